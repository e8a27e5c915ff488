"""Sessions with the settings this library is written for."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a side that may be broadcast after they were counted.
BROADCAST_ROWS = 200_000


def session(name: str = "kerbline", **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew handling; other settings come from the cluster or ``conf``."""
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    builder = SparkSession.builder.appName(name)
    for k, v in (base | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.  Where none is named, a local session gets one of its own; a cluster must name one."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-kerbline-"))
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def kept(df: DataFrame) -> DataFrame:
    """Computes ``df`` once into a table in the shared folder, and reads that: what follows sees the same rows, however often it asks."""
    path = f"{shared_dir(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def in_order(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` with ``_part`` and ``_before``: its range partition by ``order``, and the rows of all partitions before.

    Rows that agree in ``order`` share a partition, so a window inside one plus the offset numbers or ranks all rows
    without any task that sees them all.  The partitions are a stored table, as a second shuffle might cut other ranges.
    """
    parts = kept(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))  # a row per partition
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return parts.join(F.broadcast(before), "_part")


def ranked(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """``df`` with its rank by ``order``, ties sharing the lower number, however many rows there are."""
    place = F.rank().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before")
    return in_order(df, *order).withColumn(name, place.cast("long")).drop("_part", "_before")


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if ``df`` has at most ``limit`` rows, told by a count that stops there; else Spark shuffles."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
