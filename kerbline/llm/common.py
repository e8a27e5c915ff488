"""Helpers shared by the training-text operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as every operator here sees it: space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of two or three numbers that may be broadcast (some 20 to 60 MB as a hash relation).
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's or its context's.

    Where none is named, a local session, whose driver and executors are one process, gets a folder of its own; a
    cluster must name one.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-kerbline-"))
        folder = sc.getCheckpointDir()
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Computes ``df`` once and cuts its lineage with files in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Computes ``df`` once into a compressed table in the shared folder, and reads that."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of :func:`new_folder` that no frame reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint where ``rows``, a count of ``df``, is within ``limit``; else Spark shuffles."""
    return F.broadcast(df) if rows <= limit else df


def wrapped(docs: DataFrame, **columns: Column) -> DataFrame:
    """Each row as one struct column ``row``, with further columns beside it: names inside can't clash with these."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(k) for k, c in columns.items()])


def unwrapped(df: DataFrame, *more: Column) -> DataFrame:
    """The rows of :func:`wrapped` with their own columns again."""
    return df.select("row.*", *more)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, other letters untouched."""
    return F.translate(c, UPPER, LOWER)


def n_words(c: Column) -> Column:
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(WORD)).cast("long")


def schema_of(df: DataFrame, keep: list[str], more: str) -> T.StructType:
    """The schema of some columns of ``df``, followed by those of a DDL string."""
    return T.StructType([df.schema[k] for k in keep] + T.StructType.fromDDL(more).fields)
