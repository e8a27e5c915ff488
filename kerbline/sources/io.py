"""Sources and sinks of the road-safety tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbline.functions.text import blank_to_null, parse_datetime
from kerbline.session import kept, small


def read_csv_text(spark: SparkSession, path: str, **options) -> DataFrame:
    """CSV, gzipped or not, as trimmed text with the blank words of exports as null; a byte-order mark in the header goes."""
    df = spark.read.options(header=True, inferSchema=False, **options).csv(path)
    return df.select(*[blank_to_null(F.col(f"`{c}`")).alias(c.replace("﻿", "").strip()) for c in df.columns])


def read_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A Parquet table's named columns; others aren't read from disk."""
    return spark.read.parquet(path).select(*columns)


def typed_crashes(raw: DataFrame, date: str, severity: str) -> DataFrame:
    """Date, severity and month of rows whose date can be read."""
    rows = raw.withColumn("crash_date", parse_datetime(F.col(date)).cast("date")).where(F.col("crash_date").isNotNull())
    return rows.select("*", F.upper(F.trim(severity)).alias("severity_class"), F.trunc("crash_date", "MM").alias("month"))


def detect_layout(columns: list[str], layouts: dict[str, dict]) -> str:
    """The layout whose required headers are all there, else the best share over one half, else ``unknown``."""
    have = {c.strip().lower() for c in columns}
    share = {k: len(have & {c.lower() for c in v["required"]}) / max(1, len(v["required"])) for k, v in layouts.items()}
    full = [k for k, s in share.items() if s == 1]
    if full:
        return max(full, key=lambda k: (len(layouts[k]["required"]), k))
    best = max(share, key=lambda k: (share[k], k), default=None)
    return best if best and share[best] > 0.5 else "unknown"


def read_layout(df: DataFrame, layouts: dict[str, dict]) -> DataFrame:
    """A file of any known layout with standard column names."""
    from kerbline.operators.clean import rename_to_standard

    kind = detect_layout(df.columns, layouts)
    if kind == "unknown":
        raise ValueError(f"no layout fits the columns {df.columns}")
    return rename_to_standard(df, layouts[kind]["aliases"]).withColumn("layout", F.lit(kind))


def read_features(df: DataFrame) -> DataFrame:
    """Feature pages (attributes map, geometry paths) as flat rows: first, last and middle point, length in metres, coordinates."""
    from kerbline.functions.geo import polyline_length_m

    points = F.transform(F.flatten("geometry.paths"), lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")))
    rows = df.withColumn("points", points).where(F.size("points") >= 2)
    at = lambda k, f: F.element_at("points", k)[f]
    middle = F.get("points", F.floor(F.size("points") / 2).cast("int"))
    return rows.select("attributes.*", at(1, "lat").alias("u_lat"), at(1, "lon").alias("u_lon"), at(-1, "lat").alias("v_lat"), at(-1, "lon").alias("v_lon"), middle["lat"].alias("mid_lat"), middle["lon"].alias("mid_lon"), polyline_length_m(F.col("points")).alias("length_m"), F.to_json("points").alias("geometry_coords"))


def union_files(frames: list[DataFrame]) -> DataFrame:
    """Frames stacked by name; columns that one lacks are null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


#: Rows that a task of a split writes, and so a file holds, at most by and large.
SPLIT_ROWS = 2_000_000


def write_splits(splits: DataFrame, path: str, fmt: str = "parquet", rows: int = SPLIT_ROWS) -> DataFrame:
    """tier, entity and road_type folders in one pass; returns the manifest (tier, entity, road_type, n, start).

    Folders are laid end to end by their counts, ``start`` being the rows before each, and a row takes a place in its
    folder's stretch by a hash of all its columns.  Stretches of ``rows`` places are tasks: a large folder is written by
    as many tasks as it has such stretches, small ones share a task, and none has much more than ``rows`` rows.  The
    manifest has a row per folder; that is what the window over it sees.
    """
    keys = ["tier", "entity", "road_type"]
    counts = kept(splits.groupBy(*keys).agg(F.count("*").alias("n")))
    before = F.coalesce(F.sum("n").over(Window.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    manifest = kept(counts.withColumn("start", before))
    total = manifest.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    own = manifest.select(*[F.col(k).alias(f"_{k}") for k in keys], "start", F.col("n").alias("_n"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    place = F.col("start") + F.pmod(F.xxhash64(*splits.columns), F.col("_n"))
    dealt = splits.join(small(own), same).withColumn("_task", (place / F.lit(rows)).cast("int")).drop(*[f"_{k}" for k in keys], "start", "_n")
    dealt.repartitionById(max(1, -(-total // rows)), F.col("_task")).drop("_task").write.mode("overwrite").partitionBy(*keys).format(fmt).save(path)
    return manifest


def write_summaries(rows: DataFrame, keys: list[str], path: str) -> None:
    """One JSON document per row."""
    rows.select(F.to_json(F.struct(*keys, F.struct(*[c for c in rows.columns if c not in keys]).alias("stats"))).alias("value")).write.mode("overwrite").text(path)


def replace_partition(df: DataFrame, path: str, by: str = "state") -> None:
    """Only the partitions that ``df`` has are replaced; columns the table lacks are added by name on reading."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def refresh(spark: SparkSession, views: dict[str, tuple[tuple[str, ...], object]], folder: str) -> list[str]:
    """Derived tables rewritten in the order of their needs; returns that order.

    views: name -> (names of the views it reads, function of a reader by name to a DataFrame).
    """
    done: list[str] = []
    while len(done) < len(views):
        ready = [n for n, (needs, _) in views.items() if n not in done and all(x in done for x in needs)]
        if not ready:
            raise ValueError(f"views that need one another: {sorted(set(views) - set(done))}")
        for name in ready:
            views[name][1](lambda x: spark.read.parquet(f"{folder}/{x}")).write.mode("overwrite").parquet(f"{folder}/{name}")
            done.append(name)
    return done
