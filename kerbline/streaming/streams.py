"""Streams of crash events: deduplication, upserts, windows closed by the watermark, quarantine and alerts.

Sources are file streams with a stated schema.  Windows come out once, in append mode, when the watermark passes their
end; what is kept of them until then is all the state there is.  A source that falls silent leaves its last windows
open, so a period is ended by a beat (:func:`beat`): a row of a second folder that carries nothing but a time.

Sinks that write batch by batch (:func:`two_sinks`, :func:`upsert_batches`) keep a folder per batch number, which a
batch that runs again replaces, so every row is there once whatever failed in between.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.functions.text import content_hash


def read_events(spark: SparkSession, sf_dir: str, table: str = "events", files_per_trigger: int | None = None) -> DataFrame:
    """A file stream of a table that lands as a file or a folder; local timestamps are read as UTC."""
    path = f"{sf_dir}/{table}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.parquet(f"{path}*")  # a pattern: a plain path would have to be a folder
    return rows.withColumns({f.name: F.col(f.name).cast("timestamp") for f in rows.schema if f.dataType.simpleString() == "timestamp_ntz"})


def dedup_content(stream: DataFrame, ts: str, fields: list[str], late: str = "1 day") -> DataFrame:
    """Rows whose content came before within the watermark are dropped; state is kept no longer than that."""
    return stream.withColumn("hash", content_hash(*[F.col(f) for f in fields])).withWatermark(ts, late).dropDuplicatesWithinWatermark(["hash"])


# Windows ----------------------------------------------------------------------------------------------------


def beat(spark: SparkSession, folder: str, at) -> None:
    """Lands a beat at a time: what lies before it, less the allowed lateness, is over."""
    spark.createDataFrame([(at,)], "at timestamp").coalesce(1).write.mode("append").parquet(folder)


def with_beats(stream: DataFrame, ts: str, folder: str) -> DataFrame:
    """The stream and a folder's beats, told apart by ``is_beat``; the folder may still be empty."""
    spark = stream.sparkSession
    spark.createDataFrame([], "at timestamp").write.mode("append").parquet(folder)
    beats = spark.readStream.schema("at timestamp").parquet(folder).select(F.col("at").alias(ts), F.lit(True).alias("is_beat"))
    return stream.withColumn("is_beat", F.lit(False)).unionByName(beats, allowMissingColumns=True)


def closed_windows(stream: DataFrame, ts: str, keys: list[str], sums: dict[str, Column], length: str, step: str | None = None, late: str = "1 day") -> DataFrame:
    """w, keys, n and the sums of windows, each once, as soon as no row for it is awaited any more.

    Rows that come later than ``late`` behind the latest time seen find their window closed and are left out; how many
    :func:`run` tells.  Beats move the watermark but count for nothing; a row without a time has no window.
    """
    real = F.coalesce(~F.col("is_beat"), F.lit(True)) if "is_beat" in stream.columns else F.lit(True)
    seen = stream.observe("landed", F.count(F.when(real, 1)).alias("rows"), F.count(F.when(real & F.col(ts).isNull(), 1)).alias("untimed"))
    windows = F.window(ts, length, step) if step else F.window(ts, length)
    counted = seen.withWatermark(ts, late).groupBy(windows.alias("w"), *keys).agg(F.count(F.when(real, 1)).alias("n"), *[F.sum(F.when(real, c)).alias(k) for k, c in sums.items()])
    return counted.where("n > 0")


def window_counts(stream: DataFrame, ts: str, key: str, length: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts and the sum of ``value`` of tumbling windows."""
    return closed_windows(stream, ts, [key], {"value": F.col("value")}, length, None, late)


def month_rollup(days: DataFrame, key: str) -> DataFrame:
    """Closed windows added up to calendar months."""
    return days.groupBy(F.trunc(F.col("w.start").cast("date"), "MM").alias("month"), key).agg(F.sum("n").alias("n"))


def hotspot_alerts(stream: DataFrame, ts: str, key: str, score: Column, threshold: float, length: str = "7 days", step: str = "1 day", late: str = "1 day") -> DataFrame:
    """Sliding windows whose score reaches the threshold, told once each when they are over."""
    return closed_windows(stream, ts, [key], {"score": score}, length, step, late).where(F.col("score") >= threshold).drop("n")


@dataclass
class Ran:
    """What a run of a stream wrote, and how it went: a dict per batch with rows, state_rows, dropped and watermark."""

    rows: DataFrame
    batches: list[dict]

    @property
    def landed(self) -> int:
        """Rows with a time, beats left out."""
        return sum(b["landed"] for b in self.batches)

    @property
    def most_state(self) -> int:
        return max((b["state_rows"] for b in self.batches), default=0)


def _batches(query) -> list[dict]:
    out = []
    for p in query.recentProgress:
        state, landed = p["stateOperators"], (p["observedMetrics"] or {}).get("landed")
        out.append({
            "batch": p["batchId"], "rows": p["numInputRows"], "landed": landed["rows"] - landed["untimed"] if landed else 0, "watermark": (p["eventTime"] or {}).get("watermark"),
            "state_rows": sum(s["numRowsTotal"] for s in state), "dropped": sum(s["numRowsDroppedByWatermark"] for s in state),
        })
    return out


def run(stream: DataFrame, folder: str) -> Ran:
    """Runs an appending stream over what has landed since the last run with this folder; rows are those of all runs."""
    out = f"{folder}/out"
    query = stream.writeStream.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).format("parquet").option("path", out).start()
    query.awaitTermination()
    return Ran(stream.sparkSession.read.schema(stream.schema).parquet(out), _batches(query))


def run_to_end(windows: Callable[[DataFrame], DataFrame], stream: DataFrame, ts: str, folder: str, end) -> Ran:
    """Drains ``windows`` of a stream, then closes what is open by a beat at ``end``.

    The second run goes on from the first one's checkpoint, as a restarted job does.  ``end`` lies behind the last row
    by the length of a window and the lateness, at least.
    """
    spark, beats = stream.sparkSession, f"{folder}/beats"
    source = windows(with_beats(stream, ts, beats))
    first = run(source, folder)
    beat(spark, beats, end)
    second = run(source, folder)
    return Ran(second.rows, first.batches + second.batches)


def late_rows(ran: Ran) -> int:
    """Rows that came after their (tumbling) window had closed: those landed less those counted."""
    counted = ran.rows.agg(F.sum("n")).first()[0] or 0
    return ran.landed - counted


# Sinks that take batches ------------------------------------------------------------------------------------


def with_broken_rules(stream: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Each row with ``broken``, the names of the rules it breaks; a rule that can't be told is broken."""
    return stream.withColumn("broken", F.array_compact(F.array(*[F.when(F.coalesce(~c, F.lit(True)), k) for k, c in rules.items()])))


def two_sinks(stream: DataFrame, good: str, bad: str, checkpoint: str, between: Callable[[int], None] | None = None):
    """Rows without broken rules to ``good``, others with their reasons to ``bad``; a folder per batch in each.

    A batch is read from its source for each sink.  Its number stays the same when it runs again after a failure, and
    its folders are replaced, so a failure between the sinks (``between`` is called there) leaves no row twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        fine = F.size("broken") == 0
        batch.where(fine).drop("broken").write.mode("overwrite").parquet(f"{good}/batch={number}")
        if between:
            between(number)
        batch.where(~fine).write.mode("overwrite").parquet(f"{bad}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_batches(stream: DataFrame, target: str, key: str, checkpoint: str, order: str | None = None, buckets: int = 32):
    """A table of the newest row per key, kept current batch by batch.

    Keys are dealt to buckets, and a batch writes anew the buckets that it touches, under its own number: other buckets
    aren't read, and a batch that runs again reads what stood before it and replaces what it wrote.  ``order`` tells
    which of two rows is newer (ties and no ``order``: the one of the later batch, or any of one batch).
    """
    newest = F.col(order) if order else F.lit(0)

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mine = batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        touched = [r["bucket"] for r in mine.select("bucket").distinct().collect()]  # some dozens
        rows = mine.withColumn("_batch", F.lit(number).cast("long"))
        before = _current(spark, target, number)
        if before is not None:
            rows = rows.unionByName(before.where(F.col("bucket").isin(touched)), allowMissingColumns=True)
        picked = rows.groupBy("bucket", key).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("bucket", key)]), F.struct(newest.alias("o"), F.col("_batch").alias("b"))).alias("r"))
        out = picked.select("bucket", key, "r.*").drop("_batch")
        out.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/v={number}")

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _current(spark: SparkSession, target: str, below: int | None = None) -> DataFrame | None:
    """bucket, columns and _batch of the newest version of each bucket, of batches before ``below``; None without any."""
    try:
        table = spark.read.option("basePath", target).parquet(target)
    except Exception as e:  # the target doesn't exist before the first batch
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None
    if below is not None:
        table = table.where(F.col("v") < below)
    last = table.select("bucket", "v").distinct().groupBy("bucket").agg(F.max("v").alias("v"))  # folder names alone
    return table.join(F.broadcast(last), ["bucket", "v"]).withColumnRenamed("v", "_batch").withColumn("_batch", F.col("_batch").cast("long"))


def upserted(spark: SparkSession, target: str) -> DataFrame:
    """The table that :func:`upsert_batches` keeps."""
    return _current(spark, target).drop("_batch", "bucket")


def drain(stream: DataFrame, folder: str) -> DataFrame:
    """Runs an appending stream over what is there and returns what it wrote."""
    return run(stream, f"{folder}/drain-{uuid.uuid4().hex}").rows
