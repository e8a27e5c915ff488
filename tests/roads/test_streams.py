"""Streams over several batches: late rows, restarts, replays, and the same answer as a batch job."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kerbline.streaming import streams

DAY = dt.datetime(2024, 3, 1)
SCHEMA = "ts timestamp, event_type string, value double, event_id long"


def land(spark, folder, name, rows):
    """One file; files are taken in the order of their times."""
    import glob
    import os

    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/tmp-{name}")
    (part,) = glob.glob(f"{folder}/tmp-{name}/part-*")
    os.makedirs(f"{folder}/in", exist_ok=True)
    os.rename(part, f"{folder}/in/{name}.parquet")
    at = 1_700_000_000 + int(name) * 10
    os.utime(f"{folder}/in/{name}.parquet", (at, at))


def source(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


def days(n, per=5):
    """Files of one day each; the fifth also has rows of day 0 (late by four days) and of day 3 (late, but awaited)."""
    out = []
    for k in range(n):
        rows = [(DAY + dt.timedelta(days=k, hours=h), "ab"[h % 2], float(h), 100 * k + h) for h in range(per)]
        if k == 4:
            rows += [(DAY, "a", 7.0, 9001), (DAY + dt.timedelta(hours=1), "b", 7.0, 9002), (DAY + dt.timedelta(days=3, hours=5), "a", 1.0, 9003), (None, "a", 1.0, 9004)]
        out.append(rows)
    return out


def test_windows_close_once(spark, folder):
    files = days(20)
    for k, rows in enumerate(files):
        land(spark, folder, f"{k:03d}", rows)
    ran = streams.run_to_end(lambda s: streams.window_counts(s, "ts", "event_type"), source(spark, folder), "ts", f"{folder}/job", DAY + dt.timedelta(days=30))
    got = [(r.w.start, r.event_type, r.n, r.value) for r in ran.rows.collect()]
    want = Counter()
    total = Counter()
    for rows in files:
        for ts, kind, value, key in rows:
            if ts is not None and key not in (9001, 9002):
                day = ts.replace(hour=0)
                want[day, kind] += 1
                total[day, kind] += value
    assert len(got) == len({g[:2] for g in got}) and {g[:2]: g[2] for g in got} == dict(want) and {g[:2]: g[3] for g in got} == dict(total)
    assert streams.late_rows(ran) == 2 and ran.landed == sum(map(len, files)) - 1
    # Some days are open at any time, whatever the stream's length; complete mode would hold all forty windows.
    assert len(want) == 40 and 0 < ran.most_state <= 10 and len([b for b in ran.batches if b["rows"]]) >= 20
    assert sum(b["dropped"] for b in ran.batches) > 0
    months = {(r.month, r.event_type): r.n for r in streams.month_rollup(ran.rows, "event_type").collect()}
    assert sum(months.values()) == sum(want.values()) and len(months) == 2


def test_restart_goes_on(spark, folder):
    """Runs over what has landed so far, again and again, give each window once."""
    files = days(9)
    counts, windows = [], None
    for k, rows in enumerate(files):
        land(spark, folder, f"{k:03d}", rows)
        if windows is None:
            windows = streams.window_counts(streams.with_beats(source(spark, folder), "ts", f"{folder}/beats"), "ts", "event_type")
        ran = streams.run(windows, f"{folder}/job")
        counts.append(ran.rows.count())
    assert counts == sorted(counts) and counts[0] == 0 and 0 < counts[5] < counts[-1]
    streams.beat(spark, f"{folder}/beats", DAY + dt.timedelta(days=40))
    rows = streams.run(windows, f"{folder}/job").rows
    assert rows.count() == rows.select("w", "event_type").distinct().count() == 18 and rows.where("event_type IS NULL").count() == 0
    assert streams.run(windows, f"{folder}/job").rows.count() == 18  # nothing new, nothing twice


def test_alerts(spark, folder):
    """Sliding windows that reach the score, against all rows in one batch."""
    files = [[(DAY + dt.timedelta(days=k, hours=h), "ab"[h % 2], 1.0, 100 * k + h) for h in range((k * 7) % 11)] for k in range(25)]
    for k, rows in enumerate(files):
        if rows:
            land(spark, folder, f"{k:03d}", rows)
    ran = streams.run_to_end(lambda s: streams.hotspot_alerts(s, "ts", "event_type", F.lit(1), 16), source(spark, folder), "ts", f"{folder}/job", DAY + dt.timedelta(days=60))
    want = Counter()
    for ts, kind, _, _ in (r for rows in files for r in rows):
        for back in range(7):
            want[ts.replace(hour=0) - dt.timedelta(days=back), kind] += 1
    got = [(r.w.start, r.event_type, r.score) for r in ran.rows.collect()]
    assert len(got) == len(set(got)) and {g[:2]: g[2] for g in got} == {k: n for k, n in want.items() if n >= 16} and got
    assert ran.rows.columns == ["w", "event_type", "score"] and ran.most_state <= 24


def test_two_sinks_replay(spark, folder):
    """A failure between the sinks, and a second try of the same batch: each row is there once."""
    files = [[(DAY, "error" if k % 4 == 0 else "click", None if k % 7 == 0 else float(k % 5), 100 * f + k) for k in range(30)] for f in range(4)]
    for k, rows in enumerate(files):
        land(spark, folder, f"{k:03d}", rows)
    checked = streams.with_broken_rules(source(spark, folder), {"error": F.col("event_type") != "error", "small": F.col("value") >= 1})
    sinks = (f"{folder}/good", f"{folder}/bad", f"{folder}/state")
    failed = []

    def fail(number):
        if number == 2 and not failed:
            failed.append(number)
            raise RuntimeError("lost between the sinks")

    with pytest.raises(Exception, match="lost between the sinks"):
        streams.two_sinks(checked, *sinks, between=fail).awaitTermination()
    half = spark.read.parquet(sinks[0]).count(), spark.read.parquet(sinks[1]).count()
    streams.two_sinks(checked, *sinks, between=fail).awaitTermination()
    good, bad = spark.read.parquet(sinks[0]).collect(), spark.read.parquet(sinks[1]).collect()
    assert failed == [2] and half[0] > 0 and {r.batch for r in good} == {0, 1, 2, 3}
    rows = [r for f in files for r in f]
    fine = {r[3] for r in rows if r[1] != "error" and r[2] is not None and r[2] >= 1}
    assert sorted(r.event_id for r in good) == sorted(fine) and sorted(r.event_id for r in bad) == sorted({r[3] for r in rows} - fine)
    for r in bad:
        assert set(r.broken) == ({"error"} if r.event_type == "error" else set()) | ({"small"} if r.value is None or r.value < 1 else set())


def test_upserts(spark, folder):
    """The newest row of each key, over batches, a repeated one and a failed one; buckets that a batch doesn't touch aren't written."""
    files = [[(DAY + dt.timedelta(hours=3 * f - k % 5), f"f{f}", float(k), k * (f + 1)) for k in range(12)] for f in range(4)]
    for k, rows in enumerate(files[:3]):
        land(spark, folder, f"{k:03d}", rows)
    args = (f"{folder}/table", "event_id", f"{folder}/state", "ts", 8)
    streams.upsert_batches(source(spark, folder), *args).awaitTermination()
    land(spark, folder, "003", files[3])
    streams.upsert_batches(source(spark, folder), *args).awaitTermination()
    streams.upsert_batches(source(spark, folder), *args).awaitTermination()
    want = {}
    for f, rows in enumerate(files):
        for ts, kind, value, key in rows:
            if key not in want or (ts, f) >= want[key][:2]:
                want[key] = (ts, f, kind, value)
    got = streams.upserted(spark, f"{folder}/table").collect()
    assert {r.event_id: (r.ts, r.event_type, r.value) for r in got} == {k: (v[0], v[2], v[3]) for k, v in want.items()} and len(got) == len(want)
    few = [(DAY + dt.timedelta(days=9), "late", 1.0, 0)]
    land(spark, folder, "004", few)
    streams.upsert_batches(source(spark, folder), *args).awaitTermination()
    assert spark.read.parquet(f"{folder}/table").where("v = 4").select("bucket").distinct().count() == 1
    assert {r.event_id: r.event_type for r in streams.upserted(spark, f"{folder}/table").collect()}[0] == "late"
