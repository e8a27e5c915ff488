"""Operators against hand-made answers."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from kerbline.functions import geo, text
from kerbline.operators import aggregate, clean, forecast, rank, spatial, stats
from kerbline.sources import io


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_constant_series_has_no_spread():
    for r in forecast.holt_winters([7] * 36, [k % 12 for k in range(36)], 12):
        assert {r[q] for q in forecast.QUANTILES} == {7.0}


def test_seasonal_series_keeps_its_pattern_from_any_first_month():
    pattern = [10 + 5 * math.sin(2 * math.pi * m / 12) for m in range(12)]
    for first in (0, 5):
        moys = [(first + k) % 12 for k in range(48)]
        got = forecast.holt_winters([pattern[m] for m in moys], moys, 12)
        assert all(abs(r["p50"] - pattern[(first + 48 + k) % 12]) < 0.2 for k, r in enumerate(got))


def test_seasonal_terms_add_to_zero(spark):
    s = spark.createDataFrame([("a", datetime.date(2020 + k // 12, k % 12 + 1, 1), 20 + k % 12) for k in range(24)], "series string, month date, value long")
    assert abs(sum(r.seasonal for r in forecast.seasonal_pattern(s).collect())) < 1e-9


def test_ties_share_the_lower_rank(spark):
    m = spark.createDataFrame([("a", "D", "", "P", 5.0), ("b", "D", "", "P", 5.0), ("c", "D", "M", "P", 1.0), ("d", "", "M", "Q", 9.0)], "juris string, district string, mpo string, planning string, x double")
    got = {(r.juris, r.scope): r["rank"] for r in rank.rank_scopes(m, ["x"]).collect()}
    assert [got[j, "Juris"] for j in "dabc"] == [1, 2, 2, 4] and [got[j, "District"] for j in "abc"] == [1, 1, 3]
    assert ("d", "District") not in got and ("a", "MPO") not in got and got["d", "MPO"] == 1


def test_unknown_restraint_counts_as_unrestrained(spark):
    p = spark.createDataFrame([(1, 2020, 1, 0, 30, 0, 0, None), (2, 2020, 1, 4, 40, 1, 0, 3), (2, 2020, 5, 4, 9, 0, 9, 7)], "st_case long, year int, per_typ int, inj_sev int, age int, drinking int, alc_res int, rest_use int")
    got = {r.st_case: r for r in aggregate.persons_to_case(p).collect()}
    assert got[1].any_unrestrained and not got[2].any_unrestrained and got[2].ped_fatals == 1 and got[2].oldest_driver_age == 40


def test_ten_roads_two_schools(spark):
    """Roads 500 feet apart, schools at 0 and 3000 feet, radius 1000 feet."""
    foot = 1 / geo.FT / (geo.M_PER_DEG * math.cos(math.radians(39)))
    roads = spark.createDataFrame([(k, 39.0, -75.5 + 500 * k * foot) for k in range(10)], "place_id long, lat double, lon double")
    schools = spark.createDataFrame([(1, 1, 990 / geo.FT, 39.0, -75.5), (2, 1, 990 / geo.FT, 39.0, -75.5 + 3000 * foot)], "asset_id long, category int, radius_m double, t_lat double, t_lon double")
    got = {r.place_id: (r.asset_id, round(r.dist_m * geo.FT), r.n) for r in spatial.nearest_asset_attrs(roads, schools, 990 / geo.FT).collect()}
    assert got == {0: (1, 0, 1), 1: (1, 500, 1), 5: (2, 500, 1), 6: (2, 0, 1), 7: (2, 500, 1)}


def test_long_segments_are_found_in_the_middle_of_nowhere(spark):
    s = spark.createDataFrame([(1, 38.0, -75.0, 39.0, -75.0)], "seg_id long, u_lat double, u_lon double, v_lat double, v_lon double")
    p = spark.createDataFrame([(1, 38.2, -75.0005), (2, 38.2, -75.1)], "id long, lat double, lon double")
    got = spatial.match_points_to_segments(p, s).collect()
    assert [(r.id, r.seg_id, r.confidence) for r in got] == [(1, 1, "medium")] and abs(got[0].dist_ft - 143.3) < 1


def test_incremental_modes(spark):
    old = spark.range(100).select(F.col("id"), (F.col("id") * 7).alias("x"))
    fresh = lambda n: old.union(spark.range(1000, 1000 + n).select("id", (F.col("id") * 7).alias("x")))
    mode = lambda n: clean.diff_mode(old, fresh(n), ["id", "x"]).first()["mode"]
    assert [mode(0), mode(5), mode(30)] == ["skip", "incremental", "full"]


def test_merge_is_idempotent(spark):
    t = "id long, doc string, dt string, x double, y double, kind string"
    old = spark.createDataFrame([(1, "A", "d", 1.0, 2.0, "k"), (2, "", "d", None, None, "k")], t)
    new = spark.createDataFrame([(3, "A", "e", 5.0, 5.0, "k"), (4, "B", "d", 1.0, 2.0, "k"), (5, "", "d", None, None, "k"), (6, "C", "f", 1.0, 2.0, "k")], t)
    once = clean.merge_existing(old, new, "doc", ["dt", "x", "y", "kind"], "id")
    assert sorted(r.id for r in once.collect()) == [1, 2, 5, 6]
    assert sorted(r.id for r in clean.merge_existing(once, new.where("id <> 5"), "doc", ["dt", "x", "y", "kind"], "id").collect()) == [1, 2, 5, 6]


def test_texts(spark):
    one = lambda *c: spark.range(1).select(*c).first()
    assert one(text.slug(F.lit("001. Prince George's County - (partial)")))[0] == "prince_georges_county_partial"
    assert one(text.parse_datetime(F.lit("2015 Jul 17 03:15:00 PM")))[0] == datetime.datetime(2015, 7, 17, 15, 15)
    assert one(text.parse_datetime(F.lit("nonsense")))[0] is None
    assert one(text.extract_year(F.lit("17/7/15")))[0] == 2015
    assert one(text.parse_maxspeed(F.lit("50 km/h")))[0] == 31 and one(text.parse_maxspeed(F.lit("fast")))[0] is None


def test_normal_tail(spark):
    for z in (0.0, 0.5, 1.0, 1.96, 3.0):
        assert math.isclose(spark.range(1).select(stats.normal_tail(F.lit(z))).first()[0], 0.5 * math.erfc(z / math.sqrt(2)), abs_tol=1e-7)


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿Crash Date,Severity,x\n01/15/2024, k ,1\nnan,O,2\n")
    df = io.typed_crashes(io.read_csv_text(spark, f"file://{tmp_path}/a.csv"), "Crash Date", "Severity")
    assert [(r.severity_class, r.month) for r in df.collect()] == [("K", datetime.date(2024, 1, 1))]
    splits = spark.createDataFrame([("state", "all", "all_roads", k) for k in range(20)], "tier string, entity string, road_type string, id long")
    io.write_splits(splits, f"file://{tmp_path}/s")
    assert spark.read.parquet(f"file://{tmp_path}/s").where("tier = 'state'").count() == 20
    # One folder has most rows, others a few: no task writes much more than its share, and every row is there once.
    sizes = {("state", "all", "all_roads"): 5000, **{("county", f"c{k}", "all_roads"): 40 + k for k in range(30)}, ("city", None, "all_roads"): 70}
    many = [(t, e, r, k) for (t, e, r), n in sizes.items() for k in range(n)]
    manifest = io.write_splits(spark.createDataFrame(many, "tier string, entity string, road_type string, id long").repartition(3), f"file://{tmp_path}/m", rows=500).collect()
    assert {(m.tier, m.entity, m.road_type): m.n for m in manifest} == sizes
    back = spark.read.parquet(f"file://{tmp_path}/m").selectExpr("tier", "entity", "id", "_metadata.file_path AS f").collect()
    assert sorted((b.tier, str(b.entity), b.id) for b in back) == sorted((t, str(e), k) for t, e, _, k in many)
    tasks = {}
    for b in back:
        task = b.f.rsplit("/", 1)[1].split("-")[1]
        tasks[task] = tasks.get(task, 0) + 1
    assert max(tasks.values()) < 1.25 * 500 and len(tasks) == -(-len(many) // 500)
    assert len({b.f for b in back if b.tier == "state"}) >= 10 and all(len({b.f for b in back if b.entity == f"c{k}"}) <= 2 for k in range(30))
    io.replace_partition(spark.createDataFrame([("a", 1), ("b", 1)], "state string, n int"), f"file://{tmp_path}/p")
    io.replace_partition(spark.createDataFrame([("b", 2)], "state string, n int"), f"file://{tmp_path}/p")
    assert sorted(rows(spark.read.parquet(f"file://{tmp_path}/p").select("state", "n"))) == [("a", 1), ("b", 2)]
    layouts = {"x": {"required": ["a", "b"], "aliases": {"first": ["a"]}}, "y": {"required": ["a", "c", "d"], "aliases": {"first": ["c"]}}}
    assert [io.detect_layout(c, layouts) for c in (["A", "b", "z"], ["a", "c"], ["q"])] == ["x", "y", "unknown"]


def test_ids_count_on_from_partition_to_partition(spark):
    c = spark.range(500).select("id", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("crash_date"), F.lit(3).alias("hour"), F.lit(7).alias("minute"))
    got = [r.document for r in clean.generate_crash_ids(c, "DE", ["crash_date", "id"]).orderBy("crash_date", "id").collect()]
    assert [int(d[-7:]) for d in got] == list(range(1, 501)) and got[0].startswith("DE-20200101-0307-")


@pytest.mark.parametrize("parts", [1, 8])
def test_partition_count_changes_nothing(spark, sf, parts):
    from kerbline import catalog

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = rows(catalog.QUERIES["hotspots"](spark, sf))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == 50 and [r[-2] for r in got] == sorted((r[-2] for r in got), reverse=True)
