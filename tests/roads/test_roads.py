"""Road inventory, polygons, matching, numbering and forecasts against hand-made and brute-force answers."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from kerbline import session
from kerbline.functions import tags
from kerbline.operators import aggregate, build, clean, forecast, joins, normalise, rank, roads, spatial


def test_ids_go_on_beyond_seven_digits(spark):
    c = spark.createDataFrame([(k, datetime.date(2024, 1, 1), 5, 7) for k in range(60)], "id long, crash_date date, hour int, minute int").repartition(7)
    got = {r.id: r.document for r in clean.generate_crash_ids(c, "DE", ["crash_date", "id"], first=9_999_970).collect()}
    assert got == {k: f"DE-20240101-0507-{9_999_970 + k:07d}" for k in range(60)} and len(set(got.values())) == 60


def test_ranks_over_range_partitions(spark):
    rng = random.Random(4)
    values = [rng.randrange(40) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v long").repartition(5)
    got = {r.id: r.place for r in session.ranked(df, "place", F.desc("v")).collect()}
    assert got == {k: 1 + sum(x > v for x in values) for k, v in enumerate(values)}


def test_largest_counts_as_one(spark):
    rows = rank.max_normalised(spark.createDataFrame([("a", 4, 0), ("b", 1, 0)], "k string, n long, z long"), "n", "z").collect()
    assert {(r.k, r.n_share, r.z_share) for r in rows} == {("a", 1.0, 0.0), ("b", 0.25, 0.0)}


def inside(lat, lon, rings):
    n = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            n += (ay > lat) != (by > lat) and lon < (bx - ax) * (lat - ay) / (by - ay) + ax
    return n % 2 == 1


@pytest.mark.parametrize("size", [0.02, 0.3])
def test_polygons_with_holes_and_parts(spark, size):
    rng = random.Random(9)
    circle = lambda x, y, r, n: [(x + r * math.cos(2 * math.pi * k / n), y + r * math.sin(2 * math.pi * k / n)) for k in range(n)]
    layers = {1: [circle(-75.5, 39.0, 0.2, 17), circle(-75.5, 39.0, 0.07, 9)], 2: [[(-75.9, 38.8), (-75.7, 38.8), (-75.7, 39.0), (-75.9, 39.0)], circle(-75.2, 39.2, 0.05, 5)], 3: [circle(-75.45, 39.02, 0.15, 6)]}
    points = [(k, round(38.7 + rng.random() * 0.6, 3), round(-76 + rng.random(), 3)) for k in range(700)]
    as_rows = [(k, [[{"lon": x, "lat": y} for x, y in ring] for ring in rings]) for k, rings in layers.items()]
    polygons = spark.createDataFrame(as_rows, "poly_id long, rings array<array<struct<lon:double,lat:double>>>")
    got = {r.id: r.poly_id for r in spatial.point_in_polygon(spark.createDataFrame(points, "id long, lat double, lon double"), polygons, size).collect()}
    assert got == {k: min([p for p, rings in layers.items() if inside(lat, lon, rings)], default=None) for k, lat, lon in points}


def test_nearest_segment_by_brute_force(spark):
    rng = random.Random(6)
    segments = [(k, 39 + rng.random() / 20, -75.5 + rng.random() / 20, rng.random() / 100, rng.random() / 100) for k in range(120)]
    segments = [(k, a, b, a + c, b + d) for k, a, b, c, d in segments] + [(500, 39.02, -75.47, 39.02, -75.47)]
    points = [(k, 39 + rng.random() / 20, -75.5 + rng.random() / 20) for k in range(200)]

    def feet(lat, lon, s):
        k = math.cos(math.radians(lat))
        x, y, dx, dy = (lon - s[2]) * k, lat - s[1], (s[4] - s[2]) * k, s[3] - s[1]
        t = max(0, min(1, (x * dx + y * dy) / (dx * dx + dy * dy))) if dx or dy else 0
        return math.hypot(x - t * dx, y - t * dy) * 6_371_000 * math.pi / 180 * 3.28084

    got = {r.id: (r.seg_id, round(r.dist_ft, 3)) for r in spatial.match_points_to_segments(spark.createDataFrame(points, "id long, lat double, lon double"), spark.createDataFrame(segments, "seg_id long, u_lat double, u_lon double, v_lat double, v_lon double")).collect()}
    want = {}
    for k, lat, lon in points:
        d, s = min((feet(lat, lon, s), s[0]) for s in segments)
        if d <= 328:
            want[k] = s, round(d, 3)
    assert got == want and len(want) > 50


ROAD = {
    "seg_id": 1, "fc": roads.INTERSTATE, "speed": "20", "lanes": "1", "surface": "", "ownership": "2. County Hwy Agency", "system": "DOT Primary", "facility": "", "oneway": "no", "description": "", "control": "4. Stop Sign", "is_intersection": "No", "route": "I-95", "school_zone": "1. Yes", "school_ft": 0, "area": "Urban",
    "u_lat": 39.0, "u_lon": -75.0, "v_lat": 39.0, "v_lon": -75.0, "aadt": 100,
}


def ruled(spark, law=None, **changes):
    row = ROAD | changes
    return roads.road_rules(spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'double' if k[1:] in ('_lat', '_lon') else 'int' if isinstance(v, int) else 'string'}" for k, v in ROAD.items())), law).first()


def test_road_rules_by_hand(spark):
    r = ruled(spark)
    assert (r.speed, r.surface, r.ownership, r.system, r.facility, r.control, r.lanes, r.school_zone) == ("55", roads.CONCRETE, "1. State Hwy Agency", "DOT Interstate", roads.DIVIDED, roads.NO_CONTROL, "2", "3. No")
    assert r.description == "2. Two-Way, Divided, Unprotected Median" and {"GEOM_ZERO", "AADT_I_LO"} <= set(r.rules)
    r = ruled(spark, fc="7-Local (J,6)", speed="", route="US 13", lanes="4", school_ft=400, school_zone="3. No", control="3. Traffic Signal", facility="3-Two-Way Undivided", oneway="-1")
    assert (r.fc, r.system, r.ownership, r.speed, r.school_zone, r.control, r.facility) == (roads.PRINCIPAL, "DOT Primary", "1. State Hwy Agency", "", "1. Yes", roads.NO_CONTROL, roads.ONE_WAY)
    law = spark.createDataFrame([(7, "Urban", 25), (1, "Urban", 60)], "fc_code int, area string, limit int")
    assert ruled(spark, law, fc="7-Local (J,6)", speed="").speed == "25" and ruled(spark, law, speed="80").speed == "60" and ruled(spark, law, speed="70").speed == "70"
    assert ruled(spark, fc="", speed="5").rules == [x for x in ("SCHZ_FAR", "GEOM_ZERO") if x]


def test_road_values(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("v")).first().v
    lit = F.lit
    assert value(roads.route_name(lit(""), lit("US 9;DE 404"))) == "US 9" and value(roads.route_name(lit(""), lit("36A"))) == "CR 36A" and value(roads.route_name(lit(""), lit("Main St"))) == "" and value(roads.route_name(lit("SR 1"), lit("I 95"))) == "SR 1"
    assert value(roads.route_name(lit(None), lit("de-9"), "DE")) == "de-9"
    assert value(roads.repaired_owner(lit("Other State Agency"), lit(64), lit(""))) == "4. Federal Roads" and value(roads.repaired_owner(lit("x"), lit(None), lit("5-M"))) == "2. County Hwy Agency" and value(roads.repaired_owner(lit("x"), lit(99), lit(""))) == "6. Private/Unknown Roads" and value(roads.repaired_owner(lit(""), lit(1), lit(""))) == ""
    kinds = [value(roads.intersection_type(lit("Yes"), lit(d), lit(s).cast("int"))) for d, s in ((5, None), (6, None), (9, None), (10, None), (3, 3), (9, 2), (3, 6))]
    assert [k[0] for k in kinds] == list("1345315") and value(roads.intersection_type(lit("No"), lit(9), lit(4)))[0] == "1"
    assert value(roads.alignment(lit(4), lit("No"), lit("0"), lit(1))) == "2. Curve - Level" and value(roads.alignment(lit(4), lit("No"), lit(""), lit(2))) == "4. Grade - Curve" and value(roads.alignment(lit(0), lit("Yes"), lit("2"), lit(None).cast("int"))) == "10. On/Off Ramp"
    assert value(roads.resolve_lanes(lit(""), lit(None), lit("3;2"))["value"]) == 3 and value(roads.resolve_bridge(lit(0), lit("no"), lit("Yes"))["source"]) == "Federal"
    assert value(build.intersection_analysis(lit("4. Four Approaches"), lit("3. City or Town Hwy Agency"))) == "Urban Intersection"
    assert value(tags.road_words(lit("6"), lit("no"), lit("yes"))) == "6 Lanes, Divided" and value(tags.relevance(lit("Ohio"))) == 10


def test_volumes_stay_within_a_class(spark):
    rows = [(1, "R1", "Main", "3-P", 100), (2, "R1", "Main", "3-P", 300), (3, "R1", "x", "3-P", 0), (4, "R1", "Main", "7-L", None), (5, "", "Main", "3-P", None), (6, "", "", "3-P", None), (7, "", "", "7-L", 50), (8, "", "", "7-L", 0)]
    got = {r.seg_id: (r.aadt, r.aadt_source) for r in roads.filled_aadt(spark.createDataFrame(rows, "seg_id long, ref string, name string, fc string, aadt int")).collect()}
    assert got == {1: (100, "direct"), 2: (300, "direct"), 3: (200, "ref_propagation"), 4: (0, ""), 5: (200, "name_propagation"), 6: (200, "fc_median"), 7: (50, "direct"), 8: (0, "")}


def test_layouts_are_told_by_their_headers():
    most = ["crash_datetime", "latitude", "longitude", "county_name", "alcohol_involved", "drug_involved"]
    assert normalise.detect(["cuid", "System Code ", "Injury 00", "Injury 04", "x"]) == "colorado" and normalise.detect(most) == "delaware" and normalise.detect(most[:3]) == normalise.detect([]) == "unknown"
    assert normalise.detect(["report_no", "acrs_report_type", "road_name", "county_desc"]) == "maryland_statewide"


def test_positions_of_nodes_leave_blank_nodes_alone(spark):
    c = spark.createDataFrame([(1, "N1", 39.0, -75.0), (2, "N1", None, None), (3, "", None, None), (4, None, 38.0, -74.0)], "id long, node string, lat double, lon double")
    assert {tuple(r) for r in joins.fill_from_same_node(c).collect()} == {(1, 39.0, -75.0), (2, 39.0, -75.0), (3, None, None), (4, 38.0, -74.0)}


def test_unique_values(spark):
    rows = aggregate.unique_values(spark.createDataFrame([("b", 1), ("a", 1), ("", 2), (None, None)], "x string, y int"), ["x", "y"]).collect()
    assert {tuple(r) for r in rows} == {("x", "a,b", 2), ("y", "1,2", 2)}


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(3)
    rows = [(s, datetime.date(2019 + k // 12, k % 12 + 1, 1), int(30 + 10 * n + 8 * math.sin(k / 2) + rng.randrange(6))) for n, s in enumerate("abc") for k in range(40)] + [("d", datetime.date(2020, 1, 1), 0)]
    return rows, spark.createDataFrame(rows, "series string, month date, value long")


def smoothed(values, moys, ahead):
    """Additive Holt-Winters step by step, in plain Python: the middle forecast and the error's deviation."""
    level = sum(values[:12]) / 12
    trend = (sum(values[12:24]) / 12 - level) / 12
    season = {moys[k]: values[k] - level for k in range(12)}
    errors = []
    for v, m in zip(values[12:], moys[12:]):
        errors.append(v - level - trend - season[m])
        old = level
        level = 0.3 * (v - season[m]) + 0.7 * (level + trend)
        trend = 0.1 * (level - old) + 0.9 * trend
        season[m] = 0.15 * (v - level) + 0.85 * season[m]
    trust = min(1, len(values) / 36)
    level, trend = trust * level + (1 - trust) * sum(values) / len(values), trust * trend
    return [max(0, level + trend * h + season[(moys[-1] + h) % 12]) for h in range(1, ahead + 1)], math.sqrt(sum(e * e for e in errors) / (len(errors) - 1))


def test_forecasts_by_brute_force(series):
    rows, df = series
    got = {(r.series, r.month): r for r in forecast.forecast(df).collect()}
    for s in "abc":
        mine = sorted((m, v) for x, m, v in rows if x == s)
        middle, spread = smoothed([v for _, v in mine], [m.month - 1 for m, _ in mine], 12)
        for h, p in enumerate(middle, 1):
            last = mine[-1][0]
            month = datetime.date(last.year + (last.month - 1 + h) // 12, (last.month - 1 + h) % 12 + 1, 1)
            r = got[s, month]
            assert abs(r.p50 - p) <= 0.051 and abs(r.p90 - (p + 1.282 * spread * math.sqrt(h))) <= 0.051


def test_backtest_groups_and_movement(spark, series):
    rows, df = series
    told = {r.series: r for r in forecast.backtest(df).collect()}
    assert set(told) == set("abc")
    for s in "abc":
        mine = sorted((m, v) for x, m, v in rows if x == s)
        middle, _ = smoothed([v for _, v in mine[:-6]], [m.month - 1 for m, _ in mine[:-6]], 6)
        errors = [abs(v - p) for (_, v), p in zip(mine[-6:], middle)]
        r = told[s]
        assert abs(r.mae - sum(errors) / 6) < 0.06 and abs(r.rmse - math.sqrt(sum(e * e for e in errors) / 6)) < 0.06
        mape = sum(e / v for e, (_, v) in zip(errors, mine[-6:])) / 6 * 100
        assert abs(r.mape - mape) < 0.3 and r.grade in "ABCD"
        same = [(mine[-6 + k][1] > mine[-7 + k][1]) == (round(middle[k], 1) > round(middle[k - 1], 1)) for k in range(1, 6)]
        assert r.direction == pytest.approx(sum(same) / 5 * 100, abs=20.1)
    ahead = forecast.forecast(df)
    members = spark.createDataFrame([("a", "G"), ("b", "G"), ("c", "H")], "series string, entity string")
    single = {(r.series, r.month): r.p50 for r in ahead.collect()}
    for r in forecast.sum_members(ahead, members).collect():
        assert r.p50 == pytest.approx(sum(single[s, r.month] for s in ("ab" if r.entity == "G" else "c")), abs=0.06) and r.members == (2 if r.entity == "G" else 1)
    sums = {s: sum(v for x, _, v in rows if x == s) for s in "abcd"}
    later = {s: sum(p for (x, _), p in single.items() if x == s) for s in "abcd"}
    place = lambda of: {s: k for k, s in enumerate(sorted(of, key=lambda s: (-of[s], s)), 1)}
    for r in forecast.rank_movement(ahead, df).collect():
        assert (r.past_rank, r.ahead_rank) == (place(sums)[r.series], place(later)[r.series]) and r.moved == r.past_rank - r.ahead_rank
