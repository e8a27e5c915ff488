"""Self-enrichment and canonical rules on single rows, nulls among them; traffic figures and curves by hand."""

from pyspark.sql import functions as F

from kerbline.operators import authority, enrich

SELF = ["circumstance", "distracted", "drowsy", "speed", "animal", "hitrun", "private_property", "mainline", "collision", "ped", "bike", "severity", "route", "fc"]
CANON = ["alignment", "route", "hpms_route", "map_road", "road_name", "intersection_name", "near_school", "school_zone", "departure", "collision", "relation", "is_ramp", "ped", "severity", "speed_limit", "speed_diff", "mpo", "injured", "ped_killed", "ped_injured"]
COUNTS = ["k_people", "a_people", "b_people", "c_people", "curve_class", "terrain"]


def rows_of(spark, texts, rows):
    schema = "id long, " + ", ".join(f"{c} string" for c in texts) + ", " + ", ".join(f"{c} int" for c in COUNTS)
    return spark.createDataFrame([(k, *[r.get(c) for c in [*texts, *COUNTS]]) for k, r in enumerate(rows)], schema)


def told(df):
    return {r.id: r for r in df.collect()}


def test_self_enriched(spark):
    rows = [{}, {"circumstance": "Fell ASLEEP, texting", "severity": "K", "private_property": " n ", "route": "US 13", "ped": "No", "collision": "Pedestrian"}, {"animal": "Yes", "circumstance": "deer", "mainline": "kept", "fc": "x", "a_people": 3, "severity": "A", "bike": "No", "collision": "Bicyclist"}, {"animal": "", "circumstance": "an elk", "hitrun": "No", "ped": "No"}]
    got = told(enrich.self_enriched(rows_of(spark, SELF, rows), ("hitrun",)))
    assert got[0].drowsy == "No" and got[0].mainline == "No" and got[0].fc == "" and got[0].k_people == 0 and got[0].ped is None
    assert (got[1].drowsy, got[1].distracted, got[1].speed, got[1].mainline, got[1].fc, got[1].k_people, got[1].ped) == ("Yes", "Yes", "No", "Yes", "3-Principal Arterial - Other (E,2)", 1, "Yes")
    # A Yes anywhere makes the column the agency's own: nothing is derived for it.
    assert [got[k].animal for k in range(4)] == [None, None, "Yes", ""] and (got[2].mainline, got[2].fc, got[2].a_people, got[2].bike) == ("kept", "x", 3, "Yes")
    assert {r.hitrun for r in got.values()} == {""} and got[3].ped == "No"
    assert enrich.self_enriched(rows_of(spark, SELF, [])).count() == 0


def test_canonical(spark):
    rows = [
        {}, {"alignment": "10. On/Off Ramp", "curve_class": 5, "is_ramp": "Yes", "near_school": "Yes"}, {"alignment": "", "curve_class": 4, "collision": "RAN OFF road"}, {"terrain": 3, "relation": "Off Roadway"}, {"curve_class": 2, "terrain": 3, "alignment": "x", "departure": "told", "collision": "overturn"},
        {"route": " ", "map_road": " Elm ", "intersection_name": "Oak & Ash"}, {"intersection_name": "Oak & Ash", "ped": "Yes", "severity": "K", "b_people": 2}, {"intersection_name": "-7 & Ash", "speed_diff": "10", "mpo": "Dover/Kent County MPO"}, {"speed_diff": "10", "speed_limit": "30", "ped": "Yes", "severity": "C"},
    ]
    got = told(enrich.canonical(rows_of(spark, CANON, rows), ("drowsy",)))
    assert (got[0].alignment, got[0].route, got[0].school_zone, got[0].departure, got[0].relation, got[0].drowsy) == (None, None, "No", None, None, "")
    assert (got[1].alignment, got[1].relation, got[1].school_zone) == ("10. On/Off Ramp", "10. On/Off Ramp", "Yes")
    assert (got[2].alignment, got[2].departure) == ("4. Grade - Curve", "Curve Departure") and (got[3].alignment, got[3].departure) == ("4. Grade - Curve", "Curve Departure")
    assert (got[4].alignment, got[4].departure) == ("1. Straight - Level", "told") and got[5].route == "Elm"
    assert (got[6].route, got[6].ped_killed, got[6].injured) == ("Oak", "1", "2") and (got[7].route, got[7].speed_diff, got[7].mpo) == (None, "", "Dover / Kent County MPO")
    assert (got[8].speed_diff, got[8].ped_injured) == ("10", "1")
    # Counts that the table has anywhere are its own.
    own = told(enrich.canonical(rows_of(spark, CANON, [{"ped": "Yes", "severity": "K", "ped_killed": "0"}, {"ped_killed": "2", "a_people": 1, "injured": "4"}])))
    assert own[0].ped_killed == "0" and own[1].injured == "4"


def test_curves_and_traffic(spark):
    one = spark.range(1)
    curve = lambda signs=(), speeds=None, **road: one.select(*[c.alias(k) for k, c in authority.curve_analysis({k: F.lit(road.get(k)).cast(t) for k, t in (("curvature", "double"), ("length_m", "double"), ("inventory", "int"), ("posted", "int"), ("guard_rail", "boolean"))}, [(s, F.lit(True)) for s in signs] or [("Turn", F.lit(None).cast("boolean"))], {k: F.lit(v) for k, v in (speeds or {25: 0}).items()}).items()]).first()
    assert tuple(curve(curvature=3.0, length_m=10.0)) == (1, "Straight", "No", "", 0, 0, 0, "No")
    assert tuple(curve(curvature=3.0, length_m=100.0, posted=50, guard_rail=True)) == (5, "Extreme", "No", "", 0, 0, 40 + 25 + 15 + 10, "Yes")
    assert tuple(curve(("Turn", "Curve"), {25: 0, 30: 2, 35: 1}, curvature=1.0, length_m=100.0, posted=45)) == (3, "Moderate", "Yes", "Turn", 30, 15, 0, "Yes")
    assert tuple(curve(inventory=3, curvature=1.2, length_m=50.0, posted=20)) == (3, "Moderate", "No", "", 0, 0, 20 + 5 + 15 + 10, "Yes")
    road = lambda **v: one.select(*[c.alias(k) for k, c in authority.traffic_engineering({k: F.lit(v.get(k)).cast("double") for k in ("aadt", "capacity", "direction", "single_unit", "combination", "k_factor", "lanes", "iri", "cracking", "psr", "toll", "hov", "structure")}).items()]).first()
    assert tuple(road()) == (0.0, "", 0.0, 0, 0, "", "No", "No", "No")
    assert tuple(road(aadt=36500.0, capacity=2000.0, single_unit=365.0, combination=1460.0, k_factor=9.0, lanes=4.0, iri=80.0, psr=4.0, cracking=3.0, toll=1.0, structure=2.0)) == (1.0, "E", 5.0, 3285, 25, "Good", "Yes", "No", "Tunnel")
    assert road(iri=200.0, psr=2.0, cracking=30.0).pavement == "Poor" and road(iri=100.0).pavement == "Fair"
