"""The road-safety tables over the order tables of a data folder, and the same as SQL.

The binding is by integer arithmetic on keys, so that any engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEVERITY = {"1-URGENT": "K", "2-HIGH": "A", "3-MEDIUM": "B", "4-NOT SPECIFIED": "C", "5-LOW": "O"}


#: Road segments that one task derives and checks.
SEGMENTS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LABELS = {
    "own_code": {1: "1. State Hwy Agency", 2: "2. County Hwy Agency", 3: "3. City or Town Hwy Agency", 4: "4. Federal Roads", 5: "5. Toll Roads Maintained by Others", 6: "6. Private/Unknown Roads"},
    "fc_code": {1: "1-Interstate (A,1)", 2: "2-Principal Arterial - Other Freeways and Expressways (B)", 3: "3-Principal Arterial - Other (E,2)", 4: "4-Minor Arterial (H,3)", 5: "5-Major Collector (I,4)", 6: "6-Minor Collector (5)", 7: "7-Local (J,6)"},
    "weather_code": {0: "1. No Adverse Condition (Clear/Cloudy)", 1: "5. Rain", 2: "6. Snow", 3: "3. Fog"},
    "light_code": {0: "2. Daylight", 1: "1. Dawn", 2: "3. Dusk", 3: "4. Darkness - Road Lighted", 4: "5. Darkness - Road Not Lighted"},
    "area_code": {0: "Urban", 1: "Suburban", 2: "Rural"},
}
#: Yes/No flags: a crash has one where its key is divisible by the number.
FLAGS = {"ped": 11, "bike": 13, "motorcycle": 17, "alcohol": 5, "drug": 19, "speed": 7, "distracted": 6, "drowsy": 23, "hitrun": 12, "senior": 8, "young": 9, "unrestrained": 10, "work_zone": 29, "school_zone": 31, "animal": 37, "guardrail": 41, "lgtruck": 14}

_BASE = {
    "id": "o_orderkey",
    "crash_date": "CAST(o_orderdate AS DATE)",
    "hour": "CAST(o_orderkey * 7 % 24 AS INT)",
    "minute": "CAST(o_orderkey * 11 % 60 AS INT)",
    "severity": "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SEVERITY.items()) + " ELSE 'O' END",
    "juris": "n_name",
    "fips": "CAST(n_nationkey AS INT)",
    "region": "CAST(n_regionkey AS INT)",
    "district": "CASE WHEN n_nationkey % 9 = 8 THEN '' ELSE concat('D', CAST(n_regionkey AS VARCHAR(3))) END",
    "mpo": "CASE WHEN n_nationkey % 4 = 3 THEN '' ELSE concat('MPO', CAST(n_nationkey % 4 AS VARCHAR(3))) END",
    "planning": "concat('PD', CAST(n_nationkey % 3 AS VARCHAR(3)))",
    "collision": "c_mktsegment",
    "own_code": "CAST(o_custkey % 7 + 1 AS INT)",
    "fc_code": "CAST(o_custkey % 8 AS INT)",
    "route": "CASE WHEN o_custkey % 53 = 0 THEN '' ELSE concat('R', CAST(o_custkey % 97 AS VARCHAR(6))) END",
    "node": "CASE WHEN o_custkey % 5 = 0 THEN '' ELSE concat('N', CAST(o_custkey % 211 AS VARCHAR(6))) END",
    "weather_code": "CAST(o_orderkey * 5 % 4 AS INT)",
    "light_code": "CAST(o_orderkey * 3 % 5 AS INT)",
    "area_code": "CAST(o_custkey % 3 AS INT)",
    "lat": "38.8 + (o_orderkey * 7919 % 6000) / 10000.0E0",
    "lon": "-75.7 + (o_orderkey * 104729 % 4000) / 10000.0E0",
    "k_people": "CASE WHEN o_orderpriority = '1-URGENT' THEN 1 + o_orderkey % 2 ELSE 0 END",
    "a_people": "CASE WHEN o_orderpriority = '2-HIGH' THEN 1 + o_orderkey % 3 ELSE 0 END",
    "b_people": "CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END",
    "c_people": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 + o_orderkey % 4 ELSE 0 END",
    **{f"is_{k}": f"o_orderkey % {n} = 0" for k, n in FLAGS.items()},
}
_MORE = {
    "year": "CAST(year(crash_date) AS INT)",
    "month": "CAST(date_trunc('month', crash_date) AS DATE)",
    "is_night": "hour >= 20 OR hour < 5",
    "epdo": "CASE severity WHEN 'K' THEN 883 WHEN 'A' THEN 94 WHEN 'B' THEN 21 WHEN 'C' THEN 11 ELSE 1 END",
    **{name: f"CASE {code} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in of.items()) + " ELSE '' END" for name, code, of in (("ownership", "own_code", _LABELS["own_code"]), ("fc", "fc_code", _LABELS["fc_code"]), ("weather", "weather_code", _LABELS["weather_code"]), ("light", "light_code", _LABELS["light_code"]), ("area_type", "area_code", _LABELS["area_code"]))},
}


def _view(base: dict, more: dict, source: str) -> str:
    inner = ", ".join(f"{e} AS {n}" for n, e in base.items())
    outer = "".join(f", {e} AS {n}" for n, e in more.items())
    return f"SELECT *{outer} FROM (SELECT {inner} FROM {source}) base_rows"


CRASHES_SQL = _view(_BASE, _MORE, "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
PERSONS_SQL = """SELECT l_orderkey AS st_case, CAST(year(l_shipdate) AS INT) AS year, CAST(l_linenumber AS INT) AS per_typ,
 CASE l_returnflag WHEN 'R' THEN 4 WHEN 'A' THEN 3 ELSE 0 END AS inj_sev, CAST(l_quantity AS INT) AS age,
 CASE WHEN l_partkey % 4 = 0 THEN 1 ELSE 0 END AS drinking, CAST(l_partkey % 97 AS INT) AS alc_res,
 CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE CAST(l_suppkey % 9 AS INT) END AS rest_use FROM lineitem"""
VEHICLES_SQL = """SELECT l_orderkey AS st_case, CAST(year(l_shipdate) AS INT) AS year,
 CASE WHEN l_linestatus = 'O' THEN CAST(l_partkey % 7 AS INT) ELSE 0 END AS speedrel, CAST(l_partkey % 100 AS INT) AS body_typ,
 CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE CAST(l_suppkey % 100 AS INT) END AS mdrdstrd, CAST(l_suppkey % 4 AS INT) AS hit_run FROM lineitem"""
SEGMENTS_SQL = """SELECT *, (u_lat + v_lat) / 2 AS mid_lat, (u_lon + v_lon) / 2 AS mid_lon FROM (SELECT p_partkey AS seg_id, p_partkey % 500 AS u_node, (p_partkey * 7 + 1) % 500 AS v_node,
 38.8 + (p_partkey * 7919 % 6000) / 10000.0E0 AS u_lat, -75.7 + (p_partkey * 104729 % 4000) / 10000.0E0 AS u_lon,
 38.8 + (p_partkey * 7919 % 6000) / 10000.0E0 + (p_size - 25) / 5000.0E0 AS v_lat, -75.7 + (p_partkey * 104729 % 4000) / 10000.0E0 + (p_size % 17 - 8) / 2000.0E0 AS v_lon,
 CAST(p_size AS INT) AS lanes_code, p_type AS surface_source, CAST(p_partkey % 8 AS INT) AS fc_code, CAST(p_partkey % 7 + 1 AS INT) AS own_code,
 concat('R', CAST(p_partkey % 97 AS VARCHAR(6))) AS ref, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_partkey * 37 % 20000 AS INT) END AS aadt FROM part) seg_rows"""
ASSETS_SQL = """SELECT s_suppkey AS asset_id, s_name AS asset_name, CAST(s_nationkey % 11 AS INT) AS category, CAST(500 + s_nationkey % 11 * 250 AS INT) AS radius_ft,
 38.8 + (s_suppkey * 6701 % 6000) / 10000.0E0 AS lat, -75.7 + (s_suppkey * 90001 % 4000) / 10000.0E0 AS lon FROM supplier"""
_CHOICE = lambda key, *words: f"CASE {key} % {len(words)} " + " ".join(f"WHEN {k} THEN {w if w == 'NULL' else repr(w)}" for k, w in enumerate(words)) + " END"
_YES = lambda cond: f"CASE WHEN {cond} THEN 'Yes' ELSE 'No' END"
#: p is the segment's key; every tenth segment repeats the ends, name and source of the one before (q).
_ROADS = {
    "seg_id": "p", "fc_code": "CAST(p % 8 AS INT)", "name": "CASE WHEN q % 5 = 0 THEN '' ELSE concat('Street ', CAST(q % 400 AS STRING)) END",
    "ref": "CASE p % 7 WHEN 0 THEN concat('I ', CAST(p % 99 AS STRING)) WHEN 1 THEN concat('US ', CAST(p % 60 AS STRING), ';DE 4') WHEN 2 THEN CAST(p % 500 AS STRING) WHEN 3 THEN concat('de-', CAST(p % 300 AS STRING)) WHEN 4 THEN '' ELSE concat('Main ', CAST(p % 90 AS STRING)) END",
    "hpms_route": "CASE p % 11 WHEN 0 THEN concat('SR ', CAST(p % 70 AS STRING)) WHEN 1 THEN '0' ELSE '' END", "sdot_route": _CHOICE("p", "", "", "", "0", "Route A", "", ""),
    "route": "CASE p % 6 WHEN 0 THEN 'I-95' WHEN 1 THEN 'US 13' WHEN 2 THEN 'Interlake Road' ELSE concat('R', CAST(p % 97 AS STRING)) END",
    "ownership": _CHOICE("p", "1. State Hwy Agency", "2. County Hwy Agency", "3. City or Town Hwy Agency", "4. Federal Roads", "5. Toll Roads Maintained by Others", "6. Private/Unknown Roads", "Other State Agency", "", "Town"),
    "hpms_ownership": "CASE WHEN p % 4 = 0 THEN NULL ELSE CAST(p % 81 AS INT) END", "sdot_ownership": _CHOICE("p", "", "2. County Hwy Agency", "The county", "", ""),
    "system": _CHOICE("p", "", "DOT Primary", "DOT Secondary", "Non-DOT secondary"), "facility": _CHOICE("p", "", "1-One-Way Undivided", "3-Two-Way Undivided", "4-Two-Way Divided", "2-One-Way Divided"),
    "description": _CHOICE("p", "", "1. Two-Way, Not Divided", "nan"), "control": _CHOICE("p * 3", "", "4. Stop Sign", "3. Traffic Signal", "1. No Traffic Control"), "oneway": _CHOICE("p", "yes", "no", "-1", ""),
    "lanes": "CAST(p * 5 % 7 AS STRING)", "speed": "CAST(p * 3 % 90 AS STRING)", "area": _CHOICE("p", "Urban", "Suburban", "Rural"), "surface": _CHOICE("p", "", "1. Concrete", "2. Blacktop, Asphalt, Bituminous", "3. Brick or Block", "nan"),
    "school_zone": _CHOICE("p", "1. Yes", "3. No", "yes", "0", ""), "school_ft": "CAST(p * 13 % 2600 AS INT)", "is_intersection": _YES("p % 3 = 0"), "degree": "CAST(p % 13 AS INT)", "streets": "CASE WHEN p % 2 = 0 THEN CAST(p % 7 AS INT) END",
    "curve_class": "CAST(p % 6 AS INT)", "is_ramp": _YES("p % 17 = 0"), "grade_class": _CHOICE("p", "", "0", "1", "NULL"), "terrain": "CAST(p * 7 % 4 AS INT)", "aadt": "CASE WHEN p % 3 = 0 THEN NULL ELSE CAST(p * 37 % 2500 * (p % 4) AS INT) END",
    "u_lat": "38.8 + (q * 7919 % 6000) / 10000.0E0", "u_lon": "-75.7 + (q * 104729 % 4000) / 10000.0E0", "v_lat": "38.8 + (q * 7919 % 6000) / 10000.0E0 + (q % 51 - 25) / 2000.0E0", "v_lon": "-75.7 + (q * 104729 % 4000) / 10000.0E0 + (q % 17 - 8) / 2000.0E0",
    "road_source": _CHOICE("q", "OSM", "HPMS"), "u_node": "CASE WHEN p % 50 = 0 THEN -1 ELSE p % 500 END", "v_node": "(p * 7 + 1) % 500", "match_ft": "CASE WHEN p % 6 = 0 THEN -1.0E0 ELSE p % 300 * 1.0E0 END",
    "planning": "CASE p % 4 WHEN 0 THEN 'Dover/Kent MPO' WHEN 1 THEN 'D1' ELSE concat('PD', CAST(p % 3 AS STRING)) END", "mpo": _CHOICE("p * 5", "Dover / Kent MPO", "WILMAPCO", ""), "district": "CASE WHEN p % 5 = 0 THEN '' ELSE concat('D', CAST(p % 3 AS STRING)) END", "county": "CASE p % 4 WHEN 0 THEN '001' WHEN 1 THEN '003' WHEN 2 THEN '005' ELSE '' END",
    "sdot_speed": "CASE WHEN p % 5 = 0 THEN CAST(p % 90 AS STRING) ELSE '' END", "hpms_speed": "CASE WHEN p % 3 = 0 THEN CAST(p * 7 % 95 AS STRING) ELSE '' END", "map_speed": _CHOICE("p", "35", "", "", ""), "maxspeed": _CHOICE("p", "30", ""),
    "osm_lanes": "CASE p % 3 WHEN 0 THEN concat(CAST(p % 5 AS STRING), ';2') WHEN 1 THEN 'x' ELSE '' END", "hpms_lanes": "CASE WHEN p % 4 = 0 THEN CAST(p % 14 AS INT) END", "sdot_lanes": "CASE WHEN p % 6 = 0 THEN concat(CAST(p % 5 AS STRING), '.0') ELSE '' END",
    "osm_surface": _CHOICE("p", "asphalt", "Gravel", "", "sett ", "unknown", "mud"), "hpms_surface": "CASE WHEN p % 3 = 0 THEN CAST(p % 7 AS INT) END", "sdot_surface": _CHOICE("p", "1. Concrete", "5. Dirt", "", "", ""),
    "hpms_signal": "CASE WHEN p % 2 = 0 THEN CAST(p % 3 AS INT) END", "poi_signal": _YES("p % 5 = 0"), "map_signal": _YES("p % 7 = 0"), "poi_stop": _YES("p % 4 = 1"), "map_stop": _YES("p % 6 = 1"), "map_yield": _YES("p % 9 = 1"), "map_stop_ahead": _YES("p % 8 = 1"),
    "hpms_stops": "CASE WHEN p % 3 = 0 THEN CAST(p % 2 AS INT) END", "map_stop_lines": "CAST(p % 3 AS INT)", "map_crosswalks": "CAST(p % 4 AS INT)", "poi_crossing": _YES("p % 5 = 2"), "lit": _CHOICE("p", "yes", "no", ""), "lights": "CAST(p % 4 AS INT)",
    "bridge": _CHOICE("p", "yes", "viaduct", "no", "", "", "", "", ""), "hpms_structure": "CASE WHEN p % 10 = 0 THEN CAST(p % 4 AS INT) END", "near_bridge": _YES("p % 6 = 0"), "near_school": _YES("p % 4 = 0"), "map_school": _YES("p % 7 = 2"),
    "school_pupils": "CAST(p * 29 % 1500 AS STRING)", "schools": "CAST(p % 6 AS STRING)", "bridge_condition": _CHOICE("p", "Poor", "Fair", "Good", "", "Unknown", "Serious"), "bridge_year": "CASE WHEN p % 12 = 0 THEN '' ELSE CAST(1900 + p % 120 AS STRING) END", "bridge_width": "CAST(p % 20 AS STRING)",
    "map_guard_rail": _YES("p % 10 = 0"), "hpms_curve": "CASE WHEN p % 3 = 0 THEN CAST(p % 4 AS STRING) ELSE '' END", "curvature": "1 + (p % 20) / 20.0E0", "map_turn": _YES("p % 11 = 0"), "map_winding": _YES("p % 19 = 0"), "s25": "CAST(p % 2 AS INT)", "s35": "CAST(p % 3 AS INT)", "s55": "CASE WHEN p % 5 = 0 THEN 1 ELSE 0 END",
    "highway": _CHOICE("p", "motorway", "primary", "residential", "footway", "tertiary_link", "service", "trunk", "secondary", "unclassified"), "hpms_fc": "CASE WHEN p % 2 = 0 THEN CAST(p % 8 AS INT) END", "sdot_fc": "CASE WHEN p % 3 = 0 THEN CAST(p * 3 % 8 AS INT) END", "hpms_median": "CAST(p % 6 AS INT)", "hpms_facility": "CASE WHEN p % 4 = 0 THEN NULL ELSE CAST(p * 5 % 8 AS INT) END",
}
_FC = "CASE fc_code " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _LABELS["fc_code"].items()) + " ELSE '' END"
INVENTORY_SQL = f"SELECT *, {_FC} AS fc FROM (SELECT " + ", ".join(f"{e} AS {n}" for n, e in _ROADS.items()) + " FROM (SELECT p_partkey AS p, CASE WHEN p_partkey % 10 = 1 THEN p_partkey - 1 ELSE p_partkey END AS q FROM part) keys) road_rows"
_IF = lambda cond, yes, no: f"CASE WHEN {cond} THEN {yes} ELSE {no} END"
#: An agency's export as it comes: texts, with missing, contradictory and misplaced values at stated keys.
_RAW = {
    "id": "id", "fips": _IF("id % 19 = 0", "NULL", "fips"), "route": _IF("id % 74 = 0", "''", "route"), "severity": "CASE WHEN id % 60 = 0 THEN '' WHEN id % 3 = 0 THEN 'O' ELSE severity END", **{f"{k}_people": f"{k}_people" for k in "kabc"},
    "collision": "CASE id % 40 WHEN 0 THEN 'Bicycle crossing' WHEN 1 THEN 'BIKE' WHEN 2 THEN 'Motorcycle overturned' WHEN 3 THEN 'Unknown' ELSE collision END",
    "weather": _IF("id % 33 = 0", "'n/a'", "weather"), "light": _IF("id % 34 = 0", "NULL", "light"), "surface": _IF("id % 21 = 0", "' '", "'1. Dry'"),
    "ped": _IF("id % 22 = 0", "'Yes'", "'No'"), "ped_killed": _IF("is_ped", "k_people", "0"), "ped_injured": _IF("is_ped", "a_people + b_people + c_people", "0"),
    "bike": _IF("id % 80 = 0", "'Yes'", "'No'"), "motorcycle": _IF("id % 17 = 0", "'Yes'", "'No'"),
    "hitrun": "CASE id % 12 WHEN 0 THEN 'Y' WHEN 1 THEN 'maybe' WHEN 2 THEN '' WHEN 3 THEN 'true' ELSE 'No' END", "speeding": "CASE id % 7 WHEN 0 THEN 'Yes' WHEN 1 THEN '1' ELSE 'No' END",
    **{k: _IF(f"is_{k}", "'Yes'", "'No'") for k in ("distracted", "drowsy", "guardrail", "animal", "lgtruck")},
    "crash_date": "CASE WHEN id % 101 = 0 THEN 'x/y/z' WHEN id % 102 = 0 THEN 'soon' WHEN id % 103 = 0 THEN concat('13/1/', CAST(year AS STRING)) ELSE concat(CAST(month(crash_date) AS STRING), '/', CAST(day(crash_date) AS STRING), '/', CAST(year AS STRING)) END",
    "crash_time": "CASE WHEN id % 45 = 0 THEN '1275' WHEN id % 46 = 0 THEN 'noon' WHEN id % 47 = 0 THEN '2500' ELSE CAST(hour * 100 + minute AS STRING) END", "crash_year": _IF("id % 6 = 0", "CAST(year - 1 AS STRING)", "CAST(year AS STRING)"),
    "lat": "CASE WHEN id % 9 = 0 THEN 0.0E0 WHEN id % 29 = 0 THEN NULL WHEN id % 31 = 0 THEN lat + 2.0E0 WHEN id % 37 = 0 THEN 39.4E0 + id % 7 * 0.013E0 ELSE lat END", "lon": "lon",
    "fc": "CASE WHEN id % 4 = 0 THEN '' WHEN id % 44 = 1 THEN 'Unknown' ELSE fc END",
    "facility": "CASE WHEN id % 5 = 0 OR fc_code = 0 THEN '' WHEN fc_code <= 2 OR own_code = 5 THEN '4-Two-Way Divided' WHEN own_code = 6 THEN '1-One-Way Undivided' ELSE '3-Two-Way Undivided' END",
    "description": "CASE id % 6 WHEN 0 THEN '1. Two-Way, Not Divided' WHEN 1 THEN '3. Two-Way, Divided, Positive Median Barrier' WHEN 2 THEN '4. One-Way' ELSE '' END",
    "system": "CASE id % 8 WHEN 0 THEN 'DOT Interstate' WHEN 1 THEN 'DOT Primary' WHEN 2 THEN 'Non-DOT secondary' WHEN 3 THEN 'Local' ELSE '' END",
}
RAW_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _RAW.items()) + f" FROM ({CRASHES_SQL}) crash_rows"
_LINE = lambda key, shift: f"38.8 + ({key} * 7919 % 6000) / 10000.0E0 + {key} % 5 * {shift}E0 + CASE WHEN {key} % 11 = 0 THEN 1.0E0 ELSE 0.0E0 END AS mid_lat, -75.7 + ({key} * 104729 % 4000) / 10000.0E0 AS mid_lon, CAST({key} % 8 AS INT) AS fc_code, CASE WHEN {key} % 4 = 0 THEN '' ELSE concat('SR ', CAST({key} % 70 AS STRING)) END AS route, CASE WHEN {key} % 3 = 0 THEN NULL ELSE CAST({key} * 41 % 9000 AS INT) END AS aadt"
#: Lines of the federal and the state's road layers: most near a segment's middle, some far from all.
FEDERAL_SQL = f"SELECT c_custkey AS line_id, {_LINE('c_custkey', 0.0003)} FROM customer"
STATE_LINES_SQL = f"SELECT s_suppkey AS line_id, {_LINE('(s_suppkey * 3)', 0.0005)} FROM supplier"
VIEWS = {"federal_lines": FEDERAL_SQL, "state_lines": STATE_LINES_SQL, "raw": RAW_SQL, "crashes": CRASHES_SQL, "persons": PERSONS_SQL, "vehicles": VEHICLES_SQL, "segments": SEGMENTS_SQL, "assets": ASSETS_SQL, "inventory": INVENTORY_SQL, "base_inventory": INVENTORY_SQL}
_TABLES = {"federal_lines": ("customer",), "state_lines": ("supplier",), "raw": ("orders", "customer", "nation"), "crashes": ("orders", "customer", "nation"), "persons": ("lineitem",), "vehicles": ("lineitem",), "segments": ("part",), "assets": ("supplier",), "inventory": ("part",)}


def with_views(sql: str, *names: str) -> str:
    """The statement with the named domain tables before it."""
    before = ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
    return f"WITH {before}, {sql[5:]}" if sql.startswith("WITH ") else f"WITH {before} {sql}"


def _bound(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    frames = {t: table(spark, sf_dir, t) for t in _TABLES[name]}
    for t in frames:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t} ", f"JOIN {{{t}}} ")
    return spark.sql(text, **frames)


def crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per crash with the standard columns; lookups join by size, fact rows are read once."""
    return _bound(spark, sf_dir, "crashes")


def raw_crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crashes as an agency exports them, with its mistakes."""
    return _bound(spark, sf_dir, "raw")


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bound(spark, sf_dir, "persons")


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bound(spark, sf_dir, "vehicles")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bound(spark, sf_dir, "segments")


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bound(spark, sf_dir, "assets")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per road segment with the standard columns and those of its sources.

    A file of many segments is small, but their columns and the rules on them are not: keys are dealt to tasks first.
    """
    keys = table(spark, sf_dir, "part").select("p_partkey")
    return spark.sql(VIEWS["inventory"].replace("FROM part)", "FROM {keys})"), keys=keys.repartition(keys.count() // SEGMENTS + 1))


def road_lines(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``federal_lines`` or ``state_lines``."""
    return _bound(spark, sf_dir, name)


def yes(c) -> Column:
    """Counts rows where a boolean holds, as long."""
    return F.count(F.when(c, 1))
