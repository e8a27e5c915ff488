"""Queries of the road inventory: rules, repairs, sources and risk, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.bindings import inventory, with_views
from kerbline.functions.text import OWNERS
from kerbline.operators import authority as au
from kerbline.operators import roads

QUERIES, SQL = {}, {}
#: The statements before the inventory is named, for jobs that chain the operators.
PLAIN: dict[str, str] = {}
STATE, PRIVATE = OWNERS["state"], OWNERS["private"]
# Statutory limits by class and area.
LAW = [(f, a, m) for f, (r, u) in {1: (65, 55), 2: (55, 45), 3: (50, 35), 4: (50, 35), 5: (50, 25), 6: (50, 25), 7: (25, 25)}.items() for a, m in (("Rural", r), ("Urban", u))]
MEMBERS = {"Dover/Kent MPO": ["001"], "WILMAPCO": ["003", "005"]}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            PLAIN[name], SQL[name] = sql, with_views(sql, "inventory")
        return f

    return keep


def _steps(start: str, steps: list[tuple[str, str, dict[str, str]]]) -> str:
    """SQL that applies (name, condition, new values) one after the other and keeps the names in ``rules``."""
    for name, cond, new in steps:
        values = "".join(f", CASE WHEN {cond} THEN {v} ELSE {c} END AS {c}" for c, v in new.items())
        start = f"SELECT * REPLACE (CASE WHEN {cond} THEN list_append(rules, '{name}') ELSE rules END AS rules{values}) FROM ({start})"
    return start


_CASE = lambda k, values: f"CASE {k} " + " ".join(f"WHEN {x} THEN {v!r}" for x, v in values.items()) + " END"
_SPD, _LANES, _FT = "coalesce(TRY_CAST(speed AS DOUBLE), 0)", "coalesce(TRY_CAST(lanes AS DOUBLE), 0)", "coalesce(TRY_CAST(school_ft AS DOUBLE), 0)"
_LOW, _HIGH = (_CASE("k", {f: v[n] for f, v in roads.SPEED_RANGE.items()}) for n in (0, 1))
_LEN = "sqrt(pow((v_lon - u_lon) * cos(radians(u_lat)), 2) + pow(v_lat - u_lat, 2)) * 111320.0E0 * 3.28084E0"
_RULES = _steps(
    f"SELECT i.*, fc_code AS k, fc AS came, coalesce(m, 25) AS law, CAST([] AS VARCHAR[]) AS rules FROM inventory i LEFT JOIN (VALUES {', '.join(str(x) for x in LAW)}) t(f, a, m) ON fc_code = f AND a = CASE area WHEN 'Suburban' THEN CASE WHEN fc_code <= 3 THEN 'Rural' ELSE 'Urban' END ELSE area END",
    [
        ("SPD_FIX", f"{_SPD} > 0 AND ({_SPD} < {_LOW} OR {_SPD} > {_HIGH})", {"speed": "CAST(law AS VARCHAR)"}),
        ("SPD_LANE", f"{_LANES} >= 4 AND {_SPD} > 0 AND {_SPD} < 25", {"speed": "'25'"}),
        ("SPD_FILL", f"came <> '' AND {_SPD} <= 0", {"speed": "CAST(law AS VARCHAR)"}),
        ("SURF_FILL", "k > 0 AND surface IN ('', 'nan', 'None')", {"surface": f"CASE k WHEN 1 THEN '{roads.CONCRETE}' ELSE '{roads.ASPHALT}' END"}),
        ("OWN_FIX", "k IN (1, 2) AND ownership <> '' AND NOT contains(ownership, 'State')", {"ownership": f"'{STATE}'"}),
        ("OWN_FC7", "k = 7 AND contains(ownership, 'State')", {}),
        ("SYS_FIX", f"k > 0 AND system <> '' AND system <> {_CASE('k', roads.SYSTEM)}", {"system": _CASE("k", roads.SYSTEM)}),
        ("FAC_FILL", "k > 0 AND facility IN ('', 'nan', 'None')", {"facility": "CASE WHEN k <= 2 THEN '4-Two-Way Divided' ELSE '3-Two-Way Undivided' END"}),
        ("FAC_OW_FIX", "oneway IN ('yes', 'true', '1', '-1') AND contains(facility, 'Two-Way')", {"facility": "'1-One-Way Undivided'"}),
        ("FAC_TW_FIX", "oneway NOT IN ('yes', 'true', '1', '-1') AND contains(facility, 'One-Way')", {"facility": "CASE WHEN k IN (1, 2) THEN '4-Two-Way Divided' WHEN k > 2 THEN '3-Two-Way Undivided' ELSE facility END"}),
        ("DESC_FILL", "came <> '' AND description IN ('', 'nan', 'None') AND facility <> ''", {"description": "CASE WHEN contains(facility, 'One-Way') THEN '4. One-Way, Not Divided' WHEN facility LIKE '3%' THEN '1. Two-Way, Not Divided' ELSE '2. Two-Way, Divided, Unprotected Median' END"}),
        ("CTRL_STOP", "contains(control, 'Stop Sign') AND k IN (1, 2)", {"control": "'1. No Traffic Control'"}),
        ("CTRL_SIG", "contains(control, 'Signal') AND k = 7 AND is_intersection <> 'Yes'", {"control": "'1. No Traffic Control'"}),
        ("LANE_FC", f"k IN (1, 2) AND {_LANES} > 0 AND {_LANES} < 2", {"lanes": "'2'"}),
        ("RTE_INT", r"regexp_matches(route, '^I[-\s]?\d') AND came <> '' AND k <> 1", {"fc": "'1-Interstate (A,1)'", "system": "'DOT Interstate'", "ownership": f"'{STATE}'"}),
        ("RTE_US", r"regexp_matches(route, '^US[-\s]?\d') AND k = 7", {"fc": "'3-Principal Arterial - Other (E,2)'", "system": "'DOT Primary'", "ownership": f"'{STATE}'"}),
        ("SCHZ_FAR", f"contains(school_zone, 'Yes') AND ({_FT} = 0 OR {_FT} > 2000)", {"school_zone": "'3. No'"}),
        ("SCHZ_NEAR", f"NOT contains(school_zone, 'Yes') AND {_FT} > 0 AND {_FT} <= 500", {"school_zone": "'1. Yes'"}),
        ("GEOM_ZERO", f"{_LEN} < 1", {}), ("GEOM_LONG", f"{_LEN} > 10000", {}),
        ("AADT_I_LO", "k = 1 AND aadt > 0 AND aadt < 500", {}),
    ],
)
_RULED = ("seg_id", "speed", "surface", "ownership", "system", "facility", "description", "control", "lanes", "fc", "school_zone")


def _checked(spark, d):
    return roads.road_rules(inventory(spark, d), spark.createDataFrame(LAW, "fc_code int, area string, limit int"))


@query("road_rules_12", f"SELECT {', '.join(_RULED)}, array_to_string(rules, ',') AS rules FROM ({_RULES})")
def _rules(spark, d):
    return _checked(spark, d).select(*_RULED, F.array_join("rules", ",").alias("rules"))


@query("road_rule_report", f"SELECT rule, count(*) AS n, round(count(*) * 100.0E0 / any_value(total), 1) AS pct FROM (SELECT unnest(rules) AS rule, (SELECT count(*) FROM inventory) AS total FROM ({_RULES})) GROUP BY rule")
def _report(spark, d):
    return roads.rule_report(_checked(spark, d))


# Repairs ----------------------------------------------------------------------------------------------------

_OWN = " ".join(f"WHEN hpms_ownership IN ({', '.join(map(str, codes))}) THEN '{OWNERS[who]}'" for who, codes in roads.OWNER_CODES.items())
_FIRST = "trim(regexp_split_to_array(ref, '[;,]')[1])"
_NOW = "CASE WHEN coalesce(TRY_CAST(hpms_speed AS INT), 0) > 0 THEN CAST(hpms_speed AS INT) ELSE coalesce(TRY_CAST(speed AS INT), 0) END"
_FIXED = f"""SELECT *, row_number() OVER (PARTITION BY u_lat, u_lon, v_lat, v_lon, name, road_source ORDER BY seg_id) AS dup FROM (SELECT seg_id, name, ref, fc, fc_code AS k, u_lat, u_lon, v_lat, v_lon, road_source, county,
 CASE WHEN ownership = '' OR ownership IN ({', '.join(repr(x) for x in OWNERS.values())}) THEN ownership ELSE coalesce(CASE {_OWN} END, {_CASE('fc_code', {k: OWNERS[w] for k, w in roads.OWNER_OF_CLASS.items()})}, '{PRIVATE}') END AS ownership,
 CASE WHEN is_intersection <> 'Yes' THEN '1. Not at Intersection' WHEN streets >= 5 OR (streets IS NULL AND degree >= 10) THEN '5. Five-Point, or More' WHEN streets = 4 OR (streets IS NULL AND degree >= 8) THEN '4. Four Approaches' WHEN streets = 3 OR (streets IS NULL AND degree >= 6) THEN '3. Three Approaches' ELSE '1. Not at Intersection' END AS intersection,
 CASE WHEN is_ramp = 'Yes' THEN '10. On/Off Ramp' ELSE CASE WHEN curve_class <= 1 THEN CASE WHEN grade THEN '3. Grade - Straight' ELSE '1. Straight - Level' END ELSE CASE WHEN grade THEN '4. Grade - Curve' ELSE '2. Curve - Level' END END END AS alignment,
 CASE WHEN osm_surface = '' AND hpms_surface IS NULL AND surface IN ('3. Brick or Block', '6. Other', '1. Concrete', 'Not Applicable', '') THEN '{roads.ASPHALT}' ELSE surface END AS surface,
 CASE WHEN lower(school_zone) IN ('no', '0') THEN '3. No' WHEN lower(school_zone) IN ('yes', '1') THEN '1. Yes' ELSE school_zone END AS school_zone,
 CASE WHEN hpms_route <> '' THEN hpms_route WHEN regexp_matches({_FIRST}, '(?i)^(I|US|SR|CR|RD|DE)[-\\s]?\\d') THEN {_FIRST} WHEN regexp_matches({_FIRST}, '^\\d+[A-Za-z]?$') THEN 'CR ' || {_FIRST} ELSE '' END AS route,
 CASE WHEN match_ft >= 0 THEN match_ft END AS match_ft, greatest(u_node, 0) AS u_node,
 CAST(CASE WHEN {_NOW} > 0 THEN CASE WHEN fc_code = 0 THEN {_NOW} ELSE greatest({_LOW.replace('CASE k', 'CASE fc_code')}, least({_HIGH.replace('CASE k', 'CASE fc_code')}, {_NOW})) END ELSE coalesce({_CASE('fc_code', roads.USUAL_SPEED)}, 0) END AS INT) AS speed,
 CASE WHEN planning IN ('Dover/Kent MPO', 'WILMAPCO') AND planning <> district AND district <> '' THEN district ELSE planning END AS planning,
 CASE WHEN mpo = 'Dover / Kent MPO' AND county NOT IN ('', '001') OR mpo = 'WILMAPCO' AND county NOT IN ('', '003', '005') THEN '' ELSE mpo END AS mpo,
 coalesce(CASE WHEN TRY_CAST(lanes AS INT) > 0 THEN CAST(lanes AS INT) END, {_CASE('fc_code', roads.LEAST_LANES)}) AS lanes, coalesce(aadt, 0) AS aadt FROM (SELECT *, coalesce(grade_class, '') NOT IN ('', '0') OR terrain >= 2 AS grade FROM inventory))"""
_MED = lambda keys, value, whole: f"SELECT {keys}, CAST({'round' if whole else 'floor'}(quantile_cont({value}, 0.5)) AS INT) AS m FROM src WHERE {value} > 0 AND " + " AND ".join(f"{k} <> ''" for k in keys.split(", ")) + " GROUP BY ALL"
_REPAIRED = f"""WITH base AS ({_FIXED}),
 l AS (SELECT b.* REPLACE (coalesce(b.lanes, CASE WHEN g.m > 0 THEN g.m END) AS lanes) FROM base b LEFT JOIN ({_MED('ref, fc', 'lanes', False).replace('FROM src', 'FROM base')}) g ON b.ref = g.ref AND b.fc = g.fc),
 r AS (SELECT l.* REPLACE (CASE WHEN l.aadt = 0 AND g.m > 0 THEN g.m ELSE l.aadt END AS aadt), CASE WHEN l.aadt > 0 THEN 'direct' WHEN g.m > 0 THEN 'ref_propagation' ELSE '' END AS aadt_source FROM l LEFT JOIN ({_MED('ref, fc', 'aadt', True).replace('FROM src', 'FROM l')}) g ON l.ref = g.ref AND l.fc = g.fc),
 n AS (SELECT r.* REPLACE (CASE WHEN r.aadt = 0 AND g.m > 0 THEN g.m ELSE r.aadt END AS aadt, CASE WHEN r.aadt = 0 AND g.m > 0 THEN 'name_propagation' ELSE r.aadt_source END AS aadt_source) FROM r LEFT JOIN ({_MED('name, fc', 'aadt', True).replace('FROM src', 'FROM r')}) g ON r.name = g.name AND r.fc = g.fc),
 c AS (SELECT k, CAST(floor(quantile_cont(aadt, 0.5)) AS INT) AS m FROM n WHERE aadt > 0 AND k BETWEEN 1 AND 6 GROUP BY k),
 a AS (SELECT n.* REPLACE (CASE WHEN n.aadt = 0 AND c.m > 0 THEN c.m ELSE n.aadt END AS aadt, CASE WHEN n.aadt = 0 AND c.m > 0 THEN 'fc_median' ELSE n.aadt_source END AS aadt_source) FROM n LEFT JOIN c ON n.k = c.k)
 SELECT seg_id, ownership, intersection, alignment, surface, school_zone, route, match_ft, u_node, speed, planning, mpo, CAST(lanes AS INT) AS lanes, CAST(aadt AS INT) AS aadt, aadt_source FROM a WHERE dup = 1"""


@query("road_fixes_13", _REPAIRED)
def _fixes(spark, d):
    fixed = roads.postprocess(inventory(spark, d), "DE", MEMBERS, F.when(F.col("hpms_speed").try_cast("int") > 0, F.col("hpms_speed").try_cast("int")))
    return fixed.select("seg_id", "ownership", "intersection", "alignment", "surface", "school_zone", "route", "match_ft", "u_node", "speed", "planning", "mpo", "lanes", "aadt", "aadt_source")


# Sources ----------------------------------------------------------------------------------------------------


def _resolved(name: str, sql_value: list[tuple[str, str]], fallback: str, make):
    """sql_value: (source, SQL value or null) from the highest authority down."""
    value = f"coalesce({', '.join(v for _, v in sql_value)}, {fallback})"
    source = "CASE " + " ".join(f"WHEN {v} IS NOT NULL THEN '{s}'" for s, v in sql_value) + " ELSE '' END"

    @query(name, f"SELECT seg_id, {value} AS value, {source} AS source FROM inventory")
    def _q(spark, d):
        return inventory(spark, d).select("seg_id", *[c.alias(k) for k, c in make().items()])


_mph = lambda c: f"CASE WHEN TRY_CAST({c} AS DOUBLE) >= 5 AND TRY_CAST({c} AS DOUBLE) < 86 THEN CAST(floor(CAST({c} AS DOUBLE)) AS INT) END"
_ln = lambda c: f"CASE WHEN TRY_CAST(split_part(CAST({c} AS VARCHAR), ';', 1) AS DOUBLE) BETWEEN 1 AND 12 THEN CAST(floor(CAST(split_part(CAST({c} AS VARCHAR), ';', 1) AS DOUBLE)) AS INT) END"
_yes = lambda cond: f"CASE WHEN {cond} THEN 'Yes' END"
_c = F.col
_resolved("resolve_speed_limit", [("StateDOT", _mph("sdot_speed")), ("HPMS", _mph("hpms_speed")), ("Mapillary", _mph("map_speed")), ("OSM", _mph("maxspeed")), ("Statutory", "CASE WHEN fc_code = 7 THEN CASE WHEN mpo <> '' THEN 25 ELSE 50 END WHEN fc_code IN (5, 6) THEN 35 END")], "NULL", lambda: au.resolve_speed(_c("sdot_speed"), _c("hpms_speed"), _c("map_speed"), _c("maxspeed"), _c("fc_code") == 7, _c("mpo") != "", _c("fc_code").isin(5, 6)))
_resolved("resolve_lanes", [("StateDOT", _ln("sdot_lanes")), ("HPMS", _ln("hpms_lanes")), ("OSM", _ln("osm_lanes"))], "0", lambda: roads.resolve_lanes(_c("sdot_lanes"), _c("hpms_lanes"), _c("osm_lanes")))
_resolved("resolve_surface", [("StateDOT", f"CASE WHEN sdot_surface IN ('{roads.CONCRETE}', '{roads.ASPHALT}', '3. Brick or Block') THEN 'Paved' WHEN sdot_surface IN ('4. Slag, Gravel, Stone', '5. Dirt') THEN 'Unpaved' END"), ("HPMS", "CASE WHEN hpms_surface BETWEEN 1 AND 3 THEN 'Paved' WHEN hpms_surface IN (4, 5) THEN 'Unpaved' END"), ("OSM", "CASE WHEN trim(lower(osm_surface)) IN ('asphalt', 'sett') THEN 'Paved' WHEN trim(lower(osm_surface)) IN ('gravel', 'mud') THEN 'Unpaved' END")], "''", lambda: roads.resolve_surface(_c("sdot_surface"), _c("hpms_surface"), _c("osm_surface")))
_resolved("resolve_signals", [("Mapillary", _yes("map_signal = 'Yes'")), ("POI", _yes("poi_signal = 'Yes'")), ("HPMS", _yes("hpms_signal > 0"))], "'No'", lambda: roads.resolve_signals(_c("map_signal"), _c("poi_signal"), _c("hpms_signal")))
_resolved("resolve_lighting", [("Mapillary", _yes("lights > 0")), ("OSM", _yes("lit = 'yes'"))], "'No'", lambda: roads.resolve_lighting(_c("lights"), _c("lit")))
_resolved("resolve_bridge", [("HPMS", _yes("hpms_structure > 0")), ("OSM", _yes("bridge IN ('yes', 'viaduct')")), ("Federal", _yes("near_bridge = 'Yes'"))], "'No'", lambda: roads.resolve_bridge(_c("hpms_structure"), _c("bridge"), _c("near_bridge")))
_resolved("resolve_school_zone", [("Mapillary", _yes("map_school = 'Yes'")), ("Federal", _yes("near_school = 'Yes'"))], "'No'", lambda: roads.resolve_school_zone(_c("map_school"), _c("near_school")))

_HW = _CASE("highway", {f"'{k}'": v for k, v in roads.HIGHWAY_CLASS.items()})
_WORD = lambda c, junk="": f"CASE WHEN {c} NOT IN ('', 'nan'{junk}) AND NOT regexp_matches({c}, '^-?\\d+$') THEN {c} END"
_STD = f"""SELECT seg_id, coalesce({_CASE('code', roads.CLASSES)}, '') AS fc, fc_source, coalesce({_CASE('code', roads.SYSTEM)}, '') AS system,
 coalesce(CASE {_OWN} END, CASE WHEN sdot_ownership IN ({', '.join(repr(x) for x in OWNERS.values())}) THEN sdot_ownership END, {_CASE('code', {k: OWNERS[w] for k, w in roads.OWNER_OF_CLASS.items()})}, '') AS ownership,
 CASE WHEN CASE {_OWN} END IS NOT NULL THEN 'HPMS' WHEN sdot_ownership IN ({', '.join(repr(x) for x in OWNERS.values())}) THEN 'StateDOT' ELSE fc_source END AS ownership_source,
 coalesce({_CASE('hpms_median', roads.MEDIANS)}, '') AS description,
 coalesce(CASE WHEN sdot_route NOT IN ('', 'nan', '0') THEN sdot_route END, {_WORD('hpms_route', ", '0'")}, {_WORD('ref')}, {_WORD('name')}, '') AS route,
 CASE WHEN mpo <> '' THEN 'Urban' ELSE 'Rural' END AS area_type,
 CASE WHEN map_signal = 'Yes' OR poi_signal = 'Yes' OR coalesce(hpms_signal, 0) > 0 THEN '3. Traffic Signal' WHEN map_stop = 'Yes' OR poi_stop = 'Yes' THEN '4. Stop Sign' WHEN map_yield = 'Yes' THEN '8. Yield Sign' ELSE '' END AS control,
 CASE WHEN is_intersection = 'Yes' AND streets IS NOT NULL THEN CASE WHEN streets >= 5 THEN '5. Five-Point, or More' WHEN streets = 4 THEN '4. Four Approaches' WHEN streets = 3 THEN '3. Three Approaches' ELSE '1. Not at Intersection' END WHEN is_intersection = 'Yes' THEN CASE WHEN degree >= 10 THEN '5. Five-Point, or More' WHEN degree >= 8 THEN '4. Four Approaches' WHEN degree >= 6 THEN '3. Three Approaches' ELSE '1. Not at Intersection' END ELSE '1. Not at Intersection' END AS intersection,
 coalesce({_CASE('hpms_facility', roads.FACILITIES)}, '') AS facility, CASE WHEN hpms_facility > 0 THEN 'HPMS' ELSE '' END AS facility_source, coalesce({_CASE('hpms_surface', roads.SURFACES)}, '') AS surface, coalesce({_CASE('curve_class', roads.ALIGNMENTS)}, '') AS alignment, CASE WHEN map_school = 'Yes' OR near_school = 'Yes' THEN 'Yes' ELSE 'No' END AS school_zone,
 coalesce({_mph('sdot_speed')}, {_mph('hpms_speed')}, {_mph('map_speed')}, {_mph('maxspeed')}, CASE WHEN code = 7 THEN CASE WHEN mpo <> '' THEN 25 ELSE 50 END WHEN code IN (5, 6) THEN 35 END) AS speed, coalesce({_ln('sdot_lanes')}, {_ln('hpms_lanes')}, {_ln('osm_lanes')}, 0) AS lanes
 FROM (SELECT *, CASE WHEN coalesce(hpms_fc, 0) > 0 THEN hpms_fc WHEN coalesce(sdot_fc, 0) > 0 THEN sdot_fc ELSE coalesce({_HW}, 0) END AS code, CASE WHEN coalesce(hpms_fc, 0) > 0 THEN 'HPMS' WHEN coalesce(sdot_fc, 0) > 0 THEN 'StateDOT' WHEN {_HW} IS NOT NULL THEN 'OSM' ELSE '' END AS fc_source FROM inventory)"""


@query("merge_standard_columns", _STD)
def _standard(spark, d):
    return roads.standard_columns(inventory(spark, d))


_N = lambda *conds: " + ".join(f"(CASE WHEN {c} THEN 1 ELSE 0 END)" for c in conds)
_XW, _ST = _N("poi_crossing = 'Yes'", "map_crosswalks > 0"), _N("poi_stop = 'Yes'", "map_stop = 'Yes'")
_COUNTS = {
    "signal": (_N("hpms_signal > 0", "poi_signal = 'Yes'", "map_signal = 'Yes'"), (50, 75, 90)),
    "crosswalk": (f"{_XW} + {_N(f'map_stop_lines > 0 AND {_XW} > 0')}", (50, 75, 90)),
    "stop_sign": (f"{_ST} + " + _N(f"map_stop_ahead = 'Yes' AND {_ST} > 0", "hpms_stops > 0"), (50, 75, 90)),
    "school_zone": (_N("near_school = 'Yes'", "map_school = 'Yes'"), (50, 90, 90)),
    "speed": (_N("TRY_CAST(sdot_speed AS DOUBLE) BETWEEN 5 AND 85", "TRY_CAST(hpms_speed AS DOUBLE) BETWEEN 5 AND 85", "map_speed <> ''", "maxspeed <> ''"), (50, 80, 95)),
    "bridge": (_N("bridge IN ('yes', 'viaduct')", "near_bridge = 'Yes'"), (50, 90, 90)),
}
_INNER = ", ".join(f"CAST({n} AS INT) AS {k}_sources" for k, (n, _) in _COUNTS.items())
_OUTER = ", ".join(f"CASE WHEN {k}_sources >= 3 THEN {s[2]} WHEN {k}_sources = 2 THEN {s[1]} WHEN {k}_sources = 1 THEN {s[0]} ELSE 0 END AS {k}_confidence" for k, (_, s) in _COUNTS.items())


@query("confidence_scores", f"SELECT *, {_OUTER} FROM (SELECT seg_id, {_INNER} FROM inventory)")
def _confidence(spark, d):
    return roads.agreement_scores(inventory(spark, d))


_SIGNS = _N("map_guard_rail = 'Yes'", "TRY_CAST(hpms_curve AS DOUBLE) > 0", "TRY_CAST(grade_class AS DOUBLE) > 0", "curvature > 1.5", "map_turn = 'Yes'", "map_winding = 'Yes'")
_MPH = "[x for x in [CASE WHEN s25 > 0 THEN 25 END, CASE WHEN s35 > 0 THEN 35 END, CASE WHEN s55 > 0 THEN 55 END] if x IS NOT NULL]"
_SCHOOL = "CASE WHEN ft <= 500 THEN 40 WHEN ft <= 1000 THEN 25 WHEN ft <= 1500 THEN 15 ELSE 0 END + CASE WHEN pupils > 1000 THEN 30 WHEN pupils > 500 THEN 20 WHEN pupils > 0 THEN 10 ELSE 0 END + CASE WHEN map_school = 'Yes' THEN 20 ELSE 0 END + least(greatest(many - 1, 0) * 10, 30)"
_BRIDGE = "CASE lower(bridge_condition) WHEN 'poor' THEN 60 WHEN 'fair' THEN 30 WHEN 'good' THEN 10 WHEN 'unknown' THEN 20 WHEN '' THEN 20 ELSE 15 END + CASE WHEN built > 0 AND built < 1940 THEN 30 WHEN built >= 1990 THEN 5 WHEN built >= 1960 THEN 10 WHEN built >= 1940 THEN 20 ELSE 15 END + CASE WHEN width > 0 AND width < 8 THEN 10 ELSE 0 END"
_RISK = f"""SELECT seg_id, CASE WHEN len(mph) >= 2 THEN 'Yes' ELSE 'No' END AS speed_transition, CAST(CASE WHEN len(mph) >= 2 THEN list_max(mph) - list_min(mph) ELSE 0 END AS INT) AS speed_transition_diff,
 CASE WHEN (map_crosswalks > 0 OR poi_crossing = 'Yes') AND NOT (map_signal = 'Yes' OR poi_signal = 'Yes' OR coalesce(hpms_signal, 0) > 0) THEN 'Yes' ELSE 'No' END AS unsignalized_crosswalk,
 CAST(CASE WHEN near_school = 'Yes' THEN least({_SCHOOL}, 100) ELSE 0 END AS INT) AS school_exposure, CAST(CASE WHEN near_bridge = 'Yes' THEN least({_BRIDGE}, 100) ELSE 0 END AS INT) AS bridge_risk,
 CASE WHEN signs > 0 THEN 'Yes' ELSE 'No' END AS departure_curve, CAST(least(least(signs * 25, 75) + CASE WHEN signs > 0 AND TRY_CAST(hpms_speed AS DOUBLE) > 45 AND TRY_CAST(hpms_speed AS DOUBLE) <= 85 THEN 25 ELSE 0 END, 100) AS INT) AS departure_score
 FROM (SELECT *, {_SIGNS} AS signs, {_MPH} AS mph, coalesce(TRY_CAST(school_ft AS DOUBLE), 9999) AS ft, coalesce(TRY_CAST(school_pupils AS DOUBLE), 0) AS pupils, coalesce(TRY_CAST(schools AS DOUBLE), 0) AS many, coalesce(TRY_CAST(bridge_year AS DOUBLE), 0) AS built, coalesce(TRY_CAST(bridge_width AS DOUBLE), 0) AS width FROM inventory)"""


@query("risk_indicators", _RISK)
def _risk(spark, d):
    return roads.risk_indicators(inventory(spark, d), {25: F.col("s25"), 35: F.col("s35"), 55: F.col("s55")})
