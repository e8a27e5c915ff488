"""Queries of scalar functions, cleaning, splits and set operations, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.bindings import crashes, segments, table, with_views
from kerbline.functions import tags as tag_words
from kerbline.functions import geo, severity, text
from kerbline.operators import clean

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None, *views: str):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = with_views(sql, *views) if views else sql
        return f

    return keep


@query("map_severity_kabco", "SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'K' WHEN o_orderpriority = '2-HIGH' THEN 'A' ELSE 'O' END AS severity FROM orders")
def _map_sev(spark, d):
    raw = F.when(F.col("o_orderpriority") == "1-URGENT", "Fatal Crash").when(F.col("o_orderpriority") == "2-HIGH", "personal injury").otherwise("Property damage only")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), severity.map_severity(raw).alias("severity"))


@query("severity_from_counts", "SELECT id, CASE WHEN k_people > 0 THEN 'K' WHEN a_people > 0 THEN 'A' WHEN b_people > 0 THEN 'B' WHEN c_people > 0 THEN 'C' ELSE 'O' END AS severity FROM crashes", "crashes")
def _sev_counts(spark, d):
    return crashes(spark, d).select("id", severity.severity_from_counts(*[F.col(f"{k}_people") for k in "kabc"]).alias("severity"))


@query("parse_datetime_multi", "SELECT o_orderkey AS id, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 HOUR * (o_orderkey % 24) AS ts, strftime(CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 HOUR * (o_orderkey % 24), '%H%M') AS military FROM orders")
def _dates(spark, d):
    ts = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    k = F.col("o_orderkey") % 5
    written = F.when(k == 0, F.date_format(ts, "yyyy MMM dd hh:mm:ss a")).when(k == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).when(k == 2, F.date_format(ts, "MM/dd/yyyy HH:mm")).when(k == 3, F.unix_millis(ts.cast("timestamp")).cast("string")).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), written.alias("w")).withColumn("ts", text.parse_datetime(F.col("w")))
    return rows.select("id", F.col("ts").cast("timestamp_ntz").alias("ts"), text.military_time(F.col("ts")).alias("military"))


@query("extract_year_text", "SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INT) AS year FROM orders")
def _year(spark, d):
    k, dt = F.col("o_orderkey") % 3, F.col("o_orderdate")
    written = F.when(k == 0, F.date_format(dt, "M/d/yyyy")).when(k == 1, F.date_format(dt, "yyyy-MM-dd")).otherwise(F.date_format(dt, "yyyy MMM dd"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), text.extract_year(written).alias("year"))


@query("slugify_name", "SELECT p_partkey AS id, regexp_replace(lower(p_name), ' ', '_', 'g') AS slug FROM part")
def _slug(spark, d):
    odd = F.concat(F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0"), F.lit(". "), F.replace("p_name", F.lit(" "), F.lit(" - ")), F.lit("'."))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), text.slug(odd).alias("slug"))


_NAMES = "CASE n_nationkey % 5 WHEN 0 THEN concat(n_name, ' County') WHEN 1 THEN concat('City of ', n_name) WHEN 2 THEN concat('Town of ', n_name) WHEN 3 THEN concat(n_name, ' village') ELSE n_name END"


def _names(spark, d):
    return spark.sql(f"SELECT n_nationkey AS id, {_NAMES} AS name FROM {{nation}}", nation=table(spark, d, "nation"))


@query("strip_juris_prefix", "SELECT n_nationkey AS id, n_name AS name FROM nation")
def _strip(spark, d):
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), text.strip_juris_prefix(F.concat(F.lit(" 017. "), "n_name")).alias("name"))


@query("classify_juris_name", "SELECT n_nationkey AS id, CASE n_nationkey % 5 WHEN 0 THEN 'county' WHEN 1 THEN 'city' WHEN 2 THEN 'city' ELSE 'unknown' END AS kind FROM nation")
def _classify(spark, d):
    return _names(spark, d).select("id", text.classify_juris(F.concat(F.lit("003. "), "name")).alias("kind"))


@query("juris_type", "SELECT n_nationkey AS id, CASE WHEN n_nationkey % 7 = 0 THEN 'county' WHEN n_nationkey % 7 = 1 THEN 'town' ELSE CASE n_nationkey % 5 WHEN 0 THEN 'county' WHEN 1 THEN 'city' WHEN 2 THEN 'town' WHEN 3 THEN 'village' ELSE 'unknown' END END AS kind FROM nation")
def _juris_type(spark, d):
    k = F.col("id") % 7
    return _names(spark, d).select("id", text.juris_type(F.col("name"), F.when(k == 0, "06").otherwise("99"), F.when(k == 1, "Township").otherwise("")).alias("kind"))


@query("derive_ownership", """SELECT id, CASE WHEN own_code = 1 THEN '1. State Hwy Agency' WHEN own_code = 2 THEN '2. County Hwy Agency' WHEN own_code = 5 THEN '5. Toll Roads Maintained by Others'
WHEN fc_code IN (1, 2, 3, 5) AND NOT (fc_code = 5 AND area_code = 0) THEN '1. State Hwy Agency' WHEN fc_code = 5 THEN '3. City or Town Hwy Agency' WHEN fc_code = 4 AND area_code = 0 THEN '3. City or Town Hwy Agency' WHEN fc_code = 4 THEN '1. State Hwy Agency'
WHEN area_code = 0 THEN '3. City or Town Hwy Agency' WHEN area_code = 1 THEN '2. County Hwy Agency' ELSE '1. State Hwy Agency' END AS owner FROM crashes""", "crashes")
def _owner(spark, d):
    kind = F.when(F.col("area_code") == 0, "city").when(F.col("area_code") == 1, "county").otherwise("unknown")
    hint = F.when(F.col("own_code") == 1, "State DOT").when(F.col("own_code") == 2, "county roads").when(F.col("own_code") == 5, "Turnpike").otherwise("")
    return crashes(spark, d).select("id", text.derive_ownership(kind, F.lit(""), F.col("fc"), F.lit(""), hint).alias("owner"))


@query("parse_maxspeed_mph", "SELECT p_partkey AS id, CAST(CASE p_partkey % 3 WHEN 0 THEN p_size WHEN 1 THEN round(p_size * 0.621371) ELSE round((p_size + 120) * 0.621371) END AS INT) AS mph FROM part")
def _maxspeed(spark, d):
    k = F.col("p_partkey") % 3
    tag = F.when(k == 0, F.concat(F.col("p_size").cast("string"), F.lit(" mph;60"))).when(k == 1, F.concat(F.col("p_size").cast("string"), F.lit(" km/h"))).otherwise((F.col("p_size") + 120).cast("string"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), text.parse_maxspeed(tag).alias("mph"))


@query("format_juris_name", "SELECT n_nationkey AS id, concat(lpad(CAST(n_nationkey AS VARCHAR), 3, '0'), '. ', CASE n_nationkey % 3 WHEN 0 THEN concat(n_name, ' County') WHEN 1 THEN concat('City of ', n_name) ELSE concat('Town of ', n_name) END) AS name FROM nation")
def _format(spark, d):
    k = F.col("n_nationkey") % 3
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), text.format_juris(F.col("n_name"), F.col("n_nationkey"), F.when(k == 0, "county").when(k == 1, "city").otherwise("town")).alias("name"))


_HASHED = "md5(concat_ws('|', CAST(crash_date AS VARCHAR), CAST(hour AS VARCHAR), collision, severity, coalesce(nullif(node, ''), '')))"


@query("content_hash_md5", f"SELECT id, {_HASHED} AS hash FROM crashes", "crashes")
def _hash(spark, d):
    return crashes(spark, d).select("id", text.content_hash(*[F.col(c) for c in ("crash_date", "hour", "collision", "severity")], F.nullif("node", F.lit(""))).alias("hash"))


@query("row_hash_sha256_16", "SELECT id, substr(sha256(concat_ws('|', CAST(id AS VARCHAR), juris, severity)), 1, 16) AS hash FROM crashes", "crashes")
def _row_hash(spark, d):
    return crashes(spark, d).select("id", text.row_hash(F.col("id"), F.col("juris"), F.col("severity")).alias("hash"))


@query("location_key", "SELECT concat_ws('|', route, node, juris) AS key, count(*) AS n FROM crashes GROUP BY 1", "crashes")
def _loc(spark, d):
    return crashes(spark, d).groupBy(text.location_key(F.col("route"), F.col("node"), F.col("juris")).alias("key")).agg(F.count("*").alias("n"))


@query("flags_from_text", "SELECT " + ", ".join(f"count(*) FILTER (WHERE regexp_matches(lower(coalesce(text, '')), '{'|'.join(w)}')) AS {k}" for k, w in text.FLAG_WORDS.items()) + ", count(*) AS n FROM documents")
def _flags(spark, d):
    return table(spark, d, "documents").agg(*[F.count(F.when(c, 1)).alias(k) for k, c in text.flags_from_text(F.col("text")).items()], F.count("*").alias("n"))


@query("fc_from_route_prefix", "SELECT seg_id, CASE seg_id % 4 WHEN 0 THEN '1-Interstate (A,1)' WHEN 1 THEN '3-Principal Arterial - Other (E,2)' WHEN 2 THEN '6-Minor Collector (5)' END AS fc FROM segments", "segments")
def _fc_route(spark, d):
    k = F.col("seg_id") % 4
    r = F.when(k == 0, "I-95").when(k == 1, "US 13").when(k == 2, "CR-7").otherwise("Main St")
    return segments(spark, d).select("seg_id", text.fc_from_route(r).alias("fc"))


@query("parse_route_name_by_state", "SELECT seg_id, CASE seg_id % 3 WHEN 0 THEN concat('US ', CAST(seg_id % 97 + 1 AS VARCHAR)) WHEN 1 THEN concat('I ', CAST(seg_id % 97 + 1 AS VARCHAR)) ELSE name END AS route FROM segments", "segments")
def _route_name(spark, d):
    k, n = F.col("seg_id") % 3, (F.col("seg_id") % 97 + 1).cast("string")
    raw = F.when(k == 0, F.concat(F.lit("R-US"), F.lpad(n, 5, "0"))).when(k == 1, F.concat(F.lit("IS-"), F.lpad(n, 3, "0"))).otherwise(F.col("name"))
    return segments(spark, d).select("seg_id", text.route_name(raw).alias("route"))


@query("whitespace_collapse", "SELECT p_partkey AS id, p_name AS name FROM part")
def _collapse(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), text.collapse_blanks(F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("   ")), F.lit(" "))).alias("name"))


@query("strip_trailing_dot_zero", "SELECT id, CAST(year AS VARCHAR) AS year FROM crashes", "crashes")
def _dot(spark, d):
    return crashes(spark, d).select("id", text.strip_dot_zero(F.concat(F.col("year").cast("string"), F.lit(".0"))).alias("year"))


@query("nbi_condition", "SELECT p_partkey AS id, CASE WHEN p_partkey % 11 = 10 THEN 'Unknown' WHEN least(p_size % 10, p_partkey % 10) <= 4 THEN 'Poor' WHEN least(p_size % 10, p_partkey % 10) <= 6 THEN 'Fair' ELSE 'Good' END AS condition FROM part")
def _nbi(spark, d):
    none = F.col("p_partkey") % 11 == 10
    a, b = (F.when(none, "N").otherwise((F.col(c) % 10).cast("string")) for c in ("p_size", "p_partkey"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), text.nbi_condition(a, b, F.lit("N")).alias("condition"))


@query("warning_level", "SELECT s_suppkey AS id, CASE s_suppkey % 5 WHEN 0 THEN 'Gates' WHEN 1 THEN 'Signals' WHEN 2 THEN 'Signs' WHEN 3 THEN 'None' ELSE 'Other' END AS level FROM supplier")
def _warning(spark, d):
    k = F.col("s_suppkey") % 5
    dev = F.when(k == 0, "Four Quad Gates").when(k == 1, "Flashing Lights").when(k == 2, "Crossbucks").when(k == 3, "").otherwise("Flagman")
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), text.warning_level(dev).alias("level"))


@query("dawn_dusk_split", "SELECT id, CASE WHEN hour >= 12 THEN '3. Dusk' ELSE '1. Dawn' END AS light FROM crashes", "crashes")
def _dawn(spark, d):
    return crashes(spark, d).select("id", text.dawn_dusk(F.lit("Dawn or Dusk"), F.lpad((F.col("hour") * 100).cast("string"), 4, "0")).alias("light"))


_CMF = (
    ("Right angle, rear end", "K, A", "Virginia, MD", "Install roundabout", "Intersection geometry", "", "", ("angle,rear_end", "K,A", 100, 4, "intersection")),
    ("Rear end crash", "", "Maryland", "Signal timing", "Roadway", "", "", ("rear_end", "K,A,B,C,O", 50, 3, "segment")),
    ("misc", "pdo", "", "Chevron panels", "Roadside", "no", "", ("all", "O", 25, 1, "segment")),
    ("Vehicle/pedestrian", "B", "Ohio", "Something", "Pedestrians", "", "Roadway segment", ("pedestrian", "B", 10, 2, "segment")),
    ("", None, "Ohio, Iowa", None, None, None, None, ("all", "K,A,B,C,O", 25, 2, "both")),
)


@query("cmf_tags", "SELECT p_partkey AS id, " + ", ".join(f"CASE p_partkey % {len(_CMF)} " + " ".join(f"WHEN {k} THEN {v[-1][n]!r}" for k, v in enumerate(_CMF)) + f" END AS {name}" for n, name in enumerate(("tags", "severities", "relevance", "cost", "location"))) + " FROM part")
def _tags(spark, d):
    """Crash types, severities, relevance, cost and place of countermeasures, from their texts."""
    of = lambda n: F.element_at(F.array(*[F.lit(v[n]).cast("string") for v in _CMF]), (F.col("p_partkey") % len(_CMF) + 1).cast("int"))
    words = {"rear end": "rear_end", "angle": "angle", "pedestrian": "pedestrian"}
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.array_join(text.crash_type_tags(of(0), words), ",").alias("tags"), F.array_join(tag_words.severities(of(1)), ",").alias("severities"), tag_words.relevance(of(2)).alias("relevance"), tag_words.cost_tier(of(3), of(4)).alias("cost"), tag_words.location_kind(of(5), of(6), of(4)).alias("location"))


@query("combined_cmf", "SELECT id, round(p, 6) AS cmf, round((1 - p) * 100, 4) AS crf FROM (SELECT l_orderkey AS id, product(100 - round(l_discount * 100)) / pow(100.0E0, count(*)) AS p FROM lineitem GROUP BY 1)")
def _cmf(spark, d):
    """Factors in hundredths are multiplied as whole numbers, so that no order of rows changes a digit."""
    got = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg((text.combined_cmf(F.collect_list(100 - F.round(F.col("l_discount") * 100))) / F.pow(F.lit(100.0), F.count("*"))).alias("p"))
    return got.select("id", F.round("p", 6).alias("cmf"), F.round((1 - F.col("p")) * 100, 4).alias("crf"))


_HAV = "2 * 6371000.0E0 * asin(sqrt(least(1.0E0, pow(sin(radians(v_lat - u_lat) / 2), 2) + cos(radians(u_lat)) * cos(radians(v_lat)) * pow(sin(radians(v_lon - u_lon) / 2), 2))))"


@query("haversine", f"SELECT seg_id, round({_HAV}, 2) AS m FROM segments", "segments")
def _haversine(spark, d):
    return segments(spark, d).select("seg_id", F.round(geo.haversine_m(*[F.col(c) for c in ("u_lat", "u_lon", "v_lat", "v_lon")]), 2).alias("m"))


@query("to_unit_sphere", "SELECT id, round(cos(radians(lat)) * cos(radians(lon)), 8) AS x, round(cos(radians(lat)) * sin(radians(lon)), 8) AS y, round(sin(radians(lat)), 8) AS z FROM crashes", "crashes")
def _sphere(spark, d):
    return crashes(spark, d).select("id", *[F.round(c, 8).alias(k) for k, c in geo.to_unit_sphere(F.col("lat"), F.col("lon")).items()])


@query("confidence_label", "SELECT p_partkey AS id, CASE WHEN p_size * 8 <= 100 THEN 'high' WHEN p_size * 8 <= 200 THEN 'medium' ELSE 'low' END AS confidence FROM part")
def _confidence(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), geo.confidence(F.col("p_size") * 8).alias("confidence"))


# Filters ----------------------------------------------------------------------------------------------------


@query("filter_gps_valid", "SELECT id FROM crashes WHERE id % 7 NOT IN (0, 1)", "crashes")
def _gps(spark, d):
    k = F.col("id") % 7
    return crashes(spark, d).where(geo.gps_valid(F.when(k == 0, 0.0).otherwise(F.col("lat")), F.when(k == 1, 75.0).otherwise(F.col("lon")))).select("id")


@query("sanitize_gps_envelope", "SELECT id, CASE WHEN id % 5 = 0 THEN NULL ELSE lat END AS lat, CASE WHEN id % 5 = 0 THEN NULL ELSE lon END AS lon FROM crashes", "crashes")
def _sanitize(spark, d):
    lat, lon = geo.sanitised(F.when(F.col("id") % 5 == 0, 77.7777).otherwise(F.col("lat")), F.col("lon"))
    return crashes(spark, d).select("id", lat.alias("lat"), lon.alias("lon"))


@query("filter_bounds_buffered", "SELECT id FROM crashes WHERE lat BETWEEN 38.896E0 AND 39.104E0 AND lon BETWEEN -75.604E0 AND -75.396E0", "crashes")
def _bounds(spark, d):
    return crashes(spark, d).where(geo.in_bounds(F.col("lat"), F.col("lon"), (38.9, 39.1, -75.6, -75.4))).select("id")


@query("filter_query_crashes", "SELECT id, crash_date, severity, route, node FROM crashes WHERE lower(route) LIKE '%r1%' AND lower(collision) LIKE '%mach%' AND severity IN ('K', 'A') AND crash_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' ORDER BY crash_date DESC, id LIMIT 100", "crashes")
def _filter(spark, d):
    has = lambda c, w: F.contains(F.lower(c), F.lit(w))
    rows = crashes(spark, d).where(has(F.col("route"), "r1") & has(F.col("collision"), "mach") & F.col("severity").isin("K", "A") & F.col("crash_date").between("1996-01-01", "1999-12-31"))
    return rows.select("id", "crash_date", "severity", "route", "node").orderBy(F.desc("crash_date"), "id").limit(100)


@query("filter_jurisdiction_any", "SELECT j.name, count(*) AS n FROM crashes c JOIN (SELECT n_name AS name, CAST(n_nationkey AS INT) AS fips, lower(n_name) AS county, concat('^', n_name, '$') AS pattern FROM nation WHERE n_nationkey < 12) j ON c.fips = j.fips OR lower(c.juris) = j.county OR regexp_matches(c.juris, j.pattern) GROUP BY 1", "crashes")
def _juris_any(spark, d):
    config = table(spark, d, "nation").where("n_nationkey < 12").select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("int").alias("fips"), F.lower("n_name").alias("county"), F.concat(F.lit("^"), "n_name", F.lit("$")).alias("pattern"))
    return clean.filter_jurisdictions(crashes(spark, d).select("fips", "juris"), config).groupBy("name").agg(F.count("*").alias("n"))


@query("filter_road_system", "SELECT id FROM crashes WHERE regexp_matches(lower(ownership), 'county|city') AND NOT regexp_matches(route, '^R1')", "crashes")
def _system(spark, d):
    return crashes(spark, d).where(F.lower("ownership").rlike("county|city") & ~F.col("route").rlike("^R1")).select("id")


@query("filter_inactive_segments", "SELECT seg_id FROM segments WHERE NOT regexp_matches(lower(name), 'red|hot')", "segments")
def _inactive(spark, d):
    return segments(spark, d).where(~F.lower("name").rlike("red|hot")).select("seg_id")


@query("drop_ghost_rows", "SELECT id FROM crashes WHERE id % 4 <> 0", "crashes")
def _ghost(spark, d):
    blank = lambda c: F.when(F.col("id") % 4 == 0, "").otherwise(F.col(c).cast("string"))
    return crashes(spark, d).where((F.trim(blank("year")) != "") | (F.trim(blank("crash_date")) != "")).select("id")


_CATEGORIES = {
    "pedestrian": "is_ped", "bicycle": "is_bike", "speed": "is_speed", "impaired": "is_alcohol OR is_drug", "intersection": "node <> ''", "nighttime": "is_night", "distracted": "is_distracted", "curves": "fc_code IN (5, 6)", "workzone": "is_work_zone", "school": "is_school_zone", "senior": "is_senior", "young": "is_young",
    "motorcycle": "is_motorcycle", "hitrun": "is_hitrun", "unrestrained": "is_unrestrained", "drowsy": "is_drowsy", "guardrail": "is_guardrail", "roaddeparture": "collision = 'MACHINERY' AND node = ''", "lgtruck": "is_lgtruck", "animal": "is_animal", "weather": "weather_code <> 0",
}


@query("safety_categories_21", " UNION ALL ".join(f"SELECT '{k}' AS category, count(*) AS n, CAST(sum(epdo) AS BIGINT) AS epdo FROM crashes WHERE {v}" for k, v in _CATEGORIES.items()), "crashes")
def _categories(spark, d):
    found = F.array_compact(F.array(*[F.when(F.expr(v), k) for k, v in _CATEGORIES.items()]))
    return crashes(spark, d).select("epdo", F.explode(found).alias("category")).groupBy("category").agg(F.count("*").alias("n"), F.sum("epdo").cast("long").alias("epdo"))


@query("safety_overview", "SELECT category, severity, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS category, severity FROM crashes WHERE {v}" for k, v in _CATEGORIES.items()) + ") GROUP BY category, severity", "crashes")
def _overview(spark, d):
    found = F.array_compact(F.array(*[F.when(F.expr(v), k) for k, v in _CATEGORIES.items()]))
    return crashes(spark, d).select("severity", F.explode(found).alias("category")).groupBy("category", "severity").agg(F.count("*").alias("n"))


# Splits -----------------------------------------------------------------------------------------------------

_A = {"all_roads": "true", "dot_roads": "own_code = 1", "primary_roads": "fc_code IN (1, 2)", "non_dot_roads": "own_code BETWEEN 2 AND 6"}
_B = {"all_roads": "true", "county_roads": "own_code = 2", "city_roads": "own_code = 3", "no_interstate": "fc_code NOT IN (1, 2)"}
_TIERS = [("state", "'all'", "true", _A), ("region", "lower(district)", "district <> ''", _A), ("mpo", "lower(mpo)", "mpo <> ''", _B), ("planning_district", "lower(planning)", "true", _B), ("county", "lower(juris)", "area_code <> 0", _B), ("city", "lower(juris)", "area_code = 0", _B)]
_SPLITS = " UNION ALL ".join(f"SELECT id, '{t}' AS tier, {e} AS entity, '{r}' AS road_type FROM crashes WHERE {w} AND {c}" for t, e, w, kinds in _TIERS for r, c in kinds.items())


@query("split_tiers", _SPLITS, "crashes")
def _splits(spark, d):
    return clean.split_tiers(crashes(spark, d))


@query("sink_split_manifest", f"SELECT tier, entity, road_type, count(*) AS n FROM ({_SPLITS}) GROUP BY ALL", "crashes")
def _manifest(spark, d):
    return clean.split_manifest(clean.split_tiers(crashes(spark, d)))


@query("road_type_set_a", " UNION ALL ".join(f"SELECT id, '{r}' AS road_type FROM crashes WHERE {c}" for r, c in _A.items()), "crashes")
def _set_a(spark, d):
    return crashes(spark, d).select("id", F.explode(clean.road_types_a()).alias("road_type"))


@query("road_type_set_b", " UNION ALL ".join(f"SELECT id, '{r}' AS road_type FROM crashes WHERE {c}" for r, c in _B.items()), "crashes")
def _set_b(spark, d):
    return crashes(spark, d).select("id", F.explode(clean.road_types_b()).alias("road_type"))


@query("detect_split_strategy", " UNION ALL ".join(f"SELECT '{t}' AS tier, round(count(*) FILTER (WHERE {c} <> '') * 1.0E0 / count(*), 4) AS rate, CASE WHEN count(*) FILTER (WHERE {c} <> '') * 1.0E0 / count(*) >= 0.1 THEN 'column' ELSE 'hierarchy' END AS strategy FROM crashes" for t, c in (("region", "district"), ("mpo", "mpo"), ("route", "route"))), "crashes")
def _strategy(spark, d):
    return clean.split_strategy(crashes(spark, d), {"region": "district", "mpo": "mpo", "route": "route"})


# Sets and duplicates ----------------------------------------------------------------------------------------

_FIELDS = ["o_orderdate", "o_custkey", "o_orderstatus", "o_orderpriority"]


def _batches(spark, d):
    o = table(spark, d, "orders")
    return o.where("o_orderkey % 10 < 9"), o.where("o_orderkey % 10 >= 5")


@query("diff_new_rows", "SELECT o_orderkey AS id FROM orders f WHERE o_orderkey % 10 >= 5 AND NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_orderkey % 10 < 9 AND e.o_orderdate = f.o_orderdate AND e.o_custkey = f.o_custkey AND e.o_orderstatus = f.o_orderstatus AND e.o_orderpriority = f.o_orderpriority)")
def _diff(spark, d):
    old, new = _batches(spark, d)
    return clean.diff_new_rows(old, new, _FIELDS).select(F.col("o_orderkey").alias("id"))


@query("set_diff_hashes", "WITH n AS (SELECT count(*) AS n_fresh FROM orders WHERE o_orderkey % 10 >= 5), w AS (SELECT count(*) AS n_new FROM orders f WHERE o_orderkey % 10 >= 5 AND NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_orderkey % 10 < 9 AND e.o_orderdate = f.o_orderdate AND e.o_custkey = f.o_custkey AND e.o_orderstatus = f.o_orderstatus AND e.o_orderpriority = f.o_orderpriority)) SELECT n_fresh, n_new, CASE WHEN n_new = 0 THEN 'skip' WHEN n_new < n_fresh * 0.1 THEN 'incremental' ELSE 'full' END AS mode FROM n, w")
def _mode(spark, d):
    return clean.diff_mode(*_batches(spark, d), _FIELDS)


@query("set_diff_added_common", "SELECT 'added' AS part, count(*) AS n FROM (SELECT o_custkey FROM orders WHERE o_orderkey % 10 >= 5 EXCEPT SELECT o_custkey FROM orders WHERE o_orderkey % 10 < 3) UNION ALL SELECT 'common', count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderkey % 10 >= 5 INTERSECT SELECT o_custkey FROM orders WHERE o_orderkey % 10 < 3)")
def _added(spark, d):
    o = table(spark, d, "orders")
    a, b = o.where("o_orderkey % 10 >= 5").select("o_custkey"), o.where("o_orderkey % 10 < 3").select("o_custkey")
    n = lambda df, part: df.agg(F.count("*").alias("n")).select(F.lit(part).alias("part"), "n")
    return n(a.subtract(b), "added").union(n(a.intersect(b), "common"))


@query("dedup_geo_key", "SELECT min(id) AS id FROM crashes WHERE route <> '' GROUP BY crash_date, route, collision", "crashes")
def _dedup_geo(spark, d):
    return clean.keep_first(crashes(spark, d).where("route <> ''"), ["crash_date", "route", "collision"], [F.col("id")]).select("id")


@query("dedup_document", "SELECT o_custkey AS doc, min(o_orderkey) AS id FROM orders GROUP BY 1")
def _dedup_doc(spark, d):
    return clean.keep_first(table(spark, d, "orders"), ["o_custkey"], [F.col("o_orderkey")]).select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("id"))


@query("dedup_segments", "SELECT min(seg_id) AS seg_id FROM segments GROUP BY u_node, v_node, name", "segments")
def _dedup_seg(spark, d):
    return clean.keep_first(segments(spark, d), ["u_node", "v_node", "name"], [F.col("seg_id")]).select("seg_id")


@query("dedup_poi", "SELECT DISTINCT s_nationkey AS place, s_nationkey % 11 AS category FROM supplier")
def _dedup_poi(spark, d):
    return table(spark, d, "supplier").select(F.col("s_nationkey").alias("place"), (F.col("s_nationkey") % 11).alias("category")).dropDuplicates(["place", "category"])


@query("merge_existing_two_key_dedup", """WITH u AS (SELECT *, 0 AS w FROM orders WHERE o_orderkey % 10 < 8 UNION ALL SELECT *, 1 FROM orders WHERE o_orderkey % 10 >= 6), a AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY w) AS r FROM u),
b AS (SELECT *, row_number() OVER (PARTITION BY o_orderdate, o_custkey % 50, o_custkey % 7, o_orderpriority ORDER BY w, o_orderkey) AS g FROM a WHERE r = 1) SELECT o_orderkey AS id FROM b WHERE g = 1""")
def _merge(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("string").alias("doc"), F.col("o_orderdate").alias("dt"), (F.col("o_custkey") % 50).alias("x4"), (F.col("o_custkey") % 7).alias("y4"), F.col("o_orderpriority").alias("kind"))
    return clean.merge_existing(o.where("id % 10 < 8"), o.where("id % 10 >= 6"), "doc", ["dt", "x4", "y4", "kind"], "id").select("id")


@query("first_occurrence_flag", "SELECT id, min(id) OVER (PARTITION BY crash_date, juris, collision) AS first_id, min(id) OVER (PARTITION BY crash_date, juris, collision) <> id AS duplicate FROM crashes", "crashes")
def _first(spark, d):
    return clean.first_occurrence(crashes(spark, d), ["crash_date", "juris", "collision"], "id")


@query("concat_years", "SELECT year, count(*) AS n FROM (SELECT CAST(year(l_shipdate) AS INT) AS year FROM lineitem UNION ALL SELECT CAST(year(o_orderdate) AS INT) FROM orders) GROUP BY year")
def _concat(spark, d):
    a = table(spark, d, "lineitem").select(F.year("l_shipdate").alias("year"), F.lit(1).alias("from_lineitem"))
    b = table(spark, d, "orders").select(F.year("o_orderdate").alias("year"))
    return a.unionByName(b, allowMissingColumns=True).groupBy("year").agg(F.count("*").alias("n"))


@query("generate_crash_id", "SELECT id, concat_ws('-', 'DE', strftime(crash_date, '%Y%m%d'), lpad(CAST(hour * 100 + minute AS VARCHAR), 4, '0'), lpad(CAST(row_number() OVER (ORDER BY crash_date, id) AS VARCHAR), 7, '0')) AS document FROM crashes", "crashes")
def _ids(spark, d):
    return clean.generate_crash_ids(crashes(spark, d).select("id", "crash_date", "hour", "minute"), "DE", ["crash_date", "id"]).select("id", "document")


@query("canonicalise_colliding_names", "SELECT p_partkey AS id, min(p_name) OVER (PARTITION BY lower(p_name)) AS name FROM part")
def _canonical(spark, d):
    odd = F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(F.replace("p_name", F.lit(" "), F.lit("  ")))
    rows = clean.canonical_names(table(spark, d, "part").select(F.col("p_partkey").alias("id"), odd.alias("n")), "n")
    return rows.select("id", F.regexp_replace("canonical", " +", " ").alias("name"))


@query("upsert_registry", "SELECT coalesce(b.k, a.k) AS state, coalesce(b.n, a.n) AS n FROM (SELECT o_orderstatus AS k, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1) a FULL JOIN (SELECT o_orderstatus AS k, count(*) AS n FROM orders WHERE o_orderkey % 2 = 1 AND o_orderstatus <> 'F' GROUP BY 1) b USING (k)")
def _upsert(spark, d):
    n = lambda df: df.groupBy(F.col("o_orderstatus").alias("state")).agg(F.count("*").alias("n"))
    o = table(spark, d, "orders")
    return clean.upsert(n(o.where("o_orderkey % 2 = 0")), n(o.where("o_orderkey % 2 = 1 AND o_orderstatus <> 'F'")), "state")


@query("rename_to_standard", "SELECT o_orderkey AS id, coalesce(nullif(o_orderstatus, 'P'), o_orderpriority) AS status FROM orders")
def _rename(spark, d):
    raw = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "P", " nan ").otherwise(F.col("o_orderstatus")).alias("Status"), F.col("o_orderpriority").alias("STATUS_2"))
    return clean.rename_to_standard(raw, {"status": ["status", "status_2", "stat"]}).select("id", "status")


@query("decode_code_columns", "SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS status, o_orderpriority AS priority FROM orders")
def _decode(spark, d):
    raw = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return clean.decode_code_columns(raw, {"status": {"F": "Final", "O": "Open"}, "priority": {"2-HIGH": "1-URGENT"}})


@query("map_values_with_default", "SELECT c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN '1. Rear End' WHEN 'MACHINERY' THEN '2. Angle' ELSE '16. Other' END AS collision FROM customer")
def _map_default(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), clean.map_values(F.col("c_mktsegment"), {"BUILDING": "1. Rear End", "MACHINERY": "2. Angle"}, F.lit("16. Other")).alias("collision"))


@query("normalize_yes_no", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 IN (0, 1) THEN 'Yes' ELSE 'No' END AS flag FROM orders")
def _yes_no(spark, d):
    k = F.col("o_orderkey") % 4
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), text.yes_no(F.when(k == 0, " y").when(k == 1, "TRUE").when(k == 2, "0")).alias("flag"))


@query("classify_pack_columns", "SELECT id, CASE WHEN route = '' AND node = '' THEN '{}' WHEN route = '' THEN concat('{\"node\":\"', node, '\"}') WHEN node = '' THEN concat('{\"route\":\"', route, '\"}') ELSE concat('{\"route\":\"', route, '\",\"node\":\"', node, '\"}') END AS road_data FROM crashes", "crashes")
def _pack(spark, d):
    return clean.pack_columns(crashes(spark, d), ["id"], {"road_data": ["route", "node"]})


@query("json_path_extract", "SELECT event_id AS id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def _json(spark, d):
    return table(spark, d, "events").select(F.col("event_id").alias("id"), F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@query("cmf_quality_filter", "SELECT name, id, rating FROM (SELECT substr(lower(p_name), 1, 100) AS name, p_partkey AS id, p_size % 5 + 1 AS rating, row_number() OVER (PARTITION BY substr(lower(p_name), 1, 100) ORDER BY p_partkey) AS r FROM part WHERE p_size % 5 + 1 >= 3) WHERE r = 1")
def _cmf_quality(spark, d):
    rows = table(spark, d, "part").select(F.substring(F.lower("p_name"), 1, 100).alias("name"), F.col("p_partkey").alias("id"), (F.col("p_size") % 5 + 1).alias("rating")).where("rating >= 3")
    return clean.keep_first(rows, ["name"], [F.col("id")])


@query("grants_due_window", "SELECT o_orderkey AS id, date_diff('day', DATE '1998-01-01', CAST(o_orderdate AS DATE)) AS days_until FROM orders WHERE date_diff('day', DATE '1998-01-01', CAST(o_orderdate AS DATE)) BETWEEN 0 AND 60")
def _grants(spark, d):
    k, dt = F.col("o_orderkey") % 3, F.col("o_orderdate")
    written = F.when(k == 0, F.date_format(dt, "MM/dd/yyyy")).when(k == 1, F.date_format(dt, "yyyy-MM-dd")).otherwise(F.date_format(dt, "MMM dd, yyyy"))
    due = F.coalesce(*[F.try_to_timestamp(written, F.lit(f)) for f in ("MM/dd/yyyy", "yyyy-MM-dd", "MMM dd, yyyy")])
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.datediff(due, F.lit("1998-01-01").cast("date")).cast("long").alias("days_until"))
    return rows.where(F.col("days_until").between(0, 60))


@query("filter_grants_relevant", "SELECT p_partkey AS id FROM part WHERE p_type = 'ECONOMY' OR (p_brand IN ('Brand#1', 'Brand#2') AND regexp_matches(lower(p_name), 'red|blue'))")
def _relevant(spark, d):
    return table(spark, d, "part").where((F.col("p_type") == "ECONOMY") | (F.col("p_brand").isin("Brand#1", "Brand#2") & F.lower("p_name").rlike("red|blue"))).select(F.col("p_partkey").alias("id"))
