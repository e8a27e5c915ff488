"""Queries of the roll-ups and rankings over the bound tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kerbline import session
from kerbline.bindings import crashes, persons, segments, vehicles, with_views
from kerbline.functions.severity import CLASSES, EPDO_WEIGHTS, epdo
from kerbline.operators import aggregate as agg
from kerbline.operators import rank

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None, *views: str):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = with_views(sql, *views) if views else sql
        return f

    return keep


SEV = ", ".join(f"count(*) FILTER (WHERE severity = '{k}') AS {k}" for k in CLASSES)
SCORED = ", ".join(CLASSES) + ", K * 883 + A * 94 + B * 21 + C * 11 + O AS epdo, K + A AS ka"


@query("hotspots", f"SELECT route, node, total, {SCORED} FROM (SELECT route, node, count(*) AS total, {SEV} FROM crashes WHERE route <> '' GROUP BY route, node) ORDER BY epdo DESC, route, node LIMIT 50", "crashes")
def _hotspots(spark, d):
    return agg.hotspots(crashes(spark, d))


@query("score_and_rank_hotspots", f"""SELECT route, node, total, {SCORED}, round(total / 7.0E0, 2) AS per_year, top_type FROM (SELECT route, node, count(*) AS total, {SEV} FROM crashes WHERE route <> '' GROUP BY route, node HAVING count(*) >= 3)
JOIN (SELECT route, node, collision AS top_type FROM (SELECT route, node, collision, row_number() OVER (PARTITION BY route, node ORDER BY count(*) DESC, collision) AS rn FROM crashes GROUP BY route, node, collision) WHERE rn = 1) USING (route, node)""", "crashes")
def _score_and_rank_hotspots(spark, d):
    c = crashes(spark, d).where("route <> ''")
    types = c.groupBy("route", "node", "collision").agg(F.count("*").alias("n")).groupBy("route", "node").agg(F.min(F.struct((-F.col("n")).alias("m"), F.col("collision").alias("t"))).alias("t"))
    return agg.by_severity(c, "route", "node").where("total >= 3").join(types, ["route", "node"]).withColumns({"per_year": F.round(F.col("total") / 7.0, 2), "top_type": F.col("t.t")}).drop("t")


@query("county_stats", f"SELECT juris, total, {SCORED}, ped_crashes, bike_crashes, speed_crashes, alcohol_crashes FROM (SELECT juris, count(*) AS total, {SEV}, count(*) FILTER (WHERE is_ped) AS ped_crashes, count(*) FILTER (WHERE is_bike) AS bike_crashes, count(*) FILTER (WHERE is_speed) AS speed_crashes, count(*) FILTER (WHERE is_alcohol) AS alcohol_crashes FROM crashes GROUP BY juris)", "crashes")
def _county_stats(spark, d):
    return agg.county_totals(crashes(spark, d))


_TOP = "SELECT juris, {v}, n, pct, place FROM (SELECT juris, {v}, count(*) AS n, round(count(*) * 1.0E0 / sum(count(*)) OVER (PARTITION BY juris) * 100, 1) AS pct, row_number() OVER (PARTITION BY juris ORDER BY count(*) DESC, {v}) AS place FROM crashes GROUP BY juris, {v}) WHERE place <= {k} AND {v} <> ''"


@query("county_top_collisions", _TOP.format(v="collision", k=10), "crashes")
def _county_top_collisions(spark, d):
    return agg.top_values(crashes(spark, d), "collision")


@query("county_weather_light", "SELECT juris, dimension, value, count(*) AS n FROM (SELECT juris, 'weather' AS dimension, weather AS value FROM crashes UNION ALL SELECT juris, 'light', light FROM crashes) GROUP BY ALL", "crashes")
def _county_weather_light(spark, d):
    pairs = F.array(*[F.struct(F.lit(k).alias("dimension"), F.col(k).alias("value")) for k in ("weather", "light")])
    return crashes(spark, d).select("juris", F.explode(pairs).alias("x")).groupBy("juris", "x.dimension", "x.value").agg(F.count("*").alias("n"))


@query("county_top_routes", f"SELECT * FROM (SELECT juris, route, total, {SCORED}, row_number() OVER (PARTITION BY juris ORDER BY K * 883 + A * 94 + B * 21 + C * 11 + O DESC, route) AS place FROM (SELECT juris, route, count(*) AS total, {SEV} FROM crashes WHERE route <> '' GROUP BY juris, route)) WHERE place <= 25", "crashes")
def _county_top_routes(spark, d):
    return agg.top_routes(crashes(spark, d))


@query("yoy_change", f"SELECT juris, year, total, {SCORED}, CASE WHEN lag(total) OVER (PARTITION BY juris ORDER BY year) > 0 THEN round((total - lag(total) OVER (PARTITION BY juris ORDER BY year)) * 1.0E0 / lag(total) OVER (PARTITION BY juris ORDER BY year), 4) END AS change FROM (SELECT juris, year, count(*) AS total, {SEV} FROM crashes GROUP BY juris, year)", "crashes")
def _yoy_change(spark, d):
    return agg.yearly_trend(crashes(spark, d))


BRIDGE = "SELECT 'region' AS tier, concat('R', CAST(n_regionkey AS VARCHAR(3))) AS entity, CAST(n_nationkey AS INT) AS fips FROM nation UNION ALL SELECT 'mpo', concat('MPO', CAST(n_nationkey % 4 AS VARCHAR(3))), CAST(n_nationkey AS INT) FROM nation WHERE n_nationkey % 4 <> 3 UNION ALL SELECT 'state', 'all', CAST(n_nationkey AS INT) FROM nation"


def bridge(spark, d):
    from kerbline.bindings import table

    return spark.sql(BRIDGE.replace("FROM nation", "FROM {nation}"), nation=table(spark, d, "nation"))


@query("rollup_statewide_county", f"SELECT tier, entity, total, {SCORED}, members FROM (SELECT tier, entity, count(*) AS total, {SEV}, count(DISTINCT fips) AS members FROM crashes JOIN ({BRIDGE}) b USING (fips) GROUP BY tier, entity)", "crashes")
def _rollup(spark, d):
    return agg.rollup_scopes(crashes(spark, d), bridge(spark, d))


@query("dominant_member", "SELECT route, juris AS dominant, n AS dominant_n, members, total FROM (SELECT route, juris, count(*) AS n, row_number() OVER (PARTITION BY route ORDER BY count(*) DESC, juris) AS rn, count(*) OVER (PARTITION BY route) AS members, CAST(sum(count(*)) OVER (PARTITION BY route) AS BIGINT) AS total FROM crashes WHERE route <> '' GROUP BY route, juris) WHERE rn = 1", "crashes")
def _dominant(spark, d):
    return agg.dominant_member(crashes(spark, d), ["route"])


@query("epdo_person_weighted", "SELECT node, CAST(sum(k_people) * 883 + sum(a_people) * 94 + sum(b_people) * 21 + sum(c_people) * 11 + count(*) AS BIGINT) AS epdo, count(*) AS total FROM crashes WHERE node <> '' GROUP BY node", "crashes")
def _epdo_person(spark, d):
    return agg.person_weighted_epdo(crashes(spark, d))


@query("epdo_score", "SELECT preset, CAST(sum(w) AS BIGINT) AS epdo, count(*) AS n FROM (SELECT unnest([" + ", ".join(f"{{'preset': '{p}', 'w': CASE severity " + " ".join(f"WHEN '{k}' THEN {n}" for k, n in w.items()) + " END}" for p, w in EPDO_WEIGHTS.items()) + "], recursive := true) FROM crashes) GROUP BY preset", "crashes")
def _epdo_score(spark, d):
    each = F.array(*[F.struct(F.lit(p).alias("preset"), epdo(F.col("severity"), p).alias("w")) for p in EPDO_WEIGHTS])
    return crashes(spark, d).select(F.explode(each).alias("x")).groupBy("x.preset").agg(F.sum("x.w").alias("epdo"), F.count("*").alias("n"))


@query("crash_pattern_matrix", f"SELECT collision, total, {', '.join(CLASSES)}, {', '.join(f'round({k} * 1.0E0 / total * 100, 1) AS pct_{k}' for k in CLASSES)}, K * 883 + A * 94 + B * 21 + C * 11 + O AS epdo, round((K + A) * 1.0E0 / total * 100, 1) AS ka_rate FROM (SELECT collision, count(*) AS total, {SEV} FROM crashes GROUP BY collision)", "crashes")
def _pattern(spark, d):
    return agg.pattern_matrix(crashes(spark, d))


_SERIES = "WITH c AS (SELECT {g}, month, count(*) AS n FROM crashes GROUP BY ALL), m AS (SELECT CAST(unnest(generate_series((SELECT min(month) FROM c), (SELECT max(month) FROM c), INTERVAL 1 MONTH)) AS DATE) AS month) SELECT {g}, month, coalesce(n, 0) AS n FROM (SELECT DISTINCT {g} FROM c) CROSS JOIN m LEFT JOIN c USING ({g}, month)"


@query("monthly_series_zero_filled", _SERIES.format(g="juris"), "crashes")
def _monthly(spark, d):
    return agg.monthly_series(crashes(spark, d), "juris")


@query("matrices_m01_m06", """SELECT matrix, series, month, count(*) AS n, CAST(sum(epdo) AS BIGINT) AS epdo FROM (
SELECT 'm01' AS matrix, 'all' AS series, month, epdo FROM crashes UNION ALL SELECT 'm02', severity, month, epdo FROM crashes UNION ALL SELECT 'm03', route, month, epdo FROM crashes WHERE route <> ''
UNION ALL SELECT 'm04', collision, month, epdo FROM crashes UNION ALL SELECT 'm05', 'speed', month, epdo FROM crashes WHERE is_speed UNION ALL SELECT 'm05', 'alcohol', month, epdo FROM crashes WHERE is_alcohol
UNION ALL SELECT 'm05', 'ped', month, epdo FROM crashes WHERE is_ped UNION ALL SELECT 'm05', 'bike', month, epdo FROM crashes WHERE is_bike UNION ALL SELECT 'm05', 'night', month, epdo FROM crashes WHERE is_night
UNION ALL SELECT 'm06', CASE WHEN node <> '' THEN 'intersection' ELSE 'segment' END, month, epdo FROM crashes) GROUP BY ALL""", "crashes")
def _matrices(spark, d):
    one = lambda m, s, ok=None: F.struct(F.lit(m).alias("matrix"), F.when(F.lit(True) if ok is None else ok, s).alias("series"))
    rows = [one("m01", F.lit("all")), one("m02", F.col("severity")), one("m03", F.col("route"), F.col("route") != ""), one("m04", F.col("collision"))]
    rows += [one("m05", F.lit(f), F.col(f"is_{f}")) for f in ("speed", "alcohol", "ped", "bike", "night")]
    rows.append(one("m06", F.when(F.col("node") != "", "intersection").otherwise("segment")))
    long = crashes(spark, d).select("month", "epdo", F.explode(F.array(*rows)).alias("x")).where("x.series IS NOT NULL")
    return long.groupBy("x.matrix", "x.series", "month").agg(F.count("*").alias("n"), F.sum("epdo").cast("long").alias("epdo"))


@query("summary_kpis", f"""WITH m AS (SELECT month, count(*) AS n, row_number() OVER (ORDER BY month DESC) AS r FROM crashes GROUP BY month)
SELECT total, {SCORED}, first_year, last_year, n_months, round(total * 1.0E0 / n_months, 1) AS monthly_avg, recent6, prior6 FROM (SELECT count(*) AS total, {SEV}, min(year) AS first_year, max(year) AS last_year, count(DISTINCT month) AS n_months FROM crashes),
(SELECT CAST(sum(n) FILTER (WHERE r <= 6) AS BIGINT) AS recent6, CAST(sum(n) FILTER (WHERE r BETWEEN 7 AND 12) AS BIGINT) AS prior6 FROM m)""", "crashes")
def _kpis(spark, d):
    c = crashes(spark, d)
    whole = agg.scored(c.agg(*agg.severity_counts(), F.min("year").alias("first_year"), F.max("year").alias("last_year")))
    months = c.groupBy("month").agg(F.count("*").alias("n"))
    r = F.row_number().over(Window.orderBy(F.desc("month")))  # a row per month
    last = months.withColumn("r", r).agg(F.count("*").alias("n_months"), F.sum(F.when(F.col("r") <= 6, F.col("n"))).alias("recent6"), F.sum(F.when(F.col("r").between(7, 12), F.col("n"))).alias("prior6"))
    return whole.join(F.broadcast(last)).withColumn("monthly_avg", F.round(F.col("total") / F.col("n_months"), 1))


@query("recent_vs_prior_months", "SELECT juris, count(*) FILTER (WHERE r <= 6) AS recent, count(*) FILTER (WHERE r BETWEEN 7 AND 12) AS prior FROM (SELECT juris, dense_rank() OVER (PARTITION BY juris ORDER BY month DESC) AS r FROM crashes) GROUP BY juris", "crashes")
def _recent(spark, d):
    per = crashes(spark, d).groupBy("juris", "month").agg(F.count("*").alias("n"))
    ranked = per.withColumn("r", F.row_number().over(Window.partitionBy("juris").orderBy(F.desc("month"))))
    part = lambda a, b: F.coalesce(F.sum(F.when(F.col("r").between(a, b), F.col("n"))), F.lit(0))
    return ranked.groupBy("juris").agg(part(1, 6).alias("recent"), part(7, 12).alias("prior"))


PERSON_AGG = """SELECT st_case, year, coalesce(bool_or(drinking = 1 OR alc_res BETWEEN 8 AND 94), false) AS any_drunk, bool_or(coalesce(rest_use NOT IN (3, 7), true)) AS any_unrestrained, bool_or(per_typ = 5) AS ped_involved, bool_or(per_typ = 6) AS bike_involved,
count(*) FILTER (WHERE per_typ = 5 AND inj_sev = 4) AS ped_fatals, count(*) FILTER (WHERE per_typ = 6 AND inj_sev = 4) AS bike_fatals, count(*) FILTER (WHERE inj_sev = 4) AS total_fatalities, min(CASE WHEN per_typ = 1 THEN age END) AS youngest_driver_age, max(CASE WHEN per_typ = 1 THEN age END) AS oldest_driver_age FROM persons GROUP BY st_case, year"""
VEHICLE_AGG = """SELECT st_case, year, bool_or(speedrel BETWEEN 1 AND 5) AS any_speeding, bool_or(body_typ BETWEEN 60 AND 79) AS any_large_truck, bool_or(body_typ BETWEEN 80 AND 89) AS any_motorcycle, coalesce(bool_or(mdrdstrd NOT IN (0, 96, 99)), false) AS any_distracted, bool_or(hit_run IN (1, 2)) AS hit_and_run FROM vehicles GROUP BY st_case, year"""


@query("agg_persons_to_case", PERSON_AGG, "persons")
def _persons(spark, d):
    return agg.persons_to_case(persons(spark, d))


@query("agg_vehicles_to_case", VEHICLE_AGG, "vehicles")
def _vehicles(spark, d):
    return agg.vehicles_to_case(vehicles(spark, d))


_FLAGS = ("any_drunk", "any_unrestrained", "ped_involved", "bike_involved", "any_speeding", "any_large_truck", "any_motorcycle", "any_distracted", "hit_and_run")
_FACT = f"SELECT st_case, year, severity, {', '.join(f'coalesce({f}, false) AS {f}' for f in _FLAGS)}, {', '.join(f'coalesce({f}, 0) AS {f}' for f in ('ped_fatals', 'bike_fatals', 'total_fatalities'))}, youngest_driver_age, oldest_driver_age FROM (SELECT id AS st_case, year, severity FROM crashes) a LEFT JOIN ({PERSON_AGG}) p USING (st_case, year) LEFT JOIN ({VEHICLE_AGG}) v USING (st_case, year)"


@query("join_fact_aggregates", _FACT, "crashes", "persons", "vehicles")
def _fact(spark, d):
    return agg.join_fact_aggregates(crashes(spark, d).select(F.col("id").alias("st_case"), "year", "severity"), persons(spark, d), vehicles(spark, d))


@query("federal_summary", """SELECT year, severity, region, fc, ownership, area_type, count(*) AS total_crashes, CAST(sum(k_people) AS BIGINT) AS total_k, CAST(sum(a_people) AS BIGINT) AS total_a, CAST(sum(b_people) AS BIGINT) AS total_b, CAST(sum(c_people) AS BIGINT) AS total_c,
CAST(sum(k_people + a_people + b_people + c_people) AS BIGINT) AS total_injured, count(*) FILTER (WHERE is_alcohol) AS alcohol_crashes, count(*) FILTER (WHERE is_speed) AS speed_crashes, count(*) FILTER (WHERE is_distracted) AS distracted_crashes, count(*) FILTER (WHERE is_ped) AS ped_crashes, count(*) FILTER (WHERE is_bike) AS bike_crashes, count(*) FILTER (WHERE is_work_zone) AS wz_crashes FROM crashes GROUP BY ALL""", "crashes")
def _federal(spark, d):
    return agg.federal_summary(crashes(spark, d))


_DIMS = ("severity", "collision", "weather", "light", "fc", "area_type", "hour")


@query("crash_profile", f"SELECT dimension, value, total, {SCORED} FROM (SELECT dimension, value, count(*) AS total, {SEV} FROM (" + " UNION ALL ".join(f"SELECT '{x}' AS dimension, CAST({x} AS VARCHAR) AS value, severity FROM crashes" for x in _DIMS) + ") GROUP BY dimension, value)", "crashes")
def _profile(spark, d):
    return agg.crash_profile(crashes(spark, d), list(_DIMS))


@query("temporal_patterns", "SELECT grain, part, count(*) AS n FROM (SELECT 'hour' AS grain, hour AS part FROM crashes UNION ALL SELECT 'weekday', CAST(dayofweek(crash_date) AS INT) FROM crashes UNION ALL SELECT 'month', CAST(month(crash_date) AS INT) FROM crashes) GROUP BY ALL", "crashes")
def _temporal(spark, d):
    parts = {"hour": F.col("hour"), "weekday": F.dayofweek("crash_date") - 1, "month": F.month("crash_date")}
    return crashes(spark, d).select(F.explode(F.array(*[F.struct(F.lit(k).alias("grain"), v.cast("int").alias("part")) for k, v in parts.items()])).alias("x")).groupBy("x.grain", "x.part").agg(F.count("*").alias("n"))


@query("severity_trend", """WITH y AS (SELECT year, avg(epdo) AS mean_epdo, row_number() OVER (ORDER BY year) AS r, count(*) OVER () AS k FROM crashes GROUP BY year)
SELECT round(avg(mean_epdo) FILTER (WHERE r <= k // 2), 4) AS older, round(avg(mean_epdo) FILTER (WHERE r > k // 2), 4) AS recent, CASE WHEN avg(mean_epdo) FILTER (WHERE r > k // 2) > avg(mean_epdo) FILTER (WHERE r <= k // 2) * 1.05 THEN 'worsening' WHEN avg(mean_epdo) FILTER (WHERE r > k // 2) < avg(mean_epdo) FILTER (WHERE r <= k // 2) * 0.95 THEN 'improving' ELSE 'stable' END AS trend FROM y""", "crashes")
def _severity_trend(spark, d):
    y = crashes(spark, d).groupBy("year").agg(F.avg("epdo").alias("mean_epdo")).withColumns({"r": F.row_number().over(Window.orderBy("year")), "k": F.count("*").over(Window.partitionBy())})
    old = F.col("r") <= F.floor(F.col("k") / 2)
    both = y.agg(F.avg(F.when(old, F.col("mean_epdo"))).alias("a"), F.avg(F.when(~old, F.col("mean_epdo"))).alias("b"))
    trend = F.when(F.col("b") > F.col("a") * 1.05, "worsening").when(F.col("b") < F.col("a") * 0.95, "improving").otherwise("stable")
    return both.select(F.round("a", 4).alias("older"), F.round("b", 4).alias("recent"), trend.alias("trend"))


@query("dashboard_queries", f"SELECT district, total, {SCORED} FROM (SELECT district, count(*) AS total, {SEV} FROM crashes GROUP BY district)", "crashes")
def _dashboard(spark, d):
    return agg.by_severity(crashes(spark, d), "district")


@query("list_locations", "SELECT node, count(*) AS n, max(crash_date) AS latest FROM crashes WHERE node LIKE 'N1%' GROUP BY node HAVING count(*) >= 5", "crashes")
def _locations(spark, d):
    return crashes(spark, d).where(F.col("node").like("N1%")).groupBy("node").agg(F.count("*").alias("n"), F.max("crash_date").alias("latest")).where("n >= 5")


_QUALITY = ("route", "node", "district", "mpo", "fc", "weather", "area_type")


@query("data_quality", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) FILTER (WHERE trim({c}) <> '') AS filled, round(count(*) FILTER (WHERE trim({c}) <> '') * 1.0E0 / count(*) * 100, 1) AS pct FROM crashes" for c in _QUALITY), "crashes")
def _quality(spark, d):
    return agg.completeness(crashes(spark, d), list(_QUALITY))


@query("crash_totals_summary", f"SELECT total, {SCORED} FROM (SELECT count(*) AS total, {SEV} FROM crashes)", "crashes")
def _totals(spark, d):
    return agg.scored(crashes(spark, d).agg(*agg.severity_counts()))


@query("majority_value", "SELECT route, fc, n FROM (SELECT route, fc, count(*) AS n, row_number() OVER (PARTITION BY route ORDER BY count(*) DESC, fc DESC) AS r FROM crashes WHERE route <> '' AND fc <> '' GROUP BY route, fc) WHERE r = 1 AND n >= 2", "crashes")
def _majority(spark, d):
    return agg.majority(crashes(spark, d).where("route <> '' AND fc <> ''"), "route", "fc")


@query("graph_degree", "SELECT node, count(*) AS degree, count(DISTINCT other) AS streets FROM (SELECT u_node AS node, v_node AS other FROM segments UNION ALL SELECT v_node, u_node FROM segments) GROUP BY node HAVING count(*) >= 3", "segments")
def _degree(spark, d):
    return agg.graph_degree(segments(spark, d))


@query("group_median_propagation", """WITH s AS (SELECT * FROM segments), a AS (SELECT ref, fc_code, median(aadt) AS m FROM s WHERE aadt IS NOT NULL GROUP BY ALL), b AS (SELECT name, fc_code, median(aadt) AS m FROM s WHERE aadt IS NOT NULL GROUP BY ALL), c AS (SELECT fc_code, median(aadt) AS m FROM s WHERE aadt IS NOT NULL GROUP BY ALL)
SELECT seg_id, coalesce(CAST(aadt AS DOUBLE), a.m, b.m, c.m) AS aadt, CASE WHEN aadt IS NOT NULL THEN 'source' WHEN a.m IS NOT NULL THEN 'ref_fc' WHEN b.m IS NOT NULL THEN 'name_fc' WHEN c.m IS NOT NULL THEN 'fc_median' ELSE 'none' END AS source FROM s LEFT JOIN a USING (ref, fc_code) LEFT JOIN b USING (name, fc_code) LEFT JOIN c USING (fc_code)""", "segments")
def _medians(spark, d):
    return agg.group_median_propagation(segments(spark, d))


@query("cell_centroids", "SELECT CAST(floor(lat * 100) AS BIGINT) AS cy, CAST(floor(lon * 100) AS BIGINT) AS cx, round(CAST(sum(CAST(round(lat * 10000) AS BIGINT)) AS DOUBLE) / count(*), 2) AS lat4, round(CAST(sum(CAST(round(lon * 10000) AS BIGINT)) AS DOUBLE) / count(*), 2) AS lon4, count(*) AS n FROM crashes GROUP BY 1, 2", "crashes")
def _cells(spark, d):
    mean = lambda c: F.round(F.sum(F.round(F.col(c) * 10000).cast("long")).cast("double") / F.count("*"), 2).alias(f"{c}4")
    return crashes(spark, d).groupBy(F.floor(F.col("lat") * 100).alias("cy"), F.floor(F.col("lon") * 100).alias("cx")).agg(mean("lat"), mean("lon"), F.count("*").alias("n"))


@query("route_medians", "SELECT route, lon, lat, n, CASE WHEN n >= 10 THEN 'high' WHEN n >= 3 THEN 'medium' ELSE 'low' END AS confidence FROM (SELECT route, lon, lat, row_number() OVER (PARTITION BY route ORDER BY lon, lat, id) AS r, count(*) OVER (PARTITION BY route) AS n FROM crashes WHERE route <> '') WHERE r = n // 2 + 1", "crashes")
def _route_medians(spark, d):
    from kerbline.operators.validate import route_medians

    return route_medians(crashes(spark, d).where("route <> ''"))


@query("percentile_bounds", "SELECT round(quantile_cont(lat, 0.02) - 0.05, 4) AS lat_min, round(quantile_cont(lat, 0.98) + 0.05, 4) AS lat_max, round(quantile_cont(lon, 0.02) - 0.05, 4) AS lon_min, round(quantile_cont(lon, 0.98) + 0.05, 4) AS lon_max FROM crashes HAVING count(*) >= 100", "crashes")
def _bounds(spark, d):
    from kerbline.operators.validate import percentile_bounds

    return percentile_bounds(crashes(spark, d))


# Rankings ---------------------------------------------------------------------------------------------------

_JM = """SELECT juris, count(*) AS total_crash, count(*) FILTER (WHERE severity = 'K') AS total_fatal, count(*) FILTER (WHERE severity IN ('K', 'A')) AS total_fatal_serious_injury, count(*) FILTER (WHERE is_ped) AS total_ped_crash, count(*) FILTER (WHERE is_bike) AS total_bike_crash, count(*) FILTER (WHERE is_motorcycle) AS total_motorcycle_crash, CAST(sum(epdo) AS BIGINT) AS total_epdo,
count(*) FILTER (WHERE is_night) AS total_night_crash, count(*) FILTER (WHERE is_night AND severity = 'K') AS total_night_fatal, count(*) FILTER (WHERE is_alcohol OR is_drug) AS total_impaired_crash, count(*) FILTER (WHERE is_distracted) AS total_distracted_crash, count(*) FILTER (WHERE is_speed) AS total_speed_crash, min_by(district, id) AS district, min_by(mpo, id) AS mpo, min_by(planning, id) AS planning FROM crashes GROUP BY juris"""
_TREND_OF = {"trend_total_crash": "1", "trend_fatal": "CASE WHEN severity = 'K' THEN 1 END", "trend_ksi": "CASE WHEN severity IN ('K', 'A') THEN 1 END", "trend_epdo": "epdo", "trend_ped_crash": "CASE WHEN is_ped THEN 1 END", "trend_bike_crash": "CASE WHEN is_bike THEN 1 END"}
_TRENDS = "WITH py AS (SELECT year, count(*) AS n FROM crashes GROUP BY year), r0 AS (SELECT year, n, row_number() OVER (ORDER BY year DESC) AS r FROM py), thin AS (SELECT (SELECT n FROM r0 WHERE r = 1) < (SELECT n FROM r0 WHERE r = 2) * 0.5 AS t), r1 AS (SELECT year, row_number() OVER (ORDER BY year DESC) AS r, count(*) OVER () AS k FROM r0, thin WHERE NOT (coalesce(t, false) AND r = 1)), part AS (SELECT c.*, CASE WHEN k >= 6 AND r <= 3 THEN 1 WHEN k >= 6 AND r <= 6 THEN 0 END AS p FROM crashes c LEFT JOIN r1 USING (year)) SELECT juris, " + ", ".join(f"CASE WHEN coalesce(sum({v}) FILTER (WHERE p = 0), 0) > 0 THEN round((coalesce(sum({v}) FILTER (WHERE p = 1), 0) - sum({v}) FILTER (WHERE p = 0)) * 1.0E0 / sum({v}) FILTER (WHERE p = 0) * 100, 1) ELSE 0.0E0 END AS {n}" for n, v in _TREND_OF.items()) + " FROM part GROUP BY juris"
_SHARES = "SELECT *, CASE WHEN total_fatal > 0 THEN round(total_night_fatal * 1.0E0 / total_fatal * 100, 1) ELSE 0.0E0 END AS pct_night_fatal, round(total_impaired_crash * 1.0E0 / total_crash * 100, 1) AS pct_impaired_crash, round(total_distracted_crash * 1.0E0 / total_crash * 100, 1) AS pct_distracted_crash, round(total_speed_crash * 1.0E0 / total_crash * 100, 1) AS pct_speed_crash, round(total_epdo * 1.0E0 / total_crash, 1) AS severity_index, round(total_fatal * 1.0E0 / total_crash * 1000, 2) AS fatality_rate FROM jm"


def _spread(x: str) -> str:
    return f"CASE WHEN max({x}) OVER () > min({x}) OVER () THEN ({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ()) * 100 ELSE 50.0E0 END"


_ALL = f"WITH jm AS ({_JM}), tr AS ({_TRENDS}), sh AS ({_SHARES}), am AS (SELECT sh.*, tr.* EXCLUDE (juris), total_fatal_serious_injury * 1.0E0 / total_crash * 1000 AS s1, total_ped_crash * 0.5E0 + total_bike_crash * 0.3E0 + total_motorcycle_crash * 0.2E0 AS s3, CAST(total_epdo AS DOUBLE) AS s5 FROM sh JOIN tr ON sh.juris = tr.juris), sc AS (SELECT * EXCLUDE (s1, s3, s5), round(0.0E0 + ({_spread('s1')}) * 0.40E0 + ({_spread('trend_fatal')}) * 0.25E0 + ({_spread('s3')}) * 0.15E0 + ({_spread('pct_impaired_crash')}) * 0.10E0 + ({_spread('s5')}) * 0.10E0, 1) AS safety_score FROM am)"
_LONG = _ALL + ", lg AS (" + " UNION ALL ".join(f"SELECT juris, district, mpo, planning, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM sc" for m in rank.METRICS) + "), sp AS (SELECT juris, metric, value, 'Juris' AS scope, 'all' AS scope_id FROM lg UNION ALL SELECT juris, metric, value, 'District', district FROM lg UNION ALL SELECT juris, metric, value, 'MPO', mpo FROM lg UNION ALL SELECT juris, metric, value, 'PlanningDistrict', planning FROM lg), rk AS (SELECT juris, scope, scope_id, metric, value, rank() OVER (PARTITION BY scope, scope_id, metric ORDER BY value DESC) AS rank FROM sp WHERE scope_id <> '')"


@query("jurisdiction_metrics", _JM, "crashes")
def _jm(spark, d):
    return rank.jurisdiction_metrics(crashes(spark, d))


@query("trend_metrics", _TRENDS, "crashes")
def _trends(spark, d):
    return rank.trend_metrics(crashes(spark, d))


@query("proportion_severity_metrics", f"WITH jm AS ({_JM}) SELECT juris, pct_night_fatal, pct_impaired_crash, pct_distracted_crash, pct_speed_crash, severity_index, fatality_rate FROM ({_SHARES})", "crashes")
def _shares(spark, d):
    return rank.share_metrics(rank.jurisdiction_metrics(crashes(spark, d))).select("juris", *rank.SHARES)


@query("safety_score_minmax", _ALL + " SELECT juris, safety_score FROM sc", "crashes")
def _safety(spark, d):
    return rank.all_metrics(crashes(spark, d)).select("juris", "safety_score")


@query("rank_scopes", _LONG + " SELECT * FROM rk", "crashes")
def _ranks(spark, d):
    return rank.rank_scopes(rank.all_metrics(crashes(spark, d)))


_COLS = [f"{s}_Rank_{m}" for m in rank.METRICS for s in rank.SCOPES]


@query("join_rankings_back", _LONG + ", pv AS (SELECT juris, " + ", ".join(f"min(rank) FILTER (WHERE scope = '{c.split('_Rank_')[0]}' AND metric = '{c.split('_Rank_')[1]}') AS {c}" for c in _COLS) + " FROM rk GROUP BY juris) SELECT id, pv.* FROM crashes LEFT JOIN pv USING (juris)", "crashes")
def _back(spark, d):
    c = crashes(spark, d)
    return rank.join_back(c.select("id", "juris"), rank.rank_columns(rank.rank_scopes(rank.all_metrics(c))))


_ASSET = "SELECT node, total_crashes, ksi, fatal, ped, bike, rank() OVER (ORDER BY {o}) AS safety_rank FROM (SELECT node, count(*) AS total_crashes, count(*) FILTER (WHERE severity IN ('K', 'A')) AS ksi, count(*) FILTER (WHERE severity = 'K') AS fatal, count(*) FILTER (WHERE is_ped) AS ped, count(*) FILTER (WHERE is_bike) AS bike FROM crashes WHERE node <> '' GROUP BY node)"


@query("rank_assets", _ASSET.format(o="ksi DESC, total_crashes DESC"), "crashes")
def _rank_assets(spark, d):
    return rank.rank_assets(crashes(spark, d).where("node <> ''"), "node", [F.desc("ksi"), F.desc("total_crashes")], ["ped", "bike"])


@query("safety_ranking_views", """WITH a AS (SELECT node, count(*) AS total, count(*) FILTER (WHERE severity IN ('K', 'A')) AS ksi, count(*) FILTER (WHERE is_ped) + count(*) FILTER (WHERE is_bike) AS vru, count(*) FILTER (WHERE is_night) AS night, count(*) FILTER (WHERE is_speed) AS speed FROM crashes WHERE node <> '' GROUP BY node),
n AS (SELECT node, total, ksi, round((0.40E0 * coalesce(ksi * 1.0E0 / nullif(max(ksi) OVER (), 0), 0) + 0.25E0 * coalesce(vru * 1.0E0 / nullif(max(vru) OVER (), 0), 0) + 0.15E0 * coalesce(night * 1.0E0 / nullif(max(night) OVER (), 0), 0) + 0.10E0 * coalesce(speed * 1.0E0 / nullif(max(speed) OVER (), 0), 0)) * 100, 2) AS safety_score FROM a) SELECT *, rank() OVER (ORDER BY safety_score DESC) AS safety_rank FROM n""", "crashes")
def _views(spark, d):
    yes = agg.yes
    a = crashes(spark, d).where("node <> ''").groupBy("node").agg(F.count("*").alias("total"), yes(F.col("severity").isin("K", "A")).alias("ksi"), (yes(F.col("is_ped")) + yes(F.col("is_bike"))).alias("vru"), yes(F.col("is_night")).alias("night"), yes(F.col("is_speed")).alias("speed"))
    w = {"ksi": 0.40, "vru": 0.25, "night": 0.15, "speed": 0.10}
    score = sum((F.lit(x) * F.col(f"{k}_share") for k, x in list(w.items())[1:]), F.lit(w["ksi"]) * F.col("ksi_share"))
    scored = rank.max_normalised(a, *w).select("node", "total", "ksi", F.round(score * 100, 2).alias("safety_score"))
    return session.ranked(scored, "safety_rank", F.desc("safety_score"))


@query("max_normalise", "SELECT route, round(coalesce(n * 1.0E0 / nullif(max(n) OVER (), 0), 0), 6) AS share FROM (SELECT route, count(*) AS n FROM crashes GROUP BY route)", "crashes")
def _norm(spark, d):
    return rank.max_normalised(crashes(spark, d).groupBy("route").agg(F.count("*").alias("n")), "n").select("route", F.round("n_share", 6).alias("share"))


@query("top_n_per_group", f"SELECT * FROM (SELECT region, route, total, {SCORED}, row_number() OVER (PARTITION BY region ORDER BY K * 883 + A * 94 + B * 21 + C * 11 + O DESC, route) AS place FROM (SELECT region, route, count(*) AS total, {SEV} FROM crashes WHERE route <> '' GROUP BY region, route)) WHERE place <= 10", "crashes")
def _top_n(spark, d):
    return agg.top_routes(crashes(spark, d), "region", 10)


@query("trend_slope", "WITH c AS (SELECT juris, month, count(*) AS n FROM crashes GROUP BY ALL), s AS (SELECT juris, n, row_number() OVER (PARTITION BY juris ORDER BY month) AS x FROM c) SELECT juris, round(regr_slope(n, x), 6) AS slope FROM s GROUP BY juris", "crashes")
def _slope(spark, d):
    s = crashes(spark, d).groupBy("juris", "month").agg(F.count("*").alias("n")).withColumn("x", F.row_number().over(Window.partitionBy("juris").orderBy("month")))
    return s.groupBy("juris").agg(F.round(F.regr_slope("n", "x"), 6).alias("slope"))


@query("seasonal_risk_rank", "SELECT moy, epdo, row_number() OVER (ORDER BY epdo DESC, moy) AS place FROM (SELECT CAST(month(crash_date) AS INT) AS moy, CAST(sum(epdo) AS BIGINT) AS epdo FROM crashes GROUP BY 1)", "crashes")
def _seasonal(spark, d):
    m = crashes(spark, d).groupBy(F.month("crash_date").alias("moy")).agg(F.sum("epdo").cast("long").alias("epdo"))
    return m.withColumn("place", F.row_number().over(Window.orderBy(F.desc("epdo"), "moy")).cast("long"))
