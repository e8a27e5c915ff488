"""Checks and repairs of crash tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def route_medians(crashes: DataFrame) -> DataFrame:
    """The middle crash of each route by longitude (the upper one of two), with the route's count and confidence.

    Crashes at one position are counted before a route's positions are put in order.
    """
    there = crashes.groupBy("route", "lon", "lat").agg(F.count("*").alias("there"))
    order, whole = Window.partitionBy("route").orderBy("lon", "lat"), Window.partitionBy("route")
    rows = there.withColumns({"r": F.sum("there").over(order.rowsBetween(Window.unboundedPreceding, 0)), "n": F.sum("there").over(whole)})
    middle = F.floor(F.col("n") / 2) + 1
    rows = rows.where((F.col("r") >= middle) & (F.col("r") - F.col("there") < middle))
    return rows.select("route", "lon", "lat", "n", F.when(F.col("n") >= 10, "high").when(F.col("n") >= 3, "medium").otherwise("low").alias("confidence"))


def percentile_bounds(crashes: DataFrame, least: int = 100, margin: float = 0.05) -> DataFrame:
    """2 % and 98 % positions widened by a margin; no row for fewer than ``least`` points."""
    at = lambda c, p: F.percentile(c, F.lit(p))
    one = crashes.agg(F.count("*").alias("n"), *[at(c, p).alias(f"{c}_{s}") for c in ("lat", "lon") for s, p in (("min", 0.02), ("max", 0.98))]).where(F.col("n") >= least)
    return one.select(*[F.round(F.col(f"{c}_{s}") + (margin if s == "max" else -margin), 4).alias(f"{c}_{s}") for c in ("lat", "lon") for s in ("min", "max")])


def issues(rows: DataFrame, row_id: str, checks: dict[str, tuple]) -> DataFrame:
    """Long table of what is wrong: row_id, check, severity, field, value.

    checks: name -> (severity, field, condition).  All are evaluated in one pass over the rows.
    """
    found = F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(name).alias("check"), F.lit(sev).alias("severity"), F.lit(field).alias("field"), F.col(field).cast("string").alias("value"))) for name, (sev, field, cond) in checks.items()]))
    return rows.select(F.col(row_id).alias("row_id"), F.explode(found).alias("x")).select("row_id", "x.*")


def row_rules(severities=("K", "A", "B", "C", "O")) -> dict[str, tuple]:
    """Required fields, severity set, date and coordinate range."""
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
    return {
        "missing_severity": ("error", "severity", blank("severity")), "bad_severity": ("error", "severity", ~blank("severity") & ~F.col("severity").isin(*severities)),
        "missing_route": ("warning", "route", blank("route")), "missing_node": ("info", "node", blank("node")),
        "date_range": ("error", "crash_date", ~F.col("crash_date").between("1990-01-01", "2100-01-01")),
        "latitude_range": ("error", "lat", ~F.col("lat").between(17, 72)), "longitude_range": ("error", "lon", ~F.col("lon").between(-180, -65)),
    }


def check_severity(rows: DataFrame) -> DataFrame:
    """The class that the people hurt ask for, and whether it was changed."""
    from kerbline.functions.severity import severity_from_counts

    told = severity_from_counts(*[F.col(f"{k}_people") for k in "kabc"])
    return rows.withColumns({"severity_old": F.col("severity"), "severity": F.when(told != "O", told).otherwise(F.col("severity"))}).withColumn("severity_fixed", F.col("severity") != F.col("severity_old"))


def fix_swapped(rows: DataFrame) -> DataFrame:
    """Latitude and longitude that stand in each other's place are put right."""
    swapped = F.col("lat").between(-180, -65) & F.col("lon").between(17, 72)
    return rows.withColumns({"lat": F.when(swapped, F.col("lon")).otherwise(F.col("lat")), "lon": F.when(swapped, F.col("lat")).otherwise(F.col("lon")), "swapped": F.coalesce(swapped, F.lit(False))})


def fix_gps_route_median(rows: DataFrame) -> DataFrame:
    """Missing positions from the middle crash of the route."""
    known = rows.where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & (F.col("route") != ""))
    m = route_medians(known).select("route", F.col("lat").alias("m_lat"), F.col("lon").alias("m_lon"))
    fixed = F.col("lat").isNull() & F.col("m_lat").isNotNull()
    return rows.join(m, "route", "left").select("id", F.coalesce("lat", "m_lat").alias("lat"), F.coalesce("lon", "m_lon").alias("lon"), fixed.alias("fixed"))


# How far an asset of each kind may lie to count as near, in feet.
NEAR_FT = {
    "nearest_bridge_": 500, "nearest_rail_xing_": 500, "nearest_school_": 2000, "nearest_transit_": 500, "nearest_poi_bar_": 2000, "nearest_poi_clinic_": 2000, "nearest_poi_college_": 2000, "nearest_poi_crossing_": 500, "nearest_poi_fuel_": 1000,
    "nearest_poi_hospital_": 2000, "nearest_poi_parking_": 500, "nearest_poi_rest_area_": 1000, "nearest_poi_restaurant_": 1000, "nearest_poi_signal_": 500, "nearest_poi_stop_sign_": 500,
}


def blank_beyond(rows: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    """Assets beyond their limit aren't near: ``<prefix>dist_ft`` becomes 0, other columns of the prefix 0 or null by type.

    Kinds whose distance the table lacks are left alone; a null distance counts as 0.  One projection.
    """
    new, kinds = {}, {f.name: f.dataType.typeName() for f in rows.schema}
    for prefix, limit in (limits or NEAR_FT).items():
        dist = f"{prefix}dist_ft"
        if dist not in kinds:
            continue
        far = F.coalesce(F.col(dist) > limit, F.lit(False))
        for c in rows.columns:
            if c.startswith(prefix):
                number = kinds[c] in ("byte", "short", "integer", "long", "float", "double", "decimal")
                new[c] = F.when(~far, F.coalesce(F.col(c), F.lit(0).cast(rows.schema[c].dataType)) if c == dist else F.col(c)).otherwise(F.lit(0 if number else None).cast(rows.schema[c].dataType))
    return rows.withColumns(new)


def sanity(rows: DataFrame, checks: dict) -> DataFrame:
    """check, passed, total, pct of range rules: one aggregation, then turned to rows."""
    one = rows.agg(F.count("*").alias("total"), *[F.count(F.when(c, 1)).alias(k) for k, c in checks.items()])
    turned = one.select("total", F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("passed")) for k in checks])).alias("x"))
    return turned.select("x.check", "x.passed", "total", F.round(F.col("x.passed") / F.col("total") * 100, 1).alias("pct"))
