"""Roll-ups: counts by severity and flag, hotspots, county figures, scope roll-ups, series.

All are one or two hash aggregations with partial sums before the shuffle; what is ranked or limited is already
grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.functions.severity import CLASSES, epdo_of_counts


def yes(c: Column) -> Column:
    """How many rows a condition holds in, as long."""
    return F.count(F.when(c, 1))


def severity_counts() -> list[Column]:
    return [F.count("*").alias("total"), *[yes(F.col("severity") == k).alias(k) for k in CLASSES]]


def scored(counts: DataFrame, preset: str = "fhwa2025") -> DataFrame:
    return counts.withColumn("epdo", epdo_of_counts(preset)).withColumn("ka", F.col("K") + F.col("A"))


def hotspots(crashes: DataFrame, top: int = 50, preset: str = "fhwa2025") -> DataFrame:
    """route, node, counts, epdo, ka of the worst locations; crashes without a route are left out."""
    by = crashes.where(F.coalesce("route", F.lit("")) != "").groupBy("route", F.coalesce("node", F.lit("")).alias("node")).agg(*severity_counts())
    return scored(by, preset).orderBy(F.desc("epdo"), "route", "node").limit(top)


def by_severity(crashes: DataFrame, *keys: str, preset: str = "fhwa2025") -> DataFrame:
    return scored(crashes.groupBy(*keys).agg(*severity_counts()), preset)


def county_totals(crashes: DataFrame, key: str = "juris") -> DataFrame:
    flags = [yes(F.col(f"is_{k}")).alias(f"{k}_crashes") for k in ("ped", "bike", "speed", "alcohol")]
    return scored(crashes.groupBy(key).agg(*severity_counts(), *flags))


def top_values(crashes: DataFrame, value: str, key: str = "juris", top: int = 10) -> DataFrame:
    """The most frequent values per group with their share in percent of the group; ties by value."""
    n = crashes.groupBy(key, value).agg(F.count("*").alias("n"))
    whole, order = Window.partitionBy(key), Window.partitionBy(key).orderBy(F.desc("n"), value)
    shares = n.withColumns({"pct": F.round(F.col("n") / F.sum("n").over(whole) * 100, 1), "place": F.row_number().over(order).cast("long")})
    return shares.where((F.col("place") <= top) & F.col(value).isNotNull() & (F.col(value).cast("string") != ""))


def top_routes(crashes: DataFrame, key: str = "juris", top: int = 25) -> DataFrame:
    routes = by_severity(crashes.where(F.col("route") != ""), key, "route")
    return routes.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("epdo"), "route")).cast("long")).where(F.col("place") <= top)


def yearly_trend(crashes: DataFrame, key: str = "juris") -> DataFrame:
    """Counts per group and year with the relative change on the year before."""
    years = by_severity(crashes.where(F.col("year").isNotNull()), key, "year")
    before = F.lag("total").over(Window.partitionBy(key).orderBy("year"))
    return years.withColumn("change", F.when(before > 0, F.round((F.col("total") - before) / before, 4)))


def rollup_scopes(crashes: DataFrame, bridge: DataFrame, key: str = "fips") -> DataFrame:
    """Counts per tier and entity: each county's counts are made once, then given to every entity it belongs to.

    bridge: tier, entity, ``key``.  The join carries one row per county, not crashes.
    """
    county = crashes.groupBy(key).agg(*severity_counts())
    members = bridge.join(county, key).groupBy("tier", "entity").agg(*[F.sum(c).alias(c) for c in ("total", *CLASSES)], F.count("*").alias("members"))
    return scored(members)


def dominant_member(crashes: DataFrame, location: list[str], member: str = "juris") -> DataFrame:
    """Per location the member with most crashes (ties: the first by name) and how many members it has."""
    n = crashes.where(F.col("route") != "").groupBy(*location, member).agg(F.count("*").alias("n"))
    best = n.groupBy(*location).agg(F.min(F.struct((-F.col("n")).alias("minus"), F.col(member).alias("m"))).alias("b"), F.count("*").alias("members"), F.sum("n").alias("total"))
    return best.select(*location, F.col("b.m").alias("dominant"), (-F.col("b.minus")).alias("dominant_n"), "members", "total")


def monthly_series(crashes: DataFrame, group: str) -> DataFrame:
    """Crashes per group and month over every month between the first and the last of the whole table, zeros filled in."""
    counted = crashes.groupBy(group, "month").agg(F.count("*").alias("n"))
    span = counted.agg(F.min("month").alias("a"), F.max("month").alias("b")).where("a IS NOT NULL").select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    spine = counted.select(group).distinct().join(F.broadcast(span))  # months of the table's years: some hundreds
    return spine.join(counted, [group, "month"], "left").select(group, "month", F.coalesce("n", F.lit(0)).alias("n"))


def pattern_matrix(crashes: DataFrame) -> DataFrame:
    """Collision type by severity: counts, shares of the row, EPDO and the share of K and A."""
    m = by_severity(crashes, "collision")
    return m.select("collision", "total", *CLASSES, *[F.round(F.col(k) / F.col("total") * 100, 1).alias(f"pct_{k}") for k in CLASSES], "epdo", F.round(F.col("ka") / F.col("total") * 100, 1).alias("ka_rate"))


def person_weighted_epdo(crashes: DataFrame) -> DataFrame:
    """Per node: people hurt by class at the crash-cost weights, one for each crash."""
    w = {"k": 883, "a": 94, "b": 21, "c": 11}
    return crashes.where(F.col("node") != "").groupBy("node").agg((sum((F.sum(f"{k}_people") * n for k, n in w.items()), F.count("*"))).alias("epdo"), F.count("*").alias("total"))


def persons_to_case(persons: DataFrame) -> DataFrame:
    """Any, sum, min and max of person flags per (st_case, year); unknown restraint counts as unrestrained."""
    fatal, typ = F.col("inj_sev") == 4, F.col("per_typ")
    drunk = (F.col("drinking") == 1) | F.col("alc_res").between(8, 94)
    loose = F.coalesce(~F.col("rest_use").isin(3, 7), F.lit(True))
    age = F.when(typ == 1, F.col("age"))
    some = lambda c: F.coalesce(F.max(c), F.lit(False))
    return persons.groupBy("st_case", "year").agg(
        some(drunk).alias("any_drunk"), some(loose).alias("any_unrestrained"), some(typ == 5).alias("ped_involved"), some(typ == 6).alias("bike_involved"),
        yes((typ == 5) & fatal).alias("ped_fatals"), yes((typ == 6) & fatal).alias("bike_fatals"), yes(fatal).alias("total_fatalities"),
        F.min(age).alias("youngest_driver_age"), F.max(age).alias("oldest_driver_age"),
    )


def vehicles_to_case(vehicles: DataFrame) -> DataFrame:
    some = lambda c: F.coalesce(F.max(c), F.lit(False))
    body = F.col("body_typ")
    return vehicles.groupBy("st_case", "year").agg(
        some(F.col("speedrel").between(1, 5)).alias("any_speeding"), some(body.between(60, 79)).alias("any_large_truck"), some(body.between(80, 89)).alias("any_motorcycle"),
        some(F.col("mdrdstrd").isNotNull() & ~F.col("mdrdstrd").isin(0, 96, 99)).alias("any_distracted"), some(F.col("hit_run").isin(1, 2)).alias("hit_and_run"),
    )


def join_fact_aggregates(accidents: DataFrame, persons: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Accidents with the figures of their persons and vehicles; flags of cases without any are false, counts 0."""
    out = accidents.join(persons_to_case(persons), ["st_case", "year"], "left").join(vehicles_to_case(vehicles), ["st_case", "year"], "left")
    fill = {f.name: (F.lit(False) if f.dataType.simpleString() == "boolean" else F.lit(0)) for f in out.schema if f.name.startswith(("any_", "ped_", "bike_", "hit_", "total_f"))}
    return out.withColumns({k: F.coalesce(F.col(k), v) for k, v in fill.items()})


def federal_summary(crashes: DataFrame) -> DataFrame:
    people = {"total_k": "k_people", "total_a": "a_people", "total_b": "b_people", "total_c": "c_people"}
    flags = {"alcohol_crashes": "alcohol", "speed_crashes": "speed", "distracted_crashes": "distracted", "ped_crashes": "ped", "bike_crashes": "bike", "wz_crashes": "work_zone"}
    return crashes.groupBy("year", "severity", "region", "fc", "ownership", "area_type").agg(
        F.count("*").alias("total_crashes"), *[F.sum(c).alias(n) for n, c in people.items()],
        F.sum(F.col("k_people") + F.col("a_people") + F.col("b_people") + F.col("c_people")).alias("total_injured"), *[yes(F.col(f"is_{c}")).alias(n) for n, c in flags.items()],
    )


def crash_profile(crashes: DataFrame, dimensions: list[str]) -> DataFrame:
    """Counts of every value of every dimension: one scan, one shuffle by (dimension, value)."""
    long = crashes.select(F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions])).alias("x"), "severity")
    return by_severity(long.select("x.*", "severity"), "dimension", "value")


def majority(rows: DataFrame, key: str, value: str, at_least: int = 2) -> DataFrame:
    """The most frequent value of each key, if it occurs often enough; ties: the larger value."""
    n = rows.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.max(F.struct("n", F.col(value).alias("v"))).alias("m")).where(F.col("m.n") >= at_least).select(key, F.col("m.v").alias(value), F.col("m.n").alias("n"))


def completeness(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: rows, filled rows, share in percent; one aggregation, then turned to rows."""
    filled = [yes(F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")).alias(c) for c in columns]
    one = rows.agg(F.count("*").alias("n_rows"), *filled)
    turned = one.select("n_rows", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("filled")) for c in columns])).alias("x"))
    return turned.select("x.column", "n_rows", "x.filled", F.round(F.col("x.filled") / F.col("n_rows") * 100, 1).alias("pct"))


def graph_degree(edges: DataFrame) -> DataFrame:
    """Edge ends per node and the number of different neighbours, for nodes of three or more ends."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u_node").alias("node"), F.col("v_node").alias("other")), F.struct(F.col("v_node").alias("node"), F.col("u_node").alias("other")))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.count("*").alias("degree"), F.countDistinct("other").alias("streets")).where(F.col("degree") >= 3)


def group_median_propagation(segments: DataFrame, value: str = "aadt") -> DataFrame:
    """Blank values from the median of (ref, class), then (name, class), then class, with where each came from."""
    medians, out = [(["ref", "fc_code"], "ref_fc"), (["name", "fc_code"], "name_fc"), (["fc_code"], "fc_median")], segments
    for keys, label in medians:
        m = segments.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.median(value).alias(f"m_{label}"))
        out = out.join(m, keys, "left")
    found = F.coalesce(F.col(value).cast("double"), *[F.col(f"m_{label}") for _, label in medians])
    source = F.when(F.col(value).isNotNull(), "source")
    for _, label in medians:
        source = source.when(F.col(f"m_{label}").isNotNull(), label)
    return out.select("seg_id", found.alias(value), source.otherwise("none").alias("source"))


def unique_values(rows: DataFrame, fields: list[str]) -> DataFrame:
    """field, vals (joined, in order) and n: the distinct filled values of each field, made distinct before they are gathered."""
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("x")).select("x.*")
    each = long.where(F.coalesce("value", F.lit("")) != "").distinct()
    return each.groupBy("field").agg(F.array_join(F.array_sort(F.collect_list("value")), ",").alias("vals"), F.count("*").alias("n"))
