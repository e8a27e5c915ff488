"""Outlook of a scope (a jurisdiction, region or state): its targets forecast together, reconciled, and what follows.

Targets of one scope lie in one long table (scope, target, key, month, value): all crashes, severities, collision types,
location types, contributing factors, and the routes with the most crashes.  One pass over the crashes counts them all;
months without crashes are zeros.  Every series is forecast by itself (:func:`kerbline.operators.forecast.forecast`);
severities, types and location types, of which each crash has one, can then be scaled to add up to their scope's total.

:func:`figures` derives ten figures as a long table: scope, figure, key, measure, value, label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.functions.severity import CLASSES, EPDO_WEIGHTS
from kerbline.operators.forecast import QUANTILES, backtest, forecast

SERIES = ["scope", "target", "key"]
#: Targets whose keys share out the crashes among them.
PARTS = ("severity", "type", "location")
HALF = 6
_BETWEEN = "\x1f"


def top_routes(crashes: DataFrame, scope: str, n: int = 10) -> DataFrame:
    """scope, route of the routes with the most crashes (ties: by name)."""
    counts = crashes.where("route <> ''").groupBy(F.col(scope).alias("scope"), "route").agg(F.count("*").alias("n"))
    return counts.withColumn("r", F.row_number().over(Window.partitionBy("scope").orderBy(F.desc("n"), "route"))).where(F.col("r") <= n).select("scope", "route")


def monthly(crashes: DataFrame, scope: str, kind: Column, location: Column, factors: dict[str, Column], n_routes: int = 10) -> DataFrame:
    """scope, target, key, month, value of all targets, zeros included; months run from a scope's first to its last.

    crashes: the scope's column, month, severity, route.  Each crash counts in its total, severity, type, location, the
    factors that hold, and its route if that is among the first; counts are added up before anything is shuffled.
    """
    entry = lambda target, key: F.struct(F.lit(target).alias("target"), key.alias("key"))
    mine = [entry("total", F.lit("all")), entry("severity", F.col("severity")), entry("type", kind), entry("location", location), *[F.when(F.coalesce(c, F.lit(False)), entry("factor", F.lit(k))) for k, c in factors.items()], F.when(F.col("route") != "", entry("corridor", F.col("route")))]
    counts = crashes.select(F.col(scope).alias("scope"), "month", F.inline(F.array_compact(F.array(*mine)))).groupBy(*SERIES, "month").agg(F.count("*").alias("value"))
    routes = top_routes(crashes, scope, n_routes).select(F.col("scope").alias("_s"), F.col("route").alias("_k"))
    wanted = counts.join(F.broadcast(routes), (F.col("scope") == F.col("_s")) & (F.col("key") == F.col("_k")), "left").where((F.col("target") != "corridor") | F.col("_k").isNotNull()).drop("_s", "_k")  # n_routes rows a scope
    months = Window.partitionBy("scope")
    series = wanted.withColumns({"_a": F.min("month").over(months), "_b": F.max("month").over(months)}).groupBy(*SERIES, "_a", "_b").agg(F.map_from_entries(F.collect_list(F.struct("month", "value"))).alias("_v"))
    filled = series.select(*SERIES, "_v", F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return filled.select(*SERIES, "month", F.coalesce(F.try_element_at("_v", F.col("month")), F.lit(0)).alias("value"))


def forecast_all(history: DataFrame, horizon: int = 12) -> DataFrame:
    """scope, target, key, month and the quantiles."""
    told = forecast(history.select(F.concat_ws(_BETWEEN, *SERIES).alias("series"), "month", "value"), horizon)
    part = F.split("series", _BETWEEN)
    return told.select(*[F.get(part, F.lit(k)).alias(c) for k, c in enumerate(SERIES)], "month", *QUANTILES)


def reconciled(forecasts: DataFrame) -> DataFrame:
    """Forecasts in which the keys of each of :data:`PARTS` add up to the scope's total, quantile by quantile.

    Keys are scaled alike; where all are zero the total is shared out evenly.  Factors and routes, which share nothing
    out, stay as they are.
    """
    total = forecasts.where("target = 'total'").select(F.col("scope").alias("_s"), F.col("month").alias("_m"), *[F.col(q).alias(f"_{q}") for q in QUANTILES])
    group = Window.partitionBy("scope", "target", "month")
    rows = forecasts.withColumns({f"sum_{q}": F.sum(q).over(group) for q in QUANTILES} | {"n": F.count("*").over(group)})
    rows = rows.join(total, (F.col("scope") == F.col("_s")) & (F.col("month") == F.col("_m")) & F.col("target").isin(*PARTS), "left")
    scaled = lambda q: F.when(F.col("_s").isNull(), F.col(q)).when(F.col(f"sum_{q}") > 0, F.col(q) * F.col(f"_{q}") / F.col(f"sum_{q}")).otherwise(F.col(f"_{q}") / F.col("n"))
    return rows.select(*SERIES, "month", *[scaled(q).alias(q) for q in QUANTILES])


def _change(now: Column, before: Column) -> Column:
    """Percent of change; 0 where nothing was before."""
    return F.when(before == 0, 0.0).otherwise(F.round((now - before) / F.greatest(before, F.lit(1)) * 100, 1))


def _rows(df: DataFrame, figure: str, key: Column, measures: dict[str, Column], label: Column) -> DataFrame:
    entries = [F.struct(F.lit(m).alias("measure"), c.cast("double").alias("value")) for m, c in measures.items()]
    return df.select("scope", F.lit(figure).alias("figure"), key.cast("string").alias("key"), label.alias("label"), F.inline(F.array(*entries))).select("scope", "figure", "key", "measure", "value", "label")


def figures(history: DataFrame, forecasts: DataFrame, preset: str = "fhwa2025") -> DataFrame:
    """The ten figures; ``label`` is the figure's reading.  Sums of six months are of the last six seen and the next six.

    confidence_width, epdo_forecast, ka_forecast, severity_shift, corridor_movement (per route), type_momentum (per type),
    factor_trend (per factor), risk_calendar (per month), composite_risk, location_split.
    """
    weights = EPDO_WEIGHTS[preset]
    one, c = Window.partitionBy(*SERIES), F.col
    seen = history.withColumn("r", F.row_number().over(one.orderBy(F.desc("month")))).groupBy(*SERIES).agg(
        F.sum(F.when(c("r") <= HALF, c("value"))).alias("last"), F.coalesce(F.sum(F.when((c("r") > HALF) & (c("r") <= 2 * HALF), c("value"))), F.lit(0)).alias("before"), F.sum("value").alias("total"), F.count("*").alias("months"),
    )
    ahead = forecasts.withColumn("i", F.row_number().over(one.orderBy("month")))
    soon = lambda x: F.sum(F.when(c("i") <= HALF, x))
    told = ahead.groupBy(*SERIES).agg(
        soon(c("p50")).alias("next"), F.count(F.when(c("i") <= HALF, 1)).alias("n_next"), soon(c("p90") - c("p10")).alias("spread"), F.avg(F.round(c("p90") - c("p10"), 1)).alias("width"), F.avg("p50").alias("mean"), F.coalesce(F.regr_slope("p50", "i"), F.lit(0.0)).alias("slope"),
    )
    both = seen.join(told, SERIES)
    enough = F.when(c("months") >= HALF, c("last")).otherwise(0)
    out = []

    # By scope: severities and totals side by side.
    of = lambda x, target, key=None: F.coalesce(F.sum(F.when((c("target") == target) & (F.lit(True) if key is None else c("key") == key), x)), F.lit(0))
    scopes = both.groupBy("scope").agg(
        of(c("width"), "total").alias("width"), of(c("mean"), "total").alias("mean"), of(c("last"), "total").alias("last"), of(c("before"), "total").alias("before"), of(c("months"), "total").alias("months"), of(c("next"), "total").alias("next"),
        *[of(c(x), "severity", k).alias(f"{x}_{k}") for x in ("last", "total", "next") for k in CLASSES],
        F.coalesce(F.sum(F.when((c("target") == "location") & c("key").isin("four_leg", "three_leg", "roundabout"), c("next"))), F.lit(0.0)).alias("crossing"), of(c("next"), "location").alias("everywhere"),
    )
    severe = ahead.where("target = 'severity'").groupBy("scope", "month").agg(F.round(F.sum(sum((F.when(c("key") == k, c("p50") * w).otherwise(0.0) for k, w in weights.items()), F.lit(0.0)))).alias("epdo"), F.sum(F.when(c("key").isin("K", "A"), c("p50")).otherwise(0.0)).alias("ka"))
    calendar = ahead.where("target = 'total'").select("scope", "month", "i", F.col("p50").alias("total")).join(severe, ["scope", "month"])
    half = calendar.where(c("i") <= HALF).groupBy("scope").agg(F.sum("epdo").alias("epdo_next"), F.sum(F.round("ka", 1)).alias("ka_next"))
    s = scopes.join(half, "scope")

    width, share = F.round("width", 1), lambda part, whole: F.round(part / F.greatest(whole, F.lit(1)) * 100, 2)
    cv = F.round(width / F.greatest(c("mean"), F.lit(1)) * 100, 1)
    out.append(_rows(s, "confidence_width", F.lit(""), {"avg_width": width, "variation": cv}, F.when(cv < 30, "low").when(cv < 60, "moderate").otherwise("high")))
    epdo_last = sum((c(f"last_{k}") * w for k, w in weights.items()), F.lit(0))
    epdo_change = _change(c("epdo_next"), epdo_last)
    out.append(_rows(s, "epdo_forecast", F.lit(""), {"predicted": c("epdo_next"), "historical": epdo_last, "change_pct": epdo_change}, F.lit("")))
    ka_last = c("last_K") + c("last_A")
    out.append(_rows(s, "ka_forecast", F.lit(""), {"predicted": F.round("ka_next", 1), "historical": ka_last}, F.when(c("ka_next") > ka_last, "worsening").otherwise("improving")))
    rounded = {k: F.round(f"next_{k}") for k in CLASSES}
    was = share(c("total_K") + c("total_A"), sum((c(f"total_{k}") for k in CLASSES), F.lit(0)))
    will = share(rounded["K"] + rounded["A"], sum(rounded.values(), F.lit(0)))
    shift = F.round(will - was, 2)
    out.append(_rows(s, "severity_shift", F.lit(""), {"historical": was, "predicted": will, "shift": shift}, F.when(shift > 0.5, "worsening").when(shift > -0.5, "stable").otherwise("improving")))
    trend = F.when(c("months") >= 2 * HALF, (c("last") - c("before")) / F.greatest(c("before"), F.lit(1)) * 100).otherwise(0.0)
    score = F.round(epdo_change * 0.5 + trend * 0.3 + shift * 10 * 0.2, 1)
    out.append(_rows(s, "composite_risk", F.lit(""), {"score": score, "total_trend": F.round(trend, 1), "severity_shift": shift, "epdo_change": epdo_change}, F.when(score > 10, "critical").when(score > 5, "elevated").when(score > -5, "moderate").otherwise("low")))
    crossing, elsewhere = c("crossing"), c("everywhere") - c("crossing")
    part = lambda x: F.round(x / F.greatest(c("everywhere"), F.lit(1)) * 100, 1)
    out.append(_rows(s, "location_split", F.lit(""), {"intersection": F.round(crossing), "segment": F.round(elsewhere), "intersection_pct": part(crossing), "segment_pct": part(elsewhere)}, F.lit("")))

    # By key: routes with their places, types, factors; a scope has some of each.
    routes = both.where("target = 'corridor'").withColumns({"past": enough / HALF, "ahead": c("next") / F.greatest(c("n_next"), F.lit(1))})
    routes = routes.withColumns({"change": F.round((c("ahead") - c("past")) / F.greatest(c("past"), F.lit(1)) * 100, 1), "past1": F.round("past", 1), "ahead1": F.round("ahead", 1)})
    place = lambda x: F.row_number().over(Window.partitionBy("scope").orderBy(F.desc(x), "key"))
    routes = routes.withColumns({"past_rank": place("past1"), "ahead_rank": place("ahead1")})
    out.append(_rows(routes, "corridor_movement", c("key"), {"historical": c("past1"), "predicted": c("ahead1"), "change_pct": c("change"), "width": F.round(c("spread") / HALF, 1), "historical_rank": c("past_rank"), "predicted_rank": c("ahead_rank"), "moved": c("past_rank") - c("ahead_rank")}, F.when(c("change") > 5, "rising").when(c("change") < -5, "falling").otherwise("stable")))
    by_key = lambda target: both.where(c("target") == target).withColumns({"was": enough, "change": _change(c("next"), enough)})
    out.append(_rows(by_key("type"), "type_momentum", c("key"), {"historical": c("was"), "predicted": F.round("next"), "change_pct": c("change"), "slope": F.round("slope", 2), "total": c("total")}, F.when(c("change") > 10, "accelerating").when(c("change") < -10, "decelerating").otherwise("steady")))
    factors = by_key("factor").join(scopes.select("scope", F.col("next").alias("all_next")), "scope")
    out.append(_rows(factors, "factor_trend", c("key"), {"historical": c("was"), "predicted": F.round("next"), "change_pct": c("change"), "involvement_pct": F.round(c("next") / F.greatest(c("all_next"), F.lit(1)) * 100, 1), "total": c("total")}, F.lit("")))
    risk = calendar.withColumn("risk_rank", F.row_number().over(Window.partitionBy("scope").orderBy(F.desc("epdo"), "month")))
    last = F.max("risk_rank").over(Window.partitionBy("scope"))
    risk = risk.withColumn("label", F.when(c("risk_rank") == 1, "highest").when(c("risk_rank") == last, "lowest").otherwise(""))
    out.append(_rows(risk, "risk_calendar", c("month"), {"total": F.round("total", 1), "ka": F.round("ka", 1), "epdo": c("epdo"), "risk_rank": c("risk_rank")}, c("label")))
    both = out[0]
    for x in out[1:]:
        both = both.unionByName(x)
    return both


# The worth of a grade, the weight of each target, and the best score of each overall grade.
WORTH, WEIGHTS = {"A": 1.0, "B": 2.0, "C": 3.0, "D": 4.0}, {"total": 0.5, "severity": 0.3, "corridor": 0.2}
OVERALL = ((1.5, "A"), (2.5, "B"), (3.5, "C"))


def overall_grades(history: DataFrame, hold: int = HALF) -> DataFrame:
    """scope, grade, score and the mean worth of each target, from backtests of the total, the severities and the routes.

    Grades are worth 1 to 4; what has no grade (or a worse one) counts as 3 by itself, keys without one are left out of
    a target's mean, and a target without any graded key is worth 3.
    """
    series = history.where(F.col("target").isin(*WEIGHTS)).select(F.concat_ws(_BETWEEN, *SERIES).alias("series"), "month", "value")
    part = F.split("series", _BETWEEN)
    told = backtest(series, hold).select(F.get(part, F.lit(0)).alias("scope"), F.get(part, F.lit(1)).alias("target"), "grade")
    worth = F.lit(3.0)
    for grade, value in WORTH.items():
        worth = F.when(F.col("grade") == grade, value).otherwise(worth)
    counted = (F.col("grade") != "N/A") | (F.col("target") == "total")
    means = told.groupBy("scope").agg(*[F.coalesce(F.avg(F.when((F.col("target") == t) & counted, worth)), F.lit(3.0)).alias(t) for t in WEIGHTS])
    score = sum((F.col(t) * w for t, w in WEIGHTS.items()), F.lit(0.0))
    grade = F.when(F.lit(False), "")
    for top, g in OVERALL:
        grade = grade.when(score < top, g)
    return means.select("scope", grade.otherwise("D").alias("grade"), F.round(score, 4).alias("score"), *[F.round(t, 4).alias(t) for t in WEIGHTS])
