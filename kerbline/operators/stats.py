"""Safety statistics over grouped tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normal_tail(z: Column) -> Column:
    """P(Z > z) for z >= 0 by a rational polynomial (error under 8e-8)."""
    t = 1 / (1 + 0.2316419 * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) * 0.3989422804014327 * poly


def over_representation(local: DataFrame, base: DataFrame, keys: list[str], pattern: str) -> DataFrame:
    """Share of a pattern at a location over its share everywhere, with a binomial test (continuity corrected).

    local: keys, pattern, n; base: pattern, n.
    """
    totals = local.groupBy(*keys).agg(F.sum("n").alias("total"))
    whole = base.agg(F.sum("n").alias("all_n"))
    rates = base.join(F.broadcast(whole)).select(pattern, (F.col("n") / F.col("all_n")).alias("rate"))
    x = local.join(totals, keys).join(rates, pattern)
    expected = F.col("total") * F.col("rate")
    z = F.greatest(F.lit(0.0), F.abs(F.col("n") - expected) - 0.5) / F.sqrt(expected * (1 - F.col("rate")))
    p = F.when(F.col("rate") < 1, F.least(F.lit(1.0), 2 * normal_tail(z))).otherwise(1.0)
    return x.select(*keys, pattern, "n", "total", F.round(F.col("n") / F.col("total") / F.col("rate"), 4).alias("ori"), F.round(p, 6).alias("p_value"))


def potential(observed: DataFrame, dispersion: float = 0.5) -> DataFrame:
    """Empirical-Bayes excess over the mean of all locations, and the count that would be critical."""
    mean = observed.agg(F.avg("n").alias("expected"))
    w = F.lit(dispersion) / (dispersion + F.col("expected"))
    eb = w * F.col("expected") + (1 - w) * F.col("n")
    return observed.join(F.broadcast(mean)).withColumns({"psi": F.round(eb - F.col("expected"), 4), "critical": F.round(F.col("expected") + 1.645 * F.sqrt("expected") + 0.5, 4)}).withColumn("flag", F.col("n") > F.col("critical")).drop("expected")


def before_after(counts: DataFrame) -> DataFrame:
    """CMF, CRF and Poisson z of counts before and after; counts: before_n, after_n, before_years, after_years."""
    expected = F.col("before_n") * F.col("after_years") / F.col("before_years")
    cmf = F.when(F.col("before_n") > 0, F.col("after_n") / expected)
    z = F.when(F.col("before_n") + F.col("after_n") > 0, (F.col("after_n") - expected) / F.sqrt(F.greatest(expected, F.lit(1.0))))
    return counts.withColumns({"expected": F.round(expected, 4), "cmf": F.round(cmf, 4), "crf": F.round((1 - cmf) * 100, 2), "z": F.round(z, 4)})


def baselines(crashes: DataFrame, location: str) -> DataFrame:
    """Mean and deviation of crashes and EPDO per location: two-level aggregation."""
    per = crashes.where(F.col(location) != "").groupBy(location).agg(F.count("*").alias("n"), F.sum("epdo").alias("epdo"))
    return per.agg(F.count("*").alias("locations"), F.round(F.avg("n"), 4).alias("mean_n"), F.round(F.stddev("n"), 4).alias("sd_n"), F.round(F.avg("epdo"), 4).alias("mean_epdo"))


# Hourly volumes of the eight-hour warrant, major and minor road, by lanes (one, or two and more) of each.
WARRANT = {"A": {(1, 1): (500, 150), (2, 1): (600, 150), (2, 2): (600, 200), (1, 2): (500, 200)}, "B": {(1, 1): (750, 75), (2, 1): (900, 75), (2, 2): (900, 100), (1, 2): (750, 100)}}


def signal_warrant(hourly: DataFrame, key: str) -> DataFrame:
    """Whether an intersection meets the eight-hour warrant: key, hours_a, hours_b, reduced, met.

    hourly: a row per key and hour with major, minor (volumes), major_lanes, minor_lanes, speed and population.
    Where the major road is faster than 40 mph or the place has under 10,000 people, 70 % of the volumes will do.
    """
    reduced = (F.col("speed") > 40) | (F.col("population") < 10_000)
    share, lanes = F.when(reduced, 0.7).otherwise(1.0), (F.least("major_lanes", F.lit(2)), F.least("minor_lanes", F.lit(2)))

    def enough(which: str) -> Column:
        hit = F.lit(False)
        for (a, b), (major, minor) in WARRANT[which].items():
            hit = hit | ((lanes[0] == a) & (lanes[1] == b) & (F.col("major") >= share * major) & (F.col("minor") >= share * minor))
        return F.count(F.when(hit, 1))

    out = hourly.groupBy(key).agg(enough("A").alias("hours_a"), enough("B").alias("hours_b"), F.max(reduced).alias("reduced"))
    return out.withColumn("met", (F.col("hours_a") >= 8) | (F.col("hours_b") >= 8))
