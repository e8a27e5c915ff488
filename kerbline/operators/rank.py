"""Rankings of jurisdictions and assets.  Windows run over grouped tables only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.session import kept, ranked

from kerbline.operators.aggregate import yes

#: Scopes of a rank and the column that names the group; the first ranks all jurisdictions against one another.
SCOPES = {"Juris": None, "District": "district", "MPO": "mpo", "PlanningDistrict": "planning"}
COUNTS = ("total_crash", "total_fatal", "total_fatal_serious_injury", "total_ped_crash", "total_bike_crash", "total_epdo")
TRENDS = ("trend_total_crash", "trend_fatal", "trend_ksi", "trend_epdo", "trend_ped_crash", "trend_bike_crash")
SHARES = ("pct_night_fatal", "pct_impaired_crash", "pct_distracted_crash", "pct_speed_crash", "severity_index", "fatality_rate")
METRICS = (*COUNTS, *TRENDS, *SHARES, "safety_score")


_SUMS = ("total_crash", "total_fatal", "total_fatal_serious_injury", "total_ped_crash", "total_bike_crash", "total_motorcycle_crash", "total_epdo", "total_night_crash", "total_night_fatal", "total_impaired_crash", "total_distracted_crash", "total_speed_crash")
_TREND_OF = {"trend_total_crash": "total_crash", "trend_fatal": "total_fatal", "trend_ksi": "total_fatal_serious_injury", "trend_epdo": "total_epdo", "trend_ped_crash": "total_ped_crash", "trend_bike_crash": "total_bike_crash"}


def yearly_sums(crashes: DataFrame, key: str = "juris") -> DataFrame:
    """The counts of each jurisdiction and year, and its first crash there (id, district, mpo, planning): all that metrics and trends ask for, in one pass."""
    fatal, ksi = F.col("severity") == "K", F.col("severity").isin("K", "A")
    counts = {
        "total_fatal": fatal, "total_fatal_serious_injury": ksi, "total_ped_crash": F.col("is_ped"), "total_bike_crash": F.col("is_bike"), "total_motorcycle_crash": F.col("is_motorcycle"), "total_night_crash": F.col("is_night"),
        "total_night_fatal": F.col("is_night") & fatal, "total_impaired_crash": F.col("is_alcohol") | F.col("is_drug"), "total_distracted_crash": F.col("is_distracted"), "total_speed_crash": F.col("is_speed"),
    }
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "district", "mpo", "planning"))).alias("first")
    return crashes.groupBy(key, "year").agg(F.count("*").alias("total_crash"), F.sum("epdo").cast("long").alias("total_epdo"), *[yes(c).alias(k) for k, c in counts.items()], first)


def _metrics_of(years: DataFrame, key: str) -> DataFrame:
    sums = years.groupBy(key).agg(*[F.sum(c).alias(c) for c in _SUMS], F.min("first").alias("first"))
    return sums.select(key, *_SUMS, "first.district", "first.mpo", "first.planning")


def jurisdiction_metrics(crashes: DataFrame, key: str = "juris") -> DataFrame:
    """Twelve counts per jurisdiction and the first district, MPO and planning district by crash id."""
    return _metrics_of(yearly_sums(crashes, key), key)


def _trends_of(years: DataFrame, key: str) -> DataFrame:
    per_year = years.where(F.col("year").isNotNull()).groupBy("year").agg(F.sum("total_crash").alias("n"))  # some dozens of rows
    valid = per_year.agg(F.sort_array(F.collect_list(F.struct("year", "n")), asc=False).alias("y"))
    thin = (F.size("y") >= 2) & (F.get("y", F.lit(0))["n"] < F.get("y", F.lit(1))["n"] * 0.5)
    valid = valid.select(F.when(thin, F.slice("y", 2, 1000)).otherwise(F.col("y")).alias("y")).select(F.transform("y", lambda s: s["year"]).alias("y"))
    enough = F.size("y") >= 6
    spans = valid.select(F.when(enough, F.slice("y", 1, 3)).alias("recent"), F.when(enough, F.slice("y", 4, 3)).alias("prior"))
    part = years.join(F.broadcast(spans)).withColumn("part", F.when(F.array_contains("recent", F.col("year")), 1).when(F.array_contains("prior", F.col("year")), 0))  # spans: one row
    sums = part.groupBy(key).agg(*[F.coalesce(F.sum(F.when(F.col("part") == k, F.col(c))), F.lit(0)).alias(f"{n}_{k}") for n, c in _TREND_OF.items() for k in (0, 1)])
    return sums.select(key, *[F.when(F.col(f"{n}_0") > 0, F.round((F.col(f"{n}_1") - F.col(f"{n}_0")) / F.col(f"{n}_0") * 100, 1)).otherwise(0.0).alias(n) for n in _TREND_OF])


def trend_metrics(crashes: DataFrame, key: str = "juris") -> DataFrame:
    """Change in percent of the last three valid years on the three before, 0 where there is nothing to compare.

    The last year is dropped when it has less than half of the crashes of the one before it.
    """
    return _trends_of(kept(yearly_sums(crashes, key)), key)


def share_metrics(metrics: DataFrame) -> DataFrame:
    total = F.greatest(F.col("total_crash"), F.lit(1))
    pct = lambda c: F.round(F.col(c) / total * 100, 1)
    return metrics.withColumns({
        "pct_night_fatal": F.when(F.col("total_fatal") > 0, F.round(F.col("total_night_fatal") / F.col("total_fatal") * 100, 1)).otherwise(0.0),
        "pct_impaired_crash": pct("total_impaired_crash"), "pct_distracted_crash": pct("total_distracted_crash"), "pct_speed_crash": pct("total_speed_crash"),
        "severity_index": F.round(F.col("total_epdo") / total, 1), "fatality_rate": F.round(F.col("total_fatal") / total * 1000, 2),
    })


def safety_score(metrics: DataFrame) -> DataFrame:
    """Five figures, each spread over 0 to 100 between the least and the largest jurisdiction (50 if all agree), weighted."""
    total = F.greatest(F.col("total_crash"), F.lit(1))
    raw = {"s_ksi": F.col("total_fatal_serious_injury") / total * 1000, "s_trend": F.col("trend_fatal"), "s_vru": F.col("total_ped_crash") * 0.5 + F.col("total_bike_crash") * 0.3 + F.col("total_motorcycle_crash") * 0.2, "s_impaired": F.col("pct_impaired_crash"), "s_epdo": F.col("total_epdo").cast("double")}
    weights = {"s_ksi": 0.40, "s_trend": 0.25, "s_vru": 0.15, "s_impaired": 0.10, "s_epdo": 0.10}
    with_raw = metrics.withColumns(raw)
    ends = with_raw.agg(*[f(c).alias(f"{c}_{n}") for c in raw for n, f in (("lo", F.min), ("hi", F.max))])
    spread = lambda c: F.when(F.col(f"{c}_hi") > F.col(f"{c}_lo"), (F.col(c) - F.col(f"{c}_lo")) / (F.col(f"{c}_hi") - F.col(f"{c}_lo")) * 100).otherwise(50.0)
    score = sum((spread(c) * w for c, w in weights.items()), F.lit(0.0))
    return with_raw.join(F.broadcast(ends)).withColumn("safety_score", F.round(score, 1)).drop(*raw, *[f"{c}_{n}" for c in raw for n in ("lo", "hi")])


def all_metrics(crashes: DataFrame, key: str = "juris") -> DataFrame:
    """Counts, trends, shares and score; the crashes are read once, and what follows reads a stored row per jurisdiction and year."""
    years = kept(yearly_sums(crashes, key))
    return safety_score(kept(share_metrics(_metrics_of(years, key)).join(_trends_of(years, key), key)))


def rank_scopes(metrics: DataFrame, names=METRICS, key: str = "juris") -> DataFrame:
    """Long table: jurisdiction, metric, scope, scope_id, value, rank; descending, ties share the lower number.

    Metrics and scopes are turned to rows first, so each window is partitioned by (scope, group, metric); a blank
    group gets no rank.
    """
    scopes = F.array(*[F.struct(F.lit(s).alias("scope"), (F.lit("all") if c is None else F.col(c)).alias("scope_id")) for s, c in SCOPES.items()])
    long = metrics.select(key, F.explode(scopes).alias("s"), F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names]).alias("ms"))
    long = long.where(F.coalesce("s.scope_id", F.lit("")) != "").select(key, "s.*", F.explode("ms").alias("m")).select(key, "scope", "scope_id", "m.*")
    return long.withColumn("rank", F.rank().over(Window.partitionBy("scope", "scope_id", "metric").orderBy(F.desc("value"))).cast("long"))


def rank_columns(ranked: DataFrame, names=METRICS, key: str = "juris") -> DataFrame:
    """One column per scope and metric, as ``District_Rank_total_crash``: 76 for all metrics."""
    columns = [f"{s}_Rank_{m}" for m in names for s in SCOPES]
    return ranked.groupBy(key).pivot("label", columns).agg(F.min("rank")) if "label" in ranked.columns else ranked.withColumn("label", F.concat("scope", F.lit("_Rank_"), "metric")).groupBy(key).pivot("label", columns).agg(F.min("rank"))


def join_back(crashes: DataFrame, ranks: DataFrame, key: str = "juris") -> DataFrame:
    """Ranks on every crash; jurisdictions are few, so the ranks are broadcast by Spark's own size estimate or shuffled."""
    return crashes.join(ranks, key, "left")


def rank_assets(crashes: DataFrame, asset: str, order: list[Column], flags: list[str]) -> DataFrame:
    """Counts per asset and its rank; ``order`` are the columns ranked by."""
    n = crashes.where(F.col(asset).isNotNull()).groupBy(asset).agg(F.count("*").alias("total_crashes"), yes(F.col("severity").isin("K", "A")).alias("ksi"), yes(F.col("severity") == "K").alias("fatal"), *[yes(F.col(f"is_{f}")).alias(f) for f in flags])
    return ranked(n, "safety_rank", *order)


def max_normalised(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with ``<column>_share``: each figure over the column's largest, 0 where that is 0.  The maxima are one row."""
    df = kept(df)
    tops = df.agg(*[F.max(c).alias(f"_top_{c}") for c in columns])
    share = lambda c: F.when(F.col(f"_top_{c}") != 0, F.col(c) / F.col(f"_top_{c}")).otherwise(0.0)
    return df.crossJoin(F.broadcast(tops)).withColumns({f"{c}_share": share(c) for c in columns}).drop(*[f"_top_{c}" for c in columns])
