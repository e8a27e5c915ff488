"""Road attributes from several sources by authority, and scores of a single row.  No shuffle in here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.session import small


def by_authority(sources: list[tuple[str, Column]], fallback: tuple[str, Column] | None = None) -> dict[str, Column]:
    """value and source of the first source that says something; sources from the highest authority down."""
    told = [F.when(c.isNotNull(), F.struct(c.alias("value"), F.lit(name).alias("source"))) for name, c in [*sources, *([fallback] if fallback else [])]]
    s = F.coalesce(*told)
    return {"value": s["value"], "source": F.coalesce(s["source"], F.lit(""))}


def speed_in_range(c: Column) -> Column:
    v = c.try_cast("double").cast("int")
    return F.when(v.between(5, 85), v)


def resolve_speed(state: Column, federal: Column, signs: Column, tags: Column, local: Column, in_mpo: Column, collector: Column) -> dict[str, Column]:
    """State DOT, federal, signs, tags, then what the law says for local roads and collectors."""
    law = F.when(local, F.when(in_mpo, 25).otherwise(50)).when(collector, 35)
    return by_authority([("StateDOT", speed_in_range(state)), ("HPMS", speed_in_range(federal)), ("Mapillary", speed_in_range(signs)), ("OSM", speed_in_range(tags))], ("Statutory", law))


def agreement(values: list[Column], scale=(0, 50, 75, 90)) -> Column:
    """Confidence by how many sources say something that agrees with the first: none, one, two, more."""
    first = F.coalesce(*values)
    n = sum((F.coalesce((v == first).cast("int"), F.lit(0)) for v in values), F.lit(0))
    out = F.lit(scale[-1])
    for k in (2, 1, 0):
        out = F.when(n <= k, scale[k]).otherwise(out)
    return out


def freshness(seen: Column, as_of: Column) -> Column:
    """100, 80, 60, 40 or 20 by age under 1, 2, 4, 8 years or more; 0 if never seen."""
    days = F.datediff(as_of, seen)
    out = F.lit(20)
    for years, s in ((8, 40), (4, 60), (2, 80), (1, 100)):
        out = F.when(days < years * 365.25, s).otherwise(out)
    return F.when(seen.isNull(), 0).otherwise(out)


def speed_transition(counts: dict[int, Column]) -> dict[str, Column]:
    """Whether signs of two or more speeds stand near a segment, and their spread."""
    there = F.filter(F.array(*[F.when(c > 0, F.lit(v)) for v, c in counts.items()]), lambda x: x.isNotNull())
    many = F.size(there) >= 2
    return {"transition": F.when(many, "Yes").otherwise("No"), "diff": F.when(many, F.array_max(there) - F.array_min(there)).otherwise(0)}


# Words of the structure codes and of the curve classes, and each class's points.
STRUCTURES = {1: "Bridge", 2: "Tunnel", 3: "Causeway"}
CURVES = {1: ("Straight", 0), 2: ("Slight", 10), 3: ("Moderate", 20), 4: ("Sharp", 30), 5: ("Extreme", 40)}


def _steps(value: Column, steps, otherwise) -> Column:
    """The first step's result whose limit the value doesn't exceed."""
    out = F.when(F.lit(False), F.lit(otherwise))
    for top, result in steps:
        out = out.when(value <= top, F.lit(result))
    return out.otherwise(F.lit(otherwise))


def pavement(iri: Column, cracks: Column, psr: Column) -> Column:
    """Good, Fair or Poor from roughness, serviceability and cracking, weighted; blank where neither of the first two is known."""
    rough = _steps(iri, ((0, 50), (95, 90), (170, 60)), 20)
    cracked = _steps(cracks, ((0, 50), (5, 90), (20, 60)), 20)
    served = F.when(psr <= 0, 50).when(psr >= 3.5, 90).when(psr >= 2.5, 60).otherwise(20)
    score = rough * 5 + served * 3 + cracked * 2  # tenths
    return F.when((iri > 0) | (psr > 0), F.when(score >= 750, "Good").when(score >= 450, "Fair").otherwise("Poor")).otherwise("")


def _rounded(c: Column, digits: int) -> Column:
    """Halves away from zero, told on the scaled double as SQL engines do; Spark's own rounds the decimal that is shown."""
    return F.round(c * 10.0**digits) / 10.0**digits


def traffic_engineering(road: dict[str, Column]) -> dict[str, Column]:
    """Volume over capacity and its level of service, trucks, peak hour, vehicles a lane, pavement, toll, HOV and structure.

    road: aadt, capacity, direction (0: even), single_unit, combination, k_factor, lanes, iri, cracking, psr, toll, hov and
    structure; what is null counts as 0.
    """
    c = {k: F.coalesce(v, F.lit(0)) for k, v in road.items()}
    aadt, share = c["aadt"], F.when(c["direction"] > 0, c["direction"]).otherwise(0.5)
    vc = F.when(c["capacity"] > 0, F.least(F.lit(5.0), _rounded(aadt / (c["capacity"] * share * 365) * 10, 2))).otherwise(0.0)
    yes = lambda x: F.when(x > 0, "Yes").otherwise("No")
    kind = F.lit("No")
    for k, word in STRUCTURES.items():
        kind = F.when(c["structure"] == k, word).otherwise(kind)
    return {
        "vc": vc, "los": F.when(vc <= 0, "").otherwise(_steps(vc, ((0.6, "A"), (0.7, "B"), (0.8, "C"), (0.9, "D"), (1.0, "E")), "F")),
        "truck_pct": F.when(aadt > 0, _rounded((c["single_unit"] + c["combination"]) / aadt * 100, 1)).otherwise(0.0), "peak_hour": F.when((aadt > 0) & (c["k_factor"] > 0), F.round(aadt * c["k_factor"] / 100)).otherwise(0.0).cast("int"),
        "per_lane": F.when((aadt > 0) & (c["lanes"] > 0), F.round(aadt / (c["lanes"] * 365))).otherwise(0.0).cast("int"), "pavement": pavement(c["iri"], c["cracking"], c["psr"]), "is_toll": yes(c["toll"]), "is_hov": yes(c["hov"]), "on_structure": kind,
    }


def curve_analysis(road: dict[str, Column], signs: list[tuple[str, Column]], speeds: dict[int, Column]) -> dict[str, Column]:
    """Class and label of a curve, its sign, advisory speed and what that lies below the limit, risk 0 to 100, and whether it is one.

    road: curvature, length_m, inventory (federal class, 0 to 5), posted (mph), guard_rail (Yes); signs: names of curve
    signs and whether they stand near, the first that does is told; speeds: limit -> how many signs of it stand near.
    Segments under 20 metres count as straight.  A federal class of 3 or more, and any sign, make a moderate curve of a
    lesser one.
    """
    bend = F.when(F.coalesce(road["length_m"], F.lit(0.0)) < 20, 1.0).otherwise(F.coalesce(road["curvature"], F.lit(1.0)))
    federal, posted = F.coalesce(road["inventory"], F.lit(0)), F.coalesce(road["posted"], F.lit(0))
    shape = _steps(bend, ((1.05, 1), (1.3, 2), (1.6, 3), (2.5, 4)), 5)
    sign = F.coalesce(*[F.when(c, name) for name, c in signs], F.lit(""))
    with_federal = F.when((federal >= 3) & (shape <= 2), 3).otherwise(shape)
    kind = F.when((sign != "") & (with_federal <= 2), 3).otherwise(with_federal)
    label, points = F.lit(CURVES[1][0]), F.lit(0)
    for k, (word, worth) in CURVES.items():
        label, points = F.when(kind == k, word).otherwise(label), F.when(with_federal == k, worth).otherwise(points)
    near = F.array_min(F.filter(F.array(*[F.when(c > 0, F.lit(v)) for v, c in speeds.items()]), lambda x: x.isNotNull()))
    advised = F.when(sign != "", F.coalesce(near, F.lit(0))).otherwise(0)
    curved = with_federal >= 3
    fast = F.when(~curved, 0).when(posted >= 55, 30).when(posted >= 45, 25).when(posted >= 35, 15).when(posted >= 25, 10).otherwise(5)
    agree = curved.cast("int") + (sign != "").cast("int") + F.coalesce(road["guard_rail"], F.lit(False)).cast("int") + (federal > 0).cast("int")
    risk = points + fast + F.when(curved & (sign == ""), 15).otherwise(0) + F.when(agree >= 3, 15).when(agree == 2, 10).otherwise(0)
    return {
        "curve_class": kind, "curve_label": label, "has_sign": F.when(sign != "", "Yes").otherwise("No"), "sign": sign, "advisory": advised, "differential": F.when(advised > 0, F.greatest(posted - advised, F.lit(0))).otherwise(0),
        "risk": F.least(risk, F.lit(100)), "is_curve": F.when(((bend > 1.3) & (road["length_m"] > 20)) | (federal > 0) | (sign != ""), "Yes").otherwise("No"),
    }


def sentinels(c: Column, values=(-1, 0, 9999, 99999)) -> Column:
    return F.when(~c.isin(*values), c)


def statutory_speed(segments: DataFrame, table: DataFrame) -> DataFrame:
    """Limit by class and area: suburban is rural for classes 1 to 3 and urban below; 25 where the table has none.

    table: fc_code, area, limit: some dozens of rows.
    """
    area = F.when(F.col("area") == "Suburban", F.when(F.col("fc_code") <= 3, "Rural").otherwise("Urban")).otherwise(F.col("area"))
    return segments.withColumn("_a", area).join(small(table.withColumnRenamed("area", "_a")), ["fc_code", "_a"], "left").select("seg_id", F.coalesce("limit", F.lit(25)).alias("mph"))
