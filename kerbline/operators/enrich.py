"""Enrichment of crashes from their own fields, before roads are joined, and the canonical rules that run after.

Both are one projection over the rows; what they ask of the whole table (does a flag column hold any Yes, is a count
column empty throughout) is one row, told beforehand.  Where truth can't be known a field stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.functions.text import FLAG_WORDS, fc_from_route, flags_from_text

# Alignment words of curve classes and of terrain codes, and spellings of one MPO.
STRAIGHT, CURVE, GRADE_CURVE, GRADE_STRAIGHT, RAMP = "1. Straight - Level", "2. Curve - Level", "4. Grade - Curve", "3. Grade - Straight", "10. On/Off Ramp"
TERRAIN = {1: STRAIGHT, 2: GRADE_STRAIGHT, 3: GRADE_CURVE}
MPO_NAMES = {"Dover/Kent County MPO": "Dover / Kent County MPO"}
ROUTE_SOURCES = ("hpms_route", "map_road", "road_name")


def _text(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c), F.lit("")))


def _count(c: str) -> Column:
    return F.coalesce(F.col(c).try_cast("int"), F.lit(0))


def self_enriched(rows: DataFrame, not_tracked: tuple[str, ...] = ()) -> DataFrame:
    """Flags, mainline, people and class from a crash's own fields.

    rows: circumstance, the flags of :data:`FLAG_WORDS`, private_property, mainline, collision, ped, bike, severity,
    k_people to c_people, route, fc.  A flag column that holds a Yes anywhere is the agency's own and stays; otherwise
    the circumstance's words tell.  Flags that an agency doesn't track are empty.  Pedestrians and bicycles in the
    collision's words turn a No; a severity stands for one person at least; a blank class goes by the route's prefix.
    """
    told = flags_from_text(F.col("circumstance"))
    own = rows.agg(*[F.coalesce(F.max(F.col(k) == "Yes"), F.lit(False)).alias(f"_own_{k}") for k in told])  # one row
    words = F.lower(F.coalesce("collision", F.lit("")))
    flags = {k: F.lit("") if k in not_tracked else F.when(F.col(f"_own_{k}"), F.col(k)).otherwise(F.when(c, "Yes").otherwise("No")) for k, c in told.items()}
    place = F.upper(_text("private_property"))
    people = {f"{k}_people": F.greatest(_count(f"{k}_people"), F.when(F.col("severity") == k.upper(), 1).otherwise(0)) for k in "kabc"}
    out = rows.crossJoin(F.broadcast(own)).withColumns({
        **flags, **people, "mainline": F.when(_text("mainline") != "", F.col("mainline")).when(place == "N", "Yes").otherwise("No"),
        "ped": F.when((F.col("ped") == "No") & words.contains("ped"), "Yes").otherwise(F.col("ped")), "bike": F.when((F.col("bike") == "No") & words.contains("bicycl"), "Yes").otherwise(F.col("bike")),
        "fc": F.when(_text("fc") == "", F.coalesce(fc_from_route(F.col("route")), F.lit(""))).otherwise(F.col("fc")),
    })
    return out.drop(*[f"_own_{k}" for k in told])


def canonical(rows: DataFrame, not_tracked: tuple[str, ...] = ()) -> DataFrame:
    """The rules that end an enrichment; each fills from what is certain, and leaves the rest.

    rows: alignment, curve_class, terrain, route and its sources (:data:`ROUTE_SOURCES`), intersection_name,
    near_school, school_zone, departure, collision, relation, is_ramp, injured, a_people to c_people, ped, severity,
    ped_killed, ped_injured, speed_limit, speed_diff, mpo.  In order: alignment by the curve's class (ramps stay), else by
    terrain; a blank route from its sources, else from the first name of ``X & Y``; school zone by proximity alone;
    departures where the collision or relation says so, by the alignment just told; injured people added up, and one
    pedestrian killed or hurt at least, each only where the table has none at all; ramps as relation; speed differences
    without a limit cleared; one spelling of an MPO; flags that aren't tracked emptied.
    """
    curve, terrain, ramp = _count("curve_class"), _count("terrain"), F.col("alignment").contains("Ramp")
    by_terrain = F.lit(None).cast("string")
    for code, word in TERRAIN.items():
        by_terrain = F.when(terrain == code, word).otherwise(by_terrain)
    alignment = F.when((curve > 0) & ~F.coalesce(ramp, F.lit(False)), F.when(curve <= 2, STRAIGHT).when(curve == 3, CURVE).otherwise(GRADE_CURVE)).when(_text("alignment").isin("", "nan", "None"), F.coalesce(by_terrain, F.col("alignment"))).otherwise(F.col("alignment"))
    first = F.trim(F.split_part(F.col("intersection_name"), F.lit(" & "), F.lit(1)))
    named = F.when(F.col("intersection_name").contains(" & ") & ~first.isin("", "nan") & ~first.rlike(r"^-?\d+$"), first)
    filled = lambda c: F.when(_text(c) != "", _text(c))
    none = rows.agg(*[(F.coalesce(F.sum(_count(c)), F.lit(0)) == 0).alias(f"_no_{c}") for c in ("injured", "ped_killed", "ped_injured")])  # one row
    hurt = _count("a_people") + _count("b_people") + _count("c_people")
    ped = _text("ped") == "Yes"
    least = lambda c, when: F.when(F.col(f"_no_{c}") & when, F.lit("1")).otherwise(F.col(c).cast("string"))
    said = F.lower(F.coalesce("collision", F.lit("")))
    off = said.contains("ran off") | said.contains("overturn") | F.lower(F.coalesce("relation", F.lit(""))).contains("off roadway")
    out = rows.crossJoin(F.broadcast(none)).withColumn("alignment", alignment).withColumns({
        "route": F.coalesce(filled("route"), *[filled(c) for c in ROUTE_SOURCES], named, F.col("route")),
        "school_zone": F.when(_text("near_school") == "Yes", "Yes").otherwise("No"),
        "departure": F.when((_text("departure") == "") & off, F.when(F.lower(F.coalesce("alignment", F.lit(""))).contains("curve"), "Curve Departure").otherwise("Straight Departure")).otherwise(F.col("departure")),
        "injured": F.when(F.col("_no_injured") & (hurt > 0), hurt.cast("string")).otherwise(F.col("injured").cast("string")),
        "ped_killed": least("ped_killed", ped & (F.col("severity") == "K")), "ped_injured": least("ped_injured", ped & F.col("severity").isin("A", "B", "C")),
        "relation": F.when((_text("relation") == "") & (_text("is_ramp") == "Yes"), RAMP).otherwise(F.col("relation")),
        "speed_diff": F.when((_count("speed_limit") == 0) & (_count("speed_diff") > 0), "").otherwise(F.col("speed_diff").cast("string")),
        "mpo": F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in MPO_NAMES.items() for x in kv]), F.col("mpo")), F.col("mpo")),
        **{k: F.lit("") for k in not_tracked},
    })
    return out.drop("_no_injured", "_no_ped_killed", "_no_ped_injured")


TOLD = tuple(FLAG_WORDS)
