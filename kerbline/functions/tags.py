"""Words of other catalogues to this library's: sign detections, open-map tags, countermeasure texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What detections begin with, and the sign's code and name.
SIGNS = {
    "regulatory--stop": ("R1-1", "STOP"), "regulatory--yield": ("R1-2", "YIELD"), "regulatory--all-way": ("R1-3P", "ALL WAY"), "regulatory--no-u-turn": ("R3-4", "No U-Turn"), "regulatory--no-left-turn": ("R3-2", "No Left Turn"), "regulatory--no-right-turn": ("R3-1", "No Right Turn"), "regulatory--no-parking": ("R7-1", "No Parking"),
    "regulatory--one-way": ("R6-1", "One Way"), "regulatory--keep-right": ("R4-7", "Keep Right"), "regulatory--do-not-enter": ("R5-1", "Do Not Enter"), "warning--stop-ahead": ("W3-1", "Stop Ahead"), "warning--signal-ahead": ("W3-3", "Signal Ahead"), "warning--curve": ("W1-2", "Curve"), "warning--turn": ("W1-1", "Turn"),
    "warning--winding-road": ("W1-5", "Winding Road"), "warning--railroad-crossing": ("W10-1", "Railroad Xing"), "warning--pedestrians-crossing": ("W11-2", "Ped Crossing"), "warning--school-zone": ("S1-1", "School Zone"), "warning--children": ("W15-1", "Children"), "object--street-light": ("N/A", "Street Light"), "object--fire-hydrant": ("N/A", "Fire Hydrant"),
    "object--manhole": ("N/A", "Manhole"), "object--traffic-light": ("N/A", "Traffic Signal"), "object--guard-rail": ("N/A", "Guard Rail"), "object--bollard": ("N/A", "Bollard"), "marking--discrete--crosswalk": ("N/A", "Crosswalk"), "marking--discrete--stop-line": ("N/A", "Stop Line"),
}
# Points of interest: category, tag key, tag values.
POIS = (
    ("bar", "amenity", ("bar", "pub", "nightclub", "biergarten")), ("school", "amenity", ("school", "kindergarten")), ("college", "amenity", ("college", "university")), ("hospital", "amenity", ("hospital",)), ("clinic", "amenity", ("clinic",)), ("fuel", "amenity", ("fuel",)), ("parking", "amenity", ("parking",)),
    ("restaurant", "amenity", ("restaurant", "fast_food")), ("signal", "highway", ("traffic_signals",)), ("stop_sign", "highway", ("stop",)), ("crossing", "highway", ("crossing",)), ("rest_area", "highway", ("rest_area", "services")), ("exit", "highway", ("motorway_junction",)), ("rail_xing", "railway", ("level_crossing",)),
)
# States near by, and words that tell a countermeasure's cost, dearest first.
HOME, NEAR = ("va", "virginia"), ("md", "maryland", "nc", "north carolina", "dc", "district of columbia", "wv", "west virginia", "de", "delaware", "pa", "pennsylvania")
COSTS = {
    4: ("roundabout", "interchange", "overpass", "underpass", "bridge", "grade separation", "flyover"), 3: ("signal", "median", "turn lane", "turning lane", "shoulder", "lighting", "illumination", "crosswalk", "refuge"),
    2: ("timing", "phasing", "rrfb", "phb", "beacon", "flashing", "signal timing", "lpi", "leading pedestrian"), 1: ("sign", "marking", "stripe", "edge line", "delineator", "warning", "chevron", "pavement marking", "rumble strip"),
}


def classify_sign(raw: Column) -> dict[str, Column]:
    """code, name, speed and signal heads of a detection; the first fitting beginning counts."""
    v = F.lower(F.coalesce(raw, F.lit("")))
    speed = F.regexp_extract(v, r"maximum-speed-limit-(\d+)", 1)
    part = F.split(v, "--")
    other = F.when(F.size(part) > 1, F.replace(F.get(part, F.lit(1)), F.lit("-"), F.lit(" "))).otherwise("Unknown")
    hit = F.coalesce(*[F.when(v.startswith(p), F.struct(F.lit(code).alias("code"), F.lit(name).alias("name"))) for p, (code, name) in SIGNS.items()])
    heads = F.when(~v.contains("traffic-light") | (speed != ""), "").when(v.contains("upright"), "3").when(v.contains("horizontal"), "5").otherwise("2")
    return {"code": F.when(speed != "", "R2-1").otherwise(F.coalesce(hit["code"], F.lit("N/A"))), "name": F.when(speed != "", F.concat(F.lit("Speed "), speed)).otherwise(F.coalesce(hit["name"], other)), "speed": speed, "heads": heads}


def poi_of(tags: Column) -> dict[str, Column]:
    """category, subcategory and name of a tagged feature; null category for none.  Exits keep their number."""
    tag = lambda k: F.try_element_at(tags, F.lit(k))
    hit = F.coalesce(*[F.when(tag(key).isin(*values), F.struct(F.lit(category).alias("category"), tag(key).alias("value"))) for category, key, values in POIS])
    number = F.trim(F.coalesce(tag("ref"), F.lit("")))
    return {"category": hit["category"], "subcategory": F.when((hit["category"] == "exit") & (number != ""), number).otherwise(hit["value"]), "name": F.substring(F.trim(F.coalesce(tag("name"), F.lit(""))), 1, 100)}


def centre(points: Column) -> dict[str, Column]:
    """Mean position of an area's (lon, lat) vertices, or the point itself."""
    mean = lambda f: F.round(F.aggregate(points, F.lit(0.0), lambda s, p: s + p[f]) / F.size(points), 7)
    return {"lat": mean("lat"), "lon": mean("lon")}


def facility(highway: Column, lanes: Column, oneway: Column, divided: Column) -> Column:
    n = F.coalesce(lanes.try_cast("int"), F.lit(0))
    split = F.coalesce(divided.isin("yes", "1"), F.lit(False)) | F.coalesce(highway.isin("motorway", "trunk"), F.lit(False)) | (n >= 4)
    return F.when(oneway.isin("yes", "1", "-1"), "1-One-Way Undivided").when(split, "4-Two-Way Divided").otherwise("3-Two-Way Undivided")


def road_words(lanes: Column, oneway: Column, divided: Column) -> Column:
    """``4 Lanes, Divided`` and the like."""
    n = F.coalesce(lanes.try_cast("int"), F.lit(0))
    with_lanes = lambda least, kind: F.when(n >= least, F.concat(n.cast("string"), F.lit(f" Lanes, {kind}"))).otherwise(kind)
    flat = F.when(n.isin(0, 2), "Two Lanes, Undivided").otherwise(F.concat(n.cast("string"), F.lit(" Lanes, Undivided")))
    return F.when(oneway.isin("yes", "1", "-1"), with_lanes(2, "One-Way")).when(divided.isin("yes", "1"), with_lanes(4, "Divided")).otherwise(flat)


def road_system(highway: Column, ref: Column, agency: str = "DOT") -> Column:
    big = highway.isin("trunk", "trunk_link", "primary", "primary_link")
    return (
        F.when(highway.isin("motorway", "motorway_link") | (big & F.upper(F.coalesce(ref, F.lit(""))).rlike(r"^(I[-\s]|IS\s)")), f"{agency} Interstate").when(big, f"{agency} Primary")
        .when(highway.isin("secondary", "secondary_link", "tertiary", "tertiary_link"), f"{agency} Secondary").otherwise(f"Non{agency} secondary")
    )


def severities(c: Column) -> Column:
    """The classes named in a text, gravest first; all five where none is."""
    found = F.filter(F.array(*[F.when(F.upper(c).contains(k), k) for k in "KABCO"]), lambda x: x.isNotNull())
    return F.when(F.size(found) > 0, found).otherwise(F.array(*[F.lit(k) for k in "KABCO"]))


def relevance(states: Column) -> Column:
    """100 for the home state, 50 near by, 25 for many or unknown, 10 for another."""
    low = F.lower(F.trim(F.coalesce(states, F.lit(""))))
    named = lambda words: low.rlike("|".join(words))
    return F.when(low == "", 25).when(named(HOME), 100).when(named(NEAR), 50).when(low.rlike(",|national|multiple"), 25).otherwise(10)


def cost_tier(name: Column, category: Column) -> Column:
    low, kind = F.lower(name), F.lower(F.coalesce(category, F.lit("")))
    out = F.when(kind.contains("intersection"), 3).otherwise(2)
    for tier in sorted(COSTS):
        out = F.when(low.rlike("|".join(COSTS[tier])), tier).otherwise(out)
    return F.when(name.isNull(), 2).otherwise(out)


def location_kind(related: Column, intersection: Column, category: Column) -> Column:
    r, i, c = (F.lower(F.coalesce(x, F.lit(""))) for x in (related, intersection, category))
    return F.when((r == "yes") | c.contains("intersection"), "intersection").when((r == "no") | i.contains("segment"), "segment").when(c.contains("roadway") & ~i.contains("intersection"), "segment").otherwise("both")
