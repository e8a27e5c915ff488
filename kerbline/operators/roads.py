"""Road inventory: value rules, repairs and the choice between sources.  One row per segment; rules need no shuffle.

Columns of the inventory: seg_id, name, ref, fc (functional class label), ownership, system, facility, description,
control, lanes, speed, area, surface, school_zone, school_ft, oneway, is_intersection, degree, streets, intersection,
curve_class, is_ramp, grade_class, terrain, alignment, aadt, u_lat, u_lon, v_lat, v_lon, road_source, and the sources'
own columns with prefixes ``sdot_`` (state), ``hpms_`` (federal), ``map_`` (street images), ``osm_`` (open map).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.functions.text import OWNERS
from kerbline.operators.authority import by_authority, speed_in_range
from kerbline.session import small

# Per functional class the least, largest and usual speed, the usual surface, system and facility.
SPEED_RANGE = {1: (45, 75, 55), 2: (35, 70, 50), 3: (25, 60, 40), 4: (20, 55, 35), 5: (15, 50, 30), 6: (15, 45, 25), 7: (5, 35, 25)}
ASPHALT, CONCRETE = "2. Blacktop, Asphalt, Bituminous", "1. Concrete"
SYSTEM = {1: "DOT Interstate", 2: "DOT Primary", 3: "DOT Primary", 4: "DOT Secondary", 5: "DOT Secondary", 6: "Non-DOT primary", 7: "Non-DOT secondary"}
ONE_WAY, TWO_WAY, DIVIDED = "1-One-Way Undivided", "3-Two-Way Undivided", "4-Two-Way Divided"
DESCRIPTION = {"1-One-Way Undivided": "4. One-Way, Not Divided", "2-One-Way Divided": "4. One-Way, Not Divided", "3-Two-Way Undivided": "1. Two-Way, Not Divided", "4-Two-Way Divided": "2. Two-Way, Divided, Unprotected Median"}
NO_CONTROL = "1. No Traffic Control"
INTERSTATE, PRINCIPAL = "1-Interstate (A,1)", "3-Principal Arterial - Other (E,2)"
# Federal owner codes, lanes where none are known, and speeds where none are known, by class.
OWNER_CODES = {
    "state": (1, 11, 21, 40), "county": (2,), "city": (3, 4, 12, 25), "private": (26, 27, 80), "toll": (31, 32),
    "federal": (50, 60, 62, 63, 64, 66, 67, 68, 69, 70, 72, 73, 74),
}
OWNER_OF_CLASS = {1: "state", 2: "state", 3: "state", 4: "state", 5: "county", 6: "county", 7: "city"}
LEAST_LANES = {1: 4, 2: 4, 3: 2, 4: 2, 5: 2, 6: 2, 7: 2}
USUAL_SPEED = {1: 65, 2: 55, 3: 50, 4: 45, 5: 50, 6: 50, 7: 25}
NO_CROSSING, THREE, FOUR, FIVE = "1. Not at Intersection", "3. Three Approaches", "4. Four Approaches", "5. Five-Point, or More"
PAVED = ("asphalt", "concrete", "paved", "concrete:plates", "concrete:lanes", "paving_stones", "sett", "metal")
UNPAVED = ("unpaved", "gravel", "dirt", "sand", "grass", "ground", "mud", "compacted", "fine_gravel", "earth")


def class_of(fc: Column) -> Column:
    """The number a class label begins with; null for none."""
    return F.regexp_extract(F.coalesce(fc, F.lit("")), "^([1-7])-", 1).try_cast("int")


def by_class(fc: Column, values: dict) -> Column:
    """The value of the label's class; null where the class has none."""
    out, number = F.lit(None), class_of(fc)
    for k in sorted(values, reverse=True):
        out = F.when(number == k, F.lit(values[k])).otherwise(out)
    return out


def _blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("")).isin("", "nan", "None")


def _number(c: Column) -> Column:
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


class Rules:
    """Rules one after the other: each sees what those before it wrote; which held is kept in a column per rule."""

    def __init__(self, df: DataFrame):
        self.df, self.names = df, []

    def rule(self, name: str, when: Column, **new) -> Rules:
        hit = f"_rule_{len(self.names)}"
        self.names.append(name)
        self.df = self.df.withColumn(hit, F.coalesce(when, F.lit(False)))
        if new:
            self.df = self.df.withColumns({c: F.when(F.col(hit), v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c)) for c, v in new.items()})
        return self

    def done(self) -> DataFrame:
        held = F.array_compact(F.array(*[F.when(F.col(f"_rule_{k}"), F.lit(n)) for k, n in enumerate(self.names)]))
        return self.df.withColumn("rules", held).drop(*[f"_rule_{k}" for k in range(len(self.names))])


def road_rules(inventory: DataFrame, law: DataFrame | None = None) -> DataFrame:
    """The twelve rule groups, with ``rules``: the names of those that changed or flagged a segment.

    ``law`` (fc_code, area, limit) is the state's table of statutory speeds: with it speeds out of their class's range,
    and missing ones, take the law's; without it the class's usual speed, and missing ones stay.  The class that
    rules 10 to 12 go by is the one a segment came with; rule 9 may write another.
    """
    df, came = inventory.withColumns({"lanes": F.col("lanes").cast("string"), "speed": F.col("speed").cast("string"), "_fc": F.coalesce("fc", F.lit(""))}), F.col("_fc")
    usual: Column = by_class(came, {k: v[2] for k, v in SPEED_RANGE.items()})
    if law is not None:
        # Areas other than urban and rural ones go by the class.
        area = F.when(F.coalesce("area", F.lit("Rural")) == "Suburban", F.when(class_of(came) <= 3, "Rural").otherwise("Urban")).otherwise(F.coalesce("area", F.lit("Rural")))
        told = small(law.select(F.col("fc_code").alias("_k"), F.col("area").alias("_a"), F.col("limit").alias("_law")))
        df = df.withColumns({"_k0": class_of(came), "_a0": area}).join(told, (F.col("_k0") == F.col("_k")) & (F.col("_a0") == F.col("_a")), "left").drop("_k", "_a", "_k0", "_a0")
        usual = F.coalesce("_law", F.lit(25))
    speed, number = _number(F.col("speed")), class_of(came)
    low, high = by_class(came, {k: v[0] for k, v in SPEED_RANGE.items()}), by_class(came, {k: v[1] for k, v in SPEED_RANGE.items()})
    oneway = F.lower(F.coalesce("oneway", F.lit(""))).isin("yes", "true", "1", "-1")
    system: Column = by_class(came, SYSTEM)
    top, local = number <= 2, number == 7
    r = Rules(df)
    r.rule("SPD_FIX", (speed > 0) & ((speed < low) | (speed > high)), speed=usual.cast("string"))
    r.rule("SPD_LANE", (_number(F.col("lanes")) >= 4) & (speed > 0) & (speed < 25), speed="25")
    if law is not None:
        r.rule("SPD_FILL", (came != "") & (speed <= 0), speed=usual.cast("string"))
    r.rule("SURF_FILL", number.isNotNull() & _blank(F.col("surface")), surface=F.when(number == 1, CONCRETE).otherwise(ASPHALT))
    r.rule("OWN_FIX", top & (F.col("ownership") != "") & ~F.col("ownership").contains("State"), ownership=OWNERS["state"])
    r.rule("OWN_FC7", local & F.col("ownership").contains("State"))
    r.rule("SYS_FIX", number.isNotNull() & (F.col("system") != "") & (F.col("system") != system), system=system)
    r.rule("FAC_FILL", number.isNotNull() & _blank(F.col("facility")), facility=F.when(top, DIVIDED).otherwise(TWO_WAY))
    r.rule("FAC_OW_FIX", oneway & F.col("facility").contains("Two-Way"), facility=ONE_WAY)
    r.rule("FAC_TW_FIX", ~oneway & F.col("facility").contains("One-Way"), facility=F.when(top, DIVIDED).when(number.isNotNull(), TWO_WAY).otherwise(F.col("facility")))
    said = F.lit(None)
    for k, v in DESCRIPTION.items():
        said = F.when(F.col("facility") == k, F.lit(v)).otherwise(said)
    r.rule("DESC_FILL", (came != "") & _blank(F.col("description")) & said.isNotNull(), description=said)
    r.rule("CTRL_STOP", F.col("control").contains("Stop Sign") & top, control=NO_CONTROL)
    r.rule("CTRL_SIG", F.col("control").contains("Signal") & local & (F.coalesce("is_intersection", F.lit("")) != "Yes"), control=NO_CONTROL)
    r.rule("LANE_FC", top & (_number(F.col("lanes")) > 0) & (_number(F.col("lanes")) < 2), lanes="2")
    route = F.coalesce("route", F.lit(""))
    r.rule("RTE_INT", route.rlike(r"^I[-\s]?\d") & (came != "") & ~came.startswith("1-"), fc=INTERSTATE, system=SYSTEM[1], ownership=OWNERS["state"])
    r.rule("RTE_US", route.rlike(r"^US[-\s]?\d") & local, fc=PRINCIPAL, system=SYSTEM[3], ownership=OWNERS["state"])
    yes, ft = F.coalesce("school_zone", F.lit("")).contains("Yes"), _number(F.col("school_ft"))
    r.rule("SCHZ_FAR", yes & ((ft == 0) | (ft > 2000)), school_zone="3. No")
    r.rule("SCHZ_NEAR", ~yes & (ft > 0) & (ft <= 500), school_zone="1. Yes")
    length = F.sqrt(F.pow((F.col("v_lon") - F.col("u_lon")) * F.cos(F.radians("u_lat")), F.lit(2.0)) + F.pow(F.col("v_lat") - F.col("u_lat"), F.lit(2.0))) * (111_320.0 * 3.28084)
    r.rule("GEOM_ZERO", length < 1)
    r.rule("GEOM_LONG", length > 10_000)
    r.rule("AADT_I_LO", (number == 1) & (_number(F.col("aadt")) > 0) & (_number(F.col("aadt")) < 500))
    return r.done().drop("_fc", "_law")


def rule_report(checked: DataFrame) -> DataFrame:
    """rule, n, pct: how many segments each rule changed or flagged."""
    total = checked.agg(F.count("*").alias("total"))
    hits = checked.select(F.explode("rules").alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))
    return hits.crossJoin(F.broadcast(total)).select("rule", "n", F.round(F.col("n") * 100.0 / F.col("total"), 1).alias("pct"))  # total: one row


# Repairs ----------------------------------------------------------------------------------------------------


def route_name(federal: Column, ref: Column, state: str = "") -> Column:
    """The federal name, else the first reference where it reads as a route, else a bare number as a county route; street names are no routes."""
    first = F.trim(F.split(F.coalesce(ref, F.lit("")), "[;,]")[0])
    prefix = "|".join(["I", "US", "SR", "CR", "RD", *([state.upper()] if state else [])])
    return F.when(F.trim(F.coalesce(federal, F.lit(""))) != "", F.trim(federal)).when(first.rlike(rf"(?i)^({prefix})[-\s]?\d"), first).when(first.rlike(r"^\d+[A-Za-z]?$"), F.concat(F.lit("CR "), first)).otherwise("")


def repaired_owner(owner: Column, code: Column, fc: Column) -> Column:
    """A standard owner stays; any other word goes by the federal code, then by class, then private; blank stays blank."""
    owner, code = F.trim(F.coalesce(owner, F.lit(""))), code.try_cast("int")
    by_code = F.lit(None).cast("string")
    for who, codes in OWNER_CODES.items():
        by_code = F.when(code.isin(*codes), OWNERS[who]).otherwise(by_code)
    by_fc = by_class(fc, {k: OWNERS[w] for k, w in OWNER_OF_CLASS.items()})
    return F.when((owner == "") | owner.isin(*OWNERS.values()), owner).otherwise(F.coalesce(by_code, by_fc, F.lit(OWNERS["private"])))


def intersection_type(is_intersection: Column, degree: Column, streets: Column) -> Column:
    """From the streets that meet at a node where they are known, else from its degree, which counts two-way roads twice."""
    n = F.when(streets.isNotNull(), F.when(streets >= 5, 5).otherwise(streets)).otherwise(F.when(degree >= 10, 5).when(degree >= 8, 4).when(degree >= 6, 3))
    return F.when(F.coalesce(is_intersection != "Yes", F.lit(True)), NO_CROSSING).when(n == 5, FIVE).when(n == 4, FOUR).when(n == 3, THREE).otherwise(NO_CROSSING)


def alignment(curve_class: Column, is_ramp: Column, grade_class: Column, terrain: Column) -> Column:
    """Ramps first; a grade only where the grade class or rolling terrain says so."""
    grade = F.coalesce(~F.coalesce(grade_class, F.lit("")).isin("", "0"), F.lit(False)) | F.coalesce(terrain >= 2, F.lit(False))
    straight = F.coalesce(curve_class, F.lit(0)) <= 1
    return F.when(is_ramp == "Yes", "10. On/Off Ramp").when(straight & grade, "3. Grade - Straight").when(straight, "1. Straight - Level").when(grade, "4. Grade - Curve").otherwise("2. Curve - Level")


def _medians(df: DataFrame, value: str, keys: list[str], out: str, whole: bool) -> DataFrame:
    known = df.where((F.col(value) > 0) & F.expr(" AND ".join(f"coalesce({k}, '') <> ''" for k in keys)))
    middle = F.percentile(value, F.lit(0.5))
    return known.groupBy(*keys).agg((F.round(middle) if whole else F.floor(middle)).cast("int").alias(out))


def filled_lanes(df: DataFrame) -> DataFrame:
    """Zero lanes are unknown: the class's least number, else the median of the same reference and class."""
    lanes = F.when(F.col("lanes").try_cast("int") > 0, F.col("lanes").try_cast("int"))
    df = df.withColumn("lanes", F.coalesce(lanes, by_class(F.col("fc"), LEAST_LANES)).cast("int"))
    med = _medians(df, "lanes", ["ref", "fc"], "_m", False)
    return df.join(med, ["ref", "fc"], "left").withColumn("lanes", F.coalesce("lanes", F.when(F.col("_m") > 0, F.col("_m")))).drop("_m")


def filled_aadt(df: DataFrame) -> DataFrame:
    """Volumes within one class alone: the segment's own, the median of its reference, of its name, then (not for local
    roads) of its class; with the way told.  What no layer knows stays 0."""
    df = df.withColumn("aadt", F.coalesce(F.col("aadt").try_cast("int"), F.lit(0)))
    df = df.withColumn("aadt_source", F.when(F.col("aadt") > 0, "direct").otherwise(""))
    for key, word in (("ref", "ref_propagation"), ("name", "name_propagation")):
        med = _medians(df, "aadt", [key, "fc"], "_m", True)
        use = (F.col("aadt") == 0) & (F.col("_m") > 0)
        df = df.join(med, [key, "fc"], "left").withColumn("_u", F.coalesce(use, F.lit(False))).withColumns({"aadt": F.when(F.col("_u"), F.col("_m")).otherwise(F.col("aadt")), "aadt_source": F.when(F.col("_u"), word).otherwise(F.col("aadt_source"))}).drop("_m", "_u")
    df = df.withColumn("_k", class_of(F.col("fc")))
    classes = df.where("aadt > 0 AND _k <= 6").groupBy("_k").agg(F.floor(F.percentile("aadt", F.lit(0.5))).cast("int").alias("_m"))  # six rows at most
    use = F.coalesce((F.col("aadt") == 0) & (F.col("_m") > 0), F.lit(False))
    out = df.join(F.broadcast(classes), "_k", "left").withColumn("_u", use)
    return out.withColumns({"aadt": F.when(F.col("_u"), F.col("_m")).otherwise(F.col("aadt")), "aadt_source": F.when(F.col("_u"), "fc_median").otherwise(F.col("aadt_source"))}).drop("_m", "_u", "_k")


def without_duplicates(df: DataFrame) -> DataFrame:
    """One row per ends, name and source: the one of the smallest id.  Roads of other names on the same ends stay."""
    order = Window.partitionBy("u_lat", "u_lon", "v_lat", "v_lon", "name", "road_source").orderBy("seg_id")
    return df.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def planning_and_mpo(planning: Column, mpo: Column, district: Column, county: Column, members: dict[str, list[str]]) -> dict[str, Column]:
    """A planning district that is an MPO's name takes the road district; an MPO is cleared outside its own counties.

    members: MPO name -> its county codes, from the state's hierarchy.  Names are compared without blanks round / and -.
    """
    plain = lambda c: F.regexp_replace(F.lower(F.trim(c)), r"\s*[/\-]\s*", "/")
    wrong = F.lit(False)
    for name, counties in members.items():
        wrong = wrong | ((plain(mpo) == plain(F.lit(name))) & ~county.isin(*counties) & (county != ""))
    return {"planning": F.when(planning.isin(*members) & (planning != district) & (district != ""), district).otherwise(planning), "mpo": F.when(F.coalesce(wrong, F.lit(False)), "").otherwise(mpo)}


def speed_after(speed: Column, resolved: Column, fc: Column) -> Column:
    """The resolved limit where there is one, held inside the class's range; the class's usual speed where nothing is known."""
    now = F.when(F.coalesce(resolved, F.lit(0)) > 0, resolved).otherwise(F.coalesce(speed.try_cast("int"), F.lit(0)))
    low, high = by_class(fc, {k: v[0] for k, v in SPEED_RANGE.items()}), by_class(fc, {k: v[1] for k, v in SPEED_RANGE.items()})
    held = F.when(low.isNull(), now).otherwise(F.greatest(low, F.least(high, now)))
    return F.when(now > 0, held).otherwise(F.coalesce(by_class(fc, USUAL_SPEED), F.lit(0))).cast("int")


def postprocess(inventory: DataFrame, state: str = "", members: dict[str, list[str]] | None = None, resolved_speed: Column | None = None) -> DataFrame:
    """The thirteen repairs in their order; the inventory's columns plus route, intersection, alignment and aadt_source.

    Places by polygon are a join of their own (:func:`kerbline.operators.spatial.point_in_polygon`).
    """
    sz = F.lower(F.trim(F.coalesce("school_zone", F.lit(""))))
    no_data = (F.coalesce("osm_surface", F.lit("")) == "") & F.col("hpms_surface").isNull() & F.coalesce("surface", F.lit("")).isin("3. Brick or Block", "6. Other", CONCRETE, "Not Applicable", "")
    df = inventory.withColumns({
        "ownership": repaired_owner(F.col("ownership"), F.col("hpms_ownership"), F.col("fc")),
        "intersection": intersection_type(F.col("is_intersection"), F.col("degree"), F.col("streets")),
        "alignment": alignment(F.col("curve_class"), F.col("is_ramp"), F.col("grade_class"), F.col("terrain")),
        "surface": F.when(no_data, ASPHALT).otherwise(F.col("surface")),
        "school_zone": F.when(sz.isin("no", "0"), "3. No").when(sz.isin("yes", "1"), "1. Yes").otherwise(F.col("school_zone")),
        "route": route_name(F.col("hpms_route"), F.col("ref"), state),
        "match_ft": F.when(F.col("match_ft") >= 0, F.col("match_ft")),
        "u_node": F.greatest("u_node", F.lit(0)), "v_node": F.greatest("v_node", F.lit(0)),
        "speed": speed_after(F.col("speed"), F.lit(None).cast("int") if resolved_speed is None else resolved_speed, F.col("fc")),
    })
    if members:
        df = df.withColumns(planning_and_mpo(F.col("planning"), F.col("mpo"), F.col("district"), F.col("county"), members))
    return without_duplicates(filled_aadt(filled_lanes(df)))


# Sources ----------------------------------------------------------------------------------------------------


def _yes(*sources: tuple[str, Column]) -> dict[str, Column]:
    """Yes and the highest source that says so, else No; sources from the highest authority down."""
    return by_authority([(name, F.when(F.coalesce(c, F.lit(False)), "Yes")) for name, c in sources], ("", F.lit("No")))


def lanes_in_range(c: Column) -> Column:
    n = F.split(c.cast("string"), ";")[0].try_cast("double").cast("int")
    return F.when(n.between(1, 12), n)


def resolve_lanes(state: Column, federal: Column, tags: Column) -> dict[str, Column]:
    return by_authority([("StateDOT", lanes_in_range(state)), ("HPMS", lanes_in_range(federal)), ("OSM", lanes_in_range(tags))], ("", F.lit(0)))


def resolve_surface(state: Column, federal: Column, tags: Column) -> dict[str, Column]:
    """Paved or Unpaved; blank where no source says."""
    said, tag = F.trim(state), F.lower(F.trim(tags))
    return by_authority([
        ("StateDOT", F.when(said.isin(CONCRETE, ASPHALT, "3. Brick or Block"), "Paved").when(said.isin("4. Slag, Gravel, Stone", "5. Dirt"), "Unpaved")),
        ("HPMS", F.when(federal.isin(1, 2, 3), "Paved").when(federal.isin(4, 5), "Unpaved")),
        ("OSM", F.when(tag.isin(*PAVED), "Paved").when(tag.isin(*UNPAVED), "Unpaved")),
    ], ("", F.lit("")))


def resolve_signals(images: Column, poi: Column, federal: Column) -> dict[str, Column]:
    return _yes(("Mapillary", images == "Yes"), ("POI", poi == "Yes"), ("HPMS", federal > 0))


def resolve_lighting(lights: Column, lit: Column) -> dict[str, Column]:
    return _yes(("Mapillary", lights > 0), ("OSM", F.lower(F.trim(lit)) == "yes"))


def resolve_bridge(structure: Column, tag: Column, near: Column) -> dict[str, Column]:
    return _yes(("HPMS", structure > 0), ("OSM", ~F.lower(F.trim(tag)).isin("", "no", "nan")), ("Federal", near == "Yes"))


def resolve_school_zone(images: Column, near: Column) -> dict[str, Column]:
    return _yes(("Mapillary", images == "Yes"), ("Federal", near == "Yes"))


# Class labels, median and facility codes of the federal table, and open-map classes.
CLASSES = {1: INTERSTATE, 2: "2-Principal Arterial - Other Freeways and Expressways (B)", 3: PRINCIPAL, 4: "4-Minor Arterial (H,3)", 5: "5-Major Collector (I,4)", 6: "6-Minor Collector (5)", 7: "7-Local (J,6)"}
HIGHWAY_CLASS = {"motorway": 1, "motorway_link": 1, "trunk": 2, "trunk_link": 2, "primary": 3, "primary_link": 3, "secondary": 4, "secondary_link": 4, "tertiary": 5, "tertiary_link": 5, "unclassified": 6, "residential": 7, "living_street": 7, "service": 7}
MEDIANS = {1: "1. Two-Way, Not Divided", 2: "2. Two-Way, Divided, Unprotected Median", 3: "3. Two-Way, Divided, Positive Median Barrier", 4: "4. One-Way, Not Divided"}


FACILITIES = {1: ONE_WAY, 2: TWO_WAY, 3: TWO_WAY, 4: DIVIDED, 5: "5-Reversible Exclusively", 6: DIVIDED}
SURFACES = {1: CONCRETE, 2: ASPHALT, 3: ASPHALT, 4: "4. Slag, Gravel, Stone", 5: "5. Dirt", 6: "6. Other", 7: ASPHALT, 8: "5. Dirt", 9: "6. Other", 10: ASPHALT, 11: CONCRETE}
ALIGNMENTS = {1: "1. Straight - Level", 2: "1. Straight - Level", 3: "2. Curve - Level", 4: "4. Grade - Curve", 5: "4. Grade - Curve"}


def _of(c: Column, values: dict) -> Column:
    out = F.lit(None)
    for k, v in values.items():
        out = F.when(c == F.lit(k), F.lit(v)).otherwise(out)
    return out


def standard_columns(inventory: DataFrame) -> DataFrame:
    """The standard columns of a segment from all its sources, each by its own order of authority, with the sources of class, owner and facility.

    Facility and surface are the federal table's alone; alignment goes by the curve's class; speed, lanes and school zone
    are those that :func:`kerbline.operators.authority.resolve_speed`, :func:`resolve_lanes` and :func:`resolve_school_zone` choose.
    """
    from kerbline.operators.authority import resolve_speed
    fc = by_authority([("HPMS", F.when(F.col("hpms_fc") > 0, F.col("hpms_fc"))), ("StateDOT", F.when(F.col("sdot_fc") > 0, F.col("sdot_fc"))), ("OSM", _of(F.trim("highway"), HIGHWAY_CLASS))], ("", F.lit(0)))
    df = inventory.withColumns({"fc_code": fc["value"].cast("int"), "fc_source": fc["source"]})
    by_code = F.lit(None).cast("string")
    for who, codes in OWNER_CODES.items():
        by_code = F.when(F.col("hpms_ownership").isin(*codes), OWNERS[who]).otherwise(by_code)
    state_owner = F.when(F.trim("sdot_ownership").isin(*OWNERS.values()), F.trim("sdot_ownership"))
    owner = by_authority([("HPMS", by_code), ("StateDOT", state_owner)], ("class", F.coalesce(_of(F.col("fc_code"), {k: OWNERS[w] for k, w in OWNER_OF_CLASS.items()}), F.lit(""))))
    name = lambda c, junk: F.when(~F.trim(c).isin("", "nan", *junk) & ~F.trim(c).rlike(r"^-?\d+$"), F.trim(c))
    route = F.coalesce(F.when(~F.trim("sdot_route").isin("", "nan", "0"), F.trim("sdot_route")), name(F.col("hpms_route"), ["0"]), name(F.col("ref"), []), name(F.col("name"), []), F.lit(""))
    signal = resolve_signals(F.col("map_signal"), F.col("poi_signal"), F.col("hpms_signal"))["value"]
    control = F.when(signal == "Yes", "3. Traffic Signal").when((F.col("map_stop") == "Yes") | (F.col("poi_stop") == "Yes"), "4. Stop Sign").when(F.col("map_yield") == "Yes", "8. Yield Sign").otherwise("")
    return df.select(
        "seg_id", F.coalesce(_of(F.col("fc_code"), CLASSES), F.lit("")).alias("fc"), "fc_source", F.coalesce(_of(F.col("fc_code"), SYSTEM), F.lit("")).alias("system"),
        owner["value"].alias("ownership"), F.when(owner["source"] == "class", F.col("fc_source")).otherwise(owner["source"]).alias("ownership_source"),
        F.coalesce(_of(F.col("hpms_median"), MEDIANS), F.lit("")).alias("description"), route.alias("route"),
        F.when(F.coalesce("mpo", F.lit("")) != "", "Urban").otherwise("Rural").alias("area_type"), control.alias("control"),
        intersection_type(F.col("is_intersection"), F.col("degree"), F.col("streets")).alias("intersection"),
        F.coalesce(_of(F.col("hpms_facility"), FACILITIES), F.lit("")).alias("facility"), F.when(F.col("hpms_facility") > 0, "HPMS").otherwise("").alias("facility_source"), F.coalesce(_of(F.col("hpms_surface"), SURFACES), F.lit("")).alias("surface"),
        F.coalesce(_of(F.col("curve_class"), ALIGNMENTS), F.lit("")).alias("alignment"), resolve_school_zone(F.col("map_school"), F.col("near_school"))["value"].alias("school_zone"),
        resolve_speed(F.col("sdot_speed"), F.col("hpms_speed"), F.col("map_speed"), F.col("maxspeed"), F.col("fc_code") == 7, F.col("mpo") != "", F.col("fc_code").isin(5, 6))["value"].alias("speed"),
        resolve_lanes(F.col("sdot_lanes"), F.col("hpms_lanes"), F.col("osm_lanes"))["value"].alias("lanes"),
    )


def agreement_scores(inventory: DataFrame, beside: bool = False) -> DataFrame:
    """How many sources confirm signal, crosswalk, stop sign, school zone, speed and bridge, and the confidence that follows; ``beside`` the other columns or alone."""
    one = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    plain = lambda n, scale: F.when(n >= 3, scale[2]).when(n == 2, scale[1]).when(n == 1, scale[0]).otherwise(0)
    c = F.col
    crossing = one(c("poi_crossing") == "Yes") + one(c("map_crosswalks") > 0)
    stop = one(c("poi_stop") == "Yes") + one(c("map_stop") == "Yes")
    counts = {
        "signal": one(c("hpms_signal") > 0) + one(c("poi_signal") == "Yes") + one(c("map_signal") == "Yes"),
        "crosswalk": crossing + one((c("map_stop_lines") > 0) & (crossing > 0)),
        "stop_sign": stop + one((c("map_stop_ahead") == "Yes") & (stop > 0)) + one(c("hpms_stops") > 0),
        "school_zone": one(c("near_school") == "Yes") + one(c("map_school") == "Yes"),
        "speed": one(speed_in_range(c("sdot_speed")).isNotNull()) + one(speed_in_range(c("hpms_speed")).isNotNull()) + one(c("map_speed") != "") + one(c("maxspeed") != ""),
        "bridge": one(F.lower(F.trim("bridge")).isin("yes", "viaduct", "movable", "cantilever")) + one(c("near_bridge") == "Yes"),
    }
    scales = {"school_zone": (50, 90, 90), "bridge": (50, 90, 90), "speed": (50, 80, 95)}
    out = inventory.select("*" if beside else "seg_id", *[n.alias(f"{k}_sources") for k, n in counts.items()])
    return out.withColumns({f"{k}_confidence": plain(F.col(f"{k}_sources"), scales.get(k, (50, 75, 90))) for k in counts})


def risk_indicators(inventory: DataFrame, speeds: dict[int, Column], beside: bool = False) -> DataFrame:
    """Speed transition, crosswalks without signal, school exposure, bridge condition and road departure, 0 to 100.

    speeds: limit -> how many signs of it stand near the segment; ``beside`` the other columns or alone.
    """
    from kerbline.operators.authority import speed_transition

    c, one = F.col, lambda x: F.coalesce(x, F.lit(False)).cast("int")
    number = lambda x: F.coalesce(x.try_cast("double"), F.lit(0.0))
    moves = speed_transition(speeds)
    crossing = F.coalesce(c("map_crosswalks") > 0, F.lit(False)) | F.coalesce(c("poi_crossing") == "Yes", F.lit(False))
    signal = resolve_signals(c("map_signal"), c("poi_signal"), c("hpms_signal"))["value"]
    ft, pupils = F.coalesce(c("school_ft").try_cast("double"), F.lit(9999.0)), number(c("school_pupils"))
    near = F.when(ft <= 500, 40).when(ft <= 1000, 25).when(ft <= 1500, 15).otherwise(0)
    school = near + F.when(pupils > 1000, 30).when(pupils > 500, 20).when(pupils > 0, 10).otherwise(0) + F.when(c("map_school") == "Yes", 20).otherwise(0) + F.least(F.greatest(number(c("schools")) - 1, F.lit(0.0)) * 10, F.lit(30.0)).cast("int")
    state, built, width = F.lower(F.trim(F.coalesce("bridge_condition", F.lit("")))), number(c("bridge_year")), number(c("bridge_width"))
    worn = F.when(state == "poor", 60).when(state == "fair", 30).when(state == "good", 10).when(state.isin("unknown", ""), 20).otherwise(15)
    age = F.when((built > 0) & (built < 1940), 30).when((built >= 1940) & (built < 1960), 20).when((built >= 1960) & (built < 1990), 10).when(built >= 1990, 5).otherwise(15)
    signs = one(c("map_guard_rail") == "Yes") + one(number(c("hpms_curve")) > 0) + one(number(c("grade_class")) > 0) + one(F.coalesce(c("curvature"), F.lit(1.0)) > 1.5) + one(c("map_turn") == "Yes") + one(c("map_winding") == "Yes")
    fast = F.coalesce(speed_in_range(c("hpms_speed")), F.lit(0)) > 45
    return inventory.select(
        "*" if beside else "seg_id", moves["transition"].alias("speed_transition"), moves["diff"].alias("speed_transition_diff"), F.when(crossing & (signal != "Yes"), "Yes").otherwise("No").alias("unsignalized_crosswalk"),
        F.when(c("near_school") == "Yes", F.least(school, F.lit(100))).otherwise(0).alias("school_exposure"),
        F.when(c("near_bridge") == "Yes", F.least(worn + age + F.when((width > 0) & (width < 8), 10).otherwise(0), F.lit(100))).otherwise(0).alias("bridge_risk"),
        F.when(signs > 0, "Yes").otherwise("No").alias("departure_curve"), F.least(F.least(signs * 25, F.lit(75)) + F.when(fast & (signs > 0), 25).otherwise(0), F.lit(100)).alias("departure_score"),
    )
