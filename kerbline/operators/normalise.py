"""State files to the standard crash table: one layout per state, applied as one projection.

A layout names, for each standard column, the source's spellings; how its values are mapped; and which flags any
of several columns sets.  Layouts are plain data, so a new state is a new entry.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.functions.severity import severity_from_counts
from kerbline.functions.text import blank_to_null, military_time, parse_datetime, yes_no
from kerbline.operators.clean import map_values


@dataclass(frozen=True)
class Layout:
    """required and optional: headers that tell the layout; aliases: standard -> source columns, the first filled one counts."""

    required: tuple[str, ...]
    aliases: dict[str, tuple[str, ...]]
    optional: tuple[str, ...] = ()
    severity: dict[str, str] = field(default_factory=dict)
    counts: tuple[str, ...] = ()  # people killed and hurt, gravest first, where severity comes from counts
    values: dict[str, dict[str, str]] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)  # what a value becomes that its map doesn't have; else it stays
    flags: dict[str, tuple[tuple[str, ...], str]] = field(default_factory=dict)  # flag -> (columns, pattern)
    ages: dict[str, tuple[tuple[str, ...], int, int]] = field(default_factory=dict)  # flag -> (columns, least, most)
    id_parts: tuple[str, ...] = ()
    prefix: str = ""  # of source columns that are kept as they are
    kept: tuple[str, ...] = ()


def _each(label: str, *raw: str) -> dict[str, str]:
    return dict.fromkeys(raw, label)


_UNITS = ("TU-1", "TU-2")
_both = lambda name: tuple(f"{u} {name}" for u in _UNITS)

# Headers, spellings and value maps of the known layouts.
CLEAR = "1. No Adverse Condition (Clear/Cloudy)"
CO_FIXED = (
    "Light Pole/Utility Pole", "Traffic Signal Pole", "Concrete Highway Barrier", "Guardrail Face", "Guardrail End", "Cable Rail", "Tree", "Fence", "Sign", "Curb", "Embankment", "Ditch", "Large Rocks or Boulder",
    "Electrical/Utility Box", "Electical/Utility Box", "Crash Cushion/Traffic Barrel", "Mailbox", "Delineator/Milepost", "Culvert or Headwall", "Wall or Building", "Barricade", "Bridge Structure (Not Overhead)",
    "Overhead Structure (Not Bridge)", "Railroad Crossing Equipment", "Other Fixed Object (Describe in Narrative)",
)
CO_COLLISION = (
    _each("1. Rear End", "Rear-End", "Front to Rear") | _each("2. Angle", "Broadside", "Front to Side", "Rear to Side", "Approach Turn", "Overtaking Turn") | _each("3. Head On", "Head-On", "Front to Front")
    | _each("4. Sideswipe - Same Direction", "Sideswipe Same Direction", "Side to Side-Same Direction") | _each("5. Sideswipe - Opposite Direction", "Sideswipe Opposite Direction", "Side to Side-Opposite Direction")
    | _each("8. Non-Collision", "Overturning/Rollover", "Other Non-Collision", "Fell from Motor Vehicle", "Ground") | _each("12. Ped", "Pedestrian", "School Age To/From School") | _each("13. Bicycle", "Bicycle/Motorized Bicycle")
    | _each("10. Deer/Animal", "Wild Animal", "Domestic Animal") | _each("9. Fixed Object - Off Road", *CO_FIXED) | _each("11. Fixed Object in Road", "Vehicle Debris or Cargo")
)
CO_WEATHER = _each(CLEAR, "Clear", "Cloudy") | _each("5. Rain", "Rain") | _each("4. Snow", "Snow", "Blowing Snow") | _each("6. Sleet/Hail/Freezing", "Sleet, Hail (Freezing Rain or Drizzle)", "Freezing Rain or Freezing Drizzle", "Sleet or Hail") | _each("3. Fog/Smog/Smoke", "Fog") | _each("7. Blowing Sand/Dust", "Blowing Sand, Soil, Dirt", "Dust") | _each("8. Severe Crosswinds", "Severe Crosswinds", "Wind")
CO_LIGHT = _each("2. Daylight", "Daylight") | _each("4. Darkness - Road Lighted", "Dark \u2013 Lighted", "Dark - Lighted") | _each("5. Darkness - Road Not Lighted", "Dark \u2013 Unlighted", "Dark - Unlighted") | _each("1. Dawn", "Dawn or Dusk")
_ICY = " W/Visible Icy Road Treatment"
CO_SURFACE = (
    _each("1. Dry", "Dry", f"Dry{_ICY}") | _each("2. Wet", "Wet", f"Wet{_ICY}") | _each("3. Snow", "Snow", "Snowy", f"Snowy{_ICY}") | _each("5. Ice", "Ice", "Icy", f"Icy{_ICY}") | _each("4. Slush", "Slush", "Slushy", f"Slushy{_ICY}")
    | _each("6. Sand/Mud/Dirt/Oil/Gravel", "Sand, Mud, Dirt, Oil, Gravel", "Sand/Gravel", "Muddy") | _each("7. Water", "Water (Standing, Moving)") | _each("16. Other", "Roto-Milled", "Other")
)
CO_INTERSECTION = _each("1. Not at Intersection", "Non-Intersection", "Ramp", "Ramp-related", "Crossover-Related", "Express/Managed/HOV Lane", "Auxiliary Lane", "Mid-Block Crosswalk") | _each("4. Four Approaches", "At Intersection", "Intersection Related", "Alley Related") | _each("2. Two Approaches", "Driveway Access Related", "Railroad Crossing Related") | _each("5. Roundabout", "Roundabout")
CO_RELATION = _each("8. Non-Intersection", "Non-Intersection", "Driveway Access Related", "Alley Related", "Railroad Crossing Related", "Mid-Block Crosswalk") | _each("9. Within Intersection", "At Intersection", "Roundabout") | _each("10. Intersection Related - Within 150 Feet", "Intersection Related") | _each("2. Acceleration/Deceleration Lanes", "Ramp", "Ramp-related") | _each("1. Main-Line Roadway", "Crossover-Related", "Express/Managed/HOV Lane", "Auxiliary Lane")
CO_SYSTEM = {"City Street": "Non-DOT secondary", "County Road": "Non-DOT secondary", "State Highway": "Primary", "Interstate Highway": "Interstate", "Frontage Road": "Secondary"}
CO_OWNER = {"Interstate Highway": "1. State Hwy Agency", "State Highway": "1. State Hwy Agency", "County Road": "2. County Hwy Agency", "City Street": "3. City or Town Hwy Agency", "Frontage Road": "1. State Hwy Agency"}
CO_DESCRIPTION = {"Interstate Highway": "3. Two-Way, Divided, Positive Median Barrier", "State Highway": "2. Two-Way, Divided, Unprotected Median"}
CO_PLACE = {"On Roadway": "1. On Roadway", "Center median/ Island": "3. Median", "Ran off left side": "4. Roadside", "Ran off right side": "4. Roadside", "Shoulder": "2. Shoulder", "In Parking Lane": "1. On Roadway", "Gore": "5. Gore", "On private property": "9. Outside Right-of-Way"}
VA_COLLISION = {"0": "Not Applicable", "1": "1. Rear End", "2": "2. Angle", "3": "3. Head On", "4": "4. Sideswipe - Same Direction", "5": "5. Sideswipe - Opposite Direction", "6": "6. Fixed Object in Road", "7": "7. Train", "8": "8. Non-Collision", "9": "9. Fixed Object - Off Road", "10": "10. Deer", "11": "11. Other Animal", "12": "12. Ped", "13": "13. Bicyclist", "14": "14. Motorcyclist", "15": "15. Backed Into", "16": "16. Other", "99": "Not Provided"}
VA_WEATHER = {"1": CLEAR, "3": "3. Fog", "4": "4. Mist", "5": "5. Rain", "6": "6. Snow", "7": "7. Sleet/Hail", "8": "8. Smoke/Dust", "9": "9. Other", "10": "10. Blowing Sand, Soil, Dirt, or Snow", "11": "11. Severe Crosswinds", "99": "Not Applicable"}
VA_LIGHT = {"1": "1. Dawn", "2": "2. Daylight", "3": "3. Dusk", "4": "4. Darkness - Road Lighted", "5": "5. Darkness - Road Not Lighted", "6": "6. Darkness - Unknown Road Lighting", "7": "7. Unknown", "99": "Not Applicable"}
VA_SURFACE = {"1": "1. Dry", "2": "2. Wet", "3": "3. Snowy", "4": "4. Icy", "5": "5. Muddy", "6": "6. Oil/Other Fluids", "7": "7. Other", "8": "8. Natural Debris", "9": "9. Water (Standing, Moving)", "10": "10. Slush", "11": "11. Sand, Dirt, Gravel", "99": "Not Applicable"}
VA_ALIGNMENT = {"1": "1. Straight - Level", "2": "2. Curve - Level", "3": "3. Grade - Straight", "4": "4. Grade - Curve", "5": "5. Hillcrest - Straight", "6": "6. Hillcrest - Curve", "7": "7. Dip - Straight", "8": "8. Dip - Curve", "9": "9. Other", "10": "10. On/Off Ramp", "99": "Not Applicable"}
VA_INTERSECTION = {"1": "1. Not at Intersection", "2": "2. Two Approaches", "3": "3. Three Approaches", "4": "4. Four Approaches", "5": "5. Five-Point, or More", "6": "6. Roundabout", "99": "Not Applicable"}
MD_COLLISION = (
    _each("1. Rear End", "same dir rear end", "same direction rear end", "rear end") | _each("2. Angle", "angle", "angle meets left head on", "angle meets left turn", "angle meets right turn") | _each("3. Head On", "head on", "head on left turn", "opposite direction both left turn")
    | _each("4. Sideswipe - Same Direction", "same direction sideswipe", "same direction both left turn", "same direction both right turn", "same direction left turn", "same direction right turn") | _each("5. Sideswipe - Opposite Direction", "opposite direction sideswipe") | _each("14. Fixed Object", "single vehicle") | _each("16. Other", "other", "unknown")
)
MD_WEATHER = _each(CLEAR, "clear", "cloudy") | _each("5. Rain", "raining") | _each("3. Fog/Smog/Smoke", "foggy") | _each("4. Snow", "snow", "blowing snow") | _each("6. Sleet/Hail/Freezing", "sleet") | _each("7. Blowing Sand/Dust", "blowing sand/dirt/snow", "blowing sand, soil, dirt") | _each("8. Severe Crosswinds", "severe crosswinds")
MD_LIGHT = _each("2. Daylight", "daylight") | _each("4. Darkness - Road Lighted", "dark lights on", "dark-lights on") | _each("5. Darkness - Road Not Lighted", "dark no lights", "dark-no lights") | _each("1. Dawn", "dawn") | _each("3. Dusk", "dusk") | _each("6. Dark - Unknown", "dark - unknown lighting", "dark -- unknown lighting")
YES_WORDS = "^(Yes|Y|1|TRUE|true)$"
LAYOUTS = {
    "colorado": Layout(
        ("CUID", "System Code", "Injury 00", "Injury 04"),
        {
            "document": ("CUID",), "crash_datetime": ("Crash Date",), "crash_time": ("Crash Time",), "collision_raw": ("Crash Type", "MHE"), "weather_raw": ("Weather Condition",), "light_raw": ("Lighting Conditions",), "surface_raw": ("Road Condition",), "intersection_raw": ("Road Description",),
            "relation_raw": ("Road Description",), "system_raw": ("System Code",), "ownership_raw": ("System Code",), "description_raw": ("System Code",), "harmful_place_raw": ("Location",), "juris": ("County",), "lat": ("Latitude",), "lon": ("Longitude",), "vehicles": ("Total Vehicles",),
        },
        optional=("Rd_Number", "Rd_Section", "MHE"), counts=("Injury 04", "Injury 03", "Injury 02", "Injury 01"),
        values={"collision_raw": CO_COLLISION, "weather_raw": CO_WEATHER, "light_raw": CO_LIGHT, "surface_raw": CO_SURFACE, "intersection_raw": CO_INTERSECTION, "relation_raw": CO_RELATION, "system_raw": CO_SYSTEM, "ownership_raw": CO_OWNER, "description_raw": CO_DESCRIPTION, "harmful_place_raw": CO_PLACE},
        defaults={"collision_raw": "16. Other", "intersection_raw": "1. Not at Intersection", "system_raw": "Non-DOT secondary", "ownership_raw": "", "description_raw": "1. Two-Way, Not Divided"},
        flags={
            "is_ped": ((*_both("NM Type"), "Crash Type", "MHE"), "Pedestrian|^School Age To/From School$"), "is_bike": ((*_both("NM Type"), "Crash Type", "MHE"), "Bicycle"), "is_hitrun": (_both("Hit And Run"), "^TRUE$"), "is_alcohol": (_both("Alcohol Suspected"), "^Yes"),
            "is_speed": ((*_both("Driver Action"), *_both("Human Contributing Factor")), "^(Too Fast for Conditions|Exceeded Speed Limit|Exceeded Safe/Posted Speed|Speeding)$"), "is_motorcycle": (_both("Type"), "Motorcycle"), "is_distracted": ((*_both("Driver Action"), *_both("Human Contributing Factor")), "Distract|Cell Phone|Texting"),
            "is_drowsy": (_both("Human Contributing Factor"), "Asleep|Fatigue|Drowsy"), "is_drug": (("TU-1  Marijuana Suspected", "TU-2 Marijuana Suspected", "TU-1 Other Drugs Suspected ", "TU-2 Other Drugs Suspected "), "^Yes"), "is_unrestrained": (_both("Safety restraint Use"), "^(Not Used|Improperly Used)$"),
            "is_animal": (("Wild Animal", "Crash Type", "MHE"), "Animal|Deer|Elk|Bear"), "is_guardrail": (("MHE", "Crash Type", "First HE"), "Guardrail"), "is_lgtruck": (_both("Type"), "Medium/Heavy Truck|Truck/Tractor|Truck Tractor|Semi-Trailer|Bus|Working Vehicle|Farm Equipment"),
            "is_school_zone": (("School Zone",), "^(TRUE|True)$"), "is_work_zone": (("Construction Zone",), "^(TRUE|True)$"), "is_night": (("Lighting Conditions",), "^Dark"),
        },
        ages={"is_young": (_both("Age"), 16, 20), "is_senior": (_both("Age"), 65, 999)}, prefix="co", kept=("System Code", "Agency Id", "Rd_Number", "Location 1", "Location 2", "City"),
    ),
    "maryland": Layout(
        ("report_number", "acrs_report_type", "road_name"),
        {"document": ("report_number", "report_no"), "crash_datetime": ("crash_date_time", "acc_date"), "route": ("road_name",), "collision_raw": ("collision_type", "collision_type_desc"), "weather_raw": ("weather", "weather_desc"), "light_raw": ("light", "light_desc"), "severity_raw": ("acrs_report_type", "report_type"), "lat": ("latitude",), "lon": ("longitude",)},
        optional=("crash_date_time", "collision_type", "municipality", "weather", "light"), severity={"Fatal Crash": "K", "Injury Crash": "B", "Property Damage Crash": "O"},
        values={"collision_raw": MD_COLLISION, "weather_raw": MD_WEATHER, "light_raw": MD_LIGHT}, defaults={"collision_raw": "16. Other"}, flags={"is_hitrun": (("hit_run",), YES_WORDS)},
    ),
    "maryland_statewide": Layout(
        ("report_no", "acrs_report_type", "road_name", "county_desc"),
        {"document": ("report_no", "report_number"), "crash_datetime": ("acc_date", "crash_date_time"), "route": ("road_name",), "collision_raw": ("collision_type_desc", "collision_type"), "weather_raw": ("weather_desc", "weather"), "light_raw": ("light_desc", "light"), "severity_raw": ("acrs_report_type", "report_type"), "juris": ("county_desc",), "lat": ("latitude",), "lon": ("longitude",)},
        optional=("acc_date", "collision_type_desc", "weather_desc", "light_desc"), severity={"Fatal Crash": "K", "Injury Crash": "B", "Property Damage Crash": "O"},
        values={"collision_raw": MD_COLLISION, "weather_raw": MD_WEATHER, "light_raw": MD_LIGHT}, defaults={"collision_raw": "16. Other"}, flags={"is_hitrun": (("hit_run",), YES_WORDS)},
    ),
    "delaware": Layout(
        ("crash_datetime", "crash_classification_description", "latitude", "longitude"), {"crash_datetime": ("crash_datetime", "CRASH DATETIME"), "collision_raw": ("manner_of_impact_description",), "weather_raw": ("weather_1_description",), "severity_raw": ("crash_classification_description",), "juris": ("county_name",), "lat": ("latitude",), "lon": ("longitude",)},
        optional=("manner_of_impact_description", "weather_1_description", "county_name", "alcohol_involved", "drug_involved", "motorcycle_involved"),
        severity={"fatality crash": "K", "fatal crash": "K", "personal injury crash": "B", "property damage only": "O", "property damage crash": "O", "non-reportable": "O"}, flags={"is_alcohol": (("alcohol_involved",), "^(Y|Yes|1)$"), "is_ped": (("pedestrian_involved",), "^(Y|Yes|1)$"), "is_drug": (("drug_involved",), "^(Y|Yes|1)$"), "is_motorcycle": (("motorcycle_involved",), "^(Y|Yes|1)$")}, id_parts=("crash_datetime", "lat", "lon"),
    ),
    "virginia": Layout(
        ("Document Nbr", "Crash Severity", "RTE Name", "SYSTEM"),
        {"document": ("Document Nbr",), "crash_datetime": ("Crash Date",), "route": ("RTE Name",), "node": ("Node",), "severity_raw": ("Crash Severity",), "collision_raw": ("Collision Type",), "weather_raw": ("Weather Condition",), "light_raw": ("Light Condition",), "surface_raw": ("Roadway Surface Condition",), "alignment_raw": ("Roadway Alignment",), "intersection_raw": ("Intersection Type",), "juris": ("Physical Juris Name",)},
        optional=("K_People", "A_People", "Node", "Physical Juris Name"), severity={k: k for k in "KABCO"},
        values={"collision_raw": VA_COLLISION, "weather_raw": VA_WEATHER, "light_raw": VA_LIGHT, "surface_raw": VA_SURFACE, "alignment_raw": VA_ALIGNMENT, "intersection_raw": VA_INTERSECTION},
        flags={"is_ped": (("Pedestrian?",), "^(Yes|Y|1)$"), "is_alcohol": (("Alcohol?",), "^(Yes|Y|1)$")},
    ),
}


def normalise(raw: DataFrame, layout: Layout) -> DataFrame:
    """Standard columns of one state's file: document, crash_date, year, military, severity, texts and Yes/No flags.

    Source columns that a layout keeps come along with its prefix; a flag no column of the file tells is null, not No.
    """
    have = {c.strip().lower(): c for c in raw.columns}
    there = lambda c: c.strip().lower() in have
    of = lambda c: blank_to_null(F.col(f"`{have[c.strip().lower()]}`")) if there(c) else F.lit(None).cast("string")
    said = {t: F.coalesce(*[of(a) for a in names]) for t, names in layout.aliases.items()}
    when = parse_datetime(said.get("crash_datetime", F.lit(None).cast("string")))
    military = military_time(when)
    if "crash_time" in said:
        military = F.coalesce(F.substring(F.replace(said["crash_time"], F.lit(":"), F.lit("")), 1, 4), military)
    if layout.counts:
        severity: Column = severity_from_counts(*[F.coalesce(of(c).try_cast("int"), F.lit(0)) for c in layout.counts])
    else:
        lower = {k.lower(): v for k, v in layout.severity.items()}
        severity = map_values(F.lower(said["severity_raw"]), lower, F.lit("O"))

    def mapped(t, c):
        known = layout.values[t]
        # Maps written in lower case fit any case.
        key = F.lower(c) if all(k == k.lower() for k in known) else c
        return map_values(key, known, F.lit(layout.defaults[t]) if t in layout.defaults else c)

    out = {t: mapped(t, c) if t in layout.values else c for t, c in said.items() if t not in ("crash_datetime", "crash_time", "severity_raw")}
    if "light_raw" in out:  # one word for both twilights: the hour tells which
        out["light_raw"] = F.when((out["light_raw"] == "1. Dawn") & (said["light_raw"] == "Dawn or Dusk") & (military.try_cast("int") >= 1200), "3. Dusk").otherwise(out["light_raw"])
    if layout.id_parts:
        out["document"] = F.concat_ws("-", *[F.coalesce(said[p], F.lit("")) for p in layout.id_parts])
    tracked = lambda columns, c: yes_no(c) if any(map(there, columns)) else F.lit(None).cast("string")
    flags = {k: tracked(columns, any_matches([of(c) for c in columns if there(c)], pattern)) for k, (columns, pattern) in layout.flags.items()}
    flags |= {k: tracked(columns, any_between([of(c) for c in columns if there(c)], lo, hi)) for k, (columns, lo, hi) in layout.ages.items()}
    kept = {f"{layout.prefix}_{slug(c)}": of(c) for c in layout.kept if there(c)}
    return raw.select(when.cast("date").alias("crash_date"), F.year(when).alias("year"), military.alias("military"), severity.alias("severity"), *[c.alias(t.removesuffix("_raw")) for t, c in out.items()], *[c.alias(k) for k, c in flags.items()], *[c.alias(k) for k, c in kept.items()])


def slug(name: str) -> str:
    return "_".join(name.lower().replace("_", " ").split())


def any_matches(columns: list[Column], pattern: str) -> Column:
    """Whether any of several columns, such as a crash's units, fits a pattern."""
    if not columns:
        return F.lit(False)
    return F.exists(F.array(*columns), lambda x: F.coalesce(F.rlike(x, F.lit(pattern)), F.lit(False)))


def any_between(columns: list[Column], least: int, most: int) -> Column:
    """Whether any of several columns is a whole number in a range."""
    if not columns:
        return F.lit(False)
    return F.exists(F.array(*[c.try_cast("int") for c in columns]), lambda x: F.coalesce(x.between(least, most), F.lit(False)))


def coalesce_aliases(raw: DataFrame, aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """Each standard column from the first of its source columns that is filled; sources a file lacks are passed over."""
    have = {c.lower(): c for c in raw.columns}
    told = {t: [blank_to_null(F.col(f"`{have[a.lower()]}`")) for a in names if a.lower() in have] for t, names in aliases.items()}
    return raw.select(*[(F.coalesce(*c) if c else F.lit(None).cast("string")).alias(t) for t, c in told.items()])


def route_by_system(system: Column, number: Column, first: Column) -> Column:
    """Route names by road system: I- and CO- numbers without zeros before and letters behind, named roads, frontage roads."""
    plain, first = F.regexp_replace(F.coalesce(number, F.lit("")), "^0+|[A-Za-z]+$", ""), F.coalesce(F.trim(first), F.lit(""))
    other = lambda otherwise: F.when(first != "", first).otherwise(otherwise)
    return (
        F.when(system == "Interstate Highway", F.when(plain != "", F.concat(F.lit("I-"), plain)).otherwise(other(F.concat(F.lit("I-"), number))))
        .when(system == "State Highway", other(F.concat(F.lit("CO-"), F.when(plain != "", plain).otherwise(number))))
        .when(system == "Frontage Road", F.when(first != "", F.concat(first, F.lit(" (Frontage)"))).otherwise(F.concat(F.lit("Frontage Rd "), number)))
        .otherwise(other(F.concat(F.lit("Road "), number)))
    )


def node_of_roads(relation: Column, a: Column, b: Column) -> Column:
    """``A & B`` in order where the crash lies at a crossing of two named roads, else blank."""
    at = relation.isin("At Intersection", "Intersection Related", "Roundabout") & (F.trim(a) != "") & (F.trim(b) != "")
    return F.when(at, F.array_join(F.array_sort(F.array(F.trim(a), F.trim(b))), " & ")).otherwise("")


#: Words of harmful events that stand beside the road.
DEPARTED = "Tree|Utility Pole|Guard Rail|Guardrail|Fence|Embankment|Ditch|Concrete Highway Barrier|Cable Rail|Culvert|Overturning|Rollover|Large Rocks|Sign|Mailbox|Crash Cushion|Wall or Building|Barricade|Bridge Structure"


def departure_type(*events: Column) -> Column:
    return F.when(any_matches(list(events), DEPARTED), "RD_UNKNOWN").otherwise("NOT_RD")


def alignment_of(curve: Column, grade: Column) -> Column:
    bent, steep = F.coalesce(curve.isin("Curve Right", "Curve Left"), F.lit(False)), F.coalesce(grade.isin("Uphill", "Downhill", "Hill Crest"), F.lit(False))
    return F.when(bent & steep, "4. Grade - Curve").when(bent, "2. Curve - Level").when(steep, "3. Grade - Straight").otherwise("1. Straight - Level")


def detect(columns: list[str]) -> str:
    """The first layout whose required headers are all there; else the one with the largest share of required and optional headers over one half; else ``unknown``."""
    have = {c.strip().lower() for c in columns}
    for kind, layout in LAYOUTS.items():
        if all(c.lower() in have for c in layout.required):
            return kind
    share = {k: sum(c.lower() in have for c in v.required + v.optional) / len(v.required + v.optional) for k, v in LAYOUTS.items()}
    best = max(share, key=lambda k: share[k])
    return best if share[best] > 0.5 else "unknown"


def detect_and_normalise(raw: DataFrame) -> DataFrame:
    """The layout is told by the headers alone; nothing is read for that."""
    kind = detect(raw.columns)
    if kind == "unknown":
        raise ValueError(f"no layout fits the columns {raw.columns}")
    return normalise(raw, LAYOUTS[kind]).withColumn("state", F.lit(kind))
