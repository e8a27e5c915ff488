"""State road layers to standard segment columns: one stated layout per state, applied as one projection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.functions.text import OWNERS
from kerbline.operators.clean import map_values
from kerbline.operators.roads import ASPHALT, CONCRETE, DIVIDED, ONE_WAY, OWNER_OF_CLASS, SYSTEM, TWO_WAY

# Class labels of state layers, and each layer's codes.
SHORT = {1: "1-Interstate", 2: "2-Freeway/Expressway", 3: "3-Principal Arterial", 4: "4-Minor Arterial", 5: "5-Major Collector", 6: "6-Minor Collector", 7: "7-Local"}
CLASS_WORDS = {"Interstate": 1, "Other Freeways": 2, "Other Principal": 3, "Minor Arterial": 4, "Major Collector": 5, "Minor Collector": 6, "Local": 7}
S, C, M, FED, PRIVATE = (OWNERS[k] for k in ("state", "county", "city", "federal", "private"))
INACTIVE = "proposed|deleted|retired|removed|abandoned"


@dataclass(frozen=True)
class RoadLayer:
    """Columns of a layer and what its codes mean; a column it lacks is left out ('')."""

    fc: str
    owners: tuple[tuple[str, dict[str, str], bool], ...]  # column, words or codes, whether a word may stand anywhere in it
    fallback: str = ""  # owner where nothing tells; '' for the class's owner
    surface: str = ""
    surfaces: dict[str, str] = field(default_factory=dict)
    direction: str = ""
    directions: dict[str, str] = field(default_factory=dict)
    median: str = ""
    lanes: str = ""
    speed: str = ""
    area: str = ""
    areas: dict[str, str] = field(default_factory=dict)
    route: str = ""
    status: str = ""


_DE_SURFACE = {"1": CONCRETE, "2": ASPHALT, "3": ASPHALT, "4": "4. Slag, Gravel, Stone", "5": "5. Dirt", "6": "6. Other", "9": "6. Other", "BITM": ASPHALT, "CONC": CONCRETE, "GRVL": "4. Slag, Gravel, Stone", "DIRT": "5. Dirt"}
_CO_SURFACE = {"Concrete": CONCRETE, "Asphalt": ASPHALT, "Bituminous": ASPHALT, "Composite": "3. Composite", "Gravel": "5. Gravel", "Dirt": "6. Dirt"}
_VA_MAINTAINED = {"NATIONAL PARK": FED, "MILITARY": FED, "FOREST SERVICE": FED, "CORPS": FED, "FEDERAL": FED, "PRIVATE": PRIVATE, "NOT MAINTAINED": PRIVATE, "STATE": S, "VDOT": S, "COUNTY": C, "CITY": M, "MUNICIPAL": M, "TOWN": M, "OTHER": PRIVATE}
_VA_CATEGORY = {"Interstate": S, "Primary": S, "Secondary": C, "Urban Streets": M, "Urban": M, "Frontage": S, "Ramp": S}
LAYERS = {
    "va": RoadLayer("TMPD_FUNCTIONAL_CLASS_NM", (("RIM_MAINT_RESPONSIBILITY_NM", _VA_MAINTAINED, True), ("RTE_CATEGORY_NM", _VA_CATEGORY, False)), lanes="LANES", speed="SPEED", route="RTE_NM"),
    "co": RoadLayer("FUNCCLASS", (), fallback=S, surface="PRISURF", surfaces=_CO_SURFACE, direction="ISDIVIDED", directions={"Y": DIVIDED, "Yes": DIVIDED, "1": DIVIDED}, lanes="THRULNQTY", speed="SPEEDLIM", route="ROUTE"),
    "de": RoadLayer(
        "FC", (("MAINT_RSP", {"D": S, "S": S, "C": S, "M": M, "O": PRIVATE, "1": S, "2": M, "3": PRIVATE}, False), ("OWNERSHIP", {"1": S, "2": C, "3": M, "4": S, "5": PRIVATE, "6": FED, "S": S, "C": C, "M": M}, False)), surface="SURFACE", surfaces=_DE_SURFACE,
        direction="TRAFFIC_DIR", directions={"1": TWO_WAY, "2": ONE_WAY, "3": DIVIDED, "5": TWO_WAY, "N": ONE_WAY, "S": ONE_WAY, "E": ONE_WAY, "W": ONE_WAY, "B": TWO_WAY}, median="MEDIAN", lanes="LANES", area="AREA", areas={"1": "Urban", "2": "Rural", "3": "Suburban", "U": "Urban", "R": "Rural", "S": "Suburban"}, route="ROUTE_NO", status="STATUS",
    ),
    "in": RoadLayer("FUNCTIONAL_CLASS", (("ROUTE_ID", {"^I": S, "^U": S, "^S": S, "^L": C, "^C": C, "^M": M, "^T": M}, True),), route="ROUTE_ID", status="RECORD_STATUS"),
}


def class_number(c: Column) -> Column:
    """From a leading digit, also of ``7.0`` or ``3  Principal Arterial - Other``, else from the class's words; null for none."""
    text = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    words = F.coalesce(*[F.when(text.startswith(w), k) for w, k in CLASS_WORDS.items()])
    return F.coalesce(F.regexp_extract(text, r"^([1-7])(?:\D|$)", 1).try_cast("int"), words)


def owner_of(raw, layer: RoadLayer, number: Column) -> Column:
    told = []
    for column, words, anywhere in layer.owners:
        said = F.trim(F.coalesce(raw(column), F.lit("")))
        told.append(F.coalesce(*[F.when(F.upper(said).rlike(w), v) for w, v in words.items()]) if anywhere else map_values(said, words, F.lit(None).cast("string")))
    by_class = F.coalesce(*[F.when(number == k, OWNERS[w]) for k, w in OWNER_OF_CLASS.items()])
    return F.coalesce(*told, F.lit(layer.fallback) if layer.fallback else by_class, F.lit(""))


def route_of(c: Column) -> Column:
    """``US 13``, ``I 64``: prefix and number without zeros of route ids such as ``US13`` or ``I0064E000000``; others trimmed."""
    m = lambda k: F.regexp_extract(F.upper(F.trim(c)), r"^(I|US|VA|SR|SC|DE|CO)[-\s]*0*(\d+)", k)
    return F.when(m(1) != "", F.concat_ws(" ", m(1), m(2))).otherwise(F.trim(F.coalesce(c, F.lit(""))))


def normalise_roads(raw: DataFrame, state: str, key: str = "seg_id") -> DataFrame:
    """A state's road layer as key, fc, system, ownership, facility, surface, lanes, speed, area and route; inactive roads are left out."""
    layer = LAYERS[state]
    col = lambda name: F.col(name).cast("string") if name and name in raw.columns else F.lit(None).cast("string")
    rows = raw.where(~F.lower(F.coalesce(col(layer.status), F.lit(""))).rlike(INACTIVE)) if layer.status else raw
    number, of = class_number(col(layer.fc)), lambda name, values, default: map_values(F.trim(F.coalesce(col(name), F.lit(""))), values, F.lit(default))
    by_number = lambda values: F.coalesce(*[F.when(number == k, v) for k, v in values.items()], F.lit(""))
    said = F.trim(F.coalesce(col(layer.surface), F.lit("")))
    surface = F.coalesce(map_values(said, layer.surfaces, F.lit(None).cast("string")), *[F.when(F.lower(said).contains(w.lower()), v) for w, v in layer.surfaces.items() if len(w) > 4], F.lit(ASPHALT)) if layer.surfaces else F.lit(ASPHALT)
    # A main road of dirt or gravel is a slip of the layer.
    surface = F.when((number <= 3) & surface.isin("5. Dirt", "4. Slag, Gravel, Stone"), ASPHALT).otherwise(surface)
    facility = of(layer.direction, layer.directions, TWO_WAY) if layer.directions else F.lit(TWO_WAY)
    if layer.median:
        split = ~F.trim(F.coalesce(col(layer.median), F.lit(""))).isin("", "0", "1", "N")
        facility = F.when(split, F.when(facility.contains("One-Way"), "2-One-Way Divided").otherwise(DIVIDED)).otherwise(facility)
    count = lambda name, most: F.when(col(name).try_cast("double") > 0, F.least(col(name).try_cast("double").cast("int"), F.lit(most)))
    return rows.select(
        key, by_number(SHORT).alias("fc"), by_number(SYSTEM).alias("system"), owner_of(col, layer, number).alias("ownership"), facility.alias("facility"), surface.alias("surface"),
        count(layer.lanes, 12).alias("lanes"), count(layer.speed, 999).alias("speed"), (of(layer.area, layer.areas, "") if layer.areas else F.lit("")).alias("area"), route_of(col(layer.route)).alias("route"),
    )
