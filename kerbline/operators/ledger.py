"""The checks and repairs of a crash table with a ledger: what was found in each row, and what was done about it.

Checks run in order in one projection; each sees what those before it repaired and adds entries (check, severity, field,
old, new, fixed, way) to an array beside the row.  The result is stored once: corrected rows and the table of issues
are two readings of it, so the source is scanned once for both.

What repairs need from other rows is learnt before, as tables of a row per route or class: the middle crash of each
route, the majority of functional class and facility per route, and the facility that most rows of a class have (with
how many rows speak for it).  Positions out of bounds on unknown routes go to the nearest occupied cell, searched ring
by ring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.functions.severity import severity_from_counts
from kerbline.operators.spatial import nearest_by_rings
from kerbline.operators.validate import percentile_bounds, route_medians
from kerbline.session import kept, small

# Words that stand for no value, the fields no crash should lack, flags, and the classes that names tell.
UNKNOWN = ("", "null", "unknown", "na", "n/a", "not applicable")
CRITICAL = ("severity", "collision", "weather", "light", "surface", "fc", "facility")
FLAGS = ("hitrun", "speeding", "distracted", "drowsy", "guardrail", "animal", "lgtruck")
DIVIDED, UNDIVIDED, ONE_WAY = "4-Two-Way Divided", "3-Two-Way Undivided", "1-One-Way Undivided"
INTERSTATE, PRINCIPAL, MINOR, COLLECTOR, LOCAL = "1-Interstate (A,1)", "3-Principal Arterial - Other (E,2)", "4-Minor Arterial (H,3)", "5-Major Collector (I,4)", "7-Local (J,6)"
PREFIXES = ((r"^(I-|IS\s)", INTERSTATE, DIVIDED), (r"^(US\s|US-)", PRINCIPAL, DIVIDED), (r"^(SR\s|SR-|SH\s)", MINOR, UNDIVIDED))
SYSTEMS = (("interstate", INTERSTATE), ("primary", PRINCIPAL), ("secondary", COLLECTOR), ("local", LOCAL), ("non", LOCAL))
DESCRIPTIONS = (("not divided", UNDIVIDED), ("positive median", DIVIDED), ("barrier", DIVIDED), ("divided", DIVIDED), ("one-way", ONE_WAY), ("one way", ONE_WAY))

MARGIN, REACH, CELL = 0.05, 0.1, 0.01
GROUPS = ("gps", "severity", "cross_field", "datetime", "fields")


def unknown(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c.cast("string"), F.lit("")))).isin(*UNKNOWN)


def _told(column: Column, words, at: int = 1, fits=None) -> Column:
    """The value of the first fitting entry; null for none."""
    out, fits = F.lit(None).cast("string"), fits or (lambda c, w: c.contains(w))
    for entry in reversed(words):
        out = F.when(fits(column, entry[0]), entry[at]).otherwise(out)
    return out


class Ledger:
    """Rows, and the entries that checks add to them."""

    def __init__(self, rows: DataFrame, classes: DataFrame | None = None):
        self.rows, self.classes, self.n, self.slots, self.writes = rows, classes, 0, {}, {}

    def note(self, check: str, severity: str, field: str, when: Column, old: Column | None = None, new: Column | None = None, way: Column | None = None, write: dict[str, Column] | None = None) -> Ledger:
        """An entry where ``when`` holds.  Where ``new`` isn't null the row is mended: ``write`` has the columns' values
        (without it, ``field`` becomes ``new``); ``way`` tells how it was found.

        Notes see the columns as they were at the last :meth:`settle`.  Of those since then, no two may mend a column of one row.
        """
        none = F.lit(None).cast("string")
        value = none if new is None else new.cast("string")
        entry = F.struct(
            F.lit(check).alias("check"), F.lit(severity).alias("severity"), F.lit(field).alias("field"), (F.col(field) if old is None else old).cast("string").alias("old"), value.alias("new"),
            value.isNotNull().alias("fixed"), F.when(value.isNotNull(), none if way is None else way).alias("way"),
        )
        slot = f"_entry_{self.n}"
        self.n += 1
        self.slots[slot] = F.when(F.coalesce(when, F.lit(False)), entry)
        if new is not None:
            for c, v in (write or {field: new}).items():
                self.writes.setdefault(c, []).append((F.col(f"{slot}.fixed"), v))
        return self

    def settle(self) -> Ledger:
        """Entries and mended values so far become columns: two projections, however many notes there are."""
        mended = {}
        for c, values in self.writes.items():
            mended[c] = F.col(c)
            for fixed, v in reversed(values):
                mended[c] = F.when(fixed, v).otherwise(mended[c])
        self.rows = self.rows.withColumns(self.slots) if self.slots else self.rows
        self.rows = self.rows.withColumns(mended) if mended else self.rows
        self.slots, self.writes = {}, {}
        return self

    def done(self) -> DataFrame:
        self.settle()
        slots = [f"_entry_{k}" for k in range(self.n)]
        return self.rows.withColumn("issues", F.array_compact(F.array(*slots))).drop(*slots, *[c for c in self.rows.columns if c.startswith("_learnt_")])


def _place(lat: Column, lon: Column) -> Column:
    return F.format_string("%.6f, %.6f", lat, lon)


def without_place(lat: Column, lon: Column) -> Column:
    return lat.isNull() | lon.isNull() | F.isnan(lat) | F.isnan(lon) | (lat == 0) | (lon == 0)


def outside(lat: Column, lon: Column, box, margin: float = 0.0) -> Column:
    a, b, c, d = box
    return (lat < a - margin) | (lat > b + margin) | (lon < c - margin) | (lon > d + margin)


def nearest_cells(bad: DataFrame, good: DataFrame, reach: float = REACH) -> DataFrame:
    """id, lat, lon, dist: the middle (in millionths of a degree) of the crashes in the nearest occupied cell within reach.

    Cells have 0.01 degrees.  Ties go to the cell further south, then west.
    """
    key = lambda c: (F.col(c) / CELL).cast("long")
    middle = lambda c: F.expr(f"(2 * sum(CAST(round({c} * 1000000) AS BIGINT)) + count(*)) div (2 * count(*)) / 1000000.0D")
    cells = good.groupBy(key("lat").alias("gy"), key("lon").alias("gx")).agg(middle("lat").alias("t_lat"), middle("lon").alias("t_lon"))
    targets = kept(cells.select(F.struct("gy", "gx").alias("target_id"), "t_lat", "t_lon"))
    found = nearest_by_rings(bad, targets, reach / 8, reach).where(F.col("dist") < reach)
    return found.join(targets, "target_id").select("id", F.col("t_lat").alias("lat"), F.col("t_lon").alias("lon"), "dist")


def learnt_places(rows: DataFrame, box) -> DataFrame:
    """A row per route: its middle crash and how many there are."""
    lat, lon, on_route = F.col("lat"), F.col("lon"), F.trim(F.coalesce("route", F.lit(""))) != ""
    seen = rows.where(on_route & ~without_place(lat, lon) & ~outside(lat, lon, box, MARGIN))
    return kept(route_medians(seen).select("route", F.col("lat").alias("_learnt_lat"), F.col("lon").alias("_learnt_lon"), F.col("n").alias("_learnt_n")))


def learnt_fields(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A row per route (majority class and facility, the class of a single crash) and per class (majority facility).

    Rows are read once, as counts per route, class and facility.
    """
    on_route = F.trim(F.coalesce("route", F.lit(""))) != ""
    known = rows.select(*[F.when(~unknown(F.col(c)), F.col(c)).alias(c) for c in ("fc", "facility")], F.when(on_route, F.col("route")).alias("route"))
    counted = kept(known.groupBy("route", "fc", "facility").agg(F.count("*").alias("n")))

    def votes(key: str, value: str) -> DataFrame:
        n = counted.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.sum("n").alias("n"))
        best = n.groupBy(key).agg(F.max(F.struct("n", F.col(value).alias("v"))).alias("m")).where("m.n >= 2")
        return best.select(key, F.col("m.v").alias(f"_learnt_{key}_{value}"))

    # A route's only class is taken even from a single crash.
    only = counted.where("route IS NOT NULL AND fc IS NOT NULL").groupBy("route").agg(F.min("fc").alias("_learnt_only"), F.sum("n").alias("n"))
    routes = votes("route", "fc").join(votes("route", "facility"), "route", "full").join(only.where("n = 1").drop("n"), "route", "full")
    return kept(routes), kept(votes("fc", "facility").withColumnRenamed("fc", "_learnt_class"))


def check_gps(x: Ledger, box) -> None:
    """Missing and zero positions, and those out of bounds: the route's middle crash, else (out of bounds) the nearest cell."""
    lat, lon = F.col("lat"), F.col("lon")
    missing = without_place(lat, lon)
    by_route = F.concat(F.lit("route median (n="), F.col("_learnt_n").cast("string"), F.lit(")"))
    number = lambda c: F.coalesce(F.format_string("%.4f", c), F.lit("empty"))
    shown = F.concat(F.lit("lon="), F.when(lon.isNotNull(), number(lon)).otherwise("empty"), F.lit(", lat="), F.when(lat.isNotNull(), number(lat)).otherwise("empty"))
    to = {"lat": F.col("_learnt_lat"), "lon": F.col("_learnt_lon")}
    median = F.when(F.col("_learnt_lat").isNotNull(), _place(to["lat"], to["lon"]))
    x.rows = x.rows.withColumns({"_learnt_missing": missing, "_learnt_out": ~missing & outside(lat, lon, box)})
    x.note("missing_gps", "error", "position", F.col("_learnt_missing"), shown, median, by_route, to)
    snapped = {"lat": F.coalesce("_learnt_lat", "_learnt_cell_lat"), "lon": F.coalesce("_learnt_lon", "_learnt_cell_lon")}
    place = F.when(snapped["lat"].isNotNull(), _place(snapped["lat"], snapped["lon"]))
    x.note("bounds", "error", "position", F.col("_learnt_out"), F.format_string("%.4f, %.4f", lat, lon), place, F.when(F.col("_learnt_lat").isNotNull(), by_route).otherwise("nearest cell"), snapped)


def check_severity(x: Ledger) -> None:
    """A stated severity that the people hurt contradict."""
    told, stated = severity_from_counts(*[F.col(f"{k}_people") for k in "kabc"]), F.trim(F.coalesce("severity", F.lit("")))
    x.note("severity", "warning", "severity", (stated != "") & (told != "O") & (stated != told), new=told, way=F.lit("people"))


def check_cross_field(x: Ledger) -> None:
    """Flags that counts or the collision's words contradict, and flags that are neither Yes nor No."""
    yes, words = F.lit("Yes"), F.lower(F.coalesce("collision", F.lit("")))
    no = lambda c: F.trim(F.coalesce(c, F.lit(""))) == "No"
    hurt = F.coalesce("ped_killed", F.lit(0)) + F.coalesce("ped_injured", F.lit(0)) > 0
    x.note("cross_field", "warning", "ped", no("ped") & hurt, new=yes, way=F.lit("counts"))
    x.note("cross_field", "warning", "bike", no("bike") & (words.contains("bike") | words.contains("bicycl")), new=yes, way=F.lit("collision"))
    x.note("cross_field", "warning", "motorcycle", no("motorcycle") & words.contains("motorcycle"), new=yes, way=F.lit("collision"))
    for flag in FLAGS:
        value = F.trim(F.coalesce(flag, F.lit("")))
        x.note("cross_field", "info", flag, ~value.isin("", "Yes", "No"), new=F.when(F.upper(value).isin("Y", "1", "TRUE"), "Yes").otherwise("No"), way=F.lit("standard word"))


def check_datetime(x: Ledger) -> None:
    """Dates m/d/y that can't be read or are out of range, years that contradict them, times that no clock shows."""
    # Parts are columns of their own, as several entries ask for them.
    x.rows = x.rows.withColumn("_learnt_parts", F.split(F.trim(F.coalesce("crash_date", F.lit(""))), "/")).withColumns({f"_learnt_{c}": F.get("_learnt_parts", F.lit(k)).try_cast("int") for k, c in enumerate(("month", "day", "year"))} | {"_learnt_clock": F.trim(F.coalesce("crash_time", F.lit(""))).try_cast("int")})
    month, day, year = (F.col(f"_learnt_{c}") for c in ("month", "day", "year"))
    three = F.size("_learnt_parts") == 3
    readable = three & month.isNotNull() & day.isNotNull() & year.isNotNull()
    stated = F.trim(F.coalesce(F.col("crash_year").cast("string"), F.lit("")))
    x.note("date_time", "error", "crash_date", three & ~readable)
    x.note("date_time", "warning", "crash_date", readable & ~(month.between(1, 12) & day.between(1, 31) & year.between(1990, 2030)))
    x.note("date_time", "warning", "crash_year", readable & (stated != "") & (stated != year.cast("string")), new=year.cast("string"), way=F.lit("date"))
    clock = F.col("_learnt_clock")
    x.note("date_time", "warning", "crash_time", (clock < 0) | (clock > 2359) | (F.pmod(clock, F.lit(100)) >= 60))


def check_fields(x: Ledger) -> None:
    """Critical fields without a value; functional class, then facility, are inferred: by the route's majority, the
    system or the class's usual facility and the description, and the route's prefix, in this order.

    The checks before it mend columns of their own each, so they are settled together here."""
    x.settle()
    for field in CRITICAL:
        if field not in ("fc", "facility"):
            x.note("missing_field", "warning", field, unknown(F.col(field)))
    route = F.upper(F.trim(F.coalesce("route", F.lit(""))))
    prefix = lambda at: _told(route, PREFIXES, at, lambda c, w: c.rlike(w))
    lower = lambda c: F.lower(F.coalesce(c, F.lit("")))

    def infer(field: str, chain: list[tuple[str, Column]]) -> None:
        way = F.coalesce(*[F.when(value.isNotNull(), name) for name, value in chain])
        x.note("missing_field", "warning", field, unknown(F.col(field)), new=F.coalesce(*[value for _, value in chain]), way=way)

    infer("fc", [("route_majority", F.coalesce("_learnt_route_fc", "_learnt_only")), ("system", _told(lower("system"), SYSTEMS)), ("prefix", prefix(1))])
    # The class that was just inferred speaks too.
    x.rows = _with_class(x.settle().rows, x.classes)
    infer("facility", [("route_majority", F.col("_learnt_route_facility")), ("class_majority", F.col("_learnt_fc_facility")), ("description", _told(lower("description"), DESCRIPTIONS)), ("prefix", prefix(2))])


def _with_class(rows: DataFrame, classes: DataFrame) -> DataFrame:
    return rows.join(small(classes), F.col("fc") == F.col("_learnt_class"), "left").drop("_learnt_class")


def run_checks(rows: DataFrame, box=None, groups: tuple[str, ...] = GROUPS) -> DataFrame:
    """The rows, mended, with ``issues``; stored, for several readings."""
    return kept(checks(rows, box, groups))


def checks(rows: DataFrame, box=None, groups: tuple[str, ...] = GROUPS) -> DataFrame:
    """The rows, mended, with ``issues``, for one reading, which computes the columns it asks for.

    rows: id, route, severity, k_people to c_people, ped, ped_killed, ped_injured, bike, motorcycle, the flags,
    collision, weather, light, surface, fc, facility, description, system, crash_date, crash_time, crash_year (text), lat and
    lon, and whatever else.  ``box`` (lat_min, lat_max, lon_min, lon_max) are the bounds; without it the middle 96 % of
    the positions, widened, and none for fewer than a hundred.  A group alone needs the columns it names only.
    """
    if box is None and "gps" in groups:
        one = percentile_bounds(rows.where(~without_place(F.col("lat"), F.col("lon")))).collect()  # a row at most
        box = tuple(one[0]) if one else (-90.0, 90.0, -180.0, 180.0)
    box = box or (-90.0, 90.0, -180.0, 180.0)
    # What is learnt from other rows reads a few columns several times: they are stored, the wide rows are derived once.
    learns = {"gps": ("lat", "lon"), "fields": ("fc", "facility")}
    wanted = [c for g, columns in learns.items() if g in groups for c in columns]
    source, classes = kept(rows.select("route", *wanted)) if wanted else rows, None
    if "gps" in groups:
        middles = small(learnt_places(source, box))
        rows = rows.join(middles, "route", "left")
        lat, lon = F.col("lat"), F.col("lon")
        fine = ~without_place(lat, lon)
        lost = source.join(middles, "route", "left").where(fine & outside(lat, lon, box) & F.col("_learnt_lat").isNull()).select(F.struct("lat", "lon").alias("id"), "lat", "lon").distinct()
        # Positions look for their cell, not rows.
        cells = nearest_cells(lost, source.where(fine & ~outside(lat, lon, box)).select("lat", "lon"))
        rows = rows.join(small(kept(cells.select("id.lat", "id.lon", F.col("lat").alias("_learnt_cell_lat"), F.col("lon").alias("_learnt_cell_lon")))), ["lat", "lon"], "left")
    if "fields" in groups:
        routes, classes = learnt_fields(source)
        rows = rows.join(small(routes), "route", "left")
    x = Ledger(rows, classes)
    for name, check in (("gps", lambda x: check_gps(x, box)), ("severity", check_severity), ("cross_field", check_cross_field), ("datetime", check_datetime), ("fields", check_fields)):
        if name in groups:
            check(x)
    return x.done()


def issue_table(checked: DataFrame) -> DataFrame:
    """A row per entry: row_id, check, severity, field, old, new, fixed, way."""
    return checked.select(F.col("id").alias("row_id"), F.explode("issues").alias("x")).select("row_id", "x.*")


def corrected(checked: DataFrame) -> DataFrame:
    return checked.drop("issues")


def report(checked: DataFrame) -> DataFrame:
    """check, severity, n, fixed, and the share mended in percent."""
    sums = issue_table(checked).groupBy("check", "severity").agg(F.count("*").alias("n"), F.count(F.when(F.col("fixed"), 1)).alias("fixed"))
    return sums.withColumn("fix_rate", F.round(F.col("fixed") * 100 / F.col("n"), 1))


def quality_score(checked: DataFrame, placed: Column) -> DataFrame:
    """One row: geography, severity, fix_rate and gps in percent, and score: a quarter of each, 0 to 100.

    ``placed`` tells whether a row's jurisdiction is known.  Severity counts mended values; gps is the share of rows
    that have a position now; without issues the fix rate is 100.  An empty table scores 100 but for what no row shows.
    """
    valid = F.coalesce(F.col("severity").isin("K", "A", "B", "C", "O"), F.lit(False))
    lost = F.exists("issues", lambda e: (e["check"] == "missing_gps") & ~e["fixed"])
    one = checked.agg(
        F.count("*").alias("n"), F.count(F.when(placed, 1)).alias("placed"), F.count(F.when(valid, 1)).alias("valid"), F.count(F.when(~lost, 1)).alias("there"),
        F.coalesce(F.sum(F.size("issues")), F.lit(0)).alias("found"), F.coalesce(F.sum(F.size(F.filter("issues", lambda e: e["fixed"]))), F.lit(0)).alias("fixed"),
    )
    pct = lambda part, whole, none: F.when(F.col(whole) > 0, F.col(part) * 100 / F.col(whole)).otherwise(none)
    shares = one.select(pct("placed", "n", 0.0).alias("geography"), pct("valid", "n", 0.0).alias("severity"), F.round(pct("fixed", "found", 100.0), 1).alias("fix_rate"), pct("there", "n", 100.0).alias("gps"), "n")
    quarters = sum((F.least(F.lit(25.0), F.col(c) * 0.25) for c in ("severity", "fix_rate", "gps")), F.least(F.lit(25.0), F.col("geography") * 0.25))
    return shares.select(*[F.round(c, 4).alias(c) for c in ("geography", "severity", "fix_rate", "gps")], F.round(quarters, 1).alias("score"), "n")
