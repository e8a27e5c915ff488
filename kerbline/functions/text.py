"""Column expressions on names, dates, codes and free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a blank cell may hold.
BLANKS = ("", "nan", "none", "nat", "inf", "-inf", "null")


def blank_to_null(c: Column) -> Column:
    t = F.trim(c.cast("string"))
    return F.when(F.lower(t).isin(*BLANKS), None).otherwise(t)


def yes_no(c: Column) -> Column:
    """Y, YES, 1, TRUE and T to Yes, all else to No."""
    return F.when(F.upper(F.trim(F.coalesce(c.cast("string"), F.lit("")))).isin("Y", "YES", "1", "TRUE", "T"), "Yes").otherwise("No")


#: Formats of crash dates, tried in order.
DATE_FORMATS = ("yyyy MMM dd hh:mm:ss a", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm", "yyyy-MM-dd", "MM/dd/yyyy", "M/d/yyyy")


def parse_datetime(c: Column) -> Column:
    """The first format that fits; digits alone are milliseconds since 1970; else null."""
    millis = F.when(c.rlike(r"^\d{11,14}$"), F.timestamp_millis(c.try_cast("long")))
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in DATE_FORMATS], millis)


def military_time(ts: Column) -> Column:
    return F.date_format(ts, "HHmm")


def extract_year(c: Column) -> Column:
    """A year from m/d/Y, d/m/yy, Y-m-d or the first four digits."""
    four = F.regexp_extract(c, r"^\d{1,2}/\d{1,2}/(\d{4})", 1)
    two = F.regexp_extract(c, r"^\d{1,2}/\d{1,2}/(\d{2})$", 1)
    any4 = F.regexp_extract(c, r"(\d{4})", 1)
    return F.when(four != "", four.try_cast("int")).when(two != "", F.lit(2000) + two.try_cast("int")).when(any4 != "", any4.try_cast("int"))


def slug(c: Column) -> Column:
    """A storage key: numbers before the name and marks off, blanks and hyphens to single underscores."""
    k = F.lower(F.regexp_replace(F.trim(c), r"^\d+\.\s*", ""))
    k = F.regexp_replace(F.regexp_replace(k, r"['.]", ""), r"[^a-z0-9\s_-]", " ")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(k, r"[\s-]+", "_"), "_+", "_"), "^_+|_+$", "")


def strip_juris_prefix(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"^\d+\.\s*", "")


def classify_juris(c: Column) -> Column:
    """county, city or unknown by the words of a name."""
    name = F.lower(strip_juris_prefix(c))
    return F.when(name.rlike(r"\b(county|parish|borough)\b"), "county").when(name.rlike(r"^(city of|town of)\b|^(city|town)$"), "city").otherwise("unknown")


#: Place codes of the census and what kind of place they name.
LSADC = {"06": "county", "25": "city", "04": "county", "15": "county", "13": "county", "05": "county", "21": "county", "43": "town", "47": "village", "57": "cdp"}
_NAMES = ((r"\bcity of\b|\bcity$", "city"), (r"\btown of\b|\btown$", "town"), (r"\bvillage of\b|\bvillage$", "village"), (r"\b(county|parish|borough)$", "county"))


def juris_type(name: Column, lsadc: Column, source_type: Column) -> Column:
    """From the census code, else the source's own type, else the name."""
    code, kind, low = F.lit(None).cast("string"), F.lower(F.trim(source_type)), F.lower(F.coalesce(name, F.lit("")))
    for k, v in LSADC.items():
        code = F.when(lsadc == k, v).otherwise(code)
    told = F.when(kind.isin("city", "municipality", "metro", "urban"), "city").when(kind.isin("town", "township"), "town").when(kind == "village", "village").when(kind.isin("county", "parish", "borough"), "county")
    by_name = F.lit("unknown")
    for pattern, v in reversed(_NAMES):
        by_name = F.when(low.rlike(pattern), v).otherwise(by_name)
    return F.coalesce(code, told, by_name)


OWNERS = {"state": "1. State Hwy Agency", "county": "2. County Hwy Agency", "city": "3. City or Town Hwy Agency", "federal": "4. Federal Roads", "toll": "5. Toll Roads Maintained by Others", "private": "6. Private/Unknown Roads"}


def owner_of_place(kind: Column) -> Column:
    return F.when(kind.isin("city", "town", "village"), OWNERS["city"]).when(kind.isin("county", "cdp"), OWNERS["county"]).otherwise(OWNERS["state"])


def derive_ownership(kind: Column, system: Column, fc: Column, route: Column, hint: Column) -> Column:
    """Owner by the first of: the source's own word, the road system, class with place and route, place, route; else the state."""
    h, s, n = F.lower(F.trim(F.coalesce(hint, F.lit("")))), F.lower(F.trim(F.coalesce(system, F.lit("")))), F.substring(F.coalesce(fc, F.lit("")), 1, 1)
    state_route = F.coalesce(route, F.lit("")).rlike(r"(?i)^(I|US|SR|ST|RT)[-\s]?\d")
    by_hint = F.when(h.rlike("state|dot|highway agency"), OWNERS["state"]).when(h.contains("county"), OWNERS["county"]).when(h.rlike("city|town|municipal"), OWNERS["city"]).when(h.rlike("federal|tribal"), OWNERS["federal"]).when(h.rlike("toll|turnpike"), OWNERS["toll"]).when(h.contains("private"), OWNERS["private"])
    local = s.startswith("non") | s.rlike("local|municipal|county road|city street")
    by_system = F.when(local, owner_of_place(kind)).when(s.rlike("^(v|c|m|del)dot|interstate|state|primary|secondary"), OWNERS["state"])
    urban = kind.isin("city", "town", "village")
    by_class = F.when(n.isin("1", "2", "3"), OWNERS["state"]).when(n == "4", F.when(state_route | ~urban, OWNERS["state"]).otherwise(OWNERS["city"])).when(n == "5", F.when(urban, OWNERS["city"]).otherwise(OWNERS["state"])).when(n.isin("6", "7"), owner_of_place(kind))
    by_route = F.when(F.coalesce(route, F.lit("")).rlike(r"(?i)^(CR|CO)[-\s]?\d"), OWNERS["county"])
    return F.coalesce(by_hint, by_system, by_class, F.when(kind != "unknown", owner_of_place(kind)), by_route, F.lit(OWNERS["state"]))


def parse_maxspeed(c: Column) -> Column:
    """Miles an hour from a speed tag: the first of several, kilometres turned to miles, also where over 120."""
    first = F.trim(F.split(c, ";")[0])
    value = F.floor(F.regexp_extract(first, r"^(\d+(?:\.\d+)?)", 1).try_cast("double"))
    metric = first.rlike("km/h|kmh") | (value > 120)
    return F.when(metric, F.round(value * 0.621371)).otherwise(value).cast("int")


def format_juris(name: Column, code: Column, kind: Column) -> Column:
    """``001. Name County``, ``002. City of Name`` and so on."""
    number = F.lpad(code.cast("string"), 3, "0")
    said = F.when(kind == "county", F.concat(name, F.lit(" County"))).when(kind == "city", F.concat(F.lit("City of "), name)).when(kind == "town", F.concat(F.lit("Town of "), name)).when(kind == "village", F.concat(F.lit("Village of "), name)).otherwise(name)
    return F.concat(number, F.lit(". "), said)


#: Words that set a flag when they stand in the circumstance of a crash.
FLAG_WORDS = {
    "distracted": ("distract", "inattenti", "cell phone", "texting", "electronic device", "eating", "grooming"),
    "drowsy": ("drowsy", "asleep", "fatigued"),
    "speed": ("speed", "exceeding", "too fast", "racing", "aggressive"),
    "animal": ("animal", "deer", "wildlife", "elk", "moose", "horse"),
    "hitrun": ("hit and run", "hit-and-run", "hitrun", "hit & run", "left scene", "fled", "fleeing"),
}


def flags_from_text(c: Column) -> dict[str, Column]:
    low = F.lower(F.coalesce(c, F.lit("")))
    return {k: low.rlike("|".join(words)) for k, words in FLAG_WORDS.items()}


def fc_from_route(route: Column) -> Column:
    """Functional class by a route's prefix; null where none is known."""
    kinds = ((r"^I[-\s]?\d", "1-Interstate (A,1)"), (r"^US[-\s]?\d", "3-Principal Arterial - Other (E,2)"), (r"^(SR|DE)[-\s]?\d", "4-Minor Arterial (H,3)"), (r"^(CR|CO)[-\s]?\d", "6-Minor Collector (5)"))
    out = F.lit(None).cast("string")
    for pattern, fc in reversed(kinds):
        out = F.when(route.rlike(pattern), fc).otherwise(out)
    return out


def content_hash(*fields: Column) -> Column:
    """md5 of fields joined by a bar; null is empty."""
    return F.md5(F.concat_ws("|", *[F.coalesce(f.cast("string"), F.lit("")) for f in fields]))


def row_hash(*fields: Column) -> Column:
    """The first 16 hex digits of a sha-256."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(f.cast("string"), F.lit("")) for f in fields]), 256), 1, 16)


def location_key(*fields: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.trim(f.cast("string")), F.lit("")) for f in fields])


def collapse_blanks(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, " {2,}", " "))


def strip_dot_zero(c: Column) -> Column:
    return F.regexp_replace(c, r"\.0$", "")


def nbi_condition(*ratings: Column) -> Column:
    """Poor up to 4, Fair up to 6, else Good, by the worst of the digit ratings; Unknown without any."""
    worst = F.array_min(F.filter(F.array(*[r.try_cast("int") for r in ratings]), lambda x: x.isNotNull()))
    return F.when(worst.isNull(), "Unknown").when(worst <= 4, "Poor").when(worst <= 6, "Fair").otherwise("Good")


def warning_level(device: Column) -> Column:
    """Rail-crossing devices to Gates, Signals, Signs, None or Other."""
    d = F.lower(F.coalesce(device, F.lit("")))
    return F.when(d.contains("gate"), "Gates").when(d.rlike("flash|signal|light"), "Signals").when(d.rlike("sign|crossbuck|stop"), "Signs").when(d.isin("", "none"), "None").otherwise("Other")


def dawn_dusk(light: Column, time: Column) -> Column:
    """``Dawn or Dusk`` told apart by the military time."""
    return F.when(F.lower(light).contains("dawn or dusk"), F.when(time.try_cast("int") >= 1200, "3. Dusk").otherwise("1. Dawn")).otherwise(light)


def route_name(c: Column) -> Column:
    """State route codes to short names, such as ``US 30`` and ``I 64``; other texts stay as a street."""
    m = lambda k: F.regexp_extract(F.upper(c), r"^(?:[A-Z]-)?(IS|I|US|SR|ST|VA|CR|SC)[-_\s]*0*(\d+)", k)
    kind = F.when(m(1).isin("I", "IS"), "I").when(m(1) == "US", "US").when(m(1).isin("SR", "ST", "VA"), "SR").when(m(1).isin("CR", "SC"), "CR")
    return F.when(m(1) != "", F.concat_ws(" ", kind, m(2))).otherwise(F.trim(c))


def combined_cmf(factors: Column) -> Column:
    """The product of factors, and so 100 * (1 - p) percent reduction."""
    return F.aggregate(factors, F.lit(1.0), lambda p, x: p * x)


def crash_type_tags(c: Column, words: dict[str, str]) -> Column:
    """Tags of a comma-separated text by keyword, sorted; ``all`` where none fits."""
    low = F.lower(F.coalesce(c, F.lit("")))
    tags = F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(low.contains(w), t) for w, t in words.items()]), lambda x: x.isNotNull())))
    return F.when(F.size(tags) == 0, F.array(F.lit("all"))).otherwise(tags)
