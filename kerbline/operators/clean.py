"""Whole-table cleaning: columns by alias, coded values, duplicates, differences, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.functions.text import blank_to_null, content_hash, slug
from kerbline.session import in_order, small


def rename_to_standard(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Standard columns from the first filled alias that the table has; columns without an alias stay."""
    have = {c.lower(): c for c in df.columns}
    found = {t: [have[a.lower()] for a in names if a.lower() in have] for t, names in aliases.items()}
    used = {a for names in found.values() for a in names}
    return df.select(*[F.coalesce(*[blank_to_null(F.col(f"`{a}`")) for a in names]).alias(t) for t, names in found.items() if names], *[F.col(f"`{c}`") for c in df.columns if c not in used and c not in aliases])


def decode_code_columns(df: DataFrame, maps: dict[str, dict[str, str]]) -> DataFrame:
    """Coded values to labels, for columns that look coded: some value is a code and none is a label already.

    All columns are looked at in one aggregation, joined back as one row.
    """
    looks = df.agg(*[F.coalesce(F.max(F.col(c).isin(*m)), F.lit(False)).alias(f"{c}__code") for c, m in maps.items()], *[F.coalesce(F.max(F.col(c).isin(*m.values())), F.lit(False)).alias(f"{c}__label") for c, m in maps.items()])
    new = {c: F.when(F.col(f"{c}__code") & ~F.col(f"{c}__label"), F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), F.col(c)), F.col(c))).otherwise(F.col(c)) for c, m in maps.items()}
    return df.join(F.broadcast(looks)).withColumns(new).select(*df.columns)


def map_values(c: Column, mapping: dict[str, str], default: Column | None = None) -> Column:
    known = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(known, c), c if default is None else default)


def pack_columns(df: DataFrame, core: list[str], bags: dict[str, list[str]]) -> DataFrame:
    """Core columns as they are, the rest in one JSON text per bag without blank values."""
    bag = lambda cols: F.to_json(F.map_filter(F.map_from_arrays(F.array(*[F.lit(c) for c in cols]), F.array(*[F.col(c).cast("string") for c in cols])), lambda k, v: v.isNotNull() & (F.trim(v) != "")))
    return df.select(*core, *[bag(cols).alias(name) for name, cols in bags.items()])


def prefix_extra_columns(df: DataFrame, standard: list[str], prefix: str, drop: tuple[str, ...] = ("geometry",)) -> DataFrame:
    title = lambda c: "_".join(w.capitalize() for w in c.replace("_", " ").split())
    return df.select(*[F.col(f"`{c}`") if c in standard else F.col(f"`{c}`").alias(f"{prefix}_{title(c)}") for c in df.columns if c.lower() not in drop])


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first in a stated order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def first_occurrence(df: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """row id, the id of its first occurrence, and whether it repeats that."""
    first = F.min(row_id).over(Window.partitionBy(*keys))
    return df.select(row_id, first.alias("first_id"), (first != F.col(row_id)).alias("duplicate"))


def merge_existing(existing: DataFrame, new: DataFrame, doc: str, geo: list[str], row_id: str) -> DataFrame:
    """Existing rows and those new ones whose document (where given) and whose place key (where it has a position) are not there yet."""
    rows = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    order = [F.col("_new"), F.col(row_id)]
    by_doc = F.row_number().over(Window.partitionBy(F.coalesce(F.nullif(F.trim(doc), F.lit("")), F.concat(F.lit("#"), F.col("_new").cast("string"), F.col(row_id).cast("string")))).orderBy(*order))
    rows = rows.withColumn("_d", by_doc).where("_d = 1")
    placed = F.coalesce(F.col(geo[1]).isNotNull() & F.col(geo[2]).isNotNull(), F.lit(False))
    key = F.when(placed, F.concat_ws("|", *[F.col(g).cast("string") for g in geo])).otherwise(F.concat(F.lit("#"), F.col("_new").cast("string"), F.col(row_id).cast("string")))
    by_geo = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_g", by_geo).where("_g = 1").drop("_d", "_g", "_new")


def with_hash(df: DataFrame, fields: list[str]) -> DataFrame:
    return df.withColumn("hash", content_hash(*[F.col(f) for f in fields]))


def diff_new_rows(existing: DataFrame, fresh: DataFrame, fields: list[str]) -> DataFrame:
    """Fresh rows whose content hash no existing row has."""
    return with_hash(fresh, fields).join(with_hash(existing, fields).select("hash").distinct(), "hash", "left_anti")


def diff_mode(existing: DataFrame, fresh: DataFrame, fields: list[str], share: float = 0.1) -> DataFrame:
    """One row: counts, and skip, incremental (under the share) or full."""
    n = fresh.agg(F.count("*").alias("n_fresh")).join(F.broadcast(diff_new_rows(existing, fresh, fields).agg(F.count("*").alias("n_new"))))
    return n.withColumn("mode", F.when(F.col("n_new") == 0, "skip").when(F.col("n_new") < F.col("n_fresh") * share, "incremental").otherwise("full"))


def canonical_names(df: DataFrame, name: str) -> DataFrame:
    """Names with equal slugs become the first of them in order."""
    names = df.select(name).distinct().where(F.trim(name) != "").withColumn("_slug", slug(F.col(name)))
    best = names.groupBy("_slug").agg(F.min(name).alias("canonical"))
    return df.join(small(names.join(best, "_slug").select(name, "canonical")), name, "left").withColumn("canonical", F.coalesce("canonical", F.col(name)))


def upsert(registry: DataFrame, news: DataFrame, key: str) -> DataFrame:
    """Rows of the registry with those of ``news`` over them."""
    return registry.join(news.select(key), key, "left_anti").unionByName(news, allowMissingColumns=True)


def padded(number: Column, width: int) -> Column:
    """Digits with zeros before them up to a width; longer numbers stay whole."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def generate_crash_ids(crashes: DataFrame, prefix: str, order: list[str], first: int = 1) -> DataFrame:
    """``ST-YYYYMMDD-HHMM-0000001``: rows are range-sorted, counted per partition, and numbered from each partition's offset.

    Numbers are padded to seven digits and longer from 10,000,000 on.  No task sees more than its own range.
    """
    number = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before") + first - 1
    said = F.concat_ws("-", F.lit(prefix), F.date_format("crash_date", "yyyyMMdd"), F.lpad((F.col("hour") * 100 + F.col("minute")).cast("string"), 4, "0"), padded(number, 7))
    return in_order(crashes, *order).withColumn("document", said).drop("_part", "_before")


# Splits -----------------------------------------------------------------------------------------------------

_FREE = "^[12]-"


def road_types_a() -> Column:
    """Labels of the state and region tiers that a crash belongs to."""
    own, fc = F.coalesce("ownership", F.lit("")), F.coalesce("fc", F.lit(""))
    from kerbline.functions.text import OWNERS

    others = [OWNERS[k] for k in ("county", "city", "federal", "toll", "private")]
    return F.array_compact(F.array(F.lit("all_roads"), F.when(own == OWNERS["state"], "dot_roads"), F.when(fc.rlike(_FREE), "primary_roads"), F.when(own.isin(others), "non_dot_roads")))


def road_types_b() -> Column:
    """Labels of the local tiers; a blank class counts as no interstate."""
    own, fc = F.coalesce("ownership", F.lit("")), F.coalesce("fc", F.lit(""))
    from kerbline.functions.text import OWNERS

    return F.array_compact(F.array(F.lit("all_roads"), F.when(own == OWNERS["county"], "county_roads"), F.when(own == OWNERS["city"], "city_roads"), F.when(~fc.rlike(_FREE), "no_interstate")))


def split_tiers(crashes: DataFrame) -> DataFrame:
    """A row for each split a crash belongs to: tier, entity (a slug), road_type, id.  One scan, no shuffle.

    Tiers are unrolled before their road types, so a name is slugged once per tier, not once per split.
    """
    tier = lambda name, entity, kinds: F.when(F.coalesce(entity, F.lit("")) != "", F.struct(F.lit(name).alias("tier"), entity.alias("entity"), F.col(kinds).alias("kinds")))
    city = F.col("area_type") == "Urban"
    rows = crashes.select("id", "district", "mpo", "planning", "juris", "area_type", road_types_a().alias("_a"), road_types_b().alias("_b"))
    where = F.array_compact(F.array(
        tier("state", F.lit("all"), "_a"), tier("region", F.col("district"), "_a"), tier("mpo", F.col("mpo"), "_b"), tier("planning_district", F.col("planning"), "_b"),
        tier("county", F.when(~city, F.col("juris")), "_b"), tier("city", F.when(city, F.col("juris")), "_b"),
    ))
    tiers = rows.select("id", F.inline(where)).select("id", "tier", slug(F.col("entity")).alias("entity"), "kinds")
    return tiers.select("id", "tier", "entity", F.explode("kinds").alias("road_type"))


def split_manifest(splits: DataFrame) -> DataFrame:
    return splits.groupBy("tier", "entity", "road_type").agg(F.count("*").alias("n"))


def split_strategy(crashes: DataFrame, columns: dict[str, str], least: float = 0.1) -> DataFrame:
    """tier, fill rate and strategy: the tier's own column where it is filled enough, else membership by county."""
    rates = crashes.agg(*[F.round(F.count(F.when(F.trim(c) != "", 1)) / F.count("*"), 4).alias(t) for t, c in columns.items()])
    turned = rates.select(F.explode(F.array(*[F.struct(F.lit(t).alias("tier"), F.col(t).alias("rate")) for t in columns])).alias("x")).select("x.*")
    return turned.withColumn("strategy", F.when(F.col("rate") >= least, "column").otherwise("hierarchy"))


def filter_jurisdictions(crashes: DataFrame, config: DataFrame) -> DataFrame:
    """Every crash with every configured jurisdiction it fits: by FIPS, exact name or a name pattern.

    config (name, fips, county, pattern) is a small stated table, checked before it is broadcast.
    """
    fits = (F.col("c.fips") == F.col("j.fips")) | (F.lower(F.trim("c.juris")) == F.lower("j.county")) | F.coalesce(F.expr("c.juris RLIKE j.pattern"), F.lit(False))
    return crashes.alias("c").join(small(config, 20_000).alias("j"), fits).select("j.name", "c.*")
