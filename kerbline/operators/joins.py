"""Joins on keys: lookups, cascades, repairs and the road graph.

Lookups join the fact table once, on a key; Spark broadcasts a side by its own size estimate or shuffles both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.functions.geo import haversine_m
from kerbline.operators.aggregate import graph_degree
from kerbline.session import small


def overwrite_fill(rows: DataFrame, other: DataFrame, key: str, overwrite: dict[str, str], fill: dict[str, str]) -> DataFrame:
    """Columns from ``other``: some replace where they are not blank, some fill where the row is blank."""
    said = lambda c: F.nullif(F.trim(c), F.lit(""))
    new = {c: F.coalesce(said(o), F.col(c)) for c, o in overwrite.items()} | {c: F.coalesce(said(c), F.col(o)) for c, o in fill.items()}
    return rows.join(other, key, "left").withColumns(new).select(*rows.columns)


def repair_from_original(rows: DataFrame, original: DataFrame, key: str) -> DataFrame:
    """Columns that the original has, from it where it has the row."""
    fixed = [c for c in original.columns if c != key]
    o = original.select(key, *[F.col(c).alias(f"_{c}") for c in fixed])
    return rows.join(o, key, "left").withColumns({c: F.coalesce(f"_{c}", c) for c in fixed}).select(*rows.columns)


def secondary_attributes(segments: DataFrame, layer: DataFrame, suffix: str = r"(NB|SB|EB|WB)$") -> DataFrame:
    """Attributes by route name without its direction; the layer counts once per name."""
    base = F.regexp_replace("rte", suffix, "")
    return segments.withColumn("_rte", base).join(layer.dropDuplicates(["rte"]).withColumnRenamed("rte", "_rte"), "_rte", "left").drop("_rte")


def node_degree(segments: DataFrame) -> DataFrame:
    """Each segment with the larger degree and street count of its ends, and whether either is an intersection."""
    d = graph_degree(segments)
    end = lambda side: d.select(F.col("node").alias(f"{side}_node"), F.col("degree").alias(f"{side}_d"), F.col("streets").alias(f"{side}_s"))
    both = segments.select("seg_id", "u_node", "v_node").join(end("u"), "u_node", "left").join(end("v"), "v_node", "left")
    most = lambda k: F.greatest(F.coalesce(f"u_{k}", F.lit(0)), F.coalesce(f"v_{k}", F.lit(0)))
    return both.select("seg_id", most("d").alias("degree"), most("s").alias("streets"), F.when(F.col("u_d").isNotNull() | F.col("v_d").isNotNull(), "Yes").otherwise("No").alias("intersection"))


def ramp_types(segments: DataFrame, is_ramp: Column, is_mainline: Column) -> DataFrame:
    """Ramps by which of their ends lie on a mainline."""
    nodes = segments.where(is_mainline).select(F.explode(F.array("u_node", "v_node")).alias("node")).distinct().withColumn("main", F.lit(True))
    end = lambda s: nodes.select(F.col("node").alias(f"{s}_node"), F.col("main").alias(f"{s}_main"))
    r = segments.where(is_ramp).join(end("u"), "u_node", "left").join(end("v"), "v_node", "left")
    u, v = F.coalesce("u_main", F.lit(False)), F.coalesce("v_main", F.lit(False))
    return r.select("seg_id", F.when(u & v, "Connector").when(u, "Exit").when(v, "Entrance").otherwise("Ramp").alias("ramp"))


def intersection_names(segments: DataFrame) -> DataFrame:
    """``A & B`` of the first two names at a node; nodes of one name have none."""
    ends = segments.select(F.explode(F.array("u_node", "v_node")).alias("node"), "name").distinct()
    first = ends.withColumn("_r", F.row_number().over(Window.partitionBy("node").orderBy("name"))).where("_r <= 2")
    names = first.groupBy("node").agg(F.array_sort(F.collect_list("name")).alias("names")).where(F.size("names") == 2)
    return names.select("node", F.array_join("names", " & ").alias("crossing"))


def fill_from_same_node(crashes: DataFrame) -> DataFrame:
    """Missing positions from the last crash of the same node that has one."""
    known = crashes.where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & (F.col("node") != "")).groupBy("node").agg(F.max_by(F.struct("lat", "lon"), "id").alias("p"))
    # Only crashes with a node go through the join: all others would meet on one key.
    has = F.coalesce(F.col("node"), F.lit("")) != ""
    filled = crashes.where(has).join(known, "node", "left").select("id", F.coalesce("lat", F.col("p.lat")).alias("lat"), F.coalesce("lon", F.col("p.lon")).alias("lon"))
    return filled.union(crashes.where(~has).select("id", "lat", "lon"))


def fresh(cache: DataFrame, on: str, as_of: str, days: int) -> DataFrame:
    """Cached rows that are younger than ``days`` at a stated date."""
    return cache.where(F.datediff(F.lit(as_of).cast("date"), F.col(on)) < days)


def counties_within(counties: DataFrame, centres: DataFrame, km: float, top: int | None) -> DataFrame:
    """Counties around each centre of a small stated table, nearest first."""
    d = haversine_m(F.col("c_lat"), F.col("c_lon"), F.col("m_lat"), F.col("m_lon"))
    near = counties.join(small(centres), d <= km * 1000).select("mpo", "county", F.round(d, 4).alias("dist_m"))
    if top is None:
        return near
    return near.withColumn("place", F.row_number().over(Window.partitionBy("mpo").orderBy("dist_m", "county")).cast("long")).where(F.col("place") <= top).drop("dist_m")


def _plain(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def resolve_fips(stated: DataFrame, counties: DataFrame) -> DataFrame:
    """id -> fips and method: the code itself, the full name, the base name, then letters and digits only.

    stated: id, given, name; counties: fips, full, base.  Each way is one equi join; the first that hits wins.
    """
    ways = [("fips", F.col("given").cast("string"), F.col("fips").cast("string")), ("full", F.lower("name"), F.lower("full")), ("base", F.lower("name"), F.lower("base")), ("alnum", _plain(F.col("name")), _plain(F.col("base")))]
    keys = F.array(*[F.struct(F.lit(k).alias("step"), F.lit(m).alias("method"), mine.alias("key")) for k, (m, mine, _) in enumerate(ways)])
    names = F.array(*[F.struct(F.lit(k).alias("step"), theirs.alias("key")) for k, (_, _, theirs) in enumerate(ways)])
    asked = stated.select("id", F.explode(keys).alias("k")).select("id", "k.*").where(F.col("key").isNotNull())
    known = counties.select("fips", F.explode(names).alias("k")).select("fips", "k.*")
    hits = asked.join(known, ["step", "key"]).groupBy("id").agg(F.min(F.struct("step", "fips", "method")).alias("b"))
    return stated.select("id").join(hits, "id", "left").select("id", F.col("b.fips").alias("fips"), F.col("b.method").alias("method"))


def resolve_geography(crashes: DataFrame, counties: DataFrame, bridge: DataFrame) -> DataFrame:
    """County and MPO of every crash; names are resolved once per distinct jurisdiction, then joined."""
    names = crashes.select(F.col("juris").alias("id"), F.lit(None).cast("int").alias("given"), F.col("juris").alias("name")).distinct()
    found = resolve_fips(names, counties).select(F.col("id").alias("juris"), "fips")
    mpo = bridge.where("tier = 'mpo'").groupBy("fips").agg(F.min("entity").alias("mpo"))
    known = found.join(counties.select("fips", F.col("base").alias("county")), "fips", "left").join(mpo, "fips", "left")
    return crashes.join(known, "juris", "left").select("id", "fips", "county", "mpo")


def recommend(crashes: DataFrame, cmfs: DataFrame, location: str, pattern: str, least: int, top: int) -> DataFrame:
    """Countermeasures for the crash patterns of each location: rating, match and proof add up; the best few stay.

    A score hangs on the countermeasure alone, so only the best few of each tag can be among a location's best few:
    the rest go before the join, and what is joined doesn't grow with the catalogue.
    """
    patterns = crashes.groupBy(location, F.col(pattern).alias("tag")).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    score = F.col("rating") * 10 + 20 + F.when(F.col("proven"), 25).otherwise(0)
    tagged = cmfs.select("cmf", score.alias("score"), F.explode("tags").alias("tag")).groupBy("tag", "cmf").agg(F.max("score").alias("score"))
    few = tagged.withColumn("_r", F.row_number().over(Window.partitionBy("tag").orderBy(F.desc("score"), "cmf"))).where(F.col("_r") <= top).drop("_r")
    best = patterns.join(few, "tag").groupBy(location, "cmf").agg(F.max("score").alias("score"))
    return best.withColumn("place", F.row_number().over(Window.partitionBy(location).orderBy(F.desc("score"), "cmf")).cast("long")).where(F.col("place") <= top)
