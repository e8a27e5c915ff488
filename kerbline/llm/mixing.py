"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sizes are words.  Each source gets a target: its weight's share of all words, stopped at ``max_epochs`` times
the source's own words, the excess reshared by weight (water filling, solved in closed form over the sources).
A target is met with complete epochs first; the rest is a weighted sample without replacement: every document
draws the exponential key ``-ln(u) / weight``, where u is a hash of its id, documents are ordered by key, and
their sizes are summed until the rest is full.  The document that crosses the budget gives the words that are
still missing.

Only a threshold per source leaves this computation (key, id, size and what the crossing document gives), so
the documents themselves are never sorted, shuffled or joined to one another: sizes are summed per source and
key bucket and the crossing bucket is found on those sums.  While one of the crossing buckets holds more than
:data:`SORTED` rows it is cut into buckets again (up to the key's 52 bits), so however large a source is, no task
sorts more than that, but for rows of one and the same key.

Null texts have no words and are never taken.  A null source is a source, last in order; a null id draws one
key for all such rows.  Rows that agree in id and size share the crossing document's words evenly (rounded
down).  An empty table gives no rows.  Other columns are kept by :func:`mix`, but those named as its results, which
it replaces; :func:`taken` and :func:`taken_whole` keep all columns.  The windows of :func:`targets` are over one row
per source, so sources should be thousands, not one per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.llm.common import WORD, checkpoint, n_words, small, unwrapped, wrapped

BLANKS = r"[\x20\x09-\x0D]*"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Key ranges that a source, or a crossing range of it, is cut into; and the most rows of a range that is sorted.
BUCKETS, LEVELS = 4096, 4
SORTED = 100_000
#: Characters whose share lowers a document's weight.
SYMBOLS = "#*$%&|<>"


def quality_weight(text: Column) -> Column:
    """1 for plain prose, towards 0 as symbols take over: 1 / (1 + 50 * share of symbols)."""
    text = F.coalesce(text, F.lit(""))
    marks = sum((F.length(text) - F.length(F.replace(text, F.lit(x), F.lit(""))) for x in SYMBOLS), F.lit(0))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(50.0) * marks / F.greatest(F.length(text), F.lit(1)))


def draw(doc_id: Column, weight: Column, seed: int = 0) -> Column:
    """The exponential key of a document; 52 bits of an md5, never 0."""
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    u = (F.conv(F.substring(hashed, 1, 13), 16, 10).cast("double") + 1) / float(2**52)
    return -F.log(u) / weight


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size -> with target.  Windows run over the sources only, one row each."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumns({"w": weight, "cap": (F.col("source_size") * max_epochs).cast("double")})
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    before, here_on = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    # If all smaller caps bind and this one doesn't, one unit of weight is worth `level`; the first such source fixes it.
    level = (F.sum("source_size").over(Window.partitionBy()).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(here_on)
    rows = ranked.withColumn("level", level).withColumn("level", F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "rank", "level"))).over(Window.partitionBy())["level"])
    return rows.select("source", "source_size", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("level") * F.col("w"), F.col("cap"))).alias("target"))


def _bucket(key: Column, level: int) -> Column:
    """The key's range at a level: of ranges of the levels before, one in :data:`BUCKETS`."""
    at = (1 - F.exp(-key)) * float(BUCKETS**level)
    at = at - F.floor(at) if level else at
    return F.least(F.lit(BUCKETS - 1), F.floor(at * BUCKETS)).cast("int")


def thresholds(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> tuple[DataFrame, int]:
    """(doc_id, source, size, key) -> a row per source with its target, epochs and threshold, and the number of sources."""
    goal, inside, n = None, sizes.withColumn("left", F.lit(None).cast("long")), 0
    for level in range(LEVELS):
        dealt = inside.withColumn("bucket", _bucket(F.col("key"), level))
        sums = checkpoint(dealt.groupBy("source", "bucket").agg(F.sum("size").alias("size"), F.count("*").alias("rows"), F.first("left").alias("left")))
        if goal is None:
            goal = checkpoint(targets(sums.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs))
            n = goal.count()
            epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
            goal = goal.withColumn("epochs", epochs).withColumn("rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
            sums = sums.alias("s").join(small(goal, n).alias("g"), F.col("s.source").eqNullSafe(F.col("g.source"))).select("s.source", "bucket", "size", "rows", F.col("rest").alias("left"))
        running = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))
        crossing = checkpoint(
            sums.withColumn("upto", running).where((F.col("upto") - F.col("size") <= F.col("left")) & (F.col("left") < F.col("upto")))
            .select("source", "bucket", "rows", (F.col("left") - F.col("upto") + F.col("size")).alias("left"))
        )
        inside = (
            dealt.drop("left").alias("d").join(small(crossing, n).alias("c"), F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("d.bucket") == F.col("c.bucket")))
            .select("d.doc_id", "d.source", "d.size", "d.key", "c.left")
        )
        if crossing.where(F.col("rows") > SORTED).isEmpty():
            break
        inside = checkpoint(inside)
    inside = inside.groupBy("source", "left", "key", "doc_id", "size").agg(F.count("*").alias("same"))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size")
    inside = inside.withColumn("upto", F.sum(F.col("size") * F.col("same")).over(order))
    at = (
        inside.where((F.col("upto") - F.col("size") * F.col("same") <= F.col("left")) & (F.col("left") < F.col("upto")))
        .select("source", F.struct("key", F.struct("doc_id").alias("doc_id"), "size").alias("at"), F.floor((F.col("left") - F.col("upto") + F.col("size") * F.col("same")) / F.col("same")).cast("long").alias("gives"))
    )
    return checkpoint(goal.alias("g").join(small(at, n).alias("a"), F.col("g.source").eqNullSafe(F.col("a.source")), "left").select("g.*", "at", "gives")), n


def _keyed(docs: DataFrame, weight: Column | None, by_text: bool) -> DataFrame:
    """row, id, source, size and key of every document."""
    w = quality_weight(F.col("text")) if weight is None else weight
    me = F.struct("doc_id", F.xxhash64("text").alias("text_hash")) if by_text else F.col("doc_id")
    return wrapped(docs, id=me, source=F.col("source"), size=n_words(F.col("text")), key=draw(F.col("doc_id"), w))


def _told(keyed: DataFrame, goal: DataFrame, n: int) -> DataFrame:
    """``keyed`` with its source's ``goal``, and ``taken``."""
    me = F.struct("key", F.struct(F.col("id").alias("doc_id")).alias("doc_id"), "size")
    more = F.when(F.col("goal.at").isNull(), 0).when(me < F.col("goal.at"), F.col("size")).when(me == F.col("goal.at"), F.col("goal.gives")).otherwise(0)
    joined = keyed.join(small(goal.select(F.struct("*").alias("goal")), n), F.col("source").eqNullSafe(F.col("goal.source")))
    return joined.withColumn("taken", F.col("goal.epochs") * F.col("size") + more)


def _sizes(keyed: DataFrame) -> DataFrame:
    return checkpoint(keyed.select("id", "source", "size", "key"))


def _mixed(docs: DataFrame, weight: Column | None, weights: tuple[int, ...], max_epochs: int, by_text: bool) -> DataFrame:
    keyed = _keyed(docs, weight, by_text)
    return _told(keyed, *thresholds(_sizes(keyed).withColumnRenamed("id", "doc_id"), weights, max_epochs))


def mix(docs: DataFrame, weight: Column | None = None, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, by_text: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, source and more) with mix_size, mix_source_size, mix_target, mix_epochs, mix_taken.

    ``weight`` is a document's quality, a positive column of ``docs`` such as a score; without one, the share of
    symbols stands in for it.  ``mix_taken`` counts words: ``mix_epochs`` times the whole document, and what one more,
    partial epoch takes of it: all, nothing, or what the document at the threshold still has to give.  With ``by_text``
    rows of one id and size are put in order of their texts' hashes, so that only rows of one id and text share.
    """
    mine = {"mix_size": F.col("size"), "mix_source_size": F.col("goal.source_size"), "mix_target": F.col("goal.target"), "mix_epochs": F.col("goal.epochs"), "mix_taken": F.col("taken")}
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in mine]
    return _mixed(docs, weight, weights, max_epochs, by_text).select(*kept, *[c.alias(k) for k, c in mine.items()])


def amounts(docs: DataFrame, weight: Column | None = None, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """doc_id, size, source_size, target, taken: the figures of :func:`mix` alone.  Texts are read once."""
    sizes = _sizes(_keyed(docs, weight, False))
    told = _told(sizes, *thresholds(sizes.withColumnRenamed("id", "doc_id"), weights, max_epochs))
    return told.select(F.col("id").alias("doc_id"), "size", F.col("goal.source_size").alias("source_size"), F.col("goal.target").alias("target"), "taken")


def taken(docs: DataFrame, weight: Column | None = None, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, by_text: bool = False) -> DataFrame:
    """The mix as rows of ``docs``: one per epoch, and the opening words of a document that gives a part, as they stand there."""
    mixed = _mixed(docs, weight, weights, max_epochs, by_text).where(F.col("size") > 0)
    part = F.col("taken") - F.col("goal.epochs") * F.col("size")
    copies = F.concat(F.array_repeat(F.col("size"), F.col("goal.epochs").cast("int")), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    rows = mixed.withColumn("words", F.explode(copies))
    # Words with the blanks before them, so that what is kept is the text's own beginning.
    cut = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(rf"({BLANKS}{WORD})"), F.lit(1)), 1, F.col("words").cast("int")), "")
    return unwrapped(rows.select(F.when(F.col("words") < F.col("size"), F.col("row").withField("text", cut)).otherwise(F.col("row")).alias("row")))


def taken_whole(docs: DataFrame, weight: Column | None = None, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, by_text: bool = True) -> DataFrame:
    """The mix as rows of ``docs``, whole ones alone: a document that gives half of its words or more comes once more, else it stays out.

    A source misses its target by half of its crossing document at most (and of the rows of the same id and text).
    """
    mixed = _mixed(docs, weight, weights, max_epochs, by_text).where(F.col("size") > 0)
    part = F.col("taken") - F.col("goal.epochs") * F.col("size")
    copies = (F.col("goal.epochs") + F.when(2 * part >= F.col("size"), 1).otherwise(0)).cast("int")
    return unwrapped(mixed.withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies))))
