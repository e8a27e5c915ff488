"""Quality rules with cross-document line frequency.

Base rules look at one text: too few words, or too many words inside eight-word windows that occur twice or
more in it.  The method looks across documents: lines are normalised (A-Z lower-cased, digits to 0, outer white
space off) and, per host, the distinct documents that hold a line are counted.  A line held by more than
``max(MIN_DOCS, SHARE * documents of the host)`` documents is boilerplate and removed; a document that keeps
less than :data:`LEAST_LEFT` of its words is depleted and rejected.  Exact copies count as one document: many
copies of a good text are a matter for deduplication and do not make its lines boilerplate.

Null and empty texts have no words and fail the base rules.  A null host is a host.  Repeated rows are judged
each.  An empty table gives no rows.  Other columns are kept by :func:`clean` and not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.llm.common import LOWER, UPPER, checkpoint, n_words, schema_of, small, unwrapped, wrapped

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
MIN_DOCS, SHARE, LEAST_LEFT = 20, 0.02, 0.2
_EDGE = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"
_BLANKS = "\t\n\x0b\x0c\r "


def repeated_words(codes) -> int:
    """How many words lie in windows of :data:`WINDOW` words found twice or more; codes: an int array, equal for equal words."""
    import numpy as np

    n = len(codes) - WINDOW + 1
    if n < 2:
        return 0
    # Windows get exact numbers by doubling: pairs of words, pairs of pairs, pairs of those.
    level, step = codes.astype(np.int64), 1
    while step < WINDOW:
        a, b = level[: len(level) - step], level[step:]
        _, level = np.unique(a * (int(level.max()) + 1) + b, return_inverse=True)
        step *= 2
    again = np.bincount(level)[level] > 1
    edge = np.zeros(len(codes) + 1, np.int64)
    edge[:n][again] += 1
    edge[WINDOW : WINDOW + n][again] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    import numpy as np

    words = text.encode("utf-8", "surrogatepass").split()  # bytes are split at just these white-space characters
    seen: dict[bytes, int] = {}
    codes = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    lines = [x for x in text.split("\n") if x.strip(_BLANKS)]
    return len(words), len(text) - sum(text.count(x) for x in _BLANKS), sum(text.count(x) for x in SYMBOLS), len(lines) - len(set(lines)), repeated_words(codes)


def measured(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` with the five base figures of each text and base_failed."""
    schema = schema_of(docs, keys, "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")

    def figures(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [measure(t.as_py() or "") for t in batch.column(len(keys))]
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *columns], schema.fieldNames())

    out = docs.select(*keys, "text").mapInArrow(figures, schema)
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def normalised(line: Column) -> Column:
    return F.regexp_replace(F.translate(line, UPPER + "123456789", LOWER + "000000000"), _EDGE, "")


def line_counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """Lines above the limit of their host: host, line_hash.

    Only hashes are shuffled.  Copies are dropped by text hash before lines are counted.
    """
    texts = docs.where(F.col("text").isNotNull()).select(F.col(host).alias("host"), F.xxhash64("text").alias("text_hash"), "text")
    lines = texts.select("host", "text_hash", F.explode(F.array_distinct(F.transform(F.split("text", "\n"), lambda x: F.xxhash64(normalised(x))))).alias("line_hash"))
    per_host = checkpoint(texts.groupBy("host", "text_hash").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("host_docs")))
    counted = lines.where(F.col("line_hash") != F.xxhash64(F.lit(""))).groupBy("host", "line_hash", "text_hash").agg(F.lit(1).alias("one")).groupBy("host", "line_hash").agg(F.count("*").alias("docs"))
    # No host has a lower limit than this, so most lines go before the join.
    counted = counted.where(F.col("docs") > MIN_DOCS)
    limits = small(per_host, per_host.count())
    over = F.col("docs") > F.greatest(F.lit(MIN_DOCS), F.col("host_docs") * SHARE)
    return counted.alias("c").join(limits.alias("h"), F.col("c.host").eqNullSafe(F.col("h.host"))).where(over).select("c.host", "line_hash", "docs")


def judge(docs: DataFrame, host: str = "source", frequent: DataFrame | None = None) -> DataFrame:
    """doc_id, the base figures, base_failed, words_left and kept, a row per row of ``docs``."""
    keyed = docs.select("doc_id", F.col(host).alias("host"), F.xxhash64("text").alias("text_hash"), "text")
    base = measured(keyed, ["doc_id", "host", "text_hash"])
    # A text has the same lines wherever it stands, so what is lost is told per host and text.
    lost = _lost_per_text(keyed, checkpoint(line_counts(keyed, "host")) if frequent is None else frequent)
    n = lost.count()
    joined = base.alias("b").join(small(lost, n).alias("x"), F.col("b.host").eqNullSafe(F.col("x.host")) & (F.col("b.text_hash") == F.col("x.text_hash")), "left")
    left = F.col("n_words") - F.coalesce(F.col("x.lost"), F.lit(0))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", left.alias("words_left"),
        (~F.col("base_failed") & (left >= F.col("n_words") * LEAST_LEFT)).alias("kept"), F.col("b.text_hash").alias("text_hash"), F.col("b.host").alias("host"),
    )


def _lost_per_text(keyed: DataFrame, frequent: DataFrame) -> DataFrame:
    """host, text_hash, lost: the words in boilerplate lines, for texts that hold any."""
    # Rows are told apart by their place, not their id: ids and texts may repeat, and ids may be null.
    rows = keyed.select(F.monotonically_increasing_id().alias("row"), "host", "text_hash", "text")
    lines = rows.select("row", "host", "text_hash", F.explode(F.split("text", "\n")).alias("line")).withColumns({"line_hash": F.xxhash64(normalised(F.col("line")))})
    mine = lines.alias("l").join(small(frequent, frequent.count()).alias("f"), F.col("l.host").eqNullSafe(F.col("f.host")) & (F.col("l.line_hash") == F.col("f.line_hash")))
    mine = mine.select("l.host", "l.text_hash", "l.row", n_words(F.col("line")).alias("words"))
    # Copies lose the same lines each: words per row, then one figure per text.
    return checkpoint(mine.groupBy("host", "text_hash", "row").agg(F.sum("words").alias("lost")).groupBy("host", "text_hash").agg(F.min("lost").alias("lost")))


def without_boilerplate(docs: DataFrame, frequent: DataFrame, host: str = "source") -> DataFrame:
    """``docs`` with the lines of ``frequent`` (host, line_hash) taken out; other lines stay as they are.

    A host has few such lines (each is in a fixed share of its documents), so they travel as one array per host.
    Where a text changes, ``n_chars`` is counted anew.
    """
    per_host = checkpoint(frequent.groupBy("host").agg(F.collect_set("line_hash").alias("hashes")))
    kept = F.array_join(F.filter(F.split("row.text", "\n"), lambda x: ~F.array_contains("hashes", F.xxhash64(normalised(x)))), "\n")
    text = F.when(F.col("hashes").isNull(), F.col("row.text")).otherwise(kept)
    out = wrapped(docs, own_host=F.col(host)).join(small(per_host, per_host.count(), 20_000), F.col("own_host").eqNullSafe(F.col("host")), "left").withColumn("left", text)
    row = F.col("row").withField("text", F.col("left"))
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("left").eqNullSafe(F.col("row.text")), F.col("row.n_chars")).otherwise(F.length("left").cast(docs.schema["n_chars"].dataType))
        row = row.withField("n_chars", n_chars)
    return unwrapped(out.select(row.alias("row")))


def clean(docs: DataFrame, host: str = "source") -> DataFrame:
    """``docs`` without the rejected documents, and the others without their boilerplate lines."""
    frequent = checkpoint(line_counts(docs, host))
    verdicts = judge(docs, host, frequent).where(~F.col("kept")).select(F.col("host").alias("bad_host"), F.col("text_hash").alias("bad_text")).distinct()
    verdicts = checkpoint(verdicts)
    rows = wrapped(docs, own_host=F.col(host), own_text=F.xxhash64("text"))
    kept = rows.join(small(verdicts, verdicts.count()), F.col("own_host").eqNullSafe(F.col("bad_host")) & (F.col("own_text") == F.col("bad_text")), "left_anti")
    return without_boilerplate(unwrapped(kept), frequent, host)
