"""Token counts from an exact length histogram.

Every document is encoded once, in one pass; documents are counted by encoded length.  The histogram has a row per distinct
length, whatever the number of documents, and suffix sums over it answer totals, quantiles and the tokens left
after truncation for every context limit at once.

Null and empty texts have length 0 (plus the end id where one is counted).  Repeated rows count each.  An empty
table gives an empty histogram.  Columns other than ``text`` are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbline.llm.common import checkpoint
from kerbline.llm.tokens import Encoder, default_path, slices

#: Lengths in a range of the two-level running sums.
RANGE = 1024


def encoded_lengths(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """n_tokens long, a row per document."""
    path = path or default_path()

    def lengths(batches):
        import pyarrow as pa

        encoder = Encoder.get(path)
        width = encoder.dtype.itemsize
        for batch in batches:
            for piece in slices(batch):
                yield pa.RecordBatch.from_arrays([pa.array([len(b) // width for b in encoder.encode(piece.column(0).to_pylist())], pa.int64())], ["n_tokens"])

    return docs.select(text).mapInArrow(lengths, "n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """n_tokens, docs, tokens and, for each length taken as a limit, docs_longer, tokens_longer and truncated_tokens.

    ``docs_longer`` and ``tokens_longer`` are over documents of more than n_tokens; ``truncated_tokens`` is the
    corpus total if every document were cut at n_tokens.  The sums run over ranges of lengths, then inside each
    range, so no task sees more than the ranges or one range.
    """
    # Sums below ask for the histogram again and again; documents are encoded for it once.
    hist = checkpoint(lengths.groupBy("n_tokens").agg(F.count("*").alias("docs"))).withColumns({"tokens": F.col("n_tokens") * F.col("docs"), "range": F.floor(F.col("n_tokens") / RANGE)})
    after = Window.orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranges = hist.groupBy("range").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t")).select("range", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t"))
    inside = Window.partitionBy("range").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    longer = hist.join(ranges, "range").withColumns({
        "docs_longer": F.col("d") + F.coalesce(F.sum("docs").over(inside), F.lit(0)),
        "tokens_longer": F.col("t") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)),
    })
    total = hist.agg(F.sum("tokens").alias("all_tokens"), F.sum("docs").alias("all_docs"))
    return longer.crossJoin(F.broadcast(total)).select(
        "n_tokens", "docs", "tokens", "docs_longer", "tokens_longer",
        (F.col("all_tokens") - F.col("tokens_longer") + F.col("docs_longer") * F.col("n_tokens")).alias("truncated_tokens"),
        (F.lit(1.0) - F.col("docs_longer") / F.col("all_docs")).alias("quantile"),
    )


def truncated_totals(hist: DataFrame, limits: DataFrame) -> DataFrame:
    """For context limits (column ``limit``): tokens kept and documents cut.

    A limit between two lengths is answered from the last length at or under it.
    """
    both = limits.select("limit").join(hist, F.col("n_tokens") <= F.col("limit"), "left").groupBy("limit").agg(F.max_by(F.struct("n_tokens", "docs_longer", "truncated_tokens"), "n_tokens").alias("h"))
    all_docs = hist.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("all_docs"))
    docs_cut = F.coalesce(F.col("h.docs_longer"), F.col("all_docs"))
    return both.crossJoin(F.broadcast(all_docs)).select("limit", docs_cut.alias("docs_cut"), (F.coalesce(F.col("h.truncated_tokens"), F.lit(0)) + docs_cut * (F.col("limit") - F.coalesce(F.col("h.n_tokens"), F.lit(0)))).alias("tokens"))


def length_quantiles(hist: DataFrame, qs: list[float]) -> DataFrame:
    """q, n_tokens: the smallest length that at least a share q of the documents doesn't exceed."""
    wanted = hist.select(F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q"), "n_tokens", "quantile")
    return wanted.where(F.col("quantile") >= F.col("q") - 1e-12).groupBy("q").agg(F.min("n_tokens").alias("n_tokens"))
