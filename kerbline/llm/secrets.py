"""Secret scans: stated patterns, and Markov models of random strings and of ordinary identifiers.

The patterns find assignments of passwords and tokens, access-key ids and long hex strings.  Beyond them, every
run of 20 or more letters, digits and ``+ _ - =`` that has a letter and a digit (a key of letters alone, or a number
with dashes, is no candidate) is scored by two first-order
character models, one of random strings, one of ordinary identifiers; where the mean log-likelihood ratio per
character is over :data:`MARGIN`, the run is reported as ``markov``.  The models are counts of character pairs,
learnt from labelled samples of any size and added up in Spark to 64 x 64 numbers per class.
:func:`count_values` takes samples (value, random) that someone has labelled; :func:`label_samples` draws them
from all documents: what the patterns found is random, the words of texts where they found nothing are ordinary.

Spans are in code points, end exclusive.  Null and empty texts have no spans.  Rows are scanned each, repeats
too; an empty table gives no rows, and without samples of both classes the models find nothing.  Columns other
than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.common import schema_of
from kerbline.llm.tokens import slices

# The kinds of the stated patterns, in order, and the patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
_STARTS = re.compile(r"(?ai:passw|secret|token|api_?key)")

RUN = re.compile(r"[A-Za-z0-9+_=-]{20,}")
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
MARGIN = 0.35
SIDE = 64
_CODES = np.full(128, 63, np.int64)
_CODES[np.frombuffer(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", np.uint8)] = np.arange(62)


def base_spans(text: str) -> list[tuple[int, str, int, int, str]]:
    """(start, kind, start, end, value) of the stated patterns, in order of start, then kind."""
    found = []
    if _STARTS.search(text):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return [(a, KINDS[k], a, b, v) for a, k, b, v in sorted(found)]


def _pairs(value: str) -> np.ndarray:
    """Numbers of the character pairs of a string; other characters share the last code."""
    raw = np.frombuffer(value.encode("ascii", "replace"), np.uint8)
    codes = _CODES[raw]
    return codes[:-1] * SIDE + codes[1:]


def label_samples(docs: DataFrame) -> DataFrame:
    """random, pairs: character pairs of labelled strings, counted over all documents.

    Each Arrow batch gives at most two rows, the counts of its random and its ordinary strings, so what is
    shuffled doesn't hang on how many words there are.
    """

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            totals = np.zeros((2, SIDE * SIDE), np.int64)
            for text in batch.column(0):
                text = text.as_py() or ""
                spans = base_spans(text)
                for _, _, _, _, value in spans:
                    np.add.at(totals[1], _pairs(value), 1)
                if not spans:
                    # Pairs inside words: a blank is no part of any.
                    raw = np.frombuffer(text.encode("ascii", "replace"), np.uint8)
                    codes = _CODES[raw & 127]
                    word = codes < 63
                    both = word[:-1] & word[1:]
                    totals[0] += np.bincount((codes[:-1] * SIDE + codes[1:])[both], minlength=SIDE * SIDE)
            yield pa.RecordBatch.from_arrays([pa.array([False, True]), pa.array(totals.tolist(), pa.list_(pa.int64()))], ["random", "pairs"])

    return docs.select("text").mapInArrow(count, "random boolean, pairs array<long>")


def count_values(samples: DataFrame) -> DataFrame:
    """Labelled strings (value, random boolean) -> (random, pairs) for :func:`train`; rows with a null are left out."""

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            totals = np.zeros((2, SIDE * SIDE), np.int64)
            for value, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                np.add.at(totals[int(label)], _pairs(value), 1)
            yield pa.RecordBatch.from_arrays([pa.array([False, True]), pa.array(totals.tolist(), pa.list_(pa.int64()))], ["random", "pairs"])

    return samples.select("value", "random").dropna().mapInArrow(count, "random boolean, pairs array<long>")


def train(counts: DataFrame) -> list[list[float]]:
    """The log-likelihood ratio of each character pair (64 x 64), random over ordinary; a table of fixed size.

    counts: (random, pairs array of 4,096 counts), any number of rows.
    """
    rows = counts.select("random", F.posexplode("pairs").alias("pair", "n")).where("n > 0").groupBy("random", "pair").agg(F.sum("n").alias("n")).collect()  # 2 x 4,096 rows at most
    totals = np.zeros((2, SIDE, SIDE))
    for r in rows:
        totals[int(r["random"]), r["pair"] // SIDE, r["pair"] % SIDE] += r["n"]
    if not totals[0].sum() or not totals[1].sum():
        return np.full((SIDE, SIDE), -1.0).tolist()
    # A pair's probability backs off to its class's second character, then to evenness.
    single = totals.sum(axis=1) + 1
    single /= single.sum(axis=1, keepdims=True)
    cond = (totals + 4 * single[:, None, :]) / (totals.sum(axis=2, keepdims=True) + 4)
    return (np.log(cond[1]) - np.log(cond[0])).tolist()


def scan(docs: DataFrame, model: list[list[float]], margin: float = MARGIN) -> DataFrame:
    """doc_id, spans: array of (kind, start, end) in order of start, then kind; the models' kind is ``markov``."""
    ratio = np.array(model).ravel()

    def find(batches):
        import pyarrow as pa

        kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for piece in slices(batch, 1024):
                out = []
                for text in piece.column(1):
                    text = text.as_py() or ""
                    spans = [(k, a, b) for _, k, a, b, _ in base_spans(text)]
                    taken, more = [(a, b) for _, a, b in spans], []
                    for m in RUN.finditer(text):
                        value = m[0]
                        if _DIGIT.search(value) and _LETTER.search(value) and not any(a < m.end() and m.start() < b for a, b in taken) and ratio[_pairs(value)].mean() > margin:
                            more.append(("markov", m.start(), m.end()))
                    order = {k: n for n, k in enumerate(KINDS)}
                    spans = sorted(spans + more, key=lambda s: (s[1], order.get(s[0], len(KINDS)), s[2]))
                    out.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(out, kinds)], ["doc_id", "spans"])

    schema = schema_of(docs, ["doc_id"], "spans array<struct<kind:string,start:bigint,end:bigint>>")
    return docs.select("doc_id", "text").mapInArrow(find, schema)


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (joined), n_markov."""
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return scanned.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(written(F.filter("spans", lambda s: s["kind"] != "markov")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"), count("markov").alias("n_markov"),
    )


def redact(text: str, spans) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, start, end in ((s["kind"], s["start"], s["end"]) for s in spans):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])
