"""Fill-in-middle transformation by repeated-capture matching.

A text is cut to units, lines by default, by a single ``fullmatch`` of ``(unit)*`` of the regex library, which keeps
every repetition of its group: ``match.ends(1)`` holds the end of each unit, so its length is the number of units n
and the two cuts are looked up in it.  Prefix ends after the smaller of ``h1 % (n + 1)`` and ``h2 % (n + 1)`` units and
middle after the larger; suffix is the rest.  h1 to h4 are the first four 8-digit groups of the hex SHA-256 of
``seed:doc_id``, so an example depends on nothing but seed, id and text.

Forms: ``plain`` (the text itself) where the text is empty or holds a sentinel, or where ``h3 % 100`` is not below
``rate``; else ``spm`` where ``h4 % 100`` is below ``spm``, else ``psm``::

    psm  <P>prefix<S>suffix<M>middle
    spm  <S>suffix<P>prefix<M>middle

Since no text with a sentinel is cut, :func:`restore` finds each part of an output again.

A null text is an empty one and a null id stands as ``null``; repeated rows give one row each, an empty table none.
Texts of any length are matched whole: one text with its line ends is what a task holds beside its batch.  Other
columns, whatever their names, are left out by :func:`transform` unless named in ``keep``.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.common import schema_of

#: A line with its end, or the last one without.
LINE = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM = 7, 100, 50
#: Batches stay this small, as every row makes a copy of its text.
BATCH_CHARS = 4_000_000


@lru_cache(16)
def _matcher(unit: str):
    import regex

    return regex.compile(f"({unit})*")


def units(text: str, unit: str = LINE) -> list[int]:
    """Where each unit ends."""
    match = _matcher(unit).fullmatch(text)
    if match is None:
        raise ValueError("the units don't cover the text")
    return match.ends(1)


def draws(doc_id, seed: int = SEED) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[8 * k : 8 * k + 8], 16) for k in range(4))


def example(doc_id, text: str | None, unit: str = LINE, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> tuple[int, str, int | None, int | None, str]:
    """n, form, length of prefix and of middle (None if plain), output."""
    text = text or ""
    ends = units(text, unit)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(x in text for x in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (low, high))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that an output was made of."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    head, middle = output.split(MIDDLE)
    one, two = head.removeprefix(first).split(second)
    return (one + middle + two) if form == "psm" else (two + middle + one)


def transform(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), unit: str = LINE, seed: int = SEED, rate: int = RATE, spm: int = SPM, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """``keep``, n, form, prefix_chars, middle_chars and ``output``, the training text."""
    schema = schema_of(docs, list(keep), "n long, form string, prefix_chars long, middle_chars long, output string")
    types = ("int64", "string", "int64", "int64", "string")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, texts, out, at, chars = batch.column(0).to_pylist(), batch.column(1), [], 0, 0
            for k in range(batch.num_rows):
                text = texts[k].as_py()
                out.append(example(ids[k], text, unit, seed, rate, spm))
                chars += len(text or "")
                if chars >= batch_chars or k + 1 == batch.num_rows:
                    made = [pa.array(column, pa.type_for_alias(t)) for column, t in zip(zip(*out), types)]
                    yield pa.RecordBatch.from_arrays([c.slice(at, len(out)) for c in batch.columns[2:]] + made, schema.fieldNames())
                    out, at, chars = [], k + 1, 0

    kept = [F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(keep)]  # by place, as names may clash
    return docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), *kept).mapInArrow(run, schema)


def digest(docs: DataFrame, unit: str = LINE, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the hashes of :func:`transform`'s output and of the text restored from it."""

    def restored(batches):
        import pyarrow as pa

        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        for batch in batches:
            outputs, forms = batch.column(5), batch.column(2)
            hashes = [(sha(t), sha(restore(t, f.as_py()))) for t, f in ((o.as_py(), f) for o, f in zip(outputs, forms))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array([h[0] for h in hashes], pa.string()), pa.array([h[1] for h in hashes], pa.string())], schema.fieldNames())

    made = transform(docs, ("doc_id",), unit, seed, rate, spm)
    schema = schema_of(made, ["doc_id", "n", "form", "prefix_chars", "middle_chars"], "output_sha256 string, restored_sha256 string")
    return made.mapInArrow(restored, schema)
