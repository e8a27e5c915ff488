"""Language identification by prediction by partial matching over bytes.

Each language has a variable-order context tree: how often each byte followed each context of up to :data:`ORDER`
bytes.  A text's code length in a language is the sum, over its bytes, of what the longest context known there says:
``-log2(count / (n + u))`` where the byte followed the context before (n times something followed, u different bytes),
else the escape's ``-log2(u / (n + u))`` and the same question of the next shorter context, with the bytes left out
that the longer one knew already (method C with exclusion); below order 0 all other bytes are alike.  Statistics stay
as learnt, so the lengths are exact sums and don't depend on what was read before.  The language of the shortest code,
its own ``-log2`` share of the training documents included, is the prediction (ties: the smaller name); ``score`` is
its posterior probability among the languages.

The trees are fitted on a bounded sample of the labelled texts: :data:`SAMPLE` bytes a language and :data:`TOTAL`
in all, in pieces of :data:`PIECE` bytes drawn by a hash of id and piece, with a share that comes from counting the bytes of all
of a language's texts.  A language with less is learnt whole.  Copies under one id are drawn together, but add no runs.  Counts of runs of ``ORDER + 1`` bytes
are gathered in Spark; all shorter runs follow from them.  The runs of all languages are one hash table, with the code
lengths in every language beside each run, so that nearly every byte costs one look-up; runs that no language has walk
down the contexts.  Tables are broadcast, and bounded as the sample is.

Texts are scored whole, in stretches of bounded size.  A null text, or one without a letter, is ``und`` with score 0,
as is every text where nothing could be learnt.  A null id is in no held-out part.  A language without bytes of text isn't
learnt.  Repeated rows are judged each; empty tables give no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.llm.common import schema_of

ORDER = 4
SAMPLE, TOTAL, PIECE = 2_000_000, 12_000_000, 4_096
STRETCH = 1 << 20
UNKNOWN = "und"


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


# Runs of bytes as numbers


def runs(data: bytes, order: int = ORDER, before: bytes = b"") -> np.ndarray:
    """For each byte of ``data`` the number made of it and the ``order`` bytes before; before a text stand zero bytes."""
    x = np.frombuffer(before[-order:].rjust(order, b"\0") + data, np.uint8)
    keys = np.zeros(len(data), np.uint64)
    for k in range(order + 1):
        keys = keys << np.uint64(8) | x[k : k + len(data)]
    return keys


def _counted(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64)


def run_counts(docs: DataFrame, shares: dict[str, float], order: int = ORDER, piece: int = PIECE) -> DataFrame:
    """lang, key, count of the runs in the drawn pieces of doc_id, lang, text; a task adds up what it has drawn."""

    def count(batches):
        import pyarrow as pa
        import xxhash

        found: dict[str, tuple[list, list]] = {}
        for batch in batches:
            for doc_id, lang, text in zip(*(batch.column(k) for k in range(3))):
                lang, share, name = lang.as_py(), shares[lang.as_py()], str(doc_id)
                data = text.as_py().encode("utf-8", "surrogatepass")
                for at in range(0, len(data), piece):
                    if share >= 1 or xxhash.xxh3_64_intdigest(f"{name}:{at}:".encode() + data[at : at + piece], 17) < share * 2**64:
                        keys, counts = found.setdefault(lang, ([], []))
                        keys.append(runs(data[at : at + piece], order, data[max(0, at - order) : at]))
                        counts.append(np.ones(len(keys[-1]), np.int64))
                        if len(keys) > 200:
                            found[lang] = tuple([x] for x in _counted(keys, counts))
        for lang, (keys, counts) in found.items():
            key, n = _counted(keys, counts)
            for at in range(0, len(key), 65_536):
                part = slice(at, at + 65_536)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key[part]), pa.string()), pa.array(key[part].astype(np.int64)), pa.array(n[part])], ["lang", "key", "count"])

    counted = docs.select(F.col("doc_id").cast("string"), "lang", "text").mapInArrow(count, "lang string, key long, count long")
    return counted.groupBy("lang", "key").agg(F.sum("count").alias("count"))


# The model


def _at(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Positions in sorted numbers, -1 where missing."""
    if not len(known):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, at, -1)


def _tail(keys: np.ndarray, n: int) -> np.ndarray:
    return keys & np.uint64((1 << 8 * n) - 1)


def _bits(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """-log2(part / whole), 0 where there is no part."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(part > 0, np.log2(np.maximum(whole, 1)) - np.log2(np.maximum(part, 1)), 0.0)


class Trees:
    """The languages' context trees over one list of runs: ``keys`` with ``counts`` (runs, languages), of ``order + 1`` bytes."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int = ORDER):
        self.order, self.n_langs = order, counts.shape[1]
        top = order + 1
        # Runs of k bytes and their counts; contexts of j bytes with n and u.
        self.grams, self.counts = {top: keys}, {top: counts}
        for k in range(order, 0, -1):
            self.grams[k], at = np.unique(_tail(self.grams[k + 1], k), return_inverse=True)
            self.counts[k] = self._sums(at, self.counts[k + 1], len(self.grams[k]))
        self.contexts, self.n, self.u = {}, {}, {}
        of = {}
        for j in range(order + 1):
            self.contexts[j], of[j] = np.unique(self.grams[j + 1] >> np.uint64(8), return_inverse=True)
            self.n[j], self.u[j] = (self._sums(of[j], x, len(self.contexts[j])) for x in (self.counts[j + 1], self.counts[j + 1] > 0))
        # After an escape from a context of j + 1 bytes: what is left in the one of j bytes.
        self.n_left, self.u_left = {}, {}
        for j in range(order):
            suffix = _at(self.contexts[j], _tail(self.contexts[j + 1], j))
            shorter = self.counts[j + 1][_at(self.grams[j + 1], _tail(self.grams[j + 2], j + 1))]
            known = self._sums(of[j + 1], np.where(self.counts[j + 2] > 0, shorter, 0), len(self.contexts[j + 1]))
            self.n_left[j + 1], self.u_left[j + 1] = self.n[j][suffix] - known, self.u[j][suffix] - self.u[j + 1]

    def _sums(self, at: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, self.n_langs), np.int64)
        for lang in range(self.n_langs):
            out[:, lang] = np.bincount(at, x[:, lang], n)
        return out

    def costs(self, keys: np.ndarray) -> np.ndarray:
        """Bits of each run's last byte after the bytes before it, in each language, by walking down the contexts."""
        cost, open_ = np.zeros((len(keys), self.n_langs)), np.ones((len(keys), self.n_langs), bool)
        longer, had = None, np.zeros((len(keys), self.n_langs), bool)  # the context escaped from, where one was known
        for j in range(self.order, -1, -1):
            gram, context = _at(self.grams[j + 1], _tail(keys, j + 1)), _at(self.contexts[j], _tail(keys >> np.uint64(8), j))
            c = np.where(gram[:, None] >= 0, self.counts[j + 1][gram], 0)
            n, u = (np.where(context[:, None] >= 0, x[j][context], 0) for x in (self.n, self.u))
            known = n > 0
            if longer is not None:
                n, u = np.where(had, self.n_left[j + 1][longer], n), np.where(had, self.u_left[j + 1][longer], u)
            hit = open_ & (c > 0)
            cost += np.where(hit, _bits(c, n + u), np.where(open_, _bits(u, n + u), 0.0))
            open_ &= ~hit
            longer, had = context, known
        return cost + np.where(open_, np.log2(np.maximum(256 - self.u[0][0], 1)), 0.0)


class Model:
    """What workers need: a hash table of the longest runs with their bits in each language, and the trees for other runs."""

    def __init__(self, langs: list[str], shares: list[float], trees: Trees):
        self.langs, self.trees = langs, trees
        self.own = -np.log2(np.maximum(np.asarray(shares, float), 1e-300)) if langs else np.zeros(0)
        keys = trees.grams[trees.order + 1]
        self.bits = np.concatenate([trees.costs(keys[at : at + 65_536]) for at in range(0, len(keys), 65_536)] or [np.zeros((0, len(langs)))]).astype(np.float32)
        width = max(4, (2 * len(keys)).bit_length())
        self.shift, self.slots = np.uint64(64 - width), np.full(1 << width, -1, np.int32)
        place, left = self._slot(keys), np.arange(len(keys))
        while len(left):  # each free slot takes one of those that want it, the others go on to the next
            want, first = np.unique(place[left], return_index=True)
            free = self.slots[want] < 0
            self.slots[want[free]] = left[first[free]]
            left = left[self.slots[place[left]] != left]
            place[left] = (place[left] + 1) & (len(self.slots) - 1)
        self.keys = keys

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The run's position, -1 where no language has it."""
        place = self._slot(keys)
        at = self.slots[place]
        open_ = np.nonzero((at >= 0) & (self.keys[at] != keys))[0]
        while len(open_):
            place[open_] = (place[open_] + 1) & (len(self.slots) - 1)
            at[open_] = self.slots[place[open_]]
            open_ = open_[(at[open_] >= 0) & (self.keys[at[open_]] != keys[open_])]
        return at

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language."""
        out = np.zeros((len(texts), len(self.langs)))
        pieces, of, size = [], [], 0
        for k, data in enumerate(texts):
            for at in range(0, len(data), STRETCH):
                pieces.append(runs(data[at : at + STRETCH], self.trees.order, data[max(0, at - self.trees.order) : at]))
                of.append(k)
                size += len(pieces[-1])
                if size >= STRETCH:
                    self._add(out, pieces, of)
                    pieces, of, size = [], [], 0
        if pieces:
            self._add(out, pieces, of)
        return out

    def _add(self, out: np.ndarray, pieces: list[np.ndarray], of: list[int]) -> None:
        keys = np.concatenate(pieces)
        at = self.find(keys)
        bits = self.bits[at]
        missed = np.nonzero(at < 0)[0]
        for k in range(0, len(missed), 65_536):
            part = missed[k : k + 65_536]
            bits[part] = self.trees.costs(keys[part])
        starts = np.cumsum([0] + [len(p) for p in pieces[:-1]])
        np.add.at(out, of, np.add.reduceat(bits, starts, axis=0, dtype=np.float64))


def fit(labelled: DataFrame, order: int = ORDER, sample: int = SAMPLE, total: int = TOTAL) -> Model:
    """doc_id, text, lang of the documents to learn from -> the model."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("docs")).where("bytes > 0").orderBy("lang").collect()  # a row per language
    langs, whole = [r["lang"] for r in sizes], sum(r["docs"] for r in sizes)
    each = min(sample, total // max(1, len(langs)))
    counts = run_counts(rows.where(F.octet_length("text") > 0), {r["lang"]: each / r["bytes"] for r in sizes}, order).toArrow()
    names = counts["lang"].combine_chunks().dictionary_encode()
    place = np.array([langs.index(x) for x in names.dictionary.to_pylist()], np.int64)[names.indices.to_numpy()]
    key, at = np.unique(counts["key"].to_numpy().astype(np.uint64), return_inverse=True)
    table = np.zeros((len(key), len(langs)), np.int64)
    table[at, place] = counts["count"].to_numpy()
    return Model(langs, [r["docs"] / whole for r in sizes], Trees(key, table, order))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and bits_per_byte, the code's length in the predicted language; only texts are looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        import regex

        letter, model = regex.compile(r"\p{L}"), shared.value
        for batch in batches:
            texts = batch.column(1)
            said, at, data, size = [], [], [], 0
            lengths = np.zeros((batch.num_rows, len(model.langs)))
            for k in range(batch.num_rows):
                text = texts[k].as_py()
                said.append(bool(model.langs) and text is not None and letter.search(text) is not None)
                if said[-1]:
                    at.append(k)
                    data.append(text.encode("utf-8", "surrogatepass"))
                    size += len(data[-1])
                if data and (size >= 4 * STRETCH or k + 1 == batch.num_rows):
                    lengths[at] = model.lengths(data)
                    at, data, size = [], [], 0
            n_bytes = np.maximum(pc.binary_length(texts).fill_null(1).to_numpy(), 1)
            full = np.round(lengths + model.own, 4) if model.langs else np.zeros((batch.num_rows, 1))
            best = full.argmin(axis=1)
            score = 1 / np.exp2(np.minimum(full[np.arange(len(full)), best][:, None] - full, 0)).sum(axis=1)
            names = [model.langs[b] if s else UNKNOWN for b, s in zip(best, said)]
            of_best = lengths[np.arange(len(full)), best] / n_bytes if model.langs else np.zeros(batch.num_rows)
            blank = ~np.array(said, bool)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(np.where(blank, 0.0, np.round(score, 6))), pa.array(np.round(of_best, 6), mask=blank)], ["doc_id", "lang_pred", "score", "bits_per_byte"])

    return docs.select("doc_id", "text").mapInArrow(run, schema_of(docs, ["doc_id"], "lang_pred string, score double, bits_per_byte double"))


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte: learnt from the documents that aren't held out, told for all."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")
