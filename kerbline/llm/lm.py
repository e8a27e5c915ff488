"""Language-model scoring by online logistic context mixing.

A text is a sequence of tokens: its words, A-Z lower-cased, then an end.  The model codes a token as a path of binary
decisions through a prefix code whose leaves are the end, the :data:`TOP` commonest words, and one leaf for each class
of last byte of all other words.  After such a leaf a word is told by the class of its count, then evenly among the
words of that class and byte; a word that the training text doesn't have is spelled byte by byte, each byte a path of
decisions in a second prefix code.  The probabilities of all tokens add up to one, so ``score`` is a log probability
and divides into bits per byte.

* **Hashed-context bit predictors.**  Contexts of a word's decision: none; the state (the latest of the 15 commonest
  words that stands before the previous word); the previous word (its last two bytes, hashed, where it is not among
  the commonest); previous word and state together.  Contexts of a byte's decision: one, two, three and four bytes
  before it.  Each looks up how often zeros and ones were seen and leans on the shorter context's estimate.
* **Gated mixing.**  Their log odds are added with weights.  A gate, told by how much evidence the three longer
  contexts have, chooses the weights, which are learnt online, block by block, from leave-one-out predictions on all
  training text.
* **Adaptive refinement.**  A last table maps (evidence, mixed log odds) to what was observed there; the two are
  averaged in the log-odds domain.

Everything is gathered over the whole training part and grows with it: the count of every word, and the counts of
(previous word, state, leaf).  A decision's counts are sums of the latter over the previous word's rows, so rows are
dealt to shards by previous word, as many shards as :data:`SHARD` tokens each need, and a shard's hash tables are as
large as its own decisions ask for.  Tokens are sent to their shard's counts as arrays, sorted, a row per piece of
text and shard; shards of a hot word are split, each part with a copy of the shard's counts (at most one per state and
leaf).  Shards learn alike from the same first weights, in the order of a hash of their rows, and are averaged by
evidence, so neither the order of rows nor their partitions change a score but in the last digits.

``docs`` is read several times: hand in a stored table, not a frame that gives other rows each time.  A null text is
empty: an end alone.  Rows are scored each, repeats too; a null id is in the training part when the caller's split
says so (here: null is not held out).  Without training text all words are unknown and spelled at even odds.  An empty
table gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.llm.common import stored

#: Words with a leaf of their own, classes of last bytes, classes of last two bytes, and states.
TOP, LAST, ENDINGS, STATES = 4_000, 128, 256, 16
LEAVES, BEFORE = 1 + TOP + LAST, 1 + TOP + ENDINGS
#: Words whose counts are broadcast, at most; the least count of one.
KNOWN, LEAST = 65_536, 4
#: Training tokens of a shard, and tokens scored in one group.
SHARD, SPLIT = 1 << 21, 1 << 22
#: Bytes and rows of text cut at once; they bound a worker's memory (but for a longer single text).
PIECE_BYTES, PIECE_ROWS = 4 << 20, 32_000
#: Rows of counts in a block of online learning, words that make a shard of the spelling model, merged rows.
BLOCK, WORDS_A_SHARD, FAN_IN = 512, 16_384, 16
CONTEXTS, GATES, CELLS = 4, 64, 48
#: How many sightings of its own outweigh the shorter context's estimate.
LEAN = (0.5, 3.0, 6.0, 3.0)
END, SIGNS = 256, 257
#: How often a word may occur that the spelling model learns from.
RARE = 2
#: Slots of the spelling model's tables, as powers of two: contexts of up to three bytes are few; a fourth is hashed.
SPELL_BITS = (16, 18, 20, 20)
_R = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


# Texts to tokens


def pieces(batch, at: int):
    """An Arrow batch in slices of some :data:`PIECE_BYTES` of the text in column ``at``."""
    import pyarrow.compute as pc

    upto = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0)).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = upto[start - 1] if start else 0
        stop = min(max(start + 1, int(np.searchsorted(upto, before + PIECE_BYTES, "right"))), start + PIECE_ROWS)
        yield batch.slice(start, stop - start)
        start = stop


def cut(texts) -> tuple:
    """An Arrow column of texts -> its distinct words (binary, the first is the empty one: the end), the word's place
    there for each token, and the number of tokens of each text."""
    import pyarrow as pa
    import pyarrow.compute as pc

    # Lower-casing comes before the cast: of a slice that was cast it gives wrong bytes.
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_string()))
    offsets, flat = np.asarray(lists.offsets), lists.flatten()
    filled = np.asarray(pc.greater(pc.binary_length(flat), 0))  # blanks at either side of a text leave empty strings
    coded = flat.filter(pa.array(filled)).dictionary_encode()
    words = pa.concat_arrays([pa.array([b""], pa.large_binary()), coded.dictionary.cast(pa.large_binary())])
    before = np.concatenate([[0], np.cumsum(filled)])
    sizes = np.diff(before[offsets]) + 1
    word = np.zeros(int(sizes.sum()), np.int64)
    inside = np.ones(len(word), bool)
    inside[np.cumsum(sizes) - 1] = False
    word[inside] = np.asarray(coded.indices) + 1
    return words, word, sizes


def _last_bytes(words) -> tuple[np.ndarray, np.ndarray]:
    """The last byte of each word, and the one before it; 0 where there is none."""
    ends, data = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1], words.buffers()[2]
    raw = np.frombuffer(data, np.uint8).astype(np.int64) if data is not None and data.size else np.zeros(1, np.int64)
    size = np.diff(ends)
    one = np.where(size > 0, raw[np.maximum(ends[1:] - 1, 0)], 0)
    return one, np.where(size > 1, raw[np.maximum(ends[1:] - 2, 0)], 0)


def codes(words, word: np.ndarray, sizes: np.ndarray, known) -> tuple[np.ndarray, np.ndarray]:
    """The key (previous word, state, leaf) of each token, and the rank of each distinct word among ``known``, or -1."""
    import pyarrow.compute as pc

    rank = np.asarray(pc.fill_null(pc.index_in(words, value_set=known), -1)).astype(np.int64)
    rank[0] = -1
    top, (one, two) = (rank >= 0) & (rank < TOP), _last_bytes(words)
    leaf = np.where(top, 1 + rank, 1 + TOP + (one & 127))
    before = np.where(top, 1 + rank, 1 + TOP + (one * 31 + two) % ENDINGS)
    common = np.where((rank >= 0) & (rank < STATES - 1), rank + 1, 0)
    leaf[0] = before[0] = 0
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(len(word))
    previous = np.zeros(len(word), np.int64)
    previous[1:] = before[word[:-1]]
    previous[place == first] = 0
    seen = common[word]
    latest = np.maximum.accumulate(np.where(seen > 0, place, -1)) if len(word) else place
    state = np.zeros(len(word), np.int64)
    state[2:] = np.where(latest[:-2] >= first[2:], seen[np.maximum(latest[:-2], 0)], 0)
    return (previous << 17 | state << 13 | leaf[word]).astype(np.int32), rank


def count_class(c: np.ndarray) -> np.ndarray:
    """0 to 15 are classes of their own, then half powers of two."""
    c = np.asarray(c, np.float64)
    return np.where(c < 16, c, 16 + np.floor(2 * (np.log2(np.maximum(c, 1)) - 4) + 1e-9)).astype(np.int64)


def _count_class(c: Column) -> Column:
    return F.when(c < 16, c).otherwise(16 + F.floor(2 * (F.log2(c.cast("double")) - 4) + 1e-9)).cast("int")


def _byte_from_end(k: int) -> Column:
    """The k-th byte of ``word`` from its end; 0 where there is none."""
    byte = F.conv(F.hex(F.expr(f"substring(word, -{k}, 1)")), 16, 10).cast("int")
    return F.when(F.length("word") >= k, byte).otherwise(0)


# Counts, added up in Spark


def word_counts(train: DataFrame) -> DataFrame:
    """word, c: how often each token is in the training texts."""

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in pieces(batch, 0):
                words, word, _ = cut(piece.column(0))
                yield pa.RecordBatch.from_arrays([words.cast(pa.binary()), pa.array(np.bincount(word, minlength=len(words)))], ["word", "c"])

    return train.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _summed(keys: list, ns: list) -> tuple[np.ndarray, np.ndarray]:
    keys, ns = np.concatenate(keys), np.concatenate(ns)
    order = np.argsort(keys, kind="stable")
    keys, ns = keys[order], ns[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(ns, first) if len(first) else ns


def _arrays(column) -> list[np.ndarray]:
    """The arrays of an Arrow list column; empty ones for nulls."""
    import pyarrow.compute as pc

    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    ends = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(column), 0)))])
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def merged(parts: DataFrame, salts: int) -> DataFrame:
    """Rows (shard, salt, key array<int>, n array<long>) added up to one row per shard.

    ``salt`` is under ``salts``; rounds join :data:`FAN_IN` salts, so no group holds more than that many sums, or the
    parts of one salt.
    """

    def add(name, table):
        import pyarrow as pa

        keys, ns = _summed(_arrays(table["key"]), _arrays(table["n"]))
        return pa.table({"shard": pa.array([name[0].as_py()], pa.int32()), "salt": pa.array([name[1].as_py()], pa.int32()), "key": pa.array([keys], pa.list_(pa.int32())), "n": pa.array([ns], pa.list_(pa.int64()))})

    while True:
        parts = parts.groupBy("shard", "salt").applyInArrow(add, "shard int, salt int, key array<int>, n array<long>")
        if salts <= 1:
            return parts.select("shard", "key", "n")
        parts, salts = parts.withColumn("salt", F.floor(F.col("salt") / FAN_IN).cast("int")), math.ceil(salts / FAN_IN)


def _by_shard(keys: np.ndarray, shard_of: np.ndarray):
    """(shard, place among ``keys``) for each shard met, keys sorted."""
    shard = shard_of[keys >> 17]
    order = np.lexsort((keys, shard))
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield int(shard[part[0]]), part


def pair_counts(train: DataFrame, known, shard_of, salts_of) -> DataFrame:
    """shard, key, n: the counts of (previous word, state, leaf), one row per shard."""

    def count(batches):
        import pyarrow as pa

        task, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in pieces(batch, 0):
                keys, n = np.unique(codes(*cut(piece.column(0)), known.value)[0], return_counts=True)
                rows = list(_by_shard(keys, shard_of.value))
                k += 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([s for s, _ in rows], pa.int32()), pa.array([(task * 31 + k) % salts_of.value[s] for s, _ in rows], pa.int32()),
                    pa.array([keys[p] for _, p in rows], pa.list_(pa.int32())), pa.array([n[p] for _, p in rows], pa.list_(pa.int64())),
                ], ["shard", "salt", "key", "n"])

    return merged(train.select("text").mapInArrow(count, "shard int, salt int, key array<int>, n array<long>"), int(salts_of.value.max()))


# Prefix codes, mixing


def prefix_code(counts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Huffman code: where each sign's path starts, and the paths' nodes and bits."""
    n = len(counts)
    heap = [(int(c) + 1, k, k) for k, c in enumerate(counts)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    for node in range(n, 2 * n - 1):
        (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        parent[x], parent[y] = (node, 0), (node, 1)
        heapq.heappush(heap, (a + b, node, node))
    starts, nodes, bits = [0], [], []
    for sign in range(n):
        path, at = [], sign
        while at in parent:
            path.append((parent[at][0] - n, parent[at][1]))
            at = parent[at][0]
        nodes += [x for x, _ in path[::-1]]
        bits += [b for _, b in path[::-1]]
        starts.append(len(nodes))
    return np.array(starts), np.array(nodes, np.int64), np.array(bits, np.int64)


def paths(signs: np.ndarray, code) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Node, bit and place in ``signs`` of every decision."""
    starts, nodes, bits = code
    reps = (starts[1:] - starts[:-1])[signs]
    at = np.repeat(np.arange(len(signs)), reps)
    path = np.arange(len(at)) + np.repeat(starts[signs] - np.cumsum(reps) + reps, reps)
    return nodes[path], bits[path], at


def _slot(context: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    h = (context.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + node.astype(np.uint64)) * _R
    return ((h ^ h >> np.uint64(32)) * _R >> np.uint64(64 - bits)).astype(np.int64)


def _evidence(n: np.ndarray) -> np.ndarray:
    """None, a few, some, many."""
    return (n > 0).astype(np.int64) + (n > 3) + (n > 20)


def _inputs(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Log odds per context, shortest first, with a constant; and the gate.  counts: zeros and ones seen, float32."""
    x, p, gate = np.empty((CONTEXTS + 1, len(counts[0][0])), np.float32), np.float32(0.5), 0
    for k, (n0, n1) in enumerate(counts):
        n = n0 + n1
        p = (n1 + np.float32(LEAN[k]) * p) / (n + np.float32(LEAN[k]))
        p = np.clip(p, np.float32(1e-6), np.float32(1 - 1e-6))
        x[k] = np.log(p / (1 - p))
        if k:
            gate = gate * 4 + _evidence(n)
    x[CONTEXTS] = 1
    return x, gate


def first_weights() -> np.ndarray:
    w = np.zeros((GATES, CONTEXTS + 1))
    w[:, CONTEXTS - 1], w[:, CONTEXTS - 2], w[:, 1] = 0.6, 0.3, 0.1
    return w


def _cell(st: np.ndarray, gate: np.ndarray) -> np.ndarray:
    return (gate & 3) * CELLS + np.clip((st + 12) * (CELLS / 24), 0, CELLS - 1).astype(np.int64)


class Learner:
    """Online mixing, block by block."""

    def __init__(self):
        self.w, self.mass, self.cells, self.blocks = first_weights(), np.zeros(GATES), np.zeros((2, 4 * CELLS)), 0

    def block(self, counts, bit: np.ndarray, weight: np.ndarray) -> None:
        """One step on decisions that were seen ``weight`` times each; counts include them and are told without one."""
        one = bit.astype(np.float32)
        x, gate = _inputs([(np.maximum(n0 - (1 - one), 0), np.maximum(n1 - one, 0)) for n0, n1 in counts])
        st = np.clip(np.einsum("kn,nk->n", x, self.w[gate]), -12, 12)
        p = 1 / (1 + np.exp(-st))
        self.cells[1] += np.bincount(_cell(st, gate), weight * one, 4 * CELLS)
        self.cells[0] += np.bincount(_cell(st, gate), weight * (1 - one), 4 * CELLS)
        rate = 0.3 / math.sqrt(1 + self.blocks / 16)
        err = weight * (one - p)
        self.mass += np.bincount(gate, weight, GATES)
        curve = np.bincount(gate, weight * p * (1 - p), GATES)
        for k in range(CONTEXTS + 1):
            # The second derivative, with the mean square of the input for that of each gate.
            square = float(x[k] @ x[k]) / max(1, len(bit))
            self.w[:, k] += rate * np.bincount(gate, err * x[k], GATES) / (curve * square + 50)
        self.blocks += 1

    def sums(self) -> np.ndarray:
        return np.concatenate([(self.w * self.mass[:, None]).ravel(), self.mass, self.cells.ravel()])


class Mixer:
    """Weights and refinement learnt by some learners, from the sum of their :meth:`Learner.sums`."""

    def __init__(self, sums: np.ndarray | None):
        if sums is None:
            sums = np.zeros(len(Learner().sums()))
        w, mass, cells = np.split(sums, [GATES * (CONTEXTS + 1), GATES * (CONTEXTS + 2)])
        self.w = np.where(mass[:, None] > 0, w.reshape(GATES, -1) / np.maximum(mass, 1)[:, None], first_weights()).astype(np.float32)
        cells = cells.reshape(2, -1)
        middle = (np.arange(CELLS) + 0.5) * (24 / CELLS) - 12
        self.refined = np.where(cells.sum(axis=0) > 20, np.log((cells[1] + 1) / (cells[0] + 1)), np.tile(middle, 4)).astype(np.float32)

    def bits(self, counts, bit: np.ndarray) -> np.ndarray:
        """The code length of each decision."""
        x, gate = _inputs(counts)
        st = np.clip(np.einsum("kn,nk->n", x, self.w[gate]), -12, 12)
        st = (st + self.refined[_cell(st, gate)]) * np.float32(0.5)
        return np.log1p(np.exp(np.where(bit, -st, st))) / np.float32(math.log(2))


def _learnt(groups: DataFrame) -> Mixer:
    """Mixer from rows (at, x) of learners; as many rows as the sums are long, whatever the number of learners."""
    rows = groups.groupBy("at").agg(F.sum("x").alias("x")).collect()
    sums = np.zeros(len(Learner().sums()))
    for r in rows:
        sums[r["at"]] = r["x"]
    return Mixer(sums)


def _rows_of(learner: Learner):
    import pyarrow as pa

    sums = learner.sums()
    at = np.flatnonzero(sums)
    return pa.array(at, pa.int64()), pa.array(sums[at])


# Words


class Words:
    """The counts of decisions that all shards share: without a context, and by state.  leaves: (STATES, LEAVES)."""

    def __init__(self, leaves: np.ndarray):
        self.code = prefix_code(leaves.sum(axis=0))
        every = np.arange(LEAVES)
        node, bit, at = paths(every, self.code)
        self.tables = np.stack([np.bincount(2 * node + bit, n[at], 2 * LEAVES) for n in [leaves.sum(axis=0), *leaves]]).astype(np.float32)


class Shard:
    """The counts of a shard's decisions by previous word, and by previous word and state."""

    def __init__(self, words: Words, keys: np.ndarray, n: np.ndarray):
        self.words = words
        starts = words.code[0]
        total = int((starts[1:] - starts[:-1])[keys & 8191].sum())
        self.size = max(10, int(max(1, total)).bit_length())
        self.tables = np.zeros((2, 2 << self.size), np.float32)
        for at in range(0, len(keys), 1 << 16):
            slots, bit, place = self._slots(keys[at : at + (1 << 16)])[1:]
            for t, s in zip(self.tables, slots):
                np.add.at(t, 2 * s + bit, n[at : at + (1 << 16)][place].astype(np.float32))

    def _slots(self, keys):
        node, bit, at = paths(keys & 8191, self.words.code)
        context = (keys >> 13)[at]
        return node, [_slot(context >> 4, node, self.size), _slot(context + (1 << 20), node, self.size)], bit, at

    def decisions(self, keys: np.ndarray):
        """Counts per context, bit, and place in ``keys``."""
        node, slots, bit, at = self._slots(keys)
        state = (keys >> 13 & 15)[at] + 1
        shared = [(t[2 * node], t[2 * node + 1]) for t in (self.words.tables[0],)]
        flat = self.words.tables.ravel()
        place = state * (2 * LEAVES) + 2 * node
        shared.append((flat[place], flat[place + 1]))
        return [*shared, *[(t[2 * s], t[2 * s + 1]) for t, s in zip(self.tables, slots)]], bit, at

    def learn(self, keys: np.ndarray, n: np.ndarray) -> Learner:
        learner = Learner()
        order = np.argsort(keys.astype(np.uint64) * _R, kind="stable")
        for at in range(0, len(keys), BLOCK):
            part = order[at : at + BLOCK]
            counts, bit, place = self.decisions(keys[part])
            learner.block(counts, bit, n[part][place].astype(np.float32))
        return learner

    def bits(self, keys: np.ndarray, mixer: Mixer) -> np.ndarray:
        out = np.empty(len(keys))
        for at in range(0, len(keys), 4096):
            part = keys[at : at + 4096]
            counts, bit, place = self.decisions(part)
            out[at : at + len(part)] = np.bincount(place, mixer.bits(counts, bit), len(part))
        return out


# Spelling


class Spelling:
    """Codes words that the training text doesn't have, byte by byte, with what its rarest words are like."""

    def __init__(self, counts: np.ndarray, code, mixer: Mixer | None = None):
        self.counts, self.code, self.mixer = counts, code, mixer

    def decisions(self, words: list[bytes]):
        """Slots per context, bit, and place in ``words`` of every decision.

        Words are spelled backwards, as the class of their last byte is known from their leaf: it stands where no
        byte stands before.
        """
        sizes = np.array([len(w) + 1 for w in words], np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        signs = np.full(int(sizes.sum()), END, np.int64)
        inside = np.ones(len(signs), bool)
        inside[first + sizes - 1] = False
        signs[inside] = np.frombuffer(b"".join([w[::-1] for w in words]), np.uint8)
        word = np.repeat(np.arange(len(words)), sizes)
        place, none = np.arange(len(signs)) - first[word], SIGNS + np.array([w[-1] & 127 for w in words], np.int64)[word]
        node, bit, at = paths(signs, self.code)
        context, slots = np.zeros(len(signs), np.int64), []
        for k, bits in enumerate(SPELL_BITS, 1):
            b = none.copy()
            b[k:] = np.where(place[k:] >= k, signs[:-k], none[k:])
            context = context * 521 + b + 1
            slots.append(_slot(context[at], node, bits) + sum(1 << x for x in SPELL_BITS[: k - 1]))
        return slots, bit, word[at]

    def seen(self, slots):
        return [(self.counts[2 * s], self.counts[2 * s + 1]) for s in slots]

    def learn(self, words: list[bytes]) -> Learner:
        learner = Learner()
        for at in range(0, len(words), 128):
            slots, bit, _ = self.decisions(words[at : at + 128])
            learner.block(self.seen(slots), bit, np.ones(len(bit), np.float32))
        return learner

    def bits(self, words: list[bytes]) -> np.ndarray:
        out = np.empty(len(words))
        for at in range(0, len(words), 1024):
            part = words[at : at + 1024]
            slots, bit, place = self.decisions(part)
            out[at : at + len(part)] = np.bincount(place, self.mixer.bits(self.seen(slots), bit), len(part))
        return out


def spelling(counts: DataFrame) -> Spelling:
    """Learnt from the words that occur :data:`RARE` times at most: they stand for those that don't occur."""
    rare = counts.where((F.col("c") <= RARE) & (F.length("word") > 0)).select("word")
    spark = counts.sparkSession

    def histogram(batches):
        import pyarrow as pa

        total = np.zeros(SIGNS, np.int64)
        for batch in batches:
            total[:END] += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8), minlength=END)
            total[END] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(range(SIGNS), pa.int64()), pa.array(total)], ["sign", "n"])

    signs = np.zeros(SIGNS)
    for r in rare.mapInArrow(histogram, "sign long, n long").groupBy("sign").agg(F.sum("n").alias("n")).collect():  # 257 rows
        signs[r["sign"]] = r["n"]
    code = prefix_code(signs)

    def count(batches):
        import pyarrow as pa

        empty, keys, ns = Spelling(None, code), [], []
        for batch in batches:
            slots, bit, _ = empty.decisions(batch.column(0).to_pylist())
            k, n = np.unique(np.concatenate([2 * s + bit for s in slots]), return_counts=True)
            keys.append(k)
            ns.append(n)
        if keys:
            k, n = _summed(keys, ns)
            cuts = np.searchsorted(k, np.arange(0, 2 * sum(1 << x for x in SPELL_BITS) + 1, 1 << 18))
            rows = [(s, a, b) for s, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(k)])) if b > a]
            yield pa.RecordBatch.from_arrays([
                pa.array([s for s, _, _ in rows], pa.int32()), pa.array([TaskContext.get().partitionId()] * len(rows), pa.int32()),
                pa.array([k[a:b] for _, a, b in rows], pa.list_(pa.int32())), pa.array([n[a:b] for _, a, b in rows], pa.list_(pa.int64())),
            ], ["shard", "salt", "key", "n"])

    n_tasks = rare.rdd.getNumPartitions()
    table = np.zeros(2 * sum(1 << x for x in SPELL_BITS), np.float32)
    for r in merged(rare.mapInArrow(count, "shard int, salt int, key array<int>, n array<long>"), n_tasks).toLocalIterator():  # a few rows of at most 2^18 numbers
        table[np.array(r["key"], np.int64)] = r["n"]
    sent = spark.sparkContext.broadcast((table, code))
    n_shards = max(1, math.ceil(signs[END] / WORDS_A_SHARD))

    def learn(_, group):
        import pyarrow as pa
        import xxhash

        words = sorted(group["word"].to_pylist(), key=lambda w: (xxhash.xxh3_64_intdigest(w), w))
        at, x = _rows_of(Spelling(*sent.value).learn(words))
        return pa.table({"at": at, "x": x})

    # As many tasks as shards: words are small, and learning from them takes its time.
    dealt = rare.withColumn("shard", F.pmod(F.xxhash64("word"), F.lit(n_shards))).repartition(n_shards, "shard")
    mixer = _learnt(dealt.groupBy("shard").applyInArrow(learn, "at long, x double"))
    return Spelling(table, code, mixer)


# The model of all tokens


def _shards(load: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shard of each previous word, and in how many parts a shard's tokens are scored; load: tokens after each."""
    shard_of, at, filled, loads = np.zeros(BEFORE, np.int32), 0, 0, [0]
    for k, n in enumerate(load.tolist()):
        if filled and filled + n > SHARD:
            at, filled = at + 1, 0
            loads.append(0)
        shard_of[k] = at
        filled += n
        loads[at] += n
    return shard_of, np.maximum(1, np.ceil(np.array(loads) / SPLIT)).astype(np.int32)


def _rest_bits(classes: list, top: list[tuple[bytes, int]]) -> np.ndarray:
    """Bits (class of count, class of last byte) of which word it is, after its leaf; without the spelling for class 0.

    classes: rows (last, k, less, types, tokens): words by last byte and the classes of their count and of one less.
    """
    n_classes = 1 + max([0, *(int(r["k"]) for r in classes)])
    types, tokens = np.zeros((n_classes, LAST)), np.zeros((n_classes, LAST))
    for r in classes:
        types[r["k"], r["last"]] += r["types"]
        tokens[r["less"], r["last"]] += r["tokens"]
    for word, c in top:
        types[count_class(c), word[-1] & 127] -= 1
        tokens[count_class(c - 1), word[-1] & 127] -= c
    there = types > 0
    there[0] = True
    share = np.where(there, np.maximum(tokens, 0) + 0.5, 0)
    return -np.log2(np.where(there, share / share.sum(axis=0), 1)) + np.log2(np.maximum(types, 1))


def score(docs: DataFrame, held: Column | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte: a row per row of ``docs``.

    Learns from the rows where ``held`` is false.  ``base_score`` is the sum over tokens of
    log10((c + 0.1) / (N + 0.1 * (V + 1))), ``score`` the model's log10 probability of all tokens.
    """
    import pyarrow as pa

    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    held = held_out(F.col("doc_id")) if held is None else held
    train = docs.where(~held)
    counts = stored(word_counts(train), "counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.sum(F.when(F.length("word") == 0, F.col("c"))), F.lit(0)).alias("ends")).first()
    n, v = total["n"], total["v"]
    below = math.log10(n + 0.1 * (v + 1)) if n else math.log10(0.1)

    # The commonest words, by a least count that a histogram tells.
    real = counts.where(F.length("word") > 0)
    level = F.floor(100 * F.log(F.col("c").cast("double"))).cast("int")
    levels, least, words_in = real.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect(), None, 0  # some hundred rows
    for r in levels:
        words_in += r["count"]
        if words_in > KNOWN or r["level"] < math.floor(100 * math.log(LEAST)):
            break
        least = r["level"]
    heads = sorted(((bytes(r["word"]), r["c"]) for r in real.where(level >= least).collect()), key=lambda x: (-x[1], x[0])) if least is not None else []  # KNOWN at most
    known = sc.broadcast(pa.array([w for w, _ in heads], pa.large_binary()))
    # Words by last byte and class of count, and the tokens after each ending: fixed numbers of rows.
    classes = real.groupBy(_byte_from_end(1).bitwiseAND(F.lit(127)).alias("last"), _count_class(F.col("c")).alias("k"), _count_class(F.col("c") - 1).alias("less")).agg(F.count("*").alias("types"), F.sum("c").alias("tokens")).collect()
    endings = real.groupBy(((_byte_from_end(1) * 31 + _byte_from_end(2)) % ENDINGS).alias("ending")).agg(F.sum("c").alias("tokens")).collect()
    load = np.zeros(BEFORE, np.int64)
    load[0] = total["ends"]
    for r in endings:
        load[1 + TOP + r["ending"]] += r["tokens"]
    for k, (word, c) in enumerate(heads[:TOP]):
        load[1 + k] = c
        load[1 + TOP + (word[-1] * 31 + (word[-2] if len(word) > 1 else 0)) % ENDINGS] -= c
    shard_of, salts_of = _shards(load)
    shard_of, salts_of = sc.broadcast(shard_of), sc.broadcast(salts_of)
    rest = _rest_bits(classes, heads[:TOP])
    spelled = sc.broadcast(spelling(counts))

    pairs = stored(pair_counts(train, known, shard_of, salts_of), "pairs")
    words, mixer = _word_model(pairs)
    words, mixer = sc.broadcast(words), sc.broadcast(mixer)
    by_text = _leaf_bits(docs, pairs, known, shard_of, salts_of, words, mixer)

    head_c = np.array([c for _, c in heads], np.int64)
    figures = sc.broadcast((head_c, rest))

    def cut_texts(batches):
        import pyarrow.compute as pc

        (head_c, rest), task, row = figures.value, TaskContext.get().partitionId(), 0
        ends = math.log10(total["ends"] + 0.1) - below
        base_of = np.concatenate([np.log10(head_c + 0.1) - below, [ends]])  # the end is last: rank -1
        for batch in batches:
            for piece in pieces(batch, 3):
                found, word, sizes = cut(piece.column(3))
                m, rank = len(sizes), np.asarray(pc.fill_null(pc.index_in(found, value_set=known.value), -1)).astype(np.int64)
                doc = np.repeat(np.arange(m), sizes)
                sure = rank >= 0
                sure[0] = True
                one = _last_bytes(found)[0] & 127
                k = np.minimum(count_class(np.where(sure & (rank >= 0), head_c[np.minimum(rank, len(head_c) - 1)] if len(head_c) else 0, 0)), len(rest) - 1)
                more = np.where((rank >= TOP) & sure, rest[k, one], 0.0)
                mine, at = doc[sure[word]], word[sure[word]]
                base = np.bincount(mine, base_of[rank[at]], m).astype(float)
                bits = np.bincount(mine, more[at], m).astype(float)
                have = np.bincount(mine, (rank[at] >= 0) | (total["ends"] > 0), m).astype(np.int64)
                # Other words, once per document, to be joined with their counts.
                tail, times = np.unique(doc[~sure[word]] * (len(found) + 1) + word[~sure[word]], return_counts=True)
                owner, of = tail // (len(found) + 1), tail % (len(found) + 1)
                keys, t = (task << 40) + row + np.arange(m), len(tail)
                row += m
                zeros = np.zeros(t, np.int64)
                n_bytes = np.asarray(pc.fill_null(pc.binary_length(piece.column(3)), 0)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([keys, keys[owner]])), *[pa.concat_arrays([piece.column(c), pa.nulls(t, piece.column(c).type)]) for c in range(3)],
                    pa.array(np.concatenate([sizes, zeros])), pa.array(np.concatenate([have, zeros])), pa.array(np.concatenate([base, zeros])), pa.array(np.concatenate([bits, zeros])), pa.array(np.concatenate([n_bytes, zeros])),
                    # 0xFF never stands in UTF-8, so these match no word, and they spread over all partitions.
                    pa.concat_arrays([pa.array([b"\xff" + int(x).to_bytes(8, "big") for x in keys], pa.binary()), found.take(pa.array(of)).cast(pa.binary())]),
                    pa.array(np.concatenate([np.zeros(m, np.int64), times])),
                ], names)

    def score_tail(batches):
        """Rows come sorted by word, so a word is met in one batch, or two."""
        spell, rest = spelled.value, figures.value[1]
        for batch in batches:
            column = dict(zip([*names, "c"], batch.columns))
            times, coded = np.asarray(column["times"]), column["word"].dictionary_encode()
            told, at = times > 0, np.asarray(coded.indices)
            c = np.asarray(column["c"].fill_null(0))
            fresh = np.unique(at[told & (c == 0)])
            distinct = coded.dictionary.to_pylist()
            each = np.zeros(len(distinct))
            each[fresh] = spell.bits([distinct[x] for x in fresh.tolist()])
            last = np.array([w[-1] & 127 for w in distinct], np.int64)[at] if distinct else at
            bits, base, have = np.asarray(column["bits"]).copy(), np.asarray(column["base"]).copy(), np.asarray(column["n_known"]).copy()
            bits[told] += (each[at] + rest[np.minimum(count_class(c), len(rest) - 1), last])[told] * times[told]
            base[told] += (np.log10(c[told] + 0.1) - below) * times[told]
            have[told] += np.where(c[told] > 0, times[told], 0)
            yield pa.RecordBatch.from_arrays([column["key"], column["doc_id"], column["held_out"], column["text_hash"], column["n_tokens"], pa.array(have), pa.array(base), pa.array(bits), column["n_bytes"]], names[:9])

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    told = f"key long, doc_id {doc_id}, held_out boolean, text_hash long, n_tokens long, n_known long, base double, bits double, n_bytes long"
    schema = T.StructType.fromDDL(f"{told}, word binary, times long")
    names = schema.fieldNames()
    found = docs.select("doc_id", held.alias("held_out"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(cut_texts, schema).join(counts, "word", "left").select(*names, "c")
    sums = found.mapInArrow(score_tail, told).groupBy("key").agg(*[F.max(k).alias(k) for k in ("doc_id", "held_out", "text_hash")], *[F.sum(k).alias(k) for k in ("n_tokens", "n_known", "base", "bits", "n_bytes")])
    joined = sums.join(by_text, "text_hash")
    bits = F.col("bits") + F.col("leaf_bits")
    return joined.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), (-bits * math.log10(2)).alias("score"), (bits / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))


def _word_model(pairs: DataFrame) -> tuple[Words, Mixer]:
    """What all shards share: counts by state, and the mixer that their rows teach."""

    def by_state(batches):
        import pyarrow as pa

        for batch in batches:
            for shard, keys, ns in zip(batch.column(0).to_pylist(), _arrays(batch.column(1)), _arrays(batch.column(2))):
                k, n = _summed([keys & (1 << 17) - 1], [ns])
                yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([shard // FAN_IN], pa.int32()), pa.array([k], pa.list_(pa.int32())), pa.array([n], pa.list_(pa.int64()))], ["shard", "salt", "key", "n"])

    leaves = np.zeros(STATES << 13)
    for r in merged(pairs.select("shard", "key", "n").mapInArrow(by_state, "shard int, salt int, key array<int>, n array<long>"), math.ceil(BEFORE / FAN_IN)).collect():  # one row of STATES x LEAVES numbers
        leaves[np.array(r["key"], np.int64)] = r["n"]
    words = Words(leaves.reshape(STATES, -1)[:, :LEAVES])
    sent = pairs.sparkSession.sparkContext.broadcast(words)

    def learn(batches):
        import pyarrow as pa

        for batch in batches:
            for keys, n in zip(_arrays(batch.column(0)), _arrays(batch.column(1))):
                at, x = _rows_of(Shard(sent.value, keys, n).learn(keys, n))
                yield pa.RecordBatch.from_arrays([at, x], ["at", "x"])

    return words, _learnt(pairs.select("key", "n").mapInArrow(learn, "at long, x double"))


def _leaf_bits(docs: DataFrame, pairs: DataFrame, known, shard_of, salts_of, words, mixer) -> DataFrame:
    """text_hash, leaf_bits: the code length of each text's leaves."""
    import pyarrow as pa

    kinds = {"shard": pa.int32(), "salt": pa.int32(), "piece": pa.int64(), "key": pa.list_(pa.int32()), "doc": pa.list_(pa.int16()), "n": pa.list_(pa.int64())}

    def send(batches):
        """Of each piece a row per shard, and one with the texts' hashes."""
        task, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in pieces(batch, 1):
                found, word, sizes = cut(piece.column(1))
                keys, _ = codes(found, word, sizes, known.value)
                doc, name = np.repeat(np.arange(len(sizes)), sizes).astype(np.int16), (task << 32) + k
                rows = list(_by_shard(keys, shard_of.value))
                k += 1
                salts = [(task * 31 + k) % salts_of.value[s] for s, _ in rows]
                columns = [
                    [*(s for s, _ in rows), -1], [*salts, (task * 31 + k) % 1024], [name] * (len(rows) + 1),
                    [*(keys[p] for _, p in rows), np.zeros(0, np.int32)], [*(doc[p] for _, p in rows), np.zeros(0, np.int16)], [*[None] * len(rows), np.asarray(piece.column(0))],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], list(kinds))

    def tell(group, table):
        table = table.combine_chunks()
        if group[0].as_py() < 0:  # the hashes pass
            return pa.table({"piece": table["piece"], "doc": table["doc"], "bits": pa.array([[]] * len(table), pa.list_(pa.float32())), "hashes": table["n"]})
        names, keys, docs_of, ns = table["piece"].to_pylist(), _arrays(table["key"]), _arrays(table["doc"]), _arrays(table["n"])
        held = [k for k, x in enumerate(names) if x is None]
        shard = Shard(words.value, *_summed([np.zeros(0, np.int32), *(keys[k] for k in held)], [np.zeros(0, np.int64), *(ns[k] for k in held)]))
        mine = [k for k, x in enumerate(names) if x is not None]
        distinct, back = np.unique(np.concatenate([keys[k] for k in mine]), return_inverse=True) if mine else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        each, at, out = shard.bits(distinct, mixer.value), 0, []
        for k in mine:
            sums = np.bincount(docs_of[k], each[back[at : at + len(keys[k])]])
            at += len(keys[k])
            there = np.flatnonzero(sums)
            out.append((names[k], there.astype(np.int16), sums[there].astype(np.float32)))
        return pa.table({"piece": pa.array([x for x, _, _ in out], pa.int64()), "doc": pa.array([d for _, d, _ in out], pa.list_(pa.int16())), "bits": pa.array([b for _, _, b in out], pa.list_(pa.float32())), "hashes": pa.array([None] * len(out), pa.list_(pa.int64()))})

    def add(_, table):
        table = table.combine_chunks()
        hashes = next(h for h in table["hashes"].to_pylist() if h is not None)
        rows = zip(_arrays(table["doc"]), _arrays(table["bits"]), table["hashes"].to_pylist())
        total = np.zeros(len(hashes))
        for d, b, h in rows:
            if h is None:
                total[d] += b
        return pa.table({"text_hash": pa.array(hashes, pa.int64()), "leaf_bits": pa.array(total)})

    spark = docs.sparkSession
    parts = spark.sparkContext.broadcast(salts_of.value)
    copies = F.explode(F.sequence(F.lit(0), F.element_at(F.array(*[F.lit(int(x)) for x in parts.value]), F.col("shard") + 1) - 1))
    counted = pairs.select("shard", copies.alias("salt"), F.lit(None).cast("long").alias("piece"), "key", F.lit(None).cast("array<smallint>").alias("doc"), "n")
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text").mapInArrow(send, "shard int, salt int, piece long, key array<int>, doc array<smallint>, n array<long>")
    told = texts.union(counted).groupBy("shard", "salt").applyInArrow(tell, "piece long, doc array<smallint>, bits array<float>, hashes array<long>")
    return told.groupBy("piece").applyInArrow(add, "text_hash long, leaf_bits double").groupBy("text_hash").agg(F.max("leaf_bits").alias("leaf_bits"))
