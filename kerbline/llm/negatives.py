"""Hard-negative mining with rotated one-bit codes and deterministic intervals.

A component x stands as the integer ``floor(256 * x)``; a row's score for an anchor is the inner product of the two
integer vectors.  An anchor's positives are the rows of its label with the highest scores (ties: the smaller id), and
the negatives of an anchor and a positive are the best rows of other labels whose score lies between two shares of the
positive's, so that they are hard, but not as near as a mislabelled copy would be.

Every row is coded once.  Its vector is rotated (three rounds of random signs and a Hadamard transform, which keeps
inner products), and the code is one bit, the sign, per component; stored beside it is the alignment ``<s, x>`` of the
vector with its code's unit vector s.  What the code leaves over, ``x - <s, x> s``, is coded the same way again,
:data:`LEVELS` times, and the length of the last residual is stored.  An anchor's rotated vector is cut to
:data:`BITS` bit planes, so ``<s, q>`` is a sum of popcounts.  The estimate of a score is the sum of alignment times
``<s, q>``, and by the Cauchy-Schwarz inequality it errs by no more than ``|residual| |q| + |x - residual| |q's rounding|``.
A pair whose interval ends below what the anchor has already is dropped; what survives is scored in integers.  One
level alone leaves an interval of 0.6 |x| |q| either side, which drops nothing where scores are that low; six leave
some 0.06 to 0.1; levels end where few pairs of a stretch are left.  The intervals are certain, so the result is exact.

Rows against anchors are a stated query set against all rows: anchors come in blocks of bounded size, which are
broadcast, and rows are read by parts that grow sixteenfold, each once.  The best that a block's anchors have after one
part prunes the next, so each part gives some rows per anchor, however many tasks it has, and no hot label or vector
makes one task larger: tasks hold stretches of rows, not groups.  No row is sampled away: parts together are all rows.

Rows with a null label, a null vector, or a null or non-finite component take no part, nor do those whose scores could
leave the range of a long (a component beyond 4,096, or more than 16,384 components).  Components that the shorter of
two vectors lacks count as zero.  A null id is no anchor, keeps its label and comes after all others in ties.  Each of
several rows with one id is a row of its own, so an anchor's equal may be its positive, and an anchor that stands twice
gives its rows twice.  Anchors without positives or negatives, and empty tables, give no rows.  Columns but the three
named ones are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbline.llm.common import new_folder, stored

LEVELS, BITS, SEED = 6, 8, 20_240_229
POSITIVES, NEGATIVES = 5, 3
#: Shares of the positive's score, in hundredths, between which a negative's lies.
LOW, HIGH = 50, 95
#: Anchors broadcast at once: so many bytes of vectors and planes at most.
BLOCK_BYTES = 48_000_000
#: Rows of the first part, and how much larger each next one is.
FIRST, GROWTH = 65_536, 16
MOST, LONGEST = 1 << 20, 1 << 14
_ROWS, _ANCHORS, _WAITING = 2048, 256, 500_000


def participants(rows: DataFrame) -> DataFrame:
    """vec_id, label, embedding -> vec_id, label (long), q (array of long): the rows that take part, components floored."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.coalesce(F.forall("x", lambda v: v.isNotNull() & (F.abs(v) <= MOST / 256)), F.lit(False)) & (F.size("x") <= LONGEST)  # NaN is the largest number
    kept = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), x.alias("x")).where(F.col("label").isNotNull() & F.col("x").isNotNull() & fine)
    return kept.select("vec_id", "label", F.transform("x", lambda v: F.floor(v * 256).cast("long")).alias("q"))


def rotated(q: np.ndarray) -> np.ndarray:
    """Rows in a power of two of components, 64 at least, turned by signs and Hadamard transforms; lengths stay."""
    rng, x = np.random.default_rng(SEED), q.astype(np.float64)
    n, d = x.shape
    for _ in range(3):
        x = x * rng.choice([-1.0, 1.0], d)
        half = 1
        while half < d:
            x = x.reshape(n, -1, 2, half)
            x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
            half *= 2
        x = x.reshape(n, d) / np.sqrt(d)
    return x


def _packed(bits: np.ndarray) -> np.ndarray:
    """0/1 rows as 64-bit words."""
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


def encode(q: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, levels, words), alignments (rows, levels), and lengths (rows, 2) of the last residual and of what the codes tell."""
    x = rotated(q)
    rest, codes, align = x.copy(), [], []
    for _ in range(levels):
        bits = rest >= 0
        a = np.abs(rest).sum(axis=1) / np.sqrt(x.shape[1])
        rest = rest - (a / np.sqrt(x.shape[1]))[:, None] * np.where(bits, 1.0, -1.0)
        codes.append(_packed(bits))
        align.append(a)
    lengths = np.stack([np.linalg.norm(rest, axis=1), np.linalg.norm(x - rest, axis=1)], axis=1)
    return np.stack(codes, axis=1), np.stack(align, axis=1), lengths


def planes(q: np.ndarray, bits: int = BITS) -> dict[str, np.ndarray]:
    """The anchors' side: bit planes (rows, bits, words), step, sum of the rounded components, length, length of the rounding."""
    x = rotated(q)
    step = np.maximum(np.abs(x).max(axis=1, initial=0), 1e-9) * 2 / (2**bits - 1)
    k = np.clip(np.rint(x / step[:, None] + (2**bits - 1) / 2), 0, 2**bits - 1).astype(np.int64)
    error = x - step[:, None] * (k - (2**bits - 1) / 2)
    return {"planes": np.stack([_packed((k >> b & 1).astype(bool)) for b in range(bits)], axis=1), "step": step, "sum": k.sum(axis=1), "length": np.linalg.norm(x, axis=1), "error": np.linalg.norm(error, axis=1)}


def survivors(codes, align, lengths, q, anchors: dict, wanted, low, high, allowed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions (row, anchor) and integer scores of the pairs whose score may lie in ``low`` to ``high`` of the anchor.

    ``wanted``: positions of the anchors; ``allowed``: rows x wanted, the pairs that count at all.
    """
    d = q.shape[1]
    step, total = anchors["step"][wanted] / np.sqrt(d), anchors["sum"][wanted]
    estimate = np.zeros((len(q), len(wanted)))
    open_ = allowed
    for level in range(codes.shape[1]):
        plane, code = anchors["planes"][wanted], codes[:, level]
        met = np.zeros((len(q), len(wanted)), np.int32)
        for b in range(plane.shape[1]):
            for w in range(plane.shape[2]):
                met += np.bitwise_count(code[:, w, None] & plane[None, :, b, w]).astype(np.int32) << b
        ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
        middle = (2 ** plane.shape[1] - 1) / 2
        estimate += align[:, level, None] * step * (2 * met - total - (middle * (2 * ones - d))[:, None])
        # What the levels to come tell is part of what is left over; lengths of orthogonal parts add up as squares.
        left = np.sqrt(lengths[:, 0] ** 2 + (align[:, level + 1 :] ** 2).sum(axis=1))
        told = lengths[:, 1] if level + 1 == codes.shape[1] else align[:, : level + 1].sum(axis=1)
        radius = (left[:, None] * anchors["length"][wanted] + told[:, None] * anchors["error"][wanted]) * (1 + 1e-9) + 1e-6
        open_ = allowed & (estimate + radius >= low) & (estimate - radius <= high)
        if np.count_nonzero(open_) * 20 < open_.size:
            break
    i, j = np.nonzero(open_)
    scores = np.empty(len(i), np.int64)
    for at in range(0, len(i), 65_536):
        part = slice(at, at + 65_536)
        scores[part] = np.einsum("ij,ij->i", q[i[part]], anchors["q"][wanted[j[part]]])
    return i, j, scores


class _Best:
    """The best ``k`` rows of each slot by score, then id (nulls last); starts from what is known and tells what is new.

    Rows are columns slot, score, no_id, id and new; offers wait until :meth:`settle` sorts them in.
    """

    def __init__(self, known: np.ndarray, slots: int, k: int):
        self.k, self.slots, self.rows = k, slots, np.concatenate([known, np.zeros((len(known), 1), np.int64)], axis=1)
        self.waiting, self.n_waiting = [self.rows[:0]], 0
        self.settle()

    def settle(self) -> None:
        r = np.concatenate([self.rows, *self.waiting])
        r = r[np.lexsort((r[:, 3], r[:, 2], -r[:, 1], r[:, 0]))]
        self.rows = r[np.arange(len(r)) - np.searchsorted(r[:, 0], r[:, 0]) < self.k]
        self.waiting, self.n_waiting = [], 0
        counts = np.bincount(self.rows[:, 0], minlength=self.slots)
        full = counts == self.k
        last = self.rows[np.cumsum(counts)[full] - 1]
        self.least, self.no_id, self.id = np.full(self.slots, np.iinfo(np.int64).min), np.full(self.slots, 2), np.zeros(self.slots, np.int64)
        self.least[full], self.no_id[full], self.id[full] = last[:, 1], last[:, 2], last[:, 3]

    def add(self, slot, score, no_id, vec_id) -> None:
        tie = (no_id < self.no_id[slot]) | ((no_id == self.no_id[slot]) & (vec_id < self.id[slot]))
        fit = (score > self.least[slot]) | ((score == self.least[slot]) & tie)
        if fit.any():
            self.waiting.append(np.stack([slot[fit], score[fit], no_id[fit], vec_id[fit], np.ones(int(fit.sum()), np.int64)], axis=1))
            self.n_waiting += len(self.waiting[-1])
            if self.n_waiting > _WAITING:
                self.settle()


_FOUND = "slot long, score long, no_id long, vec_id long"


def _scan(rows: DataFrame, shared, scan) -> DataFrame:
    """Each task's new best rows, ``scan(block, state, batch)`` offering them stretch by stretch."""

    def run(batches):
        import pyarrow as pa

        anchors = shared.value
        best = _Best(anchors["known"], anchors["slots"], anchors["k"])
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                n, d = part.num_rows, anchors["q"].shape[1]
                get = lambda c, t: np.frombuffer(b"".join(part.column(c).to_pylist()), t).reshape(n, -1)
                ids = part.column("vec_id")
                cut = {
                    "row": part.column("row").to_numpy(), "label": part.column("label").to_numpy(), "no_id": np.asarray(ids.is_null()).astype(np.int64), "vec_id": ids.fill_null(0).to_numpy(),
                    "q": get("ints", np.int32).astype(np.int64), "codes": get("codes", np.uint64).reshape(n, -1, d // 64), "align": get("align", np.float64), "lengths": get("lengths", np.float64),
                }
                scan(anchors, best, cut)
                best.settle()
        new = best.rows[best.rows[:, 4] == 1]
        yield pa.RecordBatch.from_arrays([pa.array(new[:, k]) for k in range(4)], ["slot", "score", "no_id", "vec_id"])

    return rows.select("row", "vec_id", "label", "ints", "codes", "align", "lengths").mapInArrow(run, _FOUND)


def _positives(anchors: dict, best: _Best, rows: dict) -> None:
    """Offers the rows of each anchor's own label; only stretches of one label are compared."""
    order = np.argsort(anchors["label"], kind="stable")
    labels = anchors["label"][order]
    for label in np.unique(rows["label"]):
        lo, hi = np.searchsorted(labels, label), np.searchsorted(labels, label, "right")
        here = np.nonzero(rows["label"] == label)[0]
        for at in range(lo, hi, _ANCHORS):
            wanted = order[at : min(at + _ANCHORS, hi)]
            allowed = rows["row"][here, None] != anchors["row"][wanted]
            low = np.where(best.least[wanted] == np.iinfo(np.int64).min, -np.inf, best.least[wanted].astype(float))
            i, j, scores = survivors(rows["codes"][here], rows["align"][here], rows["lengths"][here], rows["q"][here], anchors, wanted, low, np.inf, allowed)
            best.add(wanted[j], scores, rows["no_id"][here[i]], rows["vec_id"][here[i]])


def _negatives(anchors: dict, best: _Best, rows: dict) -> None:
    """Offers rows of other labels to each positive whose range of scores they are in."""
    told, k = anchors["positives"], anchors["positives"].shape[1]  # scores, anchors x positives
    has = anchors["has"]
    below, above = -(-anchors["low"] * told // 100), anchors["high"] * told // 100
    for at in range(0, len(told), _ANCHORS):
        wanted = np.nonzero(has[at : at + _ANCHORS].any(axis=1))[0] + at
        if not len(wanted):
            continue
        floor = np.maximum(below, best.least.reshape(-1, k))[wanted]
        low = np.where(has[wanted], floor, np.iinfo(np.int64).max).min(axis=1).astype(float)
        high = np.where(has[wanted], above[wanted], np.iinfo(np.int64).min).max(axis=1).astype(float)
        allowed = rows["label"][:, None] != anchors["label"][wanted]
        i, j, scores = survivors(rows["codes"], rows["align"], rows["lengths"], rows["q"], anchors, wanted, low, high, allowed)
        for p in range(k):
            a = wanted[j]
            fit = has[a, p] & (anchors["low"] * told[a, p] <= 100 * scores) & (100 * scores <= anchors["high"] * told[a, p])
            best.add(a[fit] * k + p, scores[fit], rows["no_id"][i[fit]], rows["vec_id"][i[fit]])


def coded(rows: DataFrame, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame, int]:
    """Parts of all rows as vec_id, label, row (a number of its own), ints, codes, align, lengths (binary); all parts as one; the width."""
    spark = rows.sparkSession
    have = stored(participants(rows).withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, longest = have.agg(F.count("*"), F.coalesce(F.max(F.size("q")), F.lit(0))).first()
    width = max(64, 1 << max(0, longest - 1).bit_length())
    cuts = [FIRST]
    while cuts[-1] < n:
        cuts.append(cuts[-1] * GROWTH)
    # A row's part is drawn, so every part is like the whole; how it falls changes the work, not the result.
    draw, part = F.rand(SEED) * max(n, 1), F.lit(0)
    for k, cut in enumerate(cuts[:-1]):
        part = F.when(F.col("draw") >= cut, k + 1).otherwise(part)

    def code(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                cut = batch.slice(at, _ROWS)
                q, lists = np.zeros((cut.num_rows, width), np.int64), cut.column("q")
                sizes = lists.value_lengths().to_numpy()
                q[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
                codes, align, lengths = encode(q, levels)
                blob = lambda x: pa.array([r.tobytes() for r in x], pa.binary())
                yield pa.RecordBatch.from_arrays([cut.column(c) for c in ("vec_id", "label", "row", "part")] + [blob(q.astype(np.int32)), blob(codes), blob(align), blob(lengths)], columns)

    columns = ["vec_id", "label", "row", "part", "ints", "codes", "align", "lengths"]
    path = new_folder(spark, "codes")
    drawn = have.withColumn("draw", draw).select("vec_id", "label", "row", "q", part.cast("int").alias("part"))
    drawn.mapInArrow(code, "vec_id long, label long, row long, part int, ints binary, codes binary, align binary, lengths binary").write.partitionBy("part").parquet(path)
    everything = spark.read.schema("vec_id long, label long, row long, ints binary, codes binary, align binary, lengths binary, part int").parquet(path)
    return [everything.where(F.col("part") == k) for k in range(len(cuts))], everything, width


def _gathered(parts: list[DataFrame], anchors: dict, slots: int, k: int, scan) -> np.ndarray:
    """The best rows of each slot over all parts: slot, score, no_id, vec_id; a bounded number, ``slots * k``."""
    spark, known = parts[0].sparkSession, np.empty((0, 4), np.int64)
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "no_id", "vec_id")
    for part in parts:
        shared = spark.sparkContext.broadcast(anchors | {"known": known, "slots": slots, "k": k})
        found = _scan(part, shared, scan).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
        rows = found.select("slot", "score", "no_id", "vec_id").toArrow()
        both = np.concatenate([known, np.stack([c.to_numpy() for c in rows.columns], axis=1).astype(np.int64)])
        known = _Best(both, slots, k).rows[:, :4]
        shared.unpersist()
    return known


def mine(rows: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, levels: int = LEVELS, bits: int = BITS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: vec_id, label, embedding; ``is_anchor`` is a condition on vec_id.  A block of anchors, its positives and its
    negatives are all that the driver holds, within ``block_bytes`` and some ranks a row.
    """
    import pyarrow as pa

    spark = rows.sparkSession
    parts, everything, width = coded(rows, levels)
    asked = stored(everything.where(is_anchor & F.col("vec_id").isNotNull()).select("row", "vec_id", "label", "ints"), "anchors")
    block = max(1, block_bytes // (width * 8 + width // 8 * bits + 16 * positives * (1 + negatives)))
    out, schema = new_folder(spark, "negatives"), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(out)
    for low_row, high_row in _stretches(asked, asked.count(), block):
        got = asked.where((F.col("row") >= low_row) & (F.col("row") < high_row)).toArrow()
        q = np.frombuffer(b"".join(got["ints"].to_pylist()), np.int32).reshape(got.num_rows, width).astype(np.int64)
        anchors = {"row": got["row"].to_numpy(), "label": got["label"].to_numpy(), "q": q, "low": low, "high": high, **planes(q, bits)}
        n, ids = got.num_rows, got["vec_id"].to_numpy()
        top = _gathered(parts, anchors, n, positives, _positives)
        place = np.arange(len(top)) - np.searchsorted(top[:, 0], top[:, 0])
        told, has = np.zeros((n, positives), np.int64), np.zeros((n, positives), bool)
        told[top[:, 0], place], has[top[:, 0], place] = top[:, 1], True
        # A range is empty where the positive's score is below zero.
        last = _gathered(parts, anchors | {"positives": told, "has": has}, n * positives, negatives, _negatives)
        of = np.full(n * positives, -1)
        of[top[:, 0] * positives + place] = np.arange(len(top))
        mine_ = of[last[:, 0]]
        nullable = lambda ids, none: pa.array(ids, pa.int64(), mask=none == 1)
        rank = np.arange(len(last)) - np.searchsorted(last[:, 0], last[:, 0]) + 1
        made = pa.table({
            "anchor_id": ids[last[:, 0] // positives], "positive_id": nullable(top[mine_, 3], top[mine_, 2]), "rank": rank.astype(np.int32),
            "negative_id": nullable(last[:, 3], last[:, 2]), "positive_score": top[mine_, 1], "negative_score": last[:, 1],
        })
        spark.createDataFrame(made, schema).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


def _stretches(asked: DataFrame, n: int, block: int) -> list[tuple[int, int]]:
    """Ranges of row numbers, from and below, with some ``block`` anchors each at most: range partitions, of which only the least number is collected."""
    if n <= block:
        return [(-1, 1 << 62)] if n else []
    parts = asked.select("row").repartitionByRange(2 * -(-n // block), "row").groupBy(F.spark_partition_id().alias("p")).agg(F.min("row").alias("low"))
    edges = sorted(r["low"] for r in parts.collect()) + [1 << 62]  # a row per block
    return list(zip(edges, edges[1:]))
