"""Benchmark decontamination by SimHash of item-sized windows, with DataFrame functions only.

Texts are cut to words (lower case, runs of letters and digits) and words to five-word shingles.  A window has
as many words as a benchmark item.  A shingle of the document that an item of that size has too is a hit, and its
aligned start is where the window stands if the shingle lies as it does in the item.  Windows are looked at that
hold the threshold's share of an item's shingles as hits and start between the smallest and the largest aligned
start of their hits, ends included: with fewer hits no similarity reaches the threshold, and a window before or
after all aligned starts of its hits loses no hit by a step towards them, so no best similarity is lost.  Windows hang over a document's edge only as far as aligned starts do.  A window at the threshold holds at least that share of an item's shingles, so of any
``floor((1 - threshold) * n) + 1`` shingles of an item one must be there; for each item those with the longest
words are taken, and only documents with one of these shingles are looked at further.

Each window and each item gets a SimHash of 320 bits in which a shingle votes as often as it occurs, as 20 blocks of
16 bits.  Of two fingerprints within :data:`RADIUS` (71) bits at most 17 blocks differ by four bits or more, so at
least :data:`AGREE` (3) blocks differ by three or fewer.  The index holds the items' blocks with all values within two
bits, a window asks for its blocks with all values within one bit: blocks within three bits meet.  Items met in three
blocks are candidates: every one within the radius, and of random pairs some one in a thousand.  Only numbers of
windows and items go through that join; fingerprints and shingles are fetched for candidates.  Each candidate within
the radius is verified exactly: the weighted Jaccard similarity of the two bags of shingles (sum of the smaller over
sum of the larger counts) must reach the threshold.

At similarity 0.8 two fingerprints lie 48.5 bits apart on average with a deviation of 6.4, so 71 bits miss about
one borderline pair in five thousand, and practically none above 0.85.

Null and empty texts, and items or documents of fewer than five words, match nothing.  Repeated rows give one
result; a null ``doc_id`` or ``item_id`` is an id like any other.  Empty tables give no rows.  Other columns are
not looked at (:func:`clean` keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.llm.common import checkpoint, small, unwrapped, wrapped

SHINGLE = 5
THRESHOLD = 0.8
BLOCKS, WIDTH, RADIUS = 20, 16, 71
#: Bits by which a block may differ, on the items' side and on the windows'; and in how many blocks that must hold.
NEAR_ITEM, NEAR_WINDOW = 2, 1
#: Rows of the index that may be broadcast, some 75 bytes each.
INDEX_ROWS = 1_500_000
AGREE = BLOCKS - RADIUS // (NEAR_ITEM + NEAR_WINDOW + 1)
#: Up to so many shingles are constants of the plan; more are joined.
MARKS_IN_PLAN = 10_000


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; an empty array for none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where a lambda inside asks for it again and again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingles(w: Column) -> Column:
    """A 64-bit hash for each run of five words."""

    def hashed(w):
        starts = F.when(F.size(w) >= SHINGLE, F.sequence(F.lit(0), F.size(w) - SHINGLE)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))

    return let(w, hashed)


def _simhash(df: DataFrame, hashes: str, out: str) -> DataFrame:
    """Adds the fingerprint of an array column, as an array of blocks; plain SQL, as shifts are by a lambda's variable."""
    bit = "CASE WHEN 2 * aggregate(ws, 0, (n, w) -> n + (shiftrightunsigned(w, j) & 1)) > size(ws) THEN shiftleft(1, j) ELSE 0 END"
    block = f"aggregate(sequence(0, {WIDTH - 1}), 0, (v, j) -> v | {bit})"
    words = f"transform(hs, h -> CAST(xxhash64(h, b) & {(1 << WIDTH) - 1}L AS INT))"
    return df.withColumn(out, F.expr(f"get(transform(array({hashes}), hs -> transform(sequence(0, {BLOCKS - 1}), b -> get(transform(array({words}), ws -> {block}), 0))), 0)"))


def _around(value: str, bits: int) -> str:
    """SQL: all values of a block within so many bits."""
    near = [f"array({value})", f"transform(sequence(0, {WIDTH - 1}), k -> {value} ^ shiftleft(1, k))"]
    near.append(f"flatten(transform(sequence(0, {WIDTH - 2}), k -> transform(sequence(k + 1, {WIDTH - 1}), l -> {value} ^ shiftleft(1, k) ^ shiftleft(1, l))))")
    return f"concat({', '.join(near[: bits + 1])})"


def _probes(df: DataFrame, keys: list[str], fingerprint: str, bits: int) -> DataFrame:
    """keys, block, value: what a fingerprint is found by, or what it asks for."""
    blocks = df.select(*keys, F.posexplode(fingerprint).alias("block", "own"))
    return blocks.select(*keys, "block", F.explode(F.expr(_around("own", bits))).alias("value"))


def proposed(prints: DataFrame, items: DataFrame) -> DataFrame:
    """(win, n, print) and (item, n, item_print) -> win, item: pairs of one n that agree, but for three bits, in :data:`AGREE` blocks."""
    index, asked = _probes(items, ["item", "n"], "item_print", NEAR_ITEM), _probes(prints, ["win", "n"], "print", NEAR_WINDOW)
    # Spark doesn't see how many rows the index has, so it is counted: broadcast within a bound, else both sides are sorted.
    around = [1, 1 + WIDTH, 1 + WIDTH + WIDTH * (WIDTH - 1) // 2][NEAR_ITEM]
    index = F.broadcast(index) if items.count() * BLOCKS * around <= INDEX_ROWS else index.hint("merge")
    # Two blocks may meet in several values: blocks are counted as bits of a number.
    met = asked.join(index, ["n", "block", "value"]).groupBy("win", "item").agg(F.bit_count(F.bit_or(F.expr("shiftleft(1, block)"))).alias("blocks"))
    return met.where(F.col("blocks") >= AGREE).select("win", "item")


def _distance(a: str, b: str) -> Column:
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)")


def _bag_similarity(a: str, b: str) -> str:
    """SQL: weighted Jaccard of two sorted arrays of hashes, by their distinct values."""
    n = "size(filter({0}, x -> x = v))"
    common = f"aggregate(array_intersect({a}, {b}), 0, (s, v) -> s + least({n.format(a)}, {n.format(b)}))"
    return f"CAST({common} AS DOUBLE) / (size({a}) + size({b}) - {common})"


def _marks(benchmark: DataFrame, threshold: float) -> DataFrame:
    """word, hash: enough shingles of each item that no match can do without all of them, and the longest word of each."""
    longest = f"array_max(transform(slice(w, i + 1, {SHINGLE}), x -> named_struct('n', length(x), 'word', x)))"
    hashed = f"xxhash64({', '.join(f'get(w, i + {k})' for k in range(SHINGLE))})"
    runs = f"transform(sequence(0, size(w) - {SHINGLE}), i -> named_struct('longest', {longest}, 'hash', {hashed}))"
    items = benchmark.select(words(F.col("text")).alias("w")).where(F.size("w") >= SHINGLE).select(F.sort_array(F.expr(runs), asc=False).alias("runs"))
    enough = (F.floor(F.size("runs") * (1 - threshold) + 1e-9) + 1).cast("int")
    return items.select(F.explode(F.slice("runs", F.lit(1), enough)).alias("x")).select("x.longest.word", "x.hash").distinct()


def _marked(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """doc_id, text_hash, w of the documents that hold a marked shingle, each text of an id once.

    Where the marks are few they are constants of the plan and a document is looked at in its own row: only the
    shingles around a marked word are hashed.  Else all shingles are joined with the marks.
    """
    body = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    n = marks.count()
    if not n:
        found = body.limit(0)
    elif n <= MARKS_IN_PLAN:
        rows = marks.collect()  # counted above
        names, hashes = sorted({r["word"] for r in rows}), sorted({r["hash"] for r in rows})

        def holds(w, i):
            around = F.sequence(F.greatest(i - SHINGLE + 1, F.lit(0)), F.least(i, F.size(w) - SHINGLE))
            return F.exists(around, lambda k: F.xxhash64(*[F.get(w, k + x) for x in range(SHINGLE)]).isin(hashes))

        def marked(w):
            places = F.sequence(F.lit(0), F.size(w) - 1)
            return F.when(F.size(w) >= SHINGLE, F.when(F.exists(places, lambda i: F.get(w, i).isin(names) & holds(w, i)), w))

        found = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), let(words(F.col("text")), marked).alias("w")).where(F.col("w").isNotNull())
    else:
        keys = body.select("doc_id", "text_hash", F.explode(shingles(F.col("w"))).alias("hash")).join(small(marks.select("hash").distinct(), n), "hash", "left_semi").select("doc_id", "text_hash").distinct().alias("k")
        found = body.alias("b").join(keys, F.col("b.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("b.text_hash") == F.col("k.text_hash")), "left_semi")
    return found.dropDuplicates(["doc_id", "text_hash"])


def _starts(threshold: float) -> str:
    """SQL: where windows of ``n`` words start, from the sorted ``hits`` of a document with items of that size.

    Each hit is taken as the first of a window, so every start comes once, and only hits within reach are looked at.
    """
    size, least = f"(n - {SHINGLE - 1})", f"greatest(1, CAST(ceil((n - {SHINGLE - 1}) * {threshold!r}D - 1e-9D) AS INT))"
    here, near = "hits[j].pos", f"filter(slice(hits, j + 1, {size}), x -> x.pos < hits[j].pos + {size})"
    low = f"greatest(get(hits, j - 1).pos + 1, hits[j + {least} - 1].pos - {size} + 1, array_min(transform(near, x -> x.low)))"
    high = f"least({here}, array_max(transform(near, x -> x.high)))"
    none = "CAST(array() AS ARRAY<INT>)"
    run = f"get(transform(array({near}), near -> get(transform(array(named_struct('a', {low}, 'b', {high})), r -> IF(r.a <= r.b, sequence(r.a, r.b), {none})), 0)), 0)"
    each = f"transform(sequence(0, size(hits) - {least}), j -> IF(hits[j + {least} - 1].pos - {here} < {size}, {run}, {none}))"
    return f"IF(size(hits) >= {least}, flatten({each}), {none})"


def _leaks(docs: DataFrame, benchmark: DataFrame, threshold: float) -> DataFrame:
    """doc_id, text_hash, item_id, start (word), n, similarity of all windows that reach the threshold."""
    cut_items = benchmark.select("item_id", words(F.col("text")).alias("w")).select("item_id", F.size("w").alias("n"), shingles(F.col("w")).alias("item_hashes"))
    items = checkpoint(_simhash(cut_items.where(F.size("item_hashes") > 0).distinct(), "item_hashes", "item_print").withColumn("item", F.monotonically_increasing_id()))
    places = items.select("n", F.posexplode("item_hashes").alias("at", "hash")).groupBy("n", "hash").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    n_places = places.count()
    texts = checkpoint(_marked(docs, checkpoint(_marks(benchmark, threshold))))
    found = texts.select("doc_id", "text_hash", F.posexplode(shingles(F.col("w"))).alias("pos", "hash"))
    hit = F.struct("pos", (F.col("pos") - F.col("last_at")).alias("low"), (F.col("pos") - F.col("first_at")).alias("high"))
    hits = found.join(small(places, n_places), "hash").groupBy("doc_id", "text_hash", "n").agg(F.sort_array(F.collect_list(hit)).alias("hits"))
    windows = hits.select("doc_id", "text_hash", "n", F.expr(_starts(threshold)).alias("starts")).where(F.size("starts") > 0)
    cut = (
        windows.alias("v").join(texts.alias("t"), F.col("v.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("v.text_hash") == F.col("t.text_hash")))
        .select("v.doc_id", "v.text_hash", "n", "w", F.explode("starts").alias("at"))
        .select("doc_id", "text_hash", "n", "w", F.greatest(F.lit(0), F.col("at")).alias("start"), F.least(F.size("w"), F.col("at") + F.col("n")).alias("stop"))
        .select("doc_id", "text_hash", "start", "n", F.slice("w", F.col("start") + 1, F.col("stop") - F.col("start")).alias("w"))
        .select("doc_id", "text_hash", "start", "n", shingles(F.col("w")).alias("hashes"))
    )
    prints = checkpoint(_simhash(cut, "hashes", "print").withColumn("win", F.monotonically_increasing_id()))
    pairs = checkpoint(proposed(prints.select("win", "n", "print"), items.select("item", "n", "item_print")))
    n_pairs = pairs.count()
    near = small(pairs, n_pairs).join(prints, "win").join(items.drop("n"), "item").where(_distance("print", "item_print") <= RADIUS)
    candidates = near.select("doc_id", "text_hash", "item_id", "start", "n", "hashes", "item_hashes")
    scored = candidates.withColumn("similarity", F.expr(_bag_similarity("hashes", "item_hashes"))).where(F.col("similarity") >= threshold)
    return scored.select("doc_id", "text_hash", "item_id", "start", "n", "similarity")


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, start (word), n_words, similarity: each item that a document holds, where it fits best."""
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n")).alias("best")
    found = _leaks(docs, benchmark, threshold).groupBy("doc_id", "item_id").agg(best)
    return found.select("doc_id", "item_id", (-F.col("best.before")).alias("start"), F.col("best.n").alias("n_words"), F.col("best.similarity").alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item.

    Rows are judged by id and text: another text under the same id stays, and so do other rows without an id.
    """
    leaks = checkpoint(_leaks(docs, benchmark, threshold).select("doc_id", "text_hash").distinct())
    mine = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_text") == F.col("text_hash"))
    return unwrapped(wrapped(docs, own_id=F.col("doc_id"), own_text=F.xxhash64("text")).join(small(leaks, leaks.count()), mine, "left_anti"))
