"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of five-word shingles (words are split at white space, A-Z lower-cased; a text of one to four
words is a single shingle).  Two documents are linked where the Jaccard similarity of their sets is 0.8 or more.

1. Every text gets 160 MinHash values.  Documents with the same words in the same order are one text from here
   on; copies are links by definition and are counted, never paired.
2. 32 bands of five values propose which texts may be near.  Each bucket of a band ties its texts to its smallest
   one, so a bucket of any size gives as many rows as it has texts; texts tied together, directly or through
   others, form a pool.  At similarity 0.8 all bands miss with probability 3e-6.
3. Pools are compared in blocks of :data:`BLOCK` texts.  A pool of more than :data:`POOL` texts, as chance ties make
   in large corpora, isn't compared as a whole but bucket by bucket, each pair in its first common bucket alone; both
   ways compare the pairs that have a bucket in common, and no others, so a pool's size changes no link.  Inside a block pair, MinHash values are compared 32 at a
   time; a pair is dropped as soon as the posterior probability that its similarity reaches the threshold, under a
   uniform prior, falls below :data:`TOLERANCE`.  What is left is verified exactly on the shingle sets.
4. Blocks return sums, not pairs: how many documents each text is linked with, and a spanning tree of the links.
   Classes are the connected components of these trees.

A null or empty text has no shingles, is in a class of its own and has no links.  Rows that repeat an id and a
text are copies of one another.  An empty table gives no rows.  Other columns are kept by :func:`one_of_each`.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.common import checkpoint, new_folder, remove, schema_of, small, unwrapped, wrapped

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
STEP, TOLERANCE = 32, 1e-6
BLOCK, POOL = 256, 8_192
_WORDS_KNOWN = 100_000


@lru_cache(1)
def _family():
    rng = np.random.default_rng(20_240_229)
    return rng.integers(0, 1 << 32, HASHES, dtype=np.uint32), rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


class _Words(dict):
    """Word -> 64-bit hash, remembered per worker up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > _WORDS_KNOWN:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = max(1, len(codes) - SHINGLE + 1)
    h = np.full(n, len(codes) if len(codes) < SHINGLE else SHINGLE, np.uint64)
    for k in range(min(SHINGLE, len(codes))):
        h = (h ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return np.unique(h)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """160 values of 32 bits."""
    flip, odd = _family()
    low, best = (shingles & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 512):
        best = np.minimum(best, ((low[at : at + 512, None] ^ flip) * odd).min(axis=0))
    return best


def _normal_key(text: str | None) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split()))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, exact (a hash of the text as it stands), text_key, filled, signature (bytes), bands (array of 64-bit keys)."""

    def sign(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            keys, filled, sigs, bands = [], [], [], []
            for text in batch.column(2):
                text = text.as_py()
                shingles = shingle_set(text)
                sig = minhash(shingles).reshape(BANDS, ROWS)
                keys.append(_normal_key(text))
                filled.append(len(shingles) > 0)
                sigs.append(sig.tobytes() if len(shingles) else b"")
                bands.append([xxhash.xxh3_64_intdigest(row.tobytes(), k) - (1 << 63) for k, row in enumerate(sig)] if len(shingles) else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(filled, pa.bool_()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], schema.fieldNames())

    schema = schema_of(docs, ["doc_id"], "exact long, text_key binary, filled boolean, signature binary, bands array<bigint>")
    return docs.select("doc_id", F.xxhash64("text").alias("exact"), "text").mapInArrow(sign, schema)


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of a graph -> node, root: the smallest node of its component.

    Labels travel along edges and then to the label's own label, so rounds grow with the logarithm of a
    component's width.  Each round is a table in the shared folder, which goes when the next one stands.
    """
    spark, paths = edges.sparkSession, []

    def table(df: DataFrame) -> DataFrame:
        paths.append(new_folder(spark, "labels"))
        df.write.parquet(paths[-1])
        return spark.read.parquet(paths[-1])

    both = table(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = table(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"))
    while True:
        around = both.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = label.join(around, "node", "left").select("node", "root", F.least("root", "near").alias("next"))
        jump = label.select(F.col("node").alias("next"), F.col("root").alias("far"))
        new = table(step.join(jump, "next", "left").select("node", F.least("next", "far").alias("root"), (F.least("next", "far") != F.col("root")).alias("moved")))
        remove(spark, paths.pop(-2))
        if new.where("moved").isEmpty():
            remove(spark, paths[0])
            return new.select("node", "root")
        label = new.select("node", "root")


@lru_cache(8)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For 32, 64, ... compared values: the fewest matches for which P(similarity >= threshold | matches) >= tolerance."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            logs = m * np.log(grid) + (n - m) * np.log1p(-grid)
            dens = np.exp(logs - logs.max())
            if dens[grid >= threshold].sum() / dens.sum() >= tolerance:
                out.append(m)
                break
    return tuple(out)


def linked_pairs(sig_a, sig_b, sets_a, sets_b, same: bool, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, first=None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked pairs between two blocks: pruned on MinHash values, then verified on the sets.

    Pairs without a common band are no candidates, however large their pool is.
    first: (bands of a, bands of b, bucket) where only pairs whose first common band is that bucket are wanted.
    """
    hits = np.zeros((len(sig_a), len(sig_b)), np.int16)
    for k in range(STEP):
        hits += sig_a[:, k, None] == sig_b[None, :, k]
    need = least_matches(threshold, tolerance)
    i, j = np.nonzero(hits >= need[0])
    if same:
        i, j = i[i < j], j[i < j]
    hits = hits[i, j].astype(np.int64)
    for k, least in enumerate(need[1:], 1):
        if len(i):
            hits += (sig_a[i, STEP * k : STEP * (k + 1)] == sig_b[j, STEP * k : STEP * (k + 1)]).sum(axis=1)
            ok = hits >= least
            i, j, hits = i[ok], j[ok], hits[ok]
    if first is None and len(i):
        ok = np.empty(len(i), bool)
        for at in range(0, len(i), 4096):
            part = slice(at, at + 4096)
            ok[part] = (sig_a[i[part]].reshape(-1, BANDS, ROWS) == sig_b[j[part]].reshape(-1, BANDS, ROWS)).all(axis=2).any(axis=1)
        i, j = i[ok], j[ok]
    elif len(i):
        bands_a, bands_b, bucket = first
        common = bands_a[i] == bands_b[j]
        ok = bands_a[i, common.argmax(axis=1)] == bucket
        i, j = i[ok], j[ok]
    if not len(i):
        return i, j
    sizes_a, sizes_b = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
    # Shared shingles of all pairs left, as a product of two 0/1 tables, a stretch of shingles at a time.
    used_a, used_b = np.unique(i), np.unique(j)
    if len(i) > 4 * (len(used_a) + len(used_b)):
        names, codes = np.unique(np.concatenate([sets_a[x] for x in used_a] + [sets_b[x] for x in used_b]), return_inverse=True)
        rows = np.repeat(np.arange(len(used_a) + len(used_b)), np.concatenate([sizes_a[used_a], sizes_b[used_b]]))
        order = np.argsort(codes, kind="stable")
        codes, rows, common = codes[order], rows[order], np.zeros((len(used_a), len(used_b)), np.float64)
        for at in range(0, len(names), 4096):
            lo, hi = np.searchsorted(codes, [at, at + 4096])
            one = np.zeros((len(used_a) + len(used_b), 4096), np.float32)
            one[rows[lo:hi], codes[lo:hi] - at] = 1
            common += one[: len(used_a)] @ one[len(used_a) :].T
        shared = common[np.searchsorted(used_a, i), np.searchsorted(used_b, j)]
    else:
        shared = np.array([len(np.intersect1d(sets_a[x], sets_b[y], assume_unique=True)) for x, y in zip(i, j)])
    ok = shared >= threshold * (sizes_a[i] + sizes_b[j] - shared) - 1e-9
    return i[ok], j[ok]


def _tree(n: int, i, j) -> list[int]:
    """The smallest position of each node's component."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(map(find, i.tolist()), j.tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def near_texts(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, exact, text_key) and texts (text_key, rep: the smallest id of the text, copies, filled; root and links where it has any)."""
    signed = checkpoint(signatures(docs))
    texts = checkpoint(signed.groupBy("text_key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("m"), F.count("*").alias("copies"), F.first("filled").alias("filled")).select("text_key", F.col("m.doc_id").alias("rep"), "copies", "filled"))
    keys = signed.select("text_key", F.explode("bands").alias("key"))
    ties = checkpoint(keys.groupBy("key").agg(F.min("text_key").alias("b"), F.max("text_key").alias("z")).where("b != z").select("key", "b"))
    n_ties = ties.count()
    # Buckets of one text, nearly all, are gone before anything is joined.
    edges = keys.join(small(ties, n_ties), "key").where(F.col("text_key") != F.col("b")).select(F.col("text_key").alias("a"), "b").distinct()
    pools = components(edges)
    members = checkpoint(pools.join(texts.select(F.col("text_key").alias("node"), "copies"), "node"))
    n_members = members.count()
    sizes = checkpoint(members.groupBy("root").agg(F.count("*").alias("size")))
    # Texts are fetched again for the few that are in pools; each row of a text is as good as any other.
    wanted = small(members.select(F.col("node").alias("text_key"), "root", "copies"), n_members)
    keyed = signed.select("doc_id", "text_key", "signature").join(wanted, "text_key").groupBy("text_key", "root", "copies").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "signature")).alias("m"))
    keyed = checkpoint(keyed.select("text_key", "root", "copies", F.col("m.doc_id").alias("of"), F.col("m.signature").alias("signature")))
    bodies = docs.select("doc_id", "text").alias("d").join(small(keyed.select("of").distinct(), n_members).alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.of")), "left_semi").select("doc_id", "text")
    # Where an id is repeated with other texts, the text's own key tells which row is meant.
    sets = checkpoint(_shingle_rows(bodies))
    pooled = keyed.join(sets, "text_key").join(small(sizes, n_members), "root")  # pools are fewer than their members
    no_bands = F.lit(None).cast("array<bigint>")
    units = pooled.where(F.col("size") <= POOL).select(F.lower(F.hex("root")).alias("unit"), "size", "text_key", "copies", "signature", "shingles", no_bands.alias("bands"))
    if not sizes.where(F.col("size") > POOL).isEmpty():
        wide = pooled.where(F.col("size") > POOL).drop("size").join(signed.select("text_key", "bands").dropDuplicates(["text_key"]), "text_key")
        in_buckets = wide.withColumn("key", F.explode("bands")).join(small(ties.select("key"), n_ties), "key")
        in_bucket = in_buckets.groupBy("key").agg(F.count("*").alias("size"))
        units = units.union(in_buckets.join(in_bucket, "key").select(F.col("key").cast("string").alias("unit"), "size", "text_key", "copies", "signature", "shingles", "bands"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = units.withColumn("block", F.pmod(F.xxhash64("text_key"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).select("unit", "lo", "hi", "block", "text_key", "copies", "signature", "shingles", "bands")

    def compare(key, table):
        import pyarrow as pa

        block, copies = table["block"].to_numpy(), table["copies"].to_numpy()
        names = table["text_key"].to_pylist()
        sig = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint32).reshape(-1, HASHES)
        sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        lo, hi = key[1].as_py(), key[2].as_py()
        a, b = np.nonzero(block == lo)[0], np.nonzero(block == hi)[0]
        first = None
        if table["bands"].null_count == 0:
            bands = np.array(table["bands"].to_pylist(), np.int64)
            first = bands[a], bands[b], int(key[0].as_py())
        i, j = linked_pairs(sig[a], sig[b], [sets[x] for x in a], [sets[x] for x in b], lo == hi, threshold, tolerance, first)
        i, j = a[i], b[j]
        links = np.bincount(i, copies[j], len(names)) + np.bincount(j, copies[i], len(names))
        root = _tree(len(names), i, j)
        return pa.table({"text_key": pa.array(names, pa.binary()), "to": pa.array([names[r] for r in root], pa.binary()), "links": pa.array(links.astype(np.int64))})

    compared = checkpoint(dealt.groupBy("unit", "lo", "hi").applyInArrow(compare, "text_key binary, to binary, links long").where("links > 0"))
    classes = components(compared.select(F.col("text_key").alias("a"), F.col("to").alias("b")))
    links = compared.groupBy(F.col("text_key").alias("node")).agg(F.sum("links").alias("links"))
    linked = classes.join(links, "node").select(F.col("node").alias("text_key"), "root", "links")
    return signed.select("doc_id", "exact", "text_key"), texts.join(linked, "text_key", "left")


def _shingle_rows(bodies: DataFrame) -> DataFrame:
    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([_normal_key(t) for t in texts], pa.binary()), pa.array([shingle_set(t).tobytes() for t in texts], pa.binary())], ["text_key", "shingles"])

    return bodies.select("doc_id", "text").mapInArrow(rows, "text_key binary, shingles binary").dropDuplicates(["text_key"])


def classes(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, class_id (the smallest id of its class), n_links: a row per row of ``docs``.

    ``n_links`` counts the other documents of similarity ``threshold`` or more, copies included.
    """
    members, texts = near_texts(docs, threshold, tolerance)
    group = F.coalesce(F.col("root"), F.col("text_key"))
    texts = texts.select("text_key", group.alias("group"), "rep", F.when(F.col("filled"), F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).alias("n_links"), "filled")
    first = texts.groupBy("group").agg(F.min("rep").alias("class_id"))
    known = checkpoint(texts.join(first, "group").select("text_key", "class_id", "n_links", "filled"))
    return members.join(known, "text_key").select("doc_id", F.when(F.col("filled"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), "n_links")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with one row of each class: the smallest id (nulls last), of its texts the one with the smallest key, once.

    Rows are judged, not ids: a row goes where its own text is near another's, whatever else stands under its id, and
    rows without an id are judged like others.  A row without shingles (a null or empty text) always stays, however
    often it is there.
    """
    members, texts = near_texts(docs, threshold, tolerance)
    # Texts of one row without links are their class's pick; only the others are looked at.
    shared = checkpoint(texts.where(F.col("filled") & ((F.col("copies") > 1) | F.col("root").isNotNull())).select("text_key", F.coalesce("root", "text_key").alias("group")))
    rows = checkpoint(members.join(small(shared, shared.count()), "text_key").groupBy("group", "doc_id", "text_key", "exact").agg(F.count("*").alias("times")))
    # A row per class: stored, so that a class with many rows isn't bound to the task that found its pick.
    pick = checkpoint(rows.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key", "exact")).alias("pick")))
    judged = checkpoint(rows.join(small(pick, pick.count()), "group").select(F.col("doc_id").alias("of_id"), F.col("exact").alias("of_exact"), "times", (F.col("doc_id").eqNullSafe(F.col("pick.doc_id")) & (F.col("exact") == F.col("pick.exact"))).alias("stays")))
    mine = F.col("own_id").eqNullSafe(F.col("of_id")) & (F.col("own_exact") == F.col("of_exact"))
    gone, twice = judged.where(~F.col("stays")).select("of_id", "of_exact"), judged.where(F.col("stays") & (F.col("times") > 1)).select("of_id", "of_exact")
    n_gone, n_twice = gone.count(), twice.count()
    kept = wrapped(docs, own_id=F.col("doc_id"), own_exact=F.xxhash64("text")).join(small(gone, n_gone), mine, "left_anti")
    if n_twice:
        once = kept.join(small(twice, n_twice), mine, "left_semi").dropDuplicates(["own_id", "own_exact"])
        kept = kept.join(small(twice, n_twice), mine, "left_anti").unionByName(once)
    return unwrapped(kept)
