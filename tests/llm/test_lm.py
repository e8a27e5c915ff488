import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbline.llm import lm


def toks(t):
    return [*(t or "").encode().lower().split(), b""]


def out(d):
    return d is not None and zlib.crc32(str(d).encode()) % 10 == 0


def brute_base(docs):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) of each row."""
    c = Counter(w for d, t, _ in docs if not out(d) for w in toks(t))
    n, v = sum(c.values()), len(c)
    return Counter((d, out(d), len(toks(t)), sum(c[w] > 0 for w in toks(t)), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in toks(t)), 6)) for d, t, _ in docs)


def told(rows):
    return Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)


@pytest.fixture(scope="module")
def corpus(prose):
    rng = random.Random(11)
    words = sorted({w for t in prose for w in t.split()})
    docs = [(k, " ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=60)), "s") for k in range(120)]
    return docs + [(500, None, "s"), (501, "", "s"), (502, "zzqx unseen wörd É", "s"), (None, "no id Here", "s"), (3, "The THE the", "s"), (3, "The THE the", "s")]


def test_cut():
    import pyarrow as pa

    texts = ["  The the\tÉ\x0b\nX ", None, "", "\x85a\x1cb", "one"]
    for given in (texts, [t for t in texts if t is not None] * 3):
        column = pa.array(given)
        for start in range(len(given)):  # slices too: they share their column's buffers
            words, word, sizes = lm.cut(column.slice(start, 3))
            want = [toks(t) for t in given[start : start + 3]]
            assert [[words[w].as_py() for w in part] for part in np.split(word, np.cumsum(sizes)[:-1])] == want
    assert lm.cut(pa.array([], pa.string()))[1].size == 0


def test_pieces():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["x" * k for k in (5, 3_000_000, 2_000_000, 9_000_000, 1, 0)] + [None])], ["text"])
    parts = [p.column(0).to_pylist() for p in lm.pieces(batch, 0)]
    assert [t for p in parts for t in p] == batch.column(0).to_pylist() and max(map(len, parts)) < 5 and len(parts) >= 3


def test_codes():
    """Each token's key, against a plain loop."""
    import pyarrow as pa

    texts = ["the cat of a Cat", "", None, "xé of of the the end of it", "of"]
    known = [b"the", b"of", b"cat", b"it"]
    words, word, sizes = lm.cut(pa.array(texts))
    keys, rank = lm.codes(words, word, sizes, pa.array(known, pa.large_binary()))
    place = {w: k for k, w in enumerate(known)}
    at = 0
    for t in texts:
        state, before, last = 0, 0, 0
        for w in toks(t):
            leaf = 0 if not w else 1 + place[w] if w in place else 1 + lm.TOP + (w[-1] & 127)
            assert (keys[at] >> 17, keys[at] >> 13 & 15, keys[at] & 8191) == (before, state, leaf)
            state = last or state
            last = place[w] + 1 if w in place else 0
            before = 1 + place[w] if w in place else 1 + lm.TOP + (w[-1] * 31 + (w[-2] if len(w) > 1 else 0)) % lm.ENDINGS if w else 0
            at += 1
    assert at == len(keys) and [rank[k] for k, w in enumerate(words.to_pylist())] == [place.get(w, -1) if w else -1 for w in words.to_pylist()]


def test_base_score(spark, docs_of, corpus, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN", 20)  # most words take the join
    rows = lm.score(docs_of(corpus, extra=True)).collect()
    assert told(rows) == brute_base(corpus)
    by_id = {r.doc_id: r for r in rows}
    assert all(r.score < 0 and r.bits_per_byte >= 0 for r in rows)
    # Learnt text is cheaper than strange text, and far cheaper than a byte's eight bits.
    held = [r for r in rows if r.held_out and r.n_tokens > 30]
    assert held and all(r.bits_per_byte < 2.5 for r in held) and by_id[502].bits_per_byte > 2 * max(r.bits_per_byte for r in held)


def test_many_rows_in_one_batch(spark, docs_of, prose):
    """Rows far down an Arrow batch are read as the first ones are."""
    rng = random.Random(2)
    words = " ".join(prose).split()
    docs = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 30))) + f" only{k}", "s") for k in range(7_000)]
    assert told(lm.score(docs_of(docs).coalesce(1)).collect()) == brute_base(docs)


def test_any_order_and_partitions(spark, docs_of, corpus, monkeypatch):
    monkeypatch.setattr(lm, "SHARD", 800)  # several shards, some of them in parts
    monkeypatch.setattr(lm, "SPLIT", 300)
    monkeypatch.setattr(lm, "WORDS_A_SHARD", 20)
    mixed = list(corpus)
    random.Random(1).shuffle(mixed)
    one, two = (sorted(((r.doc_id, r.score, r.bits_per_byte) for r in lm.score(df).collect()), key=str) for df in (docs_of(corpus).coalesce(1), docs_of(mixed).repartition(5)))
    assert [x[0] for x in one] == [x[0] for x in two]
    assert np.allclose([x[1:] for x in one], [x[1:] for x in two], rtol=1e-6)


def test_better_than_the_unigram(spark):
    """On text that it hasn't seen, and on whole documents of the given tables."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = lm.score(docs).where("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert r.score > r.base


def test_order_of_words_counts(spark, docs_of):
    """The same words shuffled are dearer, also where they are long."""
    rng = random.Random(8)
    names = [f"longishword{chr(97 + k)}" for k in range(12)]

    def chain(n):
        start = rng.randrange(12)
        return " ".join(names[k % 12] for k in range(start, start + n))

    train = [(k, chain(50), "s") for k in range(200)]
    fluent, mixed = chain(50), chain(50).split()
    rng.shuffle(mixed)
    rows = {r.doc_id: r.score for r in lm.score(docs_of(train + [(1001, fluent, "s"), (1002, " ".join(mixed), "s")]), F.col("doc_id") > 1000).collect()}
    assert rows[1001] > rows[1002] + 20


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(4)
    words = lm.Words(rng.integers(0, 50, (lm.STATES, lm.LEAVES)).astype(float))
    keys = np.unique((rng.integers(0, 3, 5000) << 17 | rng.integers(0, 16, 5000) << 13 | rng.integers(0, lm.LEAVES, 5000)).astype(np.int32))
    n = rng.integers(1, 9, len(keys))
    shard = lm.Shard(words, keys, n)
    mixer = lm.Mixer(shard.learn(keys, n).sums())
    for before, state in ((0, 3), (2, 0), (9, 9)):
        every = (before << 17 | state << 13 | np.arange(lm.LEAVES)).astype(np.int32)
        assert math.isclose(sum(2.0 ** -shard.bits(every, mixer)), 1, rel_tol=1e-4)
    code = lm.prefix_code(rng.integers(1, 100, lm.SIGNS))
    spell = lm.Spelling(rng.integers(0, 5, 2 * sum(1 << x for x in lm.SPELL_BITS)).astype(np.float32), code)
    slots, bit, _ = spell.decisions([b"river", b"a"])
    both = mixer.bits(spell.seen(slots), bit), mixer.bits(spell.seen(slots), 1 - bit)
    assert np.allclose(2.0 ** -both[0] + 2.0 ** -both[1], 1, rtol=1e-4)
    assert math.isclose(sum(2.0 ** -(code[0][k + 1] - code[0][k]) for k in range(lm.SIGNS)), 1)
    classes = [{"last": 5, "k": k, "less": k - 1, "types": k * 3, "tokens": k * 3 * k} for k in range(1, 6)]
    rest = lm._rest_bits(classes, [])
    assert math.isclose(sum(2.0 ** -rest[k, 5] * (3 * k or 1) for k in range(6)), 1)


def test_merged(spark):
    rng = random.Random(3)
    rows = [(s, salt, sorted(rng.sample(range(50), 7)), [rng.randrange(9) for _ in range(7)]) for s in range(3) for salt in range(40) for _ in range(2)]
    want = Counter()
    for s, _, keys, ns in rows:
        for k, n in zip(keys, ns):
            want[s, k] += n
    got = lm.merged(spark.createDataFrame(rows, "shard int, salt int, key array<int>, n array<long>"), 40).collect()
    assert len(got) == 3 and {(r.shard, k): n for r in got for k, n in zip(r.key, r.n)} == dict(want)


def test_nothing_to_learn_from(spark, docs_of):
    rows = lm.score(docs_of([(1, "a b", "s"), (2, None, "s")]), F.lit(True)).collect()
    assert [(r.n_known, r.train_tokens) for r in rows] == [(0, 0), (0, 0)] and all(math.isfinite(r.score) for r in rows)
    assert lm.score(docs_of([])).count() == 0
    assert lm.score(docs_of([(2, "word " * 60_000, "s"), (3, "x" * 200_000, None)])).count() == 2
