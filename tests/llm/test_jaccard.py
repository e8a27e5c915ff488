import random
from collections import defaultdict

import numpy as np

from kerbline.llm import jaccard


def words(t):
    return (t or "").encode().lower().split()


def shingles(t):
    w = words(t)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = [shingles(t) for _, t, _ in docs]
    near = defaultdict(list)
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                near[i].append(j)
                near[j].append(i)
    out, seen = [None] * len(docs), {}
    for i in range(len(docs)):
        todo, part = [i], set()
        while todo:
            x = todo.pop()
            if x not in part:
                part.add(x)
                todo += near[x]
        ids = [docs[x][0] for x in part if docs[x][0] is not None]
        out[i] = (docs[i][0], min(ids) if ids else None, len(near[i]))
    del seen
    return sorted(out, key=str)


def cases(prose):
    rng = random.Random(5)
    vocabulary = sorted({w for t in prose for w in t.split()})
    docs, base = [], [" ".join(rng.choices(vocabulary, k=120)) for _ in range(12)]
    for k, b in enumerate(base):
        docs.append((k, b, "s"))
        for e in range(k % 5):
            w = b.split()
            for _ in range(rng.randrange(1, 6)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary) + "x"
            docs.append((100 + 10 * k + e, " ".join(w), "s"))
    docs += [(300 + k, base[0].upper() if k % 2 else base[0] + "\n", "s") for k in range(6)]
    docs += [(400, None, "s"), (401, "", None), (402, " \n", "s"), (403, "three words only", "s"), (404, "Three  words ONLY", "s"), (405, "one", "s"), (None, base[1], "s"), (2, base[2], "s"), (2, base[3], "s"), (406, (base[4] + " ") * 200, "s")]
    return docs


def test_brute_force(spark, docs_of, prose):
    docs = cases(prose)
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.classes(docs_of(docs, extra=True)).collect()), key=str)
    assert got == brute(docs)


def test_small_blocks(spark, docs_of, prose, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    docs = cases(prose)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.classes(docs_of(docs)).collect()), key=str) == brute(docs)


def test_wide_pools_go_by_buckets(spark, docs_of, prose, monkeypatch):
    """Pools over the bound are compared bucket by bucket, with the same links."""
    monkeypatch.setattr(jaccard, "POOL", 2)
    docs = cases(prose)
    for block in (3, 256):
        monkeypatch.setattr(jaccard, "BLOCK", block)
        assert sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.classes(docs_of(docs)).collect()), key=str) == brute(docs)


def test_planted_near_copies(spark, docs_of, prose):
    """Of pairs just above the threshold, and of wide clusters, every link is found."""
    rng = random.Random(23)
    docs = []
    for k in range(150):  # pairs of 0.8 to 0.9
        w = [f"w{rng.randrange(3000)}" for _ in range(200)]
        other = list(w)
        for at in rng.sample(range(0, 200, 9), rng.randrange(2, 5)):
            other[at] = "changed"
        docs += [(2 * k, " ".join(w), "s"), (2 * k + 1, " ".join(other), "s")]
    base = [f"v{rng.randrange(3000)}" for _ in range(300)]
    for k in range(120):
        w = list(base)
        for at in rng.sample(range(300), rng.randrange(0, 8)):
            w[at] = f"x{rng.randrange(50)}"
        docs.append((1000 + k, " ".join(w), "s"))
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.classes(docs_of(docs)).collect()), key=str)
    assert got == brute(docs) and sum(r[2] > 0 for r in got) > 150


def brute_one_of_each(docs):
    """Which rows stay, as (id, normal text): of each component of filled rows one, and all rows without words."""
    sets = [shingles(t) for _, t, _ in docs]
    left, kept = [k for k in range(len(docs)) if sets[k]], [(d, ()) for (d, _, _), s in zip(docs, sets) if not s]
    near = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9
    while left:
        part, todo = set(), [left[0]]
        while todo:
            x = todo.pop()
            if x not in part:
                part.add(x)
                todo += [y for y in left if y not in part and near(x, y)]
        left = [x for x in left if x not in part]
        smallest = min(part, key=lambda x: (docs[x][0] is None, docs[x][0] or 0))
        kept.append((docs[smallest][0], [tuple(words(docs[x][1])) for x in part if docs[x][0] == docs[smallest][0]]))
    return kept


def same_rows(rows, want):
    """Each row that stays is the pick of one component; where an id has several texts there, any one of them."""
    have = [(r.doc_id, tuple(words(r.text))) for r in rows]
    for doc_id, texts in want:
        fit = next((x for x in have if x[0] == doc_id and (x[1] in texts if texts else not x[1])), None)
        assert fit is not None, (doc_id, texts)
        have.remove(fit)
    assert not have


def test_one_of_each(spark, docs_of, prose):
    """Null and repeated ids, ids with several texts, empty texts beside repeats."""
    near = lambda t: t + " indeed"
    a, b, c = (f"{t} {t[::-1]}" for t in prose)
    mixed = [(3, b, "s"), (5, a, "s"), (5, near(b), "s"), (None, b, "s"), (None, near(b), "s"), (None, c, "s"), (9, "", "s"), (9, "", "s"), (None, None, "s"), (None, None, "s")]
    for docs in (cases(prose), mixed, [*mixed, (3, b, "t"), (3, b.upper(), "s")], [(None, a, "s")] * 5 + [(None, near(a), "s"), (None, "", None)], [(1, a, "s"), (1, near(a), "s"), (1, near(near(a)), "s")]):
        left = jaccard.one_of_each(docs_of(docs))
        assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        same_rows(left.collect(), brute_one_of_each(docs))
        named = jaccard.one_of_each(docs_of(docs, extra=True).selectExpr("*", "'x' AS own_id", "'x' AS row", "'x' AS own_exact", "'x' AS of_id", "'x' AS exact", "'x' AS pick"))
        assert named.where("gone_id = 'x' AND own_id = 'x'").count() == left.count()
    assert jaccard.classes(docs_of([])).count() == 0 and jaccard.one_of_each(docs_of([])).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    """Signatures of pairs at 0.8 are dropped no more often than the tolerance allows for."""
    rng = np.random.default_rng(9)
    lost = 0
    for _ in range(60):
        both, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (400, 50, 50))
        x, y = np.unique(np.concatenate([both, a])), np.unique(np.concatenate([both, b]))
        i, _ = jaccard.linked_pairs(jaccard.minhash(x)[None], jaccard.minhash(y)[None], [x], [y], False)
        lost += len(i) == 0
    assert lost == 0
    need = jaccard.least_matches(0.8, 1e-6)
    assert list(need) == sorted(need) and need[0] >= 8


def test_pairs_need_a_common_band():
    """The same rule in small pools as in wide ones, where pairs meet in buckets."""
    rng = np.random.default_rng(3)
    sets = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
    sig = np.repeat(jaccard.minhash(sets)[None], 3, axis=0)
    sig[1].reshape(jaccard.BANDS, jaccard.ROWS)[:, 0] += 1  # four values of five agree in each band
    sig[2].reshape(jaccard.BANDS, jaccard.ROWS)[1:, 0] += 1  # and one band in full
    i, j = jaccard.linked_pairs(sig, sig, [sets] * 3, [sets] * 3, True)
    assert sorted(zip(i, j)) == [(0, 2), (1, 2)]
    bands = np.array([[hash(row.tobytes()) for row in x.reshape(jaccard.BANDS, jaccard.ROWS)] for x in sig])
    for bucket, want in ((bands[0, 0], [(0, 2)]), (bands[0, 1], []), (bands[1, 1], [(1, 2)]), (bands[1, 2], [])):
        rows = [x for x in range(3) if bucket in bands[x]]
        i, j = jaccard.linked_pairs(sig[rows], sig[rows], [sets] * len(rows), [sets] * len(rows), True, first=(bands[rows], bands[rows], bucket))
        assert [(rows[a], rows[b]) for a, b in zip(i, j)] == want


def test_components(spark):
    rng = random.Random(7)
    edges = [(k, k + 1) for k in range(40)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(25)]
    got = {r.node: r.root for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(60):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root
