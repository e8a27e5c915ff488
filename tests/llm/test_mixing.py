import hashlib
import math
import re
from collections import defaultdict

from kerbline.llm import mixing


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def fill(sizes, weights, caps):
    """Water filling by repeated sharing."""
    goal, free, left = {}, set(sizes), float(sum(sizes.values()))
    while free:
        total = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / total > caps[s] + 1e-9}
        if not over:
            goal |= {s: left * weights[s] / total for s in free}
            break
        for s in over:
            goal[s] = caps[s]
            left -= caps[s]
        free -= over
    return goal


def cases(prose):
    docs = [(k, " ".join(["w"] * (k % 7 + 1)), f"s{k % 4}") for k in range(200)]
    docs += [(300, None, "s1"), (301, "", None), (302, "a b c", None), (303, "only", "tiny"), (None, "x y z", "s0"), (5, "w " * 6, "s1"), (5, "w " * 6, "s1"), (304, "lone & # * words | here", "zz")]
    return docs


def test_targets_and_taken(spark, docs_of, prose):
    docs = cases(prose)
    rows = mixing.mix(docs_of(docs, extra=True)).collect()
    sizes = defaultdict(int)
    for _, t, s in docs:
        sizes[s] += size(t)
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    goal = fill(sizes, weights, {s: 3 * n for s, n in sizes.items()})
    took, most = defaultdict(int), defaultdict(int)
    for r in rows:
        assert math.isclose(r.mix_target, goal[r.source], abs_tol=1e-6) and r.mix_source_size == sizes[r.source]
        assert 0 <= r.mix_taken <= 3 * r.mix_size and r.mix_taken >= r.mix_epochs * r.mix_size
        took[r.source] += r.mix_taken
        most[r.source] = max(most[r.source], r.mix_size)
    assert len(rows) == len(docs)
    assert all(goal[s] - 3 <= took[s] <= goal[s] for s in sizes)


def test_order_is_by_key(spark, docs_of, prose):
    """Inside a source the documents taken once more are those of the smallest keys."""
    docs = [(k, "w " * (k % 5 + 1) + "# " * (k % 3), s) for k in range(60) for s in ("a", "b")]
    rows = mixing.mix(docs_of(docs)).collect()

    def key(r):
        t = r.text
        weight = 1 / (1 + 50 * sum(t.count(x) for x in mixing.SYMBOLS) / max(len(t), 1))
        u = (int(hashlib.md5(f"0:{r.doc_id}".encode()).hexdigest()[:13], 16) + 1) / 2**52
        return -math.log(u) / weight

    for s in "ab":
        mine = sorted((r for r in rows if r.source == s), key=key)
        more = [r.mix_taken - r.mix_epochs * r.mix_size for r in mine]
        whole = [m == r.mix_size for m, r in zip(more, mine)]
        first = whole.index(False) if False in whole else len(whole)
        assert all(m == 0 for m in more[first + 1 :])


def test_reruns_partitions_and_rows(spark, docs_of, prose):
    docs = cases(prose)
    a = sorted(mixing.mix(docs_of(docs)).select("doc_id", "source", "mix_taken").collect(), key=str)
    b = sorted(mixing.mix(docs_of(docs).repartition(7)).select("doc_id", "source", "mix_taken").collect(), key=str)
    assert a == b
    mixed = mixing.mix(docs_of(docs))
    assert sorted(((r.doc_id, r.taken) for r in mixing.amounts(docs_of(docs)).collect()), key=str) == sorted(((r.doc_id, r.mix_taken) for r in mixed.collect()), key=str)
    out = mixing.taken(docs_of(docs))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sum(size(r.text) for r in out.collect()) == sum(r.mix_taken for r in mixed.collect())


def test_crossing_range_is_cut_again(spark, docs_of, monkeypatch):
    """However few rows may be sorted, and however few ranges there are, the result is the same."""
    docs = [(k, "w " * (k % 9 + 1), f"s{k % 2}") for k in range(400)] + [(None, "x " * (k % 3 + 1), "s0") for k in range(50)]
    want = sorted(((r.doc_id, r.size, r.taken) for r in mixing.amounts(docs_of(docs)).collect()), key=str)
    monkeypatch.setattr(mixing, "BUCKETS", 4)
    monkeypatch.setattr(mixing, "SORTED", 3)
    assert sorted(((r.doc_id, r.size, r.taken) for r in mixing.amounts(docs_of(docs)).collect()), key=str) == want


def test_a_part_is_the_texts_own_beginning(spark, docs_of):
    docs = [(k, f" one\n\ttwo  three{k} \n four\n", f"s{k % 3}") for k in range(7)]
    rows = mixing.taken(docs_of(docs)).collect()
    assert all(docs[r.doc_id][1].startswith(r.text) for r in rows) and any(r.text != docs[r.doc_id][1] for r in rows)


def test_own_columns_named_like_ours(spark, docs_of):
    from pyspark.sql import functions as F

    df = docs_of([(k, "a b c", f"s{k % 2}") for k in range(20)], extra=True)
    for name in ("mix_goal", "mix_size", "mix_taken", "goal", "row", "id", "taken", "copy", "words"):
        df = df.withColumn(name, F.lit("mine"))
    assert mixing.taken_whole(df).columns == df.columns and all(r.mix_size == r.goal == "mine" for r in mixing.taken(df).collect())
    mixed = mixing.mix(df)
    assert len(set(mixed.columns)) == len(mixed.columns) and all(r.mix_goal == "mine" and r.mix_size == 3 for r in mixed.collect())


def test_empty(spark, docs_of):
    assert mixing.mix(docs_of([])).count() == 0
    only = mixing.mix(docs_of([(1, None, "a"), (2, "", None)])).collect()
    assert [r.mix_taken for r in only] == [0, 0]
