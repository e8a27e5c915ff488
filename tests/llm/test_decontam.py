import random
import re
from collections import Counter

import pytest

from kerbline.llm import decontam


def cut(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def bag(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(docs, items):
    """Every aligned window of every document against every item of its size, without fingerprints."""
    best = {}
    cuts = [(i, cut(t)) for i, t in items]
    for d, text in docs:
        w = cut(text)
        places = set()
        for p in range(len(w) - 4):
            for _, u in cuts:
                for q in range(len(u) - 4):
                    if w[p : p + 5] == u[q : q + 5]:
                        places.add((max(0, p - q), min(len(w), p - q + len(u)), len(u)))
        for a, b, n in places:
            mine = bag(w[a:b])
            for i, u in cuts:
                if len(u) == n:
                    theirs = bag(u)
                    s = sum((mine & theirs).values()) / sum((mine | theirs).values())
                    if s >= 0.8 and (s, -a) > best.get((d, i), (0, 0)):
                        best[d, i] = s, -a
    return {(d, i, -a, round(s, 9)) for (d, i), (s, a) in best.items()}


@pytest.fixture(scope="module")
def case(prose):
    item = prose[0]
    words = item.split()
    docs = [
        (1, f"{prose[1]} {item} {prose[2]}"), (2, prose[1]), (3, None), (4, ""), (5, item.upper().replace(" ", ", ")), (6, " ".join(words[:-2])), (7, " ".join(words[:14])),
        (8, f"{prose[2]}. {' '.join(words[:-1])} ocean {prose[1]}"), (9, " ".join(["wall"] + words)), (10, f"{prose[2]} {prose[2]}"), (1, f"{prose[1]} {item} {prose[2]}"), (None, item), (11, " ".join(words[:10] + ["red"] + words[11:])),
    ]
    return docs, [(1, item), (2, prose[2]), (3, None), (4, "too short"), (None, prose[1] + " at last")]


def test_brute_force(spark, docs_of, case):
    docs, items = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.find_leaks(docs_of([(d, t, "s") for d, t in docs], extra=True), bench).collect()
    assert {(r.doc_id, r.item_id, r.start, round(r.similarity, 9)) for r in got} == brute(docs, items)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    assert {1, 5, 6, 9, None} <= {r.doc_id for r in got} and not {2, 3, 4, 7} & {r.doc_id for r in got if r.item_id == 1}


def test_many_marks_and_empty(spark, docs_of, case, monkeypatch):
    docs, items = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontam, "MARKS_IN_PLAN", 0)
    monkeypatch.setattr(decontam, "INDEX_ROWS", 0)
    got = decontam.find_leaks(docs_of([(d, t, "s") for d, t in docs]), bench).collect()
    assert {(r.doc_id, r.item_id, r.start, round(r.similarity, 9)) for r in got} == brute(docs, items)
    assert decontam.find_leaks(docs_of([]), bench).count() == 0
    assert decontam.find_leaks(docs_of([(1, "a b c d e f g", "s")]), bench.limit(0)).count() == 0


def test_clean(spark, docs_of, case):
    docs, items = case
    bench = spark.createDataFrame([i for i in items if i[0] == 1], "item_id long, text string")
    left = decontam.clean(docs_of([(d, t, "s") for d, t in docs]), bench)
    assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    named = docs_of([(d, t, "s") for d, t in docs], extra=True).selectExpr("*", *[f"'x' AS {c}" for c in ("win", "item", "print", "hits", "d", "l", "hashes", "own_id", "own_text", "row")])
    assert decontam.clean(named, bench).columns == named.columns and decontam.clean(named, bench).count() == left.count()
    leaky = {t for d, t in docs if brute([(0, t)], [i for i in items if i[0] == 1])}
    assert leaky and Counter((r.doc_id, r.text) for r in left.collect()) == Counter((d, t) for d, t in docs if t not in leaky)


def test_clean_judges_rows(spark, docs_of, prose):
    """A leak under an id, or without one, takes its own text alone, as often as that stands there."""
    item, other = prose[0], prose[1]
    rows = [(None, item), (None, other), (None, other), (6, item), (6, other), (4, other), (7, f"{other} {item} {other}"), (7, f"{other} {item} {other}"), (7, None), (None, None), (7, "")]
    bench = spark.createDataFrame([(1, item), (None, "no one has this item of the benchmark at all today")], "item_id long, text string")
    left = decontam.clean(docs_of([(d, t, "s") for d, t in rows]), bench)
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter((d, t) for d, t in rows if not t or item not in t)


def test_index(spark):
    """Whatever lies within the radius is proposed; of random pairs under one in a hundred is."""
    rng = random.Random(12)
    bits, width = decontam.BLOCKS * decontam.WIDTH, decontam.WIDTH
    as_blocks = lambda v: [v >> k * width & (1 << width) - 1 for k in range(decontam.BLOCKS)]
    items = [rng.getrandbits(bits) for _ in range(60)]
    near = [(k % 60, items[k % 60] ^ sum(1 << b for b in rng.sample(range(bits), decontam.RADIUS))) for k in range(120)]
    for k in range(60):  # as evenly spread as can be, which is worst for blocks
        flips = [b * width + j for j in rng.sample(range(width), 4) for b in rng.sample(range(decontam.BLOCKS), decontam.BLOCKS)][: decontam.RADIUS]
        near.append((k, items[k] ^ sum(1 << b for b in flips)))
    far = [rng.getrandbits(bits) for _ in range(200)]
    prints = [(w, 50, as_blocks(v)) for w, v in enumerate([v for _, v in near] + far)]
    got = {(r.win, r.item) for r in decontam.proposed(spark.createDataFrame(prints, "win long, n int, print array<int>"), spark.createDataFrame([(k, 50, as_blocks(v)) for k, v in enumerate(items)], "item long, n int, item_print array<int>")).collect()}
    assert {(w, i) for w, (i, _) in enumerate(near)} <= got
    assert sum(w >= len(near) for w, _ in got) < 0.01 * len(far) * len(items)
    assert decontam.AGREE >= 1 and decontam.RADIUS // (decontam.NEAR_ITEM + decontam.NEAR_WINDOW + 1) + decontam.AGREE == decontam.BLOCKS


def test_fingerprints_of_similar_bags_are_near(spark):
    rng = random.Random(4)
    rows = []
    for k in range(300):
        both, mine, theirs = ([rng.getrandbits(63) for _ in range(n)] for n in (48, 6, 6))
        rows.append((k, both + mine, both + theirs))
    df = decontam._simhash(decontam._simhash(spark.createDataFrame(rows, "k long, a array<bigint>, b array<bigint>"), "a", "pa"), "b", "pb")
    apart = [r[0] for r in df.select(decontam._distance("pa", "pb")).collect()]  # similarity 0.8
    assert 44 < sum(apart) / len(apart) < 53 and max(apart) <= decontam.RADIUS


def test_very_long_text(spark, docs_of, prose):
    """A passage deep inside a text of 100,000 words, and a phrase of an item that comes again and again."""
    item = prose[0] + " " + prose[1]
    docs = [(1, f"{(prose[2] + ' ') * 4000}{item} {(prose[2] + ' ') * 200}", "s"), (2, (" ".join(prose[0].split()[:8]) + " ") * 3000, "s"), (3, "word " * 100_000, "s")]
    got = decontam.find_leaks(docs_of(docs), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.start, r.similarity) for r in got] == [(1, 7, 4000 * len(prose[2].split()), 1.0)]


def slide(docs, items):
    """The best similarity of each document and item over all windows of the item's size inside the document."""
    best = {}
    for d, text in docs:
        w = cut(text)
        for i, t in items:
            u = cut(t)
            theirs = bag(u)
            for a in range(len(w) - len(u) + 1):
                mine = bag(w[a : a + len(u)])
                s = sum((mine & theirs).values()) / sum((mine | theirs).values())
                if s >= 0.8:
                    best[d, i] = max(s, best.get((d, i), 0))
    return {(d, i, round(s, 9)) for (d, i), s in best.items()}


def test_windows_between_aligned_starts(spark, docs_of):
    """Words put in, left out, moved or repeated leave the best window between the places where shingles are aligned."""
    rng = random.Random(5)
    word = lambda k: [f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.randrange(10**6)}" for _ in range(k)]
    items = [(k, word(59)) for k in range(4)]
    items.append((4, items[0][1][:30] * 2))
    docs = [(0, items[0][1][:28] + word(2) + items[0][1][28:])]
    for k in range(1, 40):
        u = list(items[k % 5][1])
        at = rng.randrange(8, 50)
        docs.append((k, [u[:at] + word(k % 4) + u[at:], u[:at] + u[at + k % 3 + 1 :], u[at:] + u[:at], u + u[:at]][k % 4]))
    docs = [(d, " ".join(word(70) + u + word(70))) for d, u in docs]
    items = [(i, " ".join(u)) for i, u in items]
    got = decontam.find_leaks(docs_of([(d, t, "s") for d, t in docs]), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = slide(docs, items)
    assert (0, 0, round(49 / 61, 9)) in want and {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in got} == want
