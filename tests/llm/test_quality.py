import re
from collections import Counter, defaultdict

from kerbline.llm import quality

WORD = r"[^\x20\x09-\x0D]+"
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")


def base(text):
    text = text or ""
    w = re.findall(WORD, text)
    wins = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if wins[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            dups += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dups, len(hit)


def brute(docs):
    normal = lambda s: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", s.translate(ASCII))
    texts, held = defaultdict(set), defaultdict(set)
    for _, t, s in docs:
        if t is not None:
            texts[s].add(t)
            for x in t.split("\n"):
                held[s, normal(x)].add(t)
    bad = {(s, x) for (s, x), ts in held.items() if x and len(ts) > max(quality.MIN_DOCS, quality.SHARE * len(texts[s]))}
    out = []
    for d, t, s in docs:
        b = base(t)
        failed = b[0] < 20 or 100 * b[4] > 30 * b[0]
        left = b[0] - sum(len(re.findall(WORD, x)) for x in (t or "").split("\n") if (s, normal(x)) in bad)
        out.append((d, *b, failed, left, not failed and left >= b[0] * quality.LEAST_LEFT))
    return Counter(out)


def rows(prose):
    docs = [(k, f"{prose[0]} number{'x' * k}\n  LICENSED under terms {k % 10} and more words here\n{prose[1]}", "a") for k in range(30)]
    docs += [(100 + k, f"licensed under terms {k % 10} and more words here\nshort{'y' * k}", "a") for k in range(6)]
    docs += [(200 + k, f"{prose[2]}\n{prose[0]}", "b") for k in range(40)]  # copies only
    docs += [(300, None, "a"), (301, "", None), (302, " \n\t\n\x85 é", "a"), (303, (prose[0] + " ") * 3, "a"), (304, "w " * 30_000, "a"), (305, "one\none\n\none", "a"), (None, prose[0], None), (5, "twice " + prose[2], "a"), (5, "twice " + prose[2], "a")]
    return docs


def test_brute_force(spark, docs_of, prose):
    docs = rows(prose)
    got = quality.judge(docs_of(docs, extra=True).withColumnRenamed("host", "host_x")).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.words_left, r.kept) for r in got) == brute(docs)


def test_clean(spark, docs_of, prose):
    docs = rows(prose)
    left = quality.clean(docs_of(docs))
    want = Counter(k[0] for k, n in brute(docs).items() for _ in range(n) if k[-1])
    named = docs_of(docs, extra=True).selectExpr("*", *[f"'x' AS {c}" for c in ("_host", "bad_host", "bad_text", "_lines", "_text", "own_host", "hashes", "row", "left")])
    assert quality.clean(named).columns == named.columns and quality.clean(named).where("_text = 'x' AND _host = 'x' AND hashes = 'x'").count() == left.count()
    assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"] and Counter(r.doc_id for r in left.collect()) == want
    lines = {r.doc_id: (r.text.split("\n"), r.n_chars) for r in left.collect() if r.doc_id in range(30)}
    assert all(x == [f"{prose[0]} number{'x' * k}"] and n == len(x[0]) for k, (x, n) in lines.items() if k not in (3, 5))
    assert set(range(30)) <= set(want) and 200 in want and 100 not in want
    assert quality.judge(docs_of([])).count() == 0 and quality.clean(docs_of([])).count() == 0


def test_repeated_rows_with_boilerplate(spark, docs_of, prose):
    """Each copy of a row, and each copy of a text without id, loses its frequent lines once."""
    line = "licensed under " + " ".join(f"term{chr(97 + k)}" for k in range(18))
    docs = [(k, f"{prose[0]} number{'x' * k}\n{line}", "a") for k in range(30)]
    docs += [(50, f"{prose[1]}\n{line}", "a")] * 2 + [(None, f"{prose[2]}\n{line}", "a")] * 3
    rows = [r for r in quality.judge(docs_of(docs)).collect() if r.doc_id is None or r.doc_id == 50]
    assert Counter((r.doc_id, r.words_left, r.kept) for r in rows) == {(50, len(prose[1].split()), True): 2, (None, len(prose[2].split()), True): 3}
    assert Counter((r.doc_id, r.words_left, r.kept) for r in rows) == Counter((x[0], *x[-2:]) for x in brute(docs).elements() if x[0] is None or x[0] == 50)
    left = Counter((r.doc_id, r.text) for r in quality.clean(docs_of(docs)).collect() if r.doc_id is None or r.doc_id == 50)
    assert left == {(50, prose[1]): 2, (None, prose[2]): 3}
