import hashlib

import pytest

from kerbline.llm import fim


def brute(doc_id, text):
    """The contract word by word, line by line."""
    text = text or ""
    lines, line = [], ""
    for c in text:
        line += c
        if c == "\n":
            lines.append(line)
            line = ""
    if line:
        lines.append(line)
    n = len(lines)
    h = hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 100:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    spm = h4 % 100 < 50
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, "spm" if spm else "psm", len(p), len(m), sha(out), sha(text)


TEXTS = [None, "", "\n", "\n\n\n", "one", "one\n", "one\ntwo", "a\r\nb c\x0bd\x85e\nf", "é\n\U0001f600\U0001f600\nß", "has <P> in it\nx", "<M>", "<S", "<P\n>", "x < P >\ny", "same\nsame\nsame\n", "\x00\n\x00", "long " * 40_000 + "\n" + "z" * 200_000, "line\n" * 50_000]


def test_digest(spark, docs_of):
    docs = [(k, t, "s") for k, t in enumerate(TEXTS)] + [(None, "no id\nat all\n", "s"), (3, "a repeated id\nother text", None), (4, "one", "s"), (4, "one", "s"), (-17, "below\nzero\n", "s"), (2**62, "large\nid", "s")]
    docs += [(100 + k, "".join(f"line {j}\n" for j in range(k)), "s") for k in range(60)]
    want = sorted((brute(d, t) for d, t, _ in docs), key=str)
    for df in (docs_of(docs), docs_of(docs, extra=True).selectExpr("*", "'x' AS n", "'x' AS output", "'x' AS `a.b`", "1 AS _id"), docs_of(docs).repartition(7)):
        assert sorted(map(tuple, fim.digest(df).collect()), key=str) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert fim.digest(docs_of([])).count() == 0


def test_small_batches(spark, docs_of):
    docs = [(k, "ab\n" * k, f"s{k}") for k in range(40)]
    rows = fim.transform(docs_of(docs), ("source", "doc_id"), batch_chars=10).collect()
    assert sorted((r.doc_id, r.source, fim.restore(r.output, r.form)) for r in rows) == [(k, s, t) for k, t, s in docs]


@pytest.mark.parametrize("unit", [fim.LINE, r"\S+\s*|\s+", r".|\n"])
def test_other_units_and_shares(spark, docs_of, unit):
    docs = [(k, f"some words {k}\nand a few more  \n\n of them", "s") for k in range(200)]
    rows = fim.transform(docs_of(docs), ("doc_id", "source", "text"), unit, seed=3, rate=60, spm=30).collect()
    share = {f: sum(r.form == f for r in rows) for f in ("plain", "psm", "spm")}
    assert 50 < share["plain"] < 110 and share["psm"] > share["spm"] > 10 and len(rows) == 200
    for r in rows:
        assert fim.restore(r.output, r.form) == r.text and r.source == "s"
        assert "".join(r.text[a:b] for a, b in zip([0, *fim.units(r.text, unit)], fim.units(r.text, unit))) == r.text
        if r.form != "plain":
            assert {r.prefix_chars, r.prefix_chars + r.middle_chars} <= {0, *fim.units(r.text, unit)}


def test_units_must_cover_the_text():
    with pytest.raises(ValueError):
        fim.units("a\nb", r"[^\n]+")
