import random
import zlib
from collections import Counter

import numpy as np
import pytest

from kerbline.llm import lengths, sst
from kerbline.llm.tokens import Encoder, default_path

ODD = ["", None, " ", "\n", "a  b   c\n\n d", "it's  'tis\tx\r\ny", "\x1c\x1da \x1fb", "\u00a0\u2003x \u0085 y", "😀 é ñandú  ", "<|endoftext|> ok", "a <|endoftext|> b", "x<|endoftext|><|endoftext|>", "<|endoftext", "a\n b \nc", "a \u00a0b", "tab\t\tend ", "  lead", "x" * 5000, "1234 56,78 %%% ### a.b"]


@pytest.fixture(scope="module")
def direct():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_same_ids_as_one_call(direct):
    rng = random.Random(3)
    signs = list("ab'sEé1. ,_²e\u0301\n\t\r\x0b\x0c\x1c\x85\u00a0\u2003😀-")
    texts = ODD + ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(6000)]
    e = Encoder(default_path())
    for _ in range(2):  # afresh, then from memory
        for text, raw in zip(texts, e.encode(texts)):
            assert np.frombuffer(raw, e.dtype).tolist() == direct(text), repr(text)
    assert np.frombuffer(e.encode(["a <|endoftext|> b"])[0], e.dtype).tolist() == [64, 220, 50256, 275]


def test_shards(spark, docs_of, direct, tmp_path, monkeypatch):
    docs = [(k * 7 % 101 - 20, f"text {k} " * (k % 9), "s") for k in range(101)] + [(None, "no id", "s"), (500, None, "s"), (501, "", "s"), (3, "again", "s"), (3, "again", "s"), (600, "word " * 40_000, "s")]
    manifest = sst.write(docs_of(docs, extra=True), f"file://{tmp_path}/shards", shards=5)
    got = sorted(sst.read(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, *sorted(d for d, _, _ in docs if d is not None)]
    ids = lambda t: direct(t) + [0]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(ids(t)), zlib.crc32(np.array(ids(t), "<u4").tobytes())) for d, t, _ in docs)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    asked = spark.createDataFrame([(3,), (500,), (None,), (9999,), (-21,)], "doc_id long")
    found = [(r.doc_id, r.ids) for r in sst.lookup(asked, manifest).collect()]
    monkeypatch.setattr(sst, "SHARDS_SENT", 0)
    assert sorted(((r.doc_id, r.ids) for r in sst.lookup(asked, manifest).collect()), key=str) == sorted(found, key=str)
    assert sorted(found, key=str) == sorted([(3, ids(next(t for d, t, _ in docs if d == 3 and t != "again"))), (3, ids("again")), (3, ids("again")), (500, [0]), (None, ids("no id"))], key=str)
    reader, file = sst.open_shard(manifest.first().path)
    assert not all(reader.may_have(10**9 + k) for k in range(50))
    file.close()
    assert sst.read(sst.write(docs_of([]), f"file://{tmp_path}/none")).count() == 0


def test_histogram(spark, docs_of, direct):
    docs = [(k, "a b c " * (k % 40), "s") for k in range(300)] + [(1, None, "s"), (2, "", None), (3, "long " * 3000, "s")]
    hist = lengths.histogram(lengths.encoded_lengths(docs_of(docs, extra=True)))
    n = [len(direct(t)) for _, t, _ in docs]
    for r in hist.collect():
        assert (r.docs, r.tokens) == (n.count(r.n_tokens), n.count(r.n_tokens) * r.n_tokens)
        assert (r.docs_longer, r.tokens_longer) == (sum(x > r.n_tokens for x in n), sum(x for x in n if x > r.n_tokens))
        assert r.truncated_tokens == sum(min(x, r.n_tokens) for x in n)
    limits = spark.createDataFrame([(k,) for k in (0, 1, 17, 50, 2000, 10**6)], "limit long")
    for r in lengths.truncated_totals(hist, limits).collect():
        assert (r.tokens, r.docs_cut) == (sum(min(x, r["limit"]) for x in n), sum(x > r["limit"] for x in n))
    for r in lengths.length_quantiles(hist, [0.01, 0.5, 0.9, 1.0]).collect():
        assert r.n_tokens == min(v for v in n if sum(x <= v for x in n) >= r.q * len(n) - 1e-9)
    assert lengths.histogram(lengths.encoded_lengths(docs_of([]))).count() == 0
