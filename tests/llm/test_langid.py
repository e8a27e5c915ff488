import math
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest

from kerbline.llm import langid
from kerbline.llm.common import table


class Tree:
    """Prediction by partial matching, method C with exclusion, one byte after the other with plain dictionaries."""

    def __init__(self, texts, order):
        self.order, self.after = order, defaultdict(lambda: defaultdict(int))
        for t in texts:
            data = b"\0" * order + t.encode()
            for i in range(order, len(data)):
                for j in range(order + 1):
                    self.after[data[i - j : i]][data[i]] += 1

    def bits(self, text):
        data, total = b"\0" * self.order + text.encode(), 0.0
        for i in range(self.order, len(data)):
            out = set()
            for j in range(self.order, -1, -1):
                seen = {b: n for b, n in self.after.get(data[i - j : i], {}).items() if b not in out}
                n, u = sum(seen.values()), len(seen)
                if data[i] in seen:
                    total -= math.log2(seen[data[i]] / (n + u))
                    break
                if u:
                    total -= math.log2(u / (n + u))
                out |= set(seen)
            else:
                total += math.log2(256 - len(out))
        return total


TEXTS = {"xx": ["the cat sat on the mat", "that hat\nthat the cat ate", "ämter über öl"], "yy": ["le chat est sur le tapis", "le tapis du chat — où est-il?"], "zz": ["1 2 3 1 2 3 1 2 4"]}
ASKED = ["the cat", "le chat est là", "quite unlike anything", "ß\U0001f600 the", "1 2 3", "a", "the the the tapis " * 30, ""]


@pytest.mark.parametrize("order", [1, 2, 4, 6])
def test_code_lengths(spark, docs_of, order):
    rows = [(k, t, lang) for lang, ts in TEXTS.items() for k, t in enumerate(ts)]
    df = docs_of([(k, t, "s") for k, t, _ in rows]).drop("lang").withColumnRenamed("source", "s")
    df = spark.createDataFrame([(k, t, lang) for k, t, lang in rows], "doc_id long, text string, lang string").repartition(3)
    model = langid.fit(df, order)
    assert model.langs == sorted(TEXTS)
    want = np.array([[Tree(TEXTS[lang], order).bits(t) for lang in model.langs] for t in ASKED])
    assert np.allclose(model.lengths([t.encode() for t in ASKED]), want, rtol=1e-6, atol=1e-4)
    assert np.allclose(model.own, [-math.log2(len(TEXTS[lang]) / len(rows)) for lang in model.langs])


def test_stretches_and_pieces(spark, monkeypatch):
    """How texts are cut while they are counted and scored changes nothing."""
    rng = random.Random(5)
    texts = {"aa": "".join(rng.choices("abcde é", k=3000)), "bb": "".join(rng.choices("abcdf ö", k=3000))}
    df = spark.createDataFrame([(1, texts["aa"], "aa"), (2, texts["bb"], "bb")], "doc_id long, text string, lang string")
    model = langid.fit(df)
    asked = [("".join(rng.choices("abcdefé", k=k))).encode() for k in (0, 1, 5, 700, 40)]
    want = np.array([[Tree([texts[x]], langid.ORDER).bits(t.decode()) for x in ("aa", "bb")] for t in asked])
    for stretch in (3, 50, 1 << 20):
        monkeypatch.setattr(langid, "STRETCH", stretch)
        assert np.allclose(model.lengths(asked), want, rtol=1e-6, atol=1e-4)
    shares = {"aa": 1.0, "bb": 1.0}
    whole = {(r.lang, r.key, r["count"]) for r in langid.run_counts(df, shares).collect()}
    assert whole == {(r.lang, r.key, r["count"]) for r in langid.run_counts(df, shares, piece=7).collect()}
    some = langid.run_counts(df, {"aa": 0.3, "bb": 1.0}, piece=20).groupBy("lang").sum("count").collect()
    got = {r[0]: r[1] for r in some}
    assert got["bb"] == len(texts["bb"].encode()) and 0.1 < got["aa"] / len(texts["aa"].encode()) < 0.5


def test_odd_rows(spark):
    prose = {"en": "the small birds watch the sea from the old wall and ", "fr": "les oiseaux regardent la mer depuis le vieux mur et "}
    rows = [(k, prose[x] * 3, x) for k, x in enumerate(["en", "fr"] * 20)]
    odd = [(900, None, "en"), (901, "", "fr"), (902, "123 456\n!!", "en"), (None, prose["fr"], "en"), (903, prose["en"] * 20_000, None), (904, None, "de"), (905, "é", None), (905, "é", None), (906, "١٢٣", "en"), (907, "的", None)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").selectExpr("*", "'x' AS score", "'x' AS lang_pred", "'x' AS held_out", "'x' AS key")
    got = langid.judge(df).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert r.held_out == (r.doc_id is not None and crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert all(by[k] == ("und", 0.0) for k in (900, 901, 902, 904, 906)) and by[None][0] == "fr" and by[903] == ("en", 1.0) and by[905][0] in prose and by[907][0] in prose
    assert [by[k][0] for k, _, _ in rows] == [x for _, _, x in rows]
    # Rows that are held out, and the language of any row that is told, don't matter.
    changed = df.selectExpr("doc_id", f"IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 'zz', lang) AS lang", "text")
    assert sorted(map(str, langid.judge(changed).collect())) == sorted(map(str, got))
    none = langid.judge(df.where("lang = 'nowhere' OR lang IS NULL"))
    assert {(r.lang_pred, r.score, r.bits_per_byte) for r in none.collect()} <= {("und", 0.0, None)}
    assert langid.judge(df.limit(0)).count() == 0


def test_held_out_accuracy(spark, sf):
    docs = table(spark, sf, "documents")
    told = langid.judge(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(told) > 30 and sum(r.lang == r.lang_pred for r in told) >= 0.98 * len(told)
    # A model of a fiftieth of the bytes still tells most.
    model = langid.fit(docs.where(~langid.held_out(docs.doc_id)), sample=8_000)
    small = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in small) >= 0.9 * len(small)
