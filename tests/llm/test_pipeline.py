"""The pipeline's stages, each against a brute-force version of its own on a small fixture."""

import hashlib
import math
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

from kerbline.llm.tokens import default_path

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))
import corpus_pipeline  # noqa: E402
import test_jaccard  # noqa: E402
import test_mixing  # noqa: E402
import test_quality  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, docs_of, prose, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    rng = random.Random(17)
    words = sorted({w for t in prose for w in t.split()})
    docs = [(k, " ".join(rng.choices(words, k=40 + k)), f"s{k % 3}") for k in range(40)]
    docs += [(100 + k, docs[k][1] + " changed", f"s{k % 2}") for k in range(8)]
    docs += [(200 + k, f"{prose[1]} {prose[2]} same", "s1") for k in range(9)] + [(300, "too short", "s0"), (301, None, None)]
    docs += [(400, f"before it {' '.join(prose[2].split()[:3])} benchmark line that nobody should learn by heart at all costs tonight after all the rest of this", "s2")]
    docs_of(docs).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, "benchmark line that nobody should learn by heart at all costs tonight")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), docs


def mixed_whole(docs):
    """(doc_id, text) -> how often the mixing stage takes a document, whole."""
    size = lambda t: len((t or "").split())
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += size(t)
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(s for s in sizes if s is not None))} | ({None: (5, 2, 1)[(len(sizes) - 1) % 3]} if None in sizes else {})
    goal = test_mixing.fill(sizes, weights, {s: 3 * n for s, n in sizes.items()})
    out = Counter()
    for s in sizes:
        epochs = math.floor(goal[s] / sizes[s])
        rest = math.floor(goal[s] - epochs * sizes[s])
        mine = []
        for d, t, x in docs:
            if x == s and size(t):
                weight = 1 / (1 + 50 * sum(t.count(c) for c in "#*$%&|<>") / len(t))
                u = (int(hashlib.md5(f"0:{d}".encode()).hexdigest()[:13], 16) + 1) / 2**52
                mine.append((-math.log(u) / weight, d, t))
        for _, d, t in sorted(mine):
            part = min(size(t), max(0, rest))
            rest -= size(t)
            out[d, t] += epochs + (2 * part >= size(t) and part > 0)
    return out


def test_stages(spark, folder):
    d, docs = folder
    have = docs
    df = spark.read.parquet(f"{d}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        df = stage(spark, df, d)
        rows = df.collect()
        if k < 4:
            assert df.columns == COLUMNS
        if k == 0:
            want = Counter(x[0] for x, n in test_quality.brute(have).items() for _ in range(n) if x[-1])
        elif k == 1:
            want = Counter({c for _, c, _ in test_jaccard.brute(have)})
        elif k == 2:
            want = Counter(x[0] for x in have if x[0] != 400)
            assert any(x[0] == 400 for x in have)
        elif k == 3:
            taken = mixed_whole(have)
            assert Counter((r.doc_id, r.text) for r in rows) == +taken
            want = Counter()
            for (doc, _), n in taken.items():
                want[doc] += n
            want = +want
        else:
            tokenizer = Tokenizer.from_file(default_path())
            ids = lambda t: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
            assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter((x, len(ids(t)), zlib.crc32(ids(t).tobytes())) for x, t, _ in have)
            want = Counter(x[0] for x in have)
        assert Counter(r.doc_id for r in rows) == want, name
        if k < 4:
            have = [(r.doc_id, r.text, r.source) for r in rows]
            df = spark.createDataFrame(rows, df.schema)
    assert len(corpus_pipeline.STAGES) == 5 and len(have) > 20


def test_run(spark, folder):
    d, _ = folder
    rows = corpus_pipeline.run(spark, d).orderBy("start").collect()
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids) and not {300, 301, 400} & set(ids) and 200 in ids and 201 not in ids


def test_mixing_leaves_documents_whole(spark, docs_of):
    """Texts come as they went in, also where rows without id tie, and each source is near its target."""
    docs = [(k, f"one  two\tthree {'four ' * (k % 9)}\nend", f"s{k % 5}") for k in range(60)] + [(None, f"a  b c d{k}", "s1") for k in range(50)]
    df = docs_of(docs)
    rows = corpus_pipeline.source_mixing(spark, df, "").collect()
    assert {(r.doc_id, r.text, r.source) for r in rows} <= set(docs) and max(Counter((r.doc_id, r.text) for r in rows).values()) <= 3
    goal = {r.source: r.mix_target for r in corpus_pipeline.mixing.mix(df).collect()}
    for s, target in goal.items():
        most = max(len(t.split()) for _, t, x in docs if x == s)
        assert abs(sum(len(r.text.split()) for r in rows if r.source == s) - target) <= most / 2 + 1
