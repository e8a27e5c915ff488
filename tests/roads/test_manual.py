"""Nested manuals to passages: paths, nothing lost, cuts at sentence ends."""

import json
import random

from kerbline.operators import manual


def brute(text, most):
    out = []
    while text:
        piece = text[:most]
        if len(text) > most:
            ends = [k + 2 for k in range(len(piece) - 1) if piece[k] in ".!?" and piece[k + 1] in " \n"]
            piece = piece[: max(ends)] if ends else piece
        out.append(piece)
        text = text[len(piece) :]
    return out


def test_passages(spark, tmp_path):
    rng = random.Random(2)
    say = lambda n: "".join(rng.choice(["word ", "end. ", "why? ", "é\U0001f600 ", "no stop", "!\n", ". "]) for _ in range(n))
    section = lambda k, n: {"section": str(k), "title": f"on {k}", "paragraphs": [say(n), None, say(n // 3), ""]}
    manuals = [
        {"manual": m, "parts": [{"part": f"{p}", "title": "t", "chapters": [{"chapter": f"{p}{c}", "title": None, "sections": [section(s, rng.choice([0, 2, 30, 200])) for s in range(3)]} for c in "AB"]} for p in (1, 2)]} for m in range(3)
    ] + [{"manual": 7, "parts": []}, {"manual": 8, "parts": None}, {"manual": 9, "parts": [{"part": "1", "chapters": [{"chapter": "A", "sections": [{"section": "x", "paragraphs": ["y" * 5000 + ". " + "z" * 60]}]}]}]}]
    (tmp_path / "m.json").write_text("\n".join(map(json.dumps, manuals)))
    for most in (40, 100, 8000):
        got = {}
        for r in manual.passages(manual.read_manuals(spark, f"file://{tmp_path}/m.json"), most=most).collect():
            got.setdefault((r.manual, r.path), {})[r.passage] = r.text
        want = {}
        for m in manuals:
            for p in m["parts"] or []:
                for c in p["chapters"]:
                    for s in c["sections"]:
                        body = "\n".join(x for x in s["paragraphs"] if x is not None)
                        if len(body) >= 50:
                            want[m["manual"], f"Part {p['part']} > Chapter {c['chapter']} > Section {s['section']}"] = dict(enumerate(brute(body, most), 1))
        assert got == want and len(want) > 10
        assert max(len(t) for x in got.values() for t in x.values()) <= most
