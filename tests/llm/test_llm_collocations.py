"""Collocations against a brute-force count, also with fingerprints so short that most of them collide."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm_edge import edge, no_rows  # noqa: F401
from scorewright.llm import collocations as C


def brute(rows, upto=3, least=10, absorb=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang, low = lang or "und", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, upto + 1):
                f.update((lang, " ".join(ws[i:i + k])) for i in range(len(ws) - k + 1))
    cand = {}
    for (lang, ph), a in f.items():
        ws = ph.split(" ")
        if len(ws) > 1 and a >= least:
            cuts = [(10**6 * a * a // (f[lang, " ".join(ws[:k])] * f[lang, " ".join(ws[k:])]), k) for k in range(1, len(ws))]
            score, k = min(cuts)
            cand[lang, ph] = (a, f[lang, " ".join(ws[:k])], f[lang, " ".join(ws[k:])], score)
    gone = set()
    for (lang, ph), (a, *_) in cand.items():
        ws = ph.split(" ")
        for k in range(2, len(ws)):
            for i in range(len(ws) - k + 1):
                inner = (lang, " ".join(ws[i:i + k]))
                if 100 * a >= absorb * cand[inner][0]:
                    gone.add(inner)
    out = []
    for lang in n:
        mine = sorted(((-s, -a, ph.encode(), ph, a, x, y) for (g, ph), (a, x, y, s) in cand.items() if g == lang and (g, ph) not in gone))
        out += [(lang, i, ph, a, x, y, n[lang], -s) for i, (s, _, _, ph, a, x, y) in enumerate(mine[:top], 1)]
    return sorted(out)


def got(df, **kw):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in C.collocations(df, **kw).collect())


def texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "cat", "sat", "é", "中", "a", "b", "on", "mat"]
    sep = [" ", " ", " ", "\t", "  ", ", ", ". ", "\n", "\x1c"]
    return [(rng.choice(["en", "fr", None, "und"]), "".join(rng.choice(words) + rng.choice(sep) for _ in range(rng.randint(0, 40)))) for _ in range(n)]


@pytest.mark.parametrize("kw", [{}, {"fp_bits": 5, "filter_bits": 1 << 10}, {"fp_bits": 12, "filter_bits": 64}, {"max_words": 4, "least": 5, "top": 7},
                                {"absorb_percent": 90, "least": 3}])
def test_random_texts(spark, kw):
    rows = texts(len(kw), 120)
    df = spark.createDataFrame([(i, g, t) for i, (g, t) in enumerate(rows)], "doc_id long, lang string, text string").repartition(5)
    want = brute(rows, kw.get("max_words", 3), kw.get("least", 10), kw.get("absorb_percent", 50), kw.get("top", 2000))
    assert want and got(df, **kw) == want


def test_edge_rows(edge):
    rows = [(r["lang"], r["text"]) for r in edge.collect()]
    assert got(edge, least=2) == brute(rows, least=2)


def test_empty_table(no_rows):
    assert C.collocations(no_rows).count() == 0


@pytest.mark.parametrize("block", [1, 7, 1 << 16])
def test_fingerprints_are_those_of_the_words(monkeypatch, block):
    """Equal phrases of one language have equal fingerprints and check values, in whatever block, place and spacing; others differ."""
    monkeypatch.setattr(C, "BLOCK", block)
    rows = texts(9, 60)
    data, offsets = C._buffers(pa.array([t for _, t in rows]))
    seen, back, count = {}, {}, Counter()
    for first, n, start, end, text, grams in C.ngrams(data, offsets, C._salts([g for g, _ in rows]), 3):
        for k, (fp, check, valid) in enumerate(grams, 1):
            for i in np.flatnonzero(valid).tolist():
                key = (rows[text[first + i]][0] or "und", C._phrase(data, start, end, first + i, k))
                own = (int(fp[i]), int(check[i]))
                assert seen.setdefault(key, own) == own and back.setdefault(own, key) == key
                count[key] += 1
    want = Counter()
    for lang, t in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if "A" <= c <= "Z" else c for c in t)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                want.update((lang or "und", " ".join(ws[i:i + k])) for i in range(len(ws) - k + 1))
    assert count == want
