"""Periodic runs against a brute-force search over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from llm_edge import edge, no_rows  # noqa: F401
from scorewright.llm import periodic
from scorewright.llm.common import documents
from scorewright.llm.queries import op12_periodic_runs, planted_tail

SF001 = "/root/testdata/sf0.001"


def brute(words, least=6, times=4):
    """(start, length, period) of every run: each period's maximal stretches, smallest period of a place kept."""
    codes = {w: k for k, w in enumerate(dict.fromkeys(words))}
    a, found = np.array([codes[w] for w in words], np.int64), {}
    for p in range(1, len(words) // times + 1):
        same = np.concatenate([[0], a[:-p] == a[p:], [0]]).astype(np.int8)
        step = np.diff(same)
        for s, e in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1)):
            n = int(e - s + p)
            if n >= max(least, times * p):
                found.setdefault((int(s), n), p)
    return sorted((s, n, p) for (s, n), p in found.items())


def collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def random_words(rng):
    out = []
    while len(out) < rng.choice([5, 40, 300]):
        unit = [rng.choice("abcd") for _ in range(rng.randint(1, 20))]
        out += unit * rng.choice([1, 1, 2, 4, 5, 9]) + unit[:rng.randint(0, len(unit))]
    return out


@pytest.mark.parametrize("tile", [16, 64, 1 << 15])
def test_random_texts_in_every_tiling(spark, tile):
    """Also texts of one letter, and long ones whose runs pass many tiles."""
    rng = random.Random(tile)
    texts = [random_words(rng) for _ in range(120)] + [["a"] * n for n in (0, 1, 5, 6, 7, 100, 700)] + [["a", "b"] * 3, ["a", "b"] * 4]
    unit = [str(rng.randint(0, 30)) for _ in range(150)]
    texts += [random_words(rng) + unit * 5 + random_words(rng), ["x", "y", "z"] * 400 + ["x"] + unit * 4]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in periodic.periodic_runs(df, tile=tile).collect()}
    assert len(got) == len(texts)
    for i, w in enumerate(texts):
        runs = brute(w)
        assert [(r["start"], r["length"], r["period"]) for r in got[i]["runs"]] == runs
        left = collapsed(w, runs)
        assert got[i]["n_words"] == len(w) and got[i]["collapsed"] == (left if runs else None)
        assert got[i]["collapsed_sha256"] == hashlib.sha256(left.encode()).hexdigest()


def test_z_values_of_boundaries():
    rng = random.Random(3)
    for _ in range(60):
        a = np.array([rng.randint(0, 1) for _ in range(rng.randint(40, 120))])
        octave, cap = 8, 16
        for b in range(0, len(a), cap):
            ps = np.array([p for p in range(octave, 2 * octave) if b + p <= len(a)])
            if len(ps):
                f, g = periodic._boundary(a, b, octave, ps)
                for p, x, y in zip(ps, f, g):
                    up = next((t for t in range(cap) if b + p + t >= len(a) or a[b + t] != a[b + p + t]), cap)
                    down = next((t for t in range(cap) if b - 1 - t < 0 or a[b - 1 - t] != a[b + p - 1 - t]), cap)
                    assert (x, y) == (up, down)


def expected(doc_id, text):
    words = split(text)
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    s, n, p = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{x},{y},{z}\n" for x, y, z in sorted(runs, key=lambda r: (r[0], r[2])))
    return (len(runs), s, n, p, None if s is None else 1000 * n // p, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(collapsed(words, runs).encode()).hexdigest())


def test_query_over_a_whole_table(spark):
    rows = {r["doc_id"]: r["text"] for r in documents(spark, SF001).collect()}
    got = op12_periodic_runs(spark, SF001).collect()
    assert len(got) == len(rows) and any(r["n_runs"] for r in got)
    for r in got:
        assert tuple(r[1:]) == expected(r["doc_id"], rows[r["doc_id"]])


def test_edge_rows(spark, edge, tmp_dir):
    edge.write.parquet(f"{tmp_dir}/documents.parquet")
    got = sorted((tuple(r) for r in op12_periodic_runs(spark, tmp_dir).collect()), key=str)
    assert got == sorted(((r["doc_id"], *expected(r["doc_id"], r["text"])) for r in edge.collect()), key=str)


def test_empty_table(no_rows):
    assert periodic.periodic_runs(no_rows).count() == 0


def test_tail_rule():
    assert planted_tail(1, 0) is None
    ids = [i for i in range(2000) if planted_tail(i, 50)]
    assert 100 < len(ids) < 300
