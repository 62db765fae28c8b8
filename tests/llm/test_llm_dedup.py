"""Exact dedup and SimHash near-dedup against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from llm_edge import edge, no_rows  # noqa: F401
from scorewright.llm import blocknames, simhash
from scorewright.llm.common import documents
from scorewright.llm.queries import op6_block_naming, op10_covering_simhash


def exact_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return groups


def check_exact(rows, got):
    groups = exact_groups(rows)
    assert len(got) == len(rows)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = Counter()
    for r in got:
        ids = by_hash[r["text_sha256"]]
        top = max((i for i in ids if i is not None), default=None)
        assert (r["keep_id"], r["group_size"]) == (top, len(ids))
        assert not r["kept"] or r["doc_id"] == top
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) <= {1} and len(kept) == len(groups)


@pytest.mark.parametrize("sizes", [{}, {"block": 16, "segment_bytes": 2000, "segment_rows": 3}])
def test_exact_edge(edge, sizes):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    check_exact(rows, blocknames.duplicates(edge, **sizes).collect())


def test_exact_copies_that_differ_in_one_block(spark):
    """Equal blocks in other orders, prefixes of each other, one changed byte: all different texts."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab") * 8 for _ in range(rng.randint(0, 9))) for _ in range(120)]
    texts += [t[:-1] + "c" for t in texts[:20] if t] + texts[:30]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check_exact(rows, blocknames.duplicates(df, block=8, segment_rows=10).collect())


def test_exact_empty(no_rows):
    assert blocknames.duplicates(no_rows).count() == 0


def test_exact_whole_table(spark):
    d = "/root/testdata/sf0.001"
    check_exact([(r["doc_id"], r["text"]) for r in documents(spark, d).collect()], op6_block_naming(spark, d).collect())


def brute_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids, radius=4):
    f, parent = np.array(fps, np.uint64), list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= radius):
            a, b = find(i), find(int(j))
            if a != b:
                parent[a] = b
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(ids))]


def check_near(rows, got):
    fps = [brute_fingerprint(t) for _, t in rows]
    comps = brute_components(fps, [i for i, _ in rows])
    expected = Counter((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, comps))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == expected


def test_near_edge(edge):
    check_near([(r["doc_id"], r["text"]) for r in edge.collect()], simhash.near_duplicates(edge).collect())


def test_near_empty(no_rows):
    assert simhash.near_duplicates(no_rows).count() == 0


def test_near_whole_table(spark):
    d = "/root/testdata/sf0.001"
    check_near([(r["doc_id"], r["text"]) for r in documents(spark, d).collect()], op10_covering_simhash(spark, d).collect())


def test_masks_cover_every_pair_within_the_radius():
    masks = [m & (1 << 64) - 1 for m in simhash.masks(4, 11)]
    assert len(masks) == 31
    rng = random.Random(1)
    for _ in range(20_000):
        bits = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
        assert any(bits & m == 0 for m in masks)


def test_buckets_of_the_last_level_are_bounded():
    assert [simhash.free_positions(4, 11, depth) for depth in (1, 2, 3)] == [32, 22, 15]


@pytest.mark.parametrize("limit", [20_000, 5])
def test_links_of_dense_and_random_fingerprints(spark, limit):
    """Dense balls, chains of four-bit steps and noise; with a tiny bucket limit, members split by further masks."""
    rng = random.Random(2)
    fps = {rng.getrandbits(64) for _ in range(200)}
    for _ in range(4):
        at = rng.getrandbits(64)
        for _ in range(60):
            fps.add(at ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
        for _ in range(30):
            at ^= sum(1 << b for b in rng.sample(range(64), 4))
            fps.add(at)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.near_links(df, bucket_limit=limit)).collect()}
    expected = brute_components(fps, list(range(len(fps))))
    assert [len({expected[i] for i, s in enumerate(signed) if roots.get(s, s) == root}) for root in {roots.get(s, s) for s in signed}].count(1) == \
        len({roots.get(s, s) for s in signed}) == len(set(expected))
