"""SimHash near-dedup with covering locality-sensitive hashing.

Fingerprint: each bit is the majority over the XXH64 values of the text's word shingles.  Candidates:
every bit position is given a non-zero vector of GF(2)^(r+1); each of the 2^(r+1)-1 non-zero vectors v
makes one mask of the positions whose vector is not orthogonal to v.  The vectors of at most r
differing bits span at most r dimensions, so some v is orthogonal to all of them: that mask drops them
all, and the pair agrees in that table.  No pair within the radius can be missed.

Only distinct fingerprints enter the tables.  A bucket is never expanded into pairs: a breadth-first
search over the fingerprints not yet reached (vectorised popcounts) emits one link per fingerprint that
joins.  A bucket beyond ``bucket_limit`` is not held in one task: its members are split again by
independent masks of the same kind (the guarantee holds at every level) until the pieces fit.  After
``max_depth`` = 3 levels they always do: the masks leave at most 15 positions free (``free_positions``), so
no bucket of the last level holds over 2^15 distinct fingerprints, however large the corpus is.
Components: alternating large-star and small-star rounds, staged.

Cases: null text counts as text without words; such texts have fingerprint zero, linked like any other.
Repeated rows and repeated ids each keep their row; the component id is the smallest non-null id
reachable (null if there is none).  A bit set in exactly half the shingles is 0.  Very long texts are hashed whole,
some shingles at a time.  An empty table gives an empty result.  Only the id and text columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, scratch, staged

BITS = 64


def fingerprint(text: str | None, words: int = 4, seed: int = 42, step: int = 1 << 15) -> int:
    """SimHash of one text as a signed 64-bit integer (``bytes.lower`` and ``bytes.split`` are ASCII-only)."""
    w = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    counts, digest, join = np.zeros(BITS, np.int64), xxhash.xxh64_digest, b" ".join
    for a in range(0, n, step):
        part = w[a:min(a + step, n) + words - 1]
        shingles = zip(*(part[j:] for j in range(words))) if len(part) >= words else [part]
        raw = b"".join([digest(s, seed) for s in map(join, shingles)])
        counts += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n).view(">i8")[0])


def masks(radius: int, seed: int, bits: int = BITS) -> list[int]:
    """2^(radius+1)-1 masks (signed) that cover every set of at most ``radius`` positions."""
    size = 1 << (radius + 1)
    # every non-zero vector gets its share of positions, so all masks keep about half of the bits
    vectors = np.resize(np.arange(1, size), bits)
    np.random.default_rng(seed).shuffle(vectors)
    out = []
    for v in range(1, size):
        keep = np.array([bin(int(x) & v).count("1") & 1 for x in vectors], np.uint8)
        out.append(int(np.packbits(keep).view(">i8")[0]))
    return out


def free_positions(radius: int, seed: int, depth: int, bits: int = BITS) -> int:
    """The most positions that ``depth`` levels of masks, one of each level, leave open: 2^this bounds a bucket."""
    free = np.array([(1 << bits) - 1], np.uint64)
    for d in range(depth):
        free = (free[:, None] & ~np.array(masks(radius, seed + d, bits), np.int64).view(np.uint64)[None, :]).ravel()
    return int(np.bitwise_count(free).max())


def _near(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected at ``radius``, at most one per value: breadth-first search."""
    left, parents, children = values, [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                found, left = left[near], left[~near]
                parents.append(np.full(len(found), x))
                children.append(found)
                queue.extend(found)
    if not parents:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(parents), np.concatenate(children)


def _search(radius: int, limit: int | None):
    """Task function over (bucket, fp) sorted by bucket: links, and the members of buckets over ``limit``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, count, heavy = None, [], 0, False

        def out(a, b, big):
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(big, pa.int64())], names=["a", "b", "big"])

        def links(runs):
            got = [_near(r.view(np.uint64), radius) for r in runs]
            a = np.concatenate([x for x, _ in got]).view(np.int64) if got else np.empty(0, np.int64)
            b = np.concatenate([y for _, y in got]).view(np.int64) if got else np.empty(0, np.int64)
            return out(a, b, np.zeros(len(a), np.int64))

        def spill(fps):
            return out(fps, np.full(len(fps), key), np.ones(len(fps), np.int64))

        for batch in batches:
            keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(keys):
                continue
            edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(keys)]])
            runs = []
            # bounds that can't hold a run of two are skipped without a Python step
            lone = (ends - starts == 1) & (starts > 0) & (ends < len(keys))
            for s, e in zip(starts[~lone], ends[~lone]):
                if keys[s] != key:
                    if not heavy and count > 1:
                        runs.append(np.concatenate(parts))
                    key, parts, count, heavy = keys[s], [], 0, False
                parts.append(fps[s:e].copy())
                count += e - s
                if limit is not None and count > limit:
                    heavy = True
                    yield spill(np.concatenate(parts))
                    parts = []
            if runs:
                yield links(runs)
        if not heavy and count > 1:
            yield links([np.concatenate(parts)])

    return run


def near_links(fps: DataFrame, *, radius: int = 4, seed: int = 11, bucket_limit: int = 20000, max_depth: int = 3) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints of ``fps`` exactly as all links would."""
    found, level = None, fps.select(F.lit(0).cast("long").alias("bucket"), F.col("fp"))
    for depth in range(max_depth):
        tables = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(m).alias("m")) for t, m in enumerate(masks(radius, seed + depth))])
        keyed = level.select("bucket", "fp", F.explode(tables).alias("x")).select(
            F.xxhash64("bucket", "x.t", F.col("fp").bitwiseAND(F.col("x.m"))).alias("key"), "fp")
        last = depth + 1 == max_depth
        got = staged(keyed.repartition("key").sortWithinPartitions("key")
                     .mapInArrow(_search(radius, None if last else bucket_limit), "a long, b long, big long"), "links")
        links = got.filter("big = 0").select("a", "b")
        found = links if found is None else found.unionByName(links)
        level = got.filter("big = 1").select(F.col("b").alias("bucket"), F.col("a").alias("fp"))
        if last or level.isEmpty():
            return found
    return found


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): smallest node reachable, for every node that has a link.  Star rounds until nothing changes."""
    with scratch(links.sparkSession) as keep:
        e = keep(_stars(links, max_rounds))
    roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _stars(links: DataFrame, max_rounds: int) -> DataFrame:
    """(a, b): every node hung on the smallest one reachable."""

    def state(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    e = staged(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = state(e)
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: every larger neighbour is hung on the smallest one of the closed neighbourhood
        e = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        e = staged(e, "edges")
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        # small star: the smaller neighbours and the node itself are hung on the smallest of them
        e = e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b") \
            .unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        e = staged(e, "edges")
        now = state(e)
        if now == seen:
            return e
        seen = now
    raise RuntimeError("components did not settle")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """One row per input row: id, fp (signed 64 bits)."""
    prepare(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words, seed) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).alias("id"), fp(F.col(text_col)).alias("fp"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                    seed: int = 42, radius: int = 4, **search) -> DataFrame:
    """One row per input row: id, fingerprint (hex), component_id."""
    rows = staged(fingerprints(docs, id_col=id_col, text_col=text_col, words=words, seed=seed), "fingerprints")
    with scratch(docs.sparkSession) as keep:
        distinct = staged(rows.groupBy("fp").agg(F.min("id").alias("low")), "distinct")
        roots = components(near_links(distinct, radius=radius, **search))
        linked = roots.join(distinct, roots["node"] == distinct["fp"]).select("fp", "root", "low")
        lows = linked.groupBy("root").agg(F.min("low").alias("component"))
        # every fingerprint with its component: those without links stay alone
        member = distinct.join(linked.join(lows, "root").select("fp", "component", F.lit(True).alias("is_linked")), "fp", "left") \
            .select("fp", F.when(F.col("is_linked"), F.col("component")).otherwise(F.col("low")).alias("component_id"))
        member = keep(staged(member, "member"))   # both sides then meet on plain exchanges: a hot fingerprint can be split
    return rows.join(member, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
