"""Periodic runs of words: tiles per period octave, boundary Z-values, fragments stitched by a shuffle.

A run is a maximal stretch of words with smallest period q and at least max(``least``, ``times`` * q) words.

The words of a text become numbers, and the text is cut into tiles: one tile where it has at most ``tile``
words; of longer texts, for each group of period octaves [P, 2P), overlapping tiles whose margins hold every
word that a boundary in the tile's core looks at.  Tiles of long texts are spread over the tasks by a
shuffle; a text of one tile is its own tile.  Each tile is solved alone: boundaries lie 2P words apart, and
for each boundary b and each period p of the octave the Z-values LCE(b, b + p) forwards and backwards, cut at
2P, give the fragment of words i with w[i] = w[i + p] around b.  (First the neighbours of all boundaries are
compared at once; only periods that survive ``PROBE`` words get the linear Z-function.)  A run of period p
has 3p such words or more in a row, so a boundary lies in it, its first and last fragments are at least 1.5P
long, and fragments of neighbouring boundaries touch.  Fragments are shuffled by (document, period), touching
ones are joined, and of runs with one place the smallest period stays (its multiples describe the same words).

Texts travel only where they hold a fragment or have several tiles.

Cases: null and empty texts have no words and no run.  Null ids count as the empty text for the tail rule.
Equal rows (same id and text) come back each with the same result.  Ties of the greatest length: smallest
start, then period.  Very long texts: a task holds one text's words once, then one tile at a time; every step is
linear in them per octave.  An empty table gives an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, scratch, staged

TILE = 1 << 15
PROBE = 16
GROUP_BYTES = 1 << 21


def _z(w: list) -> list[int]:
    """Z-function: length of the longest prefix of ``w`` that starts at each place."""
    n, left, right = len(w), 0, 0
    z = [n] + [0] * (n - 1)
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and w[k] == w[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _boundary(a: np.ndarray, b: int, octave: int, ps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Z-values of boundary ``b`` for periods ``ps`` of [octave, 2 octave): matching words from b on, and before b; at most 2 octaves."""
    cap = 2 * octave
    z = np.array(_z(a[b:b + cap + ps.max()].tolist()) + [0])
    forward = np.minimum(z[np.minimum(ps, len(z) - 1)], cap)
    before = a[max(0, b - cap):b][::-1].tolist()
    top = min(len(a), b + int(ps.max()))
    after = a[max(0, b - cap):top][::-1].tolist()                  # read backwards from the last b + p
    z = np.array([*_z([*before, None, *after]), 0])
    return forward, z[len(before) + 1 + top - b - ps]


def _extend(a: np.ndarray, left: np.ndarray, right: np.ndarray, step: int, cap: int) -> np.ndarray:
    """How far places ``left`` and ``right`` go on matching in direction ``step``, up to ``cap`` words."""
    n, length, live = len(a), np.zeros(len(left), np.int64), np.arange(len(left))
    for t in range(cap):
        i, j = left[live] + step * t, right[live] + step * t
        ok = (i >= 0) & (j < n)
        ok[ok] = a[i[ok]] == a[j[ok]]
        live = live[ok]
        if not len(live):
            break
        length[live] = t + 1
    return length


def fragments(a: np.ndarray, octave: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(p, s, e) of the tile ``a``: for periods p in [octave, 2 octave), stretches of i with a[i] = a[i + p] around the boundaries."""
    grid, n = 2 * octave, len(a)
    rows = -(-n // grid)
    wide = np.concatenate([a, np.full(rows * grid - n, -1, a.dtype)])       # numbers below 0 equal no word
    body = wide.reshape(rows, grid)
    here, before = body[:, :1], wide[grid - 1:(rows - 1) * grid:grid, None]
    ahead = np.flatnonzero((here == body[:, octave:]) & (here >= 0))                                     # w[b] = w[b + p]
    behind = np.flatnonzero((before == body[1:, octave - 1:grid - 1]) & (before >= 0)) + octave          # w[b - 1] = w[b + p - 1]
    cells = np.union1d(ahead, behind)
    b, p = cells // octave * grid, cells % octave + octave
    probe = min(PROBE, grid)
    forward, backward = _extend(a, b, b + p, 1, probe), _extend(a, b - 1, b + p - 1, -1, probe)
    # every wanted fragment has 1.5 octaves on one side
    far = np.maximum(forward, backward) >= min(probe, -(-3 * octave // 2))
    b, p, forward, backward = b[far], p[far], forward[far], backward[far]
    if grid > probe and len(b):
        cuts = np.flatnonzero(np.diff(b)) + 1
        got = [_boundary(a, int(x[0]), octave, y) for x, y in zip(np.split(b, cuts), np.split(p, cuts))]
        forward, backward = (np.concatenate([g[k] for g in got]) for k in (0, 1))
        far = np.maximum(forward, backward) >= -(-3 * octave // 2)
        b, p, forward, backward = b[far], p[far], forward[far], backward[far]
    return p, b - backward, b + forward


def merged(p: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Touching stretches of one period joined."""
    if not len(p):
        return p, s, e
    order = np.lexsort((s, p))
    p, s, e = p[order], s[order], e[order]
    # running end within a period: periods are lifted apart by more than any place
    lift = p * (int(e.max()) + 1)
    top = np.maximum.accumulate(e + lift)
    new = np.concatenate([[True], s[1:] + lift[1:] > top[:-1]])
    at = np.flatnonzero(new)
    return p[at], s[at], np.maximum.reduceat(e, at)


def _solve(a: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragments of one tile for the octaves from ``low`` to ``high``, touching ones joined."""
    parts, octave = [], low
    while octave <= high:
        parts.append(fragments(a, octave))
        octave *= 2
    return merged(*(np.concatenate([x[k] for x in parts]) for k in range(3)))


def tiles(n: int, tile: int, times: int) -> list[tuple[int, int, int, int]]:
    """(first octave, last octave, from, to) of the tiles of a text of ``n`` words, more than ``tile``.

    Octaves up to tile / 16 share tiles of that core; each higher one has cores of 16 octaves.  Margins are two
    octaves before the core and four after it; cores are whole multiples of the boundaries' distance."""
    out, low, high = [], 1, max(1, tile // 16)
    while low * times <= n:
        core = max(tile, 16 * high)
        out += [(low, high, max(0, c - 2 * high), min(n, c + core + 4 * high)) for c in range(0, n, core)]
        low = high = 2 * high
    return out


def _flat(rows: list, names: list[str], types: list) -> pa.Array:
    """List of tuples per row as an Arrow list of structs."""
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    fields = [pa.array([x[k] for r in rows for x in r], t) for k, t in enumerate(types)]
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, names))


def _cut(tail, tile: int, least: int, times: int):
    """Task function: number the words, solve texts of one tile, cut the others into tiles."""

    def group(ids: list, numbers: list, texts: list) -> pa.RecordBatch:
        words = [(t or b"").split() for t in texts]
        if tail is not None:
            for k, w in enumerate(words):
                at = tail(ids[k], len(w))
                if at is not None:
                    start, period = at
                    w[start:] = (w[start:start + period] * (-(-(len(w) - start) // period)))[:len(w) - start]
        sizes = np.array([len(w) for w in words])
        codes = pa.array([x for w in words for x in w], pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        spread, offsets = int(codes.max(initial=0)) + 1, np.concatenate([[0], np.cumsum(sizes)])
        frags: list[list] = [[] for _ in words]
        cut: list[list] = [[] for _ in words]
        for k in np.flatnonzero(sizes > tile):
            a = codes[offsets[k]:offsets[k + 1]].astype(np.int32)
            cut[k] = [(lo, hi, x, a[x:y].tobytes()) for lo, hi, x, y in tiles(len(a), tile, times)]
        short = [k for k in np.argsort(-sizes, kind="stable") if sizes[k] <= tile and sizes[k] >= max(least, times)]
        if short:
            # longest first, so an octave works on a prefix; a number of its own between two texts
            own = np.concatenate([np.append(codes[offsets[k]:offsets[k + 1]] + np.int64(k) * spread, -2 - k) for k in short])
            ends = np.cumsum(sizes[short] + 1)
            octave = 1
            while (live := int(np.searchsorted(-sizes[short], -octave * times, side="right"))):
                p, s, e = merged(*fragments(own[:ends[live - 1]], octave))
                full = (e - s >= (times - 1) * p) & (e - s + p >= least)
                for q, x, y in zip(p[full].tolist(), s[full].tolist(), e[full].tolist()):
                    j = int(np.searchsorted(ends, x, side="right"))
                    base = int(ends[j - 1]) if j else 0
                    frags[short[j]].append((q, x - base, y - base))
                octave *= 2
        joined = [b" ".join(w) for w in words]
        held = [bool(f or c) for f, c in zip(frags, cut)]
        return pa.RecordBatch.from_arrays([
            pa.array(numbers, pa.int64()), pa.array(sizes, pa.int64()),
            pa.array([None if h else hashlib.sha256(j).hexdigest() for h, j in zip(held, joined)], pa.string()),
            pa.array([j if h else None for h, j in zip(held, joined)], pa.binary()).cast(pa.string()),
            _flat(frags, ["p", "s", "e"], [pa.int32(), pa.int64(), pa.int64()]),
            _flat(cut, ["low", "high", "at", "words"], [pa.int32(), pa.int32(), pa.int64(), pa.binary()]),
        ], names=["t", "n_words", "sha", "words", "frags", "tiles"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers, texts = batch.column(0), batch.column(1), batch.column(2).cast(pa.binary())
            at = 0
            while at < len(texts):
                start, held = at, 0
                while at < len(texts) and held < GROUP_BYTES:
                    held += len(texts[at].as_buffer() or b"") if texts[at].is_valid else 0
                    at += 1
                out = group(ids.slice(start, at - start).to_pylist(), numbers.slice(start, at - start).to_pylist(),
                            texts.slice(start, at - start).to_pylist())
                yield pa.RecordBatch.from_arrays([ids.slice(start, at - start), *out.columns], names=["id", *out.schema.names])

    return run


def _solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: rows (id, t, low, high, at, words) of tiles to rows (id, t, p, s, e) of fragments."""
    for batch in batches:
        for k in range(len(batch)):
            low, high, at = (batch.column(c)[k].as_py() for c in ("low", "high", "at"))
            p, s, e = _solve(np.frombuffer(batch.column("words")[k].as_buffer(), np.int32), low, high)
            if len(p):
                own = pa.array(np.full(len(p), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(own), batch.column("t").take(own), pa.array(p, pa.int32()),
                    pa.array(s + at, pa.int64()), pa.array(e + at, pa.int64())], names=["id", "t", "p", "s", "e"])


def stitched(frags: DataFrame, least: int, times: int) -> DataFrame:
    """(id, t, runs): the runs of each document by start and period, from its fragments (id, t, p, s, e)."""
    by = Window.partitionBy("id", "t", "p").orderBy("s", "e")
    reach = F.max("e").over(by.rowsBetween(Window.unboundedPreceding, -1))
    islands = (frags.distinct().withColumn("new", F.coalesce(F.col("s") > reach, F.lit(True)).cast("int"))
               .withColumn("island", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
               .groupBy("id", "t", "p", "island").agg(F.min("s").alias("start"), (F.max("e") - F.min("s") + F.col("p")).alias("length")))
    full = islands.filter((F.col("length") >= times * F.col("p")) & (F.col("length") >= least))
    return (full.groupBy("id", "t", "start", "length").agg(F.min("p").cast("long").alias("period"))
            .groupBy("id", "t").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs")))


@F.pandas_udf(T.StringType())
def _collapsed(words: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    """The words outside all [start, end), joined by one space."""
    def one(w: str, xs, ys) -> str:
        w = w.split(" ")
        depth = np.zeros(len(w) + 1, np.int64)
        np.add.at(depth, np.asarray(xs, np.int64), 1)
        np.add.at(depth, np.asarray(ys, np.int64), -1)
        return " ".join([x for x, d in zip(w, np.cumsum(depth).tolist()) if not d])
    return pd.Series([None if w is None else one(w, x, y) for w, x, y in zip(words, starts, ends)])


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 6, times: int = 4,
                  tile: int = TILE, tail=None) -> DataFrame:
    """One row per row: id, n_words, runs (start, period, length; by start, then period), collapsed, collapsed_sha256.

    ``collapsed``: the words that no run holds after its first period, joined by one space (null without a run: all
    stay).  ``tail(id, n)`` may name (start, period): from that word on the text repeats its first ``period`` words."""
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("t"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    with scratch(spark) as keep:
        cut = keep(staged(rows.mapInArrow(_cut(tail, tile, least, times), f"id {kind}, t long, n_words long, sha string, words string, "
                          f"frags array<struct<p: int, s: long, e: long>>, tiles array<struct<low: int, high: int, at: long, words: binary>>"), "cut"))
        spread = cut.select("id", "t", F.explode("tiles").alias("x")).select("id", "t", "x.*").repartition("id", "t", "low", "at")
        solved = spread.mapInArrow(_solve_tiles, f"id {kind}, t long, p int, s long, e long")
        frags = cut.select("id", "t", F.explode("frags").alias("x")).select("id", "t", "x.*").unionByName(solved)
        found = keep(staged(stitched(frags, least, times).select(F.col("id").alias("r_id"), F.col("t").alias("r_t"), "runs"), "runs"))
    none = F.array().cast("array<struct<start: bigint, period: bigint, length: bigint>>")
    quiet = cut.filter(F.col("words").isNull()).select("id", "n_words", none.alias("runs"), F.lit(None).cast("string").alias("collapsed"), "sha")
    met = cut.filter(F.col("words").isNotNull()).select("id", "t", "n_words", "words").join(
        found, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("t") == F.col("r_t")), "left").withColumn("runs", F.coalesce("runs", none))
    left = _collapsed("words", F.transform("runs", lambda r: r["start"] + r["period"]), F.transform("runs", lambda r: r["start"] + r["length"]))
    told = met.withColumn("collapsed", F.when(F.size("runs") > 0, left))
    busy = told.select("id", "n_words", "runs", "collapsed",
                       F.sha2(F.coalesce("collapsed", "words").cast("binary"), 256).alias("sha"))
    return quiet.unionByName(busy).select(F.col("id").alias(id_col), "n_words", "runs", "collapsed", F.col("sha").alias("collapsed_sha256"))
