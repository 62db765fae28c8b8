"""Phrase collocations: Rabin-Karp fingerprints of n-grams, counted by a shuffle, verified against the text.

Texts are lower-cased (A-Z) and cut into pieces and words on their bytes.  Prefix polynomials in numpy hash every
word (over its bytes) and every n-gram (over its words' hashes) modulo 2^64, and once more modulo the prime
2^31 - 1 as a check value.

Most n-grams occur once or twice.  So a first shuffle per length carries only 44 bits of each fingerprint (4 bytes
in one of 4,096 rows, each value at most ``least`` times a chunk of text) and finds the keys that occur ``least`` times;
of a phrase of k words it carries only those whose two parts of k - 1 words are that frequent.  Frequent keys set
bits in a table of ``filter_bits`` bits (16 MB at any corpus size), which travels to the tasks: it lets some rare
phrases pass, which their count removes, and never stops a frequent one.

Then each task combines equal fingerprints and sends (fingerprint, check, count, occurrence pointer) of those that
pass; a pointer is the hash of a document's id and text, where the fingerprint is found again by the same hashing.
The shuffle adds the counts and keeps the least and greatest check value and pointer.  One whose check values
differ holds several phrases, and so does one whose two pointers show different texts: those few are counted anew
by their text.  Only fingerprints of ``least`` occurrences or more ever become text.

Scores: cutting a candidate after its first k words gives l and r, the counts of both parts, and
floor(1000000 a a / (l r)); the lowest counts, ties to the smallest k.  A candidate inside a longer candidate that
occurs at least ``absorb_percent`` percent as often is dropped.  Arithmetic is in decimals of 38 digits (exact for
counts below 10^15).  Parts that stand for at least 1/65,536 of all words (so 65,536 a length and language at most)
are looked up by broadcast, the others by a shuffle in which no part can be hot.

Cases: a null text counts as empty; a null language is ``und``.  Equal rows count each.  Null ids are fine (the
pointer is a hash of id and text).  Ties: score, then count, descending, then phrase in byte order.  Very long
texts are hashed in blocks of ``BLOCK`` words, whatever a word's length.  Corpora far beyond 1 TB need more than
4,096 rows of keys: raise ``KEY_BITS``.  An empty table gives an empty result.  Only the
id, text and language columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, scratch, staged

BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0xD1342543DE82EF95)
PRIME = (1 << 31) - 1
CHECK_BASE, CHECK_WORD_BASE = 911_382_323, 972_663_749
BLOCK = 1 << 16
CHUNK = 2 << 20
COMBINE = 2 << 20
KEY_BITS = 44
FILTER_BITS = 1 << 27
FILTER_PART = 1 << 20
HEAVY = 65_536
UND = "und"

_CLASS = np.zeros(256, np.uint8)                 # 0: of a word, 1: between words, 2: between pieces
_CLASS[[0x20, 0x09]] = 1
_CLASS[list(b".,;:!?\n\x0b\x0c\r")] = 2
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32


class _Powers:
    """Powers of a base and of its inverse modulo 2^64, and of another modulo the prime, as far as needed."""

    def __init__(self, base: np.uint64, check_base: int):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.check_base, self.check_inverse = check_base, pow(check_base, -1, PRIME)
        self.size = 0

    def upto(self, n: int) -> None:
        if n <= self.size:
            return
        n = max(n, 2 * self.size, 1 << 12)

        def wrap(b):
            out = np.full(n, b, np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        def mod(b):
            out, m = np.ones(n, np.int64), 1
            while m < n:
                k = min(m, n - m)
                out[m:m + k] = out[:k] * pow(b, m, PRIME) % PRIME
                m += k
            return out

        self.up, self.down, self.check_up, self.check_down = wrap(self.base), wrap(self.inverse), mod(self.check_base), mod(self.check_inverse)
        self.size = n

    def prefixes(self, values: np.ndarray, checks: np.ndarray | None) -> tuple:
        """Prefix polynomials over ``values`` modulo 2^64 and over ``checks`` modulo the prime."""
        n = len(values)
        self.upto(n + 1)
        h = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.up[:n], out=h[1:])
        if checks is None:
            return h, None
        c = np.zeros(n + 1, np.int64)
        np.cumsum(checks * self.check_up[:n] % PRIME, out=c[1:])
        return h, c

    def between(self, prefix: tuple, start: np.ndarray, end: np.ndarray) -> tuple:
        """Hash and check value of each range [start, end)."""
        h, c = prefix
        return (h[end] - h[start]) * self.down[start], None if c is None else (c[end] - c[start]) % PRIME * self.check_down[start] % PRIME

    def ranges(self, values: np.ndarray, checks: np.ndarray | None, start: np.ndarray, end: np.ndarray) -> tuple:
        return self.between(self.prefixes(values, checks), start, end)


_BYTES, _WORDS = _Powers(BASE, CHECK_BASE), _Powers(WORD_BASE, CHECK_WORD_BASE)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, piece, text) of each word in ``data``, the texts' bytes end to end; equal pieces are one."""
    kind = _CLASS[data]
    inside = kind == 0
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(data))])
    begin[cut[inside[cut]]] = True                # two texts meet without a blank between them
    stop[cut[inside[cut - 1]] - 1] = True
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    text = np.searchsorted(offsets, start, side="right") - 1
    return start, end, np.cumsum(kind == 2, dtype=np.int32)[start] + text if len(start) else start, text


def ngrams(data: np.ndarray, offsets: np.ndarray, salt: np.ndarray, upto: int, bits: int = 64, checks: bool = True) -> Iterator[tuple]:
    """Blocks (first word, words, starts, ends and texts of all words, [(fingerprint, check, valid)] of lengths 1 to ``upto``).

    ``salt``: a number per text, the same for texts of one language.  ``valid[i]``: words i to i + k - 1 are one phrase."""
    start, end, piece, text = word_places(data, offsets)
    for first in range(0, len(start), BLOCK):
        last = min(len(start), first + BLOCK)
        far = min(len(start), last + upto - 1)
        origin = start[first]
        raw = _FOLD[data[origin:end[far - 1]]]
        s, e = start[first:far] - origin, end[first:far] - origin
        h, c = _BYTES.ranges(raw.astype(np.uint64) + np.uint64(1), raw.astype(np.int64) + 1 if checks else None, s, e)
        h, c, n = _mix(h + (e - s).astype(np.uint64)), (c + (e - s)) % PRIME if checks else None, last - first
        at = np.arange(far - first + 1)
        prefix, seed, out = _WORDS.prefixes(h, c), salt[text[first:last]].astype(np.uint64), []
        for k in range(1, upto + 1):
            m = min(n, max(0, far - first - k + 1))
            fp, check = _WORDS.between(prefix, at[:m], at[k:m + k])
            fp = _mix(fp ^ (seed[:m] * np.uint64(0x94D049BB133111EB) + np.uint64(k)))
            if bits < 64:
                fp &= ~np.uint64((1 << (64 - bits)) - 1)
            out.append((fp, (check + seed[:m].astype(np.int64)) % PRIME if checks else None, piece[first:first + m] == piece[first + k - 1:first + k - 1 + m]))
        yield first, n, start, end, text, out


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _salts(langs: list) -> np.ndarray:
    return np.array([zlib.crc32((x or UND).encode()) for x in langs], np.int64)


def _combined(rows: list[tuple]) -> tuple:
    """Equal (length, fingerprint, check) of the rows' arrays as one, with one of their pointers."""
    k, fp, check, pointer, count = (np.concatenate([r[c] for r in rows]) for c in range(5))
    order = np.lexsort((check, fp, k)) if len(fp) else np.zeros(0, np.int64)
    k, fp, check, pointer, count = k[order], fp[order], check[order], pointer[order], count[order]
    at = np.flatnonzero(np.concatenate([[True], (fp[1:] != fp[:-1]) | (check[1:] != check[:-1]) | (k[1:] != k[:-1])])) if len(fp) else order
    return k[at], fp[at], check[at], pointer[at], np.add.reduceat(count, at) if len(at) else count


def _passes(table: np.ndarray, fp: np.ndarray) -> np.ndarray:
    bit = (fp >> np.uint64(64 - KEY_BITS)) & np.uint64(len(table) * 8 - 1)
    return (table[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``CHUNK`` bytes of text (one text at least)."""
    for batch in batches:
        _, offsets = _buffers(batch.column("text"))
        at = 0
        while at < len(batch):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def _keys(length: int, table, bits: int, least: int):
    """Task function: (part, keys): the first ``KEY_BITS`` bits of a chunk's fingerprints of ``length`` words, each up to ``least``
    times, 4 bytes each in the row of its first bits.  ``table``: broadcast bits of the frequent parts, where they are known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if table is None else np.frombuffer(table.value, np.uint8)
        for batch in _chunks(batches):
            data, offsets = _buffers(batch.column("text"))
            found = []
            for *_, grams in ngrams(data, offsets, _salts(batch.column("lang").to_pylist()), length, bits, checks=False):
                fp, _, valid = grams[length - 1]
                if known is not None:
                    part = grams[length - 2][0]
                    hit, rest = _passes(known, part[:len(fp)]), _passes(known, part[1:len(fp) + 1])
                    hit[:len(rest)] &= rest              # a last part past the block's end is not looked up
                    valid = valid & hit
                found.append(fp[valid] >> np.uint64(64 - KEY_BITS))
            if not found:
                continue
            key = np.sort(np.concatenate(found))
            # the (least + 1)th equal one and all after it add nothing
            key = key[np.concatenate([np.ones(min(least, len(key)), bool), key[least:] != key[:-least]])]
            part = (key >> np.uint64(32)).astype(np.int32)
            at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(key) else np.zeros(0, np.int64)
            ends = (np.append(at, len(key)) * 4).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part[at]), pa.Array.from_buffers(
                pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer((key & np.uint64(0xFFFFFFFF)).astype(np.uint32))])], names=["part", "keys"])

    return run


def _often(least: int):
    """Group function: the keys of one part that occur ``least`` times or more, as fingerprints whose other bits are 0."""

    def pick(key: tuple, rows: pa.Table) -> pa.Table:
        values = np.sort(np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in rows.column("keys")]))
        n = max(0, len(values) - least + 1)
        often = np.unique(values[:n][values[:n] == values[len(values) - n:]]).astype(np.uint64)
        fp = (often | np.uint64(key[0].as_py() << 32)) << np.uint64(64 - KEY_BITS)
        return pa.table({"fp": pa.array(fp.view(np.int64), pa.int64())})

    return pick


def _count(tables: dict, bits: int):
    """Task function: (length, fp, check, n, pointer) of the texts' words, and of its phrases that hit the bits of their length's
    broadcast table; one row of length 0 per language counts its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {k: np.frombuffer(t.value, np.uint8) for k, t in tables.items()}
        held, waiting = [], 0                                # rows of the task so far, bounded by COMBINE
        for chunk in _chunks(batches):
            data, offsets = _buffers(chunk.column("text"))
            pointer, salts = chunk.column("pointer").to_numpy(), _salts(chunk.column("lang").to_pylist())
            for first, n, _, _, text, grams in ngrams(data, offsets, salts, max(known), bits):
                own, rows = pointer[text[first:first + n]], []
                each, at, size = np.unique(salts[text[first:first + n]], return_index=True, return_counts=True)
                rows.append((np.zeros(len(each), np.int32), each.astype(np.uint64), each % PRIME, own[at], size))
                for k, (fp, check, valid) in enumerate(grams, 1):
                    at = np.flatnonzero(valid & _passes(known[k], fp)) if k in known else np.arange(len(fp))
                    rows.append((np.full(len(at), k, np.int32), fp[at], check[at], own[at], np.ones(len(at), np.int64)))
                held.append(_combined(rows))
                waiting += len(held[-1][0])
                if waiting > COMBINE:
                    held = [_combined(held)]
                    waiting = len(held[0][0])
                    if waiting > COMBINE * 3 // 4:
                        yield _counted(held.pop())
                        waiting = 0
        if held:
            yield _counted(_combined(held))

    return run


def _counted(rows: tuple) -> pa.RecordBatch:
    k, fp, check, pointer, n = rows
    return pa.RecordBatch.from_arrays([pa.array(k), pa.array(fp.view(np.int64)), pa.array(check.astype(np.int32)), pa.array(n.astype(np.int32)),
                                       pa.array(pointer)], names=["length", "fp", "check", "n", "pointer"])


def _bit_table(fps: DataFrame, filter_bits: int):
    """A broadcast of ``filter_bits`` bits, those of the fingerprints set; built in parts by the tasks."""
    part = min(FILTER_PART, filter_bits)

    def fill(key: tuple, rows: pa.Table) -> pa.Table:
        out, at = np.zeros(part // 8, np.uint8), rows.column("bit").to_numpy()
        np.bitwise_or.at(out, at >> 3, np.left_shift(np.uint8(1), (at & 7).astype(np.uint8)))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([out.tobytes()], pa.binary())})

    place = F.shiftrightunsigned("fp", 64 - KEY_BITS).bitwiseAND(F.lit(filter_bits - 1))
    rows = fps.select((place / part).cast("int").alias("part"), (place % part).alias("bit")).distinct()
    filled = rows.groupBy("part").applyInArrow(fill, "part int, bits binary").collect()          # filter_bits / 8 bytes at most
    table = np.zeros(filter_bits // 8, np.uint8)
    for r in filled:
        at = r["part"] * (part // 8)
        table[at:at + part // 8] = np.frombuffer(r["bits"], np.uint8)
    return fps.sparkSession.sparkContext.broadcast(table.tobytes())


def _phrase(data: np.ndarray, start: np.ndarray, end: np.ndarray, i: int, k: int) -> str:
    return b" ".join(_FOLD[data[start[j]:end[j]]].tobytes() for j in range(i, i + k)).decode()


def _find(upto: int, bits: int):
    """Task function: documents with the (length, fp) that point to them to rows (length, fp, lang, phrase): every text found under it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for r in range(len(batch)):
                data, offsets = _buffers(batch.column("text").slice(r, 1))
                wanted: dict[int, np.ndarray] = {}
                for x in batch.column("wanted")[r].as_py():
                    wanted.setdefault(x["length"], []).append(x["fp"])
                got = {}
                for first, _, start, end, _, grams in ngrams(data, offsets, _salts(langs[r:r + 1]), upto, bits):
                    for k, fps in wanted.items():
                        fp, check, valid = grams[k - 1]
                        hit = np.flatnonzero(valid & np.isin(fp.view(np.int64), np.array(fps, np.int64)))
                        for i, f, c in zip(hit.tolist(), fp[hit].view(np.int64).tolist(), check[hit].tolist()):
                            if (k, f, c) not in got:
                                got[k, f, c] = _phrase(data, start, end, first + i, k)
                if got:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([k for k, _, _ in got], pa.int32()), pa.array([f for _, f, _ in got], pa.int64()),
                        pa.array([langs[r] or UND] * len(got), pa.string()), pa.array(list(got.values()), pa.string())],
                        names=["length", "fp", "lang", "phrase"])

    return run


def _recount(upto: int, table, bits: int):
    """Task function: (length, fp, lang, phrase, n) of a batch, by text, where the fingerprint may be among the collided ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(table.value, np.uint8)
        for batch in batches:
            data, offsets = _buffers(batch.column("text"))
            langs = [x or UND for x in batch.column("lang").to_pylist()]
            for first, n, start, end, text, grams in ngrams(data, offsets, _salts(langs), upto, bits):
                counts: dict[tuple, int] = {}
                for k, (fp, _, valid) in enumerate(grams, 1):
                    at = np.flatnonzero(valid & _passes(known, fp))
                    for i, f in zip(at.tolist(), fp[at].view(np.int64).tolist()):
                        key = (k, f, langs[text[first + i]], _phrase(data, start, end, first + i, k))
                        counts[key] = counts.get(key, 0) + 1
                if counts:
                    yield pa.RecordBatch.from_arrays([*(pa.array([x[c] for x in counts], t) for c, t in enumerate(
                        (pa.int32(), pa.int64(), pa.string(), pa.string()))), pa.array(list(counts.values()), pa.int64())],
                        names=["length", "fp", "lang", "phrase", "n"])

    return run


def frequent_phrases(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_words: int = 3,
                     least: int = 10, filter_bits: int = FILTER_BITS, fp_bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(lang, length, phrase, n) of all phrases of ``least`` occurrences or more, and (lang, n): all words of a language.  Both staged."""
    spark = docs.sparkSession
    prepare(spark)
    text, lang = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(lang_col), F.lit(UND))
    rows = docs.select(text.alias("text"), lang.alias("lang"), F.xxhash64(F.col(id_col), lang, text).alias("pointer"))
    with scratch(spark) as keep:
        tables: dict[int, object] = {}
        for k in range(2, max_words + 1):
            keys = rows.select("text", "lang").mapInArrow(_keys(k, tables.get(k - 1), fp_bits, least), "part int, keys binary")
            tables[k] = _bit_table(keys.groupBy("part").applyInArrow(_often(least), "fp long"), filter_bits)
        counted = staged(rows.mapInArrow(_count(tables, fp_bits), "length int, fp long, check int, n int, pointer long").groupBy("length", "fp").agg(
            F.sum(F.col("n").cast("long")).alias("n"), F.min("check").alias("c0"), F.max("check").alias("c1"),
            F.min("pointer").alias("p0"), F.max("pointer").alias("p1")).filter((F.col("n") >= least) | (F.col("length") == 0)), "fingerprints")
        for table in tables.values():
            table.destroy()
        seeds = rows.select("lang").distinct().select("lang", F.crc32(F.col("lang").cast("binary")).alias("seed"))
        words = keep(staged(counted.filter("length = 0").join(seeds, F.col("fp") == F.col("seed")).select("lang", "n"), "words"))
        phrases = counted.filter("length > 0")
        wanted = (phrases.select("length", "fp", F.explode(F.array_distinct(F.array("p0", "p1"))).alias("w_pointer"))
                  .groupBy("w_pointer").agg(F.collect_list(F.struct("length", "fp")).alias("wanted")))
        # rows of one id and text share a pointer: each of them shows the same phrases
        found = staged(rows.join(wanted, F.col("pointer") == F.col("w_pointer")).select("text", "lang", "wanted")
                       .mapInArrow(_find(max_words, fp_bits), "length int, fp long, lang string, phrase string").distinct(), "found")
        shown = found.groupBy("length", "fp").agg(F.count("*").alias("texts"), F.min("lang").alias("lang"), F.min("phrase").alias("phrase"))
        met = staged(phrases.join(shown, ["length", "fp"]), "met")
        table, several = None, (F.col("texts") > 1) | (F.col("c0") != F.col("c1"))
        single = met.filter(~several).select("lang", "length", "phrase", "n")
        collided = met.filter(several).select("length", "fp")
        if not collided.isEmpty():
            table = _bit_table(collided, filter_bits)
            anew = (rows.select("text", "lang").mapInArrow(_recount(max_words, table, fp_bits), "length int, fp long, lang string, phrase string, n long")
                    .join(collided, ["length", "fp"], "left_semi").groupBy("lang", "length", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))
            single = single.unionByName(anew)
        out = keep(staged(single, "phrases"))
        if table is not None:
            table.destroy()
    return out, words


def _looked_up(rows: DataFrame, counts: DataFrame, heavy: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with the count of the phrase in column ``key``: the few heavy ones by broadcast, the others by a shuffle."""
    h = F.broadcast(heavy.select("lang", F.col("phrase").alias(key), F.col("n").alias(name)))
    light = counts.join(F.broadcast(heavy.select("lang", "phrase")), ["lang", "phrase"], "left_anti")
    marked = rows.join(h, ["lang", key], "left")
    return marked.filter(F.col(name).isNotNull()).unionByName(
        marked.filter(F.col(name).isNull()).drop(name).join(light.select("lang", F.col("phrase").alias(key), F.col("n").alias(name)), ["lang", key]))


def collocations(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_words: int = 3, least: int = 10,
                 absorb_percent: int = 50, top: int = 2000, filter_bits: int = FILTER_BITS, fp_bits: int = 64) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of 2 to ``max_words`` words of each language."""
    spark = docs.sparkSession
    with scratch(spark) as keep:
        phrases, words = frequent_phrases(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, max_words=max_words, least=least,
                                          filter_bits=filter_bits, fp_bits=fp_bits)
        total = words.agg(F.sum("n")).first()[0] or 0
        counts = phrases.filter(F.col("length") < max_words).select("lang", "phrase", "n")
        heavy = counts.filter(F.col("n") * HEAVY >= total)
        part = F.split("phrase", " ")
        cuts = phrases.filter("length > 1").select(
            "lang", "phrase", "length", F.col("n").alias("a"), part.alias("w"), F.explode(F.expr("sequence(1, length - 1)")).alias("k")).select(
            "lang", "phrase", "length", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
            F.array_join(F.slice("w", F.col("k") + 1, F.col("length") - F.col("k")), " ").alias("rest"))
        both = _looked_up(_looked_up(cuts, counts, heavy, "head", "l"), counts, heavy, "rest", "r")
        big = lambda c: F.col(c).cast("decimal(16,0)")
        both = both.withColumn("a_", big("a")).withColumn("l_", big("l")).withColumn("r_", big("r")).withColumn(
            "score", F.expr("cast((a_ * a_ * 1000000BD) div (l_ * r_) as bigint)"))
        lowest = F.min(F.struct("score", "k", "l", "r")).alias("x")
        scored = staged(both.groupBy("lang", "phrase", "length", "a").agg(lowest).select("lang", "phrase", "length", "a", "x.score", "x.l", "x.r"), "scored")
        inner = scored.filter("length > 2").select("lang", F.col("a").alias("longer"), F.split("phrase", " ").alias("w"), "length").select(
            "lang", "longer", "w", "length", F.explode(F.expr("sequence(2, length - 1)")).alias("m")).select(
            "lang", "longer", F.explode(F.expr("transform(sequence(0, length - m), i -> array_join(slice(w, i + 1, m), ' '))")).alias("phrase"))
        covered = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        free = scored.join(covered, ["lang", "phrase"], "left").filter(
            F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * absorb_percent))
        # the first of each slice of a language, then the first of those: a task ranks at most ``top`` rows a slice
        order, slices = (F.desc("score"), F.desc("a"), F.col("phrase")), int(spark.conf.get("spark.sql.shuffle.partitions"))
        slice_ = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(slices))).orderBy(*order)
        ranked = free.withColumn("rank", F.row_number().over(slice_)).filter(F.col("rank") <= top)
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
        out = ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
        return keep(staged(out, "ranked"))
