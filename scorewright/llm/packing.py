"""Packing along a space-filling curve.

Each document's token ids are hashed into a random projection of ``dims`` dimensions (a hashed bag of
tokens times a fixed random matrix, folded into one table row per id), scaled to unit length, put on a
grid of ``bits`` bits per dimension and given the Hilbert key of its cell.  Documents are range-sorted
by that key (ties by hash of the id, so that equal texts spread over the range), laid end to end, and
cut every ``length`` tokens: neighbours on the curve share sequences and only the last sequence of the
corpus can be short.

A document's pieces follow from where it starts, so only (row, key, length) is sorted; the ids stay
where they were tokenised and meet the starts in one join.  Running sums go by range slice, then over
the slices' totals (one row per slice).

Cases: null text counts as empty; a document always has its end token, so every row has a piece.
Repeated rows and null ids each keep their pieces; equal keys go by hash of the id, then by row number.  A very long
text is tokenised whole in one task and cut into as many pieces as it needs.  An empty table gives an empty result.  Only the id
and text columns are read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, read_text, staged, tokenizer_file

LENGTH = 2048
SPECIAL = "<|endoftext|>"


def ranks_of(vocabulary: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Byte strings and ids of a byte-level BPE tokenizer file, and its added tokens."""
    spec = json.loads(vocabulary)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]        # bytes written as themselves
    rest = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}, added


class ByteEncoder:
    """Ids as the ``tokenizers`` library gives them for the file; the merge work runs in ``tiktoken``."""

    def __init__(self, vocabulary: str):
        import tiktoken

        from public_tokenizers import PATTERN

        ranks, self.added = ranks_of(vocabulary)
        self.bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.added)
        self.vocabulary, self.exact = vocabulary, None

    def __call__(self, text: str) -> list[int]:
        if len(text) > 1 << 18:                      # very long: the library itself, which has no regex depth limit
            return self.library(text)
        try:
            if any(s in text for s in self.added):
                return self.bpe.encode(text, allowed_special="all")
            return self.bpe.encode_ordinary(text)
        except BaseException as e:                   # noqa: BLE001 - a panic of the regex engine is no Exception
            if isinstance(e, (KeyboardInterrupt, SystemExit)):
                raise
            return self.library(text)

    def library(self, text: str) -> list[int]:
        if self.exact is None:
            from tokenizers import Tokenizer

            self.exact = Tokenizer.from_str(self.vocabulary)
            self.exact.no_truncation()
            self.exact.no_padding()
        return self.exact.encode(text, add_special_tokens=False).ids


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert keys of integer grid cells (rows of n coordinates): Skilling's transform, vectorised."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def projection(ids: int, dims: int, buckets: int = 1024, seed: int = 5) -> np.ndarray:
    """Row per token id: the random direction of the bucket the id hashes to."""
    direction = np.random.default_rng(seed).normal(size=(buckets, dims)).astype(np.float32)
    mixed = np.arange(ids, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return direction[(mixed >> np.uint64(40)) % np.uint64(buckets)]


_ENCODERS: dict[str, ByteEncoder] = {}


def _tokenise(shipped, end_id: int, dims: int, bits: int):
    """Task function: (row, id, hash) and text -> ids, their number and the Hilbert key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shipped.value
        encode = _ENCODERS.get(vocabulary)
        if encode is None:
            _ENCODERS.clear()
            encode = _ENCODERS[vocabulary] = ByteEncoder(vocabulary)
        table = projection(max(max(encode.added.values()), encode.bpe.n_vocab, end_id) + 1, dims)
        wide = np.uint16 if len(table) <= 1 << 16 else np.uint32
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(2)
            ids, keys, size = [], [], []
            for t in texts:
                one = np.array([*encode(t.as_py() or ""), end_id], dtype=np.uint32)
                at = table[one].sum(axis=0, dtype=np.float64)
                at /= max(1e-9, np.linalg.norm(at))
                keys.append(np.minimum((at + 1) / 2 * (1 << bits), (1 << bits) - 1))
                size.append(len(one))
                ids.append(one.astype(wide).tobytes())
            n = len(ids)
            cells = np.array(keys).astype(np.int64).reshape(n, dims)
            yield pa.RecordBatch.from_arrays([
                pa.array((part << 40) + np.arange(row, row + n), pa.int64()), batch.column(0), batch.column(1),
                pa.array(hilbert(cells, bits), pa.int64()), pa.array(size, pa.int64()), pa.array(ids, pa.binary())],
                names=["row", "id", "tie", "key", "n", "ids"])
            row += n

    return run


def _pieces(length: int, wide: str, with_ids: bool):
    """Task function: (id, n, ids, begin) -> a row for each sequence that the document touches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, start, size, crc, total, seq, offset, held = [], [], [], [], [], [], [], []
            for i, (n, raw, begin) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)))):
                ids = np.frombuffer(raw, wide).astype("<u4")
                a = 0
                while a < n:
                    b = min(n, a + length - (begin + a) % length)
                    piece = ids[a:b].tobytes()
                    for out, v in ((source, i), (start, a), (size, b - a), (crc, zlib.crc32(piece)), (total, n),
                                   (seq, (begin + a) // length), (offset, (begin + a) % length)):
                        out.append(v)
                    if with_ids:
                        held.append(piece)
                    a = b
            cols = [batch.column(0).take(pa.array(source, pa.int64())), *(pa.array(c, pa.int64()) for c in (start, size, crc, total, seq, offset))]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                cols, names = [*cols, pa.array(held, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def _begins(tokens: DataFrame) -> DataFrame:
    """(row, begin): where each document starts when all are laid end to end along the curve."""
    order = ["key", "tie", "row"]
    slices = staged(tokens.select("row", "key", "tie", "n").repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("slice", F.spark_partition_id()), "slices")
    upto = Window.partitionBy("slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)        # one row per slice
    totals = slices.groupBy("slice").agg(F.sum("n").alias("m")).select("slice", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"))
    return (slices.withColumn("own", F.sum("n").over(upto) - F.col("n")).join(totals, "slice")
            .select("row", (F.col("own") + F.col("base")).alias("begin")))


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str | None = None,
         end_id: int = 1, length: int = LENGTH, dims: int = 3, bits: int = 10, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids: 32-bit little-endian)."""
    spark = docs.sparkSession
    prepare(spark)
    vocabulary = read_text(vocabulary_path or tokenizer_file("byte_bpe_50k.json"))
    shipped = spark.sparkContext.broadcast(vocabulary)               # one tokenizer file
    light = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col).cast("string")).alias("tie"), F.col(text_col).alias("text"))
    kind = light.schema["id"].dataType.simpleString()
    tokens = staged(light.mapInArrow(_tokenise(shipped, end_id, dims, bits),
                                     f"row long, id {kind}, tie long, key long, n long, ids binary"), "tokens")
    begins = _begins(tokens)
    spec = json.loads(vocabulary)
    top = max([end_id, *spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    out = (tokens.select("row", "id", "n", "ids").join(begins, "row").select("id", "n", "ids", "begin")
           .mapInArrow(_pieces(length, "<u2" if top < 1 << 16 else "<u4", with_ids), schema))
    return out.withColumnRenamed("id", id_col)
