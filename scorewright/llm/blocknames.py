"""Exact dedup by deterministic block naming.

A text is cut into blocks of ``block`` bytes.  Equal blocks get equal integer names (dense rank of the
sorted blocks inside one of ``BUCKETS`` hash buckets, so the work spreads and the name does not depend
on the partitioning); then adjacent pairs of names are named again and again until one name is left.
Two texts end with the same (levels, name) if and only if they are identical: names are ranks of the
content itself, so there are no collisions to check for.

Work per task is bounded: each task keeps a dictionary of the distinct blocks of one segment (at most
``segment_bytes`` of text), so a block that a third of all rows share leaves a task once per segment,
and only small integers travel after that.  Blocks travel compressed (lossless, so equality is kept).

Cases: null text counts as empty; an empty text is one empty block.  Of equal texts the row with the
largest id stays (null ids sort first); of repeated rows with that same id exactly one stays.  An empty
table gives an empty result.  Only the id and text columns are read; other columns don't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, scratch, staged

BUCKETS = 1 << 16
BLOCK = 16384
SEGMENT_BYTES = 32 << 20
SEGMENT_ROWS = 1 << 16


def _cut(block: int, segment_bytes: int, segment_rows: int):
    """Task function: distinct blocks of each segment, and per text the list of its block numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1, write_checksum=False).compress
        part = TaskContext.get().partitionId()
        seg, row, known, held, used = 0, 0, {}, 0, 0
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            at = 0
            while at < len(texts):
                new, sha, lists = [], [], []
                start = at
                while at < len(texts) and used < segment_rows and held < segment_bytes:
                    t = texts[at].as_py() or b""
                    sha.append(hashlib.sha256(t).digest())
                    own = []
                    for a in range(0, max(1, len(t)), block):
                        b = t[a:a + block]
                        k = known.get(b)
                        if k is None:
                            k = known[b] = len(known)
                            new.append((k, squeeze(b)))
                            held += len(b)
                        own.append(k)
                    lists.append(own)
                    at, used = at + 1, used + 1
                n, d = len(lists), len(new)
                row += n
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * (n + d), pa.int32()), pa.array([seg] * (n + d), pa.int32()),
                    pa.array([None] * n + [k for k, _ in new], pa.int32()),
                    pa.array([None] * n + [c for _, c in new], pa.binary()),
                    pa.array([(part << 40) + i for i in range(row - n, row)] + [None] * d, pa.int64()),
                    pa.concat_arrays([batch.column(0).slice(start, n), pa.nulls(d, batch.column(0).type)]),
                    pa.array(sha + [None] * d, pa.binary()),
                    pa.array(lists + [None] * d, pa.list_(pa.int32()))],
                    names=["part", "seg", "local", "block", "row", "id", "sha", "blocks"])
                if used >= segment_rows or held >= segment_bytes:
                    seg, known, held, used = seg + 1, {}, 0, 0

    return run


def _ranked(df: DataFrame, *content: str) -> Column:
    """An integer name for the content columns: bucket, then dense rank in the bucket's sort order."""
    window = Window.partitionBy("bucket").orderBy(*content)
    return F.shiftleft(F.col("bucket").cast("long"), 40) + F.dense_rank().over(window)


def _bucket(*content: str) -> Column:
    return F.pmod(F.xxhash64(*content), F.lit(BUCKETS)).cast("int")


def identities(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
               segment_bytes: int = SEGMENT_BYTES, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row per input row: row (unique), id, sha (of the text), level and name: its identity."""
    prepare(docs.sparkSession)
    with scratch(docs.sparkSession) as keep:
        return keep(_identities(docs, id_col, text_col, block, segment_bytes, segment_rows))


def _identities(docs: DataFrame, id_col: str, text_col: str, block: int, segment_bytes: int, segment_rows: int) -> DataFrame:
    light = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    schema = (f"part int, seg int, local int, block binary, row long, id {light.schema['id'].dataType.simpleString()}, "
              "sha binary, blocks array<int>")
    cut = staged(light.mapInArrow(_cut(block, segment_bytes, segment_rows), schema), "blocks")
    texts = cut.filter("row is not null")
    names = (cut.filter("row is null").select("part", "seg", "local", "block")
             .withColumn("bucket", _bucket("block"))
             .select("part", "seg", "local", _ranked(cut, "block").alias("name")))
    level = staged(texts.select("part", "seg", "row", F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "local"))
                   .join(names, ["part", "seg", "local"]).select("row", "pos", "n", "name"), "names")
    done, k = level.filter("n = 1").select("row", F.lit(0).alias("level"), "name"), 0
    while True:
        longest = level.agg(F.max("n")).first()[0]
        if longest is None or longest <= 1:
            break
        k += 1
        pairs = (level.filter("n > 1").groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
                 .agg(F.first("n").alias("n"), F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b")))
        pairs = staged(pairs, "pairs")
        ranked = (pairs.select("a", "b").distinct().withColumn("bucket", _bucket("a", "b"))
                  .select("a", "b", _ranked(pairs, "a", "b").alias("name")))
        level = staged(pairs.join(ranked, ["a", "b"]).select("row", "pos", F.ceil(F.col("n") / 2).cast("int").alias("n"), "name"),
                       "names")
        done = done.unionByName(level.filter("n = 1").select("row", F.lit(k).alias("level"), "name"))
    return staged(texts.select("row", "id", "sha").join(done, "row"), "identities")


def duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    named = identities(docs, id_col=id_col, text_col=text_col, **sizes)
    # partial aggregation collapses a group inside each task; only groups of two or more are joined back
    groups = (named.groupBy("level", "name").agg(F.count("*").alias("group_size"), F.max(F.struct("id", "row")).alias("keep"))
              .filter("group_size > 1"))
    groups = staged(groups, "groups")         # both sides then meet on plain exchanges: a hot group can be split
    return named.join(groups, ["level", "name"], "left").select(
        F.col("id").alias(id_col), F.when(F.col("keep").isNull(), F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("keep").isNull() | (F.col("keep.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
