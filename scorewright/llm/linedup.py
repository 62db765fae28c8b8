"""Line dedup against levelled sorted runs of line hashes, in DataFrame and SQL operations only.

A line's key is the line without blanks at both ends, A-Z in lower case; it is known by 128 bits of hash.
``LineRuns`` keeps, in a folder that all executors share, sorted runs of (hash, documents that hold it):
tables bucketed and sorted by the hash, so a run meets a batch, or another run, bucket by bucket without
being shuffled.  A new batch is counted, merge-anti-joined with the runs' settled lines (those that already
reached ``limit`` documents need no further count) and written as a run of its own at level 0; ``fanout``
runs of a level are compacted into one of the next.  With ``limit=1`` every line is settled once seen, and
what a batch adds is just its unseen lines.

``drop_lines`` feeds a table to the runs in batches and takes every line that ``limit`` documents hold out of
all of them.  A line that a third of all documents share leaves a task as one row per batch when counted;
when its places are marked, the lines that hold at least 1/1,024 of the count (so 1,024 at most) meet the
rows by broadcast, all others by a shuffle in which none can be hot.  Only texts' hashes, line numbers and
line hashes are shuffled for that; the texts move once, to meet the numbers of their dropped lines.

Cases: a null or empty text is one empty line; lines whose key has fewer than ``min_chars`` code points are
never dropped.  Every row is a document: n equal rows count n times and come back n times; a line that
occurs several times in a row counts once.  Null ids are a value like any other.  Order of rows and ties play no part.
Very long texts: one text is held by one task at a time, its lines sorted once (no quadratic step).  An empty table
gives an empty result.  Only the id and text columns are read; others don't clash.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.session import work_path
from scorewright.sinks.fs import delete, is_complete, list_names

from .common import let, prepare, scratch, staged

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEAVY = 1024


class LineRuns:
    """Runs of (h1, h2, n) below ``path``; reopened from the names of its folders.

    A folder ``L<level>-<first>-<last>-<buckets>`` holds the batches first to last.  A compacted run covers its
    sources by that range, so a writer lost between writing it and deleting them leaves no line counted twice."""

    def __init__(self, spark: SparkSession, path: str, *, limit: int = 10, fanout: int = 4, buckets: int | None = None):
        self.spark, self.path, self.limit, self.fanout = spark, path.rstrip("/"), limit, fanout
        self.live: list[tuple[int, int, int, str]] = []          # level, first, last, table
        self.stale: list[tuple[int, int, int, str]] = []
        found = []
        for name in list_names(spark, self.path):
            m = re.fullmatch(r"L(\d+)-(\d+)-(\d+)-(\d+)", name)
            if m and is_complete(spark, f"{self.path}/{name}"):
                found.append((*map(int, m.groups()), name))
        self.buckets = found[0][3] if found else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        for level, first, last, _, name in sorted(found, key=lambda r: -r[0]):
            if not any(a <= first and last <= b for _, a, b, _ in self.live):
                self.live.append((level, first, last, self._register(name)))

    def _register(self, name: str) -> str:
        table = f"line_run_{uuid.uuid4().hex[:12]}"
        self.spark.sql(f"CREATE TABLE {table} (h1 BIGINT, h2 BIGINT, n BIGINT) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/{name}'")
        return table

    def _folder(self, run: tuple[int, int, int, str]) -> str:
        return f"{self.path}/L{run[0]}-{run[1]}-{run[2]}-{self.buckets}"

    def _write(self, rows: DataFrame, level: int, first: int, last: int) -> None:
        run = (level, first, last, f"line_run_{uuid.uuid4().hex[:12]}")
        (rows.repartition(self.buckets, "h1", "h2").write.format("parquet").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
         .mode("overwrite").option("path", self._folder(run)).saveAsTable(run[3]))
        self.live.append(run)

    def _merged(self, runs: list[tuple[int, int, int, str]]) -> DataFrame:
        # one scan of all folders: a union of bucketed scans would be taken as already grouped by the hash, which it isn't
        rows = self.spark.read.schema("h1 long, h2 long, n long").parquet(*[self._folder(r) for r in runs])
        return rows.groupBy("h1", "h2").agg(F.sum("n").alias("n"))

    def add(self, hashes: DataFrame) -> DataFrame:
        """Take in a batch, one row (h1, h2) per document and distinct line.  Returns the run it became: its
        lines that were not settled before, with the batch's documents (readable until the next ``add``)."""
        self.sweep()
        batch = hashes.groupBy("h1", "h2").agg(F.count("*").alias("n"))
        for _, _, _, table in self.live:
            settled = self.spark.table(table).filter(F.col("n") >= self.limit).select("h1", "h2")
            batch = batch.join(settled, ["h1", "h2"], "left_anti")
        number = 1 + max((last for _, _, last, _ in self.live), default=-1)
        self._write(batch, 0, number, number)
        own = self.spark.table(self.live[-1][3])
        level = 0
        while len(runs := [r for r in self.live if r[0] == level]) >= self.fanout:
            self._write(self._merged(runs), level + 1, min(r[1] for r in runs), max(r[2] for r in runs))
            self.live = [r for r in self.live if r not in runs]
            self.stale += runs
            level += 1
        return own

    def sweep(self) -> None:
        """Delete the runs that compaction has replaced."""
        while self.stale:
            run = self.stale.pop()
            self.spark.sql(f"DROP TABLE IF EXISTS {run[3]}")
            delete(self.spark, self._folder(run))

    def drop(self) -> None:
        """Delete all runs."""
        self.stale, self.live = self.stale + self.live, []
        self.sweep()

    def frequent(self) -> DataFrame:
        """(h1, h2, n): lines of at least ``limit`` documents.  Counts of settled lines stop at some value of ``limit`` or more."""
        if not self.live:
            return self.spark.createDataFrame([], "h1 long, h2 long, n long")
        return self._merged(self.live).filter(F.col("n") >= self.limit)


def _hashed(line: Column) -> Column:
    """128 bits from two seeds (the second: the hash of a fixed word)."""
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2"))


def line_rows(docs: DataFrame, batches: int, min_chars: int) -> DataFrame:
    """(id, t, batch, pos, h1, h2, first) per line with a key; ``docs``: id, text; ``first``: the key's first place in its row."""
    keys = F.transform(F.split(F.translate("text", UPPER, LOWER), "\n"),
                       lambda x, i: let(F.btrim(x, F.lit(BLANKS)), lambda k: F.struct(F.length(k).alias("size"), _hashed(k).alias("h"), i.alias("pos"))))
    ordered = F.sort_array(F.transform(F.filter(keys, lambda x: x["size"] >= min_chars), lambda x: F.struct(x["h"].alias("h"), x["pos"].alias("pos"))))
    marked = let(ordered, lambda a: F.transform(a, lambda x, i: F.struct(
        x["h"]["h1"].alias("h1"), x["h"]["h2"].alias("h2"), x["pos"].alias("pos"),
        ((i == 0) | (F.get(a, i - 1)["h"] != x["h"])).alias("first"))))
    return docs.select("id", "t", F.pmod(F.xxhash64("id", "t"), F.lit(batches)).cast("int").alias("batch"), F.explode(marked).alias("x")).select(
        "id", "t", "batch", "x.*")


def _kept(lines: Column, gone: Column) -> Column:
    """``lines`` without those at the sorted places ``gone`` (from 0), as the slices between them."""
    def slice_(g: Column):
        def one(i: Column) -> Column:
            start = F.when(i == 0, F.lit(0)).otherwise(F.get(g, i - 1) + 1)
            return F.slice(lines, start + 1, F.coalesce(F.get(g, i), F.size(lines)) - start)
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(g)), one))
    return let(gone, slice_)


def drop_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 10, min_chars: int = 1,
               batches: int = 6, fanout: int = 3, buckets: int | None = None) -> DataFrame:
    """One row per row: id, n_lines (before), n_dropped, text (what stays, joined by line feeds)."""
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("t"))
    runs = LineRuns(spark, work_path(spark, "llm", spark.sparkContext.applicationId, f"line-runs-{uuid.uuid4().hex[:12]}"),
                    limit=limit, fanout=fanout, buckets=buckets)
    with scratch(spark) as keep:
        lines = staged(line_rows(rows, batches, min_chars), "lines", by=["batch"])
        for b in range(batches):
            runs.add(lines.filter((F.col("batch") == b) & F.col("first")).select("h1", "h2"))
        frequent = staged(runs.frequent(), "frequent")
        total = frequent.agg(F.sum("n")).first()[0] or 0
        heavy = frequent.filter(F.col("n") * HEAVY >= total).select("h1", "h2")       # 1,024 rows at most
        light = frequent.filter(F.col("n") * HEAVY < total).select("h1", "h2")
        places = lines.select("id", "t", "pos", "h1", "h2")
        marked = (places.join(F.broadcast(heavy), ["h1", "h2"], "left_semi")
                  .unionByName(places.join(F.broadcast(heavy), ["h1", "h2"], "left_anti").join(light, ["h1", "h2"], "left_semi")))
        gone = keep(staged(marked.groupBy(F.col("id").alias("g_id"), F.col("t").alias("g_t")).agg(F.sort_array(F.collect_set("pos")).alias("gone")), "gone"))
    runs.drop()
    met = rows.join(gone, F.col("id").eqNullSafe(F.col("g_id")) & (F.col("t") == F.col("g_t")), "left")
    parts = F.split("text", "\n")
    done = let(parts, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(_kept(x, F.col("gone")), "\n")).alias("text")))
    return met.select(F.col("id").alias(id_col), done.alias("d"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped")).select(
        id_col, "d.n_lines", "n_dropped", F.col("d.text").alias(text_col))
