"""Quality rules by cross-document line frequency, in DataFrame expressions only.

Every line that holds a word is normalised (lower case, one space between words) and hashed to 96 bits.
Per host, the distinct documents (by id and text) that hold a line are counted; lines in more than ``share`` of
the host's distinct documents, and more than ``min_docs``, are boilerplate there and are removed; a document that loses more than ``max_removed`` of its
words that way, or is left with fewer than ``min_words``, is depleted and rejected.  In front stand the
usual single-document rules (too short, too many repeated word windows).

Counting shuffles a hash per distinct document and line, dealt by both, so a line that a third of all rows hold
is spread, and then counted with a sum per task.  Frequent lines are few (each stands for more than
``min_docs`` documents); they meet the lines in a join whose side Spark broadcasts only when its measured size
allows.  The texts themselves are never shuffled.

Cases: a null text has no words (base rules reject it).  A null host is a host of its own, a null id an id.
Repeated rows count once and come back as often as they are.  A line at the limit stays (it has to be in more
documents).  Very long texts go whole; one text's lines and windows are sorted in one task.  Empty table:
empty result.  Only the named columns are read; others don't clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, fresh, let, prepare, staged


@dataclass(frozen=True)
class Limits:
    min_docs: int = 5
    share: float = 0.05
    max_removed: float = 0.5
    min_words: int = 10
    repeat_window: int = 5
    max_repeat_percent: int = 20


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def _covered(windows: Column, k: int) -> Column:
    """Words covered by windows of ``k`` words that occur twice or more (``windows``: a hash per window)."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(p: Column) -> Column:
        def twin(x: Column, j: Column) -> Column:
            same = lambda d: F.coalesce(F.get(p, j + d)["h"] == x["h"], F.lit(False))
            return same(-1) | same(1)

        return F.sort_array(F.transform(F.filter(p, twin), lambda x: x["i"]))

    def total(at: Column) -> Column:
        step = F.transform(at, lambda x, j: F.least(F.coalesce(F.get(at, j + 1) - x, F.lit(k)), F.lit(k)).cast("long"))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(let(pairs, places), total)


def repeated_words(words_: Column, k: int = 5) -> Column:
    """Words in windows of ``k`` words found twice or more in the text, first ones included.

    Windows are told apart by a 64-bit hash of their words' hashes; only texts that have two equal ones
    are sorted with their places."""

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(_covered(w, k))

    def of(h: Column) -> Column:
        return F.when(F.size(h) < k, F.lit(0).cast("long")).otherwise(let(windows(h), count))

    return let(F.transform(words_, lambda w: F.xxhash64(w)), of)


def _lines(text: Column) -> Column:
    """Normalised lines that hold a word."""
    flat = F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.filter(F.transform(F.split(flat, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def _hash(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.hash(line).alias("h2")]


def base_measures(text: Column) -> list[Column]:
    bare = F.translate(text, " \t\n\x0b\x0c\r", "")
    held = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    both = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    return [both.alias("w"), F.length(bare).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
            let(held, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines")]


def frequent_lines(docs: DataFrame, limits: Limits) -> DataFrame:
    """(host, h1, h2, docs): lines in more distinct documents of the host than the limits allow; ``docs``: id, host, text."""
    own = ["id", F.xxhash64("text").alias("t1"), F.hash("text").alias("t2")]
    each = docs.select("host", *own, F.explode(F.array_distinct(_lines(F.col("text")))).alias("line")).select(
        "host", "id", "t1", "t2", *_hash(F.col("line"))).distinct()
    lines = each.groupBy("host", "h1", "h2").agg(F.count("*").alias("docs")).filter(F.col("docs") > limits.min_docs)
    hosts = docs.select("host", *own).distinct().groupBy(F.col("host").alias("of")).agg(F.count("*").alias("all"))
    return lines.join(hosts, F.col("host").eqNullSafe(F.col("of"))).filter(F.col("docs") > limits.share * F.col("all")).select("host", "h1", "h2", "docs")


def line_quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                 limits: Limits = Limits()) -> DataFrame:
    """One row per row: id, base measures, base_failed, removed_lines, removed_words, depleted, kept."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), text.alias("text"))
    frequent = staged(frequent_lines(rows, limits), "frequent_lines")
    key = ["id", "host", "t1", "t2"]                 # equal rows share it, and all that follows from it
    named = [F.col("id"), F.col("host"), F.xxhash64("text").alias("t1"), F.hash("text").alias("t2")]
    lines = rows.select(*named, F.explode(_lines(F.col("text"))).alias("line")).select(
        *key, *_hash(F.col("line")), F.size(F.split("line", " ")).cast("long").alias("n"))
    f = frequent.select(F.col("host").alias("f_host"), F.col("h1").alias("f1"), F.col("h2").alias("f2"))
    removed = (lines.join(f, F.col("host").eqNullSafe(F.col("f_host")) & (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")))
               .groupBy(*key).agg(F.sum("n").alias("removed_words"), F.count("*").alias("removed_lines")))
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    base = (rows.select(*named, *base_measures(F.col("text")))
            .select(*key, F.lit(1).cast("long").alias("rows"), F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
                    F.col("w.r").alias("n_repeat_words")))
    # measures and removals of a row meet in one aggregation, not in a join
    met = base.unionByName(removed, allowMissingColumns=True).groupBy(*key).agg(
        F.sum("rows").alias("rows"), *[F.max(m).alias(m) for m in measures],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("removed_words", "removed_lines")])
    each = [(F.col(c) / F.col("rows")).cast("long").alias(c) for c in ("removed_words", "removed_lines")]
    one = met.select("id", *measures, *each, F.explode(F.expr("sequence(1L, rows)")).alias("copy"))
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (F.col("removed_words") > limits.max_removed * F.col("n_words")) | ((F.col("removed_words") > 0) & (left < limits.min_words))
    return one.select(F.col("id").alias(id_col), *measures, failed.alias("base_failed"), "removed_lines", "removed_words",
                      depleted.alias("depleted"), (~failed & ~depleted).alias("kept"))


def clean_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limits: Limits = Limits()) -> DataFrame:
    """``docs`` with the lines above the limit taken out of the text, the others in their order; blank lines go too."""
    prepare(docs.sparkSession)
    row = fresh(docs, "_row")
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    rows = numbered.select(F.col(row).alias("row"), F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    plain = F.trim(F.regexp_replace(F.lower("line"), r"[\x20\x09\x0B-\x0D]+", " "))
    f = staged(frequent_lines(rows, limits), "frequent_lines").select(F.col("host").alias("f_host"), F.col("h1").alias("f1"), F.col("h2").alias("f2"))
    lines = (rows.select("row", "host", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("plain", plain)
             .filter("plain != ''").select("row", "host", "pos", "line", *_hash(F.col("plain")))
             .join(f, F.col("host").eqNullSafe(F.col("f_host")) & (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")), "left_anti"))
    kept = lines.groupBy(F.col("row").alias(row)).agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("_lines"))
    clean = F.when(F.col(text_col).isNotNull(), F.coalesce(F.array_join(F.transform("_lines", lambda x: x["line"]), "\n"), F.lit("")))
    return numbered.join(kept, row, "left").withColumn(text_col, clean).select(*docs.columns)
