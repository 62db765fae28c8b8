"""Training-corpus pipeline over ``documents``: language ID, exact dedup, SimHash near-dedup, secret scans, packing.

Each stage gets what its predecessor kept and returns the columns of ``documents`` (the last: the packed
pieces).  Rows are told apart by a number given once per stage, so repeated and null ids are safe: of equal
rows one stays.  An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm import blocknames, langid, packing, secret_ledger, simhash
from scorewright.llm.common import documents, fold, fresh, prepare, staged, watched
from scorewright.session import work_path
from scorewright.sinks.fs import delete

#: Staged tables of the stage before; its result has been written when the next one starts.
_LEFT: list[str] = []


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with the staged tables of the one before it removed, unless its input still reads them."""

    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _LEFT and not any(f"/{path.rsplit('/', 1)[1]}/" in f for path in _LEFT for f in docs.inputFiles()):
            while _LEFT:
                delete(spark, _LEFT.pop())
        with watched() as made:
            out = work(spark, docs, sf_dir)
        _LEFT.extend(made)
        return out

    return run_stage


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key that orders rows by id, then by a number pinned in a staged copy."""
    row = fresh(docs, "_row")
    return staged(docs.withColumn(row, F.struct(F.col("doc_id"), F.monotonically_increasing_id().alias("row"))), "numbered"), row


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go: no language can be told (null, empty and blank texts, digits and signs).

    All others stay, whatever the score: texts that mix languages are no worse, and without a labelled row
    to learn from nothing is known against any.  Very long texts are read whole."""
    model = langid.fit(docs, fold("doc_id", 5) != 0)
    pred, score = fresh(docs, "_lang_pred"), fresh(docs, "_lang_score")
    told = langid.predict(docs, model, pred_col=pred, score_col=score)
    kept = F.col(pred) != langid.UND if model is not None else F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return told.filter(kept).select(*docs.columns)


@_stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, key = _keyed(docs)
    gone = blocknames.duplicates(rows, id_col=key).filter("not kept").select(key)
    return rows.join(gone, key, "left_anti").select(*docs.columns)


@_stage
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, key = _keyed(docs)
    gone = simhash.near_duplicates(rows, id_col=key).filter(F.col(key) != F.col("component_id")).select(key)
    return rows.join(gone, key, "left_anti").select(*docs.columns)


@_stage
def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Findings are replaced by ``[kind]`` in the text; every document stays."""
    prepare(spark)
    ledger = secret_ledger.Ledger(spark, work_path(spark, "llm", spark.sparkContext.applicationId, f"ledger-{uuid.uuid4().hex[:12]}"))
    ledger.scan(docs)
    blob, spans = fresh(docs, "_blob"), fresh(docs, "_spans")
    found = staged(ledger.spans().select(F.col("blob").alias(blob), F.col("spans").alias(spans)), "spans")
    marked = docs.withColumn(blob, secret_ledger.blob_id(F.col("text"))).join(found, blob, "left")
    clean = F.when(F.col(spans).isNull(), F.col("text")).otherwise(secret_ledger.redact(F.col("text"), F.col(spans)))
    return marked.withColumn("text", clean).select(*docs.columns)


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces: a null or empty text is its end token alone; a text longer than a sequence is cut."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("packing", pack),
]

#: Language scores, fingerprints and tokens have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
