"""Helpers shared by the operators: inputs, staged tables, training-fold expressions, tokenizer files."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.session import checkpoint_root, ship_package, work_path
from scorewright.sinks.fs import delete

#: Words of the contracts: runs of anything but space and the control characters 9 to 13.
SPACES = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


#: Bytes of a batch that go to a Python worker at a time, unless the session sets its own: texts vary a lot in length.
ARROW_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m")


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder registered, package importable in the executors' Python workers, batches bounded."""
    checkpoint_root(spark)
    ship_package(spark)
    key, default, small = ARROW_BATCH
    if spark.conf.get(key, None) == default:
        spark.conf.set(key, small)


_SCOPES: list[list[str]] = []


def staged(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared work folder (in folders ``by`` columns) and read it back.

    Cuts the lineage, and pins what must not change between two uses (ids, names, slices) even when
    executors are lost.  Inside a ``scratch`` block the table goes with the block unless kept."""
    spark = df.sparkSession
    path = work_path(spark, "llm", spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path, partitionBy=by)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    if _SCOPES:
        _SCOPES[-1].append(path)
    return out


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A block whose staged tables are deleted at its end, but for those given to the function it yields.

    What leaves the block must not read a deleted table: stage it, and keep that."""
    own: list[str] = []
    kept: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.staged_path)
        return df

    _SCOPES.append(own)
    try:
        yield keep
    finally:
        _SCOPES.pop()
        for path in own:
            if path not in kept:
                delete(spark, path)
        if _SCOPES:
            _SCOPES[-1].extend(kept)


@contextmanager
def watched() -> Iterator[list[str]]:
    """The paths of the staged tables that a block leaves behind (for whoever deletes them later)."""
    own: list[str] = []
    _SCOPES.append(own)
    try:
        yield own
    finally:
        _SCOPES.pop()


def drop_staged(spark: SparkSession) -> None:
    """Delete every table staged by this application (call after the results are written)."""
    delete(spark, work_path(spark, "llm", spark.sparkContext.applicationId))


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null ids count as the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's vocabulary file (read on the driver, shipped to tasks by value)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
