"""Train/test split, replication and sampling."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.functions.scalar import keyed_fraction
from scorewright.specs import SPLIT_SEED, TRAIN_FRACTION


def threshold_hex(fraction: float) -> str:
    """Hex prefix bound so that ``keyed_fraction(key) < bound`` keeps ``fraction`` of the keys."""
    v = min(65536, max(0, math.ceil(fraction * 65536)))
    return "g" if v >= 65536 else format(v, "04x")   # 'g' sorts after every hex digit


def split_column(df: DataFrame, key: str, fraction: float = TRAIN_FRACTION, seed: int = SPLIT_SEED,
                 out: str = "split") -> DataFrame:
    """``train`` / ``test`` from a hash of the key: the same on any partitioning and any engine,
    and every copy of a key lands on the same side."""
    inside = keyed_fraction(F.col(key), seed) < F.lit(threshold_hex(fraction))
    return df.withColumn(out, F.when(inside, F.lit("train")).otherwise(F.lit("test")))


def holdout_split(df: DataFrame, key: str, fraction: float = TRAIN_FRACTION, seed: int = SPLIT_SEED,
                  method: str = "key") -> tuple[DataFrame, DataFrame]:
    """(train, test).  ``method='random'`` is ``randomSplit`` (depends on partitioning)."""
    if method == "random":
        tr, te = df.randomSplit([fraction, 1.0 - fraction], seed=seed)
        return tr, te
    inside = keyed_fraction(F.col(key), seed) < F.lit(threshold_hex(fraction))
    return df.filter(inside), df.filter(~inside)


def replicate(df: DataFrame, copies: int, copy_col: str = "copy") -> DataFrame:
    """Each row ``copies`` times with a ``copy`` index: a generator, one scan, no join."""
    return df.withColumn(copy_col, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


#: Rows, copies included, that one task of ``spread`` takes at most on average.
ROWS_PER_TASK = 500_000


def spread(df: DataFrame, key: str, copies: int = 1, per_task: int | None = None) -> DataFrame:
    """``df`` dealt by ``key`` over every core of the cluster, or over as many tasks as hold ``per_task`` rows each
    (``ROWS_PER_TASK`` unless given) once every row is replicated ``copies`` times.  A small file is read as one or two partitions, and whatever
    multiplies its rows or passes over them again and again would stay on as many cores."""
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() * copies // (per_task or ROWS_PER_TASK)))
    return df.repartition(n, key)


def sample_rows(df: DataFrame, fraction: float, seed: int = SPLIT_SEED, key: str | None = None) -> DataFrame:
    """Bernoulli sample.  With ``key``, a keyed (partition-independent) sample whose hash is salted
    differently from the train/test split, so the sample is not a subset of one side; otherwise
    ``DataFrame.sample``."""
    if key is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.filter(keyed_fraction(F.col(key), f"sample{seed}") < F.lit(threshold_hex(fraction)))
