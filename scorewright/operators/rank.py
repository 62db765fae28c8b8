"""Exact global ranks without a single-partition window.

``Window.orderBy(x)`` with no partition moves every row into one task.  Instead the rows are
range-partitioned on the ordering (``repartitionByRange``), so partition ``b`` holds one
contiguous slice of the order; per-slice totals (one row per slice) give each slice its offset.
Running sums then take a window partitioned by slice; row numbers need no second exchange, as a
row's place in its sorted slice is known where it lies.

The sliced table is checkpointed (written to the cluster's checkpoint folder) before it is
used twice: the two uses are planned differently after column pruning, so Spark would not
reuse one range exchange for both, and two independently sampled range bounds -- sampled from
a shuffle whose row order is not fixed -- could put a row in different slices.  The checkpoint
also cuts the lineage, so a lost executor does not re-derive slice ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def range_slices(df: DataFrame, order: Sequence[str | Column], num_slices: int | None = None,
                 slice_col: str = "_slice", materialize: bool = True) -> DataFrame:
    """Range-partition by ``order``, tag each row with its (ordered) slice id, and checkpoint.

    Without ``num_slices`` the range exchange starts from the cluster's shuffle setting and
    adaptive execution merges adjacent small ranges (merging keeps the order), so the slice count
    follows the real data size -- plan-time size estimates after joins are far too unreliable."""
    from scorewright.session import checkpoint_root

    ranged = df.repartitionByRange(num_slices, *order) if num_slices else df.repartitionByRange(*order)
    out = ranged.withColumn(slice_col, F.spark_partition_id())
    if not materialize:
        return out
    checkpoint_root(df.sparkSession)     # the cluster's folder; a local one only when none is set
    return out.checkpoint(eager=True)


def prefix_before_slice(sliced: DataFrame, value: str, group: Sequence[str] = (), slice_col: str = "_slice",
                        out: str = "_before") -> DataFrame:
    """Per (group, slice): sum of ``value`` over all earlier slices of the same group."""
    g = list(group)
    totals = sliced.groupBy(*g, slice_col).agg(F.sum(value).alias("_tot"))
    w = Window.partitionBy(*g).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*g, slice_col, F.coalesce(F.sum("_tot").over(w), F.lit(0)).alias(out))


def global_row_number(df: DataFrame, order: Sequence[str], out: str = "row_id", start: int = 1,
                      num_slices: int | None = None) -> DataFrame:
    """``row_number() over (order by <order>)`` (1-based by default): slice offset + place in the sorted slice.

    The rows are exchanged once, by range.  The offsets (one row per slice, so at most as many as there
    are shuffle partitions) are broadcast.

    Rows with equal keys are ordered by a per-row tiebreak, so a key shared by a third of all
    rows is spread over many slices instead of landing in one task (the order among equal keys
    is arbitrary in SQL as well; the checkpoint fixes it once chosen).
    """
    from scorewright.session import checkpoint_root

    ordering = [*order, "_tb"]
    keyed = df.withColumn("_tb", F.monotonically_increasing_id())
    ranged = range_slices(keyed, ordering, num_slices, materialize=False).sortWithinPartitions(*ordering)
    # a partition's ids are consecutive from (its number) * 2^33
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    checkpoint_root(df.sparkSession)
    sliced = ranged.withColumns({"_place": place, "_one": F.lit(1)}).drop("_tb").checkpoint(eager=True)
    offsets = F.broadcast(prefix_before_slice(sliced, "_one"))
    return (sliced.join(offsets, "_slice").withColumn(out, F.col("_before") + F.col("_place") + F.lit(start).cast("long"))
            .drop("_slice", "_before", "_place", "_one"))
