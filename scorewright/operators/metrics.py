"""Quality measures as DataFrame aggregates (no ``collect`` loops, no RDD round trips).

Every measure takes an optional ``group`` list (e.g. ``["model"]``) so several models' predictions,
stacked in one table, are measured in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from scorewright.functions.scalar import dot
from scorewright.operators.rank import prefix_before_slice, range_slices


BROADCAST_CLASSES = 10_000       # two numbers each


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prediction_counts(df: DataFrame, prediction: str = "prediction", group: Sequence[str] = ()) -> DataFrame:
    """Total rows, rows predicted 0 (stay) and 1 (leave) in one aggregate."""
    p = F.col(prediction)
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(p == 0.0).alias("stay"),
        F.count_if(p == 1.0).alias("leave"),
    )


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction",
              group: Sequence[str] = ()) -> DataFrame:
    """tp/fp/fn/tn for class 1 plus accuracy, precision, recall, F1 as ratios of counts.

    Precision (recall) is 0 when nothing is predicted (labelled) positive, as in
    ``MulticlassMetrics``.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    counts = df.groupBy(*group).agg(
        F.count_if((y == 1.0) & (p == 1.0)).alias("tp"),
        F.count_if((y != 1.0) & (p == 1.0)).alias("fp"),
        F.count_if((y == 1.0) & (p != 1.0)).alias("fn"),
        F.count_if((y != 1.0) & (p != 1.0)).alias("tn"),
        F.count_if(y == p).alias("correct"),
        F.count(F.lit(1)).alias("n"),
    )
    tp, fp, fn = F.col("tp").cast("double"), F.col("fp").cast("double"), F.col("fn").cast("double")
    return counts.select(
        *group, "tp", "fp", "fn", "tn",
        (F.col("correct").cast("double") / F.col("n").cast("double")).alias("accuracy"),
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0)).alias("precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0)).alias("recall"),
        F.when(2 * tp + fp + fn > 0, (2 * tp) / (2 * tp + fp + fn)).otherwise(F.lit(0.0)).alias("f1"),
    )


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction",
             group: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group).agg(
        (F.count_if(F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
         / F.count(F.lit(1)).cast("double")).alias("accuracy"))


def auc(df: DataFrame, label: str = "label", score: str = "probability", group: Sequence[str] = (),
        num_slices: int | None = None) -> DataFrame:
    """Exact area under the ROC curve, ties counted one half (= ``BinaryClassificationEvaluator``
    with ``numBins=0``).

    AUC = sum over positives of (#negatives scored lower + 0.5 * #negatives scored equal)
          / (#positives * #negatives).
    Rows are first reduced to one row per distinct (group, score) -- partial aggregation, so a
    hot score value costs nothing -- then ranked slice by slice (see ``operators.rank``).
    Null when a group has only one class.  Scores are grouped with SQL equality, so ``-0.0`` and
    ``0.0`` are one tie (``BinaryClassificationEvaluator`` keeps them apart).
    """
    g = list(group)
    y = F.col(label).cast("long")
    per_score = df.groupBy(*g, F.col(score).alias("_s")).agg(
        F.sum(y).alias("_pos"), F.sum(F.lit(1) - y).alias("_neg"))
    sliced = range_slices(per_score, [*g, "_s"], num_slices)
    before = prefix_before_slice(sliced, "_neg", g)
    w = Window.partitionBy(*g, "_slice").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_before") + F.coalesce(F.sum("_neg").over(w), F.lit(0))
    ranked = sliced.join(before, [*g, "_slice"]).withColumn(
        "_c", F.col("_pos").cast("double") * (below.cast("double") + F.lit(0.5) * F.col("_neg").cast("double")))
    pos, neg = F.sum("_pos").cast("double"), F.sum("_neg").cast("double")
    return ranked.groupBy(*g).agg(
        F.when((pos > 0) & (neg > 0), F.sum("_c") / (pos * neg)).alias("auc"))


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def class_weight_table(df: DataFrame, label: str = "label", out: str = "classWeight") -> DataFrame:
    """Balanced weights ``total / (num_classes * count)``, one row per class.

    The window runs over the per-class table (one row per class), not over the data.
    """
    counts = class_counts(df, label)
    everything = Window.partitionBy()
    total = F.sum("count").over(everything).cast("double")
    num_classes = F.count(F.lit(1)).over(everything).cast("double")
    return counts.select(label, "count", (total / (num_classes * F.col("count").cast("double"))).alias(out))


def with_class_weights(df: DataFrame, label: str = "label", out: str = "classWeight", default: float = 1.0) -> DataFrame:
    """Attach the balanced weight of each row's class (unknown class -> ``default``).

    The per-class table is counted first and broadcast if it has at most ``BROADCAST_CLASSES``
    rows: the data is then not shuffled by class, so a class holding a third of the rows is no hot
    spot.  Beyond that many classes it is joined without a hint.
    """
    w = class_weight_table(df, label, "_w").select(F.col(label).alias("_wl"), "_w")
    some = w.limit(BROADCAST_CLASSES + 1).toArrow()
    if some.num_rows <= BROADCAST_CLASSES:
        w = F.broadcast(df.sparkSession.createDataFrame(some, w.schema))
    return (df.join(w, F.col(label) == F.col("_wl"), "left")
            .withColumn(out, F.coalesce(F.col("_w"), F.lit(float(default))))
            .drop("_wl", "_w"))


def _as_array(df: DataFrame, features: str) -> Column:
    dt = df.schema[features].dataType
    return F.col(features).cast("array<double>") if isinstance(dt, ArrayType) else vector_to_array(F.col(features))


def point_silhouette(stats: Sequence[tuple[float, float, float, Sequence[float]]], x: Column, sq: Column, own: Column) -> Column:
    """Silhouette of the point ``x`` (squared norm ``sq``) of cluster ``own``; ``stats``: id, size, sum of squared norms, sum of points."""
    # the k distances are one column, computed once per point
    distances = F.array(*[sq + F.lit(q / n) - F.lit(2.0) * dot(x, s) / F.lit(n) for _, n, q, s in stats])
    ids, sizes = F.array(*[F.lit(k) for k, *_ in stats]), F.array(*[F.lit(n) for _, n, *_ in stats])
    at = F.array_position(ids, own).cast("int")

    def told(d: Column) -> Column:
        own_n, own_d = F.element_at(sizes, at), F.element_at(d, at)
        other = F.array_min(F.filter(d, lambda v, i: i + 1 != at))
        a = own_d * own_n / (own_n - F.lit(1.0))
        return (F.when(own_n == 1.0, F.lit(0.0)).when(a < other, F.lit(1.0) - a / other)
                .when(a > other, other / a - F.lit(1.0)).otherwise(F.lit(0.0)))

    return F.element_at(F.transform(F.array(distances), told), 1)


def silhouette(df: DataFrame, features: str = "features", prediction: str = "prediction") -> DataFrame:
    """Mean silhouette with squared Euclidean distance, as ``ClusteringEvaluator`` computes it.

    Per cluster: n, sum of points, sum of squared norms (one aggregate; k rows come back to the
    driver -- k x d numbers, bounded by the model).  Per point, the mean distance to cluster j is
    ``|x|^2 + SQ_j/n_j - 2 x.S_j/n_j``; the own-cluster mean is rescaled by n/(n-1) to leave the
    point out; a point alone in its cluster scores 0.
    """
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    arr = _as_array(df, features)
    pts = df.select(F.col(prediction).cast("double").alias("_k"), arr.alias("_x"))
    pts = pts.withColumn("_sq", F.aggregate("_x", F.lit(0.0), lambda acc, v: acc + v * v))
    stats = (pts.groupBy("_k")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("_sq").alias("sq"),
                  Summarizer.sum(array_to_vector("_x")).alias("s"))
             .orderBy("_k").collect())
    if not stats:
        return df.sparkSession.createDataFrame([], "silhouette double")
    if len(stats) == 1:
        raise ValueError("silhouette needs at least two clusters")
    s_point = point_silhouette([(float(r["_k"]), float(r["n"]), float(r["sq"]), [float(v) for v in r["s"].toArray()]) for r in stats],
                               F.col("_x"), F.col("_sq"), F.col("_k"))
    return pts.agg(F.avg(s_point).alias("silhouette"))


def roc_points(df: DataFrame, label: str = "label", score: str = "probability", group: Sequence[str] = (), bins: int = 1000,
               num_slices: int | None = None) -> DataFrame:
    """The ROC curve as rows ``(group..., point, threshold, fpr, tpr)``, from (0, 0) to (1, 1), down-sampled to about ``bins`` points.

    Distinct scores in descending order; with at least ``2 * bins`` of them each ``n div bins`` neighbours are one
    point, as ``BinaryClassificationEvaluator(numBins)`` groups them (there, within each partition; here over the
    whole order, so the curve doesn't depend on the layout).  ``bins=0`` keeps every distinct score.  ``threshold``:
    the highest score of the point, null at (0, 0) and (1, 1).  A group of one class has no curve.  All groups
    are measured in one plan, on range slices as in ``auc``."""
    g = list(group)
    y = F.col(label).cast("long")
    per_score = df.groupBy(*g, F.col(score).alias("_s")).agg(F.sum(y).alias("_pos"), F.sum(F.lit(1) - y).alias("_neg"))
    sliced = range_slices(per_score, [*g, F.desc("_s")], num_slices)
    # one row per (group, slice): what lies before the slice, and the group's totals
    before, whole = Window.partitionBy(*g).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*g)
    sums = sliced.groupBy(*g, "_slice").agg(F.sum("_pos").alias("p"), F.sum("_neg").alias("n"), F.count(F.lit(1)).alias("c"))
    starts = sums.select(*g, "_slice", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}0") for c in "pnc"],
                         F.sum("p").over(whole).alias("_p"), F.sum("n").over(whole).alias("_n"), F.sum("c").over(whole).alias("_scores"))
    upto = Window.partitionBy(*g, "_slice").orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = sliced.join(starts, [*g, "_slice"]).filter((F.col("_p") > 0) & (F.col("_n") > 0)).withColumns({
        "_tp": F.col("_p0") + F.sum("_pos").over(upto), "_fp": F.col("_n0") + F.sum("_neg").over(upto), "_rank": F.col("_c0") + F.row_number().over(upto),
        "_size": F.expr(f"greatest(1L, _scores div {bins})") if bins else F.lit(1).cast("long")})
    points = ranked.groupBy(*g, F.expr("(_rank - 1) div _size").alias("_bin")).agg(
        F.max("_s").alias("threshold"), *[F.max(c).alias(c) for c in ("_tp", "_fp", "_p", "_n", "_scores", "_size")])

    def point(number: Column, threshold: Column, fpr: Column, tpr: Column) -> Column:
        return F.struct(number.alias("point"), threshold.alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"))

    none = F.lit(None).cast(df.schema[score].dataType)
    own = point(F.col("_bin") + 1, F.col("threshold"), F.col("_fp") / F.col("_n"), F.col("_tp") / F.col("_p"))
    ends = [point(F.lit(0).cast("long"), none, F.lit(0.0), F.lit(0.0)), point(F.expr("(_scores - 1) div _size + 2"), none, F.lit(1.0), F.lit(1.0))]
    every = F.when(F.col("_bin") == 0, F.array(ends[0], own, ends[1])).otherwise(F.array(own))       # the first point brings both ends
    return points.select(*g, F.explode(every).alias("x")).select(*g, "x.*")


def roc_area(points: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Area under the curves of ``roc_points`` by trapezoids: each point meets its predecessor by number, in one aggregate."""
    g = list(group)
    both = points.select(*g, F.explode(F.array(
        F.struct(F.col("point").alias("step"), F.col("fpr").alias("x1"), F.col("tpr").alias("y1"), F.lit(None).cast("double").alias("x0"), F.lit(None).cast("double").alias("y0")),
        F.struct((F.col("point") + 1).alias("step"), F.lit(None).cast("double").alias("x1"), F.lit(None).cast("double").alias("y1"), F.col("fpr").alias("x0"), F.col("tpr").alias("y0")))
    ).alias("e")).select(*g, "e.*")
    steps = both.groupBy(*g, "step").agg(*[F.max(c).alias(c) for c in ("x0", "y0", "x1", "y1")])
    # the first point has no predecessor, the last no successor: null, and out of the sum
    return steps.groupBy(*g).agg(F.sum((F.col("x1") - F.col("x0")) * (F.col("y1") + F.col("y0")) / 2).alias("area"))


def auc_binned(df: DataFrame, label: str = "label", score: str = "probability", bins: int = 1000) -> float:
    """AUC as ``BinaryClassificationEvaluator`` reports it by default: the ROC curve down-sampled
    to ``bins`` bins (approximate; ``auc`` is the exact value).  ``score`` may be a double or a
    raw-prediction vector column."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    data = df.select(F.col(label).cast("double").alias(label), F.col(score))
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, numBins=bins).evaluate(data)
