"""Clustering: k-means fit with a reproducible input layout, per-cluster profiles, k sweeps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.functions.scalar import squared_distance, to_double_array
from scorewright.operators.metrics import point_silhouette
from scorewright.operators.together import run_together
from scorewright.specs import KMEANS_PARAMS


def stable_layout(df: DataFrame, key: str, num_partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by a key so that seeded, partition-wise sampling (k-means||
    initialisation, random splits) sees the same rows in the same places on every run.

    The seed acts per layout: another ``num_partitions`` (default: the session's shuffle
    partitions) may pick other initial centres and so give another, equally valid model.  The
    count never depends on the data's size."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, key).sortWithinPartitions(key)


def fit_kmeans(df: DataFrame, features: str = "features", k: int = KMEANS_PARAMS["k"],
               seed: int = KMEANS_PARAMS["seed"], key: str | None = None, **params) -> KMeansModel:
    """KMeans over a persisted input (the fit makes one pass per iteration); a caller's own cache stays."""
    own = bool(key) or not df.is_cached
    data = stable_layout(df, key).select(features) if key else df
    if own:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return KMeans(k=k, seed=seed, featuresCol=features, **params).fit(data)
    finally:
        if own:
            data.unpersist()


def cluster_profile(df: DataFrame, columns: Sequence[str], prediction: str = "prediction",
                    fixed_decimals: int | None = None) -> DataFrame:
    """Mean of each listed column per cluster, plus the cluster size.

    With ``fixed_decimals`` the columns are fixed-point numbers (money): they are summed as exact
    integers, so the means do not depend on summation order.
    """
    aggs = [F.count(F.lit(1)).alias("size")]
    for c in columns:
        if fixed_decimals is None:
            aggs.append(F.avg(c).alias(f"avg_{c}"))
        else:
            scale = float(10 ** fixed_decimals)
            units = F.round(F.col(c) * F.lit(scale)).cast("long")
            aggs.append((F.sum(units).cast("double") / (F.count(F.lit(1)).cast("double") * F.lit(scale)))
                        .alias(f"avg_{c}"))
    return df.groupBy(prediction).agg(*aggs)


def measure_clusterings(df: DataFrame, centres: Mapping[int, Sequence[Sequence[float]]], features: str = "features") -> DataFrame:
    """``(k, silhouette, cost)`` of several sets of centres over the same points, in two scans for all of them.

    The first assigns every point under every set and adds up sizes, sums and squared norms per (k, cluster): that
    aggregate, of as many rows as there are centres, comes to the driver.  The second averages the points'
    silhouettes and sums their squared distances to the nearest centre, all sets in one aggregate."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    x, zero = to_double_array(features, df.schema[features].dataType), F.lit(0.0)
    pts = df.select(x.alias("_x")).withColumn("_sq", F.aggregate("_x", zero, lambda acc, v: acc + v * v))
    for k, cs in centres.items():
        pts = pts.withColumn(f"_d{k}", F.array(*[squared_distance(F.col("_x"), [float(v) for v in c]) for c in cs]))
    near = {k: (F.array_position(F.col(f"_d{k}"), F.array_min(F.col(f"_d{k}"))) - 1).cast("double") for k in centres}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), near[k].alias("at")) for k in centres]))
    stats: dict[int, list] = {k: [] for k in centres}
    for r in (pts.select("_x", "_sq", each.alias("m")).groupBy("m.k", "m.at")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("_sq").alias("sq"), Summarizer.sum(array_to_vector("_x")).alias("s")).orderBy("k", "at").collect()):
        stats[r["k"]].append((float(r["at"]), float(r["n"]), float(r["sq"]), [float(v) for v in r["s"].toArray()]))
    told = [F.struct(F.lit(k).alias("k"),
                     (F.avg(point_silhouette(stats[k], F.col("_x"), F.col("_sq"), near[k])) if len(stats[k]) > 1 else F.lit(None).cast("double")).alias("silhouette"),
                     F.sum(F.array_min(F.col(f"_d{k}"))).alias("cost")) for k in centres]
    return pts.agg(F.array(*told).alias("m")).select(F.explode("m").alias("m")).select("m.*")


def sweep_k(df: DataFrame, ks: Sequence[int] = (3, 4, 5, 6, 7, 8), features: str = "features",
            seed: int = KMEANS_PARAMS["seed"], key: str | None = None, together: bool = True) -> DataFrame:
    """Fit one k-means per k on one persisted input; table ``(k, silhouette, cost, train_time_s)``.

    The fits run side by side (``together=False``: one after the other), each timed on its own; then two scans
    measure all of them.  ``cost``: sum of squared distances to the nearest final centre."""
    spark = df.sparkSession
    data = stable_layout(df, key) if key else df
    data = data.select(features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        data.count()                       # cached by one pass, not by all fits at once
        fits = run_together(spark, {f"k={k}": lambda k=k: KMeans(k=k, seed=seed, featuresCol=features).fit(data).clusterCenters() for k in ks},
                            None if together else 1)
        rows = measure_clusterings(data, {int(k): fits[f"k={k}"][0] for k in ks}, features).collect()
    finally:
        data.unpersist()
    times = {int(k): fits[f"k={k}"][1] for k in ks}
    return spark.createDataFrame([(r["k"], r["silhouette"], r["cost"], times[r["k"]]) for r in rows], "k int, silhouette double, cost double, train_time_s double")
