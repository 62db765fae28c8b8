"""Scoring with saved tree ensembles, without the model class: a node table walked by an expression.

``read_forest`` reads a saved random forest or boosted-tree classifier as plain tables: one row per
node (tree, node, feature, threshold or category set, left, right, leaf values).  ``score_trees`` packs
them into one array of trees -- a scalar subquery, evaluated once, of the model's size -- and walks every
tree by an expression of fixed depth, so scoring is a projection: no model object, no Python, no join.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from scorewright.sinks.fs import exists, list_names

RF, GBT = "rf", "gbt"


@dataclass(frozen=True)
class Forest:
    """``nodes``: (tree, weight, node, feature, n_categories, split, left, right, prediction, stats);
    feature -1 marks a leaf; ``n_categories`` -1: ``split`` holds the threshold, else the categories that go left."""

    nodes: DataFrame
    kind: str
    num_classes: int
    depth: int


def stage_path(spark: SparkSession, path: str, stage: int = -1) -> str:
    """Folder of one stage of a saved pipeline (the last by default); a saved model is its own."""
    root = path.rstrip("/")
    if not exists(spark, f"{root}/stages"):
        return root
    names = sorted(list_names(spark, f"{root}/stages"), key=lambda n: int(n.split("_", 1)[0]))
    return f"{root}/stages/{names[stage]}"


def read_forest(spark: SparkSession, path: str) -> Forest:
    """Node table of a saved forest or boosted-tree classifier, or of a pipeline that ends with one."""
    root = stage_path(spark, path)
    meta = json.loads(spark.read.text(f"{root}/metadata").first()[0])
    name = meta["class"].rsplit(".", 1)[-1]
    kind = {"RandomForestClassificationModel": RF, "GBTClassificationModel": GBT}.get(name)
    if kind is None:
        raise ValueError(f"no tree ensemble classifier: {meta['class']}")
    weights = spark.read.parquet(f"{root}/treesMetadata").toDF("tree", "metadata", "weight")
    n = F.col("nodeData")
    nodes = spark.read.parquet(f"{root}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
        n["split"]["numCategories"].alias("n_categories"), n["split"]["leftCategoriesOrThreshold"].alias("split"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["prediction"].alias("prediction"), n["impurityStats"].alias("stats"))
    depth = {**meta["defaultParamMap"], **meta["paramMap"]}["maxDepth"]
    return Forest(nodes.join(weights.select("tree", "weight"), "tree"), kind, int(meta.get("numClasses", 2)), int(depth))


def _packed(forest: Forest) -> DataFrame:
    """One row, one column: the trees in order, each an array of its nodes in order (a node's number is its place)."""
    node = F.struct("node", "feature", "n_categories", "split", "left", "right", "prediction", "stats")
    trees = forest.nodes.groupBy("tree").agg(F.first("weight").alias("weight"), F.sort_array(F.collect_list(node)).alias("nodes"))
    return trees.agg(F.sort_array(F.collect_list(F.struct("tree", "weight", "nodes"))).alias("trees"))


def _leaf(nodes: Column, x: Column, depth: int) -> Column:
    """The leaf that ``x`` reaches: at most ``depth`` steps from the root, place 0."""

    def step(at: Column, _: Column) -> Column:
        here = F.get(nodes, at)
        value = F.get(x, here["feature"])
        goes_left = F.when(here["n_categories"] < 0, value <= F.get(here["split"], F.lit(0))).otherwise(F.array_contains(here["split"], value))
        return F.when(here["feature"] < 0, at).when(goes_left, here["left"]).otherwise(here["right"])

    return F.get(nodes, F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), F.lit(0), step))


def score_trees(df: DataFrame, forest: Forest, features: str = "features", raw_col: str = "raw", probability_col: str = "probability",
                prediction_col: str = "prediction") -> DataFrame:
    """``df`` with raw scores, probabilities (arrays by class) and the predicted class.

    Forest: each tree votes its leaf's class shares; boosted trees: margin m = sum of weighted leaf values,
    p(class 1) = 1 / (1 + exp(-2m)).  A null feature vector scores to null."""
    from pyspark.ml.functions import vector_to_array

    dense = F.col(features).cast("array<double>") if isinstance(df.schema[features].dataType, ArrayType) else vector_to_array(F.col(features))
    # a null vector is walked as an empty one's root would be: not at all
    with_x = df.withColumns({"_x": F.when(F.col(features).isNotNull(), dense), "_trees": _packed(forest).scalar()})
    leaves = F.transform("_trees", lambda t: F.struct(t["weight"].alias("weight"), _leaf(t["nodes"], F.col("_x"), forest.depth).alias("leaf")))
    out = with_x.withColumn("_leaves", F.when(F.col("_x").isNotNull(), leaves)).drop("_x", "_trees")
    zero = F.lit(0.0)
    if forest.kind == RF:
        def votes(c: int) -> Column:
            def add(acc: Column, t: Column) -> Column:
                total = F.aggregate(t["leaf"]["stats"], zero, lambda a, s: a + s)
                return acc + F.when(total != 0, F.get(t["leaf"]["stats"], F.lit(c)) / total).otherwise(zero)
            return F.aggregate("_leaves", zero, add)
        raw = F.array(*[votes(c) for c in range(forest.num_classes)])
        share = F.transform(F.col(raw_col), lambda v: v / F.aggregate(F.col(raw_col), zero, lambda a, s: a + s))
        told = (F.array_position(F.col(raw_col), F.array_max(F.col(raw_col))) - 1).cast("double")
    else:
        margin = F.aggregate("_leaves", zero, lambda acc, t: acc + t["weight"] * t["leaf"]["prediction"])
        raw = F.array(-margin, margin)
        p1 = 1.0 / (1.0 + F.exp(-2.0 * F.get(F.col(raw_col), F.lit(1))))
        share, told = F.array(1.0 - p1, p1), (F.get(F.col(raw_col), F.lit(1)) > 0).cast("double")
    known = F.col("_leaves").isNotNull()
    return (out.withColumn(raw_col, F.when(known, raw)).withColumn(probability_col, F.when(known, share))
            .withColumn(prediction_col, F.when(known, told)).drop("_leaves"))
