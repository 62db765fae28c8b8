"""Label maps ``(index int, label string)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LABEL_MAP_SCHEMA = "index int, label string"


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines ``{"index": int, "label": str}``."""
    return spark.read.schema(LABEL_MAP_SCHEMA).json(path)


def read_label_map_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """Label map from JSON of either form, mixed as they come: lines ``{"index": 0, "label": "cat"}``, and objects
    ``{"0": "cat", "1": "dog"}`` on a line or, in a file without any such line, over the whole file.  What doesn't
    parse, or names no integer index, is skipped.

    One plan: each file (a label map: a row per class) is parsed as VARIANT by lines, or whole; every object is
    taken apart by key, and the key ``index`` stands for its line."""
    def is_object(v: Column) -> Column:
        return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))

    lines = F.filter(F.transform(F.split("value", r"\r?\n"), lambda x: F.try_parse_json(x)), is_object)
    # the parser stops after a first value, so a whole file is only taken where no line is an object by itself
    files = spark.read.text(path, wholetext=True).select(lines.alias("lines"), F.try_parse_json("value").alias("whole"))
    each = files.select(F.explode(F.when(F.size("lines") > 0, F.col("lines")).otherwise(F.array("whole"))).alias("v"))
    objects = each.filter(is_object(F.col("v")))
    pairs = objects.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    line = F.col("key") == "index"
    index = F.when(line, F.try_variant_get("value", "$", "int")).otherwise(F.col("key").try_cast("int"))
    label = F.when(line, F.try_variant_get("v", "$.label", "string")).otherwise(F.try_variant_get("value", "$", "string"))
    return pairs.select(index.alias("index"), label.alias("label")).filter(F.col("index").isNotNull() & F.col("label").isNotNull())
