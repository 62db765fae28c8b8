"""Scoring operators that need no model object: linear scores, nearest centroid, label lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.functions.scalar import dot, sigmoid, squared_distance, to_double_array


def linear_score(df: DataFrame, features: str, coefficients: Sequence[float], intercept: float,
                 tie: str = "high", confidence: str = "positive",
                 prediction_col: str = "prediction", probability_col: str = "probability",
                 confidence_col: str = "confidence", raw_col: str = "raw") -> DataFrame:
    """Binary logistic scoring from fixed coefficients (a vector or numeric-array column).

    ``raw = w.x + b`` (left to right, in double), ``probability = 1/(1+exp(-raw))``,
    ``prediction = probability >= 0.5`` (``tie='high'``, the batch job's rule) or ``> 0.5``
    (``tie='low'``, what ``LogisticRegressionModel`` does).  ``confidence='positive'`` reports
    p(class 1) for every row (batch job), ``'predicted'`` reports p(predicted class).
    The coefficients travel as one literal array in the plan, not as a broadcast variable.
    """
    df = df.withColumn("_arr", to_double_array(features, df.schema[features].dataType))
    z = dot(F.col("_arr"), coefficients) + F.lit(float(intercept))
    p = sigmoid(F.col(raw_col))
    pred = (F.col(probability_col) >= F.lit(0.5)) if tie == "high" else (F.col(probability_col) > F.lit(0.5))
    out = df.withColumn(raw_col, z).drop("_arr").withColumn(probability_col, p).withColumn(prediction_col, pred.cast("double"))
    if confidence == "positive":
        conf = F.col(probability_col)
    elif confidence == "predicted":
        conf = F.when(F.col(prediction_col) == 1.0, F.col(probability_col)).otherwise(F.lit(1.0) - F.col(probability_col))
    else:
        raise ValueError(f"confidence must be 'positive' or 'predicted', not {confidence!r}")
    return out.withColumn(confidence_col, conf)


def model_confidence(probability: str | Column, prediction: str | Column, mode: str = "predicted") -> Column:
    """Element of a model's probability vector: class 1 (``positive``) or the predicted class."""
    from pyspark.ml.functions import vector_to_array

    arr = vector_to_array(F.col(probability) if isinstance(probability, str) else probability)
    pred = F.col(prediction) if isinstance(prediction, str) else prediction
    if mode == "positive":
        return F.element_at(arr, 2)
    return F.element_at(arr, pred.cast("int") + 1)


def id_and_answer(scored: DataFrame, id_col: str) -> DataFrame:
    """``id, churn``: yes where class 1 is predicted, else no (the columns of a scored CSV)."""
    return scored.select(F.col(id_col).alias("id"), F.when(F.col("prediction") == 1.0, F.lit("yes")).otherwise(F.lit("no")).alias("churn"))


def assign_cluster(df: DataFrame, features: str, centres: Sequence[Sequence[float]],
                   output: str = "prediction") -> DataFrame:
    """Nearest centre by squared Euclidean distance; the lowest centre index wins a tie."""
    df = df.withColumn("_arr", to_double_array(features, df.schema[features].dataType))
    d = F.array(*[squared_distance(F.col("_arr"), c) for c in centres])
    return df.withColumn("_d", d).drop("_arr").withColumn(
        output, (F.array_position(F.col("_d"), F.array_min(F.col("_d"))) - 1).cast("int")).drop("_d")


def label_lookup(df: DataFrame, labels: DataFrame, index_col: str = "prediction",
                 label_col: str = "label", out_col: str = "label_name") -> DataFrame:
    """Index -> label with fallback to the index as text.

    ``labels`` has ``(index int, label string)``.  A plain left join: the planner broadcasts the
    label map when its measured size is under the broadcast threshold and shuffles otherwise.
    """
    lm = labels.select(F.col("index").cast("int").alias("_li"), F.col(label_col).alias("_ll"))
    idx = F.col(index_col).cast("int")
    out = df.join(lm, idx == F.col("_li"), "left")
    return out.withColumn(out_col, F.coalesce(F.col("_ll"), idx.cast("string"))).drop("_li", "_ll")
