"""End-to-end jobs: the batch work of the original scripts and API routes, as DataFrame plans.

Each job takes paths (any Hadoop URI) and returns DataFrames and/or writes through ``sinks``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.operators.clean import clean_blank_drop, clean_blank_zero, quarantine
from scorewright.operators.cluster import cluster_profile, fit_kmeans
from scorewright.operators.embed import SIZE, Embedder, image_features
from scorewright.operators.features import feature_stages, indexer
from scorewright.operators.metrics import accuracy, prediction_counts, silhouette, with_class_weights
from scorewright.operators.models import classifier, compare_models, evaluate, fit_pipeline, report_table
from scorewright.operators.rank import global_row_number
from scorewright.operators.scoring import id_and_answer, label_lookup, linear_score
from scorewright.operators.split import holdout_split, replicate, sample_rows, spread
from scorewright.session import work_path
from scorewright.sinks import save_model, write_csv, write_json_single, write_label_map, write_single_csv
from scorewright.sinks.fs import delete
from scorewright.sources.filesystems import resolve
from scorewright.sources.csv import MALFORMED, read_csv_strings, require_columns
from scorewright.sources.images import (
    NoImagesError, packed, read_images, reading_pictures, stage_members, with_path_label, zip_members)
from scorewright.sources.labels import read_label_map_tolerant
from scorewright.specs import ERROR_LABEL, LR_EMBEDDING_PARAMS, LR_WEIGHTED_PARAMS, TELCO, TableSpec


# ---------------------------------------------------------------- churn
def load_training_table(spark: SparkSession, csv_path: str, spec: TableSpec = TELCO) -> DataFrame:
    """Training-path cleaning: exact ``" "`` blanks dropped, typed casts (integers that are none take the
    contract's default, as in scoring: the assembler refuses nulls), 0/1 label."""
    raw = require_columns(read_csv_strings(spark, csv_path), [*spec.required, spec.target])
    fill = {c: spec.defaults[c] for c in spec.int_columns if c in spec.defaults}
    df = clean_blank_drop(raw, spec)
    return df.fillna(fill) if fill else df


def train_churn(spark: SparkSession, csv_path: str, kind: str = "rf", model_path: str | None = None,
                spec: TableSpec = TELCO, split: str = "key", **params) -> dict:
    """Clean, split 80/20, fit index/one-hot/assemble + classifier, evaluate on the test part,
    save the pipeline (overwrite).  Returns model, metrics (AUC, accuracy, P/R/F1), counts and
    test predictions."""
    df = load_training_table(spark, csv_path, spec)
    train, test = holdout_split(df, spec.id_col, method=split)
    model = fit_pipeline(train, spec, classifier(kind, **params))
    preds = model.transform(test)
    if model_path:
        save_model(model, model_path, overwrite=True)
    return {"model": model, "metrics": evaluate(preds), "counts": prediction_counts(preds), "predictions": preds}


def compare_churn_models(spark: SparkSession, csv_path: str, out_dir: str | None = None, replicas: int = 200,
                         spec: TableSpec = TELCO, candidates: dict | None = None) -> DataFrame:
    """Replicate the table ``replicas`` times (one scan, its rows first dealt over all cores), split on the
    original key so copies of a row never straddle train and test, fit every candidate, write
    ``model_comparison.csv``."""
    df = load_training_table(spark, csv_path, spec)
    if replicas > 1:
        df = replicate(spread(df, spec.id_col, replicas), replicas)
    train, test = holdout_split(df, spec.id_col)
    cands = candidates or {"Random Forest": classifier("rf"), "Gradient Boosted Tree": classifier("gbt")}
    table, _ = compare_models(train, test, spec, cands)
    report = report_table(table)
    if out_dir:
        write_single_csv(spark, report, out_dir, "model_comparison.csv")
    return report


def score_csv(spark: SparkSession, in_path: str, model: str | PipelineModel, out_path: str | None = None,
              spec: TableSpec = TELCO) -> DataFrame:
    """Batch scoring of a CSV: contract check, scoring-path cleaning (blanks -> defaults), saved
    pipeline, ``id,churn`` (yes/no).  The id rides through ``transform``; no row-id join."""
    m = PipelineModel.load(model) if isinstance(model, str) else model
    raw = require_columns(read_csv_strings(spark, in_path), spec.required)
    df = clean_blank_zero(raw.select(*spec.required), spec)
    out = id_and_answer(m.transform(df), spec.id_col)
    if out_path:
        write_csv(out, out_path)
    return out


def batch_report(df: DataFrame, spec: TableSpec, score: Callable[[DataFrame], DataFrame],
                 order: Sequence[str | Column] = ()) -> dict[str, DataFrame]:
    """The two sides of a batch report over raw text rows: ``scored`` (row, id, prediction, probability)
    for rows without an issue, ``issues`` (row, error), one per missing or unreadable value.

    Rows of ``read_csv_checked`` may carry a malformed line: it is one issue, with the line, and never scored.
    ``row`` counts from 1 in ``order``, or as the rows are read.  ``score`` adds ``prediction`` and
    ``probability`` (of class 1), e.g. a fixed linear scorer.  Both sides read one checkpointed numbering."""
    keys = [f"_order{i}" for i in range(max(1, len(order)))]
    by = list(order) or [F.monotonically_increasing_id()]
    numbered = global_row_number(df.withColumns(dict(zip(keys, (F.col(c) if isinstance(c, str) else c for c in by)))), keys, "row")
    checked = quarantine(numbered.drop(*keys), spec, check_text=True)
    if MALFORMED in df.columns:
        bad = F.col(MALFORMED).isNotNull()
        checked = checked.withColumns({
            "errors": F.when(bad, F.array(F.concat(F.lit("malformed line: "), F.col(MALFORMED)))).otherwise(F.col("errors")),
            "status": F.when(bad, F.lit("rejected")).otherwise(F.col("status"))})
    good = score(checked.filter(F.col("status") == "ok"))
    return {"scored": good.select("row", F.col(spec.id_col).alias("id"), "prediction", "probability"),
            "issues": checked.select("row", F.explode("errors").alias("error"))}


def score_images(spark: SparkSession, image_glob: str, lr_model: str | LogisticRegressionModel, labels_path: str, size: int = SIZE,
                 embedder_factory: Callable[[], Embedder] | None = None) -> DataFrame:
    """Label and p(predicted class) of every image of a folder (or of one image): ``origin, label,
    confidence``; an image that cannot be decoded or embedded becomes ``(origin, ERROR, 0.0)``."""
    from scorewright.operators.scoring import model_confidence

    lr = LogisticRegressionModel.load(lr_model) if isinstance(lr_model, str) else lr_model
    feats = image_features(packed(read_images(spark, image_glob)), "image", size, embedder_factory)
    path = work_path(spark, "stage", f"features-{uuid.uuid4().hex}")
    with reading_pictures(spark):
        feats.select(F.col("image.origin").alias("origin"), F.col("emb.features").alias("features")).write.parquet(path)
    rows = spark.read.parquet(path)
    good = rows.filter(F.col("features").isNotNull()).withColumn(
        lr.getFeaturesCol(), array_to_vector(F.col("features").cast("array<double>")))
    told = label_lookup(lr.transform(good), read_label_map_tolerant(spark, labels_path), "prediction").select(
        "origin", F.col("label_name").alias("label"), model_confidence("probability", "prediction").alias("confidence"))
    failed = rows.filter(F.col("features").isNull()).select("origin", F.lit(ERROR_LABEL).alias("label"), F.lit(0.0).alias("confidence"))
    return told.unionByName(failed)


def score_rows(spark: SparkSession, records: Sequence[dict], model: str | PipelineModel,
               spec: TableSpec = TELCO) -> DataFrame:
    """Score in-memory records (a form submission): prediction, p(leave), decision text."""
    from scorewright.functions.scalar import decision_text, percent
    from scorewright.operators.scoring import model_confidence

    m = PipelineModel.load(model) if isinstance(model, str) else model
    df = spark.createDataFrame([{k: v for k, v in r.items() if k != spec.id_col} for r in records])
    out = m.transform(df)
    p1 = model_confidence("probability", "prediction", "positive")
    return out.select(*[c for c in df.columns], "prediction", p1.alias("probability"),
                      decision_text("prediction").alias("decision"), percent(p1).alias("leave_probability"))


# ---------------------------------------------------------------- clustering
def cluster_customers(spark: SparkSession, df: DataFrame, spec: TableSpec, k: int = 5, seed: int = 42,
                      scale: str = "std", key: str | None = None, model_path: str | None = None,
                      plot_path: str | None = None, plot_columns: Sequence[str] = (), plot_fraction: float | None = 0.1,
                      profile_columns: Sequence[str] = ()) -> dict:
    """Encode (+ scale), k-means, per-cluster means, silhouette, save (fails if the path exists),
    and two columns + cluster id for plotting (a sample of ``plot_fraction``; None: all rows), as parquet."""
    from pyspark.ml import Pipeline

    fm = Pipeline(stages=feature_stages(spec, "features", scale)).fit(df)
    feats = fm.transform(df).persist(StorageLevel.MEMORY_AND_DISK)
    km = fit_kmeans(feats, "features", k=k, seed=seed, key=key)
    preds = km.transform(feats)
    if model_path:
        save_model(km, model_path, overwrite=False)
    out = {"model": km, "predictions": preds,
           "profile": cluster_profile(preds, list(profile_columns or spec.numeric)),
           "silhouette": silhouette(preds, "features", "prediction")}
    if plot_path and plot_columns:
        points = preds.select(*plot_columns, "prediction")
        points = points if plot_fraction is None else sample_rows(points, plot_fraction, seed)
        points.write.mode("overwrite").parquet(plot_path)
    return out


# ---------------------------------------------------------------- images
def image_training_set(spark: SparkSession, image_glob: str, size: int = SIZE,
                       embedder_factory: Callable[[], Embedder] | None = None) -> DataFrame:
    """Image rows -> (origin, label from the folder, features vector); failed images dropped.

    Features are written once to the work folder and read from there, so each image is embedded once
    however often the fit and the caller read the result."""
    imgs = with_path_label(packed(read_images(spark, image_glob)))
    feats = image_features(imgs, "image", size, embedder_factory)
    path = work_path(spark, "stage", f"features-{uuid.uuid4().hex}")
    with reading_pictures(spark):
        feats.select(F.col("image.origin").alias("origin"), "label", F.col("emb.features").alias("features")).write.parquet(path)
    ok = spark.read.parquet(path).filter(F.col("features").isNotNull())
    return ok.select("origin", "label", array_to_vector(F.col("features").cast("array<double>")).alias("features_vec"))


def train_image_lr(spark: SparkSession, image_glob: str, model_dir: str | None = None,
                   labels_dir: str | None = None, metrics_dir: str | None = None, weighted: bool = False,
                   size: int = SIZE, embedder_factory: Callable[[], Embedder] | None = None) -> dict:
    """Embed, index labels (fail on unseen), optional balanced class weights, 80/20 split on folder
    and file name (wherever the folders lie), logistic regression, test accuracy; write metrics JSON,
    label map JSON, model."""
    data = image_training_set(spark, image_glob, size, embedder_factory)
    if data.isEmpty():
        raise ValueError("no valid data left after feature extraction")
    ix = indexer(["label"], handle_invalid="error").fit(data)
    d = ix.transform(data).withColumnRenamed("label_idx", "labelIndex")
    if weighted:
        d = with_class_weights(d, "labelIndex")
        lr = LogisticRegression(featuresCol="features_vec", labelCol="labelIndex", weightCol="classWeight",
                                **LR_WEIGHTED_PARAMS)
    else:
        lr = LogisticRegression(featuresCol="features_vec", labelCol="labelIndex", **LR_EMBEDDING_PARAMS)
    d = d.withColumn("_name", F.concat_ws("/", "label", F.element_at(F.split("origin", "/"), -1)))
    train, test = (part.drop("_name") for part in holdout_split(d, "_name"))
    model = lr.fit(train)
    preds = model.transform(test)
    metrics = accuracy(preds, "labelIndex", "prediction")
    labels = ix.labelsArray[0]
    if metrics_dir:
        write_json_single(metrics, metrics_dir)
    if labels_dir:
        write_label_map(spark, labels, labels_dir)
    if model_dir:
        save_model(model, model_dir, overwrite=True)
    return {"model": model, "labels": labels, "metrics": metrics, "predictions": preds}


def score_zip(spark: SparkSession, zip_path: str, lr_model: str | LogisticRegressionModel, labels_path: str,
              out_dir: str | None = None, slices: int | None = None, stage_dir: str | None = None,
              size: int = SIZE, embedder_factory: Callable[[], Embedder] | None = None, single_file: bool = False, resources=None) -> DataFrame:
    """Classify every image member of one or more ZIP archives with a binary logistic model.

    archive listing -> central-directory UDTF (extension filter, directories skipped; none -> error)
    -> members spread over tasks and staged as files -> image source (Spark packs files into
    partitions by their sizes; ``slices`` sets another number) -> batched embedder
    -> ``w.x + b``, sigmoid, ``p >= 0.5`` -> label map (fallback: the index as text).  A member that
    cannot be decoded or embedded becomes ``(name, ERROR, 0.0)``.  Output ``archive, filename, label,
    confidence`` (p of class 1); with ``out_dir`` it is also written as distributed CSV or, with
    ``single_file=True``, without the archive as exactly one ``preds.csv``.  ``resources``: a resource
    profile of the embedding stage (see ``image_features``).
    """
    lr = LogisticRegressionModel.load(lr_model) if isinstance(lr_model, str) else lr_model
    if lr.numClasses != 2:
        raise ValueError("score_zip needs a binary logistic regression model")
    w, b = [float(x) for x in lr.coefficients.toArray()], float(lr.intercept)
    labels = read_label_map_tolerant(spark, labels_path)

    stage = (stage_dir or work_path(spark, "stage", f"zip-{uuid.uuid4().hex}")).rstrip("/")
    zip_members(spark, zip_path, require_any=False).write.mode("overwrite").parquet(f"{stage}/members")   # listed once
    members = spark.read.parquet(f"{stage}/members")
    if members.filter(F.col("name").isNotNull()).isEmpty():
        raise NoImagesError("No valid images found in ZIP.")
    stage_members(members, f"{stage}/files", archives=resolve(spark, zip_path)).write.mode("overwrite").parquet(f"{stage}/manifest")
    manifest = spark.read.parquet(f"{stage}/manifest")

    imgs = read_images(spark, f"{stage}/files", recursive=True).withColumn(
        "staged", F.element_at(F.split(F.col("image.origin"), "/"), -1))
    feats = image_features(imgs.repartition(slices) if slices else packed(imgs), "image", size, embedder_factory, resources=resources)
    feats = feats.select("staged", F.col("emb.features").cast("array<double>").alias("features"))
    # a null feature array scores to a null prediction, which finds no label: the row fails
    scored = linear_score(feats, "features", w, b, tie="high", confidence="positive")
    scored = label_lookup(scored, labels, "prediction").select("staged", "label_name", "confidence")
    rows = manifest.join(scored, "staged", "left")
    failed = F.col("label_name").isNull()
    preds = rows.select(
        F.element_at(F.split("archive", "/"), -1).alias("archive"), F.col("name").alias("filename"),
        F.when(failed, F.lit(ERROR_LABEL)).otherwise(F.col("label_name")).alias("label"),
        F.when(failed, F.lit(0.0)).otherwise(F.col("confidence")).alias("confidence"))
    # written once: the output below and the caller read this, and the extracted pictures can go
    with reading_pictures(spark):
        preds.write.mode("overwrite").parquet(f"{stage}/preds")
    preds = spark.read.parquet(f"{stage}/preds")
    for part in ("files", "manifest", "members"):
        delete(spark, f"{stage}/{part}")
    if out_dir:
        if single_file:
            write_single_csv(spark, preds.drop("archive"), out_dir, "preds.csv")
        else:
            write_csv(preds, out_dir)
    return preds
