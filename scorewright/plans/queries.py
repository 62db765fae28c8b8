"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (or tables Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.operators.clean import clean_blank_zero
from scorewright.operators.features import fit_features
from scorewright.operators.scoring import id_and_answer, linear_score
from scorewright.plans.fixed import CHURN_INTERCEPT, churn_weights
from scorewright.sources.csv import read_csv_strings, require_columns
from scorewright.sources.tables import churn_csv_path
from scorewright.specs import CHURN

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    """Register a query; the registered callable first ships the package to the workers."""
    import functools

    from scorewright.session import ship_package

    def deco(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        REGISTRY[name] = run
        return fn
    return deco


def _feature_size(model, n_numeric: int) -> int:
    size = n_numeric
    for st in model.stages:
        if isinstance(st, StringIndexerModel):
            size += sum(len(lab) for lab in st.labelsArray)
    return size


def churn_scored(spark: SparkSession, sf_dir: str, weights=None, intercept: float = CHURN_INTERCEPT,
                 tie: str = "high") -> DataFrame:
    """Dirty churn CSV -> contract -> scoring-path cleaning -> index/one-hot/assemble -> fixed
    linear score.  ``customerID`` rides along; no join back."""
    raw = require_columns(read_csv_strings(spark, churn_csv_path(spark, sf_dir)), [*CHURN.required, CHURN.target])
    df = clean_blank_zero(raw.select(*CHURN.required, CHURN.target), CHURN)
    model = fit_features(df, CHURN)
    size = _feature_size(model, len(CHURN.numeric))
    w = churn_weights(size, weights) if weights is not None else churn_weights(size)
    return linear_score(model.transform(df), "features", w, intercept, tie=tie)


@register("score_ids")
def q_score_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_and_answer(churn_scored(spark, sf_dir), "customerID")


# ---------------------------------------------------------------- metrics on the fixed scorer
def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = churn_scored(spark, sf_dir)
    return s.withColumn("label", (F.col(CHURN.target) == F.lit(CHURN.positive)).cast("int"))


@register("prediction_counts")
def q_prediction_counts(spark, sf_dir):
    from scorewright.operators.metrics import prediction_counts
    return prediction_counts(churn_scored(spark, sf_dir))


@register("accuracy")
def q_accuracy(spark, sf_dir):
    from scorewright.operators.metrics import accuracy
    return accuracy(_labelled(spark, sf_dir))


@register("binary_metrics")
def q_binary_metrics(spark, sf_dir):
    from scorewright.operators.metrics import confusion
    return confusion(_labelled(spark, sf_dir))


@register("auc")
def q_auc(spark, sf_dir):
    from scorewright.operators.metrics import auc
    return auc(_labelled(spark, sf_dir), score="raw")


def _rules_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fixed rules scored in one pass over the features; one row per (rule, customer)."""
    from scorewright.functions.scalar import dot
    from scorewright.plans.fixed import CHURN_ALT_RULES

    raw = require_columns(read_csv_strings(spark, churn_csv_path(spark, sf_dir)), [*CHURN.required, CHURN.target])
    df = clean_blank_zero(raw.select(*CHURN.required, CHURN.target), CHURN)
    model = fit_features(df, CHURN)
    size = _feature_size(model, len(CHURN.numeric))
    from pyspark.ml.functions import vector_to_array

    feats = model.transform(df).withColumn("_arr", vector_to_array("features"))
    rules = F.array(*[
        F.struct(F.lit(name).alias("model"), (dot(F.col("_arr"), churn_weights(size, w)) + F.lit(float(b))).alias("raw"))
        for name, (w, b) in CHURN_ALT_RULES.items()])
    out = feats.select("customerID", (F.col(CHURN.target) == F.lit(CHURN.positive)).cast("int").alias("label"),
                       F.explode(rules).alias("r"))
    out = out.select("r.model", "customerID", "label", F.col("r.raw").alias("raw"))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("raw")))
    return out.withColumn("probability", p).withColumn("prediction", (F.col("probability") >= 0.5).cast("double"))


@register("compare_metrics")
def q_compare_metrics(spark, sf_dir):
    from scorewright.operators.metrics import auc, confusion
    st = _rules_stacked(spark, sf_dir)
    return confusion(st, group=["model"]).join(auc(st, score="raw", group=["model"]), "model")


@register("stack_predictions")
def q_stack_predictions(spark, sf_dir):
    """Rows per (rule, prediction): the stacked outputs share one scan and one indexer fit."""
    return _rules_stacked(spark, sf_dir).groupBy("model", "prediction").agg(F.count(F.lit(1)).alias("n"))


def _batch_report(spark, sf_dir) -> dict[str, DataFrame]:
    from scorewright.plans.jobs import batch_report
    raw = _churn_strings(spark, sf_dir).select(*CHURN.required)
    model = fit_features(clean_blank_zero(raw, CHURN), CHURN)
    w = churn_weights(_feature_size(model, len(CHURN.numeric)))
    return batch_report(raw, CHURN, lambda ok: linear_score(model.transform(ok), "features", w, CHURN_INTERCEPT),
                        [F.col("customerID").cast("long")])


@register("batch_report_scored")
def q_batch_report_scored(spark, sf_dir):
    """Scored side of the batch report: customers without an issue, by their row in customer order."""
    return _batch_report(spark, sf_dir)["scored"].withColumn("probability", F.round("probability", 6))


@register("batch_report_issues")
def q_batch_report_issues(spark, sf_dir):
    """Issue side of the batch report: one row per missing or unreadable value."""
    return _batch_report(spark, sf_dir)["issues"]


@register("batch_report_malformed")
def q_batch_report_malformed(spark, sf_dir):
    """Both sides of the batch report of a CSV with malformed lines: a malformed line is one issue and is not scored."""
    from scorewright.plans.jobs import batch_report
    from scorewright.sources.csv import MALFORMED, read_csv_checked
    from scorewright.sources.tables import malformed_csv_path
    raw = read_csv_checked(spark, malformed_csv_path(spark, sf_dir)).select(*CHURN.required, MALFORMED)
    model = fit_features(clean_blank_zero(raw.filter(F.col(MALFORMED).isNull()), CHURN), CHURN)
    w = churn_weights(_feature_size(model, len(CHURN.numeric)))
    r = batch_report(raw, CHURN, lambda ok: linear_score(model.transform(ok), "features", w, CHURN_INTERCEPT), [F.col("customerID").cast("long")])
    scored = r["scored"].select("row", F.lit("scored").alias("side"), "id", "prediction", F.lit(None).cast("string").alias("error"))
    issues = r["issues"].select("row", F.lit("issue").alias("side"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("double").alias("prediction"),
                                # of a malformed line its first field: the rest is text as the writer formats it
                                F.when(F.col("error").startswith("malformed line"), F.substring_index("error", ",", 1)).otherwise(F.col("error")).alias("error"))
    return scored.unionByName(issues)


@register("roc_points")
def q_roc_points(spark, sf_dir):
    """The ROC curves of the fixed rules, down-sampled to about 50 points a rule, in one plan."""
    from scorewright.operators.metrics import roc_points
    p = roc_points(_rules_stacked(spark, sf_dir), score="raw", group=["model"], bins=50)
    return p.select("model", "point", F.round("threshold", 6).alias("threshold"), "fpr", "tpr")


@register("decision_text")
def q_decision_text(spark, sf_dir):
    from scorewright.functions.scalar import decision_text, percent
    s = churn_scored(spark, sf_dir)
    return s.select("customerID", decision_text("prediction").alias("decision"),
                    percent("probability").alias("leave_probability"))


@register("confidence_modes")
def q_confidence_modes(spark, sf_dir):
    s = churn_scored(spark, sf_dir)
    pred = F.when(F.col("prediction") == 1.0, F.col("probability")).otherwise(1.0 - F.col("probability"))
    return s.select("customerID", F.round("probability", 6).alias("conf_positive"),
                    F.round(pred, 6).alias("conf_predicted"))


@register("preview_scored")
def q_preview_scored(spark, sf_dir):
    s = churn_scored(spark, sf_dir)
    return (s.select("customerID", "segment", "nation", CHURN.target, "prediction",
                     F.round("probability", 6).alias("probability"))
            .orderBy(F.col("customerID").cast("long")).limit(10))


@register("row_ids")
def q_row_ids(spark, sf_dir):
    from scorewright.operators.rank import global_row_number
    from scorewright.sources.tables import churn_table
    t = churn_table(spark, sf_dir).select("customerID", "custkey")
    return global_row_number(t, ["custkey"]).select("customerID", "row_id")


# ---------------------------------------------------------------- sources and cleaning
CHURN_CSV_SCHEMA = ("customerID string, segment string, nation string, region string, top_priority string, "
                    "n_orders int, tenure int, avg_order double, total_spent double, acctbal double, churn string")


def _churn_strings(spark, sf_dir) -> DataFrame:
    return read_csv_strings(spark, churn_csv_path(spark, sf_dir))


@register("scan_csv")
def q_scan_csv(spark, sf_dir):
    from scorewright.sources.csv import read_csv
    return read_csv(spark, churn_csv_path(spark, sf_dir), schema=CHURN_CSV_SCHEMA)


@register("scan_csv_strings")
def q_scan_csv_strings(spark, sf_dir):
    return _churn_strings(spark, sf_dir).select("customerID", "segment", "nation", "region", "top_priority",
                                                "n_orders", "tenure", "churn")


@register("scan_csv_inferred")
def q_scan_csv_inferred(spark, sf_dir):
    """The CSV with inferred types: its values, and the type inferred for each column."""
    from scorewright.sources.csv import read_csv
    df = read_csv(spark, churn_csv_path(spark, sf_dir), infer=True)
    types = F.concat_ws(",", *[F.lit(f"{f.name}:{f.dataType.simpleString()}") for f in df.schema.fields])
    return df.withColumns({"types": types, "total_spent": F.col("total_spent").try_cast("double")})


@register("clean_blank_drop")
def q_clean_blank_drop(spark, sf_dir):
    from scorewright.operators.clean import clean_blank_drop
    return clean_blank_drop(_churn_strings(spark, sf_dir), CHURN).drop("churn")


@register("clean_blank_zero")
def q_clean_blank_zero(spark, sf_dir):
    return clean_blank_zero(_churn_strings(spark, sf_dir), CHURN)


@register("typed_casts")
def q_typed_casts(spark, sf_dir):
    from scorewright.operators.clean import typed_casts
    return typed_casts(_churn_strings(spark, sf_dir), CHURN.int_columns, CHURN.double_columns)


@register("derive_label")
def q_derive_label(spark, sf_dir):
    from scorewright.operators.clean import derive_label
    return derive_label(_churn_strings(spark, sf_dir), CHURN.target, CHURN.positive).select("customerID", "label")


@register("quarantine_rows")
def q_quarantine_rows(spark, sf_dir):
    from scorewright.operators.clean import quarantine
    q = quarantine(_churn_strings(spark, sf_dir), CHURN)
    return q.select("customerID", "status", F.concat_ws("; ", "errors").alias("error"), "tenure", "total_spent")


# ---------------------------------------------------------------- encoding
def _clean_table(spark, sf_dir) -> DataFrame:
    return clean_blank_zero(_churn_strings(spark, sf_dir), CHURN)


@register("string_index")
def q_string_index(spark, sf_dir):
    from scorewright.operators.features import idx_col, indexer
    df = _clean_table(spark, sf_dir)
    m = indexer(CHURN.categorical).fit(df)
    return m.transform(df).select("customerID", *[F.col(idx_col(c)).cast("int").alias(idx_col(c))
                                                  for c in CHURN.categorical])


@register("one_hot")
def q_one_hot(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from scorewright.operators.features import indexer, one_hot, vec_col
    df = _clean_table(spark, sf_dir)
    m = Pipeline(stages=[indexer(CHURN.categorical), one_hot(CHURN.categorical)]).fit(df)
    out = m.transform(df)
    return out.select("customerID", *[
        (F.array_position(vector_to_array(vec_col(c)), F.lit(1.0)) - 1).cast("int").alias(f"{c}_hot")
        for c in CHURN.categorical])


@register("assemble")
def q_assemble(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    df = _clean_table(spark, sf_dir)
    out = fit_features(df, CHURN).transform(df).withColumn("_a", vector_to_array("features"))
    return out.select(
        "customerID", F.size("_a").alias("n_features"),
        F.size(F.filter("_a", lambda x: x != 0.0)).alias("nnz"),
        F.aggregate(F.transform("_a", lambda x, i: x * (i + 1).cast("double")), F.lit(0.0),
                    lambda acc, x: acc + x).alias("checksum"))


def _scaled(spark, sf_dir, center: bool) -> DataFrame:
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from scorewright.operators.features import assembler, scaler
    df = _clean_table(spark, sf_dir)
    m = Pipeline(stages=[assembler(CHURN.numeric, [], "raw_features"),
                         scaler("raw_features", "scaled", with_mean=center)]).fit(df)
    out = m.transform(df).withColumn("_s", vector_to_array("scaled"))
    return out.select("customerID", *[F.round(F.col("_s")[i], 6).alias(c) for i, c in enumerate(CHURN.numeric)])


@register("standard_scale")
def q_standard_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, center=False)


# ---------------------------------------------------------------- split, replicate, sample
@register("holdout_split")
def q_holdout_split(spark, sf_dir):
    from scorewright.operators.split import split_column
    from scorewright.sources.tables import churn_table
    return split_column(churn_table(spark, sf_dir), "custkey").select("customerID", "split")


@register("replicate")
def q_replicate(spark, sf_dir):
    from scorewright.operators.split import replicate
    from scorewright.sources.tables import churn_table
    return replicate(churn_table(spark, sf_dir).select("customerID", "churn"), 200)


# ---------------------------------------------------------------- embeddings, labels, sinks
def _emb(spark, sf_dir) -> DataFrame:
    from scorewright.sources.tables import embeddings_table
    return embeddings_table(spark, sf_dir)


def _emb_scored(spark, sf_dir) -> DataFrame:
    from scorewright.plans.fixed import EMBED_INTERCEPT, embed_weights
    e = _emb(spark, sf_dir)
    low, dim = e.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if low != dim:
        raise ValueError(f"embeddings of lengths {low} to {dim}: one length expected")
    return linear_score(e, "embedding", embed_weights(dim), EMBED_INTERCEPT)


@register("linear_score")
def q_linear_score(spark, sf_dir):
    s = _emb_scored(spark, sf_dir)
    return s.select("vec_id", "prediction", F.round("probability", 6).alias("probability"))


@register("class_counts")
def q_class_counts(spark, sf_dir):
    from scorewright.operators.metrics import class_counts
    return class_counts(_emb(spark, sf_dir), "label")


@register("class_weights")
def q_class_weights(spark, sf_dir):
    from scorewright.operators.metrics import with_class_weights
    return with_class_weights(_emb(spark, sf_dir), "label").select("vec_id", "label", "classWeight")


@register("feature_filter")
def q_feature_filter(spark, sf_dir):
    from scorewright.functions.scalar import has_nonzero
    e = _emb(spark, sf_dir)
    return e.filter(F.col("embedding").isNotNull() & has_nonzero("embedding")).select("vec_id", "label")


def _image_names(spark, sf_dir) -> DataFrame:
    """File paths derived from the embeddings table: ``/data/images/<class>/img_<id><ext>``."""
    from scorewright.plans.fixed import NAME_EXTENSIONS
    e = _emb(spark, sf_dir)
    ext = F.element_at(F.array(*[F.lit(x) for x in NAME_EXTENSIONS]),
                       (F.col("vec_id") % len(NAME_EXTENSIONS) + 1).cast("int"))
    return e.select("vec_id", F.concat(F.lit("file:/data/images/"), F.col("class_name"), F.lit("/img_"),
                                       F.col("vec_id").cast("string"), ext).alias("origin"))


@register("path_label")
def q_path_label(spark, sf_dir):
    from scorewright.functions.scalar import parent_dir
    return _image_names(spark, sf_dir).select("vec_id", parent_dir("origin").alias("label"))


@register("file_extension")
def q_file_extension(spark, sf_dir):
    from scorewright.functions.scalar import file_extension
    from scorewright.specs import IMAGE_EXTENSIONS
    n = _image_names(spark, sf_dir)
    ext = file_extension("origin")
    return n.select("vec_id", ext.alias("ext"), ext.isin(IMAGE_EXTENSIONS).alias("is_image"))


def _label_map_path(spark, sf_dir) -> str:
    """Fit the class-name indexer on the embeddings and write its label map once (sink K2)."""
    from scorewright.operators.features import indexer
    from scorewright.session import stage_key, work_path
    from scorewright.sinks import fs, write_label_map
    path = work_path(spark, "stage", f"label_map-{stage_key(spark, sf_dir)}")

    def write(tmp):
        m = indexer(["class_name"], handle_invalid="error").fit(_emb(spark, sf_dir))
        write_label_map(spark, m.labelsArray[0], tmp)
    return fs.stage_once(spark, path, write)


@register("sink_label_map")
def q_sink_label_map(spark, sf_dir):
    return spark.read.json(_label_map_path(spark, sf_dir)).select(F.col("index").cast("int"), "label")


@register("label_map")
def q_label_map(spark, sf_dir):
    from scorewright.sources.labels import read_label_map
    return read_label_map(spark, _label_map_path(spark, sf_dir))


def _stage_text(spark, sf_dir, name: str, text_df_fn) -> str:
    from scorewright.session import stage_key, work_path
    from scorewright.sinks import fs
    path = work_path(spark, "stage", f"{name}-{stage_key(spark, sf_dir)}")
    return fs.stage_once(spark, path, lambda tmp: text_df_fn().repartition(1).write.text(tmp))


@register("label_map_tolerant")
def q_label_map_tolerant(spark, sf_dir):
    """Label lines plus one malformed line and one line without ``index``."""
    from scorewright.sources.labels import read_label_map, read_label_map_tolerant
    good = _label_map_path(spark, sf_dir)

    def text():
        lines = read_label_map(spark, good).select(F.to_json(F.struct("index", "label")).alias("value"))
        junk = lines.limit(1).select(F.lit('{"index": 3, "label": ').alias("value"))
        nokey = lines.limit(1).select(F.lit('{"label": "orphan"}').alias("value"))
        return lines.unionByName(junk).unionByName(nokey)
    return read_label_map_tolerant(spark, _stage_text(spark, sf_dir, "label_map_dirty", text))


@register("label_map_object")
def q_label_map_object(spark, sf_dir):
    """The whole-file form ``{"0": "...", "1": "..."}`` (the tolerant reader's fallback)."""
    from scorewright.sources.labels import read_label_map, read_label_map_tolerant
    good = _label_map_path(spark, sf_dir)

    def text():
        m = read_label_map(spark, good)
        # one row: the map has one entry per class (bounded by the indexer's label count)
        return m.agg(F.to_json(F.map_from_entries(F.collect_list(
            F.struct(F.col("index").cast("string"), F.col("label"))))).alias("value"))
    return read_label_map_tolerant(spark, _stage_text(spark, sf_dir, "label_map_object", text))


@register("label_lookup")
def q_label_lookup(spark, sf_dir):
    from scorewright.operators.scoring import label_lookup
    from scorewright.sources.labels import read_label_map
    s = _emb_scored(spark, sf_dir)
    return label_lookup(s, read_label_map(spark, _label_map_path(spark, sf_dir)), "prediction").select(
        "vec_id", "label_name")


def _sink_dir(spark, name: str) -> str:
    import uuid

    from scorewright.session import work_path
    return work_path(spark, "out", f"{name}-{uuid.uuid4().hex[:8]}")


@register("sink_metrics_json")
def q_sink_metrics_json(spark, sf_dir):
    from scorewright.operators.metrics import accuracy
    from scorewright.sinks import write_json_single
    s = _emb_scored(spark, sf_dir).withColumn("y", (F.col("label") < 5).cast("int"))
    path = write_json_single(accuracy(s, "y", "prediction"), _sink_dir(spark, "metrics"))
    return spark.read.schema("accuracy double").json(path)


def _preds(spark, sf_dir) -> DataFrame:
    from scorewright.operators.scoring import label_lookup
    from scorewright.sources.labels import read_label_map
    s = _emb_scored(spark, sf_dir)
    s = label_lookup(s, read_label_map(spark, _label_map_path(spark, sf_dir)), "prediction")
    return s.select(F.concat(F.lit("img,"), F.col("vec_id").cast("string"), F.lit(".png")).alias("filename"),
                    F.col("label_name").alias("label"), F.round("confidence", 6).alias("confidence"))


@register("sink_single_csv")
def q_sink_single_csv(spark, sf_dir):
    from scorewright.sinks import write_single_csv
    out = _sink_dir(spark, "preds")
    path = write_single_csv(spark, _preds(spark, sf_dir), out, "preds.csv")
    return spark.read.option("header", True).schema("filename string, label string, confidence double").csv(path)


@register("sink_scores_csv")
def q_sink_scores_csv(spark, sf_dir):
    from scorewright.sinks import write_csv
    path = write_csv(q_score_ids(spark, sf_dir), _sink_dir(spark, "scores"))
    return spark.read.option("header", True).schema("id string, churn string").csv(path)


# ---------------------------------------------------------------- wholesale clustering
def _wholesale_scaled(spark, sf_dir, center: bool = True) -> DataFrame:
    from pyspark.ml import Pipeline

    from scorewright.operators.features import assembler, scaler
    from scorewright.sources.tables import wholesale_path
    from scorewright.specs import WHOLESALE_STANDIN_COLUMNS as W
    t = spark.read.parquet(wholesale_path(spark, sf_dir))
    m = Pipeline(stages=[assembler(W, [], "raw_features"), scaler("raw_features", "features", with_mean=center)]).fit(t)
    return m.transform(t)


@register("standard_scale_centered")
def q_standard_scale_centered(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    from scorewright.specs import WHOLESALE_STANDIN_COLUMNS as W
    s = _wholesale_scaled(spark, sf_dir).withColumn("_a", vector_to_array("features"))
    return s.select("custkey", *[F.round(F.col("_a")[i], 6).alias(c) for i, c in enumerate(W)])


def _assigned(spark, sf_dir) -> DataFrame:
    from scorewright.operators.scoring import assign_cluster
    from scorewright.plans.fixed import wholesale_centres
    from scorewright.specs import KMEANS_PARAMS
    from scorewright.specs import WHOLESALE_STANDIN_COLUMNS as W
    s = _wholesale_scaled(spark, sf_dir)
    return assign_cluster(s, "features", wholesale_centres(KMEANS_PARAMS["k"], len(W)))


@register("assign_cluster")
def q_assign_cluster(spark, sf_dir):
    return _assigned(spark, sf_dir).select("custkey", "prediction")


@register("cluster_profile")
def q_cluster_profile(spark, sf_dir):
    from scorewright.operators.cluster import cluster_profile
    from scorewright.specs import WHOLESALE_STANDIN_COLUMNS as W
    return cluster_profile(_assigned(spark, sf_dir), W, fixed_decimals=2)


@register("silhouette")
def q_silhouette(spark, sf_dir):
    from scorewright.operators.metrics import silhouette
    return silhouette(_assigned(spark, sf_dir)).select(F.round("silhouette", 6).alias("silhouette"))


def _fitted_clusters(spark, sf_dir) -> DataFrame:
    from scorewright.operators.cluster import fit_kmeans
    from scorewright.operators.scoring import assign_cluster
    s = _wholesale_scaled(spark, sf_dir)
    m = fit_kmeans(s, key="custkey")
    centres = [[float(v) for v in c] for c in m.clusterCenters()]
    return assign_cluster(m.transform(s), "features", centres, "nearest")


@register("cluster_customers")
def q_cluster_customers(spark, sf_dir):
    """Every customer's cluster by the fitted model (as its transform says and as the nearest fitted centre)."""
    return _fitted_clusters(spark, sf_dir).select("custkey", "prediction", "nearest")


@register("sweep_k")
def q_sweep_k(spark, sf_dir):
    """Silhouette and cost of one fit per k."""
    from scorewright.operators.cluster import sweep_k
    return sweep_k(_wholesale_scaled(spark, sf_dir), key="custkey").select("k", "silhouette", "cost")


@register("cluster_plot_sample")
def q_cluster_plot_sample(spark, sf_dir):
    """The random 10% of the fitted clusters' points, for plotting: two spend columns and the cluster.  Every row also tells
    what holds of all points, each met with its picked row: their number, whether each was picked at most once and as
    it was, and whether about a tenth were."""
    from scorewright.operators.cluster import fit_kmeans
    from scorewright.operators.split import sample_rows
    s = _wholesale_scaled(spark, sf_dir)
    m = fit_kmeans(s, key="custkey")
    points = m.transform(s).select("custkey", "medium", "standard", "prediction")
    sample = sample_rows(points, 0.1)
    picked = sample.select(F.col("custkey").alias("key"), F.struct("medium", "standard", "prediction").alias("picked"))
    met = points.join(picked, F.col("custkey").eqNullSafe(F.col("key")), "full")
    n, k = F.count("prediction"), F.count("picked")
    told = met.agg(n.alias("points"), (n == F.count(F.lit(1))).alias("each_once"),
                   F.every(F.col("picked").isNull() | (F.struct("medium", "standard", "prediction") == F.col("picked"))).alias("as_it_was"),
                   (F.abs(k - 0.1 * n) <= 5 * F.sqrt(0.09 * n) + 1).alias("about_a_tenth"))
    return sample.crossJoin(told)


# ---------------------------------------------------------------- training (rows-only checks)
def _churn_train_test(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    from scorewright.operators.clean import clean_blank_drop
    from scorewright.operators.split import holdout_split
    df = clean_blank_drop(_churn_strings(spark, sf_dir), CHURN)
    df = df.fillna({"tenure": 0})      # bad integers: the assembler refuses nulls
    return holdout_split(df, "customerID")


def _train_churn(spark, sf_dir, kind: str, **params) -> DataFrame:
    from scorewright.operators.models import classifier, fit_pipeline, positive_probability
    train, test = _churn_train_test(spark, sf_dir)
    m = fit_pipeline(train, CHURN, classifier(kind, **params))
    return positive_probability(m.transform(test))


def _churn_answers(spark, sf_dir, kind: str, **params) -> DataFrame:
    """The test customers with their label, the fitted model's answer and its probability of leaving."""
    return _train_churn(spark, sf_dir, kind, **params).select("customerID", "label", "prediction", "p1")


@register("train_churn_rf")
def q_train_churn_rf(spark, sf_dir):
    return _churn_answers(spark, sf_dir, "rf", seed=42)


@register("train_churn_gbt")
def q_train_churn_gbt(spark, sf_dir):
    return _churn_answers(spark, sf_dir, "gbt", seed=42)


@register("train_churn_lr")
def q_train_churn_lr(spark, sf_dir):
    return _churn_answers(spark, sf_dir, "lr")


def _compare(spark, sf_dir, out_dir: str | None = None):
    """The comparison job with its default replication (x200) on the dirty churn CSV."""
    from scorewright.operators.models import classifier
    from scorewright.plans.jobs import compare_churn_models
    return compare_churn_models(spark, churn_csv_path(spark, sf_dir), out_dir, spec=CHURN, candidates={
        "Random Forest": classifier("rf", seed=42),
        "Gradient Boosted Tree": classifier("gbt", seed=42),
        "Logistic Regression": classifier("lr"),
    })


@register("compare_models")
def q_compare_models(spark, sf_dir):
    """Model, AUC, Accuracy, Precision, Recall, F1, TrainTime(s) as the job reports them."""
    return _compare(spark, sf_dir)


@register("sink_comparison_csv")
def q_sink_comparison_csv(spark, sf_dir):
    out = _sink_dir(spark, "comparison")
    _compare(spark, sf_dir, out)
    return spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/model_comparison.csv")


def _saved_churn_model(spark, sf_dir, kind: str) -> str:
    """Path of a pipeline fitted on the training part with the default parameters and saved (overwrite)."""
    from scorewright.operators.models import classifier, fit_pipeline
    from scorewright.sinks import save_model
    train, _ = _churn_train_test(spark, sf_dir)
    return save_model(fit_pipeline(train, CHURN, classifier(kind, seed=42)), _sink_dir(spark, f"model_{kind}"))


@register("score_saved_model")
def q_score_saved_model(spark, sf_dir):
    """Fit, save (overwrite), load, and score the whole cleaned table with the loaded model."""
    from pyspark.ml import PipelineModel

    from scorewright.operators.models import positive_probability
    loaded = PipelineModel.load(_saved_churn_model(spark, sf_dir, "rf"))
    return positive_probability(loaded.transform(_clean_table(spark, sf_dir))).select(F.col("customerID").alias("id"), "prediction", "p1")


def _score_trees(spark, sf_dir, kind: str) -> DataFrame:
    from pyspark.ml import PipelineModel

    from scorewright.operators.trees import read_forest, score_trees
    path = _saved_churn_model(spark, sf_dir, kind)
    encoded = PipelineModel(PipelineModel.load(path).stages[:-1]).transform(_clean_table(spark, sf_dir))
    told = score_trees(encoded, read_forest(spark, path))
    return told.select(F.col("customerID").alias("id"), "prediction", F.get("probability", F.lit(1)).alias("p1"))


@register("score_trees_rf")
def q_score_trees_rf(spark, sf_dir):
    """The whole table scored from the saved forest's node table, without the model class."""
    return _score_trees(spark, sf_dir, "rf")


@register("score_trees_gbt")
def q_score_trees_gbt(spark, sf_dir):
    """The whole table scored from the saved boosted trees' node table, without the model class."""
    return _score_trees(spark, sf_dir, "gbt")


@register("score_trees_fixed")
def q_score_trees_fixed(spark, sf_dir):
    """The whole table scored by two fixed forests over its numeric columns, one voting and one boosted."""
    from scorewright.operators.trees import score_trees
    from scorewright.plans.fixed import fixed_forest
    x = _clean_table(spark, sf_dir).withColumn("features", F.array(*[F.col(c).cast("double") for c in CHURN.numeric]))
    for kind in ("rf", "gbt"):
        x = score_trees(x, fixed_forest(spark, kind), raw_col=f"{kind}_raw", probability_col=f"{kind}_p", prediction_col=f"{kind}_prediction")
    return x.select("customerID", *[c for kind in ("rf", "gbt") for c in (
        F.round(F.get(f"{kind}_p", F.lit(1)), 6).alias(f"{kind}_p1"), F.col(f"{kind}_prediction"))])


def _emb_train_test(spark, sf_dir, weighted: bool):
    from pyspark.ml.functions import array_to_vector

    from scorewright.operators.features import indexer
    from scorewright.operators.metrics import with_class_weights
    from scorewright.operators.split import holdout_split
    e = _emb(spark, sf_dir).withColumn("features_vec", array_to_vector(F.col("embedding").cast("array<double>")))
    ix = indexer(["class_name"], handle_invalid="error").fit(e)
    e = ix.transform(e).withColumnRenamed("class_name_idx", "labelIndex")
    if weighted:
        e = with_class_weights(e, "labelIndex")
    return holdout_split(e, "vec_id"), ix


def _train_emb(spark, sf_dir, weighted: bool) -> DataFrame:
    from pyspark.ml.classification import LogisticRegression

    from scorewright.operators.scoring import model_confidence
    from scorewright.specs import LR_EMBEDDING_PARAMS, LR_WEIGHTED_PARAMS
    (train, test), _ = _emb_train_test(spark, sf_dir, weighted)
    if weighted:
        lr = LogisticRegression(featuresCol="features_vec", labelCol="labelIndex", weightCol="classWeight",
                                **LR_WEIGHTED_PARAMS)
    else:
        lr = LogisticRegression(featuresCol="features_vec", labelCol="labelIndex", **LR_EMBEDDING_PARAMS)
    m = lr.fit(train)
    out = m.transform(test)
    return out.select("vec_id", F.col("labelIndex").cast("int").alias("labelIndex"), "prediction",
                      model_confidence("probability", "prediction").alias("confidence"))


@register("train_embedding_lr")
def q_train_embedding_lr(spark, sf_dir):
    return _train_emb(spark, sf_dir, weighted=False)


@register("train_embedding_lr_weighted")
def q_train_embedding_lr_weighted(spark, sf_dir):
    return _train_emb(spark, sf_dir, weighted=True)


# ---------------------------------------------------------------- images
def _vec_id_from(path_col: str):
    return F.regexp_extract(F.col(path_col), r"img[_,](\d+)\.[A-Za-z]+$", 1).cast("long")


@register("scan_images")
def q_scan_images(spark, sf_dir):
    from scorewright.sources.images import read_images, with_path_label
    from scorewright.sources.tables import pet_image_dir
    imgs = with_path_label(read_images(spark, pet_image_dir(spark, sf_dir) + "/*"))
    return imgs.select(_vec_id_from("image.origin").alias("vec_id"), "label",
                       F.col("image.height").alias("height"), F.col("image.width").alias("width"),
                       F.col("image.nChannels").alias("nChannels"))


@register("image_features")
def q_image_features(spark, sf_dir):
    """Every feature of every image (one row without a place for an image that failed)."""
    from scorewright.operators.embed import image_features
    from scorewright.sources.images import read_images
    from scorewright.sources.tables import pet_image_dir
    f = image_features(read_images(spark, pet_image_dir(spark, sf_dir) + "/*"))
    return f.select(_vec_id_from("image.origin").alias("vec_id"), F.col("emb.error").alias("error"),
                    F.posexplode_outer(F.col("emb.features").cast("array<double>")).alias("place", "value"))


@register("zip_members")
def q_zip_members(spark, sf_dir):
    from scorewright.sources.images import zip_members
    from scorewright.sources.tables import image_zip_dir
    m = zip_members(spark, image_zip_dir(spark, sf_dir))
    return m.select(F.element_at(F.split("archive", "/"), -1).alias("archive"), "name", "error")


def _pet_model(spark, sf_dir) -> tuple[str, str]:
    """Binary image LR trained once per input folder on the pet pictures; (model, label map)."""
    from scorewright.plans.jobs import train_image_lr
    from scorewright.session import stage_key, work_path
    from scorewright.sinks import fs
    from scorewright.sources.tables import pet_image_dir
    root = work_path(spark, "stage", f"pet_model-{stage_key(spark, sf_dir)}")

    def write(tmp):
        train_image_lr(spark, pet_image_dir(spark, sf_dir) + "/*", f"{tmp}/model", f"{tmp}/labels")
        fs.touch(spark, f"{tmp}/_SUCCESS")          # written last: the model and labels are complete
    fs.stage_once(spark, root, write)
    return f"{root}/model", f"{root}/labels"


@register("train_image_lr")
def q_train_image_lr(spark, sf_dir):
    from scorewright.plans.jobs import train_image_lr
    from scorewright.sources.tables import pet_image_dir
    r = train_image_lr(spark, pet_image_dir(spark, sf_dir) + "/*", weighted=True)
    from scorewright.operators.scoring import model_confidence
    return r["predictions"].select(_vec_id_from("origin").alias("vec_id"), "label", F.col("labelIndex").cast("int").alias("labelIndex"), "prediction",
                                   model_confidence("probability", "prediction").alias("confidence"))


@register("score_images")
def q_score_images(spark, sf_dir):
    """Every image of the folder with its label and p(predicted class), failed ones as ERROR."""
    from scorewright.plans.jobs import score_images
    from scorewright.sources.tables import pet_image_dir
    model_dir, labels_dir = _pet_model(spark, sf_dir)
    return score_images(spark, pet_image_dir(spark, sf_dir) + "/*", model_dir, labels_dir).select(
        _vec_id_from("origin").alias("vec_id"), "label", "confidence")


def _score_zip(spark, sf_dir, single_file: bool = False) -> DataFrame:
    from scorewright.plans.jobs import score_zip
    from scorewright.sources.tables import image_zip_dir
    model_dir, labels_dir = _pet_model(spark, sf_dir)
    out = _sink_dir(spark, "zip_preds")
    score_zip(spark, image_zip_dir(spark, sf_dir), model_dir, labels_dir, out, single_file=single_file)
    if single_file:
        return spark.read.option("header", True).schema("filename string, label string, confidence double").csv(f"{out}/preds.csv")
    return spark.read.option("header", True).schema("archive string, filename string, label string, confidence double").csv(out)


@register("score_zip")
def q_score_zip(spark, sf_dir):
    """Every image member with its archive, label and p(class 1), read back from the distributed CSV."""
    return _score_zip(spark, sf_dir)


@register("error_rows")
def q_error_rows(spark, sf_dir):
    return _score_zip(spark, sf_dir, single_file=True).filter(F.col("label") == "ERROR")


@register("wholesale_spend")
def q_wholesale_spend(spark, sf_dir):
    """The wholesale stand-in itself: lineitem x orders x part, spend pivoted on six part types."""
    from scorewright.sources.tables import wholesale_table
    return wholesale_table(spark, sf_dir)


@register("wholesale_plot_all")
def q_wholesale_plot_all(spark, sf_dir):
    """Plot data of the wholesale job: two spend columns + cluster of all customers, read back from its file."""
    path = _sink_dir(spark, "plot")
    _assigned(spark, sf_dir).select("custkey", "medium", "standard", "prediction").write.parquet(path)
    return spark.read.parquet(path)


@register("plot_sample_keyed")
def q_plot_sample_keyed(spark, sf_dir):
    """Plot data (two spend columns + cluster) for a reproducible 10% of customers: the keyed form
    of the plot sample, on the fixed-centre assignment."""
    from scorewright.operators.split import sample_rows
    return sample_rows(_assigned(spark, sf_dir).select("custkey", "medium", "standard", "prediction"), 0.1,
                       key="custkey")
