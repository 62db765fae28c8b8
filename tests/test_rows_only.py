"""Queries without an exact SQL form (model fits, sampling, images): invariants on sf0.001."""

from __future__ import annotations

import pytest
from conftest import SF001
from pyspark.sql import functions as F

import __spark_entry__ as entry

Q = entry.queries()


def _rows(spark, name):
    return Q[name](spark, SF001).collect()


def test_cluster_ids_in_range(spark):
    from scorewright.plans.queries import _fitted_clusters

    rows = _fitted_clusters(spark, SF001).collect()
    assert len(rows) == Q["wholesale_spend"](spark, SF001).count()
    assert {r["prediction"] for r in rows} <= set(range(5)) and all(r["prediction"] == r["nearest"] for r in rows)


def test_sweep_k_equals_the_evaluator(spark):
    """Silhouette and cost of every k as the evaluator and a sum over points give them; the models don't depend on being fitted together."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator

    from scorewright.operators.cluster import stable_layout, sweep_k
    from scorewright.plans.queries import _wholesale_scaled

    data = stable_layout(_wholesale_scaled(spark, SF001), "custkey").cache()
    rows = sweep_k(_wholesale_scaled(spark, SF001), ks=(2, 3, 5), key="custkey").collect()
    apart = sweep_k(_wholesale_scaled(spark, SF001), ks=(2, 3, 5), key="custkey", together=False).collect()
    assert [r["k"] for r in rows] == [2, 3, 5] and all(r["train_time_s"] > 0 for r in rows)
    for c in ("silhouette", "cost"):
        assert [r[c] for r in rows] == pytest.approx([r[c] for r in apart], rel=1e-9)
    for r in rows:
        m = KMeans(k=r["k"], seed=42, featuresCol="features").fit(data.select("features"))
        told = m.transform(data)
        assert r["silhouette"] == pytest.approx(ClusteringEvaluator(featuresCol="features").evaluate(told), abs=1e-9)
        centres = [c.tolist() for c in m.clusterCenters()]
        cost = sum(min(sum((a - b) ** 2 for a, b in zip(x["features"].toArray(), c)) for c in centres) for x in data.collect())
        assert r["cost"] == pytest.approx(cost, rel=1e-9)
    data.unpersist()


def test_sweep_k_scans_twice_after_the_fits(spark):
    from scorewright.operators.cluster import measure_clusterings
    from scorewright.plans.queries import _wholesale_scaled

    df = _wholesale_scaled(spark, SF001)
    out = measure_clusterings(df, {2: [[0.0] * 6, [1.0] * 6], 3: [[0.0] * 6, [1.0] * 6, [5.0] * 6]})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") + plan.count("SortAggregate") == 2 and "CartesianProduct" not in plan      # partial and final, all k in one


def test_plot_sample_is_a_subset(spark):
    points = {r["custkey"]: tuple(r)[1:] for r in Q["wholesale_plot_all"](spark, SF001).collect()}
    rows = _rows(spark, "cluster_plot_sample")
    assert len({r["custkey"] for r in rows}) == len(rows) and all((r["medium"], r["standard"]) == points[r["custkey"]][:2] for r in rows)
    assert abs(len(rows) - 0.1 * len(points)) <= 5 * (0.09 * len(points)) ** 0.5 + 1 and {r["prediction"] for r in rows} <= set(range(5))


@pytest.mark.parametrize("kind", ["rf", "gbt", "lr"])
def test_churn_models_score_the_test_split(spark, kind):
    from scorewright.plans.queries import _train_churn

    rows = _train_churn(spark, SF001, kind).collect()
    tests = Q["holdout_split"](spark, SF001).filter("split = 'test'").count()
    assert 0 < len(rows) <= tests
    assert all(0.0 <= r["p1"] <= 1.0 and r["prediction"] in (0.0, 1.0) for r in rows)


def test_compare_models_table(spark):
    rows = {r["Model"]: r for r in _rows(spark, "compare_models")}
    assert list(rows) == ["Random Forest", "Gradient Boosted Tree", "Logistic Regression"]
    for r in rows.values():
        assert all(0 <= r[c] <= 1 and round(r[c], 4) == r[c] for c in ("AUC", "Accuracy", "Precision", "Recall", "F1")) and r["TrainTime(s)"] > 0


def test_models_fitted_together_are_those_fitted_apart(spark):
    from scorewright.operators.models import classifier, compare_models
    from scorewright.plans.queries import _churn_train_test
    from scorewright.specs import CHURN

    train, test = _churn_train_test(spark, SF001)
    tables = []
    for together in (True, False):
        cands = {"rf": classifier("rf", numTrees=8, seed=1), "gbt": classifier("gbt", maxIter=3, seed=1), "lr": classifier("lr")}
        table, models = compare_models(train, test, CHURN, cands, together=together)
        tables.append([tuple(r)[:-1] for r in table.collect()])
        assert list(models) == ["rf", "gbt", "lr"]
    assert tables[0] == tables[1]


def test_run_together_overlaps_and_raises(spark):
    import threading

    from scorewright.operators.together import run_together

    met = threading.Barrier(3, timeout=20)      # only passed when all three run at the same time
    out = run_together(spark, {n: lambda n=n: (met.wait() is not None, spark.sparkContext.getLocalProperty("spark.scheduler.pool")) for n in "abc"})
    assert {n: v[0][1] for n, v in out.items()} == {"a": "a", "b": "b", "c": "c"} and all(s >= 0 for _, s in out.values())
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None and run_together(spark, {}) == {}
    with pytest.raises(ZeroDivisionError):
        run_together(spark, {"bad": lambda: 1 / 0, "good": lambda: 1})


def test_saved_model_scores_as_before_it_was_saved(spark):
    from scorewright.operators.models import classifier, fit_pipeline, positive_probability
    from scorewright.plans.queries import _churn_train_test, _clean_table
    from scorewright.specs import CHURN

    train, _ = _churn_train_test(spark, SF001)
    df = _clean_table(spark, SF001)
    fresh = positive_probability(fit_pipeline(train, CHURN, classifier("rf", seed=42)).transform(df)).select("customerID", "p1").collect()
    saved = {r["id"]: r for r in _rows(spark, "score_saved_model")}
    assert len(saved) == len(fresh) and all(saved[r["customerID"]]["p1"] == r["p1"] for r in fresh)
    assert all(r["prediction"] == float(r["p1"] > 0.5) for r in saved.values())


@pytest.mark.parametrize("name", ["train_embedding_lr", "train_embedding_lr_weighted"])
def test_embedding_lr(spark, name):
    rows = _rows(spark, name)
    assert rows and all(0 < r["confidence"] <= 1 and r["prediction"] in range(10) and r["labelIndex"] in range(10) for r in rows)
    # ten classes: the predicted one has at least a tenth
    assert all(r["confidence"] >= 0.1 for r in rows) and len({r["prediction"] for r in rows}) > 1


def test_image_pipeline(spark):
    n = spark.read.parquet(f"{SF001}/embeddings.parquet").count()
    scanned = _rows(spark, "scan_images")
    assert len(scanned) == n and {r["label"] for r in scanned} == {"cat", "dog"}
    bad = [r for r in scanned if r["height"] == -1]
    feats = _rows(spark, "image_features")
    assert sum(r["error"] is not None for r in feats) == len(bad)
    members = _rows(spark, "zip_members")
    assert len(members) == n
    preds = _rows(spark, "score_zip")
    assert len(preds) == n and {r["archive"] for r in preds} == {r["archive"] for r in members}
    assert all((r["label"] in ("cat", "dog") and 0 < r["confidence"] < 1) or (r["label"], r["confidence"]) == ("ERROR", 0.0) for r in preds)
    assert sum(r["label"] == "ERROR" for r in preds) == len(bad)


def test_image_answers_agree_with_each_other(spark):
    """The blue channel tells the classes apart: the model finds them, from the folder and from the archives alike."""
    from scorewright.sources.tables import member_name

    folder = {r["vec_id"]: r for r in _rows(spark, "score_images")}
    truth = {r["vec_id"]: "cat" if r["label"] < 5 else "dog" for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()}
    zipped = {r["filename"]: r for r in _rows(spark, "score_zip")}
    assert len(folder) == len(zipped) == len(truth)
    right = [r["label"] == truth[v] for v, r in folder.items() if r["label"] != "ERROR"]
    assert sum(right) > 0.95 * len(right)
    for v, r in folder.items():
        z = zipped[member_name(v)]
        assert r["label"] == z["label"]
        if r["label"] != "ERROR":
            assert r["confidence"] == pytest.approx(max(z["confidence"], 1 - z["confidence"]), abs=1e-9)
    trained = _rows(spark, "train_image_lr")
    assert trained and all(r["label"] == truth[r["vec_id"]] and r["confidence"] > 0.5 for r in trained)
    assert sum(r["prediction"] == r["labelIndex"] for r in trained) > 0.95 * len(trained)


def test_planted_signal_is_learned(spark):
    """Churn stand-in with a planted rule (10% flipped): trained models must find it."""
    from scorewright.functions.scalar import keyed_fraction
    from scorewright.operators.clean import clean_blank_drop
    from scorewright.operators.models import classifier, compare_models
    from scorewright.operators.split import holdout_split
    from scorewright.plans.queries import _churn_strings
    from scorewright.specs import CHURN

    df = clean_blank_drop(_churn_strings(spark, "/root/testdata/sf0.01"), CHURN).fillna({"tenure": 0})
    flip = keyed_fraction(F.col("customerID"), "noise") < F.lit("1999")
    df = df.withColumn("label", ((F.col("n_orders") < 8) != flip).cast("int"))
    train, test = holdout_split(df, "customerID")
    table, _ = compare_models(train, test, CHURN, {"rf": classifier("rf", seed=42), "lr": classifier("lr")})
    aucs = {r["model"]: r["auc"] for r in table.collect()}
    assert aucs["rf"] > 0.8 and aucs["lr"] > 0.8, aucs


def test_embedding_lr_learns_planted_rule(spark):
    """Embeddings labelled by the sign of a fixed dot product: weighted LR must recover it."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    from scorewright.functions.scalar import dot
    from scorewright.operators.metrics import accuracy, with_class_weights
    from scorewright.operators.split import holdout_split
    from scorewright.plans.fixed import embed_weights
    from scorewright.sources.tables import embeddings_table

    e = embeddings_table(spark, "/root/testdata/sf0.01")
    e = e.withColumn("x", F.col("embedding").cast("array<double>"))
    e = e.withColumn("y", (dot(F.col("x"), embed_weights(64)) > 0).cast("double"))
    e = with_class_weights(e.withColumn("features", array_to_vector("x")), "y")
    train, test = holdout_split(e, "vec_id")
    m = LogisticRegression(labelCol="y", weightCol="classWeight", maxIter=50, regParam=0.01,
                           elasticNetParam=0.0).fit(train)
    acc = accuracy(m.transform(test), "y", "prediction").first()["accuracy"]
    assert acc > 0.9, acc


def test_staged_inputs_follow_replaced_tables(spark, tmp_path):
    """New files in the same folder are seen: staged inputs are keyed on names, lengths and times."""
    import shutil

    for src, n in (("/root/testdata/sf0.001", 150), ("/root/testdata/sf0.01", 1500)):
        for t in ("customer", "orders", "nation", "region"):
            shutil.copyfile(f"{src}/{t}.parquet", tmp_path / f"{t}.parquet")
        spark.catalog.clearCache()
        assert Q["scan_csv_strings"](spark, str(tmp_path)).count() == n


def test_each_image_is_embedded_once(spark, tmp_path):
    import os

    from scorewright.plans.jobs import train_image_lr
    from scorewright.sources.tables import pet_image_dir

    log = str(tmp_path / "calls")
    os.makedirs(log)

    def factory():
        import uuid

        import numpy as np

        def embed(batch):
            with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(len(batch)))
            return batch.reshape(len(batch), -1, 3).mean(axis=1).astype(np.float32)
        return embed

    good = sum(r["height"] > 0 for r in _rows(spark, "scan_images"))
    r = train_image_lr(spark, pet_image_dir(spark, SF001) + "/*", weighted=True, size=16, embedder_factory=factory)
    r["predictions"].count(), r["metrics"].collect()
    assert sum(int(open(f"{log}/{f}").read()) for f in os.listdir(log)) == good


def test_embedder_that_always_fails_fails_the_job(spark):
    from scorewright.operators.embed import image_features
    from scorewright.sources.images import read_images
    from scorewright.sources.tables import pet_image_dir

    def factory():
        def embed(batch):
            raise ValueError("no network")
        return embed

    with pytest.raises(Exception, match="the embedder fails on every picture"):
        image_features(read_images(spark, pet_image_dir(spark, SF001) + "/*"), embedder_factory=factory).select("emb").collect()


@pytest.mark.parametrize("size", [30, 224])
def test_resize_and_colour_grid_values(size):
    import numpy as np

    from scorewright.operators.embed import _to_rgb, colour_grid

    left = np.zeros((8, 8, 3), np.uint8)
    left[:, :4] = (10, 20, 200)                                        # blue, green, red
    rgb = _to_rgb(left.tobytes(), 8, 8, 3, size)
    assert rgb.shape == (size, size, 3) and rgb[0, 0].tolist() == [200, 20, 10] and rgb[-1, -1].tolist() == [0, 0, 0]
    assert (np.diff(rgb[size // 2, :, 0].astype(int)) <= 0).all()      # one smooth edge
    cells = colour_grid(4)(rgb[None])[0]
    assert cells.shape == (51,) and abs(cells[0] - 200 / 255) < 1e-3 and cells[45] < 1e-6


def test_class_weights_do_not_shuffle_the_data(spark):
    from scorewright.operators.metrics import with_class_weights

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 2000)
    try:
        df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
        plan = with_class_weights(df, "label")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_batch_report_checks_ids_and_categoricals(spark):
    from scorewright.plans.jobs import batch_report
    from scorewright.specs import TableSpec

    spec = TableSpec(id_col="id", categorical=["kind"], numeric=["n"], int_columns=["n"])
    df = spark.createDataFrame([("a", "x", "1"), (None, " ", "2"), ("c", None, "y"), ("d", "x", "4")], "id string, kind string, n string").coalesce(1)
    r = batch_report(df, spec, lambda ok: ok.withColumns({"prediction": F.lit(1.0), "probability": F.col("n") / 10.0}))
    assert [tuple(x) for x in r["scored"].orderBy("row").collect()] == [(1, "a", 1.0, 0.1), (4, "d", 1.0, 0.4)]
    assert sorted((x["row"], x["error"]) for x in r["issues"].collect()) == [
        (2, "id: missing"), (2, "kind: missing"), (3, "kind: missing"), (3, "n: not a valid int: 'y'")]


def test_replicated_rows_are_spread_over_all_cores(spark, monkeypatch):
    """The fits pass over the copies again and again: a small file's one or two partitions would hold them all."""
    from collections import Counter

    from scorewright.operators import split
    from scorewright.plans import jobs
    from scorewright.sources.tables import churn_csv_path
    from scorewright.specs import CHURN

    seen = []
    monkeypatch.setattr(jobs, "compare_models", lambda train, test, spec, cands: (seen.append((train, test)), (None, {}))[1])
    monkeypatch.setattr(jobs, "report_table", lambda table: table)
    path, cores = churn_csv_path(spark, SF001), spark.sparkContext.defaultParallelism
    jobs.compare_churn_models(spark, path, replicas=3, spec=CHURN)
    assert all(part.rdd.getNumPartitions() >= cores for part in seen[0])
    ids = Counter(r["customerID"] for part in seen[0] for r in part.select("customerID").collect())
    assert ids == {r["customerID"]: 3 for r in jobs.load_training_table(spark, path, CHURN).select("customerID").collect()}
    monkeypatch.setattr(split, "ROWS_PER_TASK", 10)
    assert split.spread(spark.range(95), "id", copies=cores).rdd.getNumPartitions() == -(-95 * cores // 10)


def test_predictions_are_scored_once_for_both_measures(spark, monkeypatch):
    from scorewright.operators import models
    from scorewright.plans.queries import _churn_train_test
    from scorewright.specs import CHURN

    kept = []
    measure = models.confusion
    monkeypatch.setattr(models, "confusion", lambda df, *a: (kept.append(df.is_cached), measure(df, *a))[1])
    train, test = _churn_train_test(spark, SF001)
    table, _ = models.compare_models(train, test, CHURN, {"lr": models.classifier("lr", maxIter=2)})
    assert kept == [True] and table.count() == 1


def test_plot_sample_is_checked_against_all_points(spark):
    """every point is met with its picked row, as before the query was cut to the sample alone."""
    rows = _rows(spark, "cluster_plot_sample")
    whole = Q["wholesale_spend"](spark, SF001).count()
    assert rows and {(r["points"], r["each_once"], r["as_it_was"], r["about_a_tenth"]) for r in rows} == {(whole, True, True, True)}
    clusters = {r["custkey"]: r["prediction"] for r in _rows(spark, "cluster_customers")}
    assert all(r["prediction"] == clusters[r["custkey"]] for r in rows)


def test_picture_files_are_written_by_many_tasks(spark, tmp_path):
    """A table in one row group is read by one task; the pictures are still written by all cores, every one of them."""
    from scorewright.sources.tables import pet_image_dir

    rows = [(i, [i / 200.0] * 64, i % 10) for i in range(200)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    told = spark.read.parquet(pet_image_dir(spark, str(tmp_path)).removesuffix("/PetImages") + "-manifest")
    assert told.select(F.input_file_name()).distinct().count() > 1
    assert sorted(r["vec_id"] for r in told.collect()) == list(range(200))
    assert spark.read.format("binaryFile").load(pet_image_dir(spark, str(tmp_path)) + "/*").count() == 200


def test_small_pictures_are_read_in_fewer_tasks(spark):
    from scorewright.sources.images import packed

    few, many = spark.range(0, 4, 1, 4), spark.range(0, 4000, 1, 2000)
    assert packed(few).rdd.getNumPartitions() == 4
    assert packed(many).rdd.getNumPartitions() == max(8 * spark.sparkContext.defaultParallelism, 250) and packed(many).count() == 4000


def test_read_tasks_hold_as_many_small_pictures_whatever_sparks_partition_size(spark):
    """partitions of 16 MB hold 4 small pictures, and 32 of them were a task."""
    from scorewright.sources.images import packed

    many, cores = spark.range(0, 4000, 1, 2000), spark.sparkContext.defaultParallelism
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size, tasks in (("16m", 31), ("1g", 2000)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert packed(many).rdd.getNumPartitions() == max(8 * cores, tasks)
            assert packed(many).agg(F.count("id"), F.sum("id")).first()[:] == (4000, 7998000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_picture_rows_are_converted_without_generated_code(spark, monkeypatch, tmp_path):
    """the image source generates its converter's code anew for every file.  The actions that read pictures do without, with the
    same rows, and the session's setting is back afterwards."""
    from pyspark.sql import DataFrameWriter

    from scorewright.operators.embed import image_features
    from scorewright.plans.jobs import image_training_set, score_images, score_zip, train_image_lr
    from scorewright.sources.images import CONVERSION, read_images
    from scorewright.sources.tables import image_zip_dir, pet_image_dir

    pictures, before, seen = pet_image_dir(spark, SF001) + "/*", spark.conf.get(CONVERSION), {}
    write = DataFrameWriter.parquet

    def noted(self, path, *a, **b):
        seen[path.rsplit("/", 1)[-1].split("-")[0]] = spark.conf.get(CONVERSION)
        return write(self, path, *a, **b)

    plain = image_features(read_images(spark, pictures), size=32).select(F.col("image.origin").alias("o"), F.col("emb.features").alias("f")).collect()
    fitted = train_image_lr(spark, pictures, f"{tmp_path}/model", f"{tmp_path}/labels", size=32)
    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    got = {r["origin"]: list(r["features_vec"]) for r in image_training_set(spark, pictures, size=32).collect()}
    assert seen.pop("features") == "NO_CODEGEN" and got == {r["o"]: list(r["f"]) for r in plain if r["f"]} and len(got) < len(plain)
    assert score_images(spark, pictures, fitted["model"], f"{tmp_path}/labels", size=32).count() == len(plain)
    assert seen.pop("features") == "NO_CODEGEN"
    assert score_zip(spark, image_zip_dir(spark, SF001), fitted["model"], f"{tmp_path}/labels", size=32).count() == len(plain)
    assert seen == {"members": before, "manifest": before, "preds": "NO_CODEGEN"} and spark.conf.get(CONVERSION) == before


def test_the_sessions_own_conversion_comes_back(spark):
    from scorewright.sources.images import CONVERSION, reading_pictures

    before = spark.conf.get(CONVERSION, None)
    try:
        for own in ("CODEGEN_ONLY", None):
            spark.conf.set(CONVERSION, own) if own else spark.conf.unset(CONVERSION)
            one, other = reading_pictures(spark), reading_pictures(spark)        # two threads' actions, ending in the order they began
            one.__enter__(), other.__enter__()
            one.__exit__(None, None, None)
            assert spark.conf.get(CONVERSION) == "NO_CODEGEN"
            other.__exit__(None, None, None)
            assert spark.conf.get(CONVERSION, None) == own
            with pytest.raises(OSError), reading_pictures(spark):
                raise OSError
            assert spark.conf.get(CONVERSION, None) == own
    finally:
        spark.conf.set(CONVERSION, before) if before else spark.conf.unset(CONVERSION)


def test_folders_are_made_once_for_many_files(monkeypatch, tmp_path):
    from pyarrow import fs as pafs

    from scorewright.sources import filesystems
    from scorewright.sources.images import write_bytes

    made = []

    class Watched:
        def __init__(self):
            self.fs = pafs.LocalFileSystem()

        def create_dir(self, path, recursive):
            made.append(path)
            self.fs.create_dir(path, recursive=recursive)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    monkeypatch.setattr(filesystems.Store, "filesystem", lambda self: Watched())
    for i in range(3):
        write_bytes(f"{tmp_path}/a/b/{i}.png", bytes([i]), filesystems.LOCAL)
    assert made == [f"{tmp_path}/a/b"] and [(tmp_path / "a/b" / f"{i}.png").read_bytes() for i in range(3)] == [b"\0", b"\1", b"\2"]


def test_pictures_are_decoded_without_temporary_files(spark):
    from scorewright.sources.images import read_images
    from scorewright.sources.tables import pet_image_dir

    spark._jvm.javax.imageio.ImageIO.setUseCache(True)
    read_images(spark, pet_image_dir(spark, SF001) + "/*").select("image.height").collect()
    assert not spark._jvm.javax.imageio.ImageIO.getUseCache()


def test_scaled_pictures_by_hand():
    """Bilinear by exact fractions; a tall picture, of which few rows count, a wide and a small one."""
    from fractions import Fraction

    import numpy as np

    from scorewright.operators.embed import _places, _to_rgb

    def around(i, n, size):
        at = min(max(Fraction(2 * i + 1, 2) * n / size - Fraction(1, 2), 0), n - 1)
        low = int(at)
        return low, min(low + 1, n - 1), at - low

    rng = np.random.default_rng(2)
    for h, w, size in ((90, 3, 5), (2, 40, 6), (3, 4, 9)):
        a = rng.integers(0, 256, (h, w, 3), dtype=np.uint8)
        got = _to_rgb(a.tobytes(), h, w, 3, size)
        for y in range(size):
            for x in range(size):
                (y0, y1, fy), (x0, x1, fx) = around(y, h, size), around(x, w, size)
                for c in range(3):
                    v = lambda i, j: int(a[i, j, 2 - c])  # noqa: B023, E731
                    want = (v(y0, x0) * (1 - fx) + v(y0, x1) * fx) * (1 - fy) + (v(y1, x0) * (1 - fx) + v(y1, x1) * fx) * fy
                    assert got[y, x, c] == int(want + Fraction(1, 2))
    assert _places(3, 9) is _places(3, 9)                       # worked out once for pictures of one size
