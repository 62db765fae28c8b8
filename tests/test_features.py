"""Tree scoring by node table, malformed CSV lines, ROC curves, stores, one-file output, resources of the embedding stage."""

from __future__ import annotations

import glob
import math
import os
import random

import pytest
from conftest import SF001
from pyspark.sql import functions as F

import __spark_entry__ as entry

Q = entry.queries()


# ---------------------------------------------------------------- trees
def _points(spark, wide: bool):
    from pyspark.ml.feature import VectorAssembler, VectorIndexer

    rng = random.Random(5)
    n = 60 if wide else 4
    rows = [(i, float(rng.randint(0, 2) if wide else rng.randint(0, 1)), [float(rng.randint(0, 3)) if j % 2 else rng.gauss(0, 1) for j in range(n)])
            for i in range(240)]
    df = spark.createDataFrame([(i, (y + (x[1] > 1)) % (3 if wide else 2), *x) for i, y, x in rows],
                               "id int, label double, " + ", ".join(f"x{j} double" for j in range(n)))
    raw = VectorAssembler(inputCols=[f"x{j}" for j in range(n)], outputCol="raw").transform(df)
    # columns of few values become categorical: their splits are sets
    return VectorIndexer(inputCol="raw", outputCol="features", maxCategories=5).fit(raw).transform(raw).select("id", "label", "features")


@pytest.mark.parametrize("kind,wide", [("rf", False), ("rf", True), ("gbt", False)])
def test_node_table_scores_as_the_model_does(spark, tmp_dir, kind, wide):
    """Every row to 1e-12, with threshold and category splits, two and three classes, dense and sparse vectors, arrays."""
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from scorewright.operators.trees import read_forest, score_trees

    df = _points(spark, wide)
    est = RandomForestClassifier(numTrees=7, maxDepth=6, seed=3) if kind == "rf" else GBTClassifier(maxIter=6, maxDepth=4, seed=3)
    model = est.fit(df)
    model.save(f"{tmp_dir}/m")
    forest = read_forest(spark, f"{tmp_dir}/m")
    assert forest.nodes.filter("n_categories >= 0").count() > 0 and forest.nodes.filter("n_categories < 0 and feature >= 0").count() > 0
    want = {r["id"]: r for r in model.transform(df).select("id", vector_to_array("rawPrediction").alias("raw"), vector_to_array("probability").alias("p"), "prediction").collect()}
    for features in (df, df.withColumn("features", vector_to_array("features")), df.withColumn("features", array_to_vector(vector_to_array("features")))):
        got = score_trees(features, forest).collect()
        assert len(got) == len(want)
        for r in got:
            w = want[r["id"]]
            assert r["raw"] == pytest.approx(w["raw"], abs=1e-12) and r["probability"] == pytest.approx(w["p"], abs=1e-12) and r["prediction"] == w["prediction"]


def test_node_table_null_features(spark, tmp_dir):
    from pyspark.ml.classification import RandomForestClassifier

    from scorewright.operators.trees import read_forest, score_trees

    df = _points(spark, False)
    RandomForestClassifier(numTrees=3, seed=1).fit(df).save(f"{tmp_dir}/m")
    nulls = df.withColumn("features", F.when(F.col("id") != 0, F.col("features")))
    got = {r["id"]: r for r in score_trees(nulls, read_forest(spark, f"{tmp_dir}/m")).collect()}
    assert (got[0]["raw"], got[0]["probability"], got[0]["prediction"]) == (None, None, None) and got[1]["prediction"] is not None


@pytest.mark.parametrize("kind", ["rf", "gbt"])
def test_saved_pipeline_scored_without_its_class(spark, kind):
    from scorewright.operators.models import classifier, fit_pipeline, positive_probability
    from scorewright.plans.queries import _churn_train_test, _clean_table
    from scorewright.specs import CHURN

    got = {r["id"]: r for r in Q[f"score_trees_{kind}"](spark, SF001).collect()}
    model = fit_pipeline(_churn_train_test(spark, SF001)[0], CHURN, classifier(kind, seed=42))
    want = positive_probability(model.transform(_clean_table(spark, SF001))).collect()
    assert len(got) == len(want)
    for r in want:
        assert got[r["customerID"]]["p1"] == pytest.approx(r["p1"], abs=1e-12) and got[r["customerID"]]["prediction"] == r["prediction"]


def test_other_models_are_refused(spark, tmp_dir):
    from pyspark.ml.classification import LogisticRegression

    from scorewright.operators.trees import read_forest

    LogisticRegression(maxIter=1).fit(_points(spark, False)).save(f"{tmp_dir}/lr")
    with pytest.raises(ValueError, match="LogisticRegressionModel"):
        read_forest(spark, f"{tmp_dir}/lr")


# ---------------------------------------------------------------- malformed CSV lines
def test_checked_csv_keeps_malformed_lines(spark, tmp_dir):
    from scorewright.sources.csv import MALFORMED, read_csv_checked

    lines = ["a,b,c", "1,x,2", "3,y", "4,z,5,6", '7,"u,8', '9,"v, w",1', '"w,1,2', "", '5,k,"l', r'6,"q \" r",7', "8,,9", "  "]
    with open(os.path.join(tmp_dir, "a.csv"), "w") as f:
        f.write("\n".join(lines) + "\n")
    with open(os.path.join(tmp_dir, "b.csv"), "w") as f:
        f.write("a,b,c\n10,s,11\n12\n")
    rows = read_csv_checked(spark, tmp_dir).collect()
    bad = sorted(r[MALFORMED] for r in rows if r[MALFORMED] is not None)
    assert bad == sorted(["3,y", "4,z,5,6", '7,"u,8', '"w,1,2', '5,k,"l', "12"])
    good = sorted(tuple(r)[:3] for r in rows if r[MALFORMED] is None)
    assert good == sorted([("1", "x", "2"), ("9", "v, w", "1"), ("6", 'q " r', "7"), ("8", None, "9"), ("10", "s", "11")], key=lambda r: r[0])


def test_batch_report_of_malformed_lines(spark, tmp_dir):
    """Each planted bad line once among the issues, none among the scored."""
    from scorewright.plans.jobs import batch_report
    from scorewright.sources.csv import read_csv_checked
    from scorewright.specs import TableSpec

    with open(os.path.join(tmp_dir, "a.csv"), "w") as f:
        f.write('id,kind,n\na,x,1\nb,y\nc,z,2,3\nd,x,"4\ne,x,y\nf,x,6\n')
    spec = TableSpec(id_col="id", categorical=["kind"], numeric=["n"], int_columns=["n"])
    r = batch_report(read_csv_checked(spark, tmp_dir), spec, lambda ok: ok.withColumns({"prediction": F.lit(1.0), "probability": F.lit(0.5)}))
    assert [x["id"] for x in r["scored"].orderBy("row").collect()] == ["a", "f"]
    assert sorted((x["row"], x["error"]) for x in r["issues"].collect()) == [
        (2, "malformed line: b,y"), (3, "malformed line: c,z,2,3"), (4, 'malformed line: d,x,"4'), (5, "n: not a valid int: 'y'")]


# ---------------------------------------------------------------- ROC curves
def _scores(spark, n, seed=2):
    rng = random.Random(seed)
    rows = [(rng.choice("pq"), float(rng.random() < 0.4), rng.choice([round(rng.random(), 2), rng.random()])) for _ in range(n)]
    return spark.createDataFrame(rows, "model string, label double, probability double").coalesce(1)


@pytest.mark.parametrize("n,bins", [(5000, 1000), (5000, 0), (300, 1000), (4000, 7)])
def test_roc_area_equals_the_evaluators(spark, n, bins):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    from scorewright.operators.metrics import roc_area, roc_points

    df = _scores(spark, n)
    areas = {r["model"]: r["area"] for r in roc_area(roc_points(df, group=["model"], bins=bins), ["model"]).collect()}
    for m in "pq":
        own = df.filter(F.col("model") == m).cache()
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        try:
            want = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=bins).evaluate(own.coalesce(1))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert areas[m] == pytest.approx(want, abs=1e-9)
        own.unpersist()
    alone = roc_area(roc_points(df.filter("model = 'p'"), bins=bins)).first()["area"]
    assert alone == pytest.approx(areas["p"], abs=1e-12)


def test_roc_points_are_the_curve(spark):
    """Every point against a count over all rows; the same on any layout; a group of one class has none."""
    from scorewright.operators.metrics import roc_points

    df = _scores(spark, 400).unionByName(spark.createDataFrame([("one", 1.0, 0.5), ("one", 1.0, 0.7)], "model string, label double, probability double"))
    rows = df.collect()
    points = roc_points(df, group=["model"], bins=0).collect()
    assert {r["model"] for r in points} == {"p", "q"}
    again = roc_points(df.repartition(7), group=["model"], bins=0, num_slices=3).collect()
    assert sorted(map(str, points)) == sorted(map(str, again))
    for r in points:
        if r["threshold"] is not None:
            own = [x for x in rows if x["model"] == r["model"]]
            over = [x for x in own if x["probability"] >= r["threshold"]]
            assert r["tpr"] == sum(x["label"] for x in over) / sum(x["label"] for x in own)
            assert r["fpr"] == sum(1 - x["label"] for x in over) / sum(1 - x["label"] for x in own)
    for m in "pq":
        mine = sorted((r["point"], r["fpr"], r["tpr"]) for r in points if r["model"] == m)
        assert [p for p, _, _ in mine] == list(range(len(mine))) and mine[0][1:] == (0.0, 0.0) and mine[-1][1:] == (1.0, 1.0)
        assert all(a[1] <= b[1] and a[2] <= b[2] for a, b in zip(mine, mine[1:]))


# ---------------------------------------------------------------- stores

def test_store_of_each_scheme():
    from scorewright.sources.filesystems import LOCAL, Store, UnsupportedStoreError, inner_path, store_of

    none = {}.get
    assert store_of("/a/b", none) == store_of("file:///a/b", none) == LOCAL
    minio = {"fs.s3a.endpoint": "http://minio:9000", "fs.s3a.access.key": "k", "fs.s3a.secret.key": "s", "fs.s3a.path.style.access": "true",
             "fs.s3a.endpoint.region": "eu-west-1", "fs.s3a.bucket.other.endpoint": "https://elsewhere", "fs.s3a.bucket.other.access.key": "k2"}.get
    assert store_of("s3a://data/x", minio) == Store("s3", {"endpoint_override": "minio:9000", "scheme": "http", "region": "eu-west-1", "access_key": "k", "secret_key": "s"})
    other = store_of("s3a://other/x", minio).options
    assert (other["endpoint_override"], other["scheme"], other["access_key"]) == ("elsewhere", "https", "k2")
    assert store_of("s3://b/x", {"fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider"}.get).options == {"anonymous": True}
    assert store_of("s3a://b/x", {"fs.s3a.endpoint": "host:1", "fs.s3a.connection.ssl.enabled": "false"}.get).options == {
        "endpoint_override": "host:1", "scheme": "http", "force_virtual_addressing": True}
    assert store_of("s3a://b/x", {"fs.s3a.assumed.role.arn": "arn:x"}.get).options == {"role_arn": "arn:x"}
    assert store_of("s3a://b/x", {"fs.s3a.access.key": "k", "fs.s3a.secret.key": "s", "fs.s3a.session.token": "t"}.get).options["session_token"] == "t"
    assert store_of("gs://b/x", {"fs.gs.auth.type": "UNAUTHENTICATED", "fs.gs.storage.root.url": "http://fake:4443/"}.get) == Store(
        "gs", {"anonymous": True, "endpoint_override": "fake:4443", "scheme": "http"})
    account = "acc.dfs.core.windows.net"
    assert store_of(f"abfss://box@{account}/x", {f"fs.azure.account.key.{account}": "K"}.get) == Store("azure", {"account_name": "acc", "account_key": "K"})
    assert store_of("hdfs://nn:8020/x", none) == Store("hdfs", {"host": "nn", "port": 8020})
    assert store_of("hdfs://service/x", {"dfs.ha.namenodes.service": "nn1,nn2"}.get).options == {"host": "hdfs://service", "port": 0}
    for bad in ("ftp://h/x", "viewfs://c/x", "nope://x"):
        with pytest.raises(UnsupportedStoreError, match=bad.split(":")[0]):
            store_of(bad, none)
    paths = {"/a/b": "/a/b", "file:///a/b": "/a/b", "file:/a/b": "/a/b", "s3a://bucket/k/x.zip": "bucket/k/x.zip", "gs://b/k": "b/k",
             f"abfss://box@{account}/k/x": "box/k/x", "hdfs://nn:8020/d/x": "/d/x", "rel/x:y": "rel/x:y"}
    assert {p: inner_path(p) for p in paths} == paths
    assert Store.of(Store("s3", {"region": "r"}).text()) == Store("s3", {"region": "r"})


def test_resolved_stores_open_and_unknown_schemes_raise_on_the_driver(spark, tmp_dir):
    import pyarrow.fs as pafs

    from scorewright.sources.filesystems import Store, UnsupportedStoreError, resolve
    from scorewright.sources.images import zip_members

    fs, p = resolve(spark, tmp_dir).open(f"file://{tmp_dir}/x")
    with fs.open_output_stream(p) as f:
        f.write(b"y")
    assert open(f"{tmp_dir}/x").read() == "y"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.s3a.endpoint", "http://localhost:1")
    try:
        store = resolve(spark, "s3a://bucket/k")
    finally:
        conf.unset("fs.s3a.endpoint")
    assert store.options["endpoint_override"] == "localhost:1" and isinstance(Store("s3", {"region": "eu-west-1", "anonymous": True}).filesystem(), pafs.S3FileSystem)
    for call in (lambda: resolve(spark, "viewfs://cluster/x"), lambda: zip_members(spark, "nope://x/y")):
        with pytest.raises(Exception, match="viewfs|nope"):
            call()


# ---------------------------------------------------------------- one file
def test_one_file_in_partition_order_without_an_exchange(spark, tmp_dir):
    from scorewright.sinks import write_single_csv

    rows = [(i, f'n,{i}"q' if i % 3 else None, i / 7, "") for i in range(500)]
    df = spark.createDataFrame(rows, "id int, `a name` string, v double, e string").repartitionByRange(6, "id").sortWithinPartitions("id").cache()
    df.count()
    for _ in range(2):                                    # an existing file is replaced
        path = write_single_csv(spark, df, f"{tmp_dir}/out", "preds.csv")
    back = spark.read.option("header", True).schema(df.schema).csv(path).collect()
    assert [tuple(r) for r in back] == [(*tuple(r)[:3], None) for r in df.collect()]         # Spark's reader takes an empty text as null
    assert open(path).read().splitlines()[1] == '0,,0.0,""'
    assert [x.split(",")[0] for x in open(path).read().splitlines()[1:]] == [str(i) for i in range(500)]
    assert os.listdir(f"{tmp_dir}/out") == ["preds.csv"]
    empty = write_single_csv(spark, df.limit(0), f"{tmp_dir}/none", "preds.csv")
    assert open(empty).read() == "id,a name,v,e\n"


def test_one_file_parts_of_lost_attempts_are_not_joined(spark, tmp_dir):
    """A task that fails after writing, and is run again: only the attempts that the commit names count."""
    import pyarrow as pa

    from scorewright.sinks.one_file import OneFileWriter
    from scorewright.sources.filesystems import LOCAL

    class Ctx:
        def __init__(self, n):
            self.n = n

        def partitionId(self):
            return self.n

    import pyspark
    real = pyspark.TaskContext.get
    w = OneFileWriter(f"{tmp_dir}/o/all.txt", f"{tmp_dir}/o/.scratch", LOCAL.text(), "head")
    parts = []
    try:
        for n, lines in ((1, ["c", "d"]), (0, ["a", "b"]), (2, [])):
            pyspark.TaskContext.get = staticmethod(lambda n=n: Ctx(n))
            batches = [pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["line"])]

            def torn(batches=batches):
                yield from batches
                raise RuntimeError("lost")
            with pytest.raises(RuntimeError):
                w.write(torn())
            parts.append(w.write(iter(batches)))
    finally:
        pyspark.TaskContext.get = real
    assert len(glob.glob(f"{tmp_dir}/o/.scratch/*")) == 4
    w.commit(parts)
    assert open(f"{tmp_dir}/o/all.txt").read() == "head\na\nb\nc\nd\n" and os.listdir(f"{tmp_dir}/o") == ["all.txt"]
    w.abort([])                                           # nothing to clear: no error


# ---------------------------------------------------------------- resources of the embedding stage
def test_stage_profile_by_master():
    from scorewright.operators.embed import embedding_resources, stage_profile

    profile = embedding_resources(cores=4, memory="6g", accelerator="gpu", tasks_per_accelerator=2)
    assert profile.taskResources["gpu"].amount == 0.5 and profile.executorResources["cores"].amount == 4
    for master in ("spark://h:7077", "yarn", "k8s://https://h"):
        assert stage_profile(master, profile) is profile
    with pytest.warns(UserWarning, match="no stage-level resources"):
        assert stage_profile("local[8]", profile) is None
    assert stage_profile("local[8]", None) is None


def test_embedding_in_a_stage_of_its_own(spark, monkeypatch):
    """The operator that carries a profile gives the values of the usual one; on a local master the profile is ignored."""
    from scorewright.operators import embed
    from scorewright.sources.images import read_images
    from scorewright.sources.tables import pet_image_dir

    imgs = read_images(spark, pet_image_dir(spark, SF001) + "/*").select("image", F.col("image.origin").alias("o"))
    plain = {r["o"]: r["emb"] for r in embed.image_features(imgs, size=32).select("o", "emb").collect()}
    profile = embed.embedding_resources(cores=1)
    with pytest.warns(UserWarning, match="no stage-level resources"):
        ignored = embed.image_features(imgs, size=32, resources=profile).select("o", "emb")
    assert "MapInArrow" not in ignored._jdf.queryExecution().executedPlan().toString()
    seen = []
    real = type(imgs).mapInArrow

    def without_profile(self, func, schema, barrier=False, profile=None):
        seen.append(profile)
        return real(self, func, schema, barrier)                     # a local master refuses profiles
    monkeypatch.setattr(type(imgs), "mapInArrow", without_profile)
    monkeypatch.setattr(embed, "stage_profile", lambda master, resources: resources)
    own = embed.image_features(imgs, size=32, resources=profile)
    assert seen == [profile] and own.columns == ["image", "o", "emb"]
    got = {r["o"]: r["emb"] for r in own.select("o", "emb").collect()}
    assert got == plain and any(e["error"] for e in got.values()) and not any(math.isnan(v) for e in got.values() for v in e["features"] or [])
