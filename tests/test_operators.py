"""Edge tables (small fixtures written by the tests) and cross-checks against pyspark.ml."""

from __future__ import annotations

import io
import os
import zipfile

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql import functions as F

from scorewright.functions.scalar import file_extension, has_nonzero, parent_dir
from scorewright.operators.clean import clean_blank_drop, clean_blank_zero, quarantine
from scorewright.operators.features import fit_features, idx_col, indexer
from scorewright.operators.metrics import accuracy, auc, confusion, silhouette, with_class_weights
from scorewright.operators.rank import global_row_number
from scorewright.operators.scoring import assign_cluster, label_lookup, linear_score
from scorewright.operators.split import holdout_split, replicate, threshold_hex
from scorewright.sources.csv import MissingColumnsError, read_csv_strings, require_columns
from scorewright.specs import TableSpec

SPEC = TableSpec(id_col="id", categorical=["color"], numeric=["n", "amount"], int_columns=["n"],
                 double_columns=["amount"], target="y", blank_column="amount",
                 defaults={"n": 0, "amount": 0.0})


def _dirty_csv(path):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part.csv"), "w") as f:
        f.write('id,color,n,amount,y\n'
                'a,red,1,1.5,Yes\n'
                'b,blue,2," ",No\n'
                'c,red,x,2.5,Yes\n'
                'd,,3,"",No\n'
                'e,green,4,"  ",Yes\n')
    return path


def test_clean_paths_and_quarantine(spark, tmp_dir):
    raw = read_csv_strings(spark, _dirty_csv(tmp_dir))
    drop = {r["id"]: r for r in clean_blank_drop(raw, SPEC).collect()}
    # exact " " is missing on the training path; "" is null already; "  " does not parse -> null too
    assert set(drop) == {"a", "c"}
    assert drop["c"]["n"] is None and drop["a"]["label"] == 1
    zero = {r["id"]: r for r in clean_blank_zero(raw, SPEC).collect()}
    assert len(zero) == 5
    assert zero["b"]["amount"] == 0.0 and zero["d"]["amount"] == 0.0 and zero["e"]["amount"] == 0.0
    assert zero["c"]["n"] == 0
    q = {r["id"]: r for r in quarantine(raw, SPEC).collect()}
    assert q["a"]["status"] == "ok" and q["a"]["errors"] == []
    assert q["c"]["errors"] == ["n: not a valid int: 'x'"]
    assert q["b"]["errors"] == ["amount: missing"]
    assert q["e"]["status"] == "rejected"


def test_require_columns_names_every_missing_one(spark, tmp_dir):
    raw = read_csv_strings(spark, _dirty_csv(tmp_dir))
    with pytest.raises(MissingColumnsError) as e:
        require_columns(raw, ["id", "Contract", "tenure", "color"])
    assert e.value.missing == ["Contract", "tenure"]


def test_indexer_keep_and_one_hot_unknown(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("c",)], "color string")
    m = indexer(["color"]).fit(train)
    assert m.labelsArray[0] == ["a", "c", "b"]        # frequency desc, then value asc
    test = spark.createDataFrame([("b",), ("zzz",), (None,)], "color string")
    got = [r[idx_col("color")] for r in m.transform(test).collect()]
    assert got == [2.0, 3.0, 3.0]
    df = spark.createDataFrame([("x", "a", 1, 1.0), ("y", "q", 2, 2.0)], "id string, color string, n int, amount double")
    fm = fit_features(df.filter(F.col("id") == "x"), SPEC)
    vecs = [r["features"].toArray().tolist() for r in fm.transform(df).orderBy("id").collect()]
    assert vecs == [[1.0, 1.0, 1.0], [2.0, 2.0, 0.0]]     # unseen -> all-zero one-hot block


def test_metrics_match_pyspark_evaluators(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        y = int(rng.random() < 0.4)
        s = float(np.round(rng.normal(0.3 * y, 1.0), 1)) + 0.0   # rounded: many ties; no -0.0
        rows.append((i, y, s, float(s > 0.1)))
    df = spark.createDataFrame(rows, "id long, label int, score double, prediction double")
    ours = auc(df, "label", "score").first()["auc"]
    pos = np.array([r[2] for r in rows if r[1] == 1])
    neg = np.array([r[2] for r in rows if r[1] == 0])
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(ours - brute) < 1e-12
    ref = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0).evaluate(df)
    assert abs(ours - ref) < 1e-9
    c = confusion(df).first()
    dd = df.withColumn("label", F.col("label").cast("double"))
    mc = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert abs(c["accuracy"] - mc.setMetricName("accuracy").evaluate(dd)) < 1e-12
    assert abs(c["precision"] - mc.setMetricName("precisionByLabel").setMetricLabel(1.0).evaluate(dd)) < 1e-12
    assert abs(c["recall"] - mc.setMetricName("recallByLabel").setMetricLabel(1.0).evaluate(dd)) < 1e-12
    assert abs(c["f1"] - mc.setMetricName("fMeasureByLabel").setMetricLabel(1.0).evaluate(dd)) < 1e-12
    # metamorphic: replication and repartitioning change nothing
    rep = replicate(df, 7).repartition(5)
    assert abs(auc(rep, "label", "score", num_slices=3).first()["auc"] - ours) < 1e-12
    assert accuracy(rep).first()["accuracy"] == accuracy(df).first()["accuracy"]


def test_one_class_labels(spark):
    df = spark.createDataFrame([(0, 0.2, 0.0), (0, 0.9, 1.0)], "label int, score double, prediction double")
    assert auc(df, "label", "score").first()["auc"] is None
    c = confusion(df).first()
    assert c["precision"] == 0.0 and c["recall"] == 0.0 and c["f1"] == 0.0


def test_silhouette_matches_evaluator_with_singleton(spark):
    pts = [(0, [0.0, 0.0]), (0, [0.1, 0.2]), (0, [0.2, 0.1]), (1, [5.0, 5.0]), (1, [5.2, 4.9]), (2, [9.0, 0.0])]
    df = spark.createDataFrame([(float(k), Vectors.dense(v)) for k, v in pts], StructType([StructField("prediction", DoubleType()), StructField("features", VectorUDT())]))
    ref = ClusteringEvaluator().evaluate(df)
    assert abs(silhouette(df).first()["silhouette"] - ref) < 1e-9


def test_linear_score_ties_and_model_equivalence(spark):
    df = spark.createDataFrame([([1.0, -1.0],), ([2.0, 0.5],)], "x array<double>")
    hi = linear_score(df, "x", [1.0, 1.0], 0.0, tie="high").collect()
    lo = linear_score(df, "x", [1.0, 1.0], 0.0, tie="low").collect()
    assert hi[0]["probability"] == 0.5 and hi[0]["prediction"] == 1.0 and lo[0]["prediction"] == 0.0
    pc = linear_score(df, "x", [1.0, 1.0], 0.0, confidence="predicted").collect()
    assert pc[1]["confidence"] == pc[1]["probability"]
    from pyspark.ml.classification import LogisticRegression
    rng = np.random.default_rng(1)
    data = [(Vectors.dense(rng.normal(size=3).tolist()), float(i % 2)) for i in range(60)]
    train = spark.createDataFrame(data, StructType([StructField("features", VectorUDT()),
                                                    StructField("label", DoubleType())]))
    m = LogisticRegression(maxIter=20).fit(train)
    ours = linear_score(train, "features", m.coefficients.toArray().tolist(), m.intercept, tie="low",
                        probability_col="p_ours").select("p_ours", "prediction").collect()
    theirs = m.transform(train).select("probability", "prediction").collect()
    for a, b in zip(ours, theirs):
        assert abs(a["p_ours"] - b["probability"][1]) < 1e-12
        assert a["prediction"] == b["prediction"]


def test_feature_filter_forms(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([-1.0, 0.0],), ([0.0, 2.0],)], "v array<double>")
    assert [r[0] for r in df.select(has_nonzero("v")).collect()] == [False, True, True]
    assert [r[0] for r in df.select(has_nonzero("v", strict=True)).collect()] == [False, False, True]


def test_paths_and_extensions(spark):
    df = spark.createDataFrame([("gs://b/PetImages/Cat/1.JPG",), ("a/b/c.tar.GZ",), ("noext",)], "p string")
    got = df.select(parent_dir("p").alias("d"), file_extension("p").alias("e")).collect()
    assert [(r["d"], r["e"]) for r in got] == [("Cat", ".jpg"), ("b", ".gz"), (None, "")]


def test_split_is_keyed_and_stable(spark):
    assert threshold_hex(0.8) == "cccd"
    df = spark.range(5000).withColumnRenamed("id", "k")
    tr1, _ = holdout_split(df, "k")
    tr2, _ = holdout_split(df.repartition(7), "k")
    a = {r["k"] for r in tr1.collect()}
    assert a == {r["k"] for r in tr2.collect()}
    assert 0.77 < len(a) / 5000 < 0.83


def test_global_row_number_matches_window(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("k"))
    ours = {r["k"]: r["row_id"] for r in global_row_number(df, ["k"], num_slices=5).collect()}
    want = sorted(ours)
    assert [ours[k] for k in want] == list(range(1, 3001))
    # a key holding a third of the rows: still a permutation of 1..n, in key order, over many slices
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    rows = global_row_number(hot, ["k"], num_slices=6).collect()
    assert sorted(r["row_id"] for r in rows) == list(range(1, 3001))
    by_id = sorted(rows, key=lambda r: r["row_id"])
    assert [r["k"] for r in by_id] == sorted(r["k"] for r in rows)


def test_class_weights_and_label_lookup(spark):
    df = spark.createDataFrame([(i, 0 if i < 6 else 1) for i in range(8)], "id int, y int")
    w = {r["y"]: r["classWeight"] for r in with_class_weights(df, "y").collect()}
    assert w == {0: 8 / (2 * 6), 1: 8 / (2 * 2)}
    labels = spark.createDataFrame([(0, "cat")], "index int, label string")
    pred = spark.createDataFrame([(0.0,), (1.0,)], "prediction double")
    assert [r["label_name"] for r in label_lookup(pred, labels).orderBy("prediction").collect()] == ["cat", "1"]


def test_assign_cluster_lowest_index_on_tie(spark):
    df = spark.createDataFrame([([0.0],), ([2.0],)], "x array<double>")
    got = [r["prediction"] for r in assign_cluster(df, "x", [[1.0], [-1.0], [3.0]]).collect()]
    assert got == [0, 0]


def test_label_map_forms(spark, tmp_dir):
    from scorewright.sources.labels import read_label_map_tolerant
    lines = os.path.join(tmp_dir, "lines")
    os.makedirs(lines)
    with open(os.path.join(lines, "a.json"), "w") as f:
        f.write('{"index": 0, "label": "cat"}\n{"index": 1, "lab\n{"label": "x"}\n{"index": 1, "label": "dog"}\n')
    got = sorted((r["index"], r["label"]) for r in read_label_map_tolerant(spark, lines).collect())
    assert got == [(0, "cat"), (1, "dog")]
    mixed = os.path.join(tmp_dir, "mixed")
    os.makedirs(mixed)
    with open(os.path.join(mixed, "a.json"), "w") as f:
        f.write('{"index": 0, "label": "cat"}\n\nnonsense\n{"1": "dog", "x": "no index", "2": null}\r\n{"index": 3, "label": "fox", "more": {"index": 9}}\n[4]\n')
    with open(os.path.join(mixed, "b.json"), "w") as f:
        f.write('{\n  "5": "owl",\n  "6": "bee"\n}\n')
    with open(os.path.join(mixed, "empty.json"), "w") as f:
        f.write("")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup("no action")
    spark.sparkContext.setJobGroup("no action", "reading a label map runs no job")
    df = read_label_map_tolerant(spark, mixed)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("no action") == before
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted((r["index"], r["label"]) for r in df.collect()) == [(0, "cat"), (1, "dog"), (3, "fox"), (5, "owl"), (6, "bee")]
    whole = os.path.join(tmp_dir, "whole")
    os.makedirs(whole)
    with open(os.path.join(whole, "a.json"), "w") as f:
        f.write('{\n  "0": "cat",\n  "1": "dog"\n}\n')
    got = sorted((r["index"], r["label"]) for r in read_label_map_tolerant(spark, whole).collect())
    assert got == [(0, "cat"), (1, "dog")]


def _zip(path, members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, body in members:
            z.writestr(name, body)
    with open(path, "wb") as f:
        f.write(buf.getvalue())


def test_zip_members_and_score_zip(spark, tmp_dir):
    from pyspark.ml.classification import LogisticRegression

    from scorewright.operators.embed import image_features
    from scorewright.plans.jobs import score_zip
    from scorewright.sinks import write_label_map
    from scorewright.sources.images import NoImagesError, read_images, zip_members
    from scorewright.sources.tables import png_bytes

    red = np.zeros((8, 8, 3), np.uint8)
    red[:, :, 0] = 250
    blue = np.zeros((8, 8, 3), np.uint8)
    blue[:, :, 2] = 250
    zdir = os.path.join(tmp_dir, "zips")
    os.makedirs(zdir)
    _zip(os.path.join(zdir, "a.zip"), [("a/", b""), ("a/1.JPG", png_bytes(red)), ("a/2.txt", b"hello"),
                                       ("b,3.png", png_bytes(blue)), ("bad.png", b"\x89PNG broken")])
    m = {r["name"]: r for r in zip_members(spark, zdir).collect()}
    assert set(m) == {"a/1.JPG", "b,3.png", "bad.png"}
    broken = os.path.join(tmp_dir, "broken")
    os.makedirs(broken)
    _zip(os.path.join(broken, "ok.zip"), [("x.png", png_bytes(red))])
    with open(os.path.join(broken, "torn.zip"), "wb") as f:
        f.write(b"PK\x03\x04 not really a zip")
    rows = zip_members(spark, broken).collect()
    got = sorted(((r["name"] or ""), r["error"] is not None) for r in rows)
    assert got == [("", True), ("x.png", False)]
    empty = os.path.join(tmp_dir, "empty")
    os.makedirs(empty)
    _zip(os.path.join(empty, "e.zip"), [("notes.txt", b"x")])
    with pytest.raises(NoImagesError):
        zip_members(spark, empty)

    # a binary model on colour-grid features of red (0) vs blue (1) pictures
    pics = os.path.join(tmp_dir, "pics")
    for i in range(6):
        for cls, arr in (("r", red), ("b", blue)):
            os.makedirs(os.path.join(pics, cls), exist_ok=True)
            with open(os.path.join(pics, cls, f"{i}.png"), "wb") as f:
                f.write(png_bytes(np.clip(arr.astype(int) + i, 0, 255).astype(np.uint8)))
    feats = image_features(read_images(spark, pics + "/*"))
    from pyspark.ml.functions import array_to_vector
    train = feats.select(array_to_vector(F.col("emb.features").cast("array<double>")).alias("features"),
                         F.when(parent_dir("image.origin") == "b", 1.0).otherwise(0.0).alias("label"))
    lr = LogisticRegression(maxIter=50).fit(train)
    labels = write_label_map(spark, ["red", "blue"], os.path.join(tmp_dir, "labels"))
    out = os.path.join(tmp_dir, "out")
    preds = {r["filename"]: r for r in score_zip(spark, zdir, lr, labels, out, slices=2, single_file=True).collect()}
    assert preds["a/1.JPG"]["label"] == "red" and preds["b,3.png"]["label"] == "blue"
    assert preds["bad.png"]["label"] == "ERROR" and preds["bad.png"]["confidence"] == 0.0
    assert [n for n in os.listdir(out) if not n.startswith(".")] == ["preds.csv"]
    text = open(os.path.join(out, "preds.csv")).read().splitlines()
    assert text[0] == "filename,label,confidence" and any(t.startswith('"b,3.png"') for t in text)


def test_model_save_policies(spark, tmp_dir):
    from pyspark.ml.clustering import KMeans

    from scorewright.sinks import save_model
    df = spark.createDataFrame([(Vectors.dense([float(i), 0.0]),) for i in range(10)],
                               StructType([StructField("features", VectorUDT())]))
    m = KMeans(k=2, seed=42).fit(df)
    p = os.path.join(tmp_dir, "km")
    save_model(m, p, overwrite=False)
    with pytest.raises(Exception):
        save_model(m, p, overwrite=False)
    save_model(m, p, overwrite=True)


def test_auc_property_against_brute_force(spark):
    """Random tie-heavy scores (signed zeros included) in random slice counts: exact AUC."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=6, deadline=None)
    @given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([-1.5, -0.0, 0.0, 0.25, 0.5, 2.0])),
                    min_size=2, max_size=60),
           st.integers(1, 5))
    def check(rows, slices):
        df = spark.createDataFrame([(i, y, s) for i, (y, s) in enumerate(rows)], "id int, label int, score double")
        got = auc(df, "label", "score", num_slices=slices).first()["auc"]
        pos = [s for y, s in rows if y == 1]
        neg = [s for y, s in rows if y == 0]
        if not pos or not neg:
            assert got is None
            return
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert abs(got - want) < 1e-12

    check()


def test_row_number_property(spark):
    """Random keys with many duplicates, random slice counts: ids are 1..n in key order."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.integers(-3, 3), min_size=1, max_size=80), st.integers(1, 6))
    def check(keys, slices):
        df = spark.createDataFrame([(k,) for k in keys], "k int")
        rows = sorted(global_row_number(df, ["k"], num_slices=slices).collect(), key=lambda r: r["row_id"])
        assert [r["row_id"] for r in rows] == list(range(1, len(keys) + 1))
        assert [r["k"] for r in rows] == sorted(keys)

    check()


def test_quarantine_property(spark):
    """Random mixes of valid, blank, null and unparsable text: status and messages follow the rules."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    ints = {"12": "ok", " 7": "ok", "-3": "ok", "x": "bad", "": "missing", "  ": "missing", None: "missing"}
    dbls = {"1.5": "ok", "2": "ok", "-0.25": "ok", "1,5": "bad", "abc": "bad", " ": "missing", None: "missing"}

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.tuples(st.sampled_from(list(ints)), st.sampled_from(list(dbls))), min_size=1, max_size=30))
    def check(rows):
        df = spark.createDataFrame([(str(i), a, b) for i, (a, b) in enumerate(rows)], "id string, n string, amount string")
        got = {r["id"]: r for r in quarantine(df, SPEC).collect()}
        for i, (a, b) in enumerate(rows):
            r = got[str(i)]
            want = []
            if ints[a] == "missing":
                want.append("n: missing")
            elif ints[a] == "bad":
                want.append(f"n: not a valid int: '{a}'")
            if dbls[b] == "missing":
                want.append("amount: missing")
            elif dbls[b] == "bad":
                want.append(f"amount: not a valid double: '{b}'")
            assert r["errors"] == want, (a, b, r["errors"])
            assert r["status"] == ("ok" if not want else "rejected")
            if ints[a] == "ok":
                assert r["n"] == int(a)
            if dbls[b] == "ok":
                assert r["amount"] == float(b)

    check()


def test_dot_of_any_width_and_of_a_wrong_length(spark):
    from scorewright.functions.scalar import dot
    rng = np.random.default_rng(11)
    for width in (5, 300, 2048):
        w = rng.normal(size=width).tolist()
        rows = [(rng.normal(size=width).tolist(),) for _ in range(4)]
        df = spark.createDataFrame(rows, "x array<double>")
        got = [r[0] for r in df.select(dot("x", w)).collect()]
        for (x,), g in zip(rows, got):
            acc = 0.0
            for a, b in zip(x, w):          # the same left-to-right order, in Python doubles
                acc = acc + a * b
            assert g == acc
        for wrong in (width - 1, width + 1):
            with pytest.raises(Exception, match=f"array of length {width} expected, got {wrong}"):
                spark.createDataFrame([([0.0] * wrong,)], "x array<double>").select(dot("x", w)).collect()
    assert spark.createDataFrame([(None,)], "x array<double>").select(dot("x", [1.0])).first()[0] is None


def test_stage_once_publishes_one_complete_copy(spark, tmp_dir):
    import threading

    from scorewright.sinks import fs
    target = os.path.join(tmp_dir, "staged")
    errors = []

    def writer(n):
        try:
            fs.stage_once(spark, target, lambda tmp: spark.range(n).write.parquet(tmp))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=writer, args=(n,)) for n in (5, 7)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert fs.is_complete(spark, target)
    assert spark.read.parquet(target).count() in (5, 7)
    assert not [n for n in os.listdir(tmp_dir) if ".tmp-" in n]
    # a second call is a no-op
    fs.stage_once(spark, target, lambda tmp: (_ for _ in ()).throw(AssertionError("rewrote")))


def test_binned_auc_is_close_to_exact(spark):
    from scorewright.operators.metrics import auc_binned
    rng = np.random.default_rng(5)
    rows = [(int(rng.random() < 0.3), float(rng.normal())) for _ in range(3000)]
    df = spark.createDataFrame(rows, "label int, score double")
    exact = auc(df, "label", "score").first()["auc"]
    assert abs(auc_binned(df, "label", "score", bins=0) - exact) < 1e-9
    assert abs(auc_binned(df, "label", "score", bins=100) - exact) < 1e-2
