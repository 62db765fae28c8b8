"""The Telco contract end to end on a small Telco-shaped fixture written by the test:
train, save, score a CSV, score a form record, compare models, cluster, score a stream."""

from __future__ import annotations

import csv
import os

import numpy as np
import pytest

from scorewright.plans import jobs
from scorewright.specs import TELCO

# fixed values: the contract's allowed values per column
VALUES = {
    "gender": ["Male", "Female"], "Partner": ["Yes", "No"], "Dependents": ["Yes", "No"],
    "PhoneService": ["Yes", "No"], "MultipleLines": ["Yes", "No", "No phone service"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    **{c: ["Yes", "No", "No internet service"] for c in
       ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies"]},
    "Contract": ["Month-to-month", "One year", "Two year"], "PaperlessBilling": ["Yes", "No"],
    "PaymentMethod": ["Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)"],
}
#: A made-up customer: per contract column its last allowed value.
SAMPLE = {**{c: v[-1] for c, v in VALUES.items()}, "SeniorCitizen": 1, "tenure": 31, "MonthlyCharges": 54.2, "TotalCharges": 1680.2}


def telco_csv(path: str, n: int = 400, seed: int = 3, with_target: bool = True) -> str:
    rng = np.random.default_rng(seed)
    os.makedirs(path, exist_ok=True)
    cols = [*TELCO.required, *(["Churn"] if with_target else [])]
    with open(os.path.join(path, "telco.csv"), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(cols)
        for i in range(n):
            row = {"customerID": f"{1000 + i}-ABCD"}
            for c, vals in VALUES.items():
                row[c] = vals[int(rng.integers(len(vals)))]
            row["SeniorCitizen"] = int(rng.random() < 0.2)
            row["tenure"] = int(rng.integers(0, 72))
            row["MonthlyCharges"] = round(float(rng.uniform(18, 120)), 2)
            row["TotalCharges"] = " " if i % 50 == 0 else f"{row['MonthlyCharges'] * max(row['tenure'], 1):.2f}"
            leave = (row["Contract"] == "Month-to-month") and row["tenure"] < 24
            row["Churn"] = "Yes" if leave != (rng.random() < 0.1) else "No"
            w.writerow([row[c] for c in cols])
    return path


@pytest.fixture(scope="module")
def telco(tmp_path_factory):
    return telco_csv(str(tmp_path_factory.mktemp("telco")))


def test_train_save_score(spark, telco, tmp_path):
    model_path = str(tmp_path / "rf")
    r = jobs.train_churn(spark, telco, "rf", model_path, seed=42)
    m = r["metrics"].first()
    assert m["auc"] > 0.8 and 0 <= m["accuracy"] <= 1
    c = r["counts"].first()
    assert c["total"] == c["stay"] + c["leave"]
    out = jobs.score_csv(spark, telco, model_path, str(tmp_path / "scores"))
    assert out.count() == 400                       # blank TotalCharges rows are scored with 0.0
    back = spark.read.option("header", True).csv(str(tmp_path / "scores"))
    assert back.columns == ["id", "churn"] and back.count() == 400
    one = jobs.score_rows(spark, [SAMPLE], model_path).first()
    assert one["decision"] in ("leave", "stay") and one["leave_probability"].endswith("%")


def test_compare_models_writes_one_csv(spark, telco, tmp_path):
    from scorewright.operators.models import classifier
    out = str(tmp_path / "cmp")
    rep = jobs.compare_churn_models(spark, telco, out, replicas=3,
                                    candidates={"Random Forest": classifier("rf", seed=42),
                                                "Logistic Regression": classifier("lr")})
    assert rep.columns == ["Model", "AUC", "Accuracy", "Precision", "Recall", "F1", "TrainTime(s)"]
    assert rep.count() == 2
    assert [n for n in os.listdir(out) if not n.startswith(".")] == ["model_comparison.csv"]


def test_cluster_telco(spark, telco, tmp_path):
    df = jobs.load_training_table(spark, telco, TELCO)
    r = jobs.cluster_customers(spark, df, TELCO, k=5, scale="std", key="customerID",
                               model_path=str(tmp_path / "km"), plot_path=str(tmp_path / "plot"),
                               plot_columns=["MonthlyCharges", "TotalCharges"],
                               profile_columns=["MonthlyCharges", "TotalCharges"])
    assert r["profile"].count() == 5
    assert -1 <= r["silhouette"].first()["silhouette"] <= 1
    with pytest.raises(Exception):    # saving k-means refuses to replace an existing model
        jobs.cluster_customers(spark, df, TELCO, k=5, key="customerID", model_path=str(tmp_path / "km"))
    assert spark.read.parquet(str(tmp_path / "plot")).count() < df.count()


def test_score_stream(spark, telco, tmp_path):
    from scorewright.streaming import score_stream
    model = jobs.train_churn(spark, telco, "lr")["model"]
    inbox = telco_csv(str(tmp_path / "in"), n=50, seed=9, with_target=False)
    q = score_stream(spark, inbox, model, str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True)
    q.awaitTermination(120)
    got = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert got.count() == 50 and {r["churn"] for r in got.collect()} <= {"yes", "no"}


def test_command_line(spark, telco, tmp_path, capsys):
    import json

    from scorewright.__main__ import main
    model = str(tmp_path / "m")
    assert main(["train-churn", "--csv", telco, "--kind", "lr", "--model", model]) == 0
    assert main(["score-csv", "--csv", telco, "--model", model, "--out", str(tmp_path / "s")]) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).count() == 400
    assert main(["predict-customer", "--model", model, "--json", json.dumps(SAMPLE)]) == 0
    assert "leave_probability" in capsys.readouterr().out
    assert spark.sparkContext._jsc is not None      # the shared session is still running


def test_cluster_wholesale_command(spark, tmp_path, capsys):
    from scorewright.__main__ import main
    from scorewright.sources.tables import wholesale_table
    from scorewright.specs import WHOLESALE_COLUMNS, WHOLESALE_STANDIN_COLUMNS

    t = wholesale_table(spark, "/root/testdata/sf0.001")
    csv_dir = str(tmp_path / "wholesale")
    t.select(*[t[a].alias(b) for a, b in zip(WHOLESALE_STANDIN_COLUMNS, WHOLESALE_COLUMNS)]) \
        .write.option("header", True).csv(csv_dir)
    assert main(["cluster-wholesale", "--csv", csv_dir, "--model", str(tmp_path / "km"),
                 "--plot", str(tmp_path / "plot")]) == 0
    out = capsys.readouterr().out
    assert "silhouette" in out and "avg(" not in out
    assert spark.read.parquet(str(tmp_path / "plot")).columns == ["Milk", "Grocery", "prediction"]
