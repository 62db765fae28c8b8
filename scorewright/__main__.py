"""Command line for the batch jobs (``spark-submit`` a script that calls this, or
``python -m scorewright <command> ...``).  Paths are any Hadoop URI.

    train-churn     --csv P [--kind rf|gbt|lr] [--model OUT]
    compare-models  --csv P --out DIR [--replicas 200]
    cluster-telco   --csv P [--model OUT] [--plot OUT] [--k 5]
    cluster-wholesale --csv P [--model OUT] [--k 5]
    predict-customer --model P --json '{"gender": "Female", ...}'
    score-csv       --csv P --model P --out DIR
    train-image-lr  --images GLOB --model OUT --labels OUT --metrics OUT [--weighted]
    score-zip       --zip-uri P --lr-model-path P --labels-json P --output-csv DIR [--repartition N]
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _spark(name: str) -> tuple[SparkSession, bool]:
    """The active session if there is one (then it is left running), else a new one."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active, False
    s = SparkSession.builder.appName(name).getOrCreate()
    s.sparkContext.setLogLevel("WARN")
    return s, True


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="scorewright")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("train-churn")
    p.add_argument("--csv", required=True)
    p.add_argument("--kind", default="rf", choices=["rf", "gbt", "lr"])
    p.add_argument("--model")
    p = sub.add_parser("compare-models")
    p.add_argument("--csv", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--replicas", type=int, default=200)
    for name in ("cluster-telco", "cluster-wholesale"):
        p = sub.add_parser(name)
        p.add_argument("--csv", required=True)
        p.add_argument("--model")
        p.add_argument("--plot")
        p.add_argument("--k", type=int, default=5)
    p = sub.add_parser("predict-customer")
    p.add_argument("--model", required=True)
    p.add_argument("--json", required=True)
    p = sub.add_parser("score-csv")
    p.add_argument("--csv", required=True)
    p.add_argument("--model", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("train-image-lr")
    p.add_argument("--images", required=True)
    p.add_argument("--model")
    p.add_argument("--labels")
    p.add_argument("--metrics")
    p.add_argument("--weighted", action="store_true")
    p = sub.add_parser("score-zip")          # fixed values: the five option names below are the job's contract
    p.add_argument("--zip-uri", required=True)
    p.add_argument("--lr-model-path", required=True)
    p.add_argument("--labels-json", required=True)
    p.add_argument("--output-csv", required=True)
    p.add_argument("--repartition", type=int, default=0)
    a = ap.parse_args(argv)

    from scorewright.plans import jobs
    from scorewright.specs import TELCO, WHOLESALE_COLUMNS, TableSpec

    spark, owned = _spark(f"scorewright-{a.cmd}")
    if a.cmd == "train-churn":
        r = jobs.train_churn(spark, a.csv, a.kind, a.model)
        r["metrics"].show(truncate=False)
        r["counts"].show()
        shown = [TELCO.id_col, *TELCO.numeric, TELCO.target, "prediction", "probability"]
        r["predictions"].select(*shown).orderBy(TELCO.id_col).show(10, truncate=False)
    elif a.cmd == "compare-models":
        jobs.compare_churn_models(spark, a.csv, a.out, a.replicas).show(truncate=False)
    elif a.cmd == "cluster-telco":
        r = jobs.cluster_customers(spark, jobs.load_training_table(spark, a.csv, TELCO), TELCO, k=a.k,
                                   scale="std", key=TELCO.id_col, model_path=a.model, plot_path=a.plot,
                                   plot_columns=["MonthlyCharges", "TotalCharges"],
                                   profile_columns=["MonthlyCharges", "TotalCharges"])
        r["profile"].show()
        r["silhouette"].show()
    elif a.cmd == "cluster-wholesale":
        from scorewright.sources.csv import read_csv
        spec = TableSpec(id_col="", categorical=[], numeric=WHOLESALE_COLUMNS)
        df = read_csv(spark, a.csv, infer=True)
        r = jobs.cluster_customers(spark, df, spec, k=a.k, scale="center", model_path=a.model,
                                   plot_path=a.plot, plot_columns=["Milk", "Grocery"], plot_fraction=None)
        r["profile"].show()
        r["silhouette"].show()
    elif a.cmd == "predict-customer":
        jobs.score_rows(spark, [json.loads(a.json)], a.model).show(truncate=False)
    elif a.cmd == "score-csv":
        jobs.score_csv(spark, a.csv, a.model, a.out)
    elif a.cmd == "train-image-lr":
        r = jobs.train_image_lr(spark, a.images, a.model, a.labels, a.metrics, weighted=a.weighted)
        r["metrics"].show()
    elif a.cmd == "score-zip":
        jobs.score_zip(spark, a.zip_uri, a.lr_model_path, a.labels_json, a.output_csv, a.repartition or None, single_file=True)
    if owned:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
