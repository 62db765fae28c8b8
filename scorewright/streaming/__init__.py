"""Scoring on a stream of CSV files.

The original jobs are batch only (streaming is listed there as not done).  Every scoring step
here is row-wise -- contract check, cleaning, a fitted pipeline of stateless transformers -- so
the batch scorer runs unchanged on a Structured Streaming source; nothing stateful (no
watermark, no aggregation state) is involved.  The checkpoint location makes the query restart
where it stopped after a failure.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from scorewright.operators.clean import clean_blank_zero
from scorewright.operators.scoring import id_and_answer
from scorewright.sources.csv import require_columns
from scorewright.specs import TELCO, TableSpec


def read_csv_stream(spark: SparkSession, in_dir: str, spec: TableSpec = TELCO,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """All-string CSV stream with the contract's columns (a file stream needs its schema up front)."""
    schema = ", ".join(f"`{c}` string" for c in spec.required)
    r = spark.readStream.option("header", True).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(in_dir)


def score_stream(spark: SparkSession, in_dir: str, model: str | PipelineModel, out_dir: str,
                 checkpoint: str, spec: TableSpec = TELCO, available_now: bool = False) -> StreamingQuery:
    """New CSV files in ``in_dir`` -> ``id,churn`` CSV files in ``out_dir`` (append)."""
    m = PipelineModel.load(model) if isinstance(model, str) else model
    raw = require_columns(read_csv_stream(spark, in_dir, spec), spec.required)
    scored = id_and_answer(m.transform(clean_blank_zero(raw, spec)), spec.id_col)
    w = (scored.writeStream.format("csv").option("header", True).option("path", out_dir)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
