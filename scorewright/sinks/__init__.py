"""Writers.  Side effects live here (and in ``plans.jobs``); operators stay pure."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.sinks import fs


def write_json_single(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A small result (metrics, label map) as one JSON-lines part file.

    ``repartition(1)`` rather than ``coalesce(1)``: the upstream plan keeps its parallelism and
    only the final rows meet in one task.
    """
    df.repartition(1).write.mode(mode).json(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    """Distributed CSV (one part file per task): the writer for results of any size."""
    df.write.mode(mode).option("header", header).csv(path)
    return path


def write_single_csv(spark: SparkSession, df: DataFrame, out_dir: str, filename: str, header: bool = True) -> str:
    """All rows in the one file ``<out_dir>/<filename>``, an existing one replaced, in the order of ``df``'s partitions.

    The tasks write their rows as CSV lines (quoted as Spark's CSV writer does) into parts, and the commit joins
    the parts (``sinks.one_file``): no row is moved to another task first.
    """
    from scorewright.session import ship_package
    from scorewright.sinks.one_file import OneFile
    from scorewright.sources.filesystems import resolve

    ship_package(spark)
    spark.dataSource.register(OneFile)
    folder = fs.qualified(spark, out_dir.rstrip("/"))
    target = f"{folder}/{filename}"
    # a null alone in its row would be an empty line, which readers skip
    options = {"nullValue": '""'} if len(df.columns) == 1 else {}
    writer = (df.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns]), options).alias("line")).write.format("one_file").mode("append")
              .option("target", target).option("scratch", f"{folder}/.one-file-{uuid.uuid4().hex}").option("store", resolve(spark, folder).text()))
    (writer.option("first", csv_line(df.columns)) if header else writer).save()
    return f"{out_dir.rstrip('/')}/{filename}"


def csv_line(values: Sequence[str]) -> str:
    """A line as Spark's CSV writer quotes it: only where needed, with a backslash before a quote."""
    def cell(v: str) -> str:
        return '"' + v.replace("\\", "\\\\").replace('"', '\\"') + '"' if any(c in v for c in ',"\n\r') or v == "" else v
    return ",".join(cell(v) for v in values)


def write_label_map(spark: SparkSession, labels: Sequence[str], path: str) -> str:
    """``{"index": i, "label": labels[i]}`` lines from a fitted indexer's label list."""
    df = spark.createDataFrame([(i, str(lab)) for i, lab in enumerate(labels)], "index int, label string")
    return write_json_single(df, path)


def save_model(model, path: str, overwrite: bool = True) -> str:
    """Save a fitted model or pipeline; ``overwrite=False`` fails when ``path`` exists."""
    if overwrite:
        model.write().overwrite().save(path)
    else:
        model.save(path)
    return path
