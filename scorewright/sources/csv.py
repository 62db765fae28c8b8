"""CSV sources and the required-column contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


class MissingColumnsError(ValueError):
    def __init__(self, missing: Sequence[str]):
        self.missing = list(missing)
        super().__init__(f"Missing columns: {', '.join(self.missing)}")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             infer: bool = False) -> DataFrame:
    """CSV with a header row.

    Give ``schema`` for typed columns (no extra pass over the data; a value that does not parse
    becomes null under the default PERMISSIVE mode).  ``infer=True`` keeps the inference pass of
    the original jobs.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row, every column read as text (the scoring path)."""
    return spark.read.option("header", True).csv(path)


#: Column of ``read_csv_checked`` with the text of a malformed line (null: a good one).
MALFORMED = "_malformed"


def read_csv_checked(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """``read_csv_strings`` that keeps malformed lines: columns as text, and the line itself in ``MALFORMED``
    where it has too few or too many fields or a quote that isn't closed.

    Lines equal to the header (``header``, else the first line of the first file) are headers, in whatever file
    or split they stand; blank lines are skipped.  One scan; the header costs one line of one file."""
    lines = spark.read.text(path)
    if header is None:
        header = spark.read.text(sorted(lines.inputFiles())[0]).first()[0]
    names = spark.range(1).select(F.from_csv(F.lit(header), F.schema_of_csv(F.lit(header))).alias("h")).select("h.*").first()
    fields = StructType([StructField(str(n), StringType()) for n in names] + [StructField(MALFORMED, StringType())])
    rows = lines.filter((F.col("value") != F.lit(header)) & (F.trim("value") != ""))
    parsed = F.from_csv("value", _ddl(fields), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED})
    # quotes that no backslash precedes come in pairs
    bare = F.regexp_replace("value", r'\\.', "")
    odd = (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))) % 2 == 1
    out = rows.select("value", odd.alias("_odd"), parsed.alias("_row"))
    bad = F.col(f"_row.{MALFORMED}").isNotNull() | F.col("_odd")
    return out.select(*[F.col(f"_row.`{f.name}`").alias(f.name) for f in fields[:-1]], F.when(bad, F.col("value")).alias(MALFORMED))


def _ddl(fields: StructType) -> str:
    return ", ".join(f"`{f.name}` string" for f in fields)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail before any action if a required column is absent, naming every missing one."""
    present = set(df.columns)
    missing = [c for c in columns if c not in present]
    if missing:
        raise MissingColumnsError(missing)
    return df
