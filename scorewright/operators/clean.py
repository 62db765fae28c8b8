"""Cleaning, typed casts, labels and the row-level quarantine report (one projection each)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from scorewright.functions.scalar import blank_to_null, trimmed_blank_to_null
from scorewright.specs import TableSpec


def _is_string(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, StringType)


def typed_casts(df: DataFrame, int_columns: Sequence[str] = (), double_columns: Sequence[str] = ()) -> DataFrame:
    """Text to int/double where text that does not parse becomes null (``try_cast``)."""
    casts = {c: F.col(c).try_cast("int") for c in int_columns}
    casts.update({c: F.col(c).try_cast("double") for c in double_columns})
    return df.withColumns(casts) if casts else df


def derive_label(df: DataFrame, target: str, positive: str = "Yes", label_col: str = "label") -> DataFrame:
    """``(target == positive)`` as 0/1 int; a null target stays null (filter it before a fit)."""
    return df.withColumn(label_col, (F.col(target) == F.lit(positive)).cast("int"))


def clean_blank_drop(df: DataFrame, spec: TableSpec, label_col: str | None = "label") -> DataFrame:
    """Training path: exact ``" "`` -> null in the blank column, typed casts, drop rows whose
    blank column is null, 0/1 label from the target."""
    exprs: dict[str, Column] = {}
    for c in spec.int_columns:
        exprs[c] = F.col(c).try_cast("int") if _is_string(df, c) else F.col(c).cast("int")
    for c in spec.double_columns:
        v = blank_to_null(c) if (c == spec.blank_column and _is_string(df, c)) else F.col(c)
        exprs[c] = v.try_cast("double")
    out = df.withColumns(exprs)
    if spec.blank_column:
        out = out.na.drop(subset=[spec.blank_column])
    if label_col and spec.target and spec.target in df.columns:
        out = derive_label(out, spec.target, spec.positive, label_col)
    return out


def clean_blank_zero(df: DataFrame, spec: TableSpec, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Scoring path: whitespace-only -> null in the blank column, typed casts, then per-column
    defaults for nulls (no row is dropped)."""
    exprs: dict[str, Column] = {}
    for c in spec.int_columns:
        exprs[c] = F.col(c).try_cast("int") if _is_string(df, c) else F.col(c).cast("int")
    for c in spec.double_columns:
        v = trimmed_blank_to_null(c) if (c == spec.blank_column and _is_string(df, c)) else F.col(c)
        exprs[c] = v.try_cast("double")
    out = df.withColumns(exprs)
    fill = dict(spec.defaults if defaults is None else defaults)
    return out.fillna(fill) if fill else out


def quarantine(df: DataFrame, spec: TableSpec, check_text: bool = False) -> DataFrame:
    """Row-level issue report in one pass.

    Adds ``errors array<string>`` (one message per value that is missing or does not parse: typed
    columns, then with ``check_text`` the id and the categoricals, as far as the table has them) and
    ``status`` (``ok`` / ``rejected``); numeric columns come back typed.  Split with
    ``filter(status == 'ok')`` and ``filter(status == 'rejected')``: both branches read the same
    projection, so nothing is re-parsed per branch.
    """
    typed: dict[str, Column] = {}
    checks: list[Column] = []
    for c in [*spec.int_columns, *spec.double_columns]:
        raw = F.col(c)
        kind = "int" if c in spec.int_columns else "double"
        text = trimmed_blank_to_null(raw) if _is_string(df, c) else raw
        value = text.try_cast(kind)
        typed[c] = value
        checks.append(F.when(text.isNull(), F.lit(f"{c}: missing"))
                      .when(value.isNull(), F.concat(F.lit(f"{c}: not a valid {kind}: '"), raw, F.lit("'"))))
    for c in [spec.id_col, *spec.categorical]:
        if check_text and c in df.columns:
            text = trimmed_blank_to_null(c) if _is_string(df, c) else F.col(c)
            checks.append(F.when(text.isNull(), F.lit(f"{c}: missing")))
    errors = F.array_compact(F.array(*checks))
    out = df.withColumn("errors", errors).withColumns(typed)
    return out.withColumn("status", F.when(F.size("errors") == 0, F.lit("ok")).otherwise(F.lit("rejected")))
