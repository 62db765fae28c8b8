"""Column expressions.  All of them are built-in Spark expressions (JVM side, no Python per row)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column, blank: str = " ") -> Column:
    """Exact-blank to null (training path: only the string ``" "`` counts as missing)."""
    c = _c(c)
    return F.when(c == F.lit(blank), F.lit(None)).otherwise(c)


def trimmed_blank_to_null(c: str | Column) -> Column:
    """Any whitespace-only or empty text to null (scoring path)."""
    c = _c(c)
    return F.when(F.trim(c) == F.lit(""), F.lit(None)).otherwise(c)


def parent_dir(path: str | Column) -> Column:
    """Name of the folder that holds a file: ``.../<label>/<file>`` -> ``<label>`` (null when the
    path has no folder part)."""
    return F.try_element_at(F.split(_c(path), "/"), F.lit(-2))


def file_extension(name: str | Column) -> Column:
    """Lower-cased extension including the dot (``''`` when there is none)."""
    return F.lower(F.regexp_extract(_c(name), r"(\.[^./]*)$", 1))


def sigmoid(z: str | Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))


def to_double_array(c: str | Column, dtype: DataType | None = None) -> Column:
    """ML vector or numeric array -> ``array<double>``."""
    c = _c(c)
    if dtype is not None and isinstance(dtype, ArrayType):
        return c.cast("array<double>")
    return vector_to_array(c)


def _paired(arr: str | Column, fixed: Sequence[float], term) -> Column:
    """Sum of ``term(entry, fixed entry)``, left to right from 0.0; the same form for every width.

    Null for a null array; an array that is not as long as the fixed one fails the query."""
    a, n = _c(arr), len(fixed)
    total = F.aggregate(F.zip_with(a, F.array(*[F.lit(float(x)) for x in fixed]), term), F.lit(0.0), lambda acc, x: acc + x)
    wrong = F.raise_error(F.concat(F.lit(f"array of length {n} expected, got "), F.size(a).cast("string"))).cast("double")
    return F.when(a.isNull(), F.lit(None).cast("double")).when(F.size(a) == n, total).otherwise(wrong)


def dot(arr: str | Column, weights: Sequence[float]) -> Column:
    """Left-to-right dot product of an ``array<double>`` with fixed weights."""
    return _paired(arr, weights, lambda x, y: x * y)


def squared_distance(arr: str | Column, centre: Sequence[float]) -> Column:
    """Squared Euclidean distance to a fixed point."""
    return _paired(arr, centre, lambda x, y: (x - y) * (x - y))


def has_nonzero(arr: str | Column, strict: bool = False) -> Column:
    """Keep-filter for embeddings: some entry differs from 0.

    ``strict=True`` reproduces the ``array_max(arr) != 0`` form, which also drops vectors whose
    largest entry is exactly 0 (e.g. ``[-1, 0]``).
    """
    a = _c(arr)
    if strict:
        return F.array_max(a) != F.lit(0.0)
    return F.exists(a, lambda x: x != F.lit(0.0))


def keyed_fraction(key: str | Column, seed: int | str = 42) -> Column:
    """First 16 bits of ``md5('<seed>:<key>')`` as hex text; ``< 'cccd'`` selects ~80%.

    A function of the key only: the same rows land on the same side on any partitioning,
    any cluster size, any engine that has md5.
    """
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string"))), 1, 4)


def percent(p: str | Column, decimals: int = 2) -> Column:
    return F.format_string(f"%.{decimals}f%%", _c(p) * F.lit(100.0))


def decision_text(prediction: str | Column, positive: str = "leave", negative: str = "stay") -> Column:
    return F.when(_c(prediction) == F.lit(1.0), F.lit(positive)).otherwise(F.lit(negative))
