"""Feature encoding: index, one-hot, assemble, scale -- the built-in ``pyspark.ml`` stages.

One multi-column ``StringIndexer`` replaces one indexer per column (one aggregation job to fit
instead of fifteen) and one multi-column ``OneHotEncoder`` replaces fifteen encoders.  Index
order is frequency descending, then value ascending; null and unseen values get index ``n``
(``handleInvalid='keep'``), which the one-hot step (``dropLast``) turns into an all-zero block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame

from scorewright.specs import TableSpec


def idx_col(c: str) -> str:
    return f"{c}_idx"


def vec_col(c: str) -> str:
    return f"{c}_vec"


def indexer(columns: Sequence[str], handle_invalid: str = "keep") -> StringIndexer:
    cols = list(columns)
    return StringIndexer(inputCols=cols, outputCols=[idx_col(c) for c in cols],
                         handleInvalid=handle_invalid, stringOrderType="frequencyDesc")


def one_hot(columns: Sequence[str]) -> OneHotEncoder:
    cols = list(columns)
    return OneHotEncoder(inputCols=[idx_col(c) for c in cols], outputCols=[vec_col(c) for c in cols],
                         dropLast=True)


def assembler(numeric: Sequence[str], categorical: Sequence[str], output: str = "features") -> VectorAssembler:
    """Numerics first, then the one-hot blocks, in the given order (nulls raise, as in Spark)."""
    return VectorAssembler(inputCols=[*numeric, *[vec_col(c) for c in categorical]], outputCol=output,
                           handleInvalid="error")


def scaler(input_col: str = "raw_features", output_col: str = "features", with_mean: bool = False,
           with_std: bool = True) -> StandardScaler:
    """Divide by the sample standard deviation (and optionally subtract the mean)."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=with_mean, withStd=with_std)


def feature_stages(spec: TableSpec, output: str = "features", scale: str | None = None) -> list:
    """Indexer, one-hot, assembler (and a scaler when ``scale`` is ``'std'`` or ``'center'``)."""
    stages: list = []
    if spec.categorical:
        stages += [indexer(spec.categorical), one_hot(spec.categorical)]
    if scale is None:
        stages.append(assembler(spec.numeric, spec.categorical, output))
    else:
        stages.append(assembler(spec.numeric, spec.categorical, "raw_features"))
        stages.append(scaler("raw_features", output, with_mean=(scale == "center")))
    return stages


def fit_features(df: DataFrame, spec: TableSpec, output: str = "features", scale: str | None = None) -> PipelineModel:
    return Pipeline(stages=feature_stages(spec, output, scale)).fit(df)
