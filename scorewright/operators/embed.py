"""Image rows -> feature arrays, batched per Arrow batch, with the embedder built once per task.

The embedder is pluggable: any ``Callable[[np.ndarray], np.ndarray]`` mapping a batch
``(n, size, size, 3)`` of RGB uint8 images to ``(n, d)`` features.  A factory (called once per
task, inside the executor) is passed instead of the embedder itself so that a heavy network is
loaded per task, not pickled from the driver.  The built-in default is a deterministic colour
grid: per-cell channel means plus global channel standard deviations.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.resource import ExecutorResourceRequests, ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

Embedder = Callable[[np.ndarray], np.ndarray]
FEATURES_TYPE = T.StructType([T.StructField("features", T.ArrayType(T.FloatType())), T.StructField("error", T.StringType())])
DEFAULT_GRID = 4
SIZE = 224                      # pixels a side that the embedder sees
EMBED_BATCH = 64                # pictures held at that size at a time


def colour_grid(grid: int = DEFAULT_GRID) -> Embedder:
    """``3*grid*grid + 3`` features in [0, 1]."""

    def embed(batch: np.ndarray) -> np.ndarray:
        n, s, _, _ = batch.shape
        if s < grid:
            raise ValueError(f"pictures of at least {grid} pixels a side expected, got {s}")
        cuts = np.arange(grid) * s // grid                # cells may differ by a pixel
        size = np.diff(np.append(cuts, s))
        # sums of integers, all held exactly: the features don't depend on the order of summation
        exact = np.float32 if 255 * 255 * s < 1 << 24 else np.float64
        bands, column = np.repeat(np.eye(grid, dtype=exact), size, axis=1), np.ones(s, exact)
        sums, squares = np.empty((n, grid, grid, 3), np.int64), np.empty((n, 3), np.int64)
        for i, picture in enumerate(batch):
            a = picture.reshape(s, 3 * s).astype(exact)
            sums[i] = np.add.reduceat((bands @ a).astype(np.int64).reshape(grid, s, 3), cuts, axis=1)
            a *= a
            squares[i] = (column @ a).astype(np.int64).reshape(s, 3).sum(axis=0)
        cells = sums / (size[:, None, None] * size[None, :, None] * 255.0)
        total = sums.sum(axis=(1, 2))
        spread = np.sqrt((s * s * squares - total * total).astype(np.float64)) / (s * s * 255.0)
        return np.concatenate([cells.reshape(n, -1), spread], axis=1).astype(np.float32)

    return embed


def _to_rgb(data, height: int, width: int, channels: int, size: int) -> np.ndarray:
    """Spark image bytes (BGR or BGRA or gray, row-major) -> RGB ``size x size`` (bilinear, pixel centres
    aligned, halves rounded up; in integers, so every machine gets the same pixels)."""
    a = np.frombuffer(bytes(data), dtype=np.uint8).reshape(height, width, channels)
    if channels == 1:
        a = np.repeat(a, 3, axis=2)
    else:
        a = a[:, :, [2, 1, 0]]
    if (height, width) == (size, size):
        return a

    (y0, y1, fy), (x0, x1, fx), whole = _places(height, size), _places(width, size), 4 * size * size
    rows, at = np.unique(np.concatenate([y0, y1]), return_inverse=True)      # across first, in the rows that count: they are few
    wide = a[rows]
    wide = wide[:, x0] * (2 * size - fx)[None, :, None] + wide[:, x1] * fx[None, :, None]
    out, below = np.take(wide, at[:size], axis=0), np.take(wide, at[size:], axis=0)
    out *= (2 * size - fy)[:, None, None]
    below *= fy[:, None, None]
    out += below
    out += whole // 2
    out //= whole
    return out.astype(np.uint8)


@lru_cache(maxsize=256)
def _places(n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For ``size`` places over ``n`` pixels: the pixels before and after each, and the share of the one after (of ``2 * size``)."""
    unit = 2 * size                                       # places count in parts of a pixel
    kind = np.int32 if 256 * unit * unit < 1 << 31 else np.int64
    at = ((2 * np.arange(size) + 1) * n - size).clip(0, unit * (n - 1))
    low = at // unit
    return low, np.minimum(low + 1, n - 1), (at - low * unit).astype(kind)


def _embed_into(embed: Embedder, places: list, imgs: list, feats: list, errors: list) -> None:
    """Features of a batch; if it fails, picture by picture, so one bad picture costs only itself."""
    try:
        vecs = list(np.asarray(embed(np.stack(imgs)), dtype=np.float32))
    except Exception:  # noqa: BLE001 - told apart below
        vecs, first = [], None
        for img in imgs:
            try:
                vecs.append(np.asarray(embed(img[None]), dtype=np.float32)[0])
            except Exception as e:  # noqa: BLE001
                vecs.append(e)
                first = first or e
        if len(imgs) > 1 and all(isinstance(v, Exception) for v in vecs):
            raise RuntimeError(f"the embedder fails on every picture: {first}") from first
    for i, v in zip(places, vecs):
        if isinstance(v, Exception):
            errors[i] = f"embedder failed: {v}"
        else:
            feats[i] = v.tolist()


def embedding_resources(cores: int | None = None, memory: str | None = None, overhead: str | None = None, accelerator: str | None = None,
                        accelerators: int = 1, tasks_per_accelerator: int = 1, discovery_script: str = "") -> ResourceProfile:
    """A resource profile for the embedding stage: cores and memory of its executors, and an accelerator
    (``"gpu"``) that ``tasks_per_accelerator`` tasks share."""
    executor, task = ExecutorResourceRequests(), TaskResourceRequests()
    if cores:
        executor.cores(cores)
    if memory:
        executor.memory(memory)
    if overhead:
        executor.memoryOverhead(overhead)
    if accelerator:
        executor.resource(accelerator, accelerators, discovery_script)
        task.resource(accelerator, 1.0 / tasks_per_accelerator)
    task.cpus(1)
    return ResourceProfileBuilder().require(executor).require(task).build


def stage_profile(master: str, resources: ResourceProfile | None) -> ResourceProfile | None:
    """``resources`` where the master can start executors by them (standalone, YARN, Kubernetes), else none, with a warning."""
    if resources is None or master.startswith(("spark://", "yarn", "k8s://")):
        return resources
    warnings.warn(f"the master {master} has no stage-level resources: the embedding stage runs with what there is", stacklevel=3)
    return None


def _in_own_stage(df: DataFrame, image_col: str, featurize, out: str, profile: ResourceProfile) -> DataFrame:
    """``featurize`` as a ``mapInArrow`` over whole rows: the operator that takes a resource profile."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, FEATURES_TYPE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[pa.RecordBatch] = []

        def pictures() -> Iterator[pd.DataFrame]:
            for b in batches:
                seen.append(b)
                image = b.column(b.schema.get_field_index(image_col))
                yield pd.DataFrame({c: pa.array(image.field(c)).to_pandas() for c in ("height", "width", "nChannels", "data")})

        for told in featurize(pictures()):
            b = seen.pop(0)
            features = pa.array([None if f is None else list(f) for f in told["features"]], pa.list_(pa.float32()))
            found = pa.StructArray.from_arrays([features, pa.array(list(told["error"]), pa.string())], ["features", "error"])
            yield pa.RecordBatch.from_arrays([*b.columns, found], names=[*b.schema.names, out])

    return df.mapInArrow(run, schema, profile=profile)


def image_features(df: DataFrame, image_col: str = "image", size: int = SIZE,
                   embedder_factory: Callable[[], Embedder] | None = None, out: str = "emb", resources: ResourceProfile | None = None) -> DataFrame:
    """Add ``out struct<features array<float>, error string>``.

    Undecodable images (height <= 0 or empty data) and pictures the embedder fails on give a null
    feature array and an error message instead of failing the task or inventing a zero vector.  An
    embedder that fails on every picture of a batch of several fails the job.  The function counts as
    non-deterministic, so the optimizer never runs it twice to push a filter below it.

    ``resources``: executor and task resources of this stage alone (cores, memory, an accelerator; see
    ``embedding_resources``).  A local master has no executors to ask for them: there they are ignored with a warning.
    """
    from scorewright.session import ship_package

    ship_package(df.sparkSession)
    factory = embedder_factory or colour_grid

    def featurize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embed = factory()                      # once per task
        for b in batches:
            n = len(b)
            feats: list = [None] * n
            errors: list = [None] * n
            ok_idx, imgs = [], []
            for i, (h, w, c, data) in enumerate(zip(b["height"], b["width"], b["nChannels"], b["data"])):
                if h is None or h <= 0 or w <= 0 or data is None or len(data) == 0:
                    errors[i] = "undecodable image"
                    continue
                try:
                    imgs.append(_to_rgb(data, int(h), int(w), int(c), size))
                    ok_idx.append(i)
                except Exception as e:  # noqa: BLE001 - per-row error column
                    errors[i] = f"bad pixels: {e}"
                if len(imgs) == EMBED_BATCH:
                    _embed_into(embed, ok_idx, imgs, feats, errors)
                    ok_idx, imgs = [], []
            if imgs:
                _embed_into(embed, ok_idx, imgs, feats, errors)
            yield pd.DataFrame({"features": feats, "error": errors})

    profile = stage_profile(df.sparkSession.sparkContext.master, resources)
    if profile is not None:
        return _in_own_stage(df, image_col, featurize, out, profile)
    img: Column = F.col(image_col)
    udf = pandas_udf(featurize, FEATURES_TYPE)
    return df.withColumn(out, udf.asNondeterministic()(F.struct(img["height"].alias("height"), img["width"].alias("width"),
                                                 img["nChannels"].alias("nChannels"), img["data"].alias("data"))))
