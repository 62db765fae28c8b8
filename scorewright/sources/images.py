"""Image sources: image directories, ZIP archives of images, and file staging.

Decoding is left to Spark's image source (``format("image")``: JPEG, PNG, BMP, GIF; BGR bytes).
ZIP members are listed by a Python UDTF that reads each archive's central directory; to decode
them, the members are spread over tasks, extracted into files under a shared folder by those
tasks, and read back with the image source.
"""

from __future__ import annotations

import hashlib
import os
import threading
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from scorewright.functions.scalar import file_extension, parent_dir
from scorewright.sources.filesystems import Store, resolve
from scorewright.specs import IMAGE_EXTENSIONS


class NoImagesError(RuntimeError):
    pass


#: Java writes every picture to a temporary file before it decodes it, unless told not to: in each executor, by the rows it reads.
IN_MEMORY = "reflect('javax.imageio.ImageIO', 'setUseCache', false) is not null"


def read_images(spark: SparkSession, path: str, drop_invalid: bool = False, recursive: bool = False) -> DataFrame:
    """``image`` struct rows; undecodable files stay as rows with height -1 unless ``drop_invalid``."""
    r = spark.read.format("image").option("dropInvalid", drop_invalid)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(path).filter(IN_MEMORY)


#: Whether rows are converted by code generated for them or step by step, which is slower a row but costs nothing to set up.
CONVERSION, STEP_BY_STEP = "spark.sql.codegen.factoryMode", "NO_CODEGEN"
_READS: dict[SparkSession, tuple[int, str | None]] = {}     # actions that read pictures now, and the setting before the first
_READS_LOCK = threading.Lock()


@contextmanager
def reading_pictures(spark: SparkSession) -> Iterator[None]:
    """For the action that reads pictures: rows are converted without generated code until it ends.

    The image source makes the converter of its rows anew for every file, and generating that code takes several times
    as long as reading and decoding a small picture.  Rows are the same either way.  The session's own setting comes back
    after the action, or after the last of those that several threads run."""
    with _READS_LOCK:
        n, before = _READS.get(spark, (0, spark.conf.get(CONVERSION, None)))
        spark.conf.set(CONVERSION, STEP_BY_STEP)
        _READS[spark] = n + 1, before
    try:
        yield
    finally:
        with _READS_LOCK:
            n, before = _READS.pop(spark)
            if n > 1:
                _READS[spark] = n - 1, before
            elif before is None:
                spark.conf.unset(CONVERSION)
            else:
                spark.conf.set(CONVERSION, before)


#: What one read task of pictures takes, by Spark's measure: the bytes of its files and ``spark.sql.files.openCostInBytes`` for each.
PACK_BYTES = 1 << 30


def packed(images: DataFrame) -> DataFrame:
    """``images`` in fewer, larger tasks, without a shuffle: as many partitions to one as make ``PACK_BYTES`` (256 small pictures),
    but never fewer than eight tasks a core.  A partition of 4 or 32 small pictures, as Spark packs them by
    ``spark.sql.files.maxPartitionBytes``, costs its task more in starting and committing than in pictures."""
    spark = images.sparkSession
    some, size = images.rdd.getNumPartitions(), spark.conf.get("spark.sql.files.maxPartitionBytes")
    each = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)
    most = max(8 * spark.sparkContext.defaultParallelism, some * each // PACK_BYTES)
    return images.coalesce(most) if some > most else images


def with_path_label(df: DataFrame, out: str = "label") -> DataFrame:
    """Class label from the folder that holds each image."""
    return df.withColumn(out, parent_dir(F.col("image.origin")))


# ---------------------------------------------------------------- ZIP members
@udtf(returnType="name string, size long, error string")
class ZipIndex:
    """One row per file member of the archive at ``path`` (directories skipped).

    Only the archive's central directory is read (random access), so listing costs the same
    for a 10 MB or a 100 GB archive and no archive passes through a single row."""

    def eval(self, path: str, store: str):
        if path is None:
            return
        try:
            fs, p = Store.of(store).open(path)
            with fs.open_input_file(p) as f, zipfile.ZipFile(f, "r") as zf:
                infos = zf.infolist()
        except Exception as e:  # noqa: BLE001 - an unreadable archive becomes one error row
            yield None, None, f"bad archive: {e}"
            return
        for info in infos:
            if not info.is_dir():
                yield info.filename, info.file_size, None


def list_archives(spark: SparkSession, zip_path: str) -> DataFrame:
    """``(archive, length)`` of every ``*.zip`` under ``zip_path`` (file contents are not read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(zip_path)
            .select(F.col("path").alias("archive"), "length"))


def zip_members(spark: SparkSession, zip_path: str, extensions=IMAGE_EXTENSIONS,
                require_any: bool = True) -> DataFrame:
    """``(archive, name, size, error)`` for every member whose extension (any case) is listed,
    plus one error row per unreadable archive.  ``require_any`` raises when no member qualifies."""
    from scorewright.session import ship_package

    ship_package(spark)
    store = F.lit(resolve(spark, zip_path).text())
    members = list_archives(spark, zip_path).lateralJoin(ZipIndex(F.col("archive").outer(), store)).select(
        "archive", "name", "size", "error")
    members = members.filter(F.col("name").isNull() | file_extension("name").isin(list(extensions)))
    if require_any and members.filter(F.col("name").isNotNull()).isEmpty():
        raise NoImagesError("No valid images found in ZIP.")
    return members


# ---------------------------------------------------------------- staging files from tasks
def write_bytes(path: str, data: bytes, store: Store) -> None:
    import io

    write_stream(path, io.BytesIO(data), store)


def write_stream(path: str, source, store: Store) -> None:
    """Write a file from a task, copying ``source`` in pieces (any size, little memory): to a unique
    temporary name, then move it into place, so a retried or speculative attempt never leaves a
    half-written file under the final name."""
    import shutil
    import uuid

    fs, p = store.open(path)
    parent = p.rsplit("/", 1)[0]
    tmp = f"{parent}/.{p.rsplit('/', 1)[-1]}.{uuid.uuid4().hex}.tmp"
    try:
        out = fs.open_output_stream(tmp)
    except FileNotFoundError:                # the folder's first file; asked for each, it is a third of a small file's cost
        fs.create_dir(parent, recursive=True)
        out = fs.open_output_stream(tmp)
    with out as f:
        shutil.copyfileobj(source, f, 1 << 20)
    fs.move(tmp, p)


#: Uncompressed bytes of members that one task extracts.
STAGE_TASK_BYTES = 256 << 20


def staged_name(archive: str, name: str) -> str:
    """Collision-free file name for a member: hash of (archive, name) + ext.  Its first two digits name the
    sub-folder, so Spark lists 256 folders in parallel (a task each) instead of one huge one."""
    ext = os.path.splitext(name)[1].lower()
    return hashlib.sha1(f"{archive}\x00{name}".encode()).hexdigest() + ext


def stage_members(members: DataFrame, stage_dir: str, num_partitions: int | None = None, archives: Store | None = None) -> DataFrame:
    """Extract members into files under ``stage_dir`` and return ``(archive, name, staged, error)``;
    ``staged`` is the file name to join image rows on.

    ``members`` is read twice (its total size, then the rows): pass a written listing.  Member rows are
    hash-partitioned on (archive, name), into one share per core or per ``STAGE_TASK_BYTES``, whichever is
    more (or ``num_partitions``), so the members of one huge archive are extracted by many tasks.  Each task
    sorts its rows by archive, so it opens an archive once (once more where a batch ends) and reads only its members
    (random access), copied in pieces.  A member
    that does not inflate becomes an error row.  ``archives``: the store the archives lie in (else the stage folder's)."""
    from scorewright.session import ship_package
    from scorewright.sinks.fs import qualified

    ship_package(members.sparkSession)
    stage_dir = qualified(members.sparkSession, stage_dir.rstrip("/"))
    staging = resolve(members.sparkSession, stage_dir)
    archived = archives or staging
    n = num_partitions
    if n is None:
        size = members.agg(F.sum("size")).first()[0] or 0
        n = max(members.sparkSession.sparkContext.defaultParallelism, -(-size // STAGE_TASK_BYTES))
    spread = members.repartition(n, "archive", "name").sortWithinPartitions("archive", "name")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            archives, names = list(b["archive"]), list(b["name"])
            staged, errors = [None] * len(b), list(b["error"])
            for archive, rows in b.groupby("archive", sort=False).indices.items():
                try:
                    fs, p = archived.open(archive)
                    f = fs.open_input_file(p)
                    zf = zipfile.ZipFile(f, "r")
                except Exception as e:  # noqa: BLE001 - every member of the archive fails
                    for i in rows:
                        errors[i] = errors[i] or f"bad archive: {e}"
                    continue
                with f, zf:
                    for i in rows:
                        if names[i] is None or errors[i]:
                            continue
                        fname = staged_name(archives[i], names[i])
                        try:
                            with zf.open(names[i]) as body:
                                write_stream(f"{stage_dir}/{fname[:2]}/{fname}", body, staging)
                        except (zipfile.BadZipFile, zlib.error, KeyError, EOFError, NotImplementedError, RuntimeError) as e:
                            errors[i] = f"unreadable member: {e}"
                            continue
                        staged[i] = fname
            yield pd.DataFrame({"archive": archives, "name": names, "staged": staged, "error": errors})

    return spread.mapInPandas(write, "archive string, name string, staged string, error string")
