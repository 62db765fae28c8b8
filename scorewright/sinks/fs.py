"""Hadoop FileSystem access through the JVM gateway (any Hadoop URI: file, hdfs, s3a, gs...)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def is_complete(spark: SparkSession, path: str) -> bool:
    """A Spark writer finished this folder (``_SUCCESS`` marker present)."""
    return exists(spark, path.rstrip("/") + "/_SUCCESS")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs_and_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def file_states(spark: SparkSession, path: str) -> list[str]:
    """``name:length:modified`` of the files in a folder and in its sub-folders' first level, sorted."""
    fs, p = _fs_and_path(spark, path)
    out = []
    for s in fs.listStatus(p) if fs.exists(p) else []:
        inner = fs.listStatus(s.getPath()) if s.isDirectory() else [s]
        out += [f"{s.getPath().getName()}/{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}" for f in inner]
    return sorted(out)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as the cluster's Hadoop configuration resolves it."""
    fs, p = _fs_and_path(spark, path)
    return fs.makeQualified(p).toString()


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs_and_path(spark, src)
    d = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)
    if fs.exists(d):
        fs.delete(d, True)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs_and_path(spark, path)
    fs.mkdirs(p)


def stage_once(spark: SparkSession, path: str, write) -> str:
    """Produce ``path`` exactly once: ``write(tmp)`` fills a private temporary folder next to it,
    which is then renamed into place.  The final folder only ever appears complete; if another
    writer published first, this copy is dropped.  ``write`` must leave ``_SUCCESS`` in ``tmp``
    (any Spark writer does)."""
    import uuid

    if is_complete(spark, path):
        return path
    tmp = f"{path.rstrip('/')}.tmp-{uuid.uuid4().hex}"
    write(tmp)
    fs, t = _fs_and_path(spark, tmp)
    dst = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if fs.exists(dst) and not is_complete(spark, path):
        fs.delete(dst, True)                # leftover of a writer that died before publishing
    if not fs.exists(dst):
        fs.mkdirs(dst.getParent())
        fs.rename(t, dst)
    if fs.exists(t):
        fs.delete(t, True)                  # someone else published first
    return path


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file (a completion marker)."""
    fs, p = _fs_and_path(spark, path)
    fs.create(p, True).close()
