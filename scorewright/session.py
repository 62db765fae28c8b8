"""Session helpers and the shared work folder.

On a cluster the work folder is the one the cluster names in ``spark.checkpoint.dir``
(a shared file system).  Only when that setting is absent -- local tests, the smoke
check -- do we create our own folder and register it as the checkpoint dir.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

from pyspark.sql import SparkSession

_PKG = "scorewright"


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = _PKG,
                  driver_memory: str = "8g") -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only when the session has none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if conf_dir:
            sc.setCheckpointDir(conf_dir)
        elif not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        else:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix=f"{_PKG}-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path under ``<checkpoint root>/scorewright`` for staged tables and sink output."""
    root = checkpoint_root(spark)
    # the checkpoint dir is a per-application sub folder (<dir>/<uuid>); stage next to it
    base = root.rsplit("/", 1)[0] if "/" in root else root
    return "/".join([base, _PKG, *parts])


STAGE_VERSION = "5"   # bump when the rules that derive staged inputs change


def stage_key(spark: SparkSession, folder: str) -> str:
    """Key of what is derived from ``folder``: its path and the names, lengths and modification times
    of its files (a table may be a file or a folder of files), so replaced tables are derived anew."""
    from scorewright.sinks.fs import file_states

    return hashlib.sha1("|".join([STAGE_VERSION, folder.rstrip("/"), *file_states(spark, folder)]).encode()).hexdigest()[:12]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``scorewright`` importable in the executors' Python workers (``addPyFile``).

    Functions run by pandas UDFs, ``mapInPandas`` and UDTFs are pickled by reference to this
    package, so the workers must be able to import it.  The package is zipped in memory, written
    through the Hadoop FileSystem into the shared work folder, and registered once per
    application (a deployment that already ships it with ``--py-files`` loses nothing)."""
    import io
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    data = buf.getvalue()
    target = work_path(spark, "pkg", f"{_PKG}-{hashlib.sha1(data).hexdigest()[:12]}.zip")
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        out = fs.create(path, True)
        out.write(bytearray(data))
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
