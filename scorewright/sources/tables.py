"""Stand-in tables built from the driver's parquet tables.

The original data sets (Telco churn CSV, wholesale customers CSV, pet images) are not available
offline, so every job and query runs on tables Spark derives from ``customer``, ``orders``,
``lineitem``, ``part``, ``nation``, ``region`` and ``embeddings``.  Their work grows with those
tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.session import stage_key, work_path
from scorewright.sinks import fs
from scorewright.specs import CHURN, WHOLESALE_STANDIN_COLUMNS

# --- fixed values of the stand-ins -------------------------------------------------------
CHURN_CUTOFF = "2000-06-01"          # features from orders before it, label from orders on/after it
CUTOFF_MONTH_INDEX = 2000 * 12 + 6   # year*12 + month of the cutoff
BLANK_EVERY = 10                     # total_spent written as " " where c_custkey % 10 = 0
BAD_INT_EVERY = 97                   # tenure written as "x" where c_custkey % 97 = 0
# -----------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cutoff() -> Column:
    return F.lit(CHURN_CUTOFF).cast("timestamp_ntz")


def _cents(c: str) -> Column:
    """Money as exact integer cents, so sums and means do not depend on summation order."""
    return F.round(F.col(c) * F.lit(100.0)).cast("long")


def churn_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: four categoricals, five numerics, ``churn`` Yes/No.

    Plan: orders are aggregated first (map-side partial aggregation, then one shuffle on
    ``(o_custkey, o_orderpriority)`` and one on ``o_custkey`` over at most five rows per
    customer), then joined to ``customer``; ``nation`` and ``region`` (25 and 5 rows by the
    schema) are joined without a hint, each broadcast by its measured file size.
    """
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    before = F.col("o_orderdate") < _cutoff()
    per_priority = orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.count_if(before).alias("cnt"),
        F.sum(F.when(before, _cents("o_totalprice"))).alias("cents"),
        F.min(F.when(before, F.col("o_orderdate"))).alias("first_date"),
        F.max(F.when(before, F.lit(0)).otherwise(F.lit(1))).alias("after"),
    )
    per_customer = per_priority.groupBy("o_custkey").agg(
        F.sum("cnt").alias("n"),
        F.sum("cents").alias("cents"),
        F.min("first_date").alias("first_date"),
        F.max("after").alias("after"),
        # most frequent priority before the cutoff, lowest value on ties
        F.min(F.when(F.col("cnt") > 0, F.struct((-F.col("cnt")).alias("k"), F.col("o_orderpriority").alias("p"))))
        .alias("mode"),
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    joined = (
        cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
    )
    n = F.coalesce(F.col("n"), F.lit(0)).cast("int")
    cents = F.coalesce(F.col("cents"), F.lit(0))
    first = F.col("first_date")
    return joined.select(
        F.col("c_custkey").cast("string").alias("customerID"),
        F.col("c_custkey").alias("custkey"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
        F.col("mode.p").alias("top_priority"),
        n.alias("n_orders"),
        F.when(first.isNull(), F.lit(0))
        .otherwise(F.lit(CUTOFF_MONTH_INDEX) - (F.year(first) * 12 + F.month(first))).cast("int").alias("tenure"),
        F.when(n > 0, cents.cast("double") / (n.cast("double") * F.lit(100.0))).otherwise(F.lit(0.0)).alias("avg_order"),
        (cents.cast("double") / F.lit(100.0)).alias("total_spent"),
        F.col("c_acctbal").alias("acctbal"),
        F.when(F.coalesce(F.col("after"), F.lit(0)) == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("churn"),
    )


def churn_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The churn table as CSV text: every column a string, with planted dirt
    (``" "`` in ``total_spent``, ``"x"`` in ``tenure``)."""
    t = churn_table(spark, sf_dir)
    cols = []
    for c in t.columns:
        if c == "custkey":
            continue
        v = F.col(c).cast("string")
        if c == CHURN.blank_column:
            v = F.when(F.col("custkey") % BLANK_EVERY == 0, F.lit(" ")).otherwise(v)
        if c == "tenure":
            v = F.when(F.col("custkey") % BAD_INT_EVERY == 0, F.lit("x")).otherwise(v)
        cols.append(v.alias(c))
    return t.select(*cols)


def churn_csv_path(spark: SparkSession, sf_dir: str) -> str:
    """Write ``churn_text`` once per input folder as CSV under the shared work folder; return the path."""
    path = work_path(spark, "stage", f"churn_csv-{stage_key(spark, sf_dir)}")
    return fs.stage_once(spark, path, lambda tmp: (
        churn_text(spark, sf_dir).write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(tmp)))


# --- fixed values of the malformed lines: custkey % MALFORMED_EVERY ------------------------------
MALFORMED_EVERY = 40
TOO_FEW, TOO_MANY, OPEN_QUOTE = 3, 17, 29      # last field missing, a field "extra" more, last field after an open quote
# -------------------------------------------------------------------------------------------------


def churn_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The churn CSV's lines with planted malformed ones (``line``); built as text, without a header."""
    cols = [c for c in churn_text(spark, sf_dir).columns]
    cells = [F.coalesce(F.col(c), F.lit("")) for c in cols]
    kind = F.col("customerID").cast("long") % MALFORMED_EVERY
    line = (F.when(kind == TOO_FEW, F.concat_ws(",", *cells[:-1])).when(kind == TOO_MANY, F.concat_ws(",", *cells, F.lit("extra")))
            .when(kind == OPEN_QUOTE, F.concat_ws(",", *cells[:-1], F.concat(F.lit('"'), cells[-1]))).otherwise(F.concat_ws(",", *cells)))
    return churn_text(spark, sf_dir).select(line.alias("line"))


def malformed_csv_path(spark: SparkSession, sf_dir: str) -> str:
    """``churn_lines`` written once per input folder as CSV files, each with a header line, under the shared work folder."""
    header = ",".join(churn_text(spark, sf_dir).columns)

    def with_header(batches):
        import pyarrow as pa

        first = True
        for b in batches:
            lines = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([header, *lines] if first else lines, pa.string())], names=["line"])
            first = False

    path = work_path(spark, "stage", f"malformed_csv-{stage_key(spark, sf_dir)}")
    return fs.stage_once(spark, path, lambda tmp: churn_lines(spark, sf_dir).mapInArrow(with_header, "line string").write.text(tmp))


def wholesale_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend per customer on six part types (the wholesale stand-in): ``custkey`` + six doubles.

    lineitem -> orders on the order key and lineitem -> part on the part key are large-large
    joins left to the planner (sort-merge, or broadcast when a side measures small).  The six
    types are a fixed list, so the "pivot" is six conditional sums in one aggregation: one
    shuffle on ``custkey`` after map-side partial sums, no extra pass to discover pivot values.
    Spend is summed in integer cents.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pt = table(spark, sf_dir, "part").select(
        "p_partkey", F.lower(F.element_at(F.split(F.col("p_type"), " "), 1)).alias("ptype"))
    joined = (li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(pt, F.col("l_partkey") == F.col("p_partkey")))
    cents = _cents("l_extendedprice")
    return joined.groupBy(F.col("o_custkey").alias("custkey")).agg(*[
        (F.coalesce(F.sum(F.when(F.col("ptype") == F.lit(c), cents)), F.lit(0)).cast("double") / F.lit(100.0)).alias(c)
        for c in WHOLESALE_STANDIN_COLUMNS])


def wholesale_path(spark: SparkSession, sf_dir: str) -> str:
    """``wholesale_table`` written once per input folder as parquet (the wholesale CSV's role):
    the three-way join and pivot run once, and the multi-pass clustering steps (scaler fit,
    k-means iterations, silhouette statistics) read the small per-customer table."""
    path = work_path(spark, "stage", f"wholesale-{stage_key(spark, sf_dir)}")
    return fs.stage_once(spark, path, lambda tmp: wholesale_table(spark, sf_dir).write.parquet(tmp))


def embeddings_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id``, ``embedding array<float>``, ``label int`` and a class name ``class_<label>``."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "embedding", "label",
                    F.concat(F.lit("class_"), F.col("label").cast("string")).alias("class_name"))


# ---------------------------------------------------------------- image stand-ins
# --- fixed values of the image stand-ins ---------------------------------------------------
PET_CLASSES = ("cat", "dog")         # folder of an image: cat when label < 5, else dog
CORRUPT_EVERY = 50                   # vec_id % 50 == 7 -> bytes that are not an image
CORRUPT_AT = 7
ARCHIVE_SIZE = 100                   # members per archive: vec_id // 100
COMMA_EVERY = 13                     # vec_id % 13 == 0 -> member name with a comma
UPPER_EVERY = 4                      # vec_id % 4 == 1 -> upper-case extension
PICTURES_PER_TASK = 5000             # picture files that one task writes on average, at most
# -------------------------------------------------------------------------------------------


def pet_class(label_col: str = "label") -> Column:
    return F.when(F.col(label_col) < 5, F.lit(PET_CLASSES[0])).otherwise(F.lit(PET_CLASSES[1]))


def _pixels(vec, label: int):
    """8x8 RGB picture of a 64-d embedding: red/green from the values, blue from the class."""
    import numpy as np

    v = np.clip(np.round(128 + 400 * np.asarray(vec, dtype=np.float64)), 0, 255).astype(np.uint8)
    side = int(np.ceil(np.sqrt(len(v))))
    v = np.pad(v, (0, side * side - len(v))).reshape(side, side)
    blue = np.full_like(v, 64 if label < 5 else 192)
    return np.stack([v, 255 - v, blue], axis=2)


def png_bytes(rgb) -> bytes:
    """Minimal PNG (8-bit RGB, no interlace) from an ``(h, w, 3)`` uint8 array."""
    import struct
    import zlib

    import numpy as np

    a = np.ascontiguousarray(rgb, dtype=np.uint8)
    h, w, _ = a.shape
    raw = b"".join(b"\x00" + a[y].tobytes() for y in range(h))

    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b""))


def _image_body(vec_id: int, vec, label: int) -> bytes:
    if vec_id % CORRUPT_EVERY == CORRUPT_AT:
        return b"not an image " + str(vec_id).encode()
    return png_bytes(_pixels(vec, label))


def pet_image_dir(spark: SparkSession, sf_dir: str) -> str:
    """``<dir>/PetImages/<cat|dog>/img_<vec_id>.png``, one file per embedding row (some corrupt),
    written by tasks on every core (the table may come in one row group); returns ``<dir>/PetImages``."""
    import pandas as pd

    from scorewright.operators.split import spread
    from scorewright.session import ship_package
    from scorewright.sources.filesystems import resolve
    from scorewright.sources.images import write_bytes
    ship_package(spark)
    root = work_path(spark, "stage", f"pets-{stage_key(spark, sf_dir)}")
    store = resolve(spark, root)
    images = f"{root}/PetImages"
    manifest = f"{root}-manifest"
    if not fs.is_complete(spark, manifest):
        def write(batches):
            for b in batches:
                paths = []
                for vid, vec, lab in zip(b["vec_id"], b["embedding"], b["label"]):
                    cls = PET_CLASSES[0] if lab < 5 else PET_CLASSES[1]
                    p = f"{images}/{cls}/img_{vid}.png"
                    write_bytes(p, _image_body(int(vid), vec, int(lab)), store)
                    paths.append(p)
                yield pd.DataFrame({"vec_id": b["vec_id"], "path": paths})
        fs.stage_once(spark, manifest, lambda tmp: (
            spread(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), "vec_id", per_task=PICTURES_PER_TASK)
            .mapInPandas(write, "vec_id long, path string").write.parquet(tmp)))
    return images


def image_zip_dir(spark: SparkSession, sf_dir: str) -> str:
    """ZIP archives of the embedding pictures, ``ARCHIVE_SIZE`` members each, plus a directory
    entry and a text file per archive; some names carry a comma or an upper-case extension."""
    import io
    import zipfile

    import pandas as pd

    from scorewright.session import ship_package
    from scorewright.sources.filesystems import resolve
    from scorewright.sources.images import write_bytes
    ship_package(spark)
    root = work_path(spark, "stage", f"zips-{stage_key(spark, sf_dir)}")
    store = resolve(spark, root)
    manifest = f"{root}-manifest"
    if not fs.is_complete(spark, manifest):
        def write(pdf: pd.DataFrame) -> pd.DataFrame:
            aid = int(pdf["archive_id"].iloc[0])
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(f"batch_{aid}/", b"")
                z.writestr(f"batch_{aid}/readme.txt", b"not an image")
                for vid, vec, lab in zip(pdf["vec_id"], pdf["embedding"], pdf["label"]):
                    z.writestr(member_name(int(vid)), _image_body(int(vid), vec, int(lab)))
            path = f"{root}/archive_{aid}.zip"
            write_bytes(path, buf.getvalue(), store)
            return pd.DataFrame({"archive_id": [aid], "path": [path], "members": [len(pdf)]})
        e = table(spark, sf_dir, "embeddings").withColumn("archive_id", (F.col("vec_id") / ARCHIVE_SIZE).cast("long"))
        fs.stage_once(spark, manifest, lambda tmp: (
            e.groupBy("archive_id").applyInPandas(write, "archive_id long, path string, members long")
            .write.parquet(tmp)))
    return root


def member_name(vec_id: int) -> str:
    """Member path of an embedding picture inside its archive (same rule as the oracle SQL)."""
    aid = vec_id // ARCHIVE_SIZE
    stem = f"img,{vec_id}" if vec_id % COMMA_EVERY == 0 else f"img_{vec_id}"
    ext = ".PNG" if vec_id % UPPER_EVERY == 1 else ".png"
    return f"batch_{aid}/{stem}{ext}"
