"""Bronze landing with checksum idempotency, file manifest, run manifests.

S10 checksum skip (J3), S13 bronze read, S15 existence / metadata lookup, S16 / S17 manifest
write / read, W6 file-manifest rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.schemas import FILE_MANIFEST, MANIFEST
from fileflow.session import path_exists

MAX_BROADCAST_FILES = 500_000


def split_by_checksum(incoming: DataFrame, known: DataFrame,
                      key: str = "storage_path", checksum: str = "checksum_md5"
                      ) -> tuple[DataFrame, DataFrame]:
    """(new or changed, unchanged) incoming files against the known manifest.

    Equal key and equal md5 = already landed: skipped (left-semi); everything else lands
    (left-anti). Only the two key columns of the manifest are read; AQE picks broadcast or
    sort-merge by the manifest's real size.
    """
    k = known.select(F.col(key).alias("_k"), F.col(checksum).alias("_c")).distinct()
    cond = (F.col(key) == F.col("_k")) & (F.col(checksum) == F.col("_c"))
    return incoming.join(k, cond, "left_anti"), incoming.join(k, cond, "left_semi")


def bronze_files(bronze: DataFrame, wanted: DataFrame) -> DataFrame:
    """The landed bytes of the wanted (storage_path, checksum_md5): one row per key, the latest
    upload (S13). Bytes are joined to the small key table, never grouped."""
    keys = wanted.select("storage_path", "checksum_md5").distinct()
    latest = bronze.join(keys, ["storage_path", "checksum_md5"], "left_semi") \
        .groupBy("storage_path", "checksum_md5") \
        .agg(F.max("upload_timestamp").alias("upload_timestamp"))
    return bronze.join(F.broadcast(latest) if latest.count() <= MAX_BROADCAST_FILES else latest,
                       ["storage_path", "checksum_md5", "upload_timestamp"], "left_semi")


def landed_chunks(chunks: DataFrame, wanted: DataFrame) -> DataFrame:
    """Chunk rows of the wanted files (``storage_path``), each file's latest upload only. The
    manifest holds one row per path, for the bytes that landed last, so no checksum is compared."""
    mine = chunks.join(wanted.select("storage_path").distinct(), "storage_path", "left_semi")
    latest = mine.filter("offset = 0").groupBy("storage_path").agg(
        F.max("upload_timestamp").alias("upload_timestamp"))
    return mine.join(F.broadcast(latest) if latest.count() <= MAX_BROADCAST_FILES else latest,
                     ["storage_path", "upload_timestamp"], "left_semi")


def bronze_object(bronze: DataFrame, storage_path: str) -> DataFrame:
    """The latest landed bytes under one key (S13 ``download_raw``): a point filter plus a
    bounded top-1 on upload time."""
    return bronze.filter(F.col("storage_path") == storage_path) \
        .orderBy(F.col("upload_timestamp").desc()).limit(1) \
        .select("storage_path", "content", "checksum_md5")


def manifest_rows(landed: DataFrame, run_id: str | Column, status: str = "PENDING",
                  processed_at: Column | None = None) -> DataFrame:
    """FILE_MANIFEST rows for landed files."""
    rid = run_id if isinstance(run_id, Column) else F.lit(run_id)
    at = processed_at if processed_at is not None else F.current_timestamp()
    cols = {
        "manifest_id": F.lit(None).cast("long"),
        "run_id": rid,
        "file_name": F.col("file_name"),
        "file_id": F.col("file_id") if "file_id" in landed.columns else F.col("storage_path"),
        "checksum_md5": F.col("checksum_md5"),
        "storage_path": F.col("storage_path"),
        "processed_at": at.cast("timestamp"),
        "row_count": F.col("row_count") if "row_count" in landed.columns
        else F.lit(None).cast("long"),
        "status": F.lit(status),
    }
    return landed.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in FILE_MANIFEST])


def exists(manifest: DataFrame, keys: DataFrame, key: str = "storage_path") -> DataFrame:
    """Requested keys that exist in the manifest (S15 ``object_exists``): a semi join."""
    return keys.join(manifest.select(F.col(key).alias(key)).distinct(), key, "left_semi")


def metadata(manifest: DataFrame, keys: DataFrame, key: str = "storage_path") -> DataFrame:
    """Manifest rows of the requested keys (S15 ``get_object_metadata``)."""
    return manifest.join(keys.select(key).distinct(), key, "left_semi")


# --- run manifests (S16 / S17) ---------------------------------------------------------------
# Stored as JSON lines, one line per file, partitioned by run_date, so a run with millions of
# files never becomes one array in one task. The file count is an aggregate at read time.

def write_manifest(files: DataFrame, path: str, run_date: Column | str,
                   created_at: Column | None = None) -> None:
    """``files`` has file_name, minio_key, size_bytes.

    A run without files still gets a manifest when ``run_date`` is a value: one line that names
    no file."""
    ca = created_at if created_at is not None else F.date_format(F.current_timestamp(),
                                                                 "yyyy-MM-dd'T'HH:mm:ss")
    named = isinstance(run_date, str) and run_date in files.columns
    rd = F.col(run_date) if named else (run_date if isinstance(run_date, Column)
                                        else F.lit(run_date))
    lines = files.select(rd.cast("string").alias("run_date"),
                         F.col("file_name").cast("string"), F.col("minio_key").cast("string"),
                         F.col("size_bytes").cast("long"))
    if isinstance(run_date, str) and not named:
        lines = lines.union(files.sparkSession.range(1).select(
            rd.alias("run_date"), F.lit(None).cast("string").alias("file_name"),
            F.lit(None).cast("string").alias("minio_key"),
            F.lit(None).cast("long").alias("size_bytes")))
    lines.select("run_date", ca.cast("string").alias("created_at"), "file_name", "minio_key",
                 "size_bytes").write.mode("overwrite").partitionBy("run_date").json(path)


def _manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    schema = ("created_at string, file_name string, minio_key string, size_bytes long, "
              "run_date string")
    if not path_exists(spark, path):        # no manifest written yet; other faults are raised
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def read_manifest(spark: SparkSession, path: str, run_date: str | None = None) -> DataFrame:
    """Files of a run (or all runs) with the run's file count (S17). A missing run -> empty."""
    df = _manifest_lines(spark, path).filter(F.col("minio_key").isNotNull()
                                             | F.col("file_name").isNotNull())
    if run_date is not None:
        df = df.filter(F.col("run_date") == run_date)
    counts = df.groupBy("run_date").agg(F.count(F.lit(1)).alias("file_count"))
    return df.join(F.broadcast(counts), "run_date")          # one row per day


def manifest_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run_date, created_at, file_count) of every run with a manifest, empty ones too."""
    return _manifest_lines(spark, path).groupBy("run_date").agg(
        F.max("created_at").alias("created_at"),
        F.count(F.coalesce("minio_key", "file_name")).alias("file_count"))


def read_manifest_document(spark: SparkSession, path: str) -> DataFrame:
    """A single nested manifest document ``{run_date, created_at, file_count, files:[...]}``
    exploded to one row per file; a missing ``files`` list gives no rows (S17).

    ``path`` is the document, or a run folder holding ``manifest.json``. Spark hides every
    file whose name starts with '_' or '.', even when named explicitly, so a document called
    ``_manifest.json`` must be renamed before Spark can read it."""
    if not path.endswith(".json"):
        path = path.rstrip("/") + "/manifest.json"
    doc = spark.read.schema(MANIFEST).option("multiLine", "true").json(path)
    return doc.select("run_date", "created_at", F.explode_outer(
        F.coalesce(F.col("files"), F.array().cast(MANIFEST["files"].dataType))).alias("f")) \
        .filter(F.col("f").isNotNull()).select("run_date", "created_at", "f.*")
