"""E1 extract: discover -> size guard -> checksum skip -> land in bronze -> manifests.

Bronze is an append-only Parquet table of raw bytes (path, relative path, md5, size, run
date, run id, upload time) partitioned by run_date — Spark has no raw-object writer, and a
table keeps every version of a changed file. Checksums are computed without carrying bytes
through a join; only new and changed files are read again to be landed. The file manifest
(FILE_MANIFEST) is upserted on ``storage_path`` and drives the load: a file stays PENDING until a
load has taken it. The run manifest lists every accepted file of the run, unchanged ones too,
and exists for a run without files as well. Files over a size limit go to the rejects table.

A CSV over ``row_bytes`` lands as chunk rows in a table of its own (``bronze_chunks``), so that no
row and no task holds a whole one; its md5 is that of the chunks as they landed. A workbook over
``row_bytes`` is rejected: it can only be opened whole.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.functions.paths import bronze_key, extension, file_name, relative_path
from fileflow.operators import contracts
from fileflow.operators.identity import assign_identity
from fileflow.plans.lake import Lake
from fileflow.session import materialize, path_exists
from fileflow.sources import discover
from fileflow.sources.chunks import CHUNK_BYTES, md5s, read_chunks
from fileflow.sources.landing import manifest_rows, split_by_checksum, write_manifest
from fileflow.sources.profile import with_profile


@dataclass
class ExtractResult:
    discovered: int
    rejected: int
    landed: int
    skipped: int


#: So many new files are read by their paths; more by one scan of the folder and a semi join.
PATHS = 10_000
#: A larger file lands as chunk rows.
ROW_BYTES = 1 << 30


def extract(spark: SparkSession, lake: Lake, source_root: str, run_date: str, run_id: str,
            max_mb: float | None = discover.MAX_FILE_SIZE_MB, strict: bool = False,
            now: _dt.datetime | None = None, row_bytes: int = ROW_BYTES,
            chunk_bytes: int = CHUNK_BYTES) -> ExtractResult:
    lake.bootstrap()
    when = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    files, rejected = discover.size_guard(discover.scan(spark, source_root), max_mb)
    if strict:
        discover.strict(rejected)
    n_rejected = 0
    large = files.filter(F.col("size_bytes") > row_bytes)
    has_large = not large.isEmpty()
    if has_large:
        books = large.filter(F.col("ext").isin(discover.EXCEL_EXTENSIONS))
        rejected = rejected.unionByName(books.withColumn("reason", F.lit(
            f"workbook larger than {row_bytes} bytes")))
    if max_mb is not None or has_large:
        n_rejected = lake.rejects.append(rejected.select(
            F.lit(run_id).alias("run_id"), F.lit(run_date).alias("run_date"),
            F.col("file_id").alias("source_file"), F.lit(None).cast("string").alias("line"),
            "reason"))
    raw = _contents(spark, source_root)
    key = bronze_key(F.lit(run_date), relative_path("path", source_root))
    if raw is None:
        sums = spark.createDataFrame([], "path string, file_name string, size_bytes long, "
                                         "storage_path string, checksum_md5 string")
    else:
        # one row per file: the bytes are read for their md5 and not carried on. The size
        # filter is on the file length, so larger files are not opened.
        sums = (raw.filter(extension("path").isin(discover.SUPPORTED_EXTENSIONS))
                .filter(discover.size_ok(max_mb)).filter(F.col("size_bytes") <= row_bytes)
                .select("path", file_name("path").alias("file_name"), "size_bytes",
                        key.alias("storage_path"), F.md5("content").alias("checksum_md5")))
    if has_large:
        texts = read_chunks(spark, source_root, chunk_bytes, row_bytes) \
            .filter(extension("path") == ".csv").filter(discover.size_ok(max_mb))
        sums = sums.unionByName(md5s(texts).join(large, "path").select(
            "path", F.col("name").alias("file_name"), "size_bytes", key.alias("storage_path"),
            "checksum_md5"))
    sums = materialize(sums, "landing-sums")
    # survey S10: the key is run_date/relative path; the same bytes under the same key are
    # skipped (a re-run of a day lands nothing twice), anything else lands
    new = materialize(split_by_checksum(sums, lake.file_manifest.read())[0], "landing-new")
    n_all, n_new = sums.count(), new.count()
    landed = []
    here = (F.col("run_date") == run_date) & (F.col("dag_run_id") == run_id) \
        & (F.col("upload_timestamp") == F.lit(when))
    whole = new.filter(F.col("size_bytes") <= row_bytes)
    n_whole = whole.count() if has_large else n_new
    if n_whole < n_new:
        rows = texts.join(new.select("path"), "path", "left_semi").select(
            "path", "size_bytes", "offset", "content", key.alias("storage_path"),
            F.lit(source_root).alias("source_root"), F.lit(run_date).alias("run_date"),
            F.lit(run_id).alias("dag_run_id"), F.lit(when).alias("upload_timestamp"))
        lake.bronze_chunks.append(rows, partition_by=["run_date"])
        rows = lake.bronze_chunks.read().filter(here)
        landed.append(md5s(rows).join(new.drop("checksum_md5"), "path").select(
            "storage_path", "file_name", "checksum_md5", "size_bytes",
            relative_path("path", source_root).alias("rel_path")))
    if n_whole:
        if n_whole <= PATHS:
            fresh = _contents(spark, [r.path for r in whole.select("path").collect()])
        else:
            fresh = raw.join(whole.select("path"), "path", "left_semi")
        # md5 and CSV profile belong to the very bytes that land, whatever happens to the file
        fresh = with_profile(fresh.select("path", "content")).select(
            "*", relative_path("path", source_root).alias("rel_path"),
            file_name("path").alias("file_name"), F.md5("content").alias("checksum_md5"),
            key.alias("storage_path"), F.lit(source_root).alias("source_root"),
            F.lit(run_date).alias("run_date"), F.lit(run_id).alias("dag_run_id"),
            F.lit(when).alias("upload_timestamp"))
        lake.bronze.append(fresh, partition_by=["run_date"])
        landed.append(lake.bronze.read().filter(here).select(
            "storage_path", "file_name", "checksum_md5", "size_bytes", "rel_path"))
    if landed:
        landed = reduce(DataFrame.unionByName, landed)
        rows = manifest_rows(landed.withColumn("file_id", F.col("rel_path")), run_id, "PENDING",
                             F.lit(when))
        rows = assign_identity(lake.file_manifest.read(), rows.drop("manifest_id"),
                               "manifest_id", order_by=["storage_path"])
        rows = materialize(rows, "manifest-rows")
        contracts.enforce(rows, not_null=["manifest_id", "run_id", "storage_path"],
                          unique=["storage_path"])
        lake.file_manifest.upsert(rows.select(*lake.file_manifest.read().columns),
                                  ["storage_path"], keep_target=("manifest_id",))
    write_manifest(sums.select("file_name", F.col("storage_path").alias("minio_key"),
                               "size_bytes"),
                   lake.manifests, run_date, F.lit(when.strftime("%Y-%m-%dT%H:%M:%S")))
    return ExtractResult(n_all + n_rejected, n_rejected, n_new, n_all - n_new)


def _contents(spark: SparkSession, where: str | list[str]):
    """path, size_bytes and content of the files, or None where there is no folder."""
    if isinstance(where, str) and not path_exists(spark, where):
        return None
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(where)
    return raw.select("path", F.col("length").alias("size_bytes"), "content")
