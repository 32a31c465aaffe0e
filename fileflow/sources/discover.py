"""File discovery (S1), size guard (S2), prefix listing (S14), file-name parts.

Discovery lists files with Spark's ``binaryFile`` source and selects only path, length and
modification time: ``content`` is pruned, so no file bytes are read. The listing itself is
distributed by Spark (parallel partition discovery) for large trees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.functions.paths import extension, file_name, parent_path, relative_path
from fileflow.schemas import FILES
from fileflow.session import path_exists

# Extensions the scanner accepts (compared lower-cased).
SUPPORTED_EXTENSIONS = [".xlsx", ".xls", ".csv", ".xlsm", ".xlsb"]
EXCEL_EXTENSIONS = [".xlsx", ".xls", ".xlsm", ".xlsb"]
#: No limit unless a caller sets one: CSV is read split-wise, and no file is left out silently.
MAX_FILE_SIZE_MB: float | None = None

# MIME types reported per extension.
MIME_TYPES = {
    ".csv": "text/csv",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".xlsm": "application/vnd.ms-excel.sheet.macroEnabled.12",
    ".xls": "application/vnd.ms-excel",
    ".xlsb": "application/vnd.ms-excel.sheet.binary.macroEnabled.12",
}


def scan(spark: SparkSession, root: str, extensions: list[str] | None = None,
         prefix: str | None = None) -> DataFrame:
    """Every supported file under ``root`` (recursive), with the ``files`` schema.

    An empty or missing folder gives an empty DataFrame. Extension matching is
    case-insensitive (``pathGlobFilter`` would not be).
    """
    exts = [e.lower() for e in (extensions or SUPPORTED_EXTENSIONS)]
    if not path_exists(spark, root):        # any other fault is the caller's
        return spark.createDataFrame([], FILES)
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    listed = raw.select("path", "length", "modificationTime")
    mime = F.create_map(*[x for k, v in MIME_TYPES.items() for x in (F.lit(k), F.lit(v))])
    out = listed.select(
        F.col("path"),
        relative_path("path", root).alias("file_id"),
        file_name("path").alias("name"),
        extension("path").alias("ext"),
        parent_path("path").alias("parent_path"),
        F.coalesce(F.col("length"), F.lit(0)).cast("long").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
        F.element_at(mime, extension("path")).alias("mime_type"),
    ).filter(F.col("ext").isin(exts))
    if prefix:
        out = out.filter(F.startswith("file_id", F.lit(prefix.lstrip("/"))))
    return out


def _limit(max_mb: float | None, max_bytes: int | None) -> int | None:
    if max_bytes is not None:
        return int(max_bytes)
    return None if max_mb is None else int(max_mb * 1024 * 1024)


def size_ok(max_mb: float | None = MAX_FILE_SIZE_MB, max_bytes: int | None = None):
    """The S2 predicate: no limit, size unknown, or within the limit."""
    limit = _limit(max_mb, max_bytes)
    if limit is None:
        return F.lit(True)
    return F.col("size_bytes").isNull() | (F.col("size_bytes") <= F.lit(limit))


def size_guard(files: DataFrame, max_mb: float | None = MAX_FILE_SIZE_MB,
               max_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected-with-reason) by size (S2). Use ``strict`` to raise instead."""
    ok = size_ok(max_mb, max_bytes)
    rej = files.filter(~ok).withColumn(
        "reason", F.concat(F.lit("file larger than "), F.lit(str(_limit(max_mb, max_bytes))),
                           F.lit(" bytes")))
    return files.filter(ok), rej


def strict(rejected: DataFrame) -> None:
    """Raise when any file was rejected (the reference's ``ValueError`` behaviour)."""
    r = rejected.select("path", "reason").limit(1).collect()
    if r:
        raise ValueError(f"{r[0].path}: {r[0].reason}")
