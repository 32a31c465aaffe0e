"""Declared schemas (survey §1.3) and the column-rule type."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql.types import (ArrayType, BooleanType, LongType, MapType, DoubleType,
                               StringType, StructField, StructType, TimestampType)

FILES = StructType([
    StructField("path", StringType(), False),
    StructField("file_id", StringType(), True),
    StructField("name", StringType(), True),
    StructField("ext", StringType(), True),
    StructField("parent_path", StringType(), True),
    StructField("size_bytes", LongType(), True),
    StructField("modified_at", TimestampType(), True),
    StructField("mime_type", StringType(), True),
])

FILE_MANIFEST = StructType([
    StructField("manifest_id", LongType(), True),
    StructField("run_id", StringType(), True),
    StructField("file_name", StringType(), True),
    StructField("file_id", StringType(), True),
    StructField("checksum_md5", StringType(), True),
    StructField("storage_path", StringType(), True),
    StructField("processed_at", TimestampType(), True),
    StructField("row_count", LongType(), True),
    StructField("status", StringType(), True),
])

PIPELINE_RUN = StructType([
    StructField("run_id", StringType(), False),
    StructField("dag_id", StringType(), True),
    StructField("start_time", TimestampType(), True),
    StructField("end_time", TimestampType(), True),
    StructField("status", StringType(), True),
    StructField("files_processed", LongType(), True),
    StructField("rows_inserted", LongType(), True),
    StructField("rows_updated", LongType(), True),
    StructField("error_message", StringType(), True),
])

ELT_DATA = StructType([
    StructField("data_id", LongType(), True),
    StructField("source_file", StringType(), False),
    StructField("row_id", LongType(), False),
    StructField("loaded_at", TimestampType(), True),
    StructField("data_json", StringType(), True),
])

VIOLATION = StructType([
    StructField("column", StringType(), False),
    StructField("rule", StringType(), False),
    StructField("n_bad", LongType(), True),
    StructField("samples", ArrayType(StringType()), True),
    StructField("message", StringType(), True),
])

MANIFEST_FILE = StructType([
    StructField("file_name", StringType(), True),
    StructField("minio_key", StringType(), True),
    StructField("size_bytes", LongType(), True),
])

MANIFEST = StructType([
    StructField("run_date", StringType(), True),
    StructField("created_at", StringType(), True),
    StructField("file_count", LongType(), True),
    StructField("files", ArrayType(MANIFEST_FILE), True),
])

CHECK = StructType([
    StructField("check", StringType(), False),
    StructField("ok", BooleanType(), False),
    StructField("observed", LongType(), True),
    StructField("detail", StringType(), True),
])

@dataclass
class ColumnSpec:
    """A column rule: name, expected type family, nullability, max length, allowed values."""

    name: str
    dtype: str = "object"          # "int64", "float64", "object", "datetime64[ns]", ...
    nullable: bool = True
    max_length: int | None = None
    allowed_values: list[Any] = field(default_factory=list)
