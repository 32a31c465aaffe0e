"""File-scan helpers shared by readers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fileflow.functions.paths import metadata_path
from fileflow.operators.clean import BLOCK_COL, FILE_COL


def with_file_info(df: DataFrame) -> DataFrame:
    """Add the source file path and input-split start of each row (from ``_metadata``)."""
    return df.select("*", metadata_path().alias(FILE_COL),
                     F.col("_metadata.file_block_start").alias(BLOCK_COL))
