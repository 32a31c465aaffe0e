"""Silver Parquet (S11 write, S12 read).

Written under ``root/run_date=<d>/`` with dynamic partition overwrite, so a re-run replaces
only its own day. Rows are clustered by (source_file, row_id) inside each task before the
write (a local sort, no shuffle): Parquet row-group statistics on ``source_file`` then let a
single-file read skip most row groups, without one directory per file (which would explode
the file count at scale). The row count comes from an ``Observation`` on the same write.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_silver(df: DataFrame, root: str, run_date: str | None = None,
                 by_file: bool = False) -> int:
    """``run_date=None`` keeps the frame's own ``run_date`` column (several days at once)."""
    obs = Observation(f"silver_{uuid.uuid4().hex[:8]}")
    out = df if run_date is None else df.withColumn("run_date", F.lit(run_date))
    order = [c for c in ("source_file", "row_id") if c in out.columns]
    if order:
        out = out.sortWithinPartitions(*order)
    parts = ["run_date"] + (["source_file"] if by_file and "source_file" in out.columns else [])
    out.observe(obs, F.count(F.lit(1)).alias("rows")).write \
        .option("partitionOverwriteMode", "dynamic").mode("overwrite") \
        .partitionBy(*parts).parquet(root)
    return int(obs.get.get("rows", 0))


def read_silver(spark: SparkSession, root: str, run_date: str | None = None,
                source_file: str | None = None) -> DataFrame:
    """One day (partition pruning) and optionally one file (pushed filter)."""
    # a day is written in one piece, so its files share one schema; days may differ
    path = root if run_date is None else f"{root}/run_date={run_date}"
    df = spark.read.option("basePath", root).option("mergeSchema", str(run_date is None).lower()) \
        .parquet(path).withColumn("run_date", F.col("run_date").cast("string"))
    if source_file is not None:
        df = df.filter(F.col("source_file") == source_file)
    return df
