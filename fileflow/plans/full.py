"""E3 full run: extract, transform + load, then the post-load quality gate."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.operators import quality, runs
from fileflow.plans.extract import ExtractResult, extract
from fileflow.plans.lake import Lake
from fileflow.plans.transform import LoadResult, pending_files, transform_load


@dataclass
class FullRunResult:
    extract: ExtractResult
    load: LoadResult | None
    checks: DataFrame


def quality_gate(lake: Lake, target: str, keys: list[str], as_of, dag_id: str) -> DataFrame:
    """Checks after a load: rows loaded since day start, no all-NULL column, no duplicate
    natural key, the dag's latest run today succeeded."""
    if not lake.table(target or "records").exists():
        return lake.spark.createDataFrame(
            [("table_exists", False, 0, target or "records")],
            "check string, ok boolean, observed long, detail string")
    t = lake.table(target or "records").read()
    last = runs.last_run_of_day(lake.pipeline_run.read(), dag_id, as_of)
    last_ok = last.agg(F.max(F.col("status") == "SUCCESS").alias("ok"),
                       F.count(F.lit(1)).alias("observed")).select(
        F.lit("latest_run_succeeded").alias("check"), F.coalesce("ok", F.lit(False)).alias("ok"),
        F.col("observed").cast("long").alias("observed"), F.lit(dag_id).alias("detail"))
    data_cols = [c for c in t.columns if c not in ("source_file", "row_id", "loaded_at")]
    return quality.suite(quality.loaded_and_filled(t, as_of, data_cols),
                         quality.no_duplicates(t, keys), last_ok)


def full_run(spark: SparkSession, lake: Lake, source_root: str, run_date: str, run_id: str, *,
             target: str | None = None, natural_keys: list[str] | None = None,
             date_columns=(), specs=None, strict: bool = False,
             as_of: str | _dt.date | None = None, dag_id: str = "full_pipeline",
             **landing) -> FullRunResult:
    """``landing``: options of ``extract``, such as ``row_bytes``."""
    ex = extract(spark, lake, source_root, run_date, run_id, **landing)
    load = None
    # driven by the manifest, not by what this run landed: a failed load is tried again
    if not pending_files(lake, run_date).isEmpty():
        load = transform_load(spark, lake, run_date, run_id, target=target,
                              natural_keys=natural_keys, date_columns=date_columns, specs=specs,
                              dag_id=dag_id)
    day = as_of or _dt.datetime.now(_dt.timezone.utc).date()
    keys = natural_keys or ["source_file", "row_id"]
    checks = quality_gate(lake, target, keys, day, dag_id)
    if strict:
        quality.enforce(checks)
    return FullRunResult(ex, load, checks)
