"""Run records in the PIPELINE_RUN table (W3 through the snapshot table)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from fileflow.operators.upsert import merge_runs
from fileflow.plans.lake import Lake

_UPD = ("run_id string, dag_id string, status string, files_processed long, "
        "rows_inserted long, rows_updated long, error_message string")


def record_run(lake: Lake, run_id: str, dag_id: str, status: str, files_processed: int = 0,
               rows_inserted: int = 0, rows_updated: int = 0, error_message: str = "",
               now: _dt.datetime | None = None) -> None:
    spark = lake.spark
    lake.bootstrap()
    when = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    upd = spark.createDataFrame([(run_id, dag_id, status, int(files_processed),
                                  int(rows_inserted), int(rows_updated), error_message)], _UPD)
    merged = merge_runs(lake.pipeline_run.read(), upd, F.lit(when))
    lake.pipeline_run.overwrite(merged, operation=f"run:{status}")
