"""E2 transform + load: landed files not loaded yet -> read / clean -> validate -> silver ->
upsert into the target table -> file manifest update -> run record.

The file manifest says what to load: every file of the day whose status is not LOADED, from
whatever run it landed in, so a failed load is taken up by the next run. The bytes are those
in bronze. Silver holds one copy per day and file. Lines that were left out are stored in the
rejects table, and the target's keys are checked before it is published.

The run record is written RUNNING at the start and SUCCESS / FAILED at the end (survey Q15),
so run analytics (durations, status counts) are meaningful. The upsert reads the silver rows
just written, so the cleaning plan runs once and no job reads and overwrites one path.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.operators import contracts
from fileflow.operators.clean import pack_json
from fileflow.operators.identity import assign_identity
from fileflow.operators.table import align
from fileflow.plans.lake import Lake
from fileflow.plans.runlog import record_run
from fileflow.schemas import ColumnSpec
from fileflow.session import materialize, path_exists
from fileflow.sources.dispatch import read_files
from fileflow.sources.landing import bronze_files, landed_chunks
from fileflow.sources.profile import PROFILE_COLUMNS
from fileflow.sources.silver import read_silver, write_silver


#: Buckets of a new target table; a large one deserves more.
TARGET_BUCKETS = 16


@dataclass
class LoadResult:
    files_processed: int
    rows_inserted: int
    rows_updated: int
    silver_rows: int
    rejects: DataFrame


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def pending_files(lake: Lake, run_date: str) -> DataFrame:
    """Manifest rows of the day's files that no load has taken yet."""
    return lake.file_manifest.read().filter(
        F.startswith("storage_path", F.lit(f"{run_date}/"))
        & (F.coalesce("status", F.lit("")) != "LOADED"))


def check_keys(data: DataFrame, keys: list[str]) -> None:
    """Constraints of the target before it is published (W5): every key column is there."""
    missing = [k for k in keys if k not in data.columns]
    if missing:
        raise ValueError(f"no column {missing} for the natural key {keys}")


def transform_load(spark: SparkSession, lake: Lake, run_date: str, run_id: str, *,
                   target: str | None = None, natural_keys: list[str] | None = None,
                   mode: str = "wide", date_columns: list[str] | tuple[str, ...] = (),
                   specs: list[ColumnSpec] | None = None, dag_id: str = "transform_to_table",
                   sheet: int | str | None = 0, loaded_at=None,
                   buckets: int | None = TARGET_BUCKETS) -> LoadResult:
    """``mode='wide'``: the target takes the files' own columns (evolving by name);
    ``mode='packed'``: the target is ELT_DATA (source_file, row_id, loaded_at, data_json)
    with an identity ``data_id`` (survey Q2). A wide target that does not exist yet is made in
    ``buckets`` by its keys, so later loads rewrite only what they touch."""
    record_run(lake, run_id, dag_id, "RUNNING", now=_now())
    try:
        todo = materialize(pending_files(lake, run_date), "load-files")
        n_files = todo.count()
        day = F.col("run_date") == run_date
        bronze, files, chunks = lake.bronze, None, None
        roots = []
        if bronze.exists():
            files = bronze_files(bronze.read().filter(day), todo)
            roots.append(files.select("source_root"))
            files = files.select(*PROFILE_COLUMNS, "content")
        if lake.bronze_chunks.exists():
            chunks = materialize(landed_chunks(lake.bronze_chunks.read().filter(day), todo),
                                 "load-chunks")
            roots.append(chunks.select("source_root"))
        roots = [r[0] for r in reduce(DataFrame.union, roots).distinct().limit(2).collect()]
        root = roots[0] if len(roots) == 1 else None
        res = read_files(spark, files, chunks=chunks, root=root,
                         date_columns=date_columns, sheet=sheet,
                         loaded_at=loaded_at if loaded_at is not None
                         else F.lit(_now()).cast("timestamp"))
        data = materialize(res.data, "load-data")
        if specs:
            contracts.raise_on_error(data, specs)
        keys = natural_keys or ["source_file", "row_id"]
        check_keys(data, keys)
        rejects = res.rejects.select(
            F.lit(run_id).alias("run_id"), F.lit(run_date).alias("run_date"), "source_file",
            "line", "reason")
        lake.rejects.append(rejects)
        silver_n = _write_day(spark, lake, data.withColumn("run_id", F.lit(run_id)), run_date)
        silver = read_silver(spark, lake.silver_root, run_date) \
            .filter(F.col("run_id") == run_id).select(*data.columns)
        tbl = lake.table(target or ("elt_data" if mode == "packed" else "records"))
        if mode == "packed":
            packed = pack_json(silver, ["source_file", "row_id", "loaded_at"])
            if not tbl.exists():
                lake.bootstrap()
            packed = assign_identity(tbl.read(), packed, "data_id",
                                     order_by=["source_file", "row_id"])
            packed = materialize(packed, "load-packed")
            contracts.enforce(packed, not_null=["source_file", "row_id"],
                              unique=["source_file", "row_id"])
            ins, upd = tbl.upsert(packed.select("data_id", "source_file", "row_id", "loaded_at",
                                                "data_json"),
                                  ["source_file", "row_id"], keep_target=("data_id",))
        else:
            ins, upd = tbl.upsert(silver, keys, order_by=[c for c in ("source_file", "row_id")
                                                          if c in silver.columns],
                                  buckets=buckets)
        counts = silver.groupBy("source_file").agg(F.count(F.lit(1)).alias("_cnt"))
        rel = F.regexp_replace("storage_path", r"^[^/]*/", "")
        upd_rows = todo.withColumn("_rel", rel).join(
            counts.withColumnRenamed("source_file", "_rel"), "_rel", "left") \
            .select(*[F.coalesce("_cnt", F.lit(0)).cast("long").alias(c) if c == "row_count"
                      else (F.lit("LOADED").alias(c) if c == "status" else F.col(c))
                      for c in todo.columns])
        lake.file_manifest.upsert(upd_rows, ["storage_path"], keep_target=("manifest_id",))
        record_run(lake, run_id, dag_id, "SUCCESS", n_files, ins, upd, now=_now())
        return LoadResult(n_files, ins, upd, silver_n, rejects)
    except Exception as e:
        record_run(lake, run_id, dag_id, "FAILED", error_message=f"{type(e).__name__}: {e}",
                   now=_now())
        raise


def _write_day(spark: SparkSession, lake: Lake, data: DataFrame, run_date: str) -> int:
    """Silver of the day: the rows of these files replace earlier ones, other files stay."""
    day = None
    if path_exists(spark, f"{lake.silver_root}/run_date={run_date}"):
        day = read_silver(spark, lake.silver_root, run_date).drop("run_date")
    n = data.count()
    if day is not None:
        names = data.select("source_file").distinct()
        wide, fresh = align(day, data, fill=False)
        rest = (day if wide is None else wide).join(names, "source_file", "left_anti")
        # the day's folder is both read and replaced: the kept rows are written aside first
        data = fresh.unionByName(materialize(rest, "silver-day"), allowMissingColumns=True)
    write_silver(data, lake.silver_root, run_date)
    return n
