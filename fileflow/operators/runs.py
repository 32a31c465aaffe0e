"""Run-history analytics over a PIPELINE_RUN-shaped DataFrame.

L1 latest runs, A4 KPI totals, A5 daily trend, A6 status counts, A7 success rate, A8 average
duration, A9 duration histogram, A10 total, A12 latest run of a dag on a day, A15 runs
started on a day, P13 failed runs, W4 per-run rollup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fileflow.functions.dates import minutes_between
from fileflow.operators.records import on_day

STATUSES = ["SUCCESS", "FAILED", "RUNNING"]
NO_ERROR_TEXT = "No error message recorded"


def latest(runs: DataFrame, n: int = 20, time_col: str = "start_time",
           tie: str = "run_id") -> DataFrame:
    """Newest ``n`` runs, newest first, NULL start times first (as Oracle's DESC), L1.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: a bounded top-k per partition.
    """
    return runs.orderBy(F.col(time_col).desc_nulls_first(), F.col(tie).asc_nulls_last()) \
        .limit(n)


def daily_trend(runs: DataFrame, time_col: str = "start_time",
                value_cols: tuple[str, ...] = ("rows_inserted", "rows_updated"),
                total_name: str = "rows") -> DataFrame:
    """Per calendar day: sum of each value column and their total (A5).

    Group key is the ``yyyy-MM-dd`` text of the day; sums treat NULL as 0.
    """
    day = F.date_format(F.col(time_col), "yyyy-MM-dd").alias("date")
    sums = [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in value_cols]
    out = runs.groupBy(day).agg(*sums)
    if total_name:
        tot: Column = F.lit(0)
        for c in value_cols:
            tot = tot + F.col(c)
        out = out.withColumn(total_name, tot)
    return out


def status_counts(runs: DataFrame, statuses: list[str] = STATUSES) -> DataFrame:
    """Counts for SUCCESS / FAILED / RUNNING; others ignored, missing -> 0."""
    return runs.agg(*[F.count_if(F.col("status") == s).cast("long").alias(s.lower())
                      for s in statuses])


def success_rate(runs: DataFrame) -> DataFrame:
    """Share of SUCCESS in percent (denominator = all runs), plus the total run count."""
    ok = F.coalesce(F.col("status") == F.lit("SUCCESS"), F.lit(False)).cast("double")
    return runs.agg((F.avg(ok) * 100.0).alias("success_rate"),
                    F.count(F.lit(1)).alias("total_runs"))


def with_duration(runs: DataFrame, start: str = "start_time", end: str = "end_time",
                  name: str = "duration_minutes") -> DataFrame:
    return runs.withColumn(name, minutes_between(start, end))


def avg_duration(runs: DataFrame, start: str = "start_time", end: str = "end_time") -> DataFrame:
    """Mean duration in minutes over runs with both ends known.

    Summed as exact integer microseconds, divided once at the end, so the result does not
    depend on the order partitions are combined in.
    """
    us = F.timestamp_diff("MICROSECOND", F.col(start), F.col(end))
    return runs.agg((F.sum(us) / F.count(us) / F.lit(60_000_000.0)).alias("avg_duration_minutes"))


def duration_histogram(runs: DataFrame, bins: int = 20, start: str = "start_time",
                       end: str = "end_time", value: str | None = None) -> DataFrame:
    """Equal-width histogram of durations, NULL durations excluded.

    Two passes: a one-row min/max aggregate (two scalars reach the driver), then a grouped
    count by bin. The top edge goes into the last bin.
    """
    v = F.col(value) if value else minutes_between(start, end)
    d = runs.select(v.alias("d")).filter(F.col("d").isNotNull())
    lo, hi = d.agg(F.min("d"), F.max("d")).first()
    if lo is None:
        return d.sparkSession.createDataFrame(
            [], "bin int, bin_start double, bin_end double, n long")
    width = (hi - lo) / bins if hi > lo else 0.0
    if hi > lo:
        b = F.least(F.floor(F.lit(float(bins)) * (F.col("d") - F.lit(lo)) / F.lit(hi - lo))
                    .cast("int") + 1, F.lit(bins))
    else:
        b = F.lit(1)
    out = d.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(
        "bin",
        (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("bin_start"),
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_end"),
        "n")


def failed_runs(runs: DataFrame) -> DataFrame:
    """FAILED runs with their error text; empty or missing text gets a default."""
    msg = F.coalesce(F.nullif(F.col("error_message"), F.lit("")), F.lit(NO_ERROR_TEXT))
    return runs.filter(F.col("status") == "FAILED") \
        .select("run_id", "start_time", msg.alias("error_message"))


def last_run_of_day(runs: DataFrame, dag_id: str, as_of) -> DataFrame:
    """Latest run of ``dag_id`` that started on day ``as_of``: status and counters."""
    today = on_day(runs.filter(F.col("dag_id") == dag_id), "start_time", as_of)
    return latest(today, 1).select("run_id", "status", "files_processed", "rows_inserted",
                                   "rows_updated")


def runs_started_on(runs: DataFrame, as_of) -> DataFrame:
    """Number of runs that started on day ``as_of``."""
    return on_day(runs, "start_time", as_of).agg(F.count(F.lit(1)).alias("runs_today"))


def kpi_totals(datasets: DataFrame, runs: DataFrame) -> DataFrame:
    """Overview KPIs (A4): total rows, number of datasets, last run's status and rows.

    One aggregate over the union of the dataset list and the single newest run, so no join
    is needed to put the two one-row results side by side.
    """
    last = latest(runs, 1).select(
        F.lit(None).cast("long").alias("row_count"), F.lit(None).cast("string").alias("name"),
        F.col("status").alias("last_status"),
        (F.coalesce(F.col("rows_inserted"), F.lit(0))
         + F.coalesce(F.col("rows_updated"), F.lit(0))).cast("long").alias("last_rows"))
    ds = datasets.select(F.coalesce(F.col("row_count"), F.lit(0)).cast("long").alias("row_count"),
                         "name", F.lit(None).cast("string").alias("last_status"),
                         F.lit(None).cast("long").alias("last_rows"))
    u = ds.unionByName(last)
    return u.agg(F.coalesce(F.sum("row_count"), F.lit(0)).cast("long").alias("total_rows"),
                 F.count("name").alias("total_datasets"),
                 F.coalesce(F.max("last_status"), F.lit("N/A")).alias("last_run_status"),
                 F.coalesce(F.max("last_rows"), F.lit(0)).cast("long").alias("last_run_rows"))


def rollup(load_results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per-run rollup of per-file load results (W4): files, sum inserted, sum updated."""
    aggs = [F.count(F.lit(1)).alias("files_processed"),
            F.sum(F.coalesce(F.col("rows_inserted"), F.lit(0))).cast("long").alias("rows_inserted"),
            F.sum(F.coalesce(F.col("rows_updated"), F.lit(0))).cast("long").alias("rows_updated")]
    if by:
        return load_results.groupBy(*by).agg(*aggs)
    return load_results.agg(*aggs)
