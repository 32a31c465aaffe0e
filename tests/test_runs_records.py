import datetime as dt

from pyspark.sql import functions as F

from fileflow.operators import records, runs
from fileflow.schemas import PIPELINE_RUN


def _runs(spark):
    d = dt.datetime
    data = [("a", "dag", d(2024, 1, 1, 10), d(2024, 1, 1, 10, 30), "SUCCESS", 1, 10, 2, None),
            ("b", "dag", d(2024, 1, 2, 10), d(2024, 1, 2, 11), "FAILED", 1, 0, 0, ""),
            ("c", "dag", None, None, "RUNNING", 0, 0, 0, None),
            ("d", "other", d(2024, 1, 2, 12), None, "SKIPPED", 0, 5, 5, "boom")]
    return spark.createDataFrame(data, PIPELINE_RUN)


def test_latest_nulls_first(spark):
    assert [r.run_id for r in runs.latest(_runs(spark), 3).collect()] == ["c", "d", "b"]


def test_status_rate_duration(spark):
    r = _runs(spark)
    c = runs.status_counts(r).first()
    assert (c.success, c.failed, c.running) == (1, 1, 1)
    s = runs.success_rate(r).first()
    assert s.success_rate == 25.0 and s.total_runs == 4
    assert runs.avg_duration(r).first()[0] == 45.0


def test_histogram_edges(spark):
    r = _runs(spark)
    h = sorted((x.bin, x.n) for x in runs.duration_histogram(r, bins=20).collect())
    assert h == [(1, 1), (20, 1)]           # the maximum lands in the last bin


def test_failed_runs_default_message(spark):
    got = [(x.run_id, x.error_message) for x in runs.failed_runs(_runs(spark)).collect()]
    assert got == [("b", "No error message recorded")]


def test_daily_trend_and_kpis(spark):
    r = _runs(spark)
    t = sorted(tuple(x) for x in runs.daily_trend(r).collect() if x.date)
    assert t == [("2024-01-01", 10, 2, 12), ("2024-01-02", 5, 5, 10)]
    ds = spark.createDataFrame([("x", 5), ("y", None)], "name string, row_count long")
    k = runs.kpi_totals(ds, r).first()
    assert (k.total_rows, k.total_datasets, k.last_run_status, k.last_run_rows) == (5, 2, "RUNNING", 0)


def test_date_range_includes_next_midnight(spark):
    d = dt.datetime
    df = spark.createDataFrame([(1, d(2024, 1, 1)), (2, d(2024, 1, 3, 23, 59)), (3, d(2024, 1, 4)),
                                (4, d(2024, 1, 4, 0, 0, 1)), (5, d(2023, 12, 31, 23, 59))],
                               "id long, loaded_at timestamp")
    got = sorted(r.id for r in records.date_range(df, "loaded_at", "2024-01-01", "2024-01-03").collect())
    assert got == [1, 2, 3]
    assert records.date_range(df, "loaded_at").count() == 5


def test_page_with_rn(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    p = records.page(df, ["k"], limit=5, offset=10, with_rn=True).collect()
    assert [(r.k, r.rn) for r in p] == [(10, 11), (11, 12), (12, 13), (13, 14), (14, 15)]
    import pytest
    with pytest.raises(ValueError):
        records.page(df, ["k"], limit=5001)


def test_deep_page_uses_distributed_numbering(spark):
    from fileflow.operators.records import TOPK_MAX
    df = spark.range(0, TOPK_MAX + 500).withColumnRenamed("id", "k")
    p = records.page(df.orderBy(F.rand(7)), ["k"], limit=3, offset=TOPK_MAX, with_rn=True)
    assert [(r.k, r.rn) for r in p.collect()] == [(TOPK_MAX, TOPK_MAX + 1),
                                                  (TOPK_MAX + 1, TOPK_MAX + 2),
                                                  (TOPK_MAX + 2, TOPK_MAX + 3)]
