import pytest
from pyspark.sql import functions as F

from fileflow.operators.rankindex import build, of_table, open_index
from fileflow.operators.table import SnapshotTable


def test_pages_equal_the_sorted_rows(spark, scratch):
    # a third of the rows share one key, nulls come last, one column cannot be ordered
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 != 1, F.col("id") % 97).alias("k"),
        "id", F.create_map(F.lit("a"), "id").alias("m"))
    index = build(df.repartition(5), f"{scratch}/ix", ["k"], rows_per_range=100)
    want = sorted(((r.k is None, r.k or 0, r.id) for r in df.collect()))
    assert index.rows == 3000 and index.ranges().count() >= 20
    got = []
    for p in range(index.pages(450)):
        got += index.page(450, p * 450, with_rn=True).collect()
    assert [(r.k is None, r.k or 0, r.id) for r in got] == want
    assert [r.rn for r in got] == list(range(1, 3001))
    assert all(r.m == {"a": r.id} for r in got)
    low = index.ranges().orderBy("first").first()
    assert low.first == 0 and low.low is not None


def test_a_deep_page_opens_few_rows(spark, scratch):
    index = build(spark.range(10_000).select(F.expr("id * 7919 % 10007").alias("k")),
                  f"{scratch}/ix", ["k"], rows_per_range=200)
    opened = index._opened(9000, 100)
    assert sum(r.rows for r in opened) < 500
    page = index.page(100, 9000)
    assert len(page.inputFiles()) == len(opened)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_copies_of_one_row_spread_over_ranges(spark, scratch):
    df = spark.range(4000).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    index = build(df, f"{scratch}/ix", ["a"], rows_per_range=200)
    assert index.ranges().agg(F.max("rows")).first()[0] < 1000
    assert index.page(5000, 3990).count() == 10


def test_empty_end_and_errors(spark, scratch):
    df = spark.createDataFrame([], "a long, rn string")
    index = build(df, f"{scratch}/ix", ["a"])
    assert index.rows == 0 and index.page(10).collect() == [] and index.pages(10) == 0
    full = build(spark.range(10), f"{scratch}/iy", ["id"], rows_per_range=3)
    assert full.page(10, 10).collect() == []
    assert [r.id for r in full.page(4, 8).collect()] == [8, 9]
    for bad in (lambda: full.page(0), lambda: full.page(1, -1), lambda: index.page(1, 0, True),
                lambda: build(df, scratch, []), lambda: build(df, scratch, ["zz"])):
        with pytest.raises(ValueError):
            bad()


def test_index_follows_the_version_of_a_table(spark, scratch):
    t = SnapshotTable(spark, f"{scratch}/t")
    t.append(spark.range(100))
    one = of_table(t, ["id"], rows_per_range=10)
    assert of_table(t, ["id"]).path == one.path            # no second sort
    t.upsert(spark.range(100, 120), ["id"])
    two = of_table(t, ["id"], rows_per_range=10)
    assert two.path != one.path and two.rows == 120
    assert [r.id for r in two.page(3, 118).collect()] == [118, 119]
    assert open_index(spark, f"{t.root}/_rank", ["other"], "v1") is None
    assert t.read().count() == 120


def test_small_ranges_do_not_make_small_tasks(spark, scratch):
    index = build(spark.range(6000), f"{scratch}/ix", ["id"], rows_per_range=10)
    got = index.ranges().collect()
    tasks = {r.file.split("-")[1] for r in got}
    assert len(got) >= 600 and len(tasks) <= spark.sparkContext.defaultParallelism
    assert max(r.rows for r in got) == 10
    assert [r.id for r in index.page(25, 2995).collect()] == list(range(2995, 3020))
