import glob
import uuid

import pytest
from pyspark.sql import functions as F

from fileflow.operators import tablestats as ts


@pytest.fixture
def db(spark, scratch):
    name = f"kept_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def _table(spark, db, scratch, df, name="t"):
    df.write.mode("overwrite").parquet(f"{scratch}/{name}")
    assert ts.register(spark, f"{db}.{name}", df.schema, f"{scratch}/{name}")
    return f"{db}.{name}"


def test_figures_are_kept_and_no_data_file_is_opened(spark, db, scratch):
    df = spark.range(100).select(
        "id", F.when(F.col("id") % 4 > 0, F.col("id") * 2).alias("odd `name'"),
        F.lit("x").alias("s"), F.array("id").alias("a"),
        F.timestamp_seconds(F.col("id")).alias("loaded_at"))
    t = _table(spark, db, scratch, df)
    assert not ts.register(spark, t, df.schema, f"{scratch}/t")
    assert ts.list_datasets(spark, [t]).first().status == "none"
    assert ts.refresh(spark, [t]) == [t] and ts.refresh(spark, [t]) == []
    want = {r.column_name: r for r in ts.column_stats(spark, t).collect()}
    for f in glob.glob(f"{scratch}/t/*.parquet"):      # same length and time, unreadable
        import os
        at, n = os.stat(f), os.path.getsize(f)
        open(f, "wb").write(b"\0" * n)
        os.utime(f, ns=(at.st_atime_ns, at.st_mtime_ns))
    got = ts.list_datasets(spark, [t]).first()
    assert (got.name, got.row_count, got.status) == (t, 100, "fresh") and got.last_analysed
    assert {r.column_name: r for r in ts.column_stats(spark, t).collect()} == want
    assert (want["id"].min_value, want["id"].max_value, want["id"].null_rate) == ("0", "99", 0.0)
    odd = want["odd `name'"]
    assert (odd.null_count, odd.null_rate, odd.min_value, odd.max_value) == (25, 0.25, "2", "198")
    assert want["s"].null_count == 0 and want["s"].min_value is None
    assert want["a"].null_count is None and want["a"].row_count == 100
    assert want["loaded_at"].min_value.startswith("1970-01-01 00:00:00")


def test_changed_folders_are_stale_until_refreshed(spark, db, scratch):
    t = _table(spark, db, scratch, spark.range(10))
    ts.analyze(spark, t)
    spark.range(5).write.mode("append").parquet(f"{scratch}/t")
    got = ts.list_datasets(spark, [t]).first()
    assert (got.row_count, got.status) == (10, "stale")
    assert ts.refresh(spark, [t]) == [t]
    got = ts.list_datasets(spark, [t]).first()
    assert (got.row_count, got.status) == (15, "fresh")
    spark.range(3).write.insertInto(t)                 # Spark itself drops outdated figures
    assert ts.list_datasets(spark, [t]).first().status in ("none", "stale")


def test_empty_and_unknown_tables(spark, db, scratch):
    t = _table(spark, db, scratch, spark.createDataFrame([], "a long, m map<string,long>"))
    ts.analyze(spark, t)
    a, m = ts.column_stats(spark, t).collect()
    assert (a.row_count, a.null_count, a.null_rate, a.min_value) == (0, 0, 0.0, None)
    assert m.null_count is None and a.status == "fresh"
    only = _table(spark, db, scratch, spark.createDataFrame([], "m map<string,long>"), "u")
    ts.analyze(spark, only)
    assert [r.row_count for r in ts.list_datasets(spark, [only, t]).collect()] == [0, 0]
    for f in (ts.analyze, ts.column_stats):
        with pytest.raises(KeyError):
            f(spark, f"{db}.nowhere")
