import datetime as dt
import hashlib

from pyspark.sql import functions as F

from fileflow.plans.full import full_run
from fileflow.plans.lake import Lake
from fileflow.sources import discover
from fileflow.sources.landing import read_manifest, split_by_checksum, write_manifest
from fileflow.testing import workbook_bytes
from tests.conftest import write


def test_checksum_skip(spark):
    known = spark.createDataFrame([("d/a.csv", "m1"), ("d/b.csv", "m2")],
                                  "storage_path string, checksum_md5 string")
    inc = spark.createDataFrame([("d/a.csv", "m1"), ("d/b.csv", "zz"), ("d/c.csv", "m3")],
                                "storage_path string, checksum_md5 string")
    new, skipped = split_by_checksum(inc, known)
    assert sorted(r.storage_path for r in new.collect()) == ["d/b.csv", "d/c.csv"]
    assert [r.storage_path for r in skipped.collect()] == ["d/a.csv"]


def test_manifest_roundtrip_and_missing(spark, scratch):
    files = spark.createDataFrame([("a.csv", "2024-01-01/a.csv", 10), ("b.csv", "2024-01-01/b.csv", 20)],
                                  "file_name string, minio_key string, size_bytes long")
    write_manifest(files, f"{scratch}/m", "2024-01-01", F.lit("2024-01-01T00:00:00"))
    got = read_manifest(spark, f"{scratch}/m", "2024-01-01").collect()
    assert sorted((r.file_name, r.file_count) for r in got) == [("a.csv", 2), ("b.csv", 2)]
    assert read_manifest(spark, f"{scratch}/nothing").count() == 0


def test_discovery_tree(spark, scratch):
    write(f"{scratch}/in/a.csv", "x\n1\n")
    write(f"{scratch}/in/deep/er/B.CSV", "x\n2\n")
    write(f"{scratch}/in/deep/a.csv", "x\n3\n")              # same name in another folder
    write(f"{scratch}/in/notes.txt", "ignored")
    write(f"{scratch}/in/big.xlsx", b"0" * 5000)
    files = discover.scan(spark, f"{scratch}/in")
    assert sorted(r.file_id for r in files.collect()) == ["a.csv", "big.xlsx", "deep/a.csv",
                                                          "deep/er/B.CSV"]
    ok, rej = discover.size_guard(files, max_bytes=1000)
    assert [r.name for r in rej.collect()] == ["big.xlsx"]
    assert discover.scan(spark, f"{scratch}/missing").count() == 0


def test_full_run_twice_is_idempotent(spark, scratch):
    src = f"{scratch}/src"
    write(f"{src}/a.csv", "Employee ID,Full Name\n1, Alice \n2,Bob\n")
    write(f"{src}/sub/b.csv", "Full Name;Employee ID\nEve;6\n")
    write(f"{src}/c.xlsx", workbook_bytes([("S", [["Employee ID", "Full Name"], [9, "Zed"]])]))
    lake = Lake(spark, f"{scratch}/lake")
    today = dt.datetime.now(dt.timezone.utc).date()
    r1 = full_run(spark, lake, src, today.isoformat(), "r1", natural_keys=["employee_id"],
                  as_of=today)
    assert (r1.extract.landed, r1.load.rows_inserted) == (3, 4)
    assert all(x.ok for x in r1.checks.collect())
    r2 = full_run(spark, lake, src, today.isoformat(), "r2", natural_keys=["employee_id"],
                  as_of=today)
    assert (r2.extract.landed, r2.extract.skipped) == (0, 3) and r2.load is None
    got = sorted((x.employee_id, x.full_name) for x in lake.table("records").read().collect())
    assert got == [(1, "Alice"), (2, "Bob"), (6, "Eve"), (9, "Zed")]
    st = {x.run_id: x.status for x in lake.pipeline_run.read().collect()}
    assert st == {"r1": "SUCCESS"}


def test_failed_load_records_failure(spark, scratch):
    import pytest
    from fileflow.schemas import ColumnSpec
    src = f"{scratch}/src"
    write(f"{src}/a.csv", "id\n1\n")
    lake = Lake(spark, f"{scratch}/lake")
    with pytest.raises(Exception):
        full_run(spark, lake, src, "2024-01-01", "bad", specs=[ColumnSpec("nope", nullable=False)])
    r = lake.pipeline_run.read().first()
    assert r.status == "FAILED" and "Missing required column" in r.error_message
    assert r.end_time is not None


def test_oversized_file_is_never_opened(spark, scratch):
    src = f"{scratch}/src"
    write(f"{src}/a.csv", "id\n1\n")
    write(f"{src}/big.csv", "id\n" + "2\n" * 4000)
    lake = Lake(spark, f"{scratch}/lake")
    from fileflow.plans.extract import extract
    r = extract(spark, lake, src, "2024-01-01", "r1", max_mb=1000 / (1024 * 1024))
    assert (r.discovered, r.rejected, r.landed) == (2, 1, 1)
    assert [x.rel_path for x in lake.bronze.read().collect()] == ["a.csv"]


def test_upsert_plan_collapses_hot_key_before_shuffle(spark):
    # one key holds a third of the source: the dedup must aggregate map-side first
    from fileflow.operators.upsert import merge
    src = spark.range(0, 30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS seq", "cast(id AS string) AS v")
    tgt = spark.createDataFrame([(0, 0, "t")], "k long, seq long, v string")
    m = merge(tgt, src, ["k"], order_by=["seq"], strategy="shuffle")
    plan = m.result._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    row = m.result.filter("k = 0").first()
    assert row.seq == 29997


def test_files_over_a_row_land_in_chunks(spark, scratch):
    src = f"{scratch}/src"
    big = "id,note\n" + "".join(f'{i},"a\n{i}"\n' for i in range(400))
    write(f"{src}/big.csv", big)
    write(f"{src}/sub/small.csv", "id,note\n9001,x\n")
    write(f"{src}/book.xlsx", workbook_bytes([("S", [["id", "note"]] + [[i, "w" * 50 + str(i)]
                                                                        for i in range(90)])]))
    lake = Lake(spark, f"{scratch}/lake")
    today = dt.datetime.now(dt.timezone.utc).date()
    args = dict(natural_keys=["id"], as_of=today, row_bytes=1500, chunk_bytes=256)
    r1 = full_run(spark, lake, src, today.isoformat(), "r1", **args)
    assert (r1.extract.landed, r1.extract.rejected) == (2, 1)
    rows = lake.bronze_chunks.read()
    assert rows.agg(F.max(F.length("content"))).first()[0] == 256
    got = {x.file_name: x for x in lake.file_manifest.read().collect()}
    assert got["big.csv"].checksum_md5 == hashlib.md5(big.encode()).hexdigest()
    assert (got["big.csv"].row_count, got["big.csv"].status) == (400, "LOADED")
    assert lake.table("records").read().count() == 401
    r2 = full_run(spark, lake, src, today.isoformat(), "r2", **args)
    assert (r2.extract.landed, r2.extract.skipped) == (0, 2) and r2.load is None
    write(f"{src}/big.csv", big.replace('"a\n7"', "changed"))
    r3 = full_run(spark, lake, src, today.isoformat(), "r3", **args)
    assert (r3.extract.landed, r3.load.rows_inserted, r3.load.rows_updated) == (1, 0, 400)
    assert lake.table("records").read().where("note = 'changed'").count() == 1
    assert [x.reason for x in lake.rejects.read().distinct().collect()][0].startswith("workbook")
