"""Cases that once lost or changed data: quoting, late bytes, crashes, retries, drift."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, TimestampType

from fileflow.functions.dates import parse_timestamp
from fileflow.operators import quality, records
from fileflow.operators.clean import BLOCK_COL, FILE_COL, with_row_ids
from fileflow.operators.table import SnapshotTable, wider
from fileflow.operators.upsert import measure, merge
from fileflow.plans.full import full_run
from fileflow.plans.lake import Lake
from fileflow.schemas import ColumnSpec
from fileflow.sources.csv import export_csv, read_csv
from fileflow.sources.dispatch import read_files
from fileflow.sources.excel import read_excel
from fileflow.sources.landing import manifest_runs, read_manifest, write_manifest
from fileflow.sources.profile import profile
from fileflow.sources.silver import read_silver
from fileflow.testing import workbook_bytes
from tests.conftest import write

DAY = "2024-03-01"


def rows(df, *cols):
    return [tuple(r) for r in df.orderBy("row_id").select(*cols).collect()]


# --- CSV -------------------------------------------------------------------------------------

def test_doubled_quotes_backslashes_and_breaks(spark, scratch):
    write(f"{scratch}/q.csv", 'id,said,n\n1,"say ""hi"" now",5\n2,"say ""hi"", ok",6\n'
                              '3,"C:\\",7\n4,"two\r\nlines",8\n5,plain "quote,9\n')
    r = read_csv(spark, scratch)
    assert rows(r.data, "id", "said", "n") == [
        (1, 'say "hi" now', 5), (2, 'say "hi", ok', 6), (3, "C:\\", 7), (4, "two\r\nlines", 8),
        (5, 'plain "quote', 9)]
    assert r.rejects.count() == 0


def test_long_lines_are_counted_by_fields(spark, scratch):
    write(f"{scratch}/l.csv", 'a,b,c\n1,2,3\n4,5,6,,lost\n7,"8,8",9\n"x,y",2,3,4\n1,2,3,\n')
    r = read_csv(spark, scratch)
    assert rows(r.data, "a", "b", "c") == [(1, "2", 3), (7, "8,8", 9)]
    assert sorted(x.line for x in r.rejects.collect()) == ['"x,y",2,3,4', "1,2,3,", "4,5,6,,lost"]


def test_late_bytes_decide(spark, scratch):
    plain = "id,note\n" + "".join(f"{i},{'a' * 40}\n" for i in range(4000))
    write(f"{scratch}/quote.csv", plain + '4000,"two\nlines"\n')
    write(f"{scratch}/latin.csv", plain + "4000,café €\n", "cp1252")
    got = {os.path.basename(r.path): r for r in profile(spark, [scratch]).collect()}
    assert got["quote.csv"].multi_line and got["latin.csv"].encoding == "windows-1252"
    r = read_csv(spark, scratch, root=scratch).data
    assert dict(r.dtypes)["id"] == "bigint" and r.count() == 8002
    last = {x.source_file: x.note for x in r.filter("id = 4000").collect()}
    assert last == {"quote.csv": "two\nlines", "latin.csv": "café €"}
    assert r.filter("row_id <> id").count() == 0


def test_wide_and_quoted_headers(spark, scratch):
    names = [f"c{i:04d}" + "x" * 16 for i in range(4000)]
    write(f"{scratch}/w/w.csv", ",".join(names) + "\n" + ",".join(map(str, range(4000))) + "\n")
    p = profile(spark, [f"{scratch}/w"]).first()
    assert len(p.header_line) == 4000 * 21 + 3999 and p.delimiter == ","
    write(f"{scratch}/h/h.csv", '"a;b;c;d",e\n1,2\n')
    assert profile(spark, [f"{scratch}/h"]).first().delimiter == ","
    assert read_csv(spark, f"{scratch}/h").data.columns[:2] == ["abcd", "e"]


def test_codes_are_not_numbers(spark, scratch):
    write(f"{scratch}/n.csv", "a,b,c\n12D,1e3,.5\n7F,-2.,inf\n3D,+4,1\n")
    types = dict(read_csv(spark, scratch).data.dtypes)
    assert (types["a"], types["b"], types["c"]) == ("string", "double", "double")


def test_export_keeps_text(spark, scratch):
    texts = ['a "b" c', "x\ny", " lead", "trail ", "C:\\", 'end"', "semi;comma,"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    export_csv(df, f"{scratch}/out")
    got = {r.i: r.t for r in read_csv(spark, f"{scratch}/out").data.collect()}
    assert got == {i: t.strip(" ") for i, t in enumerate(texts)}


def test_row_ids_survive_a_change_of_splits(spark, scratch):
    write(f"{scratch}/big.csv", "k\n" + "".join(f"{i}\n" for i in range(60000)))
    raw = spark.read.option("header", "true").schema("k long").csv(f"{scratch}/big.csv").select(
        "k", F.col("_metadata.file_path").alias(FILE_COL),
        F.col("_metadata.file_block_start").alias(BLOCK_COL))
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        out = with_row_ids(raw)
        read = read_csv(spark, scratch).data
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(24 * 1024))
        assert out.count() == 60000 and out.filter("row_id <> k").count() == 0
        assert read.count() == 60000 and read.filter("row_id <> k").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_missing_sheet_is_reported(spark):
    files = spark.createDataFrame([("d/a.xlsx", workbook_bytes([("One", [["k"], [1]])])),
                                   ("d/b.xlsx", workbook_bytes([("Two", [["k"], [2]])]))],
                                  "path string, content binary")
    r = read_excel(spark, files, sheet="Two", root="d")
    assert [x.k for x in r.data.collect()] == [2]
    assert [tuple(x) for x in r.rejects.collect()] == [("a.xlsx", "no rows in sheet 'Two'")]


def test_dispatch_reads_the_given_bytes(spark):
    files = spark.createDataFrame([("d/a.csv", b"k,v\n1,x\n"), ("d/b.xlsx", workbook_bytes(
        [("S", [["K", "V"], [2, "y"]])]))], "path string, content binary")
    got = read_files(spark, files, root="d").data.collect()
    assert sorted((r.k, r.v, r.source_file) for r in got) == [(1, "x", "a.csv"), (2, "y", "b.xlsx")]


# --- dates -----------------------------------------------------------------------------------

def test_date_forms(spark):
    noon = dt.datetime(2024, 1, 5)
    cases = {"1/5/2024": noon, "2024-1-5": noon, "5 Jan 2024": noon, "January 5, 2024": noon,
             "2024-01-05T10:20:30Z": noon.replace(hour=10, minute=20, second=30),
             "2024-01-05 10:20:30+02:00": noon.replace(hour=8, minute=20, second=30),
             "2024-01-05T10:20:30+0200": noon.replace(hour=8, minute=20, second=30),
             "2024-01-05 10:20:30.123456789": noon.replace(hour=10, minute=20, second=30,
                                                           microsecond=123456),
             "1/5/2024 1:45 PM": noon.replace(hour=13, minute=45), "junk": None, "2024": None,
             "12:30": None, "13/25/2024": None, "2024-02-30": None, "": None}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = {r.x: r.t for r in df.select("x", parse_timestamp("x").cast("string").alias("t")).collect()}
    assert got == {k: None if v is None else v.isoformat(" ") for k, v in cases.items()}


# --- tables ----------------------------------------------------------------------------------

def test_crash_before_the_log_row_is_not_published(spark, scratch):
    t = SnapshotTable(spark, f"{scratch}/t")
    t.append(spark.range(10))
    t._write(spark.range(10, 25), None)                       # the writer dies here
    t.append(spark.range(10, 15))
    assert t.read().count() == 15 and t.head().rows == 15
    t.upsert(spark.range(12, 20).withColumn("v", F.lit(1)), ["id"])
    assert t.read().count() == 20


def test_commits_of_others_are_seen_and_versions_not_reused(spark, scratch):
    a, b = SnapshotTable(spark, f"{scratch}/t"), SnapshotTable(spark, f"{scratch}/t")
    a.append(spark.range(3))
    b.append(spark.range(3, 5))
    assert a.read().count() == 5 and a.version() == 2
    with pytest.raises(RuntimeError, match="already taken"):
        a._commit(2, "append", [1], spark.range(1).schema, 1)


def test_partitioning_is_kept(spark, scratch):
    t = SnapshotTable(spark, f"{scratch}/t")
    t.append(spark.range(6).withColumn("p", F.col("id") % 2), partition_by=["p"])
    t.upsert(spark.range(2).withColumn("p", F.lit(7).cast("long")), ["id"])
    v = t.head().versions[0]
    assert sorted(x for x in os.listdir(f"{scratch}/t/data/_v={v}") if "=" in x) == [
        "p=0", "p=1", "p=7"]


def test_types_widen(spark, scratch):
    assert wider(LongType(), DoubleType()) == DoubleType()
    assert wider(LongType(), StringType()) == StringType()
    assert wider(TimestampType(), LongType()) == StringType()
    t = SnapshotTable(spark, f"{scratch}/t")
    t.append(spark.createDataFrame([(1, 10), (2, 20)], "k long, v long"))
    t.upsert(spark.createDataFrame([(2, "x"), (3, "y")], "k long, v string"), ["k"])
    assert sorted(map(tuple, t.read().collect())) == [(1, "10"), (2, "x"), (3, "y")]
    t.append(spark.createDataFrame([(4.5, 7)], "k double, v long"))
    assert sorted(map(tuple, t.read().collect())) == [(1.0, "10"), (2.0, "x"), (3.0, "y"), (4.5, "7")]


def test_nested_values_are_sized(spark):
    df = spark.range(10).select("id", F.array_repeat(F.lit(1.5), 100_000).alias("a"))
    assert measure(df)[1] > 1_000_000
    m = merge(df.limit(0), df, ["id"], max_broadcast_bytes=1 << 20)
    assert m.strategy == "shuffle"


# --- runs ------------------------------------------------------------------------------------

def test_failed_load_is_taken_up_by_the_next_run(spark, scratch):
    src, lake = f"{scratch}/src", Lake(spark, f"{scratch}/lake")
    write(f"{src}/a.csv", "id\n1\n2,9\n3\n")
    with pytest.raises(Exception):
        full_run(spark, lake, src, DAY, "r1", specs=[ColumnSpec("nope", nullable=False)])
    r = full_run(spark, lake, src, DAY, "r2", natural_keys=["id"])
    assert (r.extract.landed, r.extract.skipped, r.load.rows_inserted) == (0, 1, 2)
    assert [x.line for x in lake.rejects.read().collect()] == ["2,9"]
    assert {x.status for x in lake.file_manifest.read().collect()} == {"LOADED"}
    assert full_run(spark, lake, src, DAY, "r3", natural_keys=["id"]).load is None


def test_landed_bytes_are_loaded(spark, scratch):
    from fileflow.plans.extract import extract
    from fileflow.plans.transform import transform_load
    src, lake = f"{scratch}/src", Lake(spark, f"{scratch}/lake")
    write(f"{src}/a.csv", "id,v\n1,landed\n")
    extract(spark, lake, src, DAY, "r1")
    write(f"{src}/a.csv", "id,v\n1,changed\n")
    transform_load(spark, lake, DAY, "r1", natural_keys=["id"])
    assert [x.v for x in lake.table("records").read().collect()] == ["landed"]


def test_second_run_changed_file_and_one_silver_copy(spark, scratch):
    src, lake = f"{scratch}/src", Lake(spark, f"{scratch}/lake")
    write(f"{src}/a.csv", "id,v\n1,old\n2,old\n")
    write(f"{src}/b.csv", "id,v\n3,b\n")
    full_run(spark, lake, src, DAY, "r1", natural_keys=["id"])
    write(f"{src}/a.csv", "id,v\n1,new\n")
    write(f"{src}/c.xlsx", workbook_bytes([("S", [["ID", "V"], [4, "c"]])]))
    r = full_run(spark, lake, src, DAY, "r2", natural_keys=["id"])
    assert (r.extract.landed, r.extract.skipped) == (2, 1)
    got = sorted((x.id, x.v) for x in lake.table("records").read().collect())
    assert got == [(1, "new"), (2, "old"), (3, "b"), (4, "c")]
    silver = read_silver(spark, lake.silver_root, DAY)
    assert sorted((x.source_file, x.id, x.v) for x in silver.collect()) == [
        ("a.csv", 1, "new"), ("b.csv", 3, "b"), ("c.xlsx", 4, "c")]
    assert sorted(x.file_name for x in read_manifest(spark, lake.manifests, DAY).collect()) == [
        "a.csv", "b.csv", "c.xlsx"]


def test_empty_run_has_a_manifest(spark, scratch):
    src, lake = f"{scratch}/src", Lake(spark, f"{scratch}/lake")
    os.makedirs(src)
    r = full_run(spark, lake, src, DAY, "r1")
    assert r.load is None and [x.ok for x in r.checks.collect()] == [False]
    assert [(x.run_date, x.file_count) for x in manifest_runs(spark, lake.manifests).collect()] == [
        (DAY, 0)]
    write_manifest(spark.createDataFrame([], "file_name string, minio_key string, size_bytes long"),
                   f"{scratch}/m", DAY)
    assert read_manifest(spark, f"{scratch}/m").count() == 0


def test_no_exchange_carries_content(spark, scratch):
    from fileflow.sources.landing import bronze_files
    b = spark.createDataFrame([("k", "m", dt.datetime(2024, 1, 1), b"x")],
                              "storage_path string, checksum_md5 string, upload_timestamp timestamp, "
                              "content binary")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = bronze_files(b, b)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    heavy = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "content" in x]
    assert not heavy


# --- pages and checks ------------------------------------------------------------------------

def test_pages_by_key_cover_all_rows(spark, scratch):
    spark.range(250).select((F.col("id") % 7).alias("a"), "id").write.parquet(f"{scratch}/p")
    df, seen, after = spark.read.parquet(f"{scratch}/p"), [], None
    while got := records.page_after(df, ["a", "id"], after, 60).collect():
        seen += [tuple(r) for r in got]
        after = list(seen[-1])
    assert seen == sorted((i % 7, i) for i in range(250))
    plan = records.page_after(df, ["a", "id"], [3, 10])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(a,3)" in plan and "TakeOrderedAndProject" in plan
    with pytest.raises(ValueError):
        records.page_after(df, ["a", "id"], [3])


def test_one_scan_checks_equal_two(spark, scratch):
    spark.createDataFrame([(1, None, dt.datetime(2024, 1, 2))], "a long, b string, loaded_at timestamp"
                          ).write.parquet(f"{scratch}/c")
    df = spark.read.parquet(f"{scratch}/c")
    one = quality.loaded_and_filled(df, "2024-01-02")
    assert one._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    two = quality.suite(quality.rows_loaded_since(df, "2024-01-02"), quality.all_null_columns(df))
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
