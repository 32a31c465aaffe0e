import os

from pyspark.sql import functions as F

from fileflow.sources.csv import read_csv
from fileflow.sources.profile import profile
from tests.conftest import write


def _rows(df, *cols):
    return [tuple(r) for r in df.orderBy("source_file", "row_id").select(*cols).collect()]


def test_roundtrip_employees(spark, scratch, employees):
    lines = ["employee_id,name,department,salary,hire_date"]
    lines += [",".join(str(v) for v in e) for e in employees]
    write(f"{scratch}/emp.csv", "\n".join(lines) + "\n")
    r = read_csv(spark, scratch, date_columns=["hire_date"], root=scratch)
    types = dict(r.data.dtypes)
    assert types["employee_id"] == "bigint" and types["salary"] == "double"
    assert types["hire_date"] == "timestamp"
    got = _rows(r.data, "employee_id", "name", "salary", "row_id", "source_file")
    assert got == [(1, "Alice Smith", 95000.0, 0, "emp.csv"), (2, "Bob Jones", 72000.5, 1, "emp.csv"),
                   (3, "Carol White", 88000.0, 2, "emp.csv")]


def test_header_normalised_and_accents(spark, scratch):
    write(f"{scratch}/a.csv", "Employee ID,Full Name,Hire Date\n1,José,2024-01-05\n")
    write(f"{scratch}/b.csv", "name,city\nZoë,Zürich\n")
    r = read_csv(spark, scratch)
    assert {"employee_id", "full_name", "hire_date", "name", "city"} <= set(r.data.columns)
    names = {x.full_name for x in r.data.collect()} | {x.city for x in r.data.collect()}
    assert "José" in names and "Zürich" in names


def test_delimiters_and_single_column(spark, scratch):
    write(f"{scratch}/tab.csv", "col_a\tcol_b\n1\t2\n3\t4\n")
    write(f"{scratch}/semi.csv", "col_a;col_b\n5;6\n")
    write(f"{scratch}/pipe.csv", "col_a|col_b\n7|8\n")
    write(f"{scratch}/one.csv", "name\nx\n")             # survey Q9: header stays 'name'
    r = read_csv(spark, scratch)
    got = sorted((x.col_a, x.col_b) for x in r.data.collect() if x.col_a is not None)
    assert got == [(1, 2), (3, 4), (5, 6), (7, 8)]
    assert [x.name for x in r.data.collect() if x.name is not None] == ["x"]


def test_header_drift_aligns_by_name(spark, scratch):
    # survey Q7: Spark's multi-file read would put zz into b by position
    write(f"{scratch}/1.csv", "a,b\n1,2\n")
    write(f"{scratch}/2.csv", "a,zz\n3,4\n")
    write(f"{scratch}/3.csv", "b,a\n5,6\n")
    r = read_csv(spark, scratch)
    got = sorted((x.a, x.b, x.zz) for x in r.data.collect())
    assert got == [(1, 2, None), (3, None, 4), (6, 5, None)]


def test_ragged_blank_na_and_whitespace(spark, scratch):
    text = ("id,value,note\n"
            "1,a,x\n"
            "2,b\n"            # short: padded with NULL
            "3,c,y,extra\n"    # long: rejected
            "\n"               # blank: skipped
            ",,\n"             # all empty: dropped (P2)
            "4,NA,   \n"       # NA token -> NULL; whitespace-only survives as '' (P3 after P2)
            "5,N/A,z\n")
    write(f"{scratch}/r.csv", text)
    r = read_csv(spark, scratch, root=scratch)
    got = _rows(r.data, "id", "value", "note", "row_id")
    assert got == [(1, "a", "x", 0), (2, "b", None, 1), (4, None, "", 2), (5, None, "z", 3)]
    rej = r.rejects.collect()
    assert [x.line for x in rej] == ["3,c,y,extra"]


def test_encodings_detected(spark, scratch):
    write(f"{scratch}/bom.csv", "name,city\nJosé,Zürich\n", "utf-8-sig")
    write(f"{scratch}/u16.csv", "name,city\nAna,Łódź\n", "utf-16")
    write(f"{scratch}/cp.csv", "name,city\nRené,Köln €\n", "cp1252")
    prof = {os.path.basename(r.path): r.encoding for r in profile(spark, [scratch]).collect()}
    assert prof["bom.csv"] == "UTF-8" and prof["u16.csv"] == "UTF-16LE"
    assert prof["cp.csv"] == "windows-1252"
    r = read_csv(spark, scratch)
    got = sorted((x.name, x.city) for x in r.data.collect())
    assert got == [("Ana", "Łódź"), ("José", "Zürich"), ("René", "Köln €")]


def test_utf8_cut_at_head_window_is_utf8(spark, scratch):
    # a multi-byte character straddling the 64 KiB profile window must not flip to cp1252
    head = "name\n" + "a" * (65536 - 7) + "\n"
    body = head + "é" * 10 + "\n"
    assert len(head.encode()) == 65535
    write(f"{scratch}/cut.csv", body)
    assert profile(spark, [f"{scratch}/cut.csv"]).first().encoding == "UTF-8"


def test_row_ids_dense_across_many_splits(spark, scratch):
    # Several files, each cut into many input splits; ids must be 0..n-1 in file order
    n = {"x.csv": 30000, "y.csv": 45000, "z.csv": 5}
    for name, k in n.items():
        write(f"{scratch}/{name}", "k,v\n" + "".join(f"{i},{name}\n" for i in range(k)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    spark.conf.set("spark.sql.files.openCostInBytes", str(1024))
    try:
        r = read_csv(spark, scratch, root=scratch)
        bad = r.data.filter(F.col("row_id") != F.col("k")).count()
        assert bad == 0
        counts = {x.source_file: x[1] for x in r.data.groupBy("source_file").count().collect()}
        assert counts == n
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_declared_schema_skips_inference(spark, scratch):
    from pyspark.sql.types import StructType
    write(f"{scratch}/s.csv", "id,amount\n1,2.5\n2,x\n")
    r = read_csv(spark, scratch, schema=StructType.fromDDL("id long, amount double"))
    assert sorted((x.id, x.amount) for x in r.data.collect()) == [(1, 2.5), (2, None)]


def test_empty_folder(spark, scratch):
    os.makedirs(f"{scratch}/empty", exist_ok=True)
    write(f"{scratch}/empty/e.csv", "")
    r = read_csv(spark, f"{scratch}/empty")
    assert r.data.count() == 0


def test_counts_work_on_rejects_and_declared_schema(spark, scratch):
    from pyspark.sql.types import StructType
    write(f"{scratch}/r.csv", "a,b\n1,2\n3,4,5\n6\n")
    r = read_csv(spark, scratch, schema=StructType.fromDDL("a long, b long"))
    assert r.data.count() == 2 and r.rejects.count() == 1


def test_nullable_integers_stay_bigint(spark, scratch):
    # survey Q6: pandas would turn an int column with gaps into float; we keep bigint
    write(f"{scratch}/n.csv", "id,qty\n1,5\n2,\n3,7\n")
    r = read_csv(spark, scratch)
    assert dict(r.data.dtypes)["qty"] == "bigint"
    assert sorted((x.id, x.qty) for x in r.data.collect()) == [(1, 5), (2, None), (3, 7)]


def test_source_file_keeps_plain_path(spark, scratch):
    # _metadata.file_path is percent-encoded; source_file must match the listed path
    write(f"{scratch}/a b/f ü%1+2.csv", "x\n1\n")
    r = read_csv(spark, scratch, root=scratch)
    assert [x.source_file for x in r.data.collect()] == ["a b/f ü%1+2.csv"]



def test_a_file_name_is_made_once_per_file(spark, scratch):
    write(f"{scratch}/in/a b/x.csv", "id\n1\n2\n")
    data = read_csv(spark, f"{scratch}/in", root=f"{scratch}/in").data.select("id", "source_file")
    assert "regexp_replace" not in data._jdf.queryExecution().optimizedPlan().toString()
    assert _rows(data, "id", "source_file") == [(1, "a b/x.csv"), (2, "a b/x.csv")]


def test_a_large_file_is_not_one_row(spark, scratch, monkeypatch):
    from fileflow.sources import csv
    write(f"{scratch}/in/lf.csv", "a,b\n" + "".join(f'{i},"x\r\n{i}"\n' for i in range(400)))
    write(f"{scratch}/in/dos.csv", "a,b\r\n" + "".join(f'{i},"x\r\n{i}"\r\n' for i in range(400)))
    write(f"{scratch}/in/wide.csv", "a,b\n" + "".join(f'{i},"é\n"\n' for i in range(400)), "utf-16")
    write(f"{scratch}/in/small.csv", 'a,b\n1,"y\n"\n')

    def rows():
        return sorted(map(tuple, read_csv(spark, f"{scratch}/in", root=f"{scratch}/in").data.select(
            "source_file", "row_id", "a", "b").collect()), key=str)

    want = rows()
    monkeypatch.setattr(csv, "WHOLE_MAX", 1000)
    assert rows() == want and len(want) == 1201
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{scratch}/in")
    held = csv.folder_chunks(spark, f"{scratch}/in", files).groupBy("path").agg(
        F.max(F.octet_length("content")).alias("n")).collect()
    most = {r.path.rsplit("/", 1)[1]: r.n for r in held}
    assert most["lf.csv"] == most["dos.csv"] == 1000 and most["wide.csv"] > 1000
