import hashlib

from pyspark.sql import functions as F

from fileflow.functions.dates import parse_timestamp
from fileflow.functions.hashing import md5_hex, sha256_hex
from fileflow.functions.paths import base_name, extension, file_name, parent_path, relative_path
from fileflow.functions.strings import normalize_name, normalize_names, unicode_strip


def test_normalize_basic():
    assert normalize_names(["Employee ID", "Full Name", "Hire Date"]) == \
        ["employee_id", "full_name", "hire_date"]
    assert normalize_name("  Name  ") == "name"
    assert normalize_name("Start-Date/Time") == "start_date_time"


def test_normalize_awkward_headers():
    # survey Q3: '' -> col_<i>, duplicates -> _2, Unicode letters kept, dots dropped
    assert normalize_names(["%", "a", "A", "a.1", "Région", None]) == \
        ["col_0", "a", "a_2", "a1", "région", "col_5"]


def test_unicode_strip(spark):
    df = spark.createDataFrame([(" \t x y  ",), ("　z\n",), ("   ",), (None,)], "s string")
    got = [r[0] for r in df.select(unicode_strip("s")).collect()]
    assert got == ["x y", "z", "", None]


def test_parse_timestamp_formats(spark):
    df = spark.createDataFrame([("2024-01-05",), ("01/02/2024",), ("2024-01-05 10:30:00",),
                                ("2024-01-05T10:30:00.5",), ("junk",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_timestamp("s").alias("t")).collect()]
    assert [g.isoformat() if g else None for g in got] == [
        "2024-01-05T00:00:00", "2024-01-02T00:00:00", "2024-01-05T10:30:00",
        "2024-01-05T10:30:00.500000", None, None]


def test_parse_timestamp_epoch_ns(spark):
    df = spark.createDataFrame([(1_704_067_200_000_000_000,)], "n long")
    t = df.select(parse_timestamp("n", dtype=df.schema["n"].dataType)).first()[0]
    assert t.isoformat() == "2024-01-01T00:00:00"


def test_hashes_match_hashlib(spark):
    data = [b"", b"hello", b"\x00\xff" * 100, "héllo".encode()]
    df = spark.createDataFrame([(bytearray(b),) for b in data], "b binary")
    rows = df.select(md5_hex("b"), sha256_hex("b")).collect()
    for b, r in zip(data, rows):
        assert r[0] == hashlib.md5(b).hexdigest()
        assert r[1] == hashlib.sha256(b).hexdigest()
        assert len(r[1]) == 64
    assert rows[0][0] == "d41d8cd98f00b204e9800998ecf8427e"


def test_path_parts(spark):
    df = spark.createDataFrame([("file:/data/in/sub/Report.Final.XLSX",), ("/data/in/noext",)],
                               "p string")
    r = df.select(file_name("p"), extension("p"), base_name("p"), parent_path("p"),
                  relative_path("p", "/data/in")).collect()
    assert tuple(r[0]) == ("Report.Final.XLSX", ".xlsx", "Report.Final", "file:/data/in/sub",
                           "sub/Report.Final.XLSX")
    assert tuple(r[1])[:3] == ("noext", "", "noext")
