import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fileflow.operators import lattice
from fileflow.operators.table import SnapshotTable
from fileflow.sources.csv import read_csv
from tests.conftest import write


def text_type(spark, values, splits=1):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    if splits == 1:
        return lattice.resolve(df.agg(*lattice.state(["v"])).first(), 0)
    parts = df.withColumn("p", F.monotonically_increasing_id() % splits).groupBy("p") \
        .agg(*lattice.state(["v"]))
    return lattice.resolve(parts.agg(*lattice.merged(1)).first(), 0)


@pytest.mark.parametrize("values, want", [
    (["1", " 2 ", None, "+3"], "bigint"), (["9223372036854775807"], "bigint"),
    (["9223372036854775808", "1"], "decimal(38,0)"),
    (["123456789012345678901234", "-5"], "decimal(38,0)"), (["1" * 39], None),
    (["1.5", "2"], "double"), (["0.30000000000000004"], "double"), (["1e300", "inf"], "double"),
    (["5.684341886080802E-14", "2.2250738585072014E-308"], "double"),
    (["1.2345678901234567890", "7"], "decimal(38,18)"), (["9007199254740993.5"], "decimal(38,1)"),
    (["123456789012345678901234", "0.5"], "decimal(38,1)"),
    (["1.12345678901234567890123456789", "12345678901234567890"], None),
    (["1.2345678901234567890e5"], None), (["true", "FALSE"], "boolean"), (["true", "1"], None),
    (["12D"], None), ([None], None), ([], None), ([""], None)])
def test_types_keep_every_value(spark, values, want):
    assert text_type(spark, values) == want
    assert text_type(spark, values, 3) == want


def test_doubles_in_their_shortest_text_stay_doubles(spark):
    r = random.Random(8)
    values = [repr(r.uniform(-1, 1) * 10 ** r.randrange(-20, 20)) for _ in range(2000)]
    assert text_type(spark, values) == "double"


def test_long_digits_in_files_and_tables(spark, scratch):
    write(f"{scratch}/a.csv", "account,x\n123456789012345678901234,1\n123456789012345678901235,2\n")
    got = read_csv(spark, scratch).data
    assert sorted(r.account for r in got.collect()) == [
        Decimal("123456789012345678901234"), Decimal("123456789012345678901235")]
    t = SnapshotTable(spark, f"{scratch}/t")
    t.append(spark.createDataFrame([(9007199254740993, "a"), (2, "b")], "k long, v string"))
    t.upsert(spark.createDataFrame([(1.5, "c"), (2.0, "B")], "k double, v string"), ["k"])
    assert sorted((str(r.k.normalize()), r.v) for r in t.read().collect()) == [
        ("1.5", "c"), ("2", "B"), ("9007199254740993", "a")]
    t = SnapshotTable(spark, f"{scratch}/small")
    t.append(spark.createDataFrame([(7,)], "k long"))
    t.append(spark.createDataFrame([(1.5,)], "k double"))
    assert dict(t.read().dtypes)["k"] == "double"
    t = SnapshotTable(spark, f"{scratch}/far")
    t.append(spark.createDataFrame([(9007199254740993,)], "k long"))
    t.append(spark.createDataFrame([(1e300,)], "k double"))
    assert sorted(r.k for r in t.read().collect()) == ["1.0E300", "9007199254740993"]
