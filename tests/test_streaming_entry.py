import os

from pyspark.sql import functions as F

from fileflow.operators.table import SnapshotTable
from fileflow.streaming import changes
from fileflow.streaming.incremental import run_available
from fileflow.testing import workbook_bytes
from tests.conftest import write


def test_incremental_only_new_files(spark, scratch):
    src, cp = f"{scratch}/src", f"{scratch}/cp"
    tbl = SnapshotTable(spark, f"{scratch}/t")
    write(f"{src}/a.csv", "id,v\n1,a\n2,b\n")
    run_available(spark, src, tbl, cp, natural_keys=["id"])
    assert tbl.version() == 2           # create + one merge
    write(f"{src}/b.csv", "id,v\n2,B\n3,c\n")
    run_available(spark, src, tbl, cp, natural_keys=["id"])
    assert sorted((r.id, r.v) for r in tbl.read().collect()) == [(1, "a"), (2, "B"), (3, "c")]
    last = tbl.head()
    assert (last.inserted, last.updated) == (1, 1)   # only b.csv was delivered
    run_available(spark, src, tbl, cp, natural_keys=["id"])
    assert tbl.version() == 3           # nothing new: no commit


def test_changed_files_are_delivered_again(spark, scratch):
    src, cp = f"{scratch}/src", f"{scratch}/cp"
    tbl = SnapshotTable(spark, f"{scratch}/t")
    args = dict(natural_keys=["id"], changed=True, chunk_bytes=16)
    write(f"{src}/a.csv", "id,v\n" + "".join(f'{i},"a\n{i}"\n' for i in range(20)))
    write(f"{src}/b.csv", "id,v\n100,b\n")
    write(f"{src}/c.xlsx", workbook_bytes([("S", [["id", "v"], [200, "book"]])]))
    write(f"{src}/_part.csv", "id,v\n300,hidden\n")
    run_available(spark, src, tbl, cp, **args)
    assert (tbl.head().inserted, tbl.head().updated) == (22, 0)
    run_available(spark, src, tbl, cp, **args)
    assert tbl.version() == 2                       # nothing new: no commit
    write(f"{src}/b.csv", "id,v\n100,b2\n101,new\n")
    os.remove(f"{src}/c.xlsx")
    run_available(spark, src, tbl, cp, **args)
    assert (tbl.head().inserted, tbl.head().updated) == (1, 1)      # b.csv alone
    got = {r.id: r.v for r in tbl.read().collect()}
    assert got == {**{i: f"a\n{i}" for i in range(20)}, 100: "b2", 101: "new", 200: "book"}
    assert len(os.listdir(f"{cp}-listings")) <= 2   # older listings are gone


def test_a_file_that_changes_while_it_is_read(spark, scratch):
    path = write(f"{scratch}/in/a.csv", "x" * 100)
    r = changes.ChangeReader({"path": f"{scratch}/in", "log": f"{scratch}/log", "chunkBytes": "40"})
    end = r.latestOffset()
    parts = r.partitions({"listing": 0}, end)
    assert [x[3:] for x in parts[0].ranges] == [(0, 40), (40, 40), (80, 20)]
    rows = [tuple(y[0] for y in b.to_pydict().values()) for b in r.read(parts[0])]
    schema = "path string, size_bytes long, modified_at timestamp, offset long, content binary"
    assert changes.settled(spark.createDataFrame(rows, schema)).count() == 3
    assert changes.settled(spark.createDataFrame(rows[1:], schema)).count() == 0
    write(path, "y" * 101)
    assert list(r.read(parts[0])) == []             # not as listed any more
    again = r.latestOffset()
    assert again["listing"] == end["listing"] + 1 and r.partitions(end, again)
    assert r.latestOffset() == again and r.partitions(again, again) == []


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_settled_leaves_chunks_in_their_tasks(spark):
    rows = [("a", 6, 0, b"abc"), ("a", 6, 3, b"def"), ("b", 9, 0, b"abc")] \
        + [("c", 300, 3 * i, b"xyz") for i in range(100)]
    part = spark.createDataFrame(rows, "path string, size_bytes long, offset long, content binary")
    found = changes.settled(part.repartition(8))
    assert found.groupBy("path").count().orderBy("path").collect() == [("a", 2), ("c", 100)]
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    in_task = found.where("path = 'c'").groupBy(F.spark_partition_id()).count().count()
    assert in_task == 8
