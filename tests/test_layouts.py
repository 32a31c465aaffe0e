import random

import pytest
from pyspark.sql import functions as F

from fileflow.sources import csv, layouts
from fileflow.sources.csv import read_csv
from tests.conftest import write


def files_of(root, n, seed=3):
    """n files, each with a header of its own, odd cells, short and long lines."""
    r = random.Random(seed)
    odd = ["", "plain", '"say ""hi"""', '5" pipe', '"a{d}b"', "é漢😀", '""', '"ab"c', '"ab"c"',
           ' "q"', "12", "NA", '"two\nlines"']
    for k in range(n):
        d = ",;|\t"[k % 4]
        names = ["id", f"Only {k}", "Shared", f"mod-{k % 5}"]
        r.shuffle(names)
        rows = [d.join(names)]
        for i in range(6):
            row = [r.choice(odd).replace("{d}", d) for _ in range(r.choice([4, 4, 4, 3, 5]))]
            rows.append(d.join(row if any(row) else ["x", *row[1:]]))
        text = "\n".join(rows) + "\n"
        write(root / f"f{k:03d}.csv", text.encode("utf-16") if k == 7 else text.encode())
    write(root / "empty.csv", b"")


def content(result):
    cols = sorted(c for c in result.data.columns if c != "loaded_at")
    key = lambda x: tuple(map(repr, x))                                          # noqa: E731
    return (cols, sorted(map(tuple, result.data.select(*[F.col(f"`{c}`") for c in cols]).collect()),
                         key=key),
            sorted(map(tuple, result.rejects.select("source_file", "line", "reason").collect()),
                   key=key))


@pytest.mark.parametrize("broadcast", [True, False])
def test_one_plan_equals_a_read_for_each_layout(spark, tmp_path, monkeypatch, broadcast):
    files_of(tmp_path, 20)
    monkeypatch.setattr(csv, "MAX_LAYOUT_READS", 1000)
    want = content(read_csv(spark, str(tmp_path), root=str(tmp_path)))
    monkeypatch.setattr(csv, "MAX_LAYOUT_READS", 0)
    if not broadcast:
        monkeypatch.setattr(layouts, "MAX_BROADCAST_CELLS", 0)
    got = read_csv(spark, str(tmp_path), root=str(tmp_path))
    assert got.groups == 20 and content(got) == want


def test_the_plan_does_not_grow_with_the_layouts(spark, tmp_path):
    sizes = []
    for n in (20, 80):
        root = tmp_path / str(n)
        for k in range(n):
            names = ["a", "b", "c", "d", "e"]
            random.Random(k).shuffle(names)
            write(root / f"f{k}.csv", f"{','.join(names)}\n1,2,3,4,5\n".encode())
        r = read_csv(spark, str(root))
        assert r.data.count() == n and r.groups > csv.MAX_LAYOUT_READS
        sizes.append(len(r.data._jdf.queryExecution().optimizedPlan().toString().splitlines()))
    assert sizes[0] == sizes[1]


@pytest.mark.parametrize("record,want", [
    ("", [None]), (",", [None, None]), ("a,", ["a", None]), ('"","x"', ["", "x"]),
    ('"a,b",c', ["a,b", "c"]), ('"a""b"', ['a"b']), ('a"b,c', ['a"b', "c"]), (" x ,y", [" x ", "y"])])
def test_cells(spark, record, want):
    for d in ",;|\t":
        row = spark.range(1).select(layouts.cells(F.lit(record.replace(",", d)), F.lit(d)).alias("c"))
        assert row.first().c == [w.replace(",", d) if w else w for w in want]


def test_many_doubled_quotes(spark):
    row = spark.range(1).select(layouts.cells(
        F.concat(F.lit('"'), F.repeat(F.lit('x""'), 200_000), F.lit('",z')), F.lit(",")).alias("c"))
    c = row.first().c
    assert len(c) == 2 and len(c[0]) == 400_000 and c[1] == "z"
