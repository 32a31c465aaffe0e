import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fileflow.sources import chunks, csv, ranges
from fileflow.sources.csv import read_csv
from tests.conftest import write


def odd_csv(seed: int, rows: int = 60) -> str:
    r = random.Random(seed)
    cells = ["", "plain", '"two\nlines"', '"say ""hi"""', '5" pipe', '"a,b"', '"\r\n"', "é漢😀",
             '""', '"x""\ny,"""', "NA", "  pad ", '"ab"c', "12", '" q "']
    out = ["id,Note One,other"]
    for i in range(rows):
        n = r.choice([2, 2, 2, 1, 3])
        out.append(",".join([str(i), *[r.choice(cells) for _ in range(n)]]))
        if r.random() < .1:
            out.append("")
    return r.choice(["\n", "\r\n"]).join(out) + r.choice(["", "\n"])


def plain_steps(data: bytes, state: int, delimiter: int):
    """The state after each byte, one byte after the other."""
    for c in data:
        if state == ranges.QUOTED:
            state = ranges.CLOSED if c == 34 else ranges.QUOTED
        elif c == 34 and state != ranges.MID:
            state = ranges.QUOTED
        else:
            state = {10: ranges.LINE, 13: ranges.CR, delimiter: ranges.FIELD}.get(c, ranges.MID)
    return state


def test_steps_equal_a_byte_by_byte_run():
    r = random.Random(2)
    for _ in range(3000):
        data = bytes(r.choice(b'"""",,\n\rab') for _ in range(r.randrange(1, 40)))
        want = "".join(str(plain_steps(data, s, 44)) for s in ranges.STATES)
        assert ranges.steps(np.frombuffer(data, np.uint8), 44) == want, data


@pytest.mark.parametrize("text", ["é漢😀" * 5, "a" * 20, "\U0010ffff" * 9])
def test_utf8_is_checked_across_chunk_edges(text):
    data = text.encode()
    for n in (16, 17, 18, 19):
        parts = [data[a:a + n] for a in range(0, len(data), n)]
        got = [ranges.utf8_edges(p, i == 0, i == len(parts) - 1) for i, p in enumerate(parts)]
        assert all(ok for _, _, ok in got) and got[0][0] == b"" and got[-1][1] == b""
        for (_, tail, _), (head, _, _) in zip(got, got[1:]):
            (tail + head).decode()


def table(result):
    cols = sorted(c for c in result.data.columns if c != "loaded_at")
    # the plain reader makes line breaks inside quotes LF
    return cols, sorted((tuple(x.replace("\r\n", "\n") if isinstance(x, str) else x for x in r)
                         for r in result.data.select(*cols).collect()), key=str)


def test_ranges_equal_the_whole_read(spark, scratch, monkeypatch):
    for i in range(3):
        write(f"{scratch}/in/f{i}.csv", odd_csv(i).replace("\r\n", "\n") + "\n")
    write(f"{scratch}/in/dos.csv", odd_csv(7, 20).replace("\r\n", "\n").replace("\n", "\r\n"))
    write(f"{scratch}/in/bom.csv", "a;b\n1;é\n2;\"x\n\ny\"\n", "utf-8-sig")
    write(f"{scratch}/in/old.csv", "name,city\nRené,Köln €\n\"a\nb\",c\n" * 3, "cp1252")
    write(f"{scratch}/in/empty.csv", "")
    whole = read_csv(spark, f"{scratch}/in", root=f"{scratch}/in")
    want, lines = table(whole), sorted(map(str, whole.rejects.collect()))
    for size in (29, 61, 400, 5000, 1 << 20):
        got = read_csv(spark, chunks.read_chunks(spark, f"{scratch}/in", size),
                       root=f"{scratch}/in")
        assert table(got) == want, size
        assert sorted(map(str, got.rejects.collect())) == lines
    write(f"{scratch}/in/wide.csv", "id,note one\n77,é\n", "utf-16")
    want = table(read_csv(spark, f"{scratch}/in", root=f"{scratch}/in"))
    monkeypatch.setattr(csv, "WHOLE_MAX", 600)             # large and small files of one folder
    assert table(read_csv(spark, f"{scratch}/in", root=f"{scratch}/in")) == want
    got = read_csv(spark, chunks.read_chunks(spark, f"{scratch}/in", 16), root=f"{scratch}/in")
    assert {r.source_file for r in got.rejects.where("reason like 'header%'").collect()} == {
        "f0.csv", "f1.csv", "f2.csv", "dos.csv"}


def test_one_file_is_read_by_many_tasks(spark, scratch):
    write(f"{scratch}/big.csv", "id,note\n" + "".join(f'{i},"a\n{i}"\n' for i in range(20000)))
    rows = chunks.read_chunks(spark, scratch, 1 << 14)
    assert rows.count() > 15 and rows.agg(F.max(F.length("content"))).first()[0] == 1 << 14
    got = read_csv(spark, rows).data
    assert got.count() == 20000 and got.agg(F.max("row_id")).first()[0] == 19999
    assert got.where("row_id <> id or note <> concat('a\n', id)").count() == 0


def test_utf16_and_missing_folder(spark, scratch):
    write(f"{scratch}/w.csv", "a,b\n1,2\n", "utf-16")
    got = read_csv(spark, chunks.read_chunks(spark, scratch))
    assert [r.reason for r in got.rejects.collect()] == ["UTF-16 cannot be read in ranges"]
    assert chunks.read_chunks(spark, f"{scratch}/nowhere").count() == 0


def test_digests(spark, scratch, monkeypatch):
    r = random.Random(4)
    files = {f"f{i}.bin": r.randbytes(n) for i, n in enumerate([1, 64, 1000, 5000])}
    for name, data in files.items():
        write(f"{scratch}/{name}", data)
    write(f"{scratch}/_hidden.csv", "x")
    monkeypatch.setattr(chunks, "FANOUT", 4)
    rows = chunks.read_chunks(spark, scratch, 64)
    assert rows.agg(F.max(F.length("content"))).first()[0] <= 64
    got = {x.path.rsplit("/", 1)[1]: x for x in chunks.digests(rows).collect()}
    assert got.keys() == files.keys()
    for name, data in files.items():
        x, nodes = got[name], [hashlib.sha256(data[a:a + 64]).hexdigest()
                               for a in range(0, len(data), 64)]
        assert (x.size_bytes, x.n_chunks) == (len(data), len(nodes))
        assert x.checksum_md5 == hashlib.md5(data).hexdigest()
        while len(nodes) > 1:
            nodes = [hashlib.sha256("".join(nodes[a:a + 4]).encode()).hexdigest()
                     for a in range(0, len(nodes), 4)]
        assert x.digest == nodes[0]
    whole = spark.read.format("binaryFile").load(scratch)
    cut = chunks.digests(chunks.chunked(whole, 64)).select("path", "checksum_md5", "digest")
    assert sorted(map(tuple, cut.collect())) == sorted(
        (x.path, x.checksum_md5, x.digest) for x in got.values())
    with pytest.raises(Exception, match="missing or repeated"):
        chunks.md5s(rows.where("offset <> 64")).collect()


def test_a_record_is_parsed_once(spark):
    rows = spark.createDataFrame([("a", 0, "1,x"), ("a", 0, "2,y,z"), ("a", 9, "3"),
                                  ("b", 0, "NA,")], "path string, block long, record string")
    good, rejects = csv._read_records(rows, ",", "id,name")
    clean = csv.drop_empty_rows(csv.null_na_tokens(good))
    plan = clean._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1
    assert sorted(map(tuple, clean.select("id", "name", "_block").collect())) == [
        ("1", "x", 0), ("3", None, 9)]
    assert [r.line for r in rejects.collect()] == ["2,y,z"]


def test_short_rows_of_a_large_file_go_to_many_tasks():
    tasks = chunks.deal([("a", 100 << 20, 1), ("b", 5, 2)], 1 << 15)
    assert max(sum(x[4] for x in t.ranges) for t in tasks) <= 16 << 20
    at = [x for t in tasks for x in t.ranges]
    assert sum(x[4] for x in at) == (100 << 20) + 5 and at[-1] == ("b", 5, 2, 0, 5)
