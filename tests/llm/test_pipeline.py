import pytest

import corpus_pipeline as cp
from fileflow.llm import common, minhash, quality
from fileflow.llm.queries import ORACLE, QUERIES
from fileflow.session import scratch_path

from .conftest import prose


@pytest.fixture(scope="module")
def folder(spark):
    d = scratch_path(spark, "pipe")
    bench = prose(900, 40)
    rows = []
    for k in range(120):
        good = prose(k, 60)
        rows.append((k, good if k % 4 else " ".join(w.upper() + "!!" for w in good.split())))
    rows += [(200, prose(1, 60)), (201, prose(5, 60) + " tail"), (202, prose(700, 30) + " " + bench),
             (203, prose(701, 50) + " mail me at a.b@site.org now"), (None, prose(702, 50))]
    docs = [(i, t, "en", "src", len(t)) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(120)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(
        f"{d}/benchmark.parquet")
    return d


def test_stages_decide(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, step = docs.columns, {}
    for name, stage in cp.STAGES:
        before = docs
        docs = cp.materialize(stage(spark, docs, folder), "t")
        step[name] = (before, docs)
        if name != cp.STAGES[-1][0]:
            assert docs.columns == columns
    ids = {k: [{r.doc_id for r in x.select("doc_id").collect()} for x in v] for k, v in step.items()}
    assert ids["quality"][0] - ids["quality"][1] == set(range(0, 120, 4))
    assert ids["near_dedup"][0] - ids["near_dedup"][1] == {200, 201}
    assert ids["decontaminate"][0] - ids["decontaminate"][1] == {202}
    text = step["pii"][1].where("doc_id = 203").first()
    assert text.text.endswith("mail me at [EMAIL] now") and text.n_chars == len(text.text)
    assert None in ids["tokens"][1]
    assert sorted(map(str, cp.run(spark, folder).collect())) == sorted(map(str, docs.collect()))


def test_repeated_rows_of_a_kept_id(spark, folder):
    rows = [(1, "a b c d e f g", 1), (1, "a b c d e f g", 2), (2, "a b c d e f g", 3), (3, "", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra int")
    got = cp.near_dedup_stage(spark, docs, folder).collect()
    assert sorted(r.doc_id for r in got) == [1, 3]


@pytest.fixture
def no_small_tables(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, old)


def test_kept_texts_do_not_move_when_copies_go(spark, folder, no_small_tables):
    rows = [(k, prose(k % 30, 40)) for k in range(60)] + [(None, prose(1, 40)), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = common.materialize(docs, "t")
    out = cp.near_dedup_stage(spark, docs, folder)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" not in plan and "SortMergeJoin" not in plan
    want = [*range(30), None, None]
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(map(str, want))


def test_many_ids_to_go(spark, folder, monkeypatch, no_small_tables):
    rows = [(prose(k % 30, 40), k) for k in range(60)] + [(prose(1, 40), None), (None, None)]
    docs = common.materialize(spark.createDataFrame(rows, "text string, doc_id long"), "t")
    few = cp.near_dedup_stage(spark, docs, folder)
    monkeypatch.setattr(common, "BROADCAST_IDS", 0)
    many = cp.near_dedup_stage(spark, docs, folder)
    assert many.columns == docs.columns and sorted(map(str, many.collect())) == sorted(
        map(str, few.collect()))


@pytest.mark.parametrize("maps, most", [(2048, 120), (1, 500)])
def test_among_loses_no_id(spark, monkeypatch, maps, most):
    monkeypatch.setattr(common, "ID_MAPS", maps)
    rows = [(k, "x") for k in [*range(4000), *range(5), None, None]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = spark.createDataFrame([(k,) for k in [*range(0, 4000, 4), *range(10_000, 13_000)]],
                                "g long")
    maybe, rest = (x.collect() for x in common.among(docs, "doc_id", ids, "g"))
    assert sorted(map(str, map(tuple, [*maybe, *rest]))) == sorted(map(str, rows))
    found = {r.doc_id for r in maybe}
    assert set(range(0, 4000, 4)) <= found and None not in found
    assert len(found) <= 1000 + most


def test_registered():
    assert [n for n in QUERIES if n.startswith("op")] and {int(n[2:].split("_")[0]) for n in QUERIES} \
        == set(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
    assert minhash.MAX_DISTANCE == 27 and quality.SAMPLE == 3000
