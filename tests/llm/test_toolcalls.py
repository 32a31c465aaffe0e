import json

import pytest

from fileflow.llm import toolcalls

SCHEMA = "conv_id long, turn long, role string, text string, level string, json string"
TOOLS = [("add", "a", "integer", True), ("add", "b", "number", True), ("add", "note", "string", False),
         ("find", "q", "string", True), ("find", "opts", "object", False),
         ("find", "tags", "array", None), ("find", "deep", "boolean", False)]


def call(*calls):
    return json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments"), c)) for c in calls]})


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


@pytest.fixture(scope="module")
def rows(spark):
    msgs = [
        (1, 0, "user", "hi"), (1, 1, "assistant", call(("x", "add", {"b": 1.50, "a": 2}),
                                                       ("y", "find", {"q": "$x", "opts": {"z": 1, "k": []}}))),
        (1, 2, "tool", result("x", {"v": 3, "e": "é\n"})), (1, 3, "tool", result("y", [1, "2"])),
        (1, 4, "tool", result("x", "late")), (1, 5, "assistant", call(("x", "add", {"a": 1, "b": 1}))),
        (1, 6, "assistant", call(("z", "find", {"q": "$y", "deep": "no", "extra": 1, "tags": "t"}))),
        (2, 0, "assistant", call(("x", "nope", {}))), (2, 1, "tool", result("gone", None)),
        (2, 2, "assistant", call(("p", "find", {"q": "$q1"}), ("q1", "find", {"q": "$p"}),
                                 ("r", "find", {"q": "$p"}), ("s", "find", {"q": "$void"}))),
        (2, 3, "assistant", call((None, "find", {"q": "a"}), ("t", "add", [1]), ("u", "add", {}))),
        (None, 0, "assistant", call(("x", "find", {"q": "a"}))), (3, 0, "assistant", None),
        (3, 1, "assistant", "{bad"), (3, 2, "tool", "[]"), (3, 3, None, "{}"), (3, 4, "tool", ""),
    ]
    msgs = [(*m, "own", "own") for m in msgs]
    tools = spark.createDataFrame(TOOLS, "name string, param string, type string, required boolean")
    return toolcalls.link(spark.createDataFrame(msgs, SCHEMA), tools).collect()


def one(rows, conv, turn, idx=0):
    return next(r for r in rows if (r.conv_id, r.turn, r.idx) == (conv, turn, idx))


def test_linking_order_and_canonical_json(rows):
    x, y, z = one(rows, 1, 1, 0), one(rows, 1, 1, 1), one(rows, 1, 6)
    assert (x.status, x.level, x.errors) == ("ok", 0, "")
    assert x.json == '{"arguments":{"a":2,"b":1.5},"id":"x","name":"add","result":{"e":"é\\n","v":3}}'
    assert (y.status, y.level) == ("ok", 1)
    assert '"opts":{"k":[],"z":1}' in y.json and '"result":[1,"2"]' in y.json
    assert (z.status, z.level) == ("missing_result", 2)
    assert z.errors == "unknown:extra,type:deep,type:tags"
    assert one(rows, 1, 5).status == "duplicate_id"


def test_faults(rows):
    assert one(rows, 2, 0).errors == "unknown_tool"
    assert one(rows, 2, 1).status == "orphan_result"
    assert [one(rows, 2, 2, i).errors for i in range(4)] == ["cycle", "cycle", "cycle", "unresolved:void"]
    assert [one(rows, 2, 2, i).level for i in range(4)] == [None, None, None, 0]
    assert one(rows, 2, 3, 0).status == "no_id" and one(rows, None, 0).status == "no_id"
    assert one(rows, 2, 3, 1).errors == "arguments_not_object"
    assert one(rows, 2, 3, 2).errors == "missing:a,missing:b"
    assert not [r for r in rows if r.conv_id == 3]


def test_empty(spark):
    tools = spark.createDataFrame([], "name string, param string, type string, required boolean")
    assert toolcalls.link(spark.createDataFrame([], SCHEMA), tools).count() == 0


def test_levels_of_long_chains_and_forks(spark):
    import random
    r, needs = random.Random(6), {}
    for c in range(4):
        for k in range(120):
            old = [f"n{j}" for j in range(k)]
            if c == 0:
                needs[c, f"n{k}"] = old[-1:]                       # one chain
            else:
                needs[c, f"n{k}"] = r.sample(old, min(k, r.choice([0, 1, 1, 1, 2, 3])))
    for k in range(5):                                             # a cycle with a tail
        needs[9, f"n{k}"] = [f"n{(k + 1) % 4}"]
    want = {}

    def level(c, i):
        if (c, i) not in want:
            want[c, i] = 1 + max((level(c, x) for x in needs[c, i]), default=-1)
        return want[c, i]

    for c, i in needs:
        if c != 9:
            level(c, i)
    nodes = spark.createDataFrame([(c, i) for c, i in needs], "conv_id long, call_id string")
    waiting = spark.createDataFrame([(c, i, n) for (c, i), n in needs.items() if n],
                                    "conv_id long, call_id string, needs array<string>")
    got = toolcalls.levels(nodes, waiting).collect()
    assert {(x.conv_id, x.call_id): x.level for x in got} == want and len(got) == len(want)


@pytest.mark.parametrize("copies", [2, 3])
def test_repeated_rows_stay_as_many(spark, copies):
    msgs = [(1, 0, "assistant", call(("x", "find", {"q": "a"}))),
            (1, 1, "assistant", call(("y", "find", {"q": "$x"}))),
            (1, 2, "assistant", call(("z", "find", {"q": "$y", "opts": {"p": "$x"}, "tags": []}))),
            (1, 3, "tool", result("x", 1)), (1, 4, "tool", result("gone", 2))]
    rows = [(*m, "own", "own") for m in msgs for _ in range(copies)]
    tools = spark.createDataFrame(TOOLS, "name string, param string, type string, required boolean")
    got = toolcalls.link(spark.createDataFrame(rows, SCHEMA), tools).collect()
    assert sorted((r.call_id, r.status, r.level) for r in got if r.level is not None) == sorted(
        [("x", "ok", 0), ("y", "missing_result", 1), ("z", "missing_result", 2)] * copies)
    assert [r.status for r in got if r.level is None] == ["orphan_result"] * copies


def test_numbers_and_repeated_keys(spark):
    text = '{"tool_calls": [{"id": "a", "name": "add", "arguments": {"a": %s, "b": 1}}]}'
    rows = [(i, 0, "assistant", text % x, "", "") for i, x in enumerate(
        ["1E400", "1" * 45, "1" * 38, '1, "a": 2'])]
    tools = spark.createDataFrame(TOOLS, "name string, param string, type string, required boolean")
    got = {r.conv_id: r for r in toolcalls.link(spark.createDataFrame(rows, SCHEMA), tools).collect()}
    assert '"a":"Infinity"' in got[0].json
    assert '"a":1.1111111111111112E44' in got[1].json or '"a":1.111111111111111E44' in got[1].json
    assert '"a":' + "1" * 38 in got[2].json
    assert 3 not in got or '"arguments":null' in got[3].json
