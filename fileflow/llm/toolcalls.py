"""Chat formatting: tool-call linking (operator 2), DataFrame functions only.

Messages are rows (conv_id, turn, role, text). An ``assistant`` text may hold calls,
``{"tool_calls": [{"id": .., "name": .., "arguments": {..}}, ..]}``; a ``tool`` text holds a
result, ``{"tool_call_id": .., "content": ..}``. Calls and results are joined by
(conv_id, identifier). An argument ``"$<id>"`` refers to the result of another call of the
conversation; calls are ordered topologically by such references: level 0 refers to nothing,
level n to a call of level n - 1 and none higher. Arguments are checked against schemas, and
every linked call is written as canonical JSON: sorted keys, no spaces, normal numbers.

One row per call and per result without a call. ``status``:
ok, missing_result, duplicate_id (a later call with an identifier already used in the
conversation), no_id, orphan_result. ``errors`` lists schema errors in order: unknown_tool,
arguments_not_object, missing:<parameter>, unknown:<parameter>, type:<parameter>,
unresolved:<id>, cycle.

Defined cases: null or malformed texts and other roles hold no calls; null conversation or call
identifiers never link; of repeated results for one call the first by turn counts (ties: the
smaller content); rows that repeat a message (same conversation, turn and place) are one call, give
a row each and are linked alike (if their arguments differ, by the references of all); calls on or behind a cycle have a null level and the error ``cycle``;
other input columns are dropped; a call without schema row gets unknown_tool. Numbers are those of
Spark's variant: up to 38 digits are kept, longer ones become the nearest double, one beyond its
range the string "Infinity". A text with a key twice in one object is malformed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

_MESSAGE = ("tool_calls array<struct<id: string, name: string, arguments: variant>>, "
            "tool_call_id string, content variant")
#: JSON types that fit each schema type, as variant type names.
_FITS = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DOUBLE|DECIMAL.*)",
         "boolean": "BOOLEAN", "array": "ARRAY<.*", "object": "OBJECT<.*"}


def parse(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls (conv_id, turn, idx, call_id, name, arguments) and results (conv_id, turn,
    call_id, content)."""
    m = messages.select("conv_id", "turn", "role", F.from_json("text", _MESSAGE).alias("m"))
    calls = (m.where("role = 'assistant' and size(m.tool_calls) > 0")
             .select("conv_id", "turn", F.posexplode("m.tool_calls").alias("idx", "c"))
             .where("c is not null")
             .select("conv_id", "turn", "idx", F.col("c.id").alias("call_id"), "c.name",
                     "c.arguments"))
    results = (m.where("role = 'tool' and m.tool_call_id is not null")
               .select("conv_id", "turn", F.col("m.tool_call_id").alias("call_id"),
                       F.to_json("m.content").alias("content")))
    return calls, results


def chains(waiting: DataFrame) -> DataFrame:
    """(conv_id, call_id, anc, dist, open) of the calls that refer to exactly one other: the
    first call up the chain that does not, and the steps to it, by pointer doubling (rounds
    grow with the logarithm of a chain's length). ``open``: the chain ends in a cycle."""
    key = ["conv_id", "call_id"]
    jump = materialize(waiting.where("size(needs) = 1").select(
        *key, F.col("needs")[0].alias("anc"), F.lit(1).alias("dist"), F.lit(True).alias("open")),
        "tc-chain")
    last = None
    while True:
        up = jump.select("conv_id", F.col("call_id").alias("anc"), F.col("anc").alias("anc2"),
                         F.col("dist").alias("dist2"))
        jump = materialize(jump.join(up, ["conv_id", "anc"], "left").select(
            *key, F.coalesce("anc2", "anc").alias("anc"),
            (F.col("dist") + F.coalesce("dist2", F.lit(0))).alias("dist"),
            F.col("anc2").isNotNull().alias("open")), "tc-chain")
        left = jump.where("open").count()
        if left in (0, last):            # each round settles some, unless all are in cycles
            return jump
        last = left


def levels(nodes: DataFrame, waiting: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of all calls that no cycle holds back.

    ``waiting``: (conv_id, call_id, needs) of the calls that refer to others. Chains of calls
    with one reference each are first jumped over. Then each round takes the calls that have
    got their level out of the lists of those with several references that wait for them; so
    there is one small table for each such call on the longest path, not for each call.
    """
    key = ["conv_id", "call_id"]
    chain = chains(waiting)
    roots = nodes.select(*key).join(waiting, key, "left_anti").select(*key, F.lit(0).alias("level"))
    front = materialize(roots, "tc-level")
    parts = [front]
    link = chain.where("not open").select("conv_id", F.col("call_id").alias("need"), "anc", "dist")
    many = (waiting.where("size(needs) > 1").select(*key, F.explode("needs").alias("need"))
            .join(link, ["conv_id", "need"], "left").groupBy(*key)
            .agg(F.collect_set(F.struct(F.coalesce("anc", "need").alias("anc"), (
                F.coalesce("dist", F.lit(0)) + 1).alias("dist"))).alias("needs"))
            .select(*key, "needs", F.lit(0).alias("top")))
    many = materialize(many, "tc-level")
    while not many.isEmpty() and not front.isEmpty():
        got = front.select("conv_id", F.col("call_id").alias("anc"), "level")
        step = materialize(
            many.select(*key, "top", F.explode("needs").alias("n"))
            .select(*key, "top", "n", F.col("n.anc").alias("anc"))
            .join(got, ["conv_id", "anc"], "left").groupBy(*key)
            .agg(F.collect_set(F.when(F.col("level").isNull(), F.col("n"))).alias("needs"),
                 F.greatest(F.max("top"), F.max(F.col("level") + F.col("n.dist"))).alias("top")),
            "tc-level")
        front = step.where("size(needs) = 0").select(*key, F.col("top").alias("level"))
        many = step.where("size(needs) > 0")
        parts.append(front)
    known = materialize(reduce(DataFrame.union, parts), "tc-level")
    tail = (chain.where("not open")
            .join(known.select("conv_id", F.col("call_id").alias("anc"), "level"),
                  ["conv_id", "anc"]).select(*key, (F.col("level") + F.col("dist")).alias("level")))
    return known.union(tail)


def _errors() -> str:
    """SQL: schema errors of a call with ``params`` (null: unknown tool) and ``args``."""
    fits = " ".join(f"when '{t}' then k rlike '^{p}$'" for t, p in _FITS.items())
    return (
        "case when params is null then array('unknown_tool') "
        "when args is null then array('arguments_not_object') else concat("
        "transform(filter(params, p -> p.required and not map_contains_key(args, p.param)), "
        "p -> concat('missing:', p.param)), "
        "array_sort(transform(filter(map_keys(args), a -> not exists(params, p -> p.param = a)), "
        "a -> concat('unknown:', a))), "
        "transform(filter(params, p -> map_contains_key(args, p.param) and not "
        "element_at(transform(array(schema_of_variant(element_at(args, p.param))), k -> "
        f"case p.type {fits} else false end), 1)), p -> concat('type:', p.param))) end")


def link(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, turn, idx, call_id, name, status, level, errors, json).

    ``schemas``: (name, param, type, required), one row per parameter; types string, integer,
    number, boolean, array, object.
    """
    calls, results = parse(messages)
    calls = materialize(calls, "tc-call")
    tools = (schemas.groupBy("name").agg(F.array_sort(F.collect_set(
        F.struct("param", "type", F.coalesce("required", F.lit(False)).alias("required"))))
        .alias("params")))

    first = (calls.where("conv_id is not null and call_id is not null")
             .groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "idx")).alias("first")))
    named = (calls.join(first, ["conv_id", "call_id"], "left")
             .withColumn("chosen", F.coalesce(F.struct("turn", "idx") == F.col("first"),
                                              F.lit(False))))
    answer = (results.where("conv_id is not null").groupBy("conv_id", "call_id")
              .agg(F.min(F.struct("turn", "content")).alias("r"))
              .withColumn("chosen", F.lit(True)))
    rows = named.join(answer, ["conv_id", "call_id", "chosen"], "left").join(tools, "name", "left")
    rows = rows.withColumn("args", F.when(
        F.expr("schema_of_variant(arguments) like 'OBJECT<%'"),
        F.expr("from_json(to_json(arguments), 'map<string, variant>')")))
    needs = F.expr(
        "case when chosen and args is not null then array_distinct(transform(filter("
        "transform(map_values(args), a -> if(schema_of_variant(a) = 'STRING', "
        "try_variant_get(a, '$', 'string'), '')), a -> a like '$%'), a -> substring(a, 2))) "
        "else cast(array() as array<string>) end")
    rows = rows.withColumn("errors", F.expr(_errors())).withColumn("needs", needs)
    rows = materialize(rows.drop("params", "args", "first"), "tc-row")

    key = ["conv_id", "call_id"]
    # copies of a row are one call
    nodes = rows.where("chosen").groupBy(*key).agg(
        F.array_distinct(F.flatten(F.collect_set("needs"))).alias("needs"))
    there = nodes.select("conv_id", F.col("call_id").alias("need"), F.lit(1).alias("there"))
    asked = materialize(
        nodes.select(*key, F.explode("needs").alias("need"))
        .join(there, ["conv_id", "need"], "left").groupBy(*key)
        .agg(F.collect_set(F.when(F.col("there") == 1, F.col("need"))).alias("needs"),
             F.array_sort(F.collect_set(F.when(F.col("there").isNull(), F.concat(
                 F.lit("unresolved:"), "need")))).alias("lost")), "tc-need")
    level = levels(nodes, asked.where("size(needs) > 0").select(*key, "needs"))
    rows = (rows.join(level.withColumn("chosen", F.lit(True)), [*key, "chosen"], "left")
            .join(asked.select(*key, "lost", F.lit(True).alias("chosen")), [*key, "chosen"],
                  "left"))
    status = (F.when(F.col("conv_id").isNull() | F.col("call_id").isNull(), "no_id")
              .when(~F.col("chosen"), "duplicate_id").when(F.col("r").isNull(), "missing_result")
              .otherwise("ok"))
    errors = F.concat("errors", F.coalesce("lost", F.array().cast("array<string>")),
                      F.when(F.col("chosen") & F.col("level").isNull(), F.array(F.lit("cycle")))
                      .otherwise(F.array().cast("array<string>")))
    whole = F.concat(
        F.lit('{"arguments":'), F.coalesce(F.to_json("arguments"), F.lit("null")),
        F.lit(',"id":'), F.coalesce(F.expr("to_json(cast(call_id as variant))"), F.lit("null")),
        F.lit(',"name":'), F.coalesce(F.expr("to_json(cast(name as variant))"), F.lit("null")),
        F.lit(',"result":'), F.coalesce("r.content", F.lit("null")), F.lit("}"))
    out = rows.select("conv_id", "turn", "idx", "call_id", "name", status.alias("status"),
                      "level", F.array_join(errors, ",").alias("errors"), whole.alias("json"))
    orphans = (results.join(first, ["conv_id", "call_id"], "left_anti")
               .select("conv_id", "turn", F.lit(0).alias("idx"), "call_id",
                       F.lit(None).cast("string").alias("name"),
                       F.lit("orphan_result").alias("status"),
                       F.lit(None).cast("int").alias("level"), F.lit("").alias("errors"),
                       F.concat(F.lit('{"id":'), F.expr("to_json(cast(call_id as variant))"),
                                F.lit(',"result":'), F.coalesce("content", F.lit("null")),
                                F.lit("}")).alias("json")))
    return out.unionByName(orphans)
