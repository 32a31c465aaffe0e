"""Driver queries of the training-data operators, with their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    backoff,
    bpe,
    decontam,
    langid,
    merkle,
    minhash,
    nndescent,
    periods,
    pii,
    quality,
    rlbwt,
    toolcalls,
    unigram,
)
from .common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    """Path of a public vocabulary file, from the installed package that carries them."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


#: Schema of the tool that the derived messages call.
REPLY = [("reply", "after", "string", False), ("reply", "text", "string", True),
         ("reply", "turn", "integer", True), ("reply", "urgent", "boolean", False)]


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Tool messages derived from a chat: each user turn is a call of ``reply`` that refers to
    the call two turns before it, each assistant turn is the result for the turn before it."""
    call_id = F.concat(F.lit("call_"), "conv_id", F.lit("_"), "turn")
    args = F.to_json(F.struct(
        F.col("turn"), F.coalesce("text", F.lit("")).alias("text"),
        F.when(F.col("turn") >= 2, F.concat(F.lit("$call_"), "conv_id", F.lit("_"),
                                            F.col("turn") - 2)).alias("after")))
    calls = conversations.where("role = 'user'").select(
        "conv_id", "turn", F.lit("assistant").alias("role"),
        F.concat(F.lit('{"tool_calls": [{"name": "reply", "id": "'), call_id,
                 F.lit('", "arguments": '), args, F.lit("}]}")).alias("text"))
    results = conversations.where("role = 'assistant'").select(
        "conv_id", "turn", F.lit("tool").alias("role"),
        F.concat(F.lit('{"tool_call_id": "call_'), "conv_id", F.lit("_"),
                 F.col("turn") - 1, F.lit('", "content": {"chars": '),
                 F.coalesce(F.length("text"), F.lit(0)), F.lit("}}")).alias("text"))
    return calls.union(results)


@query
def op2_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    schemas = spark.createDataFrame(REPLY, "name string, param string, type string, "
                                           "required boolean")
    return toolcalls.link(tool_messages(table(spark, sf_dir, "conversations")), schemas)


ORACLE["op2_tool_call_linking"] = """
with calls as (
    select conv_id, turn, coalesce(text, '') as text,
           'call_' || conv_id || '_' || turn as call_id,
           row_number() over (partition by conv_id, turn % 2 order by turn) - 1 as level
    from conversations where role = 'user'),
results as (
    select conv_id, turn, 'call_' || conv_id || '_' || (turn - 1) as call_id,
           coalesce(length(text), 0) as chars
    from conversations where role = 'assistant')
select coalesce(c.conv_id, r.conv_id) as conv_id, coalesce(c.turn, r.turn) as turn,
       cast(0 as integer) as idx, coalesce(c.call_id, r.call_id) as call_id,
       case when c.call_id is not null then 'reply' end as name,
       case when c.call_id is null then 'orphan_result'
            when r.call_id is null then 'missing_result' else 'ok' end as status,
       cast(case when c.call_id is not null then c.level end as integer) as level,
       case when c.call_id is not null and c.turn >= 2 and p.call_id is null
            then 'unresolved:call_' || c.conv_id || '_' || (c.turn - 2) else '' end as errors,
       case when c.call_id is null
            then '{"id":"' || r.call_id || '","result":{"chars":' || r.chars || '}}'
            else '{"arguments":{' ||
                 case when c.turn >= 2
                      then '"after":"$call_' || c.conv_id || '_' || (c.turn - 2) || '",'
                      else '' end ||
                 '"text":' || cast(to_json(c.text) as varchar) || ',"turn":' || c.turn ||
                 '},"id":"' || c.call_id || '","name":"reply","result":' ||
                 case when r.call_id is null then 'null'
                      else '{"chars":' || r.chars || '}' end || '}' end as json
from calls c full outer join results r on r.call_id = c.call_id
left join calls p on p.conv_id = c.conv_id and p.turn = c.turn - 2
"""


@query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return unigram.token_counts(docs, tokenizer_path("piece_bpe_32k.model")).select(
        "doc_id", "n_tokens")


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.leaks(docs, table(spark, sf_dir, "benchmark"))
    return (found.select("doc_id", F.explode("leaks").alias("x"))
            .select("doc_id", "x.item_id", "x.start", "x.end", "x.windows", "x.edits"))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = rlbwt.dedup(docs)
    return out.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.expr("aggregate(removed, 0L, (a, x) -> a + x.end - x.start)").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~quality.held_out())
    model = quality.train(docs, labels)
    return quality.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = backoff.scores(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"))


#: Words: runs of characters that are not ASCII white space, A-Z in lower case.
_WORDS = r"""
words as (
    select doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
    from documents)"""

ORACLE["op8_lm_scoring"] = f"""
with {_WORDS},
pos as (select doc_id, i, w[i] as c, case when i > 1 then w[i - 1] end as b,
               case when i > 2 then w[i - 2] end as a
        from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from words)),
uni as (select c, count(*) as n from pos group by 1),
bi as (select b, c, count(*) as n from pos where b is not null group by 1, 2),
tri as (select a, b, c, count(*) as n from pos where a is not null group by 1, 2, 3),
scored as (
    select p.doc_id,
           case when t.n >= 2 then ln(t.n / x.n)
                when y.n >= 2 then ln(y.n / v.n) + case when p.i > 2 then ln(0.4) else 0 end
                else ln(u.n / (select sum(n) from uni)) + least(p.i - 1, 2) * ln(0.4) end as s
    from pos p join uni u on u.c = p.c left join uni v on v.c = p.b
    left join bi y on y.b = p.b and y.c = p.c left join bi x on x.b = p.a and x.c = p.b
    left join tri t on t.a = p.a and t.b = p.b and t.c = p.c)
select w.doc_id, cast(len(w.w) as bigint) as n_words,
       round(coalesce(s.s, 0.0), 4) as log_score
from words w left join (select doc_id, sum(s) as s from scored group by 1) s using (doc_id)
"""

_REACH = """
reach(id, node) as (
    select {id}, {id} from {nodes} union
    select r.id, l.b from reach r join both_ways l on l.a = r.node),
low as (select id, min(node) as component_id from reach group by 1)"""

ORACLE["op1_embedding_near_dedup"] = f"""
with recursive good as (
    select vec_id, label, cast(embedding as double[]) as x from embeddings
    where label is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
      and len(list_filter(embedding, lambda v: v <> 0)) > 0),
both_ways as (
    select p.vec_id as a, q.vec_id as b from good p join good q
    on p.label = q.label and len(p.x) = len(q.x) and p.vec_id <> q.vec_id
    and list_cosine_similarity(p.x, q.x) >= 0.93),
{_REACH.format(id="vec_id", nodes="embeddings")}
select e.vec_id, coalesce(n.n, 0) as n_links, l.component_id, e.vec_id = l.component_id as kept,
       cast(1.0 as double) as recall
from embeddings e join low l on l.id = e.vec_id
left join (select a, count(*) as n from both_ways group by 1) n on n.a = e.vec_id
"""

ORACLE["op3_minhash_near_dedup"] = f"""
with recursive {_WORDS},
sets as (
    select doc_id, case when len(w) >= 4 then list_distinct(list_transform(
               range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
           when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from words),
shingles as (select doc_id, len(s) as n, unnest(s) as x from sets),
shared as (
    select p.doc_id as a, q.doc_id as b, any_value(p.n) as n, any_value(q.n) as m, count(*) as k
    from shingles p join shingles q on p.x = q.x and p.doc_id <> q.doc_id group by 1, 2),
both_ways as (select a, b from shared where 100 * k >= 80 * (n + m - k)),
{_REACH.format(id="doc_id", nodes="documents")}
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, l.component_id,
       s.doc_id = l.component_id as kept
from sets s join low l on l.id = s.doc_id
"""


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode_decode(docs, tokenizer_path("byte_bpe_50k.json"))
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.detect(docs)
    kinds = [F.expr(f"size(filter(base_spans, s -> s.kind = '{k}'))").cast("long")
             .alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *kinds, F.sha2(pii.written("base_spans"), 256)
                        .alias("base_sha256"), pii.written("spans").alias("spans"))


#: crc32 of the decimal id, by the table of 256 remainders that follows from its polynomial.
_CRC = """
crc_table as (
    select list(c order by i) as crc_list from (
        select i, list_reduce(list_prepend(i, range(8)), lambda c, k:
               case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
        from range(256) t(i))),
crcs as (
    select doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(
               string_split(cast(doc_id as varchar), ''), lambda x: cast(ord(x) as bigint))),
               lambda c, b: xor(c >> 8, crc_list[(xor(c, b) & 255) + 1])), 4294967295) as h
    from documents, crc_table)"""


def crc(id_col: str = "doc_id"):
    """Unsigned crc32 of the decimal id; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h, g = crc(), F.floor(crc() / 10)
    n = F.expr(r"size(filter(split(text, r'[\x20\x09-\x0D]+'), x -> x <> ''))")
    start = (g % n).cast("int")
    period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
    docs = docs.withColumn("text", F.when((h % 10 == 0) & (n > 0), periods.repeat_tail(
        F.col("text"), start, period)).otherwise(F.col("text")))
    best = periods.longest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]),
        F.lit("\n")))
    return periods.collapse(docs).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.minus")).alias("length"), F.col("best.period").alias("period"),
        F.expr("(-1000 * best.minus) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


ORACLE["op11_periodic_runs"] = rf"""
with {_CRC},
plain as (
    select doc_id, h, h // 10 as g, list_filter(string_split_regex(
        coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
    from documents join crcs using (doc_id)),
cut as (
    select *, len(w) as n, case when h % 10 = 0 and len(w) > 0 then g % len(w) end as a
    from plain),
texts as (
    select doc_id, n, case when a is null then w else list_transform(range(n), lambda i:
               w[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end])
           end as w
    from cut),
grams as (
    select doc_id, i, array_to_string(w[i + 1:i + 6], ' ') as x
    from (select doc_id, w, unnest(range(0, n - 5)) as i from texts)),
cells as (
    select p.doc_id, p.i - q.i as d, p.i from grams p join grams q
    on p.doc_id = q.doc_id and p.x = q.x and p.i > q.i),
diagonals as (
    select doc_id, d, min(i) - d as start, max(i) + 6 as stop
    from (select *, i - row_number() over (partition by doc_id, d order by i) as island from cells)
    group by doc_id, d, island having max(i) + 6 - (min(i) - d) >= greatest(12, 2 * d)),
runs as (
    select doc_id, start, stop, stop - start as length, d as period from diagonals r
    where not exists (select 1 from diagonals s where s.doc_id = r.doc_id and s.start = r.start
                      and s.d < r.d and s.stop >= r.stop)),
found as (
    select doc_id, count(*) as n_runs, list(struct_pack(start, length, period)
               order by length desc, start, period)[1] as best,
           string_agg(start || ',' || length || ',' || period || chr(10), ''
                      order by start, period) as lines
    from runs group by 1),
gone as (
    select distinct doc_id, unnest(range(start + period, stop)) as i from runs),
kept as (
    select t.doc_id, string_agg(t.x, ' ' order by t.i) as collapsed
    from (select doc_id, unnest(w) as x, unnest(range(n)) as i from texts) t
    left join gone g on g.doc_id = t.doc_id and g.i = t.i where g.i is null group by 1)
select t.doc_id, coalesce(n_runs, 0) as n_runs, best.start as start, best.length as length,
       best.period as period, 1000 * best.length // best.period as exponent_milli,
       sha256(coalesce(lines, '')) as runs_sha256,
       sha256(coalesce(collapsed, '')) as collapsed_sha256
from texts t left join found f on f.doc_id = t.doc_id left join kept k on k.doc_id = t.doc_id
"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(crc() % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    out = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"],
                          seen={"text": tampered})
    return out.select("doc_id", "leaf", "subroot", "root",
                      F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def _told(columns: str) -> str:
    return " || ".join(f"coalesce(octet_length(encode(cast({c} as varchar))) || ':' || {c}, '-')"
                       for c in columns.split())


def _tree(name: str, grp: str, leaves: str) -> str:
    """Nodes of every level of ``leaves`` (grp, pos, digest) by recursion."""
    return f"""
{name}(grp, lvl, pos, digest) as (
    select {grp}, 0, pos, digest from {leaves} union all
    select grp, lvl + 1, pos // 3, sha256(string_agg(digest, '' order by pos))
    from (select *, count(*) over (partition by grp) as n from {name}) where n > 1
    group by grp, lvl, pos // 3)"""


ORACLE["op12_merkle_manifest"] = f"""
with recursive {_CRC},
leaves as (
    select doc_id, coalesce('s' || source, '') as src,
           row_number() over (partition by source order by doc_id) - 1 as pos,
           sha256({_told("doc_id source lang n_chars text")}) as digest,
           sha256({_told("doc_id source lang n_chars seen")}) as seen
    from (select d.*, case when h % 2 = 0 then replace(text, chr(10), '') else text end as seen
          from documents d join crcs using (doc_id))),
{_tree("low", "src", "leaves")},
subroots as (
    select grp as src, digest, row_number() over (order by grp) - 1 as pos
    from (select *, max(lvl) over (partition by grp) as top from low) where lvl = top),
{_tree("high", "0", "subroots")},
low_side as (
    select p.grp, p.lvl, p.pos, coalesce(string_agg(q.digest, '' order by q.pos)
               filter (q.pos < p.pos), '') as a,
           coalesce(string_agg(q.digest, '' order by q.pos) filter (q.pos > p.pos), '') as b
    from low p join low q on q.grp = p.grp and q.lvl = p.lvl and q.pos // 3 = p.pos // 3
    group by 1, 2, 3),
high_side as (
    select p.lvl, p.pos, coalesce(string_agg(q.digest, '' order by q.pos)
               filter (q.pos < p.pos), '') as a,
           coalesce(string_agg(q.digest, '' order by q.pos) filter (q.pos > p.pos), '') as b
    from high p join high q on q.lvl = p.lvl and q.pos // 3 = p.pos // 3 group by 1, 2),
low_top as (select grp, max(lvl) as top from low group by 1),
fold(doc_id, src, stage, lvl, pos, node, proof) as (
    select doc_id, src, 0, 0, pos, seen, '' from leaves union all
    select f.doc_id, f.src,
           case when f.stage = 0 and f.lvl = t.top then 1 else f.stage end,
           case when f.stage = 0 and f.lvl = t.top then 0 else f.lvl + 1 end,
           case when f.stage = 0 and f.lvl = t.top then s.pos else f.pos // 3 end,
           case when f.stage = 0 and f.lvl = t.top then f.node
                when f.stage = 0 then sha256(x.a || f.node || x.b)
                else sha256(y.a || f.node || y.b) end,
           case when f.stage = 0 and f.lvl = t.top then f.proof
                when f.stage = 0 then f.proof || x.a || x.b else f.proof || y.a || y.b end
    from fold f join low_top t on t.grp = f.src join subroots s on s.src = f.src
    left join low_side x on x.grp = f.src and x.lvl = f.lvl and x.pos = f.pos and f.stage = 0
    left join high_side y on y.lvl = f.lvl and y.pos = f.pos and f.stage = 1
    where f.stage = 0 or f.lvl < (select max(lvl) from high))
select l.doc_id, l.digest as leaf, s.digest as subroot, r.digest as root,
       sha256(f.proof) as proof_sha256, f.node as folded_root, f.node = r.digest as verified
from leaves l join subroots s on s.src = l.src
join (select * from fold where stage = 1 and lvl = (select max(lvl) from high)) f
    on f.doc_id = l.doc_id
join (select digest from high where lvl = (select max(lvl) from high)) r on true
"""


@query
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~quality.held_out()))
    out = langid.predict(docs.drop("lang"), model)
    return out.select("doc_id", quality.held_out().alias("held_out"), "lang_pred",
                      F.round("score", 6).alias("score"))


_SUM = "+".join(f" coalesce(ord(nullif(substr(x, {i + 1}, 1), '')), 0) * {f} "
                for i, f in enumerate(langid.FACTORS))

ORACLE["op13_language_id"] = rf"""
with {_CRC},
texts as (
    select doc_id, lang, h % 3 = 1 as held_out, nullif(trim(lower(regexp_replace(
               coalesce(text, ''), '[^\p{{L}}]+', ' ', 'g')), ' '), '') as t
    from documents join crcs using (doc_id)),
grams as (
    select doc_id, n, unnest(list_transform(range(1, len(t) + 4 - greatest(n, 2)),
                             lambda i: substr(' ' || t || ' ', i, n))) as x
    from texts, range(1, 4) k(n) where t is not null),
buckets as (
    select doc_id, (({_SUM} + n * {langid.LENGTH}) >> {langid.SHIFT}) & {langid.BUCKETS - 1} as b,
           count(*) as m
    from grams group by 1, 2),
learnt as (select * from texts where not held_out and lang is not null and t is not null),
langs as (
    select lang, n, cast(round({langid.UNIT} * ln(n / sum(n) over ())) as bigint) as prior
    from (select lang, count(*) as n from learnt group by 1)),
counts as (
    select lang, b, sum(m) as n from buckets join learnt using (doc_id) group by 1, 2),
totals as (select lang, sum(n) as total from counts group by 1),
matrix as (
    select x.b, t.lang, cast(round({langid.UNIT} * (ln(coalesce(c.n, 0) + {langid.ALPHA})
               - ln(t.total + {langid.ALPHA * langid.BUCKETS}))) as bigint) as v
    from (select distinct b from buckets) x cross join totals t
    left join counts c on c.b = x.b and c.lang = t.lang),
sums as (
    select doc_id, lang, sum(m * v) + any_value(prior) as s
    from buckets join matrix using (b) join langs using (lang) group by 1, 2),
best as (
    select doc_id, list(lang order by s desc, lang)[1] as lang_pred,
           1 / sum(exp((s - top) / {langid.UNIT}.0)) as score
    from (select *, max(s) over (partition by doc_id) as top from sums) group by 1)
select t.doc_id, t.held_out, coalesce(lang_pred, '{langid.UNKNOWN}') as lang_pred,
       round(coalesce(score, 0.0), 6) as score
from texts t left join best using (doc_id)
"""
