"""PII by weak-supervision aggregation (operator 10), DataFrame functions only.

Candidates are the matches of the base patterns plus looser forms (phone numbers without a plus
sign, spelled-out addresses, card-like numbers that fail the checksum). Five labelers vote on
each candidate (+1 personal, -1 not, 0 abstain): the base pattern, a format check, a gazetteer
of cue words before it, and the contexts on its left and right. Expectation-maximisation
estimates each labeler's reliability per kind from the counts of vote patterns over all
documents, without labels; a logistic span classifier is then trained on the posteriors and
decides about every candidate that is not a base match. Base matches always stay.

The number of different vote patterns is bounded (4 kinds, 3 ** 5 votes), so only that table of
counts reaches the driver.

Base patterns are written with a look-behind or ``\\G`` (end of the previous match) and
possessive runs: they find the same leftmost matches as the plain ones, in linear time and
without recursion on long texts. Positions are code points; ends are exclusive.

Defined cases: a null text counts as empty and has no spans; repeated rows are treated alike;
input columns named like an output are replaced; an empty table trains nothing and adds nothing.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, without

KINDS = ("email", "ip", "card", "phone")

# The base patterns, rewritten for linear time.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"

# Looser forms: (kind, pattern, what a text must match to be searched at all).
LOOSE = {
    "spelled": ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?[\[(](?i:at)[\])] ?"
                r"[A-Za-z0-9-]++(?: ?(?:\.|[\[(](?i:dot)[\])]) ?[A-Za-z0-9-]++)++",
                r"[\[(](?i:at)[\])]"),
    "local": ("phone", r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
              r"[0-9]{3}[ .-][0-9]{4}"),
}

# Gazetteers: cue words before a span, top-level domains.
CUES = {
    "email": "e-?mail|mailto|contact|contacto|kontakt|courriel|correo|write to|reply to",
    "ip": "ip|host|server|address|addr|serveur|servidor|adresse|login from",
    "card": "card|visa|mastercard|amex|credit|carte|tarjeta|karte|payment",
    "phone": "phone|tel|telephone|mobile|cell|call|fax|telefon|t[eé]l[eé]phone|tel[eé]fono|whatsapp",
}
DOMAINS = "com|org|net|edu|gov|int|info|biz|io|eu|uk|de|fr|es|it|nl|ch|at|us|ca|au|jp|cn|br|in"

BLOCK, NEAR, LABELERS = 64, 24, 5
#: Weight of each labeler's vote before anything is known: pattern, format, cue, left, right.
START = np.array([2.0, 2.0, 1.0, 0.25, 0.25])
_SPAN = "struct<start:bigint,end:bigint,kind:string,value:string,base:boolean>"


def _located(hits: str, parts: str) -> str:
    """SQL: array of (start, value) of the matches, from the lengths between them.

    Starts are running sums, taken in blocks of BLOCK so that many matches in one text cost
    little more than their number.
    """
    n = f"size({hits})"
    lens = f"zip_with(slice({parts}, 1, {n}), {hits}, (p, h) -> cast(p + length(h) as bigint))"
    add = "0L, (a, x) -> a + x"
    return (f"transform(array({lens}), lens -> transform(array(transform(sequence(0, ({n} - 1) div "
            f"{BLOCK}), j -> aggregate(slice(lens, cast(j * {BLOCK} + 1 as int), {BLOCK}), {add})))"
            f", blk -> transform({hits}, (h, i) -> struct("
            f"aggregate(slice(blk, 1, cast(i div {BLOCK} as int)), {add}) + "
            f"aggregate(slice(lens, cast((i div {BLOCK}) * {BLOCK} + 1 as int), i % {BLOCK}), {add})"
            f" + {parts}[i] as start, h as value))))[0][0]")


def _luhn(value: str) -> str:
    """SQL: digits of ``value`` pass the Luhn sum."""
    d = f"regexp_replace({value}, '[^0-9]', '')"
    return (f"aggregate(transform(split(reverse({d}), ''), (c, i) -> "
            "case when i % 2 = 0 then int(c) when int(c) > 4 then 2 * int(c) - 9 "
            "else 2 * int(c) end), 0, (a, x) -> a + x) % 10 = 0")


def _digits(value: str) -> str:
    return f"length(regexp_replace({value}, '[^0-9]', ''))"


#: Whether a base match holds (drop failing matches, no retries).
_HOLDS = {
    "email": "true",
    "ip": f"x.value rlike '{_OCTETS}'".replace("\\", "\\\\"),
    "card": f"case when {_digits('x.value')} between 12 and 19 then {_luhn('x.value')} "
            "else false end",
    "phone": f"{_digits('x.value')} between 9 and 15",
}


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``cands``: every candidate span with its votes, sorted by start and kind."""
    cols = [F.col(f"`{c}`") for c in without(docs, "cands", "spans", "base_spans").columns]
    t = f"coalesce(`{text_col}`, '')"
    guard = {"email": f"contains({t}, '@')", "phone": f"contains({t}, '+')",
             "ip": f"{t} rlike '[0-9]'", "card": f"{t} rlike '[0-9]'"}
    plan = [(k, k, PATTERNS[k], guard[k], _HOLDS[k]) for k in KINDS]
    plan += [(name, kind, p, f"{t} rlike {_quoted(need)}", "false")
             for name, (kind, p, need) in LOOSE.items()]
    df = docs.select(*cols, *[F.expr(
        f"case when {need} then regexp_extract_all({t}, {_quoted(p)}, 0) "
        "else cast(array() as array<string>) end").alias(f"__h_{name}")
        for name, _, p, need, _ in plan])
    df = df.select(*cols, *[f"__h_{x[0]}" for x in plan], *[F.expr(
        f"case when size(__h_{name}) > 0 then transform(split({t}, {_quoted(p)}, -1), "
        "x -> length(x)) end").alias(f"__p_{name}") for name, _, p, _, _ in plan])
    spans = []
    for name, kind, _, _, holds in plan:
        at = _located(f"__h_{name}", f"__p_{name}")
        keep = "true" if name == "card" or name in LOOSE else "b"
        size = f"{_digits('x.value')} between 12 and 19" if name == "card" else "true"
        spans.append(F.expr(
            f"case when size(__h_{name}) > 0 then filter(transform({at}, x -> struct("
            f"x.start as start, x.start + length(x.value) as end, '{kind}' as kind, "
            f"x.value as value, {holds} as base)), s -> "
            + keep.replace("b", "s.base") .replace("true", "true")
            + f" and {size.replace('x.value', 's.value')}) "
            f"else cast(array() as array<{_SPAN}>) end").alias(f"__s_{name}"))
    df = df.select(*cols, *spans)
    joined = "concat(" + ", ".join(f"__s_{x[0]}" for x in plan) + ")"
    df = df.select(*cols, F.expr(joined).alias("__all"))
    base = "filter(__all, s -> s.base)"
    loose = ("filter(__all, s -> not s.base and not exists(__all, "
             "o -> o.base and o.start < s.end and s.start < o.end))")
    df = df.select(*cols, F.expr(
        f"case when size(__all) = 0 then __all else concat({base}, {loose}) end").alias("__all"))
    order = "array_position(array('email', 'ip', 'card', 'phone'), s.kind)"
    votes = _votes(t)
    return df.select(*cols, F.expr(
        f"sort_array(transform(__all, s -> struct(s.start as start, cast({order} as int) as rank,"
        f" s.end as end, s.kind as kind, s.base as base, {votes} as votes)))").alias("cands"))


def _votes(t: str) -> str:
    """SQL: array of LABELERS votes on the span ``s``."""
    left = f"substring({t}, cast(greatest(s.start - {NEAR} + 1, 1) as int), " \
           f"cast(least(s.start, {NEAR}) as int))"
    right = f"substring({t}, cast(s.end + 1 as int), 1)"
    form = ("case s.kind "
            f"when 'email' then if(s.value rlike '(?i)[.]({DOMAINS})$', 1, 0) "
            "when 'ip' then if(s.value rlike '^(0|127|22[4-9]|2[3-9][0-9])[.]', -1, 1) "
            "when 'card' then if(s.base and s.value rlike '^[3-6]', 1, -1) "
            f"else if({_digits('s.value')} between 10 and 12, 1, -1) end")
    cue = "case s.kind " + " ".join(
        f"when '{k}' then if(lower({left}) rlike '(^|[^a-z])({CUES[k]})[^a-z0-9]{{0,4}}"
        "([a-z]{1,6}[^a-z0-9]{0,3})?$', 1, 0)" for k in KINDS) + " end"
    return ("array(if(s.base, 1, 0), " + form + ", " + cue + ", "
            f"if({left} = '' or {left} rlike '[\\\\s(:,;\"]$', 1, -1), "
            f"if({right} = '' or {right} rlike '^[\\\\s),;.:!?\"]', 1, -1))")


def reliabilities(patterns: dict[tuple[str, tuple[int, ...]], int], rounds: int = 50) -> dict:
    """Posterior of "personal" for each (kind, votes), by expectation-maximisation.

    Each labeler has its own chance of each vote given the truth; votes are taken as
    independent given the truth. Started from a weighted sum of votes (START).
    """
    post: dict = {}
    for kind in KINDS:
        rows = sorted((v, n) for (k, v), n in patterns.items() if k == kind)
        if not rows:
            continue
        v = np.array([r[0] for r in rows]) + 1
        n = np.array([r[1] for r in rows], dtype=float)
        p = 1 / (1 + np.exp(1 - (v - 1) @ START))
        for _ in range(rounds):
            prior = np.clip((n * p).sum() / n.sum(), 0.01, 0.99)
            log = np.full(len(rows), math.log(prior / (1 - prior)))
            for j in range(v.shape[1]):
                yes = np.bincount(v[:, j], n * p, 3) + 0.5
                no = np.bincount(v[:, j], n * (1 - p), 3) + 0.5
                log += np.log(yes / yes.sum())[v[:, j]] - np.log(no / no.sum())[v[:, j]]
            p = 1 / (1 + np.exp(-np.clip(log, -30, 30)))
        if (n * p * (v[:, 0] == 2)).sum() < (n * (1 - p) * (v[:, 0] == 2)).sum():
            p = 1 - p                      # the class of most base matches is "personal"
        post.update({(kind, r[0]): float(x) for r, x in zip(rows, p, strict=True)})
    return post


def classifier(patterns: dict, post: dict, steps: int = 400) -> dict[str, np.ndarray]:
    """Weights (bias, votes -1, votes +1) of each kind's logistic span classifier."""
    out = {}
    for kind in KINDS:
        rows = [(v, n, post[k, v]) for (k, v), n in patterns.items() if k == kind]
        w = np.zeros(1 + 2 * LABELERS)
        if rows:
            v = np.array([r[0] for r in rows])
            x = np.concatenate([np.ones((len(v), 1)), v == -1, v == 1], axis=1).astype(float)
            n = np.array([r[1] for r in rows], dtype=float)
            y, n = np.array([r[2] for r in rows]), n / n.sum()
            for _ in range(steps):
                p = 1 / (1 + np.exp(-x @ w))
                hess = (x * (n * p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-3 * np.eye(len(w))
                w += 0.5 * np.linalg.solve(hess, x.T @ (n * (y - p)) - 1e-3 * w)
        else:
            w[0] = -10.0
        out[kind] = w
    return out


def train(cands: DataFrame) -> dict[str, np.ndarray]:
    """Fit the span classifiers from the vote patterns of all candidates."""
    rows = (cands.select(F.explode("cands").alias("c")).groupBy("c.kind", "c.votes")
            .agg(F.count("*").alias("n")).collect())
    patterns = {(r.kind, tuple(r.votes)): r.n for r in rows}
    return classifier(patterns, reliabilities(patterns))


def _accepts(weights: dict[str, np.ndarray]):
    def test(s: Column) -> Column:
        out = F.lit(False)
        for kind, w in weights.items():
            z = F.lit(float(w[0]))
            for j in range(LABELERS):
                vote = F.element_at(s.votes, j + 1)
                z = z + F.when(vote == -1, float(w[1 + j])).when(
                    vote == 1, float(w[1 + LABELERS + j])).otherwise(0.0)
            out = out | ((s.kind == kind) & (z >= 0))
        return out
    return test


def detect(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with base_spans and spans: arrays of (start, rank, end, kind)."""
    cands = materialize(candidates(docs, text_col), "pii")
    accepts = _accepts(train(cands))

    def plain(s: Column) -> Column:
        return F.struct(s.start.alias("start"), s["rank"].alias("rank"), s.end.alias("end"),
                        s.kind.alias("kind"))

    base = F.transform(F.filter("cands", lambda s: s.base), plain)
    every = F.transform(F.filter("cands", lambda s: s.base | accepts(s)), plain)
    return cands.select("*", base.alias("base_spans"), every.alias("spans")).drop("cands")


def written(col: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(col, lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def redact(found: DataFrame, text_col: str = "text", spans: str = "spans") -> DataFrame:
    """Replace each span (overlapping ones together) by its kind in brackets."""
    t = f"`{text_col}`"
    text = F.expr(
        f"case when coalesce(size({spans}), 0) = 0 then {t} else aggregate({spans}, "
        "cast(struct(0L as at, '' as done) as struct<at:bigint,done:string>), (a, s) -> "
        "if(s.start < a.at, struct(greatest(a.at, s.end) as at, a.done as done), "
        f"struct(s.end as at, concat(a.done, substring({t}, cast(a.at + 1 as int), "
        "cast(s.start - a.at as int)), '[', upper(s.kind), ']') as done)), "
        f"a -> concat(a.done, substring({t}, cast(a.at + 1 as int)))) end")
    return found.withColumn(text_col, text)
