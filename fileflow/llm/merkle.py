"""Merkle dataset manifest on concatenated-level strings (operator 12).

Every row is a leaf: the hash of its columns. Per group, leaves in key order are hashed in runs of
ARITY up to one node, the group's subroot; the subroots, in group order, are hashed in the same way
up to the root. H is lower-case hex SHA-256 of the inputs concatenated.

A block is ARITY ** DEPTH consecutive nodes of a group, aligned at the group's start. It keeps each
level as one hex string: the level above hashes the fixed-width substrings of ARITY digests, so
DEPTH levels of a block are one expression over one row, however large the group. The blocks' last
strings are the nodes of the next pass, until one node is left (a pass for each factor of
ARITY ** DEPTH rows). A node's siblings at a level are the substrings on its left and right in its
run; the way back down joins each block with the segments above it and appends its own.

Only the largest number of nodes left, one root, and no rows come to the driver. Positions come
from a range sort whose ties are broken by row, so a group or a key that holds most rows is spread
over all partitions, and a block holds BLOCK short rows at most.

Defined cases: a null value is hashed as ``-``, any other as its UTF-8 byte count, ``:`` and the
value, so null, empty and shifted values differ. A null group is a group of its own and the first;
null keys come first in their group. Rows that repeat a key are ordered by leaf, then by the leaf
as seen; equal rows take neighbouring positions and any of them may take each. An empty table gives
no rows. Only the named columns are hashed; other columns do not matter and are not returned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

ARITY, DEPTH, WIDTH = 3, 5, 64
BLOCK = ARITY ** DEPTH


def leaf(values: list[Column]) -> Column:
    """H of the values, each ``-`` if null, else byte count, ``:``, value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t),
                                        F.lit("-")) for t in texts]), 256)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _cut(level: Column, start: Column, length: Column) -> Column:
    """Digests ``start`` .. ``start + length`` of a level string (bytes: no scan of characters)."""
    return F.substring(level, (start * WIDTH + 1).cast("int"), (length * WIDTH).cast("int"))


def _above(level: Column) -> Column:
    """The next level's string: H of every ARITY digests."""
    runs = F.ceil(F.octet_length(level) / (ARITY * WIDTH)).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda j: F.sha2(
        _cut(level, j * ARITY, F.lit(ARITY)), 256)), "").cast("binary")


def _levels(bottom: Column, steps: Column) -> Column:
    """Level strings from ``bottom`` up, ``steps`` times."""
    return F.aggregate(F.slice(F.array(*[F.lit(i) for i in range(DEPTH)]), F.lit(1), steps),
                       F.array(bottom),
                       lambda acc, _: F.concat(acc, F.array(_above(F.element_at(acc, -1)))))


def _siblings(levels: Column, place: Column) -> Column:
    """For each level below the top: the segments left and right of the node over ``place``."""
    def one(t: Column) -> Column:
        level, node = F.element_at(levels, t + 1), F.floor(place / F.pow(F.lit(ARITY), t))
        return F.struct(
            _cut(level, node - node % ARITY, node % ARITY).alias("left"),
            _cut(level, node + 1, ARITY - 1 - node % ARITY).alias("right"))
    n = F.size(levels) - 1
    return F.transform(F.slice(F.array(*[F.lit(i) for i in range(DEPTH)]), F.lit(1), n), one)


def _segments(path: Column) -> Column:
    return F.aggregate(path, F.lit("").cast("binary"),
                       lambda acc, x: F.concat(acc, x["left"], x["right"]))


def _fold(path: Column, start: Column) -> Column:
    """The root that follows from a node and the segments beside its path."""
    return F.aggregate(path, start, lambda acc, x: F.sha2(
        F.concat(x["left"], acc.cast("binary"), x["right"]), 256))


def _numbered(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``pos``, the position in the group by (key, digest, extra)."""
    spread = (nodes.withColumn("tie", F.monotonically_increasing_id())
              .repartitionByRange("grp", "key", "digest", "seen", "tie")
              .sortWithinPartitions("grp", "key", "digest", "seen", "tie"))
    spread = materialize(spread.drop("tie").select(
        "*", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("seq")), "merkle")
    sizes = spread.groupBy("grp", "part").agg(F.count("*").alias("n"), F.min("seq").alias("seq0"))
    before = F.sum("n").over(W.partitionBy("grp").orderBy("part").rowsBetween(
        W.unboundedPreceding, -1))
    sizes = sizes.select("grp", "part", (F.coalesce(before, F.lit(0)) - F.col("seq0"))
                         .alias("shift"))
    return (spread.join(sizes, ["grp", "part"])
            .withColumn("pos", F.col("seq") + F.col("shift")).drop("part", "seq", "shift"))


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per block of numbered nodes: its nodes and its level strings."""
    made = nodes.groupBy("grp", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "key", "seen"))).alias("nodes"))
    sizes = nodes.groupBy("grp").agg(F.count("*").alias("total"))
    need = F.lit(DEPTH)
    for t in reversed(range(DEPTH)):
        need = F.when(F.col("total") <= ARITY ** t, t).otherwise(need)
    made = made.join(sizes, "grp").withColumn("steps", need)
    bottom = F.array_join(F.transform("nodes", lambda x: x["digest"]), "").cast("binary")
    return made.select("grp", "block", "nodes", "total", _levels(bottom, F.col("steps"))
                       .alias("levels"))


def _tree(nodes: DataFrame) -> list[DataFrame]:
    """The blocks of every pass, from the leaves up, for nodes (grp, key, digest, seen)."""
    passes, nodes = [], _numbered(nodes)
    while True:
        passes.append(materialize(_blocks(nodes), "merkle"))
        most = passes[-1].agg(F.max("total")).first()[0] or 0
        if most <= BLOCK:
            return passes
        nodes = passes[-1].where(f"total > {BLOCK}").select(
            "grp", F.col("block").alias("pos"), F.col("block").alias("key"),
            F.element_at("levels", -1).cast("string").alias("digest"),
            F.lit(None).cast("string").alias("seen"))


def _tops(passes: list[DataFrame]) -> DataFrame:
    """(grp, top): the one node of each group, at the pass that leaves it one block."""
    tops = [p.where(f"total <= {BLOCK}").select(
        "grp", F.element_at("levels", -1).cast("string").alias("top")) for p in passes]
    return reduce(DataFrame.unionByName, tops)


def _paths(passes: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """Lowest blocks with ``up``: the segments above each block, from its own level to the root.

    ``above`` (grp, up): segments above each group's top node.
    """
    none = F.expr("cast(array() as array<struct<left: binary, right: binary>>)")
    upper = above
    for p in reversed(passes[1:]):
        p = _with_up(p, above, upper, none)
        upper = p.select("grp", F.explode(F.transform("nodes", lambda x, i: F.struct(
            x["pos"].alias("block"),
            F.concat(_siblings(F.col("levels"), i), F.col("up")).alias("up"))))
            .alias("x")).select("grp", "x.block", "x.up")
        upper = materialize(upper, "merkle")
    return _with_up(passes[0], above, upper, none)


def _with_up(blocks: DataFrame, above: DataFrame | None, upper: DataFrame | None,
             none: Column) -> DataFrame:
    """Blocks with the segments above: of the group's top for a group's only block, else of the
    block as a node of the next pass."""
    last = blocks.where(f"total <= {BLOCK}")
    last = last.withColumn("up", none) if above is None else last.join(above, "grp")
    if upper is above:
        return last
    return last.unionByName(blocks.where(f"total > {BLOCK}").join(upper, ["grp", "block"]))


def manifest(docs: DataFrame, columns: list[str], key: str = "doc_id", group: str = "source",
             seen: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: the key, ``leaf``, ``subroot``, ``root``, ``proof`` (the
    sibling segments from the leaf to the root, concatenated), ``folded_root`` and ``verified``.

    ``seen`` gives columns as someone received them: folded_root follows from the leaf made of
    them and the original siblings, and verified tells whether it is the root.
    """
    seen = seen or {}
    leaves = materialize(docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("")).alias("grp"),
        F.col(key).alias("key"), leaf([F.col(c) for c in columns]).alias("digest"),
        leaf([seen.get(c, F.col(c)) for c in columns]).alias("seen")), "merkle")
    low = _tree(leaves)
    subroots = _tops(low).select(
        F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("top").alias("digest"),
        F.lit(None).cast("string").alias("seen"))
    high = _tree(subroots)
    top = _tops(high).first()
    per_group = _paths(high, None)
    per_group = per_group.select(F.explode(F.transform("nodes", lambda x, i: F.struct(
        x["key"].alias("grp"), x["digest"].alias("subroot"),
        F.concat(_siblings(F.col("levels"), i), F.col("up")).alias("up")))).alias("x")).select("x.*")
    per_group = materialize(per_group, "merkle")
    blocks = _paths(low, per_group.select("grp", "up"))

    def proven(x: Column, i: Column) -> Column:
        return _let(F.concat(_siblings(F.col("levels"), i), F.col("up")), lambda path: F.struct(
            x["key"].alias(key), x["digest"].alias("leaf"),
            _segments(path).alias("proof"), _fold(path, x["seen"]).alias("folded_root")))

    blocks = blocks.join(per_group.select("grp", "subroot"), "grp")
    rows = blocks.select("subroot", F.explode(F.transform("nodes", proven)).alias("x"))
    root = F.lit(top["top"] if top else None).cast("string")
    return rows.select(f"x.{key}", "x.leaf", "subroot", root.alias("root"),
                       F.col("x.proof").cast("string").alias("proof"), "x.folded_root",
                       (F.col("x.folded_root") == root).alias("verified"))
