"""Embedding near-dedup by NN-descent (operator 1).

Vectors of one label are compared by cosine. Equal vectors are one node with a multiplicity.

1. Start: random hyperplane trees put each node into small leaves; planes lie at the median
   projection of the label (a leaf that is too large is split by a hash of the node). Neighbours
   inside a leaf start the K-neighbour graph.
2. Descent: each node joins its neighbours, forward and reverse, with one another; pairs closer
   than a list's last entry replace it. Repeated until few lists change.
3. Threshold: entries near the threshold are recomputed in double precision; those at or above
   it are links.
4. Saturation: if every entry of a node's list is a link, the list may hide more links, also to
   nodes that no list names. Such a node is compared with its whole label, in blocks.
5. Audit: before the search, probes are planted: copies of up to PROBES nodes of each label, turned
   to a cosine between the threshold and NEAR above it. A label is searched well if the lists name
   RECALL of its probes beside their nodes; otherwise fresh trees and another descent enlarge its
   lists. Probes leave no trace in the result. Beside them AUDIT nodes of each label (a fixed number)
   are compared with the label exactly: what that finds is kept, and counts for the recall too.
   A label still short after TRIES descents is compared whole, in blocks: so a search that cannot
   find what was planted loses nothing. Hardly any links in a label are no reason for that.

The search uses half-precision copies; no link is reported without double precision.

Defined cases: null labels, and vectors that are null, empty, zero or hold null or non-finite
components, link with nothing (n_links 0, own component, kept). Vectors of different length are
not compared. A null id has a null component and is kept. Repeated rows link with each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_arrow, components, materialize, small_batches

K, LEAF, TREES, ROUNDS, TRIES = 12, 64, 3, 6, 12
BITS = 20                      # planes of a tree
AUDIT, RECALL, SLACK = 128, 0.99, 0.005
PROBES, NEAR = 256, 0.04       # planted copies of a label, and how far above the threshold
SEEN = 100                     # links that the exact sample must have seen to speak of recall
BLOCK = 1024                   # nodes compared at a time
MET = "k long, own boolean, n long, d long, nbr long"


def _nodes(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, k, grp, vec, half): k and vec are null for rows that link with nothing."""
    base = df.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"),
                     F.col(vec_col).cast("array<double>").alias("x"))

    def run(b: pa.RecordBatch):
        k, grp, vec, half = [], [], [], []
        for label, x in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            v = None
            if label is not None and x and None not in x:
                v = np.array(x, dtype=np.float64) + 0.0
                norm = float(np.linalg.norm(v / (np.abs(v).max() or 1.0))) * float(np.abs(v).max())
                if not (np.isfinite(v).all() and norm > 0):
                    v = None
            if v is None:
                row = (None,) * 4
            else:
                g = f"{label}\x00{len(v)}"
                raw = v.tobytes()
                row = (int.from_bytes(hashlib.blake2b(raw + g.encode(), digest_size=8).digest(),
                                      "little", signed=True), g, raw,
                       (v / norm).astype(np.float16).tobytes())
            for out, y in zip((k, grp, vec, half), row, strict=True):
                out.append(y)
        return [pa.array(k, pa.int64()), pa.array(grp, pa.string()), pa.array(vec, pa.binary()),
                pa.array(half, pa.binary())]

    return append_arrow(base, [("k", T.LongType()), ("grp", T.StringType()),
                               ("vec", T.BinaryType()), ("half", T.BinaryType())], run
                        ).select("id", "k", "grp", "vec", "half")


def _matrix(raw: list[bytes], kind) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1)


def _unit(raw: list[bytes]) -> np.ndarray:
    x = _matrix(raw, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _edges(rows: list[tuple[int, int, float]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.float64())], ["k", "nbr", "sim"])


def _best(ids: list[int], half: list[bytes], keep: int, floor: np.ndarray | None = None):
    """(k, nbr, sim) rows: each member's best partners within the group, above its floor."""
    x = _matrix(half, np.float16).astype(np.float32)
    s = x @ x.T
    np.fill_diagonal(s, -2)
    n = min(keep, len(ids) - 1)
    top = np.argpartition(-s, n - 1, axis=1)[:, :n]
    sim = np.take_along_axis(s, top, axis=1)
    good = sim > (-2 if floor is None else floor[:, None])
    a, b = np.nonzero(good)
    return [(ids[i], ids[j], float(v)) for i, j, v in
            zip(a.tolist(), top[a, b].tolist(), sim[a, b].tolist())]


def start(nodes: DataFrame, seed: int) -> DataFrame:
    """(k, nbr, sim) inside the leaves of TREES random hyperplane trees."""
    sizes = nodes.groupBy("grp").agg(F.count("*").alias("n"))
    rows = nodes.select("k", "grp", "half")
    trees = range(TREES)

    def project(b: pa.RecordBatch):
        out = []
        for raw in b.column(2).to_pylist():
            x = np.frombuffer(raw, dtype=np.float16).astype(np.float32)
            if len(x) not in planes:
                planes[len(x)] = np.concatenate([np.random.default_rng(
                    [seed, t, len(x)]).standard_normal((BITS, len(x)), dtype=np.float32)
                    for t in trees])
            out.append(planes[len(x)] @ x)
        return [pa.array(out, pa.list_(pa.float32()))]

    planes: dict = {}
    rows = append_arrow(rows, [("p", T.ArrayType(T.FloatType()))], project)
    middle = rows.groupBy("grp").agg(F.array(*[
        F.percentile_approx(F.col("p")[i], 0.5, 200) for i in range(BITS * TREES)]).alias("mid"))
    rows = (rows.join(middle, "grp").join(sizes, "grp")
            .withColumn("bits", F.least(F.lit(BITS), F.greatest(F.lit(0), F.ceil(
                F.log2(F.col("n") / LEAF)))).cast("int"))
            .withColumn("p", F.expr("transform(p, (x, i) -> if(x > mid[i], '1', '0'))")))
    for t in trees:
        rows = rows.withColumn(f"t{t}", F.expr(f"concat_ws('', slice(p, {BITS * t + 1}, bits))"))
    rows = rows.select("k", "half", F.explode(F.array(*[
        F.concat_ws("|", "grp", F.lit(str(t)), f"t{t}") for t in trees])).alias("leaf"))
    rows = materialize(rows, "nn-leaf")
    count = rows.groupBy("leaf").agg(F.ceil(F.count("*") / (2.0 * LEAF)).alias("parts"))
    rows = rows.join(count, "leaf").select("k", "half", "leaf", F.pmod(
        F.xxhash64("k", "leaf", F.lit(seed)), F.col("parts")).alias("part"))
    lists = (rows.groupBy("leaf", "part")
             .agg(F.collect_list(F.struct("k", "half")).alias("m")).where("size(m) > 1").select("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for m in b.column(0).to_pylist():
                yield _edges(_best([r["k"] for r in m], [r["half"] for r in m], K))

    return lists.mapInArrow(run, "k long, nbr long, sim double")


def _top(edges: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("k").orderBy(F.desc("sim"), "nbr")
    return edges.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def descend(graph: DataFrame, nodes: DataFrame) -> tuple[DataFrame, int]:
    """One round: neighbours of neighbours. The new graph and the number of new entries."""
    last = graph.groupBy("k").agg(F.when(F.count("*") >= K, F.min("sim")).otherwise(-2.0)
                                  .alias("floor"))
    vec = nodes.select("k", "half").join(last, "k", "left").select(
        F.col("k").alias("nbr"), "half", F.coalesce("floor", F.lit(-2.0)).alias("floor"))
    both = _top(graph.select("k", "nbr", "sim").union(graph.select("nbr", "k", "sim"))
                .groupBy("k", "nbr").agg(F.max("sim").alias("sim")), 2 * K)
    lists = (both.join(vec, "nbr").groupBy("k")
             .agg(F.collect_list(F.struct("nbr", "half", "floor")).alias("m"))
             .where("size(m) > 1").select("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for m in b.column(0).to_pylist():
                rows += _best([r["nbr"] for r in m], [r["half"] for r in m], 4,
                              np.array([r["floor"] for r in m]))
            if rows:
                yield _edges(rows)

    found = lists.mapInArrow(run, "k long, nbr long, sim double")
    merged = (graph.select("k", "nbr", "sim", F.lit(0).alias("new"))
              .union(found.select("k", "nbr", "sim", F.lit(1)))
              .groupBy("k", "nbr").agg(F.max("sim").alias("sim"), F.min("new").alias("new")))
    out = materialize(_top(merged, K).select("k", "nbr", "sim", "new"), "nn-graph")
    return out.drop("new"), out.where("new = 1").count()


def exact(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of the candidate pairs whose cosine in double precision reaches the threshold."""
    rows = (pairs.select(F.least("k", "nbr").alias("a"), F.greatest("k", "nbr").alias("b"))
            .distinct().join(nodes.select(F.col("k").alias("a"), F.col("vec").alias("va")), "a")
            .join(nodes.select(F.col("k").alias("b"), F.col("vec").alias("vb")), "b")
            .select("a", "b", "va", "vb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = [float(_unit([x])[0] @ _unit([y])[0]) >= threshold for x, y in
                    zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(good, pa.bool_())),
                                              b.column(1).filter(pa.array(good, pa.bool_()))],
                                             ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def compare(some: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The nodes of (k) against all nodes of their labels, in blocks of bounded size. Rows
    (k, own, n, d, nbr): own, n and d are the linked rows and nodes of a compared node; not own,
    those that a node has among the compared ones; with nbr, a link. The links given are not all,
    but connect what all of them connect."""
    q = some.select("k").join(nodes.select("k", "grp", "vec", "mult"), "k")
    sizes = (nodes.groupBy("grp").agg(F.count("*").alias("n2"))
             .join(q.groupBy("grp").agg(F.count("*").alias("n1")), "grp")
             .select("grp", *[F.ceil(F.col(n) / (4.0 * BLOCK)).cast("int").alias(f"b{n[1]}")
                              for n in ("n1", "n2")]))

    def side(rows: DataFrame, at: int, own: str, other: str) -> DataFrame:
        mine, all_ = F.pmod(F.xxhash64("k"), F.col(own)), F.expr(f"sequence(0, {other} - 1)")
        rows = rows.join(sizes, "grp").withColumn("mine", mine.cast("int"))
        rows = rows.withColumn("other", F.explode(all_))
        i, j = ("mine", "other") if at == 0 else ("other", "mine")
        return rows.select("grp", F.col(i).alias("i"), F.col(j).alias("j"),
                           F.lit(at).alias("at"), "k", "vec", "mult")

    rows = (side(q, 0, "b1", "b2")
            .union(side(nodes.select("k", "grp", "vec", "mult"), 1, "b2", "b1"))
            .repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "at"))
    size = BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, one, two, out = None, [], [], []
        x = ids = mult = n = d = low = None

        def meet():
            """The nodes held against the block's compared nodes."""
            nonlocal x, ids, mult, n, d, low
            if one and x is None:
                x, ids = _unit([r[1] for r in one]), np.array([r[0] for r in one])
                mult = np.array([r[2] for r in one])
                n, d, low = (np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64),
                             np.arange(len(ids)))
            if one and two:
                k, m = np.array([r[0] for r in two]), np.array([r[2] for r in two])
                hit = x @ _unit([r[1] for r in two]).T >= threshold
                a, b = np.nonzero(hit & (ids[:, None] != k[None, :]))
                np.add.at(n, a, m[b])
                np.add.at(d, a, 1)
                rows, links = np.zeros(len(k), np.int64), np.bincount(b, minlength=len(k))
                np.add.at(rows, b, mult[a])
                got = np.flatnonzero(links)
                out.append(_compared(k[got], False, rows[got], links[got], None))
                before, last = low.copy(), None
                while last is None or (last != low).any():      # smallest name that is met
                    last, name = low.copy(), np.full(len(k), len(ids))
                    np.minimum.at(name, b, low[a])
                    np.minimum.at(low, a, name[b])
                new = np.flatnonzero(low != before)
                out.append(_compared(np.concatenate([k[got], ids[new]]), None, None, None,
                                     ids[np.concatenate([name[got], low[new]])]))
            two.clear()

        def close():
            nonlocal x
            meet()
            if one:
                out.append(_compared(ids, True, n, d, None))
            one.clear()
            x = None

        for batch in batches:
            for g, i, j, at, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (g, i, j) != block:
                    close()
                    block = (g, i, j)
                (one if at == 0 else two).append(row)
                if len(two) == size:
                    meet()
            yield from out
            out.clear()
        close()
        yield from out

    return rows.mapInArrow(run, MET)


def _compared(k, own, n, d, nbr) -> pa.RecordBatch:
    size = len(k)
    return pa.RecordBatch.from_arrays(
        [pa.array(k, pa.int64()), pa.array([own] * size, pa.bool_()),
         *[pa.nulls(size, pa.int64()) if c is None else pa.array(c, pa.int64())
           for c in (n, d, nbr)]], ["k", "own", "n", "d", "nbr"])


def counted(links: DataFrame, met: DataFrame, nodes: DataFrame) -> DataFrame:
    """(k, n, d): linked rows and nodes. Of a compared node all of them; of another node its
    links, and what the comparisons met."""
    sure = met.where("own").select("k").distinct()
    mult = nodes.select(F.col("k").alias("nbr"), F.col("mult").alias("m"))
    loose = (links.union(links.select("b", "a")).toDF("k", "nbr").distinct()
             .join(sure.toDF("nbr"), "nbr", "left_anti").join(mult, "nbr")
             .select("k", F.col("m").alias("n"), F.lit(1).cast("long").alias("d"))
             .union(met.where("not own").select("k", "n", "d")).join(sure, "k", "left_anti"))
    return (loose.union(met.where("own").select("k", "n", "d")).groupBy("k")
            .agg(F.sum("n").alias("n"), F.sum("d").alias("d")))


def plant(nodes: DataFrame, threshold: float, seed: int) -> DataFrame:
    """(k, grp, half, of): probes, each a copy of the node ``of`` turned to a cosine from
    ``threshold`` to ``threshold`` + NEAR; at most PROBES and about half of a label's nodes."""
    sizes = nodes.groupBy("grp").agg(F.least(F.lit(0.5), F.lit(float(PROBES)) / F.count("*"))
                                     .alias("share"))
    some = nodes.join(sizes, "grp").where(_spot(seed) < F.col("share")).select("k", "grp", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k, grp, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                v = _unit([raw])[0]
                r = np.random.default_rng([seed, k & 0xFFFFFFFFFFFFFFFF])
                side = r.standard_normal(len(v))
                side -= (side @ v) * v
                norm = np.linalg.norm(side)
                if len(v) > 1 and norm > 1e-6:
                    c = min(1.0, threshold + NEAR * r.random())
                    turned = c * v + np.sqrt(1 - c * c) * side / norm
                    name = hashlib.blake2b(k.to_bytes(8, "little", signed=True) + b"probe",
                                           digest_size=8).digest()
                    out.append((int.from_bytes(name, "little", signed=True), grp,
                                turned.astype(np.float16).tobytes(), k))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], t) for i, t in enumerate(
                    (pa.int64(), pa.string(), pa.binary(), pa.int64()))],
                ["k", "grp", "half", "of"])

    return some.mapInArrow(run, "k long, grp string, half binary, of long")


def _spot(seed: int):
    """A number from 0 to 1 by the hash of a node."""
    return F.pmod(F.xxhash64("k", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def planted(graph: DataFrame, probes: DataFrame, threshold: float) -> DataFrame:
    """(grp, t, f): probes of each label, and how many the graph names beside their nodes. Where
    a list of the two is full of links the probe counts as found, as such a node is compared with
    its whole label."""
    both = graph.select("k", "nbr").union(graph.select("nbr", "k"))
    full = (graph.where(F.col("sim") >= threshold - SLACK).groupBy("k").count()
            .where(F.col("count") >= K).select("k"))
    found = (probes.select("k", F.col("of").alias("nbr")).join(both, ["k", "nbr"], "left_semi")
             .select("k").union(probes.join(full, "k", "left_semi").select("k"))
             .union(probes.join(full.toDF("of"), "of", "left_semi").select("k")).distinct())
    return (probes.join(found.withColumn("hit", F.lit(1)), "k", "left").groupBy("grp")
            .agg(F.count("*").alias("t"), F.count("hit").alias("f")))


def sample(labels: DataFrame, nodes: DataFrame, met: DataFrame, seed: int) -> DataFrame:
    """About AUDIT nodes (k) of each label that are not compared yet."""
    rest = (nodes.select("k", "grp").join(labels, "grp", "left_semi")
            .join(met.where("own").select("k").distinct(), "k", "left_anti"))
    share = rest.groupBy("grp").agg((F.lit(float(AUDIT)) / F.count("*")).alias("share"))
    return rest.join(share, "grp").where(_spot(seed) < F.col("share")).select("k")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", threshold: float = 0.93) -> DataFrame:
    """(id_col, n_links, component_id, kept, recall), one row per input row; recall is the
    share of the planted probes that the search found."""
    small_batches(df.sparkSession)
    rows = materialize(_nodes(df, id_col, vec_col, label_col), "nn-row")
    nodes = materialize(rows.where("k is not null").groupBy("k").agg(
        F.first("grp").alias("grp"), F.first("vec").alias("vec"), F.first("half").alias("half"),
        F.count("*").alias("mult")), "nn-node")
    probes = materialize(plant(nodes, threshold, 77), "nn-probe")
    search = materialize(nodes.select("k", "grp", "half").union(
        probes.select("k", "grp", "half")), "nn-search")
    graph, links, labels = None, None, materialize(nodes.select("grp").distinct(), "nn-label")
    met, shares = df.sparkSession.createDataFrame([], MET), []
    names = probes.select("k")
    for attempt in range(TRIES):
        if attempt:                                # only the labels that are short
            search = materialize(search.join(labels, "grp", "left_semi"), "nn-search")
            graph = graph.join(search.select("k"), "k", "left_semi")
        n = search.count()
        fresh = start(search, attempt)
        fresh = fresh if graph is None else graph.select("k", "nbr", "sim").union(fresh)
        graph = materialize(_top(fresh.groupBy("k", "nbr").agg(F.max("sim").alias("sim")), K)
                            .drop("place"), "nn-graph")
        for _ in range(ROUNDS):
            graph, changed = descend(graph, search)
            if changed <= 0.01 * K * n:
                break
        close = graph.where(F.col("sim") >= threshold - SLACK).join(names, "k", "left_anti")
        new = exact(close.join(names.toDF("nbr"), "nbr", "left_anti").select("k", "nbr"), nodes,
                    threshold)
        links = materialize(new if links is None else links.union(new).distinct(), "nn-link")
        full = (close.groupBy("k").count().where(F.col("count") >= K)
                .join(met.where("own").select("k").distinct(), "k", "left_anti"))
        met = met.union(materialize(compare(full, nodes, threshold), "nn-met"))
        found = materialize(counted(links, met, nodes), "nn-found")
        some = sample(labels, nodes, met, attempt)
        seen = materialize(compare(some, nodes, threshold), "nn-met")
        met = met.union(seen)
        exactly = (seen.where("own").groupBy("k").agg(F.sum("d").alias("t"))
                   .join(found.select("k", "d"), "k", "left").join(nodes.select("k", "grp"), "k")
                   .groupBy("grp").agg(F.sum("t").alias("t2"), F.sum("d").alias("f2")))
        share = (labels.join(planted(graph, probes, threshold), "grp", "left")
                 .join(exactly, "grp", "left").na.fill(0))
        shares.append(materialize(share.withColumn("short", F.expr(
            f"f < {RECALL} * t or t2 >= {SEEN} and f2 < {RECALL} * t2")), "nn-share"))
        labels = materialize(shares[-1].where("short").select("grp"), "nn-short")
        if not labels.count():
            break
    else:
        short = (nodes.join(labels, "grp", "left_semi").select("k")
                 .join(met.where("own").select("k").distinct(), "k", "left_anti"))
        met = met.union(materialize(compare(short, nodes, threshold), "nn-met"))
    settled = [x if x is shares[-1] else x.where("not short") for x in shares]
    t, f = reduce(DataFrame.union, settled).agg(F.sum("t"), F.sum("f")).first()
    recall = f / t if t else 1.0
    comp = components(links.union(met.where("nbr is not null").select("k", "nbr")))
    info = (nodes.select("k", "mult").join(counted(links, met, nodes), "k", "left")
            .join(comp.withColumnRenamed("id", "k"), "k", "left")
            .select("k", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("links"),
                    F.coalesce("component", "k").alias("c")))
    out = rows.select("id", "k").join(info, "k", "left")
    low = out.where("c is not null and id is not null").groupBy("c").agg(F.min("id").alias("low"))
    out = out.join(low, "c", "left")
    cid = F.when(F.col("id").isNotNull(), F.coalesce("low", "id"))
    return out.select(F.col("id").alias(id_col),
                      F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      cid.alias("component_id"),
                      F.coalesce(F.col("id") == cid, F.lit(True)).alias("kept"),
                      F.lit(float(recall)).alias("recall"))
