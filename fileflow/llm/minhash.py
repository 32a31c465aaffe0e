"""MinHash near-dedup by a multi-index Hamming join (operator 3).

Every distinct shingle set gets a signature of 70 b-bit (b = 8) minima. Signatures are split
into 14 chunks of 5 symbols. If two signatures differ in at most 27 symbols, some chunk has at
most one error (pigeonhole: 14 chunks with two errors each would be 28), so the two agree on
4 of its 5 symbols. Enumerating the one allowed error position gives 70 keys per signature, and
every pair within distance 27 meets under one of them. At similarity 0.8 a signature differs
in 14 symbols on average, so a true pair lies beyond 27 with a chance of 3e-5.

Pairs that meet and are within distance 27 are confirmed on full sets, in bounded blocks of
documents; a set is sent only where its signature has such a partner, and for a pair that meets
in many buckets only to the one of its lowest shared key. Equal sets are one class from the start. First each class meets the smallest class of its buckets; then only buckets
whose members are still in different components are compared, all pairs in blocks, and a block
returns a spanning forest of the links found. No pair of different components within the distance
is left out, and no list of all pairs of a bucket is ever written.

Defined cases: null or blank texts have no shingles, form their own component and are kept;
rows with a null id are counted, link with nothing, have a null component and are kept;
repeated rows with one id share their component, and each of them is kept if the id is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .common import (
    among,
    append_arrow,
    components,
    light,
    materialize,
    odd_constants,
    small_batches,
    text_bytes,
)
from .shingles import shingle_sets

CHUNKS, CHUNK = 14, 5
SYMBOLS = CHUNKS * CHUNK
#: Pairs of signatures that differ in at most so many symbols always become candidates.
MAX_DISTANCE = 2 * CHUNKS - 1
BLOCK = 1 << 19               # shingles (plus 256 a document) in a block of documents
MATRIX = 1 << 23              # cells of a dense block matrix
_MUL, _XOR = odd_constants(SYMBOLS, 101), odd_constants(SYMBOLS, 202)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, SYMBOLS) bytes; rows of empty sets are zero."""
    size = np.array([len(s) for s in sets])
    sig = np.zeros((len(sets), SYMBOLS), dtype=np.uint8)
    full = np.flatnonzero(size)
    if len(full):
        x = np.concatenate([sets[i] for i in full])
        starts = np.concatenate(([0], np.cumsum(size[full])[:-1]))
        for k in range(SYMBOLS):
            low = np.minimum.reduceat((x ^ _XOR[k]) * _MUL[k], starts)
            sig[full, k] = (low * _MUL[0]) >> np.uint64(56)
    return sig


def _set_key(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little",
                          signed=True)


def _sets_of(batch: pa.RecordBatch, text_col: str, words: int) -> list[np.ndarray]:
    col = batch.column(batch.schema.get_field_index(text_col))
    return shingle_sets(*text_bytes(col), words)


def sketch(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, n_shingles, k, sig): k names the exact shingle set, null for an empty one."""
    small_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(b: pa.RecordBatch):
        sets = _sets_of(b, "text", words)
        sig = signatures(sets)
        return [pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_set_key(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([r.tobytes() if len(s) else None for r, s in zip(sig, sets)],
                         pa.binary())]

    return append_arrow(base, [("n_shingles", T.LongType()), ("k", T.LongType()),
                               ("sig", T.BinaryType())], run).drop("text")


def keys(classes: DataFrame) -> DataFrame:
    """(key, k, n): for each chunk and allowed error position, the other four symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(2).to_pylist()), dtype=np.uint8)
            sig = sig.reshape(-1, CHUNKS, CHUNK).astype(np.int64)
            out = []
            for e in range(CHUNK):
                rest = [i for i in range(CHUNK) if i != e]
                packed = sum(sig[:, :, i] << (8 * j) for j, i in enumerate(rest))
                out.append(packed | ((np.arange(CHUNKS) * CHUNK + e) << 32)[None, :])
            key = np.concatenate(out, axis=1)
            rep = key.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel()), pa.array(np.repeat(b.column(0).to_numpy(), rep)),
                 pa.array(np.repeat(b.column(1).to_numpy(), rep))], ["key", "k", "n"])

    return classes.select("k", "n", "sig").mapInArrow(run, "key long, k long, n long")


def forest(ids: np.ndarray, side: np.ndarray, comp: np.ndarray, sets: list[np.ndarray],
           percent: int) -> list[tuple[int, int]]:
    """Links that join documents of different components, thinned to a spanning forest.

    ``side``: 0 and 1 compare only across; equal values all round compare all pairs.
    """
    n = len(ids)
    if n < 2 or len(np.unique(comp)) < 2:
        return []
    size = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), size)
    _, col, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[col] > 1
    col, owner = np.unique(col[shared], return_inverse=True)[1], owner[shared]
    if not len(col):
        return []
    inter = np.zeros((n, n), dtype=np.float32)
    order = np.argsort(col, kind="stable")
    col, owner = col[order], owner[order]
    width = max(1, MATRIX // n)
    for lo in range(0, int(col[-1]) + 1, width):
        a, b = np.searchsorted(col, [lo, lo + width])
        m = np.zeros((n, min(width, int(col[-1]) + 1 - lo)), dtype=np.float32)
        m[owner[a:b], col[a:b] - lo] = 1
        inter += m @ m.T
    hit = inter.astype(np.int64)
    hit = (100 * hit >= percent * (size[:, None] + size[None, :] - hit))
    hit &= comp[:, None] != comp[None, :]
    if side.any() and not side.all():
        hit &= side[:, None] != side[None, :]
    links, seen = [], np.zeros(n, dtype=bool)
    for root in range(n):
        if seen[root]:
            continue
        seen[root], todo = True, [root]
        while todo:
            at = todo.pop()
            new = np.flatnonzero(hit[at] & ~seen)
            seen[new] = True
            links += [(int(ids[at]), int(ids[x])) for x in new]
            todo += new.tolist()
    return links


def blocks(groups: DataFrame) -> DataFrame:
    """(g, i, j, blk, comp, k): a group's rows dealt to pairs of blocks of bounded size."""
    w = Window.partitionBy("g").orderBy("k")
    weight = F.col("n") + 256
    return (groups
            .withColumn("blk", F.floor((F.sum(weight).over(w) - weight) / BLOCK).cast("int"))
            .withColumn("top", F.max("blk").over(Window.partitionBy("g")))
            .withColumn("other", F.explode(F.expr("sequence(0, top)")))
            .select("g", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"),
                    "blk", "comp", "k"))


def _per_block(fn, names: list[str]):
    """Batches of rows (g, i, j, blk, comp, k, bytes) sorted by (g, i, j) -> rows of
    ``fn(g, side, comp, k, bytes)`` for each block pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close():
            if at is None or not held:
                return []
            return fn(at[0], np.array([x[0] != at[1] for x in held]),
                      np.array([x[1] for x in held]), np.array([x[2] for x in held]),
                      [x[3] for x in held])

        def rows(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names)

        at, held, found = None, [], []
        for b in batches:
            for g, i, j, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (g, i, j) != at:
                    found += close()
                    at, held = (g, i, j), []
                held.append(row)
            if found:
                yield rows(found)
                found = []
        yield rows(close())
    return run


def first_shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The lowest key prefix (chunk and error position, as in ``keys``) that row pairs of
    signatures share; they share one if they are within MAX_DISTANCE."""
    off = (x != y).reshape(-1, CHUNKS, CHUNK)
    wrong = off.sum(axis=2)
    chunk = np.argmax(wrong <= 1, axis=1)
    one = np.arange(len(off))
    return chunk * CHUNK + np.where(wrong[one, chunk] == 1, off[one, chunk].argmax(axis=1), 0)


def near_members(g: int, side: np.ndarray, comp: np.ndarray, sigs: list[bytes]) -> np.ndarray:
    """Rows of bucket ``g`` with a partner of another component within MAX_DISTANCE, for pairs
    whose lowest shared key is ``g``: a pair that meets in many buckets is looked at in one."""
    sig = np.frombuffer(b"".join(sigs), dtype=np.uint8).reshape(-1, SYMBOLS)
    across, near = side.any() and not side.all(), np.zeros(len(sig), dtype=bool)
    step = max(1, MATRIX // (len(sig) * SYMBOLS))
    for a in range(0, len(sig), step):
        hit = (sig[a:a + step, None, :] != sig[None, :, :]).sum(axis=2) <= MAX_DISTANCE
        hit &= comp[a:a + step, None] != comp[None, :]
        if across:
            hit &= side[a:a + step, None] != side[None, :]
        x, y = np.nonzero(hit)
        near[a + x[first_shared(sig[a + x], sig[y]) == g >> 32]] = True
    return near


def close_by(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows (g, k) of buckets (g, k, n, comp) that have a partner of another component within
    MAX_DISTANCE whose lowest shared key is g: only their full sets need to be sent."""
    rows = (blocks(groups).join(classes.select("k", "sig"), "k")
            .select("g", "i", "j", "blk", "comp", "k", "sig")
            .repartition("g", "i", "j").sortWithinPartitions("g", "i", "j"))

    def fn(g, side, comp, k, sigs):
        return [(g, x) for x in k[near_members(g, side, comp, sigs)].tolist()]

    return rows.mapInArrow(_per_block(fn, ["g", "k"]), "g long, k long").distinct()


def confirm(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) links inside the groups (g, k, n, comp), compared in blocks of bounded size."""
    # where to send each set; the sets move once if it can be broadcast, else also to meet it
    rows = light(materialize(blocks(groups), "mh-block"))
    rows = (sets.join(rows, "k").select("g", "i", "j", "blk", "comp", "k", "s")
            .repartition("g", "i", "j").sortWithinPartitions("g", "i", "j"))

    def fn(g, side, comp, k, s):
        return forest(k, side, comp, [np.frombuffer(x, dtype=np.uint64) for x in s], percent)

    return rows.mapInArrow(_per_block(fn, ["a", "b"]), "a long, b long")


def near_pairs(star: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of (k, n, rep) whose signatures (k, sig) are within MAX_DISTANCE."""
    centre = materialize(star.select("rep").distinct().join(
        classes.select(F.col("k").alias("rep"), F.col("sig").alias("mid")), "rep"), "mh-centre")
    rows = star.join(classes.select("k", "sig"), "k").join(light(centre), "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8)
                    .reshape(-1, SYMBOLS) for c in (3, 4))
            near = (x != y).sum(axis=1) <= MAX_DISTANCE
            yield pa.RecordBatch.from_arrays(b.columns[:3], ["k", "n", "rep"]).filter(
                pa.array(near))

    return rows.select("k", "n", "rep", "sig", "mid").mapInArrow(run, "k long, n long, rep long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 5, percent: int = 80) -> DataFrame:
    """(id_col, n_shingles, component_id, kept), one row per input row."""
    d = materialize(sketch(docs, id_col, text_col, words), "mh-sketch")
    classes = (d.where("k is not null and id is not null").groupBy("k")
               .agg(F.min("id").alias("cid"), F.first("n_shingles").alias("n"),
                    F.first("sig").alias("sig")))
    classes = materialize(classes, "mh-class")
    w = Window.partitionBy("key")
    buckets = (keys(classes).withColumn("m", F.min("k").over(w))
               .withColumn("x", F.max("k").over(w)).where("m < x").select("key", "k", "n", "m"))
    buckets = materialize(buckets, "mh-bucket")
    members = buckets.groupBy("k").agg(F.first("n").alias("n"), F.min("m").alias("rep"))
    members = materialize(members, "mh-member")
    # only classes of some bucket go on
    members = materialize(classes.select("k", "cid", "sig").join(light(members), "k"), "mh-member")
    star = materialize(near_pairs(members.where("rep < k").select("k", "n", "rep"), members),
                       "mh-star")
    # one document stands for each class; its set is made again from its text
    wanted = members.select(F.col("cid").alias("id"), F.col("k").alias("want"))
    n_wanted = wanted.count()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if n_wanted > common.BROADCAST_IDS:
        texts = among(texts, "id", wanted, "id")[0]
    texts = texts.join(light(wanted), "id")

    def with_set(b: pa.RecordBatch):
        sets = _sets_of(b, "text", words)
        return [pa.array([_set_key(s) for s in sets], pa.int64()),
                pa.array([s.tobytes() for s in sets], pa.binary())]

    sets = append_arrow(texts, [("k", T.LongType()), ("s", T.BinaryType())], with_set)
    sets = materialize(sets.where("k = want").select("k", "s"), "mh-set")
    if sets.count() > n_wanted:              # rows that repeat an id
        sets = materialize(sets.groupBy("k").agg(F.first("s").alias("s")), "mh-set")

    star = _with_centres(star, members)
    links = materialize(confirm(star, sets, percent), "mh-link")
    comp = components(links)

    label = members.select("k", "rep").join(comp, F.col("k") == F.col("id"), "left").select(
        "k", "rep", F.coalesce("component", "k").alias("comp"))
    rest = buckets.join(light(materialize(label, "mh-label")), "k")
    mixed = (rest.groupBy("key").agg(
        F.count("*").alias("size"), F.min("comp").alias("c0"), F.max("comp").alias("c1"),
        F.sum(F.xxhash64("k").cast("decimal(38,0)")).alias("f1"),
        F.bit_xor(F.xxhash64("k", F.lit(7))).alias("f2"),
        F.min("k").alias("k0"), F.max(F.struct("k", "rep")).alias("k1"))
        .where("c0 < c1 and not (size = 2 and k1.rep = k0)")
        .groupBy("size", "f1", "f2").agg(F.min("key").alias("key")))
    mixed = light(materialize(mixed.select("key"), "mh-mixed"))
    groups = materialize(rest.join(mixed, "key").select(
        F.col("key").alias("g"), "k", "n", "comp"), "mh-group")
    groups = groups.join(close_by(groups, members), ["g", "k"])
    more = materialize(confirm(groups, sets, percent), "mh-link")
    comp = components(links.union(more))

    # the smallest id is found per class, so rows meet it by their own class, never all the rows
    # of a component at one place
    info = classes.select("k", "cid").join(comp, F.col("k") == F.col("id"), "left").select(
        "k", "cid", F.coalesce("component", "k").alias("c"))
    low = info.groupBy("c").agg(F.min("cid").alias("low"))
    out = d.join(info.join(low, "c").select("k", "low"), "k", "left")
    cid = F.when(F.col("id").isNotNull(), F.coalesce("low", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", cid.alias("component_id"),
                      F.coalesce(F.col("id") == cid, F.lit(True)).alias("kept"))


def _with_centres(star: DataFrame, members: DataFrame) -> DataFrame:
    """Groups (g, k, n, comp) of each smallest class and the classes that point to it."""
    centre = star.select(F.col("rep").alias("k")).distinct().join(members, "k")
    return (star.select(F.col("rep").alias("g"), "k", "n")
            .union(centre.select(F.col("k").alias("g"), "k", "n"))
            .withColumn("comp", F.col("k")))
