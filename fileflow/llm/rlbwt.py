"""Exact substring dedup with run-compressed Burrows-Wheeler indexes (operator 6).

Every byte covered by a LENGTH-byte string that also starts anywhere else is removed.

1. Routing. The smallest hash of the GRAM-byte strings in a window depends on the window alone,
   so equal windows share it. Consecutive windows with the same smallest hash form a run: one
   row (h, hash of the run's bytes). Equal rows are repeated as a whole; rows whose h is alone
   cannot repeat. What is left (runs that share h but not all bytes: the rims of repeats) goes,
   with one representative of each repeated run, to the task of its h.
2. Index. A task joins the runs of many h to a text of bounded size and builds its
   Burrows-Wheeler transform (suffixes ordered by rank doubling), compressed to runs, with
   sampled run ends: the match length with the neighbouring suffix is measured only at the
   ends of runs, since inside a run it is the length one position earlier, less one. These
   matching statistics are streamed along the text, and positions of at least LENGTH marked.
3. An h with more than HOT different runs is not given to one task: its windows are hashed one
   by one and counted by a distributed aggregate instead, with the same result.

Strings are identified by 64-bit hashes in step 1 and byte by byte in step 2.

Defined cases: a null text counts as empty; texts under LENGTH bytes keep everything unless no
window of them repeats (they have none); repeated rows remove one another; matches never cross
documents; results depend on the text alone, so null or repeated ids are harmless.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_arrow, materialize, mix64, odd_constants, small_batches, text_bytes

LENGTH, GRAM = 200, 64
CHUNK = 1 << 20               # bytes of text hashed at a time
INDEX = 1 << 20               # bytes of text in one index, at least one h
HOT = 4000                    # different runs of one h that one task may get
_CODE = odd_constants(256, 77)
_BASE = int(odd_constants(1, 78)[0])
_BACK = pow(_BASE, -1, 1 << 64)
_CUT = 0xFF                   # never a byte of UTF-8


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(max(n, 1), np.uint64(base), dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


class Rolling:
    """Hashes of substrings of one chunk from prefix sums."""

    def __init__(self, b: np.ndarray):
        self.total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(
            _CODE[b] * _powers(_BASE, len(b)), dtype=np.uint64)))
        self.back = _powers(_BACK, len(b) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.total[end] - self.total[start]) * self.back[start]
        return mix64(raw + (end - start).astype(np.uint64) * _CODE[0])


def _slide_min(h: np.ndarray, width: int) -> np.ndarray:
    m, done = h, 1
    while 2 * done <= width:
        m = np.minimum(m[:-done], m[done:])
        done *= 2
    rest = width - done
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def window_runs(b: np.ndarray, first: np.ndarray, last: np.ndarray, length: int):
    """Runs of windows of a chunk: h, start, windows, run hash, and whether h occurs twice in it.

    ``first`` / ``last``: bounds of the documents in the chunk; windows never cross them.
    """
    wide = length - GRAM + 1
    roll = Rolling(b)
    at = np.arange(len(b) - GRAM + 1)
    h = roll.of(at, at + GRAM)
    low = _slide_min(h, wide)
    valid = np.zeros(len(low) + 1, dtype=np.int8)
    ok = last - first >= length
    np.add.at(valid, first[ok], 1)
    np.add.at(valid, last[ok] - length + 1, -1)
    valid = np.cumsum(valid[:-1]) > 0
    edge = np.zeros(len(low) + 1, dtype=bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = (low[1:] != low[:-1]) | (valid[1:] != valid[:-1])
    edge[first[ok]] = True
    cut = np.flatnonzero(edge)
    start, n = cut[:-1], np.diff(cut)
    keep = valid[start]
    start, n = start[keep], n[keep]
    masked = np.where(valid, low, np.uint64(0))
    pad = np.zeros(wide - 1, np.uint64)
    high = ~_slide_min(~np.concatenate((pad, masked, pad)), wide)
    chosen, count = np.unique(h[h == high[:len(h)]], return_counts=True)
    twice = np.isin(low[start], chosen[count > 1])
    return low[start], start, n, roll.of(start, start + n + length - 1), twice


def runs(docs: DataFrame, length: int) -> DataFrame:
    """(h, g, c, lo, n, twice) of all texts; c names the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = batch.column(0).to_numpy()
            buf, off = text_bytes(batch.column(1))
            for d, b, first, last, shift in _chunks(buf, off, length):
                h, start, n, g, twice = window_runs(b, first, last, length)
                who = np.searchsorted(first, start, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(g.view(np.int64)),
                     pa.array(c[d[who]]), pa.array(start - first[who] + shift[who]),
                     pa.array(n.astype(np.int64)), pa.array(twice)],
                    ["h", "g", "c", "lo", "n", "twice"])

    return docs.mapInArrow(run, "h long, g long, c long, lo long, n long, twice boolean")


def _chunks(buf: np.ndarray, off: np.ndarray, length: int):
    """Chunks of whole short documents, or of parts of a long one that overlap by length - 1.

    Yields document numbers, bytes, bounds in the chunk, and each part's place in its text.
    """
    parts = []
    for d, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        for s in range(a, max(a + 1, b - length + 1), CHUNK):
            e = min(b, s + CHUNK + length - 1)
            if e - s >= length:
                parts.append((d, s, e, s - a))
    held, size = [], 0
    for p in parts + [None]:
        if held and (p is None or size + p[2] - p[1] > CHUNK + length):
            b = np.concatenate([buf[s:e] for _, s, e, _ in held])
            ends = np.cumsum([e - s for _, s, e, _ in held])
            yield (np.array([x[0] for x in held]), b, np.concatenate(([0], ends[:-1])), ends,
                   np.array([x[3] for x in held]))
            held, size = [], 0
        if p:
            held.append(p)
            size += p[2] - p[1]


class RunIndex:
    """Run-compressed BWT of a text, with match lengths sampled at the ends of its runs."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        padded = np.concatenate((text, np.full(8, _CUT, np.uint8)))
        word = np.zeros(n, np.uint64)
        for k in range(8):
            word = (word << np.uint64(8)) | padded[k:k + n]
        self.word, self.levels = word, []
        order, rank = self._ranks(word)
        width = 8
        while width < depth and rank[order[-1]] + 1 < n:
            self.levels.append((width, rank))
            after = np.full(n, n, np.int64)       # past the end: last, like the cut byte
            after[:max(0, n - width)] = rank[width:]
            order, rank = self._ranks(rank * (n + 1) + after)
            width *= 2
        if not self.levels:
            self.levels.append((8, rank))
        self.order, self.n = order, n
        before = np.concatenate((np.full(1, _CUT, np.uint8), text[:-1]))
        bwt = before[order]
        tied = rank[order]
        new = np.ones(n + 1, dtype=bool)          # a run begins at this row
        new[1:-1] = (bwt[1:] != bwt[:-1]) | (bwt[1:] == _CUT)
        # suffixes alike to the sorted depth have no true order: measured one by one, and so
        # are the positions after them
        same = np.zeros(n + 1, dtype=bool)
        same[1:-1] = tied[1:] == tied[:-1]
        loose = np.zeros(n + 1, dtype=bool)
        loose[order] = same[:-1] | same[1:]
        loose[1:] |= loose[:-1].copy()
        loose = loose[order]
        self.heads = np.flatnonzero(new[:-1] | loose)
        self.tails = np.flatnonzero(new[1:] | loose)

    @staticmethod
    def _ranks(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(key, kind="stable")
        k = key[order]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(k[1:] != k[:-1])))
        return order, rank

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b (whole words of 8 first)."""
        size = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        width, rank = self.levels[-1]
        while len(live):                          # the widest level, again and again
            x, y = a[live] + size[live], b[live] + size[live]
            inside = np.maximum(x, y) < self.n
            live, x, y = live[inside], x[inside], y[inside]
            same = rank[x] == rank[y]
            live = live[same]
            size[live] += width
        for width, rank in reversed(self.levels):
            x, y = a + size, b + size
            inside = np.maximum(x, y) < self.n
            x, y = np.minimum(x, self.n - 1), np.minimum(y, self.n - 1)
            size += np.where(inside & (rank[x] == rank[y]), width, 0)
        x, y = a + size, b + size
        inside = np.maximum(x, y) < self.n
        x, y = np.minimum(x, self.n - 1), np.minimum(y, self.n - 1)
        diff = self.word[x] ^ self.word[y]
        extra = np.zeros(len(a), np.int64)
        for k in range(1, 8):
            extra += diff >> np.uint64(64 - 8 * k) == 0
        return size + np.where(inside, extra, 0)

    def statistics(self) -> np.ndarray:
        """Longest match elsewhere of the suffix at each position, streamed from run ends."""
        best = np.zeros(self.n, np.int64)
        for rows, side in ((self.heads, -1), (self.tails, 1)):
            other = rows + side
            ok = (other >= 0) & (other < self.n)
            here = self.order[rows]
            value = np.zeros(len(rows), np.int64)
            value[ok] = self.common(here[ok], self.order[other[ok]])
            last = np.full(self.n, -1, np.int64)
            last[here] = here
            last = np.maximum.accumulate(last)
            at = np.zeros(self.n, np.int64)
            at[here] = value
            best = np.maximum(best, at[last] - (np.arange(self.n) - last))
        return best


def repeats(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each byte string, the window starts whose ``length`` bytes start elsewhere too."""
    size = np.array([len(p) for p in parts])
    text = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8)
    stat = RunIndex(text, length).statistics() >= length
    begin = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    return [np.flatnonzero(stat[a:a + max(0, s - length + 1)])
            for a, s in zip(begin.tolist(), size.tolist())]


def _covered(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Merged intervals of [start, start + length)."""
    gap = np.flatnonzero(np.diff(starts) > length)
    return starts[np.concatenate(([0], gap + 1))], starts[np.append(gap, len(starts) - 1)] + length


_MARK = "c long, lo long, hi long"


def _marks(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([r[0] for r in rows]) if rows else [], pa.int64()),
         pa.array(np.concatenate([r[1] for r in rows]) if rows else [], pa.int64()),
         pa.array(np.concatenate([r[2] for r in rows]) if rows else [], pa.int64())],
        ["c", "lo", "hi"])


def indexed(rims: DataFrame, length: int) -> DataFrame:
    """Marks (c, lo, hi) of the rims, from one index for each bounded lot of h."""
    rows = rims.repartition("h").sortWithinPartitions("h", "c", "lo")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close():
            out = []
            for (c, lo, _), at in zip(held, repeats([x[2] for x in held], length), strict=True):
                if len(at):
                    s, e = _covered(at, length)
                    out.append((np.full(len(s), c), s + lo, e + lo))
            return _marks(out)

        held, size, last = [], 0, (None, None, None)
        for b in batches:
            for h, c, lo, seg in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if (h, c, lo) == last:                 # a copy of the document
                    continue
                if h != last[0] and size >= INDEX:
                    yield close()
                    held, size = [], 0
                last = (h, c, lo)
                held.append((c, lo, seg))
                size += len(seg) + 1
        if held:
            yield close()

    return rows.select("h", "c", "lo", "seg").mapInArrow(run, _MARK)


def counted(rims: DataFrame, length: int) -> DataFrame:
    """Marks of the rims of hot h: windows hashed one by one and counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, c, lo, seg in zip(*(x.to_pylist() for x in b.columns), strict=True):
                x = np.frombuffer(seg, np.uint8)
                at = np.arange(len(x) - length + 1)
                key = Rolling(x).of(at, at + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.full(len(at), c)),
                     pa.array(at + lo)], ["key", "c", "lo"])

    rows = rims.select("h", "c", "lo", "seg").mapInArrow(run, "key long, c long, lo long")
    rows = rows.distinct()
    again = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(again, "key").select("c", "lo", (F.col("lo") + length).alias("hi"))


def intervals(docs: DataFrame, length: int) -> DataFrame:
    """(c, spans): merged byte intervals to remove from each text; docs: (c, text)."""
    one = Window.partitionBy("h", "g").orderBy("c", "lo")
    both, all_h = Window.partitionBy("h", "g"), Window.partitionBy("h")
    rows = (runs(docs, length).repartition("h")
            .withColumn("same", F.count("*").over(both)).withColumn("place", F.row_number().over(one))
            .withColumn("sharing", F.count("*").over(all_h))
            .withColumn("least", F.min("same").over(all_h))
            .withColumn("kinds", F.sum(F.when(F.col("place") == 1, 1).otherwise(0)).over(all_h))
            .withColumn("rim", F.expr("same = 1 and (sharing > 1 or twice)"))
            .withColumn("rep", F.expr("same > 1 and place = 1 and (least = 1 or twice)"))
            .where("same > 1 or rim")
            .select("h", "c", "lo", "n", (F.col("same") > 1).alias("whole"),
                    (F.col("rim") | F.col("rep")).alias("sent"),
                    (F.col("kinds") > HOT).alias("hot")))
    rows = materialize(rows, "bwt-run")
    whole = rows.where("whole").select("c", "lo", (F.col("lo") + F.col("n") + length - 1).alias("hi"))
    want = (rows.where("sent").groupBy("c")
            .agg(F.collect_list(F.struct("h", "lo", "n", "hot")).alias("want")))
    found = docs.join(want, "c").select("c", "text", "want")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            buf, off = text_bytes(b.column(1))
            for i, (c, want) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist())):
                for w in want:
                    a = int(off[i]) + w["lo"]
                    out.append((w["h"], c, w["lo"], w["hot"],
                                buf[a:a + w["n"] + length - 1].tobytes()))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("h", "c", "lo", "hot", "seg"), r)) for r in out], schema=_RIM)

    rims = materialize(found.mapInArrow(run, "h long, c long, lo long, hot boolean, seg binary"),
                       "bwt-rim")
    marks = whole.union(indexed(rims.where("not hot"), length)).union(
        counted(rims.where("hot"), length))
    lists = (marks.groupBy("c", "lo").agg(F.max("hi").alias("hi"))
             .groupBy("c").agg(F.collect_list(F.struct("lo", "hi")).alias("m")))

    def merged(b: pa.RecordBatch):
        out = []
        for m in b.column(1).to_pylist():
            spans: list = []
            for lo, hi in sorted((x["lo"], x["hi"]) for x in m):
                if spans and lo <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], hi)
                else:
                    spans.append([lo, hi])
            out.append([{"start": s, "end": e} for s, e in spans])
        return [pa.array(out, _SPANS)]

    return append_arrow(lists.select("c", "m"), [("spans", _SPANS_SPARK)], merged).select("c", "spans")


_RIM = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("lo", pa.int64()), ("hot", pa.bool_()),
                  ("seg", pa.binary())])
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_SPANS_SPARK = T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                         T.StructField("end", T.LongType())]))


def dedup(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with ``removed`` (byte spans) and ``kept`` (the bytes left)."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    found = materialize(intervals(docs.select(F.xxhash64(text).alias("c"), text.alias("text")),
                                  length), "bwt-span")
    rows = docs.join(found.toDF("bwt__c", "bwt__spans"),
                     F.xxhash64(text) == F.col("bwt__c"), "left").drop("bwt__c")

    def run(b: pa.RecordBatch):
        buf, off = text_bytes(b.column(b.schema.get_field_index(text_col)))
        spans = b.column(b.schema.get_field_index("bwt__spans")).to_pylist()
        kept = []
        for i, s in enumerate(spans):
            raw = buf[off[i]:off[i + 1]].tobytes()
            at, out = 0, []
            for x in s or []:
                out.append(raw[at:x["start"]])
                at = x["end"]
            kept.append(b"".join([*out, raw[at:]]))
        return [pa.array([s or [] for s in spans], _SPANS), pa.array(kept, pa.binary())]

    return append_arrow(rows, [("removed", _SPANS_SPARK), ("kept", T.BinaryType())],
                        run).drop("bwt__spans")
