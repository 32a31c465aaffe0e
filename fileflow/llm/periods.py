"""Periodic run detection by a sparse diagonal DP over words (operator 11).

Word i and an equal word i - d form a cell of diagonal d; a cell's match length is that of the
cell before it on the diagonal plus one. A diagonal that ends with enough matches is a run of
period d: m matches cover m + d words. Enough are max(12 - d, d), as a run has 12 words and two
periods at least. Words are read in order, and the cells kept are few:

* Lags below 12 stay active at every word; their match lengths are counts of equal neighbours.
* A longer lag becomes active at a word only where the next k words occurred ``lag`` words
  earlier, k <= lag < 2k, k = 12, 24, 48, ...: fewer matches in a row are no run. It becomes
  active where its matches begin (the words before differ), so each stretch of a diagonal is
  opened once; equal k-grams inside one long repetition, whose number is quadratic, are passed
  over block by block. The diagonal is then followed to its end, which emits the run.
* A stretch that a run of a smaller period, which began at the same word, covers has that smaller
  period and is none of its own.

Grams are compared by 64-bit names within a document; each run is confirmed word by word. Time and
memory are near-linear in the words of a text, also where the text is one word over and over.

Defined cases: a null or empty text has no words, no runs, and an empty collapsed text. Rows are
treated one by one, so null ids, repeated rows and ties change nothing; runs are sorted by start,
then period. Columns named like the ones added are replaced. Texts of any length are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_arrow, mix64, odd_constants, small_batches, text_bytes

#: A run has this many words at least, and two periods.
MIN_WORDS = 12

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType())
                                 for n in ("start", "length", "period")]))

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MIX = odd_constants(8, 41)


def split_words(buf: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, as one binary array, and the n + 1 offsets of texts into it."""
    black = ~_SPACE[buf]
    start = black.copy()
    start[1:] &= ~black[:-1]
    edges = off[:-1][off[:-1] < len(buf)]
    start[edges] = black[edges]
    at = np.flatnonzero(start)
    packed = np.concatenate((np.zeros(1, np.int64), np.cumsum(black)))   # bytes without spaces
    ends = np.concatenate((packed[at], packed[-1:])).astype(np.int64)
    if not len(at):
        ends = np.zeros(1, np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [
        None, pa.py_buffer(ends.tobytes()), pa.py_buffer(buf[black].tobytes())])
    return words, np.searchsorted(at, off)


def _dense(w: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Runs of periods below MIN_WORDS as rows (first word, end, period)."""
    out = []
    for d in range(1, min(MIN_WORDS, len(w))):
        hit = np.flatnonzero(w[d:] == w[:-d])
        if not len(hit):
            continue
        cut = np.flatnonzero(np.diff(hit) != 1)
        first = hit[np.concatenate(([0], cut + 1))]
        end = hit[np.concatenate((cut, [len(hit) - 1]))] + 1 + d
        ok = (end - first - d >= max(MIN_WORDS - d, d)) & (doc[first] == doc[end - 1])
        first, end = first[ok], end[ok]
        ok = ends[first] < end
        first, end = first[ok], end[ok]
        ends[first] = end
        out.append(np.stack((first, end, np.full(len(first), d)), axis=1))
    return out


def _join(a: np.ndarray, step: int, level: int, b: np.ndarray | None = None) -> np.ndarray:
    """Names of grams made of the gram at i and the one at i + step."""
    b = a if b is None else b
    m = min(len(a), len(b) - step)
    return mix64(a[:m] * _MIX[level % 8] + b[step:step + m]) if m > 0 else np.zeros(0, np.uint64)


def _repeated(names: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The positions ``at`` whose name occurs twice there."""
    x = names[at]
    bits = max(8, int(len(at)).bit_length() + 1)
    bucket = (x >> np.uint64(64 - bits)).astype(np.int64)
    at = at[np.bincount(bucket, minlength=1 << bits)[bucket] > 1]      # a cheap first sieve
    x = names[at]
    order = np.argsort(x, kind="stable")
    y = x[order]
    same = np.zeros(len(y) + 1, dtype=bool)
    same[1:-1] = y[1:] == y[:-1]
    return at[order[same[1:] | same[:-1]]]                             # by name, then position


def _openings(w: np.ndarray, names: np.ndarray, at: np.ndarray, k: int):
    """Pairs (u, v) of equal k-grams, k <= v - u < 2k, before which the words differ. ``at``:
    positions sorted by name, then position."""
    x = names[at]
    new = np.concatenate(([True], x[1:] != x[:-1]))
    group = np.cumsum(new)
    before = w[at - 1]
    block = new.copy()
    block[1:] |= before[1:] != before[:-1]
    block = np.maximum.accumulate(np.where(block, np.arange(len(at)), 0))
    place = group * np.int64(len(w) + 1) + at
    cur = np.arange(len(at))
    ptr = np.searchsorted(place, place - k, side="right") - 1
    us, vs = [], []
    while len(cur):
        ok = ptr >= 0
        ok[ok] = (group[ptr[ok]] == group[cur[ok]]) & (at[cur[ok]] - at[ptr[ok]] < 2 * k)
        cur, ptr = cur[ok], ptr[ok]
        differ = before[ptr] != before[cur]
        us.append(at[ptr[differ]])
        vs.append(at[cur[differ]])
        ptr = np.where(differ, ptr, block[ptr]) - 1
    return np.concatenate(us or [at[:0]]), np.concatenate(vs or [at[:0]])


def _follow(w: np.ndarray, u: int, v: int) -> int:
    """Number of equal words from u and from v on; a mark after each text ends it."""
    n, step = 0, 64
    while True:
        y = w[v + n:v + n + step]
        differ = w[u + n:u + n + len(y)] != y
        at = int(differ.argmax()) if len(differ) else 0
        if not len(differ) or differ[at]:
            return n + at
        n += step
        step *= 2


def _sparse(w: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Runs of periods from MIN_WORDS on as rows (first word, end, period). ``w`` starts with a
    mark and has one after each text; no two marks are equal."""
    x = mix64((w + np.int64(1 << 40)).astype(np.uint64) + mix64(doc.astype(np.uint64)))
    two = _join(x, 1, 1)
    four = _join(two, 2, 2)
    names = _join(_join(four, 4, 3), 8, 4, four)
    k, out = MIN_WORDS, []
    at = _repeated(names, np.arange(1, len(names)))
    while len(at):
        u, v = _openings(w, names, at, k)
        d = v - u
        inside = v + d - k < len(names)
        u, v, d = u[inside], v[inside], d[inside]
        ok = (names[u + d - k] == names[v + d - k]) & (doc[u] == doc[v]) & (ends[u] < v + d)
        rows = []
        for a, b in zip(u[ok].tolist(), v[ok].tolist()):
            m = _follow(w, a, b)
            if m >= b - a:
                rows.append((a, b + m, b - a))
        if rows:
            out.append(np.array(rows, dtype=np.int64))
            np.maximum.at(ends, out[-1][:, 0], out[-1][:, 1])
        live = np.zeros(len(names) + k, dtype=bool)
        live[at] = True
        names = _join(names, k, k.bit_length())
        at = np.flatnonzero(live[:len(names)] & live[k:k + len(names)])
        at = _repeated(names, at) if len(at) else at
        k *= 2
    return out


def find_runs(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All runs of all texts as rows (text, start, length, period), sorted, and for each word
    whether a run covers it after that run's first period. ``ids``: word numbers of all texts;
    ``first``: the n + 1 offsets of texts."""
    n_docs, n = len(first) - 1, len(ids)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    w = np.empty(n + n_docs + 1, dtype=np.int64)
    where = np.arange(n) + doc + 1                     # a mark before each text and at the end
    w[first + np.arange(n_docs + 1)] = -1 - np.arange(n_docs + 1)
    w[where] = ids
    owner = np.full(len(w), n_docs, dtype=np.int64)
    owner[first[:-1] + np.arange(n_docs)] = np.arange(n_docs)
    owner[where] = doc
    ends = np.zeros(len(w), dtype=np.int64)
    parts = _dense(w, owner, ends) + _sparse(w, owner, ends)
    runs = np.concatenate(parts) if parts else np.zeros((0, 3), dtype=np.int64)
    text = owner[runs[:, 0]]
    drop = np.zeros(len(w) + 1, dtype=np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 1], -1)
    rows = np.stack((text, runs[:, 0] - (first[text] + text + 1), runs[:, 1] - runs[:, 0],
                     runs[:, 2]), axis=1)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    return rows, np.cumsum(drop)[where] > 0


def collapse(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``runs``, an array of (start, length, period) in words, and ``collapsed``:
    the words that no run covers after its first period, joined by one space."""
    small_batches(docs.sparkSession)

    def run(b: pa.RecordBatch):
        words, first = split_words(*text_bytes(b.column(b.schema.get_field_index(text_col))))
        ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        rows, gone = find_runs(ids.astype(np.int64), first)
        off = np.searchsorted(rows[:, 0], np.arange(b.num_rows + 1)).astype(np.int32)
        runs = pa.ListArray.from_arrays(off, pa.StructArray.from_arrays(
            [pa.array(rows[:, i + 1]) for i in range(3)], ["start", "length", "period"]))
        kept = np.flatnonzero(~gone)
        lists = pa.ListArray.from_arrays(np.searchsorted(kept, first).astype(np.int32),
                                         words.take(kept).cast(pa.binary()))
        return [runs, pc.binary_join(lists, b" ").cast(pa.string())]

    return append_arrow(docs, [("runs", RUNS), ("collapsed", T.StringType())], run)


def longest(runs: Column) -> Column:
    """The run with the greatest length (ties: smallest start, then period); null without runs."""
    return F.array_min(F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period"))))


def repeat_tail(text: Column, start: Column, period: Column) -> Column:
    """``text`` with each word from word number ``start`` on replaced: the ``period`` words there,
    over and over, up to the old number of words."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")
    left = F.size(words) - start
    block = F.slice(words, start + 1, period)
    tail = F.flatten(F.array_repeat(block, F.ceil(left / period).cast("int")))
    return F.array_join(F.concat(F.slice(words, F.lit(1), start), F.slice(tail, F.lit(1), left)),
                        " ")
