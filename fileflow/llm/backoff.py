"""Stupid-backoff language-model scores of a corpus under its own counts (operator 8).

Every word position is a record (left, word, right). Records are partitioned by a hash of the
word, so one partition holds whole count tables: of the word, of (left, word), of (word, right)
and of all three. The exploded n-grams meet their counts there, and log scores are summed per
document:

    S(w3 | w1 w2) = c(w1 w2 w3) / c(w1 w2)        if the trigram occurs MIN times or more
                  = 0.4 c(w2 w3) / c(w2)          else, if the bigram does
                  = 0.16 c(w3) / N                else

The second word of a text starts at the bigram (0.4 c / N if that fails), the first is c / N.
The last case is charged by the record of w3, which knows c(w2 w3) and c(w3); so one exchange
is enough. A word with more than HOT records is not given to one partition: its records go out
twice, by a hash of (left, word) and by a hash of (word, right). Either copy knows the trigram
and one of the bigrams, and the word's own count is broadcast, so each copy charges its part of
the same score. Bigrams with more than HOT records are not given to one partition either: their
counts, and those of the trigrams made of two of them, are broadcast. There are at most N / HOT
hot words, and as many hot bigrams.

Records travel as compressed arrays for each lot of documents. Words are lower-cased runs
between ASCII white space, named by 64-bit hashes; for COMMON frequent words every task knows these,
so their places in that list travel instead. A task sums the scores of its partitions by document
before it hands them on, as pairs (document, sum) where few documents of a lot are met.

Defined cases: null, empty and blank texts have 0 words and a score of 0; repeated rows count
as often as they occur; null ids are kept; other input columns are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64, odd_constants, small_batches, text_bytes
from .shingles import words

MIN, BACK = 2, 0.4
HOT, PART = 2_000_000, 1_000_000        # records of a word or bigram / of a partition
MAX_HOT = 100_000                       # hot words and bigrams that may be sent to every task
LOT_WORDS, LOT_DOCS = 2_000_000, 4000
COMMON, RARE = 1 << 16, 500_000         # names known to every task; of lots' words, 1 in so many
MANY, EACH = 64, 32                     # tasks of one partition each; partitions of a task beyond
HELD = 64 << 20                         # bytes of sums that a task holds back
_BOS, _EOS = np.uint64(0), np.uint64(1)
_A = odd_constants(4, 61)


def _lots(batches: Iterator[pa.RecordBatch]):
    """(lot, ids, words, doc): word hashes of lots of documents, in order."""
    task, k = TaskContext.get().partitionId(), 0
    ids, held, docs, size = [], [], 0, 0
    where: list[np.ndarray] = []
    for b in chain_slices(batches):
        w, d = words(*text_bytes(b.column(1)))
        ids += b.column(0).to_pylist()
        held.append(np.where(w < 2, w + np.uint64(2), w))
        where.append(d + docs)
        docs, size = docs + b.num_rows, size + len(w)
        if size >= LOT_WORDS or docs >= LOT_DOCS:
            yield (task << 32) + k, ids, np.concatenate(held), np.concatenate(where)
            k, ids, held, where, docs, size = k + 1, [], [], [], 0, 0
    if docs:
        yield (task << 32) + k, ids, np.concatenate(held), np.concatenate(where)


def chain_slices(batches: Iterator[pa.RecordBatch], rows: int = 250) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def _records(w: np.ndarray, doc: np.ndarray):
    """left, right, and 2 * document + 1 for the second word of a text."""
    n = len(w)
    same = doc[1:] == doc[:-1]
    left, right = np.full(n, _BOS), np.full(n, _EOS)
    left[1:][same] = w[:-1][same]
    right[:-1][same] = w[1:][same]
    second = np.zeros(n, dtype=np.int64)
    second[1:] = same & (left[:-1] == _BOS)
    return left, right, doc * 2 + second


def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _unpack(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=kind)


def _small(n: int):
    return np.uint16 if n < 1 << 16 else np.uint32


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * _A[0] + b * _A[1])


def _triple(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return mix64(_pair(a, b) + c * _A[2])


class Hot:
    """Exact counts of the hot words, bigrams and trigrams, and the sorted names of frequent words,
    which decide on nothing but the bytes that travel."""

    def __init__(self, total: int, tables: list[dict[int, int]], common: np.ndarray | None = None):
        self.total = total
        self.common = np.array([_BOS, _EOS]) if common is None else common
        self.keys = [np.array(sorted(t), dtype=np.uint64) for t in tables]
        self.counts = [np.array([t[k] for k in sorted(t)], dtype=np.int64) for t in tables]

    def has(self, order: int, key: np.ndarray) -> np.ndarray:
        return np.isin(key, self.keys[order - 1])

    def count(self, order: int, key: np.ndarray) -> np.ndarray:
        """Counts of the keys, 0 for those that are not hot."""
        k = self.keys[order - 1]
        if not len(k):
            return np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(k, key), len(k) - 1)
        return np.where(k[at] == key, self.counts[order - 1][at], 0)


#: What a record's copy charges: everything, or only what its own bigram decides.
ALL, LEFT, RIGHT = 0, 1, 2


def _scores(kind, other, left, right, second, total, u, b1, b2, t):
    """Log score charged by each record, given its counts.

    ``kind``: ALL for whole records, LEFT / RIGHT for the copies of a hot word's records;
    ``other``: there is no copy for the other side, so this one charges for both.
    """
    first, last = left == _BOS, right == _EOS
    charge_l, charge_r = (kind != RIGHT) | other, (kind != LEFT) | other
    out = np.zeros(len(left))
    tri = ~last & ~first & (t >= MIN)
    x = tri & charge_r
    out[x] += np.log(t[x])
    x = tri & charge_l
    out[x] -= np.log(b1[x])
    x = ~last & ~tri & charge_r
    x[x] = b2[x] >= MIN
    out[x] += np.log(b2[x] / u[x]) + np.where(first[x], 0.0, math.log(BACK))
    x = charge_l & (kind != RIGHT)
    x[x] = first[x] | (b1[x] < MIN)
    level = np.where(first, 0, np.where(second, 1, 2))
    out[x] += np.log(u[x] / total) + level[x] * math.log(BACK)
    return out


def _count(key: np.ndarray) -> np.ndarray:
    _, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
    return n[inverse]


def _sums(docs: DataFrame, fn) -> list:
    """(k, x, n) rows summed over all lots; ``fn(lot, left, word, right)`` gives k, x, n arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot, _, w, doc in _lots(batches):
            left, right, _ = _records(w, doc)
            for k, x, n in fn(lot, left, w, right):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), k)), pa.array(x.view(np.int64)),
                     pa.array(n.astype(np.int64))], ["k", "x", "n"])

    return (docs.mapInArrow(run, "k long, x long, n long").groupBy("k", "x")
            .agg(F.sum("n").alias("n")))


def hot_ngrams(docs: DataFrame) -> Hot:
    """The number of words, and the words and bigrams that no partition should hold alone.

    Where a record goes changes no result, so what is rare in every lot may be left out of the
    first look; the counts of what was found are exact.
    """
    def look(lot, left, w, right):
        yield 0, np.zeros(1, np.uint64), np.array([len(w)])
        if not lot % (1 << 32):                   # a task's first lot shows what is frequent
            x, n = np.unique(w, return_counts=True)
            yield 3, x[n * RARE >= len(w)], n[n * RARE >= len(w)]
        for k, key in ((1, w), (2, _pair(left, w)), (2, _pair(w, right)[right == _EOS])):
            x, n = np.unique(key, return_counts=True)
            yield k, x[n * 2000 >= len(w)], n[n * 2000 >= len(w)]

    got = materialize(_sums(docs, look), "lm-look")
    total = got.where("k = 0").agg(F.sum("n")).first()[0] or 0
    often = got.where("k = 3").orderBy(F.desc("n"), "x").limit(COMMON - 2).select("x").collect()
    common = np.array([r.x for r in often], np.int64).view(np.uint64)
    common = np.unique(np.concatenate((np.array([_BOS, _EOS]), common)))
    rows = got.where(F.col("k").isin(1, 2) & (F.col("n") >= max(HOT, total // MAX_HOT))).collect()
    found = [np.sort(np.array([r.x for r in rows if r.k == k], np.int64).view(np.uint64))
             for k in (1, 2)]
    if not rows:
        return Hot(total, [{}, {}, {}], common)

    def exact(_, left, w, right):
        one, two = _pair(left, w), _pair(w, right)
        both = np.isin(one, found[1]) & np.isin(two, found[1])
        end = right == _EOS
        for k, key in ((1, w[np.isin(w, found[0])]), (2, one[np.isin(one, found[1])]),
                       (2, two[end & np.isin(two, found[1])]),
                       (3, _triple(left[both], w[both], right[both]))):
            yield k, *np.unique(key, return_counts=True)

    tables: list[dict[int, int]] = [{}, {}, {}]
    for r in _sums(docs, exact).collect():
        tables[r.k - 1][r.x % (1 << 64)] = r.n
    return Hot(total, tables, common)


def _codes(w: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Sorted names, and each record's (word, left, right) as places in them. The neighbours'
    places are those of the words, moved by one."""
    names, place = np.unique(w, return_inverse=True)
    code = np.empty((3, len(w)), dtype=np.int32)
    code[0] = place + 2
    code[1, 1:], code[2, :-1] = code[0, :-1], code[0, 1:]
    code[1][left == _BOS], code[2][right == _EOS] = 0, 1
    return np.concatenate((np.array([_BOS, _EOS]), names)), code


def _copies(hot: Hot, left, w, right):
    """Index, kind, other-flag and routing key of every record's copies, and the records whose
    bigrams are both hot, which need no routing."""
    is_hot = hot.has(1, w)
    hot_l, hot_r = hot.has(2, _pair(left, w)), hot.has(2, _pair(w, right))
    plain, at = np.flatnonzero(~is_hot), np.flatnonzero(is_hot)
    one, two = at[~hot_l[at]], at[~hot_r[at] & (right[at] != _EOS)]
    index = np.concatenate((plain, one, two))
    kind = np.repeat(np.array([ALL, LEFT, RIGHT]), (len(plain), len(one), len(two)))
    other = np.concatenate((np.zeros(len(plain), bool), hot_r[one], hot_l[two]))
    key = np.concatenate((mix64(w[plain]), mix64(_pair(left[one], w[one])),
                          mix64(_pair(w[two], right[two]))))
    direct = at[hot_l[at] & (hot_r[at] | (right[at] == _EOS))]
    return index, kind, other, key, direct


def _names_out(names: np.ndarray, place: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted names as (steps between the places of the common ones, the others); ``place`` is -1
    for these."""
    known = place[place >= 0]
    return (_pack(np.diff(known, prepend=0).astype(np.uint16)), _pack(names[place < 0]))


def _names_in(steps: bytes, others: bytes, common: np.ndarray) -> np.ndarray:
    known = np.cumsum(_unpack(steps, np.uint16), dtype=np.int64)
    return np.sort(np.concatenate((common[known], _unpack(others, np.uint64))))


def _code_out(c: np.ndarray, kind) -> bytes:
    """(word, left, right) places of records in order of their words; the first as steps."""
    c = c.reshape(3, -1).astype(kind)
    c[0, 1:] = np.diff(c[0])
    return _pack(c)


def _code_in(raw: bytes, kind) -> np.ndarray:
    c = _unpack(raw, kind).reshape(3, -1).astype(np.int64)
    c[0] = np.cumsum(c[0])
    return c


def _tag_out(tag: np.ndarray, kind) -> bytes:
    """Steps, which wrap round below zero."""
    return _pack(np.diff(tag.astype(kind), prepend=kind(0)))


def _tag_in(raw: bytes, kind) -> np.ndarray:
    return np.cumsum(_unpack(raw, kind), dtype=kind)


def partial_scores(docs: DataFrame, hot: Hot) -> DataFrame:
    """(lot, docs, ids, n, at, s): for each lot of documents one row with ids and word counts, and
    any number of rows with parts of the scores, as arrays; ``at``: of which documents, or null."""
    parts = max(1, math.ceil(hot.total / PART))
    sent = docs.sparkSession.sparkContext.broadcast(hot)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for lot, ids, w, doc in _lots(batches):
            left, right, mark = _records(w, doc)
            index, kind, other, key, direct = _copies(table, left, w, right)
            names, code = _codes(w, left, right)
            place = np.minimum(np.searchsorted(table.common, names), len(table.common) - 1)
            place = np.where(table.common[place] == names, place, -1)
            tag = mark[index] * 8 + kind * 2 + other
            part = (key % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((code[0][index], part))
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            d = direct
            s = _scores(np.full(len(d), ALL), np.ones(len(d), bool), left[d], right[d],
                        mark[d] % 2 == 1, table.total, table.count(1, w[d]),
                        table.count(2, _pair(left[d], w[d])),
                        table.count(2, _pair(w[d], right[d])),
                        table.count(3, _triple(left[d], w[d], right[d])))
            s = np.bincount(mark[d] // 2, s, minlength=len(ids))
            n = np.bincount(doc, minlength=len(ids)).astype(np.int64)
            rows = [(-1 - lot % parts, lot, len(ids), _pack(n), _pack(s),
                     _pack(np.array([i is not None for i in ids])) ,
                     _pack(np.array([i or 0 for i in ids], np.int64)))]
            for p in range(parts):
                at = order[cuts[p]:cuts[p + 1]]
                if len(at):
                    used, c = np.unique(code[:, index[at]], return_inverse=True)
                    steps, others = _names_out(names[used], place[used])
                    rows.append((p, lot, len(ids), others, _code_out(c, _small(len(used))),
                                 _tag_out(tag[at], _small(16 * len(ids))), steps))
            for i in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[j] for r in rows[i:i + 64]], t) for j, t in enumerate(
                        (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(),
                         pa.binary(), pa.binary()))],
                    ["p", "lot", "docs", "names", "code", "mark", "ids"])

    def close(rows):
        table = sent.value
        mid, left, right, tag, sizes = [], [], [], [], []
        for _, docs_n, names, code, m, steps in rows:
            names = _names_in(steps, names, table.common)
            code = _code_in(code, _small(len(names)))
            mid.append(names[code[0]])
            left.append(names[code[1]])
            right.append(names[code[2]])
            tag.append(_tag_in(m, _small(16 * docs_n)).astype(np.int32))
            sizes.append(code.shape[1])
        mid, left, right, tag = map(np.concatenate, (mid, left, right, tag))
        kind, other, mark = (tag // 2 % 4).astype(np.int8), tag % 2 == 1, tag // 8
        u = table.count(1, mid)
        b1 = table.count(2, _pair(left, mid))
        b2 = table.count(2, _pair(mid, right))
        t = np.zeros(len(mid), np.int64)
        for k in (ALL, LEFT, RIGHT):
            at = np.flatnonzero(kind == k)
            if not len(at):
                continue
            x, y, z = left[at], mid[at], right[at]
            t[at] = _count(_triple(x, y, z))
            if k == ALL:
                u[at] = _count(y)
            if k != RIGHT:
                b1[at] = _count(_pair(x, y))
            if k != LEFT:
                b2[at] = _count(_pair(y, z))
            del x, y, z
        s = _scores(kind, other, left, right, mark % 2 == 1, table.total, u, b1, b2, t)
        ends = np.cumsum(sizes)
        return [(r[0], np.bincount(mark[a:b] // 2, s[a:b], minlength=r[1]))
                for r, a, b in zip(rows, [0, *ends], ends)]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        sums: dict[int, np.ndarray] = {}

        def add() -> bool:
            for lot, s in close(held):
                sums[lot] = sums[lot] + s if lot in sums else s
            return sum(s.nbytes for s in sums.values()) > HELD

        def flush() -> Iterator[pa.RecordBatch]:
            for lot, s in sums.items():
                yield _lot_rows([(lot, None, None, s)])
            sums.clear()

        for b in batches:
            for p, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if p < 0:                                    # the head of a lot
                    lot, _, n, s, known, ids = row
                    known = _unpack(known, bool)
                    ids = [i if k else None for i, k in
                           zip(_unpack(ids, np.int64).tolist(), known.tolist())]
                    yield _lot_rows([(lot, ids, _unpack(n, np.int64), _unpack(s, np.float64))])
                    continue
                if p != at and held:
                    if add():
                        yield from flush()
                    held = []
                at = p
                held.append(row)
        if held:
            add()
        yield from flush()

    out = docs.mapInArrow(split, "p long, lot long, docs long, names binary, code binary, "
                                 "mark binary, ids binary")
    return (out.repartition(max(min(parts, MANY), parts // EACH), "p").sortWithinPartitions("p")
            .mapInArrow(score, "lot long, docs long, ids array<long>, n array<long>, at binary, "
                               "s binary"))


def _lot_rows(rows: list[tuple]) -> pa.RecordBatch:
    at = [np.flatnonzero(r[3]).astype(np.uint32) for r in rows]
    few = [12 * len(x) < r[3].nbytes for x, r in zip(at, rows)]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()),
         pa.array([len(r[3]) for r in rows], pa.int64()),
         pa.array([r[1] for r in rows], pa.list_(pa.int64())),
         pa.array([None if r[2] is None else r[2].tolist() for r in rows], pa.list_(pa.int64())),
         pa.array([x.tobytes() if f else None for x, f in zip(at, few)], pa.binary()),
         pa.array([(r[3][x] if f else r[3]).tobytes() for r, x, f in zip(rows, at, few)],
                  pa.binary())], ["lot", "docs", "ids", "n", "at", "s"])


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, log_score), one row per input row."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        heads: dict[int, tuple] = {}
        for b in batches:
            for lot, size, ids, n, at, s in zip(*(c.to_pylist() for c in b.columns), strict=True):
                total = sums.setdefault(lot, np.zeros(size))
                total[slice(None) if at is None else np.frombuffer(at, np.uint32)] += \
                    np.frombuffer(s, np.float64)
                if ids is not None:
                    heads[lot] = (ids, n)
        for lot, (ids, n) in heads.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(sums[lot])],
                ["id", "n", "s"])

    return (partial_scores(docs, hot_ngrams(docs)).repartition("lot")
            .mapInArrow(gather, "id long, n long, s double")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_words"),
                    F.col("s").alias("log_score")))
