"""Quality classifier by Bradley-Terry pairwise ranking (operator 7).

A document's score is w.x over features of its text; the chance that document i is preferred
to j is sigmoid(w.(x_i - x_j)). w is learnt by logistic loss on feature differences of pairs
(a row labelled 1, a row labelled 0). The decision threshold is the quantile of the training
scores, weighted to the labels' shares, at the share of rows labelled 0; the published score is
sigmoid(w.x - threshold).

Features come from the whole text alone: frequencies of adjacent byte classes (lower, upper,
digit, space, line break, non-ASCII, and each ASCII punctuation sign), the share of words that
repeat the word before them, the share of distinct words, of repeated lines, and the length.
Every labelled row trains: rows are dealt by a hash into lots of about SAMPLE rows of the commoner
label, a task fits each lot, and w is the mean of the lots' weights, each counting by its rows (one
lot: its own fit). The threshold is the exact quantile over all training rows, found by counting
scores in bins and dividing the bin that holds it. Every document is scored.

Defined cases: a null or empty text has zero features and a score like any other; labels that
are null, not 0 / 1 or contradict each other for one id are not used; without rows of both
labels every score is 0.5. Null ids are scored, and are never training rows. A label with few rows
goes to several lots, so that each holds about SAMPLE / RARE of it or all there are; a lot that meets more
than 4 * SAMPLE rows (an id repeated that often) is fitted in several parts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_arrow, materialize, small_batches, text_bytes

#: Rows of the commoner label in a lot (no cut: all lots train); the rarer one should have a RARE-th.
SAMPLE, RARE = 3000, 10
#: Labels are broadcast up to here.
MAX_BROADCAST = 500_000
#: Tasks that fit lots, and so rows of weights that reach the driver.
TASKS = 1000
#: Bins of one count of scores.
BINS = 4096
EPOCHS, BATCH, RATE, DECAY = 40, 256, 0.3, 1e-4
#: Added to a text's length in its frequencies: a few characters say little about a document.
SHRINK = 8

_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[65:91], _CLASS[48:58], _CLASS[32], _CLASS[10], _CLASS[128:] = 1, 2, 3, 4, 5
_CLASS[[*range(0, 10), *range(11, 32), 127]] = 6
_PUNCT = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[_PUNCT] = 7 + np.arange(len(_PUNCT))
N_CLASS = 7 + len(_PUNCT)
N_FEATURES = N_CLASS * N_CLASS + 4


def features(col: pa.Array) -> np.ndarray:
    """(documents, N_FEATURES) float32."""
    buf, off = text_bytes(col)
    cls = _CLASS[buf]
    x = np.zeros((len(off) - 1, N_FEATURES), dtype=np.float32)
    for r, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        if b <= a:
            continue
        c = cls[a:b]
        if b - a > 1:
            x[r, :-4] = np.sqrt(np.bincount(c[:-1] * N_CLASS + c[1:], minlength=N_CLASS ** 2)
                                / (b - a - 1 + SHRINK))
        raw = buf[a:b].tobytes()
        w = raw.split()
        lines = Counter(raw.split(b"\n"))
        if w:
            x[r, -4] = sum(map(eq, w, w[1:])) / len(w)
            x[r, -3] = len(set(w)) / len(w)
        x[r, -2] = 1 - len(lines) / sum(lines.values())
        x[r, -1] = np.log1p(b - a) / 10
    return x


def fit(x: np.ndarray, y: np.ndarray, share: float | None = None,
        seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and threshold from features and 0 / 1 labels; ``share``: rows labelled 0 among
    all labelled rows, where the sample has another share."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    w = np.zeros(x.shape[1])
    if not len(good) or not len(bad):
        return w, 0.0
    rng = np.random.default_rng(seed)
    n, square = max(len(good), len(bad)), np.full(len(w), 1e-8)
    for _ in range(EPOCHS):
        gi = rng.permutation(np.resize(np.arange(len(good)), n))
        bi = rng.permutation(np.resize(np.arange(len(bad)), n))
        for k in range(0, n, BATCH):
            diff = x[good[gi[k:k + BATCH]]].astype(np.float64) - x[bad[bi[k:k + BATCH]]]
            miss = 1 / (1 + np.exp(np.clip(diff @ w, -50, 50)))
            grad = DECAY * w - diff.T @ miss / len(diff)
            square += grad * grad
            w -= RATE * grad / np.sqrt(square)
    scores = np.concatenate([x[k:k + BATCH].astype(np.float64) @ w for k in range(0, len(x), BATCH)])
    share = np.mean(y == 0) if share is None else share
    order = np.argsort(scores, kind="stable")
    weight = np.where(y == 0, share / len(bad), (1 - share) / len(good))[order]
    cut = int(np.searchsorted(np.cumsum(weight), share))       # rows below the quantile
    low, high = scores[order][max(0, cut - 1)], scores[order][min(cut, len(order) - 1)]
    return w, float((low + high) / 2)


def _fit_lots(batches: Iterator[pa.RecordBatch], share: float, most: int):
    """(lot, rows, fits, weights and threshold, both times rows): the sums over the lots of a task,
    from rows (lot, id, y, text) sorted by lot."""
    held: list[tuple] = []
    lot, first, rows, fits, total = None, None, 0, 0, np.zeros(N_FEATURES + 1)

    def done():
        nonlocal held, rows, fits, total
        held.sort(key=lambda r: (r[0], r[1]))
        y = np.array([r[2] for r in held])
        x = np.empty((len(held), N_FEATURES), dtype=np.float32)
        while held:                              # each row is let go as it is copied
            r = held.pop()
            x[len(held)] = np.frombuffer(r[1], dtype=np.float32)
        if 0 < y.sum() < len(y):
            w, cut = fit(x, y, share)
            total = total + len(y) * np.append(w, cut)
            rows, fits = rows + len(y), fits + 1

    for b in batches:
        for k in range(0, b.num_rows, BATCH):
            part = b.slice(k, BATCH)
            x = features(part.column(3))
            for at, i, y, r in zip(*(part.column(c).to_pylist() for c in range(3)), x):
                if held and (at != lot or len(held) >= most):
                    done()
                lot = at
                first = at if first is None else first
                held.append((i, r.tobytes(), y))
    if held:
        done()
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array([first], pa.int64()), pa.array([rows], pa.int64()),
             pa.array([fits], pa.int64()), pa.array([total.tobytes()], pa.binary())],
            ["lot", "rows", "fits", "total"])


def _deal(rows: DataFrame, n: dict[int, int], sample: int) -> tuple[DataFrame, int]:
    """(rows with their lot, number of lots): a rare label's rows are copied to several lots."""
    lots = max(1, -(-max(n.values()) // sample))
    copies = {k: min(lots, max(1, -(-(sample // RARE) * lots // n[k]))) for k in (0, 1)}
    times = F.when(F.col("y") == 0, copies[0]).otherwise(copies[1])
    at = F.explode(F.sequence(F.lit(0), times - 1))
    return rows.select("*", at.alias("copy")).select(
        ((F.pmod(F.xxhash64("id", "text"), F.lit(lots)) + F.col("copy")) % lots).alias("lot"),
        F.col("id"), F.col("y").cast("int").alias("y"), "text"), lots


def _threshold(scored: DataFrame, share: float) -> float:
    """``fit``'s threshold over all rows (y, z): the middle between the scores on both sides of the
    quantile ``share``, where a row counts for its label's share."""
    n = {r.y: r["count"] for r in scored.groupBy("y").count().collect()}
    each = {0: share / n[0], 1: (1 - share) / n[1]}
    low, high = scored.agg(F.min("z"), F.max("z")).first()
    below, left = 0.0, None                      # weight and largest score under the bins' range
    while True:
        width = (high - low) / BINS
        inside = scored.where(F.col("z").between(low, high))
        bin_ = F.least(F.floor((F.col("z") - low) / width), F.lit(BINS - 1)) if width > 0 \
            else F.lit(0)
        found = inside.groupBy(bin_.alias("bin")).agg(
            *[F.count(F.when(F.col("y") == k, 1)).alias(f"n{k}") for k in (0, 1)],
            F.min("z").alias("lo"), F.max("z").alias("hi")).orderBy("bin").collect()
        for r in found:
            upto = below + r.n0 * each[0] + r.n1 * each[1]
            if upto >= share or r is found[-1]:
                break
            below, left = upto, r.hi
        if r.lo == r.hi or (r.lo, r.hi) == (low, high):
            break
        low, high = r.lo, r.hi
    # the first row at or over the quantile has score r.lo; the one under it too, if there are more
    inside = min(each[k] for k in (0, 1) if (r.n0, r.n1)[k])
    under = r.lo if below + inside < share and r.n0 + r.n1 > 1 else left
    return float(((r.lo if under is None else under) + r.lo) / 2)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Fit on all labelled rows, in lots of ``sample`` rows of the commoner label."""
    small_batches(docs.sparkSession)
    y = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
         .groupBy(F.col(id_col).alias("id"))
         .agg(F.min(label_col).alias("y"), F.max(label_col).alias("y1")).where("y = y1")
         .select("id", "y"))
    n = {r.y: r["count"] for r in y.groupBy("y").count().collect()}
    y = F.broadcast(y) if sum(n.values()) <= MAX_BROADCAST else y
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(y, "id")
    met = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    if len(met) < 2:
        return np.zeros(N_FEATURES), 0.0
    share = n[0] / sum(n.values())
    dealt, lots = _deal(rows, met, sample)
    got = (dealt.repartition(min(lots, TASKS), "lot").sortWithinPartitions("lot")
           .mapInArrow(lambda it: _fit_lots(it, share, 4 * sample),
                       "lot long, rows long, fits long, total binary").collect())
    got.sort(key=lambda r: r.lot)                # one sum, whatever order the tasks end in
    if not got:
        return np.zeros(N_FEATURES), 0.0
    total = sum(np.frombuffer(r.total) for r in got) / sum(r.rows for r in got)
    w = total[:-1]
    if sum(r.fits for r in got) == 1:
        return w, float(total[-1])

    def run(b: pa.RecordBatch):
        return [pa.array(features(b.column(b.schema.get_field_index("text"))).astype(
            np.float64) @ w, pa.float64())]

    scored = append_arrow(rows, [("z", T.DoubleType())], run).select("y", "z")
    return w, _threshold(materialize(scored, "quality-scores"), share)


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text",
          out: str = "score", flag: str = "predicted") -> DataFrame:
    """``docs`` with a score in 0..1 and predicted (1 from 0.5)."""
    small_batches(docs.sparkSession)
    w, threshold = model

    def run(b: pa.RecordBatch):
        z = features(b.column(b.schema.get_field_index(text_col))).astype(np.float64) @ w
        s = 1 / (1 + np.exp(-np.clip(z - threshold, -500, 500)))
        return [pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())]

    return append_arrow(docs, [(out, T.DoubleType()), (flag, T.IntegerType())], run)


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id as text, mod 3, is 1; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
