"""Language identification by multinomial naive Bayes over hashed character n-grams (operator 13).

A text becomes its letters in lower case, every run of other characters one space, with a space at
both ends. Its features are the n-grams of 1, 2 and 3 characters, hashed into BUCKETS; an n-gram
never crosses texts. Training counts buckets per language over every labelled row: each task adds
up its own rows, Spark sums the counts by (language, bucket). The matrix of log-probabilities
(additive smoothing ALPHA, prior by rows) has BUCKETS x languages cells, at most MAX_LANGUAGES
languages, whatever the corpus; it is broadcast and each batch adds up its rows of the matrix in
numpy. Log-probabilities are whole multiples of 1 / UNIT, so sums do not depend on their order.

Defined cases: a null text and one without a letter are ``und`` with score 0; so is every text
where nothing was learnt. Rows with a null language or without a letter teach nothing. Ties go to
the language first in order. Repeated rows count as often as they occur. Texts of any length are
read whole, in slices. Columns named like the ones added are replaced; more than MAX_LANGUAGES
languages raise ValueError, as the matrix would have no bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_arrow, small_batches, text_bytes

BUCKETS, ALPHA, UNIT, MAX_LANGUAGES = 1 << 16, 0.5, 1 << 20, 1000
#: Multipliers of an n-gram's characters and of its length; bits 20 to 35 of the sum name its bucket.
FACTORS, LENGTH, SHIFT = (708291137041, 915478293127, 612034519753), 483920117659, 20
SLICE = 1 << 18
UNKNOWN = "und"

COUNTS = "lang string, bucket int, n long"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space."""
    out = np.full(0x110000, 32, dtype=np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def letters(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one stream of code points with a space before, between and after them, and the
    n + 1 places of those spaces (equal for a text without letters)."""
    buf, off = text_bytes(col)
    codes = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    starts = np.concatenate((np.zeros(1, np.int64), np.cumsum((buf & 0xC0) != 0x80)))[off] \
        if len(buf) else np.zeros(len(off), np.int64)
    n = len(off) - 1
    stream = np.full(len(codes) + n + 1, 32, dtype=np.uint32)
    edges = starts + np.arange(n + 1)
    inner = np.ones(len(stream), dtype=bool)
    inner[edges] = False
    stream[inner] = _letters()[codes]
    keep = stream != 32
    keep[:-1] |= stream[1:] != 32                     # of a run of spaces the last stays
    keep[-1] = True
    size = np.add.reduceat(keep, edges, dtype=np.int64)[:-1]
    return stream[keep], np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))


def _buckets(stream: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(place, buckets of the three n-grams from there on) for slices of the stream; BUCKETS where
    the n-gram of 3 would leave its text."""
    end = len(stream) - 1
    last = at[1:][at[1:] > at[:-1]] - 1               # the last letter of each text
    for a in range(0, end, SLICE):
        m = min(SLICE, end - a)
        c = stream[a:a + m + 2].astype(np.int64)
        c = np.concatenate((c, np.zeros(m + 2 - len(c), np.int64)))
        h = np.zeros(m, dtype=np.int64)
        out = np.empty((3, m), dtype=np.int64)
        for i in range(3):
            h = h + c[i:i + m] * FACTORS[i]
            out[i] = ((h + (i + 1) * LENGTH) >> SHIFT) & (BUCKETS - 1)
        cross = last[(last >= a) & (last < a + m)] - a
        out[2, cross] = BUCKETS
        yield a, out


def count(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, bucket, n): n-grams of each language; bucket -1 counts its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            stream, at = letters(b.column(0))
            code = b.column(1).dictionary_encode()
            names, code = code.dictionary.to_pylist(), code.indices.to_numpy(zero_copy_only=False)
            for i, name in enumerate(names):
                seen.setdefault(name, np.zeros(BUCKETS + 2, dtype=np.int64))
                if len(seen) > MAX_LANGUAGES:
                    raise ValueError(f"more than {MAX_LANGUAGES} languages")
                seen[name][-1] += np.count_nonzero((code == i) & (np.diff(at) > 0))
            owner = np.repeat(code, np.diff(at))
            for a, got in _buckets(stream, at):
                lang = owner[a:a + got.shape[1]]
                for i, name in enumerate(names):
                    mine = got[:, lang == i].ravel()
                    seen[name][:-1] += np.bincount(mine, minlength=BUCKETS + 1)
        for name, n in seen.items():
            n[BUCKETS] = 0
            hit = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(hit), pa.string()),
                 pa.array(np.where(hit > BUCKETS, -1, hit), pa.int32()), pa.array(n[hit])],
                ["lang", "bucket", "n"])

    small_batches(rows.sparkSession)
    picked = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return picked.mapInArrow(run, COUNTS).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang"
          ) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in order, the matrix (BUCKETS + 1, languages) and the prior, in 1 / UNIT. The
    driver receives BUCKETS + 1 rows per language at most."""
    counts = count(rows, text_col, lang_col).toPandas()
    has = counts[(counts.bucket == -1) & (counts.n > 0)]
    langs = sorted(has.lang)
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    number = {x: i for i, x in enumerate(langs)}
    grams = counts[(counts.bucket >= 0) & counts.lang.isin(number)]
    n = np.zeros((BUCKETS, len(langs)))
    n[grams.bucket, grams.lang.map(number).astype(int)] = grams.n
    docs = np.zeros(len(langs))
    docs[has.lang.map(number).astype(int)] = has.n
    matrix = np.zeros((BUCKETS + 1, len(langs)), dtype=np.int32)
    matrix[:-1] = np.rint(UNIT * (np.log(n + ALPHA) - np.log(n.sum(axis=0) + ALPHA * BUCKETS)))
    return langs, matrix, np.rint(UNIT * np.log(docs / max(1, docs.sum()))).astype(np.int64)


def likelihoods(stream: np.ndarray, at: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """(texts, languages): sums of the matrix rows of each text's n-grams."""
    out = np.zeros((len(at) - 1, matrix.shape[1]), dtype=np.int64)
    full = np.flatnonzero(np.diff(at))                # texts with letters
    begin = at[full]
    for a, got in _buckets(stream, at):
        m = got.shape[1]
        lo = max(0, int(np.searchsorted(begin, a, side="right")) - 1)
        hi = int(np.searchsorted(begin, a + m))
        cuts = np.maximum(begin[lo:hi] - a, 0)
        for i in range(3):
            out[full[lo:hi]] += np.add.reduceat(matrix[got[i]], cuts, axis=0, dtype=np.int64)
    return out


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray],
            text_col: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the likeliest language and its posterior probability."""
    small_batches(docs.sparkSession)
    langs, prior = model[0], model[2]
    shared = docs.sparkSession.sparkContext.broadcast(model[1])

    def run(b: pa.RecordBatch):
        stream, at = letters(b.column(b.schema.get_field_index(text_col)))
        if not langs:
            return [pa.array([UNKNOWN] * b.num_rows, pa.string()), pa.array(np.zeros(b.num_rows))]
        sums = likelihoods(stream, at, shared.value) + prior
        best = sums.argmax(axis=1)
        gap = (sums - sums.max(axis=1, keepdims=True)) / UNIT
        p = 1 / np.exp(gap).sum(axis=1)
        blank = np.diff(at) == 0
        names = [UNKNOWN if x else langs[i] for i, x in zip(best.tolist(), blank.tolist())]
        return [pa.array(names, pa.string()), pa.array(np.where(blank, 0.0, p))]

    return append_arrow(docs, [(out, T.StringType()), (score, T.DoubleType())], run)
