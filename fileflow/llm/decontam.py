"""Benchmark decontamination by the q-gram lemma (operator 5).

Texts are compared lower-cased, every run of characters that are neither ASCII letters, digits
nor non-ASCII written as one space. The windows of an item are its passages of WINDOW bytes, one
at each byte (a shorter item is one window). A document leaks an item if some region of it is
within ``e`` edits of one of the item's windows, e = floor(RATE * window length).

1. Pigeonhole: a window is cut into e + 1 pieces of equal size (the rest belongs to none), one more
   than e edits can touch, so one piece occurs unchanged. Pieces are looked up at every byte of
   every document.
2. q-gram lemma: each hit names a diagonal (document minus item position). Diagonals fall into
   overlapping bands of 3e + 1; a region within e edits keeps at least L + 1 - q - e*q of the
   window's q-grams inside the band. Bands under that bound are dropped.
3. The rest is verified by banded alignment (free start and end in the document).

All three steps are exact: no region within the budget is missed. (Windows that start at multiples
of WINDOW / 2 bytes, and the last one, go first and give the places; the others are verified for the
items that a document does not show by those.) Hits are expanded in slices of SLICE pairs, and of
what a slice shows one row per document, item and window is kept, so memory does not grow with the
number of hits: one letter a million times against an item of that letter takes time, not memory.
The items are broadcast in blocks of bounded bytes, one pass over the documents for each block.

Defined cases: null or empty texts and items leak nothing; an item under MIN_ITEM compared bytes
has no budget and counts where it occurs whole, between spaces or ends; repeated items and
documents each report their own rows; a null item id is reported as null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_arrow, mix64, odd_constants, small_batches

WINDOW, Q, RATE, MIN_ITEM = 96, 6, 0.08, 24
WHOLE = 12                    # bytes of the piece by which a shorter item is looked up
SLICE = 1 << 19               # pairs of a place in a document and a place in an item at a time
BLOCK_BYTES = 8 << 20         # benchmark text broadcast at a time
TEXT_CHARS = 1 << 19          # document text searched at a time (or one document)
_BITS = 22
_BASE = np.uint64(int(odd_constants(1, 31)[0]))
_CODE = odd_constants(256, 33)

_BLACK = np.zeros(256, dtype=bool)
_BLACK[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True

MATCH = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("windows", T.LongType()),
    T.StructField("edits", T.LongType())]))


def normalise(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Compared bytes of a lower-cased text, and the place of each in it."""
    black = _BLACK[raw]
    keep = black.copy()
    keep[1:] |= black[:-1]
    at = np.flatnonzero(keep)
    return np.where(black[at], raw[at], 32).astype(np.uint8), at


def grams(b: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes that start at each position."""
    n = len(b) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h, width, base, parts = _CODE[b], 1, _BASE, []
    while True:
        if size & width:
            parts.append((width, base, h))
        if 2 * width > size:
            break
        h = h[:-width] * base + h[width:]
        base, width = np.uint64(int(base) ** 2 % (1 << 64)), 2 * width
    out, at = np.zeros(n, np.uint64), 0
    for width, base, h in reversed(parts):
        out = out * base + h[at:at + n]
        at += width
    return out


def _least(parts: list[np.ndarray]) -> np.ndarray:
    """Rows (document, item, window, first, last, edits): for each of the first three the smallest
    first, the largest last and the fewest edits."""
    x = np.concatenate([*parts, np.zeros((0, 6), np.int64)])
    x = x[np.lexsort((x[:, 2], x[:, 1], x[:, 0]))]
    new = np.flatnonzero(np.concatenate(([True], (x[1:, :3] != x[:-1, :3]).any(axis=1)))
                         ) if len(x) else np.zeros(0, np.int64)
    return x if not len(x) else np.concatenate([x[new, :3], np.stack([
        np.minimum.reduceat(x[:, 3], new), np.maximum.reduceat(x[:, 4], new),
        np.minimum.reduceat(x[:, 5], new)], axis=1)], axis=1)


class Lookup:
    """Pieces of ``size`` bytes by hash; each entry carries numbers (columns of ``data``)."""

    def __init__(self, size: int, hashes: np.ndarray, data: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.size, self.hash, self.data = size, hashes[order], data[order]
        self.table = np.zeros(1 << _BITS, dtype=bool)
        self.table[mix64(self.hash) >> np.uint64(64 - _BITS)] = True

    def hits(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the compared bytes, first entry, entries) of every piece that occurs."""
        h = grams(b, self.size)
        at = np.flatnonzero(self.table[mix64(h) >> np.uint64(64 - _BITS)])
        lo = np.searchsorted(self.hash, h[at], side="left")
        n = np.searchsorted(self.hash, h[at], side="right") - lo
        return at[n > 0], lo[n > 0], n[n > 0]


def slices(lo: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, entry) for the entries lo .. lo + n - 1 of each row, at most SLICE at a time."""
    end = np.cumsum(n)
    for k in range(0, int(end[-1]) if len(end) else 0, SLICE):
        x = np.arange(k, min(k + SLICE, int(end[-1])))
        row = np.searchsorted(end, x, side="right")
        yield row, lo[row] + x - (end[row] - n[row])


class Index:
    """Windows and pieces of a block of items; built once and sent to the tasks."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = RATE):
        self.ids: list[int | None] = []
        held, text, at = [], [], 0
        for item_id, raw in items:
            b, _ = normalise(np.frombuffer(raw.lower().encode("utf-8", "replace"), np.uint8))
            b = b[:-1] if len(b) and b[-1] == 32 else b
            b = b[1:] if len(b) and b[0] == 32 else b
            if not len(b):
                continue
            size = min(WINDOW, len(b))
            # an item under MIN_ITEM bytes counts where it occurs whole
            e = int(rate * size + 1e-9) if size >= MIN_ITEM else 0
            held.append((at, len(b), size, e, size // (e + 1) if size >= MIN_ITEM
                         else min(size, WHOLE)))
            self.ids.append(item_id)
            text.append(b)
            at += len(b)
        self.first, length, self.size, self.edits, self.piece = np.array(
            held, dtype=np.int64).reshape(-1, 5).T
        self.last = self.first + length - self.size          # start of an item's last window
        self.text = np.concatenate([*text, np.zeros(0, np.uint8)])
        self.near, self.all = self._grid(), self._places()

    def _grid(self) -> list[Lookup]:
        """(window, bytes before the piece) of the pieces of half overlapping windows."""
        out = []
        for piece in np.unique(self.piece):
            win, back = [], []
            for k in np.flatnonzero(self.piece == piece):
                w = np.unique(np.append(np.arange(self.first[k], self.last[k], WINDOW // 2),
                                        self.last[k]))
                p = np.arange(self.edits[k] + 1) * piece
                win.append(np.repeat(w, len(p)))
                back.append(np.tile(p, len(w)))
            win, back = np.concatenate(win), np.concatenate(back)
            out.append(Lookup(int(piece), grams(self.text, int(piece))[win + back],
                              np.stack([win, back], axis=1).astype(np.int32)))
        return out

    def _places(self) -> list[Lookup]:
        """Every place of the items of more than one window; ``groups`` are the places of one
        piece in one item."""
        out = []
        several = self.last > self.first
        for piece in np.unique(self.piece[several]):
            p = [np.arange(self.first[k], self.last[k] + self.size[k] - piece + 1)
                 for k in np.flatnonzero(several & (self.piece == piece))]
            p = np.concatenate(p)
            x = Lookup(int(piece), grams(self.text, int(piece))[p],
                       np.stack([p, self.item(p)], axis=1).astype(np.int32))
            # the sort by hash is stable, so the places of one item stand together
            new = np.concatenate(([True], (x.hash[1:] != x.hash[:-1])
                                  | (x.data[1:, 1] != x.data[:-1, 1])))
            start = np.flatnonzero(new)
            places = x.data[:, 0]
            groups = Lookup(int(piece), x.hash[start], np.stack([
                start, np.diff(np.append(start, len(places))), x.data[start, 1]], axis=1))
            groups.places = places
            out.append(groups)
        return out

    def item(self, win: np.ndarray) -> np.ndarray:
        """Number of the item of each window."""
        return np.searchsorted(self.first, win, side="right") - 1

    def matches(self, b: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Rows (document, item, window, first, last, edits), one for each window that a document
        shows, of verified regions of the compared bytes ``b``; ``doc`` numbers the document of
        each byte, regions never cross documents."""
        found = _least([self._candidates(win, diag, b, doc) for win, diag in self._near(b)])
        known = np.unique(found[:, 0] * len(self.ids) + found[:, 1])
        return _least([found] + [self._candidates(win, diag, b, doc)
                                 for win, diag in self._rest(b, doc, known)])

    def _near(self, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, diagonal) of the pieces of half overlapping windows, in slices."""
        for x in self.near:
            at, lo, n = x.hits(b)
            for row, entry in slices(lo, n):
                win, back = x.data[entry].astype(np.int64).T
                yield win, at[row] - back

    def _rest(self, b, doc, known) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same of all other windows, for items that a document has not shown yet."""
        for x in self.all:
            at, lo, n = x.hits(b)
            for row, group in slices(lo, n):
                pair = doc[at[row]] * len(self.ids) + x.data[group, 2]
                new = ~np.isin(pair, known)
                spot, group = at[row[new]], group[new]
                for r, entry in slices(x.data[group, 0], x.data[group, 1]):
                    place, item = x.places[entry].astype(np.int64), x.data[group[r], 2]
                    for back in range(0, WINDOW - x.size + 1, x.size):
                        w = place - back
                        good = ((w >= self.first[item]) & (w < self.last[item])
                                & ((w - self.first[item]) % (WINDOW // 2) > 0)
                                & (back <= self.edits[item] * x.size))
                        if good.any():
                            yield w[good], spot[r[good]] - back

    def _candidates(self, win, diag, b, doc):
        out = []
        item = self.item(win)
        for size in np.unique(self.size[item]):
            mine = self.size[item] == size
            e = int(self.edits[item[mine][0]])
            band = diag[mine] // (e + 1)
            both = np.unique((win[mine] << 32) + (band + (1 << 31)))
            win_, low = both >> 32, ((both & 0xFFFFFFFF) - (1 << 31)) * (e + 1) - e
            for k in range(0, len(both), 2048):
                part = slice(k, k + 2048)
                rows = self._whole(win_[part], low[part], int(size), b, doc) \
                    if size < MIN_ITEM else self._verify(
                        win_[part], low[part], int(size), e, b, doc)
                if len(rows):
                    s, t = np.maximum(rows[:, 1], 0), np.minimum(rows[:, 2], len(b))
                    out.append(_least([np.stack([doc[(s + t) // 2], self.item(rows[:, 0]),
                                                 rows[:, 0], s, t, rows[:, 3]], axis=1)]))
        return _least(out)

    def _whole(self, win, low, size, b, doc):
        """Rows of short items that occur whole, as words."""
        good = (low >= 0) & (low + size <= len(b))
        win, low = win[good], low[good]
        span = np.arange(size)[None, :]
        good = (b[low[:, None] + span] == self.text[win[:, None] + span]).all(axis=1)
        end = low + size
        good &= (doc[low] == doc[end - 1]) & ((low == 0) | (b[low - 1] == 32))
        good &= (end == len(b)) | (b[np.minimum(end, len(b) - 1)] == 32)
        return np.stack([win, low, end, np.zeros_like(win)], axis=1)[good]

    def _verify(self, win, low, size, e, b, doc):
        """Band of diagonals low .. low + 3e for each candidate window."""
        width = 3 * e + 1
        col = low[:, None] + np.arange(size + width - 1)[None, :]
        inside = (col >= 0) & (col < len(b))
        col = np.clip(col, 0, len(b) - 1)
        middle = np.clip(low + width // 2 + size // 2, 0, len(b) - 1)
        inside &= doc[col] == doc[middle][:, None]
        text = np.where(inside, b[col], 0)
        item = self.text[win[:, None] + np.arange(size)[None, :]]

        def packed(x):                              # six bytes as one number
            y = x.astype(np.int64)
            n = x.shape[1] - Q + 1
            return sum(y[:, i:i + n] << (8 * i) for i in range(Q))

        wq, tq = packed(item), packed(text)
        found = np.zeros(wq.shape, dtype=bool)
        for k in range(width):
            found |= wq == tq[:, k:k + wq.shape[1]]
        keep = np.flatnonzero(found.sum(axis=1) >= max(0, size + 1 - Q - e * Q))
        item, text = item[keep], text[keep]
        if not len(keep):
            return np.zeros((0, 4), np.int64)
        ramp = np.arange(width)[None, :]
        cost = np.zeros((len(keep), width), dtype=np.int64)
        first = np.tile(ramp, (len(keep), 1))       # diagonal where the alignment began
        big = 1 << 20
        for i in range(size):
            step = cost + (item[:, i:i + 1] != text[:, i:i + width])
            skip = np.full_like(cost, big)
            skip[:, :-1] = cost[:, 1:] + 1
            origin = first.copy()
            origin[:, :-1] = np.where(skip[:, :-1] < step[:, :-1], first[:, 1:], first[:, :-1])
            # extra text characters: best of the diagonals before, one edit each
            code = (np.minimum(step, skip) - ramp) * 4096 + origin
            code = np.minimum.accumulate(code, axis=1)
            cost = code // 4096 + ramp
            first = code % 4096
        best = np.argmin(cost, axis=1)
        rows = np.arange(len(keep))
        good = cost[rows, best] <= e
        start = low[keep] + first[rows, best]
        end = low[keep] + best + size
        return np.stack([win[keep], start, end, cost[rows, best]], axis=1)[good]


def _places(text: str) -> np.ndarray:
    """Code point of ``text`` behind each byte of its lower-cased form."""
    low = text.lower()
    if len(low) == len(text):
        raw = np.frombuffer(low.encode("utf-8", "replace"), np.uint8)
        return np.cumsum((raw & 0xC0) != 0x80) - 1
    return np.repeat(np.arange(len(text)),
                     [len(c.lower().encode("utf-8", "replace")) for c in text])


def lots(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, at most TEXT_CHARS at a time or one text: the arrays of a search take
    about a hundred times as many bytes."""
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > TEXT_CHARS:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def find(index: Index, texts: list[str]) -> list[list[dict]]:
    """Leaks of each text: one entry per item, over all its windows."""
    raw = [t.lower().encode("utf-8", "replace") + b"\n" for t in texts]
    off = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    b, at = normalise(np.frombuffer(b"".join(raw), np.uint8))
    doc = np.searchsorted(off, at, side="right") - 1
    out: list[list[dict]] = [[] for _ in texts]
    if not index.ids or not len(b):
        return out
    rows = index.matches(b, doc)
    places: dict[int, np.ndarray] = {}
    new = np.flatnonzero(np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))
                         ) if len(rows) else np.zeros(0, np.int64)
    for r in np.split(rows, new[1:]) if len(rows) else []:
        d, item = int(r[0, 0]), int(r[0, 1])
        if d not in places:
            places = {d: _places(texts[d])}
        p = places[d]
        s, t = int(at[r[:, 3].min()] - off[d]), int(at[r[:, 4].max() - 1] - off[d])
        s, t = max(0, min(s, len(p) - 1)), max(0, min(t, len(p) - 1))
        out[d].append({"item_id": index.ids[item], "start": int(p[s]), "end": int(p[t]) + 1,
                       "windows": len(r), "edits": int(r[:, 5].min())})
    return out


def blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[Index]:
    """Indexes of the items, each over at most BLOCK_BYTES of their text (or one item)."""
    rows = (benchmark.where(F.col(text_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
            .orderBy("i", "t"))
    out, held, size = [], [], 0
    for r in rows.toLocalIterator():
        if held and size + len(r.t) > BLOCK_BYTES:
            out.append(Index(held))
            held, size = [], 0
        held.append((r.i, r.t))
        size += len(r.t)
    return out + [Index(held)] if held else out


def leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text", out: str = "leaks") -> DataFrame:
    """``docs`` with an array of the items that each document leaks."""
    small_batches(docs.sparkSession)
    parts = blocks(benchmark, item_id, item_text)
    names = [f"{out}__{i}" for i in range(len(parts))]
    for name, index in zip(names, parts, strict=True):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(b: pa.RecordBatch, sent=sent):
            col = b.column(b.schema.get_field_index(text_col)).fill_null("").to_pylist()
            found = [x for part in lots(col) for x in find(sent.value, part)]
            return [pa.array(found, type=_ARROW)]

        docs = append_arrow(docs, [(name, MATCH)], run)
    both = reduce(lambda x, y: F.concat(x, y), [F.col(n) for n in names],
                  F.array().cast(MATCH.simpleString()))
    keep = [c for c in docs.columns if c not in names and c.lower() != out.lower()]
    return docs.select(*[F.col(f"`{c}`") for c in keep], both.alias(out))


_ARROW = pa.list_(pa.struct([(f.name, pa.int64()) for f in MATCH.elementType.fields]))
