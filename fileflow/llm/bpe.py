"""BPE encoding and decoding (operator 9).

A pre-token is encoded by a segment tree over its adjacent pair ranks: leaf j holds the rank
of the pair that starts at symbol j, the root holds the leftmost lowest rank. Each merge is
three point updates of log2(length) levels, until the root says that no pair can be merged.
The trees of a batch's new pre-tokens stand side by side in one array, so every step is a
vectorised update of all pre-tokens still being merged.

A batch's words are named by one dictionary encoding; ids of texts and bytes of ids are then taken
from flat arrays. Words of thousands of bytes are cut where no token of the vocabulary can reach
across, so a text without spaces becomes many short trees; where it cannot be cut (one letter over
and over) it is one tree.

Spark splits the documents; a worker holds the vocabulary and a bounded memo of encoded words
(begun anew when full, which costs time but never changes a result).

Defined cases: a null text counts as empty (no ids, decoded text ""); whole texts of any
length; repeated rows are encoded alike; input columns named like an output are replaced.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import append_arrow, small_batches, text_bytes

#: Fixed value: the pre-token pattern of the byte-level format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO_WORDS = 300_000
TREE_CELLS = 1 << 20          # cells of one block of trees
LONG_WORD = 2048              # longer words get a tree of their own, in plain lists
_NONE = np.int64(1 << 62)
#: A space that touches white space other than spaces and line feeds.
_TOUCH = regex.compile(r"[^\S ] | [^\S ]")
#: White space of the pattern besides space and line feed, by its bytes in UTF-8.
_BLANKS = [c.encode() for c in regex.findall(r"[^\S \n]", "".join(map(chr, range(0x3001))))]
_BLANK_BYTE = np.isin(np.arange(256), [c[0] for c in _BLANKS if len(c) == 1])
_BLANK_LEAD = np.isin(np.arange(256), [c[0] for c in _BLANKS if len(c) > 1])
_BLANK_TWO = [c[0] << 8 | c[1] for c in _BLANKS if len(c) == 2]
_BLANK_THREE = [c[0] << 16 | c[1] << 8 | c[2] for c in _BLANKS if len(c) == 3]


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for i, b in enumerate(x for x in range(256) if x not in out):
        out[b] = chr(256 + i)
    return out


class Codec:
    """Vocabulary, merges and added tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as fh:
            j = json.load(fh)
        vocab = j["model"]["vocab"]
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        self.byte_id = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int64)
        self.size = max(vocab.values()) + 1
        self.piece = {i: bytes(back[c] for c in s) for s, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in j.get("added_tokens") or []}
        for s, i in self.added.items():
            self.piece[i] = s.encode("utf-8")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in j["model"]["merges"]]
        key = np.array([vocab[x] * self.size + vocab[y] for x, y in pairs], dtype=np.int64)
        order = np.argsort(key)
        self.pair_key, self.pair_rank = key[order], order.astype(np.int64)
        self.rank_of = dict(zip(key.tolist(), range(len(key)), strict=True))
        self.merged = np.array([vocab[x + y] for x, y in pairs], dtype=np.int64)
        self.words = regex.compile(PATTERN)
        self.special = (regex.compile("|".join(regex.escape(s) for s in
                                               sorted(self.added, key=len, reverse=True)))
                        if self.added else None)
        top = max(self.piece) + 1
        self.pieces = pa.array([self.piece.get(i, b"") for i in range(top)] + [b""],
                               pa.large_binary())
        # byte pairs that are a token, and byte triples that occur in one: see ``cuts``
        self.pair, self.triple = np.zeros(1 << 16, bool), np.zeros(1 << 24, bool)
        for x in self.piece.values():
            if len(x) == 2:
                self.pair[x[0] << 8 | x[1]] = True
            elif len(x) > 2:
                t = np.frombuffer(x, np.uint8).astype(np.int64)
                self.triple[t[:-2] << 16 | t[1:-1] << 8 | t[2:]] = True
        self.memo: dict[bytes, int] = {}         # word -> its place in the lists below
        self.lists: list[np.ndarray] = []        # ids of words, one array per batch
        self.sizes: list[np.ndarray] = []        # how many ids each word has

    def leaf(self, left: np.ndarray, right: np.ndarray, pos: np.ndarray, cap: int) -> np.ndarray:
        """Leaf values rank * cap + position, or _NONE where the pair has no rank."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at] * cap + pos, _NONE)

    def encode_words(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each word (non-empty byte strings)."""
        out: list[tuple[int, ...]] = [()] * len(words)
        size = np.array([len(w) for w in words], dtype=np.int64)
        cap_of = 1 << np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64)
        for cap in np.unique(cap_of):
            rows = np.flatnonzero(cap_of == cap)
            if cap > LONG_WORD:
                for r in rows:
                    parts = self.cuts(words[r])
                    out[r] = (tuple(i for ids in self.encode_words(parts) for i in ids)
                              if len(parts) > 1 else self._one_tree(words[r], int(cap)))
                continue
            step = max(1, TREE_CELLS // int(cap))
            for i in range(0, len(rows), step):
                part = rows[i:i + step]
                for r, ids in zip(part, self._trees([words[k] for k in part], size[part],
                                                    int(cap)), strict=True):
                    out[r] = ids
        return out

    def cuts(self, word: bytes) -> list[bytes]:
        """The word cut where no token can reach across: a token over the place between two bytes
        is these two, or holds a third byte on either side."""
        b = np.concatenate(([0], np.frombuffer(word, np.uint8), [0])).astype(np.int64)
        pair = b[1:-2] << 8 | b[2:-1]
        joined = self.pair[pair]
        joined[1:] |= self.triple[(b[1:-3] << 16) | pair[1:]]
        joined[:-1] |= self.triple[pair[:-1] << 8 | b[3:-1]]
        at = [0, *(np.flatnonzero(~joined) + 1).tolist(), len(word)]
        return [word[x:y] for x, y in zip(at, at[1:])]

    def _trees(self, words: list[bytes], size: np.ndarray, cap: int) -> list[tuple[int, ...]]:
        n = len(words)
        cols = np.arange(cap)
        inside = cols[None, :] < size[:, None]
        sym = np.full((n, cap), -1, dtype=np.int64)
        sym[inside] = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        nxt = np.where(cols[None, :] + 1 < size[:, None], cols[None, :] + 1, cap)
        prv = np.tile(cols - 1, (n, 1))
        tree = np.full((n, 2 * cap), _NONE, dtype=np.int64)
        r, c = np.nonzero(nxt < cap)
        tree[r, cap + c] = self.leaf(sym[r, c], sym[r, c + 1], c, cap)
        k = cap
        while k > 1:
            k >>= 1
            tree[:, k:2 * k] = np.minimum(tree[:, 2 * k:4 * k:2], tree[:, 2 * k + 1:4 * k:2])
        live = np.flatnonzero(tree[:, 1] < _NONE)
        while len(live):
            root = tree[live, 1]
            pos, new = root % cap, self.merged[root // cap]
            gone = nxt[live, pos]
            after = nxt[live, gone]
            sym[live, pos], sym[live, gone] = new, -1
            nxt[live, pos] = after
            more = after < cap
            prv[live[more], after[more]] = pos[more]
            value = np.full(len(live), _NONE)
            value[more] = self.leaf(new[more], sym[live[more], after[more]], pos[more], cap)
            before = prv[live, pos]
            has = before >= 0
            left = np.full(len(live), _NONE)
            left[has] = self.leaf(sym[live[has], before[has]], new[has], before[has], cap)
            before = np.where(has, before, pos)          # no left pair: the same leaf again
            left = np.where(has, left, value)
            spots = (cap + pos, cap + gone, cap + before)
            tree[live, spots[1]] = _NONE
            tree[live, spots[0]] = value
            tree[live, spots[2]] = left
            while spots[0][0] > 1:
                spots = tuple(s >> 1 for s in spots)
                for s in spots:
                    tree[live, s] = np.minimum(tree[live, 2 * s], tree[live, 2 * s + 1])
            live = live[tree[live, 1] < _NONE]
        kept = sym >= 0
        flat, ends = sym[kept].tolist(), np.cumsum(kept.sum(axis=1)).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends], ends)]

    def _one_tree(self, word: bytes, cap: int) -> tuple[int, ...]:
        """The same tree for one long word: point updates on plain lists."""
        n, none = len(word), int(_NONE)
        sym = self.byte_id[np.frombuffer(word, dtype=np.uint8)]
        pos = np.arange(n - 1)
        tree = np.full(2 * cap, _NONE)
        tree[cap + pos] = self.leaf(sym[:-1], sym[1:], pos, cap)
        k = cap
        while k > 1:
            k >>= 1
            tree[k:2 * k] = np.minimum(tree[2 * k:4 * k:2], tree[2 * k + 1:4 * k:2])
        tree, sym, merged = tree.tolist(), sym.tolist(), self.merged
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, value: int) -> None:
            i += cap
            tree[i] = value
            while i > 1:
                i >>= 1
                low = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == low:
                    break
                tree[i] = low

        def pair(i: int) -> int:
            rank = self.rank_of.get(sym[i] * self.size + sym[nxt[i]])
            return none if rank is None else rank * cap + i

        while tree[1] < none:
            rank, i = divmod(tree[1], cap)
            gone = nxt[i]
            sym[i], sym[gone], nxt[i] = int(merged[rank]), -1, nxt[gone]
            put(gone, none)
            if nxt[i] < n:
                prv[nxt[i]] = i
                put(i, pair(i))
            else:
                put(i, none)
            if prv[i] >= 0:
                put(prv[i], pair(prv[i]))
        return tuple(s for s in sym if s >= 0)

    def _pattern(self, text: str) -> list[str]:
        """Pre-tokens and added tokens of a text."""
        out, at = [], 0
        for m in self.special.finditer(text) if self.special else ():
            out += [*self.words.findall(text[at:m.start()]), m.group()]
            at = m.end()
        return out + self.words.findall(text[at:])

    def pieces_of(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, places where a piece starts, offsets of texts) of a batch: pieces that no
        pre-token crosses. Where white space stands alone a pre-token starts before each space and
        before each line feed. Where a space touches other white space, a pre-token can hold both,
        and an added token can be anywhere: there the pattern decides on the whole text."""
        buf, off = text_bytes(col)
        n = len(buf)
        start = np.zeros(n + 1, dtype=bool)
        start[off] = True
        if not n:
            return buf, np.zeros(0, np.int64), off
        edge = start[1:n]                        # the next byte belongs to another text
        space, line = buf == 32, buf == 10
        white = space | line
        touch = (white[:-1] & white[1:] & (space[:-1] | space[1:])) & ~edge
        blank = _BLANK_BYTE[buf]
        lead = np.flatnonzero(_BLANK_LEAD[buf])
        if len(lead):
            three = np.stack([buf[np.minimum(lead + k, n - 1)] for k in range(3)]).astype(np.int64)
            blank[lead] = np.isin(three[0] << 16 | three[1] << 8 | three[2], _BLANK_THREE) \
                | np.isin(three[0] << 8 | three[1], _BLANK_TWO)
        docs = len(off) - 1

        def has(places: np.ndarray) -> np.ndarray:
            out = np.zeros(docs, dtype=bool)
            out[np.searchsorted(off, np.flatnonzero(places), side="right") - 1] = True
            return out

        odd, blanks = has(touch), has(blank)
        slow = odd.copy()
        for i in np.flatnonzero(blanks & ~odd).tolist():
            slow[i] = _TOUCH.search(col[i].as_py()) is not None
        raw = buf.tobytes()
        for s in self.added:
            at = raw.find(s := s.encode("utf-8"))
            while at >= 0:
                slow[np.searchsorted(off, at, side="right") - 1] = True
                at = raw.find(s, at + 1)
        plain = np.repeat(~slow, np.diff(off))
        start[:n] |= space & plain
        alone = line.copy()                      # the first of its line feeds
        alone[1:] &= ~line[:-1] | edge
        start[:n] |= alone & plain & np.repeat(~blanks, np.diff(off))
        for i in np.flatnonzero(slow).tolist():
            sizes = [len(x.encode("utf-8")) for x in self._pattern(col[i].as_py())]
            start[off[i] + np.cumsum(sizes)[:-1]] = True
        return buf, np.flatnonzero(start[:n]), off

    def _learn(self, words: list[bytes]) -> None:
        """Put new words' ids into the memo; all of them are merged side by side."""
        found = {w: [self.added[t]] if (t := w.decode("utf-8", "replace")) in self.added
                 else self.words.findall(t) for w in words}
        new = list(dict.fromkeys(p for ps in found.values() for p in ps if isinstance(p, str)))
        ids = dict(zip(new, self.encode_words([p.encode("utf-8", "replace") for p in new]),
                       strict=True))
        rows = [ids[ps[0]] if len(ps) == 1 and isinstance(ps[0], str) else
                [i for p in ps for i in (ids[p] if isinstance(p, str) else (p,))]
                for ps in found.values()]
        self.sizes.append(np.fromiter(map(len, rows), dtype=np.int64, count=len(rows)))
        self.lists.append(np.fromiter((i for r in rows for i in r), dtype=np.int32,
                                      count=int(self.sizes[-1].sum())))
        at = len(self.memo)
        self.memo.update(zip(found, range(at, at + len(rows))))

    def encode_column(self, col: pa.Array) -> pa.ListArray:
        """Ids of each text (null: empty). New words of the whole batch are merged together; a
        full memo keeps the words of the last batch."""
        col = col.fill_null("")
        buf, at, off = self.pieces_of(col)
        ends = np.concatenate((at, [len(buf)])).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(at), [
            None, pa.py_buffer(ends.tobytes()), pa.py_buffer(buf.tobytes())]).dictionary_encode()
        names = words.dictionary.to_pylist()
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.lists, self.sizes = {}, [], []
        fresh = [w for w in names if w not in self.memo]
        if fresh:
            self._learn(fresh)
            self.lists, self.sizes = [np.concatenate(self.lists)], [np.concatenate(self.sizes)]
        place = np.fromiter(map(self.memo.__getitem__, names), dtype=np.int64, count=len(names))
        if not len(names):
            return pa.ListArray.from_arrays(pa.array(np.zeros(len(off), np.int32)),
                                            pa.array([], pa.int32()))
        known = pa.LargeListArray.from_arrays(
            np.concatenate((np.zeros(1, np.int64), np.cumsum(self.sizes[0]))),
            pa.array(self.lists[0]))
        code = words.indices.to_numpy(zero_copy_only=False)
        rows = known.take(pa.array(place[code]))
        token = rows.offsets.to_numpy() - rows.offsets[0].as_py()
        return pa.ListArray.from_arrays(token[np.searchsorted(at, off)].astype(np.int32),
                                        rows.flatten())

    def decode_column(self, rows: pa.ListArray) -> pa.Array:
        """Text of each list of ids (null: empty); unknown ids and nulls give nothing, broken
        UTF-8 gives U+FFFD."""
        rows = pa.ListArray.from_arrays(
            np.concatenate(([0], np.cumsum(rows.value_lengths().fill_null(0)))).astype(np.int32),
            rows.flatten())
        last = len(self.pieces) - 1
        ids = rows.values.cast(pa.int64()).fill_null(last).to_numpy(zero_copy_only=False)
        got = self.pieces.take(pa.array(np.where((ids < 0) | (ids > last), last, ids)))
        cut = np.frombuffer(got.buffers()[1], np.int64)[rows.offsets.to_numpy()]
        data = got.buffers()[2] or pa.py_buffer(b"")
        whole = pa.Array.from_buffers(pa.large_binary(), len(rows),
                                      [None, pa.py_buffer(cut.astype(np.int64).tobytes()), data])
        try:
            return whole.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "replace") for x in whole.to_pylist()], pa.string())

    def encode_texts(self, texts: list[str]) -> list[list[int]]:
        return self.encode_column(pa.array(texts, pa.string())).to_pylist()

    def decode_ids(self, ids: list[int]) -> str:
        return self.decode_column(pa.array([ids], pa.list_(pa.int32())))[0].as_py()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _column(batch: pa.RecordBatch, col: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(col))


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with an array<int> of token ids."""
    small_batches(docs.sparkSession)
    return append_arrow(docs, [(out, T.ArrayType(T.IntegerType()))], lambda b: [
        codec(path).encode_column(_column(b, text_col))])


def decode(docs: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of each array of ids (null: empty)."""
    small_batches(docs.sparkSession)
    return append_arrow(docs, [(out, T.StringType())], lambda b: [
        codec(path).decode_column(_column(b, ids_col))])


def encode_decode(docs: DataFrame, path: str, text_col: str = "text", ids: str = "ids",
                  decoded: str = "decoded") -> DataFrame:
    """Both in one pass over the documents: ids, and the text that those ids decode to."""
    small_batches(docs.sparkSession)

    def run(b: pa.RecordBatch):
        rows = codec(path).encode_column(_column(b, text_col))
        return [rows, codec(path).decode_column(rows)]

    return append_arrow(docs, [(ids, T.ArrayType(T.IntegerType())),
                               (decoded, T.StringType())], run)
