"""Token counts of a unigram tokenizer by count-only Viterbi (operator 4).

An Aho-Corasick automaton over the vocabulary enumerates every piece that occurs in a word; the
dynamic programme keeps, for each position, the best score and the number of pieces on the best
path, never the pieces themselves. All new words of a batch run side by side, one start
position after another, so ties fall as in the tokenizers library: pieces are tried in the
order of their start, and a later path must be strictly better.

Words are split as its Metaspace pre-tokenizer does (each space becomes U+2581 and begins a
word; one is put before the text). A character without a piece of its own costs the lowest
score less 10; runs of such characters become byte pieces where the vocabulary has all of them,
else one unknown piece.

Defined cases: a null or empty text has 0 tokens; texts of any length are read whole; repeated
rows get equal counts; an input column named like the output is replaced.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import append_arrow, small_batches

SPACE, UNKNOWN_PENALTY = "▁", 10.0
MEMO_WORDS, LOT = 300_000, 200_000       # words remembered; characters in one automaton run


def vocabulary(path: str) -> tuple[list[tuple[str, float]], bool]:
    """(piece, score) of the ordinary pieces of a vocabulary file, and whether it has all byte
    pieces."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(m.get_piece_size())
    pieces = [(m.id_to_piece(i), float(m.get_score(i))) for i in ids
              if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
    return pieces, sum(map(m.is_byte, ids)) == 256


class Counter:
    """Counts pieces of words by Viterbi."""

    def __init__(self, pieces: list[tuple[str, float]], byte_pieces: bool):
        self.score = np.array([s for _, s in pieces])
        self.size = np.array([len(p) for p, _ in pieces], dtype=np.int64)
        self.names = {p for p, _ in pieces}
        self.unknown = float(self.score.min()) - UNKNOWN_PENALTY
        self.byte_pieces = byte_pieces
        self.find = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, (p, _) in enumerate(pieces):
            self.find.add_word(p, i)
        self.find.make_automaton()
        self.memo: dict[str, int] = {}

    def count_words(self, words: list[str]) -> list[int]:
        """Pieces of each word, in lots of bounded size."""
        out: list[int] = []
        lot: list[str] = []
        size = 0
        for w in words:
            lot.append(w)
            size += len(w) + 1
            if size >= LOT:
                out += self._lot(lot)
                lot, size = [], 0
        return out + (self._lot(lot) if lot else [])

    def _lot(self, words: list[str]) -> list[int]:
        text = "\x00".join(words) + "\x00"       # word w owns len(w) + 1 positions
        size = np.array([len(w) for w in words], dtype=np.int64)
        begin = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
        got = np.fromiter(chain.from_iterable(self.find.iter(text)), dtype=np.int64)
        end, piece = got[::2] + 1, got[1::2]
        start = end - self.size[piece]
        word = np.searchsorted(begin, start, side="right") - 1
        inside = end <= begin[word] + size[word]  # no piece runs over the end of its word
        end, piece, start, word = end[inside], piece[inside], start[inside], word[inside]
        single = np.zeros(len(text), dtype=bool)
        single[start[self.size[piece] == 1]] = True
        single[begin + size] = True              # the place after a word needs no piece
        alone = np.flatnonzero(~single)
        weight = np.array([len(text[i].encode("utf-8", "replace")) for i in alone.tolist()],
                          dtype=np.int64) if self.byte_pieces else np.ones(len(alone), np.int64)
        alone_word = np.searchsorted(begin, alone, side="right") - 1

        src = np.concatenate((start, alone))
        dst = np.concatenate((end, alone + 1))
        gain = np.concatenate((self.score[piece], np.full(len(alone), self.unknown)))
        cost = np.concatenate((np.ones(len(start), np.int64), weight))
        odd = np.concatenate((np.zeros(len(start), bool), np.ones(len(alone), bool)))
        rel = np.concatenate((start - begin[word], alone - begin[alone_word]))
        order = np.argsort(rel, kind="stable")
        src, dst, gain, cost, odd, rel = (x[order] for x in (src, dst, gain, cost, odd, rel))
        best = np.full(len(text) + 1, -np.inf)
        best[begin] = 0.0
        count = np.zeros(len(text) + 1, np.int64)
        last_odd = np.zeros(len(text) + 1, bool)
        cuts = np.flatnonzero(np.diff(rel)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rel)]):
            s, d = src[a:b], dst[a:b]
            score = best[s] + gain[a:b]
            ok = score > best[d]
            s, d, n = s[ok], d[ok], cost[a:b][ok]
            if not self.byte_pieces:             # a run of unknown characters is one piece
                n = np.where(odd[a:b][ok] & last_odd[s], 0, n)
            best[d], count[d], last_odd[d] = score[ok], count[s] + n, odd[a:b][ok]
        return count[begin + size].tolist()

    def count_texts(self, texts: list[str]) -> list[int]:
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        memo = self.memo
        rows = []
        for t in texts:
            w = t.replace(" ", SPACE).split(SPACE) if SPACE in t else t.split(" ")
            rows.append(w[1:] if not w[0] else w)
        new = list(dict.fromkeys(w for r in rows for w in r if w not in memo))
        memo.update(zip(new, self.count_words([SPACE + w for w in new]), strict=True))
        return [sum(map(memo.__getitem__, r)) for r in rows]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(*vocabulary(path))


def token_counts(docs: DataFrame, path: str, text_col: str = "text",
                 out: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of unigram tokens of each text."""
    small_batches(docs.sparkSession)

    def run(b: pa.RecordBatch):
        texts = b.column(b.schema.get_field_index(text_col)).fill_null("").to_pylist()
        return [pa.array(counter(path).count_texts(texts), pa.int64())]

    return append_arrow(docs, [(out, T.LongType())], run)
