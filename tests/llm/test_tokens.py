import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from fileflow.llm import bpe, unigram
from fileflow.llm.queries import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
PIECES = tokenizer_path("piece_bpe_32k.model")


def texts(n=400):
    r = random.Random(1)
    return ["", " ", "a  b   c", "x \n y\r\n", "it's we'll", "aaaa" * 400, "日本語 123abc", "end  "] + [
        "".join(r.choice(" ab'\n\tsé1!<|endoftext|>　▁") for _ in range(r.randrange(80)))
        for _ in range(n)]


def test_bpe_equals_library():
    c, t = bpe.Codec(PATH), Tokenizer.from_file(PATH)
    xs = texts()
    got = c.encode_texts(xs)
    assert got == [e.ids for e in t.encode_batch(xs, add_special_tokens=False)]
    assert [c.decode_ids(x) for x in got] == [t.decode(x, skip_special_tokens=False) for x in got]


def test_bpe_other_white_space_beside_spaces():
    c, t = bpe.Codec(PATH), Tokenizer.from_file(PATH)
    r = random.Random(2)
    blanks = "\t\n\x0b\x0c\r\x1c\x1f\x85\xa0\u1680\u2003\u2009\u2028\u2029\u202f\u205f\u3000\u200b"
    xs = ["Home \xa0 \xa0 News", "x \xa0 \xa0 \xa0 \xa0 y", "a \xa0b", "a\xa0 b", "\xa0 ", " \xa0",
          *[f"a {b} {b} b{b} {b}c {b}" for b in blanks]]
    xs += ["".join(r.choice("  ab1," + r.choice(blanks)) for _ in range(r.randrange(30)))
           for _ in range(1000)]
    assert c.encode_texts(xs) == [e.ids for e in t.encode_batch(xs, add_special_tokens=False)]


def test_bpe_long_word_tree(monkeypatch):
    monkeypatch.setattr(bpe, "LONG_WORD", 4)
    c, t = bpe.Codec(PATH), Tokenizer.from_file(PATH)
    xs = texts(100)
    assert c.encode_texts(xs) == [e.ids for e in t.encode_batch(xs, add_special_tokens=False)]


def test_bpe_text_without_spaces():
    c, t = bpe.Codec(PATH), Tokenizer.from_file(PATH)
    r = random.Random(4)
    xs = ["".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(100_000)),
          "".join(r.choice("abcdeü1-") for _ in range(20_000)), "the" * 3000, "=" * 5000]
    assert c.encode_texts(xs) == [e.ids for e in t.encode_batch(xs, add_special_tokens=False)]
    assert len(c.cuts(xs[0].encode())) > 1000


def test_bpe_lines_and_columns(spark):
    c, t = bpe.Codec(PATH), Tokenizer.from_file(PATH)
    r = random.Random(5)
    xs = ["".join(r.choice(["a", "B.", "\n", "\n", " ", "\n\n", "\t", "\r\n", "é", "’", "'s", "1",
                            "<|endoftext|>"]) for _ in range(r.randrange(40))) for _ in range(2000)]
    xs += ["a\nb", "a\n\n\nb", "\n", "\n\n", "end\n", "end ", "a\tb\nc"]
    assert c.encode_texts(xs) == [e.ids for e in t.encode_batch(xs, add_special_tokens=False)]
    ids = spark.createDataFrame([(None,), ([],), ([None, 1, 10 ** 8, -1],), ([128], )], "ids array<int>")
    got = [x.decoded for x in bpe.decode(ids, PATH).collect()]
    assert got[:2] == ["", ""] and got[2] == t.decode([1]) and len(got[3]) == 1


def test_bpe_memo_does_not_change_results(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 3)
    c, d = bpe.Codec(PATH), bpe.Codec(PATH)
    for x in texts(50):
        assert c.encode_texts([x]) == d.encode_texts([x])


def test_bpe_frames(odd_docs, no_docs):
    rows = bpe.encode_decode(odd_docs, PATH).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.decoded == (r.text or "") for r in rows)
    assert rows[0].leaks == "own"
    again = bpe.decode(bpe.encode(odd_docs, PATH), PATH).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert bpe.encode_decode(no_docs, PATH).count() == 0


@pytest.mark.parametrize("byte_pieces", [True, False])
def test_viterbi_equals_library(byte_pieces):
    pieces, _ = unigram.vocabulary(PIECES)
    low = min(s for _, s in pieces)
    extra = [("<unk>", low)] + [(f"<0x{i:02X}>", low) for i in range(256)] * byte_pieces
    t = Tokenizer(models.Unigram(extra + pieces, unk_id=0, byte_fallback=byte_pieces))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    xs = texts() + ["𠀀𠀁 漢𠀀e", "\x00 a\x00b"]
    want = [len(e.ids) for e in t.encode_batch(xs, add_special_tokens=False)]
    assert unigram.Counter(pieces, byte_pieces).count_texts(xs) == want


def test_viterbi_ties():
    c = unigram.Counter([("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("▁a", -2.0)], False)
    t = Tokenizer(models.Unigram([("<unk>", -2.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0),
                                  ("▁a", -2.0)], unk_id=0, byte_fallback=False))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    xs = ["a" * n for n in range(9)]
    assert c.count_texts(xs) == [len(e.ids) for e in t.encode_batch(xs, add_special_tokens=False)]


def test_viterbi_frames(odd_docs, no_docs):
    rows = unigram.token_counts(odd_docs, PIECES).collect()
    assert [r.n_tokens for r in rows if not r.text] == [0, 0, 0]
    assert all(r.n_tokens > 0 for r in rows if r.text)
    assert unigram.token_counts(no_docs, PIECES).where(F.col("n_tokens") > 0).count() == 0
