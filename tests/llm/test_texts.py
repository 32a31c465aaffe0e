import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fileflow.llm import backoff, decontam, pii, quality, rlbwt

from .conftest import prose


# -- op 5 -------------------------------------------------------------------------------------

def test_leaks_are_found_within_the_budget():
    r = random.Random(3)
    items = [(i, prose(100 + i, 30)) for i in range(8)] + [(8, "too short"), (9, "")]
    index = decontam.Index(items)
    for i, text in items[:8]:
        t = list(text)
        for _ in range(int(0.03 * len(t))):
            p = r.randrange(len(t))
            t[p:p + r.randrange(2)] = r.choice(["x", "", "yz"])
        doc = prose(1, 50) + "\n\n" + "".join(t).upper().replace(" ", "  ") + "! " + prose(2, 20)
        found = decontam.find(index, [doc, prose(3, 200), ""])
        assert [m["item_id"] for m in found[0]] == [i] and found[1:] == [[], []]


def test_passages_are_found_at_every_offset():
    item = prose(120, 60)
    index = decontam.Index([(1, item), (2, prose(121, 60))])
    docs = [f"{prose(5, 40)} ## {item[s:s + 98].strip()} ## {prose(6, 40)}"
            for s in range(len(item) - 98)]
    edited = [d.replace(item[s + 40:s + 43], "#") for s, d in enumerate(docs)]
    assert all([m["item_id"] for m in found] == [1] for found in decontam.find(index, docs))
    assert all([m["item_id"] for m in found] == [1] for s, found in enumerate(
        decontam.find(index, edited)) if edited[s].count("#") == 5)


def test_leak_places_and_blocks(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 100)
    bench = spark.createDataFrame([(1, prose(2, 60)), (2, None), (None, prose(3, 80)), (4, "é")],
                                  "item_id long, text string")
    rows = decontam.leaks(odd_docs, bench).collect()
    assert len(rows) == odd_docs.count() and rows[0].ids == "own"
    for r in rows:
        if r.text == prose(2, 60):
            assert [(m.item_id, m.start, m.end, m.edits) for m in r.leaks] == [
                (1, 0, len(r.text), 0)]
        elif r.doc_id == 8:
            assert [m.item_id for m in r.leaks] == [None]
        else:
            assert r.leaks == []
    assert decontam.leaks(no_docs, bench).count() == 0
    assert decontam.leaks(odd_docs, bench.limit(0)).where(F.size("leaks") > 0).count() == 0


def compared(text):
    import numpy as np
    b, _ = decontam.normalise(np.frombuffer(text.lower().encode(), np.uint8))
    return b.tobytes().decode().strip()


def fewest_edits(window, text):
    """Edits of the window's best place in the text, over all places (no bands, no q-grams)."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(window, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def brute_leaks(items, text):
    """{item id: (windows, edits)} by comparing every window with every place."""
    out, text = {}, compared(text)
    for i, item in items:
        item = compared(item)
        size = min(96, len(item))
        if size < 24:
            if size and f" {item} " in f" {text} ":
                out[i] = 0
            continue
        last = len(item) - size
        near = sorted({*range(0, last, 48), last})
        for starts in (near, [s for s in range(last) if s % 48]):
            cost = {s: fewest_edits(item[s:s + size], text) for s in starts}
            cost = [c for c in cost.values() if c <= size * 8 // 100]
            if cost and i not in out:
                out[i] = len(cost), min(cost)
    return {i: x or (1, 0) for i, x in out.items()}


def test_leaks_equal_brute_force():
    r = random.Random(8)
    sizes = [3, 11, 17, 24, 30, 39, 50, 63, 79, 95, 96, 100, 112]
    items = [(n, (prose(300 + n, 40)[:n - 1] + "q").replace(" q", "qq")) for n in sizes]
    items += [(200, "ab " * 40), (201, "c" * 110)]
    seen = 0
    for k in range(30):
        i, item = items[k % len(items)]
        t = list(item if len(item) < 100 else item[r.randrange(4):])
        budget = min(96, len(compared(item))) * 8 // 100
        for _ in range(max(0, budget + k % 4 - 2)):
            p = r.randrange(len(t))
            t[p:p + r.randrange(2)] = r.choice(["x", "", "y"])
        doc = prose(k, 8) + " " + "".join(t) + (" " if k % 3 else "") + prose(k + 1, 5)
        got = {m["item_id"]: (m["windows"], m["edits"]) for m in decontam.find(
            decontam.Index(items), [doc])[0]}
        assert got == brute_leaks(items, doc), (k, i)
        seen += len(got)
    assert seen > 12


def test_the_whole_budget_is_allowed_at_every_size():
    for size in (25, 30, 38, 39, 50, 75, 79, 95, 96):
        item = (prose(500 + size, 40)[:size - 1] + "q").replace(" q", "qq")
        budget = size * 8 // 100
        for n in (budget, budget + 1):
            t = list(item)
            for k in range(n):                    # spread as evenly as it goes
                t[(2 * k + 1) * size // (2 * n)] = "0"
            found = decontam.find(decontam.Index([(1, item)]), ["".join(t)])[0]
            assert [m["edits"] for m in found] == ([n] if n == budget else []), (size, n)


def test_short_items_count_where_they_occur_whole():
    index = decontam.Index([(1, "Yes, sir"), (2, "a"), (3, "x")])
    docs = ["well yes  sir!", "yes sire", "ayes sir", "yes", "sir", "A.", "bad", ""]
    assert [[m["item_id"] for m in f] for f in decontam.find(index, docs)] == [
        [1], [], [], [], [], [2], [], []]


def test_one_letter_takes_bounded_memory(monkeypatch):
    import tracemalloc
    monkeypatch.setattr(decontam, "SLICE", 1 << 15)
    index = decontam.Index([(1, "a" * 300)])
    tracemalloc.start()
    found = decontam.find(index, ["a" * 40_000])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(m["item_id"], m["start"], m["end"], m["edits"]) for m in found] == [(1, 0, 40_000, 0)]
    assert peak < 150 << 20


def test_grams_name_equal_strings():
    import numpy as np
    b = np.frombuffer(b"abcabcabcabcabcabcx", np.uint8)
    for size in range(1, 13):
        h = decontam.grams(b, size)
        raw = b.tobytes()
        same = {raw[i:i + size]: h[i] for i in range(len(h))}
        assert all(same[raw[i:i + size]] == h[i] for i in range(len(h)))
        assert len(set(h.tolist())) == len(same)


# -- op 6 -------------------------------------------------------------------------------------

def covered(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        m = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                m[i:i + length] = b"\1" * length
        out.append(m)
    return out


@pytest.mark.parametrize("length,letters", [(20, b"ab"), (20, b"abcdefgh"), (200, b"abc"), (9, b"a")])
def test_run_index_equals_brute_force(length, letters):
    r = random.Random(length)
    for _ in range(40):
        base = [bytes(r.choice(letters) for _ in range(r.randrange(300 + length)))
                for _ in range(3)]
        parts = []
        for _ in range(r.randrange(1, 7)):
            x = r.choice(base)
            y = x[r.randrange(len(x) + 1):] + r.choice(base)[:r.randrange(400)]
            parts.append(y + y[:250] * r.randrange(3))
        seen = Counter(p[i:i + length] for p in parts for i in range(len(p) - length + 1))
        want = [[i for i in range(len(p) - length + 1) if seen[p[i:i + length]] > 1] for p in parts]
        assert [x.tolist() for x in rlbwt.repeats(parts, length)] == want


@pytest.mark.parametrize("hot,chunk", [(4000, 1 << 20), (1, 1 << 20), (4000, 700)])
def test_substrings_equal_brute_force(spark, monkeypatch, hot, chunk):
    monkeypatch.setattr(rlbwt, "HOT", hot)
    monkeypatch.setattr(rlbwt, "CHUNK", chunk)
    r = random.Random(7)
    base = [prose(20 + k, 90) for k in range(5)]
    texts = [None, "", "short", "ab" * 400, base[0], base[0], "é" * 150]
    for k in range(30):
        x, y = r.choice(base), prose(300 + k, r.randrange(60))
        a = r.randrange(len(x))
        texts.append(y + x[a:a + r.randrange(150, 500)] + (y if r.random() < 0.3 else ""))
    got = {x.i: x for x in rlbwt.dedup(spark.createDataFrame(
        list(enumerate(texts)), "i long, text string")).collect()}
    raw = [(t or "").encode() for t in texts]
    for i, m in enumerate(covered(raw, 200)):
        assert sum(s.end - s.start for s in got[i].removed) == sum(m), i
        assert bytes(got[i].kept) == bytes(x for x, f in zip(raw[i], m) if not f)
        assert len(got[i].removed) == len(re.findall(rb"\x01+", bytes(m)))


def test_substrings_odd_rows(odd_docs, no_docs):
    rows = rlbwt.dedup(odd_docs).collect()
    assert len(rows) == odd_docs.count() and rows[0].spans == "own"
    assert all(bytes(r.kept) == (b"" if r.text == prose(2, 60) else bytes(r.kept)) for r in rows)
    assert rlbwt.dedup(no_docs).count() == 0


# -- op 7 -------------------------------------------------------------------------------------

def test_quality_ranks_and_holds_out(spark, odd_docs, no_docs):
    rows = []
    for k in range(300):
        good = prose(k, 40 + k % 30)
        rows.append((k, good if k % 3 else " ".join(w + "***" for w in good.split()), int(k % 3 > 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    train = docs.where(~quality.held_out())
    labels = train.select("doc_id", "quality").union(spark.createDataFrame(
        [(1, 0), (None, 1), (2, None), (5, 7)], "doc_id long, quality int"))
    model = quality.train(docs, labels)
    got = quality.score(docs, model).where(quality.held_out()).collect()
    assert got and sum(r.predicted == r.quality for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    odd = quality.score(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert quality.score(no_docs, model).count() == 0
    nothing = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, nothing).collect()} == {0.5}


# -- op 8 -------------------------------------------------------------------------------------

def brute_scores(texts):
    ws = [[w for w in (t or "").encode().lower().split()] for t in texts]
    u, b, t = Counter(), Counter(), Counter()
    for w in ws:
        u.update(w)
        b.update(zip(w, w[1:]))
        t.update(zip(w, w[1:], w[2:]))
    n, out = sum(u.values()), []
    for w in ws:
        s = 0.0
        for i, x in enumerate(w):
            if i > 1 and t[w[i - 2], w[i - 1], x] >= 2:
                s += math.log(t[w[i - 2], w[i - 1], x] / b[w[i - 2], w[i - 1]])
            elif i and b[w[i - 1], x] >= 2:
                s += math.log(b[w[i - 1], x] / u[w[i - 1]]) + (i > 1) * math.log(0.4)
            else:
                s += math.log(u[x] / n) + min(i, 2) * math.log(0.4)
        out.append((len(w), s))
    return out


@pytest.mark.parametrize("hot,part,lot", [(10**6, 10**6, 4000), (300, 500, 4), (1, 100, 7)])
def test_backoff_equals_brute_force(spark, monkeypatch, hot, part, lot):
    monkeypatch.setattr(backoff, "HOT", hot)
    monkeypatch.setattr(backoff, "PART", part)
    monkeypatch.setattr(backoff, "LOT_DOCS", lot)
    texts = [prose(k, k % 40) for k in range(120)] + [None, "", " \n", "a", "a b", "a a a a a"]
    got = {r.doc_id: r for r in backoff.scores(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, (n, s) in enumerate(brute_scores(texts)):
        assert got[i].n_words == n and got[i].log_score == pytest.approx(s, abs=1e-7), i


def test_backoff_records_travel_small_and_whole():
    r = np.random.default_rng(5)
    common = np.unique(r.integers(2, 1 << 63, 60_000).astype(np.uint64))
    names = np.unique(np.concatenate((common[::7], r.integers(2, 1 << 63, 500).astype(np.uint64))))
    place = np.minimum(np.searchsorted(common, names), len(common) - 1)
    place = np.where(common[place] == names, place, -1)
    steps, others = backoff._names_out(names, place)
    assert (backoff._names_in(steps, others, common) == names).all()
    assert len(steps) + len(others) < names.nbytes / 4
    c = r.integers(0, 5000, (3, 20_000))
    c[0].sort()
    back = backoff._code_in(backoff._code_out(c, np.uint16), np.uint16)
    assert (back == c).all()
    tag = r.integers(0, 60_000, 20_000)
    assert (backoff._tag_in(backoff._tag_out(tag, np.uint16), np.uint16) == tag).all()
    s = np.zeros(4000)
    s[[7, 9]] = -1.5
    b = backoff._lot_rows([(3, None, None, s)])
    assert b.nbytes < 200 and b.column("docs").to_pylist() == [4000]
    assert np.frombuffer(b.column("at")[0].as_py(), np.uint32).tolist() == [7, 9]


def test_backoff_odd_rows(odd_docs, no_docs):
    rows = backoff.scores(odd_docs).collect()
    want = brute_scores([r.text for r in odd_docs.collect()])
    assert sorted((r.n_words, round(r.log_score, 6)) for r in rows) == sorted(
        (n, round(s, 6)) for n, s in want)
    assert backoff.scores(no_docs).count() == 0


# -- op 10 ------------------------------------------------------------------------------------

PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and any(int(x) > 255 for x in m.group().split("."))
                    or kind == "card" and not (12 <= len(d) <= 19 and luhn(d))
                    or kind == "phone" and not 9 <= len(d) <= 15):
                continue
            out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def pii_texts():
    r = random.Random(9)
    parts = ["a.b@c.de", "x@y", "@z.com", "q@w.e.r", "_@a-b.c", "1.2.3.4", "0255.1.1.1", "256.1.1.1",
             "1.2.3", "4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1112", "+1 (743) 555-3824",
             "+12 34", "+1-2-3-4-5-6-7-8-9", " ", "  ", "é", "漢", "😀", "call 555-123-4567", "7", "-", ".",
             "me [at] site [dot] org", "\n", "+", "99", "word"]
    return ["".join(r.choice(parts) for _ in range(r.randrange(1, 14))) for _ in range(600)]


def test_pii_base_spans_equal_plain_patterns(spark):
    texts = pii_texts() + ["1.2.3.4 " * 300, "a@b.c" + ".d" * 20000, "1" * 5000, "+1" * 3000]
    rows = pii.detect(spark.createDataFrame(list(enumerate(texts)), "i long, text string")).select(
        "i", "text", pii.written("base_spans").alias("base"), pii.written("spans").alias("every"))
    for r in rows.collect():
        assert r.base == plain_spans(r.text), (r.text[:80], r.base[:80])
        assert set(r.base.split(",")) - {""} <= set(r.every.split(","))


def test_pii_adds_cued_numbers_and_redacts(spark):
    rows = [(k, f"please call 555-123-{4000 + k} now, or +1 (743) 555-{3000 + k}. "
                f"id 9{k:03d}111222333444 and mail a{k}@site.org") for k in range(60)]
    found = pii.detect(spark.createDataFrame(rows, "doc_id long, text string"))
    r = found.where("doc_id = 5").first()
    kinds = [s.kind for s in r.spans]
    assert kinds.count("phone") == 2 and kinds.count("email") == 1
    text = pii.redact(found).where("doc_id = 5").first().text
    assert "[EMAIL]" in text and text.count("[PHONE]") == 2 and "@" not in text


def test_pii_odd_rows(odd_docs, no_docs):
    rows = pii.redact(pii.detect(odd_docs))
    got = rows.collect()
    assert len(got) == odd_docs.count() and got[0].ids == "own"
    assert sorted(str(r.text) for r in got) == sorted(str(r.text) for r in odd_docs.collect())
    assert pii.detect(no_docs).count() == 0


def test_pii_overlaps_are_redacted_together(spark):
    df = spark.createDataFrame([(1, "x 1.2.3.4@h.org y")], "doc_id long, text string")
    assert pii.redact(pii.detect(df)).first().text == "x [EMAIL] y"
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(
        F.sha2(F.lit(""), 256)).first()[0]


def test_quality_trains_on_every_labelled_row(spark):
    import numpy as np
    r = random.Random(5)
    rows = [(i, prose(i, 12) if i % 4 else " ".join(r.choice("abc!? ") for _ in range(30)),
             int(i % 4 > 0)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = docs.select("doc_id", "quality")
    w, cut = quality.train(docs, labels, sample=40)
    # rows that the first 40 of each label, by the hash of the id, leave out
    last = [x.doc_id for x in docs.orderBy(F.xxhash64("doc_id").desc()).limit(2).collect()]
    for i in last:
        other = docs.withColumn("text", F.when(F.col("doc_id") == i, "1 2 3").otherwise(F.col("text")))
        assert not np.array_equal(quality.train(other, labels, sample=40)[0], w)
    x = quality.features(__import__("pyarrow").array([t for _, t, _ in rows]))
    y, z = np.array([q for *_, q in rows]), x.astype(np.float64) @ w
    order = np.sort(z)
    assert order[98] <= cut <= order[100]                  # the share of label 0 is a quarter
    got = quality.score(docs, (w, cut)).collect()
    assert sum(g.predicted == g.quality for g in got) >= 0.97 * len(got) and y.sum() == 300
    whole = quality.train(docs, labels, sample=400)        # one lot: its own fit
    want = quality.fit(x, y, 0.25)
    assert np.allclose(whole[0], want[0]) and abs(whole[1] - want[1]) < 1e-9


def test_quality_threshold_equals_the_sorted_one(spark):
    import numpy as np
    r = random.Random(8)
    for values in ([r.gauss(0, 1) for _ in range(500)], [r.randrange(4) * 1.0 for _ in range(90)],
                   [0.5] * 20, [0.0, 1e-300, 1.0, 1e9, 1e9 + 1e-6] * 9):
        y = [int(r.random() < .6) for _ in values[:-2]] + [0, 1]
        z = spark.createDataFrame(list(zip(y, map(float, values))), "y int, z double")
        share, y = .4, np.array(y)
        order = np.lexsort((y, values))
        weight = np.where(y == 0, share / (y == 0).sum(), (1 - share) / (y == 1).sum())[order]
        cut = min(int(np.searchsorted(np.cumsum(weight), share)), len(order) - 1)
        s = np.array(values)[order]
        got = quality._threshold(z, share)
        assert s[max(0, cut - 1)] <= got <= s[cut], (got, s[max(0, cut - 1)], s[cut])


def test_rare_labels_reach_every_lot(spark):
    rows = spark.range(900).select(F.col("id"), F.lit("t").alias("text"),
                                   (F.col("id") < 4).cast("int").alias("y"))
    dealt, lots = quality._deal(rows, {0: 896, 1: 4}, 100)
    got = dealt.groupBy("lot").agg(F.sum("y").alias("n1"), F.count("*").alias("n")).collect()
    assert lots == 9 and len(got) == 9 and all(r.n1 == 4 for r in got)
    assert sum(r.n for r in got) == 896 + 9 * 4


def test_leaks_are_searched_in_bounded_lots():
    texts = ["a" * 300_000, "b" * 300_000, "", "c" * 2_000_000, "d"]
    assert [len(x) for x in decontam.lots(texts)] == [1, 2, 1, 1]
    assert [t for part in decontam.lots(texts) for t in part] == texts
    index, r = decontam.Index([(1, prose(3, 40))]), random.Random(1)
    docs = [prose(9, 20) + " " + prose(3, 40) if r.random() < .4 else prose(i, 30)
            for i in range(40)]
    parts = [x for d in docs for x in decontam.find(index, [d])]
    assert decontam.find(index, docs) == parts and any(parts)
