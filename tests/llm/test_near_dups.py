import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fileflow.llm import minhash, nndescent
from fileflow.llm.common import components

from .conftest import prose


def closed(pairs, ids):
    low = {i: i for i in ids}
    for _ in ids:
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    return low


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else (
        {tuple(w)} if w else set())


def edited(text, n, r):
    w = text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"z{r.randrange(10**6)}"
    return " ".join(w)


def test_components(spark):
    r = random.Random(4)
    pairs = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in
                                                                          range(300, 340)]
    got = {x.id: x.component for x in components(spark.createDataFrame(pairs, "a long, b long"))
           .collect()}
    want = closed(pairs, range(400))
    assert all(got[a] == want[a] for p in pairs if p[0] != p[1] for a in p)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [1 << 19, 700])
def test_minhash_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    r = random.Random(2)
    texts = []
    for base in range(6):
        t = prose(base, 70)
        texts += [t, t.upper()] + [edited(t, r.randrange(4), r) for _ in range(9)]
    texts += [prose(50 + k, 40) for k in range(10)] + ["a b c d", "a b c d e", "a b c", "A b C", ""]
    rows = list(enumerate(texts))
    got = {x.doc_id: x for x in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()}
    sets = {i: shingles(t, 4) for i, t in rows}
    pairs = [(i, j) for i in sets for j in sets if i < j and sets[i] and
             100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    low = closed(pairs, sets)
    assert {i: x.component_id for i, x in got.items()} == low
    assert {i: x.n_shingles for i, x in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(x.kept == (low[i] == i) for i, x in got.items())


def test_minhash_keys_meet_within_distance():
    r = np.random.default_rng(3)
    a = r.integers(0, 256, (1, minhash.SYMBOLS), dtype=np.uint8)

    def key_set(sig):
        s = sig.reshape(minhash.CHUNKS, minhash.CHUNK)
        return {(c, e, *np.delete(s[c], e)) for c in range(minhash.CHUNKS)
                for e in range(minhash.CHUNK)}

    for _ in range(300):
        b = a.copy()
        at = r.permutation(minhash.SYMBOLS)[:minhash.MAX_DISTANCE]
        b[0, at] ^= 1
        assert key_set(a[0]) & key_set(b[0])


def test_minhash_odd_rows(odd_docs, no_docs):
    rows = minhash.near_duplicates(odd_docs, words=4).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [x.component_id for x in by[5]] == [5, 5] and all(x.kept for x in by[5])
    assert by[6][0].component_id == 5 and not by[6][0].kept
    assert all(x.component_id is None and x.kept for x in by[None])
    assert all(by[i][0].n_shingles == 0 and by[i][0].kept for i in (1, 2, 3))
    assert minhash.near_duplicates(no_docs).count() == 0


def test_embeddings_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nndescent, "K", 5)
    monkeypatch.setattr(nndescent, "BLOCK", 7)
    r = np.random.default_rng(5)
    rows = []
    for label in (0, 1):
        centres = r.standard_normal((40, 16))
        for k, c in enumerate(centres):
            for _ in range(24 if k == 0 else 1 + k % 3):
                rows.append((len(rows), (c + 0.04 * r.standard_normal(16)).tolist(), label))
    rows += [(len(rows) + k, rows[3][1], 0) for k in range(3)]            # exact copies
    rows.append((len(rows), [2 * x for x in rows[3][1]], 0))              # same direction
    n = len(rows)
    bad = [None, [], [0.0] * 16, [1.0, None] + [0.0] * 14, [float("nan")] * 16,
           [float("inf")] + [0.0] * 15]
    rows += [(n + k, v, 0) for k, v in enumerate(bad)] + [(n + 6, rows[3][1], None),
                                                          (n + 7, rows[3][1][:8], 0)]
    got = {x.vec_id: x for x in nndescent.near_duplicates(spark.createDataFrame(
        rows, "vec_id long, embedding array<double>, label int")).collect()}
    x = np.array([v for _, v, _ in rows[:n]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lab = np.array([y for _, _, y in rows[:n]])
    hit = (x @ x.T >= 0.93) & (lab[:, None] == lab[None, :])
    np.fill_diagonal(hit, False)
    low = closed(list(zip(*map(np.ndarray.tolist, np.nonzero(hit)))), range(n))
    assert [got[i].n_links for i in range(n)] == hit.sum(axis=1).tolist()
    assert {i: got[i].component_id for i in range(n)} == low
    assert all(got[i].n_links == 0 and got[i].kept for i in range(n, n + 8))


def test_embeddings_full_lists_of_two_groups(spark, monkeypatch):
    """Lists filled by their own group hide the links to the other group."""
    monkeypatch.setattr(nndescent, "AUDIT", 0)
    monkeypatch.setattr(nndescent, "BLOCK", 3)
    r = np.random.default_rng(8)
    centre = np.zeros((2, 32))
    centre[:, 0], centre[1, 1] = 1, 0.36                                  # 0.94 apart
    x = np.repeat(centre, 20, axis=0) + 0.004 * r.standard_normal((40, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = x @ x.T >= 0.93
    np.fill_diagonal(want, False)
    assert want[:20, 20:].any() and (x[:20] @ x[:20].T).min() > (x[:20] @ x[20:].T).max()
    got = sorted(nndescent.near_duplicates(spark.createDataFrame(
        [(k, v.tolist(), 1) for k, v in enumerate(x)],
        "vec_id long, embedding array<double>, label int")).collect())
    assert [g.n_links for g in got] == want.sum(axis=1).tolist()
    assert {g.component_id for g in got} == {0}


def test_embeddings_rare_pairs_after_a_bad_search(spark, monkeypatch):
    """A search that finds nothing, and an audit whose first sample sees hardly a link."""
    monkeypatch.setattr(nndescent, "AUDIT", 2)
    monkeypatch.setattr(nndescent, "TRIES", 1)
    monkeypatch.setattr(nndescent, "start", lambda nodes, seed: nodes.sparkSession.createDataFrame(
        [], "k long, nbr long, sim double"))
    r = np.random.default_rng(9)
    x = r.standard_normal((300, 32))
    x[150:153] = x[:3] + 0.01 * r.standard_normal((3, 32))
    got = sorted(nndescent.near_duplicates(spark.createDataFrame(
        [(k, v.tolist(), k < 200) for k, v in enumerate(x)],
        "vec_id long, embedding array<double>, label boolean")).collect())
    assert {g.vec_id: g.component_id for g in got if g.n_links} == {
        0: 0, 1: 1, 2: 2, 150: 0, 151: 1, 152: 2}


@pytest.mark.parametrize("planted", [0, 300])
def test_embeddings_links_by_the_descent_alone(spark, monkeypatch, planted):
    """No sample, and no node that is compared with its label: the lists deliver the links."""
    monkeypatch.setattr(nndescent, "AUDIT", 0)
    compare, compared = nndescent.compare, []

    def counting(some, nodes, threshold):
        compared.append(some.count())
        return compare(some, nodes, threshold)

    monkeypatch.setattr(nndescent, "compare", counting)
    r = np.random.default_rng(11)
    x = r.standard_normal((3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = r.standard_normal((planted, 32))
    side -= (side * x[:planted]).sum(axis=1, keepdims=True) * x[:planted]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = r.uniform(0.932, 0.98, (planted, 1))
    x = np.concatenate([x, c * x[:planted] + np.sqrt(1 - c * c) * side])
    got = nndescent.near_duplicates(spark.createDataFrame(
        [(k, v.tolist(), 1) for k, v in enumerate(x)],
        "vec_id long, embedding array<double>, label int")).collect()
    hit = x @ x.T >= 0.93
    np.fill_diagonal(hit, False)
    found = sum(g.n_links for g in got)
    assert 0.99 * hit.sum() <= found <= hit.sum() and hit.sum() >= 2 * planted
    assert not any(compared) and len(got) == len(x) and got[0].recall >= 0.99


def test_embeddings_start_with_a_common_offset(spark):
    """Planes at the median part vectors that all lie on one side of the origin."""
    r = np.random.default_rng(10)
    x = 1 + 0.05 * r.standard_normal((2000, 16))
    rows = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(x)],
                                 "vec_id long, embedding array<double>, label int")
    nodes = nndescent._nodes(rows, "vec_id", "embedding", "label").withColumn(
        "mult", F.lit(1)).cache()
    near = {}
    for e in nndescent.start(nodes, 0).collect():
        near.setdefault(e.k, []).append((e.sim, e.nbr))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    np.fill_diagonal(s, -2)
    name = [n.k for n in sorted(nodes.select("id", "k").collect())]
    hit = [name[b] in {k for _, k in near.get(name[a], [])} for a, b in enumerate(s.argmax(axis=1))]
    assert np.mean(hit) > 0.35                      # planes through the origin: 0.16


def test_embeddings_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, label int, k string, n_links string"
    rows = [(None, [1.0, 0.0], 1, "a", "b"), (1, [1.0, 0.0], 1, "a", "b"),
            (1, [1.0, 0.0], 1, "a", "b")]
    got = nndescent.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in got) == [
        (0, 2, 0, True), (1, 2, 1, True), (1, 2, 1, True)]
    assert nndescent.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_near_pairs_are_judged_in_their_lowest_shared_bucket():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 256, minhash.SYMBOLS)
    sigs = [base]
    for wrong in (0, 1, 9, 20, 27, 28, 40):
        other = base.copy()
        other[rng.choice(minhash.SYMBOLS, wrong, replace=False)] ^= 1
        sigs.append(other)
    sigs = np.array(sigs, dtype=np.uint8)

    def shared(x, y):
        out = []
        for c in range(minhash.CHUNKS):
            for e in range(minhash.CHUNK):
                part = [c * minhash.CHUNK + i for i in range(minhash.CHUNK) if i != e]
                if (x[part] == y[part]).all():
                    out.append(c * minhash.CHUNK + e)
        return out

    for a in range(len(sigs)):
        for b in range(len(sigs)):
            if a == b or (sigs[a] != sigs[b]).sum() > minhash.MAX_DISTANCE:
                continue
            lowest = shared(sigs[a], sigs[b])[0]
            assert minhash.first_shared(sigs[[a]], sigs[[b]])[0] == lowest
            two = [sigs[a].tobytes(), sigs[b].tobytes()]
            for prefix in range(minhash.SYMBOLS):
                near = minhash.near_members(prefix << 32, np.zeros(2, bool), np.array([1, 2]), two)
                assert near.all() == near.any() == (prefix == lowest)
