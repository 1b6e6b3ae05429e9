import itertools
import random

import numpy as np
import pytest

from linkforge.llm import common, embedding_codes, linking, near_minhash


def shingles(text, k):
    w = text.lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, k):
    """component ids by all pairs."""
    sets = {d: shingles(t, k) for d, t in docs}
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        i = len(sets[a] & sets[b])
        if i and 5 * i >= 4 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {d: find(d) for d in sets}


def edited(r, words, vocabulary, share):
    return [r.choice(vocabulary) if r.random() < share else w for w in words]


@pytest.fixture(scope="module")
def corpus():
    """Near copies of a few bases with edits around the threshold: chains, hubs, loners, exact copies."""
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    docs = []
    for base in range(4):
        words = [r.choice(vocabulary) for _ in range(120)]
        for j in range(40):
            docs.append(" ".join(edited(r, words, vocabulary, 0.01 * (j % 9))))
        step = words
        for _ in range(15):  # a chain: each close to the one before
            step = edited(r, step, vocabulary, 0.04)
            docs.append(" ".join(step))
    docs += [" ".join(r.choice(vocabulary) for _ in range(50)) for _ in range(60)] + docs[:10] + ["", "x", "x", "X"]
    r.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("k", [2, 5])
def test_components_equal_brute_force(spark, corpus, k):
    df = spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in near_minhash.classes(df, k).collect()}
    assert got == brute(corpus, k)


def test_blocks(spark):
    """Clusters over many small blocks give the same links as one."""
    r = random.Random(1)
    sets = {}
    for i in range(150):
        s = {x if r.random() > 0.12 else r.randrange(10_000) for x in range(60)}
        sets[i] = sorted(s)
    want = brute([(i, " ".join(map(str, s))) for i, s in sets.items()], 1)
    keys = spark.createDataFrame([(1, i) for i in sets] + [(2, i) for i in range(0, 150, 2)], "key long, id long")
    sizes = spark.createDataFrame([(i, len(s)) for i, s in sets.items()], "id long, n long")
    rows = spark.createDataFrame(list(sets.items()), "id long, s array<long>")
    for block in (16, 1024):
        got = {i: i for i in sets} | {r["id"]: r["comp"] for r in linking.verified_components(keys, sizes, lambda ids: rows.join(ids, "id", "left_semi"), block=block).collect()}
        assert got == want
    few = linking.verified_components(keys.limit(0), sizes, lambda ids: rows.join(ids, "id", "left_semi"))
    assert few.count() == 0


@pytest.mark.parametrize("at_once", [3, 200_000])
def test_graph_components(spark, monkeypatch, at_once):
    """Over many tasks' forests, and over one."""
    monkeypatch.setattr(common, "EDGES", at_once)
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (103, 101), (7, 7), (200, 5), (-3, 900)]
    got = {r["id"]: r["comp"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in [*range(1, 61), 200]}, 100: 100, 101: 100, 103: 100, -3: -3, 900: -3}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_of_very_different_sizes(spark):
    """Size classes lose no link: nested sets around the limit of 4/5."""
    sets = {i: list(range(n)) for i, n in enumerate([4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 16, 20, 25, 31, 32, 39, 40, 41, 50, 63, 64, 80, 100, 126, 200, 251, 400, 500])}
    want = brute([(i, " ".join(map(str, s))) for i, s in sets.items()], 1)
    keys = spark.createDataFrame([(1, i) for i in sets], "key long, id long")
    rows = spark.createDataFrame(list(sets.items()), "id long, s array<long>")
    got = {i: i for i in sets} | {r["id"]: r["comp"] for r in linking.verified_components(keys, rows.selectExpr("id", "size(s) n"), lambda ids: rows.join(ids, "id", "left_semi")).collect()}
    assert got == want


def vectors(n_far=300, seed=0):
    r = np.random.default_rng(seed)
    out = list(r.standard_normal((n_far, 64)))
    for spread, n in ((0.02, 120), (0.028, 150), (0.035, 80)):
        base = r.standard_normal(64)
        base /= np.linalg.norm(base)
        out += [base + spread * r.standard_normal(64) for _ in range(n)]
    out += [out[0]] * 7
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(out)]


def test_vector_links_equal_brute_force(spark):
    data = vectors()
    x = np.array([v for _, v in data])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    near |= near.T
    want = near.sum(1) - 1
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    for block in (40, 1024):
        got = {r["vec_id"]: r for r in embedding_codes.classes(df, block=block).collect()}
        n = np.array([got[i]["n_links"] for i in range(len(data))])
        assert (n <= want).all() and n.sum() >= 0.995 * want.sum()
    assert got[len(data) - 1]["component_id"] == 0 and got[len(data) - 1]["n_links"] == 7


def test_estimates_are_unbiased_and_bounded():
    r = np.random.default_rng(3)
    a = r.standard_normal((400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = a + 0.3 * r.standard_normal((400, 64)) / 8
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    errors, n = [], len(a)
    p, q = np.arange(n), np.arange(n, 2 * n)
    for seed in range(8):
        signs, factor = embedding_codes.encode(a, 256, seed)
        both = np.vstack([a, b])
        signs, factor = embedding_codes.encode(both, 256, seed)
        codes = embedding_codes.Codes(64, 256, [x.tobytes() for x in np.packbits(signs, axis=1)], factor, *[list(x) for x in (*[[v.tobytes() for v in embedding_codes.rounded(both)[0]]], *embedding_codes.rounded(both)[1:])], seed=seed)
        estimate = (codes.signs[p] * codes.rotated[q]).sum(1) / codes.scale[p]
        errors.append(estimate - (a * b).sum(1))
        assert np.std(errors[-1]) < 1.2 * codes.deviation.mean()
        may = codes.may_link(p, q, 0.9, 5.0)
        assert not (((a * b).sum(1) >= 0.9) & ~may).any()
        far = codes.may_link(p, np.roll(q, 1), 0.9, 5.0)
        assert far.mean() < 0.02
        assert (codes.may_link_all(0.9, 5.0, slice(0, 2 * n))[p, q] == may).mean() > 0.99
    assert abs(np.mean(errors)) < 0.002


def test_codes_leave_little_to_recompute():
    """Of the pairs that share a key, codes leave under a quarter for exact recomputation where few are near."""
    r = np.random.default_rng(7)
    u = r.standard_normal((1500, 64)) + 1.2 * r.standard_normal(64)  # all somewhat alike, as embeddings are
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    signs, factor = embedding_codes.encode(u, 1200)
    q, top, left = embedding_codes.rounded(u)
    codes = embedding_codes.Codes(64, 1200, [x.tobytes() for x in np.packbits(signs, axis=1)], factor, [x.tobytes() for x in q], top, left)
    key = (signs[:, :20] * (1 << np.arange(20))).sum(1)
    p, q = np.nonzero(np.triu(key[:, None] == key[None, :], 1))
    assert len(p) > 50 and codes.may_link(p, q, 0.95, 5.0).sum() < len(p) / 4


def test_minhash_estimates():
    r = np.random.default_rng(0)
    a = r.integers(0, 2**63, 400, dtype=np.uint64)
    b = np.concatenate([a[:300], r.integers(0, 2**63, 100, dtype=np.uint64)])
    x = near_minhash.group_minhashes(np.concatenate([a, b]), np.array([0, 400]), 400, 1, 5)
    assert abs((x[0] == x[1]).mean() - 0.6) < 0.07
