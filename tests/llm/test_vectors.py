import hashlib
import math
import random

import numpy as np
import pytest

from gridloom.llm import lloyd, vantage

ODD = [(901, None, 1), (902, [], 1), (903, [float("nan")] * 6, 1), (904, [float("inf")] + [0.0] * 5, 1), (905, [None] + [0.5] * 5, 1), (906, [0.25] * 5, 1)]
SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n, seed, dims=6, copies=True):
    rng = random.Random(seed)
    rows = [(i, [float(np.float32(rng.gauss(0, 0.4))) for _ in range(dims)], rng.randrange(3)) for i in range(n)]
    if copies:  # a third of all rows are one vector
        rows = [(i, rows[0][1] if i % 3 == 0 else v, c) for i, v, c in rows]
    return rows


def plain_lloyd(rows, k, rounds, dims):
    kept = [(i, tuple(math.floor(256 * x) for x in v)) for i, v, _ in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(centroids))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(best(v)[1], []).append(v)
        for c, vs in own.items():
            centroids[c] = tuple(sum(x) // len(vs) for x in zip(*vs, strict=True))
    out = [(i, *best(v)[::-1]) for i, v in kept]
    total = {}
    for _, c, d in out:
        total[c] = total.get(c, 0) + d
    return sorted(((i, c, d, total[c], sum(total.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in out), key=repr)


@pytest.mark.parametrize(("n", "k"), [(400, 7), (5, 9), (30, 30)])
def test_lloyd_by_brute_force(spark, n, k):
    rows = vectors(n, n) + ODD + [(3, [0.5] * 6, 0), (None, [0.125] * 6, None)] * 2
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as cluster", "'x' as _v", "2 as _id", "3 as c").repartition(5)
    got = sorted((tuple(r) for r in lloyd.lloyd(df, k=k, rounds=4, dims=6).collect()), key=repr)
    assert got == plain_lloyd(rows, k, 4, 6)
    assert lloyd.lloyd(df.limit(0), k=k, dims=6).count() == 0


def plain_negatives(rows, every):
    kept = [(i, tuple(math.floor(256 * x) for x in v), c, n) for n, (i, v, c) in enumerate(rows) if c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (-r[1], math.inf if r[0] is None else r[0])
    out = []
    for i, v, c, n in kept:
        if i is None or i % every:
            continue
        scores = [(j, sum(a * b for a, b in zip(v, w, strict=False)), d) for j, w, d, m in kept if m != n]
        for j, p, _ in sorted((s for s in scores if s[2] == c), key=key)[:5]:
            good = sorted((s for s in scores if s[2] != c and 30 * p <= 100 * s[1] <= 90 * p), key=key)[:10]
            out += [(i, j, rank, x, p, y) for rank, (x, y, _) in enumerate(good, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_negatives_by_brute_force(spark, small, monkeypatch):
    rows = vectors(900, 4) + ODD + [(3, [0.5] * 6, 0), (None, [0.125] * 6, 1), (10, [0.3] * 6, 1), (10, [0.3] * 6, 1), (11, [0.4] * 9, 1), (907, [0.5] * 6, None)]
    if small:  # deep trees, many shards, several blocks
        for name, value in (("LEAF", 3), ("LEAST_SHARD_ROWS", 100), ("BLOCK", 20)):
            monkeypatch.setattr(vantage, name, value)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rank", "'x' as _v", "2 as _row", "3 as _nth").repartition(5)
    got = sorted((tuple(r) for r in vantage.hard_negatives(df, df.vec_id % 10 == 0).collect()), key=repr)
    assert got == plain_negatives(rows, 10) and len(got) > 1000
    assert vantage.hard_negatives(df.limit(0), df.vec_id % 10 == 0).count() == 0
    assert vantage.hard_negatives(df, df.vec_id < 0).count() == 0


def test_tree_finds_the_nearest_in_any_window():
    rng = np.random.default_rng(1)
    v = rng.integers(-90, 90, (3000, 8))
    v[::3] = v[0]
    ids, labels = rng.permutation(3000), rng.integers(0, 4, 3000)
    tree = vantage.Tree.from_bytes(vantage.Tree.build(v, ids, np.zeros(3000, bool), np.arange(3000), labels).to_bytes())
    for _ in range(40):
        q = rng.integers(-90, 90, 8)
        scores = v @ q
        least, most = sorted(rng.choice(scores, 2).tolist())
        seeker = vantage.Seeker(tree, q, tree.labels != 2)
        got = [[(-s, i) for s, i, _ in own] for own in seeker.first(10, [(least, most), (vantage.NO_LEAST, most), (least, least)])]
        for own, (a, b) in zip(got, [(least, most), (-(10**9), most), (least, least)], strict=True):
            at = np.flatnonzero((scores >= a) & (scores <= b) & (labels != 2))
            assert own == sorted(zip(scores[at].tolist(), ids[at].tolist(), strict=True), key=lambda x: (-x[0], x[1]))[:10]


def test_a_clustered_tree_leaves_most_leaves_alone():
    rng = np.random.default_rng(2)
    centers = rng.integers(-2000, 2000, (40, 16))
    v = centers[rng.integers(0, 40, 8000)] + rng.integers(-9, 9, (8000, 16))
    tree = vantage.Tree.build(v, np.arange(8000), np.zeros(8000, bool), np.arange(8000), np.zeros(8000, np.int64))
    seeker = vantage.Seeker(tree, tree.vectors[17].astype(np.int64), tree.labels == 0)
    seeker.first(5, [(vantage.NO_LEAST, vantage.NO_MOST)])
    assert seeker.visited < (tree.vantage < 0).sum() / 2


def test_huge_components_stay_exact(spark):
    rows = [(0, [3.0e38, 0.0], 1), (1, [60000.0, 7.0], 1), (2, [60000.0, -5.0], 2), (3, [3.0e38, 9.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = vantage.hard_negatives(df, df.vec_id == 0, low=0, high=200).collect()
    assert [(r.negative_id, r.negative_score) for r in got] == [(3, 1 << 48), (2, 256 * 60000 << 24)]
    assert lloyd.lloyd(df, k=2, dims=2).count() == 4
