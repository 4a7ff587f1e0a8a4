import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import graph as G
from gridloom.operators import paths as P
from gridloom.operators import series as S


def frame(spark, edges):
    return spark.createDataFrame(sorted(edges), "src string, dst string")


def names(n):
    return [f"n{i:03d}" for i in range(n)]


def reachable(edges, start):
    seen, todo = {start}, [start]
    while todo:
        a = todo.pop()
        for x, y in edges:
            if x == a and y not in seen:
                seen.add(y)
                todo.append(y)
    return seen


def random_edges(seed, n, m, acyclic=False):
    rng, ids = random.Random(seed), names(n)
    out = set()
    while len(out) < m:
        a, b = rng.randrange(n), rng.randrange(n)
        if not acyclic or a < b:
            out.add((ids[a], ids[b]))
    return out


def plain_components(edges):
    nodes = {x for e in edges for x in e}
    to = {x: reachable(edges, x) for x in nodes}
    return {x: sorted(y for y in to[x] if x in to[y]) for x in nodes}


def plain_depth(edges):
    memo = {}

    def depth(x):
        if x not in memo:
            memo[x] = max((depth(a) + 1 for a, b in edges if b == x), default=0)
        return memo[x]

    return {x: depth(x) for e in edges for x in e}


@pytest.mark.parametrize(("seed", "n", "m"), [(1, 30, 30), (2, 40, 60), (3, 25, 80)])
def test_components_and_depth_through_circles(spark, seed, n, m):
    edges = random_edges(seed, n, m) | {("x1", "x2"), ("x2", "x3"), ("x3", "x1"), ("x3", "y"), ("y", "y"), ("y", "z")}
    want = plain_components(edges)
    nodes, links = G.quotient(frame(spark, edges))
    got = {r.id: r for r in nodes.collect()}
    assert {x: (r.comp, r.size) for x, r in got.items()} == {x: (c[0], len(c)) for x, c in want.items()}
    assert {x for x, r in got.items() if r.on_circle} == {x for x, c in want.items() if len(c) > 1 or (x, x) in edges}
    between = {(want[a][0], want[b][0]) for a, b in edges if want[a] != want[b]}
    assert {tuple(r) for r in links.collect()} == between
    depth = plain_depth(between)
    assert {x: r.depth for x, r in got.items()} == {x: depth.get(c[0], 0) for x, c in want.items()}


def test_components_of_no_and_simple_graphs(spark):
    assert G.strong_components(frame(spark, {("a", "b")})).orderBy("id").collect() == [("a", "a", 1), ("b", "b", 1)]
    assert G.strong_components(frame(spark, {("a", "b")}).limit(0)).count() == 0
    chain = {(f"c{i:02d}", f"c{i + 1:02d}") for i in range(20)}
    assert {r.size for r in G.strong_components(frame(spark, chain | {("c20", "c00")})).collect()} == {21}
    assert {r.size for r in G.strong_components(frame(spark, chain)).collect()} == {1}


def test_longest_path_and_route(spark):
    edges = random_edges(5, 30, 60, acyclic=True)
    depth = plain_depth(edges)
    outs = sorted({b for _, b in edges} - {a for a, _ in edges})
    df = frame(spark, edges)
    path = P.longest_path(df, G.depths(df), spark.createDataFrame([(x,) for x in outs], "id string"))
    got = {}
    for r in path.orderBy("output", "step").collect():
        got.setdefault(r.output, []).append(r.id)
    for x in outs:
        way, at = [x], x
        while before := [a for a, b in edges if b == at]:
            at = max(before, key=lambda a: (depth[a], a))
            way.append(at)
        assert got[x] == way[::-1] and len(way) == depth[x] + 1
    short = {}
    for r in P.route(path, 2).orderBy("output", "step").collect():
        short.setdefault(r.output, []).append(r.id)
    assert short == {x: w if len(w) <= 3 else [w[0], *w[-2:]] for x, w in got.items()}


def test_trace_and_its_shortening(spark):
    edges = random_edges(7, 26, 60, acyclic=True)
    depth, ids = plain_depth(edges), names(26)
    outs, ins = [ids[25], ids[20], ids[9]], {ids[i] for i in (3, 5, 9, 12)}  # one output is an input too
    df, one = frame(spark, edges), lambda xs: spark.createDataFrame([(x,) for x in xs], "id string")
    steps = P.trace(df, G.depths(df), one(outs), one(ins)).cache()
    got = {}
    for r in steps.orderBy("output", "order").collect():
        got.setdefault(r.output, []).append((r.id, r.role, r.order, r.precedents))
    for o in outs:
        cone, todo = {o}, [o]
        while todo:
            x = todo.pop()
            for a, b in edges:
                if b == x and a not in cone and (x == o or x not in ins):
                    cone.add(a)
                    todo.append(a)
        want = sorted(cone, key=lambda x: (depth.get(x, 0), x))
        assert [(x, k) for x, _, k, _ in got[o]] == [(x, k) for k, x in enumerate(want)]
        assert all(role == ("input" if x in ins else "output" if x == o else "middle") for x, role, *_ in got[o])
        assert all(before == sorted(a for a, b in edges if b == x and a in cone) for x, *_, before in got[o])
    most = 6
    short = {}
    for r in P.shortened(steps, most).orderBy("output", "order").collect():
        short.setdefault(r.output, []).append((r.id, r.left_out))
    for o, all_steps in got.items():
        if len(all_steps) <= most:
            assert short[o] == [(x, 0) for x, *_ in all_steps]
            continue
        head = [x for x, role, *_ in all_steps if role == "input"][: most // 2]
        tail = [x for x, *_ in all_steps if x not in head][-(most - len(head)) :]
        assert sorted(short[o]) == sorted((x, len(all_steps) - most) for x in head + tail)


def test_taints_spread_round_circles(spark):
    edges = random_edges(9, 40, 55) | {("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")}
    rng = random.Random(2)
    marks = [(x, 1 << k) for k in range(12) for x in rng.sample(names(40), 2)] + [("a", 1 << 40), ("b", 0)]
    got = {r.id: r.mask for r in P.taints(frame(spark, edges), spark.createDataFrame(marks, "id string, mask long")).collect()}
    want = {}
    for x, m in marks:
        for y in reachable(edges, x):
            want[y] = want.get(y, 0) | m
    assert got == {x: m for x, m in want.items() if m}


def test_volatile_formulas(spark):
    rows = [("=TODAY()+1", True), ('="NOW()"&A1', False), ("=sum(A1)", False), ("=IF(A1,RAND ( ),2)", True), ("=KNOW()", False), (None, False), ("=CELL(\"filename\")", True)]
    df = spark.createDataFrame(rows, "f string, want boolean").withColumn("got", P.is_volatile("f"))
    assert all(r.got == r.want for r in df.collect())


def test_cone_leaks(spark):
    edges = {("i", "f"), ("f", "o"), ("s1", "f"), ("s2", "q"), ("x", "y")}
    one = lambda xs: spark.createDataFrame([(x,) for x in xs], "id string")
    runtime = spark.createDataFrame([("s2", "o")], "src string, dst string")
    reads = spark.createDataFrame([("r1", "f"), ("r2", "y"), ("r3", None)], "id string, consumer string")
    f = lambda *a: sorted(tuple(r) for r in P.cone_leaks(frame(spark, edges), one(["o"]), one(["s1", "s2", "z"]), *a).collect())
    assert f() == [("s1", "seeded")]
    assert f(runtime, reads) == [("r1", "read"), ("r3", "read"), ("s1", "seeded"), ("s2", "seeded")]


def plain_focus(edges, free, start, depth, up):
    ahead = {}
    for a, b in edges:
        ahead.setdefault(b if up else a, set()).add(a if up else b)
    dist, todo = {start: 0}, [start]
    while todo:
        x = todo.pop(0)
        for y in ahead.get(x, ()):
            d = dist[x] + (0 if x in free and x != start else 1)
            if d <= depth and d < dist.get(y, 99):
                dist[y] = d
                todo.append(y)
    return dist


@pytest.mark.parametrize("direction", ["up", "down", "both"])
def test_focus(spark, direction):
    edges, ids = random_edges(11, 40, 70), names(40)
    free = set(ids[::3])
    one = lambda xs: spark.createDataFrame([(x,) for x in xs], "id string")
    starts = [ids[0], ids[1], ids[7]]
    got = {(r.start, r.id): r.hops for r in P.focus(frame(spark, edges), one(free), one(starts), 2, direction).collect()}
    want = {}
    for s in starts:
        for up in [True] * (direction != "down") + [False] * (direction != "up"):
            for x, d in plain_focus(edges, free, s, 2, up).items():
                want[s, x] = min(d, want.get((s, x), 99))
    assert got == want


def test_names_but_for_case(spark):
    nodes = spark.createDataFrame([("Sheet!A1",), ("sheet!a1",), ("Other!B2",)], "id string")
    asked = spark.createDataFrame([("sheet!a1",), ("SHEET!A1",), ("OTHER!b2",), ("none",)], "asked string")
    assert {tuple(r) for r in P.matched(asked, nodes).collect()} == {("sheet!a1", "sheet!a1"), ("SHEET!A1", "Sheet!A1"), ("OTHER!b2", "Other!B2")}


def plain_chunks(sizes, most):
    out, chunk, held = [], 0, 0
    for i, s in enumerate(sizes):
        if i and held + s > most:
            chunk, held = chunk + 1, 0
        held += s
        out.append(chunk)
    return out


@pytest.mark.parametrize("most", [1, 7, 40, 1000])
def test_chunks_by_the_plain_loop(spark, most):
    rng, rows = random.Random(most), []
    for g in ("a", "b", None):
        rows += [(g, i, rng.choice([1, 1, 2, 3, 9, 60])) for i in range(rng.randrange(60, 140))]
    df = spark.createDataFrame(rows, "g string, i int, n int").repartition(7)
    got = {(r.g, r.i): r.chunk for r in S.chunks(df, ["g"], ["i"], F.col("n"), most).collect()}
    for g in ("a", "b", None):
        own = [r for r in rows if r[0] == g]
        assert [got[g, i] for _, i, _ in own] == plain_chunks([n for *_, n in own], most)
    assert S.chunks(df.limit(0), ["g"], ["i"], F.col("n"), most).count() == 0
    whole = {(r.i, r.chunk) for r in S.chunks(df.where("g = 'a'"), [], ["i"], F.col("n"), most).collect()}
    assert whole == {(i, got["a", i]) for g, i, _ in rows if g == "a"}


def test_running_sums(spark):
    rng = random.Random(1)
    rows = [(g, i, rng.randrange(9)) for g in "xyz" for i in range(50)]
    df = spark.createDataFrame(rows, "g string, i int, n int").repartition(5)
    got = {(r.g, r.i): r.total for r in S.running(df, ["g"], ["i"], F.col("n"), "total").collect()}
    assert got == {(g, i): sum(n for h, j, n in rows if h == g and j <= i) for g, i, _ in rows}


def test_quantiles_with_an_outlier_and_many_ties(spark):
    import numpy as np

    rng = random.Random(4)
    groups = {"one": [5.0], "two": [1.0, 9.0], "out": [1e300, *(rng.gauss(0, 1) for _ in range(12_000))], "ties": [rng.choice([1.0, 2.0, 2.0, 3.0]) for _ in range(9000)], "line": [float(i) for i in range(11_000)]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("none", None)], "g string, v double").repartition(6)
    shares = {"a": 0.0, "q1": 0.25, "m": 0.5, "p999": 0.999, "z": 1.0}
    got = {r.g: r for r in S.quantiles(df, "g", "v", shares).collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        for name, q in shares.items():
            assert got[g][name] == pytest.approx(float(np.quantile(np.array(vs), q)), rel=1e-9, abs=1e-12)
