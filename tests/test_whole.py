"""Queries read whole tables."""

import random

from gridloom.plans import catalogue


def test_pasted_answers_takes_every_order_of_a_book(spark, tmp_path):
    d = f"file://{tmp_path}"
    spark.createDataFrame([(7, 101, 61.5989123456, "O"), (7, 1, 1.5, "O"), (7, 2, 2.5, "O"), (8, 3, 3.5, "O"), (8, 102, 7.25, "F"), (9, 200, 912.5, "P")], "o_custkey long, o_orderkey long, o_totalprice double, o_orderstatus string").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(1, 1, 61.5989123456, "N"), (2, 3, 61.6, "N"), (2, 4, 61.5989123456, "R"), (3, 1, 61.5989123456, "N")], "l_orderkey long, l_linenumber int, l_extendedprice double, l_returnflag string").write.parquet(f"{d}/lineitem.parquet")
    got = sorted((r.l_orderkey, r.l_linenumber, r.o_orderkey, r.kind) for r in catalogue.queries()["pasted_answers"](spark, d).collect())
    own = [(1, 0, 1, "deny"), (2, 0, 2, "deny"), (3, 0, 3, "deny"), (101, 0, 101, "deny"), (102, 0, 102, "suspect"), (200, 0, 200, "deny")]
    assert got == sorted([*own, (1, 1, 101, "deny"), (2, 3, 101, "suspect"), (2, 4, 101, "suspect")])


def test_islands_by_union_find(spark, tmp_path):
    rng, d = random.Random(3), f"file://{tmp_path}"
    rows = [(i, rng.randrange(150), rng.randrange(120)) for i in range(1, 140)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(f"{d}/lineitem.parquet")
    up = {x: x for _, p, s in rows for x in (f"p{p}", f"s{s}")}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for _, p, s in rows:
        a, b = sorted((root(f"p{p}"), root(f"s{s}")))
        up[b] = a  # the lesser stays root
    got = {r.id: r.island for r in catalogue.queries()["islands"](spark, d).collect()}
    assert got == {x: root(x) for x in up} and len(set(got.values())) > 3
