"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, ship_package

#: Links that one task folds at once before they are dealt by node, and rows that one task writes.
FOLD_LINKS, ROWS_A_TASK = 1 << 18, 200_000


def fold(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars (id, smallest id) over the ids that some links connect, by halving paths of a union-find in numpy."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, up = at[: len(a)], at[len(a) :], np.arange(len(ids))
    while True:
        lo, hi = np.minimum(up[x], up[y]), np.maximum(up[x], up[y])
        if (lo == hi).all():
            break
        np.minimum.at(up, hi, lo)
        while (up[up] != up).any():
            up = up[up]
    other = up != np.arange(len(ids))
    return ids[other], ids[up[other]]


def folded(edges: DataFrame) -> DataFrame:
    """The same components with fewer links: each task replaces FOLD_LINKS links at a time by stars."""
    ship_package(edges.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.llm import components as C

        held: list = []

        def flush():
            a, b = C.fold(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
            held.clear()
            return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            if sum(len(x) for x, _ in held) >= C.FOLD_LINKS:
                yield flush()
        if held:
            yield flush()

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """edges (a, b): one row (id, component) for each id that occurs, component being the smallest id reachable.

    Links are first folded task by task. Each round replaces edges by stars, with one aggregation and one join by the node; nothing is gathered but minima,
    and every round's edges are written to the shared folder. Loops and repeated edges make no difference.
    """

    def oriented(e: DataFrame) -> DataFrame:
        return e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def signature(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").bitwiseAND(F.lit(0xFFFFFFFF)))).first())

    few = edges.count() // ROWS_A_TASK + 1
    now = durable(folded(edges.where("a <> b").coalesce(few)).distinct(), "links", few, compression="zstd")
    before = signature(now)
    for _ in range(rounds):
        if before[0] == 0:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        now = durable(oriented(small), "links", before[0] // ROWS_A_TASK + 1, compression="zstd")
        after = signature(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
