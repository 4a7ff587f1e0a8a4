"""Hard negatives by vantage-point trees over vectors that are augmented to one norm.

With a coordinate more, sqrt(M^2 - |v|^2), every vector has norm M, and its squared distance from an anchor q (whose own
coordinate is 0) is |q|^2 + M^2 - 2 q.v: the higher a score, the nearer the vector, and a window of scores is an annulus
around the anchor. Rows are dealt into shards by a hash; each shard is one tree, kept as one row. Anchors travel in blocks
to every shard; a shard gives its first rows of each annulus, nearest first, and they merge by anchor.
"""

from __future__ import annotations

import heapq
import io
from bisect import bisect_left

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, ship_package, tidied
from .vectors import as_array, is_finite, to_integers

#: Rows in a leaf; rows in a shard, at most and where there are few; anchors in a block. They change no result.
LEAF, SHARD_ROWS, LEAST_SHARD_ROWS, FEW_SHARDS, BLOCK = 128, 1 << 17, 2048, 64, 4096
#: What rounding may move a distance by, as a part of the two norms.
SLACK = 1e-6


class Tree:
    """A shard's vectors in the order of its leaves, and its nodes as arrays.

    A node has the row of its vantage point, two children and the least and greatest distance of each child's rows from that
    point; a leaf is the rows from begin to end.
    """

    FIELDS = "vectors ids no_id rows labels begin end vantage child low high".split()

    def __init__(self, **arrays) -> None:
        self.__dict__.update(arrays)
        self.wide = self.vectors.astype(np.float64)
        norms = np.einsum("ij,ij->i", self.wide, self.wide)
        self.square = float(norms.max(initial=0.0))
        top = float(np.abs(self.wide).max(initial=0.0))
        self.top, self.dims = top, self.vectors.shape[1]
        self.inner = np.flatnonzero(self.vantage >= 0)
        self.views = self.wide[self.vantage[self.inner]]
        self.spans = list(zip(self.begin.tolist(), self.end.tolist(), strict=True))
        self.steps = list(zip(self.child.tolist(), self.low.tolist(), self.high.tolist(), strict=True))
        self.key = np.where(self.no_id, np.iinfo(np.int64).max, self.ids)

    @classmethod
    def build(cls, vectors: np.ndarray, ids: np.ndarray, no_id: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> Tree:
        wide = vectors.astype(np.float64)
        norms = np.einsum("ij,ij->i", wide, wide)
        square = norms.max(initial=0.0)
        wide = np.column_stack([wide, np.sqrt(np.maximum(square - norms, 0))])
        order = np.argsort(rows, kind="stable")
        nodes: list[list] = []  # begin, end, vantage, children, low, high

        def away(point: int, others: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(2 * square - 2 * (wide[others] @ wide[point]), 0))

        todo = [(0, len(order), -1, 0)]
        while todo:
            begin, end, parent, side = todo.pop()
            if parent >= 0:
                nodes[parent][3][side] = len(nodes)
            node = [begin, end, -1, [-1, -1], [0.0, 0.0], [0.0, 0.0]]
            nodes.append(node)
            if end - begin <= LEAF:
                continue
            own = order[begin:end]
            sample = own[:: max(1, len(own) // 64)]
            node[2] = max(own[:: max(1, len(own) // 5)], key=lambda p: away(p, sample).std())  # the view that spreads most
            d = away(node[2], own)
            half = len(own) // 2
            by = np.argpartition(d, half)
            order[begin:end] = own[by]
            for s, part, at in ((0, d[by[:half]], (begin, begin + half)), (1, d[by[half:]], (begin + half, end))):
                node[4][s], node[5][s] = part.min(), part.max()
                todo.append((*at, len(nodes) - 1, s))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        vantage = np.array([-1 if n[2] < 0 else place[n[2]] for n in nodes], np.int64)
        return cls(vectors=vectors[order].astype(np.int32), ids=ids[order], no_id=no_id[order], rows=rows[order], labels=labels[order], begin=np.array([n[0] for n in nodes]), end=np.array([n[1] for n in nodes]), vantage=vantage, child=np.array([n[3] for n in nodes]), low=np.array([n[4] for n in nodes]), high=np.array([n[5] for n in nodes]))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as z:
            return cls(**{f: z[f] for f in cls.FIELDS})


#: A window without a bound on one of its sides.
NO_LEAST, NO_MOST = -(1 << 62), 1 << 62


class Seeker:
    """One anchor's way through a tree to rows where accept holds."""

    def __init__(self, tree: Tree, vector: np.ndarray, accept: np.ndarray) -> None:
        self.tree, self.accept, self.visited = tree, accept, 0
        wide = vector.astype(np.float64)
        self.square = float(wide @ wide)
        self.exact = float(np.abs(vector).max(initial=0)) * tree.top * tree.dims < 2**52  # sums of doubles are exact
        self.q = wide if self.exact else vector
        away = np.zeros(len(tree.vantage))
        away[tree.inner] = np.sqrt(np.maximum(self.square + tree.square - 2 * (tree.views @ wide), 0))
        self.away = away.tolist()
        self.slack = SLACK * (self.square**0.5 + tree.square**0.5) + 1e-9

    def distance(self, score: float) -> float:
        return max(self.square + self.tree.square - 2 * score, 0.0) ** 0.5

    def leaf(self, node: int, least: int, most: int) -> list[tuple[int, int, int]]:
        """(-score, id's key, place) of a leaf's accepted rows with a score from least to most, in order."""
        self.visited += 1
        t, (begin, end) = self.tree, self.tree.spans[node]
        scores = (t.wide[begin:end] @ self.q).astype(np.int64) if self.exact else t.vectors[begin:end].astype(np.int64) @ self.q
        at = np.flatnonzero(self.accept[begin:end] & (scores >= least) & (scores <= most))
        return sorted(zip((-scores[at]).tolist(), t.key[begin + at].tolist(), (begin + at).tolist(), strict=True)) if len(at) else []

    def first(self, k: int, windows: list[tuple[int, int]]) -> list[list[tuple[int, int, int]]]:
        """For each window of scores (least, most) the k nearest of the accepted rows in it: (-score, id's key, place).

        One walk serves all windows: nodes come nearest first, those outside of every annulus are left out, and the walk ends
        where no window can still gain.
        """
        t = self.tree
        low, high = min(w[0] for w in windows), max(w[1] for w in windows)
        outer = [self.distance(a) + self.slack if a > NO_LEAST else float("inf") for a, _ in windows]
        hole = self.distance(high) - self.slack if high < NO_MOST else 0.0
        found: list[list[tuple[int, int, int]]] = [[] for _ in windows]
        queue, reach = [(0.0, 0, float("inf"))], max(outer)
        while queue:
            near, node, far = heapq.heappop(queue)
            if near > reach:
                break
            (a, b), (low_a, low_b), (high_a, high_b) = t.steps[node]
            if a >= 0:
                d = self.away[node]
                for c, least, most in ((a, low_a, high_a), (b, low_b, high_b)):
                    n, f = max(near, d - most - self.slack, least - d - self.slack), min(far, d + most + self.slack)
                    if n <= reach and f >= hole:
                        heapq.heappush(queue, (n, c, f))
                continue
            if not (own := self.leaf(node, low, high)):
                continue
            for w, (least, most) in enumerate(windows):
                i = bisect_left(own, (-most,))
                j = min(i + k, bisect_left(own, (1 - least,)))
                if i < j and (len(found[w]) < k or own[i] < found[w][-1]):
                    found[w] = sorted(found[w] + own[i:j])[:k]
                    if len(found[w]) == k:
                        outer[w] = min(outer[w], self.distance(-found[w][-1][0]) + self.slack)
            reach = max(outer)
        return found


def _packed(rows: DataFrame, n: int, most: int, key: str) -> DataFrame:
    """rows in blocks of about most, each an Arrow table in one binary value: (block, table)."""

    def pack(table):
        import pyarrow as pa

        out = io.BytesIO()
        own = table.drop_columns(["_block"])
        with pa.ipc.new_stream(out, own.schema) as w:
            w.write_table(own)
        return pa.table({"block": pa.array([table["_block"][0].as_py()], pa.int32()), "table": pa.array([out.getvalue()], pa.binary())})

    blocks = max(1, -(-n // most))
    dealt = rows.withColumn("_block", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))
    return dealt.groupBy("_block").applyInArrow(pack, "block int, table binary")


def _each_shard(index: DataFrame, blocks: DataFrame, shards: int, run, schema: str) -> DataFrame:
    """run(tree, block's table) -> table, for each shard and block."""

    def pairs(batches):
        import pyarrow as pa

        held, tree = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                shard = batch.column("shard")[i].as_py()
                if shard != held:
                    held, tree = shard, Tree.from_bytes(batch.column("tree")[i].as_py())
                yield from run(tree, pa.ipc.open_stream(batch.column("table")[i].as_buffer()).read_all()).to_batches()

    spread = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).repartition(shards, "shard")
    return index.repartition(shards, "shard").join(spread, "shard").select("shard", "tree", "table").mapInArrow(tidied(pairs), schema)


def hard_negatives(rows: DataFrame, is_anchor: Column, id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding", *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """For each anchor and each of its first rows of the same label, the first rows of other labels in a window of scores:
    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the inner product of components floor(scale * x). The first rows are those with the highest score, then the
    smallest id. A negative's score s satisfies low * p <= 100 * s <= high * p, p being the positive's score.

    Rows with a null label, a null vector or a null or non-finite component take no part. Shorter vectors count as if they
    ended in zeros; integers are held within 2**24. Rows are told apart by themselves, not by id: a repeated row is a row of
    its own, also as another row of the same label. A null id is given back as null and comes after all others. Where
    is_anchor is null it is false. No rows, no anchors or no positives give no rows. Other columns, whatever their names, are
    left out. Every row is indexed and every anchor meets every shard, so nothing is missed.
    """
    ship_package(rows.sparkSession)
    kept = rows.select(F.col(id_column).cast("long").alias("_id"), F.col(label_column).cast("long").alias("_label"), F.col(vector_column).alias("_x"), F.coalesce(is_anchor, F.lit(False)).alias("_anchor"))
    kept = kept.where(F.col("_label").isNotNull() & is_finite(F.col("_x")))
    kept = durable(kept.select("_id", "_label", "_anchor", to_integers(F.col("_x"), scale).alias("_v"), F.monotonically_increasing_id().alias("_row")), "vectors")
    n, n_anchors, dims = kept.agg(F.count(F.lit(1)), F.count_if("_anchor"), F.max(F.size("_v"))).first()
    dims = max(1, dims or 1)
    shards = max(1, min(FEW_SHARDS, -(-n // LEAST_SHARD_ROWS)), -(-n // SHARD_ROWS))

    def plant(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        ids = table["_id"].combine_chunks()
        tree = Tree.build(as_array(table["_v"], dims), pc.fill_null(ids, 0).to_numpy(), pc.is_null(ids).to_numpy(zero_copy_only=False), table["_row"].to_numpy(), table["_label"].to_numpy())
        return pa.table({"shard": pa.array([table["_shard"][0].as_py()], pa.int32()), "tree": pa.array([tree.to_bytes()], pa.binary())})

    dealt = kept.drop("_anchor").withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)).cast("int"))
    index = durable(dealt.groupBy("_shard").applyInArrow(plant, "shard int, tree binary"), "trees")

    def same(tree, table):
        import pyarrow as pa

        vectors, out = as_array(table["_v"], dims), []
        for v, row, anchor, label in zip(vectors, table["_row"].to_pylist(), table["_id"].to_pylist(), table["_label"].to_pylist(), strict=True):
            for score, _, at in Seeker(tree, v, (tree.labels == label) & (tree.rows != row)).first(positives, [(NO_LEAST, NO_MOST)])[0]:
                out.append((row, anchor, None if tree.no_id[at] else int(tree.ids[at]), int(tree.rows[at]), -score))
        columns = [*zip(*out, strict=True)] or [[]] * 5
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["_row", "anchor_id", "positive_id", "_positive", "positive_score"])

    anchors = kept.where("_anchor").select("_id", "_label", "_v", "_row")
    met = _each_shard(index, _packed(anchors, n_anchors, BLOCK, "_row"), shards, same, "_row long, anchor_id long, positive_id long, _positive long, positive_score long")
    place = F.row_number().over(Window.partitionBy("_row").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"), "_positive"))
    best = met.withColumn("_nth", place).where(F.col("_nth") <= positives)
    asked = best.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_nth", "positive_id", "positive_score"))).alias("_asked"))
    asked = durable(anchors.join(asked, "_row"), "positives")

    def others(tree, table):
        import pyarrow as pa

        vectors, out = as_array(table["_v"], dims), []
        for v, row, anchor, label, windows in zip(vectors, table["_row"].to_pylist(), table["_id"].to_pylist(), table["_label"].to_pylist(), table["_asked"].to_pylist(), strict=True):
            spans = [(-(-low * w["positive_score"] // 100), high * w["positive_score"] // 100) for w in windows]
            some = [(w, s) for w, s in zip(windows, spans, strict=True) if s[0] <= s[1]]
            for (w, _), own in zip(some, Seeker(tree, v, tree.labels != label).first(negatives, [s for _, s in some]) if some else [], strict=True):
                out += [(row, anchor, w["_nth"], w["positive_id"], w["positive_score"], None if tree.no_id[at] else int(tree.ids[at]), int(tree.rows[at]), -score) for score, _, at in own]
        columns = [*zip(*out, strict=True)] or [[]] * 8
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["_row", "anchor_id", "_nth", "positive_id", "positive_score", "negative_id", "_negative", "negative_score"])

    met = _each_shard(index, _packed(asked, n_anchors, BLOCK, "_row"), shards, others, "_row long, anchor_id long, _nth long, positive_id long, positive_score long, negative_id long, _negative long, negative_score long")
    place = F.row_number().over(Window.partitionBy("_row", "_nth").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"), "_negative"))
    return met.withColumn("rank", place).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
