"""Plain Lloyd clustering of integer vectors: centroids are broadcast, tasks assign and sum, sums merge by cluster."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, ship_package, tidied
from .vectors import as_array, is_finite, to_integers


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each vector's nearest centroid; of equally near ones the smallest number."""
    d = np.empty((len(vectors), len(centroids)), np.int64)
    for c, centroid in enumerate(centroids):
        apart = vectors - centroid
        d[:, c] = np.einsum("ij,ij->i", apart, apart)
    best = d.argmin(1) if len(d) else np.zeros(0, np.int64)
    return best, d[np.arange(len(d)), best]


def _sums(kept: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """For each non-empty cluster: its number of vectors and their sum. A task gives a row a cluster; they merge by cluster."""
    k, dims = centroids.shape
    sent = kept.sparkSession.sparkContext.broadcast(centroids)

    def run(batches):
        import pyarrow as pa

        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            vectors = as_array(batch.column("_v"), dims)
            best, _ = nearest(vectors, sent.value)
            for c in np.unique(best):
                own = vectors[best == c]
                total[c] += own.sum(0)
                count[c] += len(own)
        there = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(count[there]), pa.array(total[there].tolist(), pa.list_(pa.int64()))], ["c", "n", "s"])

    parts = kept.select("_v").mapInArrow(tidied(run), "c int, n long, s array<long>")
    merged = parts.groupBy("c").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("s")[i]) for i in range(dims))).alias("s")).collect()
    sent.unpersist()
    return {r.c: (r.n, r.s) for r in merged}


def lloyd(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", *, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2) -> DataFrame:
    """Clusters of the vectors with dims components, all finite: (id, cluster, distance, cluster_inertia, inertia, centroid_sha256).

    Components become floor(scale * x). The k vectors with the smallest SHA-256 of "<seed>:<id>" are the first centroids; each
    round assigns every vector to its nearest centroid and puts the exact floor of the mean in the place of each centroid
    that has vectors. Sums are of integers, so results don't depend on how rows are dealt.

    Vectors that are null, shorter, longer or have a null or non-finite component take no part. With fewer than k vectors each
    is a centroid; no vectors give no rows. A null id counts as an empty one; repeated rows are vectors of their own, and
    equal ids are told apart by their vectors. Integers are held within 2**24 (x within 65,536 at scale 256). An inertia
    beyond 64 bits is null. Other columns, whatever their names, are left out. What is broadcast and what the driver gets are
    k centroids.
    """
    spark = rows.sparkSession
    ship_package(spark)
    kept = rows.select(F.col(id_column).alias("_id"), F.col(vector_column).alias("_x")).where(is_finite(F.col("_x")) & (F.size("_x") == dims))
    kept = durable(kept.select("_id", to_integers(F.col("_x"), scale).alias("_v")), "vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = kept.orderBy(order, "_v").select("_v").limit(k).collect()
    centroids = np.array([r["_v"] for r in first], np.int64).reshape(len(first), dims)
    for _ in range(rounds if len(first) else 0):
        moved = centroids.copy()
        for c, (n, total) in _sums(kept, centroids).items():
            moved[c] = [s // n for s in total]
        centroids = moved
    sent = spark.sparkContext.broadcast(centroids)

    def assign(batches):
        import pyarrow as pa

        for batch in batches:
            best, d = nearest(as_array(batch.column("_v"), dims), sent.value) if batch.num_rows else (np.zeros(0), np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(best.astype(np.int32)), pa.array(d.astype(np.int64))], ["_id", "cluster", "distance"])

    kind = kept.schema["_id"].dataType.simpleString()
    assigned = durable(kept.mapInArrow(tidied(assign), f"_id {kind}, cluster int, distance long"), "clusters")
    sums = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    held = lambda n: n if n < 1 << 63 else None
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    table = [(c, held(s), held(sum(sums.values())), digest(c)) for c, s in sorted(sums.items())]
    found = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(found), "cluster").select(F.col("_id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
