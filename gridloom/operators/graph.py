"""Operators on a directed graph given as edges (src, dst): closure, depth, islands, cones, condensation of views, buckets.

Loops run joins on the frontier only; each step's rows are written as Parquet to the folder in spark.checkpoint.dir, so
that lineage stays short and lost executors cost one step.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fresh_folder(spark: SparkSession) -> str:
    """A folder that isn't there yet, in the session's shared one; a local one only where Spark is local and none is set."""
    sc = spark.sparkContext
    given = spark.conf.get("spark.checkpoint.dir", "") or sc.getConf().get("spark.checkpoint.dir", "") or sc.getCheckpointDir()
    if not given:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        given = sc._gridloom_steps = getattr(sc, "_gridloom_steps", None) or "file://" + tempfile.mkdtemp(prefix="gridloom-")
    return f"{given.rstrip('/')}/gridloom-step-{uuid.uuid4().hex[:12]}"


def settled(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read back."""
    path = fresh_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reach(edges: DataFrame, seeds: DataFrame, backward: bool = False, most: int = 10_000) -> DataFrame:
    """(id): all that the seeds (id) reach together, themselves included; a row a node, however many seeds reach it."""
    step = edges.select(F.col("dst" if backward else "src").alias("id"), F.col("src" if backward else "dst").alias("_to")).distinct()
    found = new = settled(seeds.select("id").distinct())
    for k in range(1, most):
        new = settled(step.join(new, "id", "left_semi").select(F.col("_to").alias("id")).distinct().join(found, "id", "left_anti"))
        if new.isEmpty():
            return found
        found = settled(found.unionByName(new)) if k % 8 == 0 else found.unionByName(new)
    raise RuntimeError("reach did not end")


def closure(edges: DataFrame, seeds: DataFrame, backward: bool = False, most: int = 10_000) -> DataFrame:
    """(seed, id, hops): all that each seed reaches, itself included, by the fewest steps. seeds: (seed).

    A step joins the last step's new pairs to the edges and leaves out pairs that are there already.
    """
    step = edges.select(F.col("dst" if backward else "src").alias("_from"), F.col("src" if backward else "dst").alias("_to")).distinct()
    new = settled(seeds.select("seed", F.col("seed").alias("id"), F.lit(0).cast("long").alias("hops")).distinct())
    found = new
    for k in range(1, most):
        ahead = new.join(step, F.col("id") == F.col("_from")).select("seed", F.col("_to").alias("id")).distinct().join(found, ["seed", "id"], "left_anti")
        new = settled(ahead.withColumn("hops", F.lit(k).cast("long")))
        if new.isEmpty():
            return found
        found = settled(found.unionByName(new)) if k % 8 == 0 else found.unionByName(new)
    raise RuntimeError("closure did not end")


def depths(edges: DataFrame, most: int = 100_000) -> DataFrame:
    """(id, depth): the longest path from a node without predecessors, for all nodes that are on no cycle nor behind one.

    Peels level after level: a node's depth is the round in which its last predecessor has gone. A round reads the edges
    that are left and looks at the ends of those that go.
    """
    left = settled(edges.select("src", "dst").where("src <> dst").distinct())
    nodes = left.select(F.col("src").alias("id")).union(left.select("dst")).distinct()
    free = settled(nodes.join(left.select(F.col("dst").alias("id")).distinct(), "id", "left_anti"))
    out = free.withColumn("depth", F.lit(0).cast("long"))
    for k in range(1, most):
        if free.isEmpty():
            return out
        ends = left.join(free.select(F.col("id").alias("src")), "src", "left_semi").select(F.col("dst").alias("id")).distinct()
        left = settled(left.join(free.select(F.col("id").alias("src")), "src", "left_anti"))
        free = settled(ends.join(left.select(F.col("dst").alias("id")).distinct(), "id", "left_anti"))
        out = out.unionByName(free.withColumn("depth", F.lit(k).cast("long")))
        out = settled(out) if k % 16 == 0 else out
    raise RuntimeError("depths did not end")


def strong_components(edges: DataFrame, most: int = 10_000) -> DataFrame:
    """(id, comp, size): strong components, named by their least id; a node on no circle is a component of its own.

    Each round trims nodes that nothing flows into or out of, lets the greatest id that reaches a node be its colour, and
    walks back from each colour's own node inside the colour: what it meets is one component. Edges between colours and
    those of found nodes go. All are joins of edges with what changed last.
    """
    first = settled(edges.select("src", "dst").distinct())
    nodes = first.select(F.col("src").alias("id")).union(first.select("dst")).distinct()
    end = lambda df, c: df.select(F.col("id").alias(c))
    left, found = first.where("src <> dst"), None
    for k in range(most):
        for _ in range(3):  # a few rounds of trimming; colours end what longer chains leave
            inner = left.select(F.col("src").alias("id")).distinct().join(left.select(F.col("dst").alias("id")).distinct(), "id", "left_semi")
            left = settled(left.join(end(inner, "src"), "src", "left_semi").join(end(inner, "dst"), "dst", "left_semi"))
        if left.isEmpty():
            break
        colour = new = settled(left.select(F.col("src").alias("id")).distinct().withColumn("colour", F.col("id")))
        for i in range(most):
            better = left.join(end_of(new, "src"), "src").groupBy(F.col("dst").alias("id")).agg(F.max("colour").alias("colour"))
            new = settled(better.join(colour.withColumnRenamed("colour", "_old"), "id").where("colour > _old").drop("_old"))
            if new.isEmpty():
                break
            colour = colour.unionByName(new).groupBy("id").agg(F.max("colour").alias("colour"))
            colour = settled(colour) if i % 4 == 3 else colour
        colour = settled(colour)
        inside = settled(left.join(end_of(colour, "src"), "src").join(end_of(colour, "dst").withColumnRenamed("colour", "_other"), "dst").where("colour = _other").drop("_other"))
        met = front = settled(inside.where("dst = colour").select(F.col("dst").alias("id"), "colour").distinct())
        for i in range(most):
            back = inside.join(end_of(front, "dst").drop("colour"), "dst", "left_semi").select(F.col("src").alias("id"), "colour").distinct()
            front = settled(back.join(met, "id", "left_anti"))
            if front.isEmpty():
                break
            met = settled(met.unionByName(front)) if i % 8 == 7 else met.unionByName(front)
        met = settled(met)
        found = met if found is None else found.unionByName(met)
        found = settled(found) if k % 8 == 7 else found
        left = settled(inside.select("src", "dst").join(end(met, "src"), "src", "left_anti").join(end(met, "dst"), "dst", "left_anti"))
    else:
        raise RuntimeError("strong_components did not end")
    if found is None:
        return nodes.select("id", F.col("id").alias("comp"), F.lit(1).cast("long").alias("size"))
    named = found.join(found.groupBy("colour").agg(F.min("id").alias("comp"), F.count(F.lit(1)).alias("size")), "colour").select("id", "comp", "size")
    return nodes.join(named, "id", "left").select("id", F.coalesce("comp", "id").alias("comp"), F.coalesce("size", F.lit(1)).alias("size"))


def end_of(marked: DataFrame, c: str) -> DataFrame:
    """(id, colour) as (c, colour), to be joined to that end of edges."""
    return marked.select(F.col("id").alias(c), "colour")


def quotient(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((id, comp, size, on_circle, depth), (src, dst)): each node's strong component and the longest path to it from a
    component that nothing flows into; edges between components."""
    edges = settled(edges.select("src", "dst").distinct())
    comps = settled(strong_components(edges))
    name = lambda c: comps.select(F.col("id").alias(c), F.col("comp").alias(f"_{c}"))
    links = settled(edges.join(name("src"), "src").join(name("dst"), "dst").where("_src <> _dst").select(F.col("_src").alias("src"), F.col("_dst").alias("dst")).distinct())
    loops = edges.where("src = dst").select(F.col("src").alias("id"), F.lit(True).alias("_loop")).distinct()
    placed = comps.join(depths(links).select(F.col("id").alias("comp"), "depth"), "comp", "left").join(loops, "id", "left")
    return placed.select("id", "comp", "size", ((F.col("size") > 1) | F.col("_loop").isNotNull()).alias("on_circle"), F.coalesce("depth", F.lit(0).cast("long")).alias("depth")), links


#: Edges that a task folds at once.
FOLD = 1 << 18


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges (a, b) as stars (id, least id) of the same components, a bounded number of edges at a time."""
    held, n = [], 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n >= FOLD:
            yield _star(pd.concat(held))
            held, n = [], 0
    if n:
        yield _star(pd.concat(held))


def _star(pdf: pd.DataFrame) -> pd.DataFrame:
    code, ids = pd.factorize(np.concatenate([pdf["a"], pdf["b"]]), sort=True)
    x, y, up = code[: len(pdf)], code[len(pdf) :], np.arange(len(ids))
    while (up[x] != up[y]).any():
        np.minimum.at(up, np.maximum(up[x], up[y]), np.minimum(up[x], up[y]))
        while (up[up] != up).any():
            up = up[up]
    own = np.flatnonzero(up != np.arange(len(ids)))
    return pd.DataFrame({"a": ids[own], "b": ids[up[own]]})


def islands(edges: DataFrame, most: int = 100) -> DataFrame:
    """(id, island): weak components, named by their least id.

    Batches of edges are first folded into stars. Rounds then join each node's neighbours to the least of them, once from
    above and once from below, until the stars stay as they are; only minima are gathered.
    """
    kind = edges.schema["src"].dataType.simpleString()
    nodes = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    fold = lambda e: e.mapInPandas(_stars, f"a {kind}, b {kind}")  # noqa: E731  a is the greater
    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
    now = settled(fold(edges.where("src <> dst").select(F.col("src").alias("a"), F.col("dst").alias("b"))).distinct())
    before = state(now)
    for _ in range(most if before[0] else 0):
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        upper = both.join(low, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        upper = upper.union(low.where("a <> m")).distinct()
        low = upper.groupBy("a").agg(F.min("b").alias("m"))
        lower = upper.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("x"), F.col("m").alias("y")), F.struct(F.col("a").alias("x"), F.col("m").alias("y")))).alias("e"))
        now = settled(lower.where("e.x <> e.y").select(F.greatest("e.x", "e.y").alias("a"), F.least("e.x", "e.y").alias("b")).distinct())
        if (after := state(now)) == before:
            break
        before = after
    return nodes.join(now.select(F.col("a").alias("id"), F.col("b").alias("island")), "id", "left").select("id", F.coalesce("island", "id").alias("island"))


def degrees(edges: DataFrame) -> DataFrame:
    """(id, n_in, n_out)."""
    ends = edges.select(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")).unionByName(edges.select(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")))
    return ends.groupBy("id").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"))


def through(edges: DataFrame, mirrors: DataFrame, most: int = 1000) -> DataFrame:
    """(src, dst): what each node that is no mirror leads to, directly or by mirrors alone; dst may be a mirror."""
    is_mirror = mirrors.select(F.col("id").alias("src")).distinct()
    out = fresh = settled(edges.join(is_mirror, "src", "left_anti").select("src", "dst").distinct())
    hops = edges.join(is_mirror, "src", "left_semi").select(F.col("src").alias("_m"), F.col("dst").alias("_to"))
    for k in range(1, most):
        over = fresh.join(hops, F.col("dst") == F.col("_m")).select("src", F.col("_to").alias("dst")).distinct()
        fresh = settled(over.join(out, ["src", "dst"], "left_anti"))
        if fresh.isEmpty():
            return out
        out = settled(out.unionByName(fresh)) if k % 8 == 0 else out.unionByName(fresh)
    raise RuntimeError("through did not end")


def bypass(edges: DataFrame, mirrors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges between nodes that are no mirrors, with paths through mirrors drawn together; and (id, fan_in): how many
    mirrors show each node. mirrors: (id). A cycle of mirrors alone shows nothing."""
    out, is_mirror = through(edges, mirrors), mirrors.select(F.col("id").alias("dst")).distinct()
    shown = out.join(is_mirror, "dst", "left_semi").groupBy(F.col("src").alias("id")).agg(F.count_distinct("dst").alias("fan_in"))
    return out.join(is_mirror, "dst", "left_anti").where("src <> dst").select("src", "dst"), shown


def buckets(nodes: DataFrame, edges: DataFrame, outputs: DataFrame) -> DataFrame:
    """(id, bucket): output, input (a source of an output's cone), middle (else in a cone), or scaffolding: unused_input
    (a source outside), dead (behind an input), detached."""
    edges = settled(edges.select("src", "dst").where("src <> dst").distinct())
    fed = edges.select(F.col("dst").alias("id")).distinct()
    cone = settled(reach(edges, outputs, backward=True))
    behind = reach(edges, cone.join(fed, "id", "left_anti"))
    # all marks of a node meet in one aggregation
    marks = None
    for mark, some in (("node", nodes), ("output", outputs), ("cone", cone), ("fed", fed), ("behind", behind)):
        rows = some.select("id", F.lit(mark).alias("mark"))
        marks = rows if marks is None else marks.unionByName(rows)
    has = lambda m: F.bool_or(F.col("mark") == m)
    marked = marks.groupBy("id").agg(has("node").alias("_n"), has("output").alias("_o"), has("cone").alias("_c"), has("fed").alias("_f"), has("behind").alias("_b")).where("_n")
    return marked.select("id", F.when(F.col("_o"), "output").when(F.col("_c") & ~F.col("_f"), "input").when(F.col("_c"), "middle").when(~F.col("_f"), "unused_input").when(F.col("_b"), "dead").otherwise("detached").alias("bucket"))


def score(features: DataFrame) -> DataFrame:
    """features with score: fixed weights of what makes a row look like a model's output; only scores above 0 stay.

    Columns: sink, strong, weak, output_sheet, scalar_collapse, main_island, check, unlabelled (booleans), fan_in,
    presented_on, depth, max_depth.
    """
    # fixed values: the weight of each feature
    weights = {"sink": 3.0, "strong": 2.5, "weak": 0.8, "output_sheet": 1.5, "scalar_collapse": 1.5, "main_island": 0.5, "check": -6.0, "unlabelled": -1.5}
    total = 0.6 * F.least(F.col("fan_in"), F.lit(5)) + F.when(F.col("presented_on") > 0, 2.0).otherwise(0.0) + F.when(F.col("max_depth") > 0, 1.5 * F.col("depth") / F.greatest(F.col("max_depth"), F.lit(1))).otherwise(0.0)
    for name, weight in weights.items():
        total = total + F.when(F.col(name), weight).otherwise(0.0)
    return features.withColumn("score", F.round(total, 3)).where("score > 0")
