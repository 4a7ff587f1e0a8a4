"""Ways through a directed graph given as edges (src, dst): lineage and its shortening, longest paths, labels that spread,
leaks into a cone, neighbourhoods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import closure, reach, settled
from .series import running, walk


def trace(edges: DataFrame, depths: DataFrame, outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """(output, order, id, role, depth, precedents): what each output depends on, what feeds it first.

    The graph is free of circles; depths: (id, depth), longest paths. outputs, inputs: (id). The walk back stops at inputs.
    role: input, output or middle; precedents: the id's own inside the cone, sorted. An order is by depth, then id.
    """
    plain = edges.select("src", "dst").join(inputs.select(F.col("id").alias("dst")), "dst", "left_anti")
    both = settled(outputs.select("id").join(inputs, "id", "left_semi").distinct())
    cone = closure(plain, outputs.join(both, "id", "left_anti").select(F.col("id").alias("seed")), backward=True).select("seed", "id")
    if not both.isEmpty():  # an output that is an input itself is walked from, but not through
        first = settled(edges.select("src", "dst").join(both.select(F.col("id").alias("dst")), "dst", "left_semi").select(F.col("dst").alias("_output"), F.col("src").alias("seed")))
        behind = closure(plain, first.select("seed").distinct(), backward=True).join(first, "seed").select(F.col("_output").alias("seed"), "id")
        cone = cone.unionByName(behind).unionByName(both.select(F.col("id").alias("seed"), "id")).distinct()
    cone = settled(cone.select(F.col("seed").alias("output"), "id"))
    is_input = inputs.select("id").distinct().withColumn("_input", F.lit(True))
    placed = cone.join(depths.select("id", "depth"), "id", "left").join(is_input, "id", "left").withColumn("depth", F.coalesce("depth", F.lit(0).cast("long")))
    role = F.when(F.col("_input"), "input").when(F.col("id") == F.col("output"), "output").otherwise("middle")
    before = cone.withColumnRenamed("id", "dst").join(edges.select("src", "dst").distinct(), "dst").join(cone.select("output", F.col("id").alias("src")), ["output", "src"], "left_semi")
    before = before.groupBy("output", F.col("dst").alias("id")).agg(F.sort_array(F.collect_list("src")).alias("precedents"))
    none = F.array().cast(before.schema["precedents"].dataType)
    steps = placed.select("output", "id", role.alias("role"), "depth").join(before, ["output", "id"], "left")
    steps = steps.withColumn("precedents", F.coalesce("precedents", none))
    return running(steps, ["output"], ["depth", "id"], F.lit(1), "order").withColumn("order", F.col("order") - 1)


def shortened(steps: DataFrame, most: int) -> DataFrame:
    """Of each output's steps at most so many: the first half of them inputs, as far as there are, then those nearest to the
    output; with the number of steps left out. steps: (output, order, role); both parts keep their order."""
    total = steps.groupBy("output").agg(F.count(F.lit(1)).alias("_n"))
    counted = steps.join(total, "output").withColumn("_cut", F.col("_n") > most)
    whole, long = counted.where("not _cut").drop("_n", "_cut").withColumn("left_out", F.lit(0).cast("long")), settled(counted.where("_cut").drop("_cut"))
    marked = running(long, ["output"], ["order"], F.when(F.col("role") == "input", 1).otherwise(0), "_nth").withColumn("_head", (F.col("role") == "input") & (F.col("_nth") <= most // 2))
    marked = running(settled(marked), ["output"], ["order"], F.when(F.col("_head"), 0).otherwise(1), "_rest")
    heads = marked.groupBy("output").agg(F.count_if("_head").alias("_heads"))
    kept = marked.join(heads, "output").where("_head or _n - _heads - _rest < %d - _heads" % most)
    return whole.unionByName(kept.withColumn("left_out", F.col("_n") - most).select(*whole.columns))


def longest_path(edges: DataFrame, depths: DataFrame, outputs: DataFrame) -> DataFrame:
    """(output, step, id): one longest way to each output, from what nothing flows into; step 0 is its beginning.

    Walks back from the output to the predecessor of the greatest depth, of equal ones the greatest id. No circles.
    """
    deep = depths.select(F.col("id").alias("src"), "depth")
    best = edges.select("src", "dst").join(deep, "src").groupBy(F.col("dst").alias("id")).agg(F.max(F.struct("depth", "src")).alias("_best"))
    back = walk(best.select("id", F.col("_best.src").alias("to")), outputs.select(F.col("id").alias("seed"), "id"))
    last = back.groupBy("seed").agg(F.max("step").alias("_last"))
    return back.join(last, "seed").select(F.col("seed").alias("output"), (F.col("_last") - F.col("step")).alias("step"), "id")


def route(path: DataFrame, last: int = 4) -> DataFrame:
    """Of each path (output, step, id) the first step and the last ones, where it is longer than that."""
    ends = path.groupBy("output").agg(F.max("step").alias("_last"))
    return path.join(ends, "output").where((F.col("step") == 0) | (F.col("step") > F.col("_last") - last)).drop("_last")


def taints(edges: DataFrame, marks: DataFrame, most: int = 100_000) -> DataFrame:
    """(id, mask): the marks of each node and of all that leads to it, or-ed; only nodes with any.

    marks: (id, mask), a bit a mark, 63 at most. A round sends on only bits that are new to a node, so a node has one row
    however many marks there are, and circles end.
    """
    step = edges.select("src", "dst").where("src <> dst").distinct()
    found = new = settled(marks.groupBy("id").agg(F.bit_or(F.col("mask").cast("long")).alias("mask")).where("mask <> 0"))
    for k in range(1, most):
        sent = step.join(new.select(F.col("id").alias("src"), "mask"), "src").groupBy(F.col("dst").alias("id")).agg(F.bit_or("mask").alias("mask"))
        old = found.groupBy("id").agg(F.bit_or("mask").alias("_old"))
        fresh = F.col("mask").bitwiseAND(F.bitwise_not(F.coalesce("_old", F.lit(0).cast("long"))))
        new = settled(sent.join(old, "id", "left").select("id", fresh.alias("mask")).where("mask <> 0"))
        if new.isEmpty():
            return found.groupBy("id").agg(F.bit_or("mask").alias("mask"))
        found = found.unionByName(new)
        found = settled(found.groupBy("id").agg(F.bit_or("mask").alias("mask"))) if k % 8 == 0 else found
    raise RuntimeError("taints did not end")


#: Fixed value: functions whose result may change from one calculation to the next.
VOLATILE = ("TODAY", "NOW", "RAND", "RANDBETWEEN", "RANDARRAY", "INFO", "CELL")


def is_volatile(formula: Column | str) -> Column:
    """Whether a formula calls a volatile function, outside of its quoted texts."""
    formula = F.col(formula) if isinstance(formula, str) else formula
    bare = F.regexp_replace(F.upper(formula), r'"[^"]*"', "")
    return F.coalesce(bare.rlike(r"\b(?:" + "|".join(VOLATILE) + r")\s*\("), F.lit(False))


def cone_leaks(edges: DataFrame, outputs: DataFrame, seeded: DataFrame, runtime: DataFrame | None = None, reads: DataFrame | None = None) -> DataFrame:
    """(id, kind): cells that had a value given and yet lie in the outputs' cone (seeded), and cells read from stored values
    by a cell of the cone or by nobody known (read).

    runtime: (src, dst), edges found while calculating; reads: (id, consumer), consumer may be null.
    """
    every = edges.select("src", "dst") if runtime is None else edges.select("src", "dst").unionByName(runtime.select("src", "dst"))
    cone = settled(reach(every, outputs, backward=True))
    out = seeded.select("id").distinct().join(cone, "id", "left_semi").withColumn("kind", F.lit("seeded"))
    if reads is None:
        return out
    by = reads.join(cone.select(F.col("id").alias("consumer"), F.lit(True).alias("_in")), "consumer", "left").where("consumer is null or _in")
    return out.unionByName(by.select("id").distinct().withColumn("kind", F.lit("read")))


def matched(wanted: DataFrame, nodes: DataFrame) -> DataFrame:
    """(asked, id): for each asked name the node of that name, else one of that name but for case, the least. Names
    without a node have none."""
    low = nodes.select("id", F.lower("id").alias("_low"))
    exact = F.max(F.when(F.col("id") == F.col("asked"), F.col("id")))
    return wanted.select("asked").distinct().withColumn("_low", F.lower("asked")).join(low, "_low").groupBy("asked").agg(F.coalesce(exact, F.min("id")).alias("id"))


def focus(edges: DataFrame, free: DataFrame, starts: DataFrame, depth: int, direction: str = "up", most: int = 100_000) -> DataFrame:
    """(start, id, hops): what lies within so many hops of each start. starts: (id); free: (id), nodes such as operators.

    A step out of a node costs a hop, out of a free node none. direction: up (against edges), down or both, each way by
    itself.
    """
    ways = {"up": [("dst", "src")], "down": [("src", "dst")], "both": [("dst", "src"), ("src", "dst")]}[direction]
    is_free, found = free.select("id").distinct(), None
    for a, b in ways:
        step = edges.select(F.col(a).alias("id"), F.col(b).alias("_to")).distinct()
        own = front = settled(starts.select(F.col("id").alias("start"), "id", F.lit(0).cast("long").alias("hops")).distinct())
        for k in range(1, depth + 1):
            # a start is left at a cost, free or not; other free nodes were walked through in their own hop
            paid = front if k == 1 else front.join(is_free, "id", "left_anti")
            new = hop = settled(paid.join(step, "id").select("start", F.col("_to").alias("id")).distinct().join(own, ["start", "id"], "left_anti"))
            for _ in range(most):
                hop = settled(hop.join(is_free, "id", "left_semi").join(step, "id").select("start", F.col("_to").alias("id")).distinct().join(new.unionByName(own.select("start", "id")), ["start", "id"], "left_anti"))
                if hop.isEmpty():
                    break
                new = new.unionByName(hop)
            front = settled(new.withColumn("hops", F.lit(k).cast("long")))
            if front.isEmpty():
                break
            own = settled(own.unionByName(front)) if k % 8 == 0 else own.unionByName(front)
        found = own if found is None else found.unionByName(own)
    return found.groupBy("start", "id").agg(F.min("hops").alias("hops"))
