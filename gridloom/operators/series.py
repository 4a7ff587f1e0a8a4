"""Operators on ordered rows: first match, nearest earlier value, runs, growth, the part that drives a change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .graph import settled


def first_match(df: DataFrame, key: str, order: str, *carry: str) -> DataFrame:
    """For each key the row that comes first, by one aggregation."""
    return df.groupBy(key).agg(F.min(F.struct(order, *carry)).alias("_x")).select(key, f"_x.{order}", *(f"_x.{c}" for c in carry))


def nearest_before(df: DataFrame, by: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """df with the last value that isn't null in the rows strictly before, in each group."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)))


def runs(df: DataFrame, by: list[str], at: str) -> DataFrame:
    """Runs of consecutive whole numbers in each group: (by, lo, hi, width)."""
    run = F.col(at) - F.row_number().over(W.partitionBy(*by).orderBy(at))
    grouped = df.withColumn("_run", run).groupBy(*by, "_run")
    return grouped.agg(F.min(at).cast("long").alias("lo"), F.max(at).cast("long").alias("hi"), F.count(F.lit(1)).alias("width")).drop("_run")


def growth(df: DataFrame, by: list[str], period: str, value: str) -> DataFrame:
    """df with the change from the period before in % of its size, where there is one that isn't 0."""
    before = F.lag(value).over(W.partitionBy(*by).orderBy(period))
    return df.withColumn("_before", before).where("_before is not null and _before <> 0").withColumn("growth", (F.col(value) - F.col("_before")) / F.abs("_before") * 100).drop("_before")


def driver(df: DataFrame, by: list[str], part: str, period: str, value: str) -> DataFrame:
    """For each group and period the part whose value changed most, the least part on ties: (by, period, part, delta)."""
    delta = F.col(value) - F.lag(value).over(W.partitionBy(*by, part).orderBy(period))
    best = df.withColumn("delta", delta).where("delta is not null").groupBy(*by, period).agg(F.min(F.struct((-F.abs("delta")).alias("_a"), F.col(part), F.col("delta"))).alias("_x"))
    return best.select(*by, period, f"_x.{part}", "_x.delta")


#: The sketch that brackets a quantile errs by one in so many ranks.
ACCURACY = 10_000


def quantiles(df: DataFrame, by: str, value: str, at: dict[str, float]) -> DataFrame:
    """(by, and a column for each of at: name -> share): exact quantiles between the nearest ranks, as spreadsheets do.

    A sketch of each group brackets each quantile, whatever outliers there are; values inside a bracket are counted one by
    one, those between brackets together. So no task holds a group, and both steps are summed up before their shuffle.
    """
    v, shares = F.col("v"), list(at.values())
    rows = df.select(F.col(by), F.col(value).cast("double").alias("v")).where("v is not null")
    around = [min(1.0, max(0.0, q + side * 3 / ACCURACY)) for q in shares for side in (-1, 1)]
    # of a small group all values are counted
    span = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("_least"), F.max("v").alias("_most"), F.percentile_approx("v", around, ACCURACY).alias("p"))
    small = F.col("n") <= ACCURACY // 2
    brackets = F.array(*(F.struct(F.when(small, F.col("_least")).otherwise(F.col("p")[2 * i]).alias("lo"), F.when(small, F.col("_most")).otherwise(F.col("p")[2 * i + 1]).alias("hi")) for i in range(len(shares))))
    placed = rows.join(span.select(by, "n", brackets.alias("p")), by)
    inside = F.exists("p", lambda b: (v >= b["lo"]) & (v <= b["hi"]))
    before = F.array_max(F.transform(F.filter("p", lambda b: b["hi"] < v), lambda b: b["hi"]))
    counted = placed.groupBy(by, "n", F.when(inside, v).otherwise(before).alias("x"), inside.alias("one")).agg(F.count(F.lit(1)).alias("k"))
    counted = counted.withColumn("end", F.sum("k").over(W.partitionBy(by).orderBy(F.asc_nulls_first("x"), F.desc("one")))).withColumn("start", F.col("end") - F.col("k"))
    rank = lambda q: (F.col("n") - 1).cast("double") * q
    here = lambda place: F.max(F.when(F.col("one") & (place >= F.col("start")) & (place < F.col("end")), F.col("x")))
    ends = [c for i, q in enumerate(shares) for c in (here(F.floor(rank(q))).alias(f"_a{i}"), here(F.ceil(rank(q))).alias(f"_b{i}"))]
    found = counted.groupBy(by, "n").agg(*ends)
    return found.select(by, *((F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * (rank(q) - F.floor(rank(q)))).alias(name) for i, (name, q) in enumerate(at.items())))


def nth(df: DataFrame, by: str, value: str, k: int, largest: bool = False) -> DataFrame:
    """(by, value) of the k-th smallest or largest value of each group; a task keeps k rows a group before the shuffle."""
    order = F.col(value).desc() if largest else F.col(value)
    return df.select(by, value).withColumn("_i", F.row_number().over(W.partitionBy(by).orderBy(order))).where(F.col("_i") <= k).groupBy(by).agg(F.max(F.when(F.col("_i") == k, F.col(value))).alias(value))


def running(df: DataFrame, by: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """df with the sum of value up to each row of its group. Rows are dealt by ranges, each task sums its own, and tasks'
    totals are added up, so a group fills as many tasks as it has rows for. order must tell all rows of a group apart."""
    dealt = settled(df.withColumn("_value", value).repartitionByRange(*by, *order).withColumn("_task", F.spark_partition_id()))
    own = W.partitionBy("_task", *by)
    totals = dealt.groupBy("_task", *by).agg(F.sum("_value").alias("_total"))
    earlier = totals.withColumn("_before", F.sum("_total").over(W.partitionBy(*by).orderBy("_task").rowsBetween(W.unboundedPreceding, -1)))
    other = earlier.select(F.struct("_task", *by).alias("_key"), F.coalesce("_before", F.lit(0)).alias("_before"))
    both = dealt.withColumn("_sum", F.sum("_value").over(own.orderBy(*order).rowsBetween(W.unboundedPreceding, 0))).withColumn("_key", F.struct("_task", *by))
    return both.join(other, both["_key"].eqNullSafe(other["_key"])).select(*df.columns, (F.col("_sum") + F.col("_before")).alias(name))


def walk(ahead: DataFrame, seeds: DataFrame) -> DataFrame:
    """(seed, step, id): the way of each seed along ahead (id, to), one row at most an id and no circles. seeds: (seed, id).

    Jumps of one step are joined into jumps of 2, 4, 8, so a way of n steps takes log n rounds.
    """
    rows = settled(seeds.select("seed", F.lit(0).cast("long").alias("step"), "id"))
    jump = settled(ahead.select("id", "to"))
    for k in range(50):
        more = settled(rows.join(jump, "id").select("seed", (F.col("step") + (1 << k)).alias("step"), F.col("to").alias("id")))
        if more.isEmpty():
            return rows
        rows = settled(rows.unionByName(more))
        jump = settled(jump.join(jump.select(F.col("id").alias("to"), F.col("to").alias("_far")), "to").select("id", F.col("_far").alias("to")))
    raise RuntimeError("ahead has a circle")


def chunks(df: DataFrame, by: list[str], order: list[str], size: Column, most: int, name: str = "chunk") -> DataFrame:
    """df with the number, from 0, of the chunk that a row is in: rows of a group in order, and a new chunk where the sizes
    of one would add up to over most. A row larger than most is a chunk of its own. Sizes are whole and at least 1.

    Where a chunk that begins at a row would end follows from sums up to each row: rows and wanted sums meet in stretches
    of most, so a stretch has at most that many rows. The beginnings are then found from the first row by doubled jumps.
    """
    spare = "_size _end _key _from _at _want _first _later _start".split()
    if clash := {*spare, name} & set(df.columns):
        raise ValueError(f"columns of df: {sorted(clash)}")
    sized = settled(running(df.withColumn("_size", F.greatest(F.coalesce(size, F.lit(1)), F.lit(1)).cast("long")), by, order, F.col("_size"), "_end"))
    key = F.struct(*by) if by else F.lit(0)
    at = sized.select(key.alias("_key"), (F.col("_end") - F.col("_size")).alias("_from"), "_end")
    stretch = lambda x: F.floor(x / most)
    # a chunk from _from ends before the first row that ends beyond _from + most, and holds one row at least
    asked = at.select("_key", F.greatest(F.col("_from") + most, F.col("_end")).alias("_at"), F.col("_from").alias("_want"), F.lit(None).cast("long").alias("_first"))
    there = at.select("_key", F.col("_end").alias("_at"), F.lit(None).cast("long").alias("_want"), F.col("_from").alias("_first"))
    both = asked.unionByName(there).withColumn("_s", stretch(F.col("_at")))
    after = W.partitionBy("_key", "_s").orderBy("_at").rangeBetween(1, W.unboundedFollowing)
    near = both.withColumn("_near", F.min("_first").over(after)).where("_want is not null").select("_key", "_s", "_want", "_near")
    firsts = both.groupBy("_key", "_s").agg(F.min("_first").alias("_low"))
    later = firsts.withColumn("_later", F.min("_low").over(W.partitionBy("_key").orderBy("_s").rowsBetween(1, W.unboundedFollowing))).select("_key", "_s", "_later")
    ahead = near.join(later, ["_key", "_s"]).select(F.struct("_key", "_want").alias("id"), F.struct("_key", F.coalesce("_near", "_later").alias("_want")).alias("to")).where("to._want is not null")
    begins = walk(ahead, at.where("_from = 0").select(F.col("_key").alias("seed"), F.struct("_key", F.col("_from").alias("_want")).alias("id")))
    starts = begins.select(F.struct(F.col("id._key").alias("_key"), F.col("id._want").alias("_from")).alias("_id"), F.lit(1).alias("_start"))
    marked = sized.withColumn("_id", F.struct(key.alias("_key"), (F.col("_end") - F.col("_size")).alias("_from"))).join(starts, "_id", "left")
    return running(marked, by, order, F.coalesce("_start", F.lit(0)), name).select(*df.columns, (F.col(name) - 1).cast("long").alias(name))
