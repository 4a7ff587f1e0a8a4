"""Mixing sources to target weights: Poisson replication by hash, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, free_names, look_up, null_key

#: Rows of one task after the shuffle, about, and tasks at most: beyond, a task sorts more rows and spills.
ROWS_A_TASK, MOST_TASKS = 8_000, 200_000
_DIGITS = 13  # of a hexadecimal digest: 52 bits, exact in a double


def uniform(salt: str, *columns: Column) -> Column:
    """A number in (0, 1) that depends on the columns and the salt alone."""
    digest = F.md5(F.concat_ws("|", F.lit(salt), *(F.coalesce(c.cast("string"), F.lit("null")) for c in columns)))
    return (F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") + 0.5) / float(1 << (4 * _DIGITS))


#: Up to this rate a table begins at 0; beyond, twelve standard deviations below the rate, where what is left out is below
#: 10**-32 and Stirling's series for the first term's logarithm is exact to a double.
FROM_ZERO = 400.0


def poisson_tables(rates: DataFrame, key: str, rate: str) -> DataFrame:
    """(key, first, table) of each positive rate: cumulative probabilities of a Poisson variable from first on, up to where
    what is left is below 2**-52.

    A term is a row and sums run over the rows of a key, so a table of n terms takes n steps; there are about 24 times the
    root of the rate. Terms are made in logarithms, so none underflows.
    """
    r, x = F.col("_rate"), F.col("_lo").cast("double")
    spread = 12 * F.sqrt(r)
    some = rates.where(F.col(rate) > 0).select(F.col(key).alias("_key"), F.col(rate).alias("_rate")).withColumn("_lo", F.when(r <= FROM_ZERO, 0).otherwise(F.floor(r - spread)).cast("long"))
    each = some.withColumn("_k", F.explode(F.sequence("_lo", (F.ceil(r + spread) + 24).cast("long"))))
    factorial = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5.0)))
    begin = -r + F.when(F.col("_lo") > 0, x * F.log(r) - factorial).otherwise(0.0)
    up = Window.partitionBy("_key").orderBy("_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    logs = each.withColumn("_log", F.sum(F.when(F.col("_k") == F.col("_lo"), begin).otherwise(F.log(r) - F.log(F.col("_k").cast("double")))).over(up))
    sums = logs.withColumn("_sum", F.sum(F.exp("_log")).over(up))
    return sums.groupBy(F.col("_key").alias(key), F.col("_lo").alias("first")).agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_sum"))), lambda t: t["_sum"]).alias("table"))


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None, power: float, epochs: float, source_col: str) -> DataFrame:
    """(key, source, size, rate) for each source: rate is the mean number of copies that gives the source its weight.

    weights: target share by source, 0 where absent; weights of sources without rows play no part. None: shares in
    proportion to size ** power. All rows together give epochs times their number on average. Sizes are counted over all
    rows.
    """
    sizes = docs.groupBy(null_key(source_col).alias("key"), F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(power)))
    else:
        if any(w < 0 for w in weights.values()):
            raise ValueError("weights are not negative")
        given = docs.sparkSession.createDataFrame([("-" if k is None else f"={k}", float(w)) for k, w in weights.items()] or [("-", 0.0)], "key string, weight double")
        sizes = sizes.join(given, "key", "left").fillna(0.0, ["weight"])
    totals = sizes.agg(F.sum("weight").alias("w"), F.sum("size").alias("n")).first()
    share = F.col("weight") / F.lit(float(totals["w"] or 0) or 1.0)
    return sizes.withColumn("rate", share * F.lit(float(totals["n"] or 0) * epochs) / F.col("size"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, power: float = 0.7, epochs: float = 1.0, seed: int = 0, id_col: str = "doc_id", source_col: str = "source", copy_col: str = "copy", order_col: str = "shuffle_key") -> DataFrame:
    """Each row of docs as often as a Poisson count says, in an order that mixes all sources.

    A row's count inverts the Poisson distribution of its source's rate at a number that hashes seed and id: the least k
    whose cumulative probability reaches it. So runs agree, and rows with equal id and source get equal counts. Copies
    are numbered from 0 in copy_col; order_col is a hash of seed, id and copy, by which rows are dealt to tasks and
    sorted in them, ties by id and copy. A null source is a source of its own; a null id hashes like the word null; a
    rate of 0 drops its source; an empty table gives no rows. copy_col and order_col must not be columns of docs.
    """
    if clash := {copy_col, order_col} & set(docs.columns):
        raise ValueError(f"columns of docs: {sorted(clash)}")
    key, table, first, u, n = free_names([*docs.columns, copy_col, order_col], "key", "table", "first", "u", "n")
    known = durable(source_rates(docs, weights, power, epochs, source_col).select("key", "size", "rate"), "mixing-rates")
    total = known.agg(F.sum("size")).first()[0] or 0
    rates = durable(known.select("key").join(poisson_tables(known, "key", "rate"), "key", "left").select(F.col("key").alias(key), F.col("first").alias(first), F.col("table").alias(table)), "mixing-tables")
    rows = look_up(docs.withColumn(key, null_key(source_col)), rates, key, id_col).withColumn(u, uniform(f"{seed}:count", F.col(id_col)))
    # a table ends where what is left is below the step of u: one more copy at most
    rows = rows.withColumn(n, F.when(F.col(table).isNull(), 0).otherwise(F.col(first) + F.size(F.filter(table, lambda c: c < F.col(u)))).cast("int"))
    rows = rows.where(F.col(n) > 0).withColumn(copy_col, F.explode(F.sequence(F.lit(0), F.col(n) - 1)))
    rows = rows.withColumn(order_col, F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(f"{seed}:order"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.col(copy_col).cast("string"))), 1, _DIGITS), 16, 10).cast("long"))
    # the hash is uniform, so ranges of equal width hold equal shares and no sample of the rows is needed
    tasks = min(MOST_TASKS, max(docs.sparkSession.sparkContext.defaultParallelism, int(total * epochs) // ROWS_A_TASK + 1))
    (task,) = free_names(rows.columns, "task")
    rows = rows.select(*docs.columns, copy_col, order_col, F.floor(F.col(order_col) / float(1 << (4 * _DIGITS)) * tasks).cast("int").alias(task))
    return rows.repartitionById(tasks, task).drop(task).sortWithinPartitions(order_col, id_col, copy_col)
