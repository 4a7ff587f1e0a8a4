"""Grading: cells against expected values, groups that weigh alike, repeated attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as X
from .series import quantiles


def grade(targets: DataFrame, answers: DataFrame, absolute: float, relative: float) -> DataFrame:
    """targets (task, ref, grp, expected), answers (task, ref, given): a row for each target with exact, close, score and
    weight. A target without answer scores 0; of answers under one ref the least counts. Each group weighs alike, as do the
    targets of a group."""
    once = answers.groupBy("task", "ref").agg(F.min("given").alias("given"))
    rows = targets.join(once, ["task", "ref"], "left").withColumn("grp", F.coalesce(F.col("grp").cast("string"), F.col("ref").cast("string")))
    # one shuffle by task serves all windows
    size = F.count(F.lit(1)).over(W.partitionBy("task", "grp"))
    groups = F.max("_place").over(W.partitionBy("task"))
    rows = rows.repartition("task").withColumn("_place", F.dense_rank().over(W.partitionBy("task").orderBy("grp"))).withColumn("_size", size).withColumn("_groups", groups)
    exact = X.matches_max("given", "expected", absolute, relative)
    return rows.select("task", "ref", "grp", "expected", "given", exact.alias("exact"), X.matches_max("given", "expected", absolute, 0.01).alias("close"), F.when(exact, 1.0).otherwise(X.closeness("given", "expected", absolute)).alias("score"), (1 / (F.col("_groups") * F.col("_size"))).alias("weight"))


def as_number(text: Column | str) -> Column:
    """A given answer as a number: thousands' commas and % are taken off without a change of scale; null for booleans,
    NaN, infinity and other text."""
    text = F.trim(F.col(text) if isinstance(text, str) else text)
    number = X.plain_number(F.regexp_replace(text, "[,%]", ""))
    return F.when(F.lower(text).isin("true", "false") | F.isnan(number) | (F.abs(number) == float("inf")), None).otherwise(number)


def grade_text(targets: DataFrame, answers: DataFrame, absolute: float, relative: float) -> DataFrame:
    """targets (task, ref, expected), answers (task, ref, given), both text: (task, ref, is_text, exact).

    A target that is a number is matched as one, any other by its text without white space around. A task of one target
    may be answered under the ref 'answer'.
    """
    alone = targets.groupBy("task").agg(F.min("ref").alias("_one"), F.count(F.lit(1)).alias("_n")).where("_n = 1").select("task", "_one")
    named = answers.join(alone, "task", "left").withColumn("ref", F.when((F.col("ref") == "answer") & F.col("_one").isNotNull(), F.col("_one")).otherwise(F.col("ref")))
    given = named.groupBy("task", "ref").agg(F.min("given").alias("given"))
    want, got = as_number("expected"), as_number("given")
    exact = F.when(want.isNull(), F.trim("expected") == F.trim("given")).otherwise(X.matches_max(got, want, absolute, relative))
    return targets.join(given, ["task", "ref"], "left").select("task", "ref", want.isNull().alias("is_text"), F.coalesce(exact, F.lit(False)).alias("exact"))


def task_summary(attempts: DataFrame) -> DataFrame:
    """attempts (task, score, tokens, seconds): (task, n, mean, variance, middle, best, tokens, hours), the variance that of
    all attempts."""
    own = attempts.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean"), F.var_pop("score").alias("variance"), F.max("score").alias("best"), F.sum("tokens").alias("tokens"), (F.sum("seconds") / 3600).alias("hours"))
    return own.join(quantiles(attempts, "task", "score", {"middle": 0.5}), "task", "left").select("task", "n", "mean", "variance", "middle", "best", "tokens", "hours")


def reliability(cells: DataFrame) -> DataFrame:
    """cells (task, output, attempt, exact): (task, output, attempts, right, bucket): an attempt is right where all of an
    output's cells are; always, sometimes or never."""
    each = cells.groupBy("task", "output", "attempt").agg(F.bool_and("exact").alias("ok"))
    out = each.groupBy("task", "output").agg(F.count(F.lit(1)).alias("attempts"), F.count_if("ok").alias("right"))
    return out.withColumn("bucket", F.when(F.col("right") == F.col("attempts"), "always").when(F.col("right") > 0, "sometimes").otherwise("never"))


def overall(attempts: DataFrame, k: int = 5) -> DataFrame:
    """attempts (task, ok): one row: tasks, macro (mean of the tasks' pass@k where they have k attempts), micro (share of
    all attempts that are ok) and its variance."""
    task = attempts.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("c"))
    return task.agg(F.count(F.lit(1)).alias("tasks"), F.avg(X.pass_at(k, "n", "c")).alias("macro"), (F.sum("c") / F.sum("n")).alias("micro"), ((F.sum("c") / F.sum("n")) * (1 - F.sum("c") / F.sum("n"))).alias("variance"))


def trajectory(steps: DataFrame) -> DataFrame:
    """steps (attempt, calls, prompt_tokens, completion_tokens, cost): sums and the number of steps of each attempt."""
    return steps.groupBy("attempt").agg(F.count(F.lit(1)).alias("steps"), F.sum("calls").alias("calls"), F.sum(F.col("prompt_tokens") + F.col("completion_tokens")).alias("tokens"), F.sum("cost").alias("cost"))


def summary(graded: DataFrame) -> DataFrame:
    """(task, n, score, discrete, coverage, accuracy, close): one row a task."""
    share = lambda c: F.avg(c.cast("double"))
    return graded.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("score") * F.col("weight")).alias("score"), F.bool_and("exact").cast("double").alias("discrete"), share(F.col("given").isNotNull()).alias("coverage"), share(F.col("exact")).alias("accuracy"), share(F.col("close")).alias("close"))


def best_attempt(attempts: DataFrame) -> DataFrame:
    """attempts (task, attempt, graded, …): for each task its first graded attempt, else its first one."""
    rank = F.row_number().over(W.partitionBy("task").orderBy(F.desc("graded"), "attempt"))
    return attempts.withColumn("_i", rank).where("_i = 1").drop("_i")
