"""Questions with their answers from labelled series: ratios, thresholds, hurdles, unique labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as X


def ratios(series: DataFrame, by: list[str], label: str, period: str, value: str, top: str, bottom: str) -> DataFrame:
    """(by, period, ratio): one label over another where both have a value and the second isn't 0; to two digits."""
    wide = series.where(F.col(label).isin(top, bottom)).groupBy(*by, period).agg(F.max(F.when(F.col(label) == top, F.col(value))).alias("_a"), F.max(F.when(F.col(label) == bottom, F.col(value))).alias("_b"))
    return wide.where("_a is not null and _b is not null and _b <> 0").select(*by, period, X.round_half_away(F.col("_a") / F.col("_b"), 2).alias("ratio"))


def judged(value: Column, op: str, limit: float) -> Column:
    """Whether a value meets a rule such as '>=' and 1.2."""
    return X.criteria(value, f"{op}{limit}")


def hurdle(label: Column, value: Column) -> Column:
    """Whether a return clears its hurdle, by what its label names; null for other labels.

    A rate above 1.5 is read as a percentage.
    """
    low = F.lower(label)
    rate = F.when(F.abs(value) > 1.5, value / 100).otherwise(value)
    # fixed values: the hurdle of each kind of return
    return F.when(low.contains("irr"), rate >= 0.15).when(low.contains("moic"), value >= 2.0).when(low.contains("npv"), value > 0).when(low.contains("dscr"), value >= 1.2)


def unique_labels(cells: DataFrame, by: list[str], label: str) -> DataFrame:
    """Rows whose label occurs once in their group and has from 1 to 80 characters."""
    n = F.count(F.lit(1)).over(W.partitionBy(*by, label))
    return cells.withColumn("_n", n).where((F.col("_n") == 1) & F.length(label).between(1, 80)).drop("_n")


def sampled(df: DataFrame, id_col: str, n: int, seed: int = 0) -> DataFrame:
    """n rows by the hash of their id: the same ones wherever the rows lie."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string"))), id_col).limit(n)


#: Fixed value: words of metrics that are better when they fall.
LOWER_IS_BETTER = r"(?i)cost|expense|churn|attrition|loss|debt|leverage|gearing|default|delinquen|burn|overhead|liabilit|payable|vacancy|write.?off"


def trajectories(series: DataFrame, by: list[str], metric: str, period: str, value: str, least: int = 3) -> DataFrame:
    """(by, metric, first_period, last_period, first, last, verdict): from the first to the last period of each series of at
    least so many. Rising is improving, but for metrics that are better when they fall; an unchanged one deteriorates, or
    improves where lower is better, as neither rises."""
    ends = series.where(F.col(value).isNotNull()).groupBy(*by, metric).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(period, value)).alias("_a"), F.max(F.struct(period, value)).alias("_b")).where(F.col("_n") >= least)
    rose = F.col(f"_b.{value}") > F.col(f"_a.{value}")
    better = rose != F.coalesce(F.col(metric).rlike(LOWER_IS_BETTER), F.lit(False))
    return ends.where(F.col(f"_a.{period}") != F.col(f"_b.{period}")).select(*by, metric, F.col(f"_a.{period}").alias("first_period"), F.col(f"_b.{period}").alias("last_period"), F.col(f"_a.{value}").alias("first"), F.col(f"_b.{value}").alias("last"), F.when(better, "improving").otherwise("deteriorating").alias("verdict"))


def recon_full(targets: DataFrame) -> DataFrame:
    """(wb, ref, expected): every target of a book, under its sheet and cell. targets: (wb, sheet, a1, level, value)."""
    return targets.select("wb", F.concat("sheet", F.lit("!"), "a1").alias("ref"), F.col("value").alias("expected"))


def recon_frontier(targets: DataFrame, most: int = 40, seed: int = 0) -> DataFrame:
    """recon_full of the targets on a book's lowest level, so many at most, chosen by a hash of book and cell."""
    low = targets.groupBy("wb").agg(F.min("level").alias("level"))
    near = targets.join(low, ["wb", "level"]).withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), "wb", "sheet", "a1")))
    return recon_full(near.withColumn("_i", F.row_number().over(W.partitionBy("wb").orderBy("_h", "sheet", "a1"))).where(F.col("_i") <= most))
