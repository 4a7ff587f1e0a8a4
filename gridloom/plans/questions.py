"""Question templates on yearly series of nations and on parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import templates as T
from .registry import query

_Y = "y AS (SELECT c_nationkey AS k, year(o_orderdate) AS y, o_orderstatus AS label, sum(o_totalprice) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"


def series(t):
    o = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.groupBy(F.col("c_nationkey").alias("k"), F.year("o_orderdate").cast("long").alias("year"), F.col("o_orderstatus").alias("label")).agg(F.sum("o_totalprice").alias("v"))


@query(f"WITH {_Y}, w AS (SELECT k, y, max(v) FILTER (label = 'O') AS a, max(v) FILTER (label = 'F') AS b FROM y GROUP BY ALL) SELECT k, y AS year, floor(a / b * 100 + 0.5) / 100 AS ratio FROM w WHERE a IS NOT NULL AND b <> 0")
def compute_ratio(t):
    return T.ratios(series(t), ["k"], "label", "year", "v", "O", "F")


@query(f"WITH {_Y}, w AS (SELECT k, y, max(v) FILTER (label = 'O') AS a, max(v) FILTER (label = 'F') AS b FROM y GROUP BY ALL) SELECT k, y AS year, floor(a / b * 100 + 0.5) / 100 >= 1.2 AS ok FROM w WHERE a IS NOT NULL AND b <> 0")
def judge_threshold(t):
    return T.ratios(series(t), ["k"], "label", "year", "v", "O", "F").select("k", "year", T.judged(F.col("ratio"), ">=", 1.2).alias("ok"))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN CASE WHEN p_size > 1.5 THEN p_size / 100.0 ELSE p_size END >= 0.15 WHEN 1 THEN p_size >= 2 WHEN 2 THEN p_size - 25 > 0 WHEN 3 THEN p_size >= 1.2 END AS ok FROM part""")
def judge_hurdle(t):
    names = F.element_at(F.array(*(F.lit(x) for x in ("Equity IRR", "MOIC", "Project NPV", "DSCR min", "Other"))), (F.col("p_partkey") % 5 + 1).cast("int"))
    value = F.when(F.col("p_partkey") % 5 == 2, F.col("p_size") - 25).otherwise(F.col("p_size")).cast("double")
    return t("part").select("p_partkey", T.hurdle(names, value).alias("ok"))


@query("SELECT p_brand, p_partkey, p_name FROM (SELECT *, count(*) OVER (PARTITION BY p_brand, p_name) AS n FROM part) WHERE n = 1")
def extract_named_metric(t):
    return T.unique_labels(t("part"), ["p_brand"], "p_name").select("p_brand", "p_partkey", "p_name")


@query("SELECT o_orderkey FROM orders ORDER BY md5('0|' || o_orderkey), o_orderkey LIMIT 40")
def recon_sample(t):
    return T.sampled(t("orders").select("o_orderkey"), "o_orderkey", 40)


@query("""WITH y AS (SELECT o_custkey, ['Net revenue', 'Churn rate', 'Operating cost'][1 + o_custkey % 3] AS metric, year(o_orderdate) AS y, sum(o_totalprice) AS v FROM orders GROUP BY ALL),
    s AS (SELECT o_custkey, metric, count(*) AS n, CAST(min(y) AS BIGINT) AS first_period, CAST(max(y) AS BIGINT) AS last_period, arg_min(v, y) AS a, arg_max(v, y) AS b FROM y GROUP BY ALL)
    SELECT o_custkey, metric, first_period, last_period, round(a, 2) AS first, round(b, 2) AS last, CASE WHEN (b > a) = (metric = 'Net revenue') THEN 'improving' ELSE 'deteriorating' END AS verdict FROM s WHERE n >= 3""")
def trajectory_verdicts(t):
    """Series of customers' years, some of metrics that are better when they fall."""
    metric = F.element_at(F.array(F.lit("Net revenue"), F.lit("Churn rate"), F.lit("Operating cost")), (1 + F.col("o_custkey") % 3).cast("int"))
    y = t("orders").groupBy("o_custkey", metric.alias("metric"), F.year("o_orderdate").cast("long").alias("year")).agg(F.sum("o_totalprice").alias("v"))
    return T.trajectories(y, ["o_custkey"], "metric", "year", "v").withColumns({"first": F.round("first", 2), "last": F.round("last", 2)})


@query("""WITH c AS (SELECT o_custkey AS wb, o_orderpriority AS sheet, 'B' || o_orderkey AS a1, year(o_orderdate) AS level, o_totalprice AS value FROM orders), l AS (SELECT wb, min(level) AS level FROM c GROUP BY 1),
    k AS (SELECT c.*, row_number() OVER (PARTITION BY wb ORDER BY md5('0|' || wb || '|' || sheet || '|' || a1), sheet, a1) AS i FROM c JOIN l USING (wb, level)) SELECT wb, sheet || '!' || a1 AS ref, value AS expected FROM k WHERE i <= 2""")
def recon_frontier(t):
    """Two of the cells on each book's lowest level."""
    cells = t("orders").select(F.col("o_custkey").alias("wb"), F.col("o_orderpriority").alias("sheet"), F.concat(F.lit("B"), "o_orderkey").alias("a1"), F.year("o_orderdate").alias("level"), F.col("o_totalprice").alias("value"))
    return T.recon_frontier(cells, most=2)


@query("SELECT o_custkey AS wb, o_orderpriority || '!B' || o_orderkey AS ref, o_totalprice AS expected FROM orders")
def recon_full(t):
    """Every cell of each book, under its reference."""
    return T.recon_full(t("orders").select(F.col("o_custkey").alias("wb"), F.col("o_orderpriority").alias("sheet"), F.concat(F.lit("B"), "o_orderkey").alias("a1"), F.lit(1).alias("level"), F.col("o_totalprice").alias("value")))
