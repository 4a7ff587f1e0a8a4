"""Attempts, pages and chains made from orders and line items; masks and settings of made-up books."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import grading as G
from ..operators import records as R
from ..operators import workbook as B
from . import workbooks
from .registry import query


@query("""SELECT o_custkey AS task, count(*) AS n, round(avg(o_totalprice), 7) AS mean, round(var_pop(o_totalprice) / 1e6, 5) AS variance, round(median(o_totalprice), 4) AS middle, max(o_totalprice) AS best,
    CAST(sum(o_orderkey % 1000) AS BIGINT) AS tokens, round(sum(o_orderkey % 5000) / 3600, 8) AS hours FROM orders GROUP BY 1""")
def trial_summary(t):
    a = t("orders").select(F.col("o_custkey").alias("task"), F.col("o_totalprice").alias("score"), (F.col("o_orderkey") % 1000).alias("tokens"), (F.col("o_orderkey") % 5000).alias("seconds"))
    s = G.task_summary(a)
    return s.select("task", "n", F.round("mean", 7).alias("mean"), F.round(F.col("variance") / 1e6, 5).alias("variance"), F.round("middle", 4).alias("middle"), "best", "tokens", F.round("hours", 8).alias("hours"))


@query("""WITH e AS (SELECT l_returnflag AS task, l_suppkey AS output, l_orderkey AS attempt, bool_and(l_discount < 0.08) AS ok FROM lineitem GROUP BY ALL)
    SELECT task, output, count(*) AS attempts, count(*) FILTER (ok) AS right, CASE WHEN bool_and(ok) THEN 'always' WHEN bool_or(ok) THEN 'sometimes' ELSE 'never' END AS bucket FROM e GROUP BY ALL""")
def trial_reliability(t):
    return G.reliability(t("lineitem").select(F.col("l_returnflag").alias("task"), F.col("l_suppkey").alias("output"), F.col("l_orderkey").alias("attempt"), (F.col("l_discount") < 0.08).alias("exact")))


@query("""WITH a AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_totalprice > 150000) AS c FROM orders GROUP BY 1),
    p AS (SELECT n, c, CASE WHEN n >= 5 THEN CASE WHEN n - c < 5 THEN 1.0 ELSE 1 - ((n - c) / n::DOUBLE) * ((n - c - 1) / (n - 1)::DOUBLE) * ((n - c - 2) / (n - 2)::DOUBLE) * ((n - c - 3) / (n - 3)::DOUBLE) * ((n - c - 4) / (n - 4)::DOUBLE) END END AS pass FROM a)
    SELECT count(*) AS tasks, round(avg(pass), 8) AS macro, round(sum(c) / sum(n), 8) AS micro, round(sum(c) / sum(n) * (1 - sum(c) / sum(n)), 8) AS variance FROM p""")
def trial_overall(t):
    o = G.overall(t("orders").select(F.col("o_custkey").alias("task"), (F.col("o_totalprice") > 150000).alias("ok")))
    return o.select("tasks", *(F.round(c, 8).alias(c) for c in ("macro", "micro", "variance")))


@query("SELECT l_orderkey AS attempt, count(*) AS steps, CAST(sum(l_linenumber) AS BIGINT) AS calls, CAST(sum(l_partkey + l_suppkey) AS BIGINT) AS tokens, round(sum(l_tax), 6) AS cost FROM lineitem GROUP BY 1")
def trial_trajectory(t):
    steps = t("lineitem").select(F.col("l_orderkey").alias("attempt"), F.col("l_linenumber").alias("calls"), F.col("l_partkey").alias("prompt_tokens"), F.col("l_suppkey").alias("completion_tokens"), F.col("l_tax").alias("cost"))
    return G.trajectory(steps).withColumn("cost", F.round("cost", 6))


@query("""SELECT p_brand AS task, CAST(p_partkey AS VARCHAR) AS ref, p_partkey % 3 = 1 AS is_text, p_partkey % 3 <> 2 AS exact FROM part""")
def text_answers(t):
    """Numbers written with commas and signs, and texts with white space around; every third answer is wrong."""
    i, price = F.col("p_partkey") % 3, F.format_number("p_retailprice", 2)
    p = t("part").select(F.col("p_brand").alias("task"), F.col("p_partkey").cast("string").alias("ref"), F.when(i == 1, F.col("p_name")).otherwise(price).alias("expected"), F.when(i == 0, F.concat(F.lit(" "), price, F.lit("%"))).when(i == 1, F.concat(F.lit(" "), "p_name", F.lit("\t "))).otherwise("true").alias("given"))
    given = p.select("task", "ref", F.regexp_replace("given", "\t", " ").alias("given"))
    return G.grade_text(p.select("task", "ref", "expected"), given, 1e-6, 1e-6)


@query("""SELECT o_orderkey AS id, last_value(o_orderkey) OVER w AS end, count(*) OVER w - 1 AS steps, true AS ends FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""")
def release_chains(t):
    """Each order's last successor, by doubled pointers."""
    o = R.superseded(t("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey")
    return R.chain_ends(o, "o_orderkey", "superseded_by")


@query("""WITH k AS (SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) - 1 AS i, count(*) OVER (PARTITION BY p_brand) AS total FROM part)
    SELECT p_brand, CAST(i // 5 * 5 AS BIGINT) AS cursor, count(*) AS n, CASE WHEN i // 5 * 5 + 5 < total THEN CAST(i // 5 * 5 + 5 AS BIGINT) END AS next_cursor FROM k GROUP BY ALL""")
def page_drain(t):
    """All pages; those of groups that don't add up would be left out."""
    p = R.pages(t("part"), ["p_brand"], ["p_retailprice", "p_partkey"])
    sound = p.join(R.drain_faults(p, ["p_brand"], "p_partkey").select("p_brand"), "p_brand", "left_anti")
    return sound.groupBy("p_brand", "cursor", "next_cursor").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)")
def orphaned_lines(t):
    few = t("part").where("p_size > 5").select(F.col("p_partkey").alias("l_partkey"))
    return R.orphans(t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), few, "l_partkey")


@query("""SELECT 'n' || c_nationkey AS wb, unnest(['leaked', 'lost']) AS fault, 1 AS n FROM customer GROUP BY c_nationkey""")
def workbook_mask_faults(t):
    """A mask that kept one cell too many and lost another is found out."""
    c = workbooks.books(t)
    wanted = c.where("formula is null").select("wb", "sheet", "row", "col")
    last = wanted.withColumn("_i", F.row_number().over(W.partitionBy("wb").orderBy(F.desc("row")))).where("_i = 1").select("wb", "sheet", "row", "col")
    done = c.where("formula is null").join(last, ["wb", "sheet", "row", "col"], "left_anti").select(*c.columns)
    extra = c.where("formula is not null and col = 3 and row = 1").withColumn("formula", F.lit(None).cast("string")).withColumn("number", F.lit(1.0)).withColumn("kind", F.lit("num"))
    return B.mask_faults(c, done.unionByName(extra), wanted).groupBy("wb", "fault").agg(F.count(F.lit(1)).cast("int").alias("n"))
