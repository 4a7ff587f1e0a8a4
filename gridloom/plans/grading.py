"""Line items as graded cells: a line's price is expected, a given value is made from it by arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import grading as G
from ..operators import series as S
from .registry import query

_CELLS = """cells AS (SELECT l_orderkey AS task, l_linenumber AS ref, l_linestatus AS grp, l_extendedprice AS expected,
    CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN l_extendedprice WHEN 2 THEN l_extendedprice * 1.005 ELSE l_extendedprice * 0.8 END AS given FROM lineitem),
    c AS (SELECT DISTINCT ON (task, ref) * FROM cells ORDER BY task, ref, expected, grp),
    g AS (SELECT *, coalesce(abs(given - expected) <= greatest(0.01, 1e-6 * abs(expected)), false) AS exact, coalesce(abs(given - expected) <= greatest(0.01, 0.01 * abs(expected)), false) AS near,
        coalesce(greatest(0.0, 1 - abs(given - expected) / greatest(abs(given), abs(expected), 0.01)), 0.0) AS part, count(*) OVER (PARTITION BY task, grp) AS size, 0 AS x FROM c),
    w AS (SELECT task, count(DISTINCT grp) AS groups FROM c GROUP BY task),
    s AS (SELECT g.*, groups, CASE WHEN exact THEN 1.0 ELSE part END AS score, 1.0 / (groups * size) AS weight FROM g JOIN w ON g.task = w.task)"""


def graded(t):
    cell = t("lineitem").groupBy(F.col("l_orderkey").alias("task"), F.col("l_linenumber").alias("ref")).agg(F.min(F.struct(F.col("l_extendedprice").alias("expected"), F.col("l_linestatus").alias("grp"))).alias("x")).select("task", "ref", "x.expected", "x.grp")
    k, e = F.col("ref") % 4, F.col("expected")
    answers = cell.where(k != 0).select("task", "ref", F.when(k == 1, e).when(k == 2, e * 1.005).otherwise(e * 0.8).alias("given"))
    return G.grade(cell, answers, 0.01, 1e-6)


@query(f"WITH {_CELLS} SELECT task, CAST(ref AS BIGINT) AS ref, exact, near AS close, round(score, 6) AS score, round(weight, 6) AS weight FROM s")
def grade_continuous(t):
    return graded(t).select("task", F.col("ref").cast("long").alias("ref"), "exact", "close", F.round("score", 6).alias("score"), F.round("weight", 6).alias("weight"))


@query(f"WITH {_CELLS} SELECT task, count(*) AS n, round(sum(score * weight), 5) AS score, CASE WHEN bool_and(exact) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS discrete, round(avg(CASE WHEN given IS NULL THEN 0 ELSE 1 END), 6) AS coverage, round(avg(CAST(exact AS INT)), 6) AS accuracy, round(avg(CAST(near AS INT)), 6) AS close FROM s GROUP BY task")
def group_weights(t):
    s = G.summary(graded(t))
    return s.select("task", "n", F.round("score", 5).alias("score"), "discrete", *(F.round(c, 6).alias(c) for c in ("coverage", "accuracy", "close")))


@query("""WITH a AS (SELECT c_custkey AS task, count(o_orderkey) AS n, count(*) FILTER (o_totalprice > 150000) AS c FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1)
    SELECT task, n, c, CASE WHEN n >= 5 THEN round(CASE WHEN n - c < 5 THEN 1.0 ELSE 1 - ((n - c) / n::DOUBLE) * ((n - c - 1) / (n - 1)::DOUBLE) * ((n - c - 2) / (n - 2)::DOUBLE) * ((n - c - 3) / (n - 3)::DOUBLE) * ((n - c - 4) / (n - 4)::DOUBLE) END, 8) END AS pass5,
        CASE WHEN n >= 1 THEN round(c / n::DOUBLE, 8) END AS pass1 FROM a""")
def passk(t):
    a = t("customer").join(t("orders"), F.col("c_custkey") == F.col("o_custkey"), "left").groupBy(F.col("c_custkey").alias("task")).agg(F.count("o_orderkey").alias("n"), F.count_if(F.col("o_totalprice") > 150000).alias("c"))
    return a.select("task", "n", "c", F.round(X.pass_at(5, "n", "c"), 8).alias("pass5"), F.round(X.pass_at(1, "n", "c"), 8).alias("pass1"))


@query("""SELECT o_orderpriority AS template, year(o_orderdate) AS cutoff, grouping(o_orderpriority) AS g, count(*) AS tasks, round(avg(CASE WHEN o_totalprice > 200000 THEN 1.0 ELSE 0 END), 6) AS accuracy, round(var_pop(o_totalprice / 1000), 4) AS variance,
    round(median(o_totalprice), 3) AS med, max(o_totalprice) AS best FROM orders GROUP BY GROUPING SETS ((o_orderpriority), (year(o_orderdate)))""")
def accuracy_tables(t):
    o = t("orders").withColumn("cutoff", F.year("o_orderdate").cast("long")).withColumnRenamed("o_orderpriority", "template")
    p = F.col("o_totalprice")
    sets = o.groupingSets([["template"], ["cutoff"]], "template", "cutoff").agg(F.grouping("template").cast("long").alias("g"), F.count(F.lit(1)).alias("tasks"), F.round(F.avg((p > 200000).cast("double")), 6).alias("accuracy"), F.round(F.var_pop(p / 1000), 4).alias("variance"), F.max(p).alias("best"))
    # each row is in one group of either set; their middles are found together
    key = F.explode(F.array(F.concat(F.lit("t|"), "template"), F.concat(F.lit("c|"), F.col("cutoff").cast("string"))))
    middle = S.quantiles(o.select(key.alias("_key"), p.alias("v")), "_key", "v", {"med": 0.5})
    own = F.coalesce(F.concat(F.lit("t|"), "template"), F.concat(F.lit("c|"), F.col("cutoff").cast("string")))
    return sets.withColumn("_key", own).join(middle, "_key", "left").drop("_key").withColumn("med", F.round("med", 3))


@query("SELECT task, attempt, ok FROM (SELECT o_custkey AS task, o_orderkey AS attempt, o_orderstatus = 'F' AS ok, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F') DESC, o_orderkey) AS i FROM orders) WHERE i = 1")
def retry_collapse(t):
    return G.best_attempt(t("orders").select(F.col("o_custkey").alias("task"), F.col("o_orderkey").alias("attempt"), (F.col("o_orderstatus") == "F").alias("graded"))).withColumnRenamed("graded", "ok")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n, bool_or(abs(l_extendedprice * 0.999 - l_extendedprice) <= 10 OR abs(l_extendedprice * 0.999 - l_extendedprice) / greatest(abs(l_extendedprice), 1e-12) <= 1e-4) AS either FROM lineitem GROUP BY ALL""")
def tolerance_either(t):
    p = F.col("l_extendedprice")
    return t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.bool_or(X.matches_either(p * 0.999, p, 10.0, 1e-4)).alias("either"))
