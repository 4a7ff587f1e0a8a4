"""Lookups: exact, with a default, approximate, by place; nearest earlier values; runs, growth, drivers."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import series as S
from .registry import query


@query("""WITH first AS (SELECT s_nationkey, min(s_suppkey) AS s FROM supplier GROUP BY 1)
    SELECT n_nationkey, n_name, s AS first_supplier, coalesce(s_name, 'none') AS supplier_name FROM nation LEFT JOIN first ON n_nationkey = s_nationkey LEFT JOIN supplier ON s_suppkey = s""")
def xlookup_default(t):
    first = S.first_match(t("supplier"), "s_nationkey", "s_suppkey", "s_name")
    return t("nation").join(first, F.col("n_nationkey") == F.col("s_nationkey"), "left").select("n_nationkey", "n_name", F.col("s_suppkey").alias("first_supplier"), F.coalesce("s_name", F.lit("none")).alias("supplier_name"))


@query("SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def vlookup_exact(t):
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return c.select("c_custkey", "n_name", "r_name")


@query("""WITH g AS (SELECT unnest([0.0, 1000.0, 1100.0, 1250.0, 1500.0, 1700.0]) AS lo)
    SELECT p_partkey, count(lo) FILTER (lo <= p_retailprice) AS below, CASE WHEN count(lo) FILTER (lo <= p_retailprice) > 0 THEN CAST(count(lo) FILTER (lo <= p_retailprice) AS DOUBLE) END AS approx,
        CASE WHEN min(lo) FILTER (lo >= p_retailprice) IS NOT NULL THEN CAST(count(lo) FILTER (lo < p_retailprice) + 1 AS DOUBLE) END AS above FROM part CROSS JOIN g GROUP BY p_partkey, p_retailprice""")
def match_approximate(t):
    steps = F.array(*(F.lit(x) for x in (0.0, 1000.0, 1100.0, 1250.0, 1500.0, 1700.0)))
    p = F.col("p_retailprice")
    return t("part").select("p_partkey", F.size(F.filter(steps, lambda s: s <= p)).cast("long").alias("below"), X.match(p, steps, 1).alias("approx"), X.match(p, steps, -1).alias("above"))


@query("""WITH a AS (SELECT n_regionkey, list(n_name ORDER BY n_nationkey) AS names FROM nation GROUP BY 1)
    SELECT n_regionkey, names[1 * 2 + 1] AS r2c1, names[0 * 2 + 2] AS r1c2, names[9 * 2 + 1] AS outside FROM a""")
def index_2d(t):
    a = t("nation").groupBy("n_regionkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]).alias("names"))
    at = lambda r, c: X.index(F.col("names"), F.lit(r), 2, F.lit(c))
    return a.select("n_regionkey", at(2, 1).alias("r2c1"), at(1, 2).alias("r1c2"), at(10, 1).alias("outside"))


@query("""SELECT e.event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nearest,
    first_value(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS leftmost FROM events e""")
def label_asof(t):
    e = t("events")
    return S.nearest_before(e, ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "purchase", F.col("event_id")), "nearest").select("event_id", "nearest", F.first("event_type").over(W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("leftmost"))


@query("""WITH d AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 15), g AS (SELECT *, l_linenumber - row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS run FROM d)
    SELECT l_orderkey, CAST(min(l_linenumber) AS BIGINT) AS lo, CAST(max(l_linenumber) AS BIGINT) AS hi, count(*) AS width FROM g GROUP BY l_orderkey, run""")
def band_runs(t):
    return S.runs(t("lineitem").where("l_quantity > 15").select("l_orderkey", "l_linenumber").distinct(), ["l_orderkey"], "l_linenumber")


@query("""WITH y AS (SELECT o_custkey, year(o_orderdate) AS y, sum(o_totalprice) AS v FROM orders GROUP BY ALL), g AS (SELECT *, lag(v) OVER (PARTITION BY o_custkey ORDER BY y) AS p FROM y)
    SELECT o_custkey, CAST(y AS BIGINT) AS year, round((v - p) / abs(p) * 100, 1) AS growth FROM g WHERE p IS NOT NULL AND p <> 0""")
def prior_period_growth(t):
    y = t("orders").groupBy("o_custkey", F.year("o_orderdate").cast("long").alias("year")).agg(F.sum("o_totalprice").alias("v"))
    return S.growth(y, ["o_custkey"], "year", "v").select("o_custkey", "year", F.round("growth", 1).alias("growth"))


@query("""WITH y AS (SELECT o_custkey, year(o_orderdate) AS y, sum(o_totalprice) AS v FROM orders GROUP BY ALL),
    s AS (SELECT o_custkey, count(*) AS n, arg_min(v, y) AS a, arg_max(v, y) AS b FROM y GROUP BY 1) SELECT o_custkey, n, round(a, 2) AS first, round(b, 2) AS last, b > a AS rising FROM s WHERE n >= 3""")
def trajectory(t):
    y = t("orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.sum("o_totalprice").alias("v"))
    s = y.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.min_by("v", "y").alias("a"), F.max_by("v", "y").alias("b")).where("n >= 3")
    return s.select("o_custkey", "n", F.round("a", 2).alias("first"), F.round("b", 2).alias("last"), (F.col("b") > F.col("a")).alias("rising"))


@query("""WITH y AS (SELECT n_regionkey AS r, c_nationkey AS part, year(o_orderdate) AS y, sum(o_totalprice) AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
    g AS (SELECT *, v - lag(v) OVER (PARTITION BY r, part ORDER BY y) AS delta FROM y), k AS (SELECT *, row_number() OVER (PARTITION BY r, y ORDER BY abs(delta) DESC, part) AS i FROM g WHERE delta IS NOT NULL)
    SELECT r AS regionkey, CAST(y AS BIGINT) AS year, part AS driver, round(delta, 2) AS delta FROM k WHERE i = 1""")
def driver_argmax(t):
    o = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    y = o.groupBy(F.col("n_regionkey").alias("regionkey"), F.col("c_nationkey").alias("driver"), F.year("o_orderdate").cast("long").alias("year")).agg(F.sum("o_totalprice").alias("v"))
    return S.driver(y, ["regionkey"], "driver", "year", "v").select("regionkey", "year", "driver", F.round("delta", 2).alias("delta"))
