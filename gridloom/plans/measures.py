"""Conditional aggregates, statistics, rounding, criteria and coercion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import series as S
from .registry import query


@query("""SELECT l_returnflag, CAST(sum(CASE WHEN l_quantity >= 25 AND l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS DOUBLE) AS sumifs,
    count(*) FILTER (l_quantity >= 25 AND l_discount <> 0.05) AS countifs, round(avg(CASE WHEN l_tax > 0.04 THEN l_extendedprice END), 4) AS averageif,
    coalesce(max(CASE WHEN l_quantity < 10 THEN l_extendedprice END), 0.0) AS maxifs, coalesce(min(CASE WHEN l_quantity > 40 THEN l_extendedprice END), 0.0) AS minifs FROM lineitem GROUP BY 1""")
def sumifs_family(t):
    big = X.criteria("l_quantity", ">=25")
    return t("lineitem").groupBy("l_returnflag").agg(
        F.sum(F.when(big & X.criteria("l_linestatus", "o"), F.col("l_quantity")).otherwise(0.0)).alias("sumifs"),
        F.count_if(big & X.criteria("l_discount", "<>0.05")).alias("countifs"),
        F.round(F.avg(F.when(X.criteria("l_tax", ">0.04"), F.col("l_extendedprice"))), 4).alias("averageif"),
        F.coalesce(F.max(F.when(X.criteria("l_quantity", "<10"), F.col("l_extendedprice"))), F.lit(0.0)).alias("maxifs"),
        F.coalesce(F.min(F.when(X.criteria("l_quantity", ">40"), F.col("l_extendedprice"))), F.lit(0.0)).alias("minifs"),
    )


@query("""SELECT l_linestatus, round(avg(l_extendedprice), 4) AS c1, count(l_quantity) AS c2, count(l_comment) AS c3, max(l_extendedprice) AS c4, min(l_extendedprice) AS c5, round(sum(l_extendedprice), 2) AS c9
    FROM (SELECT *, nullif(l_shipdate, NULL) AS l_comment FROM lineitem) GROUP BY 1""")
def subtotal_codes(t):
    price = F.col("l_extendedprice")
    return t("lineitem").groupBy("l_linestatus").agg(F.round(F.avg(price), 4).alias("c1"), F.count("l_quantity").alias("c2"), F.count("l_shipdate").alias("c3"), F.max(price).alias("c4"), F.min(price).alias("c5"), F.round(F.sum(price), 2).alias("c9"))


@query("""SELECT p_brand, round(quantile_cont(p_retailprice, 0.25), 4) AS q1, round(quantile_cont(p_retailprice, 0.75), 4) AS q3, round(median(p_retailprice), 4) AS med,
    list_sort(list(p_retailprice))[2] AS small2, list_reverse_sort(list(p_retailprice))[3] AS large3 FROM part GROUP BY 1""")
def quartile_small_large(t):
    p = t("part")
    q = S.quantiles(p, "p_brand", "p_retailprice", {"q1": 0.25, "q3": 0.75, "med": 0.5})
    ends = S.nth(p, "p_brand", "p_retailprice", 2).withColumnRenamed("p_retailprice", "small2").join(S.nth(p, "p_brand", "p_retailprice", 3, True).withColumnRenamed("p_retailprice", "large3"), "p_brand")
    return q.join(ends, "p_brand").select("p_brand", *(F.round(c, 4).alias(c) for c in ("q1", "q3", "med")), "small2", "large3")


@query("""WITH a AS (SELECT c_nationkey, avg(c_acctbal) AS m FROM customer GROUP BY 1) SELECT c.c_nationkey, round(avg(abs(c_acctbal - m)), 4) AS avedev, round(median(c_acctbal), 4) AS med,
    count(*) FILTER (c_acctbal < 0) AS negatives FROM customer c JOIN a ON c.c_nationkey = a.c_nationkey GROUP BY 1""")
def avedev_median(t):
    c = t("customer")
    mean = c.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("m"))
    away = c.join(mean, "c_nationkey").groupBy("c_nationkey").agg(F.round(F.avg(F.abs(F.col("c_acctbal") - F.col("m"))), 4).alias("avedev"), F.count_if(F.col("c_acctbal") < 0).alias("negatives"))
    return away.join(S.quantiles(c, "c_nationkey", "c_acctbal", {"med": 0.5}), "c_nationkey").select("c_nationkey", "avedev", F.round("med", 4).alias("med"), "negatives")


@query("""SELECT l_returnflag, l_linestatus, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_r2(l_extendedprice, l_quantity), 8) AS rsq,
    round(regr_intercept(l_extendedprice, l_quantity) + 60 * regr_slope(l_extendedprice, l_quantity), 3) AS forecast FROM lineitem GROUP BY 1, 2""")
def slope_rsq_forecast(t):
    y, x = F.col("l_extendedprice"), F.col("l_quantity")
    return t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(F.regr_slope(y, x), 4).alias("slope"), F.round(F.regr_r2(y, x), 8).alias("rsq"), F.round(F.regr_intercept(y, x) + 60 * F.regr_slope(y, x), 3).alias("forecast"))


@query("""SELECT p_partkey, sign(v) * floor(abs(v) * 10 + 0.5) / 10 AS round1, sign(v) * ceil(abs(v) * 10 - 1e-12) / 10 AS up1, sign(v) * floor(abs(v) * 10 + 1e-12) / 10 AS down1,
    sign(v) * floor(abs(v) / 5 + 0.5) * 5 AS mround5, round(v - 7 * floor(v / 7), 6) AS mod7, floor(v) AS int_v, round(exp(v / 10000), 8) AS exp_v, CASE WHEN v > 0 THEN round(ln(v), 8) END AS ln_v
    FROM (SELECT p_partkey, p_retailprice - 1200 AS v FROM part)""")
def rounding_family(t):
    v = F.col("v")
    multiple = F.signum(v) * F.floor(F.abs(v) / 5 + 0.5) * 5.0
    return t("part").select("p_partkey", (F.col("p_retailprice") - 1200).alias("v")).select(
        "p_partkey", X.round_half_away(v, 1).alias("round1"), X.round_up(v, 1).alias("up1"), X.round_down(v, 1).alias("down1"),
        F.coalesce(X.mround(v, F.signum(v) * 5.0), multiple).alias("mround5"), F.round(X.mod(v, 7.0), 6).alias("mod7"), X.integer(v).alias("int_v"), F.round(F.exp(v / 10000), 8).alias("exp_v"), F.round(X.ln(v), 8).alias("ln_v"),
    )


@query("""SELECT event_type, count(*) FILTER (value > 50) AS above, count(*) FILTER (value <= 10.5) AS upto, count(*) FILTER (value <> 0) AS other, count(*) FILTER (lower(event_type) = 'click') AS clicks,
    count(*) FILTER (lower(event_type) <> 'click') AS rest, 0 AS never FROM events GROUP BY 1""")
def criteria_strings(t):
    n = lambda column, rule, numeric=True: F.count_if(X.criteria(column, rule, numeric))
    return t("events").groupBy("event_type").agg(n("value", ">50").alias("above"), n("value", "<=10.5").alias("upto"), n("value", "<>0").alias("other"), n("event_type", "CLICK", False).alias("clicks"), n("event_type", "<>click", False).alias("rest"), n("event_type", ">click", False).cast("int").alias("never"))


@query("""WITH k AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN '2020-01-0' || (1 + event_id % 9) WHEN 2 THEN 'text' WHEN 3 THEN '' ELSE NULL END AS raw FROM events)
    SELECT event_id, CAST(CASE event_id % 5 WHEN 0 THEN event_id WHEN 1 THEN 43831 + event_id % 9 ELSE 0 END AS DOUBLE) AS num, CASE WHEN raw IS NULL OR raw = '' THEN true ELSE false END AS blank FROM k""")
def coercion_rules(t):
    i = F.col("event_id")
    raw = F.when(i % 5 == 0, i.cast("string")).when(i % 5 == 1, F.concat(F.lit("2020-01-0"), (1 + i % 9).cast("string"))).when(i % 5 == 2, "text").when(i % 5 == 3, "")
    return t("events").select("event_id", raw.alias("raw")).select("event_id", X.number("raw").alias("num"), (F.coalesce(F.col("raw"), F.lit("")) == "").alias("blank"))


@query("""SELECT l_orderkey, CASE WHEN abs(sum(x)) < max(abs(x)) * 1e-13 THEN 0.0 ELSE round(sum(x), 4) END AS snapped, CAST(count(*) AS BIGINT) AS n
    FROM (SELECT l_orderkey, l_extendedprice AS x FROM lineitem UNION ALL SELECT l_orderkey, -l_extendedprice FROM lineitem WHERE l_orderkey % 2 = 0) GROUP BY 1""")
def sum_snap(t):
    l = t("lineitem").select("l_orderkey", F.col("l_extendedprice").alias("x"))  # noqa: E741
    both = l.unionByName(l.where("l_orderkey % 2 = 0").withColumn("x", -F.col("x")))
    s = both.groupBy("l_orderkey").agg(F.sum("x").alias("s"), F.max(F.abs("x")).alias("m"), F.count(F.lit(1)).alias("n"))
    return s.select("l_orderkey", F.round(X.snap(F.col("s"), F.col("m")), 4).alias("snapped"), "n")


@query("""SELECT l_orderkey, round(sum(l_quantity * l_extendedprice), 3) AS sumproduct, round(ln(product(1 - l_discount)), 9) AS ln_prod, CAST(min(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS DOUBLE) AS mina,
    CAST(max(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS DOUBLE) AS maxa, count(*) FILTER (l_linestatus = 'F') AS countblank FROM lineitem GROUP BY 1""")
def sumproduct_product(t):
    a = F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))
    return t("lineitem").groupBy("l_orderkey").agg(F.round(F.sum(F.col("l_quantity") * F.col("l_extendedprice")), 3).alias("sumproduct"), F.round(F.log(F.product(1 - F.col("l_discount"))), 9).alias("ln_prod"), F.min(F.coalesce(a, F.lit(0.0))).alias("mina"), F.max(F.coalesce(a, F.lit(0.0))).alias("maxa"), F.count_if(a.isNull()).alias("countblank"))


@query("""SELECT l_returnflag, l_shipmode_year AS year, grouping(l_returnflag) * 2 + grouping(l_shipmode_year) AS level, count(*) AS n, round(sum(l_extendedprice), 2) AS total
    FROM (SELECT *, year(l_shipdate) AS l_shipmode_year FROM lineitem) GROUP BY GROUPING SETS ((l_returnflag), (l_shipmode_year), ())""")
def grouped_stats(t):
    l = t("lineitem").withColumn("year", F.year("l_shipdate").cast("long"))  # noqa: E741
    return l.groupingSets([["l_returnflag"], ["year"], []], "l_returnflag", "year").agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total")).select("l_returnflag", "year", "level", "n", "total")


@query("""WITH v AS (SELECT l_suppkey, l_extendedprice AS x, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS i, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem)
    SELECT l_suppkey, count(*) AS n, count(DISTINCT x) AS kinds, min(x) AS low, max(x) AS high, max(x) FILTER (i = 1) AS first1, max(x) FILTER (i = n) AS last1 FROM v GROUP BY 1""")
def value_summary(t):
    at = F.struct("l_orderkey", "l_linenumber", "l_extendedprice")  # a line's number may occur twice in an order
    x = F.col("l_extendedprice")
    return t("lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(x).alias("kinds"), F.min(x).alias("low"), F.max(x).alias("high"), F.min_by(x, at).alias("first1"), F.max_by(x, at).alias("last1"))
