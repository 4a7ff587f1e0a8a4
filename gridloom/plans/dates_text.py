"""Dates as serial numbers, and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as X
from .registry import query

_DAY = "date_diff('day', DATE '1899-12-30', CAST({} AS DATE))"
_D = f"CAST({_DAY.format('o_orderdate')} AS DOUBLE)"


@query(f"""SELECT o_orderkey, {_D} AS serial, CAST({_DAY.format("last_day(o_orderdate + INTERVAL 3 MONTH)")} AS DOUBLE) AS eomonth, CAST({_DAY.format("o_orderdate + INTERVAL 1 MONTH")} AS DOUBLE) AS edate,
    CAST(year(o_orderdate) AS BIGINT) AS y, CAST(dayofweek(o_orderdate) + 1 AS DOUBLE) AS wd1, CAST(isodow(o_orderdate) AS DOUBLE) AS wd2, CAST(isodow(o_orderdate) - 1 AS DOUBLE) AS wd3,
    CAST({_DAY.format("make_date(year(o_orderdate), 1, 1) + INTERVAL 13 MONTH + INTERVAL 39 DAY")} AS DOUBLE) AS dated FROM orders""")
def eomonth_edate_weekday(t):
    d = F.col("serial")
    return t("orders").select("o_orderkey", F.floor(X.serial("o_orderdate")).cast("double").alias("serial")).select(
        "o_orderkey", "serial", X.eomonth(d, 3).alias("eomonth"), X.edate(d, 1).alias("edate"), F.year(X.date_of(d)).cast("long").alias("y"),
        X.weekday(d, 1).alias("wd1"), X.weekday(d, 2).alias("wd2"), X.weekday(d, 3).alias("wd3"), X.date(F.year(X.date_of(d)), F.lit(14), F.lit(40)).alias("dated"),
    )


@query(f"""WITH b AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 900 AS INTEGER) AS b FROM orders),
    p AS (SELECT *, CASE WHEN month(a) = 2 AND a = last_day(a) THEN 30 WHEN day(a) = 31 THEN 30 ELSE day(a) END AS d1,
                 CASE WHEN month(a) = 2 AND a = last_day(a) AND month(b) = 2 AND b = last_day(b) THEN 30 WHEN day(b) = 31 AND (day(a) >= 30 OR (month(a) = 2 AND a = last_day(a))) THEN 30 ELSE day(b) END AS d2,
                 (year(b) - year(a)) * 360 + (month(b) - month(a)) * 30 AS base FROM b)
    SELECT o_orderkey, CAST(base + d2 - d1 AS DOUBLE) AS us, CAST(base + least(day(b), 30) - least(day(a), 30) AS DOUBLE) AS eu, round((base + d2 - d1) / 360.0, 8) AS yf0, round(date_diff('day', a, b) / 360.0, 8) AS yf2, round(date_diff('day', a, b) / 365.0, 8) AS yf3 FROM p""")
def days360_yearfrac(t):
    a = F.floor(X.serial("o_orderdate")).cast("double").alias("a")
    o = t("orders").select("o_orderkey", a).withColumn("b", F.col("a") + F.col("o_orderkey") % 900)
    return o.select("o_orderkey", X.days360("a", "b").alias("us"), X.days360("a", "b", True).alias("eu"), F.round(X.yearfrac("a", "b", 0), 8).alias("yf0"), F.round(X.yearfrac("a", "b", 2), 8).alias("yf2"), F.round(X.yearfrac("a", "b", 3), 8).alias("yf3"))


@query("""WITH b AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) AS b FROM orders),
    d AS (SELECT o_orderkey, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS x FROM b)
    SELECT o_orderkey, CAST(count(*) FILTER (isodow(x) < 6) AS DOUBLE) AS days, -CAST(count(*) FILTER (isodow(x) < 6) AS DOUBLE) * CASE WHEN o_orderkey % 60 = 0 THEN -1 ELSE 1 END AS back FROM d GROUP BY o_orderkey""")
def networkdays(t):
    o = t("orders").select("o_orderkey", F.floor(X.serial("o_orderdate")).cast("double").alias("a")).withColumn("b", F.col("a") + F.col("o_orderkey") % 60)
    return o.select("o_orderkey", X.networkdays("a", "b").alias("days"), X.networkdays("b", "a").alias("back"))


@query("""WITH b AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 1500 AS INTEGER) AS b FROM orders),
    m AS (SELECT *, (year(b) - year(a)) * 12 + month(b) - month(a) - CASE WHEN day(b) < day(a) THEN 1 ELSE 0 END AS m FROM b)
    SELECT o_orderkey, CAST(date_diff('day', a, b) AS DOUBLE) AS d, CAST(m AS DOUBLE) AS m, CAST(m // 12 AS DOUBLE) AS y, CAST(m % 12 AS DOUBLE) AS ym FROM m""")
def datedif(t):
    o = t("orders").select("o_orderkey", F.floor(X.serial("o_orderdate")).cast("double").alias("a")).withColumn("b", F.col("a") + F.col("o_orderkey") % 1500)
    return o.select("o_orderkey", *(X.datedif("a", "b", u).alias(u.lower()) for u in ("D", "M", "Y", "YM")))


@query("""SELECT p_partkey, length(p_name) AS len, upper(p_name) AS up, lower(p_type) AS low, substr(p_name, 1, 4) AS left4, right(p_name, 3) AS right3, substr(p_name, 3, 5) AS mid5,
    CASE WHEN instr(p_name, 'a') > 0 THEN CAST(instr(p_name, 'a') AS DOUBLE) END AS find_a, CASE WHEN instr(lower(p_type), 's') > 0 THEN CAST(instr(lower(p_type), 's') AS DOUBLE) END AS search_s,
    replace(p_name, 'a', 'oo') AS sub, trim(regexp_replace('  ' || p_type || '   x ', ' +', ' ', 'g')) AS trimmed, p_brand || '-' || p_size AS joined FROM part""")
def text_functions(t):
    return t("part").select(
        "p_partkey", F.length("p_name").cast("long").alias("len"), F.upper("p_name").alias("up"), F.lower("p_type").alias("low"), X.left("p_name", 4).alias("left4"), X.right("p_name", 3).alias("right3"),
        X.mid("p_name", 3, 5).alias("mid5"), X.find("a", "p_name").alias("find_a"), X.search("S", "p_type").alias("search_s"), X.substitute("p_name", "a", "oo").alias("sub"),
        X.trim(F.concat(F.lit("  "), "p_type", F.lit("   x "))).alias("trimmed"), F.concat("p_brand", F.lit("-"), X.text("p_size")).alias("joined"),
    )


@query("SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_nationkey) AS names, count(*) AS n FROM nation GROUP BY 1")
def textjoin_by_group(t):
    rows = t("nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("x"), F.count(F.lit(1)).alias("n"))
    return rows.select("n_regionkey", X.textjoin(", ", F.transform("x", lambda x: x["n_name"])).alias("names"), "n")


@query()
def proper_and_nth(t):
    """Capitals after any non-letter, and the second occurrence only: tested against str.title and a loop."""
    return t("part").select("p_partkey", X.proper(F.concat("p_type", F.lit("-"), "p_name")).alias("proper"), X.substitute("p_name", "a", "_", 2).alias("second"))
