"""Cash flows, loans and rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as X
from ..functions import solvers as S
from .registry import query

#: A series of flows of each customer: an outlay, then its orders in order of date and key.
FLOWS = """
    f AS (SELECT o_custkey AS k, o_totalprice AS v, CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS DOUBLE) AS d,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS i FROM orders)"""


def flows(t) -> DataFrame:
    """(k, flows, days): arrays in order; a customer's orders are a bounded group here."""
    o = t("orders").select(F.col("o_custkey").alias("k"), F.struct("o_orderdate", "o_orderkey", F.col("o_totalprice").alias("v"), X.serial("o_orderdate").alias("d")).alias("x"))
    rows = o.groupBy("k").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return rows.select("k", F.transform("x", lambda x: x["v"]).alias("flows"), F.transform("x", lambda x: F.floor(x["d"]).cast("double")).alias("days"))


@query(f"WITH {FLOWS} SELECT k AS custkey, count(*) AS n, round(sum(v / pow(1.01, i)), 4) AS npv FROM f GROUP BY k")
def npv_by_customer(t):
    return flows(t).select(F.col("k").alias("custkey"), F.size("flows").cast("long").alias("n"), F.round(X.npv(0.01, F.col("flows")), 4).alias("npv"))


@query(f"WITH {FLOWS}, g AS (SELECT *, min(d) OVER (PARTITION BY k) AS d0 FROM f) SELECT k AS custkey, round(sum(v * pow(1.05, -(d - d0) / 365)), 4) AS xnpv FROM g GROUP BY k")
def xnpv_by_customer(t):
    return flows(t).select(F.col("k").alias("custkey"), F.round(X.xnpv(0.05, F.col("flows"), F.col("days")), 4).alias("xnpv"))


@query(f"""WITH {FLOWS}, n AS (SELECT k, count(*) AS n FROM f GROUP BY k),
    g AS (SELECT f.k, n, sum(CASE WHEN i > 1 THEN v * pow(1.03, n - i) ELSE 0 END) AS gains, sum(CASE WHEN i = 1 THEN v * 2.5 ELSE 0 END) AS costs FROM f JOIN n ON f.k = n.k GROUP BY f.k, n)
    SELECT k AS custkey, round(CASE WHEN n > 1 AND gains > 0 THEN pow(gains / costs, 1.0 / (n - 1)) - 1 END, 6) AS mirr FROM g""")
def mirr_by_customer(t):
    signed = F.transform("flows", lambda v, i: F.when(i == 0, -2.5 * v).otherwise(v))
    return flows(t).select(F.col("k").alias("custkey"), F.round(X.mirr(signed, 0.02, 0.03), 6).alias("mirr"))


LOAN = "rate AS (SELECT p_partkey, p_retailprice AS pv, p_size / 1000.0 AS r, p_size % 12 + 2 AS n, 1 + p_partkey % (p_size % 12 + 2) AS per FROM part), loan AS (SELECT p_partkey, pv, CAST(r AS DOUBLE) AS r, CAST(n AS DOUBLE) AS n, CAST(per AS DOUBLE) AS per, CASE WHEN r = 0 THEN -pv / n ELSE -pv * pow(1 + r, n) * r / (pow(1 + r, n) - 1) END AS pmt FROM rate)"


def loans(t) -> DataFrame:
    n = F.col("p_size") % 12 + 2
    return t("part").select("p_partkey", F.col("p_retailprice").alias("pv"), (F.col("p_size") / 1000.0).alias("r"), n.cast("double").alias("n"), (1 + F.col("p_partkey") % n).cast("double").alias("per"))


@query(f"WITH {LOAN} SELECT p_partkey, round(pmt, 6) AS pmt FROM loan")
def pmt_schedule(t):
    return loans(t).select("p_partkey", F.round(X.pmt("r", "n", "pv"), 6).alias("pmt"))


_BALANCE = "-(pv * pow(1 + r, per - 1) + pmt * (pow(1 + r, per - 1) - 1) / r) * r"


@query(f"WITH {LOAN} SELECT p_partkey, round({_BALANCE}, 6) AS ipmt, round(pmt - ({_BALANCE}), 6) AS ppmt FROM loan")
def ipmt_ppmt_split(t):
    return loans(t).select("p_partkey", F.round(X.ipmt("r", "per", "n", "pv"), 6).alias("ipmt"), F.round(X.ppmt("r", "per", "n", "pv"), 6).alias("ppmt"))


@query(f"""WITH {LOAN}, p AS (SELECT p_partkey, pv, r, n, pmt, CAST(unnest(range(1, CAST(per AS INTEGER) + 1)) AS DOUBLE) AS per FROM loan)
    SELECT p_partkey, round(sum({_BALANCE}), 5) AS cumipmt, round(sum(pmt - ({_BALANCE})), 5) AS cumprinc FROM p GROUP BY p_partkey""")
def cumulative_interest(t):
    args = ("r", "n", "pv", 1, F.col("per"))
    return loans(t).select("p_partkey", F.round(X.cumulative(X.ipmt, *args), 5).alias("cumipmt"), F.round(X.cumulative(X.ppmt, *args), 5).alias("cumprinc"))


@query(f"""WITH {LOAN} SELECT p_partkey, round(-(pv * pow(1 + r, n) - 50 * (pow(1 + r, n) - 1) / r), 5) AS fv,
    round(-(pv - 50 * (pow(1 + r, n) - 1) / r) / pow(1 + r, n), 5) AS pv_out,
    round(ln((-(pv * r + 10) - 0 * r) / (-(pv * r + 10) + pv * r)) / ln(1 + r), 5) AS nper, round(pow((pv + 100) / pv, 1 / n) - 1, 8) AS rri FROM loan""")
def fv_pv_nper_rri(t):
    return loans(t).select(
        "p_partkey",
        F.round(X.fv("r", "n", -50.0, "pv"), 5).alias("fv"),
        F.round(X.pv("r", "n", -50.0, "pv"), 5).alias("pv_out"),
        F.round(X.nper("r", -(F.col("pv") * F.col("r") + 10), "pv"), 5).alias("nper"),
        F.round(X.rri("n", "pv", F.col("pv") + 100), 8).alias("rri"),
    )


@query()
def irr_xirr(t):
    """Roots by iteration, which SQL can't express: tested against closed forms and by their residual."""
    signed = flows(t).select("k", F.transform("flows", lambda v, i: F.when(i == 0, -2.5 * v).otherwise(v)).alias("flows"), "days")
    return signed.select(F.col("k").alias("custkey"), S.irr("flows").alias("irr"), S.xirr("flows", "days").alias("xirr"))


@query()
def rate_of_loans(t):
    return loans(t).withColumn("pmt", X.pmt("r", "n", "pv")).select("p_partkey", F.round(S.rate("n", "pmt", "pv"), 9).alias("rate"), F.round("r", 9).alias("given"))


@query()
def norm_distribution(t):
    """erf and its inverse aren't built in; tested against tabled values and each other."""
    z = ((F.col("l_quantity") - 25) / 10).alias("z")
    out = t("lineitem").select("l_orderkey", "l_linenumber", z)
    cdf = S.norm_cdf("z")
    return out.select("l_orderkey", "l_linenumber", F.round(cdf, 9).alias("cdf"), F.round(F.exp(-F.col("z") * F.col("z") / 2) / F.sqrt(2 * F.pi()), 9).alias("pdf"), F.round(S.norm_inv(cdf), 6).alias("back"))
