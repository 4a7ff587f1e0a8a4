"""Values of customers' books, shown in many ways, against what their orders mask."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import values as V
from .registry import query

_TARGETS = """t AS (SELECT o_custkey AS book, unnest([o_orderkey * 3, o_orderkey * 3 + 1, o_orderkey * 3 + 2]) AS id, unnest(['num', 'date', 'text']) AS kind, o_totalprice AS x, CAST(o_orderdate AS DATE) AS d, lower(o_orderpriority) AS s FROM orders)"""


def orders_masked(t):
    """(book, id, kind, number, text, day): three masked values of each order."""
    o = t("orders").select(F.col("o_custkey").alias("book"), "o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("d"), "o_orderpriority")
    none = lambda k: F.lit(None).cast(k)
    row = lambda i, kind, n, x, d: F.struct((F.col("o_orderkey") * 3 + i).alias("id"), F.lit(kind).alias("kind"), n.alias("number"), x.alias("text"), d.alias("day"))
    each = F.array(row(0, "num", F.col("o_totalprice"), none("string"), none("date")), row(1, "date", none("double"), none("string"), F.col("d")), row(2, "text", none("double"), F.col("o_orderpriority"), none("date")))
    return o.select("book", F.explode(each).alias("e")).select("book", "e.*")


@query(f"""WITH {_TARGETS}, v AS (SELECT o_custkey AS book, o_orderkey AS id, o_orderkey % 5 AS k, o_totalprice AS x, CAST(o_orderdate AS DATE) AS d, lower(o_orderpriority) AS s FROM orders)
    SELECT DISTINCT v.book, v.id, t.id AS target FROM v JOIN t ON t.book = v.book AND CASE WHEN k IN (0, 2) THEN kind = 'num' AND (abs(t.x - v.x) <= 1e-9 * greatest(1, abs(t.x), abs(v.x)) OR k = 2 AND abs(t.x - v.x * 100) <= 1e-9 * greatest(1, abs(t.x), abs(v.x * 100))) WHEN k = 3 THEN kind = 'date' AND t.d = v.d WHEN k = 4 THEN kind = 'text' AND t.s = v.s ELSE false END""")
def shown_leaks(t):
    """Totals as currency, in brackets, as percents; dates in words; priorities in capitals."""
    k, x = F.col("o_orderkey") % 5, F.col("o_totalprice")
    said = F.when(k == 0, F.concat(F.lit(" $"), F.format_number(x, 2), F.lit(" m"))).when(k == 1, F.concat(F.lit("("), x.cast("decimal(18,2)").cast("string"), F.lit(")"))).when(k == 2, F.concat((x * 100).cast("decimal(18,2)").cast("string"), F.lit(" %"))).when(k == 3, F.date_format("o_orderdate", "dd-MMM-yyyy")).otherwise(F.upper(F.replace("o_orderpriority", F.lit(" "), F.lit("  "))))
    values = t("orders").select(F.col("o_custkey").alias("book"), F.col("o_orderkey").alias("id"), F.lit("text").alias("kind"), F.lit(None).cast("double").alias("number"), said.alias("text"), F.lit(None).cast("date").alias("day"))
    return V.value_leaks(values, orders_masked(t), ["book"])


@query(f"""WITH {_TARGETS}, v AS (SELECT o_custkey AS book, o_orderkey AS id, o_orderkey % 4 AS k, o_totalprice AS x, CAST(o_orderdate AS DATE) AS d, lower(o_orderpriority) AS s FROM orders)
    SELECT DISTINCT v.book, v.id, t.id AS target FROM v JOIN t ON t.book = v.book AND CASE k WHEN 0 THEN kind = 'num' AND abs(t.x - v.x) <= 1e-9 * greatest(1, abs(t.x), abs(v.x)) WHEN 1 THEN kind = 'date' AND t.d = v.d WHEN 2 THEN kind = 'text' AND t.s = v.s ELSE false END""")
def prose_leaks(t):
    """The same inside sentences; numbers and phrases that touch other letters don't count."""
    k, x = F.col("o_orderkey") % 4, F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    said = F.when(k == 0, F.concat(F.lit("It cost "), x, F.lit(" then, no more."))).when(k == 1, F.concat(F.lit("Since "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".")))
    said = said.when(k == 2, F.concat(F.lit("ranked ("), F.upper("o_orderpriority"), F.lit(")"))).otherwise(F.concat(F.lit("v"), x, F.lit(" x"), "o_orderpriority", F.lit("s")))
    texts = t("orders").select(F.col("o_custkey").alias("book"), F.col("o_orderkey").alias("id"), said.alias("text"))
    return V.prose_leaks(texts, orders_masked(t), ["book"])
