"""Workbooks made from the tables: a nation's customers in a column, formulas beside them."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import workbook as B
from ..operators.graph import settled
from .registry import query


def books(t):
    """Column A: balances by key; column C: a filled formula; B1..B8: totals that end at the last row."""
    c = t("customer")
    i = F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey"))
    rows = c.select(F.concat(F.lit("n"), "c_nationkey").alias("wb"), i.alias("row"), F.col("c_acctbal").alias("number"))
    n = rows.groupBy("wb").agg(F.max("row").alias("n"))

    def cell(df, row, col, formula, number):
        return df.select("wb", F.lit("Data").alias("sheet"), F.lit(0).alias("sheet_idx"), row.cast("int").alias("row"), F.lit(col).alias("col"), F.lit(None).cast("string").alias("a1"), formula.alias("formula"), F.lit(False).alias("is_array"), F.when(number.isNull(), "blank").otherwise("num").alias("kind"), number.cast("double").alias("number"), F.lit(None).cast("string").alias("text"))

    none = F.lit(None)
    out = cell(rows, F.col("row"), 1, none.cast("string"), F.col("number")).unionByName(cell(rows, F.col("row"), 3, F.concat(F.lit("=A"), "row", F.lit("*2+$B$4")), none))
    forms = ["=SUM(A1:A{n})", "=AVERAGE(A1:A{n})", '=COUNTIF(A1:A{n},">0")', "=IF(B1>0,ROUND(B1*0.2,2),0)", "=MAX(A1:A{n})-MIN(A:A)", "=VLOOKUP(B5,{{0,1;5000,2;9000,3}},2)", "=INDEX(A1:A{n},3)&\"|\"&TEXT(B2,\"0.00\")", "=SUM(C1:C{n})", "=NPV(1%,A1:A{n})"]
    for k, f in enumerate(forms, 1):
        before, _, after = f.partition("{n}")
        pieces = f.replace("{{", "{").replace("}}", "}").split("{n}")
        formula = F.concat(*(x for j, p in enumerate(pieces) for x in ([F.col("n").cast("string")] if j else []) + [F.lit(p)]))
        out = out.unionByName(cell(n, F.lit(k), 2, formula, none))
    return out


_A = "a AS (SELECT 'n' || c_nationkey AS wb, c_acctbal AS v, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS i FROM customer)"
_S = f"{_A}, s AS (SELECT wb, count(*) AS n, sum(v) AS s, avg(v) AS m, count(*) FILTER (v > 0) AS pos, max(v) - min(v) AS span, max(v) FILTER (i = 3) AS third, sum(v / pow(1.01, i)) AS npv FROM a GROUP BY wb), b AS (SELECT *, CASE WHEN s > 0 THEN floor(abs(s * 0.2) * 100 + 0.5) / 100 ELSE 0 END AS b4 FROM s)"


@query(f"""WITH {_S} SELECT wb, 1 AS row, round(s, 4) AS number FROM b UNION ALL SELECT wb, 2, round(m, 4) FROM b UNION ALL SELECT wb, 3, CAST(pos AS DOUBLE) FROM b UNION ALL SELECT wb, 4, round(b4, 4) FROM b UNION ALL SELECT wb, 5, round(span, 4) FROM b
    UNION ALL SELECT wb, 6, CASE WHEN span >= 9000 THEN 3.0 WHEN span >= 5000 THEN 2.0 ELSE 1.0 END FROM b UNION ALL SELECT wb, 8, round(2 * s + n * b4, 4) FROM b UNION ALL SELECT wb, 9, round(npv, 4) FROM b""")
def workbook_totals(t):
    return B.evaluate(books(t)).where("col = 2 and kind = 'num'").select("wb", "row", F.round("number", 4).alias("number"))


@query(f"WITH {_S} SELECT wb, n, 1 AS bands FROM b")
def workbook_fill_pattern(t):
    """A filled column is one pattern."""
    return B.bands(books(t)).where("col_lo = 3").groupBy("wb").agg(F.sum("width").alias("n"), F.count_distinct("pattern").cast("int").alias("bands"))


@query(f"WITH {_S} SELECT wb, 2 * n AS fill, 5 AS totals FROM b")
def workbook_precedents(t):
    p = B.precedents(books(t)).where("not (col = 2 and row in (4, 6, 7, 8))")
    return p.groupBy("wb").agg(F.count_if(F.col("col") == 3).alias("fill"), F.count_if(F.col("col") == 2).cast("int").alias("totals")).where("totals > 0").select("wb", "fill", (F.col("totals") - 1).alias("totals"))


@query(f"WITH {_S} SELECT wb, 2 * n + 9 AS cells, n + 9 AS formulas, round(s, 4) AS total FROM b")
def workbook_round_trip(t):
    """Books are written as files' bytes and scanned again."""
    again = B.scan(B.pack(books(t)))
    return again.groupBy("wb").agg(F.count(F.lit(1)).alias("cells"), F.count("formula").alias("formulas"), F.round(F.sum(F.when(F.col("formula").isNull(), F.col("number"))), 4).alias("total"))


@query(f"WITH {_S} SELECT wb, 'match' AS verdict, n + 9 AS n FROM b")
def workbook_verify(t):
    """Values that were computed and stored agree with those computed again."""
    c = books(t)
    v = B.evaluate(c).select("wb", "sheet", "row", "col", F.col("kind").alias("_k"), F.col("number").alias("_n"), F.col("text").alias("_t"))
    stored = c.join(v, ["wb", "sheet", "row", "col"], "left").select(*(F.coalesce(n, c[o]).alias(o) if o in ("kind", "number", "text") else c[o] for o, n in ((x, {"kind": "_k", "number": "_n", "text": "_t"}.get(x, x)) for x in c.columns)))
    again = settled(B.scan(B.pack(stored)))
    return B.verify(again, B.evaluate(again)).groupBy("wb", "verdict").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_S} SELECT wb, n AS cells, 0 AS formulas FROM b")
def workbook_mask(t):
    """Only the typed cells stay."""
    c = books(t)
    kept = B.scan(B.masked(B.pack(c), c.where("formula is null").select("wb", "sheet", "row", "col")))
    return kept.groupBy("wb").agg(F.count(F.lit(1)).alias("cells"), F.count("formula").cast("int").alias("formulas"))
