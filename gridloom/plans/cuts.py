"""Selections over books made from orders: a band for each order's lines, by status and priority."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import selection as S
from .registry import query

_LINES = "l AS (SELECT l_orderkey, max(l_linenumber) AS hi, max(l_tax) AS tax FROM lineitem GROUP BY 1)"
_BANDS = f"""{_LINES}, b AS (SELECT o_orderstatus AS wb, o_orderpriority AS sheet, o_orderkey // 2 AS row, 1 + o_orderkey % 3 AS lo, 1 + o_orderkey % 3 + hi AS hi, CASE o_orderkey % 4 WHEN 0 THEN 'input' WHEN 1 THEN 'middle' WHEN 2 THEN 'output' END AS bucket,
    CASE WHEN tax > 0.07 THEN 'literal' ELSE 'formula' END AS kind, ['numeric', 'axis', 'text', 'unit'][1 + o_custkey % 4] AS vtype FROM orders JOIN l ON l_orderkey = o_orderkey),
    s AS (SELECT wb, sheet, row, unnest(range(lo, hi + 1)) AS col, bucket, kind, vtype FROM b), o AS (SELECT DISTINCT wb, sheet, row, col FROM s WHERE bucket = 'output')"""


def bands(t):
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_linenumber").alias("hi"), F.max("l_tax").alias("tax"))
    k, lo = F.col("o_orderkey"), 1 + F.col("o_orderkey") % 3
    bucket = F.when(k % 4 == 0, "input").when(k % 4 == 1, "middle").when(k % 4 == 2, "output")
    vtype = F.element_at(F.array(*map(F.lit, ("numeric", "axis", "text", "unit"))), (1 + F.col("o_custkey") % 4).cast("int"))
    return t("orders").join(lines, "o_orderkey").select(F.col("o_orderstatus").alias("wb"), F.col("o_orderpriority").alias("sheet"), F.floor(k / 2).alias("row"), lo.alias("col_lo"), (lo + F.col("hi")).alias("col_hi"), bucket.alias("bucket"), F.when(F.col("tax") > 0.07, "literal").otherwise("formula").alias("kind"), vtype.alias("vtype"))


@query(f"""WITH {_BANDS}, k AS (SELECT wb, sheet, row, col, NULL AS admitted FROM s WHERE kind <> 'literal' AND (bucket = 'input' OR vtype IN ('text', 'unit'))
    UNION ALL SELECT wb, sheet, row, col, NULL FROM s WHERE kind = 'literal' AND bucket = 'input' AND (wb, sheet, row, col) NOT IN (SELECT (wb, sheet, row, col) FROM o)
    UNION ALL SELECT wb, sheet, row, col, coalesce(bucket, '?') FROM s WHERE kind <> 'literal' AND vtype = 'axis' AND coalesce(bucket, '') <> 'input' AND (col = 1 OR row % 3 = 0 OR row BETWEEN 1990 AND 2100))
    SELECT wb, sheet, row, col, CASE WHEN bool_or(admitted IS NULL) THEN NULL ELSE min(admitted) END AS admitted FROM k GROUP BY ALL""")
def kept_cells(t):
    """What stays of books that are masked: inputs, texts, units and periods' headers."""
    b = bands(t)
    cells = S.span_cells(b).distinct().withColumns({"kind": F.when(F.col("col") == 1, "date").otherwise("num"), "number": F.col("row").cast("double"), "number_format": F.when(F.col("row") % 3 == 0, "d-MMM").otherwise("0.00")})
    return S.kept_cells(b, cells, "headers")


@query(f"""WITH {_BANDS} SELECT wb, sheet, row, col FROM (SELECT DISTINCT wb, sheet, row, col FROM s WHERE bucket = 'input') WHERE (wb, sheet, row, col) NOT IN (SELECT (wb, sheet, row, col) FROM o)""")
def frontier_cells(t):
    """Cells of inputs that are no outputs."""
    return S.input_cells(bands(t))


_DEEP = "d AS (SELECT o_custkey AS wb, count(*) - 1 AS deepest FROM orders GROUP BY 1)"


@query(f"""WITH {_DEEP}, a AS (SELECT wb, deepest, CASE WHEN deepest % 3 = 0 THEN range(0, deepest + 1, 3) ELSE list_append(range(0, deepest + 1, 3), deepest) END AS x FROM d)
    SELECT wb, CAST(unnest(CASE WHEN len(x) > 4 THEN list_distinct(list_transform(range(4), lambda i: x[CAST(round_even(i * (len(x) - 1) / 3.0, 0) AS BIGINT) + 1])) ELSE x END) AS BIGINT) AS cutoff FROM a""")
def cutoff_levels(t):
    """Where books of customers are cut off, the deepest being their number of orders: every third level, four at most."""
    return S.cutoffs(t("orders").groupBy(F.col("o_custkey").alias("wb")).agg((F.count(F.lit(1)) - 1).alias("deepest")), stride=3, cap=4)


@query("""WITH c AS (SELECT o_orderstatus AS wb, o_orderpriority AS sheet, o_orderkey AS row, 1 AS col, CASE WHEN o_orderkey % 17 <> 0 THEN o_custkey % 9 END AS level, o_orderkey % 11 = 0 AS cyclic, o_totalprice > 400000 AS volatile, CASE WHEN o_orderkey % 13 = 0 THEN '#REF!' END AS text, CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 19 <> 0 THEN o_totalprice END AS number FROM orders),
    r AS (SELECT *, CASE WHEN level IS NULL THEN 'unparsed' WHEN cyclic THEN 'cycle' WHEN volatile THEN 'volatile' WHEN text LIKE '#%' THEN 'error_value' WHEN number IS NULL THEN 'no_cached_value' END AS excluded FROM c WHERE level IS NULL OR level > 2)
    SELECT wb, sheet, row, level, excluded, CASE WHEN excluded IS NULL THEN CAST(count(*) FILTER (excluded IS NULL) OVER (PARTITION BY wb ORDER BY sheet, row) AS BIGINT) END AS place FROM r""")
def target_cells(t):
    """Computed cells below a cutoff, why some can't be asked for, and the order of the others."""
    k = F.col("o_orderkey")
    text = F.when(k % 13 == 0, "#REF!")
    number = F.when((k % 13 != 0) & (k % 19 != 0), F.col("o_totalprice"))
    cells = t("orders").select(F.col("o_orderstatus").alias("wb"), F.col("o_orderpriority").alias("sheet"), k.alias("row"), F.lit(1).alias("col"), F.when(k % 17 != 0, F.col("o_custkey") % 9).alias("level"), (k % 11 == 0).alias("cyclic"), (F.col("o_totalprice") > 400000).alias("volatile"), F.when(text.isNotNull(), "text").otherwise("num").alias("kind"), number.alias("number"), text.alias("text"))
    return S.targets(cells, F.lit(2)).drop("col")
