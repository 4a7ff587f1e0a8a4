"""Audits over books made from orders: a sheet for each priority, a row for each order, a cell for each number of its lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import normaliser as N
from ..operators import references as R
from ..operators.graph import settled
from .registry import query

#: What the books hold: the value of a line, whether it is computed, and whether the delivered book still has it.
_BOOK = """c AS (SELECT o_orderstatus AS wb, CASE o_orderpriority WHEN '5-LOW' THEN 'Lists' ELSE o_orderpriority END AS sheet, l_orderkey AS row, CAST(l_linenumber AS BIGINT) AS col, max(l_partkey * 100 + l_quantity) AS v,
        bool_or(l_tax = 0.08 AND l_linenumber = 1) AS computed, NOT bool_or(l_discount = 0.1 AND l_linenumber = 2) AS held FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4)"""


def books(t):
    """(cells, held, sheets) of the books."""
    lines = t("lineitem").join(t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("wb"), F.when(F.col("o_orderpriority") == "5-LOW", "Lists").otherwise(F.col("o_orderpriority")).alias("sheet")), "l_orderkey")
    computed = F.bool_or((F.col("l_tax") == 0.08) & (F.col("l_linenumber") == 1))
    one = settled(lines.groupBy("wb", "sheet", F.col("l_orderkey").alias("row"), F.col("l_linenumber").alias("col")).agg(F.max(F.col("l_partkey") * 100 + F.col("l_quantity")).cast("double").alias("number"), F.when(computed, "=1+1").alias("formula"), F.bool_or(F.col("l_discount") == 0.1).alias("_off")))
    cells = one.select("wb", "sheet", "row", "col", "formula", F.lit("num").alias("kind"), "number", F.lit(None).cast("string").alias("text"))
    return cells, one.where(~(F.col("_off") & (F.col("col") == 2))), cells.select("wb", "sheet").distinct()


@query(f"""WITH RECURSIVE {_BOOK}, n AS (SELECT wb, sheet, row, max(col) AS last, count(*) AS cells, count(*) FILTER (computed) AS computed, count(*) FILTER (held AND NOT computed) AS typed FROM c GROUP BY ALL),
    o AS (SELECT o_orderstatus AS wb, CASE o_orderpriority WHEN '5-LOW' THEN 'Lists' ELSE o_orderpriority END AS sheet, o_orderkey AS id FROM orders WHERE o_orderpriority <> '1-URGENT'),
    r AS (SELECT o.*, CASE WHEN id % 20 = 0 THEN ['unparsable_reference'] WHEN id % 20 = 1 THEN ['unknown_sheet']
            ELSE list_filter([CASE WHEN n.cells IS NULL OR n.typed + n.computed < n.last THEN 'blank_in_baseline' END, CASE WHEN n.computed > 0 THEN 'formula_cell' END], lambda x: x IS NOT NULL) END AS codes, coalesce(n.typed, 0) AS typed
        FROM o LEFT JOIN n ON n.wb = o.wb AND n.sheet = o.sheet AND n.row = id),
    k AS (SELECT c.wb, c.sheet, c.row AS cell_row, c.v, c.sheet = 'Lists' AS pick, r.id FROM c LEFT JOIN r ON r.wb = c.wb AND r.sheet = c.sheet AND r.id = c.row AND len(codes) = 0 AND typed > 0 WHERE held),
    t AS (SELECT c.wb, c.v, r.id FROM c JOIN r ON r.wb = c.wb AND r.sheet = c.sheet AND r.id = c.row AND len(codes) = 0 AND typed > 0 WHERE held AND NOT computed),
    s AS (SELECT DISTINCT a.id FROM t a JOIN k b ON a.wb = b.wb AND a.v = b.v WHERE b.id IS NULL AND NOT b.pick),
    d AS (SELECT id FROM s UNION SELECT a.id FROM d JOIN k b ON b.id = d.id AND NOT b.pick JOIN t a ON a.wb = b.wb AND a.v = b.v)
    SELECT wb, id, len(codes) = 0 AND typed > 0 AND id NOT IN (SELECT id FROM d) AS clean, CASE WHEN list_contains(codes, 'unparsable_reference') THEN 'unparsable_reference' WHEN list_contains(codes, 'unknown_sheet') THEN 'unknown_sheet'
        WHEN list_contains(codes, 'formula_cell') THEN 'formula_cell' WHEN list_contains(codes, 'blank_in_baseline') THEN 'blank_in_baseline' WHEN id IN (SELECT id FROM d) THEN 'duplicate_value_leak' END AS code FROM r""")
def mask_fixpoint(t):
    """Orders as an audit's rows: which can be masked, once those that uncover others' values are gone."""
    cells, held, sheets = books(t)
    last = F.chr(F.col("last") + 64)
    own = t("orders").where("o_orderpriority <> '1-URGENT'").select(F.col("o_orderstatus").alias("wb"), F.when(F.col("o_orderpriority") == "5-LOW", "Lists").otherwise(F.col("o_orderpriority")).alias("sheet"), F.col("o_orderkey").alias("id"))
    ends = cells.groupBy("wb", "sheet", F.col("row").alias("id")).agg(F.max("col").alias("last"))
    text = F.when(F.col("id") % 20 == 0, "as agreed").when(F.col("id") % 20 == 1, "see Nowhere!A1").otherwise(F.concat(F.lit("Values per <br/> "), "sheet", F.lit("!$A$"), "id", F.lit(":"), F.coalesce(last, F.lit("A")), "id", F.lit("; checked")))
    drafts = own.join(ends, ["wb", "sheet", "id"], "left").select("wb", "id", text.alias("text"))
    return N.analyse(drafts, sheets, cells, held).select("wb", "id", "clean", "code")


@query("""WITH b AS (SELECT o_orderkey, c_mktsegment AS sheet, o_custkey - o_orderkey % 40 AS lo, o_custkey + o_orderkey % 300 AS hi FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT o_orderkey, count(c_custkey) AS cells, CAST(coalesce(sum(c_custkey), 0) AS BIGINT) AS total FROM b LEFT JOIN customer c ON c.c_mktsegment = b.sheet AND c_custkey BETWEEN greatest(lo, 1) AND hi AND c_nationkey + 1 BETWEEN 2 AND 30 GROUP BY 1""")
def prose_boxes(t):
    """Boxes that sentences name, and what lies in them: customers on a sheet for each segment, a row an id, a column a nation."""
    c = t("customer")
    cells = c.select(F.lit("all").alias("wb"), F.col("c_mktsegment").alias("sheet"), F.col("c_custkey").alias("row"), (F.col("c_nationkey") + 1).alias("col"))
    o = t("orders").join(c.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    quoted = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("the '"), "c_mktsegment", F.lit("'"))).otherwise(F.concat(F.lit("Rows of: "), F.lower("c_mktsegment")))
    text = F.concat(quoted, F.lit("!B"), F.greatest(F.col("o_custkey") - F.col("o_orderkey") % 40, F.lit(1)), F.lit(":$AD$"), F.col("o_custkey") + F.col("o_orderkey") % 300, F.lit(" count."))
    rows = o.select(F.lit("all").alias("wb"), "o_orderkey", text.alias("text"))
    refs = R.prose_references(rows, "text", cells.select("wb", "sheet").distinct(), ["wb"]).select("wb", "o_orderkey", F.explode("refs").alias("r"))
    refs = settled(refs)
    boxes = refs.select("wb", "o_orderkey", F.col("r.sheet").alias("sheet"), *R.corners(F.col("r.box")))
    found = R.inside(boxes, cells, ["wb", "sheet"]).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("cells"), F.sum("row").alias("total"))
    return refs.select("o_orderkey").join(found, "o_orderkey", "left").select("o_orderkey", F.coalesce("cells", F.lit(0)).alias("cells"), F.coalesce("total", F.lit(0)).alias("total"))


@query("""WITH l AS (SELECT o_orderkey, l_linenumber, l_quantity, l_tax FROM orders JOIN lineitem ON l_orderkey = o_orderkey), n AS (SELECT o_orderkey, max(l_linenumber) AS last FROM l GROUP BY 1)
    SELECT o_orderkey AS id, 'reference' AS fault, 'Data!A' || o_orderkey || ':B' || (o_orderkey + 1) AS said, CAST(NULL AS VARCHAR) AS row FROM n WHERE o_orderkey % 7 = 0
    UNION ALL SELECT o_orderkey, 'value', '' || (CAST(l_quantity AS BIGINT) + 1000), 'line ' || l_linenumber FROM l WHERE o_orderkey % 5 = 0 AND l_tax = 0.05""")
def table_faults(t):
    """What tables on orders name beside what there is: boxes of more rows than the order's own, numbers a thousand too high."""
    l = t("lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber", F.col("l_quantity").cast("long").alias("q"), "l_tax")  # noqa: E741
    box = F.concat(F.lit("Data!A"), "id", F.lit(":B"), F.when(F.col("id") % 7 == 0, F.col("id") + 1).otherwise(F.col("id")))
    wrong = (F.col("id") % 5 == 0) & (F.col("l_tax") == 0.05)
    line = F.concat(F.lit("| line "), "l_linenumber", F.lit(" | "), F.when(wrong, F.col("q") + 1000).otherwise(F.col("q")), F.lit(" | ledger "), box, F.lit(" |"))
    tables = l.groupBy("id").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("text"))
    tables = tables.select(F.col("id").cast("string").alias("wb"), "id", "text")
    key = F.col("id").cast("string").alias("wb")
    inventory = l.groupBy("id").agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("x "), "q"))), ", ").alias("e"))
    inventory = settled(inventory.select(key, F.lit("Data").alias("sheet"), F.col("id").alias("r1"), F.lit(1).cast("long").alias("c1"), F.col("id").alias("r2"), F.lit(2).cast("long").alias("c2"), F.col("e").alias("encoded")))
    return N.table_faults(tables, inventory, inventory.select("wb", "sheet")).select("id", "fault", "said", "row")
