"""Models made from the tables: a nation's customers on one sheet, totals, a view, a circle on another."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators import model as M
from .registry import query


def reports(t):
    """Data: names, balances and their doubles below headers. Summary: a total, a cell that shows it, a result of both, and
    two cells that go round in a circle."""
    i = F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey")) + 1
    rows = t("customer").select(F.concat(F.lit("n"), "c_nationkey").alias("wb"), i.alias("row"), "c_name", F.col("c_acctbal").alias("v"))
    total = rows.groupBy("wb").agg(F.max("row").alias("last"), F.sum(F.col("v") * 2).alias("s"), F.min_by("v", "row").alias("first"))
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")

    def cell(df, sheet, row, col, formula=text, number=none, said=text):
        kind = F.when(said.isNotNull(), "text").when(number.isNotNull(), "num").otherwise("blank")
        return df.select("wb", F.lit(sheet).alias("sheet"), F.lit(0 if sheet == "Data" else 1).alias("sheet_idx"), row.cast("int").alias("row"), F.lit(col).alias("col"), text.alias("a1"), formula.alias("formula"), F.lit(False).alias("is_array"), kind.alias("kind"), number.cast("double").alias("number"), said.alias("text"))

    at, v = F.col("row"), F.col("v")
    out = cell(rows, "Data", at, 1, said=F.col("c_name")).unionByName(cell(rows, "Data", at, 2, number=v)).unionByName(cell(rows, "Data", at, 3, F.concat(F.lit("=B"), "row", F.lit("*2")), v * 2))
    for k, name in enumerate(("Customer", "Balance", "Double"), 1):
        out = out.unionByName(cell(total, "Data", F.lit(1), k, said=F.lit(name)))
    for k, name in enumerate(("Total revenue", "Shown", "IRR"), 1):
        out = out.unionByName(cell(total, "Summary", F.lit(k), 1, said=F.lit(name)))
    s = F.col("s")
    forms = {1: (F.concat(F.lit("=SUM(Data!C2:C"), "last", F.lit(")")), s), 2: (F.lit("=B1"), s), 3: (F.lit("=B1*1.5+Data!B2"), s * 1.5 + F.col("first")), 5: (F.lit("=B6+1"), none), 6: (F.lit("=B5*0.5"), none)}
    for k, (formula, number) in forms.items():
        out = out.unionByName(cell(total, "Summary", F.lit(k), 2, formula, number))
    return out


def banded(t):
    """(nodes, edges, classified cells, bands, band edges)."""
    cells = reports(t)
    nodes, edges = M.formula_graph(cells)
    own = G.settled(M.classified(nodes, edges, M.labels(cells)))
    bands, members = M.model_bands(own)
    more, links = M.promoted(bands, members, nodes)
    bands, between = G.settled(bands.unionByName(more)), M.band_edges(M.cell_edges(nodes, edges), members).unionByName(links)
    return nodes, edges, own, bands, between


def parts(t):
    """(nodes, edges, classified cells, bands, band edges, components, edges between them)."""
    found = banded(t)
    return *found, *M.condensed(*found[3:])


def scored(t):
    _, _, _, bands, _, comps, _ = parts(t)
    return G.score(M.candidate_features(bands, comps))


_N = "b AS (SELECT 'n' || c_nationkey AS wb, count(*) AS n FROM customer GROUP BY 1)"


@query(f"""WITH {_N} SELECT wb, unnest(['label', 'input', 'formula', 'op', 'const', 'range']) AS kind, unnest([n + 6, n, n + 5, n + 5, n + 3, CASE WHEN n > 100 THEN 1 ELSE 0 END]) AS n FROM b""")
def model_nodes(t):
    """Nodes of the formula graph by kind."""
    kinds = ["label", "input", "formula", "op", "const", "range"]
    counts = M.formula_graph(reports(t))[0].groupBy("wb").agg(*(F.count_if(F.col("kind") == k).alias(k) for k in kinds))
    return counts.select("wb", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in kinds))).alias("x")).select("wb", "x.kind", "x.n")


@query(f"""WITH {_N} SELECT wb, unnest(['lhs', 'rhs', 'summand', 'result', 'identity']) AS role, unnest([n + 4, n + 4, CASE WHEN n > 100 THEN 1 ELSE n END, n + 4, 1]) AS n FROM b""")
def model_roles(t):
    """What flows where, by role."""
    return M.formula_graph(reports(t))[1].groupBy("wb", "role").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_N} SELECT wb, unnest(['*', '+', 'SUM']) AS name, unnest([n + 2, 2, 1]) AS n FROM b""")
def model_stats(t):
    return M.graph_stats(*M.formula_graph(reports(t))).where("stat = 'op'").select("wb", "name", "n")


@query("""SELECT 'n' || c_nationkey AS wb, 1 + row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS row, c_name || ' / Double' AS label FROM customer""")
def model_labels(t):
    """The name of the row and the header of the column."""
    return M.labels(reports(t)).where("sheet = 'Data' and col = 3 and row > 1").select("wb", F.col("row").cast("long").alias("row"), "label")


@query(f"""WITH {_N} SELECT wb, n + 6 AS texts, 2 * n + 3 AS numbers, 2 AS blanks, 1 AS mirrors, 0 AS literals FROM b""")
def model_types(t):
    """What cells hold, and cells that only show another."""
    cells = reports(t)
    own = M.classified(*M.formula_graph(cells), M.labels(cells))
    n = lambda c: F.count_if(c)
    return own.groupBy("wb").agg(n(F.col("vtype") == "text").alias("texts"), n(F.col("vtype") == "numeric").alias("numbers"), n(F.col("vtype") == "blank").alias("blanks"), n(F.col("is_mirror")).alias("mirrors"), n(F.col("is_literal")).alias("literals"))


@query(f"""WITH {_N} SELECT wb, n AS pairs, n AS into_total FROM b""")
def model_cell_edges(t):
    """Each balance leads to its double, each double to the total, through a range or not."""
    nodes, edges = M.formula_graph(reports(t))
    e = M.cell_edges(nodes, edges)
    return e.groupBy("wb").agg(F.count_if(F.col("src").startswith("Data!B") & F.col("dst").startswith("Data!C")).alias("pairs"), F.count_if(F.col("dst") == "Summary!B1").alias("into_total"))


@query(f"""WITH {_N} SELECT wb, 3 * n + 10 AS bands, 3 AS widest, 1 AS hardcoded FROM b""")
def model_bands(t):
    """Runs of alike cells, and constants in formulas that became bands of their own."""
    return banded(t)[3].groupBy("wb").agg(F.count(F.lit(1)).alias("bands"), F.max("width").alias("widest"), F.count_if(F.col("band").contains("#lit=")).alias("hardcoded"))


@query(f"""WITH {_N} SELECT wb, 3 * n + 8 AS comps, 2 AS on_circle, 3 AS deepest, 2 * n + 3 AS main_island FROM b""")
def model_condensed(t):
    """Components, circles, the longest path, and the size of the largest island."""
    return parts(t)[5].groupBy("wb").agg(F.count_distinct("comp").alias("comps"), F.count_if("on_circle").alias("on_circle"), F.max("depth").alias("deepest"), F.max(F.when(F.col("island") == 0, F.col("island_size"))).alias("main_island"))


@query(f"""WITH {_N}, c AS (SELECT wb, unnest(range(2, n + 2)) AS r FROM b) SELECT wb, 'Summary!B3' AS band, 9.0::DOUBLE AS score FROM b UNION ALL SELECT wb, 'Summary!B1', 6.4 FROM b UNION ALL SELECT wb, 'Data!C' || r, 1.0 FROM c""")
def model_candidates(t):
    """Bands that may be the model's outputs, by their place in the graph and their labels."""
    return scored(t).select("wb", "band", "score")


@query(f"""WITH {_N}, c AS (SELECT wb, 'Data!C' || unnest(range(2, n + 2)) AS band FROM b), k AS (SELECT wb, band, 2 + row_number() OVER (PARTITION BY wb ORDER BY band) AS rank FROM c)
    SELECT wb, 'Summary!B3' AS band, 1 AS rank FROM b UNION ALL SELECT wb, 'Summary!B1', 2 FROM b UNION ALL SELECT wb, band, rank FROM k WHERE rank <= 4""")
def model_fallback(t):
    return M.fallback(scored(t)).select("wb", "band", F.col("rank").cast("long").alias("rank"))


@query(f"""WITH {_N} SELECT wb, 2 AS outputs, n + 1 AS inputs, n AS middle, n + 5 AS unused FROM b""")
def model_partition(t):
    """Outputs, what feeds them from the edge, what lies between, and the rest."""
    _, _, _, bands, _, comps, links = parts(t)
    name = lambda c: F.concat("wb", F.lit("#"), c)
    best = G.score(M.candidate_features(bands, comps)).where("score >= 6").select(name("comp").alias("id"))
    marked = G.buckets(comps.select(name("comp").alias("id")), links.select(name("src").alias("src"), name("dst").alias("dst")), best)
    n = lambda b: F.count_if(F.col("bucket") == b)
    return marked.groupBy(F.substring_index("id", "#", 1).alias("wb")).agg(n("output").alias("outputs"), n("input").alias("inputs"), n("middle").alias("middle"), n("unused_input").alias("unused"))


@query(f"""WITH {_N}, k AS (SELECT wb, CASE WHEN n > 100 THEN 1 ELSE 2 END AS total FROM b) SELECT wb, total, total + 1 AS result, 2 AS cyclic FROM k""")
def model_levels(t):
    """Steps from typed cells; a total over a range that is a node of its own starts again."""
    own = M.cell_levels(*M.formula_graph(reports(t)))
    at = lambda i: F.max(F.when(F.col("id") == i, F.col("level")))
    return own.groupBy("wb").agg(at("Summary!B1").alias("total"), at("Summary!B3").alias("result"), F.count_if("cyclic").alias("cyclic"))
