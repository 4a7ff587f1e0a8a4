"""Ways through the graph in which an order's first part leads to its second, and through the tree of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators import paths as P
from ..operators import series as S
from .graphs import _TREE, tree
from .registry import query

#: Parts in the order of an order's lines, for pending orders: a graph with about an edge a node, circles in it.
_PARTS = "e AS (SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 JOIN orders ON o_orderkey = a.l_orderkey WHERE a.l_linenumber = 1 AND o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH'))"
_COMPS = f"""{_PARTS}, n AS (SELECT src AS id FROM e UNION SELECT dst FROM e), r AS (SELECT src AS x, dst AS y FROM e UNION SELECT r.x, e.dst FROM r JOIN e ON r.y = e.src),
    m AS (SELECT a.x AS id, a.y AS other FROM r a JOIN r b ON a.x = b.y AND a.y = b.x), k AS (SELECT id, least(id, coalesce(min(other), id)) AS comp, greatest(1, count(DISTINCT other)) AS size, count(other) > 0 AS on_circle FROM n LEFT JOIN m USING (id) GROUP BY id)"""
_LINKS = f"{_COMPS}, q AS (SELECT DISTINCT a.comp AS src, b.comp AS dst FROM e JOIN k a ON a.id = e.src JOIN k b ON b.id = e.dst WHERE a.comp <> b.comp), w AS (SELECT comp, 0 AS d FROM k UNION SELECT q.dst, d + 1 FROM w JOIN q ON q.src = w.comp), z AS (SELECT comp, CAST(max(d) AS BIGINT) AS depth FROM w GROUP BY comp)"


def parts(t):
    own = t("orders").where("o_orderstatus = 'P' and o_orderpriority in ('1-URGENT', '2-HIGH')").select(F.col("o_orderkey").alias("l_orderkey"))
    line = lambda n, c: t("lineitem").where(F.col("l_linenumber") == n).select("l_orderkey", F.col("l_partkey").alias(c))
    return line(1, "src").join(line(2, "dst"), "l_orderkey").join(own, "l_orderkey").select("src", "dst").distinct()


@query(f"WITH RECURSIVE {_LINKS} SELECT id, comp, size, on_circle, depth FROM k JOIN z USING (comp)")
def circle_depths(t):
    """Circles as components, and the longest way to each, circles drawn together."""
    return G.quotient(parts(t))[0]


@query(f"""WITH RECURSIVE {_LINKS}, b AS (SELECT dst AS id, arg_max(src, {{'d': depth, 's': src}}) AS prev FROM q JOIN z ON z.comp = q.src GROUP BY dst),
    p AS (SELECT dst AS output, dst AS id, 0 AS back FROM q WHERE dst NOT IN (SELECT src FROM q) UNION SELECT output, prev, back + 1 FROM p JOIN b USING (id))
    SELECT output, CAST(max(back) OVER (PARTITION BY output) - back AS BIGINT) AS step, id FROM p""")
def longest_routes(t):
    """One longest way to each component that leads nowhere."""
    nodes, links = G.quotient(parts(t))
    ends = links.select(F.col("dst").alias("id")).distinct().join(links.select(F.col("src").alias("id")), "id", "left_anti")
    return P.longest_path(links, nodes.select(F.col("comp").alias("id"), "depth").distinct(), ends)


@query(f"""WITH RECURSIVE {_LINKS}, o AS (SELECT DISTINCT dst AS id FROM q WHERE dst NOT IN (SELECT src FROM q)), i AS (SELECT comp AS id FROM k WHERE comp % 11 = 0),
    s AS (SELECT id AS output, id FROM o UNION SELECT output, q.src FROM s JOIN q ON q.dst = s.id WHERE s.id = output OR s.id NOT IN (SELECT id FROM i))
    SELECT output, row_number() OVER (PARTITION BY output ORDER BY depth, id) - 1 AS "order", id, CASE WHEN id IN (SELECT id FROM i) THEN 'input' WHEN id = output THEN 'output' ELSE 'middle' END AS role,
        (SELECT count(*) FROM q JOIN s x ON x.output = s.output AND x.id = q.src WHERE q.dst = s.id) AS precedents FROM s JOIN z ON z.comp = s.id""")
def lineage(t):
    """What each end depends on, back to typed components, what feeds it first."""
    nodes, links = G.quotient(parts(t))
    one = nodes.select(F.col("comp").alias("id"), "depth").distinct()
    ends = links.select(F.col("dst").alias("id")).distinct().join(links.select(F.col("src").alias("id")), "id", "left_anti")
    steps = P.trace(links, one, ends, one.where("id % 11 = 0").select("id"))
    return steps.select("output", "order", "id", "role", F.size("precedents").cast("long").alias("precedents"))


@query(f"""WITH RECURSIVE {_PARTS}, m AS (SELECT p_partkey AS id, unnest(list_filter([CASE WHEN p_size > 45 THEN 1 END, CASE WHEN p_brand = 'Brand#1' THEN 2 END, CASE WHEN p_name LIKE '%red%' THEN 4 END], lambda x: x IS NOT NULL)) AS bit FROM part),
    r AS (SELECT id, bit FROM m UNION SELECT dst, bit FROM r JOIN e ON src = id) SELECT id, CAST(bit_or(bit) AS BIGINT) AS mask FROM r GROUP BY id""")
def taint_masks(t):
    """Three marks at once on parts and on all that they lead to, circles included."""
    bit = lambda c, n: F.when(c, n).otherwise(0)
    mask = bit(F.col("p_size") > 45, 1) + bit(F.col("p_brand") == "Brand#1", 2) + bit(F.col("p_name").contains("red"), 4)
    return P.taints(parts(t), t("part").select(F.col("p_partkey").alias("id"), mask.alias("mask")))


@query(f"""WITH RECURSIVE {_PARTS}, x AS (SELECT src, dst FROM e UNION ALL SELECT l_suppkey + 10000000, l_partkey FROM lineitem WHERE l_quantity = 50), o AS (SELECT p_partkey AS id FROM part WHERE p_size = 50),
    c AS (SELECT id FROM o UNION SELECT src FROM c JOIN x ON dst = id) SELECT s_suppkey + 10000000 AS id, 'seeded' AS kind FROM supplier WHERE s_suppkey + 10000000 IN (SELECT id FROM c)
    UNION SELECT p_partkey, 'read' FROM part WHERE p_retailprice > 1500 AND (p_partkey % 13 = 0 OR p_partkey + 1 IN (SELECT id FROM c))""")
def cone_leaks(t):
    """Suppliers with a value given that feed large parts by edges found late, and parts read by a part of that cone or by none known."""
    late = t("lineitem").where("l_quantity = 50").select((F.col("l_suppkey") + 10000000).alias("src"), F.col("l_partkey").alias("dst"))
    reads = t("part").where("p_retailprice > 1500").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 13 != 0, F.col("p_partkey") + 1).alias("consumer"))
    return P.cone_leaks(parts(t), t("part").where("p_size = 50").select(F.col("p_partkey").alias("id")), t("supplier").select((F.col("s_suppkey") + 10000000).alias("id")), late, reads)


@query(f"""WITH RECURSIVE {_TREE}, f AS (SELECT 'n' || n_nationkey AS id FROM nation), r AS (SELECT 'r' || r_regionkey AS start, 'r' || r_regionkey AS id, 0 AS hops FROM region
    UNION SELECT start, dst, hops + CASE WHEN id IN (SELECT id FROM f) THEN 0 ELSE 1 END FROM r JOIN e ON src = id WHERE hops + CASE WHEN id IN (SELECT id FROM f) THEN 0 ELSE 1 END <= 2)
    SELECT start, CAST(hops AS BIGINT) AS hops, count(*) AS n, min(id) AS least FROM r GROUP BY ALL""")
def focus_depth(t):
    """What lies within two hops of each region, nations being passed for free."""
    e = tree(t)
    near = P.focus(e, t("nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id")), t("region").select(F.concat(F.lit("r"), "r_regionkey").alias("id")), 2, "down")
    return near.groupBy("start", "hops").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))


@query("""WITH RECURSIVE s AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS i, doc_id, greatest(length(coalesce(text, '')), 1) AS n FROM documents),
    g AS (SELECT lang, i, doc_id, n AS held, 0 AS chunk FROM s WHERE i = 1 UNION ALL SELECT s.lang, s.i, s.doc_id, CASE WHEN held + n > 40000 THEN n ELSE held + n END, chunk + CASE WHEN held + n > 40000 THEN 1 ELSE 0 END FROM g JOIN s ON s.lang IS NOT DISTINCT FROM g.lang AND s.i = g.i + 1)
    SELECT lang, doc_id, CAST(chunk AS BIGINT) AS chunk FROM g""")
def budget_chunks(t):
    """Documents of a language in chunks of 40,000 characters at most."""
    d = t("documents").select("lang", "doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n"))
    return S.chunks(d, ["lang"], ["doc_id"], F.col("n"), 40_000).select("lang", "doc_id", "chunk")
