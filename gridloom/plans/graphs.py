"""Graph operators on hierarchies and on the part-supplier graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from .registry import query

_TREE = """e AS (SELECT 'r' || n_regionkey AS src, 'n' || n_nationkey AS dst FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer
    UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey FROM orders)"""


def tree(t):
    link = lambda df, a, x, b, y: df.select(F.concat(F.lit(a), x).alias("src"), F.concat(F.lit(b), y).alias("dst"))
    return link(t("nation"), "r", "n_regionkey", "n", "n_nationkey").unionByName(link(t("customer"), "n", "c_nationkey", "c", "c_custkey")).unionByName(link(t("orders"), "c", "o_custkey", "o", "o_orderkey"))


@query(f"""WITH RECURSIVE {_TREE}, r AS (SELECT DISTINCT src AS seed, src AS id, CAST(0 AS BIGINT) AS hops FROM e WHERE src LIKE 'r%'
    UNION SELECT seed, dst, hops + 1 FROM r JOIN e ON id = src) SELECT seed, hops, count(*) AS n, min(id) AS least FROM r GROUP BY ALL""")
def closure_depth(t):
    e = tree(t)
    return G.closure(e, e.where("src like 'r%'").select(F.col("src").alias("seed"))).groupBy("seed", "hops").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))


@query(f"""WITH RECURSIVE {_TREE}, r AS (SELECT 'o' || o_orderkey AS seed, 'o' || o_orderkey AS id, CAST(0 AS BIGINT) AS hops FROM orders WHERE o_totalprice > 300000
    UNION SELECT seed, src, hops + 1 FROM r JOIN e ON id = dst) SELECT seed, id, hops FROM r""")
def ancestors(t):
    big = t("orders").where("o_totalprice > 300000").select(F.concat(F.lit("o"), "o_orderkey").alias("seed"))
    return G.closure(tree(t), big, backward=True)


@query(f"WITH {_TREE}, l AS (SELECT unnest(['r', 'n', 'c', 'o']) AS k, unnest([0, 1, 2, 3]) AS depth), i AS (SELECT src AS id FROM e UNION SELECT dst FROM e) SELECT id, CAST(CASE WHEN id LIKE 'c%' AND id NOT IN (SELECT dst FROM e) THEN 0 ELSE depth END AS BIGINT) AS depth FROM i JOIN l ON substr(id, 1, 1) = k")
def longest_path_depth(t):
    return G.depths(tree(t))


_PS = "e AS (SELECT DISTINCT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem)"


def lines(t):
    return t("lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst"))


def parts_suppliers(t):
    return lines(t).distinct()


@query(f"""WITH RECURSIVE {_PS}, n AS (SELECT DISTINCT a.dst AS x, b.dst AS y FROM e a JOIN e b ON a.src = b.src), r AS (SELECT x, y FROM n UNION SELECT r.x, n.y FROM r JOIN n ON r.y = n.x),
    c AS (SELECT r.x AS s, min(least(e.src, e.dst)) AS island FROM r JOIN e ON e.dst = r.y GROUP BY 1) SELECT s AS id, island FROM c UNION SELECT e.src, island FROM e JOIN c ON c.s = e.dst""")
def islands(t):
    return G.islands(lines(t))


@query("""WITH e AS (SELECT DISTINCT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem), d AS (SELECT src AS id, 0 AS i, 1 AS o FROM e UNION ALL SELECT dst, 1, 0 FROM e)
    SELECT id, CAST(sum(i) AS BIGINT) AS n_in, CAST(sum(o) AS BIGINT) AS n_out FROM d GROUP BY id""")
def edge_degrees(t):
    return G.degrees(t("lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst")).distinct())


@query(f"""WITH {_TREE}, m AS (SELECT 'n' || n_nationkey AS id FROM nation)
    SELECT 'r' || n_regionkey AS src, 'c' || c_custkey AS dst FROM customer JOIN nation ON c_nationkey = n_nationkey UNION SELECT src, dst FROM e WHERE src LIKE 'c%'""")
def mirror_bypass(t):
    """Nations taken for mere views: regions link to customers."""
    return G.bypass(tree(t), t("nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id")))[0]


@query("SELECT 'r' || n_regionkey AS id, count(*) AS fan_in FROM nation GROUP BY 1")
def mirror_fan_in(t):
    return G.bypass(tree(t), t("nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id")))[1]


@query(f"""WITH RECURSIVE {_TREE}, v AS (SELECT src AS id FROM e UNION SELECT dst FROM e UNION SELECT 'x' || r_regionkey FROM region), o AS (SELECT 'o' || o_orderkey AS id FROM orders WHERE o_totalprice > 300000),
    c AS (SELECT id FROM o UNION SELECT src FROM c JOIN e ON id = dst), f AS (SELECT DISTINCT dst AS id FROM e), i AS (SELECT id FROM c WHERE id NOT IN (SELECT id FROM f)),
    b AS (SELECT id FROM i UNION SELECT dst FROM b JOIN e ON id = src)
    SELECT id, CASE WHEN id IN (SELECT id FROM o) THEN 'output' WHEN id IN (SELECT id FROM i) THEN 'input' WHEN id IN (SELECT id FROM c) THEN 'middle'
        WHEN id NOT IN (SELECT id FROM f) THEN 'unused_input' WHEN id IN (SELECT id FROM b) THEN 'dead' ELSE 'detached' END AS bucket FROM v""")
def frontier_partition(t):
    e = tree(t)
    nodes = e.select(F.col("src").alias("id")).union(e.select("dst")).union(t("region").select(F.concat(F.lit("x"), "r_regionkey")))
    return G.buckets(nodes, e, t("orders").where("o_totalprice > 300000").select(F.concat(F.lit("o"), "o_orderkey").alias("id")))


@query("""WITH f AS (SELECT p_partkey, count(*) AS fan_in, count(DISTINCT l_suppkey) AS kinds, max(l_quantity) AS q FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY 1),
    s AS (SELECT p_partkey, p_name, round(0.6 * least(fan_in, 5) + CASE WHEN kinds > 20 THEN 2.0 ELSE 0 END + 1.5 * q / 50 + CASE WHEN p_size > 25 THEN 3.0 ELSE 0 END + CASE WHEN p_name LIKE '%ring%' THEN 2.5 ELSE 0 END
        + CASE WHEN p_name LIKE '%red%' THEN 0.8 ELSE 0 END + CASE WHEN p_brand = 'Brand#1' THEN 1.5 ELSE 0 END + CASE WHEN p_type LIKE 'Small%' THEN 1.5 ELSE 0 END + 0.5 - CASE WHEN p_name LIKE '%widget%' THEN 6.0 ELSE 0 END, 3) AS score FROM f JOIN part USING (p_partkey))
    SELECT p_partkey, score, row_number() OVER (ORDER BY score DESC, p_partkey) AS rank FROM s WHERE score > 0 ORDER BY rank LIMIT 40""")
def output_score(t):
    p = t("part").join(t("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("fan_in"), F.count_distinct("l_suppkey").alias("kinds"), F.max("l_quantity").alias("depth")), "p_partkey")
    f = p.withColumns({"sink": F.col("p_size") > 25, "strong": F.col("p_name").contains("ring"), "weak": F.col("p_name").contains("red"), "output_sheet": F.col("p_brand") == "Brand#1", "scalar_collapse": F.col("p_type").startswith("Small"), "main_island": F.lit(True), "check": F.col("p_name").contains("widget"), "unlabelled": F.lit(False), "presented_on": (F.col("kinds") > 20).cast("int"), "max_depth": F.lit(50)})
    # the report is of the first 40: a top-k, so no global sort
    top = G.score(f).orderBy(F.desc("score"), "p_partkey").limit(40)
    rows = top.groupBy().agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "p_partkey"))).alias("x"))
    return rows.select(F.posexplode("x").alias("i", "y")).select("y.p_partkey", (-F.col("y.s")).alias("score"), (F.col("i") + 1).cast("long").alias("rank"))
