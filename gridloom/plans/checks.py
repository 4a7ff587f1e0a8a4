"""Checks of the tables as one bundle, with faults planted in them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import rules as R
from ..operators.graph import fresh_folder
from ..sources import segments as S
from .registry import query


@query("""SELECT 'size' AS rule, '' || p_partkey AS id, 'size ' || p_size AS message FROM part WHERE NOT coalesce(p_size BETWEEN 2 AND 48, false)
    UNION ALL SELECT 'price', '' || p_partkey, 'price' FROM part WHERE NOT coalesce(p_retailprice > 1000, false)
    UNION ALL SELECT 'name', '' || p_partkey, 'name' FROM part WHERE NOT coalesce(regexp_matches(p_name, '^[a-z ]+$'), false)""")
def row_rules(t):
    """Three rules of a table in one scan."""
    rules = {"size": (F.col("p_size").between(2, 48), F.concat(F.lit("size "), "p_size")), "price": (F.col("p_retailprice") > 1000, "price"), "name": (F.col("p_name").rlike("^[a-z ]+$"), "name")}
    return R.row_faults(t("part"), "p_partkey", rules)


@query("""WITH l AS (SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_orderkey END AS k, CASE WHEN l_orderkey % 10 = 3 THEN 1 ELSE l_linenumber END AS n FROM lineitem),
    a AS (SELECT 'line' AS rule, CASE WHEN k IS NOT NULL THEN k || '|' || n END AS id FROM l UNION ALL SELECT 'balance', '' || floor(c_acctbal) FROM customer)
    SELECT rule, id, CASE WHEN id IS NULL THEN count(*) || ' without a key' ELSE count(*) || ' rows' END AS message FROM a GROUP BY rule, id HAVING id IS NULL OR count(*) > 1""")
def key_rules(t):
    """Lines that share a number or lack an order, balances that customers share."""
    lines = t("lineitem").select(F.when(F.col("l_orderkey") % 97 != 0, F.col("l_orderkey")).alias("k"), F.when(F.col("l_orderkey") % 10 == 3, 1).otherwise(F.col("l_linenumber")).alias("n"))
    return R.key_faults({"line": (lines, ["k", "n"]), "balance": (t("customer").select(X.floor_text(F.col("c_acctbal")).alias("b")), ["b"])})


@query("""SELECT 'nation' AS rule, '' || c_custkey AS id, 'no ' || (c_nationkey + 5) AS message FROM customer WHERE c_nationkey + 5 NOT IN (SELECT n_nationkey FROM nation)
    UNION ALL SELECT 'rich customer', '' || o_orderkey, 'no ' || o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def link_rules(t):
    """Customers of nations beyond the last, orders of customers without money."""
    rich = t("customer").where("c_acctbal > 0")
    return R.link_faults({"nation": (t("customer").withColumn("n", F.col("c_nationkey") + 5), "c_custkey", "n", t("nation"), "n_nationkey"), "rich customer": (t("orders"), "o_orderkey", "o_custkey", rich, "c_custkey")})


@query("""WITH n AS (SELECT n_nationkey AS id, CASE WHEN n_regionkey + 1 NOT IN (SELECT r_regionkey FROM region) THEN 'nation' END AS broken FROM nation),
    c AS (SELECT c_custkey AS id, CASE WHEN n.id IS NULL THEN 'customer' ELSE broken END AS broken FROM customer LEFT JOIN n ON n.id = CASE WHEN c_custkey % 31 = 0 THEN -1 ELSE c_nationkey END),
    o AS (SELECT o_orderkey AS id, CASE WHEN c.id IS NULL THEN 'order' ELSE broken END AS broken FROM orders LEFT JOIN c ON c.id = CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE o_custkey END)
    SELECT 'nation' AS "table", '' || id AS id, broken FROM n WHERE broken IS NOT NULL UNION ALL SELECT 'customer', '' || id, broken FROM c WHERE broken IS NOT NULL UNION ALL SELECT 'order', '' || id, broken FROM o WHERE broken IS NOT NULL""")
def chain_rules(t):
    """Regions, nations, customers and orders as one chain, broken at three of its links."""
    nation = t("nation").withColumn("up", F.col("n_regionkey") + 1)
    customer = t("customer").withColumn("up", F.when(F.col("c_custkey") % 31 == 0, -1).otherwise(F.col("c_nationkey")))
    orders = t("orders").withColumn("up", F.when(F.col("o_orderkey") % 53 != 0, F.col("o_custkey")))
    return R.chain_faults([("region", t("region"), "r_regionkey", None), ("nation", nation, "n_nationkey", "up"), ("customer", customer, "c_custkey", "up"), ("order", orders, "o_orderkey", "up")])


_PROPS = "p AS (SELECT event_id AS id, regexp_extract(props, '[0-9]+') AS k, event_type AS e FROM events)"


@query(f"""WITH {_PROPS} SELECT id, unnest(['K', 'list', 'list[0]', 'list[1]', 'list[1].Expected', 'list[1].site', 'list[1].deep', 'list[1].deep[0]', 'list[1].deep[0].x']) AS path,
    unnest(['k', 'list', NULL, NULL, 'expected', 'site', 'deep', NULL, 'x']) AS key, unnest([k, NULL, 'a', NULL, 'true', 'http://' || e || '.example', NULL, NULL, k || '.5']) AS value FROM p WHERE id % 2 = 0
    UNION ALL SELECT id, 'k', 'k', k FROM p WHERE id % 2 = 1""")
def json_members(t):
    """All members of nested JSON that is made of the events' properties."""
    return R.json_nodes(nested(t), "id", "j").drop("kind")


@query(f"""WITH {_PROPS} SELECT id, 'list[1].Expected' AS path, 'expected' AS found FROM p WHERE id % 2 = 0 UNION ALL SELECT id, 'list[1].site', 'http://' || e || '.example' FROM p WHERE id % 2 = 0""")
def json_leaks(t):
    """Names and addresses that must not be in what is delivered."""
    nodes = R.json_nodes(nested(t), "id", "j")
    return R.leaked_keys(nodes, ["EXPECTED", "golden"]).withColumnRenamed("key", "found").unionByName(R.leaked_urls(nodes, ["origin_url"]).withColumnRenamed("value", "found"))


def nested(t):
    k = F.regexp_extract("props", "[0-9]+", 0)
    deep = F.concat(F.lit('{"K": '), k, F.lit(', "list": ["a", {"Expected": true, "site": "http://'), "event_type", F.lit('.example", "deep": [{"x": '), k, F.lit(".5}]}]}"))
    return t("events").select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 2 == 0, deep).otherwise(F.col("props")).alias("j"))


@query("""SELECT p_brand AS wb, p_partkey AS nth, '' || p_partkey AS band, p_type AS sheet, CASE WHEN p_partkey % 5 = 0 THEN 'a "b" \\ c' || chr(10) || p_name WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END AS label, p_retailprice AS score,
    p_retailprice >= 1500 OR p_size = 7 AS include FROM part""")
def curation_files(t):
    """Curation files of brands, written and read again: labels of any kind, entries that a fallback includes."""
    label = F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit('a "b" \\ c\n'), "p_name")).when(F.col("p_partkey") % 7 != 0, F.col("p_name"))
    some = t("part").select(F.col("p_brand").alias("wb"), F.col("p_partkey").alias("rank"), F.col("p_partkey").cast("string").alias("band"), F.col("p_type").alias("sheet"), label.alias("label"), F.col("p_retailprice").alias("score"), "p_size")
    path = fresh_folder(some.sparkSession)
    S.write_curation(some.drop("p_size"), path, 1500.0, top=1 << 40, fallback=some.where("p_size = 7"))
    read = S.read_curation(some.sparkSession, path)
    return read.select("wb", F.col("band").cast("long").alias("nth"), "band", "sheet", F.nullif("label", F.lit("")).alias("label"), "score", "include")
