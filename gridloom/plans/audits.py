"""Leak checks, tagging and text clean-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit as A
from .registry import query

_T = "t AS (SELECT o_custkey AS book, o_orderkey, o_totalprice AS target FROM orders)"
_C = "c AS (SELECT o_custkey AS book, l_orderkey, l_linenumber, l_extendedprice AS value, l_returnflag = 'R' AS inside FROM lineitem JOIN orders ON l_orderkey = o_orderkey UNION ALL SELECT o_custkey, o_orderkey, 0, o_totalprice, o_orderstatus = 'F' FROM orders)"
#: A number's place among all of four significant digits, so 9999.6 and 10000.4 share one; its sign.
_KEY = "CAST(floor(log10(abs({0}))) * 9000 + floor(abs({0}) / pow(10.0, floor(log10(abs({0}))) - 3) + 0.5) AS BIGINT) AS k{1}, sign({0}) AS s{1}"


@query(f"""WITH {_T}, {_C}, a AS (SELECT *, {_KEY.format('value', '1')} FROM c WHERE value <> 0 AND NOT (value = floor(value) AND abs(value) < 10000)), b AS (SELECT *, {_KEY.format('target', '2')} FROM t WHERE target <> 0)
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, o_orderkey, value, target, CASE WHEN abs(value - target) <= 1e-12 * greatest(1.0, abs(target)) AND NOT inside THEN 'deny' ELSE 'suspect' END AS kind FROM a JOIN b ON a.book = b.book AND k1 = k2 AND s1 = s2""")
def pasted_answers(t):
    """Cells of a customer's book, lines and orders, that repeat one of its answers, the orders' totals."""
    orders = t("orders").select(F.col("o_custkey").alias("book"), "o_orderkey", "o_totalprice", (F.col("o_orderstatus") == "F").alias("inside"))
    targets = orders.select("book", "o_orderkey", F.col("o_totalprice").alias("target"))
    lines = t("lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), F.col("l_extendedprice").alias("value"), (F.col("l_returnflag") == "R").alias("inside"))
    cells = lines.join(orders.select("book", F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    cells = cells.unionByName(orders.select("book", F.col("o_orderkey").alias("l_orderkey"), F.lit(0).cast("long").alias("l_linenumber"), F.col("o_totalprice").alias("value"), "inside"))
    return A.leaks(cells, targets, by=["book"], inside="inside").select("l_orderkey", "l_linenumber", "o_orderkey", "value", "target", "kind")


@query("""WITH f AS (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9][0-9,]*(?:\\.[0-9]+)?%?')) AS x FROM documents), n AS (SELECT doc_id, CAST(regexp_replace(x, '[,%]', '', 'g') AS DOUBLE) AS v FROM f UNION ALL SELECT doc_id, CAST(regexp_replace(x, '[,%]', '', 'g') AS DOUBLE) / 100 FROM f WHERE x LIKE '%\\%' ESCAPE '\\')
    SELECT doc_id, count(*) AS n, max(v) AS top FROM n GROUP BY doc_id""")
def leak_text_numbers(t):
    return t("documents").select("doc_id", F.explode(A.numbers_in("text")).alias("v")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top"))


_FAMILIES = {"returns": ["return", "irr", "moic"], "debt": ["debt", "loan", "interest"], "licence": ["license", "rights reserved", "copyright"]}


@query("""WITH s AS (SELECT p_partkey, 3 * (lower(p_brand) = 'is' OR contains(lower(p_type), 'small'))::INT + contains(lower(p_name), 'small')::INT + 3 * contains(lower(p_type), 'plated')::INT + contains(lower(p_name), 'plated')::INT AS a,
    3 * (contains(lower(p_brand), '#1') AND lower(p_brand) = '#1' OR lower(p_type) = '#1')::INT + 3 * (contains(lower(p_type), 'large') OR contains(lower(p_brand), 'large'))::INT + contains(lower(p_name), 'large')::INT + 3 * (contains(lower(p_type), 'red') OR contains(lower(p_brand), 'red'))::INT AS b FROM part)
    SELECT p_partkey, 'fine' AS family, CAST(a AS BIGINT) AS score FROM s WHERE a > 0 UNION ALL SELECT p_partkey, 'coarse', CAST(b AS BIGINT) FROM s WHERE b > 0""")
def family_sheets(t):
    """Families by sheets' names, which count thrice, and by the text of cells: a part's brand and type as sheets, its name."""
    books = t("part").select("p_partkey", F.array("p_brand", F.concat(F.lit(" "), "p_type")).alias("sheets"), "p_name")
    return A.sheet_families(books, "p_partkey", "sheets", "p_name", {"fine": ["small", "plated"], "coarse": ["#1", "large", "red"]})


@query("""WITH s AS (SELECT doc_id, contains(lower(text), 'return')::INT + contains(lower(text), 'irr')::INT + contains(lower(text), 'moic')::INT AS a, contains(lower(text), 'debt')::INT + contains(lower(text), 'loan')::INT + contains(lower(text), 'interest')::INT AS b,
    contains(lower(text), 'license')::INT + contains(lower(text), 'rights reserved')::INT + contains(lower(text), 'copyright')::INT AS c FROM documents)
    SELECT doc_id, CASE WHEN greatest(a, b, c) < 1 THEN NULL WHEN a >= greatest(b, c) THEN 'returns' WHEN b >= c THEN 'debt' ELSE 'licence' END AS family, CAST(greatest(a, b, c) AS BIGINT) AS score FROM s""")
def family_tagging(t):
    return A.families(t("documents"), "doc_id", "text", _FAMILIES)


@query("""SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k, CASE WHEN event_id % 3 = 0 THEN 1500.0::DOUBLE ELSE NULL END AS big, CASE WHEN event_id % 3 = 0 THEN event_type || ': "x", {y' END AS said, CASE WHEN event_id % 3 = 0 THEN 4 ELSE 1 END AS pairs FROM events""")
def json_salvage(t):
    """Answers cut off in a string, in a number, or not at all; with repeated keys, exponents, quotes and nested values."""
    n = F.col("event_id") % 3
    k = F.concat(F.lit('"k": '), F.regexp_extract("props", "[0-9]+", 0))
    full = F.concat(F.lit('Here: ```json\n{"k": 0, "said": "'), "event_type", F.lit(': \\"x\\", {y", "big": 1.5e3, "more": {"k": [1, {"k": 2}]}, '), k, F.lit(', "cut": "in a stri'))
    text = F.when(n == 0, full).when(n == 1, F.concat(F.lit("{"), k, F.lit(', "cut": 12'))).otherwise(F.col("props"))
    get = lambda c: F.try_element_at("m", F.lit(c))
    m = t("events").select("event_id", A.salvaged(text).alias("m"))
    return m.select("event_id", get("k").cast("double").alias("k"), get("big").cast("double").alias("big"), get("said").alias("said"), F.size("m").alias("pairs"))


@query("""SELECT conv_id, turn, trim(text) AS body, trim(regexp_replace(lower(role || ' / ' || conv_id || '!'), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM conversations""")
def fence_strip(t):
    return t("conversations").select("conv_id", "turn", A.unfenced(F.concat(F.lit("```json\n"), "text", F.lit("\n```"))).alias("body"), A.slug(F.concat("role", F.lit(" / "), "conv_id", F.lit("!"))).alias("slug"))


@query("""WITH r AS (SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN 'blank' WHEN length(text) < 100 THEN 'short' WHEN regexp_matches(text, '[$%&]{3}') THEN 'symbols' WHEN text = upper(text) THEN 'capitals' ELSE 'kept' END AS code FROM documents)
    SELECT code, count(*) AS n, min(doc_id) AS first FROM r GROUP BY code""")
def exclusion_histogram(t):
    x = F.col("text")
    code = F.when(x.isNull() | (x == ""), "blank").when(F.length(x) < 100, "short").when(x.rlike("[$%&]{3}"), "symbols").when(x == F.upper(x), "capitals").otherwise("kept")
    return t("documents").groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))


@query("""SELECT d.doc_id, min(b.item_id) AS item FROM documents d JOIN benchmark b ON contains(d.text, b.text) GROUP BY 1""")
def leak_benchmark(t):
    """The least benchmark item that each text contains."""
    return A.contained(t("documents"), "doc_id", "text", t("benchmark"), "item_id", "text").withColumnRenamed("found", "item")
