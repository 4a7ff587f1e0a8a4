"""The record service's queries on documents, parts and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import records as R
from .registry import query


@query("""SELECT doc_id, len(regexp_extract_all(lower(text), '[a-z0-9.]+')) AS n, contains('|' || array_to_string(regexp_extract_all(lower(text), '[a-z0-9.]+'), '|') || '|', '|of|the|') AS hit,
    contains('|' || array_to_string(regexp_extract_all(lower(text), '[a-z0-9.]+'), '|') || '|', '|and|') AS word FROM documents""")
def token_match(t):
    d = t("documents").withColumn("k", X.tokens("text"))
    return d.select("doc_id", F.size("k").cast("long").alias("n"), X.contains_tokens(F.col("k"), X.tokens(F.lit("Of the"))).alias("hit"), X.contains_tokens(F.col("k"), X.tokens(F.lit("AND"))).alias("word"))


@query("""WITH k AS (SELECT doc_id, text, regexp_extract_all(lower(source || ' ' || lang), '[a-z0-9.]+') AS t, list_distinct(regexp_extract_all(lower(text), '[a-z0-9.]+')) AS c FROM documents),
    s AS (SELECT doc_id AS id, text, round(CAST(4 * list_contains(t, 'src3')::INT + 4 * 2 * list_contains(t, 'en')::INT + list_contains(c, 'src3')::INT + 2 * list_contains(c, 'en')::INT AS DOUBLE) - log2(CAST(greatest(2, len(c)) AS DOUBLE)) / 12, 6) AS score,
        4 * list_contains(t, 'src3')::INT + 8 * list_contains(t, 'en')::INT + list_contains(c, 'src3')::INT + 2 * list_contains(c, 'en')::INT AS h FROM k)
    SELECT id, score, substr(text, 1, 300) AS snippet FROM s WHERE h > 0 ORDER BY score DESC, id LIMIT 50""")
def search_rank(t):
    d = t("documents").withColumn("title", F.concat_ws(" ", "source", "lang"))
    return R.search(d, "src3 EN en", "doc_id", "title", "text")


@query("""WITH k AS (SELECT p_brand, p_partkey, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) - 1 AS i, count(*) OVER (PARTITION BY p_brand) AS total FROM part)
    SELECT p_brand, p_partkey, p_name, total, CASE WHEN total > 10 THEN CAST(10 AS BIGINT) END AS next_cursor FROM k WHERE i >= 5 AND i < 10""")
def page_query(t):
    return R.page(t("part"), ["p_brand"], ["p_retailprice", "p_partkey"], 5).select("p_brand", "p_partkey", "p_name", "total", "next_cursor")


@query("SELECT p_partkey, p_name FROM part WHERE contains('|' || array_to_string(regexp_extract_all(lower(p_name), '[a-z0-9.]+'), '|') || '|', '|ring|') AND contains('|' || array_to_string(regexp_extract_all(lower(p_type), '[a-z0-9.]+'), '|') || '|', '|small|')")
def filtered_records(t):
    return R.with_tokens(t("part"), p_name="Ring", p_type="small").select("p_partkey", "p_name")


_REL = "r AS (SELECT *, lead(event_id) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS superseded_by FROM events)"


@query(f"WITH {_REL} SELECT user_id, event_type, event_id, value FROM r WHERE superseded_by IS NULL")
def supersession_current(t):
    return R.superseded(t("events"), ["user_id", "event_type"], ["ts", "event_id"], "event_id").where("superseded_by is null").select("user_id", "event_type", "event_id", "value")


@query(f"""WITH {_REL}, b AS (SELECT user_id, event_type, event_id, CASE WHEN event_id % 50 = 0 THEN -1 WHEN event_id % 51 = 0 THEN NULL ELSE superseded_by END AS s FROM r)
    SELECT x.user_id, x.event_type, count(*) AS releases, count(*) FILTER (x.s IS NULL) AS current, count(*) FILTER (x.s IS NOT NULL AND y.event_id IS NULL) AS dangling
    FROM b x LEFT JOIN b y ON x.user_id = y.user_id AND x.event_type = y.event_type AND x.s = y.event_id GROUP BY 1, 2 HAVING current <> 1 OR dangling > 0""")
def chain_check(t):
    r = R.superseded(t("events"), ["user_id", "event_type"], ["ts", "event_id"], "event_id")
    i = F.col("event_id")
    broken = r.withColumn("superseded_by", F.when(i % 50 == 0, F.lit(-1)).when(i % 51 == 0, None).otherwise(F.col("superseded_by")))
    return R.chain_faults(broken.select("user_id", "event_type", "event_id", "superseded_by"), ["user_id", "event_type"], "event_id")


@query("SELECT user_id, event_type, count(DISTINCT value) AS kinds FROM events GROUP BY ALL HAVING count(DISTINCT value) >= 2")
def conflict_metrics(t):
    return R.conflicts(t("events"), ["user_id", "event_type"], "value")


@query("""SELECT event_id, CASE WHEN abs(o - value) > 10 * greatest(1e-6, 1e-6 * abs(value)) THEN round(o, 6) ELSE round(value + greatest(0.05 * abs(value), 20 * greatest(1e-6, 1e-6 * abs(value))), 6) END AS other,
    'rec_' || substr(sha256(user_id || '|' || event_type), 1, 12) AS rid FROM (SELECT *, round(value * [0.9, 1.1, 0.96, 1.04, 0.75, 1.25][event_id % 6 + 1], 12) AS o FROM events)""")
def distractors(t):
    return t("events").select("event_id", F.round(R.perturbed("event_id", "value"), 6).alias("other"), R.stable_id("rec", F.col("user_id").cast("string"), "event_type").alias("rid"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 3) GROUP BY ALL")
def foreign_key_faults(t):
    known = t("part").where("p_size > 3").select(F.col("p_partkey").alias("l_partkey"))
    return t("lineitem").join(known, "l_partkey", "left_anti").select("l_orderkey", "l_linenumber").distinct()


@query("SELECT o_custkey, add_months AS n, CAST(CAST(CAST(o_orderdate AS DATE) + to_months(CAST(3 * add_months AS INTEGER)) AS DATE) AS VARCHAR) AS release FROM (SELECT o_custkey, min(o_orderdate) AS o_orderdate FROM orders GROUP BY 1), (SELECT unnest(range(4)) AS add_months)")
def release_dates(t):
    first = t("orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("d"))
    return first.select("o_custkey", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("n"), "d").withColumn("n", F.col("n").cast("long")).select("o_custkey", "n", X.date_of(X.edate(X.serial("d"), F.col("n") * 3)).cast("string").alias("release"))


@query("""WITH r AS (SELECT p_brand AS dataset_id, p_partkey AS id, p_name AS metric, p_type AS unit, 'size ' || p_size AS entity FROM part),
    q AS (SELECT c_custkey AS request, 'Brand#' || (1 + c_custkey % 30) AS dataset_id, CASE c_custkey % 4 WHEN 0 THEN 'ring' WHEN 1 THEN 'widget' WHEN 2 THEN '--' ELSE 'alias ' || (c_custkey % 5) END AS metric, CASE c_custkey % 3 WHEN 0 THEN 'Small' WHEN 1 THEN 'Large' ELSE '' END AS unit, c_custkey % 3 AS cursor FROM customer),
    h AS (SELECT request, id, q.cursor, row_number() OVER (PARTITION BY request ORDER BY id) AS i, count(*) OVER (PARTITION BY request) AS total FROM q JOIN r ON q.dataset_id = r.dataset_id
        AND (contains('|' || array_to_string(regexp_extract_all(lower(r.metric), '[a-z0-9.]+'), '|') || '|', '|' || array_to_string(regexp_extract_all(lower(q.metric), '[a-z0-9.]+'), '|') || '|') OR q.metric = 'alias ' || (id % 5))
        AND contains('|' || array_to_string(regexp_extract_all(lower(r.unit), '[a-z0-9.]+'), '|') || '|', '|' || lower(q.unit) || '|') WHERE q.unit <> '' AND q.metric <> '--'),
    p AS (SELECT request, any_value(total) AS total, string_agg(id, ',' ORDER BY id) FILTER (i > cursor AND i <= cursor + 3) AS rows, count(*) FILTER (i > cursor AND i <= cursor + 3) AS n FROM h GROUP BY 1),
    e AS (SELECT request, cursor, CASE WHEN q.dataset_id NOT IN (SELECT dataset_id FROM r) THEN 'unknown dataset' WHEN q.metric = '--' THEN 'a filter without letters or digits' WHEN unit = '' THEN 'too few filters' END AS error FROM q)
    SELECT request, error, CASE WHEN error IS NULL THEN coalesce(rows, '') END AS rows, CASE WHEN error IS NULL THEN coalesce(total, 0) END AS total, CASE WHEN error IS NULL AND cursor + coalesce(n, 0) < coalesce(total, 0) THEN CAST(cursor + n AS BIGINT) END AS next_cursor FROM e LEFT JOIN p USING (request)""")
def record_requests(t):
    """Requests of customers to the parts of a brand, by name or alias and type, three rows a page."""
    records = t("part").select(F.col("p_brand").alias("dataset_id"), F.col("p_partkey").alias("id"), F.col("p_name").alias("metric"), F.col("p_type").alias("unit"), F.concat(F.lit("size "), "p_size").alias("entity"), F.array(F.concat(F.lit("alias "), F.col("p_partkey") % 5)).alias("metric_aliases"))
    k = F.col("c_custkey")
    metric = F.when(k % 4 == 0, "ring").when(k % 4 == 1, "widget").when(k % 4 == 2, "--").otherwise(F.concat(F.lit("alias "), k % 5))
    unit = F.when(k % 3 == 0, "Small").when(k % 3 == 1, "Large").otherwise("")
    requests = t("customer").select(k.alias("request"), F.concat(F.lit("Brand#"), 1 + k % 30).alias("dataset_id"), F.create_map(F.lit("metric"), metric, F.lit("unit"), unit).alias("filters"), (k % 3).alias("cursor"), F.lit(3).alias("limit"))
    out = R.answered(requests, records, records.select("dataset_id"), ["metric", "unit", "entity"])
    return out.withColumn("rows", F.array_join(F.transform("rows", lambda x: x.cast("string")), ","))
