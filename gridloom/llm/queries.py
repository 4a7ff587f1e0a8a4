"""Queries of this subpackage, each over its whole table with production parameters, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .exact_dedup import exact_dedup
from .html_extract import extract
from .language_model import perplexity_quality
from .line_dedup import drop_boilerplate
from .lloyd import lloyd
from .minhash import near_duplicates
from .mixing import mix
from .packing import pack_documents
from .quality_rules import quality_rules
from .secret_scan import find_secrets
from .sstable import encode_to_shards
from .toxicity import toxicity
from .vantage import hard_negatives

#: Sources are mixed in proportion to their size to this power.
MIX_POWER, MIX_SEED = 0.7, 0
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the machine has a public tokenizer's file; it is at the same place on every executor."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # whole texts can be long: Python workers get them in batches of bounded size
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sstable_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_to_shards(read_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=0)


def op2_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"), power=MIX_POWER, seed=MIX_SEED)


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), width=4, percent=80)


def op4_recurrent_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op6_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2, capacity=1024)


def op9_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"), keep="largest")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read_table(spark, sf_dir, "documents"))


def op12_lloyd_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd(read_table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256, seed=2)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0, positives=5, negatives=10, low=30, high=90, scale=256)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sstable_shards, op2_poisson_mixing, op3_minhash_near_dedup, op4_recurrent_block_labeller, op5_line_dedup, op6_toxicity_chain, op7_quality_rules, op8_sum_of_squares_packing, op9_kneser_ney_quality, op10_exact_dedup, op11_secret_scan, op12_lloyd_clusters, op13_hard_negatives)}


#: The least k whose cumulative Poisson probability reaches u: one for each table entry below it.
_MIX_SQL = """
    WITH RECURSIVE sizes AS (SELECT source, count(*) AS size FROM documents GROUP BY source),
    rates AS (SELECT source, CAST(pow(CAST(size AS DOUBLE), 0.7) / sum(pow(CAST(size AS DOUBLE), 0.7)) OVER () * sum(size) OVER () / size AS DOUBLE) AS rate FROM sizes),
    cdf AS (
        SELECT source, rate, 0 AS k, -rate AS lp, exp(-rate) AS total FROM rates
        UNION ALL
        SELECT source, rate, k + 1, lp + ln(rate) - ln(CAST(k + 1 AS DOUBLE)), total + exp(lp + ln(rate) - ln(CAST(k + 1 AS DOUBLE))) FROM cdf WHERE k + 1 <= ceil(rate + 12 * sqrt(rate)) + 24),
    tables AS (SELECT source, list(total ORDER BY k) AS t FROM cdf GROUP BY source),
    counted AS (
        SELECT d.*, len(list_filter(t, lambda c: c < (CAST('0x' || substr(md5('0:count|' || d.doc_id), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)) AS n
        FROM documents d JOIN tables s ON d.source IS NOT DISTINCT FROM s.source),
    copies AS (SELECT doc_id, text, lang, source, n_chars, unnest(range(n)) AS copy FROM counted)
    SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
           CAST('0x' || substr(md5('0:order|' || doc_id || '|' || copy), 1, 13) AS BIGINT) AS shuffle_key
    FROM copies"""

_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"

#: Matches with their places, samples out of them, pairs of characters counted, runs scored by whole thousandths of nats.
_SECRET_SQL = rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    a AS (SELECT doc_id, t, string_split_regex(t, '{_ASSIGN}') AS gaps, regexp_extract_all(t, '{_ASSIGN}') AS ms FROM d),
    free AS (SELECT doc_id, array_to_string(list_transform(range(1, len(gaps) + 1), lambda i: gaps[i] || CASE WHEN i > len(ms) THEN '' WHEN length(regexp_extract(ms[i], '{_ASSIGN}', 2)) >= 6 THEN repeat(' ', length(ms[i])) ELSE ms[i] END), '') AS t FROM a),
    m AS (
        SELECT doc_id, 0 AS kind, gaps, ms FROM a
        UNION ALL SELECT doc_id, 1, string_split_regex(t, 'AKIA[A-Z0-9]{{16,}}'), regexp_extract_all(t, 'AKIA[A-Z0-9]{{16,}}') FROM d
        UNION ALL SELECT doc_id, 2, string_split_regex(t, '[0-9a-f]{{24,}}'), regexp_extract_all(t, '[0-9a-f]{{24,}}') FROM d
        UNION ALL SELECT doc_id, 3, string_split_regex(t, '[A-Za-z0-9+/_.=-]{{12,}}'), regexp_extract_all(t, '[A-Za-z0-9+/_.=-]{{12,}}') FROM free),
    x AS (SELECT doc_id, kind, unnest(ms) AS m, unnest(gaps[:len(ms)]) AS gap, generate_subscripts(ms, 1) AS nth FROM m WHERE len(ms) > 0),
    p AS MATERIALIZED (SELECT doc_id, kind, m, length(m) AS size, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY nth) AS e, CASE WHEN kind = 0 THEN regexp_extract(m, '{_ASSIGN}', 2) ELSE m END AS v FROM x),
    made AS (SELECT unnest([rtrim(to_base64(unhex(sha256('base64:' || i))), '='), upper(sha256('hex:' || i)), regexp_replace(to_base64(unhex(sha256('letters:' || i))), '[+/=]', '', 'g')]) AS v, true AS random FROM range(2000) r(i)),
    samples AS (
        SELECT DISTINCT v, true AS random FROM p WHERE kind IN (1, 2) OR kind = 0 AND length(v) >= 6 AND regexp_matches(v, '[0-9]')
        UNION ALL SELECT DISTINCT v, false FROM p WHERE kind = 3 AND regexp_matches(v, '^[A-Za-z+/_.=-]+[0-9]{{0,4}}$|^[0-9+/_.=-]+$')
        UNION ALL SELECT v, random FROM made),
    pairs AS (SELECT random, CASE WHEN i % 1024 = 1 THEN ' ' ELSE v[i - 1] END AS a, v[i] AS b FROM (SELECT random, v, unnest(range(1, length(v) + 1)) AS i FROM samples)),
    letters AS (SELECT unnest(string_split('{_ALPHABET}', '')) AS b),
    counts AS (SELECT random, a, b, count(*) AS n FROM pairs GROUP BY ALL),
    grid AS (SELECT g.random, g.a, g.b, coalesce(c.n, 0) AS n
        FROM (SELECT random, x.b AS a, y.b FROM (SELECT b FROM letters UNION ALL SELECT ' ') x, letters y, (SELECT unnest([true, false]) AS random)) g
        LEFT JOIN counts c ON c.random = g.random AND c.a = g.a AND c.b = g.b),
    overall AS (SELECT random, b, (sum(n) + 1) / (sum(sum(n)) OVER (PARTITION BY random) + 67) AS share FROM grid GROUP BY random, b),
    logs AS (SELECT g.random, g.a, g.b, ln((g.n + 20.0 * share) / (sum(g.n) OVER (PARTITION BY g.random, g.a) + 20.0)) AS l FROM grid g JOIN overall o ON o.random = g.random AND o.b = g.b),
    ratios AS (SELECT r.a, r.b, floor(1000 * (r.l - o.l) + 0.5) AS ratio FROM logs r JOIN logs o ON r.random AND NOT o.random AND r.a = o.a AND r.b = o.b),
    runs AS (SELECT DISTINCT v FROM p WHERE kind = 3 AND size >= 16 AND NOT regexp_matches(v, 'AKIA[A-Z0-9]{{16,}}') AND NOT regexp_matches(v, '[0-9a-f]{{24,}}')),
    steps AS (SELECT v, CASE WHEN i % 1024 = 1 THEN ' ' ELSE v[i - 1] END AS a, v[i] AS b FROM (SELECT v, unnest(range(1, length(v) + 1)) AS i FROM runs)),
    secret AS (SELECT v FROM steps JOIN ratios USING (a, b) GROUP BY v HAVING sum(ratio) > 10000),
    kept AS (SELECT doc_id, kind, e - size AS s, e FROM p WHERE kind IN (1, 2) OR kind = 0 AND length(v) >= 6 OR kind = 3 AND v IN (SELECT v FROM secret)),
    said AS (SELECT *, ['assign', 'access', 'hex', 'markov'][kind + 1] || ':' || s || ':' || e AS z FROM kept)
    SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
           sha256(coalesce(string_agg(z, ',' ORDER BY s, kind) FILTER (kind < 3), '')) AS base_sha256, coalesce(string_agg(z, ',' ORDER BY s, kind), '') AS spans
    FROM d LEFT JOIN said k ON k.doc_id = d.doc_id GROUP BY d.doc_id"""


def _lloyd_sql(rounds: int) -> str:
    """Each round as two tables: vectors with their nearest centroid, and the centroids after it."""
    at = lambda r: f"SELECT vec_id, any_value(v) AS v, min(b) AS b FROM (SELECT vec_id, v, {{'d': list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i]))), 'c': c}} AS b FROM kept, c{r}) GROUP BY vec_id"
    steps = [
        f"""a{r} AS MATERIALIZED ({at(r)}),
    c{r + 1} AS MATERIALIZED (
        SELECT c, list(m ORDER BY i) AS m FROM (SELECT b.c AS c, i, CAST((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m FROM a{r}, range(1, 65) r(i) GROUP BY 1, 2) GROUP BY c
        UNION ALL SELECT c, m FROM c{r} WHERE c NOT IN (SELECT b.c FROM a{r}))"""
        for r in range(rounds)
    ]
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v AS m FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT 40)),
    {", ".join(steps)},
    last AS MATERIALIZED ({at(rounds)})
    SELECT vec_id, CAST(b.c AS INTEGER) AS cluster, CAST(b.d AS BIGINT) AS distance, CAST(sum(b.d) OVER (PARTITION BY b.c) AS BIGINT) AS cluster_inertia,
           CAST(sum(b.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
    FROM last JOIN c{rounds} ON c{rounds}.c = b.c"""


ORACLE_SQL = {
    "op11_secret_scan": _SECRET_SQL,
    "op12_lloyd_clusters": _lloyd_sql(5),
    "op13_hard_negatives": """
        WITH v AS MATERIALIZED (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS MATERIALIZED (SELECT a.vec_id AS anchor, o.vec_id AS other, a.label = o.label AS same, CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * o.v[i])) AS BIGINT) AS score
            FROM v a JOIN v o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id),
        p AS (SELECT anchor, other AS positive, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
        SELECT p.anchor AS anchor_id, positive AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, p.score AS positive_score, s.score AS negative_score
        FROM p JOIN s ON s.anchor = p.anchor AND NOT same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
        WINDOW w AS (PARTITION BY p.anchor, positive ORDER BY s.score DESC, other) QUALIFY rank <= 10""",
    "op2_poisson_mixing": _MIX_SQL,
    "op5_line_dedup": """
        WITH l AS (SELECT source, unnest(list_distinct(string_split(text, chr(10)))) AS line FROM documents),
        c AS (SELECT source, line, count(*) AS n FROM l WHERE regexp_matches(line, '\\S') GROUP BY ALL),
        t AS (SELECT source, count(*) AS total FROM documents GROUP BY ALL),
        b AS (SELECT c.source, list(line) AS bad FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
              WHERE n >= 3 AND n * 100 > total * 2 GROUP BY c.source),
        s AS (SELECT d.doc_id, d.source, string_split(text, chr(10)) AS lines, coalesce(bad, []) AS bad
              FROM documents d LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source)
        SELECT doc_id, source, array_to_string(list_filter(lines, lambda x: NOT list_contains(bad, x)), chr(10)) AS text,
               len(lines) AS n_lines, len(lines) - len(list_filter(lines, lambda x: NOT list_contains(bad, x))) AS n_dropped_lines
        FROM s""",
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
}
