"""The dimensional record service: token filters, ranked search, pages, supersession, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as X
from .graph import settled


def with_tokens(df: DataFrame, **filters: str) -> DataFrame:
    """The rows whose columns contain each filter's tokens one after another. At least two filters with tokens are asked for."""
    active = {c: v for c, v in filters.items() if v}
    if len(active) < 2:
        raise ValueError("at least two filters are needed")
    for c, v in active.items():
        df = df.where(X.contains_tokens(X.tokens(c), X.tokens(F.lit(v))))
    return df


def search(docs: DataFrame, text: str, id_col: str, title_col: str, content_col: str, limit: int = 50) -> DataFrame:
    """(id, score, snippet) of the best documents: 4 for a query token in the title, 1 in the content, less a length term.

    Repeated query tokens count again. Documents without a hit are left out; ties go by id; 50 rows at most.
    """
    import re

    wanted = re.findall("[a-z0-9.]+", text.lower())
    # texts without any of the words as whole ones, which one pass over them shows, are not split
    words = "|".join(re.escape(w) for w in dict.fromkeys(wanted)) or r"\b\B"
    whole = rf"(?:^|[^a-z0-9.])(?:{words})(?:[^a-z0-9.]|$)"
    maybe = lambda c: F.lower(F.coalesce(F.col(c), F.lit(""))).rlike(whole)
    docs = docs.where(maybe(title_col) | maybe(content_col)).select(F.col(id_col).alias("id"), F.coalesce(content_col, F.lit("")).alias("content"), X.tokens(title_col).alias("_t"), F.array_distinct(X.tokens(content_col)).alias("_c"))
    hits = F.lit(0.0)
    for w in wanted:
        hits = hits + F.when(F.array_contains("_t", w), 4.0).otherwise(0.0) + F.when(F.array_contains("_c", w), 1.0).otherwise(0.0)
    scored = docs.withColumn("_h", hits).where("_h > 0").withColumn("score", F.round(F.col("_h") - F.log2(F.greatest(F.lit(2), F.size("_c")).cast("double")) / 12, 6))
    return scored.select("id", "score", F.substring("content", 1, 300).alias("snippet")).orderBy(F.desc("score"), "id").limit(min(max(limit, 1), 50))


def page(df: DataFrame, by: list[str], order: list[str], cursor: int, size: int = 5) -> DataFrame:
    """Of each group the rows from cursor on, size at most, with total and next_cursor (null on the last page)."""
    # a task keeps the first cursor + size rows of a group before the shuffle; totals are counted apart
    first = df.withColumn("_i", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("_i") <= cursor + size).where(F.col("_i") > cursor)
    some = first.join(df.groupBy(*by).agg(F.count(F.lit(1)).alias("total")), by)
    return some.withColumn("next_cursor", F.when(F.col("total") > cursor + size, F.lit(cursor + size).cast("long"))).drop("_i")


def superseded(df: DataFrame, by: list[str], order: list[str], id_col: str) -> DataFrame:
    """df with superseded_by: the id of the next release in its group, null for the current one."""
    return df.withColumn("superseded_by", F.lead(id_col).over(W.partitionBy(*by).orderBy(*order)))


def chain_faults(releases: DataFrame, by: list[str], id_col: str) -> DataFrame:
    """(by, releases, current, dangling): groups with other than one current release, or with a link to none of its own."""
    known = releases.select(*by, F.col(id_col).alias("superseded_by"), F.lit(True).alias("_known"))
    joined = releases.join(known, [*by, "superseded_by"], "left")
    out = joined.groupBy(*by).agg(F.count(F.lit(1)).alias("releases"), F.count_if(F.col("superseded_by").isNull()).alias("current"), F.count_if(F.col("superseded_by").isNotNull() & F.col("_known").isNull()).alias("dangling"))
    return out.where("current <> 1 or dangling > 0")


def chain_ends(links: DataFrame, id_col: str, next_col: str, most: int = 64) -> DataFrame:
    """(id, end, steps, ends): where each record's chain of successors ends and after how many steps; ends is false for a
    chain that goes round in a circle or leaves the records.

    Every round doubles the steps that a pointer makes, so a chain of n records takes about log2(n) joins by id.
    """
    at = settled(links.select(F.col(id_col).alias("id"), F.col(next_col).alias("next"), F.col(next_col).isNotNull().cast("long").alias("steps")))
    end = settled(at.select("id", F.coalesce("next", "id").alias("end"), "steps", F.col("next").isNull().alias("done"), F.lit(False).alias("gone")))
    n = end.count()
    for k in range(most):
        if end.where("not done and not gone").isEmpty() or 2**k > 2 * n:
            break
        there = end.select(F.col("id").alias("end"), F.col("end").alias("_end"), F.col("steps").alias("_steps"), F.col("done").alias("_done"), F.col("gone").alias("_gone"))
        j = end.join(there, "end", "left")
        on = ~F.col("done") & F.col("_end").isNotNull()
        end = settled(j.select("id", F.when(on, F.col("_end")).otherwise(F.col("end")).alias("end"), F.when(on, F.col("steps") + F.col("_steps")).otherwise(F.col("steps")).alias("steps"), (F.col("done") | (on & F.col("_done"))).alias("done"), (F.col("gone") | (~F.col("done") & F.col("_end").isNull()) | (on & F.col("_gone"))).alias("gone")))
    return end.select("id", F.when(F.col("done"), F.col("end")).alias("end"), F.when(F.col("done"), F.col("steps")).alias("steps"), F.col("done").alias("ends"))


def pages(df: DataFrame, by: list[str], order: list[str], size: int = 5) -> DataFrame:
    """All pages of all groups: df with cursor (where its page begins), total and next_cursor."""
    k = W.partitionBy(*by)
    numbered = df.withColumn("_i", F.row_number().over(k.orderBy(*order)) - 1).withColumn("total", F.count(F.lit(1)).over(k))
    cursor = (F.floor(F.col("_i") / size) * size).cast("long")
    return numbered.withColumn("cursor", cursor).withColumn("next_cursor", F.when(F.col("cursor") + size < F.col("total"), F.col("cursor") + size)).drop("_i")


def drain_faults(paged: DataFrame, by: list[str], id_col: str, size: int = 5) -> DataFrame:
    """Groups whose pages don't add up: an id twice, another number of rows than total, a page too long, or other than one
    last page."""
    one = paged.groupBy(*by, "cursor").agg(F.count(F.lit(1)).alias("_rows"), F.min("next_cursor").alias("_next"))
    shape = one.groupBy(*by).agg(F.max("_rows").alias("longest"), F.count_if(F.col("_next").isNull()).alias("last_pages"))
    rows = paged.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(id_col).alias("ids"), F.max("total").alias("total"))
    return rows.join(shape, by).where((F.col("rows") != F.col("ids")) | (F.col("rows") != F.col("total")) | (F.col("longest") > size) | (F.col("last_pages") != 1))


def orphans(df: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """The rows of df whose key no row of parents has."""
    return df.join(parents.select(key).distinct(), key, "left_anti")


def guarded(distractors: DataFrame, answers: DataFrame, value: str, key: list[str]) -> DataFrame:
    """Distractors without those that repeat an answer of their key: no made-up record may be right by chance."""
    return distractors.join(answers.select(*key, value).distinct(), [*key, value], "left_anti")


def conflicts(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, kinds): groups in which the value differs."""
    return df.groupBy(*by).agg(F.count_distinct(value).alias("kinds")).where("kinds >= 2")


def perturbed(index, value):
    """A deterministic distractor of a number: one of six factors by index, an added amount where that is too close."""
    index = F.pmod(F.col(index) if isinstance(index, str) else index, F.lit(6))
    value = F.col(value) if isinstance(value, str) else value
    # fixed values: the factors in order of index
    factors = [0.9, 1.1, 0.96, 1.04, 0.75, 1.25]
    factor = F.element_at(F.array(*(F.lit(x) for x in factors)), (index + 1).cast("int"))
    floor = 10 * F.greatest(F.lit(1e-6), 1e-6 * F.abs(value))
    out = F.round(value * factor, 12)
    return F.when(F.abs(out - value) > floor, out).otherwise(value + F.greatest(0.05 * F.abs(value), 2 * floor))


def stable_id(prefix: str, *parts):
    """prefix and the first 12 digits of the SHA-256 of the parts between bars."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 12))


def listed(rows: DataFrame, order: str, limit: int = 20, **filters: str) -> DataFrame:
    """The first rows whose columns contain each given filter's tokens, from 1 to 100 of them; an empty filter is none."""
    for c, v in filters.items():
        if v:
            rows = rows.where(X.contains_tokens(X.tokens(c), X.tokens(F.lit(v))))
    return rows.orderBy(order).limit(max(1, min(limit, 100)))


def fetched(asked: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """asked (id_col, …) with the documents of those ids, and error where there is none."""
    there = docs.withColumn("_there", F.lit(True))
    return asked.join(there, id_col, "left").withColumn("error", F.when(F.col("_there").isNull(), F.concat(F.lit("unknown id: "), F.coalesce(F.col(id_col).cast("string"), F.lit("none"))))).drop("_there")


def answered(requests: DataFrame, records: DataFrame, datasets: DataFrame, fields: list[str], size: int = 5, least: int = 2) -> DataFrame:
    """(request, error, rows, total, next_cursor) of many requests at once: the ids of the page that each asks for, in order.

    requests: (request, dataset_id, filters, cursor, limit), filters a map of texts by field; records: (dataset_id, id, fields,
    metric_aliases); datasets: (dataset_id). A record is meant if each of its fields contains the filter's tokens one after
    another; an alias of the metric will do for the metric. An unknown dataset, a filter without letters or digits and
    fewer than least filters are errors. Requests with the same filters are one question, which meets records by dataset,
    field and the first token of its first filter; its hits are numbered once, and each page takes its rows by number.
    """
    known = datasets.select("dataset_id").distinct().withColumn("_known", F.lit(True))
    wants = {f: F.coalesce(F.try_element_at("filters", F.lit(f)), F.lit("")) for f in fields}
    active = F.filter(F.array(*(F.struct(F.lit(f).alias("field"), X.tokens(w).alias("want"), (w != "").alias("on")) for f, w in wants.items())), lambda x: x["on"])
    asked = requests.join(known, "dataset_id", "left").withColumn("_active", active)
    error = F.when(F.col("_known").isNull(), "unknown dataset").when(F.exists("_active", lambda x: F.size(x["want"]) == 0), "a filter without letters or digits").when(F.size("_active") < least, "too few filters")
    asked = settled(asked.select("request", "dataset_id", error.alias("error"), "_active", F.to_json("_active").alias("_question"), F.greatest(F.lit(0), F.coalesce("cursor", F.lit(0))).alias("cursor"), F.greatest(F.lit(1), F.least(F.coalesce("limit", F.lit(size)), F.lit(size))).alias("limit")))
    said = {f: F.transform(F.array(F.col(f)) if f != "metric" else F.concat(F.array(F.col(f)), F.coalesce(F.col("metric_aliases"), F.array().cast("array<string>"))), lambda x: X.tokens(x)) for f in fields}
    rows = settled(records.select("dataset_id", "id", F.array(*(F.struct(F.lit(f).alias("field"), s.alias("have")) for f, s in said.items())).alias("_said")))
    keys = rows.select("dataset_id", "id", F.explode("_said").alias("_s")).select("dataset_id", "id", F.col("_s.field").alias("_field"), F.explode(F.array_distinct(F.flatten("_s.have"))).alias("_token"))
    one = ["dataset_id", "_question"]
    near = questions(asked).join(keys, ["dataset_id", "_field", "_token"]).select(*one, "_active", "id").join(rows, ["dataset_id", "id"])
    meant = F.forall("_active", lambda a: F.exists("_said", lambda s: (s["field"] == a["field"]) & F.exists(s["have"], lambda have: X.contains_tokens(have, a["want"]))))
    hits = settled(near.where(meant).select(*one, "id").withColumn("_i", F.row_number().over(W.partitionBy(*one).orderBy("id"))))
    totals = settled(hits.groupBy(*one).agg(F.max("_i").cast("long").alias("total")))
    # a page is at most size places long, and pages that are asked for again are made once
    views = asked.where("error is null").select(*one, "cursor", "limit").distinct()
    places = views.withColumn("_i", F.explode(F.sequence(F.col("cursor").cast("long") + 1, F.col("cursor").cast("long") + F.col("limit"))))
    pages = settled(places.join(hits, [*one, "_i"]).groupBy(*one, "cursor", "limit").agg(F.sort_array(F.collect_list("id")).alias("rows")))
    out = asked.join(totals, one, "left").join(pages, [*one, "cursor", "limit"], "left")
    total = F.when(F.col("error").isNull(), F.coalesce("total", F.lit(0).cast("long")))
    rows_of = F.when(F.col("error").isNull(), F.coalesce("rows", F.array().cast(pages.schema["rows"].dataType)))
    end = (F.col("cursor") + F.size(rows_of)).cast("long")
    return out.select("request", "error", rows_of.alias("rows"), total.alias("total"), F.when(end < total, end).alias("next_cursor"))


def questions(asked: DataFrame) -> DataFrame:
    """(dataset_id, _question, _active, _field, _token): what is asked without errors, each once, however many ask it."""
    first = F.col("_active")[0]
    good = asked.where("error is null").groupBy("dataset_id", "_question").agg(F.any_value("_active").alias("_active"))
    return good.select("*", first["field"].alias("_field"), first["want"][0].alias("_token"))
