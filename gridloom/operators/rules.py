"""Checks of bundles of tables: rules of single rows, keys, links between tables, chains of links; keys and leaves of JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import settled


def row_faults(df: DataFrame, id_column: str, rules: dict[str, tuple[Column, Column | str]]) -> DataFrame:
    """(rule, id, message): the rules that each row breaks. rules: name to (what must hold, message).

    All rules are read in one scan, as one array a row. Where what must hold is null, the rule is broken.
    """
    said = lambda m: F.lit(m) if isinstance(m, str) else m
    broken = [F.when(~F.coalesce(holds, F.lit(False)), F.struct(F.lit(name).alias("rule"), said(message).alias("message"))) for name, (holds, message) in rules.items()]
    return df.select(F.col(id_column).cast("string").alias("id"), F.explode(F.array_compact(F.array(*broken))).alias("f")).select("f.rule", "id", "f.message")


def key_faults(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(rule, id, message): keys that are missing (one row a rule) or that more than one row has. tables: rule to (rows, key's
    columns). All tables meet in one aggregation."""
    keys = lambda name, df, columns: df.select(F.lit(name).alias("rule"), F.when(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]), F.concat_ws("|", *(F.col(c).cast("string") for c in columns))).alias("id"))
    every = reduce(DataFrame.unionByName, [keys(name, df, columns) for name, (df, columns) in tables.items()])
    counted = every.groupBy("rule", "id").agg(F.count(F.lit(1)).alias("_n"))
    message = F.when(F.col("id").isNull(), F.concat("_n", F.lit(" without a key"))).otherwise(F.concat("_n", F.lit(" rows")))
    return counted.where("id is null or _n > 1").select("rule", "id", message.alias("message"))


def link_faults(links: dict[str, tuple[DataFrame, str, str, DataFrame, str]]) -> DataFrame:
    """(rule, id, message): rows whose link leads to no row. links: rule to (rows, id, link, parents, parents' key). All
    links meet in one join by (rule, key); a null link is a fault."""
    asked = reduce(DataFrame.unionByName, [df.select(F.lit(r).alias("rule"), F.col(i).cast("string").alias("id"), F.col(c).cast("string").alias("_key")) for r, (df, i, c, _, _) in links.items()])
    there = reduce(DataFrame.unionByName, [p.select(F.lit(r).alias("rule"), F.col(k).cast("string").alias("_key")) for r, (_, _, _, p, k) in links.items()]).where("_key is not null").distinct()
    return asked.join(there, ["rule", "_key"], "left_anti").select("rule", "id", F.concat(F.lit("no "), F.coalesce("_key", F.lit("key"))).alias("message"))


def chain_faults(tables: list[tuple[str, DataFrame, str, str | None]]) -> DataFrame:
    """(table, id, broken): rows from which the links up a chain of tables don't reach the top, and the table whose row lacks
    its parent. tables: (name, rows, id, link), from the top down; the top has no link.

    Each table is joined once to what is known of the one above, so a fault is handed down and not looked for again.
    """
    name, df, key, _ = tables[0]
    above, out = df.select(F.col(key).alias("_key"), F.lit(None).cast("string").alias("broken")), None
    for name, df, key, link in tables[1:]:
        both = df.select(F.col(key).alias("_id"), F.col(link).alias("_key")).join(above.dropDuplicates(["_key"]).withColumn("_there", F.lit(True)), "_key", "left")
        own = settled(both.select("_id", F.when(F.col("_there").isNull(), name).otherwise(F.col("broken")).alias("broken")))
        bad = own.where("broken is not null").select(F.lit(name).alias("table"), F.col("_id").cast("string").alias("id"), "broken")
        out = bad if out is None else out.unionByName(bad)
        above = own.select(F.col("_id").alias("_key"), "broken")
    return out


def json_nodes(df: DataFrame, id_column: str, json: str, most: int = 1000) -> DataFrame:
    """(id, path, key, kind, value) of all members of each row's JSON, at any depth: path like a.b[0], key in lower case (null
    for members of lists), kind as VARIANT names it, the value's text for leaves. Texts that are no JSON have none.

    Each round takes apart the values of the last one, as VARIANT columns; only objects and lists go on.
    """
    spark = df.sparkSession
    kind = lambda v: F.upper(F.regexp_extract(F.schema_of_variant(v), "^[A-Za-z]+", 0))
    now = df.select(F.col(id_column).alias("id"), F.lit("").alias("path"), F.try_parse_json(json).alias("_v")).where("_v is not null")
    out = None
    for _ in range(most):
        open_ = now.where(kind("_v").isin("OBJECT", "ARRAY")).select("id", "path", "_v")
        members = open_.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer()))
        step = F.when(F.col("key").isNull(), F.concat(F.lit("["), "pos", F.lit("]"))).otherwise(F.concat(F.when(F.col("path") == "", "").otherwise("."), "key"))
        now = settled(members.select("id", F.concat("path", step).alias("path"), F.lower("key").alias("key"), F.col("value").alias("_v")))
        if now.isEmpty():
            break
        leaf = F.when(~kind("_v").isin("OBJECT", "ARRAY"), F.col("_v").cast("string"))
        part = now.select("id", "path", "key", kind("_v").alias("kind"), leaf.alias("value"))
        out = part if out is None else out.unionByName(part)
    none = now.select("id", "path", F.lit(None).cast("string").alias("key"), F.lit("").alias("kind"), F.lit("").alias("value"))
    return none.limit(0) if out is None else out


def leaked_keys(nodes: DataFrame, forbidden: list[str]) -> DataFrame:
    """(id, path, key) of members with a forbidden name, whatever its case. nodes: json_nodes()."""
    return nodes.where(F.col("key").isin([k.lower() for k in forbidden])).select("id", "path", "key")


def leaked_urls(nodes: DataFrame, allowed: list[str]) -> DataFrame:
    """(id, path, value) of texts that hold a web address, under other names than the allowed ones."""
    bare = F.coalesce(F.col("key"), F.lit("")).isin([k.lower() for k in allowed])
    return nodes.where((F.col("kind") == "STRING") & F.col("value").rlike("(?i)https?://") & ~bare).select("id", "path", "value")
