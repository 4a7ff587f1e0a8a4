"""Boilerplate lines by their frequency on a site, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, free_names, look_up, may_contain, membership_filter, null_key, split_by_filter

#: A line is boilerplate on a site if over PERCENT % of the site's pages, and MIN_PAGES at least, contain it.
PERCENT, MIN_PAGES = 2, 3


def _line_key(site: Column, line: Column) -> Column:
    """128 bits of site and line."""
    return F.unhex(F.md5(F.concat(site, F.lit("\n"), line)))


def boilerplate_lines(docs: DataFrame, site_col: str, text_col: str, id_col: str, percent: int = PERCENT, min_pages: int = MIN_PAGES) -> DataFrame:
    """(line_key, pages, total) of each line of a site that too many of its pages contain.

    A page counts once a line; lines of white space alone never count. Pages are counted map-side first, so a line that
    every page holds costs one row a task.
    """
    site = null_key(site_col)
    lines = docs.select(site.alias("_site"), F.explode(F.array_distinct(F.filter(F.split(text_col, "\n", -1), lambda x: x.rlike(r"\S")))).alias("line"))
    counts = lines.groupBy("_site", _line_key(F.col("_site"), F.col("line")).alias("line_key")).agg(F.count(F.lit(1)).alias("pages"))
    totals = docs.groupBy(site.alias("_site")).agg(F.count(F.lit(1)).alias("total"))
    often = durable(counts.where(F.col("pages") >= min_pages), "line-counts", compression="zstd")
    return look_up(often, durable(totals, "line-totals"), "_site", "line_key").where(F.col("pages") * 100 > F.col("total") * percent).select("line_key", "pages", "total")


def drop_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", percent: int = PERCENT, min_pages: int = MIN_PAGES) -> DataFrame:
    """docs' columns with text_col without its site's boilerplate lines, and n_lines and n_dropped_lines.

    Lines are parts between line breaks, told apart by their bytes; all other lines stay as they are and in order. A null
    text stays null, with no lines; an empty text has one line, which is blank and stays. A null site is a site of its
    own. Repeated rows count as pages of their own and are treated alike. An empty table gives no rows. Columns named
    n_lines or n_dropped_lines are not allowed in docs.
    """
    if clash := {"n_lines", "n_dropped_lines"} & set(docs.columns):
        raise ValueError(f"columns of docs: {sorted(clash)}")
    bad = durable(boilerplate_lines(docs, site_col, text_col, id_col, percent, min_pages).withColumn("key", F.xxhash64("line_key")), "boilerplate", compression="zstd")
    words = membership_filter(bad, "key", bad.count())
    site = null_key(site_col)
    lines = F.split(text_col, "\n", -1)

    # the boilerplate lines of each document that has some; a filter leaves few lines to be joined
    names = free_names([*docs.columns, "n_lines", "n_dropped_lines"], "at", "bad", "site", "lines", "left")
    at, own_bad, own_site, own_lines, left = names
    place = F.xxhash64(null_key(id_col), site, F.col(text_col))  # rows without an id don't meet in one place
    held = docs.select(place.alias("at"), site.alias("site"), F.explode(F.array_distinct(lines)).alias("line")).select("at", _line_key(F.col("site"), F.col("line")).alias("line_key"))
    held = may_contain(held.withColumn("key", F.xxhash64("line_key")), "key", words).join(bad.select("line_key"), "line_key", "left_semi")
    # a set too many by texts that share a place does no harm: a line key says site and line
    held = durable(held.groupBy(F.col("at").alias(at)).agg(F.collect_set("line_key").alias(own_bad)), "boilerplate-held", compression="zstd")
    marked, clean = split_by_filter(docs.withColumn(at, place), at, membership_filter(held, at, held.count()))
    n = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long")
    stays = F.filter(own_lines, lambda x: ~F.array_contains(own_bad, _line_key(F.col(own_site), x)))
    marked = marked.join(held, at, "left").withColumn(own_bad, F.coalesce(own_bad, F.array().cast("array<binary>"))).withColumn(own_site, site).withColumn(own_lines, lines).withColumn(left, stays)
    gone = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(own_lines) - F.size(left)).cast("long")
    marked = marked.select(*(F.array_join(left, "\n").alias(c) if c == text_col else F.col(c) for c in docs.columns), n.alias("n_lines"), gone.alias("n_dropped_lines"))
    return marked.unionByName(clean.select(*docs.columns, n.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped_lines")))
