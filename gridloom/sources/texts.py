"""Text sources and sinks around the graph: tables in Markdown, GraphML, nested JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.audit import slug


def markdown_rows(spark: SparkSession, path: str) -> DataFrame:
    """(file, cells, draft_id) of the body rows of all Markdown tables in text files, ids told apart by -2, -3, …

    Lines keep their place in the file through monotonically increasing ids; one file is one task's work.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"), F.trim("value").alias("line"))
    rows = lines.where(r"line rlike '^\\|.*\\|$'").withColumn("rule", F.col("line").rlike(r"^\|[\s:|-]+\|$"))
    ahead = F.lead("rule").over(W.partitionBy("file").orderBy("at"))
    body = rows.withColumn("head", F.coalesce(ahead, F.lit(False))).where("not rule and not head")
    cells = body.withColumn("cells", F.transform(F.split(F.regexp_replace("line", r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))).withColumn("_slug", slug(F.col("cells")[0]))
    nth = F.row_number().over(W.partitionBy("file", "_slug").orderBy("at"))
    return cells.withColumn("_n", nth).select("file", "cells", F.when(F.col("_n") == 1, F.col("_slug")).otherwise(F.concat("_slug", F.lit("-"), "_n")).alias("draft_id"))


def _xml(c):
    c = F.coalesce(c.cast("string"), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def graphml(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Writes nodes (id, …) and edges (src, dst, …) as lines of GraphML, the parts ordered, below path."""
    # fixed values: GraphML's names of types
    kinds = {"int": "int", "bigint": "long", "double": "double", "boolean": "boolean"}
    head = ['<?xml version="1.0" encoding="UTF-8"?>', '<graphml xmlns="http://graphml.graphdrawing.org/xmlns">']
    head += [f'<key id="{side[0]}_{c}" for="{side}" attr.name="{c}" attr.type="{kinds.get(k, "string")}"/>' for side, df, skip in (("node", nodes, {"id"}), ("edge", edges, {"src", "dst"})) for c, k in df.dtypes if c not in skip]
    data = lambda df, side, skip: [F.when(F.col(c).isNotNull(), F.concat(F.lit(f'<data key="{side}_{c}">'), _xml(F.col(c)), F.lit("</data>"))).otherwise("") for c in df.columns if c not in skip]
    n = nodes.select(F.lit(1).alias("part"), F.concat(F.lit('<node id="'), _xml(F.col("id")), F.lit('">'), *data(nodes, "n", {"id"}), F.lit("</node>")).alias("value"))
    e = edges.select(F.lit(2).alias("part"), F.concat(F.lit('<edge source="'), _xml(F.col("src")), F.lit('" target="'), _xml(F.col("dst")), F.lit('">'), *data(edges, "e", {"src", "dst"}), F.lit("</edge>")).alias("value"))
    spark = nodes.sparkSession
    ends = spark.createDataFrame([(0, "\n".join([*head, '<graph edgedefault="directed">'])), (3, "</graph></graphml>")], "part int, value string")
    n.unionByName(e).unionByName(ends).repartitionByRange("part", "value").sortWithinPartitions("part", "value").select("value").write.text(path)


def as_json(df: DataFrame, by: str) -> DataFrame:
    """(by, json): each group's rows, which have to be few, as one array of objects in order of all their columns."""
    rest = [c for c in df.columns if c != by]
    return df.groupBy(by).agg(F.to_json(F.sort_array(F.collect_list(F.struct(*rest)))).alias("json"))
