"""Files of a segmented model: bands and candidates as CSV, segments as JSON, curation as TOML, the graph as CSV.

Each table is written by Spark's committers, a folder for each book: a task that fails leaves nothing behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the files.
NODE_FIELDS = "id kind sheet coordinate row col owner op op_kind arity expr label formula value array_formula in_degree out_degree in_cycle".split()
EDGE_FIELDS = "source target role arg_index op cell ref via_range cross_sheet in_cycle".split()
BAND_FIELDS = "band bucket subclass sheet row col_lo col_hi width kind vtype label depth island mirror_fanin component pattern cells".split()
CANDIDATE_FIELDS = "rank band sheet label score sink mirror_fanin presented_on strong_term weak_term output_sheet depth scalar_collapse main_island check_cell width cells".split()


def write_csv(df: DataFrame, path: str, fields: list[str]) -> None:
    """df's fields with a header, quoted where needed, in a folder wb=… for each book; fields that df lacks are empty."""
    have = set(df.columns)
    rows = df.select("wb", *(F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in fields))
    rows.repartition("wb").sortWithinPartitions("wb", *[c for c in ("rank", fields[0]) if c in fields]).write.partitionBy("wb").option("header", "true").option("escape", '"').option("emptyValue", "").csv(path)


def read_csv(spark: SparkSession, path: str, fields: list[str], kinds: dict[str, str] | None = None) -> DataFrame:
    """What write_csv wrote; kinds: types of columns that aren't texts. Values with line breaks are kept."""
    schema = ", ".join(f"`{c}` string" for c in [*fields, "wb"])
    df = spark.read.schema(schema).option("header", "true").option("escape", '"').option("multiLine", "true").option("emptyValue", "").csv(path)
    return df.withColumns({c: F.col(c).try_cast(k) for c, k in (kinds or {}).items()})


def write_segments(bands: DataFrame, path: str, verification: DataFrame | None = None) -> None:
    """One line of JSON for each book, in a folder wb=…: counts, inputs, outputs, middle, scaffolding, presentation.

    bands: (wb, band, bucket, subclass, sheet, label, width, kind, vtype, depth, comp, primary, is_mirror); bucket and comp
    are null for mirrors. verification: (wb, verdict, n).
    """
    is_ = lambda c: F.col("bucket") == c
    said = F.struct("sheet", "band", "label", "width", "kind", "vtype", "depth")
    some = lambda cond, value, name: F.sort_array(F.collect_list(F.when(cond, value))).alias(name)
    own = bands.groupBy("wb").agg(
        F.struct(F.count(F.lit(1)).alias("bands"), F.count_if("is_mirror").alias("mirror_bands"), F.count_distinct("comp").alias("components"), *(F.count_if(is_(b) & F.col("primary")).alias(b) for b in ("input", "middle", "output"))).alias("counts"),
        some(is_("input") & F.col("primary"), said, "inputs"), some(is_("output") & F.col("primary"), said, "outputs"), some(is_("middle"), F.col("band"), "middle"),
        F.struct(*(some(F.col("subclass") == s, F.col("band"), s) for s in ("unused_input", "dead", "detached"))).alias("scaffolding"), some(F.col("is_mirror"), F.col("band"), "presentation_bands"),
    )
    if verification is not None:
        tally = verification.groupBy("wb").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("verdict", "n")))).alias("verification"))
        own = own.join(tally, "wb", "left")
    own.select("wb", F.to_json(F.struct(F.col("wb").alias("workbook"), *[c for c in own.columns if c != "wb"])).alias("value")).repartition("wb").write.partitionBy("wb").text(path)


def toml_text(c: Column | str) -> Column:
    """A text as a basic string of TOML."""
    c = F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.concat(F.lit('"'), F.regexp_replace(c, r"[\x00-\x1F]", " "), F.lit('"'))


def _plain(c: Column) -> Column:
    """The text of a basic string's inside; a placeholder keeps escaped backslashes apart."""
    c = F.replace(c, F.lit("\\\\"), F.lit("\u0001"))
    for a, b in (('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\u0001", "\\")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def write_curation(candidates: DataFrame, path: str, threshold: float, top: int = 40, fallback: DataFrame | None = None) -> None:
    """curation.toml of each book, in a folder wb=…: an entry for each of the first candidates, included from threshold on.

    candidates: (wb, rank, band, sheet, label, score); fallback: (wb, band), included whatever their score, with a remark.
    """
    rows = candidates.where(F.col("rank") <= top)
    if fallback is None:
        rows = rows.withColumn("_picked", F.lit(False))
    else:
        rows = rows.join(fallback.select("wb", "band", F.lit(True).alias("_picked")).distinct(), ["wb", "band"], "left").withColumn("_picked", F.coalesce("_picked", F.lit(False)))
    chosen = F.col("score") >= threshold
    lines = ["[[output]]", F.concat(F.lit("band = "), toml_text("band")), F.concat(F.lit("sheet = "), toml_text("sheet")), F.concat(F.lit("label = "), toml_text("label")), F.concat(F.lit("score = "), "score"),
             F.when(F.col("_picked") & ~chosen, "include = true  # fallback: first of their kind").when(chosen, "include = true").otherwise("include = false"), F.concat(F.lit("name = "), toml_text(F.when(F.coalesce("label", F.lit("")) == "", F.col("band")).otherwise(F.col("label")))), ""]
    entry = F.array_join(F.array(*(F.lit(x) if isinstance(x, str) else x for x in lines)), "\n")
    head = candidates.select("wb").distinct().select("wb", F.lit(0).alias("rank"), F.concat(F.lit("# Outputs of workbook "), "wb", F.lit(f": set include and name, then run again.\n# Included from a score of {threshold} on; the first {top} are listed.\n")).alias("value"))
    head.unionByName(rows.select("wb", "rank", entry.alias("value"))).repartition("wb").sortWithinPartitions("wb", "rank").select("wb", "value").write.partitionBy("wb").text(path)


def read_curation(spark: SparkSession, path: str) -> DataFrame:
    """(wb, nth, band, sheet, label, score, include, name) of the entries of curation files, remarks after bare values left
    out; what an entry lacks is null."""
    whole = spark.read.schema("value string, wb string").text(path, wholetext=True)
    entries = whole.select("wb", F.posexplode(F.split("value", r"(?m)^[ \t]*\[\[output\]\][ \t]*$")).alias("nth", "_e")).where("nth > 0")
    text = lambda k: _plain(F.nullif(F.regexp_extract("_e", rf'(?m)^[ \t]*{k}[ \t]*=[ \t]*("(?:[^"\\]|\\.)*")[ \t]*$', 1), F.lit("")))
    inner = lambda k: F.substring(text(k), F.lit(2), F.length(text(k)) - 2)
    bare = lambda k: F.nullif(F.regexp_extract("_e", rf"(?m)^[ \t]*{k}[ \t]*=[ \t]*([^#\n\"]*?)[ \t]*(?:#.*)?$", 1), F.lit(""))
    return entries.select("wb", "nth", *(inner(k).alias(k) for k in ("band", "sheet", "label")), bare("score").try_cast("double").alias("score"), bare("include").try_cast("boolean").alias("include"), inner("name").alias("name"))
