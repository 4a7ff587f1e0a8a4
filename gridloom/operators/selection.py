"""Which cells of a segmented book may stay when it is masked, which are asked for, and where it is cut off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .series import running

PLACE = ["wb", "sheet", "row", "col"]
#: Parts of a number format that show a date; years that a period header may name.
DATE_TOKENS, YEARS = ("yy", "mmm", "dd"), (1990, 2100)
#: What is kept in each mode besides inputs.
MODES = ("inputs", "labels", "headers")


def span_cells(bands: DataFrame, *carry: str) -> DataFrame:
    """(wb, sheet, row, col, carried columns) of each cell that a band spans."""
    return bands.where("col_lo <= col_hi").select("wb", "sheet", F.col("row").cast("long").alias("row"), F.explode(F.sequence(F.col("col_lo").cast("long"), F.col("col_hi").cast("long"))).alias("col"), *carry)


def output_cells(bands: DataFrame) -> DataFrame:
    return span_cells(bands.where("bucket = 'output'")).distinct()


def input_cells(bands: DataFrame) -> DataFrame:
    """Cells of input bands, constants in formulas among them, but no cell that is an output."""
    return span_cells(bands.where("bucket = 'input'")).distinct().join(output_cells(bands), PLACE, "left_anti")


def output_values(bands: DataFrame, cells: DataFrame) -> DataFrame:
    """(wb, sheet, row, col, number) of outputs that hold a number."""
    return output_cells(bands).join(cells.where("kind = 'num'").select(*PLACE, "number"), PLACE)


def is_period(kind: Column | str, number: Column | str, number_format: Column | str) -> Column:
    """Whether a cell reads as a period's header: a date, a number shown as one, or a whole number that can be a year."""
    kind, number, number_format = (F.col(c) if isinstance(c, str) else c for c in (kind, number, number_format))
    shown = F.lit(False)
    for token in DATE_TOKENS:
        shown = shown | F.contains(F.lower(F.coalesce(number_format, F.lit(""))), F.lit(token))
    year = (kind == "num") & (number == F.floor(number)) & number.between(*YEARS)
    return F.coalesce((kind == "date") | shown | year, F.lit(False))


def kept_cells(bands: DataFrame, cells: DataFrame, mode: str) -> DataFrame:
    """(wb, sheet, row, col, admitted): cells that stay: inputs; in the modes labels and headers texts and units too; in the
    mode headers cells of an axis that read as a period.

    A constant that is an input keeps its formula's cell, unless that is an output. admitted: the bucket that a period's
    header came from, where nothing else keeps it; of several the least. cells: (wb, sheet, row, col, kind, number,
    number_format).
    """
    if mode not in MODES:
        raise ValueError(f"mode: one of {MODES}")
    literal = F.col("kind") == "literal"
    plain = F.col("bucket") == "input"
    if mode != "inputs":
        plain = plain | F.col("vtype").isin("text", "unit")
    own = span_cells(bands.where(~literal & F.coalesce(plain, F.lit(False)))).distinct()
    hosts = span_cells(bands.where(literal & (F.col("bucket") == "input"))).distinct().join(output_cells(bands), PLACE, "left_anti")
    none = F.lit(None).cast("string").alias("admitted")
    out = own.select(*PLACE, none).unionByName(hosts.select(*PLACE, none))
    if mode == "headers":
        axis = span_cells(bands.where(~literal & (F.col("vtype") == "axis") & ~F.coalesce(F.col("bucket") == "input", F.lit(False))), F.coalesce("bucket", F.lit("?")).alias("admitted"))
        period = cells.where(is_period("kind", "number", "number_format")).select("wb", "sheet", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"))
        out = out.unionByName(axis.join(period, PLACE, "left_semi"))
    kept = F.bool_or(F.col("admitted").isNull())
    return out.groupBy(*PLACE).agg(F.when(~kept, F.min("admitted")).alias("admitted"))


def cutoffs(deepest: DataFrame, stride: int = 1, cap: int = 0) -> DataFrame:
    """(wb, cutoff): every so many levels from 0 to the deepest, which is always there; at most cap of them, evenly spaced.

    deepest: (wb, deepest). Places are rounded to the even neighbour where they lie halfway.
    """
    stride = max(1, stride)
    steps = F.sequence(F.lit(0).cast("long"), F.col("deepest").cast("long"), F.lit(stride).cast("long"))
    every = F.when(F.element_at(steps, -1) == F.col("deepest"), steps).otherwise(F.concat(steps, F.array(F.col("deepest").cast("long"))))
    rows = deepest.where("deepest >= 0").select("wb", "deepest", every.alias("_all"))
    if cap == 1:
        chosen = F.when(F.size("_all") > 1, F.array(F.col("deepest").cast("long"))).otherwise(F.col("_all"))
    elif cap:
        place = lambda i: F.bround(i * (F.size("_all") - 1) / F.lit(float(cap - 1)), 0).cast("int")
        chosen = F.when(F.size("_all") > cap, F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(cap - 1)), lambda i: F.element_at("_all", place(i) + 1)))).otherwise(F.col("_all"))
    else:
        chosen = F.col("_all")
    return rows.select("wb", F.explode(chosen).alias("cutoff"))


def picked_cutoffs(available: DataFrame, deepest: DataFrame, count: int, seed: int = 0) -> DataFrame:
    """(wb, cutoff): so many of the cutoffs above the deepest level: those at the quarters, and, where quarters fall
    together or more are asked for, others by a hash of seed, book and cutoff. available: (wb, cutoff)."""
    shallow = available.join(deepest, "wb").where(F.col("cutoff") < F.col("deepest")).groupBy("wb").agg(F.array_sort(F.collect_set(F.col("cutoff").cast("long"))).alias("_all"))
    place = lambda q: F.element_at("_all", F.bround(F.lit(q) * (F.size("_all") - 1), 0).cast("int") + 1)
    quarters = F.array_distinct(F.array(*(place(q) for q in (0.25, 0.5, 0.75)[:count])))
    by_hash = F.array_sort(F.transform(F.array_except("_all", quarters), lambda c: F.struct(F.md5(F.concat_ws("|", F.lit(seed), "wb", c)).alias("h"), c.alias("c"))))
    more = F.slice(F.transform(by_hash, lambda x: x["c"]), 1, F.greatest(F.lit(0), F.lit(count) - F.size(quarters)))
    chosen = F.when(F.size("_all") <= count, F.col("_all")).otherwise(F.concat(quarters, more))
    return shallow.select("wb", F.explode(chosen).alias("cutoff"))


def targets(cells: DataFrame, cutoff: Column | str) -> DataFrame:
    """(wb, sheet, row, col, level, excluded, place): computed cells below the cutoff, what excludes them, and the place of
    those that are left, by sheet, row and column.

    cells: (wb, sheet, row, col, level, cyclic, volatile, kind, number, text), formulas only; a null level: not parsed.
    Cells at or above the cutoff are still to be seen and left out.
    """
    cutoff = F.col(cutoff) if isinstance(cutoff, str) else cutoff
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    failed = (F.col("kind") == "error") | ((F.col("kind") == "text") & F.col("text").startswith("#"))
    empty = F.coalesce(F.col("kind").isin("blank") | (F.col("number").isNull() & F.col("text").isNull()), F.lit(True))
    reason = F.when(F.col("level").isNull(), "unparsed").when(yes("cyclic"), "cycle").when(yes("volatile"), "volatile").when(F.coalesce(failed, F.lit(False)), "error_value").when(empty, "no_cached_value")
    rows = cells.where(F.col("level").isNull() | (F.col("level") > cutoff)).select(*PLACE, "level", reason.alias("excluded"))
    return running(rows, ["wb"], ["sheet", "row", "col"], F.when(F.col("excluded").isNull(), 1).otherwise(0), "place").withColumn("place", F.when(F.col("excluded").isNull(), F.col("place")))
