"""Which variables of an audit can be masked: their references, typed values that occur elsewhere, and drops that follow
from drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .graph import settled
from .references import corners, inside, prose_references

#: Sheets that hold lists to pick from or disclosed assumptions; reasons, first come first.
PICKLIST = r"(?i)data\s*validation|validation|dropdown|^lists?$|picklist|embedded\s*assumptions"
CAUSES = ("unparsable_reference", "unknown_sheet", "formula_cell", "blank_in_baseline", "duplicate_value_leak", "forced_exclusion")


def value_key(kind: Column | str, number: Column | str, text: Column | str) -> Column:
    """What a value is and says: a number to ten places, a date's day, a trimmed text; null for truth values and blanks."""
    kind, number, text = (F.col(c) if isinstance(c, str) else c for c in (kind, number, text))
    # rounding may give a negative zero; adding 0 takes its sign away
    n = F.concat(F.lit("n|"), (F.round(number, 10) + F.lit(0.0)).cast("string"))
    return F.when(kind == "num", n).when(kind == "date", F.concat(F.lit("d|"), F.substring(text, 1, 10))).when((kind == "text") & (F.trim(text) != ""), F.concat(F.lit("s|"), F.trim(text)))


def primary(codes: Column | str) -> Column:
    """The weightiest of an array of reasons; null where there is none."""
    codes = F.col(codes) if isinstance(codes, str) else codes
    return F.get(F.filter(F.array(*map(F.lit, CAUSES)), lambda c: F.array_contains(codes, c)), F.lit(0))


def leak_free(covers: DataFrame, holders: DataFrame, most: int = 10_000) -> DataFrame:
    """(row, round, n_leaks, leaks): the rows that have to go, since a value that they cover also stands in a cell that no
    row that stays covers; the round in which they go, how many such cells there are then, and the first four.

    covers: (row, cell, key); holders: (cell, key, picklist), all cells that hold a value. Cells of pick lists are masked
    along and never count. A row that goes uncovers its cells, so others may go in the next round; a round looks only at
    cells that the last one uncovered, and at rows with one of their values. Null keys are unlike all others.
    """
    covers = settled(covers.select("row", "cell", "key").distinct())
    keys = settled(covers.where("key is not null").select("row", "key").distinct())
    # cells that matter: those with a value that some row covers
    open_cells = settled(holders.where("key is not null and not picklist").select("cell", "key").distinct().join(keys.select("key").distinct(), "key", "left_semi"))
    loose = settled(open_cells.join(covers.select("cell").distinct(), "cell", "left_anti"))
    gone, stay = None, covers
    for k in range(1, most):
        first = loose.withColumn("_i", F.row_number().over(W.partitionBy("key").orderBy("cell"))).where("_i <= 4").groupBy("key").agg(F.collect_list("cell").alias("_four"))
        per_key = loose.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).join(first, "key")
        rows = keys if gone is None else keys.join(gone.select("row"), "row", "left_anti")
        hit = rows.join(per_key, "key").groupBy("row").agg(F.sum("_n").alias("n_leaks"), F.slice(F.sort_array(F.flatten(F.collect_list("_four"))), 1, 4).alias("leaks"))
        new = settled(hit.select("row", F.lit(k).cast("long").alias("round"), "n_leaks", "leaks"))
        gone = new if gone is None else settled(gone.unionByName(new))
        if new.isEmpty():
            return gone
        freed = stay.join(new.select("row"), "row", "left_semi").select("cell").distinct()
        stay = settled(stay.join(new.select("row"), "row", "left_anti"))
        loose = settled(open_cells.join(freed, "cell", "left_semi").join(stay.select("cell").distinct(), "cell", "left_anti"))
    raise RuntimeError("leak_free did not end")


def analyse(drafts: DataFrame, sheets: DataFrame, cells: DataFrame, held: DataFrame) -> DataFrame:
    """(wb, id, clean, code, codes, round, n_leaks, leaks, n_cells, n_along) of each row of an audit.

    drafts: (wb, id, text); sheets: (wb, sheet); cells: (wb, sheet, row, col, formula, kind, number, text), the whole book;
    held: (wb, sheet, row, col), what the delivered book still holds. A row is clean if its text names cells, all of them
    typed and held, and none of its values stands in another held cell that no clean row covers. n_along: cells of pick
    lists with one of its values that no clean row covers; they are masked along.
    """
    refs = prose_references(drafts.select("wb", "id", "text"), "text", sheets, ["wb"])
    refs = settled(refs.select("wb", "id", F.explode_outer("refs").alias("ref")))
    boxes = refs.where("ref.known").select("wb", "id", F.col("ref.sheet").alias("sheet"), F.col("ref.box").alias("box"), *corners(F.col("ref.box")))
    area = (F.greatest(F.lit(0), F.col("r2") - F.col("r1") + 1) * F.greatest(F.lit(0), F.col("c2") - F.col("c1") + 1)).cast("long")
    place = F.concat("sheet", F.lit("!r"), "row", F.lit("c"), "col")
    held_too = held.select("wb", "sheet", "row", "col").distinct().withColumn("held", F.lit(True))
    book = cells.select("wb", "sheet", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.coalesce(F.col("formula").startswith("="), F.lit(False)).alias("computed"), value_key("kind", "number", "text").alias("key"))
    book = settled(book.join(held_too, ["wb", "sheet", "row", "col"], "left").withColumn("held", F.coalesce("held", F.lit(False))))
    met = settled(inside(boxes, book, ["wb", "sheet"]))
    found = met.groupBy("wb", "id", "sheet", "box").agg(F.count_if("computed").alias("_computed"), F.count_if(F.col("held") & ~F.col("computed")).alias("_typed"))
    each = boxes.withColumn("_area", area).join(found, ["wb", "id", "sheet", "box"], "left")
    blank = F.coalesce("_computed", F.lit(0)) + F.coalesce("_typed", F.lit(0)) < F.col("_area")
    marks = each.select("wb", "id", F.array_compact(F.array(F.when(F.col("_computed") > 0, "formula_cell"), F.when(blank, "blank_in_baseline"))).alias("codes"), F.coalesce("_typed", F.lit(0)).alias("_typed"))
    other = F.when(F.col("ref").isNull(), F.array(F.lit("unparsable_reference"))).when(~F.col("ref.known"), F.array(F.lit("unknown_sheet")))
    marks = marks.unionByName(refs.where("ref is null or not ref.known").select("wb", "id", other.alias("codes"), F.lit(0).cast("long").alias("_typed")))
    rows = settled(marks.groupBy("wb", "id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("codes")))).alias("codes"), (F.sum("_typed") > 0).alias("_some")).withColumn("_ok", F.col("_some") & (F.size("codes") == 0)))

    key = F.when(F.col("key").isNotNull(), F.concat_ws("\u0001", "wb", "key"))
    name = lambda *c: F.struct("wb", *c)
    typed = met.where("held and not computed").join(rows.where("_ok").select("wb", "id"), ["wb", "id"], "left_semi")
    covers = settled(typed.select(name("id").alias("row"), name(place.alias("cell")).alias("cell"), key.alias("key")).distinct())
    holders = settled(book.where("held").select(name(place.alias("cell")).alias("cell"), key.alias("key"), F.col("sheet").rlike(PICKLIST).alias("picklist")))
    gone = leak_free(covers, holders).select("row.wb", "row.id", "round", "n_leaks", F.transform("leaks", lambda c: c["cell"]).alias("leaks"))
    out = rows.join(gone, ["wb", "id"], "left")
    codes = F.when(F.col("round").isNotNull(), F.concat("codes", F.array(F.lit("duplicate_value_leak")))).otherwise(F.col("codes"))
    out = out.withColumn("codes", codes).withColumn("clean", F.col("_ok") & F.col("round").isNull())

    stay = covers.join(out.where("clean").select(name("id").alias("row")), "row", "left_semi")
    along = holders.where("picklist and key is not null").join(stay.select("cell").distinct(), "cell", "left_anti").groupBy("key").agg(F.count_distinct("cell").alias("_n"))
    along = stay.where("key is not null").select("row", "key").distinct().join(along, "key").groupBy("row.wb", "row.id").agg(F.sum("_n").alias("n_along"))
    sizes = stay.groupBy("row.wb", "row.id").agg(F.count_distinct("cell").alias("n_cells"))
    zero = F.lit(0).cast("long")
    out = out.join(sizes, ["wb", "id"], "left").join(along, ["wb", "id"], "left")
    return out.select("wb", "id", "clean", primary("codes").alias("code"), "codes", "round", F.coalesce("n_leaks", zero).alias("n_leaks"), F.coalesce("leaks", F.array().cast("array<string>")).alias("leaks"), F.coalesce("n_cells", zero).alias("n_cells"), F.coalesce("n_along", zero).alias("n_along"))


#: Fixed value: a number in a table of an answer or in the inventory that it was made from.
NUMBER = r"(?<![A-Za-z])[-+]?(?:[0-9]+\.[0-9]+|[0-9]+)(?:[eE][-+]?[0-9]+)?"


def numbers(text: Column) -> Column:
    """The numbers of a text, as doubles."""
    return F.array_compact(F.transform(F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0)), lambda x: x.try_cast("double")))


def table_faults(tables: DataFrame, inventory: DataFrame, sheets: DataFrame) -> DataFrame:
    """(wb, id, fault, said, row): what a table names that its inventory doesn't: references (reference) and numbers of
    the second column (value, with its row's first column).

    tables: (wb, id, text), lines of | cells |; inventory: (wb, sheet, r1, c1, r2, c2, encoded), the boxes that tables may
    name and the text that their numbers come from; sheets: (wb, sheet). Numbers agree as numbers: 1.50 is 1.5.
    """
    tables = settled(tables.select("wb", "id", "text"))
    refs = prose_references(tables, "text", sheets, ["wb"]).select("wb", "id", F.explode("refs").alias("ref")).where("ref.known")
    boxes = settled(refs.select("wb", "id", F.col("ref.sheet").alias("sheet"), F.col("ref.box").alias("box"), *corners(F.col("ref.box"))))
    rows_of, cols_of = F.explode(F.sequence("r1", "r2")), F.explode(F.sequence("c1", "c2"))
    allowed = inventory.where("r1 <= r2 and c1 <= c2").select("wb", "sheet", rows_of.alias("row"), "c1", "c2").select("wb", "sheet", F.col("row").cast("long").alias("row"), cols_of.alias("col")).distinct()
    met = inside(boxes, allowed, ["wb", "sheet"]).groupBy("wb", "id", "sheet", "box").agg(F.count(F.lit(1)).alias("_n"))
    area = F.greatest(F.lit(0), F.col("r2") - F.col("r1") + 1) * F.greatest(F.lit(0), F.col("c2") - F.col("c1") + 1)
    none = F.lit(None).cast("string")
    bad = boxes.withColumn("_area", area).join(met, ["wb", "id", "sheet", "box"], "left").where(F.coalesce("_n", F.lit(0)) < F.col("_area"))
    out = bad.select("wb", "id", F.lit("reference").alias("fault"), F.concat("sheet", F.lit("!"), "box").alias("said"), none.alias("row"))

    line = tables.select("wb", "id", F.explode(F.split("text", "\n")).alias("_line")).where(F.ltrim("_line").startswith("|"))
    parts = F.split(F.regexp_replace(F.trim("_line"), r"^\|+|\|+$", ""), r"\|")
    said = line.select("wb", "id", parts.alias("_p")).where(F.size("_p") >= 3).where(~F.contains(F.get("_p", F.lit(1)), F.lit("Workbook cells and values")))
    tokens = F.regexp_extract_all(F.get("_p", F.lit(1)), F.lit(NUMBER), F.lit(0))
    said = said.select("wb", "id", F.trim(F.get("_p", F.lit(0))).alias("row"), F.explode(tokens).alias("said")).withColumn("_x", F.col("said").try_cast("double")).where("_x is not null")
    right = inventory.select("wb", F.explode(numbers(F.col("encoded"))).alias("_x")).distinct()
    wrong = said.join(right, ["wb", "_x"], "left_anti")
    return out.unionByName(wrong.select("wb", "id", F.lit("value").alias("fault"), "said", "row"))
