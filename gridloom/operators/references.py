"""References in prose, boxes of cells, and joins of boxes to cells by tiles of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import settled

#: Fixed value: a cell or a box of cells, after an exclamation mark.
CELL = r"\$?[A-Z]{1,3}\$?[0-9]+(?::\$?[A-Z]{1,3}\$?[0-9]+)?"
#: Fixed value: what a sheet's name does not go across.
BREAK = r"`|<[bB][rR]\s*/?>|[\n;]"
#: Rows of a tile at each level; a box takes the lowest level at which it fills two tiles at most.
TILES = (64, 512, 4096, 32768, 262144, 1 << 21)


def column_number(letters: Column) -> Column:
    """A to XFD as 1 to 16384."""
    at = lambda i: F.ascii(F.substring(letters, i, 1)) - 64
    n = F.length(letters)
    return F.when(n == 1, at(1)).when(n == 2, at(1) * 26 + at(2)).otherwise(at(1) * 676 + at(2) * 26 + at(3))


def prose_references(rows: DataFrame, text: str, sheets: DataFrame, by: list[str]) -> DataFrame:
    """rows with refs: each Sheet!A1 or Sheet!A1:B2 that the text names, once, in order: (sheet, box, known).

    A sheet's name stands in single quotes before the mark, or is the longest known name that the words before the mark
    end with, whatever its case; words before a line break, a semicolon or a back quote don't count. Where none is known,
    the last 31 characters are the name. sheets: (by, sheet); a book's names travel with its rows. A null text has none.
    """
    known = sheets.groupBy(*by).agg(F.sort_array(F.collect_set("sheet")).alias("_sheets"))
    given = rows.join(known, by, "left").withColumn("_sheets", F.coalesce("_sheets", F.array().cast("array<string>")))
    mark = "!(" + CELL + ")"
    body = F.coalesce(F.col(text), F.lit(""))
    pairs = F.zip_with(F.split(body, mark, -1), F.regexp_extract_all(body, F.lit(mark), F.lit(1)), lambda before, box: F.struct(before.alias("before"), box.alias("box")))

    def named(p: Column) -> Column:
        quoted = F.regexp_extract(p["before"], r"'([^']+)'\s*$", 1)
        words = F.element_at(F.split(p["before"], BREAK, -1), -1)
        words = F.regexp_replace(F.substring(words, -31, 31), r'^[ \t"=\[]+|[ \t"=\[]+$', "")
        name = F.when(quoted != "", F.trim(quoted)).otherwise(words)
        ends = F.filter("_sheets", lambda s: F.when(quoted != "", F.upper(s) == F.upper(name)).otherwise(F.endswith(F.upper(name), F.upper(s))))
        best = F.array_max(F.transform(ends, lambda s: F.struct(F.length(s).alias("n"), s.alias("s"))))["s"]
        return F.struct(F.coalesce(best, name).alias("sheet"), F.replace(p["box"], F.lit("$"), F.lit("")).alias("box"), best.isNotNull().alias("known"))

    refs = F.filter(F.transform(F.filter(pairs, lambda p: p["box"].isNotNull()), named), lambda r: r["sheet"] != "")
    return given.withColumn("refs", F.array_distinct(refs)).drop("_sheets")


def corners(box: Column) -> list[Column]:
    """r1, c1, r2, c2 of A1 or A1:B2, a single cell being a box; a box that is written backwards holds nothing."""
    part = lambda i: F.element_at(F.split(F.upper(box), ":"), i)
    last = F.when(F.contains(box, F.lit(":")), part(2)).otherwise(part(1))
    row = lambda c: F.regexp_extract(c, "[0-9]+", 0).cast("long")
    col = lambda c: column_number(F.regexp_extract(c, "[A-Z]+", 0)).cast("long")
    first = F.element_at(F.split(F.upper(box), ":"), 1)
    return [row(first).alias("r1"), col(first).alias("c1"), row(last).alias("r2"), col(last).alias("c2")]


def inside(boxes: DataFrame, cells: DataFrame, by: list[str]) -> DataFrame:
    """boxes (by, r1, c1, r2, c2, ...) joined to the cells (by, row, col, ...) in them.

    Both sides carry tiles of rows: a box the one or two that it touches at the level of its height, a cell one at each
    level that some box has, so nothing is compared but what shares a tile, and a tile is at most eight times as high as
    its box, or 64 rows.
    """
    tall = F.col("r2") - F.col("r1") + 1
    level = reduce(lambda rest, i: F.when(tall <= TILES[i], i).otherwise(rest), reversed(range(len(TILES) - 1)), F.lit(len(TILES) - 1))
    rows_of = F.element_at(F.array(*map(F.lit, TILES)), F.col("_level") + 1)
    levelled = settled(boxes.where("r1 <= r2 and c1 <= c2").withColumn("_level", level))
    tiled = levelled.withColumn("_tile", F.explode(F.sequence(F.floor(F.col("r1") / rows_of), F.floor(F.col("r2") / rows_of))))
    used = sorted(r[0] for r in levelled.select("_level").distinct().collect()) or [0]
    places = F.array(*(F.struct(F.lit(i).alias("_level"), F.floor(F.col("row") / TILES[i]).alias("_tile")) for i in used))
    dealt = cells.withColumn("_p", F.explode(places)).select("*", "_p._level", "_p._tile").drop("_p")
    return tiled.join(dealt, [*by, "_level", "_tile"]).where("row between r1 and r2 and col between c1 and c2").drop("_level", "_tile")
