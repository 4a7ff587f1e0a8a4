"""Workbooks as tables: scan, formula graph, bands of alike cells, evaluation, verification, masking.

Files are read and written cell by cell. Formulas of one book must see each other: books of some thousands of cells are
evaluated side by side, one a task, formulas of larger ones in rounds, each with the cells that it names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .graph import settled
from .references import inside

CELLS = "wb string, sheet string, sheet_idx int, row int, col int, a1 string, formula string, is_array boolean, kind string, number double, text string"
EDGES = "wb string, sheet string, row int, col int, place int, src_sheet string, r1 int, c1 int, r2 int, c2 int"
VALUES = "wb string, sheet string, row int, col int, kind string, number double, text string"
#: A book of more cells is evaluated in rounds; what so many rounds leave is evaluated in one task a book.
WHOLE, ROUNDS = 100_000, 32
#: Rows of a batch.
BATCH = 10_000


def files(spark: SparkSession, path: str) -> DataFrame:
    """(wb, content) of the .xlsx files below a path that Spark can read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.xls[xm]").option("recursiveFileLookup", "true").load(path)
    return found.select(F.regexp_extract("path", r"([^/]+)\.xls[xm]$", 1).alias("wb"), "content")


def scan(books: DataFrame) -> DataFrame:
    """books (wb, content): the cells of all sheets. A book that can't be read gives one row of kind error."""

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.sources import workbook as B

        kinds = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in CELLS.split(", ")])

        def made(wb: str, cells: Iterator[dict]) -> Iterator:
            rows = []
            for c in cells:
                rows.append({"wb": wb, **c, "number": None if c["number"] != c["number"] else c["number"]})
                if len(rows) == BATCH:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            for wb, content in zip(batch["wb"].to_pylist(), batch["content"], strict=True):
                try:
                    found = list(made(wb, B.each_cell(content.as_py())))  # a book is given whole or not at all
                except Exception as e:  # any damage to a file is a row, not a lost job
                    found = [pa.RecordBatch.from_pylist([{"wb": wb, "kind": "error", "text": f"unreadable: {e}"}], schema=schema)]
                yield from found

    return books.select("wb", "content").mapInArrow(read, CELLS)


def _parts(books: DataFrame, schema: str, read) -> DataFrame:
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for wb, content in zip(pdf["wb"], pdf["content"], strict=True):
                try:
                    out += [(wb, *row) for row in read(bytes(content))]
                except Exception:  # scan() gives the row that says so
                    continue
            yield pd.DataFrame(out, columns=columns)

    return books.select("wb", "content").mapInPandas(run, schema)


def names(books: DataFrame) -> DataFrame:
    """(wb, sheet, name, target): the defined names; sheet is null for those of the whole book."""

    def read(content: bytes) -> list:
        from gridloom.sources import workbook as B

        return B.names(content)

    return _parts(books, "wb string, sheet string, name string, target string", read)


def sheets(books: DataFrame) -> DataFrame:
    """(wb, sheet, part): the sheets and where the file has them."""

    def read(content: bytes) -> list:
        from gridloom.sources import workbook as B

        return B.sheets(content)

    return _parts(books, "wb string, sheet string, part string", read)


def settings(books: DataFrame) -> DataFrame:
    """(wb, iterate, count, delta): how a book says that its circles are calculated."""

    def read(content: bytes) -> list:
        from gridloom.sources import workbook as B

        c = B.calculation(content)
        return [(c["iterate"], c["count"], c["delta"])]

    return _parts(books, "wb string, iterate boolean, count int, delta double", read)


def pack(cells: DataFrame) -> DataFrame:
    """cells: (wb, content), each book written anew."""

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.sources import workbook as B

        schema = pa.schema([("wb", pa.string()), ("content", pa.binary())])
        w = wb = sheet = place = held = None
        for batch in batches:
            for own, name, row, col, formula, kind, number, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if w is not None and (own, name, row, col) != (wb, sheet, *place):  # of several rows for a cell the last counts
                    w.cell(*place, held)
                if w is None or own != wb:
                    if w is not None:
                        yield pa.RecordBatch.from_pylist([{"wb": wb, "content": w.content()}], schema=schema)
                    w, wb, sheet = B.Writer(), own, None
                if name != sheet:
                    w.sheet(name)
                    sheet = name
                stored = bool(number) if kind == "bool" else text if kind in ("text", "error") else None if number is None or number != number else number
                place, held = (row, col), (formula, stored) if formula is not None else stored
        if w is not None:
            w.cell(*place, held)
            yield pa.RecordBatch.from_pylist([{"wb": wb, "content": w.content()}], schema=schema)

    rows = cells.select("wb", "sheet", "row", "col", "formula", "kind", "number", "text", "sheet_idx").repartition("wb").sortWithinPartitions("wb", "sheet_idx", "sheet", "row", "col")
    return rows.drop("sheet_idx").mapInArrow(write, "wb string, content binary")


def precedents(cells: DataFrame) -> DataFrame:
    """A row for each box that a formula names, in order: the edges of the cell graph before boxes are opened."""

    def parse_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from gridloom.functions import formula as P

        for pdf in batches:
            out = []
            for c in pdf.itertuples(index=False):
                try:
                    boxes = P.precedents(P.parse(c.formula), c.sheet)
                except P.FormulaError:
                    continue
                out += [(c.wb, c.sheet, c.row, c.col, i, *b) for i, b in enumerate(boxes)]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in EDGES.split(", ")])

    return cells.where("formula is not null").select("wb", "sheet", "row", "col", "formula").mapInPandas(parse_all, EDGES)


def edges(cells: DataFrame, most: int = 100) -> DataFrame:
    """(wb, src, dst): cell names; a box of over most cells stands for itself and its populated cells lead to it."""
    name = lambda s, r, c: F.concat(s, F.lit("!R"), r, F.lit("C"), c)
    p = precedents(cells).withColumn("dst", name(F.col("sheet"), F.col("row"), F.col("col"))).withColumn("n", (F.col("r2") - F.col("r1") + 1).cast("long") * (F.col("c2") - F.col("c1") + 1))
    small = p.where(F.col("n") <= most).withColumn("r", F.explode(F.sequence("r1", "r2"))).withColumn("c", F.explode(F.sequence("c1", "c2"))).select("wb", name(F.col("src_sheet"), F.col("r"), F.col("c")).alias("src"), "dst")
    box = F.concat(name(F.col("src_sheet"), F.col("r1"), F.col("c1")), F.lit(":"), "r2", F.lit(","), "c2")
    large = p.where(F.col("n") > most).withColumn("src", box)
    there = cells.select(F.col("wb").alias("_w"), F.col("sheet").alias("_s"), F.col("row").alias("_r"), F.col("col").alias("_c"))
    boxes = large.select("wb", "src_sheet", "r1", "c1", "r2", "c2", "src").distinct()
    members = boxes.join(there, (F.col("wb") == F.col("_w")) & (F.col("src_sheet") == F.col("_s")) & F.col("_r").between(F.col("r1"), F.col("r2")) & F.col("_c").between(F.col("c1"), F.col("c2")))
    return small.unionByName(large.select("wb", "src", "dst")).unionByName(members.select("wb", name(F.col("_s"), F.col("_r"), F.col("_c")).alias("src"), F.col("src").alias("dst"))).distinct()


def bands(cells: DataFrame) -> DataFrame:
    """(wb, sheet, row, col_lo, col_hi, kind, pattern, width): neighbours of a row that are alike.

    Alike are formulas of one relative pattern, and typed cells that are both text or both not.
    """

    @F.pandas_udf("string")
    def pattern(formula: pd.Series, row: pd.Series, col: pd.Series) -> pd.Series:
        from gridloom.functions import formula as P

        return pd.Series([None if f is None else P.pattern(f, r, c) for f, r, c in zip(formula, row, col, strict=True)], dtype=object)

    kind = F.when(F.col("formula").isNotNull(), "formula").when(F.col("kind") == "text", "label").otherwise("input")
    c = cells.select("wb", "sheet", "row", "col", kind.alias("kind"), F.coalesce(pattern("formula", "row", "col"), F.lit("")).alias("pattern"), (F.col("kind") == "text").alias("_text"))
    key = ["wb", "sheet", "row", "kind", "pattern", "_text"]
    run = F.col("col") - F.row_number().over(W.partitionBy(*key).orderBy("col"))
    out = c.withColumn("_run", run).groupBy(*key, "_run").agg(F.min("col").alias("col_lo"), F.max("col").alias("col_hi"), F.count(F.lit(1)).alias("width"))
    return out.select("wb", "sheet", "row", "col_lo", "col_hi", "kind", "pattern", "width")


def _coded(v) -> tuple[str, float | None, str | None]:
    """kind, number and text of a value."""
    from gridloom.functions import interpreter as I

    kind = "blank" if v is None else "bool" if isinstance(v, bool) else "num" if isinstance(v, int | float) else "text" if isinstance(v, str) else "error" if isinstance(v, I.Error) else "unknown"
    return kind, float(v) if isinstance(v, int | float) and v == v else None, v if isinstance(v, str) else getattr(v, "code", getattr(v, "why", None))


def _decoded(kind: str, number: float | None, text: str | None):
    """The value of _coded's kind, number and text."""
    from gridloom.functions import interpreter as I

    if kind == "num":
        return float("nan") if number is None else number
    return text if kind == "text" else bool(number) if kind == "bool" else I.Error(text) if kind == "error" else I.Unknown(text) if kind == "unknown" else None


def evaluate(cells: DataFrame, today: float = 45000.0, iterate: bool = True, names: DataFrame | None = None, settings: DataFrame | None = None, whole: int = WHOLE) -> DataFrame:
    """The value of every formula cell: kind num, text, bool, blank, error (text: its code) or unknown (text: why).

    names: names(); a sheet's own come before the book's. settings: settings(); a book without any takes iterate.

    A book of up to whole cells is evaluated in one task. Of a larger one, each round evaluates the formulas whose
    precedents are known, and a task holds the cells that one formula names. Formulas on circles, those that use names,
    OFFSET, INDIRECT or areas made by operators, chains longer than ROUNDS, and what depends on these are left to one task
    a book in the end. Values don't depend on the way.
    """
    large = settled(cells.groupBy("wb").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > whole).select("wb"))
    if large.isEmpty():
        return _together(cells, today, iterate, names, settings)
    parts = [_together(cells.join(large, "wb", "left_anti"), today, iterate, names, settings)]
    some = settled(cells.join(large, "wb", "left_semi"))
    found, left = _rounds(some, today)
    parts += found
    if not left.isEmpty():
        key = ["wb", "sheet", "row", "col"]
        known = reduce(DataFrame.unionByName, found, cells.sparkSession.createDataFrame([], VALUES)).select(*key, F.struct("kind", "number", "text").alias("_known"))
        rest = some.join(left.select("wb").distinct(), "wb", "left_semi").join(known, key, "left")
        parts.append(_together(rest, today, iterate, names, settings))
    return reduce(DataFrame.unionByName, parts)


def _together(cells: DataFrame, today: float, iterate: bool, names: DataFrame | None, settings: DataFrame | None) -> DataFrame:
    """evaluate(), a book in one task. _known of cells, if there: values that are there already and aren't given again."""
    spark = cells.sparkSession
    given = names if names is not None else spark.createDataFrame([], "wb string, sheet string, name string, target string")
    cells = cells.select("wb", "sheet", "row", "col", "formula", "kind", "number", "text", *(["_known"] if "_known" in cells.columns else []))
    if settings is not None:
        cells = cells.join(settings.select("wb", F.col("iterate").alias("_iterate"), F.col("count").alias("_count"), F.col("delta").alias("_delta")), "wb", "left")

    def run(pdf: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
        from gridloom.functions import interpreter as I

        if not len(pdf):
            return pd.DataFrame(columns=[c.split()[0] for c in VALUES.split(", ")])
        book, known = {}, {}
        for c, k in zip(pdf.itertuples(index=False), pdf["_known"] if "_known" in pdf else [None] * len(pdf), strict=True):
            if k is not None:
                known[c.sheet, int(c.row), int(c.col)] = _decoded(k["kind"], k["number"], k["text"])
                continue
            v = c.formula if isinstance(c.formula, str) else c.text if c.kind == "text" else I.Error(c.text) if c.kind == "error" else bool(c.number) if c.kind == "bool" else None if pd.isna(c.number) else float(c.number)
            book[c.sheet, int(c.row), int(c.col)] = v
        own = {f"{s}!{n}" if isinstance(s, str) else n: t for s, n, t in zip(names["sheet"], names["name"], names["target"], strict=True)}
        more = {"iterate": iterate}
        if "_iterate" in pdf and not pd.isna(pdf["_iterate"].iloc[0]):
            more = {"iterate": bool(pdf["_iterate"].iloc[0]), "count": int(pdf["_count"].iloc[0]), "delta": float(pdf["_delta"].iloc[0])}
        w = I.Workbook(book, names=own, today=today, known=known, **more)
        values = w.evaluate()
        out = [(pdf["wb"].iloc[0], *k, *_coded(values[k])) for k in [*w.trees, *w.broken]]
        return pd.DataFrame(out, columns=[c.split()[0] for c in VALUES.split(", ")])

    return cells.groupBy("wb").cogroup(given.select(F.col("wb").alias("_wb"), "sheet", "name", "target").groupBy("_wb")).applyInPandas(run, VALUES)


def _rounds(cells: DataFrame, today: float) -> tuple[list[DataFrame], DataFrame]:
    """(values that each round found, formulas that are left), by joins: no task holds a book.

    at_sheet, at_row, at_col: where a formula stands; sheet, row, col: a cell that it names.
    """
    at, there = ["wb", "at_sheet", "at_row", "at_col"], ["wb", "sheet", "row", "col"]
    given = F.coalesce("formula", F.when(F.col("kind") == "text", F.col("text")))
    own = cells.select("wb", "sheet", F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), given.alias("given"), F.coalesce(F.startswith(given, F.lit("=")), F.lit(False)).alias("runs"), "kind", "number", "text")
    number = F.when(~F.isnan("number"), F.col("number"))
    kind = F.when(F.col("given").isNotNull(), "text").when(F.col("kind").isin("error", "bool"), F.col("kind")).when(number.isNull(), "blank").otherwise("num")
    typed = own.where("not runs").select(*there, kind.alias("kind"), number.alias("number"), F.coalesce("given", "text").alias("text"))
    left = own.where("runs").select(*(F.col(c).alias(a) for c, a in zip(there, at, strict=True)), F.col("given").alias("formula"))
    used = own.groupBy("wb", "sheet").agg(F.max("row").alias("row"), F.max("col").alias("col"))
    named = settled(left.repartition(*at).mapInArrow(_named, _NAMED))
    told, one, wide = named.where("r1 is null").select(*at), named.where("r1 = r2 and c1 = c2"), named.where("r1 < r2 or c1 < c2")
    single = one.select(*at, "sheet", F.col("r1").alias("row"), F.col("c1").alias("col"))
    formulas = left.select(*(F.col(a).alias(c) for c, a in zip(there, at, strict=True)))
    waits = settled(single.join(formulas, there, "left_semi").unionByName(inside(wide, formulas, ["wb", "sheet"]).select(*at, *there[1:])))
    extents = wide.select(*at, "sheet").distinct().join(used, ["wb", "sheet"]).select(*at, *there[1:], F.lit("used").alias("kind"), F.lit(None).cast("double").alias("number"), F.lit(None).cast("string").alias("text"))
    values, found = typed, []

    def run(batches: Iterator) -> Iterator:
        yield from _answers(batches, today)

    for _ in range(ROUNDS):
        free = settled(left.join(waits.select(*at).distinct(), at, "left_anti").join(told, at, "left_anti"))
        if free.isEmpty():
            break
        heads = free.select(*at, F.col("at_sheet").alias("sheet"), F.col("at_row").alias("row"), F.col("at_col").alias("col"), F.lit("formula").alias("kind"), F.lit(None).cast("double").alias("number"), F.col("formula").alias("text"))
        inputs = single.join(free, at, "left_semi").join(values, there).unionByName(inside(wide.join(free, at, "left_semi"), values, ["wb", "sheet"]).select(*at, *there[1:], "kind", "number", "text"))
        needs = reduce(DataFrame.unionByName, [heads, extents.join(free, at, "left_semi"), inputs.select(*heads.columns)])
        new = settled(needs.repartition(*at).sortWithinPartitions(*at).mapInArrow(run, VALUES))
        if new.isEmpty():
            break
        found.append(new)
        values = values.unionByName(new)
        left = settled(left.join(new.select(*(F.col(c).alias(a) for c, a in zip(there, at, strict=True))), at, "left_anti"))
        waits = settled(waits.join(new.select(*there), there, "left_anti"))
    return found, left


_NAMED = "wb string, at_sheet string, at_row int, at_col int, sheet string, r1 int, c1 int, r2 int, c2 int"


def _named(batches: Iterator) -> Iterator:
    """The boxes that formulas name; one without corners where only running a formula tells what it reads."""
    import pyarrow as pa

    from gridloom.functions import formula as P

    kinds = {"string": pa.string(), "int": pa.int32()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _NAMED.split(", ")])
    for batch in batches:
        out = []
        for *key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            try:
                tree = P.parse(text)
                told = any(n.kind == "name" or n.kind == "call" and n.value.endswith(("OFFSET", "INDIRECT")) or n.kind == "infix" and n.value in (":", " ") for _, _, _, n in P.walk(tree))
                out += [(*key, None, None, None, None, None)] if told else [(*key, *b) for b in P.precedents(tree, key[1])]
            except P.FormulaError:
                continue  # its value says so
            except RecursionError:
                out.append((*key, None, None, None, None, None))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [()] * len(schema), schema.types, strict=True)], schema=schema)


def _answers(batches: Iterator, today: float) -> Iterator:
    """VALUES of formulas, whose own rows and those of the cells that they name come one formula after another."""
    import sys

    import pyarrow as pa

    from gridloom.functions import interpreter as I

    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))  # as where books are whole

    kinds = {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in VALUES.split(", ")])
    at, text, known, used, sheets, out = None, None, {}, {}, {}, []

    def answer() -> None:
        try:
            v = I.Workbook({at[1:]: text}, today=today, known=known, used=used).value(at[1:])
        except RecursionError:
            v = I.Unknown("too-deep")
        if not isinstance(v, I.Block):  # one without cells is left to the end
            out.append((*at, *_coded(v)))

    def batch_of(rows: list):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * len(schema), schema.types, strict=True)], schema=schema)

    for batch in batches:
        for wb, at_sheet, at_row, at_col, sheet, row, col, kind, number, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != (wb, at_sheet, at_row, at_col):
                if at is not None:
                    answer()
                at, text, known, used = (wb, at_sheet, at_row, at_col), None, {}, {}
            if kind == "formula":
                text = words
            elif kind == "used":
                used[sheet] = (row, col)
            else:
                known[sheets.setdefault(sheet, sheet), row, col] = _decoded(kind, number, words)
        if len(out) >= BATCH:
            yield batch_of(out)
            out.clear()
    if at is not None:
        answer()
    yield batch_of(out)


def verify(cells: DataFrame, values: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """values with stored and verdict: match, mismatch, unresolved or unverifiable (nothing stored)."""
    stored = cells.where("formula is not null").select("wb", "sheet", "row", "col", F.col("kind").alias("_k"), F.col("number").alias("stored"), F.col("text").alias("_t"))
    j = values.join(stored, ["wb", "sheet", "row", "col"])
    close = F.abs(F.col("number") - F.col("stored")) <= tolerance * F.greatest(F.lit(1.0), F.abs("stored"))
    same = F.when(F.col("number").isNotNull() & F.col("stored").isNotNull(), close).otherwise(F.trim(F.coalesce("text", F.lit(""))) == F.trim(F.coalesce("_t", F.lit(""))))
    return j.withColumn("verdict", F.when(F.col("kind") == "unknown", "unresolved").when(F.col("_k") == "blank", "unverifiable").when(same, "match").otherwise("mismatch")).drop("_k", "_t")


def masked(books: DataFrame, keep: DataFrame) -> DataFrame:
    """books (wb, content) with only the cells in keep (wb, sheet, row, col); formulas there become their stored values."""
    sets = keep.groupBy("wb").agg(F.collect_set(F.struct("sheet", "row", "col")).alias("keep"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from gridloom.sources import workbook as B

        for pdf in batches:
            kept = [{(k["sheet"], k["row"], k["col"]) for k in (x if x is not None else [])} for x in pdf["keep"]]
            yield pd.DataFrame({"wb": pdf["wb"], "content": [B.masked(bytes(c), lambda *k, own=own: k in own) for c, own in zip(pdf["content"], kept, strict=True)]})

    return books.join(sets, "wb", "left").mapInPandas(run, "wb string, content binary")


def mask_faults(before: DataFrame, after: DataFrame, keep: DataFrame) -> DataFrame:
    """(wb, sheet, row, col, fault) of a masked book's cells: a formula that is left, leaked (not to be kept), lost (to be
    kept, with a value, but gone) or changed (another value than before)."""
    key = ["wb", "sheet", "row", "col"]
    side = lambda df, n: df.select(*key, F.struct("formula", "kind", "number", "text").alias(n))
    kept = keep.select(*key).distinct().withColumn("_keep", F.lit(True))
    j = side(before, "b").join(side(after, "a"), key, "full").join(kept, key, "left").withColumn("_keep", F.coalesce("_keep", F.lit(False)))
    there, same = F.col("a").isNotNull(), F.col("a.number").eqNullSafe(F.col("b.number")) & F.col("a.text").eqNullSafe(F.col("b.text"))
    valued = F.col("b.number").isNotNull() | F.col("b.text").isNotNull()
    fault = F.when(there & F.col("a.formula").isNotNull(), "formula").when(there & ~F.col("_keep"), "leaked").when(~there & F.col("_keep") & valued, "lost").when(there & ~same, "changed")
    return j.select(*key, fault.alias("fault")).where("fault is not null")
