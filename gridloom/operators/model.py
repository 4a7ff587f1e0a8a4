"""The graph of a workbook's model: trees of formulas, labels, types, bands, their condensation, candidates, levels.

Formulas are read row by row, their references meet cells in joins, so no task holds a book;
labels, types, bands and projections are windows and joins, circles, depths and islands those of one graph of all books.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import digits12, plain_number
from .graph import depths, islands, quotient, settled, through
from .references import inside
from .series import running

NODES = "wb string, id string, kind string, sheet string, row int, col int, owner string, op string, op_kind string, arity int, expr string, formula string, value string, number double, text string, r1 int, c1 int, r2 int, c2 int, n int"
EDGES = "wb string, seq int, src string, dst string, role string, arg_index int, op string, ref string, via_range string, cell string, cross_sheet boolean"
#: Texts that are units; words of a label that make a period axis; hints in sheets' names and labels.
UNITS = "aed usd eur gbp x % na n/a - bc 000$ $mm $bn $000s mm bn k m".split()
AXIS_WORDS = ("year", "date", "period", "month", "quarter")
PRESENTATION = ("dashboard", "output", "summary", "return", "case comparison")
STRONG = ("irr", "moic", "npv", "xirr", "equity value", "enterprise value", "terminal value", "exit value", "payback", "dscr", "tev", "share price", "per share", "roic", "break-even", "breakeven", "money multiple", "cash-on-cash", "exit equity", "equity proceeds")
WEAK = ("total revenue", "net income", "net profit", "ebitda", "ebit", "margin", "fcf", "free cash flow", "cash flow", "valuation", "return", "multiple", "dividend", "total uses", "total sources", "coverage", "net debt")
OUTPUT_SHEETS = ("dashboard", "output", "summary", "return", "valuation", "dcf", "case comparison", "comps")
CHECKS = ("check", "tie out", "tie-out", "must be zero", "error", "difference", "variance check", "balance check", "control", "audit")
#: Patterns of a date's text, of a formula that steps a year, of a formula that is one reference.
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}[T ]"
YEAR_STEP = r"^=\s*\$?[A-Za-z]{1,3}\$?\d+\s*\+\s*1\s*$"
LONE_REFERENCE = r"^=\s*(?:'[^']*'|[A-Za-z0-9_ ]+)?!?\$?[A-Za-z]{1,3}\$?\d{1,7}\s*$"
#: Numbers that tell nothing when they stand in a formula.
DULL = (0.0, 1.0, -1.0, 2.0, 12.0, 100.0, 365.0, 0.5, 360.0, 4.0, 1000.0, 10000.0)


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def formula_graph(cells: DataFrame, names: DataFrame | None = None, most: int = 100) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of all books: every populated cell (formula, label or input), what its formula consists of, and
    what flows where. cells: one row a cell; names: (wb, sheet or null, name, target). A reference to over most cells is a
    node of its own; most is 1 at least.

    A formula that can't be read is a node without edges. cross_sheet: the edge's ends lie on different sheets. seq: the
    order of the edges that one formula gives.
    """
    if most < 1:
        raise ValueError("most is 1 at least")

    @F.pandas_udf("string")
    def written(number: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(x) else f"{x:.15g}" for x in number], dtype=object)

    kind = F.when(F.col("formula").isNotNull(), "formula").when(F.col("kind") == "text", "label").otherwise("input")
    made = {"id": F.concat("sheet", F.lit("!"), _letters(F.col("col")), "row"), "kind": kind, "row": F.col("row").cast("int"), "col": F.col("col").cast("int"), "number": F.when(~F.isnan("number"), F.col("number")), "value": F.coalesce("text", written("number"))}
    own = settled(cells.select("wb", "sheet", "sheet_idx", "formula", "text", *(c.alias(n) for n, c in made.items())))
    raw = settled(_read_formulas(own, names, most))

    # boxes of one cell meet it, larger ones are measured once however many formulas name them
    box = ["wb", "box_sheet", "r1", "c1", "r2", "c2"]
    at = own.select("wb", F.col("sheet").alias("box_sheet"), "row", "col")
    refs = raw.where("part = 'edge' and src is null")
    one = refs.where("r1 = r2 and c1 = c2").join(at.select("wb", "box_sheet", F.col("row").alias("r1"), F.col("col").alias("c1")), ["wb", "box_sheet", "r1", "c1"], "left_semi")
    one = one.withColumn("src", F.concat("box_sheet", F.lit("!"), _letters(F.col("c1")), "r1")).withColumns({"_n": F.lit(1).cast("long"), "_range": F.lit(False)})
    boxes = refs.where("r1 < r2 or c1 < c2").select(*box).distinct()
    full = settled(inside(boxes, at, box[:2]).groupBy(*box).agg(F.count(F.lit(1)).alias("_n"), F.min("row").alias("_r1"), F.min("col").alias("_c1"), F.max("row").alias("_r2"), F.max("col").alias("_c2")))
    corner = lambda c, r: F.concat(_letters(F.col(c)), r)
    ranges = full.where(F.col("_n") > most).withColumn("_src", F.concat("box_sheet", F.lit("!"), corner("_c1", "_r1"), F.lit(":"), corner("_c2", "_r2")))
    few = inside(full.where(F.col("_n") <= most).select(*box, "_n"), at, box[:2]).withColumn("_place", F.row_number().over(W.partitionBy(*box).orderBy("row", "col")) - 1)
    few = few.select(*box, F.concat("box_sheet", F.lit("!"), corner("col", "row")).alias("_src"), "_n", "_place", F.lit(False).alias("_range"))
    targets = ranges.select(*box, "_src", "_n", F.lit(0).alias("_place"), F.lit(True).alias("_range")).unionByName(few)
    more = refs.where("r1 < r2 or c1 < c2").join(targets, box).withColumn("src", F.col("_src")).withColumn("seq", (F.col("seq") + F.col("_place")).cast("int")).drop("_src", "_place")
    named = raw.where("part = 'edge' and src is not null").withColumns({"_n": F.lit(1).cast("long"), "_range": F.lit(False)})
    found = named.unionByName(one).unionByName(more)

    # of references to several areas all are counted together, and a cell in two of them counts once
    several = W.partitionBy("wb", "cell", "ref_no")
    again = W.partitionBy("wb", "cell", "ref_no", "src").orderBy("seq")
    many = found.where("areas > 1").withColumn("_n", F.count(F.lit(1)).over(several)).withColumn("_range", F.max("_range").over(several)).withColumn("_again", F.row_number().over(again)).where("_again = 1").drop("_again")
    found = found.where("areas is null or areas = 1").unionByName(many)
    via = F.coalesce("via_range", F.when((F.col("_n") > 1) | F.col("_range"), F.col("ref")).otherwise(""))
    cross = F.coalesce(F.col("box_sheet") != F.col("sheet"), F.lit(False))
    edges = settled(found.withColumn("via_range", via).withColumn("cross_sheet", cross).select(*_columns(EDGES)))

    none = lambda df: df.select(*(F.col(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in (x.split() for x in NODES.split(", "))))
    inner = raw.where("part = 'node'")
    boxed = ranges.select("wb", F.col("_src").alias("id"), F.lit("range").alias("kind"), F.col("box_sheet").alias("sheet"), *(F.col(f"_{c}").alias(c) for c in ("r1", "c1", "r2", "c2")), F.col("_n").cast("int").alias("n")).distinct()
    parts = [own, inner.where("owner is not null").drop("r1", "c1", "r2", "c2"), inner.where("owner is null").select("wb", "id", "kind", "sheet").distinct(), boxed]
    nodes = reduce(DataFrame.unionByName, map(none, parts))
    return nodes, edges


def _read_formulas(cells: DataFrame, names: DataFrame | None, most: int) -> DataFrame:
    """What each formula consists of and refers to, read row by row with its book's sheets, the names that it uses and the
    values that its texts of references are made of."""
    sheets = cells.groupBy("wb", "sheet").agg(F.min("sheet_idx").alias("i")).groupBy("wb").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "sheet"))), lambda x: x["sheet"]).alias("sheets"))
    rows = cells.where("formula is not null").select("wb", F.col("id").alias("cell"), "sheet", "formula").join(sheets, "wb")
    place, definition = "struct<sheet:string,row:int,col:int,value:string>", "struct<sheet:string,name:string,target:string>"
    rows = rows.withColumns({"values": F.lit(None).cast(f"array<{place}>"), "defined": F.lit(None).cast(f"array<{definition}>")})

    def trees(batches):
        from gridloom.functions import formula as P

        for pdf in batches:
            for r in pdf.itertuples():
                try:
                    tree = P.parse(r.formula)
                except P.FormulaError:
                    continue
                given = {(v["sheet"], v["row"], v["col"]): v["value"] for v in (r.values if r.values is not None else ())}
                yield r, tree, lambda n, s=r.sheet, given=given: given.get((n.value[0] or s, *n.value[1:]))

    def asked_cells(batches):
        from gridloom.functions import formula as P
        from gridloom.functions import model as M

        for r, tree, _ in trees(batches):
            asked = {(n.value[0] or r.sheet, *n.value[1:]) for a in M.told_by_text(tree) for _, _, _, n in P.walk(a) if n.kind == "ref"}
            if asked:
                yield pd.DataFrame([(r.wb, r.cell, *x) for x in asked], columns=["wb", "cell", "sheet", "row", "col"])

    def asked_names(batches):
        from gridloom.functions import model as M

        for r, tree, stored in trees(batches):
            more = (M.told(a, stored) for a in M.told_by_text(tree))
            if asked := M.named_in(tree).union(*(M.named_in(t) for t in more if t is not None)):
                yield pd.DataFrame([(r.wb, r.cell, x) for x in asked], columns=["wb", "cell", "name"])

    def with_all(name: str, found: DataFrame) -> DataFrame:
        return rows.drop(name).join(found, ["wb", "cell"], "left")

    asked = settled(rows.where(F.upper("formula").contains("INDIRECT")).mapInPandas(asked_cells, "wb string, cell string, sheet string, row int, col int"))
    if not asked.isEmpty():
        there = asked.join(cells.select("wb", "sheet", "row", "col", "value"), ["wb", "sheet", "row", "col"])
        rows = with_all("values", there.groupBy("wb", "cell").agg(F.collect_list(F.struct("sheet", "row", "col", "value")).alias("values")))
    if names is not None:
        asked = settled(rows.mapInPandas(asked_names, "wb string, cell string, name string"))
        meant = names.select("wb", "sheet", "name", "target").groupBy("wb").applyInPandas(_meanings, f"wb string, name string, defined array<{definition}>")
        rows = with_all("defined", asked.join(meant, ["wb", "name"]).groupBy("wb", "cell").agg(F.array_distinct(F.flatten(F.collect_list("defined"))).alias("defined")))

    node = [c for c in NODES.split(", ") if c.split()[0] in ("id", "kind", "owner", "op_kind", "arity", "expr", "number", "text")]
    edge = [c for c in EDGES.split(", ") if c.split()[0] not in ("wb", "cell", "cross_sheet")]
    schema = ", ".join(["part string, wb string, cell string, sheet string", *node, *edge, "ref_no int, areas int, box_sheet string, r1 int, c1 int, r2 int, c2 int"])

    def read(batches):
        from gridloom.functions import model as M

        out = []
        for r, tree, stored in trees(batches):
            given = {(d["sheet"], str(d["name"]).upper()): d["target"] for d in (r.defined if r.defined is not None else ())}
            more, links = M.emitted(r.cell, r.sheet, tree, given, list(r.sheets), stored, most)
            out += [{"part": "node", "wb": r.wb, "cell": r.cell, **n} for n in more]
            for e in links:
                at = e.pop("box", None)
                out.append({"part": "edge", "wb": r.wb, "cell": r.cell, "sheet": r.sheet, **e} | (dict(zip(("box_sheet", "r1", "c1", "r2", "c2"), at)) if at else {}))
            if len(out) >= 20_000:
                yield pd.DataFrame(out, columns=_columns(schema), dtype=object)
                out = []
        yield pd.DataFrame(out, columns=_columns(schema), dtype=object)

    return rows.mapInPandas(read, schema)


def _meanings(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """One book's names, each with the definitions, in any scope, of itself and of all names that these use."""
    from gridloom.functions import formula as P
    from gridloom.functions import model as M

    own: dict[str, list[dict]] = {}
    for s, n, t in zip(pdf["sheet"], pdf["name"], pdf["target"]):
        own.setdefault(str(n).upper(), []).append({"sheet": s if isinstance(s, str) else None, "name": str(n), "target": t})

    def uses(d: dict) -> set[str]:
        try:
            return M.named_in(M.defined(d["target"])) if isinstance(d["target"], str) else set()
        except P.FormulaError:
            return set()

    out = []
    for name in own:
        seen, front = {name}, [name]
        while front:
            front = [x for n in front for d in own[n] for x in uses(d) if x in own and x not in seen]
            front = list(dict.fromkeys(front))
            seen |= set(front)
        out.append((key[0], name, [d for n in sorted(seen) for d in own[n]]))
    return pd.DataFrame(out, columns=["wb", "name", "defined"])


def graph_stats(nodes: DataFrame, edges: DataFrame, top: int = 15) -> DataFrame:
    """(wb, stat, name, n): nodes by kind, edges by role, the commonest operators, edges between sheets."""
    by = lambda df, stat, c: df.groupBy("wb", F.lit(stat).alias("stat"), F.col(c).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    ops = by(nodes.where("kind = 'op'"), "op", "op").withColumn("_i", F.row_number().over(W.partitionBy("wb").orderBy(F.desc("n"), "name"))).where(F.col("_i") <= top).drop("_i")
    cross = edges.where("cross_sheet").groupBy("wb").agg(F.count(F.lit(1)).alias("n")).select("wb", F.lit("cross_sheet").alias("stat"), F.lit(None).cast("string").alias("name"), "n")
    return by(nodes, "kind", "kind").unionByName(by(edges, "role", "role")).unionByName(ops).unionByName(cross)


def labels(cells: DataFrame, longest: int = 160) -> DataFrame:
    """cells with label: a text cell's own text; else the row's leftmost text, the nearest text to the left and the
    nearest above, each once, joined by ' / '."""
    text = F.when((F.col("kind") == "text") & F.col("formula").isNull() & (F.trim("text") != ""), F.trim("text"))
    before = W.partitionBy("wb", "sheet", "row").orderBy("col").rowsBetween(W.unboundedPreceding, -1)
    above = W.partitionBy("wb", "sheet", "col").orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    found = cells.withColumn("_text", text).withColumn("_first", F.first("_text", True).over(before)).withColumn("_near", F.last("_text", True).over(before)).withColumn("_above", F.last("_text", True).over(above))
    parts = F.array_distinct(F.array_compact(F.array("_first", "_near", "_above")))
    own = F.when((F.col("kind") == "text") & (F.trim("text") != ""), F.trim("text")).otherwise(F.array_join(parts, " / "))
    return found.withColumn("label", F.substring(own, 1, longest)).drop("_text", "_first", "_near", "_above")


def vtype(kind: Column, value: Column, formula: Column, label: Column) -> Column:
    """text, blank, axis (of periods), unit or numeric: what a cell's stored value is."""
    number = plain_number(value)
    first = F.lower(F.split(F.coalesce(label, F.lit("")), " / ", 2)[0])
    stepped = (number == F.floor(number)) & number.between(1900, 2200) & F.coalesce(formula.rlike(YEAR_STEP), F.lit(False))
    axis = F.lit(False)
    for word in AXIS_WORDS:
        axis = axis | F.contains(first, F.lit(word))
    plain = F.when(value.rlike(DATE_TEXT), "axis").when(F.lower(F.trim(value)).isin(UNITS), "unit").otherwise("text")
    return F.when(kind == "label", "text").when(F.coalesce(F.trim(value), F.lit("")) == "", "blank").when(number.isNull(), plain).when(axis | stepped, "axis").otherwise("numeric")


def classified(nodes: DataFrame, edges: DataFrame, labelled: DataFrame) -> DataFrame:
    """The cells among nodes with label, vtype, is_mirror (shows one other thing), is_literal (a constant as a formula)
    and empty_ref (refers to an empty cell). labelled: labels()."""
    source = nodes.select("wb", F.col("id").alias("src"), F.col("kind").alias("_kind"))
    into = edges.join(source, ["wb", "src"]).groupBy("wb", F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("_n"), F.min_by(F.struct("role", F.col("_kind").alias("kind")), "seq").alias("_in"))
    cells = nodes.where("row is not null").join(labelled.select("wb", "sheet", "row", "col", "label"), ["wb", "sheet", "row", "col"], "left").join(into, ["wb", "id"], "left")
    is_formula = F.col("kind") == "formula"
    yes = lambda c: F.coalesce(c, F.lit(False))
    out = cells.withColumns({
        "vtype": vtype(F.col("kind"), F.col("value"), F.col("formula"), F.col("label")),
        "is_mirror": yes(is_formula & (F.col("_n") == 1) & (F.col("_in.role") == "identity")),
        "is_literal": yes(is_formula & (F.col("_in.kind") == "const")),
        "empty_ref": yes(is_formula & F.col("_n").isNull() & F.col("formula").rlike(LONE_REFERENCE)),
    })
    return out.select("wb", "id", "kind", "sheet", "row", "col", "formula", "value", "number", "label", "vtype", "is_mirror", "is_literal", "empty_ref")


def cell_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(wb, src, dst) between cells: operators and constants count as their cell, a range as its populated cells."""
    owner = nodes.where("kind in ('op', 'const') or row is not null").select("wb", F.col("id").alias("_id"), F.coalesce("owner", "id").alias("_own"))
    boxes = nodes.where("kind = 'range'").select("wb", "sheet", "r1", "c1", "r2", "c2", F.col("id").alias("_id"))
    members = inside(boxes, nodes.where("row is not null").select("wb", "sheet", "row", "col", F.col("id").alias("_own")), ["wb", "sheet"]).select("wb", "_id", "_own")
    from_any = owner.unionByName(members)
    src = edges.join(from_any.select("wb", F.col("_id").alias("src"), F.col("_own").alias("a")), ["wb", "src"])
    return src.join(owner.select("wb", F.col("_id").alias("dst"), F.col("_own").alias("b")), ["wb", "dst"]).where("a <> b").select("wb", F.col("a").alias("src"), F.col("b").alias("dst")).distinct()


def model_bands(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bands, which cell is in which) of classified cells: neighbours of a row that are of one kind, relative pattern and
    type, blanks going with numbers.

    A band has the label and type that most of its cells have, of equal ones that met first, and is a mirror or a literal
    where all its cells are.
    """

    @F.pandas_udf("string")
    def pattern(formula: pd.Series, row: pd.Series, col: pd.Series) -> pd.Series:
        from gridloom.functions import formula as P

        return pd.Series(["" if f is None else P.pattern(f, r, c) for f, r, c in zip(formula, row, col, strict=True)], dtype=object)

    key = ["wb", "sheet", "row", "kind", "pattern", "_type"]
    runs = cells.withColumn("pattern", pattern("formula", "row", "col")).withColumn("_type", F.when(F.col("vtype") == "blank", "numeric").otherwise(F.col("vtype")))
    runs = runs.withColumn("_run", F.col("col") - F.row_number().over(W.partitionBy(*key).orderBy("col")))
    whole = W.partitionBy(*key, "_run")
    lo, hi = F.min("col").over(whole), F.max("col").over(whole)
    name = lambda c: F.concat(_letters(c), F.col("row"))
    runs = runs.withColumn("col_lo", lo).withColumn("col_hi", hi).withColumn("band", F.concat("sheet", F.lit("!"), name(F.col("col_lo")), F.when(F.col("col_lo") < F.col("col_hi"), F.concat(F.lit(":"), name(F.col("col_hi")))).otherwise("")))

    def usual(column: str) -> DataFrame:
        some = runs.where(F.trim(column) != "").groupBy("wb", "band", F.trim(column).alias(column)).agg(F.count(F.lit(1)).alias("_n"), F.min("col").alias("_at"))
        return some.groupBy("wb", "band").agg(F.max_by(column, F.struct("_n", (-F.col("_at")).alias("_at"))).alias(column))

    bands = runs.groupBy("wb", "band", "sheet", "row", "col_lo", "col_hi", "kind", "pattern").agg(F.bool_and("is_mirror").alias("is_mirror"), F.bool_and("is_literal").alias("is_literal"))
    bands = bands.join(usual("vtype"), ["wb", "band"], "left").join(usual("label"), ["wb", "band"], "left").withColumn("label", F.coalesce("label", F.lit(""))).withColumn("width", F.col("col_hi") - F.col("col_lo") + 1)
    return bands.withColumn("value_bearing", F.col("vtype").isin("numeric", "axis")), runs.select("wb", "id", "band")


def _letters(col: Column) -> Column:
    """A column's letters, up to three."""
    at = lambda x: F.chr(65 + x % 26)
    n = col - 1
    two, three = F.floor((n - 26) / 26).cast("int"), F.floor((n - 702) / 676).cast("int")
    return F.when(n < 26, at(n)).when(n < 702, F.concat(at(two), at(n))).otherwise(F.concat(at(three), at(F.floor((n - 702) / 26).cast("int")), at(n)))


def band_edges(cells: DataFrame, members: DataFrame) -> DataFrame:
    """cells: cell_edges(); the same between bands, without loops."""
    end = lambda c: members.select("wb", F.col("id").alias(c), F.col("band").alias(f"_{c}"))
    return cells.join(end("src"), ["wb", "src"]).join(end("dst"), ["wb", "dst"]).where("_src <> _dst").select("wb", F.col("_src").alias("src"), F.col("_dst").alias("dst")).distinct()


def notable(x: Column) -> Column:
    """Whether a number in a formula is an assumption: none of the usual ones, and broken or at least 100."""
    return ~F.isnan(x) & (F.abs(x) < float("inf")) & ~x.isin(list(DULL)) & ((x != F.floor(x)) | (F.abs(x) >= 100))


def promoted(bands: DataFrame, members: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bands, edges) to add: each notable constant in the first cell of a computed band becomes a source of the band, a
    literal that spans the same columns."""
    own = bands.where("kind = 'formula' and not is_mirror and not is_literal and value_bearing")
    first = own.join(nodes.where("row is not null").select("wb", "sheet", "row", F.col("col").alias("col_lo"), F.col("id").alias("owner")), ["wb", "sheet", "row", "col_lo"])
    found = nodes.where("kind = 'const'").where(notable(F.col("number"))).select("wb", "owner", F.col("number").alias("lit")).distinct()
    made = first.join(found, ["wb", "owner"]).withColumn("_text", digits12(F.col("lit")))
    made = made.withColumn("new", F.concat("band", F.lit("#lit="), "_text"))
    label = F.ltrim(F.concat(F.coalesce("label", F.lit("")), F.lit(" [hardcoded "), "_text", F.lit("]")))
    extra = made.select("wb", F.col("new").alias("band"), "sheet", "row", "col_lo", "col_hi", F.lit("literal").alias("kind"), F.lit("").alias("pattern"), F.lit(False).alias("is_mirror"), F.lit(True).alias("is_literal"), F.lit("numeric").alias("vtype"), label.alias("label"), "width", F.lit(True).alias("value_bearing"))
    return extra.select(*bands.columns), made.select("wb", F.col("new").alias("src"), F.col("band").alias("dst"))


def condensed(bands: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bands, edges between components): mirrors are passed over, circles become one component, components get a depth
    (longest path from a source), a place in a topological order and an island, ranked by its number of bands.

    A component is named after its least band. fan_in counts the mirrors that show a band, presented_on their sheets that
    present results. primary: the band that stands for its component (widest, longest label, last name). sink and fed:
    whether anything follows or comes before; scalar_collapse: the primary band is one cell and something at least three
    wide flows in. Mirrors themselves have no component. All books are one graph, a node being book and band.
    """
    node = lambda c: F.concat_ws("\u0001", "wb", c)
    part = lambda c, i: F.get(F.split(c, "\u0001"), F.lit(i))
    own = settled(bands.select(node("band").alias("id"), "wb", "band", "is_mirror", "width", "label", "sheet"))
    real, mirrors = own.where("not is_mirror"), own.where("is_mirror")
    there = own.select("id")
    links = edges.select(node("src").alias("src"), node("dst").alias("dst")).join(there.withColumnRenamed("id", "src"), "src", "left_semi").join(there.withColumnRenamed("id", "dst"), "dst", "left_semi")
    reached = settled(through(links, mirrors.select("id")))
    views = reached.join(mirrors.select(F.col("id").alias("dst"), "sheet"), "dst").groupBy(F.col("src").alias("id"))
    hint = F.lit(False)
    for word in PRESENTATION:
        hint = hint | F.contains(F.lower("sheet"), F.lit(word))
    views = views.agg(F.count_distinct("dst").alias("fan_in"), F.collect_set(F.when(hint, F.col("sheet"))).alias("shown"))
    direct = settled(reached.join(mirrors.select(F.col("id").alias("dst")), "dst", "left_anti"))
    placed, parts = quotient(direct)
    one = F.lit(1).cast("long")
    nodes = real.join(placed, "id", "left").join(views, "id", "left").withColumns({"comp": F.coalesce("comp", "id"), "comp_size": F.coalesce("size", one), "on_circle": F.coalesce("on_circle", F.lit(False)), "depth": F.coalesce("depth", F.lit(0).cast("long")), "fan_in": F.coalesce("fan_in", F.lit(0).cast("long"))}).drop("size")
    nodes, parts = settled(nodes), settled(parts)

    best = F.max_by("id", F.struct("width", F.length("label"), "band"))
    comps = nodes.groupBy("wb", "comp", "depth", "comp_size").agg(best.alias("best"), F.max_by("width", F.struct("width", F.length("label"), "band")).alias("best_width"), F.max("fan_in").alias("all_fan_in"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("shown", F.array().cast("array<string>")))))).alias("presented_on"))
    into = direct.join(nodes.select(F.col("id").alias("src"), F.col("width").alias("_w")), "src").join(nodes.select(F.col("id").alias("dst"), "comp"), "dst").groupBy("comp").agg(F.max("_w").alias("widest_in"))
    ahead, behind = (parts.select(F.col(c).alias("comp"), F.lit(True).alias(n)).distinct() for c, n in (("src", "_ahead"), ("dst", "_behind")))
    names = islands(parts).select(F.col("id").alias("comp"), "island")
    comps = settled(comps.join(into, "comp", "left").join(ahead, "comp", "left").join(behind, "comp", "left").join(names.withColumnRenamed("island", "_island"), "comp", "left").withColumn("_island", F.coalesce("_island", "comp")))
    sizes = comps.groupBy("wb", "_island").agg(F.sum("comp_size").alias("island_size")).withColumn("_negative", -F.col("island_size"))
    ranked = running(sizes, ["wb"], ["_negative", "_island"], F.lit(1), "island").select("_island", "island_size", (F.col("island") - 1).alias("island"))
    deepest = comps.groupBy("wb").agg(F.max("depth").alias("max_depth"))
    comps = running(comps, ["wb"], ["depth", "comp"], F.lit(1), "place").join(ranked, "_island").join(deepest, "wb")
    comps = comps.select("comp", "best", "best_width", "all_fan_in", "presented_on", "widest_in", "max_depth", (F.col("place") - 1).alias("place"), "island", "island_size", F.col("_ahead").isNull().alias("sink"), F.col("_behind").isNotNull().alias("fed"))
    falls = (F.col("best_width") == 1) & F.coalesce(F.col("widest_in") >= 3, F.lit(False))
    out = nodes.drop("fan_in", "shown").join(comps, "comp").select("wb", "band", part("comp", 1).alias("comp"), "comp_size", "on_circle", (F.col("id") == F.col("best")).alias("primary"), "depth", "max_depth", "place", "island", "island_size", F.col("all_fan_in").alias("fan_in"), "presented_on", "sink", "fed", falls.alias("scalar_collapse"))
    return settled(out), parts.select(part("src", 0).alias("wb"), part("src", 1).alias("src"), part("dst", 1).alias("dst"))


def _hit(label: Column, terms: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(F.lower(label), F.lit(t))
    return out


def candidate_features(bands: DataFrame, parts: DataFrame) -> DataFrame:
    """What graph.score() needs, a row for each component whose primary band is a computed number that something feeds."""
    own = parts.where("primary and fed").join(bands.select("wb", "band", "label", "sheet", "vtype", "is_literal", "width"), ["wb", "band"]).where("vtype = 'numeric' and not is_literal")
    return own.withColumns({"strong": _hit(F.col("label"), STRONG), "weak": _hit(F.col("label"), WEAK), "check": _hit(F.col("label"), CHECKS), "output_sheet": _hit(F.col("sheet"), OUTPUT_SHEETS), "main_island": F.col("island") == 0, "unlabelled": F.col("label") == "", "presented_on": F.size("presented_on")})


def fallback(scored: DataFrame, most: int = 4) -> DataFrame:
    """Of each book the first candidates that are labelled and no checks, one for each label and sheet, those whose label
    names a result first."""
    some = scored.where("not check").where((F.trim("label") != "") & (F.col("score") > 0))
    one = some.withColumn("_i", F.row_number().over(W.partitionBy("wb", F.lower(F.trim("label")), "sheet").orderBy(F.desc("score"), "band"))).where("_i = 1")
    rank = F.row_number().over(W.partitionBy("wb").orderBy(F.desc(F.col("strong") | F.col("weak")), F.desc("score"), "band"))
    return one.withColumn("rank", rank).where(F.col("rank") <= most).drop("_i")


def cell_levels(nodes: DataFrame, edges: DataFrame, relaxations: int = 4) -> DataFrame:
    """(wb, id, level, cyclic): the longest path to each cell or range from one that nothing flows into.

    Operators and constants count as their cell, a range as a source. Cells on a circle or behind one are cyclic: they are
    put below their predecessors that are not, and then below each other in a few relaxations, each from the levels of
    the one before.
    """
    node = lambda c: F.struct("wb", F.col(c).alias("id"))
    real = nodes.where("kind not in ('op', 'const')").select(node("id").alias("id")).distinct()
    owner = nodes.select("wb", "id", F.coalesce("owner", "id").alias("own"))
    end = lambda c: owner.select("wb", F.col("id").alias(c), F.col("own").alias(f"_{c}"))
    links = settled(edges.join(end("src"), ["wb", "src"]).join(end("dst"), ["wb", "dst"]).where("_src <> _dst").select(node("_src").alias("src"), node("_dst").alias("dst")).distinct())
    free = settled(depths(links))
    held = settled(links.select(F.col("src").alias("id")).union(links.select("dst")).distinct().join(free, "id", "left_anti"))
    into = settled(links.join(held.withColumnRenamed("id", "dst"), "dst", "left_semi"))
    below = lambda placed: into.join(placed.select(F.col("id").alias("src"), "depth"), "src").groupBy(F.col("dst").alias("id")).agg((F.max("depth") + 1).alias("depth"))
    first = below(free)
    now = held.join(first, "id", "left").withColumn("depth", F.coalesce("depth", F.lit(0).cast("long")))
    for _ in range(relaxations):
        more = below(now).withColumnRenamed("depth", "_more")
        now = settled(now.join(more, "id", "left").select("id", F.greatest("depth", "_more").alias("depth")))
    levels = free.withColumn("cyclic", F.lit(False)).unionByName(now.withColumn("cyclic", F.lit(True)))
    out = real.join(levels, "id", "left")
    return out.select("id.wb", "id.id", F.coalesce("depth", F.lit(0).cast("long")).alias("level"), F.coalesce("cyclic", F.lit(False)).alias("cyclic"))
