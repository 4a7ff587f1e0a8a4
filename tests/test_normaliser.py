import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import normaliser as N
from gridloom.operators import references as R


def plain_fixpoint(covers, holders):
    """(row: (round, leaks)) by whole rounds over all rows."""
    rows = {r for r, _, _ in covers}
    clean, gone, k = set(rows), {}, 0
    while True:
        k += 1
        held = {c for r, c, _ in covers if r in clean}
        now = {}
        for r in clean:
            keys = {x for s, _, x in covers if s == r and x is not None}
            leaks = sorted({c for c, x, pick in holders if x in keys and not pick and c not in held})
            if leaks:
                now[r] = (k, len(leaks), leaks[:4])
        if not now:
            return gone
        gone |= now
        clean -= set(now)


@pytest.mark.parametrize("seed", range(4))
def test_drops_that_follow_from_drops(spark, seed):
    rng = random.Random(seed)
    cells = [(f"c{i:03d}", rng.choice([None, *(f"k{j}" for j in range(60))]) if i % 9 else "hot", rng.random() < 0.1) for i in range(220)]
    value = {c: k for c, k, _ in cells}
    covers = [(f"r{r:02d}", c, value[c]) for r in range(45) for c in rng.sample(sorted(value), rng.randrange(1, 9))]
    covers += [("r99", "c005", value["c005"])] * 2
    got = N.leak_free(spark.createDataFrame(covers, "row string, cell string, key string"), spark.createDataFrame(cells, "cell string, key string, picklist boolean"))
    got = {r.row: (r["round"], r.n_leaks, r.leaks) for r in got.collect()}
    assert got == plain_fixpoint(covers, cells)


def test_a_chain_of_drops(spark):
    # row i covers cells a(i) with key i and b(i) with key i + 1; key 0 also stands in a cell of nobody
    covers = [(i, f"{w}{i:02d}", f"k{i + (w == 'b')}") for i in range(12) for w in "ab"] + [(50, "z1", "z"), (51, "z2", "z")]
    holders = [(c, k, False) for _, c, k in covers] + [("free", "k0", False), ("list", "z", True)]
    got = N.leak_free(spark.createDataFrame(covers, "row int, cell string, key string"), spark.createDataFrame(holders, "cell string, key string, picklist boolean"))
    assert {r.row: (r["round"], r.leaks) for r in got.collect()} == {0: (1, ["free"])} | {i: (i + 1, [f"b{i - 1:02d}"]) for i in range(1, 12)}
    none = spark.createDataFrame([], "row int, cell string, key string")
    assert N.leak_free(none, spark.createDataFrame(holders, "cell string, key string, picklist boolean")).count() == 0


def test_analyse(spark):
    t = lambda wb, sheet, row, col, v, formula=None: (wb, sheet, row, col, formula, "num" if isinstance(v, float) else "text", v if isinstance(v, float) else None, v if isinstance(v, str) else None)
    cells = [t("w", "In put", 1, 1, 5.5), t("w", "In put", 2, 1, 7.0), t("w", "In put", 3, 1, 8.0, "=A1+A2"), t("w", "Other", 1, 1, 7.0), t("w", "Lists", 1, 1, 5.5), t("w", "Lists", 2, 1, 5.50000000001), t("w", "Other", 4, 2, "x "), t("v", "Other", 1, 1, 5.5), t("w", "In put", 9, 3, 1.25), t("w", "In put", 9, 4, 1.25)]
    drafts = [("w", "ok", "'In put'!$A$1 at 5.5"), ("w", "leak", "see In put!A2"), ("w", "formula", "INPUT; in put!A1:A3"), ("w", "blank", "Other!A1:A2"), ("w", "sheet", "Nope!A1"), ("w", "prose", "no cell"), ("w", "text", "Other!B4"), ("w", "gone", "In put!C9"), ("w", "null", None), ("w", "pair", "In put!C9<br>In put!D9"), ("v", "ok", "Other!A1")]
    book = spark.createDataFrame(cells, "wb string, sheet string, row int, col int, formula string, kind string, number double, text string")
    held = book.where("not (sheet = 'In put' and row = 9 and col = 3)")
    got = {(r.wb, r.id): r for r in N.analyse(spark.createDataFrame(drafts, "wb string, id string, text string"), book.select("wb", "sheet").distinct(), book, held).collect()}
    assert {k: r.code for k, r in got.items()} == {("w", "ok"): None, ("w", "leak"): "duplicate_value_leak", ("w", "formula"): "formula_cell", ("w", "blank"): "blank_in_baseline", ("w", "sheet"): "unknown_sheet", ("w", "prose"): "unparsable_reference", ("w", "text"): None, ("w", "gone"): "blank_in_baseline", ("w", "null"): "unparsable_reference", ("w", "pair"): "blank_in_baseline", ("v", "ok"): None}
    assert got["w", "ok"].clean and got["w", "ok"].n_along == 2 and got["w", "ok"].n_cells == 1 and got["w", "leak"].leaks == ["Other!r1c1"]
    assert got["v", "ok"].n_along == 0 and got["w", "formula"].codes == ["formula_cell"]


@pytest.mark.parametrize(("text", "want"), [
    ("Rate in Inputs!B2 and 'Cash Flow'!$C$3:$D4.", [("Inputs", "B2"), ("Cash Flow", "C3:D4")]),
    ("`Cash Flow!A1`; cash flow!A1", [("Cash Flow", "A1")]),
    ("Inputs!A1,Inputs!A1 then =INPUTS!AA10", [("Inputs", "A1"), ("Inputs", "AA10")]),
    ("Flow!A1", [("Flow", "A1")]), ("no", []), (None, []), ("!A1", []), ("a sheet of a name far longer than any may be!A1", [("f a name far longer than any may be"[-31:].strip(), "A1")]),
])
def test_references_in_prose(spark, text, want):
    df = spark.createDataFrame([("w", text)], "wb string, t string")
    sheets = spark.createDataFrame([("w", "Inputs"), ("w", "Cash Flow"), ("v", "Flow")], "wb string, sheet string")
    assert [(r.sheet, r.box) for r in R.prose_references(df, "t", sheets, ["wb"]).first().refs] == want


def test_boxes_by_brute_force(spark):
    rng = random.Random(3)
    cells = [("s", rng.randrange(1, 300_000) if i % 2 else rng.randrange(1, 200), rng.randrange(1, 40)) for i in range(1500)]
    boxes = []
    for i in range(120):
        r, c = rng.randrange(1, 150), rng.randrange(1, 40)
        boxes.append((i, "s", r, c, r + rng.choice([0, 3, 63, 64, 100, 9000, 250_000]), c + rng.randrange(0, 9)))
    boxes.append((999, "s", 9, 9, 3, 3))
    got = sorted((r.i, r.row, r.col) for r in R.inside(spark.createDataFrame(boxes, "i int, sheet string, r1 long, c1 long, r2 long, c2 long"), spark.createDataFrame(cells, "sheet string, row long, col long"), ["sheet"]).collect())
    assert got == sorted((i, r, c) for i, _, r1, c1, r2, c2 in boxes for _, r, c in cells if r1 <= r <= r2 and c1 <= c <= c2)


def test_corners(spark):
    got = spark.createDataFrame([("A1",), ("xfd12",), ("AB3:ZZ40",)], "b string").select(*R.corners(F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(1, 1, 1, 1), (12, 16384, 12, 16384), (3, 28, 40, 702)]


def test_table_faults(spark):
    table = "| Variable | Workbook cells and values | Source |\n|---|---|---|\n| Rate | In!A1 is 0.070 | web |\n| Cost | 99 and In!A1:B2 | 12345 |\nnot 77"
    tables = spark.createDataFrame([("w", 1, table), ("w", 2, None)], "wb string, id int, text string")
    inventory = spark.createDataFrame([("w", "In", 1, 1, 2, 1, '{"band": "In!A1:A2", "v": 7e-2}')], "wb string, sheet string, r1 long, c1 long, r2 long, c2 long, encoded string")
    got = sorted((r.fault, r.said, r.row) for r in N.table_faults(tables, inventory, inventory.select("wb", "sheet")).collect())
    assert got == [("reference", "In!A1:B2", None), ("value", "99", "Cost")]
