import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import selection as S


def plain_cutoffs(deepest, stride, cap):
    out = list(range(0, deepest + 1, stride))
    out += [] if out[-1] == deepest else [deepest]
    if cap and len(out) > cap:
        out = [deepest] if cap == 1 else sorted({out[round(i * (len(out) - 1) / (cap - 1))] for i in range(cap)})
    return out


@pytest.mark.parametrize(("stride", "cap"), [(1, 0), (1, 1), (1, 2), (3, 4), (2, 5)])
def test_cutoffs(spark, stride, cap):
    deep = spark.createDataFrame([(f"w{n}", n) for n in range(25)], "wb string, deepest int")
    got = {}
    for r in S.cutoffs(deep, stride, cap).collect():
        got.setdefault(r.wb, []).append(r.cutoff)
    assert {w: sorted(x) for w, x in got.items()} == {f"w{n}": plain_cutoffs(n, stride, cap) for n in range(25)}


def test_picked_cutoffs(spark):
    rng = random.Random(1)
    rows = [(f"w{n}", c) for n in range(12) for c in rng.sample(range(30), n)]
    deep = spark.createDataFrame([(f"w{n}", 20) for n in range(12)], "wb string, deepest int")
    for count in (1, 3, 5):
        got = {}
        for r in S.picked_cutoffs(spark.createDataFrame(rows, "wb string, cutoff int"), deep, count).collect():
            got.setdefault(r.wb, []).append(r.cutoff)
        for n in range(12):
            able = sorted(c for w, c in rows if w == f"w{n}" and c < 20)
            own = got.get(f"w{n}", [])
            assert len(own) == len(set(own)) == min(count, len(able)) and set(own) <= set(able)
            if len(able) > count:
                assert {able[round(q * (len(able) - 1))] for q in (0.25, 0.5, 0.75)[:count]} <= set(own)


def test_kept_cells(spark):
    bands = spark.createDataFrame([("w", "A", 1, 1, 2, "input", "formula", "numeric"), ("w", "A", 2, 1, 2, "output", "formula", "numeric"), ("w", "A", 2, 2, 4, "input", "literal", "numeric"), ("w", "A", 3, 1, 1, "middle", "formula", "text"), ("w", "A", 4, 1, 3, "middle", "formula", "axis"), ("w", "A", 5, 1, 1, None, "formula", "axis"), ("w", "A", 9, 5, 4, "input", "formula", "numeric"), ("w", "A", 6, 1, 1, "output", "literal", "numeric")], "wb string, sheet string, row int, col_lo int, col_hi int, bucket string, kind string, vtype string")
    cells = spark.createDataFrame([("w", "A", 4, 1, "num", 2020.0, "0"), ("w", "A", 4, 2, "num", 45658.0, "MMM-yy"), ("w", "A", 4, 3, "num", 2020.5, None), ("w", "A", 5, 1, "date", None, None)], "wb string, sheet string, row int, col int, kind string, number double, number_format string")
    keep = lambda mode: {(r.row, r.col): r.admitted for r in S.kept_cells(bands, cells, mode).collect()}
    inputs = {(1, 1): None, (1, 2): None, (2, 3): None, (2, 4): None}
    assert keep("inputs") == inputs and keep("labels") == inputs | {(3, 1): None}
    assert keep("headers") == inputs | {(3, 1): None, (4, 1): "middle", (4, 2): "middle", (5, 1): "?"}
    assert {(r.row, r.col) for r in S.input_cells(bands).collect()} == set(inputs)
    values = S.output_values(bands, spark.createDataFrame([("w", "A", 2, 1, "num", 5.0), ("w", "A", 2, 2, "text", None)], "wb string, sheet string, row int, col int, kind string, number double"))
    assert [(r.row, r.col, r.number) for r in values.collect()] == [(2, 1, 5.0)]
    with pytest.raises(ValueError):
        S.kept_cells(bands, cells, "all")


def test_targets(spark):
    rows = [("w", "B", 1, 1, 5, False, False, "num", 1.0, None), ("w", "A", 2, 1, 5, False, False, "num", 1.0, None), ("w", "A", 1, 2, 5, False, True, "num", 1.0, None), ("w", "A", 1, 1, None, False, False, "num", 1.0, None), ("w", "A", 3, 1, 5, True, True, "num", 1.0, None), ("w", "A", 4, 1, 5, None, None, "text", None, "#N/A"), ("w", "A", 5, 1, 5, False, False, "blank", None, None), ("w", "A", 6, 1, 2, False, False, "num", 1.0, None)]
    df = spark.createDataFrame(rows, "wb string, sheet string, row int, col int, level int, cyclic boolean, volatile boolean, kind string, number double, text string")
    got = {(r.sheet, r.row, r.col): (r.excluded, r.place) for r in S.targets(df, F.lit(2)).collect()}
    assert got == {("A", 1, 1): ("unparsed", None), ("A", 1, 2): ("volatile", None), ("A", 2, 1): (None, 1), ("A", 3, 1): ("cycle", None), ("A", 4, 1): ("error_value", None), ("A", 5, 1): ("no_cached_value", None), ("B", 1, 1): (None, 2)}
