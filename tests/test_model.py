import pytest

from gridloom.functions import model as K
from gridloom.functions.formula import parse
from gridloom.operators import graph as G
from gridloom.operators import model as M
from gridloom.operators import workbook as B
from gridloom.sources import workbook as S

BOOK = {
    "Calc": {"A1": "Year", "B1": 2020.0, "C1": ("=B1+1", 2021.0), "D1": ("=C1+1", 2022.0), "A2": "Revenue", "B2": 100.0, "C2": ("=B2*1.07", 107.0), "D2": ("=C2*1.07", 114.49), "A3": "Total revenue", "B3": ("=SUM(B2:D2)", 321.49),
             "A4": "Loop", "B4": ("=C4+1", 0.0), "C4": ("=B4*0.5", 0.0), "A5": "Five", "B5": ("=5", 5.0), "B6": ("=Z99", 0.0), "A7": "Check", "B7": ("=B3-B3", 0.0), "B8": "=SUM(", "A9": "usd", "B9": ("=CONCAT(A9)", "usd")},
    "Summary": {"A1": "Headline", "B1": ("=Calc!B3", 321.49), "A2": "IRR", "B2": ("=IF(Calc!B3>0,Calc!B3/Rate,0)", 3.2), "C2": ('=INDIRECT("Calc!B"&2)', 100.0), "D2": ("=[1]Other!A1+NoName", 0.0)},
}


@pytest.fixture(scope="module")
def graph(spark):
    cells = G.settled(B.scan(spark.createDataFrame([("w", bytearray(S.write(BOOK)))], "wb string, content binary")))
    names = spark.createDataFrame([("w", None, "Rate", "Calc!$B$2")], "wb string, sheet string, name string, target string")
    nodes, edges = M.formula_graph(cells, names)
    return cells, nodes, edges, G.settled(M.classified(nodes, edges, M.labels(cells)))


def test_edges(graph):
    got = {(r.src, r.dst, r.role, r.arg_index, r.via_range, r.cross_sheet) for r in graph[2].collect()}
    assert {("Calc!B2", "Calc!B3#0:SUM", "summand", 0, "B2:D2", False), ("Calc!D2", "Calc!B3#0:SUM", "summand", 0, "B2:D2", False), ("Calc!B3#0:SUM", "Calc!B3", "result", 0, "", False)} <= got
    assert {("Calc!B3", "Summary!B1", "identity", 0, "", True), ("Calc!B5#0:const", "Calc!B5", "constant", 0, "", False), ("Calc!B2", "Summary!B2#2:/", "rhs", 1, "", True)} <= got
    assert {("Summary!B2#1:>", "Summary!B2#4:IF", "condition", 0, "", False), ("Summary!B2#3:const", "Summary!B2#4:IF", "else", 2, "", False), ("Calc!B2", "Summary!C2#3:INDIRECT", "resolved", 1, "Calc!B2", True)} <= got
    kinds = {r.id: r.kind for r in graph[1].collect()}
    assert kinds["name:NoName"] == "name" and kinds["external:'[1]Other'!A1"] == "external" and kinds["Calc!B8"] == "formula" and kinds["Calc!A1"] == "label"
    stats = {(r.stat, r.name): r.n for r in M.graph_stats(graph[1], graph[2]).collect()}
    assert stats["role", "resolved"] == 1 and stats["op", "+"] == 4 and stats["cross_sheet", None] == 5


def test_classes(graph):
    own = {r.id: r for r in graph[3].collect()}
    assert {i: own[i].vtype for i in ("Calc!A1", "Calc!B1", "Calc!C1", "Calc!B2", "Calc!B8", "Calc!B9", "Calc!B5")} == {"Calc!A1": "text", "Calc!B1": "axis", "Calc!C1": "axis", "Calc!B2": "numeric", "Calc!B8": "blank", "Calc!B9": "unit", "Calc!B5": "numeric"}
    assert {i for i, r in own.items() if r.is_mirror} == {"Summary!B1"} and {i for i, r in own.items() if r.is_literal} == {"Calc!B5"} and {i for i, r in own.items() if r.empty_ref} == {"Calc!B6"}
    assert own["Calc!D2"].label == "Revenue" and own["Summary!C2"].label == "IRR" and own["Calc!B6"].label == ""


def test_bands_and_condensation(graph):
    cells, nodes, edges, own = graph
    bands, members = M.model_bands(own)
    more, links = M.promoted(bands, members, nodes)
    bands, between = G.settled(bands.unionByName(more)), M.band_edges(M.cell_edges(nodes, edges), members).unionByName(links)
    by = {r.band: r for r in bands.collect()}
    assert by["Calc!C2:D2"].width == 2 and by["Calc!C2:D2"].label == "Revenue" and by["Calc!C2:D2#lit=1.07"].label == "Revenue [hardcoded 1.07]" and by["Summary!B1"].is_mirror and not by["Calc!C1:D1"].is_mirror
    comps, _ = M.condensed(bands, between)
    at = {r.band: r for r in comps.collect()}
    assert at["Calc!B4"].comp == at["Calc!C4"].comp and at["Calc!B4"].on_circle and not at["Calc!B3"].on_circle and "Summary!B1" not in at
    assert [at[b].depth for b in ("Calc!B2", "Calc!C2:D2", "Calc!B3", "Calc!B7")] == [0, 1, 2, 3] and at["Calc!B3"].fan_in == 1 and at["Calc!B3"].presented_on == ["Summary"]
    assert all(at[a].place < at[b].place for a, b in (("Calc!B2", "Calc!C2:D2"), ("Calc!C2:D2", "Calc!B3"), ("Calc!B3", "Summary!B2")))
    scores = {r.band: r.score for r in G.score(M.candidate_features(bands, comps)).collect()}
    assert scores["Summary!B2"] == 9.0 and "Calc!B7" not in scores and "Calc!B4" not in scores
    levels = {r.id: (r.level, r.cyclic) for r in M.cell_levels(nodes, edges).collect()}
    assert levels["Calc!B2"] == (0, False) and levels["Calc!B3"] == (3, False) and levels["Calc!B4"][1] and levels["Calc!C4"][1]


def test_large_ranges_are_nodes(graph, spark):
    nodes, edges = M.formula_graph(graph[0], most=2)
    ranges = [r for r in nodes.where("kind = 'range'").collect()]
    assert [(r.id, r.n) for r in ranges] == [("Calc!B2:D2", 3)]
    assert {r.src for r in M.cell_edges(nodes, edges).where("dst = 'Calc!B3'").collect()} == {"Calc!B2", "Calc!C2", "Calc!D2"}
    assert {r.id: r.level for r in M.cell_levels(nodes, edges).collect()}["Calc!B3"] == 1  # a range is a source


def test_references():
    book = K.Book([("A", 1, 1), ("B", 1, 1), ("C", 1, 1), ("A", 2, 1)], {(None, "N"): "A!$A$1,B!$A$1", ("C", "N"): "C!$A$1", (None, "LOOP"): "LOOP", (None, "BAD"): "A!#REF!"}, ["A", "B", "C"])
    ids = lambda text, sheet="A": [t[0] for t in book.targets(parse(text), sheet)]
    assert ids("=N") == ["A!A1", "B!A1"] and ids("=N", "C") == ["C!A1"] and ids("=A:A") == ["A!A1", "A!A2"] and ids("=A9") == []
    assert ids("=LOOP") == ["name:LOOP"] and ids("=BAD") == ["name:BAD"] and ids("=Gone!A1") == ["name:Gone!A1"]


def test_no_task_holds_a_book(spark, monkeypatch):
    cell = "wb string, sheet string, sheet_idx int, row int, col int, a1 string, formula string, is_array boolean, kind string, number double, text string"
    rows = [("w", "S", 0, i, 1, None, None, False, "num", float(i), None) for i in range(1, 301)] + [("w", "S", 0, i, 2, None, f"=A{i}*2", False, "num", 2.0 * i, None) for i in range(1, 301)]
    rows += [("w", "S", 0, 1, 3, None, "=SUM(A:A)+SUM(A1:A300)", False, "num", 0.0, None), ("w", "S", 0, 2, 3, None, '=INDIRECT("OFFSET(A1,1,1)")', False, "num", 0.0, None)]
    plans, kept = [], M.settled
    monkeypatch.setattr(M, "settled", lambda df: plans.append(df._jdf.queryExecution().toString()) or kept(df))
    nodes, edges = M.formula_graph(spark.createDataFrame(rows, cell))
    assert [(r.id, r.n) for r in nodes.where("kind = 'range'").collect()] == [("S!A1:A300", 300)] and edges.where("src = 'S!A1:A300'").count() == 2
    assert edges.where("src like 'S!A%' and via_range = ''").count() == 300 and edges.where("role = 'resolved'").isEmpty()
    assert plans and not any("GroupsInPandas" in p for p in plans)
