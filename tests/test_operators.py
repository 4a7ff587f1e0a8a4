from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridloom.functions import columns as X
from gridloom.functions import interpreter as I
from gridloom.operators import audit, grading, graph, records
from gridloom.operators import workbook as W
from gridloom.sources import workbook as B
from gridloom.sources.shipping import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("column", "formula"),
    [
        (lambda: X.pmt(0.01, 12, 1000.0), "=PMT(0.01,12,1000)"), (lambda: X.ipmt(0.01, 3, 12, 1000.0, 0.0, 1), "=IPMT(0.01,3,12,1000,0,1)"), (lambda: X.ppmt(0.01, 3, 12, 1000.0), "=PPMT(0.01,3,12,1000)"), (lambda: X.fv(0.0, 12, -10.0, 5.0), "=FV(0,12,-10,5)"), (lambda: X.pv(0.01, 12, -10.0, 7.0, 1), "=PV(0.01,12,-10,7,1)"),
        (lambda: X.nper(0.01, -100.0, 1000.0), "=NPER(0.01,-100,1000)"), (lambda: X.mround(F.lit(-7.0), -5.0), "=MROUND(-7,-5)"), (lambda: X.mod(F.lit(3.0), -2.0), "=MOD(3,-2)"), (lambda: X.round_half_away(F.lit(-2.5)), "=ROUND(-2.5,0)"), (lambda: X.days360(F.lit(40573.0), F.lit(40602.0)), "=DAYS360(40573,40602)"),
        (lambda: X.yearfrac(F.lit(40909.0), F.lit(41120.0), 4), "=YEARFRAC(40909,41120,4)"), (lambda: X.networkdays(F.lit(41334.0), F.lit(41183.0)), "=NETWORKDAYS(41334,41183)"), (lambda: X.datedif(F.lit(37043.0), F.lit(37483.0), "YD"), '=DATEDIF(37043,37483,"YD")'), (lambda: X.datedif(F.lit(37043.0), F.lit(37483.0), "MD"), '=DATEDIF(37043,37483,"MD")'),
        (lambda: X.weekday(F.lit(39492.0)), "=WEEKDAY(39492)"), (lambda: X.edate(F.lit(40574.0), 1), "=EDATE(40574,1)"), (lambda: X.proper(F.lit("2-way o'neil")), '=PROPER("2-way o\'neil")'), (lambda: X.substitute(F.lit("a-a-a"), "a", "b", 2), '=SUBSTITUTE("a-a-a","a","b",2)'), (lambda: X.right(F.lit("abc"), 5), '=RIGHT("abc",5)'),
        (lambda: X.mirr(F.array(*(F.lit(float(v)) for v in (-120000, 39000, 30000, 21000, 37000, 46000))), 0.1, 0.12), "=MIRR({-120000,39000,30000,21000,37000,46000},0.1,0.12)"),
    ],
)
def test_columns_and_interpreter_agree(spark, column, formula):
    want = I.Workbook({("S", 1, 1): formula}).evaluate()["S", 1, 1]
    got = one(spark, column())
    assert got == (pytest.approx(want, rel=1e-9) if isinstance(want, float) else want)


def test_errors_are_null(spark):
    assert all(one(spark, c) is None for c in (X.divide(F.lit(1.0), F.lit(0.0)), X.mround(F.lit(5.0), -2.0), X.ln(F.lit(0.0)), X.power(F.lit(-8.0), 1 / 3), X.find("z", F.lit("abc")), X.pass_at(5, F.lit(3), F.lit(1)), X.ipmt(0.1, 9, 5, 1.0), X.left(F.lit("a"), -1)))


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def test_graph_with_a_circle(spark):
    e = edges(spark, [("a", "b"), ("b", "c"), ("c", "b"), ("c", "d"), ("x", "y"), ("m", "y")])
    got = {(r.seed, r.id): r.hops for r in graph.closure(e, spark.createDataFrame([("a",), ("y",)], "seed string")).collect()}
    assert got == {("a", "a"): 0, ("a", "b"): 1, ("a", "c"): 2, ("a", "d"): 3, ("y", "y"): 0}
    assert {r.id: r.depth for r in graph.depths(e).collect()} == {"a": 0, "x": 0, "m": 0, "y": 1}
    assert {r.id: r.island for r in graph.islands(e).collect()} == {"a": "a", "b": "a", "c": "a", "d": "a", "x": "m", "y": "m", "m": "m"}
    through, shown = graph.bypass(edges(spark, [("a", "m1"), ("m1", "m2"), ("m2", "z"), ("a", "z2")]), spark.createDataFrame([("m1",), ("m2",)], "id string"))
    assert sorted(map(tuple, through.collect())) == [("a", "z"), ("a", "z2")] and [tuple(r) for r in shown.collect()] == [("a", 2)]


def test_buckets(spark):
    e = edges(spark, [("in", "mid"), ("mid", "out"), ("in", "dead"), ("lone", "off"), ("off", "off2")])
    nodes = spark.createDataFrame([(x,) for x in ("in", "mid", "out", "dead", "lone", "off", "off2", "single")], "id string")
    got = {r.id: r.bucket for r in graph.buckets(nodes, e, spark.createDataFrame([("out",)], "id string")).collect()}
    assert got == {"in": "input", "mid": "middle", "out": "output", "dead": "dead", "lone": "unused_input", "off": "detached", "off2": "detached", "single": "unused_input"}


def test_grading_weights_and_tolerance(spark):
    t = spark.createDataFrame([("t", "a", "g", 100.0), ("t", "b", "g", 100.0), ("t", "c", None, 50.0)], "task string, ref string, grp string, expected double")
    a = spark.createDataFrame([("t", "a", 100.00001), ("t", "b", 50.0)], "task string, ref string, given double")
    rows = {r.ref: r for r in grading.grade(t, a, 1e-6, 1e-6).collect()}
    assert rows["a"].exact and rows["b"].score == pytest.approx(0.5) and rows["c"].score == 0.0
    assert [rows[k].weight for k in "abc"] == pytest.approx([0.25, 0.25, 0.5])
    s = grading.summary(grading.grade(t, a, 1e-6, 1e-6)).first()
    assert s.score == pytest.approx(0.375) and s.discrete == 0.0 and s.coverage == pytest.approx(2 / 3)


def test_pass_at_k(spark):
    assert one(spark, X.pass_at(1, F.lit(4), F.lit(1))) == pytest.approx(0.25) and one(spark, X.pass_at(2, F.lit(4), F.lit(3))) == 1.0


def test_records(spark):
    df = spark.createDataFrame([(1, "Net Debt 2020", "EUR m"), (2, "Debt net", "EUR m"), (3, None, "EUR m")], "id long, metric string, unit string")
    assert [r.id for r in records.with_tokens(df, metric="net debt", unit="eur").collect()] == [1]
    with pytest.raises(ValueError):
        records.with_tokens(df, metric="x", unit="")
    assert [r.id for r in records.search(df, "debt EUR", "id", "metric", "unit").collect()][:1] == [1]


def test_leaks_meet_across_rounding(spark):
    cells = spark.createDataFrame([(1, 61.5989123456), (2, 61.6), (3, 4.0), (4, -61.5989123456), (5, 20000.0)], "id long, value double")
    got = {r.id: r.kind for r in audit.leaks(cells, spark.createDataFrame([(61.5989123456,), (4.0,), (20000.0,)], "target double")).collect()}
    assert got == {1: "deny", 2: "suspect", 5: "deny"}
    assert one(spark, audit.numbers_in(F.lit("IRR came to 23.4% on 1,250 units"))) == pytest.approx([23.4, 1250.0, 0.234])
    assert one(spark, audit.salvaged(F.lit('{"a": 1, "b": -2.5, "c": 3'))) == {"a": "1", "b": "-2.5"}


def test_leaks_meet_on_both_sides_of_a_rounding_edge(spark):
    pairs = [(1234.5, 1234.4999999999998), (1234.4999999999998, 1234.5), (9999.6, 10000.4), (10000.4, 9999.6), (9999.5, 9999.499999999998), (-0.99995, -0.9999499999999999), (3e-13, 7e-13), (2.5e-9, 2.5004e-9), (3e-13, -3e-13)]
    pairs += [(1234.4, 1234.6), (9999.4, 9999.6), (10000.4, 10006.0), (1234.5, -1234.5), (2e-9, 2.1e-9)]
    want = ["deny", "deny", "suspect", "suspect", "deny", "deny", "deny", "deny", "deny"] + [None] * 5
    for (t, v), kind in zip(pairs, want, strict=True):
        got = audit.leaks(spark.createDataFrame([(v,)], "value double"), spark.createDataFrame([(t,)], "target double")).collect()
        assert [r.kind for r in got] == ([kind] if kind else []), (t, v)


def test_workbooks(spark, tmp_path):
    book = {"M": {"A1": "Revenue", "B1": 100.0, "C1": 110.0, "B2": ("=B1*0.2", 20.0), "C2": ("=C1*0.2", 23.0), "B3": "=B2*5", "B4": "=SUM(B1:C3)", "B5": "=NOSUCH(1)"}}
    (tmp_path / "m1.xlsx").write_bytes(B.write(book))
    (tmp_path / "bad.xlsx").write_bytes(b"no zip")
    cells = W.scan(W.files(spark, f"file://{tmp_path}")).cache()
    assert cells.where("wb = 'bad'").first().kind == "error"
    cells = cells.where("wb = 'm1'")
    values = {(r.row, r.col): r for r in W.evaluate(cells).collect()}
    assert values[2, 2].number == 20.0 and values[3, 2].number == 100.0 and values[4, 2].number == 352.0 and values[5, 2].kind == "unknown"
    verdicts = {(r.row, r.col): r.verdict for r in W.verify(cells, W.evaluate(cells)).collect()}
    assert verdicts == {(2, 2): "match", (2, 3): "mismatch", (3, 2): "unverifiable", (4, 2): "unverifiable", (5, 2): "unresolved"}
    bands = {(r.row, r.col_lo, r.col_hi, r.kind) for r in W.bands(cells).collect()}
    assert {(1, 1, 1, "label"), (1, 2, 3, "input"), (2, 2, 3, "formula")} <= bands
    e = defaultdict(set)
    for r in W.edges(cells).collect():
        e[r.dst].add(r.src)
    assert e["M!R3C2"] == {"M!R2C2"} and len(e["M!R4C2"]) == 6
    boxed = W.edges(cells, most=3)
    assert boxed.where("dst = 'M!R4C2'").count() == 1 and boxed.where("dst like '%:%'").count() == 5


def test_streams(spark, tmp_path):
    import datetime as dt

    from gridloom.streaming import releases as S

    rows = [(1, 10, dt.datetime(2020, 1, 1), True), (1, 11, dt.datetime(2020, 1, 2), False), (2, 12, dt.datetime(2020, 1, 1), True), (1, 9, dt.datetime(2019, 1, 1), True)]
    spark.createDataFrame(rows, "k long, rec long, at timestamp, ok boolean").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k long, rec long, at timestamp, ok boolean").parquet(f"{tmp_path}/in")
    for name, df, mode in (("cur", S.current_releases(stream, "k", "at", "rec"), "update"), ("win", S.attempt_scores(stream, "at", "ok", "1 day"), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert {r.k: r.rec for r in spark.table("cur").collect()} == {1: 11, 2: 12}
    assert sorted((r.attempts, r.passed) for r in spark.table("win").collect()) == [(1, 0), (1, 1), (2, 2)]


def test_contained_by_brute_force(spark):
    import random

    rng = random.Random(2)
    phrases = [(i, "".join(rng.choice("ab c") for _ in range(rng.randrange(1, 6)))) for i in range(40)] + [(90, None), (None, "a")]
    texts = [(i, "".join(rng.choice("ab c") for _ in range(rng.randrange(12)))) for i in range(200)] + [(900, None), (None, "abab")]
    docs, few = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(phrases, "item_id long, text string")
    want = sorted(((i, min(p for p, x in phrases if x is not None and p is not None and x in t)) for i, t in texts if t is not None and any(x is not None and p is not None and x in t for p, x in phrases)), key=str)
    for most in (10**6, 30):
        assert sorted(map(tuple, audit.contained(docs, "doc_id", "text", few, "item_id", "text", most).collect()), key=str) == want
    assert audit.contained(docs, "doc_id", "text", few.limit(0), "item_id", "text").count() == 0
    assert audit.contained(docs.limit(0), "doc_id", "text", few, "item_id", "text").count() == 0


def test_quantiles_by_numpy(spark):
    import random

    import numpy as np
    from gridloom.operators import series

    rng = random.Random(4)
    rows = [(g, float(rng.choice([rng.randrange(5), rng.random() * 1000]))) for g in "abc" for _ in range(rng.choice([1, 2, 7, 300]))] + [("d", 3.0)] * 40 + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in series.quantiles(df, "g", "v", {"q1": 0.25, "med": 0.5, "top": 1.0}).collect()}
    for g in "abcd":
        own = [v for k, v in rows if k == g and v is not None]
        assert [got[g].q1, got[g].med, got[g].top] == pytest.approx([np.percentile(own, 25), np.median(own), max(own)])


def test_reach(spark):
    e = edges(spark, [("a", "b"), ("b", "c"), ("c", "b"), ("c", "d"), ("x", "y")])
    seeds = spark.createDataFrame([("b",), ("x",)], "id string")
    assert {r.id for r in graph.reach(e, seeds).collect()} == {"b", "c", "d", "x", "y"}
    assert {r.id for r in graph.reach(e, seeds, backward=True).collect()} == {"a", "b", "c", "x"}


def test_answers_as_text(spark):
    g = {r.x: grading for r in spark.range(1).select(F.lit(1).alias("x")).collect()}[1]
    values = ["1,234.5", " 12 %", "true", "nan", "inf", "abc", "-3", None]
    got = [r.n for r in spark.createDataFrame([(v,) for v in values], "v string").select(g.as_number("v").alias("n")).collect()]
    assert got == [1234.5, 12.0, None, None, None, None, -3.0, None]
    targets = spark.createDataFrame([("t", "A1", "1,000"), ("t", "A2", "Yes"), ("u", "B1", "5"), ("v", "C1", "x")], "task string, ref string, expected string")
    answers = spark.createDataFrame([("t", "A1", "1000.0000001"), ("t", "A2", " Yes "), ("u", "answer", "5")], "task string, ref string, given string")
    assert sorted(map(tuple, g.grade_text(targets, answers, 1e-6, 1e-6).collect())) == [("t", "A1", False, True), ("t", "A2", True, True), ("u", "B1", False, True), ("v", "C1", True, False)]


def test_chains_that_end_and_circles(spark):
    links = [(1, 2), (2, 3), (3, None), (4, 5), (5, 4), (6, 4), (7, 99), (8, None), (9, 9)] + [(100 + i, 101 + i if i < 40 else None) for i in range(41)]
    got = {r.id: (r.end, r.steps, r.ends) for r in records.chain_ends(spark.createDataFrame(links, "id long, nxt long"), "id", "nxt").collect()}
    assert [got[i] for i in (1, 2, 3, 8, 100)] == [(3, 2, True), (3, 1, True), (3, 0, True), (8, 0, True), (140, 40, True)]
    assert all(got[i] == (None, None, False) for i in (4, 5, 6, 7, 9))


def test_names_and_settings_reach_the_evaluator(spark):
    content = bytearray(B.write({"S": {"A1": 4.0, "B1": "=Rate*2", "B2": "=B3+1", "B3": "=B2*0.5"}}, {"Rate": "S!$A$1"}))
    books = spark.createDataFrame([("w", content)], "wb string, content binary")
    cells = W.scan(books)
    assert [tuple(r) for r in W.names(books).collect()] == [("w", None, "RATE", "S!$A$1")] and [r.sheet for r in W.sheets(books).collect()] == ["S"]
    assert [(r.iterate, r["count"], r.delta) for r in W.settings(books).collect()] == [(False, 100, 0.001)]
    got = {(r.row, r.col): (r.kind, r.number, r.text) for r in W.evaluate(cells, names=W.names(books), settings=W.settings(books)).collect()}
    assert got[1, 2] == ("num", 8.0, None) and got[2, 2] == ("unknown", None, "circular-reference")
    got = {(r.row, r.col): r.kind for r in W.evaluate(cells).collect()}
    assert got[1, 2] != "num" and got[2, 2] == "num"


def test_long_chains_of_cells_are_evaluated():
    n = 30_000
    cells = {("S", 1, 1): 1.0} | {("S", r, 1): f"=A{r - 1}+1" for r in range(2, n)} | {("S", 1, 2): f"=A{n - 1}"}
    assert I.Workbook(dict(reversed(cells.items()))).evaluate()["S", 1, 2] == n - 1
    own = I.Workbook({("S", 1, 1): 1.0, ("S", 2, 1): 2.0, ("S", 1, 2): "=N", ("T", 1, 1): "=N"}, names={"N": "S!A1", "T!N": "S!A2"}).evaluate()
    assert own["S", 1, 2] == 1.0 and own["T", 1, 1] == 2.0


def test_leaks_by_brute_force(spark):
    import math
    import random

    rng = random.Random(6)
    base = [rng.choice([1, -1]) * rng.random() * 10 ** rng.randrange(-13, 6) for _ in range(60)] + [1e-8, 1.99999e-8, 2e-8, 1e-12, 9999.5, 0.99995, 3e-12, -3e-12]
    targets = [(x,) for x in base]
    cells = [(i, x + rng.choice([0, 1, -1, 0.5, -0.5, 3]) * 1e-12 * max(1, abs(x)) * rng.choice([0, 0.9, 1.1])) for i, x in enumerate(base * 6)] + [(1000 + i, rng.choice(base) * (1 + rng.random() * 1e-3)) for i in range(100)]

    def form(x):
        power = math.floor(math.log10(abs(x))) - 3
        return power * 9000 + math.floor(abs(x) / 10.0**power + 0.5)

    want = []
    for i, v in cells:
        for (t,) in targets:
            if v != 0 and t != 0 and not (v == math.floor(v) and abs(v) < 10000):
                exact = abs(v - t) <= 1e-12 * max(1, abs(t))
                if exact or (v > 0) == (t > 0) and form(v) == form(t):
                    want.append((i, t, "deny" if exact else "suspect"))
    got = audit.leaks(spark.createDataFrame(cells, "id long, value double"), spark.createDataFrame(targets, "target double")).select("id", "target", "kind").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_numbers_are_decimal(spark):
    from gridloom.functions.columns import digits12, plain_number

    rows = [("5d", None), ("12f", None), ("0x1p3", None), ("1,234", None), (" 1.5e3 ", 1500.0), ("-.5", -0.5), ("5.", 5.0), ("5.e2", 500.0), ("1e400", float("inf")), ("inf", float("inf")), ("", None), (None, None), ("--1", None)]
    df = spark.createDataFrame(rows, "x string, want double").withColumn("got", plain_number("x"))
    assert all(r.got == r.want for r in df.collect())
    assert one(spark, grading.as_number(F.lit("5d"))) is None and one(spark, grading.as_number(F.lit("1,234%"))) == 1234.0
    values = [1e-13, 0.0, 1.07, -2.5, 100.0, 123456789012.0, 1e12, 1.23456789012345e15, 1e-4, 9.99999999999e-5, 1 / 3, 1e100, -1e-300, 0.1 + 0.2]
    got = spark.createDataFrame([(v,) for v in values], "v double").withColumn("t", digits12(F.col("v"))).collect()
    assert [r.t for r in got] == [f"{r.v:.12g}" for r in got]


def test_answers_that_are_given_twice(spark):
    targets = spark.createDataFrame([("t", "a", "g", 1.0), ("t", "b", "g", 2.0)], "task string, ref string, grp string, expected double")
    answers = spark.createDataFrame([("t", "a", 1.0), ("t", "a", 5.0), ("t", "b", 2.0)], "task string, ref string, given double")
    got = {r.ref: (r.exact, r.weight) for r in grading.grade(targets, answers, 1e-9, 1e-6).collect()}
    assert got == {"a": (True, 0.5), "b": (True, 0.5)}


def test_requests_for_records(spark):
    rows = [("d", i, "Net margin" if i % 2 else "Cost", "percent", ["NM", "margin, net"]) for i in range(1, 10)] + [("e", 50, "Net margin", "percent", None)]
    found = spark.createDataFrame(rows, "dataset_id string, id int, metric string, unit string, metric_aliases array<string>")
    asked = [(1, "d", {"metric": "net margin", "unit": "Percent"}, 0, 5), (2, "d", {"metric": "margin net", "unit": "percent"}, 7, 5), (3, "d", {"metric": "margin"}, 0, 5), (4, "x", {"metric": "m", "unit": "u"}, 0, 5), (5, "d", {"metric": "%", "unit": "percent"}, 0, 5), (6, "d", {"metric": "nothing", "unit": "percent"}, 0, 5), (7, "e", {"unit": "percent", "metric": "net"}, None, None), (8, "d", None, 0, 5), (9, "d", {"metric": "cost", "unit": "percent"}, 99, 1)]
    requests = spark.createDataFrame(asked, "request int, dataset_id string, filters map<string,string>, cursor int, limit int")
    got = {r.request: (r.error, r["rows"], r.total, r.next_cursor) for r in records.answered(requests, found, found.select("dataset_id"), ["metric", "unit"]).collect()}
    assert got[1] == (None, [1, 3, 5, 7, 9], 5, None) and got[2] == (None, [8, 9], 9, None) and got[7] == (None, [50], 1, None)
    assert [got[i][0] for i in (3, 4, 5, 8)] == ["too few filters", "unknown dataset", "a filter without letters or digits", "too few filters"] and got[4][1] is None
    assert got[6] == (None, [], 0, None) and got[9] == (None, [], 4, None)
    assert [r.id for r in records.listed(found, "id", 2, metric="net").collect()] == [1, 3]
    out = {r.id: r.error for r in records.fetched(spark.createDataFrame([(1,), (77,)], "id int"), found, "id").collect()}
    assert out == {1: None, 77: "unknown id: 77"}


def test_requests_that_ask_the_same_are_one_question(spark, monkeypatch):
    found = spark.range(300).selectExpr("'d' dataset_id", "id", "'Net margin' metric", "'percent' unit", "cast(null as array<string>) metric_aliases")
    requests = spark.range(2000).selectExpr("id request", "'d' dataset_id", "map('metric', if(id % 2 = 0, 'net', 'MARGIN'), 'unit', 'percent') filters", "cast(id % 310 as int) cursor", "2 limit")
    met, kept = [], records.settled
    monkeypatch.setattr(records, "settled", lambda df: met.append(kept(df)) or met[-1])
    got = {r.request: (r["rows"], r.total, r.next_cursor) for r in records.answered(requests, found, found.select("dataset_id"), ["metric", "unit"]).collect()}
    assert all(got[i] == ([x for x in (i % 310, i % 310 + 1) if x < 300], 300, i % 310 + 2 if i % 310 < 298 else None) for i in range(2000))
    hits = [df.count() for df in met if "_i" in df.columns]
    assert hits == [600]  # two questions, each with 300 records, not a row for each request and record


def test_boxes_of_all_heights_meet_cells_in_tiles_of_their_size(spark):
    from gridloom.operators import references

    tiles, heights = references.TILES, [1, 63, 64, 65, 340, 512, 513, 4097, 40_000, 300_000, 3_000_000]
    assert all(b <= 8 * a for a, b in zip(tiles, tiles[1:]))
    boxes = spark.createDataFrame([("b", i, 60 + i, 2, 59 + i + h, 3) for i, h in enumerate(heights)], "wb string, i int, r1 long, c1 long, r2 long, c2 long")
    rows = [r for h in heights for r in (59, 60, 70, h + 59, h + 60, h + 75)]
    cells = spark.createDataFrame([("b", r, c) for r in sorted(set(rows)) for c in (1, 2, 4)], "wb string, row long, col long")
    got = sorted((r.i, r.row, r.col) for r in references.inside(boxes, cells, ["wb"]).collect())
    assert got == sorted((i, r, 2) for i, h in enumerate(heights) for r in set(rows) if 60 + i <= r <= 59 + i + h)


def test_edges_are_folded_over_batches():
    import pandas as pd

    ring = [pd.DataFrame({"a": [i], "b": [i + 1]}) for i in range(100)]
    assert [len(x) for x in graph._stars(iter(ring))] == [100] and set(next(graph._stars(iter(ring)))["b"]) == {0}


@pytest.mark.parametrize("most", [0, 1000])
def test_only_first_words_of_phrases_are_shuffled(spark, monkeypatch, most):
    from gridloom.operators import values

    monkeypatch.setattr(values, "MOST_FIRSTS", most)
    targets = spark.createDataFrame([("a", 1, "text", None, "net income", None), ("a", 2, "text", None, "!!", None), ("b", 3, "text", None, "net", None)], "book string, id int, kind string, number double, text string, day date")
    texts = spark.createDataFrame([("a", 10, "The Net Income !!"), ("b", 11, "net income"), ("a", 12, "netincome"), ("c", 13, "net")], "book string, id int, text string")
    found = values.prose_leaks(texts, targets, ["book"])
    assert {(r.id, r.target) for r in found.collect()} == {(10, 1), (10, 2), (11, 3)}
    assert ("_w" in found._jdf.queryExecution().optimizedPlan().toString()) and ("LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()) == bool(most)


def test_large_books_are_evaluated_by_rounds_as_in_one_task(spark, monkeypatch):
    import random

    rng = random.Random(18)
    monkeypatch.setattr(W, "ROUNDS", 4)
    forms = ["=A{r}*2+$B$1", "=SUM($A$1:A{r})", "=IF(A{r}>0,T!B2,\"=x\")", "=COUNTBLANK(A{r}:D60)", "=C{r}&\"|\"", "=1/0", "=NOSUCH(A{r})", "=A{r}+", "=IFERROR(C{r},7)", "=Rate*A{r}", "=OFFSET(A{r},0,1)", "=INDIRECT(\"A{r}\")", "=T!B{r}+1", "=AVERAGE(A:A)", "=MAX(T!A1:C9)", "=D{r}", "=A{r}>2", "=10^400", "=ROW()+COLUMN(B{r})", "=TODAY()", "=(A1:A9 A{r}:B{r})", "=LEN(C{r})"]
    books = []
    for wb in ("v", "w"):
        book = {s: {f"A{r}": rng.choice([1.5, -2.0, 3.0, True, "words", ("=A1", 1.0), "=1+1"]) for r in range(1, 30) if rng.random() < 0.9} for s in ("S", "T")}
        for s in book:
            book[s] |= {f"{c}{r}": rng.choice(forms).format(r=rng.randrange(1, 30)) for r in range(1, 30) for c in "BCDE" if rng.random() < 0.8}
        book["S"] |= {"G1": "=G2+1", "G2": "=G1*0.5", "G3": "=G2+A1", "H1": 1.0} | {f"H{r}": f"=H{r - 1}+1" for r in range(2, 10)}
        books.append((wb, bytearray(B.write(book, {"Rate": "S!$A$3"}))))
    books = spark.createDataFrame(books, "wb string, content binary")
    cells, given = W.scan(books).cache(), {"names": W.names(books), "settings": W.settings(books)}
    want = sorted(map(repr, W.evaluate(cells, **given).collect()))
    assert len(want) > 200
    # books of which rounds evaluate a part
    assert sorted(map(repr, W.evaluate(cells, whole=0, **given).collect())) == want
    # and all
    found, left = W._rounds(cells.where("sheet = 'S' and col = 8 and row < 4"), 45000.0)
    assert left.isEmpty() and len(found) > 1
