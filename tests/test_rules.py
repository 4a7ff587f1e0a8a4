import json

import pytest

from gridloom.functions.answers import answer
from gridloom.operators import audit as A
from gridloom.operators import rules as R


@pytest.mark.parametrize(("text", "want"), [
    ('{"a": 1, "a": 2, "b": 3', {"a": 2}),
    ('{"a": 1, "a": 2, "b": 3}', {"a": 2, "b": 3}),
    ('{"a": 1e5, "b": "x, \\"y\\" {", "c": [1, {"d": 2}], "e": {"f": 1', {"a": 1e5, "b": 'x, "y" {', "c": [1, {"d": 2}]}),
    ('{"a": 12', None), ('{"a": 12,', {"a": 12}), ("{", None), ("none", None), (None, None), ("[1, 2]", None),
    ('so:\n```json\n{"a": 1}\n```\nor\n```json\n{"b": 2}\n```', {"b": 2}),
    ('so:\n```json\n{"a": 1}\n```\nor\n```json\n{"b": 2, "c": tru', {"a": 1}),
    ('```json\n{"b": 2, "c": tru', {"b": 2}), ('{"a": true, "b": null, "c": -0.5, d: 1}', {"a": True, "b": None, "c": -0.5}),
])
def test_answers(text, want):
    got = answer(text)
    assert (None if got is None else json.loads(got)) == want


def test_answers_cut_anywhere():
    whole = {"a": "q\"u,o{te", "b": [1, {"c": "}"}], "d": {"e": {"f": -1.5e-7}}, "g": None, "h": "é\n"}
    text, keys = json.dumps(whole), list(whole)
    for k in range(1, len(text)):
        got = answer(text[:k])
        pairs = {} if got is None else json.loads(got)
        assert list(pairs) == keys[: len(pairs)] and all(whole[x] == pairs[x] for x in pairs)
    assert json.loads(answer(text)) == whole
    assert json.loads(answer("{" + '"x": "' + "y " * 500_000 + '", "z": 1')) == {"x": "y " * 500_000}


def test_salvaged_columns(spark):
    df = spark.createDataFrame([('{"a": 1e5, "b": {"c": 2}, "d": "t", "e',), (None,)], "x string")
    got = [r.m for r in df.select(A.salvaged("x").alias("m")).collect()]
    assert got[0].keys() == {"a", "b", "d"} and float(got[0]["a"]) == 1e5 and json.loads(got[0]["b"]) == {"c": 2} and got[1] is None


def test_json_nodes(spark):
    text = '{"A": {"b": [1, "http://x", null]}, "a": true, "c": {}}'
    df = spark.createDataFrame([(1, text), (2, "[[2]]"), (3, "no json"), (4, None), (5, '"leaf"')], "i int, j string")
    nodes = R.json_nodes(df, "i", "j").cache()
    got = {(r.id, r.path): (r.key, r.kind, r.value) for r in nodes.collect()}
    assert set(got) == {(1, "A"), (1, "A.b"), (1, "A.b[0]"), (1, "A.b[1]"), (1, "A.b[2]"), (1, "a"), (1, "c"), (2, "[0]"), (2, "[0][0]")}
    assert got[1, "A"] == ("a", "OBJECT", None) and got[1, "A.b[1]"] == (None, "STRING", "http://x") and got[1, "a"][2] == "true" and got[2, "[0][0]"][2] == "2"
    assert {r.path for r in R.leaked_keys(nodes, ["B"]).collect()} == {"A.b"} and {r.path for r in R.leaked_urls(nodes, ["c"]).collect()} == {"A.b[1]"}
    assert R.json_nodes(df.where("i > 2"), "i", "j").count() == 0


def test_rules(spark):
    df = spark.createDataFrame([(1, 5, "a"), (2, None, "b"), (3, 7, None), (3, 1, "a")], "id int, n int, s string")
    faults = lambda x: sorted((r.rule, r.id or "", r.message) for r in x.collect())
    assert faults(R.row_faults(df, "id", {"n": (df.n > 2, "small"), "s": (df.s.isNotNull(), "none")})) == [("n", "2", "small"), ("n", "3", "small"), ("s", "3", "none")]
    assert faults(R.key_faults({"id": (df, ["id"]), "s": (df, ["s", "n"])})) == [("id", "3", "2 rows"), ("s", "", "2 without a key")]
    up = spark.createDataFrame([(5,), (1,)], "k int")
    assert faults(R.link_faults({"up": (df, "id", "n", up, "k")})) == [("up", "2", "no key"), ("up", "3", "no 7")]
    top, mid = spark.createDataFrame([("t",)], "k string"), spark.createDataFrame([("m1", "t"), ("m2", "?")], "k string, up string")
    low = spark.createDataFrame([("l1", "m1"), ("l2", "m2"), ("l3", None)], "k string, up string")
    got = sorted((r.table, r.id, r.broken) for r in R.chain_faults([("top", top, "k", None), ("mid", mid, "k", "up"), ("low", low, "k", "up")]).collect())
    assert got == [("low", "l2", "mid"), ("low", "l3", "low"), ("mid", "m2", "mid")]


def test_keys_of_floors_are_texts_of_doubles(spark, tmp_path):
    import duckdb
    import __spark_entry__ as entry

    values = "('0.4'), ('0.6'), ('-0.0'), ('-0.0'), ('-0.5'), ('-0.2'), ('nan'), ('nan'), ('-inf'), ('-inf'), ('1e16'), ('1e16'), ('-1.5e300'), ('-1.5e300'), ('123456789012345.6'), ('123456789012345.5'), (NULL)"
    db = duckdb.connect()
    db.execute(f"COPY (SELECT v::DOUBLE AS c_acctbal FROM (VALUES {values}) x(v)) TO '{tmp_path}/customer.parquet'")
    db.execute(f"COPY (SELECT 1::BIGINT AS l_orderkey, 1::INTEGER AS l_linenumber) TO '{tmp_path}/lineitem.parquet'")
    for t in ("customer", "lineitem"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    got = sorted(map(str, (tuple(r) for r in entry.queries()["key_rules"](spark, str(tmp_path)).select("rule", "id", "message").collect())))
    assert got == sorted(map(str, db.execute(entry.oracle_sql()["key_rules"]).fetchall())) and "('balance', '-0.0', '2 rows')" in got
