import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridloom.llm import common, mixing


def expected(doc_id, rate, seed=0):
    u = (int(hashlib.md5(f"{seed}:count|{doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    k, p, total = 0, math.exp(-rate), math.exp(-rate)
    while total < u and k < 500:
        k += 1
        p *= rate / k
        total += p
    return k


@pytest.mark.parametrize("many", [False, True])
def test_counts_by_brute_force(spark, many, monkeypatch):
    if many:
        monkeypatch.setattr(common, "MAX_LOOKUP_ROWS", 1)
    rows = [(i, f"t{i}", ["a", "a", "a", "b", None, ""][i % 6], i, "k") for i in range(1200)] + [(3, "again", "b", 0, "k"), (None, None, "a", None, "k")]
    names = ["_key", "size", "_u", "_n", "_table", "_salt", "key", "task"]  # like those of the operator's own columns
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, _key string")
    for name in names[2:]:
        df = df.withColumn(name, F.lit("own"))
    weights = {"a": 1.0, "b": 2.0, None: 0.5, "absent": 9.0}
    got = mixing.mix(df, weights).collect()
    size = Counter(r[2] for r in rows)
    rate = {s: weights.get(s, 0) / 3.5 * len(rows) / n for s, n in size.items()}
    want = Counter()
    for i, t, s, _, _ in rows:
        want[(i, t, s)] += expected("null" if i is None else i, rate[s]) if rate[s] else 0
    assert Counter((r.doc_id, r.text, r.source) for r in got) == +want
    assert all(r["_key"] == "k" and r[c] == "own" for r in got for c in names[2:])
    assert all(0 <= r.copy < want[(r.doc_id, r.text, r.source)] for r in got)


def test_order_and_shares(spark):
    rows = [(i, "t", "big" if i % 10 else "small") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, {"big": 1, "small": 1}, epochs=2.0).collect()
    keys = [(r.shuffle_key, r.doc_id, r.copy) for r in got]
    assert keys == sorted(keys)
    share = Counter(r.source for r in got)
    assert share["big"] == pytest.approx(6000, rel=0.05) and share["small"] == pytest.approx(6000, rel=0.1)
    half = Counter(r.source for r in got[: len(got) // 2])
    assert half["small"] == pytest.approx(share["small"] / 2, rel=0.1)
    assert mixing.mix(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(df.withColumnRenamed("text", "copy"))
    with pytest.raises(ValueError):
        mixing.mix(df, {"big": -1})


def test_large_rates(spark):
    df = spark.createDataFrame([(i, "t", "s") for i in range(20)], "doc_id long, text string, source string")
    got = Counter(r.doc_id for r in mixing.mix(df, {"s": 1}, epochs=1500.0).collect())
    assert all(1250 < n < 1750 for n in got.values()) and len(got) == 20


def test_a_rate_of_a_million(spark):
    rates = spark.createDataFrame([("a", 1e6), ("b", 399.0), ("c", 401.0), ("d", 0.0), ("e", 2.5e5)], "k string, rate double")
    got = {r.k: (r["first"], r["table"]) for r in mixing.poisson_tables(rates, "k", "rate").collect()}
    assert got.keys() == {"a", "b", "c", "e"} and got["b"][0] == 0
    for k, rate in (("a", 1e6), ("b", 399.0), ("c", 401.0), ("e", 2.5e5)):
        first, table = got[k]
        assert len(table) < 24 * rate**0.5 + 450 and abs(table[-1] - 1) < 1e-8
        for i in (len(table) // 3, len(table) // 2, 2 * len(table) // 3):
            x = first + i
            assert table[i] - table[i - 1] == pytest.approx(math.exp(-rate + x * math.log(rate) - math.lgamma(x + 1)), rel=1e-7, abs=1e-300)
    df = spark.createDataFrame([(1, "t", "big"), *((i, "t", "small") for i in range(2, 40))], "doc_id long, text string, source string")
    n = mixing.mix(df, {"big": 1.0}, epochs=25_000.0).groupBy("doc_id").count().collect()
    assert [r.doc_id for r in n] == [1] and abs(n[0]["count"] - 975_000) < 5_000
