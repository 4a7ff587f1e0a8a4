import math

import duckdb
import pytest

import __spark_entry__ as entry
from gridloom.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return "0.0" if isinstance(v, float) and v == 0 else repr(v)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_same_rows_as_sql(spark, db, name):
    df = catalogue.queries()[name](spark, SF)
    want = db.execute(catalogue.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    at = [df.columns.index(c) for c in columns]
    got = sorted(tuple(plain(r[i]) for i in at) for r in df.collect())
    assert got == sorted(tuple(map(plain, r)) for r in want.fetchall()) and got


def test_roots_are_roots(spark):
    rows = catalogue.queries()["irr_xirr"](spark, SF).collect()
    assert len(rows) > 50 and all(r.irr is None or r.irr > -1 for r in rows) and any(r.irr for r in rows)
    assert all(abs(r.rate - r.given) < 1e-6 for r in catalogue.queries()["rate_of_loans"](spark, SF).collect())
    for r in catalogue.queries()["norm_distribution"](spark, SF).limit(500).collect():
        assert 0 < r.cdf < 1 and abs(0.5 * math.erfc(-r.back / math.sqrt(2)) - r.cdf) < 1e-5


def test_titles_and_nth(spark):
    t = spark.read.parquet(f"{SF}/part.parquet").select("p_partkey", "p_name", "p_type").collect()
    got = {r.p_partkey: r for r in catalogue.queries()["proper_and_nth"](spark, SF).collect()}
    for r in t:
        parts = r.p_name.split("a")
        assert got[r.p_partkey].proper == f"{r.p_type}-{r.p_name}".title()
        assert got[r.p_partkey].second == (r.p_name if len(parts) < 3 else "a".join(parts[:2]) + "_" + "a".join(parts[2:]))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["custkey", "n", "npv"]


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
