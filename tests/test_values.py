import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridloom.operators import values as V

SCHEMA = "book string, id string, kind string, number double, text string, day date"


@pytest.mark.parametrize(("text", "want"), [
    ("1,234.5", [1234.5]), ("$ 12", [12.0]), ("EUR 3e2 m", [300.0]), ("(1 234)", [-1234.0]), ("12.5%", [12.5, 0.125]), ("(5 %)", [-5.0, -0.05]), ("-7 units p.a.", [-7.0]),
    ("12,34", []), ("12 apples, 3", []), ("", []), (None, []), ("x5", []), ("(5", []), ("0x10", [0.0]), ("5)", []),
])
def test_shown_numbers(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(V.shown_numbers("t").alias("n")).first().n == pytest.approx(want)


def test_shown_dates(spark):
    rows = [("2024-01-31", dt.date(2024, 1, 31)), ("2024/1/3", dt.date(2024, 1, 3)), ("02/03/2024", dt.date(2024, 2, 3)), ("31/12/2024", dt.date(2024, 12, 31)), ("5-Mar-2024", dt.date(2024, 3, 5)), ("05 Mar 2024", dt.date(2024, 3, 5)), ("Mar 5, 2024", dt.date(2024, 3, 5)), ("soon", None), ("2024-13-45", None), (None, None), ("12", None)]
    df = spark.createDataFrame(rows, "t string, want date").withColumn("got", V.shown_date("t"))
    assert all(r.got == r.want for r in df.collect())


def leaked(f, spark, rows, targets, schema=SCHEMA):
    return sorted((r.id, r.target) for r in f(spark.createDataFrame(rows, schema), spark.createDataFrame(targets, SCHEMA), ["book"]).collect())


def test_value_leaks(spark):
    targets = [("w", "num", "num", 1000.0, None, None), ("w", "small", "num", 1.0, None, None), ("w", "neg", "num", -0.25, None, None), ("w", "day", "date", None, None, dt.date(2024, 3, 5)), ("w", "yes", "bool", 1.0, None, None), ("w", "text", "text", None, "Acme  Corp", None), ("w", "zero", "num", 0.0, None, None)]
    rows = [("w", "a", "num", 1000.0000005, None, None), ("w", "b", "num", 1000.00001, None, None), ("w", "c", "text", None, "1,000.00", None), ("w", "d", "num", 1 - 5e-10, None, None), ("w", "e", "text", None, "100%", None), ("w", "f", "text", None, "(25%)", None), ("w", "g", "text", None, "05 Mar 2024", None), ("w", "h", "text", None, "TRUE", None), ("w", "i", "text", None, " acme corp ", None), ("v", "j", "num", 1000.0, None, None), ("w", "k", "text", None, None, None), ("w", "l", "num", float("nan"), None, None), ("w", "m", "num", -1e-10, None, None), ("w", "n", "date", None, None, dt.date(2024, 3, 6))]
    assert leaked(V.value_leaks, spark, rows, targets) == [("a", "num"), ("c", "num"), ("d", "small"), ("e", "small"), ("f", "neg"), ("g", "day"), ("h", "yes"), ("i", "text"), ("m", "zero")]


def test_prose_leaks(spark):
    targets = [("w", "num", "num", 1500.0, None, None), ("w", "share", "num", 0.125, None, None), ("w", "day", "date", None, None, dt.date(2024, 3, 5)), ("w", "no", "bool", 0.0, None, None), ("w", "text", "text", None, "C++ (new) \\E", None), ("w", "mark", "text", None, "§", None)]
    rows = [("w", "a", "about 1,500 in all."), ("w", "b", "x1500 or 1500x or 1500.5"), ("w", "c", "a 12.5% share"), ("w", "d", "on 2024-03-05."), ("w", "e", "FALSE alarm"), ("w", "f", "falsehood"), ("w", "g", "in c++ (new) \\e here"), ("w", "h", "C++ (newer)"), ("w", "i", None), ("v", "j", "1500"), ("w", "k", "see § 5")]
    assert leaked(V.prose_leaks, spark, rows, targets, "book string, id string, text string") == [("a", "num"), ("c", "share"), ("d", "day"), ("e", "no"), ("g", "text"), ("k", "mark")]
