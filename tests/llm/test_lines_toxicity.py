import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridloom.llm import common
from gridloom.llm import toxicity as T
from gridloom.llm.common import Batch
from gridloom.llm.line_dedup import drop_boilerplate


@pytest.mark.parametrize("many", [False, True])
def test_lines_by_brute_force(spark, many, monkeypatch):
    if many:
        monkeypatch.setattr(common, "MAX_LOOKUP_ROWS", 1)
    rng = random.Random(6)
    pool = ["menu", " menu", "footer", "", " \t", "é line"] + [f"line {i}" for i in range(60)]
    rows = []
    for i in range(300):
        site = ["a", "a", "a", "b", None, ""][i % 6]
        some = [rng.choice(pool[: 6 if rng.random() < 0.3 else 66]) for _ in range(rng.randrange(1, 8))]
        rows.append((i if i % 17 else None, "\n".join(some) if i % 31 else None, site, "x"))
    rows += [rows[3], rows[3], (777, "x\n" * 3000, "c", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, line string").repartition(3)
    pages, total = defaultdict(int), Counter(r[2] for r in rows)
    for _, t, s, _ in rows:
        for x in set((t or "").split("\n")):
            pages[s, x] += bool(re.search(r"\S", x))
    bad = {k for k, n in pages.items() if n >= 3 and n * 100 > 10 * total[k[0]]}
    want = []
    for i, t, s, z in rows:
        lines = [] if t is None else t.split("\n")
        left = [x for x in lines if (s, x) not in bad]
        want.append((i, None if t is None else "\n".join(left), s, z, len(lines), len(lines) - len(left)))
    got = drop_boilerplate(df, percent=10)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr) and bad
    own = ["_at", "_bad", "_lines", "_left", "_slot", "_site", "_word", "at", "bad", "key"]  # like the operator's own
    more = df
    for name in own:
        more = more.withColumn(name, F.lit("own"))
    found = drop_boilerplate(more, percent=10)
    assert found.columns == [*df.columns, *own, "n_lines", "n_dropped_lines"]
    assert sorted(map(tuple, found.drop(*own).collect()), key=repr) == sorted(want, key=repr) and all(r[c] == "own" for r in found.collect() for c in own)
    assert drop_boilerplate(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        drop_boilerplate(df.withColumnRenamed("line", "n_lines"))


def test_letter_words_by_brute_force():
    rng = random.Random(8)
    texts = [None, ""] + ["".join(rng.choice("aBcdé1 .$\n-") for _ in range(rng.randrange(40))) for _ in range(300)]
    doc, h = T.letter_words(Batch(pa.array(texts, pa.string())))
    for i, t in enumerate(texts):
        words = {w.encode() for w in re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))}
        starts = {(n, w[:n]) for w in words for n in T.PREFIXES if len(w) > n}
        assert (doc == i).sum() == len(words) + len(starts)


def text_of(rng, nasty):
    words = [rng.choice("river stone green tea house walk over under light table".split()) + rng.choice(["", "s", "y"]) for _ in range(rng.randrange(5, 300))]
    for _ in range(nasty):
        words[rng.randrange(len(words))] = rng.choice(["gromble", "Fnarg!", "zaxxt$$$", "QUEB"])
    return " ".join(words)


def test_held_out_accuracy(spark):
    rng = random.Random(1)
    rows = [(i, text_of(rng, rng.randrange(1, 6) if i % 5 == 0 else 0), "t") for i in range(900)]
    rows += [(2000, None, "t"), (2001, "", "t"), (None, text_of(rng, 3), "t"), (2003, "calm " * 40_000 + "fnarg gromble", "t"), (2003, "calm", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(500)] + [(None, 1, 1), (3, None, 1), (4, 1, None)], "doc_id long, quality int, toxic int")
    got = T.toxicity(docs, labels).collect()
    held = [r for r in got if r.doc_id is not None and 500 <= r.doc_id < 900]
    assert sum(r.toxic != (r.doc_id % 5 == 0) for r in held) <= 2
    other = sorted((str(r.doc_id), r.toxic) for r in got if r.doc_id is None or r.doc_id >= 2000)
    assert other == [("2000", False), ("2001", False), ("2003", False), ("2003", True), ("None", True)]
    assert all(0 <= p <= 1 for r in got for p in (r.p_junk, r.p_toxic, r.p_severe_derived))
    assert np.mean([r.p_severe_derived for r in held if r.doc_id % 5 == 0]) > np.mean([r.p_severe_derived for r in held if r.doc_id % 5])
    none = T.toxicity(docs, labels.where("toxic = 0")).collect()
    assert all(r.p_toxic is None and not r.toxic for r in none)
    assert T.toxicity(docs.limit(0), labels).count() == 0


def test_toxic_words_late_in_labelled_texts_are_learnt(spark):
    rng = random.Random(3)
    calm = lambda: text_of(rng, 0) + " calm" * 8000 + " "  # noqa: E731, over 40,000 characters
    rows = [(i, calm() + ("gromble fnarg zaxxt" if i % 2 else "river")) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(100)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.toxic for r in T.toxicity(docs, labels).collect()}
    assert all(got[i] == (i % 2 == 1) for i in range(100, 160))
    doc, h, y = T.labelled_words(docs, labels, "toxic")
    want = T.letter_words(Batch(pa.array([t for _, t in rows[:100]])))
    assert np.array_equal(doc, want[0]) and np.array_equal(h, want[1]) and y.tolist() == [i % 2 for i in range(100)]
