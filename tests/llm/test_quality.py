import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gridloom.llm import linear as L
from gridloom.llm import quality_rules as Q
from gridloom.llm.common import Batch


def counts(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    runs = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    inside = {j for i in range(len(w) - 7) if runs[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside)


def test_base_counts_by_brute_force():
    rng = random.Random(4)
    texts = [None, "", "\n\n", " a", "a\na\n\na ", "é#É |\n\té#É |", "x " * 30, "\n" * 5 + "q", "a b c d e f g h i a b c d e f g h", "日本 語<>"]
    texts += ["".join(rng.choice(["a", "bé", " ", "\n", "#", "a b c d e f g h ", "\t", "\x0b", "|"]) for _ in range(rng.randrange(60))) for _ in range(600)]
    got = Q.base_counts(Batch(pa.array(texts, pa.string())))
    assert list(zip(*(got[k].tolist() for k in Q.COUNTS), strict=True)) == [counts(t) for t in texts]


def test_features_do_not_cross_texts():
    texts = ["Alpha beta", "", "g", "beta gamma delta"]
    whole = L.features(Batch(pa.array(texts)))
    for i, t in enumerate(texts):
        alone = L.features(Batch(pa.array([t])))
        assert sorted(whole[1][whole[0] == i].tolist()) == sorted(alone[1].tolist())
    grams = [len(L.features(Batch(pa.array([t])))[1]) for t in ("日本語", "éñ", "日本語日本語", "a b")]
    assert grams == [2, 1, 5, 4]  # words, pairs of words and runs of three code points
    upper = L.features(Batch(pa.array(["ALPHA BETA"])))
    assert sorted(upper[1].tolist()) == sorted(L.features(Batch(pa.array(["alpha beta"])))[1].tolist())


def make(rng, bad):
    words = [rng.choice(["the", "cat", "sat", "upon", "mat", "with", "tea", "river", "stone", "green"]) + rng.choice(["", "s", "ed"]) for _ in range(rng.randrange(25, 60))]
    return " ".join(w + rng.choice(["###", "$$$"]) if bad else w for w in words)


def test_held_out_accuracy_and_verdicts(spark):
    rng = random.Random(9)
    rows = [(i, make(rng, i % 4 == 0), "x") for i in range(400)] + [(900, None, "x"), (901, "too short", "x"), (902, "again " * 50, "x"), (None, make(rng, False), "x"), (904, make(rng, False), "x"), (904, make(rng, True), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(200)] + [(5, 1), (None, 0), (7, None)], "doc_id long, quality int")
    got = Q.quality_rules(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None and 200 <= r.doc_id < 400:
            assert r.kept == (r.doc_id % 4 != 0)
    by = {r.doc_id: r for r in got}
    assert [by[i].base_failed for i in (900, 901, 902)] == [True] * 3 and by[900].n_words == 0 and by[None].kept
    assert sorted(r.kept for r in got if r.doc_id == 904) == [False, True]
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r.doc_id) for r in got if r.kept)
    none = Q.quality_rules(docs, labels.where("quality = 1")).collect()
    assert all(r.quality is None and r.kept == (not r.base_failed) for r in none)
    assert Q.quality_rules(docs.limit(0), labels).count() == 0


def test_calibration_moves_probabilities_to_frequencies():
    rng = np.random.default_rng(0)
    raw = rng.normal(0, 3, 20000)
    y = (rng.random(20000) < L.sigmoid(0.5 * raw - 1)).astype(int)
    m = L.calibrate(L.Model(np.zeros(1), np.zeros(0), 0.0), raw, y)
    assert m.a == pytest.approx(0.5, abs=0.05) and m.b == pytest.approx(-1, abs=0.1)


def test_labelled_texts_are_counted_whole(spark):
    rng = random.Random(2)
    texts = [make(rng, i % 2 == 0) for i in range(20)] + ["calm river " * 9000 + "gromble", "", "calm river " * 900 + "zaxxt ###", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, "no label")], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(texts))], "doc_id long, quality int")
    Q.ship_package(spark)
    bag, y = Q.labelled_bags(docs, labels, "quality")
    want = L.bags([t or "" for t in texts])
    assert y.tolist() == [i % 2 for i in range(len(texts))]
    assert all(np.array_equal(getattr(bag, k), getattr(want, k)) for k in ("doc", "feature", "times", "size"))
    assert bag.size[20] == len(L.features(Batch(pa.array([texts[20]])))[0]) > 100_000


def test_junk_late_in_labelled_texts_is_learnt(spark):
    rng = random.Random(5)
    clean = lambda: " ".join(make(rng, False) for _ in range(60))  # noqa: E731, some 15,000 characters
    rows = [(i, clean() + (" " + make(rng, True) * 20 if i % 2 else "")) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(100)], "doc_id long, quality int")
    got = {r.doc_id: r.quality for r in Q.quality_rules(docs, labels).collect()}
    assert all((got[i] >= 0.5) == (i % 2 == 0) for i in range(100, 160))
