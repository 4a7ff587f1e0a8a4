import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import language_model as K


def reference(texts):
    """Probabilities by the definition, from dictionaries: f(context characters, character) -> probability."""
    n = K.ORDER
    grams = {n: Counter()}
    for t in texts:
        s = K.BEGIN * (n - 1) + t + K.END
        grams[n].update(s[i : i + n] for i in range(len(s) - n + 1))
    for k in range(n - 1, 0, -1):
        before = defaultdict(set)
        for g in grams[k + 1]:
            before[g[1:]].add(g[0])
        grams[k] = Counter({g: len(b) for g, b in before.items()})
    discounts, contexts = {}, {}
    for k, own in grams.items():
        c = [sum(v == j for v in own.values()) for j in (1, 2, 3, 4)]
        y = c[0] / max(c[0] + 2 * c[1], 1)
        discounts[k] = [min(max(j - (j + 1) * y * c[j] / c[j - 1] if c[j - 1] else 0.5 * j, 0.05), j - 0.05) for j in (1, 2, 3)]
        contexts[k] = defaultdict(lambda: [0, 0.0])
        for g, v in own.items():
            contexts[k][g[:-1]][0] += v
            contexts[k][g[:-1]][1] += discounts[k][min(v, 3) - 1]
    kinds = len(grams[1])

    def p(k, g):
        if k == 0:
            return 1 / (kinds + 1)
        total, taken = contexts[k].get(g[:-1], (0, 0.0))
        if not total:
            return p(k - 1, g[1:])
        v = grams[k].get(g, 0)
        own = (v - discounts[k][min(v, 3) - 1]) / total if v else 0.0
        return own + taken / total * p(k - 1, g[1:])

    return p


def perplexity(p, text):
    s = K.BEGIN * (K.ORDER - 1) + K.normalised(text) + K.END
    logs = [math.log(p(K.ORDER, s[i : i + K.ORDER])) for i in range(len(s) - K.ORDER + 1)]
    return math.exp(-sum(logs) / len(logs))


def make(rng, n, junk=False):
    return " ".join("".join(rng.choice(["ba", "lo", "ti", "né", "ro"] if not junk else ["#x", "$Q", "!!", "0|"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.mark.parametrize("entries", [1_500_000, 60])
def test_perplexities_by_brute_force(spark, entries):
    rng = random.Random(2)
    rows = [(i, make(rng, rng.randrange(3, 40)), "aa" if i % 2 else None, "x") for i in range(60)]
    rows += [(100, "unseen çç \x02 日本", "aa", "x"), (101, None, "aa", "x"), (102, "", None, "x"), (103, "other tongue", "zz", "x"), (None, rows[1][1], "aa", "x"), (1, rows[1][1], "aa", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, logp string")
    counted = docs.where("doc_id < 40").select("lang", "text")
    model = K.kneser_ney(K.count_grams(counted))
    got = {(r.key, r.lang): r for r in K.perplexities(docs, model, "doc_id", "text", "lang", entries).collect()}
    trained = {x: reference([K.normalised(t) for i, t, lang, _ in rows if i is not None and i < 40 and lang == x]) for x in ("aa", None)}
    for i, t, lang, _ in rows:
        r = got[i, lang]
        assert r.n_tokens == len(K.normalised(t)) + 1
        if lang == "zz":
            assert r.perplexity is None
        else:
            assert r.perplexity == pytest.approx(perplexity(trained[lang], t), rel=1e-4)


def test_probabilities_sum_to_one():
    rng = random.Random(3)
    p = reference([make(rng, 20) for _ in range(10)])
    letters = {c for c in "balotinéro " + K.END} | {"?"}
    assert sum(p(K.ORDER, "balo" + c) for c in letters) == pytest.approx(1, abs=1e-9)


def test_table():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    t = K.Table(keys, np.arange(5000.0), np.full(5000, np.nan))
    assert (t.find(keys, 0) == np.arange(5000)).all() and np.isnan(t.find(keys + np.uint64(1), 0)).all() and np.isnan(t.find(keys, 1)).all()
    assert len(K.Table(keys[:0], keys[:0], keys[:0]).find(keys, 0)) == 5000


def test_verdicts(spark):
    rng = random.Random(4)
    rows = [(i, make(rng, rng.randrange(10, 60), i % 10 == 9), "aa", "x") for i in range(900)] + [(2000, None, "aa", "x"), (2001, "some text", "new", "x"), (2002, "some text", None, "x"), (None, make(rng, 30, True), "aa", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, threshold string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 10 != 9), 0) for i in range(600)] + [(None, 1, 0), (9, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in K.perplexity_quality(docs, labels).collect()}
    assert got == {r.doc_id: r for r in K.perplexity_quality(docs, labels, trusted_ids=10).collect()}  # joined by shuffle
    # adjusted perplexities and the threshold by the definition
    trusted = {r.doc_id for r in labels.where("quality = 1 and toxic = 0 and doc_id is not null").collect()}
    out = {r.doc_id for r in spark.createDataFrame([(i,) for i in sorted(trusted)], "doc_id long").where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(K.HELD_OUT)) == 0).collect()}
    mean = np.mean([math.log(got[i].perplexity) for i in out])
    want = {i: math.exp((math.log(r.perplexity) * r.n_tokens + mean * K.MORE_CHARACTERS) / (r.n_tokens + K.MORE_CHARACTERS)) for i, r in got.items() if r.lang == "aa"}
    assert all(got[i].adjusted == pytest.approx(w) for i, w in want.items())
    limit = sorted(want[i] for i in out)[math.ceil(K.QUANTILE * len(out)) - 1] * K.MARGIN
    assert all(got[i].threshold == pytest.approx(limit) and got[i].kept == (w <= got[i].threshold) for i, w in want.items())
    held = [got[i] for i in range(600, 900)]
    assert all(not r.kept for r in held if r.doc_id % 10 == 9) and sum(not r.kept for r in held if r.doc_id % 10 != 9) <= 4
    assert got[2001].kept and got[2001].perplexity is None and got[2002].kept and not got[None].kept
    assert K.perplexity_quality(docs.limit(0), labels).count() == 0
    assert all(r.kept for r in K.perplexity_quality(docs, labels.where("quality = 0")).collect())
