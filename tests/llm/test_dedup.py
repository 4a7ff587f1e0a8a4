import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import minhash as M
from gridloom.llm.common import Batch, may_contain, membership_filter
from gridloom.llm.components import components
from gridloom.llm.exact_dedup import MergeIndex, exact_dedup, keep_one_of_each


def reference_sets(rows, width):
    out = []
    for i, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out.append((i, {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()))
    return out


def reference_groups(rows, width, percent=80):
    sets = reference_sets(rows, width)
    up = {i: i for i, _ in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    by = defaultdict(list)
    for i, s in sets:
        for x in s:
            by[x].append(i)
    every = dict(sets)
    near = {(a, b) for ids in by.values() for a in ids for b in ids if a < b}
    for a, b in near:
        n = len(every[a] & every[b])
        if 100 * n >= percent * (len(every[a]) + len(every[b]) - n):
            x, y = sorted((top(a), top(b)))
            up[y] = x
    return {i: (len(s), top(i)) for i, s in sets}


def check_near(spark, rows, width, **options):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, key string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in M.near_duplicates(df, width=width, **options).collect()}
    assert got == reference_groups(rows, width)


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return w


def test_near_duplicates_by_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"W{i}" for i in range(400)]
    rows, texts = [], []
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 5, 8, 40, 150]))]
        for n in [0, 0, *(rng.randrange(6) for _ in range(4))]:
            texts.append(" ".join(edited(rng, base, n)))
    common = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts += [common + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 60))) for _ in range(80)]
    texts += [None, "", " \t\n", "Ü x", "ü x", "A\x0bb  c", "a b\nC", "a b c d", "A B C D"]
    rng.shuffle(texts)
    rows = [(i * 7 - 50, t) for i, t in enumerate(texts)]
    check_near(spark, rows, 4)


@pytest.mark.parametrize(("block", "whole"), [(3, 1), (7, 2), (7, 16), (2000, 16)])
def test_chains_are_followed(spark, block, whole, monkeypatch):
    """Each text is close to the next, but the ends have little in common; small blocks make no difference."""
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "WHOLE_BLOCKS", whole)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        at = rng.randrange(len(words) - 3)
        words[at] = f"n{i}"
    rows += [(100 + i, " ".join(edited(rng, [f"z{j}" for j in range(100)], 3))) for i in range(40)]
    check_near(spark, rows, 4)


@pytest.mark.parametrize("most", [4, 16])
def test_one_large_group_of_near_copies(spark, most, monkeypatch):
    """A third of all rows are near copies of one text, some too far from its smallest id; links stay few."""
    monkeypatch.setattr(M, "BLOCK", 40)
    monkeypatch.setattr(M, "WHOLE_BLOCKS", most)
    rng, found = random.Random(11), []
    whole = M.compare
    monkeypatch.setattr(M, "compare", lambda *a: found.append(whole(*a)) or found[-1])
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(edited(rng, base, rng.randrange(5)))) for i in range(400)]
    rows += [(1000 + i, " ".join(rng.choice(base) + str(i) for _ in range(30))) for i in range(800)]
    check_near(spark, rows, 4)
    assert len(found) == (3 if most == 4 else 1) and sum(x.count() for x in found) < 10 * 400


@pytest.mark.parametrize("seed", range(3))
def test_links_of_a_run_by_brute_force(seed):
    rng = np.random.default_rng(seed)
    pool = np.sort(rng.integers(0, 2**63, 60, dtype=np.uint64))
    sets = [np.sort(rng.choice(pool, rng.integers(40, 60), replace=False)) for _ in range(70)]
    n = np.array([len(x) for x in sets])
    sketch = M.sketches(np.repeat(np.arange(70), n), np.concatenate(sets), 70)
    marks = (sketch[:, : M.MARKS] & np.uint64(255)).astype(np.uint8)
    comp, role = rng.integers(0, 60, 70), rng.integers(0, 3, 70)
    links = M.links_of_run(np.arange(70) * 3, comp, n, role, marks, sets, 80)

    def parts(edges):
        up = {c: c for c in comp.tolist()}
        top = lambda x: x if up[x] == x else top(up[x])
        for a, b in edges:
            up[top(int(comp[a]))] = top(int(comp[b]))
        return {frozenset(i for i in range(70) if top(int(comp[i])) == t) for t in {top(c) for c in up}}

    same = lambda a, b: len(np.intersect1d(sets[a], sets[b]))
    every = [(a, b) for a in range(70) for b in range(70) if a != b and role[a] != 1 and role[b] != 0 and 100 * same(a, b) >= 80 * (n[a] + n[b] - same(a, b))]
    assert every and parts([(a // 3, b // 3) for a, b in links]) == parts(every) and len(links) < len(set(comp.tolist()))


def test_marks_keep_pairs_at_the_threshold():
    """Of pairs at exactly 80 % none in thousands is ruled out by its marks."""
    rng, lost = np.random.default_rng(4), 0
    for n in (9, 90, 900):
        for _ in range(700):
            x = rng.integers(0, 2**63, n // 9 * 10, dtype=np.uint64)  # two sets of nine tenths each, eight tenths shared
            a, b = np.sort(x[: n // 9 * 9]), np.sort(x[n // 9 :])
            s = M.sketches(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]), 2)
            lost += not M.links_of_run(np.arange(2), np.arange(2), np.array([len(a), len(b)]), np.array([2, 2]), M.marks_of(s), [a, b], 80)
    assert lost == 0


def test_near_duplicates_odd_rows(spark):
    rows = [(5, "a b c d e f", 1), (5, "z z y y x x", 1), (None, "a b c d e f", 1), (3, "a b c d e f", 1), (9, "z z y y x x", 1), (9, "z z y y x x", 1), (4, None, 1), (4, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rep long")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(df, width=4).collect()), key=str)
    assert got == sorted([(5, 3, 3, False), (5, 3, 3, False), (None, 3, None, True), (3, 3, 3, True), (9, 3, 3, False), (9, 3, 3, False), (4, 0, 4, True), (4, 0, 4, True)], key=str)
    assert M.near_duplicates(df.limit(0)).count() == 0
    assert {r["gone"] for r in M.keep_one_of_each(df.withColumnsRenamed({"doc_id": "gone", "text": "_id"}), id_col="gone", text_col="_id").collect()} == {None, 3, 4}


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    for n in (1, 3, 50, 700, 5000):
        pool = rng.integers(0, 2**63, n + n // 4, dtype=np.uint64)
        a, b = pool[:n], pool[n // 4 :]
        s = M.sketches(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]), 2)
        assert (s != np.uint64(2**64 - 1)).all()
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((s[0] == s[1]).mean() - j) < 0.12


def test_words_by_brute_force():
    rng = random.Random(2)
    texts = ["".join(rng.choice("aB \t\n\x0b\x0c\ré\x1cz\xa0") for _ in range(rng.randrange(30))) for _ in range(500)] + [None, "", " "]
    import pyarrow as pa

    b = Batch(pa.chunked_array([texts[:100], texts[100:]]))
    begin, end, doc, h = M.words_of(b, lower=False)
    data = b.data.tobytes()
    got = [(d, data[x:y].decode()) for x, y, d in zip(begin, end, doc)]
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert got == want
    assert len(set(h.tolist())) == len({w for _, w in want})


def test_components_by_brute_force(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000 + rng.randrange(80), 1000 + rng.randrange(80)) for _ in range(50)] + [(500, 500)] + [(700, x) for x in range(600, 640)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up: dict = {}

    def top(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    assert got == {i: top(i) for i in up if i != 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_filter_loses_nothing(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("key"))
    words = membership_filter(keys, "key", 3000)
    assert may_contain(keys, "key", words).count() == 3000
    assert may_contain(spark.range(10**6, 10**6 + 20000).select(F.xxhash64("id").alias("key")), "key", words).count() < 1500


ROWS = [(3, "a"), (1, "a"), (2, "b"), (4, None), (5, ""), (6, "a "), (7, "A"), (8, "x" * 200_000), (9, "x" * 200_000), (9, "x" * 200_000), (None, "a"), (10, "é"), (11, "é")]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, keep, weak):
    df = spark.createDataFrame([(i, t, "k") for i, t in ROWS], "doc_id long, text string, key string").repartition(4)
    more = {"digest": lambda c: F.unhex(F.substring(F.sha2(F.coalesce(c, F.lit("")), 256), 1, 1))} if weak else {}
    got = exact_dedup(df, keep=keep, fan_in=2, **more).collect()
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[t or ""].append(i)
    order = lambda i: (i is not None, i or 0)
    want = sorted((i, (min if keep == "smallest" else max)(groups[t or ""], key=order), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ROWS if i is not None)
    assert sorted(tuple(r)[:3] + (r.text_sha256,) for r in got if r.doc_id is not None) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    assert exact_dedup(df.limit(0)).count() == 0


def test_one_of_each_stays(spark):
    df = spark.createDataFrame([(i, t, "k") for i, t in ROWS], "doc_id long, text string, key string")
    out = keep_one_of_each(df.withColumn("_id", F.lit("i")).withColumn("at", F.lit("a")).withColumn("digest", F.lit("d")).withColumn("_sha", F.lit(0)))
    assert out.columns == [*df.columns, "_id", "at", "digest", "_sha"] and out.where("_id = 'i' and at = 'a' and digest = 'd' and _sha = 0").count() == out.count()
    out = keep_one_of_each(df.withColumnsRenamed({"doc_id": "id", "text": "body"}), id_col="id", text_col="body").withColumnsRenamed({"id": "doc_id", "body": "text"})
    assert out.columns == df.columns and sorted(r.text or "" for r in out.collect()) == sorted({t or "" for _, t in ROWS})
    assert sorted(r.doc_id for r in keep_one_of_each(df.where("doc_id < 8"), keep="largest").collect()) == [2, 3, 5, 6, 7]


@pytest.mark.parametrize("fan_in", [1, 2, 3, 50])
def test_merge_index_levels(spark, fan_in):
    """Runs are merged level by level, and hits are those of a plain count whatever is left unmerged."""
    index, count = MergeIndex(spark, fan_in=max(2, fan_in)), defaultdict(list)
    d = F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest")
    for part in range(3):
        written = index.flush(spark.range(part, 60 + part, part + 1).repartition(3).select(d, F.col("id").alias("row"), F.lit("x").alias("more")))
        assert written.columns == ["digest", "row", "more"]
        for i in range(part, 60 + part, part + 1):
            count[i].append(i)
    assert index.runs() == 9
    found = {bytes(r.digest): (r.smallest, r.largest, r.n) for r in index.hits().collect()}
    assert found == {hashlib.sha256(str(i).encode()).digest(): (i, i, len(v)) for i, v in count.items() if len(v) > 1}
    assert all(n <= max(2, fan_in) for _, n in index.levels) and len(index.levels) == {1: 4, 2: 4, 3: 2, 50: 1}[fan_in]
    want = hashlib.sha256(b"12").digest()
    assert [(r.smallest, r.largest, r.n) for r in index.lookup([want, b"absent"]).collect()] == [(12, 12, len(count[12]))]
