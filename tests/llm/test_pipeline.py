import random

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline as P  # noqa: E402
from gridloom.llm import mixing  # noqa: E402


def test_stages(spark, tmp_path):
    """Each stage against what its rule says of its own input."""
    rng = random.Random(1)
    word = lambda: rng.choice("river stone green tea house walk over under light table".split()) + str(rng.randrange(40))
    clean = [" ".join(word() for _ in range(60)) for _ in range(120)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(clean)]
    rows += [(200 + i, clean[i], "en", "s0", 1) for i in range(20)]  # exact copies
    rows += [(300 + i, clean[40 + i].replace(" ", " x ", 1), "en", "s1", 1) for i in range(20)]  # near copies
    rows += [(400 + i, " ".join(word() + "###" for _ in range(60)), "en", "s2", 1) for i in range(40)]  # junk
    rows += [(500, None, None, None, None), (501, "short", "en", "s0", 5)]
    d = f"file://{tmp_path}"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] < 400), 0) for r in rows if r[0] < 500], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    docs, ids = spark.read.parquet(f"{d}/documents.parquet"), {}
    columns = docs.columns
    for i, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, d).write.parquet(f"{d}/{i}")
        docs = spark.read.parquet(f"{d}/{i}")
        ids[name] = sorted(r.doc_id for r in docs.select("doc_id").collect())
        assert i == len(P.STAGES) - 1 or docs.columns == columns
    good = sorted(set(range(120)) | set(range(200, 220)) | set(range(300, 320)))
    assert ids["quality rules"] == good
    assert ids["exact dedup"] == sorted(set(good) - set(range(20)))
    near = sorted(set(ids["exact dedup"]) - set(range(300, 320)))
    assert ids["MinHash near-dedup"] == near
    source = {r[0]: r[3] for r in rows}
    again = mixing.mix(spark.createDataFrame([(i, source[i]) for i in near], "doc_id long, source string"), power=P.MIX_POWER, seed=P.MIX_SEED)
    mixed = sorted(r.doc_id for r in again.collect())
    assert ids["mixing sources to target weights"] == mixed
    assert sorted(set(ids["sum-of-squares packing"])) == sorted(set(mixed))
    fill: dict = {}
    for r in sorted(docs.collect(), key=lambda r: (r.sequence_id, r.offset)):
        assert fill.get(r.sequence_id, 0) == r.offset
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 1024


def test_names_and_sql():
    assert len(P.STAGES) == 5 and P.ORACLE_SQL is None


def test_near_stage_takes_five_words(spark):
    """One word of 44 replaced: similarity 37/45 by four words, 35/45 by five."""
    words = [f"w{i}" for i in range(44)]
    other = words[:22] + ["other"] + words[23:]
    same = words[:43] + ["other"]  # 39/41 by five words
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(same))], "doc_id long, text string")
    assert sorted(r.doc_id for r in P.near(spark, docs, "").collect()) == [1, 2]
