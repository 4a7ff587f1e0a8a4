import io
import random
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from gridloom.llm.packing import pack, pack_documents, place, place_all, sequences  # noqa: E402
from gridloom.llm.sstable import Reader, Writer, encode_to_shards, id_of, key_of, read_shards, write_shards  # noqa: E402
from gridloom.llm.tokenize import Encoder  # noqa: E402

PATH = str(P.path("byte_bpe_50k.json"))
TEXTS = ["", "one", "The cat.\nSat on it's mat, 12 3 don't!", " lead", "trail ", "a  b", "a\n\nb", "tab\tx", "a \nb", "é x ÑÑ", "x\x1cy", "<|endoftext|> in text", "日本語 テキスト\nです", "Ġx Ċy", "a b c", "🙂 🙂\n🙂", "\n", " ", "\ta", "a\r\nb", "\x85q w", "'s 't\n're"]


def plain(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_encoder_gives_the_tokenizers_ids():
    rng = random.Random(1)
    many = ["".join(rng.choice(["a", "the", "É", " ", " ", "\n", ",", "12", "'ll", "#", "  ", "ß", "x y"]) for _ in range(rng.randrange(40))) for _ in range(800)]
    tok = Encoder(PATH)
    for texts in (TEXTS, many, [*many, None]):
        assert [tok.ids(x).tolist() for x in tok.encode(texts)] == plain(texts)


def test_encoder_forgets(monkeypatch):
    import gridloom.llm.tokenize as T

    monkeypatch.setattr(T, "MEMO_WORDS", 3)
    tok, texts = Encoder(PATH), ["a b c d e", "e f g h", "a b"]
    assert [tok.ids(x).tolist() for x in tok.encode(texts)] == plain(texts)


def test_more_new_words_than_the_memo_holds():
    import gridloom.llm.tokenize as T

    tok = Encoder(PATH)
    tok.encode(["intro alpha beta"])
    texts = [" ".join(f"w{i}" for i in range(T.MEMO_WORDS + 1000)), "w1 alpha w2", "intro"]
    for some in (texts, ["w1 yet unseen", *texts[1:]]):  # the second time everything is forgotten first
        assert [tok.ids(x).tolist() for x in tok.encode(some)] == plain(some)


def test_memo_by_brute_force():
    import gridloom.llm.tokenize as T

    rng, memo, want = np.random.default_rng(0), T.Memo(np.dtype("<u2")), {}
    for _ in range(30):
        keys = np.unique(rng.integers(0, 5000, (700, 1), dtype=np.uint64) * np.array([[1 << 40, 1]], np.uint64), axis=0)  # low bits alike
        keys = keys[memo.find(keys) < 0]
        count = rng.integers(1, 4, len(keys)).astype(np.int32)
        ids = rng.integers(0, 60000, count.sum()).astype("<u2")
        memo.add(keys, ids, count)
        want |= {tuple(k): v.tolist() for k, v in zip(keys.tolist(), np.split(ids, np.cumsum(count)[:-1]))}
    every = np.array(list(want), np.uint64)
    at = memo.find(every)
    assert [memo.ids[memo.at[i] : memo.at[i] + memo.count[i]].tolist() for i in at] == list(want.values())
    assert (memo.find(every + np.uint64(1)) == -1).all()


def test_shard_round_trip_and_lookup():
    rng, sink = np.random.default_rng(0), io.BytesIO()
    docs = {i: rng.integers(0, 60000, rng.integers(0, 300)).astype("<u2") for i in sorted(rng.choice(10**6, 3000, replace=False).tolist())}
    w = Writer(sink, 2)
    w.add(key_of(None), b"\1\0")
    for i, v in [(-5, np.array([7], "<u2")), *docs.items()]:
        w.add(key_of(i), v.tobytes())
    w.close()
    with pytest.raises(ValueError):
        w.add(key_of(0), b"")
    r = Reader(io.BytesIO(sink.getvalue()))
    assert len(r.blocks) > 3 and r.n_docs == len(docs) + 2
    assert [id_of(k) for k, _ in r] == [None, -5, *docs]
    for i, v in docs.items():
        assert (r.get(i) == v).all()
    assert r.get(None).tolist() == [1] and r.get(-5).tolist() == [7]
    absent = [i for i in range(10**6, 10**6 + 3000)]
    assert all(r.get(i) is None for i in absent)
    assert sum(r.may_hold(key_of(i)) for i in absent) < 150


def test_shards_of_documents(spark, tmp_path):
    rows = [(i * 3 - 9, t, "x") for i, t in enumerate(TEXTS)] + [(500, None, None), (None, "null id", "y"), (500, "same id", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, path string").repartition(3)
    got = sorted(map(tuple, encode_to_shards(df, PATH).collect()), key=lambda r: r[1])
    want, at = [], 0
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*plain([t])[0], 0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    assert encode_to_shards(df.limit(0), PATH).count() == 0
    m = write_shards(df, PATH, f"file://{tmp_path}/s")
    assert {r.doc_id: list(r.ids) for r in read_shards(spark, m, with_ids=True).where("doc_id = -9").collect()} == {-9: [0]}


@pytest.mark.parametrize("seed", range(4))
def test_places_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = np.concatenate([rng.integers(1, 65, 300), [64] * 5])
    for f in (place, place_all):
        bins, offsets = f(lengths, 64)
        assert set(bins.tolist()) == set(range(bins.max() + 1))
        for b in range(bins.max() + 1):
            own = sorted((o, n) for o, n, x in zip(offsets, lengths, bins) if x == b)
            at = 0
            for o, n in own:
                assert o == at
                at += n
            assert at <= 64
    fitted: list[int] = []  # what best fit needs, longest first
    for s in -np.sort(-lengths):
        at = max((i for i, f in enumerate(fitted) if f + s <= 64), key=lambda i: fitted[i], default=None)
        if at is None:
            fitted.append(s)
        else:
            fitted[at] += s
    assert place_all(lengths, 64)[0].max() + 1 <= len(fitted) + 2


def test_each_place_is_the_best_by_brute_force():
    rng, cap = np.random.default_rng(3), 12
    lengths = rng.integers(1, 13, 120)
    bins, _ = place(lengths, cap)
    fill: dict[int, int] = {}
    cost = lambda f: sum(v * v for v in np.unique([cap - x for x in f.values() if x < cap], return_counts=True)[1])
    for s, b in zip(lengths.tolist(), bins.tolist()):
        options = [cost(fill | {k: v + s}) for k, v in fill.items() if v + s <= cap] + [cost(fill | {-1: s})]
        taken = cost(fill | {b: fill.get(b, 0) + s})
        assert taken == min(options)
        fill[b] = fill.get(b, 0) + s


def test_packed_documents(spark):
    alike = spark.createDataFrame([(7, "x")], "length long, uid string").join(spark.range(3000)).drop("id")
    assert pack(alike, 70, per_group=500).groupBy("sequence_id").count().count() <= 3000 / 10 + 12  # equal rows spread over groups
    rows = [(i, t, 0) for i, t in enumerate(TEXTS)] + [(90, None, 1), (91, "word " * 3000, 1), (91, "word " * 3000, 1), (None, "x", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sequence_id int")
    got = pack_documents(df, PATH, capacity=64).collect()
    by_doc: dict = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, t, _ in rows:
        ids = np.array([*plain([t])[0], 2], "<u4")
        own = sorted(by_doc[i], key=lambda r: r.piece)
        own = own[::2] if i == 91 else own
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
        assert sum(r.length for r in own) == len(ids) and all(r.length == 64 for r in own[1:])
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own)
    by_seq: dict = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 64
    assert pack_documents(df.limit(0), PATH).count() == 0
    whole = sequences(df, PATH, capacity=64).collect()
    assert sum(len(r.input_ids) for r in whole) == sum(r.length for r in got) and sum(r.segments for r in whole) == len(got)
