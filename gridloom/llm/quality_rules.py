"""Quality rules: counted base rules and a calibrated linear model, scored in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import linear
from .common import Batch, durable, ship_package, tidied, window_hashes, words_of

#: Labelled rows that the model is fitted on, at most, of each class; a fifth of them calibrates it.
SAMPLE_PER_CLASS = 1500
#: A document is dropped if its calibrated probability of good quality is below this.
THRESHOLD = 0.2
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


def base_counts(batch: Batch) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text of a batch."""
    n, data, at = batch.n, batch.data, batch.at
    begin, end, doc, h = words_of(batch, lower=False)
    words = np.bincount(doc, minlength=n)

    def summed(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[at[1:]] - total[at[:-1]]

    inside = np.zeros(len(data) + 1, np.int8)
    inside[begin] += 1
    np.add.at(inside, end, -1)
    starts_char = (data & 0xC0) != 0x80
    chars = summed(starts_char & (np.cumsum(inside[:-1], dtype=np.int8) > 0)) if len(data) else np.zeros(n, np.int64)

    # lines: a text's first byte and each byte after a line break begin one
    breaks = np.flatnonzero(data == 10)
    line_begin = np.sort(np.concatenate([at[:-1], breaks + 1]), kind="stable")
    owner = np.concatenate([np.arange(n), np.searchsorted(at, breaks, "right") - 1])
    order = np.argsort(np.concatenate([at[:-1], breaks + 1]), kind="stable")
    owner = owner[order]
    line_begin = np.concatenate([at[:-1], breaks + 1])[order]
    o = np.lexsort((line_begin, owner))
    owner, line_begin = owner[o], line_begin[o]
    line_end = np.empty_like(line_begin)
    line_end[:-1] = line_begin[1:] - 1
    last = np.ones(len(owner), bool)
    last[:-1] = owner[1:] != owner[:-1]
    line_end[last] = at[1:][owner[last]]
    first_word = np.searchsorted(begin, line_begin)
    has_word = np.zeros(len(line_begin), bool)
    ok = first_word < len(begin)
    has_word[ok] = begin[first_word[ok]] < line_end[ok]
    owner, line_begin, line_end = owner[has_word], line_begin[has_word], line_end[has_word]
    from .common import span_hashes

    lh = span_hashes(data, line_begin, line_end)
    o = np.lexsort((lh, owner))
    dup = np.bincount(owner[o][1:][(lh[o][1:] == lh[o][:-1]) & (owner[o][1:] == owner[o][:-1])], minlength=n)

    # words in windows found twice or more: windows with an equal one in the same text, spread over their words
    pos, wdoc, wh = window_hashes(h, doc, WINDOW)
    repeat = np.zeros(n, np.int64)
    if len(pos):
        o = np.argsort(wh)
        narrow = wdoc[o].astype(np.uint16) if n < 1 << 16 else wdoc[o]
        o = o[np.argsort(narrow, kind="stable")]
        same = (wh[o][1:] == wh[o][:-1]) & (wdoc[o][1:] == wdoc[o][:-1])
        twice = np.zeros(len(pos), bool)
        twice[o[1:][same]] = True
        twice[o[:-1][same]] = True
        edge = np.zeros(len(h) + 1, np.int64)
        np.add.at(edge, pos[twice], 1)
        np.add.at(edge, pos[twice] + WINDOW, -1)
        repeat = np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=n)
    return {"n_words": words, "word_chars": chars, "n_symbols": summed(_SYMBOL[data]) if len(data) else np.zeros(n, np.int64), "n_dup_lines": dup, "n_repeat_words": repeat}


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int = SAMPLE_PER_CLASS, carry: str | None = None) -> DataFrame:
    """(doc_id, y, text) of at most per_class labelled documents of each class, those of the smallest id hashes; whole texts.

    carry: a column to return in the place of label. This is the bounded sample that a model may be fitted on.
    """
    rank = F.xxhash64("doc_id", F.lit(11))
    picked = None
    for value in (0, 1):
        some = labels.where((F.col(label) == value) & F.col("doc_id").isNotNull()).select("doc_id", F.col(carry or label).alias("y")).distinct().orderBy(rank, "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    picked = durable(picked, "labelled-sample")  # at most 2 * per_class rows: broadcast
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id", "y"]).select("doc_id", "y", "text")


def labelled_bags(docs: DataFrame, labels: DataFrame, label: str, per_class: int = SAMPLE_PER_CLASS) -> tuple[linear.Bags, np.ndarray]:
    """(n-gram counts, labels) of labelled_rows; whole texts are counted in executors, the driver gets the counts."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.llm import linear as L
        from gridloom.llm.common import Batch

        for batch in batches:
            for i, part in Batch(batch.column(2)).parts(1 << 20):
                doc, feature, times, size = L.counted(part)
                cut = np.searchsorted(doc, np.arange(part.n + 1))
                packed = [[x[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)] for x in (feature, times)]
                yield pa.record_batch([batch.column(0).slice(i, part.n), batch.column(1).slice(i, part.n), *(pa.array(x, pa.binary()) for x in packed), pa.array(size, pa.int64())], names=["doc_id", "y", "feature", "times", "size"])

    found = labelled_rows(docs, labels, label, per_class)
    rows = found.mapInArrow(tidied(count), ", ".join(f"{k} {found.schema[k].dataType.simpleString()}" for k in ("doc_id", "y")) + ", feature binary, times binary, size long").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["y"]))
    y, size = np.array([r["y"] for r in rows], np.int64), np.array([r["size"] for r in rows], np.int64)
    feature = np.frombuffer(b"".join([r["feature"] for r in rows]), np.int32)
    times = np.frombuffer(b"".join([r["times"] for r in rows]), np.float32)
    return linear.Bags(np.repeat(np.arange(len(rows), dtype=np.int32), [len(r["feature"]) // 4 for r in rows]), feature, times, size), y


def fit_quality(docs: DataFrame, labels: DataFrame) -> linear.Model | None:
    """The calibrated model of good quality, or None where the labels lack a class."""
    bag, y = labelled_bags(docs, labels, "quality")
    if len(set(y.tolist())) < 2:
        return None
    held = np.random.default_rng(0).permutation(len(y)) % 5 == 0
    model = linear.train(bag.rows(np.flatnonzero(~held)), y[~held])
    return linear.calibrate(model, bag.rows(np.flatnonzero(held)).raw(model), y[held])


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, quality, base_failed, kept.

    Words are runs without ASCII white space of the whole text (null: none). base_failed: under MIN_WORDS words, or over
    MAX_REPEAT_PERCENT % of the words in WINDOW-word runs that the text holds twice or more. kept: not base_failed and
    the model's calibrated probability of good quality (quality) is at least threshold. The model is fitted on a bounded
    sample of labelled rows (labels: doc_id, quality); where labels lack one class, quality is null and the base rules alone decide. Repeated rows
    and null ids are scored like others; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    model = fit_quality(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), labels)
    shared = docs.sparkSession.sparkContext.broadcast(model and (model.weights.astype(np.float32), model.bias, model.a, model.b))  # 2**BITS numbers

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.llm import linear as L
        from gridloom.llm import quality_rules as Q
        from gridloom.llm.common import Batch

        own = shared.value and L.Model(shared.value[0], np.zeros(0), *shared.value[1:])
        for batch in batches:
            for i, part in Batch(batch.column(1)).parts():
                c = Q.base_counts(part)
                failed = (c["n_words"] < Q.MIN_WORDS) | (100 * c["n_repeat_words"] > Q.MAX_REPEAT_PERCENT * c["n_words"])
                p = own.probability(*L.features(part), part.n) if own else np.full(part.n, np.nan)
                keep = ~failed & ((p >= threshold) if own else True)
                yield pa.record_batch([batch.column(0).slice(i, part.n), *(pa.array(c[k], pa.int64()) for k in COUNTS), pa.array(p, pa.float64(), mask=np.isnan(p)), pa.array(failed), pa.array(keep)], names=["key", *COUNTS, "quality", "base_failed", "kept"])

    schema = f"key {docs.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{k} long" for k in COUNTS) + ", quality double, base_failed boolean, kept boolean"
    return docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).mapInArrow(tidied(score), schema).withColumnRenamed("key", id_col)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, training: DataFrame | None = None) -> DataFrame:
    """docs without the rows that quality_rules rejects, decided row by row; all columns stay.

    training: the documents that the labels are about; docs themselves if None.
    """
    ship_package(docs.sparkSession)
    model = fit_quality(docs if training is None else training, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model and (model.weights.astype(np.float32), model.bias, model.a, model.b))
    at = docs.columns.index("text")

    def good(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.llm import linear as L
        from gridloom.llm import quality_rules as Q
        from gridloom.llm.common import Batch

        own = shared.value and L.Model(shared.value[0], np.zeros(0), *shared.value[1:])
        for batch in batches:
            for i, part in Batch(batch.column(at)).parts():
                c = Q.base_counts(part)
                keep = (c["n_words"] >= Q.MIN_WORDS) & (100 * c["n_repeat_words"] <= Q.MAX_REPEAT_PERCENT * c["n_words"])
                if own:
                    keep &= own.probability(*L.features(part), part.n) >= threshold
                yield batch.slice(i, part.n).filter(pa.array(keep))

    return docs.mapInArrow(tidied(good), docs.schema)
