"""Toxicity by a classifier chain: linear models of one category after another on the words of a document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batch, _LOWER, mix, ship_package, span_hashes, tidied
from .linear import calibrate, Model, sigmoid
from .quality_rules import labelled_rows

#: The chain's categories in order: poor quality and toxic, as labelled, and severely toxic, which no label says: severe()
#: derives it from the toxic rows of the sample.
CATEGORIES = ("junk", "toxic", "severe")
#: Labelled rows of each class that the chain is fitted on; words that a model may use.
SAMPLE_PER_CLASS, MAX_WORDS, MIN_DOCS, MIN_CHI2, FOLDS = 1500, 200_000, 4, 10.83, 5
THRESHOLD = 0.5
PREFIXES = (4, 5)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def letter_words(batch: Batch) -> tuple[np.ndarray, np.ndarray]:
    """(document, 64-bit hash) of each distinct word and word beginning of a text.

    Words are runs of letters, digits and non-ASCII bytes, A-Z lower-cased; beginnings are PREFIXES bytes long, which
    brings together words that are built or bent alike.
    """
    data = batch.data
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    solid = _LETTER[data]
    first = np.zeros(len(data), bool)
    first[batch.at[:-1][batch.at[1:] > batch.at[:-1]]] = True
    step = solid.copy()
    step[1:] &= ~solid[:-1] | first[1:]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | first[1:]
    begin, end = np.flatnonzero(step), np.flatnonzero(last) + 1
    doc = np.searchsorted(batch.at, begin, "right") - 1
    low = _LOWER[data]
    words, docs = [span_hashes(low, begin, end)], [doc]
    for n in PREFIXES:
        longer = end - begin > n
        words.append(mix(span_hashes(low, begin[longer], begin[longer] + n) + np.uint64(n)))
        docs.append(doc[longer])
    h, doc = np.concatenate(words), np.concatenate(docs)
    o = np.argsort(h)
    o = o[np.argsort(doc[o].astype(np.uint16) if batch.n < 1 << 16 else doc[o], kind="stable")]
    doc, h = doc[o], h[o]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def known(vocabulary: np.ndarray, doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, place in the sorted vocabulary) of the words that are in it; told apart by all 64 bits."""
    if not len(vocabulary) or not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    ok = vocabulary[at] == h
    return doc[ok], at[ok]


def _fit(doc: np.ndarray, word: np.ndarray, size: int, y: np.ndarray, more: np.ndarray, steps: int = 200, l2: float = 3e-4) -> Model:
    """Logistic regression on word presence and further columns, by full-batch Adam, both classes weighted alike.

    Only words whose presence depends on the class (chi-squared, MIN_CHI2) get a weight, the others' chance differences
    being noise in a small sample.
    """
    n = len(y)
    a, b = np.bincount(word, weights=y[doc], minlength=size), np.bincount(word, weights=1 - y[doc], minlength=size)
    n1, n0 = max(1, (y == 1).sum()), max(1, (y == 0).sum())
    chi2 = n * (a * (n0 - b) - b * (n1 - a)) ** 2 / np.maximum((a + b) * (n - a - b) * n1 * n0, 1)
    keep = (chi2 >= MIN_CHI2)[word] & (0 < y.sum() < n)
    doc, word = doc[keep], word[keep]
    w, share = np.zeros(size + more.shape[1] + 1), np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = np.bincount(doc, weights=w[word], minlength=n) + more @ w[size:-1] + w[-1]
        g = (sigmoid(z) - y) * share
        grad = np.concatenate([np.bincount(word, weights=g[doc], minlength=size), more.T @ g, [g.sum()]]) + l2 * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Model(w[:size], w[size:-1], float(w[-1]))


def _raw(model: Model, doc: np.ndarray, word: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
    return np.bincount(doc, weights=model.weights[word], minlength=n) + model.bias + (more @ model.more if more.shape[1] else 0)


def _logit(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-3, 1 - 1e-3)) - np.log1p(-np.clip(p, 1e-3, 1 - 1e-3))


@dataclass
class Chain:
    vocabulary: np.ndarray
    models: list[Model]

    def probabilities(self, batch: Batch) -> np.ndarray:
        """A column for each category; each model sees the words and the probabilities of the categories before it."""
        doc, word = known(self.vocabulary, *letter_words(batch))
        p = np.zeros((batch.n, 0))
        for model in self.models:
            own = sigmoid(model.a * _raw(model, doc, word, batch.n, _logit(p)) + model.b)
            p = np.concatenate([p, own[:, None]], axis=1)
        return p


def severe(doc: np.ndarray, word: np.ndarray, size: int, toxic: np.ndarray) -> np.ndarray:
    """1 for toxic documents with as many different telling words as half of the toxic ones have, or more.

    Telling words occur in 2 % of the sample's toxic documents and ten times as often there as in the others.
    """
    n1, n0 = max(1, (toxic == 1).sum()), max(1, (toxic == 0).sum())
    in1 = np.bincount(word, weights=toxic[doc], minlength=size) / n1
    in0 = np.bincount(word, weights=1 - toxic[doc], minlength=size) / n0
    telling = (in1 >= 0.02) & (in1 >= 10 * in0)
    n = np.bincount(doc, weights=telling[word], minlength=len(toxic))
    return ((toxic == 1) & (n >= max(1, np.median(n[toxic == 1]) if (toxic == 1).any() else 1))).astype(np.int64)


def labelled_words(docs: DataFrame, labels: DataFrame, label: str, per_class: int = SAMPLE_PER_CLASS, carry: str | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, word hash) of letter_words and the labels of labelled_rows; whole texts are read in executors."""

    def words(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.llm import toxicity as T
        from gridloom.llm.common import Batch

        for batch in batches:
            for i, part in Batch(batch.column(2)).parts(1 << 20):
                doc, h = T.letter_words(part)
                cut = np.searchsorted(doc, np.arange(part.n + 1))
                packed = pa.array([h[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary())
                yield pa.record_batch([batch.column(0).slice(i, part.n), batch.column(1).slice(i, part.n), packed], names=["doc_id", "y", "words"])

    found = labelled_rows(docs, labels, label, per_class, carry)
    rows = found.mapInArrow(tidied(words), ", ".join(f"{k} {found.schema[k].dataType.simpleString()}" for k in ("doc_id", "y")) + ", words binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["y"]))
    h = np.frombuffer(b"".join([r["words"] for r in rows]), np.uint64)
    return np.repeat(np.arange(len(rows)), [len(r["words"]) // 8 for r in rows]), h, np.array([r["y"] for r in rows], np.int64)


def fit_chain(doc: np.ndarray, h: np.ndarray, junk: np.ndarray, toxic: np.ndarray) -> Chain:
    """Fits each category's model with the out-of-fold probabilities of the categories before it; (doc, h): letter_words."""
    found, count = np.unique(h, return_counts=True)
    often = np.argsort(-count, kind="stable")[:MAX_WORDS]
    vocabulary = np.sort(found[often[count[often] >= MIN_DOCS]])
    doc, word = known(vocabulary, doc, h)
    n, size = len(toxic), len(vocabulary)
    fold = np.random.default_rng(0).permutation(n) % FOLDS
    p, models = np.zeros((n, 0)), []
    for y in (junk, toxic, severe(doc, word, size, toxic)):
        out, more = np.zeros(n), _logit(p)
        for k in range(FOLDS):
            inside = fold[doc] != k
            place = np.cumsum(fold != k) - 1
            model = _fit(place[doc[inside]], word[inside], size, y[fold != k], more[fold != k])
            out[fold == k] = _raw(model, doc, word, n, more)[fold == k]
        whole = calibrate(_fit(doc, word, size, y, more), out, y)  # calibrated on what held-out folds gave
        models.append(whole)
        p = np.concatenate([p, sigmoid(whole.a * out + whole.b)[:, None]], axis=1)
    used = np.flatnonzero(np.any([m.weights != 0 for m in models], axis=0))
    return Chain(vocabulary[used], [Model(m.weights[used], m.more, m.bias, m.a, m.b) for m in models])


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, p_junk, p_toxic, p_severe_derived, toxic (p_toxic >= threshold).

    p_severe_derived is of a category that severe() derives. Whole texts are scored (null: none) in Arrow batches. The chain is fitted on a bounded sample of labelled rows;
    where labels hold no toxic or no other row, probabilities are null and toxic is false. Repeated rows and null ids are
    scored like others; an empty table gives no rows; other columns play no part.
    """
    ship_package(docs.sparkSession)
    both = labels.where("quality is not null and toxic is not null").select("doc_id", (F.col("quality") * 2 + F.col("toxic")).alias("pair"), "toxic")
    doc, h, pair = labelled_words(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), both.select("doc_id", "toxic", "pair"), "toxic", carry="pair")
    chain = fit_chain(doc, h, (pair < 2).astype(np.int64), pair % 2) if len(set((pair % 2).tolist())) == 2 else None
    shared = docs.sparkSession.sparkContext.broadcast(chain and (chain.vocabulary, [(m.weights, m.more, m.bias, m.a, m.b) for m in chain.models]))  # at most MAX_WORDS words

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.llm import toxicity as T
        from gridloom.llm.common import Batch
        from gridloom.llm.linear import Model

        own = shared.value and T.Chain(shared.value[0], [Model(*m) for m in shared.value[1]])
        for batch in batches:
            for i, part in Batch(batch.column(1)).parts():
                p = own.probabilities(part) if own else np.full((part.n, 3), np.nan)
                flag = p[:, 1] >= threshold if own else np.zeros(part.n, bool)
                yield pa.record_batch([batch.column(0).slice(i, part.n), *(pa.array(p[:, k], pa.float64(), mask=np.isnan(p[:, k])) for k in range(3)), pa.array(flag)], names=["key", "p_junk", "p_toxic", "p_severe_derived", "toxic"])

    schema = f"key {docs.schema[id_col].dataType.simpleString()}, p_junk double, p_toxic double, p_severe_derived double, toxic boolean"
    return docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).mapInArrow(tidied(score), schema).withColumnRenamed("key", id_col)
