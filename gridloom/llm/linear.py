"""Logistic regression on hashed word and character n-grams: numpy kernels, training on a bounded sample, calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .common import Batch, mix, words_of

#: Hashed features.
BITS = 18
#: A word feature's and a character feature's lengths.
WORD_GRAMS, CHAR_GRAMS = (1, 2), (3,)


def features(batch: Batch) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of every n-gram of a batch's texts, A-Z lower-cased, repeated ones too.

    Words are runs without ASCII white space; characters are code points, over the whole text.
    """
    begin, _, doc, h = words_of(batch, lower=True)
    docs, found = [], []
    for n in WORD_GRAMS:
        if len(h) >= n:
            m = len(h) - n + 1
            at = np.flatnonzero(doc[:m] == doc[n - 1 :]) if n > 1 else np.arange(m)
            x = h[at]
            for i in range(1, n):
                x = mix(x * np.uint64(0xFF51AFD7ED558CCD) + h[at + i])
            docs.append(doc[at].astype(np.int32))
            found.append((x >> np.uint64(64 - BITS)).astype(np.int32))
    chars = np.frombuffer(batch.data.tobytes().decode().encode("utf-32-le"), "<u4").copy()
    chars[(chars >= 65) & (chars <= 90)] += 32
    starts = np.concatenate([[0], np.cumsum((batch.data & 0xC0) != 0x80)])  # characters before each byte
    own = np.repeat(np.arange(batch.n, dtype=np.int32), np.diff(starts[batch.at]))
    for n in CHAR_GRAMS:
        m = len(chars) - n + 1
        if m <= 0:
            continue
        x = np.zeros(m, np.uint32)
        for i in range(n):
            x = x * np.uint32(16777619) + chars[i : i + m] + np.uint32(1)
        x = (x * np.uint32(2654435761)) >> np.uint32(32 - BITS)
        same = own[:m] == own[n - 1 :]
        docs.append(own[:m][same])
        found.append(x[same].astype(np.int32))
    if not docs:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(docs), np.concatenate(found)


@dataclass
class Model:
    """weights: of each feature's share of a document's n-grams (times SCALE); more: of further columns; a, b: calibration."""

    weights: np.ndarray
    more: np.ndarray
    bias: float
    a: float = 1.0
    b: float = 0.0

    def raw(self, doc: np.ndarray, feature: np.ndarray, n_docs: int) -> np.ndarray:
        total = np.bincount(doc, weights=self.weights[feature], minlength=n_docs)
        return SCALE * total / np.maximum(np.bincount(doc, minlength=n_docs), 1) + self.bias

    def probability(self, *x, **y) -> np.ndarray:
        return sigmoid(self.a * self.raw(*x, **y) + self.b)


#: Makes shares of n-grams, which are small, steps of ordinary size.
SCALE = 30.0


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Bags:
    """(document, feature, times) of some texts, and how many n-grams each text has."""

    doc: np.ndarray
    feature: np.ndarray
    times: np.ndarray
    size: np.ndarray

    def rows(self, rows: np.ndarray) -> "Bags":
        place = np.full(len(self.size), -1)
        place[rows] = np.arange(len(rows))
        keep = place[self.doc] >= 0
        return Bags(place[self.doc[keep]], self.feature[keep], self.times[keep], self.size[rows])

    def raw(self, model: "Model") -> np.ndarray:
        return SCALE * np.bincount(self.doc, weights=self.times * model.weights[self.feature], minlength=len(self.size)) / np.maximum(self.size, 1) + model.bias


def counted(batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, times) of a batch's texts, ascending, and how many n-grams each text has."""
    doc, feature = features(batch)
    key, n = np.unique(doc.astype(np.int64) << BITS | feature, return_counts=True)
    return (key >> BITS).astype(np.int32), (key & ((1 << BITS) - 1)).astype(np.int32), n.astype(np.float32), np.bincount(doc, minlength=batch.n)


def bags(texts: list[str]) -> Bags:
    """The features of a bounded sample, summed up a megabyte of text at a time."""
    import pyarrow as pa

    parts = [(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(0, np.int64))]
    for i, part in Batch(pa.array(texts, pa.string())).parts(1 << 20):
        doc, *rest = counted(part)
        parts.append((doc + np.int32(i), *rest))
    return Bags(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def train(bag: Bags, y: np.ndarray, steps: int = 150, l2: float = 1e-4) -> Model:
    """Full-batch Adam on log loss with classes weighted alike; the order of n-grams makes no difference."""
    n, d = len(y), bag.doc
    value = (SCALE * bag.times / np.maximum(bag.size, 1)[d]).astype(np.float32)
    used, f = np.unique(bag.feature, return_inverse=True)
    w = np.zeros(len(used) + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    for t in range(1, steps + 1):
        z = np.bincount(d, weights=value * w[f], minlength=n) + w[-1]
        g = (sigmoid(z) - y) * share
        grad = np.append(np.bincount(f, weights=value * g[d], minlength=len(used)), g.sum()) + l2 * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    weights = np.zeros(1 << BITS)
    weights[used] = w[:-1]
    return Model(weights, np.zeros(0), float(w[-1]))


def calibrate(model: Model, raw: np.ndarray, y: np.ndarray) -> Model:
    """Platt scaling on held-out rows: a, b of sigmoid(a * raw + b), with smoothed targets, by Newton steps."""
    pos, neg = (y == 1).sum(), (y == 0).sum()
    if not pos or not neg:
        return model
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, w = np.stack([raw, np.ones(len(raw))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - target) + 1e-6 * w)
        w -= step / max(1.0, np.abs(step).max())
    model.a, model.b = float(w[0]), float(w[1])
    return model
