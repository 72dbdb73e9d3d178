"""Quality by gradient-boosted trees over statistics of a document.

Statistics are put into at most 63 bins at quantiles; trees are grown level by level on histograms
of first and second derivatives of the logistic loss, and are flattened into arrays: all documents
of a batch walk all trees together, one level per numpy step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import forget, fold, portions, texts, two
from tidemark.llm.labelled import sample

_KINDS = np.zeros(256, np.int64)  # of a byte: other, lower, upper, digit, white, punctuation, high
for _b in range(256):
    _c = chr(_b)
    _KINDS[_b] = (6 if _b > 127 else 1 if _c.islower() else 2 if _c.isupper() else
                  3 if _c.isdigit() else 4 if _c in " \t\n\v\f\r" else 5 if 32 < _b < 127 else 0)
_SIGNS = np.frombuffer(b"#$%&*|!?.,:;<>=/@_-()", np.uint8)


def statistics(text: bytes) -> list[float]:
    """Statistics of a whole text; an empty one has zeros."""
    if not text:
        return [0.0] * (14 + 7 + len(_SIGNS))
    bytes_ = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = len(text)
    kinds = np.bincount(_KINDS, weights=bytes_, minlength=7) / n
    shares = bytes_[bytes_ > 0] / n
    words = text.split()
    w = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = text.split(b"\n")
    distinct = set(words)
    line_set = set(lines)
    size = sum(map(len, line_set))
    longest = int(lengths.max()) if len(words) else 0
    return [np.log1p(n), np.log1p(len(words)), float(lengths.mean()) if len(words) else 0.0,
            float(lengths.std()) if len(words) else 0.0, np.log1p(longest),
            len(distinct) / w, len(distinct) / w ** 0.7, float((lengths <= 3).sum()) / w,
            np.log1p(len(lines)), n / len(lines), len(line_set) / len(lines), size / n,
            float(-(shares * np.log2(shares)).sum()), float(kinds[5]) * n / w,
            *kinds, *(bytes_[_SIGNS] / w)]


@dataclass
class Trees:
    """Full binary trees of one depth: `feature` and `cut` by inner node, `value` by leaf."""

    base: float
    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], side="right")
                         for i, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        trees, inner = self.feature.shape
        node = np.zeros((len(x), trees), np.int64)
        each, tree = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        for _ in range((inner + 1).bit_length() - 1):
            right = b[each, self.feature[tree, node]] > self.cut[tree, node]
            node = 2 * node + 1 + right
        raw = self.base + self.value[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, trees: int = 80,
        depth: int = 4, rate: float = 0.15, l2: float = 2.0, bins: int = 63) -> Trees:
    """Boosting with Newton steps. One class alone, or no rows, gives its smoothed base rate."""
    weight = np.ones(len(y)) if weight is None else weight
    rate0 = (weight @ y + 0.5) / (weight.sum() + 1)
    base = float(np.log(rate0 / (1 - rate0)))
    inner = (1 << depth) - 1
    k = x.shape[1]
    if not len(y) or y.min() == y.max():
        zero = np.zeros((1, inner), np.int64)
        return Trees(base, [np.zeros(0)] * k, zero, zero, np.zeros((1, inner + 1)))
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, bins + 1)[1:-1])) for i in range(k)]
    model = Trees(base, edges, np.zeros((trees, inner), np.int64),
                  np.full((trees, inner), bins + 1), np.zeros((trees, inner + 1)))
    b = model.bins(x)
    width = bins + 1
    flat = b + np.arange(k) * width
    raw = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, many = (1 << level) - 1, 1 << level
            at = ((node - first)[:, None] * (k * width) + flat).ravel()
            shape = (many, k, width)
            gs = np.bincount(at, np.repeat(g, k), many * k * width).reshape(shape).cumsum(axis=2)
            hs = np.bincount(at, np.repeat(h, k), many * k * width).reshape(shape).cumsum(axis=2)
            ga, ha = gs[:, :, -1:], hs[:, :, -1:]
            gain = (gs ** 2 / (hs + l2) + (ga - gs) ** 2 / (ha - hs + l2) - ga ** 2 / (ha + l2))
            gain[(hs < 1) | (ha - hs < 1)] = 0
            gain = gain.reshape(many, -1)
            best = gain.argmax(axis=1)
            good = gain[np.arange(many), best] > 1e-9
            f, c = best // width, best % width
            model.feature[t, first:first + many] = f
            model.cut[t, first:first + many] = np.where(good, c, bins + 1)
            own = node - first
            right = b[np.arange(len(y)), f[own]] > np.where(good, c, bins + 1)[own]
            node = 2 * node + 1 + right
        leaf = node - inner
        gs, hs = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        model.value[t] = rate * gs / (hs + l2)
        raw += model.value[t][leaf]
    return model


def learnt(docs: DataFrame, labels: DataFrame, rows: int = 6000, text_bytes: int = 1 << 16) -> Trees:
    """Trees fitted on a bounded sample; its classes are weighted back to their shares in `labels`."""
    shares = {r["y"]: r["n"] for r in labels.select(F.col("quality").cast("int").alias("y"),
              "doc_id").filter("y IN (0, 1)").filter(fold(F.col("doc_id")) != 0)
              .groupBy("y").agg(F.count("*").alias("n")).collect()}
    found = sample(docs, labels, "quality", rows, text_bytes)
    x = np.array([statistics(bytes(r["text"])) for r in found], float).reshape(
        len(found), len(statistics(b"")))
    y = np.array([r["y"] for r in found], float)
    weight = np.ones(len(y))
    for c in (0, 1):
        if (y == c).any():
            weight[y == c] = shares[c] / sum(shares.values()) * len(y) / (y == c).sum()
    return fit(x, y, weight)


def scores(docs: DataFrame, model: Trees, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (of the whole text), predicted; a row for each row of `docs`.

    Null and empty texts are scored by statistics of zero; a null id belongs to the fold of empty
    text. Nothing but the text enters the score.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 1024):
            x = [statistics(t) for t in texts(batch)]
            s = model.score(np.array(x)) if x else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)],
                                             ["doc_id", "score"])

    found = two(docs).mapInArrow(run, "doc_id long, score double")
    return found.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                        (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Trees, cut: float = 0.3) -> DataFrame:
    """The rows of `docs`, all columns, whose text is not rejected; a null text counts as empty.

    Only texts go to Python, and a score a row comes back.
    """
    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        forget()
        out = [np.zeros(0)]
        for at in range(0, len(text), 256):
            x = [statistics((t or "").encode()) for t in text.slice(at, 256).to_pylist()]
            out.append(model.score(np.array(x)))
        return pa.array(np.concatenate(out))

    return docs.filter(score("text") >= cut)
