"""Toxicity by a convolutional text classifier.

Words and their beginnings are hashed to embeddings; filters of several widths slide over the
whole text, and the largest answer of each filter feeds a logistic layer. All of it is trained here
in numpy. A word's part in a filter's answer does not depend on its neighbours, so scoring works it
out once per distinct word and place, and adds.

The cut between the classes is calibrated by language, as told from the function words of the text
itself, and moved to 0.5 of the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import fold, portions, texts, two
from tidemark.llm.labelled import sample

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 15, 8, 12, (1, 2, 3)
PAD = BUCKETS  # after each document, so that no window crosses into the next
#: Frequent function words that tell a language.
FUNCTION_WORDS = {
    "en": "the and of to in is was it that with for are this by as at be or an have not",
    "de": "der die das und ist von mit den ein eine zu auf für im nicht sich dem des auch als",
    "fr": "le la les de et des du en un une est que dans pour qui sur au par il elle",
    "es": "el los las y en que por con una se su es para como al lo más pero del un",
}
LANGS = tuple(FUNCTION_WORDS)


STARTS = (4, 5, 6)  # a word's beginnings have embeddings too, so that inflected words share them
_STRIP = b".,;:!?\"'()|*#$%&"


def _bucket(word: bytes) -> int:
    return crc32(word) % BUCKETS


_LANG = {w.encode(): i for i, words in enumerate(FUNCTION_WORDS.values()) for w in words.split()}


@dataclass
class Words:
    """Texts as numbers of distinct words; each text is followed by two pads (number 0).

    `parts` has the hash buckets of each distinct word and of its beginnings, `lang` its language.
    """

    docs: list[np.ndarray]
    parts: np.ndarray
    lang: np.ndarray


def words(texts: list[bytes]) -> Words:
    """An empty text has three pads."""
    seen: dict[bytes, int] = {b"": 0}
    docs = []
    for text in texts:
        found = [seen.setdefault(w, len(seen)) for w in text.lower().split()]
        docs.append(np.array((found or [0]) + [0, 0], np.int32))
    parts = np.full((len(seen), 1 + len(STARTS)), PAD, np.int32)
    lang = np.full(len(seen), len(LANGS))
    for i, word in enumerate(seen):
        word = word.strip(_STRIP)
        if word:
            parts[i] = [_bucket(word)] + [
                _bucket(b"%d%s" % (n, word[:n])) if len(word) >= n else PAD for n in STARTS]
            lang[i] = _LANG.get(word, len(LANGS))
    return Words(docs, parts, lang)


@dataclass
class Net:
    embedding: np.ndarray
    filters: list[np.ndarray]  # by width: place, dimension, filter
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    cuts: np.ndarray  # by language, and one for none

    def raw(self, held: Words, step: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
        """Logit and language of each document; memory is bounded by `step`, not by a text."""
        flat = np.concatenate(held.docs)
        n = np.fromiter(map(len, held.docs), np.int64, len(held.docs))
        row = np.repeat(np.arange(len(n)), n)
        own = self.embedding[held.parts].sum(axis=1)
        top = np.full((len(n), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        tables = [[own @ w[j] for j in range(len(w))] for w in self.filters]
        last = len(flat) - 2  # windows that begin at pads only see pads
        for a in range(0, last, step):
            b = min(a + step, last)
            r = row[a:b]
            at = np.concatenate([[0], np.flatnonzero(np.diff(r)) + 1])
            for i, places in enumerate(tables):
                answer = places[0][flat[a:b]]
                for j, table in enumerate(places[1:], 1):
                    answer += table[flat[a + j:b + j]]
                part = slice(i * FILTERS, (i + 1) * FILTERS)
                top[r[at], part] = np.maximum(top[r[at], part], np.maximum.reduceat(answer, at))
        top = np.maximum(top + np.concatenate(self.bias), 0)
        lang = held.lang[flat]
        known = lang < len(LANGS)
        counts = np.bincount(row[known] * len(LANGS) + lang[known],
                             minlength=len(n) * len(LANGS)).reshape(len(n), len(LANGS))
        lang = np.where(counts.sum(axis=1) > 0, counts.argmax(axis=1), len(LANGS))
        return top @ self.out + self.out_bias, lang

    def score(self, texts: list[bytes]) -> np.ndarray:
        raw, lang = self.raw(words(texts))
        return 1 / (1 + np.exp(-np.clip(raw - self.cuts[lang], -30, 30).astype(float)))


def fit(held: Words, y: np.ndarray, weight: np.ndarray, epochs: int = 14,
        batch: int = 32, rate: float = 0.02, seed: int = 7, least: int = 4) -> Net:
    """Adam on the logistic loss; an eighth of the documents is kept to calibrate the cuts on.

    No rows, or one class alone, gives a net that answers that class's base rate.
    """
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.3, (BUCKETS + 1, DIM)).astype(np.float32)
    ws = [rng.normal(0, 0.5 / np.sqrt(w), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    bs = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    out = rng.normal(0, 0.2, len(WIDTHS) * FILTERS).astype(np.float32)
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    ob = np.array([base], np.float32)
    many = len(y) > 0 and 0 < y.sum() < len(y)
    docs = held.docs
    met = np.zeros(BUCKETS + 1, np.int64)
    for d in docs:
        met[np.unique(held.parts[np.unique(d)])] += 1
    rare = met < least  # too few documents to learn from: no part in any answer
    rare[PAD] = True
    e[rare] = 0

    def net(cuts: np.ndarray) -> Net:
        return Net(e, ws, bs, out, float(ob[0]), cuts)

    if not many:
        out[:] = 0
        return net(np.zeros(len(LANGS) + 1))
    order = rng.permutation(len(y))
    cal, learn = order[:len(y) // 8], order[len(y) // 8:]
    params = [*ws, *bs, out, ob]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    em1, em2 = np.zeros_like(e), np.zeros_like(e)
    step = 0
    for _ in range(epochs):
        rng.shuffle(learn)
        for lo in range(0, len(learn), batch):
            rows = learn[lo:lo + batch]
            some = [docs[r] for r in rows]
            flat = np.concatenate(some)
            n = np.fromiter(map(len, some), np.int64, len(some))
            starts = np.cumsum(n) - n
            own = e[held.parts[flat]].sum(axis=1)
            tops, args = [], []
            for w, b in zip(ws, bs):
                answer = own @ w[0]
                for j in range(1, len(w)):
                    answer[:-j] += (own @ w[j])[j:]
                cols = []
                for s, k in zip(starts, n):
                    cols.append(s + answer[s:s + k - 2].argmax(axis=0))
                arg = np.stack(cols)
                args.append(arg)
                tops.append(np.take_along_axis(answer, arg, axis=0) + b)
            top = np.concatenate(tops, axis=1)
            act = np.maximum(top, 0)
            p = 1 / (1 + np.exp(-np.clip(act @ out + ob[0], -30, 30)))
            d = (p - y[rows]).astype(np.float32) / len(rows)
            grads = [np.zeros_like(w) for w in ws] + [np.zeros_like(b) for b in bs]
            dt = np.outer(d, out) * (top > 0)
            ge = np.zeros_like(e)
            for i, w in enumerate(ws):
                part = dt[:, i * FILTERS:(i + 1) * FILTERS]
                grads[len(ws) + i] = part.sum(axis=0)
                for j in range(len(w)):
                    at = np.minimum(args[i] + j, len(flat) - 1)
                    grads[i][j] = np.einsum("rfd,rf->df", own[at], part)
                    down = part[:, :, None] * w[j].T[None]
                    for buckets in held.parts[flat[at]].transpose(2, 0, 1):
                        np.add.at(ge, buckets.ravel(), down.reshape(-1, DIM))
            ge[rare] = 0
            grads += [act.T @ d, np.array([d.sum()], np.float32)]
            step += 1
            fix = np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for p_, g, a, b2 in zip(params, grads, m1, m2):
                a *= 0.9
                a += 0.1 * g
                b2 *= 0.999
                b2 += 0.001 * g * g
                p_ -= rate * fix * a / (np.sqrt(b2) + 1e-8)
            hit = np.flatnonzero(ge.any(axis=1))  # rows without a gradient stay as they are
            em1[hit] = 0.9 * em1[hit] + 0.1 * ge[hit]
            em2[hit] = 0.999 * em2[hit] + 0.001 * ge[hit] ** 2
            e[hit] -= rate * fix * em1[hit] / (np.sqrt(em2[hit]) + 1e-8)
    plain = net(np.zeros(len(LANGS) + 1))
    raw, lang = (plain.raw(Words([docs[r] for r in cal], held.parts, held.lang))
                 if len(cal) else (np.zeros(0), np.zeros(0, int)))
    enough = len(cal) and min(y[cal].sum(), (1 - y[cal]).sum()) >= 20
    whole = _cut(raw, y[cal], weight[cal]) if enough else 0.0
    cuts = np.full(len(LANGS) + 1, whole)
    for i in range(len(LANGS)):
        own = lang == i
        if min(y[cal][own].sum(), (1 - y[cal][own]).sum()) >= 20:
            cuts[i] = _cut(raw[own], y[cal][own], weight[cal][own])
    return net(cuts)


def _cut(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The logit with the largest F1 at the classes' true shares, midway to the next."""
    if not 0 < y.sum() < len(y):
        return 0.0
    order = np.argsort(-raw, kind="stable")
    raw, y, weight = raw[order], y[order], weight[order]
    hit = np.cumsum(y * weight)
    f1 = 2 * hit / (np.cumsum(weight) + (y * weight).sum())
    f1[:-1][np.diff(raw) == 0] = 0
    i = int(f1.argmax())
    return float((raw[i] + raw[min(i + 1, len(raw) - 1)]) / 2)


def learnt(docs: DataFrame, labels: DataFrame, rows: int = 4000, text_bytes: int = 1 << 15) -> Net:
    """A net fitted on a bounded sample."""
    shares = {r["y"]: r["n"] for r in labels.select(F.col("toxic").cast("int").alias("y"),
              "doc_id").filter("y IN (0, 1)").filter(fold(F.col("doc_id")) != 0)
              .groupBy("y").agg(F.count("*").alias("n")).collect()}
    found = sample(docs, labels, "toxic", rows, text_bytes)
    y = np.array([r["y"] for r in found], float)
    weight = np.ones(len(y))
    for c in (0, 1):
        if (y == c).any():
            weight[y == c] = shares[c] / sum(shares.values()) * len(y) / (y == c).sum()
    return fit(words([bytes(r["text"]) for r in found]), y, weight)


def scores(docs: DataFrame, net: Net) -> DataFrame:
    """doc_id, held_out, score (of the whole text), predicted; a row for each row of `docs`.

    Null and empty texts are scored as a text of pads; a null id belongs to the fold of empty text.
    Nothing but the text enters the score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)  # tables of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in portions(batches, 512):
            held = texts(batch)
            s = model.score(held) if held else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(s)],
                ["doc_id", "score"])

    found = two(docs).mapInArrow(run, "doc_id long, score double")
    return found.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))
