"""Language model scores by a weighted automaton with failure arcs.

The model is a bigram model over words with a prior (Dirichlet smoothing):
P(w | h) = (c(h w) + m P(w)) / (c(h) + m), with P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)). As an
automaton it has a state for each history met in training, an arc for each bigram met, and a
failure arc of weight m / (c(h) + m) to the state without history, which has an arc for each word.
A text is read from left to right; the state is carried and log weights of the arcs are summed.

Counts cover all training documents, however many, and no bigram is dropped. The model is never
in one place: documents are dealt to shards, each shard's bigrams are counted where they are met,
summed by bigram over all shards, and the sums go back to the shards that have met them. A shard
then holds the part of the automaton that its own texts can reach, and no more.

Null and empty texts are one end token. Words are kept as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import keeps, fold, mix, portions, texts, two
from tidemark.session import materialize

END, START = np.uint64(1), np.uint64(2)  # no word hashes to these in practice
HELD_OUT = 1
PRIOR = 200.0


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, 3)
        return found


_hashes = _Hashes()
keeps("backoff", _hashes.clear)


def tokens(text: bytes) -> np.ndarray:
    """Hashes of the words, A-Z lower-cased, and the end."""
    words = text.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    out[-1] = END
    return out


def pair(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(h) + w)


class Grams:
    """Tokens of a shard's documents, with their distinct words and bigrams sorted by hash."""

    def __init__(self, docs: list[np.ndarray], train: np.ndarray) -> None:
        self.n = np.fromiter(map(len, docs), np.int64, len(docs))
        flat = np.concatenate(docs) if docs else np.zeros(0, np.uint64)
        first = np.cumsum(self.n) - self.n
        learn = np.repeat(train, self.n)
        self.words, self.word = np.unique(flat, return_inverse=True)
        self.word_counts = np.bincount(self.word[learn], minlength=len(self.words))
        before = np.empty_like(flat)
        before[1:] = flat[:-1]
        before[first] = START
        self.pairs, self.arc = np.unique(pair(before, flat), return_inverse=True)
        self.pair_counts = np.bincount(self.arc[learn], minlength=len(self.pairs))
        self.first, self.starts = first, int(train.sum())

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and training counts of words, bigrams and the start, in that order."""
        return (np.concatenate([self.words, self.pairs, [START]]),
                np.concatenate([self.word_counts, self.pair_counts, [self.starts]]))

    def buckets(self, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """The bucket of each, and an order that puts buckets together and hashes in each upward.

        Buckets below `parts` hold words, those from there on bigrams and the start.
        """
        hashes, _ = self.all()
        bucket = ((hashes >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
        bucket[len(self.words):] += parts
        return bucket, np.lexsort((hashes, bucket))


def _read(group: pa.Table) -> Grams:
    unpack = zstandard.ZstdDecompressor()
    docs = [tokens(unpack.decompress(t)) for t in group.column("text").to_pylist()]
    return Grams(docs, ~np.array(group.column("held_out").to_pylist(), bool))


def _varying(x: np.ndarray) -> bytes:
    """Small integers as bytes, larger ones as a list of exceptions."""
    big = np.flatnonzero(x > 254)
    low = np.minimum(x, 255).astype(np.uint8)
    return np.int64(len(x)).tobytes() + low.tobytes() + big.astype("<i4").tobytes() + \
        x[big].astype("<i8").tobytes()


def _varied(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    out = np.frombuffer(data, np.uint8, n, 8).astype(np.int64)
    m = (len(data) - 8 - n) // 12
    at = np.frombuffer(data, "<i4", m, 8 + n)
    out[at] = np.frombuffer(data, "<i8", m, 8 + n + 4 * m)
    return out


def scores(docs: DataFrame, prior: float = PRIOR, shard_bytes: int = 12 << 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; a row for each row."""
    base = two(docs)
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int")
    base = base.select("doc_id", shard.alias("shard"),
                       (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "text")

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in portions(batches, 1024):
            packed = pa.array([pack.compress(t) for t in texts(batch)], pa.binary())
            yield batch.set_column(3, "text", packed)

    dealt = base.mapInArrow(shrink, base.schema)

    def count(group: pa.Table) -> pa.Table:
        grams = _read(group)
        hashes, counts = grams.all()
        bucket, order = grams.buckets(shards)
        sorted_ = bucket[order]
        cut = np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1
        edges = np.concatenate([[0], cut, [len(order)]])
        hashes, counts = hashes[order], counts[order]
        one = group.column("shard")[0].as_py()
        blocks = [(a, b) for a, b in zip(edges[:-1], edges[1:]) if b > a]
        return pa.table({
            "shard": pa.array([one] * len(blocks), pa.int32()),
            "bucket": pa.array([int(sorted_[a]) for a, _ in blocks], pa.int32()),
            "grams": pa.array([_steps(hashes[a:b]) for a, b in blocks], pa.binary()),
            "counts": pa.array([_varying(counts[a:b]) for a, b in blocks], pa.binary())})

    blocks = dealt.groupBy("shard").applyInArrow(
        count, "shard int, bucket int, grams binary, counts binary")

    def total(group: pa.Table) -> pa.Table:
        shard = group.column("shard").to_pylist()
        held = [_stepped(g) for g in group.column("grams").to_pylist()]
        counts = np.concatenate([_varied(c) for c in group.column("counts").to_pylist()])
        _, row = np.unique(np.concatenate(held), return_inverse=True)
        sums = np.bincount(row, counts, minlength=row.max() + 1 if len(row) else 0).astype(np.int64)
        mine = sums[row]
        edges = np.cumsum([0] + [len(h) for h in held])
        words = group.column("bucket")[0].as_py() < shards
        rest = [0] * (len(shard) - 1)  # the bucket's totals stand in its first row
        return pa.table({
            "shard": pa.array(shard, pa.int32()), "bucket": group.column("bucket"),
            "sums": pa.array([_varying(mine[a:b]) for a, b in zip(edges[:-1], edges[1:])],
                             pa.binary()),
            "n": pa.array([int(sums.sum()) if words else 0, *rest], pa.int64()),
            "v": pa.array([int((sums > 0).sum()) if words else 0, *rest], pa.int64())})

    sums = materialize(blocks.groupBy("bucket").applyInArrow(
        total, "shard int, bucket int, sums binary, n long, v long"), "sums")
    n, v = sums.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    return _scored(dealt, sums.drop("n", "v"), shards, n, v, prior)


def _steps(x: np.ndarray) -> bytes:
    """Ascending integers as differences, each in as few bytes as the widest needs, by plane."""
    d = np.diff(x, prepend=np.uint64(0))
    wide = max(1, (int(d[1:].max()).bit_length() + 7) // 8) if len(d) > 1 else 1
    head = np.array([len(x), wide], "<i4").tobytes() + x[:1].astype("<u8").tobytes()
    planes = d[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]
    return head + np.ascontiguousarray(planes.T).tobytes()


def _stepped(data: bytes) -> np.ndarray:
    n, wide = np.frombuffer(data, "<i4", 2)
    out = np.zeros((n, 8), np.uint8)
    if n > 1:
        out[1:, :wide] = np.frombuffer(data, np.uint8, (n - 1) * wide, 16).reshape(wide, n - 1).T
    d = out.reshape(-1).view("<u8")
    d[0] = np.frombuffer(data, "<u8", 1, 8)[0]
    return np.cumsum(d, dtype=np.uint64)


class Automaton:
    """The part of the model that a shard reaches.

    States are words as histories, and one without history (the last). Arcs are bigrams met in the
    shard's texts, by their place in its sorted list; `met` tells which the training texts have.
    """

    def __init__(self, grams: Grams, sums: np.ndarray, n: int, v: int, prior: float) -> None:
        words = len(grams.words)
        self.known = sums[:words]
        arcs = sums[words:words + len(grams.pairs)]
        base = (self.known + 0.5) / (n + 0.5 * (v + 1))
        self.base = np.log10(base)
        self.history = np.append(self.known, sums[-1])  # the start's count last
        self.fail = np.log10(prior / (self.history + prior))
        self.met = arcs > 0
        self.arcs, self.prior, self.plain = arcs, prior, base

    def read(self, grams: Grams) -> np.ndarray:
        """Log10 weight of each token: all texts step from left to right together."""
        out = np.empty(len(grams.word))
        order = np.argsort(-grams.n, kind="stable")
        length = grams.n[order]
        state = np.full(len(order), len(self.history) - 1)
        for step in range(int(length[0]) if len(length) else 0):
            live = int(np.searchsorted(-length, -step, side="left"))
            at = grams.first[order[:live]] + step
            w, arc, s = grams.word[at], grams.arc[at], state[:live]
            # an arc that is not met is taken from the state without history, over the failure arc
            weight = self.fail[s] + self.base[w]
            met = self.met[arc]
            a, b, c = arc[met], s[met], w[met]
            weight[met] = np.log10((self.arcs[a] + self.prior * self.plain[c])
                                   / (self.history[b] + self.prior))
            out[at] = weight
            state[:live] = w
        return out


def _scored(dealt: DataFrame, sums: DataFrame, shards: int, n: int, v: int,
            prior: float) -> DataFrame:
    def score(docs: pa.Table, parts: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return OUT.empty_table()
        grams = _read(docs)
        _, by = grams.buckets(shards)
        blocks = sorted(zip(parts.column("bucket").to_pylist(), parts.column("sums").to_pylist()))
        mine = np.empty(len(by), np.int64)
        mine[by] = np.concatenate([_varied(s) for _, s in blocks])
        model = Automaton(grams, mine, n, v, prior)
        weight = model.read(grams)
        known = (model.known > 0)[grams.word]
        sum_ = lambda x: np.add.reduceat(x, grams.first)
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": pa.array(grams.n),
            "n_known": pa.array(sum_(known.astype(np.int64))),
            "train_tokens": pa.array(np.full(len(grams.n), n)),
            "base_score": pa.array(sum_(model.base[grams.word])),
            "score": pa.array(sum_(weight))}, schema=OUT)

    return dealt.groupBy("shard").cogroup(sums.groupBy("shard")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
               "base_score double, score double")


OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                 ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                 ("base_score", pa.float64()), ("score", pa.float64())])
