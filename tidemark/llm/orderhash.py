"""Fingerprints by order min hashing.

A k-mer is `K` words in a row, numbered by how often it has occurred before in the text. Under
each of `TUPLES` permutations the `ORDER` least numbered k-mers are taken, put back into the order
of the text and hashed together. Two texts then agree in an entry if they share these k-mers *and*
their order, so the share of equal entries falls with edits and with moved passages alike.

Words are runs of bytes other than blanks and bytes 9 to 13, as they stand. A text of fewer than K
words has one k-mer of them all; one without words is one empty k-mer. Where there are fewer than
ORDER k-mers, all are taken. Equal texts have equal fingerprints; so have texts that differ in
white space alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import keeps, mix, portions, slices, two
from tidemark.session import materialize

K, ORDER, TUPLES = 3, 2, 64
_SEEDS = mix(np.arange(1, TUPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_LOW = np.uint64((1 << 24) - 1)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, 5)
        return found


_hashes = _Hashes()
keeps("orderhash", _hashes.clear)


def kmers(text: bytes) -> np.ndarray:
    """Hashes of the occurrence-numbered k-mers, in text order."""
    words = text.split()
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    if len(h) < K:
        out = np.array([len(h)], np.uint64)
        for x in h:
            out = mix(out ^ x) + np.uint64(1)
        return out
    out = h[:len(h) - K + 1].copy()
    for j in range(1, K):
        out = mix(out) + h[j:len(h) - K + 1 + j]
    order = np.argsort(out, kind="stable")
    same = out[order]
    new = np.concatenate([[True], same[1:] != same[:-1]])
    if not new.all():
        row = np.arange(len(same))
        number = np.empty(len(same), np.uint64)
        number[order] = row - np.maximum.accumulate(np.where(new, row, 0))
        out = mix(out + number * np.uint64(0x632BE59BD9B4E019))
    return mix(out)


def fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    """TUPLES 32-bit entries per text.

    The place in the text takes the low bits of each hash, so that the least hash tells where it
    is. Texts of more than 2^24 k-mers keep exact order by being handled with full indices.
    """
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.empty((len(sets), TUPLES), np.uint32)
    for a, b in slices(n, 1 << 15):
        flat = np.concatenate(sets[a:b])
        m = n[a:b]
        at = np.cumsum(m) - m
        row = np.repeat(np.arange(b - a), m)
        if len(flat) > int(_LOW):
            out[a:b] = _one_by_one(flat)
            continue
        place = np.arange(len(flat), dtype=np.uint64)
        single = m == 1
        for t, seed in enumerate(_SEEDS):
            v = flat * seed
            v ^= v >> np.uint64(29)
            v &= ~_LOW
            v |= place
            first = np.minimum.reduceat(v, at) & _LOW
            v[first.astype(np.int64)] = _TOP
            second = np.minimum.reduceat(v, at) & _LOW
            second[single] = first[single]
            x, y = np.minimum(first, second), np.maximum(first, second)
            entry = mix(mix(flat[x.astype(np.int64)] ^ seed) + flat[y.astype(np.int64)])
            out[a:b, t] = (entry >> np.uint64(32)).astype(np.uint32)
    return out


def _one_by_one(flat: np.ndarray) -> np.ndarray:
    """The same for one very long text."""
    out = np.empty((1, TUPLES), np.uint32)
    for t, seed in enumerate(_SEEDS):
        v = flat * seed
        v ^= v >> np.uint64(29)
        v &= ~_LOW
        x, y = np.sort(np.argsort(v, kind="stable")[:ORDER])
        out[0, t] = int(mix(mix(flat[x:x + 1] ^ seed) + flat[y:y + 1])[0] >> np.uint64(32))
    return out


def edited(text: str, after: str) -> str:
    """The last half of the text replaced by the beginning of the next, as long as the half."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def _bytes(prints: np.ndarray) -> list[bytes]:
    return [p.astype(">u4").tobytes() for p in prints]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint binary, "
          "edited_fingerprint binary, near_edited double, near_next double")
_PART = RESULT + ", part int, own binary, head binary"
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()), ("part", pa.int32()),
    ("own", pa.binary()), ("head", pa.binary())])


def _rows(ids: list, own: list[str], after: list[str], now: np.ndarray, then: np.ndarray) -> dict:
    new = [edited(a, b) for a, b in zip(own, after)]
    raw = [x.encode() for x in new]
    prints = fingerprints([kmers(x) for x in raw]) if raw else np.zeros((0, TUPLES), np.uint32)
    return {"doc_id": ids, "n_chars": [len(x) for x in own],
            "edited_sha256": [hashlib.sha256(x).hexdigest() for x in raw],
            "fingerprint": _bytes(now), "edited_fingerprint": _bytes(prints),
            "near_edited": (now == prints).mean(axis=1), "near_next": (now == then).mean(axis=1)}


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text; a row for each row of `docs`.

    The next document is the one with the next doc_id, nulls first and equal ids by content; after
    the last comes the first, which may be the document itself. One shuffle by ranges of doc_id; a
    task hands the text of its first and its last document on, and these few rows, one or two for
    each task, are joined in a second step.
    """
    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in portions(batches):
            yield batch.set_column(2, "text", pa.array(map(pack.compress, batch.column(
                "text").to_pylist()), pa.binary()))

    packed = two(docs).select("doc_id", F.xxhash64("text").alias("content"), "text").mapInArrow(
        shrink, "doc_id long, content long, text binary")
    spread = packed.repartitionByRange("doc_id", "content").sortWithinPartitions("doc_id", "content")

    def opened(packed: pa.Array) -> list[str]:
        unpack = zstandard.ZstdDecompressor()
        return [unpack.decompress(t).decode("utf-8", "replace") for t in packed.to_pylist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, head = None, None
        for batch in portions(batches, 1024, "orderhash"):
            ids = batch.column("doc_id").to_pylist()
            if not ids:
                continue
            own = opened(batch.column("text"))
            prints = fingerprints([kmers(t.encode()) for t in own])
            if last is None:
                head = batch.column("text")[0].as_py()
            else:
                ids, own = [last[0], *ids], [last[1], *own]
                prints = np.concatenate([last[2][None], prints])
            done = _rows(ids[:-1], own[:-1], own[1:], prints[:-1], prints[1:])
            n = len(ids) - 1
            done |= {"part": [part] * n, "own": [None] * n, "head": [None] * n}
            yield pa.RecordBatch.from_pydict(done, schema=_SCHEMA)
            last = ids[-1], own[-1], prints[-1], batch.column("text")[-1].as_py()
        if last is not None:
            row = dict.fromkeys(_SCHEMA.names)
            row |= {"doc_id": last[0], "part": part, "own": last[3], "head": head}
            yield pa.RecordBatch.from_pylist([row], schema=_SCHEMA)

    found = materialize(spread.mapInArrow(run, _PART), "orderhash")
    done = found.filter("own IS NULL").drop("part", "own", "head")
    ends = found.filter("own IS NOT NULL").select("doc_id", "part", "own", "head")
    # a number for each task of the shuffle in one place; the texts are joined by it
    by, everywhere = Window.orderBy("part"), Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    after = ends.select("part").select("part", F.coalesce(
        F.lead("part").over(by), F.first("part").over(everywhere)).alias("after"))
    heads = ends.select(F.col("part").alias("after"), "head")
    ends = ends.select("doc_id", "part", "own").join(after, "part").join(heads, "after")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 256, "orderhash"):
            own, after = opened(batch.column("own")), opened(batch.column("head"))
            if own:
                now, then = (fingerprints([kmers(t.encode()) for t in x]) for x in (own, after))
                yield pa.RecordBatch.from_pydict(_rows(
                    batch.column("doc_id").to_pylist(), own, after, now, then),
                    schema=pa.schema(list(_SCHEMA)[:7]))

    finished = ends.select("doc_id", "own", "head").mapInArrow(finish, RESULT)
    return done.unionAll(finished).withColumns({
        c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})
