"""Token ids as wavelet matrices, one compressed file per shard.

A shard holds the ids of consecutive documents as bit planes, most significant bit first. At each
plane the ids are split stably by their bit, so that access, counting and occurrence lookup cost
one rank or select per plane, without decoding the rest.

Documents are put in ascending order of doc_id (nulls first, then by content), encoded, closed with
an end id and cut into shards of about `shard_tokens`; a document is never cut. The shards are
Parquet files with one row each: `doc_ids`, `lengths`, `planes`. Null and empty texts hold the end
id alone; equal rows are stored as often as they come; an empty table gives no shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import portions, texts, two
from tidemark.llm.encoding import encoder
from tidemark.session import scratch_path

BLOCK = 512  # bits between two entries of the rank directory
SHARD = ("part long, shard long, start long, n_tokens long, doc_ids array<long>, "
         "lengths array<long>, planes binary")


class WaveletMatrix:
    """Planes of bits with a rank directory."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: np.ndarray,
                 ranks: list[np.ndarray]) -> None:
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        seq = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, ranks, zeros = [], [], np.zeros(bits, np.int64)
        for level in range(bits):
            one = (seq & seq.dtype.type(1 << (bits - 1 - level))).astype(bool)
            packed = np.packbits(one)
            planes.append(packed)
            ranks.append(_directory(packed))
            low, high = seq[~one], seq[one]
            zeros[level] = len(low)
            seq = np.concatenate([low, high])
        return cls(len(ids), planes, zeros, ranks)

    def to_bytes(self) -> bytes:
        head = np.array([self.n, len(self.planes)], "<i8").tobytes()
        return b"".join([head, self.zeros.astype("<i8").tobytes(),
                         *(p.tobytes() for p in self.planes),
                         *(r.astype("<u4").tobytes() for r in self.ranks)])

    @classmethod
    def from_bytes(cls, blob: bytes) -> WaveletMatrix:
        n, bits = map(int, np.frombuffer(blob, "<i8", 2))
        zeros = np.frombuffer(blob, "<i8", bits, 16)
        at, width = 16 + 8 * bits, (n + 7) // 8
        planes = [np.frombuffer(blob, np.uint8, width, at + i * width) for i in range(bits)]
        at += bits * width
        entries = width // (BLOCK // 8) + 1
        ranks = [np.frombuffer(blob, "<u4", entries, at + 4 * i * entries) for i in range(bits)]
        return cls(n, planes, zeros, ranks)

    def _ones(self, level: int, i: int) -> int:
        """Set bits of the plane before position i."""
        block = i // BLOCK
        lo = block * BLOCK // 8
        rest = np.unpackbits(self.planes[level][lo:(i + 7) // 8])[:i - block * BLOCK]
        return int(self.ranks[level][block]) + int(rest.sum())

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of that value in the plane."""
        before = self.ranks[level].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        lo = block * BLOCK
        held = np.unpackbits(self.planes[level][lo // 8:lo // 8 + BLOCK // 8])[:self.n - lo]
        return lo + int(np.flatnonzero(held == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        """The id at position i."""
        value = 0
        for level, plane in enumerate(self.planes):
            bit = plane[i >> 3] >> (7 - (i & 7)) & 1
            ones = self._ones(level, i)
            i = int(self.zeros[level]) + ones if bit else i - ones
            value = value << 1 | int(bit)
        return value

    def count(self, value: int, start: int = 0, stop: int | None = None) -> int:
        """How often the id occurs in [start, stop)."""
        lo, hi = start, self.n if stop is None else stop
        if value >> len(self.planes):
            return 0
        for level in range(len(self.planes)):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if value >> (len(self.planes) - 1 - level) & 1:
                lo, hi = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                lo, hi = lo - a, hi - b
        return hi - lo

    def find(self, value: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of the id, or -1."""
        if not 0 <= k < self.count(value):
            return -1
        lo, path = 0, []
        for level in range(len(self.planes)):
            bit = value >> (len(self.planes) - 1 - level) & 1
            ones = self._ones(level, lo)
            lo = int(self.zeros[level]) + ones if bit else lo - ones
            path.append(bit)
        at = lo + k
        for level in reversed(range(len(self.planes))):
            bit = path[level]
            at = self._select(level, bit, at - int(self.zeros[level]) if bit else at)
        return at

    def decode(self) -> np.ndarray:
        """All ids, by undoing the splits from the last plane to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        seq = np.zeros(self.n, kind)
        for shift, (plane, zeros) in enumerate(zip(self.planes[::-1], self.zeros[::-1])):
            one = np.unpackbits(plane, count=self.n).view(bool)
            out = np.empty(self.n, kind)
            out[~one] = seq[:zeros]
            out[one] = seq[zeros:] | kind(1 << shift)
            seq = out
        return seq.astype(np.uint32)


def _directory(packed: np.ndarray) -> np.ndarray:
    per = np.bitwise_count(packed).astype(np.uint32)
    size = BLOCK // 8
    whole = len(per) // size * size
    sums = per[:whole].reshape(-1, size).sum(axis=1, dtype=np.uint32)
    return np.concatenate([[0], np.cumsum(sums)]).astype(np.uint32)


def write_shards(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, kind: str = "word",
                 shard_tokens: int = 1 << 22) -> None:
    """Write the shards of all documents below `path`.

    One shuffle by ranges of (doc_id, content hash), so many rows under one id still spread. A task
    holds one shard and one batch of texts.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(tokenizer, kind), TaskContext.get().partitionId()
        doc_ids, lengths, held, size, start, shard = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(held)
            return pa.RecordBatch.from_pydict({
                "part": [part], "shard": [shard], "start": [start], "n_tokens": [len(ids)],
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                "lengths": pa.array([lengths], pa.list_(pa.int64())),
                "planes": pa.array([WaveletMatrix.of(ids).to_bytes()], pa.binary())})

        for batch in portions(batches, 4096, "encoding"):
            ids, counts = coder.encode(texts(batch))
            at = 0
            for doc_id, n in zip(batch.column("doc_id").to_pylist(), counts.tolist()):
                if size and size + n + 1 > shard_tokens:
                    yield close()
                    start, shard = start + size, shard + 1
                    doc_ids, lengths, held, size = [], [], [], 0
                doc_ids.append(doc_id)
                lengths.append(n + 1)
                held += [ids[at:at + n], np.array([end_id], ids.dtype)]
                at, size = at + n, size + n + 1
        if size:
            yield close()

    ordered = two(docs).repartitionByRange("doc_id", F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"))
    (ordered.mapInArrow(build, SHARD).write
     .option("maxRecordsPerFile", 1).option("compression", "zstd")
     # one row is a whole shard: look at the size of a page after each
     .option("parquet.page.size.row.check.min", 1).option("parquet.block.size.row.check.min", 1)
     .parquet(path))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the shards: doc_id, start (ids of all documents before it), n_tokens, ids.

    `ids` are little-endian unsigned 32-bit integers. Offsets come from one row per range of the
    writer, not per shard or document.
    """
    shards = spark.read.schema(SHARD).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
               .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = WaveletMatrix.from_bytes(row["planes"]).decode().astype("<u4", copy=False)
                n = np.array(row["lengths"], np.int64)
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(len(n), row["part"])),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": pa.array(row["start"] + ends - n), "n_tokens": pa.array(n),
                    "ids": pa.array([ids[a:b].tobytes() for a, b in zip(ends - n, ends)],
                                    pa.binary())})

    found = shards.mapInArrow(unpack, "part long, doc_id long, start long, n_tokens long, ids binary")
    return found.join(offsets, "part").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids")


def occurrences(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """doc_id, token, at (from 0 in the document): where the tokens stand, by rank and select in the
    shard files; no shard is decoded."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = WaveletMatrix.from_bytes(row["planes"])
                starts = np.concatenate([[0], np.cumsum(row["lengths"])])
                for token in tokens:
                    found = np.array([matrix.find(token, k) for k in range(matrix.count(token))], np.int64)
                    own = np.searchsorted(starts, found, "right") - 1
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(row["doc_ids"], pa.int64()).take(pa.array(own)),
                        "token": pa.array(np.full(len(found), token, np.int64)),
                        "at": pa.array(found - starts[own])})

    return spark.read.schema(SHARD).parquet(path).mapInArrow(find, "doc_id long, token long, at long")


def counts(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """token, n: how often each token stands in all shards, by rank alone."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for planes in batch.column("planes"):
                matrix = WaveletMatrix.from_bytes(planes.as_py())
                yield pa.RecordBatch.from_pydict({
                    "token": pa.array(tokens, pa.int64()),
                    "n": pa.array([matrix.count(t) for t in tokens], pa.int64())})

    shards = spark.read.schema(SHARD).parquet(path).select("planes")
    return shards.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write shards below the shared folder and digest what is read back from them."""
    spark = docs.sparkSession
    path = scratch_path(spark, "wavelet")
    write_shards(docs, tokenizer, path)
    return read_shards(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
