"""Packing of token ids into sequences by online best fit over a fixed number of open bins.

The open bins are kept by free space, with one bit per free space that has a bin. A piece goes into
the bin with the least free space that still holds it; the lowest such bit finds it. If none does,
a new bin is opened, and where all are in use, the fullest is closed. A placement is final, so
pieces leave a task as soon as they are placed. Pieces are taken from a buffer of `window` tokens,
longest first, which wastes least; the buffer and the open bins are all that a task holds.

Each task packs what it reads; nothing is shuffled. Null and empty texts hold the end id alone;
equal rows are packed as often as they come; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import give_back, portions, texts, two
from tidemark.llm.encoding import encoder

PACKED = ("doc_id long, piece int, start long, length long, sequence_id long, offset long, "
          "ids binary")


class BestFit:
    """At most `most_open` bins of `capacity`; `place` gives the bin and the offset in it."""

    def __init__(self, capacity: int, most_open: int) -> None:
        self.capacity, self.most_open = capacity, most_open
        self.free = 0  # bit f: some open bin has f free
        self.bins: dict[int, list[int]] = defaultdict(list)
        self.open = self.made = 0

    def _take(self, space: int) -> int:
        held = self.bins[space]
        found = held.pop()
        if not held:
            self.free &= ~(1 << space)
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        if not 0 < length <= self.capacity:
            raise ValueError(f"a piece of {length} does not fit {self.capacity}")
        fits = self.free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            found = self._take(space)
        else:
            if self.open == self.most_open:  # the fullest closes first
                self._take((self.free & -self.free).bit_length() - 1)
            space, found = self.capacity, self.made
            self.made += 1
        left = space - length
        if left:
            self.bins[left].append(found)
            self.free |= 1 << left
            self.open += 1
        return found, self.capacity - space


def pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole ones, but for a first one that is shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, kind: str = "byte",
         capacity: int = 2048, most_open: int = 1024, window: int = 1 << 23) -> DataFrame:
    """A row per piece with its place and its ids (little-endian unsigned 32-bit integers).

    `sequence_id` is the task's number and the bin's in it; a task that is run again gives the
    whole of its bins anew, so places stay consistent.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, fit = encoder(tokenizer, kind), BestFit(capacity, most_open)
        first = TaskContext.get().partitionId() << 33
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            held.sort(key=lambda x: -x[3])
            for at in range(0, len(held), 4096):
                some = held[at:at + 4096]
                placed = [fit.place(x[3]) for x in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in some], pa.int64()),
                     pa.array([x[1] for x in some], pa.int32()),
                     pa.array([x[2] for x in some], pa.int64()),
                     pa.array([x[3] for x in some], pa.int64()),
                     pa.array([first + b for b, _ in placed], pa.int64()),
                     pa.array([o for _, o in placed], pa.int64()),
                     pa.array([x[4].astype("<u4").tobytes() for x in some], pa.binary())],
                    ["doc_id", "piece", "start", "length", "sequence_id", "offset", "ids"])

        for batch in portions(batches, 1024, "encoding"):
            ids, counts = coder.encode(texts(batch))
            at = 0
            for doc_id, n in zip(batch.column("doc_id").to_pylist(), counts.tolist()):
                own = np.append(ids[at:at + n], ids.dtype.type(end_id))
                at += n
                held += [(doc_id, i, s, m, own[s:s + m])
                         for i, (s, m) in enumerate(pieces(n + 1, capacity))]
                size += n + 1
                if size >= window:
                    yield from flush()
                    held, size = [], 0
        yield from flush()
        held = batch = ids = own = None
        give_back()

    return two(docs).mapInArrow(run, PACKED)


def packed(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Packing with the ids replaced by their crc32."""
    return pack(docs, tokenizer).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "sequence_id", "offset")
