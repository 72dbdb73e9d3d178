"""What the operators share: reading the two columns they use, word splitting, fold of a document."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

M64 = np.uint64(0xFFFFFFFFFFFFFFFF)


def two(docs: DataFrame) -> DataFrame:
    """`doc_id` as long and `text` as bytes; no other column, so that no name can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").to_pylist()


#: How to empty what an operator keeps in a Python worker from task to task, by operator.
_kept: dict[str, Callable[[], None]] = {}


def keeps(operator: str, empty: Callable[[], None]) -> None:
    _kept[operator] = empty


@cache
def _trim() -> Callable[[int], int]:
    """`malloc_trim` where the C library has it."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def give_back() -> None:
    """What has been freed goes back to the system: else a worker holds the most it ever used while it
    waits, and the next stage of its executor has that much less."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def forget(all_but: str | None = None) -> None:
    """Empty what other operators have left in this worker: workers outlive stages."""
    for operator, empty in _kept.items():
        if operator != all_but:
            empty()
    give_back()


def portions(batches: Iterator[pa.RecordBatch], rows: int = 256,
             keep: str | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what is made of a batch stays small. The task begins
    with what operator `keep` has kept in its worker, and nothing else, and leaves nothing else."""
    forget(keep)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    batch = None
    give_back()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, on whole arrays of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all the slices [start, start + length), one slice after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most `most` items together; a longer row is a run of its own."""
    at, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > most:
            yield at, i
            at, held = i, 0
        held += int(n)
    if at < len(lengths):
        yield at, len(lengths)
