"""Removal of word windows that an earlier document has, behind a count-min sketch.

A window is `width` consecutive words of one document. Nearly all windows stand in one document
alone, and shuffling each of them to find that out costs several times the texts. So a count-min
sketch looks first: `depth` rows of counters, of which a window raises one a row. Documents lie in
blocks of some megabytes. A block makes a sketch of its own, which holds the counters it raises and
no other, and the sketches of all blocks are merged by ranges of counters, so that a range is a
small array in one task and the whole sketch is nowhere. Its width follows the size of the texts
(`load` windows a counter at most, by the bytes), hence it is as selective at any size.

Counters never fall short, so a window that stands in two documents is never lost; some others pass
as well. What passes is then grouped exactly, by 96 bits of hash, to the least doc_id of each
window. Blocks contribute a distinct window once, with the least and greatest doc_id that has it: a
window that stands everywhere is one row a block, however often it occurs.

Null and empty texts have no words. A row with a null doc_id comes neither before nor after any
other: it loses nothing and costs nothing elsewhere. Rows of equal doc_id do not cost each other
anything. Every row comes out once. A text longer than a block is a block of its own. Other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import forget, mix, signed, slices, two
from tidemark.llm.words import Words, windows, words
from tidemark.session import materialize

#: Bytes of text a block, and counters a range.
BLOCK, RANGE = 8 << 20, 1 << 23
#: Bytes of text that are hashed at once.
_PORTION = 1 << 20


def blocks(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """block, bytes, docs: documents in compressed blocks, numbered by the task that reads them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        task, made = TaskContext.get().partitionId(), 0
        pack = zstandard.ZstdCompressor(level=3)
        held: list[pa.RecordBatch] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal size, made
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches(held).combine_chunks()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            out = pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + made]), pa.array([size]),
                 pa.array([pack.compress(sink.getvalue())], pa.binary())],
                ["block", "bytes", "docs"])
            held.clear()
            size, made = 0, made + 1
            return out

        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("text")).to_numpy()
            for a, b in slices(sizes, block):
                part = int(sizes[a:b].sum())
                if held and size + part > block:
                    yield close()
                # copied, so that a block does not hold the whole batch
                held.append(pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([c.slice(a, b - a)]) for c in batch.columns],
                    batch.schema.names))
                size += part
        if held:
            yield close()

    return two(docs).mapInArrow(run, "block long, bytes long, docs binary")


def opened(packed: bytes) -> tuple[pa.Array, pa.Array]:
    """doc_id and text of a block."""
    table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(packed)).read_all()
    table = table.combine_chunks()
    return table.column("doc_id").combine_chunks(), table.column("text").combine_chunks()


def portions(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, Words]]:
    """Rows from … to, their bytes and words, some texts at a time."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    for a, b in slices(np.diff(offsets), _PORTION):
        part = data[offsets[a]:offsets[b]]
        yield a, b, part, words(part, (offsets[a:b + 1] - offsets[a]).astype(np.int64))


class Block:
    """The distinct windows of a block, sorted, with the least and greatest doc_id of each."""

    def __init__(self, packed: bytes, width: int) -> None:
        ids, texts = opened(packed)
        known = np.asarray(ids.is_valid())
        doc = ids.fill_null(0).to_numpy()
        parts = []
        for a, _, _, found in portions(texts):
            at, h, g = windows(found, width)
            row = found.text[at] + a
            keep = known[row]
            parts.append((h[keep], (g[keep] >> np.uint64(32)).astype(np.uint32), doc[row[keep]]))
        h, g, doc = (np.concatenate(x) for x in zip(*parts)) if parts else (
            np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64))
        parts.clear()
        order = np.argsort(h)
        one = h[order[1:]] == h[order[:-1]]
        if (one & (g[order[1:]] != g[order[:-1]])).any():   # 64 bits were not enough
            order = np.lexsort((g, h))
        h, g, doc = h[order], g[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        at = np.flatnonzero(new)
        #: of each window of the block, in the order of the text: its place among the distinct ones
        self.place = np.empty(len(h), np.int32)
        self.place[order] = np.cumsum(new, dtype=np.int32) - 1
        self.h, self.g = h[at], g[at]
        self.least = np.minimum.reduceat(doc, at) if len(at) else doc
        self.shared = (np.maximum.reduceat(doc, at) if len(at) else doc) > self.least

    def counters(self, row: int, wide: int) -> np.ndarray:
        salt = mix(self.g.astype(np.uint64) * np.uint64(row + 1) + np.uint64(row))
        return mix(self.h ^ salt) >> np.uint64(64 - wide)


def _packed(counters: np.ndarray) -> bytes:
    """Ascending integers, as compressed planes of the bytes of their differences."""
    d = np.diff(counters, prepend=np.uint64(0)).astype("<u4")
    planes = np.ascontiguousarray(d.view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    d = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").reshape(-1)
    return np.cumsum(d, dtype=np.int64)


def sketch_width(size: int, load: float) -> int:
    """Bits of the number of a counter: `load` windows a counter, if a word has six bytes."""
    return max(23, int(np.ceil(np.log2(max(1.0, size / 6 / load)))))


def sketches(stored: DataFrame, width: int, depth: int, wide: int) -> DataFrame:
    """slice, block, counters, twice: the sketch of each block, by ranges of counters. `twice`
    tells which of the counters it raises more than once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, packed in zip(batch.column("block").to_pylist(), batch.column("docs")):
                yield made(name, Block(packed.as_py(), width))

    def made(name: int, block: Block) -> pa.RecordBatch:
        weight, rows = 1 + block.shared, []
        for row in range(depth):
            counters = block.counters(row, wide)
            order = np.argsort(counters)
            raised, at = np.unique(counters[order], return_index=True)
            twice = np.add.reduceat(weight[order], at) > 1 if len(at) else at > 1
            part = raised // np.uint64(RANGE)
            edges = np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1)))
            for a, b in zip(edges, [*edges[1:], len(part)]):
                rows.append(((row << 40) + int(part[a]), _packed(raised[a:b] % np.uint64(RANGE)),
                             np.packbits(twice[a:b]).tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([name] * len(rows), pa.int64()),
             pa.array([r[1] for r in rows], pa.binary()),
             pa.array([r[2] for r in rows], pa.binary())], ["slice", "block", "counters", "twice"])

    return stored.mapInArrow(run, "slice long, block long, counters binary, twice binary")


def merged(parts: DataFrame) -> DataFrame:
    """block, slice, twice: what the sum of all sketches says of the counters of each."""
    def run(group: pa.Table) -> pa.Table:
        total = np.zeros(RANGE, np.uint8)
        held = [_unpacked(c) for c in group.column("counters").to_pylist()]
        for at, twice in zip(held, group.column("twice").to_pylist()):
            more = 1 + np.unpackbits(np.frombuffer(twice, np.uint8), count=len(at))
            total[at] = np.minimum(total[at] + more, 2)
        return pa.table({
            "block": group.column("block"), "slice": group.column("slice"),
            "twice": pa.array([np.packbits(total[at] > 1).tobytes() for at in held], pa.binary())})

    return parts.groupBy("slice").applyInArrow(run, "block long, slice long, twice binary")


def estimated_repeated(stored: DataFrame, sums: DataFrame, width: int, depth: int,
                       wide: int) -> DataFrame:
    """block, h, g, least, place: windows that by the sketch more than one document has, with the
    least doc_id in the block, and their place among its distinct windows."""
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        for name, packed in zip(docs.column("block").to_pylist(), docs.column("docs")):
            block = Block(packed.as_py(), width)
            twice = sorted(zip(replies.column("slice").to_pylist(),
                               replies.column("twice").to_pylist()))
            passed = np.ones(len(block.h), bool)
            for row in range(depth):
                raised, at = np.unique(block.counters(row, wide), return_inverse=True)
                part = raised // np.uint64(RANGE)
                sizes = np.diff(np.append(np.flatnonzero(
                    np.diff(part, prepend=part[:1] + np.uint64(1))), len(part)))
                bits = [np.unpackbits(np.frombuffer(t, np.uint8), count=n)
                        for (_, t), n in zip((x for x in twice if x[0] >> 40 == row), sizes)]
                passed &= np.concatenate([*bits, np.zeros(0, np.uint8)]).astype(bool)[at]
            place = np.flatnonzero(passed).astype(np.int32)
            out.append(pa.table({
                "block": pa.array(np.full(len(place), name)), "h": pa.array(signed(block.h[passed])),
                "g": pa.array(block.g[passed].view(np.int32)), "least": pa.array(block.least[passed]),
                "place": pa.array(place)}))
        return pa.concat_tables(out) if out else _PASSED.empty_table()

    return stored.select("block", "docs").groupBy("block").cogroup(sums.groupBy("block")) \
        .applyInArrow(run, "block long, h long, g int, least long, place int")


_PASSED = pa.schema([("block", pa.int64()), ("h", pa.int64()), ("g", pa.int32()),
                     ("least", pa.int64()), ("place", pa.int32())])
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                   ("text", pa.string())])


def met_before(passed: DataFrame) -> DataFrame:
    """block, place: windows that a document has which comes before all that have it in the block.

    A window has at most one row a block, so no group outgrows the number of blocks.
    """
    first = F.min("least").over(Window.partitionBy("h", "g"))
    return passed.withColumn("first", first).filter("first < least").select("block", "place")


def without_earlier_windows(docs: DataFrame, width: int = 13, depth: int = 2, load: float = 0.125,
                            block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_removed, text: the kept words of each row, joined by one space."""
    stored = materialize(blocks(docs, block), "blocks")
    size = stored.agg(F.sum("bytes")).first()[0] or 0
    wide = sketch_width(size, load)
    sums = merged(sketches(stored.select("block", "docs"), width, depth, wide))
    before = met_before(estimated_repeated(stored, sums, width, depth, wide))

    def cut(docs: pa.Table, found: pa.Table) -> pa.Table:
        out = [_cut(packed.as_py(), width, found.column("place").to_numpy())
               for packed in docs.column("docs")]
        return pa.concat_tables(out) if out else _KEPT.empty_table()

    return stored.select("block", "docs").groupBy("block").cogroup(before.groupBy("block")) \
        .applyInArrow(cut, "doc_id long, n_words long, n_removed long, text string")


def _cut(packed: bytes, width: int, before: np.ndarray) -> pa.Table:
    """`before`: the windows that an earlier document outside has. The others belong to the first
    document of the block that has them."""
    block = Block(packed, width)
    earlier = np.zeros(len(block.h), bool)
    earlier[before] = True
    # of each window that has a doc_id, in the order of the text
    earlier, owner = earlier[block.place], block.least[block.place]
    ids, texts = opened(packed)
    known = np.asarray(ids.is_valid())
    doc = ids.fill_null(0).to_numpy()
    n_words, n_removed, kept, done = [], [], [], 0
    for a, b, data, found in portions(texts):
        at, _, _ = windows(found, width)
        row = found.text[at] + a
        at, row = at[known[row]], row[known[row]]
        here = slice(done, done + len(at))
        gone = at[earlier[here] | (owner[here] < doc[row])]
        done += len(at)
        step = np.zeros(len(found.hashes) + 1, np.int64)
        np.add.at(step, gone, 1)
        np.add.at(step, gone + width, -1)
        stays = np.cumsum(step[:-1]) == 0
        n = np.bincount(found.text, minlength=b - a)
        left = np.bincount(found.text[stays], minlength=b - a)
        n_words.append(n)
        n_removed.append(n - left)
        raw, at = data.tobytes(), 0
        s, e = found.starts[stays].tolist(), found.ends[stays].tolist()
        for count in left.tolist():
            kept.append(b" ".join([raw[i:j] for i, j in zip(s[at:at + count], e[at:at + count])]))
            at += count
    return pa.table([ids, pa.array(np.concatenate(n_words)), pa.array(np.concatenate(n_removed)),
                     pa.array(kept, pa.binary()).cast(pa.string())], schema=_KEPT)
