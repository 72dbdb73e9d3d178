"""Long repeats across a corpus, found with run-length indexes and cut out.

A byte goes if a string of `length` bytes covers it that starts anywhere else too, in the same
document or another. Strings never cross documents and are judged on the input.

1. Anchors. In every window of `length` bytes the k-gram with the least hash is an anchor, so two
   equal windows have equal anchors at equal places. An anchor's context is all that windows over
   it can reach; its bytes are hashed with it.
2. Counting. Anchors met once are dropped. If all contexts of an anchor are equal, all of their
   windows are repeats. The others are *mixed*.
3. Indexing. Of each mixed anchor the distinct contexts are brought together, many anchors to an
   index. An index is a run-compressed Burrows-Wheeler transform of the contexts, aligned at their
   anchors. Matching statistics are streamed through it from right to left: in a run the match of
   neighbours grows by one, and only at run ends it is sampled. Two contexts are two different
   places in the corpus, and so are their windows at equal distances from the anchor.
4. Cutting. Repeated ranges go back to their documents.

An anchor with more distinct contexts than `most_contexts` (a short common passage in ever new
company) is not indexed in one place: its windows are counted one by one, by 128-bit hashes over
all tasks, which gives the same ranges.

Null texts count as empty; texts shorter than `length` and empty tables have no repeats; equal rows
are copies of each other, and go whole if they are long enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import forget, mix, portions, ranges, signed, texts, two
from tidemark.session import materialize

K = 128  # bytes of an anchor
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_rng = np.random.default_rng(99)
_LETTER = _rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}
STEP = 1 << 21  # bytes hashed at a time


def _power(of: np.uint64, n: int, name: str) -> np.ndarray:
    held = _powers.get(name)
    if held is None or len(held) < n:
        out = np.full(max(n, STEP + 4096), of, np.uint64)
        out[0] = 1
        held = _powers[name] = np.multiply.accumulate(out)
    return held[:n]


class Prefix:
    """Hashes of any slices of a text of bytes."""

    def __init__(self, data: np.ndarray, letter: np.ndarray = _LETTER) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(letter[data] * _power(_BASE, len(data), "up"), out=self.sums[1:])
        self.down = _power(_INVERSE, len(data) + 1, "down")

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mix((self.sums[stops] - self.sums[starts]) * self.down[starts])


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of each run of `width` keys, from minima of blocks before and after their seams."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    after = np.minimum.accumulate(blocks, axis=1).ravel()
    before = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(before[:n - width + 1], after[width - 1:n])


def anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, anchor hashes and context hashes. Works through a long text step by step."""
    reach, n = length - K, len(text)
    if n < length:
        return (np.zeros(0, np.int64),) + (np.zeros(0, np.uint64),) * 2
    data = np.frombuffer(text, np.uint8)
    at, key, ctx = [], [], []
    for a in range(0, n - length + 1, STEP):  # windows that start in [a, a + STEP)
        lo, hi = max(0, a - length), min(n, a + STEP + 2 * length)
        held = Prefix(data[lo:hi])
        first, last = a - lo, min(a + STEP, n - length + 1) - lo
        grams = np.arange(first, last + reach)
        hashes = held.of(grams, grams + K)
        low = np.uint64((1 << 22) - 1)  # positions in a step: ties go to the left
        best = _least((hashes & ~low) | (grams - first).astype(np.uint64), reach + 1)
        pos = np.unique(best & low).astype(np.int64) + first
        key.append(hashes[pos - first])
        left, right = np.maximum(pos - reach, -lo), np.minimum(pos + length, n - lo)
        ctx.append(mix(held.of(left, right) ^ (pos - left).astype(np.uint64)
                       ^ ((right - pos).astype(np.uint64) << np.uint64(32))))
        at.append(pos + lo)
    at, key, ctx = map(np.concatenate, (at, key, ctx))
    at, once = np.unique(at, return_index=True)
    return at, key[once], ctx[once]


def occurrences(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, doc (hash of id and text), places, anchor, context: a row for each kind of anchor and
    context in a document, however often a line that is repeated there makes it occur."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found = [anchors(t, length) for t in texts(batch)]
            n = [len(f[0]) for f in found]
            if not sum(n):
                continue
            rows = np.repeat(np.arange(len(n)), n)
            at, key, ctx = (np.concatenate([f[i] for f in found]) for i in range(3))
            order = np.lexsort((at, ctx, key, rows))
            rows, at, key, ctx = rows[order], at[order], key[order], ctx[order]
            new = np.ones(len(at), bool)
            new[1:] = (rows[1:] != rows[:-1]) | (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1])
            first = np.flatnonzero(new)
            places = pa.ListArray.from_arrays(
                pa.array(np.append(first, len(at)).astype(np.int32)), pa.array(at.astype(np.int32)))
            rows = pa.array(rows[first])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("doc").take(rows), places,
                 pa.array(signed(key[first])), pa.array(signed(ctx[first]))],
                ["doc_id", "doc", "places", "anchor", "context"])

    return _keyed(docs).mapInArrow(
        run, "doc_id long, doc long, places array<int>, anchor long, context long")


def _keyed(docs: DataFrame) -> DataFrame:
    return two(docs).withColumn("doc", F.xxhash64("doc_id", "text"))


def _packed(docs: DataFrame) -> DataFrame:
    """With the text compressed, for a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in portions(batches):
            yield batch.set_column(1, "text", pa.array(
                [pack.compress(t) for t in texts(batch)], pa.binary()))

    held = _keyed(docs)
    return held.mapInArrow(run, held.schema)


def _unpacked(batch: pa.RecordBatch) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(t) for t in texts(batch)]


def contexts(docs: DataFrame, mixed: DataFrame, length: int) -> DataFrame:
    """Bytes of mixed contexts: anchor, context, before (bytes before the anchor), data."""
    by_doc = mixed.groupBy("doc_id", "doc").agg(
        F.collect_list(F.struct("pos", "anchor", "context")).alias("hits"))
    held = _packed(docs).alias("d").join(by_doc.alias("m"), F.expr(
        "d.doc_id <=> m.doc_id AND d.doc = m.doc")).select("text", "hits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            hits = batch.column("hits")
            n = np.asarray(hits.value_lengths())
            flat = hits.flatten()
            pos = np.asarray(flat.field("pos")).tolist()
            held = _unpacked(batch)
            rows = np.repeat(np.arange(len(n)), n).tolist()
            lo = [max(0, p - length + K) for p in pos]
            yield pa.RecordBatch.from_arrays(
                [flat.field("anchor"), flat.field("context"),
                 pa.array([p - a for p, a in zip(pos, lo)], pa.int32()),
                 pa.array([held[r][a:p + length] for r, a, p in zip(rows, lo, pos)], pa.binary())],
                ["anchor", "context", "before", "data"])

    return held.mapInArrow(run, "anchor long, context long, before int, data binary")


class RunLengthIndex:
    """Burrows-Wheeler transform of texts that are aligned at their anchors, in runs.

    Suffixes matter only against those that begin at the same place of another context of the same
    anchor, so the transform is kept column by column, from the right: `order` has the contexts
    sorted by anchor and then by what stands from the column on, and the column to the left of it,
    read in that order, falls into runs of equal symbols. Inside a run, neighbours stay neighbours
    and their match grows by one. Only at the ends of runs new neighbours meet, and their match is
    sampled from the texts.
    """

    def __init__(self, anchor: np.ndarray, columns: np.ndarray) -> None:
        """`columns`: a row of symbols per column of the texts, a context per place in it."""
        self.columns = columns
        self.rows = np.ascontiguousarray(columns.T)
        self.order = np.argsort(anchor, kind="stable")
        self.group = anchor[self.order].astype(np.uint16 if anchor.max() < 1 << 16 else np.int64)
        self.match = np.zeros(len(anchor), np.int32)  # with the context before in order
        self.at = len(columns)
        self.runs = 0

    def step(self) -> None:
        """Move one column to the left."""
        self.at -= 1
        symbol = self.columns[self.at][self.order]
        by = np.argsort(symbol, kind="stable")
        by = by[np.argsort(self.group[by], kind="stable")]
        symbol, order = symbol[by], self.order[by]
        match = np.zeros(len(by), np.int32)
        same = (symbol[1:] == symbol[:-1]) & (self.group[1:] == self.group[:-1])
        inside = same & (by[1:] == by[:-1] + 1)
        match[1:][inside] = self.match[by[1:][inside]] + 1
        ends = np.flatnonzero(same & ~inside) + 1
        match[ends] = self._sample(order[ends - 1], order[ends])
        self.runs += len(by) - int(inside.sum())
        self.order, self.match = order, match

    def _sample(self, a: np.ndarray, b: np.ndarray, part: int = 16) -> np.ndarray:
        """How far contexts a and b agree from the column on."""
        out, live, at = np.zeros(len(a), np.int32), np.arange(len(a)), self.at
        while len(live) and at < len(self.columns):
            x, y = self.rows[a[live], at:at + part], self.rows[b[live], at:at + part]
            same = x == y
            step = np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))
            out[live] += step.astype(np.int32)
            live, at = live[step == part], at + part
        return out

    def statistics(self) -> np.ndarray:
        """For each context, its longest match with another of its anchor from the column on."""
        best = np.maximum(self.match, np.append(self.match[1:], 0))
        out = np.empty(len(best), np.int32)
        out[self.order] = best
        return out


def marked(anchor: np.ndarray, before: np.ndarray, data: list[bytes], length: int
           ) -> tuple[np.ndarray, np.ndarray]:
    """Context number and place before the anchor of each window that is met in another context."""
    reach = length - K
    n = np.fromiter(map(len, data), np.int64, len(data))
    texts = np.full((len(data), length + reach), 256, np.uint16)  # 256: outside the document
    row = np.repeat(np.arange(len(n)), n)
    within = ranges(reach - before, n)
    texts[row, within] = np.frombuffer(b"".join(data), np.uint8)
    index = RunLengthIndex(np.unique(anchor, return_inverse=True)[1],
                           np.ascontiguousarray(texts.T))
    rows, places = [], []
    while index.at:
        index.step()
        place = index.at - reach  # windows begin at the anchor or before it
        if place <= 0:
            good = (index.statistics() >= length) & (place >= -before) & (
                place + length <= n - before)
            hit = np.flatnonzero(good)
            rows.append(hit)
            places.append(np.full(len(hit), place))
    row, place = np.concatenate(rows), np.concatenate(places)
    by = np.lexsort((place, row))
    return row[by], place[by]


def _runs(row: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Windows to ranges [lo, hi): neighbouring starts in one row become one range."""
    if not len(row):
        return row, place, place
    cut = np.flatnonzero((np.diff(row) != 0) | (np.diff(place) != 1)) + 1
    a, b = np.concatenate([[0], cut]), np.concatenate([cut, [len(row)]]) - 1
    return row[a], place[a], place[b] + length


def indexed(held: DataFrame, length: int, blocks: int) -> DataFrame:
    """anchor, context, lo, hi (against the anchor) of windows met in other contexts of the anchor."""
    def run(group: pa.Table) -> pa.Table:
        anchor = group.column("anchor").to_numpy()
        row, place = marked(anchor, group.column("before").to_numpy().astype(np.int64),
                            group.column("data").to_pylist(), length)
        row, lo, hi = _runs(row, place, length)
        return pa.table({"anchor": anchor[row], "context": group.column("context").to_numpy()[row],
                         "lo": lo.astype(np.int32), "hi": hi.astype(np.int32)})

    return (held.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)))
            .groupBy("block").applyInArrow(run, "anchor long, context long, lo int, hi int"))


def counted(held: DataFrame, length: int) -> DataFrame:
    """The same by counting windows one by one, for anchors with very many contexts."""
    letter = _rng.permutation(_LETTER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            anchor, context = (batch.column(c).to_numpy() for c in ("anchor", "context"))
            for i, (before, data) in enumerate(zip(batch.column("before").to_pylist(),
                                                   batch.column("data").to_pylist())):
                bytes_ = np.frombuffer(data, np.uint8)
                at = np.arange(min(before, len(data) - length) + 1)
                a, b = (Prefix(bytes_, x).of(at, at + length) for x in (_LETTER, letter))
                yield pa.RecordBatch.from_pydict({
                    "anchor": np.full(len(at), anchor[i]), "context": np.full(len(at), context[i]),
                    "lo": (at - before).astype(np.int32), "a": signed(a), "b": signed(b)})

    windows = held.mapInArrow(run, "anchor long, context long, lo int, a long, b long")
    many = (windows.groupBy("anchor", "lo", "a", "b").agg(F.count("*").alias("n"))
            .filter("n > 1").drop("n"))
    return windows.join(many, ["anchor", "lo", "a", "b"], "left_semi").select(
        "anchor", "context", "lo", (F.col("lo") + length).alias("hi"))


def repeated(docs: DataFrame, length: int = 400, most_contexts: int = 5000,
             contexts_per_index: int = 2000) -> DataFrame:
    """doc_id, doc, spans (lo, hi in bytes, clipped by the text): what is to go from each document.

    Documents without repeats have no row.
    """
    found = occurrences(docs, length)  # worked out twice, which takes less than keeping it
    many = materialize(
        found.groupBy("anchor").agg(F.sum(F.size("places")).alias("n"), F.min("context").alias("least"),
                                    F.max("context").alias("greatest"))
        .filter("n > 1").select("anchor", (F.col("least") != F.col("greatest")).alias("mixed")),
        "repeated")
    hits = materialize(found.join(many, "anchor"), "hits")
    mixed = hits.filter("mixed").select("doc_id", "doc", "places", "anchor", "context")
    kinds = materialize(mixed.groupBy("anchor", "context").agg(
        F.sum(F.size("places")).alias("n"),
        F.min(F.struct("doc_id", "doc", F.col("places")[0].alias("pos"))).alias("one")), "kinds")
    per_anchor = kinds.groupBy("anchor").agg(F.count("*").alias("contexts"))
    wide = per_anchor.filter(F.col("contexts") > most_contexts).select("anchor")
    # one place for each distinct context; a context met twice needs no index, but others match it
    held = materialize(contexts(
        docs, kinds.select("one.doc_id", "one.doc", "one.pos", "anchor", "context"), length)
        .dropDuplicates(["anchor", "context"]), "contexts")
    blocks = max(1, held.count() // contexts_per_index)
    matched = indexed(held.join(wide, "anchor", "left_anti"), length, blocks)
    if not wide.isEmpty():
        matched = matched.unionAll(counted(held.join(wide, "anchor"), length))
    matched = matched.groupBy("anchor", "context").agg(
        F.collect_list(F.struct("lo", "hi")).alias("parts"))

    whole = F.array(F.struct(F.lit(K - length).alias("lo"), F.lit(length).alias("hi")))
    simple = hits.filter("NOT mixed").select("doc_id", "doc", "places", whole.alias("parts"))
    # a context met once is where `one` says; one met more often repeats as a whole, at each place
    once = kinds.filter("n = 1").join(matched, ["anchor", "context"]).select(
        "one.doc_id", "one.doc", F.array("one.pos").alias("places"), "parts")
    often = mixed.join(kinds.filter("n > 1"), ["anchor", "context"], "left_semi").select(
        "doc_id", "doc", "places", whole.alias("parts"))
    placed = simple.unionAll(once).unionAll(often).select(
        "doc_id", "doc", F.flatten(F.transform("places", lambda at: F.transform(
            "parts", lambda p: F.struct(F.greatest(p["lo"] + at, F.lit(0)).alias("lo"),
                                        (p["hi"] + at).alias("hi"))))).alias("parts"))
    return placed.groupBy("doc_id", "doc").agg(F.flatten(F.collect_list("parts")).alias("spans"))


def _gone(n: int, spans: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed runs, as starts and stops."""
    if spans is None or not len(spans):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lo, hi = spans[:, 0], np.minimum(spans[:, 1], n)
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    cut = np.flatnonzero(lo[1:] > hi[:-1]) + 1
    return lo[np.concatenate([[0], cut])], hi[np.concatenate([cut, [len(lo)]]) - 1]


def _kept(text: bytes, starts: np.ndarray, stops: np.ndarray) -> bytes:
    at = [0, *stops.tolist()]
    return b"".join(text[a:b] for a, b in zip(at, [*starts.tolist(), len(text)]))


def cut(docs: DataFrame, length: int = 400, **sizes: int) -> DataFrame:
    """doc_id, kept (bytes), n_bytes, n_removed, n_spans; a row for each row of `docs`."""
    spans = repeated(docs, length, **sizes)
    held = _packed(docs).alias("d").join(spans.alias("s"), F.expr(
        "d.doc_id <=> s.doc_id AND d.doc = s.doc"), "left").select("d.doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            kept, n, removed, runs = [], [], [], []
            spans = batch.column("spans")
            for i, text in enumerate(_unpacked(batch)):
                own = spans[i].values
                pairs = None if own is None else np.stack(
                    [np.asarray(own.field(c)).astype(np.int64) for c in ("lo", "hi")], axis=1)
                a, b = _gone(len(text), pairs)
                kept.append(_kept(text, a, b) if len(a) else text)
                n.append(len(text))
                removed.append(int((b - a).sum()))
                runs.append(len(a))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(kept, pa.binary()), pa.array(n, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(runs, pa.int64())],
                ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return held.mapInArrow(
        run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def digest(docs: DataFrame, length: int = 400, **sizes: int) -> DataFrame:
    """`cut`, with the kept bytes replaced by their SHA-256."""
    return cut(docs, length, **sizes).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """The rows of `docs`, all columns, with repeats cut out of `text`.

    Where a cut leaves part of a character, that part goes too. A null text stays null.
    """
    spans = repeated(docs, length)
    # the row is one column until the end, so that no name of its own can clash
    key = F.xxhash64(F.col("row.doc_id").cast("long"),
                     F.coalesce(F.col("row.text"), F.lit("")).cast("binary"))
    held = docs.select(F.struct("*").alias("row")).select("row", key.alias("key")).join(
        spans, F.expr("CAST(row.doc_id AS LONG) <=> doc_id AND key = doc"), "left")

    @F.arrow_udf("string")
    def left(text: pa.Array, spans: pa.Array) -> pa.Array:
        forget()
        out = []
        for i, raw in enumerate(text.cast(pa.large_binary())):
            own = spans[i].values
            raw = raw.as_py()
            if raw is not None and own is not None:
                a, b = _gone(len(raw), np.stack(
                    [np.asarray(own.field(c)).astype(np.int64) for c in ("lo", "hi")], axis=1))
                raw = _kept(raw, a, b).decode("utf-8", "ignore").encode()
            out.append(raw)
        return pa.array(out, pa.binary()).cast(pa.string())

    text, some = F.col("row.text"), F.col("spans").isNotNull()   # no other text goes to Python
    kept = F.when(some, left(F.when(some, text), "spans")).otherwise(text)
    return held.select(*((kept if c == "text" else F.col(f"row.`{c}`")).alias(c)
                         for c in docs.columns))
