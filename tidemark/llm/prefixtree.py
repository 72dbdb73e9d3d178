"""Prefix tree of conversations that share their first turns, with subtree totals.

Conversations are rebuilt first: `c` starts with up to h turns of conversation c - c % 100 and goes
on with its own turns after its first h, where h is the crc32 of its number modulo 6. A node is a
sequence of turns that some rebuilt conversations start with; its key is 128 bits made of sums of
powers of the digests of its turns, so that the keys of all prefixes come from running sums.

No conversation has to fit a task. Turns are sorted over the whole table by (conversation, turn,
role, text); a task numbers and sums the turns it holds, and what a conversation has in earlier
tasks is added afterwards: that is known for each conversation that crosses a border, two for each
task at most.

Subtree totals go bottom-up by time-forward processing: nodes sorted by falling depth, each sends
its totals to its parent through a queue sorted by the parent's place, and takes what its children
have sent from there. The queue holds two levels and spills sorted runs. Shards are sets of whole
subtrees: a node is light if the turns below it, counted per conversation, are at most `light`, and
the topmost light nodes are the roots of subtrees that are dealt to shards. The nodes above, which
are few, follow with the totals of these roots, in bands of `light` levels, of which only
conversations of more than that many turns make more than one.

Rows with a null conv_id belong to no conversation. Null turns come first; equal turns are ordered
by role and text; repeated rows are turns of their own. Null role and text are empty. An empty table
makes no node, not even a root. Other columns are not looked at; texts of any length become digests
where they are read. Queue files are unnamed, the task's own, and vanish with it.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import mix, signed
from tidemark.session import materialize

_P, _BACK = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
HEAD = 5          # most turns that are taken from another conversation
LEAST_LIGHT = 1 << 12


def power(exponent: np.ndarray) -> np.ndarray:
    """Powers of the base modulo 2^64; exponents may be negative."""
    out, e = np.ones(len(exponent), np.uint64), np.abs(exponent)
    base = np.where(exponent < 0, _BACK, _P)
    while e.any():
        out = np.where(e & 1, out * base, out)
        base, e = base * base, e >> 1
    return out


def unsigned(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy().view(np.uint64) for n in names]


# ── turns: number and running sums ───────────────────────────────────────────

def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of a turn among those of its conversation in this task, and sums up to it."""
    part = TaskContext.get().partitionId()
    conv, n, sums = None, 0, (np.uint64(0), np.uint64(0))
    for batch in batches:
        ids = batch.column("conv_id").to_numpy()
        if not len(ids):
            continue
        new = np.ones(len(ids), bool)
        new[1:] = ids[1:] != ids[:-1]
        goes_on = ids[0] == conv
        start = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        at = np.arange(len(ids)) - start[run]
        if goes_on:
            at[run == 0] += n
        terms, totals = [], []
        for digest, carried in zip(unsigned(batch, "t1", "t2"), sums):
            term = digest * power(at)
            total = np.cumsum(term, dtype=np.uint64)
            before = total[start] - term[start]
            total = total - before[run]
            if goes_on:
                total[run == 0] += carried
            terms.append(signed(term))
            totals.append(signed(total))
        conv, n = ids[-1], int(at[-1]) + 1
        sums = tuple(t[-1:].view(np.uint64)[0] for t in totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(ids), part)), batch.column("conv_id"), pa.array(at),
             *map(pa.array, totals), *map(pa.array, terms), batch.column("size")],
            ["part", "conv_id", "i", "s1", "s2", "w1", "w2", "size"])


_TURN = "conv_id long, i long, s1 long, s2 long, w1 long, w2 long, size long"


def summed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, i (from 0), s1 and s2 (sums up to the turn), w1 and w2 (its own part), size."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = (conversations.filter("conv_id IS NOT NULL")
             .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
                     role.alias("role"), text.alias("text")))
    # equal rows are interchangeable; the last key only lets a range border fall between them
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "text",
             F.monotonically_increasing_id()]
    digests = (turns.repartitionByRange(*order).sortWithinPartitions(*order[:-1]).select(
        "conv_id", F.xxhash64("role", "text").alias("t1"),
        F.xxhash64(F.lit(7), "role", "text").alias("t2"),
        F.length("text").cast("long").alias("size")))
    stored = materialize(digests.mapInArrow(_summed, f"part long, {_TURN}"), "turns")

    pieces = (stored.groupBy("conv_id", "part")
              .agg(F.max("i").alias("last"), F.max_by("s1", "i").alias("s1"),
                   F.max_by("s2", "i").alias("s2"))
              .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
                  "part", "last", "s1", "s2"))).alias("pieces")).filter("size(pieces) > 1"))
    before = {}   # for each border between tasks at most one conversation
    for row in pieces.collect():
        n, a, b = 0, 0, 0
        for piece in row.pieces:
            before[row.conv_id, piece.part] = (n, a, b)
            factor = pow(int(_P), n, 1 << 64)
            a, b = a + piece.s1 * factor, b + piece.s2 * factor
            n += piece.last + 1

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows = np.array([x % (1 << 64) for key in before for x in before[key][1:]],
                        np.uint64).reshape(-1, 2)
        counts = np.array([v[0] for v in before.values()], np.int64)
        place = {key: k for k, key in enumerate(before)}
        crossing = np.array(sorted({c for c, _ in before}), np.int64)
        for batch in batches:
            conv, part = (batch.column(c).to_numpy() for c in ("conv_id", "part"))
            i = batch.column("i").to_numpy().copy()
            s1, s2, w1, w2 = (x.copy() for x in unsigned(batch, "s1", "s2", "w1", "w2"))
            at = np.flatnonzero(np.isin(conv, crossing))
            if len(at):
                k = np.array([place[key] for key in zip(conv[at].tolist(), part[at].tolist())])
                factor = power(counts[k])
                for j, (s, w) in enumerate(((s1, w1), (s2, w2))):
                    w[at] *= factor
                    s[at] = s[at] * factor + lows[k, j]
                i[at] += counts[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(i), *(pa.array(signed(x)) for x in (s1, s2, w1, w2)),
                 batch.column("size")], ["conv_id", "i", "s1", "s2", "w1", "w2", "size"])

    return stored.mapInArrow(carried, _TURN)


# ── rebuilt conversations and their paths ────────────────────────────────────

def kept_turns(conv_id: Column) -> Column:
    """Turns that a conversation takes from another one, if that has as many."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % (HEAD + 1)).cast("int")


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, depth, key, parent, size (of the last turn), length (of the conversation): a row
    for each prefix of each rebuilt conversation."""
    first = F.when(F.col("i") < HEAD, F.struct("i", "s1", "s2", "w1", "w2", "size"))
    own = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(first)).alias("heads"))
    bases = own.select(F.col("conv_id").alias("base"), F.col("heads").alias("given"))
    h = kept_turns(F.col("conv_id"))
    zero = F.lit(0).cast("long")

    def upto(heads: str, n: str, field: str) -> Column:
        return F.when(F.col(n) > 0, F.expr(f"{heads}[{n} - 1].{field}")).otherwise(zero)

    known = (own.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % 100})
             .join(bases, "base", "left")
             .withColumn("m", F.least("h", F.coalesce(F.size("given"), F.lit(0))))
             .withColumn("skipped", F.least(F.col("h"), F.col("n").cast("int")))
             .select("conv_id", "h", "m", F.slice("given", 1, F.col("m")).alias("given"),
                     (F.col("m") + F.col("n") - F.col("skipped")).alias("length"),
                     *(upto("heads", "skipped", f"s{k}").alias(f"a{k}") for k in (1, 2)),
                     *(upto("given", "m", f"s{k}").alias(f"b{k}") for k in (1, 2))))
    known = materialize(known, "rebuilt")

    plain = [zero.alias("e"), *(zero.alias(n) for n in ("a1", "a2", "b1", "b2"))]
    roots = known.select("conv_id", "length", zero.alias("depth"), *(
        zero.alias(n) for n in ("s1", "s2", "w1", "w2", "size")), *plain)
    taken = known.select("conv_id", "length", F.inline("given")).select(
        "conv_id", "length", (F.col("i") + 1).alias("depth"), "s1", "s2", "w1", "w2", "size", *plain)
    kept = turns.join(known.drop("given"), "conv_id").filter("i >= h").select(
        "conv_id", "length", (F.col("m") + F.col("i") - F.col("h") + 1).alias("depth"),
        "s1", "s2", "w1", "w2", "size", (F.col("m") - F.col("h")).cast("long").alias("e"),
        "a1", "a2", "b1", "b2")

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth = batch.column("depth").to_numpy()
            factor = power(batch.column("e").to_numpy())
            sums, before = [], []
            for k in "12":
                s, w, a, b = unsigned(batch, f"s{k}", f"w{k}", f"a{k}", f"b{k}")
                sums.append(b + (s - a) * factor)
                before.append(sums[-1] - w * factor)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("depth"), _keys(*sums, depth),
                 _keys(*before, depth - 1, depth == 0), batch.column("size"),
                 batch.column("length")],
                ["conv_id", "depth", "key", "parent", "size", "length"])

    return roots.unionAll(taken).unionAll(kept).mapInArrow(
        named, "conv_id long, depth long, key binary, parent binary, size long, length long")


def _keys(a: np.ndarray, b: np.ndarray, depth: np.ndarray, none=None) -> pa.Array:
    d = depth.astype(np.uint64)
    key = np.stack([mix(a + d), mix(b ^ mix(d))], 1).astype(">u8")
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(16), len(d), [None if none is None else pa.py_buffer(
            np.packbits(~none, bitorder="little")), pa.py_buffer(key.tobytes())]).cast(pa.binary())


# ── time-forward processing ──────────────────────────────────────────────────

class SpillingQueue:
    """Messages (key, three numbers) in sorted runs, taken in the order of their keys."""

    def __init__(self, most: int = 1 << 18) -> None:
        self.most, self.fresh, self.held, self.runs = most, [], 0, []

    def push(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.fresh.append((keys, values))
        self.held += len(keys)
        if self.held > self.most:
            self._close(spill=True)

    def _close(self, spill: bool) -> None:
        if not self.held:
            return
        keys, values = (np.concatenate(x) for x in zip(*self.fresh))
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        if spill:
            stored = []
            for x in (keys, values):
                with tempfile.TemporaryFile() as file:
                    file.write(x.tobytes())
                    file.flush()
                    stored.append(np.memmap(file, x.dtype, "r", shape=x.shape))
            keys, values = stored
        self.runs.append([keys, values, 0])
        self.fresh, self.held = [], 0

    def upto(self, last: bytes) -> tuple[np.ndarray, np.ndarray]:
        """All messages for keys up to `last` that have not been taken."""
        self._close(spill=False)
        taken = [(np.zeros(0, "S16"), np.zeros((0, 3), np.int64))]
        for run in self.runs:
            keys, values, at = run
            run[2] = at + int(np.searchsorted(keys[at:], np.bytes_(last), "right"))
            taken.append((np.asarray(keys[at:run[2]]), np.asarray(values[at:run[2]])))
        self.runs = [r for r in self.runs if r[2] < len(r[0])]
        return tuple(np.concatenate(x) for x in zip(*taken))


def _key_array(column: pa.Array) -> np.ndarray:
    return np.array(column.fill_null(b"").to_pylist(), "S16")


def settle(batches: Iterator[pa.RecordBatch], most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Totals of nodes that come shard by shard, deepest first, by key within a level.

    `own` is what a node adds to the totals above it; children, leaves and saved hold what it has
    already got from outside its shard.
    """
    shard = level = None
    now, coming = SpillingQueue(most), SpillingQueue(most)
    for batch in batches:
        shards, depths = (batch.column(c).to_numpy() for c in ("shard", "depth"))
        keys, parents = _key_array(batch.column("key")), _key_array(batch.column("parent"))
        got = np.stack([batch.column(c).to_numpy() for c in ("children", "leaves", "saved")], 1)
        own = batch.column("own").to_numpy()
        out = np.empty_like(got)
        new = (np.diff(shards, prepend=shards[:1]) != 0) | (np.diff(depths, prepend=depths[:1]) != 0)
        edges = [0, *np.flatnonzero(new).tolist(), len(keys)] if len(keys) else [0]
        for a, b in zip(edges[:-1], edges[1:]):
            if (shards[a], depths[a]) != (shard, level):
                fits = shards[a] == shard and depths[a] == level - 1
                now, coming = coming if fits else SpillingQueue(most), SpillingQueue(most)
                shard, level = shards[a], depths[a]
            to, message = now.upto(keys[b - 1])
            total = got[a:b].copy()
            at = np.minimum(np.searchsorted(keys[a:b], to), b - a - 1)
            hit = keys[a:b][at] == to   # others are for parents in another shard
            np.add.at(total, at[hit], message[hit])
            total[:, 1][total[:, 0] == 0] = 1
            total[:, 2] += own[a:b]
            out[a:b] = total
            to, at = np.unique(parents[a:b], return_inverse=True)
            sent = np.zeros((len(to), 3), np.int64)
            np.add.at(sent, at, np.column_stack([np.ones(b - a, np.int64), total[:, 1:]]))
            coming.push(to, sent)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("parent"), batch.column("top"),
             *(pa.array(out[:, k]) for k in range(3))],
            ["key", "parent", "top", "children", "leaves", "saved"])


def _settled(nodes: DataFrame) -> DataFrame:
    """`nodes` (shard, depth, key, parent, top, own and what came from outside) with totals."""
    sorted_ = (nodes.select("shard", "depth", "key", "parent", "top", "own", "children", "leaves",
                            "saved")
               .repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "key"))
    return materialize(sorted_.mapInArrow(
        settle, "key binary, parent binary, top boolean, children long, leaves long, saved long"),
        "settled")


def _sent(settled: DataFrame) -> DataFrame:
    """What the topmost nodes send to the parents above their shards."""
    return (settled.filter("top AND parent IS NOT NULL").groupBy(F.col("parent").alias("key"))
            .agg(F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"),
                 F.sum("saved").alias("saved")))


def subtree_totals(nodes: DataFrame, ways: DataFrame, light: int | None = None) -> DataFrame:
    """key, children, leaves, saved of each node; `ways` are the paths, both are read repeatedly."""
    size = nodes.agg(F.max("weight")).first()[0] or 0
    light = light or max(LEAST_LIGHT, isqrt(size))
    heavy = nodes.filter(F.col("weight") > light)
    none = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]

    # the heavy part of a path is its beginning; the first node after it is the root of a subtree
    reach = (ways.join(heavy.select("key"), "key", "left_semi").groupBy("conv_id")
             .agg(F.max("depth").alias("reach")))
    tops = (ways.select("conv_id", "depth", F.col("key").alias("root"))
            .join(reach, "conv_id", "left").filter("depth = coalesce(reach, -1) + 1")
            .select("conv_id", "root"))
    shards = max(1, size // (4 * light))
    small = (nodes.filter(F.col("weight") <= light).join(tops, "conv_id")
             .select("*", F.pmod(F.xxhash64("root"), F.lit(shards)).alias("shard"),
                     (F.col("key") == F.col("root")).alias("top"), *none))
    done = [_settled(small)]

    deepest = heavy.agg(F.max("depth")).first()[0]
    inbox = _sent(done[0])
    for band in range(-1 if deepest is None else deepest // light, -1, -1):
        low = band * light
        starts = ways.filter(F.col("depth") == low).select("conv_id", F.col("key").alias("start"))
        level = (heavy.filter((F.col("depth") >= low) & (F.col("depth") < low + light))
                 .join(starts, "conv_id").join(inbox, "key", "left")
                 .select("depth", "key", "parent", "own", F.xxhash64("start").alias("shard"),
                         (F.col("key") == F.col("start")).alias("top"),
                         *(F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
                           for c in ("children", "leaves", "saved"))))
        done.append(_settled(level))
        above = _sent(done[-1])
        inbox = (inbox.unionAll(above).groupBy("key").agg(
            *(F.sum(c).alias(c) for c in ("children", "leaves", "saved"))))
    out = done[0]
    for part in done[1:]:
        out = out.unionAll(part)
    return out.drop("parent", "top")


# ── conversations that end at a node ─────────────────────────────────────────

def ends(ways: DataFrame) -> DataFrame:
    """key, ends_sha256: digest of the numbers of the conversations that end there.

    Numbers are sorted and joined all over the table; only the joined pieces of a node, one for
    each batch that has some, come together, to be read one after the other.
    """
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = _key_array(batch.column("key"))
            ids = batch.column("conv_id").to_pylist()
            at = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(ids)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(at[:-1])), pa.array([ids[a] for a in at[:-1]]),
                 pa.array([",".join(map(str, ids[a:b])) for a, b in zip(at, at[1:])])],
                ["key", "first", "ids"])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            out = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k == key:
                    digest.update(b"," + ids.encode())
                    continue
                if digest:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(ids.encode())
            yield _digests(out)
        if digest:
            yield _digests([(key, digest.hexdigest())])

    pieces = (ways.filter("depth = length").select("key", "conv_id")
              .repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
              .mapInArrow(joined, "key binary, first long, ids string"))
    return (pieces.repartition("key").sortWithinPartitions("key", "first")
            .mapInArrow(digested, "key binary, ends_sha256 string"))


def _digests(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())],
        ["key", "ends_sha256"])


NO_ENDS = hashlib.sha256().hexdigest()


def tree(conversations: DataFrame, light: int | None = None) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: a
    row for each node. `light` is the size of subtrees; by default it follows that of the table."""
    ways = materialize(paths(summed_turns(conversations)), "paths")
    nodes = materialize(ways.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.max("depth").alias("depth"), F.max("parent").alias("parent"),
        ((F.count(F.lit(1)) - 1) * F.max("size")).alias("own"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight")), "nodes")
    totals = subtree_totals(nodes, ways, light)
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(totals, "key").join(ends(ways), "key", "left").join(parents, "parent", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs",
                    F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                    F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")))
