"""Nearest neighbours by inner product, from a forest of hash prefixes.

Each tree gives every vector a long string of bits, the sides of random hyperplanes it lies on, and
keeps all strings in one sorted array. A query's longest-prefix matches are its neighbours in the
array; going up a level, to prefixes shorter by one bit, widens the run around it. All trees go up
together, one level at a time, until they have `budget` candidates between them, which are then
scored exactly. Vectors get one more component, which makes all norms equal and the order of
angles to a query that of inner products.

A sorted array is cut into segments of equal numbers of rows, with an overlap of `reach` rows, as
far as a query may look on either side; many equal strings spread over segments like any others.
`reach` is fitted: true neighbours of a bounded sample of queries are found by brute force, and the
reach is what would have found 97 of 100 of them, and twice that. Nothing else depends on the
sample, and every row is indexed.

Vectors that are null, zero, of another length than the most common one (the shortest of these),
or hold null or non-finite components take no part, nor do null ids. A row is a candidate for every
query with another id. Equal ids count once, with the vector that scores highest. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import materialize

BITS = 60
FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, queries: str) -> DataFrame:
    """id, v (doubles), q: whether the row is a query."""
    v = vectors.filter("vec_id IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"),
        F.expr(queries).alias("q"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.filter(F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0))
    sizes = v.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), "d").limit(1).collect()
    return v.filter(F.size("v") == (first[0]["d"] if first else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def planes(dim: int, trees: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim + 1, trees * BITS))


def strings(v: np.ndarray, more: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Bit strings as integers, a column per tree. `more`: the component that evens the norms."""
    bits = (np.column_stack([v, more]) @ sides > 0).reshape(len(v), sides.shape[1] // BITS, BITS)
    weight = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    return bits @ weight


def _depth(a: np.ndarray, b: int) -> np.ndarray:
    """Length of the common prefixes of the strings a with the string b."""
    differ = (a ^ b).astype(np.uint64)
    high, low = (differ >> np.uint64(30)).astype(float), (differ & np.uint64(2**30 - 1)).astype(float)
    bits = np.where(high > 0, np.frexp(high)[1] + 30, np.frexp(low)[1])
    return BITS - bits


def ranked(rows: DataFrame, trees: int, seed: int) -> DataFrame:
    """tree, code, id, q, rank: how many rows that are not queries' stand before in the tree.

    A query's own string, for which the extra component is zero, is a row of its own (q true).
    """
    dim = rows.select(F.size("v")).first()
    sides = planes(dim[0] if dim else 0, trees, seed)
    norm = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0] or 0.0

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v, ids = matrix(batch.column("v")), batch.column("id").to_numpy()
            asked = np.asarray(batch.column("q").to_pylist(), bool)
            more = np.sqrt(np.maximum(0, norm - (v * v).sum(axis=1)))
            for q, keep, extra in ((False, slice(None), more), (True, asked, 0 * more)):
                code = strings(v[keep], extra[keep], sides)
                own = ids[keep]
                yield pa.RecordBatch.from_pydict({
                    "tree": np.tile(np.arange(trees, dtype=np.int32), len(own)),
                    "code": code.ravel(), "id": np.repeat(own, trees),
                    "q": np.full(len(own) * trees, q)})

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, seen = TaskContext.get().partitionId(), -1, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("tree").to_numpy()
            data = ~np.asarray(batch.column("q").to_pylist(), bool)
            before = np.cumsum(data) - data
            start = np.concatenate([[True], own[1:] != own[:-1]])
            base = np.maximum.accumulate(np.where(start, before, 0))
            carry = np.where(own == tree, seen, 0)
            at = before - base + carry
            tree, seen = int(own[-1]), int(at[-1] + data[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(own), part, np.int32)), pa.array(at)],
                [*batch.schema.names, "part", "at"])

    order = ("tree", "code", "q", "id")
    rows = rows.mapInArrow(split, "tree int, code long, id long, q boolean")
    sorted_ = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        number, "tree int, code long, id long, q boolean, part int, at long"), "forest")
    # a row for each task and each tree
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sorted_.filter("NOT q").groupBy("tree", "part").agg(F.count("*").alias("n")))
    edges = sorted_.select("tree", "part").distinct().join(offsets, ["tree", "part"], "left")
    edges = edges.select("tree", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("o"))
    return sorted_.join(edges, ["tree", "part"]).select(
        "tree", "code", "id", "q", (F.col("at") + F.col("o")).alias("rank"))


def brute(rows: DataFrame, asked: list, k: int) -> DataFrame:
    """The k nearest of each of a few queries (id, v), against all rows."""
    ids = np.array([r["id"] for r in asked], np.int64)
    q = np.array([r["v"] for r in asked], float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            s, own = matrix(batch.column("v")) @ q.T, batch.column("id").to_numpy()
            for i, one in enumerate(ids):
                other = np.flatnonzero(own != one)
                best = other[np.argsort(-s[other, i], kind="stable")[:k]]
                yield pa.RecordBatch.from_pydict({
                    "query_id": np.full(len(best), one), "vec_id": own[best], "score": s[best, i]})

    return nearest(rows.mapInArrow(run, FOUND), k)


def nearest(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the k best of each query, ties to the smaller id."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def fitted_reach(rows: DataFrame, places: DataFrame, k: int, asked: int, recall: float) -> int:
    """How far true neighbours of sampled queries are from them in the nearest tree."""
    some = rows.filter("q").orderBy(F.xxhash64("id"), "id").limit(asked).collect()
    if not some:
        return 1
    true = F.broadcast(brute(rows, some, k).select("query_id", "vec_id"))  # asked * k rows
    a = places.filter("q").select(F.col("id").alias("query_id"), "tree", F.col("rank").alias("a"))
    b = places.filter("NOT q").select(F.col("id").alias("vec_id"), "tree", F.col("rank").alias("b"))
    gaps = (b.join(true, "vec_id").join(a, ["query_id", "tree"])
            .groupBy("query_id", "vec_id").agg(F.min(F.abs(F.col("a") - F.col("b"))).alias("gap")))
    reach = gaps.agg(F.percentile("gap", F.lit(recall))).first()[0]
    return int(2 * (reach or 0)) + k


def search(vectors: DataFrame, queries: str, k: int = 20, trees: int = 24, asked: int = 64,
           recall: float = 0.97, segment: int = 1 << 14, seed: int = 11,
           reach: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row that meets `queries`."""
    rows = materialize(usable(vectors, queries), "vectors")
    places = materialize(ranked(rows, trees, seed), "places")
    reach = reach or fitted_reach(rows, places, k, asked, recall)
    budget = reach * trees  # of the 2 * reach * trees candidates in reach
    size = max(segment, 4 * reach)

    home = F.floor(F.col("rank") / size)
    spread = F.when(F.col("q"), F.array(home)).otherwise(F.array_distinct(F.array(
        home, F.floor(F.greatest(F.col("rank") - reach, F.lit(0)) / size),
        F.floor((F.col("rank") + reach) / size))))
    cut = places.withColumn("segment", F.explode(spread))

    def arrays(group: pa.Table) -> tuple:
        """Rows of the array by rank, and the queries."""
        asked_ = np.asarray(group.column("q").to_pylist(), bool)
        rank = group.column("rank").to_numpy()
        data = np.flatnonzero(~asked_)
        data = data[np.argsort(rank[data], kind="stable")]
        return data, np.flatnonzero(asked_), rank, group.column("code").to_numpy(), \
            group.column("id").to_numpy()

    def levels(group: pa.Table) -> pa.Table:
        data, asked_, rank, code, ids = arrays(group)
        counts = np.zeros((len(asked_), BITS + 1), np.int64)
        codes, ranks = code[data], rank[data]
        for i, q in enumerate(asked_):
            lo, hi = np.searchsorted(ranks, [rank[q] - reach, rank[q] + reach])
            counts[i] = np.bincount(_depth(codes[lo:hi], code[q]), minlength=BITS + 1)
        i, depth = np.nonzero(counts)
        return pa.table({"query_id": ids[asked_[i]], "depth": depth.astype(np.int32),
                         "n": counts[i, depth]})

    met = (cut.groupBy("tree", "segment").applyInArrow(levels, "query_id long, depth int, n long")
           .groupBy("query_id", "depth").agg(F.sum("n").alias("n")))
    down = Window.partitionBy("query_id").orderBy(F.desc("depth"))
    # the level at which all trees together first have enough, or else the highest there is
    enough = (met.withColumn("have", F.sum("n").over(down))
              .groupBy("query_id").agg(F.coalesce(
                  F.max(F.when(F.col("have") >= budget, F.col("depth"))), F.min("depth")).alias("level")))

    def score(group: pa.Table) -> pa.Table:
        data, asked_, rank, code, ids = arrays(group)
        v, level = matrix(group.column("v")), group.column("level").to_numpy()
        codes, ranks, held, own = code[data], rank[data], v[data], ids[data]
        out = []
        for q in asked_:
            lo, hi = np.searchsorted(ranks, [rank[q] - reach, rank[q] + reach])
            near = lo + np.flatnonzero((_depth(codes[lo:hi], code[q]) >= level[q])
                                       & (own[lo:hi] != ids[q]))
            if len(near) > 4 * k:
                rough = held[near] @ v[q]
                least = np.partition(rough, -2 * k)[-2 * k]
                near = near[rough >= least - 1e-9 * abs(least)]
            exact = (held[near] * v[q]).sum(axis=1)
            best = np.lexsort((own[near], -exact))[:2 * k]
            out.append((np.full(len(best), ids[q]), own[near[best]], exact[best]))
        parts = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, t) for t in "qqd"]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), parts)))

    full = (cut.join(enough.withColumnRenamed("query_id", "id"), "id", "left")
            .withColumn("level", F.coalesce("level", F.lit(0)))
            .join(rows.select("id", "v").dropDuplicates(["id", "v"]), "id"))
    found = full.select("tree", "segment", "q", "rank", "code", "id", "level", "v").groupBy(
        "tree", "segment").applyInArrow(score, FOUND)
    return nearest(found, k)
