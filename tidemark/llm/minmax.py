"""Near-duplicates by min-max hashing.

A document's set is that of its shingles of `width` words; a document of fewer words is one
shingle, and one without words has none and is linked with nothing. Under each permutation both
the least and the greatest value are kept, so half the permutations give a whole signature. Bands
of the signature find candidates; candidates are confirmed on their full sets.

Documents of one set are one class from the start. In a band bucket, classes are compared with a
few leaders and not all with all: who turns out to be in the leader's component needs no more
comparisons with it. The first leader is the one with the most company over all its buckets, which
in a group of copies is the least edited. Leaders multiply by eight each round until no bucket
holds members of two components that have not been compared, so no link among candidates that
could join components is left out, and groups of mutual copies cost a comparison each.

After the first round, what is left falls into clusters that buckets hold together. A cluster
within stated bounds is settled in one task, where postings give all its intersections and only
links between components leave. For larger clusters the rounds go on, spread over all tasks; there,
shingles that no other remaining class has are counted first: with x and y of these, sets of m and
n can share no more than min(m - x, n - y), which settles many pairs without a comparison.

With 20 bands of 5 values a pair at the threshold of 0.85 is missed with a probability of 8e-6.
Classes are numbered by 64 bits of a 128-bit digest of the set.

Null ids take part; a component of null ids alone has a null id. Equal rows are one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import keeps, mix, portions, ranges, signed, slices, texts, two
from tidemark.session import materialize

BANDS, ROWS = 20, 5
_rng = np.random.default_rng(20240917)
_FACTORS = _rng.integers(0, 1 << 63, BANDS * ROWS // 2, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, BANDS * ROWS // 2, np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_hashes = _Hashes()
keeps("minmax", _hashes.clear)


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; A-Z is lower-cased, words are cut at blanks
    and at bytes 9 to 13."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    if len(h) < width:
        short = np.array([len(h)], np.uint64)  # apart from shingles of full width
        for x in h:
            short = mix(short ^ x) * np.uint64(0x9E3779B97F4A7C15)
        return short
    out = h[:len(h) - width + 1].copy()
    for j in range(1, width):
        out = mix(out) + h[j:len(h) - width + 1 + j]
    return np.unique(mix(out))


def digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, as two integers."""
    a = [int(np.bitwise_xor.reduce(mix(s)) ^ np.uint64(len(s))) if len(s) else 0 for s in sets]
    b = [int(mix(s + np.uint64(0x9E3779B97F4A7C15)).sum()) if len(s) else 0 for s in sets]
    return np.array(a, np.uint64), np.array(b, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Least and greatest value of each (non-empty) set under each permutation, alternating."""
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.empty((len(sets), BANDS * ROWS), np.uint64)
    for a, b in slices(n, 1 << 15):
        flat = np.concatenate(sets[a:b])
        at = np.cumsum(n[a:b]) - n[a:b]
        for k, (f, s) in enumerate(zip(_FACTORS, _SHIFTS)):
            v = flat * f
            v += s
            out[a:b, 2 * k] = np.minimum.reduceat(v, at)
            out[a:b, 2 * k + 1] = np.maximum.reduceat(v, at)
    return out


def bands(values: np.ndarray) -> np.ndarray:
    """A hash per band, different from band to band."""
    parts = values.reshape(len(values), BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :].repeat(len(values), axis=0)
    for j in range(ROWS):
        out = mix(out ^ parts[:, :, j])
    return out


def signed_docs(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, node and node2 (the digest; null without shingles), keys (of bands)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 256, "minmax"):
            sets = [shingles(t, width) for t in texts(batch)]
            full = [s for s in sets if len(s)]
            keys = iter(signed(bands(signatures(full))).tolist() if full else [])
            a, b = digests(sets)
            none = np.array([len(s) == 0 for s in sets], bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("content"),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(signed(a), mask=none), pa.array(signed(b), mask=none),
                 pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "content", "n_shingles", "node", "node2", "keys"])

    return two(docs).withColumn("content", F.xxhash64("text")).mapInArrow(
        run, "doc_id long, content long, n_shingles long, node long, node2 long, keys array<long>")


def stored_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The full sets (sorted 64-bit hashes) of the classes `wanted` (node, rep)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 256, "minmax"):
            sets = [shingles(t, width) for t in texts(batch)]
            nodes = signed(digests(sets)[0])
            # two rows can share an id: only the one whose set it is counts
            own = nodes == batch.column("node").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["node", "shingles"]).filter(pa.array(own))

    rows = two(docs).join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")))
    return rows.select("node", "text").mapInArrow(run, "node long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 1024):
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    held = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"))
    return held.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def contracted(links: DataFrame) -> DataFrame:
    """`node`, `root` for every node of the links (a, b): one root per connected component.

    Each round every node points to its least neighbour and pointers are followed twice; links
    between different roots remain for the next round. Node numbers are hashes, so chains of
    falling numbers are short, and rounds are about the logarithm of a component's diameter.
    """
    edges = materialize(links.filter("a != b"), "links")
    roots = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")), "up")
        for _ in range(2):
            over = up.select(F.col("a").alias("p"), F.col("p").alias("q"))
            up = up.join(over, "p").select("a", F.col("q").alias("p"))
        up = materialize(up, "up")
        a, b = (up.select(F.col("a").alias(c), F.col("p").alias(f"p{c}")) for c in "ab")
        edges = materialize(edges.join(a, "a").join(b, "b")
                            .select(F.col("pa").alias("a"), F.col("pb").alias("b"))
                            .filter("a != b").distinct(), "links")
        step = up.select(F.col("a").alias("node"), F.col("p").alias("root"))
        if roots is None:
            roots = step
        else:
            after = step.select(F.col("node").alias("root"), F.col("root").alias("later"))
            roots = materialize(
                roots.join(after, "root", "left")
                .select("node", F.coalesce("later", "root").alias("root")), "roots")
    if roots is None:
        roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def _shared(members: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component."""
    mixed = (members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .filter("lo != hi").select("key"))
    return members.join(mixed, "key", "left_semi")


def _possible(n: str, own: str, m: str, other: str, percent: int) -> Column:
    """Whether sets of n and m shingles, `own` and `other` of them unshared, can be alike enough."""
    most = F.least(F.col(n) - F.col(own), F.col(m) - F.col(other))
    return most * 100 >= (F.col(n) + F.col(m) - most) * percent


def _unshared(members: DataFrame, sets: DataFrame) -> DataFrame:
    """node, own: how many of the shingles of each remaining class no other one has."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 1024):
            held = [np.frombuffer(s, np.int64) for s in batch.column("shingles").to_pylist()]
            n = [len(s) for s in held]
            for a, b in slices(np.array(n, np.int64), 1 << 18):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(held[a:b])),
                     batch.column("node")[a:b].take(pa.array(np.repeat(np.arange(b - a), n[a:b])))],
                    ["shingle", "node"])

    left = sets.join(members.select("node").distinct(), "node", "left_semi")
    once = (left.select("node", "shingles").mapInArrow(split, "shingle long, node long")
            .groupBy("shingle").agg(F.count("*").alias("c"), F.min("node").alias("node"))
            .filter("c = 1"))
    return once.groupBy("node").agg(F.count("*").cast("int").alias("own"))


def local_links(comp: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between components, at least as many as join what the links of all pairs join.

    Members of the largest component are only met by the others.
    """
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), n)
    by = np.argsort(code, kind="stable")
    posted, ends = owner[by], np.cumsum(np.bincount(code, minlength=len(values)))
    starts = np.cumsum(n) - n
    kinds, label = np.unique(comp, return_inverse=True)
    largest = np.bincount(label).argmax()
    root = list(range(len(kinds)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    begin = ends - np.diff(ends, prepend=0)
    for i in np.flatnonzero(label != largest):
        own = code[starts[i]:starts[i] + n[i]]
        met = posted[ranges(begin[own], ends[own] - begin[own])]
        both = np.bincount(met, minlength=len(sets))
        near = np.flatnonzero(100 * both >= percent * (n + n[i] - both))
        for j in near:
            a, b = find(label[i]), find(label[j])
            if a != b:
                root[a] = b
                out.append((int(kinds[label[i]]), int(kinds[label[j]])))
    return out


def _clusters(members: DataFrame) -> DataFrame:
    """node, cluster: classes that mixed buckets hold together, by way of each bucket's least."""
    least = members.groupBy("key").agg(F.min("node").alias("b"))
    edges = members.join(least, "key").select(F.col("node").alias("a"), "b").distinct()
    # components found so far hold together too
    first = members.groupBy("comp").agg(F.min("node").alias("b"))
    edges = edges.unionAll(members.join(first, "comp").select(F.col("node").alias("a"), "b")
                           .distinct())
    return contracted(edges).withColumnRenamed("root", "cluster")


def _settled(members: DataFrame, sets: DataFrame, percent: int, classes: int, shingles: int
             ) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of components within small clusters, and the members of all others."""
    nodes = members.select("node", "n", "comp").distinct().join(_clusters(members), "node")
    nodes = materialize(nodes, "clustered")
    small = nodes.groupBy("cluster").agg(F.count("*").alias("c"), F.sum("n").alias("s")).filter(
        (F.col("c") <= classes) & (F.col("s") <= shingles)).select("cluster")
    inside = materialize(nodes.join(small, "cluster", "left_semi"), "inside")

    def run(group: pa.Table) -> pa.Table:
        held = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
        found = local_links(group.column("comp").to_numpy(), held, percent)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()),
                         "b": pa.array([b for _, b in found], pa.int64())})

    links = inside.join(sets, "node").select("cluster", "comp", "shingles").groupBy(
        "cluster").applyInArrow(run, "a long, b long")
    return links, members.join(inside, "node", "left_anti")


def components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; a row for each row of `docs`, none for an empty table.

    component_id is the smallest doc_id that links lead to, the own one included; `kept` marks the
    row that has it.
    """
    return _components(docs, width, percent).drop("content")


def _components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The same with `content`, a hash of the text."""
    rows = materialize(signed_docs(docs, width), "minmax")
    classes = materialize(
        rows.filter("n_shingles > 0").groupBy("node", "node2")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
             F.first("keys").alias("keys")), "classes")
    # a class is its own component at first
    members = materialize(_shared(
        classes.select(F.explode("keys").alias("key"), "node", F.col("n").cast("int").alias("n"))
        .withColumn("comp", F.col("node"))), "members")
    sizes = members.groupBy("key").agg(F.count("*").alias("c"))
    company = members.join(sizes, "key").groupBy("node").agg(F.sum("c").alias("company"))
    members = materialize(members.join(company, "node").select(
        "key", "node", "n", F.lit(0).alias("own"), "company", "comp"), "members")
    wanted = members.select("node").distinct().join(classes.select("node", "rep"), "node")
    sets = materialize(stored_sets(docs, wanted, width), "sets")

    moves, leaders_per_bucket, turn = [], 1, 0
    while not members.isEmpty():
        slot = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(leaders_per_bucket))
        leaders = (members.groupBy("key", slot.alias("slot"))
                   .agg(F.max(F.struct("company", "node", "n", "own", "comp")).alias("l"))
                   .select("key", *(F.col(f"l.{c}").alias(f"lead_{c}")
                                    for c in ("node", "n", "own", "comp"))))
        leaders = materialize(leaders, "leaders")
        pairs = (members.join(leaders, "key").filter("comp != lead_comp")
                 .filter(_possible("n", "own", "lead_n", "lead_own", percent))
                 .select(F.least("node", "lead_node").alias("a"),
                         F.greatest("node", "lead_node").alias("b"),
                         F.least("comp", "lead_comp").alias("ca"),
                         F.greatest("comp", "lead_comp").alias("cb")).distinct())
        pairs = materialize(pairs, "pairs")
        good = confirmed(pairs.select("a", "b"), sets, percent)
        links = pairs.join(good, ["a", "b"], "left_semi")
        roots = contracted(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
        roots = roots.select(F.col("node").alias("comp"), "root")
        moves.append(roots)
        used = leaders.select("key", F.col("lead_node").alias("node"))
        rest = (members.join(used, ["key", "node"], "left_anti").join(roots, "comp", "left")
                .select("key", "node", "n", "own", "company",
                        F.coalesce("root", "comp").alias("comp")))
        members = materialize(_shared(rest), "members")
        if not turn and not members.isEmpty():
            links, members = _settled(members, sets, percent, 4096, 1 << 22)
            moves.append(contracted(links).select(F.col("node").alias("comp"), "root"))
            members = materialize(members, "members")
        if not turn and not members.isEmpty():
            # leaders of one bucket can be members of another, so these counts hold for all left
            own = _unshared(members, sets)
            members = materialize(_shared(
                members.drop("own").join(own, "node", "left")
                .withColumn("own", F.coalesce("own", F.lit(0)))
                .filter((F.col("n") - F.col("own")) * 100 >= F.col("n") * percent)
                .select("key", "node", "n", "own", "company", "comp")), "members")
        leaders_per_bucket, turn = leaders_per_bucket * 8, turn + 1

    found = classes.select("node", "node2", "rep", F.col("node").alias("comp"))
    for roots in moves:
        found = found.join(roots, "comp", "left").select(
            "node", "node2", "rep", F.coalesce("root", "comp").alias("comp"))
    least = found.groupBy("comp").agg(F.min("rep").alias("component_id"))
    found = found.join(least, "comp").select("node", "node2", "component_id")
    out = rows.join(found, ["node", "node2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "content")


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, all columns, one of each component: that of the smallest doc_id.

    Rows without words all stay, and so do rows of one id and text that differ in another column;
    equal rows are one row. Rows without an id stay if their component has no id at all.
    """
    found = _components(docs, width, percent).filter("kept").groupBy(
        "doc_id", "content", (F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).alias("told")
    ).agg(F.count(F.lit(1)).alias("rows"))
    # two texts under the smallest doc_id of their component: the one of the smaller hash stays
    one = found.filter("told").groupBy("doc_id").agg(
        F.min(F.struct("content", "rows")).alias("one")).select("doc_id", "one.*")
    kept = materialize(one.unionAll(found.filter("NOT told").drop("told")), "kept")
    # the row is one column until the end, so that no name of its own can clash
    own = F.xxhash64(F.coalesce(F.col("row.text"), F.lit("")).cast("binary"))
    rows = docs.select(F.struct("*").alias("row")).withColumn("own", own)
    same = F.expr("CAST(row.doc_id AS LONG) <=> doc_id AND own = content")
    once = rows.join(kept.filter("rows = 1"), same, "left_semi").select("row.*")
    more = rows.join(kept.filter("rows > 1"), same, "left_semi").select("row.*")
    return once.unionAll(more.dropDuplicates())
