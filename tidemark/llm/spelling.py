"""Spelling variants: words one edit apart, found by a frontier that walks a trie level by level.

The trie is a table of edges. Chains without branches are one edge, so a node is a prefix after
which words differ or end, and the number of levels is that of branchings, not of letters. A state
is a word, the part of it still to be read, a node, and the letters read to get there. Where a word's
own path passes a node, the edit may happen: a greater letter instead of its next one, or its next
letter left out. Each pair is so found from one side, and turned round at the end. Words one edit apart
part at a node for good, so these are all the places there are. From then on the rest must match
exactly: the frontier is joined with the edges by (node, next letter) until no state has anything
left to read. States that end where a word ends are its neighbours. A node knows by a bit each what
three letters may follow it, and a state whose next three letters may not is not made.

Near the root nodes have very many words and branch to every letter. A word is therefore walked twice,
as it is and backwards, and edits happen only in the second half of either walk: an edit in the first
half of a word is one in the second half of its mirror image. No node of the first half is built.

Nodes are 64-bit hashes of prefixes. Two prefixes of one hash could add states but lose none, and
what a state has read is kept as letters and looked up among the words at the end, so results do not
rest on hashes.

Null texts have no words; a null doc_id counts as an empty one. Repeated rows count again, under
their own id. An empty table has no words. Other columns are not looked at. Words may have any
length: a row of the trie holds a number for its word, not its letters. The runs of one text are an
array in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import mix, ranges, signed, slices
from tidemark.llm.words import powers
from tidemark.session import materialize

# Capital letters, letters of a run, and how rarely a run loses a letter.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[a-zÀ-ÿ]+"
ONE_IN = 97

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def counted(docs: DataFrame, letters: int, least: int) -> DataFrame:
    """word, n: words of at least so many letters and occurrences; one run in 97 loses a letter."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = (docs.select(ident.alias("ident"), F.explode(F.regexp_extract_all(
                F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
            .filter(F.length("run") >= letters)
            .select("run", F.crc32(F.concat_ws(":", "ident", "run").cast("binary")).alias("h")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at),
                       F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % ONE_IN == 0, shorter).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).filter(F.length("word") >= letters)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least))


# ── the trie ─────────────────────────────────────────────────────────────────

# How the next three letters choose a bit, here and in SQL.
_SECOND, _FIRST, _SPREAD = 31, 961, 2654435761


def bit_of(rest: str) -> str:
    """SQL: the bit of the first three letters of a text, of which there may be fewer."""
    a, b, c = (f"ascii(substring({rest}, {i}, 1))" for i in (1, 2, 3))
    return (f"CAST(shiftright(({a} * {_FIRST}L + {b} * {_SECOND}L + {c}) * {_SPREAD}L, 16) % 64 AS INT)")


def fits(rest: str, ahead: str) -> str:
    """SQL: false if no word goes on from a node like this."""
    return f"(shiftright({ahead}, {bit_of(rest)}) & 1L) = 1L"


def first_depth(length: np.ndarray, back: bool) -> np.ndarray:
    """Least prefix after which a word is edited on either walk, and so the first that has a node. No
    word is reached from a shorter one, hence not before its own first depth."""
    return length - length // 2 if back else length // 2


def prefixes(words: DataFrame) -> DataFrame:
    """w, back, depth, node, letter (the next one, 0 at the end), ahead (bit of the next three): the
    prefixes of each word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word = batch.column("word").to_pylist()
            size = np.fromiter(map(len, word), np.int64, len(word))
            w = batch.column("w").to_numpy()
            for a, b in slices(size, 1 << 17):
                for back in (False, True):
                    part = [x[::-1] for x in word[a:b]] if back else word[a:b]
                    yield made(w[a:b], part, size[a:b], back)

    def made(w: np.ndarray, word: list[str], size: np.ndarray, back: bool) -> pa.RecordBatch:
        letters = np.frombuffer("".join(word).encode("utf-32-le"), np.uint32)
        start = np.cumsum(size) - size
        sums = np.zeros(len(letters) + 1, np.uint64)
        np.cumsum(mix(letters.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(letters)),
                  out=sums[1:], dtype=np.uint64)
        low = first_depth(size, back)
        own = np.repeat(np.arange(len(w)), size - low + 1)
        depth = ranges(low, size - low + 1)
        at = start[own]
        node = mix((sums[at + depth] - sums[at]) * powers(_BACK, len(letters) + 1)[at]
                   + mix(2 * depth.astype(np.uint64) + np.uint64(back)))
        padded = np.append(letters, [0, 0, 0]).astype(np.int64)
        letter, second, third = (np.where(depth + k < size[own], padded[at + depth + k], 0)
                                 for k in range(3))
        bit = ((letter * _FIRST + second * _SECOND + third) * _SPREAD >> 16) % 64
        return pa.RecordBatch.from_arrays(
            [pa.array(w[own]), pa.array(np.full(len(own), back)), pa.array(depth.astype(np.int32)),
             pa.array(signed(node)), pa.array(letter.astype(np.int32)),
             pa.array(signed(np.uint64(1) << bit.astype(np.uint64)))],
            ["w", "back", "depth", "node", "letter", "ahead"])

    return words.select("w", "word").mapInArrow(
        run, "w long, back boolean, depth int, node long, letter int, ahead long")


def trails(words: DataFrame) -> DataFrame:
    """back, s (the word as it is walked), trail: the nodes on its path, from some depth on."""
    rows = materialize(prefixes(words), "prefixes")
    nodes = (rows.groupBy("node").agg(F.min("letter").alias("low"), F.max("letter").alias("high"),
                                      F.bit_or("ahead").alias("ahead"))
             .filter("low = 0 OR low < high").select("node", (F.col("low") == 0).alias("ends"), "ahead"))
    found = (rows.drop("letter", "ahead").join(nodes, "node").groupBy("w", "back").agg(F.sort_array(
        F.collect_list(F.struct("depth", "node", "ends", "ahead"))).alias("trail")))
    word = F.col("word")
    return found.join(words.select("w", "word"), "w").select(
        "back", F.when(F.col("back"), F.reverse(word)).otherwise(word).alias("s"), "trail")


def edges(paths: DataFrame) -> DataFrame:
    """node, letter, label, child, child_ends, child_ahead: one row for each edge."""
    steps = paths.filter("size(trail) > 1").selectExpr("s", """
        explode(transform(sequence(1, size(trail) - 1),
            k -> struct(trail[k - 1] AS a, trail[k] AS b))) AS step""")
    labelled = steps.selectExpr(
        "step.a.node AS node", "substring(s, step.a.depth + 1, step.b.depth - step.a.depth) AS label",
        "step.b.node AS child", "step.b.ends AS child_ends", "step.b.ahead AS child_ahead")
    return labelled.groupBy("node", F.left("label", F.lit(1)).alias("letter")).agg(
        *(F.min(c).alias(c) for c in ("label", "child", "child_ends", "child_ahead")))


# ── the frontier ─────────────────────────────────────────────────────────────

# A state: back, s (the word), node, ends (whether a word ends there), read, rest.
_GONE_ON = ("back", "s", "child AS node", "child_ends AS ends", "read || label AS read")


def edited(paths: DataFrame, graph: DataFrame) -> DataFrame:
    """States after the one edit."""
    places = (paths.select("back", "s", F.inline("trail")).filter("depth < length(s)")
              .selectExpr("back", "s", "node", "ends", "ahead", "left(s, depth) AS read",
                          "substring(s, depth + 1, 1) AS next", "substring(s, depth + 2) AS rest"))
    dropped = places.filter(fits("rest", "ahead")).select("back", "s", "node", "ends", "read", "rest")
    tail = "substring(label, 2)"
    replaced = (places.drop("ends", "ahead").join(graph, "node")
                .filter(f"letter > next AND startswith(rest, {tail})")
                .selectExpr(*_GONE_ON, "child_ahead", "substring(rest, length(label)) AS rest")
                .filter(fits("rest", "child_ahead")).drop("child_ahead"))
    return dropped.unionAll(replaced)


def advanced(states: DataFrame, graph: DataFrame) -> DataFrame:
    """States that still have something to read, one edge further."""
    return (states.filter("rest <> ''").drop("ends").withColumn("letter", F.left("rest", F.lit(1)))
            .join(graph, ["node", "letter"]).filter("startswith(rest, label)")
            .selectExpr(*_GONE_ON, "child_ahead", "substring(rest, length(label) + 1) AS rest")
            .filter(fits("rest", "child_ahead")).drop("child_ahead"))


def neighbours(words: DataFrame) -> DataFrame:
    """word, near: all pairs of words one edit apart, both ways round; `words` (w, word) is stored,
    w its number."""
    paths = materialize(trails(words), "trails")
    graph = materialize(edges(paths), "edges")
    states = materialize(edited(paths, graph), "states")
    ended = []
    while True:   # as many rounds as nodes branch one after another
        ended.append(states.filter("rest = '' AND ends"))
        if states.filter("rest <> ''").isEmpty():
            break
        states = materialize(advanced(states, graph), "states")
    found = ended[0]
    for part in ended[1:]:
        found = found.unionAll(part)

    def forward(c: str) -> Column:
        return F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c))

    pairs = found.select(forward("s").alias("word"), forward("read").alias("near"))
    return (pairs.join(words.select(F.col("word").alias("near")), "near", "left_semi")
            .select(F.inline(F.array(F.struct("word", "near"), F.struct(
                F.col("near").alias("word"), F.col("word").alias("near")))))
            .distinct())


def roots(forms: DataFrame) -> DataFrame:
    """word, root: forms followed to the last. Each round doubles the steps taken; counts at least
    double from form to form, so a few rounds do."""
    reach = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if reach.join(on, "root", "left_semi").isEmpty():
            return reach
        reach = materialize(reach.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root")), "roots")


def variants(docs: DataFrame, letters: int = 5, least: int = 3, times: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n: a row for each word."""
    words = materialize(counted(docs, letters, least)
                        .withColumn("w", F.monotonically_increasing_id()), "words")
    near = (neighbours(words)
            .join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
            .groupBy("word").agg(
                F.count(F.lit(1)).alias("n_near"),
                F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    best = F.when(-F.col("best.less") >= times * F.col("n"), F.col("best"))
    known = materialize(
        words.join(near, "word", "left").select(
            "word", best["near"].alias("form"), "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            (-best["less"]).alias("form_n")), "forms")
    ends = roots(known.filter("form IS NOT NULL"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
