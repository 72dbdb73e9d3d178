"""Mixing sources by temperature, in DataFrame operations only.

A source's weight is its share of all tokens to the power of an exponent between 0 (all sources
alike) and 1 (as they are), over the sum of these powers. The exponent is found by bisection: the
largest with an entropy of at least `entropy` times the greatest possible one, or, given a limit
of repetitions instead, the smallest at which no source is asked for more than that many times its
tokens. Sources are summed and compared as a table; no source and no list of sources is collected.

Of `budget` times all tokens each source gets its weight's share, as whole passes over its
documents and a part of one more. For the part its documents are dealt to blocks by a hash, blocks
are put in a hashed order, and are taken while they fit; in the first block that does not fit,
documents are taken in hashed order while they fit. So only sums of blocks are ordered per source,
and only the documents of one block, a 4096th of a large source.

A null source is a source of its own. Null and empty texts have no tokens and come once per whole
pass, with the first part pass's block order. Equal rows are mixed as rows of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
STEPS = 20  # the exponent is a multiple of 2^-20
BLOCKS = 4096


def source_tokens(docs: DataFrame) -> DataFrame:
    """source, tokens, n_docs of each source; summed in each task first."""
    return docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens"),
                                      F.count("*").alias("n_docs"))


def exponent(shares: DataFrame, entropy: float | None, repeats: float | None,
             budget: float) -> float:
    """Bisection on sums over the table of sources: one number comes back per step."""
    low, high = 0, 1 << STEPS
    live = F.col("share") > 0

    def fits(e: float) -> bool:
        power = F.when(live, F.pow("share", F.lit(e)))
        # with p = s^e / S: entropy = ln S - e / S * sum(s^e ln s)
        got = shares.agg(
            F.sum(power).alias("s"), F.sum(power * F.log("share")).alias("t"),
            F.sum(live.cast("int")).alias("n"), F.max(power / F.col("share")).alias("r")).first()
        if not got["n"]:
            return True
        if entropy is not None:
            return math.log(got["s"]) - e * got["t"] / got["s"] >= entropy * math.log(got["n"])
        return budget * got["r"] / got["s"] <= repeats

    if entropy is not None:
        if fits(1.0):
            return 1.0
        while high - low > 1:  # fits(low), not fits(high)
            mid = (low + high) // 2
            low, high = (mid, high) if fits(mid / (1 << STEPS)) else (low, mid)
        return low / (1 << STEPS)
    if fits(0.0):
        return 0.0
    while high - low > 1:  # not fits(low), fits(high)
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid / (1 << STEPS)) else (mid, high)
    return high / (1 << STEPS)


def _number(text: Column, salt: str) -> Column:
    """48 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat(text, F.lit(salt)).cast("binary")), 1, 12), 16,
                  10).cast("long")


def mixed(docs: DataFrame, entropy: float | None = None, repeats: float | None = None,
          budget: float = 1.0) -> DataFrame:
    """doc_id, source, n_tokens, weight, copies; a row for each row of `docs`.

    `copies` is how often the document is in the mix, 0 if it is not.
    """
    if (entropy is None) == (repeats is None):
        raise ValueError("give an entropy or a limit of repetitions")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    base = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("n_tokens"),
        _number(key, ":block").alias("b"), _number(key, ":document").alias("h"),
        F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("tie")), "mixing")
    sums = source_tokens(base)
    whole = sums.agg(F.sum("tokens")).first()[0] or 0
    shares = materialize(sums.withColumn("share", F.col("tokens") / F.lit(float(max(whole, 1)))),
                         "shares")
    e = exponent(shares, entropy, repeats, budget)
    power = F.when(F.col("share") > 0, F.pow("share", F.lit(e))).otherwise(0.0)
    total = shares.agg(F.sum(power)).first()[0] or 1.0
    quota = shares.select(
        "source", "tokens", (power / F.lit(total)).alias("weight"),
        F.least(F.lit(BLOCKS), F.ceil(F.col("n_docs") / 64)).alias("blocks"))
    # a millionth of a token more, so that rounding never costs a source its last document
    asked = F.floor(F.col("weight") * F.lit(float(budget)) * F.lit(whole) + 1e-6).cast("long")
    passes = F.when(F.col("tokens") > 0, F.floor(asked / F.col("tokens"))).otherwise(1)
    quota = materialize(quota.select(
        "source", "weight", "blocks", passes.cast("long").alias("passes"),
        F.when(F.col("tokens") > 0, asked - passes * F.col("tokens")).otherwise(0).cast("long")
        .alias("left")), "quota")

    same = F.col("d.source").eqNullSafe(F.col("q.source"))
    rows = base.alias("d").join(quota.alias("q"), same).select(
        "d.*", "weight", "passes", "left", F.pmod("b", "blocks").alias("block"))
    sizes = rows.groupBy("source", "block", "left").agg(F.sum("n_tokens").alias("size"))
    at = F.concat(F.col("block").cast("string"), F.lit(":"), F.coalesce("source", F.lit("")))
    order = Window.partitionBy("source").orderBy(_number(at, ":order"), "block")
    sizes = sizes.withColumn("end", F.sum("size").over(order.rowsBetween(
        Window.unboundedPreceding, 0)))
    # blocks that end within what is left are taken; the next one in part
    sizes = sizes.select("source", "block", "size", (F.col("end") - F.col("size")).alias("start"),
                         (F.col("end") <= F.col("left")).alias("taken"), "left")
    first = sizes.filter("NOT taken").groupBy("source").agg(F.min("start").alias("start"))
    a, b = sizes.alias("a"), first.alias("f")
    edge = a.join(b, F.expr("a.source <=> f.source AND NOT a.taken AND a.start = f.start")).select(
        "a.source", "a.block", (F.col("a.left") - F.col("a.start")).alias("room"))
    marks = materialize(
        sizes.filter("taken").select("source", "block", F.lit(None).cast("long").alias("room"))
        .unionAll(edge), "marks")
    rows = rows.alias("r").join(
        marks.alias("m"), F.expr("r.source <=> m.source AND r.block = m.block"), "left").select(
        "r.*", F.col("m.block").isNotNull().alias("in_block"), "room")
    inside = Window.partitionBy("source", "block").orderBy("h", "doc_id", "tie")
    part = rows.filter("room IS NOT NULL").withColumn(
        "extra", (F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
                  <= F.col("room")).cast("long")).drop("tie")
    rest = rows.filter("room IS NULL").withColumn("extra", F.col("in_block").cast("long"))
    out = part.unionByName(rest.drop("tie"))
    return out.select("doc_id", "source", "n_tokens", "weight",
                      (F.col("passes") + F.col("extra")).alias("copies"))


def remixed(docs: DataFrame, **target: float) -> DataFrame:
    """The rows of `docs`, all columns, each as often as it is in the mix.

    Rows that agree in doc_id and source are taken as often as the one of them taken most.
    """
    copies = mixed(docs, **target).filter("copies > 0").groupBy("doc_id", "source").agg(
        F.max("copies").alias("copies"))
    # the row is one column until the end, so that no name of its own can clash
    held = docs.select(F.struct("*").alias("row")).join(copies, F.expr(
        "CAST(row.doc_id AS LONG) <=> doc_id AND CAST(row.source AS STRING) <=> source"))
    return held.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
