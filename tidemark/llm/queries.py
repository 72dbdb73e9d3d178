"""The operators applied to the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (backoff, countmin, forest, minmax, mixing, orderhash, packing, prefixtree,
                          quality, repeats, spelling, toxicity, wavelet)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


#: SQL: a step with the table that `crc32` looks up, one row.
CRC_TABLE = """crc_table AS MATERIALIZED (
    SELECT list(list_reduce(range(8), lambda c, bit: xor(c >> 1, (c & 1) * 3988292384), n)
                ORDER BY n) AS t FROM range(256) AS r(n))"""


def crc32(text: str) -> str:
    """SQL: the unsigned crc32 of the UTF-8 bytes of a text."""
    data = f"""list_transform(range(1, 2 * octet_length(encode({text})) + 1, 2),
        lambda i: ('0x' || hex(encode({text}))[i:i + 1])::BIGINT)"""
    return f"""xor(4294967295, list_reduce({data}, lambda c, b:
        xor(c >> 8, crc_table.t[(xor(c, b) & 255) + 1]), 4294967295))"""


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_wavelet_tokens")
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.encoded(table(spark, sf_dir, "documents"),
                           public_tokenizers.path("word_bpe_49k.json"))


@query("op4_best_fit_packing")
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.json"))


@query("op5_toxicity")
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.learnt(docs, table(spark, sf_dir, "labels")))


@query("op10_quality")
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scores(docs, quality.learnt(docs, table(spark, sf_dir, "labels")))


@query("op2_minmax_dedup")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.components(table(spark, sf_dir, "documents"), width=3, percent=85)


@query("op6_run_length_repeats")
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(table(spark, sf_dir, "documents"), length=400)


@query("op3_backoff_scores")
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.scores(table(spark, sf_dir, "documents"))


@query("op8_order_minhash")
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderhash.with_edits(table(spark, sf_dir, "documents"))


@query("op7_prefix_forest")
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)


#: A share of the greatest possible entropy; as many tokens as there are.
MIX = {"entropy": 0.97, "budget": 1.0}


@query("op9_temperature_mixing")
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), **MIX)


@query("op11_countmin_windows")
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = countmin.without_earlier_windows(table(spark, sf_dir, "documents"), width=13)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL["op11_countmin_windows"] = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
places AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS phrase
    FROM texts, unnest(range(1, len(ws) - 11)) AS t(i)),
owners AS (SELECT phrase, min(doc_id) AS owner FROM places GROUP BY phrase),
gone AS (
    SELECT DISTINCT doc_id, i + j AS pos
    FROM places JOIN owners USING (phrase), unnest(range(0, 13)) AS s(j) WHERE owner < doc_id),
single AS (
    SELECT doc_id, pos, ws[pos] AS word FROM texts, unnest(range(1, len(ws) + 1)) AS t(pos)),
left_over AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS kept
    FROM single ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN left_over USING (doc_id)"""


@query("op12_forward_tree")
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtree.tree(table(spark, sf_dir, "conversations"))


@query("op13_trie_spelling")
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), letters=5, least=3, times=2)


ORACLE_SQL["op12_forward_tree"] = f"""
WITH {CRC_TABLE},
own AS (
    SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
rebuilt AS (
    SELECT own.c, list_concat(coalesce(base.turns, [])[1:h], own.turns[h + 1:]) AS turns
    FROM (SELECT own.*, {crc32('c::VARCHAR')} % 6 AS h FROM own, crc_table) AS own
    LEFT JOIN own AS base ON base.c = own.c - own.c % 100),
steps AS (
    SELECT c, d, len(turns) = d AS ends, CASE WHEN d > 0 THEN length(turns[d].t) ELSE 0 END AS size,
        list_transform(turns[1:d], lambda x: length(x.r) || ':' || x.r || x.t) AS path
    FROM rebuilt, unnest(range(0, len(turns) + 1)) AS s(d)),
nodes AS (
    SELECT path, min(c) AS conv_id, any_value(d) AS depth, count(*) AS n_convs,
        (count(*) - 1) * any_value(size) AS own_saved,
        coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ending
    FROM steps GROUP BY path),
linked AS (
    SELECT nodes.*, CASE WHEN depth > 0 THEN path[1:depth - 1] END AS up FROM nodes),
children AS (SELECT up AS path, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY up),
below AS (
    SELECT linked.path[1:a] AS path, sum(own_saved) AS saved, count(*) FILTER (n_children IS NULL) AS leaves
    FROM linked LEFT JOIN children USING (path), unnest(range(0, depth + 1)) AS s(a) GROUP BY 1)
SELECT l.conv_id, l.depth, p.conv_id AS parent_conv_id, l.n_convs,
    coalesce(n_children, 0) AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens,
    sha256(l.ending) AS ends_sha256
FROM linked AS l JOIN below USING (path) LEFT JOIN children USING (path)
LEFT JOIN nodes AS p ON l.up = p.path"""

ORACLE_SQL["op13_trie_spelling"] = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
    WHERE length(run) >= 5),
hashed AS (
    SELECT run, {crc32("concat(doc_id::VARCHAR, ':', run)")} AS h FROM runs, crc_table),
words AS (
    SELECT word, count(*) AS n FROM (
        SELECT CASE WHEN h % 97 = 0
            THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed)
    WHERE length(word) >= 5 GROUP BY word HAVING count(*) >= 3),
holes AS (
    SELECT word, i, word[1:i - 1] AS a, word[i + 1:] AS b
    FROM words, unnest(range(1, length(word) + 1)) AS s(i)),
pairs AS (
    SELECT x.word, y.word AS near FROM holes AS x JOIN holes AS y USING (i, a, b) WHERE x.word <> y.word
    UNION SELECT holes.word, w.word FROM holes JOIN words AS w ON w.word = a || b
    UNION SELECT w.word, holes.word FROM holes JOIN words AS w ON w.word = a || b),
best AS (
    SELECT pairs.word, count(*) AS n_near, first(near ORDER BY y.n DESC, encode(near)) AS near,
        max(y.n) AS near_n
    FROM pairs JOIN words AS y ON near = y.word GROUP BY pairs.word),
forms AS (
    SELECT word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * words.n THEN near END AS form,
        CASE WHEN near_n >= 2 * words.n THEN near_n END AS form_n
    FROM words LEFT JOIN best USING (word)),
walk AS (
    SELECT word, word AS root FROM forms
    UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON walk.root = forms.word
    WHERE forms.form IS NOT NULL),
roots AS (SELECT walk.word, root FROM walk JOIN forms ON root = forms.word WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""

ORACLE_SQL["op2_minmax_dedup"] = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS s
    FROM texts),
classes AS (
    SELECT min(doc_id) AS rep, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
parts AS (SELECT rep, len(s) AS n, unnest(s) AS shingle FROM classes),
links AS (
    SELECT a.rep AS x, b.rep AS y FROM parts AS a JOIN parts AS b USING (shingle)
    WHERE a.rep <> b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
    SELECT rep AS x, rep AS y FROM classes
    UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
least_of AS (SELECT x AS rep, min(y) AS component FROM reach GROUP BY x)
SELECT sets.doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(component, sets.doc_id) AS component_id,
    sets.doc_id = coalesce(component, sets.doc_id) AS kept
FROM sets LEFT JOIN classes ON list_sort(sets.s) = classes.s LEFT JOIN least_of USING (rep)"""

ORACLE_SQL["op6_run_length_repeats"] = """
WITH texts AS (SELECT doc_id, encode(coalesce(text, '')) AS data FROM documents),
places AS (
    SELECT doc_id, i, md5(data[i:i + 399]) AS h
    FROM texts, unnest(range(1, octet_length(data) - 398)) AS s(i)),
twice AS (SELECT h FROM places GROUP BY h HAVING count(*) > 1),
gone AS (SELECT doc_id, i FROM places SEMI JOIN twice USING (h)),
-- starts not more than 400 bytes apart make one run
marked AS (
    SELECT *, CASE WHEN i > coalesce(lag(i) OVER w, -400) + 400 THEN 1 ELSE 0 END AS new
    FROM gone WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY doc_id, run),
kept AS (
    SELECT doc_id, coalesce(lag(b) OVER w, 1) AS a, a AS b FROM runs
    WINDOW w AS (PARTITION BY doc_id ORDER BY a)
    UNION ALL SELECT doc_id, max(b), NULL FROM runs GROUP BY doc_id),
rest AS (
    SELECT doc_id, string_agg(hex(data[a:coalesce(b - 1, octet_length(data))]), '' ORDER BY a) AS left_over
    FROM kept JOIN texts USING (doc_id) WHERE coalesce(b - 1, octet_length(data)) >= a GROUP BY doc_id)
SELECT doc_id, octet_length(data)::BIGINT AS n_bytes, coalesce(sum(b - a), 0)::BIGINT AS n_removed,
    count(a) AS n_spans, sha256(CASE WHEN count(a) = 0 THEN data ELSE unhex(coalesce(any_value(left_over), '')) END)
        AS kept_sha256
FROM texts LEFT JOIN runs USING (doc_id) LEFT JOIN rest USING (doc_id) GROUP BY doc_id, data"""
