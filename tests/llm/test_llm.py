"""Operators for training data against brute force, on small fixtures with the usual oddities."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (backoff, forest, minmax, mixing, orderhash, packing, quality, repeats,
                          toxicity, wavelet)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, key int"
WORDS = ["alpha", "beta", "gamma", "delta", "the", "of", "and", "naïve", "x1", "Ω", "don't", "a.b"]


def made(seed: int = 1) -> list[tuple]:
    """Long, short, empty and null texts, copies, near copies, shared passages, equal rows, nulls."""
    rng = np.random.default_rng(seed)

    def text(n: int) -> str:
        return " ".join(rng.choice(WORDS) + str(rng.integers(0, 400)) for _ in range(n))

    passage, base = text(90), text(120).split()
    texts = [text(int(n)) for n in rng.integers(1, 150, 25)]
    texts += [text(30) + " " + passage + " " + text(20) for _ in range(4)]
    for i in range(8):
        near = list(base)
        for j in rng.integers(0, 120, i):
            near[j] = "w%d" % rng.integers(0, 9)
        texts.append(" ".join(near))
    texts += ["", " \n\t ", "one", "one", "One", "two words", "a  b\n\n c   d", texts[0], texts[0],
              text(9000), "é" * 700, "ab" * 900]
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else "hot", len(t), "n", 1)
            for i, t in enumerate(texts)]
    rows += [rows[3], (None, "null id of some words here", None, None, None, None, None),
             (1000, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def raw(rows) -> list[tuple]:
    return [(r[0], r[1] or "") for r in rows]


def test_wavelet_matrix_answers_like_a_list():
    rng = np.random.default_rng(0)
    for n in (0, 1, 63, 511, 512, 513, 3000):
        ids = rng.integers(0, 60, n).astype(np.uint32) * 991
        w = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.of(ids).to_bytes())
        assert (w.decode() == ids).all()
        for i in range(0, n, max(1, n // 40)):
            v = int(ids[i])
            where = np.flatnonzero(ids == v)
            assert w.access(i) == v and w.count(v) == len(where)
            assert w.count(v, i // 2, i + 1) == (ids[i // 2:i + 1] == v).sum()
            assert w.find(v, len(where) - 1) == where[-1] and w.find(v, len(where)) == -1
    assert w.count(1 << 30) == 0


def reference_ids(file: str, text: str) -> list[int]:
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(file)).encode(
        text, add_special_tokens=False).ids


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_shards_give_back_the_ids(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = [tuple(r) for r in wavelet.encoded(docs, path).collect()]
    want, start = [], 0
    for i, t in sorted(raw(made()), key=lambda r: (r[0] is not None, r[0])):
        ids = reference_ids("word_bpe_49k.json", t) + [2]
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    by = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(got, key=by) == sorted(want, key=by)
    assert wavelet.encoded(none, path).count() == 0


def test_packing_is_gapless_and_whole(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.packed(docs, path).collect()
    want = Counter()
    for i, t in raw(made()):
        ids = reference_ids("byte_bpe_50k.json", t) + [0]
        for p, (s, n) in enumerate(packing.pieces(len(ids), 2048)):
            want[i, p, s, n, crc(ids[s:s + n])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins: dict = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 2048
    assert packing.packed(none, path).count() == 0


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    fit = packing.BestFit(10, 2)
    assert fit.place(6) == (0, 0) and fit.place(7) == (1, 0)
    assert fit.place(3) == (1, 7) and fit.place(4) == (0, 6)
    assert fit.place(9) == (2, 0) and fit.place(8) == (3, 0) and fit.place(5) == (4, 0)
    assert fit.place(1) == (3, 8)  # the bin with one left was closed


def linked(rows, width: int, percent: int) -> list[int]:
    sets = []
    for _, t in rows:
        w = t.encode().lower().split()
        sets.append(frozenset(tuple(w[j:j + width]) for j in range(len(w) - width + 1))
                    or (frozenset([tuple(w)]) if w else frozenset()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and both and 100 * both >= percent * (len(x) + len(sets[j]) - both):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], sets


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_components_are_those_of_all_pairs(docs, none, width, percent):
    rows = raw(made())
    roots, sets = linked(rows, width, percent)
    least: dict = {}
    for r, (i, _) in zip(roots, rows):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = Counter((i, len(s), least.get(r), i == least.get(r))
                   for (i, _), r, s in zip(rows, roots, sets))
    got = minmax.components(docs, width, percent).collect()
    assert Counter(map(tuple, got)) == want
    assert minmax.components(none).count() == 0


def test_clusters_and_leaders_find_the_same(docs, monkeypatch):
    once = sorted(map(tuple, minmax.components(docs, 3, 85).filter("doc_id >= 0").collect()))
    settled = minmax._settled
    monkeypatch.setattr(minmax, "_settled",
                        lambda m, s, p, c, n: settled(m, s, p, 0, n))  # no cluster is small
    assert sorted(map(tuple, minmax.components(docs, 3, 85).filter("doc_id >= 0").collect())) == once


def test_one_of_each_keeps_all_columns(docs):
    kept = minmax.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.filter("doc_id = 3").count() == 1 and kept.filter("text = 'One'").count() == 0


def test_language_model_scores(docs, none):
    rows = raw(made())
    tok = [t.encode().lower().split() + ["end"] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    c, pairs, hist = Counter(), Counter(), Counter()
    for t, h in zip(tok, held):
        if not h:
            c.update(t)
            pairs.update(zip(["start"] + t, t))
            hist["start"] += 1
    n, v = sum(c.values()), len(c)
    hist.update(c)
    p = {w: (c[w] + 0.5) / (n + 0.5 * (v + 1)) for t in tok for w in t}
    want = sorted((i is not None, i or 0, h, len(t), sum(c[w] > 0 for w in t), n,
                   round(sum(math.log10(p[w]) for w in t), 6),
                   round(sum(math.log10((pairs[a, w] + 200 * p[w]) / (hist[a] + 200))
                             for a, w in zip(["start"] + t, t)), 6))
                  for (i, _), t, h in zip(rows, tok, held))
    got = sorted((r[0] is not None, r[0] or 0, *r[1:5], round(r[5], 6), round(r[6], 6))
                 for r in backoff.scores(docs, shard_bytes=20_000).collect())
    for a, b in zip(got, want):
        assert a[:6] == b[:6] and a[6:] == pytest.approx(b[6:], abs=1e-5)
    assert len(got) == len(want) and backoff.scores(none).count() == 0


def covered(rows, length: int) -> Counter:
    seen = Counter()
    data = [t.encode() for _, t in rows]
    for d in data:
        seen.update(d[i:i + length] for i in range(len(d) - length + 1))
    out = Counter()
    for (i, _), d in zip(rows, data):
        gone = np.zeros(len(d) + 1, bool)
        for s in range(len(d) - length + 1):
            if seen[d[s:s + length]] > 1:
                gone[s:s + length] = True
        gone = gone[:len(d)]
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i, len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("most_contexts", [5000, 1])
def test_repeats_are_those_of_all_windows(docs, none, most_contexts):
    got = repeats.digest(docs, 400, most_contexts=most_contexts).collect()
    assert Counter(map(tuple, got)) == covered(raw(made()), 400)
    assert repeats.digest(none, 400).count() == 0


def test_cutting_keeps_columns_and_whole_characters(docs):
    cut = repeats.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert cut.filter("doc_id = 1000").first().text is None


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(600, 12)).round(3)
    v[7] = v[8] = v[9]
    rows = [(i, [float(x) for x in a]) for i, a in enumerate(v)]
    odd = [(700, None), (720, [0.0] * 12), (740, [None] + [1.0] * 11), (760, [math.nan] * 12),
           (780, [1.0]), (None, [1.0] * 12)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(4)
    got = forest.search(df, "vec_id % 20 = 0").collect()
    hits = 0
    for q in range(0, 600, 20):
        s = (v * v[q]).sum(axis=1)
        best = [i for i in sorted(range(600), key=lambda i: (-s[i], i)) if i != q][:20]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 21))
        assert all(r.score == pytest.approx(s[r.vec_id], abs=1e-12) for r in own)
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        hits += len({r.vec_id for r in own} & set(best))
    assert {r.query_id for r in got} == set(range(0, 600, 20)) and hits >= 0.9 * 600
    few = forest.search(df.filter("vec_id < 5"), "vec_id = 0").collect()
    assert [r.rank for r in sorted(few, key=lambda r: r.rank)] == [1, 2, 3, 4]
    assert forest.search(df.filter("vec_id > 5000"), "vec_id = 0").count() == 0


def test_order_fingerprints(docs, none):
    rows = sorted({(i, t) for i, t in raw(made()) if i is not None})
    df = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in orderhash.with_edits(df).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        new = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        a, b, c = orderhash.fingerprints([orderhash.kmers(x.encode()) for x in (t, new, after)])
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert (r.near_edited, r.near_next) == ((a == b).mean(), (a == c).mean())
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1)
    assert got[0].fingerprint == got[44].fingerprint and orderhash.with_edits(none).count() == 0
    alone = orderhash.with_edits(df.filter("doc_id = 1")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1


def test_moved_passages_lower_the_likeness():
    words = [f"w{i}" for i in range(400)]
    moved = words[200:] + words[:200]
    near = [*words[:50], "other", *words[51:]]
    a, b, c = orderhash.fingerprints([orderhash.kmers(" ".join(x).encode())
                                      for x in (words, moved, near)])
    assert (a == b).mean() < 0.75 < (a == c).mean()


@pytest.mark.parametrize("target", [{"entropy": 0.97}, {"repeats": 2.0}, {"entropy": 0.5}])
def test_mixing_meets_its_target(docs, none, target):
    got = mixing.mixed(docs, **target).collect()
    assert len(got) == docs.count() and mixing.mixed(none, **target).count() == 0
    have, taken, weight = Counter(), Counter(), {}
    for r in got:
        have[r.source] += r.n_tokens
        taken[r.source] += r.n_tokens * r.copies
        weight[r.source] = r.weight
    total = sum(have.values())
    assert sum(weight.values()) == pytest.approx(1)
    for s, w in weight.items():
        assert taken[s] <= w * total + 1e-6
        most = max([r.n_tokens for r in got if r.source == s])
        assert w * total - taken[s] <= most + 1
    p = [w for w in weight.values() if w]
    if "entropy" in target:
        assert -sum(w * math.log(w) for w in p) >= target["entropy"] * math.log(len(p)) - 1e-9
    else:
        assert all(w * total <= 2.0 * have[s] * (1 + 1e-5) for s, w in weight.items() if have[s])


def test_remixing_repeats_rows(docs):
    copies = {(r.doc_id, r.source): r.copies for r in mixing.mixed(docs, entropy=0.97).collect()}
    out = mixing.remixed(docs, entropy=0.97)
    assert out.columns == docs.columns
    assert {tuple(r)[:2]: r["count"] for r in out.groupBy("doc_id", "source").count().collect()
            if r.doc_id not in (3,)} == {k: c for k, c in copies.items() if c and k[0] != 3}


def test_trees_and_net_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality.fit(x[:1500], y[:1500], trees=40)
    assert ((model.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.9
    one = quality.fit(x[:10], np.ones(10))
    assert (one.score(x[:3]) > 0.9).all()
    texts = [b" ".join(rng.choice([b"mild", b"calm", b"tea", b"the"], 30)) for _ in range(400)]
    bad = rng.random(400) < 0.5
    texts = [t + b" badword" * int(b) for t, b in zip(texts, bad)]
    net = toxicity.fit(toxicity.words(texts[:300]), bad[:300].astype(float), np.ones(300))
    assert ((net.score(texts[300:]) >= 0.5) == bad[300:]).mean() > 0.95
    assert 0 <= net.score([b""])[0] <= 1


def test_classifiers_score_every_row(docs, none, spark):
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(40)] + [(1, None, None)],
                                   "doc_id long, quality int, toxic int")
    trees, net = quality.learnt(docs, labels), toxicity.learnt(docs, labels)
    for scored, cut in ((quality.scores(docs, trees), 0.3), (toxicity.scores(docs, net), 0.5)):
        rows = scored.collect()
        assert len(rows) == docs.count()
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= cut) for r in rows)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
                   for r in rows if r.doc_id is not None)
    kept = quality.keep_good(docs, trees)
    good = quality.scores(docs, trees).filter("predicted = 1").count()
    assert kept.columns == docs.columns and kept.count() == good
    assert quality.scores(none, quality.learnt(none, labels)).count() == 0
    assert toxicity.scores(none, toxicity.learnt(none, labels)).count() == 0


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline
    sf_dir = "/root/testdata/sf0.001"
    source = docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == source.columns, name
            docs = docs.cache()
    assert docs.agg(F.sum("length")).first()[0] > 0
