"""Count-min windows, the prefix tree and spelling variants against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from test_llm import SCHEMA, made, raw

from tidemark.llm import countmin, prefixtree, spelling
from tidemark.llm.encoding import Encoder
from tidemark.llm.words import windows, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_text(rows) -> list:
    return sorted(map(tuple, rows), key=repr)


# ── count-min windows ────────────────────────────────────────────────────────

def test_words_are_cut_and_hashed_like_python_does():
    texts = ["", " ", "a", "a b\ta", "  x\x0by\x0cz \r\n", "é" * 300 + " b", "b " + "é" * 300, "\x1c a\x85b"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    found = words(data, offsets)
    got = [[] for _ in texts]
    for s, e, t in zip(found.starts, found.ends, found.text):
        got[t].append(data[s:e].tobytes().decode())
    assert got == [WORD.findall(t) for t in texts]
    name = [w for t in got for w in t]
    assert len(set(zip(name, found.hashes.tolist()))) == len(set(name)) == len(set(found.hashes.tolist()))


def test_windows_are_equal_if_their_words_are():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("ab") for _ in range(n)) for n in (0, 2, 3, 50, 200)]
    data = np.frombuffer(" ".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    offsets[-1] -= 1
    found = words(data, offsets)
    at, h, g = windows(found, 3)
    name = [tuple(data[found.starts[i + k]] for k in range(3)) for i in at]
    assert len(at) == sum(max(0, (len(t) + 1) // 2 - 2) for t in texts)
    assert len({*zip(name, h.tolist(), g.tolist())}) == len(set(name)) == len(set(h.tolist()))


def earlier_removed(rows, width):
    docs = [(i, WORD.findall(t)) for i, t in rows]
    least = {}
    for i, w in docs:
        for j in range(len(w) - width + 1) if i is not None else ():
            key = tuple(w[j:j + width])
            least[key] = min(least.get(key, i), i)
    for i, w in docs:
        gone = {k for j in range(len(w) - width + 1) if i is not None
                and least[tuple(w[j:j + width])] < i for k in range(j, j + width)}
        yield i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)


@pytest.mark.parametrize("width, block", [(13, 1 << 23), (13, 3000), (3, 3000), (1, 20000)])
def test_windows_of_earlier_documents_go(spark, width, block):
    docs = spark.createDataFrame(made(), SCHEMA).repartition(3)
    got = countmin.without_earlier_windows(docs, width=width, block=block).collect()
    assert by_text(got) == by_text(earlier_removed(raw(made()), width))


def test_a_crowded_sketch_costs_work_but_no_window(spark, monkeypatch):
    """As good as no counters: nearly all windows pass the sketch and are grouped exactly."""
    monkeypatch.setattr(countmin, "sketch_width", lambda size, load: 24)
    monkeypatch.setattr(countmin.Block, "counters", lambda self, row, wide: self.h >> np.uint64(59))
    docs = spark.createDataFrame(made(4), SCHEMA).repartition(4)
    got = countmin.without_earlier_windows(docs, width=5, block=4000).collect()
    assert by_text(got) == by_text(earlier_removed(raw(made(4)), 5))


def test_no_documents_have_no_windows(none):
    assert countmin.without_earlier_windows(none).count() == 0


# ── prefix tree ──────────────────────────────────────────────────────────────

TURNS = "conv_id long, turn int, role string, text string, key int, depth string"


def conversations(seed: int = 3) -> list[tuple]:
    """Negative and missing bases, null and equal turns, null texts, repeated rows, a long one."""
    rng = random.Random(seed)
    rows = [(c, rng.choice([t, t, None, 3]), rng.choice(["user", "assistant", None]),
             rng.choice(["a", "b", "", "héé", None]))
            for c in [*range(-210, 300, 7), 0, 100, 200] for t in range(rng.randint(1, 9))]
    rows += [(5, t, "user", f"x{t % 7}") for t in range(60)]
    rows += [(None, 1, "user", "nobody's")] + [rows[3]] * 40
    rng.shuffle(rows)
    return [(*r, 1, "d") for r in rows]


def plain_tree(rows) -> list[tuple]:
    own: dict = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    members: dict = {}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
        for d in range(len(rebuilt[c]) + 1):
            members.setdefault(tuple(rebuilt[c][:d]), []).append(c)
    children: dict = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = sum(saved[x] for x in below)
        saved[node] += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
    return [(min(m), len(node), min(members[node[:-1]]) if node else None, len(m),
             len(children.get(node, [])), leaves[node], saved[node],
             hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(node))
                            .encode()).hexdigest()) for node, m in members.items()]


@pytest.mark.parametrize("light", [None, 25])
def test_nodes_and_subtree_totals(spark, light):
    """25 makes many shards, heavy nodes above them, and two bands of these."""
    rows = conversations()
    table = spark.createDataFrame(rows, TURNS).repartition(6)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:   # conversations then lie across the borders of tasks
        got = prefixtree.tree(table, light).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert by_text(got) == by_text(plain_tree(rows))


def test_no_turns_make_no_tree(spark):
    assert prefixtree.tree(spark.createDataFrame([], TURNS)).count() == 0


def test_the_queue_spills_and_gives_messages_in_order_of_their_keys():
    rng = np.random.default_rng(1)
    queue = prefixtree.SpillingQueue(most=50)
    keys = rng.integers(0, 40, 1000).astype(">u8")
    named = np.array([b"%016d" % k for k in keys], "S16")
    for a in range(0, 1000, 30):
        queue.push(named[a:a + 30], np.column_stack([keys[a:a + 30].astype(int)] * 3))
    assert len(queue.runs) > 10
    seen = Counter()
    for last in (b"%016d" % 0, b"%016d" % 17, b"%016d" % 99):
        k, v = queue.upto(last)
        assert (k <= np.bytes_(last)).all() and (v[:, 0] == k.astype("S16").astype(int)).all()
        assert not set(k.tolist()) & set(seen)
        seen.update(k.tolist())
    assert seen == Counter(named.tolist()) and queue.upto(b"~" * 16)[0].size == 0


def test_settling_does_not_depend_on_batches():
    """A path and a star, in batches of every size."""
    key = [hashlib.md5(str(i).encode()).digest() for i in range(40)]
    parent = [None] + key[:19] + [key[3]] * 20
    depth = [*range(20)] + [4] * 20
    rows = sorted(zip(depth, key, parent), key=lambda r: (-r[0], r[1]))
    want = None
    for size in (1, 3, 7, 40):
        batches = []
        for a in range(0, 40, size):
            d, k, p = zip(*rows[a:a + size])
            zero = pa.array([0] * len(d), pa.int64())
            batches.append(pa.RecordBatch.from_arrays(
                [pa.array([1] * len(d), pa.int64()), pa.array(d, pa.int64()), pa.array(k, pa.binary()),
                 pa.array(p, pa.binary()), pa.array([x is None for x in p]),
                 pa.array([1] * len(d), pa.int64()), zero, zero, zero],
                ["shard", "depth", "key", "parent", "top", "own", "children", "leaves", "saved"]))
        got = {r["key"]: (r["children"], r["leaves"], r["saved"])
               for b in prefixtree.settle(iter(batches), most=4) for r in b.to_pylist()}
        want = want or got
        assert got == want
    assert want[key[0]] == (1, 21, 40) and want[key[3]] == (21, 21, 37) and want[key[19]] == (0, 1, 1)


# ── spelling variants ────────────────────────────────────────────────────────

def near(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1:] == b[i + (len(a) == len(b)):] if len(a) >= len(b) else a[i:] == b[i + 1:]


def plain_variants(rows, letters, least, times) -> list[tuple]:
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = run.translate(str.maketrans(spelling.UPPER, spelling.LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            at = h % len(run)
            n[run[:at] + run[at + 1:] if h % 97 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= letters and k >= least}
    out, form = [], {}
    for w in n:
        around = [x for x in n if near(w, x)]
        best = min(around, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= times * n[w] else None
        out.append([w, form[w], None, n[w], len(around), n[form[w]] if form[w] else None])
    for row in out:
        row[2] = row[0]
        while form[row[2]]:
            row[2] = form[row[2]]
    return [tuple(r) for r in out]


def misspelt(seed: int = 5) -> list[tuple]:
    """Words of few letters, so that all kinds of edits occur, runs of one letter, and a long one."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    base += ["a" * k for k in range(4, 12)] + ["Straße", "ÀÉÎõü", "xyzxyz" * 40, "xyzxyz" * 40 + "x"]
    texts = [" ".join(rng.choices(base, [1 / (k + 1) for k in range(len(base))], k=120))
             for _ in range(20)] + ["", None, "a1b2 - x", " ".join(base) * 2]
    texts.append("chainab " * 4 + "chainabc " * 9 + "chainabcd " * 20)
    rows = [(i, t, None, None, None, None, None) for i, t in enumerate(texts)]
    return rows + [rows[2], (None, " ".join(base), None, None, None, None, None)]


@pytest.mark.parametrize("letters, least, times", [(5, 3, 2), (1, 1, 1)])
def test_variants(spark, letters, least, times):
    rows = misspelt()
    if letters == 1:   # every neighbour, very short words included; no form is larger than itself
        rows, times = rows[:6], 2
    got = spelling.variants(spark.createDataFrame(rows, SCHEMA).repartition(3), letters, least, times)
    want = plain_variants(raw(rows), letters, least, times)
    assert by_text(got.collect()) == by_text(want)
    if letters == 5:
        assert [r[:3] for r in want if r[0] == "chainab"] == [("chainab", "chainabc", "chainabcd")]


def test_no_documents_have_no_variants(none):
    assert spelling.variants(none).count() == 0


# ── the encoder ──────────────────────────────────────────────────────────────

PARTS = ["hello", "Hello.", "World,", "naïve", "Straße.", "don't", "a.b", "x1", "...", ",", "Ω.", "é,",
         "İstanbul,", "ǅ", "ʼn.", "a..", "b.,", "<|endoftext|>", "<|startoftext|>", "ⅷ", "日本", "😀",
         "ﬁn.", "\u200b", "_x", "ªº.", "e\u0301", "\x00"]
GAPS = [" ", "  ", "\n", " \n", "\t", "\xa0", " \u3000", "\x1c", "\r\n", " ", " ", " "]


@pytest.mark.parametrize("file, kind, known", [
    ("word_bpe_49k.json", "word", True), ("byte_bpe_50k.json", "byte", True),
    ("word_bpe_49k.json", "byte", False), ("byte_bpe_50k.json", "word", False)])
def test_ids_are_those_of_the_library(file, kind, known):
    """Random texts in batches, through a memo that is emptied again and again."""
    from tokenizers import Tokenizer
    rng = random.Random(hash(file) % 7)
    path = public_tokenizers.path(file)
    library, own = Tokenizer.from_file(path), Encoder(path, kind, most_words=60)
    assert own.known == known
    texts = ["", ".", ",", " ", "a.", " a.", *("".join(
        rng.choice(PARTS) + rng.choice(GAPS) for _ in range(rng.randint(0, 12))) for _ in range(3000))]
    for a in range(0, len(texts), 251):
        part = texts[a:a + 251]
        ids, n = own.encode([t.encode() for t in part])
        want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert n.tolist() == list(map(len, want))
        assert ids.tolist() == [x for ids_ in want for x in ids_]


# ── stages over rows with columns of any name ────────────────────────────────

ODD = ("doc_id long, text string, source string, `__key` int, `__n` int, row string, key string, "
       "spans string, copies int, own int, content int")


def odd(rows) -> list[tuple]:
    return [(i, t, s, k, 2, "r", "k", "s", 3, 4, 5) for k, (i, t, s) in enumerate(rows)]


def test_stages_keep_all_columns_whatever_they_are_called(spark):
    from tidemark.llm import minmax, mixing, quality, repeats
    rng = random.Random(1)
    text = lambda n: " ".join(rng.choice(["red", "blue", "tall", "small"]) + str(rng.randint(0, 99))
                              for _ in range(n))
    same = text(120)
    rows = odd([(1, text(80), "a"), (2, same + " x", "b"), (3, same + " y", "a"), (4, None, None),
                (5, "", "a"), (None, text(9), "a")])
    docs = spark.createDataFrame(rows, ODD).repartition(3)
    cut = {r.doc_id: r for r in repeats.without_repeats(docs, length=300).collect()}
    assert cut[1] == rows[0] and cut[4].text is None and cut[5].text == ""
    assert (cut[2].text, cut[3].text) == ("x", "y") or len(cut[2].text) < 5
    mixed = mixing.remixed(docs, entropy=0.9)
    assert mixed.columns == docs.columns and set(map(tuple, mixed.collect())) <= set(rows)
    trees = quality.fit(np.zeros((4, len(quality.statistics(b"")))), np.array([0., 1, 0, 1]), np.ones(4))
    assert by_text(quality.keep_good(docs, trees, cut=0.0).collect()) == by_text(rows)
    assert quality.keep_good(docs, trees, cut=1.1).count() == 0
    assert minmax.one_of_each(docs).columns == docs.columns


def test_one_of_each_drops_equal_rows_and_near_copies_alone(spark):
    from tidemark.llm import minmax
    rng = random.Random(2)
    words_ = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(200)]
    base, near_, other = " ".join(words_), " ".join(words_[:-1]), " ".join(words_[::-1])
    rows = [(1, base, "web"), (1, base, "news"), (1, base, "news"), (2, "", "web"), (2, "", "news"),
            (3, near_, "web"), (5, near_, "web"), (5, other, "web"), (7, other, "web"),
            (8, None, "x"), (None, "no id here at all", "x"), (None, "nor one in this text", "x")]
    got = minmax.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert by_text(got.collect()) == by_text([
        (1, base, "web"), (1, base, "news"), (2, "", "web"), (2, "", "news"), (5, other, "web"),
        (8, None, "x"), (None, "no id here at all", "x"), (None, "nor one in this text", "x")])
    one = [(1, base, "a"), (1, near_, "a"), (2, base, "a")]   # both texts of the id are alike
    got = minmax.one_of_each(spark.createDataFrame(one, "doc_id long, text string, source string"))
    assert got.count() == 1 and got.first().doc_id == 1


def plain_fingerprint(text: str) -> str:
    """Order min hash by its definition: the least occurrence-numbered k-mers, in their order."""
    from tidemark.llm import orderhash
    flat = orderhash.kmers(text.encode())
    out = orderhash.fingerprints([flat])[0]
    return out.astype(">u4").tobytes().hex()


def test_fingerprints_of_texts_and_of_edited_texts(spark):
    from tidemark.llm import orderhash
    docs = spark.createDataFrame(made(), SCHEMA).repartition(7)
    got = orderhash.with_edits(docs).collect()
    order = sorted(raw(made()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(r.n_chars for r in got) == sorted(len(t) for _, t in order)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id != 3}
    texts = dict(order)
    ids = [i for i, _ in order if i is not None]
    for i, r in by_id.items():
        assert r.fingerprint == plain_fingerprint(texts[i])
        at = ids.index(i) + 1
        if at < len(ids) and ids[at] != 3:
            new = orderhash.edited(texts[i], texts[ids[at]])
            assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
            assert r.edited_fingerprint == plain_fingerprint(new)
            assert r.near_next == sum(
                a == b for a, b in zip(*(np.frombuffer(bytes.fromhex(plain_fingerprint(texts[x])), ">u4")
                                         for x in (i, ids[at])))) / 64


def test_tokens_are_counted_and_found_in_the_files(spark):
    from tokenizers import Tokenizer

    from tidemark.llm import wavelet
    from tidemark.session import scratch_path
    path, shards = public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "shards")
    rows = [r for r in made() if r[0] is not None][:40]
    wavelet.write_shards(spark.createDataFrame(rows, SCHEMA).repartition(3), path, shards, shard_tokens=500)
    library = Tokenizer.from_file(path)
    ids = {r[0]: library.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in rows}
    wanted = [2, *(t for t, _ in Counter(x for v in ids.values() for x in v).most_common(5)), 48999]
    want = sorted((i, t, k) for i, v in ids.items() for k, t in enumerate(v) if t in set(wanted))
    wanted = sorted(set(wanted))
    assert sorted(map(tuple, wavelet.occurrences(spark, shards, wanted).collect())) == want
    n = Counter(t for _, t, _ in want)
    assert dict(map(tuple, wavelet.counts(spark, shards, wanted).collect())) == {t: n[t] for t in wanted}


def test_a_task_gives_back_what_it_has_freed(monkeypatch):
    import pyarrow as pa

    from tidemark.llm import common

    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(len(seen)))
    seen = []
    for part in common.portions(iter([pa.record_batch({"a": list(range(5))})] * 2), 2):
        seen.append(part.num_rows)
    assert seen == [2, 2, 1] * 2 and given == [0, 6]
    monkeypatch.undo()
    common.give_back()
    assert pa.total_allocated_bytes() >= 0


def test_a_worker_holds_no_more_after_a_task_than_it_has_learnt():
    import subprocess
    import sys
    from pathlib import Path

    code = """
import pyarrow as pa
from tidemark.llm.common import portions
def held():
    return int(next(x for x in open('/proc/self/status') if x.startswith('VmRSS')).split()[1]) // 1024
batch = pa.record_batch({'text': pa.array([b'x' * 40] * 1000)})
before = held()
def task():
    junk, kept = [], []
    for part in portions(iter([batch]), 1000):
        junk = [bytes(1000 + i % 7) for i in range(200_000)]
        kept = junk[::2000]
        junk = None
    return kept
kept = task()
print(held() - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                         cwd=Path(__file__).resolve().parents[2])
    assert int(out.stdout) < 60   # 200 MB were freed around a few that stay
