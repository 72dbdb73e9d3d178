"""Encoding with a public tokenizer, one call per new word instead of one per document.

Both supported files cut a text at white space before they merge anything, so the ids of a text are
those of its pieces, one after the other, and each piece needs to be encoded once. Pieces are kept
in a memo of bounded size, which a Python worker keeps from task to task; when it is full, those
met only once are forgotten. Texts in which a blank meets other white space, where the byte-level
cut looks ahead, are given to the tokenizer whole.

A piece that is one run of Latin letters, perhaps with a full stop or comma after it, is known
to be cut there and nowhere else. The mark is a piece of its own then, so a word needs to be learnt
once and not with each mark, and new runs of letters are given to the tokenizer's merge model
directly. Pieces are looked at by Arrow kernels and whole lists; nothing is done word by word but to
look up what the memo has.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import keeps, ranges

#: A blank before a byte that is, or may begin, white space of any script.
_LOOKS_AHEAD = re.compile(rb" [\x09-\x0d\x1c-\x20\xc2\xe1-\xe3]")


#: Latin letters below U+0250, but for the dotted capital I, which lower case splits in two.
_LETTERS = r"[A-Za-zªµºÀ-ÖØ-öø-įı-ɏ]+"


# The make-up of tokenizers whose cuts are known here (normalizer, pre-tokenizer).
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
_MADE = {
    "byte": (None, {**_BYTES, "use_regex": True}),
    "word": (
        {"type": "Sequence", "normalizers": [
            {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"}]},
        {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "behavior": "Removed", "invert": True, "pattern": {"Regex":
                r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}},
            {**_BYTES, "use_regex": False}]}),
}


@cache
def encoder(path: str, kind: str) -> Encoder:
    """The worker's own encoder, with what it has learnt in earlier tasks."""
    return Encoder(path, kind)


keeps("encoding", encoder.cache_clear)


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte: itself if printable, else one from 256 onwards."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """`kind` "word": white space is dropped; "byte": a blank belongs to the word after it.

    `encode` gives the ids of all texts in one array, and how many each text has. Special tokens
    spelled in a text are encoded as the library does by default. A tokenizer of another make-up than
    its kind has is given all texts whole.
    """

    def __init__(self, path: str, kind: str, most_words: int = 600_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer, pre_tokenizers

        if kind not in ("word", "byte"):
            raise ValueError(f"unknown kind {kind}")
        self.full, self.merges = Tokenizer.from_file(path), Tokenizer.from_file(path)
        made = json.loads(self.full.to_str())
        self.known = (made["normalizer"], made["pre_tokenizer"]) == _MADE[kind]
        self.merges.normalizer = None
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([])
        self.special = re.compile(b"|".join(
            re.escape(t.content.encode()) for t in self.full.get_added_tokens_decoder().values()
        ) or rb"(?!)")
        self.width = np.uint16 if self.full.get_vocab_size() <= 1 << 16 else np.uint32
        self.kind, self.most_words = kind, most_words
        self.lead = b" " if kind == "byte" else b""
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items() if b != 10})
        self.memo: dict[bytes | tuple[bytes], int] = {}
        self.flat = np.zeros(0, self.width)
        self.starts = self.lengths = self.met = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the pieces met more than once, unless these alone are too many."""
        keep = np.flatnonzero(self.met > 1)
        if len(keep) > self.most_words // 2:
            keep = keep[:0]
        kept = set(keep.tolist())
        self.memo = {w: i for i, w in enumerate(
            w for i, w in enumerate(self.memo) if i in kept)}
        n = self.lengths[keep]
        self.flat = self.flat[ranges(self.starts[keep], n)]
        self.starts, self.lengths = np.cumsum(n) - n, n
        self.met = np.zeros(len(keep), np.int64)

    def _library(self, batch: list[str]) -> list[list[int]]:
        return [e.ids for e in self.full.encode_batch_fast(batch, add_special_tokens=False)]

    def _ids(self, pieces: list[bytes | tuple[bytes]]) -> list[list[int]]:
        """Ids of new pieces; one in a tuple stands as it is, others follow a blank if `lead`."""
        out: list[list[int]] = [[]] * len(pieces)
        plain = pa.array([None if isinstance(p, tuple) else p for p in pieces], pa.large_binary())
        fast = pc.fill_null(pc.match_substring_regex(
            plain.cast(pa.large_string(), safe=False), f"^{_LETTERS}$"), False).to_numpy(zero_copy_only=False)
        slow = np.flatnonzero(~fast).tolist()
        texts = [p[0].decode("utf-8", "replace") if isinstance(p, tuple)
                 else self.lead.decode() + p.decode("utf-8", "replace")
                 for p in map(pieces.__getitem__, slow)]
        for i, ids in zip(slow, self._library(texts)):
            out[i] = ids
        fast = np.flatnonzero(fast).tolist()
        if fast:
            joined = (b"\n" + self.lead).join([b"", *map(pieces.__getitem__, fast)])[1:]
            if self.kind == "word":
                joined = joined.decode().lower().encode()
            bare = joined.decode("latin-1").translate(self.letters).split("\n")
            for i, one in zip(fast, self.merges.encode_batch_fast(bare, add_special_tokens=False)):
                out[i] = one.ids
        return out

    def _codes(self, pieces: list) -> np.ndarray:
        """Numbers of different pieces, new ones counted on."""
        memo = self.memo
        codes = np.fromiter(map(memo.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(codes < 0)
        codes[new] = np.arange(len(memo), len(memo) + len(new))
        memo.update(zip(map(pieces.__getitem__, new.tolist()), codes[new].tolist()))
        return codes

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if not self.known:
            whole = self._library([t.decode("utf-8", "replace") for t in texts])
            n = np.fromiter(map(len, whole), np.int64, len(whole))
            return np.fromiter(chain.from_iterable(whole), self.width, int(n.sum())), n
        if len(self.memo) > self.most_words:
            self._forget()
        memo, known = self.memo, len(self.memo)
        heads: list[int] = []  # code of what stands first in a text as it is, or -1
        tails: list[bytes | None] = []
        for text in texts:
            head: bytes | None = None
            if self.special.search(text) or self.lead and _LOOKS_AHEAD.search(text):
                head, tail = text, None
            elif self.lead:
                at = text.find(b" ")
                head, tail = (text, None) if at < 0 else (text[:at], text[at + 1:])
            else:
                tail = text
            heads.append(-1 if head is None else memo.setdefault((head,), len(memo)))
            tails.append(tail)
        tail = pa.array(tails, pa.large_binary())
        if not self.lead:
            tail = pc.ascii_lower(tail.cast(pa.large_string(), safe=False))
        words = (pc.split_pattern(tail, " ") if self.lead
                 else pc.ascii_split_whitespace(tail).cast(pa.large_list(pa.large_binary())))
        counts = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
        coded = words.flatten().dictionary_encode()
        pieces, at = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        closed = pc.fill_null(pc.match_substring_regex(pieces.cast(pa.large_string(), safe=False),
                                                       f"^{_LETTERS}[.,]$"), False)
        stems = pc.if_else(closed, pc.binary_slice(pieces, 0, -1), pieces).dictionary_encode()
        own = self._codes(stems.dictionary.to_pylist())[stems.indices.to_numpy(zero_copy_only=False)]
        marks = self._codes([(b".",), (b",",)])
        mark = marks[pc.equal(pc.binary_slice(pieces, -1), b",").cast(pa.int8())
                     .to_numpy(zero_copy_only=False)]
        closed = closed.to_numpy(zero_copy_only=False)

        # each text: the head, if it has one, then its pieces, each with its mark, if it has one
        first = np.array(heads, np.int64)
        wide = 1 + closed[at].astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(wide)])
        within = np.concatenate([[0], np.cumsum(counts.astype(np.int64))])
        counts = upto[within[1:]] - upto[within[:-1]] + (first >= 0)
        upto = np.concatenate([[0], np.cumsum(counts)])
        flat = np.repeat(own[at], wide)
        flat[np.cumsum(wide)[wide > 1] - 1] = mark[at[wide > 1]]
        codes = np.empty(upto[-1], np.int64)
        rest = np.ones(len(codes), bool)
        rest[upto[:-1][first >= 0]] = False
        codes[~rest] = first[first >= 0]
        codes[rest] = flat

        new = self._ids(list(islice(memo, known, None)))
        n = np.fromiter(map(len, new), np.int64, len(new))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(n) - n])
        self.lengths = np.concatenate([self.lengths, n])
        self.flat = np.concatenate([self.flat, np.fromiter(
            chain.from_iterable(new), self.width, int(n.sum()))])
        self.met = np.append(self.met, np.zeros(len(new), np.int64))
        self.met += np.bincount(codes, minlength=len(memo))

        n = self.lengths[codes]
        ends = np.concatenate([[0], np.cumsum(n)])
        return self.flat[ranges(self.starts[codes], n)], np.diff(ends[upto])
