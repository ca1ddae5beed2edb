"""Byte-level BPE with exact merges in linear time, for the vocabulary file of a public tokenizer.

A text is split by the tokenizer's pattern; in each piece the longest vocabulary entry at every position comes from one
Aho-Corasick pass. The encoder takes the longest entry, keeps it if it is compatible with the token before it, else tries
the next shorter prefix, else steps back and never comes to that position again. Two tokens are compatible if merging
their joined bytes by rank gives the two again; that is decided from the merge table alone and remembered. A sequence all
of whose neighbours are compatible is the one that merging by rank gives, so the ids are those of the merge algorithm.
Decoding looks bytes up in one table with offsets.

Requires of the file: a byte-level BPE model whose merged tokens are numbered in the order of the merges, and
that splits texts by ``PATTERN`` without a normal form (checked).
"""

from __future__ import annotations

import json
import os
from itertools import chain
from pathlib import Path

import ahocorasick
import numpy as np
import regex

#: Fixed value: the pattern that splits a text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed value: what a file says that splits by this pattern.
SPLIT = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
DEFAULT_FILE = "/opt/tokenizers/byte_bpe_50k.json"
#: A vocabulary goes to every worker; a larger file is refused.
MOST_FILE_BYTES = 64 << 20
#: Pieces remembered with their ids in a worker; beyond that the memory starts anew. Results do not depend on it.
MOST_REMEMBERED = 300_000


def read_file(path: str | None = None) -> bytes:
    path = path or DEFAULT_FILE
    if os.path.getsize(path) > MOST_FILE_BYTES:
        raise ValueError(f"{path} is larger than a vocabulary may be")
    return Path(path).read_bytes()


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabulary files -> the byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Memo(dict):
    """Piece -> ids, encoded when first asked for."""

    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self[piece] = self._encode(piece)
        return ids


class ByteBPE:
    def __init__(self, file: bytes, pattern: str = PATTERN):
        spec = json.loads(file)
        model = spec["model"]
        vocab = model["vocab"]
        alphabet = byte_alphabet()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        n = 1 + max(vocab.values())
        self.left, self.right = list(range(n)), list(range(n))
        self.merged: dict[int, int] = {}
        texts = [""] * n  # the bytes of a token, one character a byte
        for token, i in vocab.items():
            if len(token) == 1 and token in alphabet:
                texts[i] = chr(alphabet[token])
        before = -1
        for a, b in merges:
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if z <= before or z <= max(x, y):
                raise ValueError("the tokens are not numbered in the order of their merges")
            before = z
            self.merged[x << 32 | y] = z
            self.left[z], self.right[z] = x, y
            texts[z] = texts[x] + texts[y]
        self.lengths = [len(t) for t in texts]
        ids = {t: i for i, t in enumerate(texts) if t}
        if len({t for t in texts if len(t) == 1}) != 256:
            raise ValueError("a byte has no token")
        split = spec.get("pre_tokenizer", SPLIT) or {}
        if spec.get("normalizer") or model.get("ignore_merges") or (pattern == PATTERN and {k: split.get(k) for k in SPLIT} != SPLIT):
            raise ValueError("the file asks for another normal form, split or order of merges than this encoder has")
        automaton = ahocorasick.Automaton()
        self.shorter = [-1] * n
        for t, i in ids.items():
            automaton.add_word(t, i)
            for k in range(len(t) - 1, 0, -1):
                if t[:k] in ids:
                    self.shorter[i] = ids[t[:k]]
                    break
        automaton.make_automaton()
        self._matches = automaton.iter
        self._compatible: dict[int, bool] = {}
        blob = "".join(texts).encode("latin-1")
        self.table = np.frombuffer(blob, np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        self._split = regex.compile(pattern).findall
        self._memo = _Memo(self._encode_piece)

    def _decide(self, a: int, b: int) -> bool:
        """Whether no merge across the border of a and b comes before the merges that make them.

        Undoes the youngest merge on either side, step by step; ``bound`` is the merge that the two border tokens must
        outlast. A merge of the border tokens below it would have come first.
        """
        merged, left, right = self.merged, self.left, self.right
        bound = 1 << 62
        while True:
            if merged.get(a << 32 | b, bound) < bound:
                return False
            if a > b:
                bound, a = a, right[a]
                if a == bound:  # a byte: nothing left to undo there
                    bound, b = b + 1, left[b]
                    if b + 1 == bound:
                        return True
            else:
                bound, b = b + 1, left[b]
                if b + 1 == bound:
                    bound, a = a, right[a]
                    if a == bound:
                        return True

    def compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self._compatible.get(key)
        if known is None:
            if len(self._compatible) > 4_000_000:
                self._compatible.clear()
            known = self._compatible[key] = self._decide(a, b)
        return known

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8").decode("latin-1")
        n = len(data)
        if n == 0:
            return ()
        longest = [0] * n
        lengths, shorter, compatible = self.lengths, self.shorter, self.compatible
        for end, token in self._matches(data):
            longest[end + 1 - lengths[token]] = token  # ends come in order, so the longest is the last
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + lengths[token]
            if not dead[end] and (not out or compatible(out[-1], token)):
                out.append(token)
                at = end
                if at == n:
                    return tuple(out)
                token = longest[at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead[at] = 1
                token = out.pop()
                at -= lengths[token]

    def encode(self, text: str | None) -> list[int]:
        """Ids without special tokens, whose texts are ordinary text here. Null and empty texts have no ids."""
        return list(chain.from_iterable(map(self._memo.__getitem__, self._split(text)))) if text else []

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the offsets of the texts in them."""
        get, split = self._memo.__getitem__, self._split
        if len(self._memo) > MOST_REMEMBERED:
            self._memo.clear()
        parts, ends = [], np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if text:
                ids = np.fromiter(chain.from_iterable(map(get, split(text))), np.int32)
                parts.append(ids)
                ends[i + 1] = len(ids)
        return (np.concatenate(parts) if parts else np.array([], np.int32)), np.cumsum(ends)

    def count_all(self, texts: list[str | None]) -> np.ndarray:
        """The number of ids of each text."""
        get, split = self._memo.__getitem__, self._split
        if len(self._memo) > MOST_REMEMBERED:
            self._memo.clear()
        return np.array([sum(map(len, map(get, split(t)))) if t else 0 for t in texts], np.int64)

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all texts one after the other, and the offsets of the texts in them, without a loop over ids."""
        ids = ids.astype(np.int64)
        starts, sizes = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        source = np.arange(total) + np.repeat(starts - (ends - sizes), sizes)
        before = np.concatenate([[0], ends])
        return self.table[source], before[offsets]

    def decode(self, ids: list[int]) -> bytes:
        data, _ = self.decode_all(np.array(ids, np.int64), np.array([0, len(ids)]))
        return data.tobytes()


_loaded: dict[int, ByteBPE] = {}


def load(file: bytes) -> ByteBPE:
    """The tokenizer of a file's content, built once in a worker."""
    key = hash(file)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = ByteBPE(file)
    return _loaded[key]
