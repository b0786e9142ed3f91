"""Texts in chunks that a tokenizer treats alike wherever they stand, each encoded once.

A chunk is a run of white space with the run of other characters after it. A
byte-level tokenizer starts a new part at each change from other characters to
white space, and what it makes of a run of white space depends only on the
character after it, so a text's ids are its chunks' ids in order.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable

import numpy as np

from drawloom.llm.common import once
from drawloom.llm.names import ranges

#: The characters with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(rf"[{WHITE}]*+[^{WHITE}]++|[{WHITE}]++")
# as above, but a carriage return after other characters doesn't end a chunk: vocabularies hold pieces like ';\r'
_CHUNK_CR = re.compile(rf"[{WHITE}]*+[^{WHITE}]++(?:\r[{WHITE}]*+[^{WHITE}]*+)*+|[{WHITE}]++")


_LETTERS = "À-ÖØ-öø-ÿĀ-įĴ-ňŊ-ž"
_PLAIN = re.compile(rf"[\t-\r\x20-~{_LETTERS}]*+")
# how a byte-level tokenizer parts texts, over the characters of _PLAIN
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z{_LETTERS}]+| ?[0-9]+| ?[^\s0-9A-Za-z{_LETTERS}]+|\s+(?!\S)|\s+")


def chunks(text: str) -> list[str]:
    """text in chunks; where all its characters are plain, in the tokenizer's own parts, of which there are fewer different ones."""
    return (_PARTS if _PLAIN.fullmatch(text) else _CHUNK).findall(text)


def chunks_cr(text: str) -> list[str]:
    return (_CHUNK_CR if "\r" in text else _CHUNK).findall(text)


class Store:
    """Numbers of chunks in the order they came, with what `fill` made of each; emptied when it holds over `most` chunks or `most_chars` characters."""

    def __init__(self, fill: Callable[[list[str]], None], clear: Callable[[], None], most: int = 600_000, most_chars: int = 16 << 20):
        self.fill, self.clear, self.most, self.most_chars = fill, clear, most, most_chars
        self.place: dict[str, int] = {}
        self.chars = 0

    def trim(self) -> None:
        if len(self.place) > self.most or self.chars > self.most_chars:
            self.place, self.chars = {}, 0
            self.clear()

    def numbers(self, flat: list[str]) -> np.ndarray:
        new = list(set(flat).difference(self.place))
        if new:
            new.sort()  # neighbours take the same merges, which is faster
            self.fill(new)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.chars += sum(map(len, new))
        return np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))


class Grown:
    """A numpy array that grows at its end."""

    def __init__(self, dtype):
        self.a, self.n = np.empty(1 << 12, dtype), 0

    def add(self, x: np.ndarray) -> None:
        end = self.n + len(x)
        if end > len(self.a):
            self.a = np.concatenate((self.a[: self.n], np.empty(max(end, 2 * len(self.a)) - self.n, self.a.dtype)))
        self.a[self.n : end] = x
        self.n = end

    def __getitem__(self, at):
        return self.a[: self.n][at]


class Lists:
    """Lists of numbers, one for each chunk, end to end."""

    def __init__(self, dtype):
        self.dtype = dtype
        self.empty()

    def empty(self) -> None:
        self.values, self.edge = Grown(self.dtype), Grown(np.int64)
        self.edge.add(np.zeros(1, np.int64))

    def add(self, values: np.ndarray, lengths: np.ndarray) -> None:
        self.edge.add(self.values.n + np.cumsum(lengths))
        self.values.add(values)

    def of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of the chunks `at` end to end, and their lengths."""
        first = self.edge[at]
        n = self.edge[at + 1] - first
        return self.values[ranges(first, n)] if len(at) else self.values[:0], n


def byte_letters() -> dict[str, int]:
    """The byte that each printable stand-in of a byte-level vocabulary is for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level(path: str):
    """The tokenizer at path, and whether its texts may be cut into chunks: byte-level parts without a normalizer or added space."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    with open(path) as f:
        d = json.load(f)
    p = d["pre_tokenizer"] or {}
    plain = not d["normalizer"] and not d["post_processor"] and p.get("type") == "ByteLevel" and not p.get("add_prefix_space") and p.get("use_regex") and not d["model"].get("dropout")
    return tok, bool(plain), [t["content"] for t in d["added_tokens"]]


def encoder(path: str):
    """A function from texts to one array of ids and the number of ids of each, equal to encoding each text whole; one in each process."""
    return once(("encoder", path), lambda: _encoder(path))


def _encoder(path: str):
    tok, plain, special = byte_level(path)
    ids = Lists(np.uint32)
    mark, parted = special[0] if special else "", tok.token_to_id(special[0]) if special else None

    def fill(new: list[str]) -> None:
        if parted is None or len(new) == 1:
            got = [np.array(e.ids, np.uint32) for e in tok.encode_batch_fast(new, add_special_tokens=False)]
            ids.add(np.concatenate(got), np.fromiter(map(len, got), np.int64, len(got)))
            return
        # a special token parts texts before anything else is done to them, so that many go in one call
        for i in range(0, len(new), 4096):
            many = np.array(tok.encode_batch_fast([mark.join([*new[i : i + 4096], ""])], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(many == parted)
            ids.add(many[many != parted], np.diff(ends, prepend=-1) - 1)

    store = Store(fill, ids.empty)

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        store.trim()
        # a special token ends a run of white space like the end of the text does, so its texts stay whole
        whole = {i: np.array(tok.encode(t, add_special_tokens=False).ids, np.uint32) for i, t in enumerate(texts) if t and (not plain or any(s in t for s in special))}
        cut = [[] if i in whole else chunks(t) for i, t in enumerate(texts)]
        values, n = ids.of(store.numbers([c for cs in cut for c in cs]))
        ends = np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], np.cumsum([len(cs) for cs in cut]))).astype(np.int64)]
        if whole:
            parts = [whole[i] if i in whole else values[a:z] for i, (a, z) in enumerate(zip(ends[:-1], ends[1:]))]
            return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        return values, np.diff(ends)

    return encode
