"""Sum-of-squares online packing of token sequences into windows.

Each task packs the rows of its own input partition as they come, without a
shuffle: whole windows of a long document go out at once, and what is left of it
goes to the fill level that makes the sum over levels of squared numbers of
partly filled windows least (the fullest of equal ones). The levels are one
array of `window` counts. Partly filled windows wait in the task. At its end, or
when over `waiting` windows wait, they go out as they were filled, from the fullest
on; the room left in each takes pieces of the emptiest windows, which alone are
cut, and the last window is cut into powers of two, so nothing is padded.
A task's state is the counts and at most waiting * window ids, however
many documents it reads.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawloom.llm.common import batch, ddl, keyed, pieces, raw, table
from drawloom.llm.names import ranges

_PIECE = pa.schema([
    ("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("tokens", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])


_LETTERS = "À-ÖØ-öø-ÿĀ-įĴ-ňŊ-ž"  # lower-cased to one letter each and composed already
_PLAIN = re.compile(rf"[\t-\r\x20-~{_LETTERS}]*+")
_PLAIN_WORD = re.compile(rf"[!-~{_LETTERS}]*+")
_SPECIAL = "<|"  # how the names of special tokens begin
# the tokenizer's own split pattern, over the characters of _PLAIN after lower-casing
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LETTERS}]+|[0-9]|[^\sa-z0-9{_LETTERS}]+")


#: How a tokenizer must prepare texts for its parts to be split here.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def _is_plain(path: str) -> bool:
    """Whether the tokenizer splits texts as word_tokenizer() does."""
    with open(path) as f:
        d = json.load(f)
    m = d["model"]
    return (
        d["normalizer"] == _NORMALIZER and d["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTES]} and not d["post_processor"] and not d["truncation"]
        and m["type"] == "BPE" and not m["dropout"] and not m["ignore_merges"] and not m["continuing_subword_prefix"]
        and all(t["content"].startswith(_SPECIAL) and not t["normalized"] for t in d["added_tokens"])
    )


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if it is one, else the next character from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Store:
    """Ids of strings, one after another in one growing array, with the place of each string."""

    def __init__(self, most: int):
        self.most, self.place = most, {}
        self.ids, self.edge, self.n = np.empty(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), 0

    def add(self, key, ids: list[int]) -> None:
        k, end = len(self.place), self.n + len(ids)
        while end > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        if k + 2 > len(self.edge):
            self.edge = np.concatenate((self.edge, np.empty_like(self.edge)))
        self.ids[self.n : end] = ids
        self.place[key], self.edge[k + 1], self.n = k, end, end

    def trim(self) -> None:
        if len(self.place) > self.most:
            self.place, self.n = {}, 0


def word_tokenizer(path: str, end: int | None, words: int = 400_000):
    """A function from texts to id arrays, equal to encoding each text whole and adding `end`.

    For lower-casing vocabularies, which split at white space, letters,
    digits and other signs. Texts of plain characters are split here with the
    same pattern and each distinct part goes to the merges once while it stays in
    the store of about `words` parts. A word with any other character, or that may hold the name of
    a special token, is encoded by the whole tokenizer; so are all texts if the
    tokenizer prepares them in any other way.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tail = np.array([] if end is None else [end], np.uint32)
    if not _is_plain(path):
        tok.no_truncation()
        tok.no_padding()
        return lambda texts: [np.concatenate((np.array(e.ids, np.uint32), tail)) for e in tok.encode_batch([t.decode() for t in texts], add_special_tokens=False)]
    merges = tok.model
    letters = _byte_letters()
    store = _Store(words)

    def parts(text: str) -> list[str]:
        if _PLAIN.fullmatch(text) and _SPECIAL not in text:
            return _PARTS.findall(text.lower())
        out = []
        for w in text.encode().split():  # at ASCII white space only
            w = w.decode()
            # a blank before it marks a word for the whole tokenizer
            out += _PARTS.findall(w.lower()) if _PLAIN_WORD.fullmatch(w) and _SPECIAL not in w else [" " + w]
        return out

    def ids_of(part: str) -> list[int]:
        if part[0] == " ":
            return tok.encode(part[1:], add_special_tokens=False).ids
        if not part.isascii():
            part = "".join(letters[b] for b in part.encode())
        return [t.id for t in merges.tokenize(part)]

    def encode(texts: list[bytes]) -> list[np.ndarray]:
        split = [parts(t.decode()) for t in texts]
        flat = [w for ws in split for w in ws]
        store.trim()
        for w in set(flat).difference(store.place):
            store.add(w, ids_of(w))
        at = np.fromiter(map(store.place.__getitem__, flat), np.int64, len(flat))
        first = store.edge[at]
        n = store.edge[at + 1] - first
        tokens = store.ids[ranges(first, n)] if len(at) else store.ids[:0]
        ends = np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], np.cumsum([len(ws) for ws in split]))).astype(np.int64)]
        return [np.concatenate((tokens[a:z], tail)) for a, z in zip(ends[:-1].tolist(), ends[1:].tolist())]

    return encode


class Packer:
    """Windows of one task; add() and close() give rows of _PIECE without doc_tokens filled in twice."""

    def __init__(self, window: int, first_id: int, waiting: int):
        self.window, self.next, self.most = window, first_id, waiting
        self.count = np.zeros(window + 1, np.int64)  # of waiting windows by fill
        self.open: dict[int, list[list]] = {}  # fill: windows, each the list of its pieces
        self.n_open = 0
        self.placed = 0  # ids that close() has let out in the window they were placed in

    def _out(self, held: list) -> list:
        rows, at = [], 0
        for doc, start, ids, total in held:
            rows.append((doc, start, len(ids), ids.tobytes(), total, self.next, at))
            at += len(ids)
        self.next += 1
        return rows

    def add(self, doc, ids: np.ndarray) -> list:
        rows, n, w, c = [], len(ids), self.window, self.count
        whole = n - n % w
        for a in range(0, whole, w):
            rows += self._out([(doc, a, ids[a : a + w], n)])
        r = n - whole
        if not r:
            return rows
        piece = (doc, whole, ids[whole:], n)
        level, best = 0, 2 * c[r] + 1
        fills = np.flatnonzero(c[: w - r + 1])
        if len(fills):
            rise = 2 * (c[fills + r] - c[fills]) + 2
            if fills[-1] == w - r:
                rise[-1] = 1 - 2 * c[w - r]
            k = len(fills) - 1 - int(np.argmin(rise[::-1]))
            if rise[k] <= best:
                level = int(fills[k])
        if level:
            held = self.open[level].pop()
            c[level] -= 1
            self.n_open -= 1
        else:
            held = []
        held.append(piece)
        if level + r == w:
            return rows + self._out(held)
        self.open.setdefault(level + r, []).append(held)
        c[level + r] += 1
        self.n_open += 1
        return rows + self.close() if self.n_open > self.most else rows

    def close(self) -> list:
        """The waiting windows, fullest first, each filled up from the emptiest; of the last one a sequence for each power of two in its length."""
        rows = []
        held = [w for fill in sorted(self.open, reverse=True) for w in self.open[fill]]
        loose: list = []  # pieces of windows that were taken apart, last first
        i, j = 0, len(held)
        while i < j:
            window, room = held[i], self.window - sum(len(x[2]) for x in held[i])
            i += 1
            while room:
                if not loose:
                    if i == j:
                        break
                    j -= 1
                    loose = held[j][::-1]
                doc, start, ids, total = loose.pop()
                window = [*window, (doc, start, ids[:room], total)]
                if len(ids) > room:
                    loose.append((doc, start + room, ids[room:], total))
                room -= min(room, len(ids))
            if room:
                loose = window[::-1]
            else:
                self.placed += sum(len(x[2]) for x in held[i - 1])
                rows += self._out(window)
        left = sum(len(x[2]) for x in loose)
        for k in range(left.bit_length() - 1, -1, -1):
            part, room = [], (1 << k) & left
            while room:
                doc, start, ids, total = loose.pop()
                part.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    loose.append((doc, start + room, ids[room:], total))
                room -= min(room, len(ids))
            if part:
                rows += self._out(part)
        self.open, self.n_open = {}, 0
        self.count[:] = 0
        return rows


def _pack(path, end, window, waiting):
    def run(batches):
        encode = word_tokenizer(path, end)
        packer = Packer(window, TaskContext.get().partitionId() << 40, waiting)
        for b in pieces(batches, size=1 << 20):
            rows = []
            for doc, ids in zip(b.column("id").to_pylist(), encode(raw(b.column("text")))):
                rows += packer.add(doc, ids)
            if rows:
                yield batch(_PIECE, *zip(*rows))
        rows = packer.close()
        for i in range(0, len(rows), 2000):
            yield batch(_PIECE, *zip(*rows[i : i + 2000]))

    return run


def pack(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int | None = 2, window: int = 4096, waiting: int = 1024) -> DataFrame:
    """One row per piece: id, start, length, tokens (unsigned 32-bit little-endian ids), doc_tokens, sequence_id, offset.

    Each document's ids, with `end` after them, lie in exactly one piece each.
    Null and empty texts are the end id alone (with end=None they give no piece).
    Null and repeated ids are packed like others, each row for itself. Extra
    columns are not carried.
    """
    docs = keyed(df, id_col, text_col).select("id", "text")
    return docs.mapInArrow(_pack(tokenizer, end, window, waiting), ddl(_PIECE)).withColumnRenamed("id", id_col)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark, sf_dir: str) -> DataFrame:
    """op8: see pack; the tokens as their CRC-32."""
    out = pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return out.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
