"""Fixed-length substring names by doubling, as numpy arrays.

The name of the 2h bytes at a position is a mix of the names of the h bytes
there and h further on (the prefix-doubling step with 64-bit fingerprints as
ranks), so all names of one length cost a few vectorised passes. Names of 8
bytes are the bytes themselves.
"""

from __future__ import annotations

import numpy as np

_C1 = np.uint64(0x9E3779B97F4A7C15)
_C2 = np.uint64(0xC2B2AE3D27D4EB4F)
_C3 = np.uint64(0xFF51AFD7ED558CCD)
_S32, _S29 = np.uint64(32), np.uint64(29)
_LOW = np.uint64(0xFFFFFFFF)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of the ordered pair (a, b), elementwise."""
    x = a * _C1
    y = b ^ _C2
    y *= _C3
    y ^= y >> _S29
    x = x + y
    x ^= x >> _S32
    x *= _C3
    x ^= x >> _S29
    return x


def eights(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes at each position as one number; buf is uint8 and has 8 spare bytes."""
    return np.ndarray(len(buf) - 7, "<u8", buf, strides=(1,)).astype(np.uint64)


def doubled(x: np.ndarray, h: int) -> np.ndarray:
    """Names of length 2h from names of length h."""
    return mix(x[:-h], x[h:])


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` neighbours."""
    h = 1
    while 2 * h <= width:
        v = np.minimum(v[:-h], v[h:])
        h *= 2
    return np.minimum(v[: len(v) - (width - h)], v[width - h :]) if width > h else v


def joined(texts: list[bytes], spare: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one uint8 buffer (with spare bytes at its end), their starts and lengths."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate(([0], np.cumsum(lens)[:-1])) if len(texts) else lens
    return np.frombuffer(b"".join([*texts, bytes(spare)]), np.uint8), starts, lens


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (counts[0] numbers), then the same from starts[1], and so on."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


SPACES = np.array([9, 10, 11, 12, 13, 32], np.uint8)
_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(1), np.full(256, 77, np.uint64))


def word_names(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of all words (runs of bytes other than white space) in order, and each text's first one and their number."""
    buf, starts, lens = joined([t + b" " for t in texts])
    b = buf[: int(starts[-1] + lens[-1]) if len(texts) else 0]
    at = np.flatnonzero(~np.isin(b, SPACES))
    if not len(at):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    first = np.flatnonzero(np.concatenate(([True], np.diff(at) > 1)))
    word_len = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, word_len)
    power = np.cumprod(np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    names = mix(np.add.reduceat(_BYTE[b[at]] * power[place], first), word_len.astype(np.uint64))
    edge = np.searchsorted(at[first], starts)
    return names, edge, np.diff(np.append(edge, len(first)))
