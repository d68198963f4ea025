"""Vectorised text primitives over Arrow string columns: word hashes, shingle sets, line splits.

Words are runs of characters other than the six ASCII white-space characters and vertical tab;
A-Z count as a-z. Hashes are 64-bit; two different words or shingles share one with a chance
of 2**-64, which no threshold here would notice. Null texts count as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RNG = np.random.default_rng(20240607)
_MULT = U64(0x9E3779B97F4A7C15)
_STEP = (_RNG.integers(1, 2**63, 64, dtype=np.int64).astype(U64) * U64(2)) + U64(1)
#: Bytes hashed at once; bounds memory at some 40 times this.
SLICE = 1 << 15


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


_INVERSE = U64(pow(int(_MULT), -1, 1 << 64))
_POW: dict[bool, np.ndarray] = {}


def _powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers 0, 1, 2 ... of the multiplier, or of its inverse modulo 2**64."""
    if len(_POW.get(inverse, ())) < n:
        full = np.full(max(n, SLICE + 4096), _INVERSE if inverse else _MULT, dtype=U64)
        full[0] = 1
        _POW[inverse] = np.cumprod(full)
    return _POW[inverse]


def is_space(b: np.ndarray) -> np.ndarray:
    return (b == 32) | ((b - np.uint8(9)) < 5)


def lower_ascii(b: np.ndarray) -> np.ndarray:
    return b + (((b - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5))


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    n = len(col)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + n + 1]
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8)[offs[0] : offs[-1]] if col.buffers()[2] is not None else np.empty(0, np.uint8)
    return data, offs - offs[0]


def hash_words(data: np.ndarray, offs: np.ndarray, lower: bool = True, spans: bool = False):
    """Hashes of all words in order, and ptr: words of text i are ptr[i]:ptr[i+1]. With spans also starts and ends in bytes."""
    total = len(data)
    hashes, starts, ends = [], [], []
    breaks = offs[1:-1]
    at = 0
    while at < total:
        end = min(total, at + SLICE)
        while end < total and not is_space(data[end : end + 1])[0]:
            ahead = data[end : end + SLICE]
            gap = np.flatnonzero(is_space(ahead))
            end = end + (gap[0] if len(gap) else len(ahead))
        part = data[at:end]
        word = ~is_space(part)
        edge = np.empty(len(part) + 1, dtype=bool)
        edge[1:-1] = word[1:] != word[:-1]
        edge[0], edge[-1] = word[0], word[-1]
        lo, hi = np.searchsorted(breaks, (at + 1, end))  # texts that begin inside this slice
        if hi > lo:
            inner = breaks[lo:hi] - at
            inner = np.unique(inner)
            edge[inner[word[inner] & word[inner - 1]]] = True
        cuts = np.flatnonzero(edge)
        opens = word[np.minimum(cuts, len(part) - 1)] & (cuts < len(part))
        begins = cuts[opens]
        if len(begins):
            stops = cuts[np.flatnonzero(opens) + 1]
            length = stops - begins
            total_to = np.zeros(len(part) + 1, dtype=U64)
            value = (lower_ascii(part) if lower else part).astype(U64)
            value += U64(1)
            value *= _powers(len(part))[: len(part)]
            np.cumsum(value, out=total_to[1:])
            h = (total_to[stops] - total_to[begins]) * _powers(len(part), inverse=True)[begins]
            hashes.append(mix(h + length.astype(U64)))
            starts.append(begins + at)
            if spans:
                ends.append(stops + at)
        at = end
    h = np.concatenate(hashes) if hashes else np.empty(0, U64)
    s = np.concatenate(starts) if starts else np.empty(0, np.int64)
    ptr = np.searchsorted(s, offs)
    ptr[-1] = len(s)
    return (h, ptr, s, np.concatenate(ends) if ends else np.empty(0, np.int64)) if spans else (h, ptr)


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.zeros(n, U64)
    for j in range(k):
        out += h[j : j + n] * _STEP[j]
    return mix(out)


def short_hash(h: np.ndarray) -> np.ndarray:
    """One hash for a whole sequence shorter than k words; sequences of other lengths get others."""
    out = U64(len(h))
    for j in range(len(h)):
        out = out + h[j] * _STEP[32 + j % 32]
    return mix(np.array([out], dtype=U64))


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int, whole_if_short: bool = True) -> list[np.ndarray]:
    """The sorted distinct k-word shingles of each text. A text of fewer words has its whole sequence as one; no words, none."""
    h, ptr = hash_words(data, offs)
    with np.errstate(over="ignore"):
        s = shingle_hashes(h, k)
        out = []
        for i in range(len(offs) - 1):
            a, b = ptr[i], ptr[i + 1]
            if b - a >= k:
                out.append(np.unique(s[a : b - k + 1]))
            elif b > a and whole_if_short:
                out.append(short_hash(h[a:b]))
            else:
                out.append(np.empty(0, U64))
    return out
