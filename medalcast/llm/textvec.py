"""Vectorised text helpers for tasks: word spans, word hashes and k-gram hashes over Arrow buffers.

A batch of texts is read as one UTF-8 byte buffer with row offsets (no Python
strings are made). Words are runs of word bytes; a word's 64-bit hash is a
polynomial over random byte values, reduced per word and mixed. k-gram hashes
are mixed linear forms of k consecutive word hashes. All arithmetic wraps
modulo 2**64, so results do not depend on the batch, partition or machine.

Memory: byte-wide work is done on pieces of at most ``PIECE`` bytes cut at
separators, so a text of any length costs eight bytes a word plus a fixed part.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20          # bytes worked on at once
U = np.uint64


def _mix_int(x: int) -> int:
    m = (1 << 64) - 1
    x = (x + 0x9E3779B97F4A7C15) & m
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & m
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & m
    return x ^ (x >> 31)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser over a uint64 array."""
    x = x + U(0x9E3779B97F4A7C15)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTE = np.array([_mix_int(1000 + i) | 1 for i in range(256)], dtype=U)
_BASE = U(_mix_int(7) | 1)
_GRAM = np.array([_mix_int(5000 + i) | 1 for i in range(64)], dtype=U)


def gram_consts(k: int) -> np.ndarray:
    if k <= len(_GRAM):
        return _GRAM[:k]
    return np.array([_mix_int(5000 + i) | 1 for i in range(k)], dtype=U)


class WordClass:
    """Which bytes belong to words, and the (ASCII-folded) value of each byte."""

    def __init__(self, word_bytes, fold_case: bool = True):
        self.is_word = np.zeros(256, dtype=bool)
        self.is_word[list(word_bytes)] = True
        value = _BYTE.copy()
        if fold_case:
            value[65:91] = _BYTE[97:123]
        value[~self.is_word] = 0
        self.value = value


_SPACE = {0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D}
#: runs of anything but white space (0x20, 0x09-0x0D), A-Z folded
SPACED = WordClass([b for b in range(256) if b not in _SPACE])
#: the same, case kept
SPACED_CASED = WordClass([b for b in range(256) if b not in _SPACE], fold_case=False)
#: ASCII letters (folded), digits and every byte of a non-ASCII code point
ALNUM = WordClass([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])


def give_back() -> None:
    """Return memory that this worker freed to the system; allocators keep it for themselves otherwise."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


try:
    _TRIM = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):      # another C library
    _TRIM = None


def lean(run):
    """``run`` (over an iterator of batches) with freed memory given back after every batch."""
    def fed(batches):
        for b in batches:
            yield b
            del b
            give_back()

    def whole(batches):
        yield from run(fed(batches))
        give_back()
    return whole


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_null(col.type):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    large = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if col.null_count:
        col = col.cast(pa.large_binary() if large else pa.binary()).fill_null(b"")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if large else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes (one row at least)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def _pieces(buf: np.ndarray, wc: WordClass) -> Iterator[tuple[int, int]]:
    """Byte ranges of about PIECE bytes that end at a separator (or the end)."""
    n, i = len(buf), 0
    while i < n:
        j = min(n, i + PIECE)
        while j < n and wc.is_word[buf[j - 1]]:
            gap = np.flatnonzero(~wc.is_word[buf[j:j + 4096]])
            if len(gap):
                j += int(gap[0]) + 1
                break
            j = min(n, j + 4096)
        yield i, j
        i = j


def words(buf: np.ndarray, offsets: np.ndarray, wc: WordClass):
    """Word starts, ends, 64-bit hashes, and per row the index of its first word (rows + 1 entries)."""
    out_s, out_e, out_h = [], [], []
    inner = offsets[1:-1]
    for a, z in _pieces(buf, wc):
        part = buf[a:z]
        is_word = wc.is_word[part]
        before = np.empty_like(is_word)
        before[0] = False
        before[1:] = is_word[:-1]
        cut = inner[(inner >= a) & (inner < z)] - a
        before[cut] = False                      # a row's first byte follows nothing
        starts = np.flatnonzero(is_word & ~before)
        if not len(starts):
            continue
        after = np.empty_like(is_word)
        after[-1] = False
        after[:-1] = is_word[1:]
        after[cut[cut > 0] - 1] = False
        ends = np.flatnonzero(is_word & ~after) + 1
        span = np.diff(np.append(starts, len(part)))
        at = np.arange(starts[0], len(part), dtype=np.int64) - np.repeat(starts, span)
        longest = int((ends - starts).max())
        power = np.full(longest + 1, _BASE, dtype=U)
        power[0] = 1
        power = np.cumprod(power)
        np.minimum(at, longest, out=at)          # separators behind a word; their value is 0
        h = np.add.reduceat(wc.value[part[starts[0]:]] * power[at], starts - starts[0])
        out_h.append(mix(h ^ ((ends - starts).astype(U) * U(0xC2B2AE3D27D4EB4F))))
        out_s.append(starts + a)
        out_e.append(ends + a)
    starts = np.concatenate(out_s) if out_s else np.zeros(0, np.int64)
    ends = np.concatenate(out_e) if out_e else np.zeros(0, np.int64)
    hashes = np.concatenate(out_h) if out_h else np.zeros(0, U)
    first = np.searchsorted(starts, offsets, side="left")
    return starts, ends, hashes, first


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words, ignoring row bounds (see ``gram_rows``)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    acc = np.zeros(n, U)
    for j, c in enumerate(gram_consts(k)):
        acc += hashes[j:j + n] * c
    return mix(acc)


def whole(hashes: np.ndarray) -> int:
    """Hash of a whole word sequence; equals ``grams`` with k = its length."""
    return int(grams(hashes, len(hashes))[0]) if len(hashes) else 0


def row_ids(first: np.ndarray) -> np.ndarray:
    """Row number of each word, from the rows' first-word indexes."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def as_long(x: np.ndarray) -> np.ndarray:
    """The bits of a uint64 array as int64 (Spark's long)."""
    return np.ascontiguousarray(x).view(np.int64)


def distinct_per_row(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash) pairs, sorted by row, then hash; ``row`` must not decrease."""
    if not len(h):
        return row, h
    order = np.lexsort((h, row))
    r, h = row[order], h[order]
    keep = np.empty(len(h), bool)
    keep[0] = True
    keep[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return r[keep], h[keep]


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles per row as (row, hash), sorted; a row with fewer words has its whole sequence as one."""
    n_words = np.diff(first)
    g = grams(hashes, k)
    row = row_ids(first)[:len(g)]
    fits = np.arange(len(g)) + k <= first[1:][row] if len(g) else np.zeros(0, bool)
    r, h = row[fits], g[fits]
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):
        hs = np.array([whole(hashes[first[i]:first[i + 1]]) for i in short], dtype=U)
        r, h = np.concatenate([r, short]), np.concatenate([h, hs])
    return distinct_per_row(r, h)
