"""Words of texts as numpy arrays, straight from Arrow string buffers.

A *slice* is a run of consecutive rows of one Arrow column.  ``WordSlice``
finds the words of a whole slice at once (byte classes, one prefix sum) and
gives every word a 64-bit hash.  Slices are cut by bytes, so memory stays
bounded by ``SLICE_BYTES`` or by one text, whichever is larger; texts are
never shortened.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):           # another C library than glibc
    _trim = None
_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240611))
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_P, _M = _U(0x9E3779B97F4A7C15), _U(0xD1342543DE82EF95)
_P_INV, _M_INV = _U(pow(int(_P), -1, 2**64)), _U(pow(int(_M), -1, 2**64))
_POWERS: dict[int, np.ndarray] = {}

# ASCII white space \x09-\x0D and \x20 separates words
SPACE_WORDS = np.ones(256, bool)
SPACE_WORDS[[9, 10, 11, 12, 13, 32]] = False
# digits, a-z and everything outside ASCII belong to words
ALNUM_WORDS = np.zeros(256, bool)
ALNUM_WORDS[0x30:0x3A] = ALNUM_WORDS[0x61:0x7B] = ALNUM_WORDS[0x80:] = True

SAME_BYTES = np.arange(256, dtype=np.uint8)
LOWER_ASCII = SAME_BYTES.copy()
LOWER_ASCII[65:91] += 32


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64, kept between calls."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 64)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= SLICE_BYTES + 64:         # the powers of a rare huge text are not kept
            _POWERS[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, in place."""
    for mult in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x ^= x >> _U(33)
        x *= _U(mult)
    x ^= x >> _U(33)
    return x


def text_buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (n + 1) and bytes of a string column; NULL is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if isinstance(col, pa.ChunkedArray):      # an empty chunked array
        col = pa.array([], pa.large_string())
    if not len(col):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    col = (col.fill_null("") if col.null_count else col).cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return offsets, data


def hand_back() -> None:
    """Give freed memory back to the system: workers live on, and what one
    stage leaves in them would add to what the next one needs."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row; memory freed
    meanwhile is handed back at the end of a large column."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)
    if int(offsets[-1]) - int(offsets[0]) > 4 * SLICE_BYTES:
        hand_back()


class WordSlice:
    """Words of the rows ``lo .. hi`` of a text column.

    ``first``: index of each row's first word (rows + 1 entries); ``starts``,
    ``ends``: byte range of each word in ``data``; ``hashes``: one 64-bit hash
    per word.
    """

    def __init__(self, offsets, data, lo, hi, is_word, fold):
        base = int(offsets[lo])
        self.data = np.take(fold, data[base:int(offsets[hi])])
        edges = (offsets[lo:hi + 1] - base).astype(np.int64)
        inside = np.zeros(len(self.data) + 1, bool)
        inside[:-1] = is_word[self.data]
        begins = inside[:-1].copy()
        begins[1:] &= ~inside[:-2]
        closes = inside[:-1] & ~inside[1:]
        # a word never runs across two rows
        cuts = edges[(edges > 0) & (edges < len(self.data))]
        begins[cuts] = inside[cuts]
        closes[cuts - 1] = inside[cuts - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, edges)
        self._hashes = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            n = len(self.data)
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE_VALUE[self.data] * powers(_P, n), out=total[1:])
            h = (total[self.ends] - total[self.starts]) * powers(_P_INV, n + 1)[self.starts]
            h += (self.ends - self.starts).astype(np.uint64) * _U(0xA0761D6478BD642F)
            self._hashes = mix(h)
        return self._hashes

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries of ``h``
    (``len(h) - k + 1`` values, none when ``h`` is shorter)."""
    n = len(h)
    if n < k or k < 1:
        return np.zeros(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * powers(_M, n), out=total[1:])
    return mix((total[k:] - total[:-k]) * powers(_M_INV, n)[:n - k + 1] + _U(k))


def shingle_set(h: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct ``k``-shingle hashes of one text's word hashes; a text
    of fewer (but some) words is one shingle of its whole sequence."""
    if not len(h):
        return np.zeros(0, np.uint64)
    return np.unique(windows(h, k if len(h) >= k else len(h)))
