"""Helpers over Arrow string columns: texts of a batch as one byte array, words and rolling hashes with numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache, wraps
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)


@cache
def _trim() -> Callable[[int], int] | None:
    """The C library's malloc_trim, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return None


def give_back() -> None:
    """Returns to the system what Arrow and the C library hold for reuse."""
    pa.default_memory_pool().release_unused()
    if (trim := _trim()) is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that gives memory back after each batch it took and at its end: workers live on, beside those of later stages."""

    def given(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            give_back()

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(given(batches))
        finally:
            give_back()

    return task


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit numbers (splitmix64): every output bit depends on every input bit."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


@cache
def byte_codes(seed: int, fold: bool) -> np.ndarray:
    """A random 64-bit code of each byte; with fold, A-Z have the codes of a-z."""
    codes = mix(np.arange(1, 257, dtype=U64) * GOLDEN + U64(seed))
    if fold:
        codes[65:91] = codes[97:123]
    codes.flags.writeable = False
    return codes


_known_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(seed: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a seed's base and of its inverse, 2^bits at least: one table a seed, the longest asked for."""
    known = _known_powers.get(seed)
    if known is not None and known[0].size >= 1 << bits:
        return known
    base = int(mix(np.array([seed + 77], U64))[0]) | 5
    n = 1 << bits
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.ones(n, U64)
        step = 1
        factor = b
        while step < n:
            p[step : 2 * step] = p[:step] * U64(factor)
            factor = factor * factor % (1 << 64)
            step *= 2
        p.flags.writeable = False
        both.append(p)
    _known_powers[seed] = both[0], both[1]
    return _known_powers[seed]


class Rolling:
    """Hashes of any ranges of a byte array. Equal bytes have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray, seed: int = 0, fold: bool = False):
        n = data.size
        power, self._inverse = _powers(seed, max(16, int(n).bit_length()))
        self._sums = np.zeros(n + 1, U64)
        np.cumsum(byte_codes(seed, fold)[data] * power[:n], out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self._sums[end] - self._sums[start]) * self._inverse[start]
        return mix(h + (end - start).astype(U64) * GOLDEN)

    def every(self, q: int) -> np.ndarray:
        """Hash of the q bytes that start at each place."""
        s = self._sums
        return mix((s[q:] - s[:-q]) * self._inverse[: s.size - q] + U64(q * int(GOLDEN) % (1 << 64)))


class Slice(NamedTuple):
    """Texts first..first+len(offsets)-2 of a batch, one after another in data."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


def text_slices(column: pa.Array, most: int = 1 << 18) -> Iterator[Slice]:
    """The texts of a column as byte arrays of about `most` bytes; a longer text is a slice of its own. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        last = min(last, first + 50_000, n)
        at = offsets[first : last + 1]
        yield Slice(first, data[at[0] : at[-1]], at - at[0])
        first = last


def _edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = inside.size
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:n]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


class Words(NamedTuple):
    """Words of a slice: byte ranges, hashes, and for each text the place of its first word (one more at the end)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def words_of(s: Slice, inside: np.ndarray, seed: int = 0) -> Words:
    """Words are the longest runs of the bytes that `inside` (256 booleans) marks; A-Z count as a-z."""
    start, end = _edges(inside[s.data], s.offsets)
    h = Rolling(s.data, seed, fold=True)(start, end)
    return Words(start, end, h, np.searchsorted(start, s.offsets))


@cache
def _scripts_without_blanks() -> np.ndarray:
    """For the first two bytes of a UTF-8 character of three, whether it is of a script that sets no blanks between words."""
    alone = np.zeros(1 << 16, bool)
    # Thai and Lao, Tibetan, Myanmar, Khmer, kana to ideographs, Yi, ideographs and forms for compatibility, full width.
    for lo, hi in ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x9FFF), (0xA000, 0xA4CF), (0xF900, 0xFAFF), (0xFF00, 0xFFEF)):
        a, b = (int.from_bytes(chr(c).encode()[:2], "big") for c in (lo, hi))
        alone[a : b + 1] = True
    return alone


def words_and_characters(s: Slice, inside: np.ndarray, seed: int = 0) -> Words:
    """As words_of, but each character of a script without blanks is a word of its own."""
    offsets = s.offsets
    if (s.data >= 0xE0).any():
        lead = np.flatnonzero(s.data >= 0xE0)
        lead = lead[lead + 2 < s.data.size]
        pair = s.data[lead].astype(np.int64) << 8 | s.data[lead + 1]
        wide = (s.data[lead] == 0xF0) & (s.data[lead + 1] >= 0xA0)  # ideographs beyond 16 bits
        alone = _scripts_without_blanks()[pair] & (s.data[lead] < 0xF0)
        cuts = [lead[wide], lead[wide] + 4, lead[alone], lead[alone] + 3]
        offsets = np.concatenate([offsets, *cuts])
    start, end = _edges(inside[s.data], offsets)
    h = Rolling(s.data, seed, fold=True)(start, end)
    return Words(start, end, h, np.searchsorted(start, s.offsets))


@cache
def not_space() -> np.ndarray:
    """Bytes of words between ASCII white space."""
    inside = np.ones(256, bool)
    inside[[32, 9, 10, 11, 12, 13]] = False
    return inside


@cache
def alphanumeric() -> np.ndarray:
    """0-9, A-Z, a-z and every byte of a character beyond ASCII."""
    inside = np.zeros(256, bool)
    inside[48:58] = inside[65:91] = inside[97:123] = inside[128:] = True
    return inside


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive numbers; shorter by k - 1."""
    n = h.size - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = h[:n].copy()
    for i in range(1, k):
        out = out * U64(0xD6E8FEB86659FD93) + h[i : i + n]
    return mix(out + U64(k))


def owner(first: np.ndarray, n: int) -> np.ndarray:
    """For each of n words, the number of its text."""
    return np.repeat(np.arange(first.size - 1), np.diff(first))[:n]


def shingles(w: Words, k: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles. With 1 to k - 1 words: the whole sequence as one."""
    g = grams(w.hash, k)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        n = b - a
        if n >= k:
            x = np.sort(g[a : b - k + 1])
            out.append(x[np.concatenate(([True], x[1:] != x[:-1]))])
        else:
            out.append(grams(w.hash[a:b], n) if n else np.zeros(0, U64))
    return out


def long_array(h: np.ndarray) -> pa.Array:
    """Unsigned hashes as the signed 64-bit integers of Spark."""
    return pa.array(np.ascontiguousarray(h).view(np.int64))
