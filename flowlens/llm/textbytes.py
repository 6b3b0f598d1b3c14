"""Words, lines and their 64-bit hashes from a batch of texts, by numpy over the UTF-8 bytes.

Words are maximal runs without the ASCII white space bytes 0x20 and 0x09-0x0D. These bytes
never occur inside a multi-byte UTF-8 character, so byte positions are safe. Work goes in
blocks of about ``BLOCK_BYTES`` of text (a longer text is a block of its own): the memory of
a task is bounded by the longest text, not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18

_WS = np.zeros(256, dtype=bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element (a bijection of 64-bit values)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeded(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return splitmix((np.arange(1, n + 1, dtype=np.uint64) + _U(seed)) * _U(_BASE))


_BYTE = seeded(11, 256)
_POW = np.ones(1, dtype=np.uint64)
_INV = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base and of its inverse modulo 2**64. A worker keeps those of a usual block;
    a longer text's are made anew and let go."""
    global _POW, _INV
    if len(_POW) >= n:
        return _POW, _INV
    size = max(n, 2 * BLOCK_BYTES)
    made = tuple(
        np.cumprod(np.r_[_U(1), np.full(size, _U(b), dtype=np.uint64)], dtype=np.uint64)
        for b in (_BASE, pow(_BASE, -1, 1 << 64))
    )
    if n <= 2 * BLOCK_BYTES:
        _POW, _INV = made
    return made


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of rows in them); null texts count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if n == 0:
        return
    texts = texts.fill_null("")
    big = pa.types.is_large_string(texts.type)
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, dtype=np.int64 if big else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and its row."""
    inside = ~_WS[data]
    n = len(data)
    before = np.empty(n, dtype=bool)
    after = np.empty(n, dtype=bool)
    if n:
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edge = offs[(offs > 0) & (offs < n)]
        before[edge] = False
        after[edge - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def hash_prefix(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash of the bytes, from which ``span_hash`` reads any span."""
    p, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[data] * p[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal spans have equal hashes wherever they stand."""
    _, inv = _powers(len(prefix))
    with np.errstate(over="ignore"):
        return splitmix((prefix[ends] - prefix[starts]) * inv[starts] + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def windows(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of n consecutive words of one row, and the index of its first word."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    first = np.flatnonzero(row[:m] == row[n - 1 :])
    c = seeded(1000 + n, n)
    with np.errstate(over="ignore"):
        out = h[first] * c[0]
        for j in range(1, n):
            out = out + splitmix(h[first + j] ^ c[j]) * (c[j] | _U(1))
        return splitmix(out), first


def shingle_sets(data: np.ndarray, offs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each row: (hashes grouped by row and sorted, offsets of rows).

    A row with 1 to n-1 words has its whole sequence as one shingle; without words, none.
    """
    starts, ends, row = words(data, offs)
    h = span_hash(hash_prefix(data), starts, ends)
    sh, first = windows(h, row, n)
    srow = row[first]
    count = np.bincount(row, minlength=len(offs) - 1)
    for m in range(1, n):
        short = np.flatnonzero(count == m)
        if len(short):
            sel = np.isin(row, short)
            hs, fs = windows(h[sel], row[sel], m)
            sh, srow = np.r_[sh, hs], np.r_[srow, row[sel][fs]]
    order = np.lexsort((sh, srow))
    sh, srow = sh[order], srow[order]
    if len(sh):
        new = np.r_[True, (sh[1:] != sh[:-1]) | (srow[1:] != srow[:-1])]
        sh, srow = sh[new], srow[new]
    return sh, np.searchsorted(srow, np.arange(len(offs)))


def segment_sum(values: np.ndarray, seg: np.ndarray, n: int) -> np.ndarray:
    """Sum of whole numbers per segment id in [0, n)."""
    return np.bincount(seg, weights=values, minlength=n).astype(np.int64)
