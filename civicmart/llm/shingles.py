"""Hashed word shingles of many texts at once, in numpy over their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled at once; a longer text is cut between words.
SLICE = 1 << 19
SHINGLE = 5

_rng = np.random.default_rng(20_240_601)
_BASE = int(_rng.integers(1 << 62)) | 1
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# Digits, letters and every byte of a character past ASCII.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        found = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(max(n, SLICE + 1), base, dtype=np.uint64)
            row[0] = 1
            found.append(np.multiply.accumulate(row))
        _powers[:] = found
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums s and inverse powers v: (s[j] - s[i]) * v[i] names the bytes from i to j."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    return sums, down


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of texts that lie end to end, and words per text.
    ``bounds`` holds where each text begins, and the end."""
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(bounds) - 1, dtype=np.int64)
    inside = _IN_WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    starts = bounds[:-1][bounds[:-1] < len(data)]
    first[starts] = inside[starts]
    stops = bounds[1:][bounds[1:] > 0] - 1
    last[stops] = inside[stops]
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums, down = prefix_sums(_LOWER[data])
    hashes = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
    return hashes, np.diff(np.searchsorted(a, bounds))


def _long_text(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, cut between words."""
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + SLICE)
        if end < len(data):
            gap = np.flatnonzero(~_IN_WORD[data[at:end]])
            if len(gap):
                end = at + int(gap[-1]) + 1
            else:  # a word longer than a slice
                gap = np.flatnonzero(~_IN_WORD[data[end:]])
                end = end + int(gap[0]) if len(gap) else len(data)
        found.append(word_hashes(data[at:end], np.array([0, end - at]))[0])
        at = end
    return np.concatenate(found)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and runs per text. A text of fewer words, but not
    none, is one run."""
    ends = np.cumsum(counts)
    text = np.repeat(np.arange(len(counts)), counts)
    left = ends[text] - np.arange(len(words)) if len(words) else np.zeros(0, dtype=np.int64)
    long = counts >= size
    take = np.where(long[text], left >= size, left == counts[text]) if len(words) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(take)
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(size):
        here = k < left[at]
        total[here] += words[at[here] + k] * _STEP[k]
    total += np.minimum(left[at], size).astype(np.uint64)
    return mix(total), np.bincount(text[at], minlength=len(counts))


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, word hashes, words per row) for runs of rows of a string column."""
    column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    whole = column.buffers()[2]
    data = np.frombuffer(whole, dtype=np.uint8) if whole is not None and whole.size else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + SLICE, side="right")) - 1
        if end <= row:
            words = _long_text(data[offsets[row] : offsets[row + 1]])
            yield row, 1, words, np.array([len(words)])
            row += 1
            continue
        bounds = offsets[row : end + 1].astype(np.int64)
        words, counts = word_hashes(data[bounds[0] : bounds[-1]], bounds - bounds[0])
        yield row, end - row, words, counts
        row = end
