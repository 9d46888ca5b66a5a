"""Numpy helpers over the bytes of an Arrow string column, a few megabytes of text at a time.

All texts are handled as UTF-8 bytes in one flat array with an offset per row; a null is an empty
range. Hashes are 64-bit and the same in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 21

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, np.uint64)
        step = base
        while len(have) < n:
            have = np.concatenate([have, have * np.uint64(step)])
            step = step * step % (1 << 64)
        if len(have) <= 4 * PIECE_BYTES:
            _powers[base] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def folded(data: np.ndarray) -> np.ndarray:
    """Bytes with the capitals of the basic Latin, Latin-1, Greek and Cyrillic alphabets read as small letters."""
    out = LOWER[data]
    lead = np.flatnonzero((data == 0xC3) | (data == 0xCE) | (data == 0xD0))
    lead = lead[lead + 1 < len(data)]
    a, b = data[lead], data[lead + 1]
    up = ((a == 0xC3) & (b >= 0x80) & (b <= 0x9E) & (b != 0x97)) | ((a == 0xCE) & (b >= 0x91) & (b <= 0x9F)) | ((a == 0xD0) & (b >= 0x90) & (b <= 0x9F))
    out[lead[up] + 1] += 0x20
    down = ((a == 0xCE) & (b >= 0xA0) & (b <= 0xAB)) | ((a == 0xD0) & (b >= 0xA0) & (b <= 0xAF))
    out[lead[down]] += 1
    out[lead[down] + 1] -= 0x20
    return out


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets.astype(np.int64)


def pieces(data: np.ndarray, offsets: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows with about `size` bytes of text, at least one row: first, past the last, bytes, offsets."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        at = offsets[first : last + 1]
        yield first, last, data[at[0] : at[-1]], at - at[0]
        first = last


def spans_of(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes within rows: starts, ends, and the row of each."""
    edge = np.zeros(len(member) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], member[:-1]])
    after = np.concatenate([member[1:], [False]])
    starts = np.flatnonzero(member & (edge[:-1] | ~before))
    ends = np.flatnonzero(member & (edge[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of every span's bytes, from running sums of byte * power."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers(_INVERSE, len(data) + 1)[starts]
    return mixed(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a piece, A-Z read as a-z, and the place of each row's first word (one more at the end)."""
    low = LOWER[data]
    starts, ends, row = spans_of(~SPACE[low], offsets)
    return span_hashes(low, starts, ends), np.searchsorted(row, np.arange(len(offsets)))


_TURN = [np.uint64(x | 1) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC6A4A7935BD1E995, 0x8CB92BA72F3D8DD7, 0xE7037ED1A0B428DB)]


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """The distinct hashes of k consecutive words, sorted; of the whole sequence if it is shorter."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    m = min(n, k)
    h = np.full(n - m + 1, 0x2545F4914F6CDD1D * m % (1 << 64), np.uint64)
    for j in range(m):
        h = mixed((h ^ words[j : n - m + 1 + j]) * _TURN[j % len(_TURN)] + np.uint64(j))
    return np.unique(h)


def taken(values: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Stretches of an array, one after the other: `n` values from each `begin`."""
    return values[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())]
