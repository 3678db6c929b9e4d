"""Vectorised word splitting and hashing over Arrow string columns.

Works on the UTF-8 bytes of a whole Arrow batch at once. The word classes
used by the operators only look at single ASCII bytes, so multi-byte
characters never need decoding. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MIX1, _MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_GOLDEN = U64(0x9E3779B97F4A7C15)
_BYTE_MUL = 0x9E3779B97F4A7C15 | 1
_WORD_MUL = 0xD6E8FEB86659FD93 | 1

#: Bytes hashed at a time; bounds the temporary arrays (8 bytes per byte).
BLOCK = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser that spreads every input bit over 64 bits."""
    x = x + _GOLDEN
    x = (x ^ (x >> U64(30))) * _MIX1
    x = (x ^ (x >> U64(27))) * _MIX2
    return x ^ (x >> U64(31))


_BYTE_VALUE = mix64(np.arange(256, dtype=U64)) | U64(1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` for i < n (base odd), kept per process."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, BLOCK + 1024)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=U64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=U64))
        have = _POWERS[base] = (out[0], out[1])
        if n > 4 * BLOCK:  # one giant word or text: don't hold its powers
            del _POWERS[base]
    return have[0][:n], have[1][:n]


def byte_class(members) -> np.ndarray:
    """A 256-entry truth table of byte values."""
    t = np.zeros(256, dtype=bool)
    t[list(members)] = True
    return t


#: [^\x20\x09-\x0D]+
NON_SPACE = ~byte_class([0x20, *range(0x09, 0x0E)])
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z are lower-cased
ALNUM = ~byte_class([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n+1 row offsets into them; a
    null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # more than 2 GB
        column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks])
    if column.null_count:
        column = column.fill_null("")
    big = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    offsets = (np.frombuffer(offs, dtype=np.int64 if big else np.int32)
               [column.offset:column.offset + len(column) + 1].astype(np.int64)
               if len(column) else np.zeros(1, dtype=np.int64))
    if data is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    body = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]
    return body, offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = 4 * BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, of one row at least."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, members: np.ndarray):
    """Starts, ends (exclusive) and row index of every maximal run of bytes
    in ``members``; a run never spans two rows."""
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = members[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    changed = inside[1:] != inside[:-1]
    changed |= edge
    starts = np.flatnonzero(changed & inside[1:])
    ends = np.flatnonzero(changed & inside[:-1])
    row = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, row


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial over the bytes, read
    off prefix sums, then mixed. Temporary arrays cover a block of bytes."""
    out = np.empty(len(starts), dtype=U64)
    i, n = 0, len(starts)
    while i < n:
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + BLOCK, side="right")))
        size = int(ends[j - 1]) - base
        up, down = powers(_BYTE_MUL, size + 1)
        sums = np.zeros(size + 1, dtype=U64)
        np.cumsum(_BYTE_VALUE[data[base:base + size]] * up[:size], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix64((sums[e] - sums[s]) * down[s])
        i = j
    return out


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Rabin-Karp hashes of every run of ``k`` consecutive word hashes (the
    caller drops the runs that cross rows). One value per start."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = np.empty(n, dtype=U64)
    step = max(BLOCK // 2, k)
    up, down = powers(_WORD_MUL, step + k)
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        part = hashes[lo:hi + k - 1]
        sums = np.zeros(len(part) + 1, dtype=U64)
        np.cumsum(part * up[:len(part)], out=sums[1:])
        m = hi - lo
        out[lo:hi] = (sums[k:k + m] - sums[:m]) * down[:m]
    return mix64(out)
