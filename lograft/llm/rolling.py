"""Vectorised text kernels shared by the operators that run inside Arrow tasks.

Everything here works on one *chunk* at a time: a few documents whose UTF-8
bytes are laid end to end in one numpy buffer.  Hashes are polynomial prefix
sums modulo 2**64, so the hash of any slice costs O(1) once the chunk's prefix
sums exist, and every helper is a handful of array passes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MULT = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_WORD_MULT = 0xD1342543DE82EF95
_GOLD, _MIX1, _MIX2 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)

#: Separators of ``[^\x20\x09-\x0D]+`` words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all their bits are usable (splitmix64)."""
    x = x + _GOLD
    x ^= x >> U64(30)
    x *= _MIX1
    x ^= x >> U64(27)
    x *= _MIX2
    x ^= x >> U64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64))


class _Powers:
    """Powers of an odd base and of its inverse, grown on demand and kept."""

    def __init__(self, base: int):
        self.base, self.inv = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            steps = np.full(size, self.base, dtype=U64)
            steps[0] = 1
            self.up = np.cumprod(steps)
            steps[1:] = self.inv
            self.down = np.cumprod(steps)
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_MULT), _Powers(_WORD_MULT)


def prefix_sums(values: np.ndarray, powers: _Powers) -> np.ndarray:
    up, _ = powers.get(len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * up[:-1], out=out[1:])
    return out


def _slice_hash(sums: np.ndarray, powers: _Powers, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers.get(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def byte_sums(buf: np.ndarray) -> np.ndarray:
    return prefix_sums(BYTE_VALUES[buf], _BYTES)


def byte_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte slices [starts, ends)."""
    return _slice_hash(sums, _BYTES, starts, ends)


def gram_sums(values: np.ndarray) -> np.ndarray:
    return prefix_sums(values, _WORDS)


def gram_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the word sequences [starts, ends)."""
    return _slice_hash(sums, _WORDS, starts, ends)


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_bounds(buf: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE):
    """Word starts, word ends and, for each document, the range of its words.

    A word never crosses a document: a run that does is cut at the offset.
    """
    inside = ~space[buf]
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(buf) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(buf) else inside
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = 1 << 20):
    """Yield (first row, bytes, offsets) with about ``limit`` bytes each.

    A longer document forms a chunk alone, so whole texts are always seen;
    null texts count as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        if not column.num_chunks:
            return
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(n, max(end, row + 1))
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def windows(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start items of all windows of ``size`` that stay within one document,
    and the document (index) of each; ``bounds`` are item offsets."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return np.arange(len(doc)) - first[doc] + bounds[:-1][doc], doc


_POSITION = U64((1 << 32) - 1)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum, by their upper 32 bits, of every ``width`` consecutive values.

    Equal values are told apart by position only, so equal stretches of values
    always pick the same relative position.  Value and position travel in one number.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    best, have = (values & ~_POSITION) | np.arange(len(values), dtype=U64), 1
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    return (best & _POSITION).astype(np.int64)


def covered(length: int, starts: np.ndarray, span: int) -> np.ndarray:
    """Mask of the items covered by intervals [s, s + span)."""
    depth = np.zeros(length + 1, dtype=np.int32)
    np.add.at(depth, starts, 1)
    np.add.at(depth, np.minimum(starts + span, length), -1)
    return np.cumsum(depth[:-1]) > 0
