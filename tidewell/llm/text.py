"""Vectorised words, lines and hashes over Arrow text columns, for use inside tasks.

A text column is one byte array with offsets, so the work on a batch is a handful of numpy
passes over its bytes. Blocks bound the memory: a block holds about a megabyte of text, or a
single longer text, whose arrays take some forty times its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
U64 = np.uint64

#: The characters that separate words in the near-duplicate contract.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

#: Lower-cases A-Z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads every input bit over the whole word."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


BYTE = constants(256, 11) << U64(8) | np.arange(1, 257, dtype=U64)
#: Bytes hashed together at once, and the multipliers of their places, by level.
RUNG = 4096
PLACE = [constants(RUNG, 13 + level) for level in range(4)]
BASE = U64(0xD1342543DE82EF95)
_powers = np.ones(1, U64)


def powers(n: int) -> np.ndarray:
    """The first n powers of the hash's base."""
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 2 * len(_powers)), BASE)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:n]


def column(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = pc.fill_null(array, "")
    large = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    if offsets is None or len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def blocks(data: np.ndarray, offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: first row, bytes, offsets."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def hash_runs(data: np.ndarray, starts: np.ndarray, skip: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of the bytes from each start to the next, without those marked ``skip``.

    The runs must begin at byte 0 or after skipped bytes, and skipped bytes must end a run. Every place
    in a run has a multiplier of its own, drawn without regard to the others, as powers of one base
    collide on Thue-Morse words. Longer runs are hashed in rungs of 4096 bytes, whose hashes are summed the same way.
    """
    if not len(starts):
        return np.zeros(0, U64)
    at = np.zeros(len(data), np.int64)
    at[starts] = starts
    at = np.arange(len(data), dtype=np.int64) - np.maximum.accumulate(at)
    at[: starts[0]] = 0
    values = BYTE[data] * PLACE[0][at % RUNG]
    if skip is not None:
        values[skip] = 0
    if int(at.max()) < RUNG:
        return mix(np.add.reduceat(values, starts))
    heads = starts[0] + np.flatnonzero(at[starts[0] :] % RUNG == 0)
    sums, first = mix(np.add.reduceat(values, heads)), np.searchsorted(heads, starts)
    for level in (1, 2, 3):  # a run without further rungs, or of skipped bytes only, keeps its first one's hash
        k = np.arange(len(sums)) - np.repeat(first, np.diff(np.append(first, len(sums))))
        heads = np.flatnonzero(k % RUNG == 0)
        sums = np.add.reduceat(np.where(k % RUNG == 0, sums, sums * PLACE[level][k % RUNG]), heads)
        first = np.searchsorted(heads, first)
    return sums


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, hash and row of every word of a block; ``separators`` marks the bytes between words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64)
    apart = separators[data]
    begins = ~apart
    begins[1:] &= apart[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = ~apart[firsts]
    starts = np.flatnonzero(begins)
    return starts, hash_runs(data, starts, apart), np.searchsorted(offsets, starts, "right") - 1


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, hash and row of every line of a block; a line's end mark is no part of its hash."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64)
    ends = data == 10
    begins = np.zeros(len(data), bool)
    begins[1:] = ends[:-1]
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(begins)
    return starts, hash_runs(data, starts, ends), np.searchsorted(offsets, starts, "right") - 1


def slices(values: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    return [values[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
