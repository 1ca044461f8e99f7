"""Texts of an Arrow column as numpy byte arrays: bounded slices, words, rolling hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are processed in slices of about this many bytes (one longer text is one slice).
SLICE_BYTES = 1 << 20
#: An odd multiplier of the polynomial hash modulo 2**64, and its inverse.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (one more offset than texts). Null is empty."""
    array = pc.fill_null(array.cast(pa.large_string() if not pa.types.is_binary(array.type) else pa.large_binary()), "" if not pa.types.is_binary(array.type) else b"")
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit hashes (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE`` to the powers 0 to n - 1 modulo 2**64, and their inverses."""
    up = np.full(n, BASE, np.uint64)
    down = np.full(n, BASE_INVERSE, np.uint64)
    if n:
        up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def prefix_hashes(data: np.ndarray, up: np.ndarray) -> np.ndarray:
    """Prefix sums S with S[j] - S[i] = sum of data[k] * BASE**k over i <= k < j."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return total


def lower_table(separators: np.ndarray) -> np.ndarray:
    """A map of bytes: A-Z to lower case, the given separators to 0, all others to themselves."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[separators] = 0
    return table


#: Words are runs of bytes that are no ASCII white space.
WHITE_SPACE = lower_table(np.array([32, 9, 10, 11, 12, 13]))
#: Words are runs of ASCII letters and digits and of bytes above 127.
ALPHANUMERIC = lower_table(np.array([*range(48), *range(58, 65), *range(91, 97), *range(123, 128)]))


def hash_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, heads: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """A 64-bit hash of each word, and the word index where each text begins (one more than texts).

    ``heads`` adds, for each number of bytes, hashes of the words' beginnings of that length.
    """
    n = len(data)
    low = table[data]
    inside = low != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < n]
    first[begins] = inside[begins]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = powers(n)
    total = prefix_hashes(low, up)
    words = mix((total[stops] - total[starts]) * down[starts])
    cut = [mix((total[np.minimum(stops, starts + k)] - total[starts]) * down[starts] ^ np.uint64(k)) for k in heads]
    return words, np.searchsorted(starts, offsets), *cut
