"""Words of whole texts as hashes, for tasks that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

A_TO_Z = np.arange(256, dtype=np.uint8)
A_TO_Z[65:91] += 32


def constants(name: str, n: int) -> np.ndarray:
    """``n`` odd 64-bit numbers that depend on the name only."""
    return np.array([int.from_bytes(blake2b(f"{name}:{i}".encode(), digest_size=8).digest(), "big") | 1 for i in range(n)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; a bijection."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


OF_BYTE = constants("byte", 256)


def word_hashes(texts: list[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts, and where each text's words begin (one more at the end).

    Two different words have the same hash with a chance of about 2**-63. Null counts as an empty text.
    """
    joined = np.frombuffer(b" " + b" ".join(t or b"" for t in texts) + b" ", np.uint8)
    space = (joined == 32) | ((joined >= 9) & (joined <= 13))
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    bounds = np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))
    if not len(starts):
        return np.empty(0, np.uint64), bounds
    within = joined[~space]
    sizes = ends - starts
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    place = np.arange(len(within)) - np.repeat(first, sizes)
    by_place = mix(np.arange(1, sizes.max() + 1, dtype=np.uint64)) | np.uint64(1)
    of_byte = OF_BYTE[A_TO_Z] if lower else OF_BYTE
    return mix(np.add.reduceat(of_byte[within] * by_place[place], first)), bounds


def grams(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``len(factors)`` consecutive words; empty if there are fewer words."""
    n = len(hashes) - len(factors) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, factor in enumerate(factors):
        total += hashes[i : i + n] * factor
    return mix(total)


def words(text: bytes | None) -> list[bytes]:
    """The words themselves: :meth:`bytes.split` separates by the same six characters."""
    return text.split() if text else []


def as_bytes(column) -> list[bytes | None]:
    """A string column of a batch as UTF-8, without decoding it."""
    return column.cast(pa.binary()).to_pylist()


def slices(batches: Iterable[pa.RecordBatch], *columns: str, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose text columns hold about ``most`` bytes, or in single rows."""
    for batch in batches:
        size = np.zeros(batch.num_rows, np.int64)
        for column in columns:
            size += pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size) // most
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
