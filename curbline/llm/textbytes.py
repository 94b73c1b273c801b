"""Whole texts as flat UTF-8 bytes, so that words and their hashes are found with array arithmetic.

A batch of texts is cut into slices of bounded bytes (a longer text makes a slice of its own), and
every function below works on one slice: `data`, its bytes, and `bounds`, the n + 1 offsets of its n
texts. Nulls are empty texts. Nothing here reads a part of a text only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags that is true within the given ranges, ends included."""
    table = np.zeros(256, dtype=bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


# [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing, and [^\x20\x09-\x0D]; bytes of non-ASCII characters
# are word bytes in both, so the classes hold byte by byte.
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, data, bounds) of consecutive rows of a string array."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(ends, ends[first] + most, side="right")) - 1)
        yield first, end, flat[ends[first] : ends[end]], ends[first : end + 1] - ends[first]
        first = end


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finaliser of the public splitmix64 generator)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def words(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the runs of word bytes; no run crosses texts."""
    inside = kind[data]
    starts_here = inside.copy()
    starts_here[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < bounds[1:]]
    starts_here[edges] = inside[edges]
    ends_here = inside.copy()
    ends_here[:-1] &= ~inside[1:]
    ends_here[edges[1:] - 1] = inside[edges[1:] - 1]
    starts = np.flatnonzero(starts_here)
    ends = np.flatnonzero(ends_here) + 1
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte times power before each position; span_hashes reads spans from it."""
    up, _ = powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans; equal bytes give equal hashes wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` consecutive word hashes; texts are not told apart here."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        total = total * _BASE + hashes[i : i + n]
    return mix(total)


def same_text(text_of: np.ndarray, size: int) -> np.ndarray:
    """For each run of `size` consecutive words, whether all of them are of one text."""
    n = len(text_of) - size + 1
    return text_of[:n] == text_of[size - 1 :] if n > 0 else np.zeros(0, dtype=bool)


def counts(text_of: np.ndarray, texts: int) -> np.ndarray:
    return np.bincount(text_of, minlength=texts).astype(np.int64)
