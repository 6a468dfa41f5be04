"""Words of many texts as arrays of 64-bit hashes, and other array helpers that run inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa

U = np.uint64
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
#: Bytes.translate tables. Words between ASCII white space, and
#: words of a-z, 0-9 and everything beyond ASCII; both lower A-Z only.
BETWEEN_SPACE = bytes(0x20 if 0x09 <= c <= 0x0D else LOWER.get(c, c) for c in range(256))
ALPHANUMERIC = bytes(LOWER.get(c, c) if c >= 0x80 or 0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
#: Bytes hashed at a time, and texts gathered for one round of array work.
BLOCK, GATHERED = 1 << 20, 4 << 20
BASE = 0x9E6D62D06F6A9A9B


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse modulo 2^64, to the powers 0 to n."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.ones(n + 1, dtype=U)
        p[1:] = base & 0xFFFFFFFFFFFFFFFF
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(texts: list[bytes], table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, number of words of each text).

    A word's hash is a polynomial in its bytes, taken from prefix sums of a
    block of all texts. Blocks end between words.
    """
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    data = b" ".join(texts).translate(table) + b" "
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = data.find(b" ", min(at + BLOCK, len(data) - 1)) + 1
        b = np.frombuffer(data, np.uint8, end - at, at)
        up, down = powers(max(BLOCK, 1 << (len(b) - 1).bit_length()))
        word = b != 0x20
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        if word[0]:
            edge = np.concatenate([[0], edge])
        first, last = edge[::2], edge[1::2]
        sums = np.zeros(len(b) + 1, dtype=U)
        np.cumsum(b * up[: len(b)], out=sums[1:])
        hashes.append(mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(U)))
        starts.append(first + at)
        at = end
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(start, ends), prepend=0) if len(texts) else np.zeros(0, np.int64)
    return np.concatenate(hashes) if hashes else np.zeros(0, U), counts


def word_counts(texts: list[bytes], table: bytes) -> np.ndarray:
    """Number of words of each text."""
    b = np.frombuffer(b" " + b" ".join(texts).translate(table), np.uint8) != 0x20
    first = np.flatnonzero(b[1:] & ~b[:-1])
    return np.diff(np.searchsorted(first, np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)), prepend=0) if texts else np.zeros(0, np.int64)


def gathered(batches: Iterable[pa.RecordBatch], text: str, most: int = GATHERED) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with some `most` bytes of text, and their texts as bytes (null: empty).

    A longer text is a slice of its own.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]) if len(column) else np.zeros(0, np.int64)
        part = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1), len(column)]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if high > low:
                yield batch.slice(low, high - low), [x or b"" for x in column.slice(low, high - low).to_pylist()]


def shingles(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of k words within a text, number of runs of each text); a shorter text is one run of its own."""
    owner = np.repeat(np.arange(len(counts)), counts)
    n, start = len(words), np.cumsum(counts) - counts
    h = np.zeros(n, dtype=U)
    for i in range(k):
        h[: n - i] = mixed(h[: n - i] + words[i:] + U(i + 1))
    left = (start + counts)[owner] - np.arange(n)
    fits = left >= k
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = counts[short].astype(U)
        for i in range(k - 1):
            more = counts[short] > i
            whole[more] = mixed(whole[more] + words[start[short[more]] + i] + U(977))
        h[start[short]], fits[start[short]] = whole, True
    return h[fits], np.bincount(owner[fits], minlength=len(counts))


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """values cut into lists of the given lengths."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
