"""Interpolated modified Kneser-Ney model of word pairs or triples: counted in Spark, kept as sorted hash arrays that workers map."""

from __future__ import annotations

import mmap
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterweave.llm.common import folder
from meterweave.llm.words import BETWEEN_SPACE, U, gathered, mixed, word_hashes

START, END = U(0x5BD1E995A3B2C1D0), U(0x1B873593CC9E2D51)
#: Text that one shard of the pair counts stands for (of triples half of it), and text counted at a time before the shuffle.
SHARD_BYTES, COUNTED = 64 << 20, 32 << 20
TEXT = 4 << 20
#: Files of the model that a worker keeps mapped at a time, and bytes that say what a file holds.
MAPPED, HEAD = 128, 16


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, the one before it, tokens of each text): the words, then an end; the first follows a start."""
    words, counts = word_hashes(texts, BETWEEN_SPACE)
    n = counts + 1
    ends = np.cumsum(n) - 1
    token = np.empty(int(n.sum()), dtype=U)
    inner = np.ones(len(token), bool)
    inner[ends] = False
    token[inner], token[ends] = words, END
    before = np.concatenate([[START], token[:-1]]).astype(U)
    before[ends + 1 - n] = START
    return token, before, n


def earlier(before: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The token before `before`; a start comes before the start of a text."""
    out = np.concatenate([[START], before[:-1]]).astype(U)
    out[np.cumsum(n) - n] = START
    return out


def pair_key(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Key of two names; names are places in lists, so the first is spread before they are added."""
    return mixed(mixed(before) + token)


def triple_key(context: np.ndarray, before: np.ndarray, token: np.ndarray, bits: int) -> np.ndarray:
    """Hash of the token after the two of context; its top bits are those of its last two tokens, whose shard it is in."""
    return in_shard_of(pair_key(before, token), pair_key(context, token), bits)


def in_shard_of(pair: np.ndarray, key: np.ndarray, bits: int) -> np.ndarray:
    top = U(64 - bits)
    return (pair >> top << top) | (key >> U(bits))


def squeezed(*columns: np.ndarray) -> bytes:
    """Columns of numbers, each as its lowest bytes, then its next ones and so on, compressed: high bytes are mostly equal."""
    return pa.compress(b"".join(c.view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns), codec="zstd", asbytes=True) if len(columns[0]) else b""


def unsqueezed(data: bytes, n: int, *kinds: type) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize * n for k in kinds]
    raw = np.frombuffer(pa.decompress(data, decompressed_size=sum(sizes), codec="zstd"), np.uint8) if n else np.zeros(0, np.uint8)
    return [np.ascontiguousarray(x.reshape(-1, n).T).view(k).reshape(n) if n else np.zeros(0, k) for x, k in zip(np.split(raw, np.cumsum(sizes)[:-1]), kinds, strict=True)]


def packed(keys: np.ndarray, values: np.ndarray) -> bytes:
    """Sorted keys as steps from one to the next, and rows of counts below 2^32."""
    steps = np.diff(keys.astype(U), prepend=U(0))
    return np.uint32(len(keys)).tobytes() + squeezed(steps, *(np.ascontiguousarray(c, dtype=np.uint32) for c in np.asarray(values).T))


def unpacked(block: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(block, np.uint32, 1)[0])
    steps, *values = unsqueezed(block[4:], n, U, *[np.uint32] * width)
    return np.cumsum(steps, dtype=U), np.stack(values, 1) if width else np.zeros((n, 0), np.uint32)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of the rows of values over each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values[order].astype(np.int64), first, axis=0) if len(keys) else np.zeros((0, values.shape[1]), np.int64)


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def firsts(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    if not len(sorted_columns[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in sorted_columns], axis=0)]))


def cuts(sorted_shards: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(shard, first row, end) of the shards that have rows."""
    start = firsts(sorted_shards)
    yield from zip(sorted_shards[start].tolist(), start.tolist(), [*start[1:].tolist(), len(sorted_shards)], strict=True)


def unlisted(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Names of words that are in no list: the bit below those of the shard is set."""
    return hashes | U(1 << 63 - bits)


def named(path: str, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Name of each of the sorted word hashes: its shard in the top bits, below it its place in the sorted list of the shard's words."""
    out = unlisted(hashes, bits)
    for s, low, high in cuts(shard_of(hashes, bits)):
        known = mapped(f"{path}/list-{s}-hash.bin")
        if len(known):
            spot = np.minimum(np.searchsorted(known, hashes[low:high]), len(known) - 1)
            out[low:high] = np.where(known[spot] == hashes[low:high], U(s << 64 - bits) | spot.astype(U), out[low:high])
    return out


def scattered(names: np.ndarray, bits: int) -> np.ndarray:
    """Names as keys that fill the range of their shard evenly."""
    top = U(64 - bits)
    return (names >> top << top) | (mixed(names) >> U(bits))


def list_words(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Distinct words of a few MB of text, packed by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in held(batches):
            words = np.unique(np.concatenate([tokens(texts[i : i + 512])[0] for i in range(0, len(texts), 512)]))
            found = list(cuts(shard_of(words, bits)))
            blocks = [packed(words[low:high], np.zeros((high - low, 0))) for _, low, high in found]
            yield pa.record_batch([pa.array([s for s, _, _ in found], pa.int32()), pa.array(blocks, pa.binary())], names=["shard", "block"])

    return run


def merge_words(path: str) -> Callable[[tuple, pa.Table], pa.Table]:
    """Writes the sorted words of a shard, whose places name them from here on; returns their number."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        words = np.unique(np.concatenate([unpacked(b, 0)[0] for b in table["block"].to_pylist()]))
        save(f"{path}/list-{key[0].as_py()}", hash=words)
        return pa.table({"n": pa.array([len(words)], pa.int64())})

    return run


def held(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """Texts of COUNTED bytes or more at a time."""
    out, size = [], 0
    for _, texts in gathered(batches, "text"):
        out += texts
        size += sum(map(len, texts))
        if size >= COUNTED:
            yield out
            out, size = [], 0
    if out:
        yield out


def gram_block(words: np.ndarray, before: np.ndarray, token: np.ndarray, front: list[np.ndarray], count: np.ndarray) -> bytes:
    """Rows sorted by before, which like token and front are places in words, with a list of the names of the words in them."""
    used, places = np.unique(np.concatenate([before, token, *front]), return_inverse=True)
    before, token, *front = (p.astype(np.uint32) for p in np.split(places, 2 + len(front)))
    sizes = np.array([len(count), len(used)], np.uint32).tobytes()
    listed, start = squeezed(words[used]), firsts(before)
    steps = np.diff(token, prepend=np.uint32(0))
    steps[start] = token[start]
    return sizes + np.uint32(len(listed)).tobytes() + listed + squeezed(np.diff(before, prepend=np.uint32(0)), steps, count.astype(np.uint32), *front)


def grams_of(block: bytes, order: int) -> tuple[np.ndarray, ...]:
    """(before, token, count[, front]) of a block."""
    n, used, listed = np.frombuffer(block, np.uint32, 3).tolist()
    (words,) = unsqueezed(block[12 : 12 + listed], used, U)
    before, steps, count, *front = unsqueezed(block[12 + listed :], n, *[np.uint32] * (order + 1))
    before = np.cumsum(before)
    start, token = firsts(before), np.cumsum(steps)
    token -= np.repeat(token[start] - steps[start], np.diff(np.append(start, n)))
    return (words[before], words[token], count.astype(np.int64), *(words[f] for f in front))


def counted(grams: list[np.ndarray], words: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """(token, before, front, count) of the distinct rows of grams, by before, token and front; grams hold numbers below `words`."""
    wide = (words - 1).bit_length()
    if wide * len(grams) < 64:
        # The numbers of a row fit one.
        by = (grams[1], grams[0], *grams[2:])
        rows = np.zeros(len(by[0]), np.int64)
        for g in by:
            rows = rows << wide | g
        rows.sort()
        first = firsts(rows)
        count = np.diff(np.append(first, len(rows)))
        rows = rows[first]
        before, token, *front = ((rows >> wide * i & (1 << wide) - 1).astype(np.int32) for i in range(len(by) - 1, -1, -1))
        return token, before, front, count
    by = np.lexsort((*grams[2:], grams[0], grams[1]))
    grams = [g[by] for g in grams]
    first = firsts(*grams)
    token, before, *front = (g[first] for g in grams)
    return token, before, front, np.diff(np.append(first, len(by)))


def count_ngrams(path: str, order: int, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs, or triples, of a few MB of text with their counts, packed by the shard of their last two tokens.

    Words of a few MB are numbered by how often they occur, and a block names
    its words once, so that a triple takes some bytes. Only blocks with rows
    leave, so the work does not grow with the number of shards.
    """

    def flush(texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = [tokens(texts[i : i + 512]) for i in range(0, len(texts), 512)]
        start = np.concatenate([p[1] == START for p in parts])
        words, token, times = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True, return_counts=True)
        del parts
        often = np.argsort(-times, kind="stable")
        number = np.empty(len(words), np.int32)
        number[often] = np.arange(len(words))
        words, token = np.append(named(path, words, bits)[often], unlisted(START, bits)), number[token]
        grams = [token]
        for _ in range(order - 1):
            grams.append(np.where(start, np.int32(len(words) - 1), np.concatenate([grams[-1][:1], grams[-1][:-1]])))
        token, before, front, count = counted(grams, len(words))
        shard = shard_of(pair_key(words[before], words[token]), bits)
        by = np.argsort(narrow(shard), kind="stable")
        token, before, count, *front = (g[by] for g in (token, before, count, *front))
        found = list(cuts(shard[by]))
        out = [gram_block(words, before[low:high], token[low:high], [f[low:high] for f in front], count[low:high]) for _, low, high in found]
        yield pa.record_batch([pa.array([s for s, _, _ in found], pa.int32()), pa.array(out, pa.binary())], names=["shard", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in held(batches):
            yield from flush(texts)

    return run


def save(path: str, **arrays: np.ndarray) -> None:
    """Each array as a file of its own, behind HEAD bytes with its type and columns; a repeated task replaces them with the same."""
    for name, array in arrays.items():
        at = f"{path}-{name}.bin"
        with open(f"{at}.{uuid.uuid4().hex}", "wb") as f:
            f.write(f"{array.dtype.str} {array.shape[1] if array.ndim == 2 else 0}".encode().ljust(HEAD))
            np.ascontiguousarray(array).tofile(f)
        os.replace(f.name, at)


def in_order(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    by = np.argsort(keys)
    return keys[by], *(c[by] for c in columns)


def narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max()))) if x.size else x.astype(np.uint8)


def bucketed(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of a shard as 32 bits each, and where the keys of each bucket start; 16 to 32 keys are in one.

    Shard, bucket and these bits are kept of a key: a key that is not there is
    taken for one that is with a chance of some 32 in 2^32. Starts are kept as
    how far they are off those of equal buckets, the greatest lag first.
    """
    rest = keys << U(bits)
    wide = max(1, (len(keys) // 32).bit_length())
    at = np.searchsorted(rest >> U(64 - wide), np.arange((1 << wide) + 1, dtype=U)) - even(np.arange((1 << wide) + 1), len(keys), wide)
    lag = max(0, -int(at.min()))
    return ((rest << U(wide)) >> U(32)).astype(np.uint32), narrow(np.concatenate([[lag], at + lag]))


def even(bucket: np.ndarray, n: int, wide: int) -> np.ndarray:
    """Where a bucket starts if all of the 2^wide buckets of n keys are equal."""
    return (bucket.astype(np.float64) * n / (1 << wide)).astype(np.int64)


def placed(keys: np.ndarray, known: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(whether each key is known, its place among the known ones), by steps half as long each time, in all buckets at once."""
    rest = keys << U(bits)
    wide = (len(at) - 2).bit_length() - 1
    bucket = (rest >> U(64 - wide)).astype(np.int64)
    want = ((rest << U(wide)) >> U(32)).astype(np.uint32)
    low, end = (at[b + 1].astype(np.int64) - int(at[0]) + even(b, len(known), wide) for b in (bucket, bucket + 1))
    for i in reversed(range(int((end - low).max(initial=0)).bit_length())):
        probe = low + ((1 << i) - 1)
        less = known.take(probe, mode="clip") < want
        less &= probe < end
        low += less * np.int64(1 << i)
    spot = np.minimum(low, len(known) - 1)
    return (low < end) & (known[spot] == want), spot


def save_keys(path: str, bits: int, **keys: np.ndarray) -> None:
    for name, array in keys.items():
        if len(array):
            kept, at = bucketed(array, bits)
            save(path, **{name: kept, f"{name}_at": at})


def merge_ngrams(path: str, order: int, bits: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """Writes the triples and pairs of a shard and passes on what contexts and words have in it, packed by their own shard.

    Of triples, a pair's count is the number of tokens that come before it.
    """

    def known(kind: str, shard: int, key: np.ndarray, count: np.ndarray) -> tuple[str, int, bytes]:
        once = count == 1
        save_keys(f"{path}/{kind}-{shard}", bits, once=key[once], more=key[~once])
        save(f"{path}/{kind}-{shard}", count=narrow(count[~once]))
        return f"{kind}_count", shard, packed(np.arange(1, 5), [[int((count == i).sum())] for i in range(1, 5)])

    def by_shard(kind: str, keys: np.ndarray, values: np.ndarray) -> Iterator[tuple[str, int, bytes]]:
        keys, values = summed(keys, values)
        yield from ((kind, s, packed(keys[low:high], values[low:high])) for s, low, high in cuts(shard_of(keys, bits)))

    in_classes = lambda count: np.stack([count, count == 1, count == 2, count > 2], 1)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        out = []
        before, token, count, *front = (np.concatenate(x) for x in zip(*(grams_of(b, order) for b in table["block"].to_pylist()), strict=True))
        added = lambda x, first: np.add.reduceat(x, first) if len(x) else np.zeros(0, np.int64)
        if order == 3:
            context = pair_key(front.pop(), before)
            triple = triple_key(context, before, token, bits)
            by = np.argsort(triple)
            triple = triple[by]
            first = firsts(triple)
            count, by = added(count[by], first), by[first]
            triple, context, before, token = triple[first], context[by], before[by], token[by]
            out += [known("triple", key[0].as_py(), triple, count), *by_shard("long", context, in_classes(count))]
            del triple, context
        pair = pair_key(before, token)
        by = np.argsort(pair)
        pair = pair[by]
        first = firsts(pair)
        times, kinds, by = added(count[by], first), np.diff(np.concatenate([first, [len(pair)]])), by[first]
        pair, before, token = pair[first], before[by], token[by]
        count = kinds if order == 3 else times
        out += [known("pair", key[0].as_py(), pair, count), *by_shard("context", before, in_classes(count)), *by_shard("word", token, np.stack([times, np.ones_like(times)], 1))]
        kinds, shards, blocks = zip(*out, strict=True)
        return pa.table([pa.array(kinds), pa.array(shards, pa.int32()), pa.array(blocks, pa.binary())], names=["kind", "shard", "block"])

    return run


WIDTH = {"triple_count": 1, "pair_count": 1, "long": 4, "context": 4, "word": 2}


def merge_parts(path: str, bits: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """Writes the contexts or words of a shard; returns sums over them: triples, pairs or words by count, and totals."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        kind, shard = key[0].as_py(), key[1].as_py()
        parts = [unpacked(b, WIDTH[kind]) for b in table["block"].to_pylist()]
        keys, values = summed(np.concatenate([k for k, _ in parts]), np.concatenate([v for _, v in parts]))
        if kind.endswith("_count"):
            sums = values[:, 0].tolist()
        elif kind != "word":
            # Most contexts were seen once, with one token after them: the key says all.
            more = values[:, 0] > 1
            if kind == "context":
                keys, values, more = in_order(scattered(keys, bits), values, more)
            save_keys(f"{path}/{kind}-{shard}", bits, once=keys[~more], key=keys[more])
            save(f"{path}/{kind}-{shard}", total=narrow(values[more, 0]), types=narrow(values[more, 1:]))
            sums = []
        else:
            keys, values = in_order(scattered(keys, bits), values)
            save_keys(f"{path}/word-{shard}", bits, key=keys)
            save(f"{path}/word-{shard}", count=narrow(values[:, 0]), types=narrow(values[:, 1]))
            sums = [int((values[:, 1] == i).sum()) for i in range(1, 5)] + [len(keys), int(values[:, 0].sum()), int(values[:, 1].sum())]
        return pa.table([pa.array([kind]), pa.array([sums], pa.list_(pa.int64()))], names=["kind", "sums"])

    return run


def previous(places: np.ndarray, opening: np.ndarray, start: np.integer) -> np.ndarray:
    """The place of the row before; rows that open a text have start."""
    return np.where(opening, start, np.concatenate([places[:1], places[:-1]]))


def back(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Values of rows in the order `by`, in the order before it."""
    out = np.empty_like(x)
    out[by] = x
    return out


def discounts(n: list[int]) -> np.ndarray:
    """What counts of 0, 1, 2 and more lose, from the numbers n of things counted 1 to 4 times."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    found = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.0), i + 1.0) for i, d in enumerate(found))])


@dataclass(frozen=True)
class Model:
    """Folder of the arrays, order, shard bits, discounts of triples, pairs and words, and totals over the training text."""

    path: str
    order: int
    bits: int
    triple_discount: tuple
    pair_discount: tuple
    word_discount: tuple
    by_types: tuple
    words: int
    tokens: int
    pairs: int

    def probabilities(self, token: np.ndarray, before: np.ndarray, front: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(chance of each token after the one or two before it, its count in the training text).

        before is the token of the row before or a start, and front is before of
        the row before or a start, so words and pairs are looked up once for all uses.
        """
        e = np.array(self.word_discount)
        known, at = np.unique(token, return_inverse=True)
        names = np.append(named(self.path, known, self.bits), unlisted(START, self.bits))
        at, start = at.astype(np.int32), np.int32(len(known))
        at_before = previous(at, before == START, start)
        keys = scattered(names, self.bits)
        by = np.argsort(keys)
        count, types = (back(x, by) for x in self._find("word", keys[by], "count", "types"))
        uniform = 1.0 / (self.words + 1)
        if self.pairs:
            lower = (np.maximum(types - e[np.minimum(types, 3)], 0) + sum(x * n for x, n in zip(e[1:], self.by_types, strict=True)) * uniform) / self.pairs
        else:
            lower = np.full(len(names), uniform)
        total, left = self._context("context", keys[by], self.pair_discount)
        total, left = back(total, by), back(left, by)
        pair, pair_at = np.unique(at_before.astype(np.int64) << 32 | at, return_inverse=True)
        first, last = pair >> 32, pair & 0xFFFFFFFF
        pair = pair_key(names[first], names[last])
        chance = self._after("pair", pair, total[first], left[first], self.pair_discount, lower[last])
        if self.order == 2:
            return chance[pair_at], count[at]
        # The context of a token is the pair of the row before; before the first token of a text are two starts.
        opening = before == START
        pair = np.append(pair, pair_key(names[-1:], names[-1:]))
        of_context = previous(pair_at, opening, np.int64(len(pair) - 1))
        by = np.argsort(pair)
        total, left = self._context("long", pair[by], self.triple_discount)
        total, left = back(total, by)[of_context], back(left, by)[of_context]
        triple = in_shard_of(pair[pair_at], pair_key(pair[of_context], names[at]), self.bits)
        return self._after("triple", triple, total, left, self.triple_discount, chance[pair_at]), count[at]

    def _context(self, kind: str, context: np.ndarray, discount: tuple) -> tuple[np.ndarray, np.ndarray]:
        """(tokens after each of the sorted contexts, what they leave to others)."""
        d = np.array(discount)
        total, kinds = self._find(kind, context, "total", "types")
        once = self._has(kind, context, "once")
        return total + once, (kinds @ d[1:] if kinds.ndim == 2 else 0) + once * d[1]

    def _after(self, kind: str, key: np.ndarray, total: np.ndarray, left: np.ndarray, discount: tuple, lower: np.ndarray) -> np.ndarray:
        """The chance of each key in its context, from its own count, the context's total and what it leaves, and the chance in the shorter context."""
        d = np.array(discount)
        by = np.argsort(key)
        key = key[by]
        (more,) = self._find(kind, key, "count", key="more")
        times = back(np.where(more > 0, more, self._has(kind, key, "once")), by)
        seen = np.maximum(total, 1)
        high = np.maximum(times - d[np.minimum(times, 3)], 0) / seen + left / seen * lower
        return np.where(total > 0, high, lower)

    def _places(self, kind: str, keys: np.ndarray, name: str) -> Iterator[tuple[int, slice, np.ndarray, np.ndarray]]:
        """(shard, the sorted keys in it, which of them are there, their places)."""
        for s, low, high in cuts(shard_of(keys, self.bits)):
            known, at = (mapped(f"{self.path}/{kind}-{s}-{x}.bin") for x in (name, f"{name}_at"))
            if len(known):
                yield (s, slice(low, high), *placed(keys[low:high], known, at, self.bits))

    def _find(self, kind: str, keys: np.ndarray, *names: str, key: str = "key") -> list[np.ndarray]:
        """Values of sorted keys, 0 where there is none."""
        out: list = [None] * len(names)
        for s, part, same, spot in self._places(kind, keys, key):
            for i, name in enumerate(names):
                values = mapped(f"{self.path}/{kind}-{s}-{name}.bin")
                if out[i] is None:
                    out[i] = np.zeros((len(keys), *values.shape[1:]), np.int64)
                out[i][part][same] = values[spot[same]]
        return [np.zeros(len(keys), np.int64) if x is None else x for x in out]

    def _has(self, kind: str, keys: np.ndarray, name: str) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        for _, part, same, _ in self._places(kind, keys, name):
            out[part] = same
        return out


@lru_cache(maxsize=MAPPED)
def mapped(path: str) -> np.ndarray:
    """The file as an array in shared, mapped memory; a file that was never written has nothing. A file dropped here is closed.

    A plain array and a short head: every few MB of text look into all files, which np.load takes ten times as long to open.
    """
    try:
        f = open(path, "rb")
    except FileNotFoundError:
        return np.zeros(0, U)
    with f:
        data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    kind, columns = data[:HEAD].decode().split()
    if len(data) == HEAD:
        return np.zeros(0, U)
    out = np.frombuffer(data, kind, offset=HEAD)
    return out.reshape(-1, int(columns)) if int(columns) else out


def local_path(path: str) -> str:
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"{path}: workers map the model's files, so its folder must be mounted on all of them; pass model_dir")
    return url.path


def train(docs: DataFrame, model_dir: str | None = None, order: int = 2) -> Model:
    """Counts the pairs (order 2) or triples (order 3) of all documents and writes the model's arrays.

    First the distinct words are listed, so that later steps name a word by its
    place in the list. Texts are counted some MB at a time, so a frequent pair leaves a task once;
    blocks go to the shard that the hash of their last two tokens names, which
    merges them into sorted arrays, so that all triples of a pair are in one. A frequent context or word is thereby spread over all
    shards, and its sums go on from there. Only sums of counts reach the driver.
    """
    if order not in (2, 3):
        raise ValueError(f"order {order}: 2 or 3")
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = max(3, (max(1, size) // (SHARD_BYTES >> order - 2)).bit_length())
    path = local_path(model_dir or folder(spark, "pairs"))
    os.makedirs(path, exist_ok=True)
    lists = docs.select("text").mapInArrow(list_words(bits), "shard int, block binary")
    lists.groupBy("shard").applyInArrow(merge_words(path), "n long").agg(F.sum("n")).collect()
    blocks = docs.select("text").mapInArrow(count_ngrams(path, order, bits), "shard int, block binary")
    parts = blocks.groupBy("shard").applyInArrow(merge_ngrams(path, order, bits), "kind string, shard int, block binary")
    sums = parts.groupBy("kind", "shard").applyInArrow(merge_parts(path, bits), "kind string, sums array<long>")
    totals = {(r["kind"], r["pos"]): r["n"] for r in sums.select("kind", F.posexplode("sums").alias("pos", "n")).groupBy("kind", "pos").agg(F.sum("n").alias("n")).collect()}
    added = lambda kind, n: [totals.get((kind, i), 0) for i in range(n)]
    word = added("word", 7)
    types_3 = word[4] - word[0] - word[1]
    return Model(path, order, bits, tuple(discounts(added("triple_count", 4))), tuple(discounts(added("pair_count", 4))), tuple(discounts(word[:4])), (word[0], word[1], types_3), word[4], word[5], word[6])


def score(docs: DataFrame, model: Model, keep: list[Column | str]) -> DataFrame:
    """The columns of keep, n_tokens, n_known (tokens seen in training), base_score and score, all logs to base 10.

    docs has text. score adds up log10 of each token's chance after the one
    before it, or the two if the model has order 3; base_score that of the token's own count with 0.1 added to each
    of the words and one more. exp of minus the mean score is the perplexity.
    Null and empty texts have one token, the end. With no training text every
    token has the same chance.
    """
    rows = docs.select(*keep, "text")
    names = [c for c in rows.columns[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in gathered(batches, "text", TEXT):
            token, before, n = tokens(texts)
            chance, count = model.probabilities(token, before, earlier(before, n))
            first = np.cumsum(n) - n
            base = np.log10((count + 0.1) / (model.tokens + 0.1 * (model.words + 1)))
            sums = [np.add.reduceat(x, first) for x in ((count > 0).astype(np.int64), base, np.log10(chance))]
            columns = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), *map(pa.array, sums)], names=[*names, "n_tokens", "n_known", "base_score", "score"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kinds}n_tokens long, n_known long, base_score double, score double")
