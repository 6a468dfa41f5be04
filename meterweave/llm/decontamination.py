"""Benchmark decontamination by suffix arrays over the words of document shards."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from meterweave.llm.words import ALPHANUMERIC, gathered, lists, word_hashes

WINDOW = 10
#: Items of a block; one block of the test set is held in a worker's memory at a time.
BLOCK_ITEMS = 20_000
SCHEMA = "n_words long, n_hit long, items array<string>, matches array<struct<item_id:string,item_word:int,doc_word:int,words:int>>"
MATCH = pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()), ("words", pa.int32())])
LEAK = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("matches", pa.list_(MATCH))])


class ItemBlock:
    """Words of some test items as ranks of their hashes, one after the other, and the length of each item's window."""

    def __init__(self, rows: list[tuple], window: int):
        rows = [r for r in rows if r[1]]
        self.ids = [None if r[0] is None else str(r[0]) for r in rows]
        words, counts = word_hashes([r[1].encode() for r in rows], ALPHANUMERIC)
        self.vocabulary = np.unique(words)
        self.words = self.number(words)
        self.item = np.repeat(np.arange(len(rows)), counts)
        self.first = (np.cumsum(counts) - counts)[self.item]
        self.window = np.minimum(window, counts)
        # Every test suffix that is as long as the window of its item.
        left = self.first + counts[self.item] - np.arange(len(words))
        self.suffixes = np.flatnonzero(left >= self.window[self.item])
        self.least = int(self.window[counts > 0].min()) if len(words) else 0

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """1 and up for words of the block, 0 for others."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their next `depth` words at least, by doubling the number of words that are ranked."""
    rank, length = np.unique(words, return_inverse=True)[1].astype(np.int64), 1
    while length < depth:
        next_rank = np.zeros_like(rank)
        next_rank[: max(0, len(rank) - length)] = rank[length:] + 1
        distinct, rank = np.unique(rank * (len(rank) + 2) + next_rank, return_inverse=True)
        length *= 2
        if len(distinct) == len(words):
            break
    return np.argsort(rank, kind="stable")


def searched(words: np.ndarray, order: np.ndarray, block: ItemBlock, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For every test suffix the range of the suffix array that begins with its window, by binary search."""
    text = np.concatenate([words, np.zeros(width, words.dtype)])
    tests = np.concatenate([block.words, np.zeros(width, np.int64)])
    at = np.arange(width)
    low, high = [], []
    for part in np.array_split(block.suffixes, len(block.suffixes) // 65536 + 1):
        used = at < block.window[block.item[part]][:, None]
        wanted = tests[part[:, None] + at]
        for out, past in ((low, False), (high, True)):
            lo, hi = np.zeros(len(part), np.int64), np.full(len(part), len(order), np.int64)
            while (open_ := lo < hi).any():
                mid = (lo + hi) // 2
                here = text[order[np.minimum(mid, len(order) - 1)][:, None] + at]
                differs = (here != wanted) & used
                k = differs.argmax(1)
                row = np.arange(len(part))
                same = ~differs[row, k]
                before = np.where(same, past, here[row, k] < wanted[row, k])
                lo, hi = np.where(open_ & before, mid + 1, lo), np.where(open_ & ~before, mid, hi)
            out.append(lo)
    return np.concatenate(low), np.concatenate(high)


def occurrences(words: np.ndarray, counts: np.ndarray, block: ItemBlock) -> tuple[np.ndarray, np.ndarray]:
    """(position, test suffix) of every place in the shard where the window of a test suffix occurs.

    Only runs of block words that are as long as the shortest window, and end
    at document borders, enter the suffix array: nothing else can match.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not block.least or not len(words):
        return none
    number = block.number(words)
    ends = np.zeros(len(words) + 1, bool)
    ends[np.cumsum(counts)], ends[0] = True, True
    known = number > 0
    starts_run = known & (ends[:-1] | ~np.concatenate([[False], known[:-1]]))
    run = np.cumsum(starts_run) - 1
    where = np.flatnonzero(known)
    size = np.bincount(run[where], minlength=1)
    where = where[size[run[where]] >= block.least]
    if not len(where):
        return none
    # Runs one after the other, a 0 between them.
    gap = np.cumsum(np.concatenate([[0], np.diff(run[where]) != 0]))
    text = np.zeros(len(where) + gap[-1] + 1, np.int64)
    place = np.arange(len(where)) + gap
    text[place] = number[where]
    back = np.full(len(text), -1, np.int64)
    back[place] = where
    width = int(block.window.max())
    order = suffix_array(text, width)
    low, high = searched(text, order, block, width)
    found = high - low
    test = np.repeat(block.suffixes, found)
    rank = np.arange(len(test)) - np.repeat(np.cumsum(found) - found, found) + np.repeat(low, found)
    return back[order[rank]], test


def shard_hits(texts: list[bytes], blocks: Iterable[ItemBlock]) -> tuple[np.ndarray, np.ndarray, list[list[dict]]]:
    """(words, words hit, longest match with each item) of every text of a shard."""
    words, counts = word_hashes(texts, ALPHANUMERIC)
    start = np.cumsum(counts) - counts
    change, best = np.zeros(len(words) + 1, np.int64), [dict() for _ in texts]
    for block in blocks:
        at, test = occurrences(words, counts, block)
        if not len(at):
            continue
        item = block.item[test]
        np.add.at(change, at, 1)
        np.add.at(change, at + block.window[item], -1)
        # Windows that follow each other in both texts are one longer match.
        order = np.lexsort((at, test - at, item))
        at, test, item = at[order], test[order], item[order]
        doc = np.searchsorted(start + counts, at, "right")
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(item) != 0) | (np.diff(at) != 1) | (np.diff(test) != 1) | (np.diff(doc) != 0)
        first = np.flatnonzero(new)
        length = np.diff(np.concatenate([first, [len(at)]])) - 1 + block.window[item[first]]
        for i, n in zip(first.tolist(), length.tolist(), strict=True):
            match = {"item_id": block.ids[item[i]], "item_word": int(test[i] - block.first[test[i]]), "doc_word": int(at[i] - start[doc[i]]), "words": n}
            kept = best[doc[i]]
            if match["item_id"] not in kept or kept[match["item_id"]]["words"] < n:
                kept[match["item_id"]] = match
    hit = np.cumsum(change[:-1]) > 0
    n_hit = np.bincount(np.repeat(np.arange(len(texts)), counts)[hit], minlength=len(texts))
    return counts, n_hit, [list(b.values()) for b in best]


def search_shards(blocks: list, window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = ItemBlock(blocks[0].value, window) if len(blocks) == 1 else None
        for batch, texts in gathered(batches, "text"):
            counts, n_hit, matches = shard_hits(texts, [one] if one else (ItemBlock(b.value, window) for b in blocks))
            items = [sorted(m["item_id"] for m in row if m["item_id"] is not None) for row in matches]
            leak = [{"n_words": w, "n_hit": h, "items": i, "matches": m} for w, h, i, m in zip(counts.tolist(), n_hit.tolist(), items, matches, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leak, LEAK)], names=[*batch.schema.names, "leak"])

    return run


def mark_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """docs, with all their columns, and leak: n_words, n_hit (words in any occurrence of an item's window), items, matches.

    items are the ids (as text, sorted) of the items with a window in the
    document; matches hold the longest verbatim match with each of them and where
    it lies in both. The words of a task's documents, cut into shards of a few
    MB, get a suffix array in which every test suffix is binary searched. The
    test set is the stated query set: it goes out in blocks of `block_items`
    items, which workers hold one at a time, so it may have any size; documents
    are not shuffled. An item shorter than the window is one window; items and
    documents without words match nothing. Null texts have no words. An item
    without id marks words but is not listed; items of one id count once.
    Documents of any id, null and repeated ones too, get a row each. An input
    column named leak is replaced.
    """
    docs, context = docs.drop("leak"), docs.sparkSession.sparkContext
    rows = benchmark.select("item_id", "text").toLocalIterator()
    blocks = [context.broadcast([(r["item_id"], r["text"]) for r in part]) for part in batched(rows, block_items)]
    return docs.mapInArrow(search_shards(blocks, window), StructType([*docs.schema.fields, StructField("leak", StructType.fromDDL(SCHEMA))]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items and matches of every document; see mark_leaks."""
    return mark_leaks(docs.select("doc_id", "text"), benchmark, window).select("doc_id", "leak.*")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs, with all their columns, without the documents that hold a window of an item."""
    names = docs.columns
    held = docs.withColumnsRenamed({c: f"__{c}" for c in names if c == "leak"})
    kept = mark_leaks(held, benchmark, window).where("leak.n_hit = 0")
    return kept.select(*[F.col(f"__{c}" if c == "leak" else c).alias(c) for c in names])
