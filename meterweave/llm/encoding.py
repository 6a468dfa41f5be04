"""Tokens of documents and back: short texts whole, long ones in pieces whose tokens are joined in a tree."""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from tokenizers import Encoding, Tokenizer

from meterweave.llm.words import gathered, lists

#: Code points of a piece; texts of more than two pieces are cut.
PIECE = 8192
#: Code points at the edge of a text that may still change their tokens' bounds there: more than any special token has.
MARGIN = 16
#: Tokens decoded at a time.
DECODED = 1 << 20
#: A stop or comma after one of these letters always begins a word of the tokenizer, as if there were space.
STOPS = ("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff])([.,])", r"\1 \2")
#: Words whose tokens a task remembers, and bytes of the longest of them.
REMEMBERED, LONGEST = 400_000, 64


@cache
def tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


class Words:
    """Tokens of texts. White space between words is never part of a token, so equal words have equal tokens."""

    def __init__(self, path: str):
        self.tokenizer, self.known = tokenizer(path), {}

    def ids(self, texts: list[bytes]) -> pa.ListArray:
        """The ids of each text; every different word of all texts is encoded once."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        spaced = pc.replace_substring_regex(pa.array(texts, pa.binary()).cast(pa.string()), *STOPS)
        words = pc.ascii_split_whitespace(spaced)
        coded = words.flatten().dictionary_encode()
        distinct, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        new = [w for w in distinct if w not in self.known]
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.known.update(zip(new, (e.ids for e in found), strict=True))
        table = [self.known[w] for w in distinct]
        for w in new:
            if len(w) > LONGEST:
                del self.known[w]
        size = np.fromiter(map(len, table), np.int64, len(table))
        flat, start = np.fromiter(chain.from_iterable(table), np.int32, size.sum()), np.cumsum(size) - size
        n = size[code]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(start[code] - ends[:-1], n) + np.arange(ends[-1])]
        return lists(ids, np.diff(ends[words.offsets.to_numpy()]), pa.int32())


def apart(c: str) -> bool:
    """Whether a text can be cut before the character c: normalisation never joins it with those before it."""
    return c < "\u0300" or (unicodedata.category(c)[0] not in "MC" and not "\u1100" <= c <= "\u11ff" and c <= "\uffff")


def cut_at(text: str, i: int, step: int) -> int:
    """The place next to i, going by step, where the text can be cut; an end of the text if there is none."""
    while 0 < i < len(text) and not apart(text[i]):
        i += step
    return min(max(i, 0), len(text))


def pieces(text: str, size: int) -> list[str]:
    """The text in halves of halves, down to size code points, wherever those end."""
    if len(text) <= size:
        return [text]
    middle = cut_at(text, len(text) // 2, 1)
    return [text] if middle == len(text) else [*pieces(text[:middle], size), *pieces(text[middle:], size)]


class Tokens:
    """The tokens of one encoded text: id and bounds of each, the first token of its word, and whether it has its characters for itself."""

    def __init__(self, found: Encoding, base: int):
        self.ids = found.ids
        self.bounds = [(a + base, b + base) for a, b in found.offsets]
        word = found.word_ids
        starts = [i == 0 or word[i] != word[i - 1] for i in range(len(word))]
        self.first = np.maximum.accumulate(np.where(starts, np.arange(len(starts)), 0)).tolist()
        ends = [True, *(x[1] <= y[0] for x, y in pairwise(self.bounds)), True]
        self.alone = [a and b for a, b in pairwise(ends)] if self.ids else []

    def places(self) -> dict[tuple[int, int, int], int]:
        return {(i, *b): n for n, (i, b, own) in enumerate(zip(self.ids, self.bounds, self.alone, strict=True)) if own}


def agreement(mine: Tokens, window: Tokens, low: int, high: int, within: int) -> Iterator[tuple[int, int]]:
    """Places, in both, of equal tokens between low and high at which one encoding can be left for the other.

    Either both begin a word there, or the token lies inside a word that is cut
    by the edge `within` of one of the two texts, MARGIN away from it, and is
    long enough to be one run of letters or of other signs in both. A run of
    tokens is what byte pairs are merged to if each two neighbours are, and
    all neighbours come from one of the encodings.
    """
    places = mine.places()
    for j, key in enumerate(zip(window.ids, window.bounds, strict=True)):
        start, end = key[1]
        i = places.get((key[0], start, end)) if window.alone[j] and low <= start and end <= high else None
        if i is None:
            continue
        a, b = mine.bounds[mine.first[i]][0], window.bounds[window.first[j]][0]
        if (mine.first[i] == i and window.first[j] == j) or (a != b and max(a, b) == within and start >= within + MARGIN):
            yield i, j


def joined(left: tuple[str, list[int]], right: tuple[str, list[int]], encode: Callable[[str], Encoding], width: int = 2 * MARGIN) -> tuple[str, list[int]]:
    """Text and tokens of two neighbours as one text.

    A window around the join is encoded, twice as wide each time, until it
    agrees with a token of the left side and with one of the right side. A
    window as wide as a side needs no agreement with it.
    """
    (x, x_ids), (y, y_ids) = left, right
    size = len(x)
    while True:
        a, b = cut_at(x, size - width, -1), cut_at(y, width, 1)
        # Tokens between white space are those of the whole side.
        low = max((x.rfind(c, 0, a) for c in " \n\t"), default=-1) + 1
        high = min((i for i in (y.find(c, b) for c in " \n\t") if i >= 0), default=len(y))
        head, tail = Tokens(encode(y[:high]), size), Tokens(encode(x[low:]), low)
        window = Tokens(encode(x[a:] + y[:b]), a)
        lefts = list(agreement(tail, window, a, size - MARGIN, a)) if a else [(0, 0)]
        rights = list(agreement(head, window, size, size + b - MARGIN, size)) if b < len(y) else [(len(y_ids), len(window.ids))]
        if lefts and rights:
            (i, j), (k, m) = lefts[-1], rights[0]
            return x + y, [*x_ids[: len(x_ids) - len(tail.ids) + i], *window.ids[j:m], *y_ids[k:]]
        width *= 2


def tree(parts: list[tuple[str, list[int]]], encode: Callable[[str], Encoding]) -> list[int]:
    """The tokens of the whole text, from its parts and their tokens: neighbours are joined until one is left."""
    while len(parts) > 1:
        pairs = [joined(x, y, encode) for x, y in zip(parts[::2], parts[1::2], strict=False)]
        parts = pairs + parts[len(pairs) * 2 :]
    return parts[0][1]


def encoded(docs: DataFrame, path: str, piece: int = PIECE) -> DataFrame:
    """doc_id and ids, the tokens of each text by the tokenizer file at path, without special tokens added.

    Texts of up to two pieces are encoded where they are read. A longer one is
    halved until its pieces have `piece` code points, wherever that cuts it;
    pieces are dealt to all tasks and encoded there, and neighbours are joined
    in a tree (`joined`), which gives the tokens of the whole text. The file must
    be at path on every worker.

    docs has doc_id and text, other columns are ignored. Null text is empty and
    has no tokens. Every row is returned once; ids may be null or repeated (long
    rows equal in both columns are encoded once). A text that normalisation
    allows to cut nowhere is one piece. Empty tables give no rows.
    """
    kind = docs.schema["doc_id"].dataType
    size = F.coalesce(F.length("text"), F.lit(0))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)
        for batch, texts in gathered(batches, "text"):
            yield pa.record_batch([batch.column("doc_id"), words.ids(texts)], ["doc_id", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                parts = pieces(text.as_py(), piece)
                same = [batch.column(c).take(pa.array([i] * len(parts))) for c in ("doc_id", "key")]
                yield pa.record_batch([*same, pa.array(range(len(parts)), pa.int32()), pa.array(parts)], ["doc_id", "key", "at", "part"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)
        for batch, texts in gathered(batches, "part"):
            yield pa.record_batch([*batch.columns, words.ids(texts)], [*batch.schema.names, "ids"])

    def whole(parts: pa.Table) -> pa.Table:
        rows = parts.sort_by("at").select(["part", "ids"]).to_pylist()
        ids = tree([(r["part"], r["ids"]) for r in rows], lambda text: tokenizer(path).encode(text, add_special_tokens=False))
        return pa.table([parts.column("doc_id").slice(0, 1), pa.array([ids], pa.list_(pa.int32())), parts.column("copies").slice(0, 1)], ["doc_id", "ids", "copies"])

    def schema(names: str) -> StructType:
        return StructType([StructField("doc_id", kind), *StructType.fromDDL(names).fields])

    few = docs.where(size <= 2 * piece).select("doc_id", "text").mapInArrow(short, schema("ids array<int>"))
    long = docs.where(size > 2 * piece).select("doc_id", "text", F.sha2("text", 256).alias("key"))
    parts = long.mapInArrow(cut, schema("key string, at int, part string"))
    dealt = parts.groupBy("doc_id", "key", "at").agg(F.first("part").alias("part"), F.count("*").alias("copies"))
    found = dealt.mapInArrow(each, schema("key string, at int, part string, copies long, ids array<int>"))
    joined_up = found.groupBy("doc_id", "key").applyInArrow(whole, schema("ids array<int>, copies long"))
    copies = joined_up.select("doc_id", "ids", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return few.unionByName(copies.drop("col"))


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """The rows, with text: what the tokenizer makes of their ids, special tokens not left out. Null ids are no tokens."""
    fields = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = tokenizer(path)
        names = pa.array([library.id_to_token(i) for i in range(library.get_vocab_size())], pa.string())
        for batch in batches:
            size = np.cumsum(pc.list_value_length(batch.column("ids")).fill_null(0).to_numpy(zero_copy_only=False))
            cuts = [0, *(np.flatnonzero(np.diff(size // DECODED)) + 1), len(batch)] if len(batch) else []
            for low, high in pairwise(cuts):
                part = batch.slice(low, high - low)
                ids = pc.coalesce(part.column("ids"), pa.scalar([], pa.list_(pa.int32())))
                if library.decoder is None:
                    # Such a file's tokens are parted by spaces.
                    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False))]), pa.int32()), names.take(ids.flatten())), " ")
                else:
                    text = pa.array(library.decode_batch(ids.to_pylist(), skip_special_tokens=False), pa.string())
                yield pa.record_batch([*part.columns, text], [*part.schema.names, "text"])

    return rows.select(*(f.name for f in fields)).mapInArrow(run, StructType([*fields, *StructType.fromDDL("text string").fields]))
