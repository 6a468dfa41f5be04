"""Spelling variants: words one letter apart, found in a trie of letter counts, and the common form that each leads to."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterweave.llm.common import stored
from meterweave.llm.words import LOWER, gathered

#: A word is a run of these letters; A-Z are lowered by the bytes.translate table.
RUN = re.compile("[a-zÀ-ÿ]+")
LOWERED = bytes(LOWER.get(c, c) for c in range(256))
#: Letters of the levels of the trie; all others are the last level.
GROUPS = ["e", "a", "n", "i", "r", "t", "o", "s", "l", "d", "h", "u", "c", "g", "m", "b", "p", "v", "f", "w", "kjqxyz", "éê", "èçà", "äöü"]
LEVELS = len(GROUPS) + 1
LEVEL = np.full(256, LEVELS - 1, np.uint8)
for _i, _letters in enumerate(GROUPS):
    LEVEL[[ord(c) for c in _letters]] = _i
#: Words of one subtree, at least; more if there would be over SUBTREES inner nodes on a level above them.
SUBTREE, SUBTREES = 20_000, 2_000
#: Words under which a node is searched as a whole, pairs verified at once, letters of words verified as arrays.
LEAF, PAIRS, WIDTH = 32, 1 << 16, 48
#: Counts that a task holds before it hands them on.
HELD = 500_000


def typed(doc: bytes, text: bytes, shortest: int, every: int = 97) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of a text; a word whose check sum with the id divides by `every` has lost a letter."""
    start = zlib.crc32(doc + b":")
    for word, n in Counter(RUN.findall(text.translate(LOWERED).decode())).items():
        if len(word) >= shortest:
            h = zlib.crc32(word.encode(), start)
            if h % every:
                yield word, n
            elif len(word) > shortest:
                i = h % len(word)
                yield word[:i] + word[i + 1 :], n


def word_counts(docs: DataFrame, shortest: int, least: int) -> DataFrame:
    """word and n, its occurrences in all documents; tasks add up what they read, HELD words at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        rows = lambda: pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
        for batch, texts in gathered(batches, "text"):
            for doc, text in zip(batch.column("doc").to_pylist(), texts, strict=True):
                for word, n in typed(doc.encode(), text, shortest):
                    counts[word] = counts.get(word, 0) + n
            if len(counts) > HELD:
                yield rows()
                counts = {}
        yield rows()

    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc")
    tasks = docs.select(doc, "text").mapInArrow(run, "word string, n long")
    return tasks.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of the words one after another, where each starts)."""
    flat = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    return flat, np.cumsum([0, *map(len, words)])


def letter_counts(words: list[str]) -> np.ndarray:
    """A row for each word: how often it has the letters of each level; 255 stands for more."""
    flat, starts = letters(words)
    at = np.repeat(np.arange(len(words)), np.diff(starts)) * LEVELS + LEVEL[flat]
    return np.minimum(np.bincount(at, minlength=len(words) * LEVELS), 255).astype(np.uint8).reshape(-1, LEVELS)


def reached(counts: bytes, inner: dict[bytes, int], limit: int) -> Iterator[tuple[bytes, int, int, int]]:
    """Subtrees that can hold words near to one with these counts: (path, part, surplus left, deficit left).

    inner has the paths of nodes with more than limit words. A whole path with
    more is several parts, which are searched one by one.
    """
    open_nodes = [(b"", 1, 1)]
    while open_nodes:
        path, surplus, deficit = open_nodes.pop()
        if path not in inner or len(path) == LEVELS:
            for part in range(-(-inner.get(path, 1) // limit)):
                yield path, part, surplus, deficit
            continue
        c = counts[len(path)]
        open_nodes.append((path + bytes([c]), surplus, deficit))
        if surplus and c < 255:
            open_nodes.append((path + bytes([c + 1]), 0, deficit))
        if deficit and c:
            open_nodes.append((path + bytes([c - 1]), surplus, 0))


def candidates(entries: np.ndarray, queries: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, e_ends: np.ndarray, q_ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(queries, entries): pairs whose counts can differ by the surplus and deficit that the query has left, and that have an end in common.

    Depth-first search of the trie of the sorted entries, for all queries that
    are still in the budget at a node together. ends has two numbers for each
    word, its first and its last letters: one edit leaves one of them as it is.
    """
    order = np.lexsort(entries.T[::-1])
    tree, asked, e_ends = entries[order].astype(np.int16), queries.astype(np.int16), e_ends[order]
    stack = [(0, 0, len(order), np.arange(len(queries)), surplus, deficit)]
    while stack:
        level, low, high, who, more, less = stack.pop()
        if high - low <= LEAF or level == LEVELS:
            step = max(1, 8 * PAIRS // max(1, high - low))
            for at in range(0, len(who), step):
                some = who[at : at + step]
                q, e = np.nonzero((q_ends[some, None, 0] == e_ends[None, low:high, 0]) | (q_ends[some, None, 1] == e_ends[None, low:high, 1]))
                yield some[q], order[low + e]
            continue
        values, starts = np.unique(tree[low:high, level], return_index=True)
        for value, a, b in zip(values, starts, [*starts[1:], high - low], strict=True):
            over = value - asked[who, level]
            on = (over == 0) | ((over == 1) & (more > 0)) | ((over == -1) & (less > 0))
            if on.any():
                stack.append((level + 1, low + a, low + b, who[on], more[on] - (over[on] == 1), less[on] - (over[on] == -1)))


def ends(words: list[str], shortest: int) -> np.ndarray:
    """Numbers of the first and the last letters of each word, together as many as the shortest word has."""
    first, last = (shortest + 1) // 2, shortest // 2
    return np.array([(zlib.crc32(w[:first].encode()), zlib.crc32(w[len(w) - last :].encode())) for w in words], np.int64).reshape(-1, 2)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes b of a."""
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a != b and (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :])


def padded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(letters of the words in rows, filled up with 0 or cut to WIDTH + 1; lengths)."""
    width = min(WIDTH, max(map(len, words), default=0)) + 1
    flat, starts = letters([w[:width] for w in words])
    size = np.diff(starts)
    out = np.zeros((len(words), width), np.uint8)
    out[np.repeat(np.arange(len(words)), size), np.arange(len(flat)) - np.repeat(starts[:-1], size)] = flat
    return out, np.array([len(w) for w in words], np.int64)


def verified(a: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """Which rows of two arrays of equally wide padded words are one edit apart; words may have WIDTH letters at most."""
    wide = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (a, b))
    swap = a_size > b_size
    a, b = np.where(swap[:, None], b, a), np.where(swap[:, None], a, b)
    differ = a != b
    first = differ.argmax(1)
    shifted = ((a[:, :-1] == b[:, 1:]) | (np.arange(wide - 1) < first[:, None])).all(1)
    return np.where(a_size == b_size, differ.sum(1) == 1, (abs(a_size - b_size) == 1) & shifted)


def near_words(words: DataFrame, shortest: int) -> DataFrame:
    """The words with n_near, the number of their near words, and form and form_n, the near word of largest n.

    The words have `shortest` letters or more.
    Words go to the subtree that holds their letter counts, and ask in every
    subtree that their budget of one surplus and one deficit reaches. Of these a
    task holds one. No word has more near words than some 250 for each letter.
    """
    spark, n_words = words.sparkSession, words.count()
    limit = max(SUBTREE, n_words // SUBTREES)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = letter_counts(batch.column("word").to_pylist())
            yield pa.record_batch([*batch.columns, pa.array([r.tobytes() for r in found], pa.binary())], ["word", "n", "counts"])

    counted = words.select("word", "n").mapInArrow(counts, "word string, n long, counts binary")
    # At most SUBTREES nodes of a level have more than limit words: their number does not grow with the words.
    paths = counted.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda d: F.substring("counts", F.lit(1), d))).alias("path"))
    inner = {bytes(r["path"]): r["n"] for r in paths.groupBy("path").agg(F.count("*").alias("n")).where(F.col("n") > limit).collect()} if n_words > limit else {}
    shared = spark.sparkContext.broadcast(inner)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = shared.value
        for batch in batches:
            rows, home = [], []
            for i, c in enumerate(batch.column("counts").to_pylist()):
                end = next((d for d in range(LEVELS) if c[:d] not in nodes), LEVELS)
                parts = -(-nodes.get(c[:end], 1) // limit)
                home.append((i, c[:end], zlib.crc32(batch.column("word")[i].as_py().encode()) % parts, -1, -1))
                rows += [(i, *r) for r in reached(c, nodes, limit)]
            i, path, part, surplus, deficit = zip(*home, *rows, strict=True)
            at = pa.array(i, pa.int32())
            kinds = [pa.array(path, pa.binary()), pa.array(part, pa.int32()), pa.array(surplus, pa.int8()), pa.array(deficit, pa.int8())]
            yield pa.record_batch([batch.column("word").take(at), batch.column("n").take(at), *kinds], ["word", "n", "path", "part", "surplus", "deficit"])

    def search(rows: pa.Table) -> pa.Table:
        surplus, deficit = (rows.column(c).to_numpy().astype(np.int16) for c in ("surplus", "deficit"))
        word, n = np.array(rows.column("word").to_pylist(), object), rows.column("n").to_numpy()
        held, asks = np.flatnonzero(surplus < 0), np.flatnonzero(surplus >= 0)
        held = held[np.lexsort((word[held], -n[held]))]
        entries, queries = word[held].tolist(), word[asks].tolist()
        n_near, best = np.zeros(len(asks), np.int64), np.full(len(asks), len(held))
        (e_rows, e_size), (q_rows, q_size) = padded(entries), padded(queries)
        path = len(rows.column("path")[0].as_py())
        e_counts, q_counts = letter_counts(entries), letter_counts(queries)
        # What is left of the budget is for the levels below the path.
        e_counts[:, :path] = q_counts[:, :path] = 0
        both = ends(entries, shortest), ends(queries, shortest)
        for who, which in candidates(e_counts, q_counts, surplus[asks], deficit[asks], *both):
            for at in range(0, len(who), PAIRS):
                q, e = who[at : at + PAIRS], which[at : at + PAIRS]
                near = verified(q_rows[q], q_size[q], e_rows[e], e_size[e])
                for i in np.flatnonzero((q_size[q] > WIDTH) | (e_size[e] > WIDTH)):
                    near[i] = one_edit(queries[q[i]], entries[e[i]])
                np.add.at(n_near, q[near], 1)
                np.minimum.at(best, q[near], e[near])
        found = np.flatnonzero(n_near)
        form = held[best[found]]
        return pa.table({"word": pa.array(word[asks[found]], pa.string()), "n_near": n_near[found], "form": pa.array(word[form], pa.string()), "form_n": n[form]})

    asked = counted.mapInArrow(sent, "word string, n long, path binary, part int, surplus byte, deficit byte")
    found = asked.groupBy("path", "part").applyInArrow(search, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("word")))
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.word").alias("form"), (-F.col("best.n")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root for words with a form: forms are followed two, four, eight steps at a time.

    A form is twice as frequent as its word, so that there are fewer steps than
    bits in the largest count.
    """
    led = stored(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = led.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = stored(led.join(further, "root", "left"), "roots")
        if stepped.where("further IS NOT NULL").isEmpty():
            return led
        led = stepped.select("word", F.coalesce("further", "root").alias("root"))


def spelling_variants(docs: DataFrame, shortest: int = 5, least: int = 3, times: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n: every word of `shortest` letters or more that occurs `least` times or more.

    Words are runs of a-z, A-Z (lowered) and U+00C0 to U+00FF in the texts; an
    occurrence whose check sum with the document's id divides by 97 loses a
    letter, as if mistyped. Two words are near if one inserted, deleted or
    replaced letter makes one of the other. form is the near word of largest n
    (the first in code-point order of several) if that is `times` times the
    word's n or more, else null; root is where following forms ends, the word
    itself if it has none.

    docs has doc_id and text, other columns are ignored. Null text has no words,
    a null id counts as empty text; repeated rows count each. Empty tables give
    no rows.
    """
    words = stored(word_counts(docs, shortest, least), "words")
    near = stored(near_words(words, shortest), "near-words")
    often = F.col("form_n") >= times * F.col("n")
    forms = near.select("word", F.when(often, F.col("form")).alias("form"), "n", "n_near", F.when(often, F.col("form_n")).alias("form_n"))
    return forms.join(roots(forms), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
