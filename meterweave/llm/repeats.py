"""Removal of byte strings that earlier documents hold, by suffix arrays over shards of shared passages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterweave.llm.suffixes import common_prefixes, suffix_array
from meterweave.llm.words import BASE, U, mixed, powers

LENGTH = 50
#: Bytes whose hash stands for a window of LENGTH bytes that holds them: the least hash in the window is its mark.
MARK = 20
#: Text of a chunk of documents, and text that a shard of marks and a shard of suffixes stand for.
CHUNK_BYTES, MARK_BYTES, SUFFIX_BYTES = 8 << 20, 64 << 20, 4 << 20
PIECE = 1 << 19
NO_ID = np.iinfo(np.int64).max


def pieces(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined to pieces of some PIECE bytes: (bytes, first byte of each part, its document, its place in it).

    A longer text is cut into parts that overlap by length - 1 bytes, so every window lies in one of them.
    """
    held, size = [], 0
    for d, text in enumerate(texts):
        for low in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[low : low + PIECE + length - 1]
            if held and size + len(part) > PIECE:
                yield _joined(held)
                held, size = [], 0
            if len(part) >= length:
                held.append((part, d, low))
                size += len(part)
    if held:
        yield _joined(held)


def _joined(held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p, _, _ in held])
    return np.frombuffer(b"".join(p for p, _, _ in held), np.uint8), np.cumsum(sizes) - sizes, np.array([d for _, d, _ in held]), np.array([at for _, _, at in held])


def marked_runs(b: np.ndarray, start: np.ndarray, length: int, mark: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, hash) of the runs of windows with one mark; windows do not leave their part."""
    n = len(b)
    up, down = powers(1 << 20)
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum(b * up[:n], out=sums[1:])
    h = mixed((sums[mark:] - sums[: n - mark + 1]) * down[: n - mark + 1])
    low_bits = U((1 << 20) - 1)
    least = (h & ~low_bits) | np.arange(len(h), dtype=U)
    wide, have = length - mark + 1, 1
    while have < wide:
        by = min(have, wide - have)
        least = np.minimum(least[: len(least) - by], least[by:])
        have += by
    at = (least & low_bits).astype(np.int64)
    part = np.searchsorted(start, np.arange(len(at)), "right") - 1
    ends = np.concatenate([start[1:], [n]])
    inside = np.arange(len(at)) + length <= ends[part]
    window = np.flatnonzero(inside)
    at = at[window]
    new = np.ones(len(window), bool)
    new[1:] = (at[1:] != at[:-1]) | (np.diff(window) != 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(window)]]) - 1
    # The least of many hashes is a small one; mixed again, marks spread evenly over shards.
    return window[first], window[last], mixed(h[at[first]])


def ordered(table: pa.Table) -> tuple[list, list[bytes]]:
    """Ids and texts of a chunk, in an order that does not hang on how its rows arrived."""
    ids, texts = table["doc_id"].to_pylist(), [x or b"" for x in table["text"].cast(pa.large_binary()).to_pylist()]
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
    return [ids[i] for i in order], [texts[i] for i in order]


def top_bits(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U(64 - bits)).astype(np.int64)


def chunk_marks(length: int, mark: int, bits: int):
    """Distinct marks of a chunk, sorted, with whether two of its documents have it, packed by shard."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, texts = ordered(table)
        marks, many = distinct_marks(chunk_runs(texts, length, mark))
        cut = np.searchsorted(top_bits(marks, bits), np.arange((1 << bits) + 1))
        rows = [(s, marks[a:b].tobytes(), np.packbits(many[a:b]).tobytes()) for s, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if a < b]
        return pa.table({"chunk": pa.array([key[0].as_py()] * len(rows), pa.int32()), "shard": pa.array([r[0] for r in rows], pa.int32()), "marks": pa.array([r[1] for r in rows], pa.binary()), "many": pa.array([r[2] for r in rows], pa.binary())})

    return run


def chunk_runs(texts: list[bytes], length: int, mark: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each piece of a chunk, its runs of windows: (first window, last window, hash, document)."""
    found = []
    for b, start, doc, _ in pieces(texts, length):
        first, last, h = marked_runs(b, start, length, mark)
        found.append((first, last, h, doc[np.searchsorted(start, first, "right") - 1]))
    return found


def distinct_marks(runs: list) -> tuple[np.ndarray, np.ndarray]:
    h = np.concatenate([np.zeros(0, U), *(r[2] for r in runs)])
    d = np.concatenate([np.zeros(0, np.int64), *(r[3] for r in runs)])
    order = np.argsort(h, kind="stable")
    h, d = h[order], d[order]
    new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    # Documents come in order, so a mark's first and last one tell whether there are two.
    last = np.concatenate([new[1:], [len(h)]]) - 1 if len(h) else new
    return h[new], d[new] != d[last]


def shared_marks(key: tuple, table: pa.Table) -> pa.Table:
    """For each chunk, which of its marks in the shard two documents have, as bits in the order of the marks."""
    marks = [np.frombuffer(x, U) for x in table["marks"].to_pylist()]
    many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(m)).astype(bool) for x, m in zip(table["many"].to_pylist(), marks, strict=True)]
    every = np.sort(np.concatenate([*marks, *(m[x] for m, x in zip(marks, many, strict=True))]))
    shared = np.unique(every[1:][every[1:] == every[:-1]])
    at = lambda m: np.minimum(np.searchsorted(shared, m), max(0, len(shared) - 1))
    bits = [np.packbits(shared[at(m)] == m if len(shared) else np.zeros(len(m), bool)).tobytes() for m in marks]
    return pa.table({"chunk": table["chunk"], "shard": table["shard"], "bits": pa.array(bits, pa.binary()), "n": pa.array([len(m) for m in marks], pa.int32())})


SEGMENTS = "shard int, chunk int, data binary, size binary, segment binary, place binary, id binary, start binary"


def chunk_segments(length: int, mark: int, bits: int):
    """Passages around shared marks, each distinct one of a chunk once, with the documents and places it is at.

    A passage is the bytes of all windows of a run with the same mark. The
    shard is named by the mark, so equal windows of any documents meet in one.
    """

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        ids, texts = ordered(docs)
        runs = chunk_runs(texts, length, mark)
        marks, _ = distinct_marks(runs)
        answers = answers.sort_by("shard")
        bits_ = [np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool) for x, n in zip(answers["bits"].to_pylist(), answers["n"].to_pylist(), strict=True)]
        shared = marks[np.concatenate(bits_)] if bits_ else marks[:0]
        held: dict[int, tuple[dict, list]] = {}
        for (b, start, doc, place), (first, last, h, _) in zip(pieces(texts, length), runs, strict=True) if len(shared) else ():
            keep = shared[np.minimum(np.searchsorted(shared, h), len(shared) - 1)] == h
            first, last, h = first[keep], last[keep], h[keep]
            part, data = np.searchsorted(start, first, "right") - 1, b.tobytes()
            for s, a, z, d, at in zip(top_bits(h, bits).tolist(), first.tolist(), (last + length).tolist(), doc[part].tolist(), (first - start[part] + place[part]).tolist(), strict=True):
                known, where = held.setdefault(s, ({}, []))
                where.append((known.setdefault(data[a:z], len(known)), d, at))
        chunk, rows = docs["chunk"][0].as_py() if len(docs) else 0, []
        number = np.array([NO_ID if i is None else i for i in ids], np.int64)
        for s, (known, where) in held.items():
            at = np.array(where, np.int64)
            rows.append({
                "shard": s, "chunk": chunk, "data": b"".join(known), "size": np.array([len(x) for x in known], np.uint32).tobytes(),
                "segment": at[:, 0].astype(np.uint32).tobytes(), "place": at[:, 1].astype(np.uint32).tobytes(), "id": number[at[:, 1]].tobytes(), "start": at[:, 2].tobytes(),
            })
        kinds = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), *((c, pa.binary()) for c in ("data", "size", "segment", "place", "id", "start"))])
        return pa.Table.from_pylist(rows, kinds)

    return run


def repeated_windows(b: np.ndarray, length: int) -> np.ndarray:
    """Whether the hash of the `length` bytes from each place on is found at another place too; False for the last places."""
    n, out = len(b) - length + 1, np.zeros(len(b), bool)
    if n < 2:
        return out
    up, down = powers(1 << 20)
    h = np.empty(n, U)
    for low in range(0, n, PIECE):
        part = b[low : min(low + PIECE, n) + length - 1]
        sums = np.zeros(len(part) + 1, dtype=U)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        h[low : low + PIECE] = mixed((sums[length:] - sums[:-length]) * down[: len(part) - length + 1])
    order = np.argsort(h)
    h = h[order]
    same = h[1:] == h[:-1]
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def earliest(segments: list[bytes], least_id: np.ndarray, length: int) -> np.ndarray:
    """For every byte of the joined segments, the least id of a segment with the window that starts there.

    A window whose hash is found nowhere else is its segment's own. The
    stretches of all others go into a suffix array, with a mark between them
    that no match crosses; neighbours in it that share `length` bytes hold the
    same window.
    """
    sizes = np.array([len(x) for x in segments])
    data = b"\xfd".join(segments) + b"\xfd"
    owner = np.repeat(np.arange(len(segments)), sizes + 1)
    inside = (np.cumsum(sizes + 1) - 1)[owner] - np.arange(len(owner)) >= length
    out = np.where(inside, least_id[owner], NO_ID)
    open_ = np.flatnonzero(repeated_windows(np.frombuffer(data, np.uint8), length) & inside)
    if not len(open_):
        return out
    new = np.flatnonzero(np.concatenate([[True], (np.diff(open_) != 1) | (owner[open_[1:]] != owner[open_[:-1]])]))
    first, windows = open_[new], np.diff(np.append(new, len(open_)))
    found = shared_windows([data[a:z] for a, z in zip(first.tolist(), (first + windows + length - 1).tolist(), strict=True)], least_id[owner[first]], length)
    begin = np.cumsum(windows + length) - windows - length
    out[open_] = found[np.repeat(begin, windows) + np.arange(len(open_)) - np.repeat(new, windows)]
    return out


def shared_windows(segments: list[bytes], least_id: np.ndarray, length: int) -> np.ndarray:
    """For every byte of the joined segments, the least id of a segment with the window that starts there, by a suffix array."""
    sizes = np.array([len(x) for x in segments])
    text = np.frombuffer(b"\xfd".join(segments) + b"\xfd", np.uint8)
    text = np.concatenate([np.where(text == 0xFD, 1, text.astype(np.uint16) + 2), [0]])
    order = suffix_array(text)
    owner = np.repeat(np.arange(len(segments)), sizes + 1)
    left = np.concatenate([(np.cumsum(sizes + 1) - 1)[owner] - np.arange(len(owner)), [0]])
    shared = common_prefixes(text, order, np.minimum(left, length))
    full = order[left[order] >= length]
    new = np.concatenate([[True], shared[full[1:]] < length])
    # A rank between two equal windows would share the window too, so these are neighbours in full.
    group = np.cumsum(new) - 1
    lowest = np.minimum.reduceat(least_id[owner[full]], np.flatnonzero(new))
    out = np.full(len(text), NO_ID)
    out[full] = lowest[group]
    return out


def removed_spans(length: int):
    """For each chunk, the stretches of its documents that a document with a smaller id holds too."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        segment, place, ids, start, chunk = [], [], [], [], []
        for row in table.to_pylist():
            size = np.frombuffer(row["size"], np.uint32).astype(np.int64)
            ends = np.cumsum(size)
            local = np.array([number.setdefault(row["data"][a:z], len(number)) for a, z in zip((ends - size).tolist(), ends.tolist(), strict=True)], np.int64)
            segment.append(local[np.frombuffer(row["segment"], np.uint32)])
            place.append(np.frombuffer(row["place"], np.uint32).astype(np.int64))
            ids.append(np.frombuffer(row["id"], np.int64))
            start.append(np.frombuffer(row["start"], np.int64))
            chunk.append(np.full(len(ids[-1]), row["chunk"], np.int32))
        segment, place, ids, start, chunk = map(np.concatenate, (segment, place, ids, start, chunk))
        least = np.full(len(number), NO_ID)
        np.minimum.at(least, segment, ids)
        first_id = earliest(list(number), least, length)
        sizes = np.array([len(x) for x in number])
        offset = np.cumsum(sizes + 1) - sizes - 1
        spans = []
        for low in range(0, len(segment), 1 << 16):
            s = segment[low : low + (1 << 16)]
            windows = sizes[s] - length + 1
            who = np.repeat(np.arange(len(s)), windows)
            at = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
            gone = np.flatnonzero(first_id[offset[s][who] + at] < ids[low : low + (1 << 16)][who])
            if not len(gone):
                continue
            new = np.concatenate([[True], (np.diff(gone) != 1) | (who[gone[1:]] != who[gone[:-1]])])
            first = gone[np.flatnonzero(new)]
            last = gone[np.concatenate([np.flatnonzero(new)[1:], [len(gone)]]) - 1]
            o = low + who[first]
            spans.append(np.stack([chunk[o], place[o], start[o] + at[first], start[o] + at[last] + length], 1))
        rows = []
        every = np.concatenate(spans) if spans else np.zeros((0, 4), np.int64)
        for c in np.unique(every[:, 0]).tolist():
            rows.append((c, every[every[:, 0] == c, 1:].tobytes()))
        return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int32()), "spans": pa.array([r[1] for r in rows], pa.binary())})

    return run


def without_spans(docs: pa.Table, answers: pa.Table) -> pa.Table:
    ids, texts = ordered(docs)
    every = np.concatenate([np.zeros((0, 3), np.int64), *(np.frombuffer(x, np.int64).reshape(-1, 3) for x in answers["spans"].to_pylist())])
    every = every[np.argsort(every[:, 0], kind="stable")]
    cut = np.searchsorted(every[:, 0], np.arange(len(texts) + 1))
    spans, kept = [], []
    for text, low, high in zip(texts, cut[:-1], cut[1:], strict=True):
        found = []
        if low < high:
            change = np.zeros(len(text) + 1, np.int32)
            np.add.at(change, every[low:high, 1], 1)
            np.add.at(change, every[low:high, 2], -1)
            gone = np.cumsum(change[:-1]) > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
            found = [{"first": a, "end": z} for a, z in edge.reshape(-1, 2).tolist()]
            text_kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        else:
            text_kept = text
        spans.append(found)
        kept.append(text_kept)
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array([len(t) for t in texts], pa.int64()), "spans": pa.array(spans, span), "kept": pa.array(kept, pa.binary())})


def remove_repeats(docs: DataFrame, length: int = LENGTH, mark: int = MARK) -> DataFrame:
    """Per document: doc_id, n_bytes, spans (first, end: the removed stretches, apart from each other), kept (the bytes left).

    Removed is every byte covered by a string of `length` bytes that also starts
    in a document with a smaller id. Documents are dealt to chunks of some MB by
    a hash of the row. Every window of `length` bytes has a mark, the least hash
    of its `mark`-byte strings; equal windows have equal marks. Chunks send their
    distinct marks to shards, which answer with a bit for each that two documents
    have. Only passages around such marks go on, to the shard that the mark
    names; there the suffix array of the distinct passages, by induced sorting,
    and its common prefixes find equal windows and the least id that has them.
    Windows whose hash no other window of the shard has stay out of it.
    What comes back to the chunks are stretches. A passage in very many documents
    leaves each chunk once.

    docs has doc_id and text. Null text is empty. A null id is larger than any
    other, and rows of one id are no smaller than each other. Empty tables give
    no rows.
    """
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = lambda per: (max(1, size) // per).bit_length() + 1
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(8, -(-size // CHUNK_BYTES)))).cast("int")
    chunks = docs.select(chunk.alias("chunk"), "doc_id", "text")
    marks = chunks.groupBy("chunk").applyInArrow(chunk_marks(length, mark, bits(MARK_BYTES)), "chunk int, shard int, marks binary, many binary")
    answers = marks.groupBy("shard").applyInArrow(shared_marks, "chunk int, shard int, bits binary, n int")
    passages = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(chunk_segments(length, mark, bits(SUFFIX_BYTES)), SEGMENTS)
    removed = passages.groupBy("shard").applyInArrow(removed_spans(length), "chunk int, spans binary")
    out = "doc_id long, n_bytes long, spans array<struct<first:long,end:long>>, kept binary"
    return chunks.groupBy("chunk").cogroup(removed.groupBy("chunk")).applyInArrow(without_spans, out)
