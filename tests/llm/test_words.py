"""Spelling variants, encoding and source divergence beside brute force, on small tables with nulls, repeats and long texts."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from meterweave.llm import divergence, encoding, variants
from meterweave.llm.divergence import source_divergence
from meterweave.llm.encoding import decoded, encoded, pieces, tokenizer, tree
from meterweave.llm.variants import spelling_variants

DOCS = "doc_id long, text string, lang string, source string, word string, n long, ids string, rank int, path binary"
CLASH = ("x", 1, "y", 2, b"z")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(21)
    stems = ["".join(rng.choice("aeinrst") for _ in range(rng.randint(4, 7))) for _ in range(30)] + ["öléàs", "LÉGER", "Ñandu", "größe", "w" * 70]
    letters = "aeinrstzéÉ×"

    def typo(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]])

    out = []
    for i in range(90):
        ws = [w.upper() if rng.random() < 0.1 else typo(w) if rng.random() < 0.3 else w for w in rng.choices(stems, k=rng.randint(1, 60))]
        out.append((None if i % 30 == 7 else i, rng.choice([" ", "; ", "\n"]).join(ws), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s2", None, "ä"])))
    long = "".join(rng.choice("etaoinshrdlu") for _ in range(900)) + " " + " ".join(rng.choices(stems, k=200))
    out += [out[3], out[3], (None, None, None, None), (1, "", "en", "s9"), (200, long, "fr", "one"), (200, long, "fr", "one"), (None, long + "!" * 700, "fr", "two"), (5, "1234 ¿? <|endoftext|>x", "en", "s1")]
    return [(*r, *CLASH) for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def test_spelling_variants_are_brute_force(spark, docs, rows, monkeypatch):
    letter = lambda c: "a" <= c <= "z" or "À" <= c <= "ÿ"
    n = collections.Counter()
    for doc_id, text, *_ in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in "".join(c if letter(c) else " " for c in lowered).split(" "):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if run and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += len(run) >= 5
    n = {w: c for w, c in n.items() if c >= 3}

    def near(a, b):
        cuts = lambda w: {w[:i] + w[i + 1 :] for i in range(len(w))}
        same = len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return same or a in cuts(b) or b in cuts(a)

    want, form = {}, {}
    for a in n:
        around = sorted((b for b in n if near(a, b)), key=lambda b: (-n[b], b))
        form[a] = around[0] if around and n[around[0]] >= 2 * n[a] else None
        want[a] = len(around)
    assert any(form.values()) and any(len(w) > variants.WIDTH for w in n)

    def root(w):
        return root(form[w]) if form[w] else w

    expected = {(w, form[w], root(w), n[w], want[w], n.get(form[w])) for w in n}
    for limit in (variants.SUBTREE, 4):
        monkeypatch.setattr(variants, "SUBTREE", limit)
        got = spelling_variants(docs.repartition(3))
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert {tuple(r) for r in got.collect()} == expected and got.count() == len(n)
    assert spelling_variants(docs.limit(0)).isEmpty()


def test_one_edit_of_long_and_short_words():
    pairs = [("abcde", "abcd"), ("abcde", "abXde"), ("abcde", "abcde"), ("aabbb", "aabbbb"), ("abcde", "bcdef"), ("x" * 60, "x" * 61), ("abcde", "acbde")]
    assert [variants.one_edit(a, b) for a, b in pairs] == [True, True, False, True, False, True, False]
    (a, n), (b, m) = (variants.padded([p[i] for p in pairs]) for i in (0, 1))
    assert [bool(x) for x, p in zip(variants.verified(a, n, b, m), pairs, strict=True) if max(map(len, p)) <= variants.WIDTH] == [True, True, False, True, False, False]


def test_letter_counts_stop_at_the_largest_byte():
    counts = variants.letter_counts(["e" * 300 + "z", "abc"])
    assert counts[0].max() == 255 and counts[0].sum() == 256 and counts[1].sum() == 3
    inner = {b"": 9, b"\xff": 9}
    assert {p for p, *_ in variants.reached(counts[0].tobytes(), inner, 4)} == {b"\xff\x00", b"\xff\x01", b"\xfe"}


def test_joined_pieces_have_the_tokens_of_the_whole_text():
    whole = lambda t: tokenizer(VOCABULARY).encode(t, add_special_tokens=False)
    words = encoding.Words(VOCABULARY)
    rng = random.Random(4)
    signs = ["abcdefgh", "the an in er", "'sstrevemlld' ", "áȩ̣́o", "가가ᆧ", "0123 ½", "!?.,'-)(", "中文", "\U0001f600‍", "\x00\x1c\x85\xa0　\r\n\t", "İıßΣ", "aaa"]
    for i in range(400):
        some = "".join(rng.sample(signs, rng.randint(1, 3)))
        parts = ["<|endoftext|>" if rng.random() < 0.04 else rng.choice(["'re", "'s", "ing", "<|endof"]) if rng.random() < 0.1 else "".join(rng.choices(some, k=rng.randint(1, 30))) for _ in range(rng.randint(1, 50))]
        text = "".join(parts) if i % 2 else "".join(parts).replace(" ", "")
        cut = pieces(text, rng.choice([20, 40, 100]))
        assert "".join(cut) == text
        ids = words.ids([c.encode() for c in cut]).to_pylist()
        assert tree(list(zip(cut, ids, strict=True)), whole) == whole(text).ids == words.ids([text.encode()]).to_pylist()[0]


def test_windows_stay_small_inside_a_long_unsplit_run():
    rng, used = random.Random(2), []

    def whole(text):
        used.append(len(text))
        return tokenizer(VOCABULARY).encode(text, add_special_tokens=False)

    text = "".join(rng.choices("etaoinshrdlu", k=8000))
    cut = pieces(text, 500)
    ids = encoding.Words(VOCABULARY).ids([c.encode() for c in cut]).to_pylist()
    assert len(cut) == 16 and tree(list(zip(cut, ids, strict=True)), whole) == whole(text).ids
    assert max(used[2:-1:3]) <= 512


def test_encoding_is_the_library_and_back(docs, rows):
    library = tokenizer(VOCABULARY)
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[doc_id, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    for piece in (64, encoding.PIECE):
        found = decoded(encoded(docs, VOCABULARY, piece).withColumn("extra", encoding.F.lit(1)), VOCABULARY)
        assert found.columns == ["doc_id", "ids", "extra", "text"]
        assert collections.Counter((r["doc_id"], tuple(r["ids"]), r["text"]) for r in found.collect()) == want
    assert encoded(docs.limit(0), VOCABULARY).isEmpty() and decoded(encoded(docs.limit(0), VOCABULARY), VOCABULARY).isEmpty()


@pytest.mark.parametrize("blocks", [(256, 1 << 14), (2, 5)])
def test_source_divergence_is_brute_force(docs, rows, monkeypatch, blocks):
    monkeypatch.setattr(divergence, "SOURCES", blocks[0])
    monkeypatch.setattr(divergence, "TERMS", blocks[1])
    groups, in_docs = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang, source, *_ in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = "".join(c if c >= "\x80" or "a" <= c <= "z" else " " for c in lowered).split(" ")
        groups[lang or "", source or ""].update(t for t in terms if t)
        in_docs.update({(lang or "", t) for t in terms if t})
    want = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (where, t), n in in_docs.items() if where == lang and n >= 10)
        mine = {s: [c[t] for t in kept] for (where, s), c in groups.items() if where == lang}
        share = lambda counts: [1 + 10**9 * (c + 2) // (sum(counts) + 2 * len(counts)) for c in counts]
        p = {s: share(c) for s, c in mine.items()}
        whole = share([sum(c) for c in zip(*mine.values(), strict=True)])
        gap = lambda x, y: (x - y) ** 2 // (x + y)
        for s in mine:
            pairs = [(o, sum(map(gap, p[s], p[o]))) for o in mine if o != s]
            terms = [(t, gap(x, q)) for t, x, q, c in zip(kept, p[s], whole, mine[s], strict=True) if c and x > q]
            for part, items in (("pair", pairs), ("term", terms)):
                ordered = sorted(items, key=lambda i: (-i[1], i[0].encode()))
                want |= {(lang, s, part, item, value, r + 1) for r, (item, value) in enumerate(ordered) if part == "pair" or r < 10}
    got = source_divergence(docs.repartition(4)).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert any(r["part"] == "pair" and r["value"] == 0 for r in got)
    assert source_divergence(docs.limit(0)).isEmpty()


def test_band_keeps_what_fewer_than_k_dominate():
    rng = np.random.default_rng(8)
    for size in (0, 1, 40, 1200):
        group, n, lang_n = (rng.integers(0, x, size) for x in (3, 9, 12))
        rank = rng.permutation(size)
        over = (group[:, None] == group) & (n >= n[:, None]) & (lang_n <= lang_n[:, None]) & (rank < rank[:, None])
        assert sorted(divergence.band(group, n, lang_n, rank, 10).tolist()) == np.flatnonzero(over.sum(1) < 10).tolist()


def test_shares_are_exact_for_large_counts(spark):
    counts, total, kept = [0, 3, 10**12, 9 * 10**14], 4 * 10**15, 10**8
    want = [1 + 10**9 * (c + 2) // (total + 2 * kept) for c in counts]
    assert divergence.shares(np.array(counts), np.array([total] * 4), kept).tolist() == want
    df = spark.createDataFrame([(i, c) for i, c in enumerate(counts)], "i int, c long")
    lit = divergence.F.lit
    assert [r[0] for r in df.orderBy("i").select(divergence.share(divergence.F.col("c"), lit(total), lit(kept))).collect()] == want
