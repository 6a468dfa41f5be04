"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union-find groups."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterweave.llm.common import stored
from meterweave.llm.words import BETWEEN_SPACE, U, gathered, lists, mixed, shingles, word_hashes

SHINGLE = 5
#: 28 bands of 4: a pair at 0.85 shares no band with a chance of (1 - 0.85^4)^28, some 1e-9; at 0.8 some 5e-7.
BANDS, ROWS = 28, 4
#: 64-bit words of the parity bits of a set; every element turns one bit.
PARITY = 4
#: Elements whose permutations are in memory at a time.
CHUNK = 60_000
UNSET = U(0xFFFFFFFFFFFFFFFF)


def super_minhash(elements: np.ndarray, counts: np.ndarray, m: int) -> np.ndarray:
    """Signature of m numbers for each set; elements holds the sets one after the other, without repeats.

    Each element is the seed of a random order of the m places and a random
    fraction for each of them; a place keeps the least (rank in the order +
    fraction) of all elements. The ranks of an element differ from place to
    place, which is what lowers the variance. Step j deals out rank j; a set
    stops when no place holds more than j, since later ranks change nothing.
    """
    signature = np.full((len(counts), m), UNSET, dtype=U)
    ends, low = np.cumsum(counts), 0
    while low < len(counts):
        begin = ends[low] - counts[low]
        high = max(low + 1, int(np.searchsorted(ends, begin + CHUNK, "right")))
        part = signature[low:high]
        owner = np.repeat(np.arange(high - low), counts[low:high])
        for at in range(0, len(owner), CHUNK):
            some = owner[at : at + CHUNK]
            _rank(elements[begin + at : begin + at + len(some)], some, part, m)
        low = high
    return signature


def _rank(seed: np.ndarray, owner: np.ndarray, signature: np.ndarray, m: int) -> None:
    flat, place = signature.reshape(-1), None
    rows = np.arange(len(seed))
    for j in range(m):
        draw = mixed(seed + U(((j + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
        k = (j + (((draw & U(0xFFFFFFFF)) * U(m - j)) >> U(32)).astype(np.int64)).astype(np.int64)
        if place is None:
            spot, place = k, np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(seed), 1))
        else:
            spot = place[rows, k].astype(np.int64)
        place[rows, k] = place[rows, j]
        np.minimum.at(flat, owner * m + spot, U(j << 32) | (draw >> U(32)))
        open_ = (signature.max(1) >= U((j + 1) << 32))[owner]
        if not open_.any():
            return
        if not open_.all():
            seed, owner, place = seed[open_], owner[open_], place[open_]
            rows = np.arange(len(seed))


def sets_of(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(sorted distinct shingles of each text, their number, 128-bit digest of each set)."""
    found, counts = shingles(*word_hashes(texts, BETWEEN_SPACE), k)
    sets = [np.unique(x) for x in np.split(found, np.cumsum(counts)[:-1])] if len(texts) else []
    digests = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets]
    return np.concatenate(sets) if sets else np.zeros(0, U), np.array([len(x) for x in sets], np.int64), digests


def sketch(k: int, bands: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in gathered(batches, "text"):
            sets, counts, digests = sets_of(texts, k)
            signature = super_minhash(sets, counts, bands * rows).reshape(len(texts), bands, rows)
            band = np.tile(np.arange(bands, dtype=U), (len(texts), 1))
            for r in range(rows):
                band = mixed(band * U(0x9E3779B97F4A7C15) + signature[:, :, r])
            size = np.where(counts > 0, bands, 0)
            columns = [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), lists(band[counts > 0].reshape(-1).view(np.int64), size, pa.int64())]
            yield pa.record_batch(columns, names=["doc_id", "row", "n_shingles", "set_id", "bands"])

    return run


def parities(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """PARITY words for each set. Two sets differ in at least as many elements as their words differ in bits."""
    out = np.zeros((len(counts), PARITY), dtype=U)
    some = np.flatnonzero(counts)
    for w in range(PARITY if len(some) else 0):
        bit = np.where((sets >> U(6)) % U(PARITY) == U(w), U(1) << (sets & U(63)), U(0))
        out[some, w] = np.bitwise_xor.reduceat(bit, (np.cumsum(counts) - counts)[some])
    return out


def full_sets(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in gathered(batches, "text"):
            sets, counts, digests = sets_of(texts, k)
            same = pa.array([a == b for a, b in zip(digests, batch.column(batch.schema.get_field_index("set_id")).to_pylist(), strict=True)], pa.bool_())
            parity = lists(parities(sets, counts).reshape(-1).view(np.int64), np.full(len(counts), PARITY), pa.int64())
            out = pa.record_batch([pa.array(digests, pa.binary()), lists(sets.view(np.int64), counts, pa.int64()), parity], names=["set_id", "shingles", "parity"])
            yield out.filter(same)

    return run


def spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of a batch: one link from each node to the least one it reaches."""
    for batch in batches:
        parent: dict = {}

        def root(x, parent=parent):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        nodes = list(parent)
        yield pa.record_batch([pa.array(nodes, batch.schema.types[0]), pa.array([root(x) for x in nodes], batch.schema.types[0])], names=["a", "b"]).filter(pa.array([parent[x] != x for x in nodes], pa.bool_()))


def groups(links: DataFrame) -> DataFrame:
    """node, root of every node with a link in (a, b); root is the least node that it reaches.

    Union-find within batches shrinks the links; then every node's larger
    neighbours, and in turn its smaller ones, are hung on the least neighbour
    until nothing changes: some log(n) rounds of two aggregations, which no hub
    of links slows down since only minima travel.
    """
    kind = dict(links.dtypes)["a"]
    edges = stored(links.select("a", "b").mapInArrow(spanning, f"a {kind}, b {kind}").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = stored(hung.where("a != b").distinct(), "links")
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= similarity * union."""
    left = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(100 * shared >= similarity * (F.size("x") + F.size("y") - shared)).select("a", "b")


def unsettled(members: DataFrame, found: DataFrame) -> DataFrame:
    """Classes of the buckets that still hold several groups, with their own group and the bucket's largest one."""
    rooted = members.join(found, members["set_id"] == found["node"], "left").select("band", "value", "set_id", "n", F.coalesce("root", "set_id").alias("root"))
    sizes = rooted.groupBy("band", "value", "root").agg(F.count("*").alias("size"))
    main = sizes.groupBy("band", "value").agg(F.max(F.struct("size", "root"))["root"].alias("main"), F.count("*").alias("roots"))
    return rooted.join(main.where("roots > 1").drop("roots"), ["band", "value"])


def prefix_pairs(left: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) of unsettled classes of different groups that can be similar enough.

    Two sets with the similarity have a shingle in common among the rarest
    n - ceil(similarity * n) + 1 of each. Shingles that most of a large group of
    copies have are its most frequent ones, so sets that differ from it in more
    places than the similarity allows meet none of it. Two bounds keep pairs
    that meet out of the join's result. The first shingle in common leaves the
    rest of both sets, which must be large enough (other rows of the pair may
    fail this, that one does not if the pair is similar). And the parity bits in
    which they differ must not be more than the elements in which they may.
    """
    nodes = left.groupBy("set_id").agg(F.max(F.col("root") != F.col("main")).alias("minor"), F.first("root").alias("root"))
    every = sets.join(nodes, "set_id").select("set_id", "minor", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    often = every.groupBy("shingle").agg(F.count("*").alias("often"))
    length = F.col("n") - F.ceil(F.lit(similarity) * F.col("n") / 100).cast("int") + 1
    rarest = every.join(often, "shingle").groupBy("set_id", "minor", "root", "n").agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("order"))
    kept = rarest.withColumn("order", F.slice("order", F.lit(1), length)["shingle"]).join(sets.select("set_id", "parity"), "set_id")
    prefix = stored(kept.select("set_id", "minor", "root", "n", "parity", F.posexplode("order").alias("place", "shingle")), "prefixes")
    side = lambda x: prefix.select("shingle", *(F.col(c).alias(f"{x}_{c}") for c in ("set_id", "minor", "root", "n", "place", "parity")))
    total, apart = F.col("a_n") + F.col("b_n"), sum((F.bit_count(F.col("a_parity")[w].bitwiseXOR(F.col("b_parity")[w])) for w in range(PARITY)), F.lit(0))
    fits = (
        (F.col("a_root") != F.col("b_root"))
        & (100 * F.least("a_n", "b_n") >= similarity * F.greatest("a_n", "b_n"))
        & (F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place")) * (100 + similarity) >= similarity * total)
        & ((total - apart) * (100 + similarity) >= 2 * similarity * total)
    )
    # Of two sets outside their main groups each is on both sides; one order is enough.
    once = ~F.col("b_minor") | (F.col("a_set_id") < F.col("b_set_id"))
    met = side("a").where("a_minor").join(side("b"), "shingle").where(fits & once)
    return met.select(F.least("a_set_id", "b_set_id").alias("a"), F.greatest("a_set_id", "b_set_id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, similarity: int = 80, k: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest id it reaches by links, its own included).

    Documents are linked if 100 * intersection >= similarity * union of their
    sets of k-word shingles. Equal sets are one class, which stands in all later
    steps as one node. Classes that share a band of their signatures lie in one
    bucket. First every class is checked against the least of each of its
    buckets, then against a member of the largest group of each bucket that still
    holds several groups. What is left over is checked in full: every class
    outside the largest group of a bucket against all unsettled classes with
    which it has one of its rarest shingles in common. So no link between groups
    is lost, and a large group of copies never becomes all of its pairs. Checks
    use full sets.

    Texts without words (null, empty, white space) have an empty set and are
    linked with nothing. Equal rows are one class and each is returned. Rows
    with a null id link as all others; only a group without any id has no
    component_id. Empty tables give no rows.
    """
    schema = "doc_id long, row long, n_shingles long, set_id binary, bands array<long>"
    # Where a class's text is found again: by id or, without one, by the text. Other texts met there have another set_id.
    named = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("row"), "text")
    sketches = stored(named.mapInArrow(sketch(k, bands, rows), schema), "sketches")
    some = sketches.where("n_shingles > 0")
    source = F.min(F.struct(F.col("doc_id").isNull(), F.col("row").alias("row")))["row"]
    classes = some.groupBy("set_id").agg(F.min("doc_id").alias("least_id"), source.alias("row"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    places = classes.select("set_id", "n", "row", F.posexplode("bands").alias("band", "value"))
    shared = places.groupBy("band", "value").agg(F.min("set_id").alias("hub"), F.max("set_id").alias("last")).where("hub != last").drop("last")
    members = stored(places.join(shared, ["band", "value"]), "buckets")
    nodes = members.select("set_id", "row", "n").distinct()
    chosen = named.drop("doc_id").join(nodes.select("set_id", "row"), "row")
    sets = stored(chosen.mapInArrow(full_sets(k), "set_id binary, shingles array<long>, parity array<long>").dropDuplicates(["set_id"]), "sets")
    fits = lambda x, y: (100 * F.least(x, y) >= similarity * F.greatest(x, y))

    sizes = nodes.select(F.col("set_id").alias("hub"), F.col("n").alias("hub_n"))
    first = members.where("set_id != hub").join(sizes, "hub").where(fits(F.col("n"), F.col("hub_n"))).select(F.col("hub").alias("a"), F.col("set_id").alias("b")).distinct()
    links = stored(verified(first, sets, similarity), "links")
    found = groups(links)

    # Classes outside their bucket's largest group meet one of its members, another one in each band.
    open_ = stored(unsettled(members, found), "open")
    picked = open_.where("root = main").groupBy("band", "value").agg(F.min_by("set_id", F.xxhash64("band", "value", "set_id")).alias("a"))
    second = open_.where("root != main").join(picked, ["band", "value"]).join(sizes.withColumnsRenamed({"hub": "a", "hub_n": "a_n"}), "a")
    second = second.where(fits(F.col("n"), F.col("a_n"))).select("a", F.col("set_id").alias("b")).distinct()
    links = stored(links.unionByName(verified(second, sets, similarity)), "links")
    found = groups(links)

    rest = prefix_pairs(unsettled(members, found), sets, similarity)
    links = stored(links.unionByName(verified(rest, sets, similarity)), "links")
    found = groups(links)

    of_class = classes.select("set_id", "least_id").join(found, F.col("set_id") == F.col("node"), "left").select("set_id", "least_id", F.coalesce("root", "set_id").alias("root"))
    least = of_class.groupBy("root").agg(F.min("least_id").alias("component"))
    component = of_class.join(least, "root").select(F.col("set_id").alias("__set"), "component")
    joined = sketches.join(component, (F.col("set_id") == F.col("__set")) & (F.col("n_shingles") > 0), "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def first_of_groups(docs: DataFrame, similarity: int = 80) -> DataFrame:
    """docs, with all their columns, with one document of each near-duplicate group: the one with its smallest id.

    Rows equal in id and text stay as one; documents without words stay. A row
    is named by a hash of its id and text, so a null or repeated id stands for
    none but its own row. A null id comes after all others; of equal ids the
    one with the least hash stays.
    """
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text", F.col("doc_id").isNull(), F.col("text").isNull()))
    found = near_duplicates(keyed.select(F.col("__key").alias("doc_id"), "text"), similarity).where("n_shingles > 0")
    group = stored(found.selectExpr("doc_id AS __key", "component_id AS __group").distinct(), "groups")
    # Only groups of several rows have one to take out.
    several = group.where("__key != __group").select("__group").distinct()
    members = group.join(several, "__group", "left_semi").join(keyed.select("__key", "doc_id").distinct(), "__key")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__key").alias("key"))
    first = members.groupBy("__group").agg(F.min(order)["key"].alias("__first"))
    gone = members.join(first, "__group").where("__key != __first").select("__key")
    return keyed.join(gone, "__key", "left_anti").select(*docs.columns).dropDuplicates(["doc_id", "text"])
