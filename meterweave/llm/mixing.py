"""Mixing sources to target weights by blocks of tokens and index permutations, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterweave.llm.common import SPACE, ranked, word_count

BLOCK = 128
SHARDS = 64
ROUNDS = 12
#: Slots made from one row when the slots of a source are numbered.
CHUNK = 8192


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """One row per source: source, source_id (rank by code point, null last), weight, source_size, target.

    Weights repeat along the ranks and share all sizes. A target stops at `most`
    times the size of its source, and the excess goes to the others by weight
    until none is above: min(most * size, level * weight) with the one level at
    which the targets add up. Sources are sorted by the level at which they stop,
    so prefix sums find that level.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    share = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_id") % len(weights) + 1).cast("int")).cast("double")
    named = sizes.select("source", F.col("size").cast("double").alias("size"), (F.row_number().over(order) - 1).alias("source_id")).withColumn("weight", share)
    every, stop = Window.partitionBy(F.lit(0)), most * F.col("size")
    up = Window.partitionBy(F.lit(0)).orderBy(stop / F.col("weight"), "source_id")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    level = named.select(
        "*", (stop / F.col("weight")).alias("stops"),
        ((F.sum("size").over(every) - F.coalesce(F.sum(stop).over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))).alias("level"),
    )
    # The level is the one of the first source that does not reach its stop.
    found = F.coalesce(F.min(F.when(F.col("level") <= F.col("stops"), F.struct("stops", "source_id", "level"))).over(every)["level"], F.lit(float("inf")))
    return level.select("source", "source_id", "weight", F.col("size").cast("long").alias("source_size"), F.least(stop, found * F.col("weight")).alias("target"))


def permuted(at: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """Place of index `at` in a pseudorandom permutation of 0 to n - 1 that key names.

    Swap-or-not shuffle: each round pairs x with (k - x) mod n and swaps the
    pair if a hash of its larger member says so, which is a bijection for any n.
    One fold over the rounds, so that the expression stays as short as a round.
    """

    def swapped(x: Column, i: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(i, key), n) - x, n)
        return F.when(F.xxhash64(-1 - i, key, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), at, swapped)


def slots(targets: DataFrame, block: int, shards: int, seed: int) -> DataFrame:
    """Output slots: shard, source_id, slot, epoch, block.

    A source gets as many slots as its target has blocks. Each slot falls on an
    output shard independently, so the counts of a source over the shards are a
    multinomial draw, given the totals that the targets ask for. Slots numbered
    beyond the blocks of a source start another epoch, with a permutation of its own.
    """
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    wanted = F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long")
    sized = targets.where("source_size > 0").withColumn("blocks", blocks).select("source_id", "blocks", wanted.alias("wanted")).where("wanted > 0")
    chunks = sized.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("wanted") - 1) / CHUNK))))
    # A number of partitions of its own: the few small rows would be merged into one task and expanded there.
    spread = chunks.repartition(int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source_id", "chunk")
    each = spread.withColumn("slot", F.explode(F.sequence(F.col("chunk") * CHUNK, F.least(F.col("chunk") * CHUNK + CHUNK, F.col("wanted")) - 1)))
    index, epoch = F.pmod("slot", "blocks"), F.floor(F.col("slot") / F.col("blocks"))
    return each.select(
        "source_id", "slot", F.pmod(F.xxhash64(F.lit(seed), "source_id", "slot"), F.lit(shards)).cast("int").alias("shard"),
        epoch.alias("epoch"), permuted(index, F.col("blocks"), F.xxhash64(F.lit(seed + 1), "source_id", epoch)).alias("block"),
    )


def pieces(docs: DataFrame, identity: list[str], block: int, seed: int, weights: tuple[int, ...], most: float) -> tuple[DataFrame, DataFrame]:
    """(each document cut at block borders, targets of the sources).

    The documents of a source stand one after another in a pseudorandom order;
    a piece has its block, its first word in the document (piece_start) and its
    words (piece). A document without words has one piece without a block.
    """
    sizes = docs.groupBy("source").agg(F.sum("size").alias("size"))
    targets = source_targets(sizes, weights, most)
    joined = docs.join(targets.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    key = F.xxhash64(F.lit(seed + 2), *identity)
    placed = ranked(joined, ["source_id"], key, [F.col(c) for c in identity], F.col("size"), "start")
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    cut = placed.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    low = F.greatest(F.col("block") * block, F.col("start"))
    high = F.least(F.col("block") * block + block, F.col("start") + F.col("size"))
    return cut.withColumn("piece_start", low - F.col("start")).withColumn("piece", F.coalesce(high - low, F.lit(0))), targets


def sized(docs: DataFrame) -> DataFrame:
    """Adds size and a row's identity: no document is told apart by its id alone."""
    return docs.withColumn("size", word_count("text")).withColumn("__text", F.xxhash64("text"))


def mix_taken(docs: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = 23, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (its words in the mix, repeats counted).

    docs has doc_id, text and source; more columns are ignored. Null text has no
    words, null source is a source of its own and the last, null ids are ids
    like any other. Repeated rows stand apart, each in its own place in the
    stream. Documents without words take nothing. An empty table gives no rows.
    """
    rows = sized(docs.select("doc_id", "source", "text")).drop("text")
    cut, targets = pieces(rows, ["doc_id", "__text"], block, seed, weights, most)
    times = slots(targets, block, shards, seed).groupBy("source_id", "block").agg(F.count("*").alias("times")).hint("merge")
    key = ["source_id", "start", "doc_id", "__text", "size", "source", "source_size", "target"]
    got = cut.join(times, ["source_id", "block"], "left").withColumn("words", F.col("piece") * F.coalesce("times", F.lit(0)))
    # Rows of no words share a place; they are counted and put out as often as they came.
    out = got.groupBy(*key).agg(F.sum("words").alias("taken"), F.sum(F.when(F.col("size") == 0, 1).otherwise(0)).alias("empty"))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("empty")).cast("int"))))
    return out.select("doc_id", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = 23, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """The mix as rows with the columns of docs: a document once for each epoch that takes words of it.

    Its text is the document's own if the epoch takes all of it, else the taken
    words in their order, single-spaced; n_chars, if there is one, counts the
    characters of the text. docs has doc_id, text and source. Documents without
    words, which no weight can choose, stay as they are.
    """
    names = docs.columns
    whole = F.struct(*[F.col(c) for c in names if c != "text"]).alias("__row")
    rows = sized(docs.select(whole, "doc_id", "source", "text"))
    ids = rows.select("doc_id", "source", "size", "__text")
    cut, targets = pieces(ids, ["doc_id", "__text"], block, seed, weights, most)
    drawn = slots(targets, block, shards, seed).select("source_id", "block", "epoch").hint("merge")
    part = F.struct("piece_start", "piece")
    taken = (
        cut.where("size > 0").join(drawn, ["source_id", "block"])
        .groupBy("source_id", "start", "doc_id", "__text", "epoch", "size")
        .agg(F.array_sort(F.collect_list(part)).alias("parts"), F.sum("piece").alias("words"))
        # Rows equal in id and text stand in several places of the stream: any of them gets any place.
        .withColumn("copy", F.dense_rank().over(Window.partitionBy("doc_id", "__text").orderBy("source_id", "start")))
        .select(F.col("doc_id").alias("__doc"), F.col("__text").alias("__hash"), "copy", "epoch", "parts", "words")
    )
    numbered = rows.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "__text").orderBy(F.xxhash64("__row"))))
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__text") == F.col("__hash")) & (numbered["copy"] == taken["copy"])
    found = numbered.where("size > 0").join(taken, same)
    words = F.filter(F.split("text", f"[{SPACE}]+"), lambda w: w != "")
    cut_text = F.array_join(F.flatten(F.transform("parts", lambda p: F.slice(F.col("__words"), (p["piece_start"] + 1).cast("int"), p["piece"].cast("int")))), " ")
    found = found.withColumn("__words", F.when(F.col("words") < F.col("size"), words))
    text = F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(cut_text)
    length = lambda t: {"n_chars": F.length(t).cast(dict(docs.dtypes)["n_chars"])} if "n_chars" in names else {}
    put = lambda df, t: df.select(*[(t if c == "text" else length(t).get(c, F.col("__row")[c])).alias(c) for c in names])
    return put(found, text).unionByName(put(rows.where("size = 0"), F.col("text")))
