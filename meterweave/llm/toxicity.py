"""Toxicity by subword-bag embeddings averaged into a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from meterweave.llm.words import ALPHANUMERIC, U, gathered, mixed

BUCKETS, DIMENSIONS = 1 << 17, 8
GRAMS = (3, 4, 5)
#: Words of a bag, and words from one bag to the next.
BAG, STRIDE = 8, 4
#: Bounds of the training sample: rows of each label, and bytes of a row's text.
ROWS, BYTES = 2500, 1 << 15
THRESHOLD = 0.7


@dataclass
class Units:
    """Subwords of some texts: bucket and word (over all texts) of each, words of each text."""

    bucket: np.ndarray
    word: np.ndarray
    counts: np.ndarray


def subwords(texts: list[bytes], buckets: int = BUCKETS) -> Units:
    """Every word as a whole, and its character n-grams with the borders of the word as characters of their own."""
    data = b" " + b"  ".join(texts).translate(ALPHANUMERIC) + b" "
    b = np.frombuffer(data, np.uint8)
    space = b == 0x20
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    stops = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    ends = np.cumsum([len(t) + 2 for t in texts], dtype=np.int64)
    counts = np.diff(np.searchsorted(starts, ends), prepend=0) if len(texts) else np.zeros(0, np.int64)
    owner = np.cumsum(~space & np.concatenate([[True], space[:-1]])) - 1
    found, words = [], []
    up = np.ones(len(b) + 1, dtype=U)
    up[1:] = U(0x9E6D62D06F6A9A9B)
    up = np.multiply.accumulate(up)
    sums = np.zeros(len(b) + 1, dtype=U)
    np.cumsum(b * up[:-1], out=sums[1:])
    inverse = np.full(len(b) + 1, pow(0x9E6D62D06F6A9A9B, -1, 1 << 64), dtype=U)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    whole = (sums[stops] - sums[starts]) * inverse[starts]
    found.append(mixed(whole + (stops - starts).astype(U)))
    words.append(np.arange(len(starts)))
    inner = np.concatenate([[0], np.cumsum(space)])
    for n in GRAMS:
        at = np.arange(max(0, len(b) - n + 1))
        at = at[inner[at + n - 1] == inner[at + 1]]
        found.append(mixed((sums[at + n] - sums[at]) * inverse[at] + U(n << 32)))
        words.append(owner[at + 1])
    bucket = (np.concatenate(found) % U(buckets)).astype(np.int32)
    return Units(bucket, np.concatenate(words), counts)


def bags(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end) of overlapping bags of BAG words; a text without words has none."""
    n = np.where(counts > 0, np.maximum(0, -(-(counts - BAG) // STRIDE)) + 1, 0)
    text = np.repeat(np.arange(len(counts)), n)
    step = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    first = (np.cumsum(counts) - counts)[text]
    return text, first + step * STRIDE, np.minimum(first + step * STRIDE + BAG, first + counts[text])


@dataclass
class Model:
    """What scoring needs of the trained embeddings: each bucket's part in the log odds, and their start."""

    weight: np.ndarray
    bias: float

    def log_odds(self, texts: list[bytes]) -> np.ndarray:
        """Of each text: the largest over its bags; a text without words has the bias alone."""
        units = subwords(texts, len(self.weight))
        n = int(units.counts.sum())
        total = np.concatenate([[0], np.cumsum(np.bincount(units.word, self.weight[units.bucket], n))])
        size = np.concatenate([[0], np.cumsum(np.bincount(units.word, minlength=n))])
        text, low, high = bags(units.counts)
        found = np.full(len(texts), -np.inf)
        np.maximum.at(found, text, (total[high] - total[low]) / (size[high] - size[low]) + self.bias)
        return np.where(units.counts > 0, found, self.bias)


def spans(n: int, step: int = 1 << 18) -> list[tuple[int, int]]:
    return [(a, min(a + step, n)) for a in range(0, n, step)]


def by_word(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, word after word; where each word's begin and end; words of each text), a few texts at a time."""
    sizes, counts, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    # Room for a word and all n-grams at every byte; what is not written takes no memory.
    buckets = np.empty((1 + len(GRAMS)) * sum(len(t) + 2 for t in texts), np.int32)
    for a, z in spans(len(texts), 128):
        units = subwords(texts[a:z])
        buckets[n : n + len(units.bucket)] = units.bucket[np.argsort(units.word, kind="stable")]
        n += len(units.bucket)
        sizes.append(np.bincount(units.word, minlength=int(units.counts.sum())))
        counts.append(units.counts)
    return buckets[:n], np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64), np.concatenate(counts)


def train(texts: list[bytes], toxic: np.ndarray, rounds: int = 24, steps: int = 6, rate: float = 0.08, decay: float = 1e-6, seed: int = 7) -> Model:
    """Embeddings and softmax trained together by Adam.

    A clean text is clean in all its bags, a toxic text toxic only in its worst.
    Each round scores all bags and trains on those that decide: the worst of
    every text, two of clean ones (in the first rounds some four of every text,
    drawn at random). The gradient of an embedding is the softmax's
    direction times what all bags with it add up to, so one weighted count over
    the subwords gives all of them.
    """
    toxic = np.asarray(toxic, bool)
    share = toxic.mean() if len(toxic) else 0.0
    if not 0 < share < 1:
        return Model(np.zeros(BUCKETS), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    bucket, ends, counts = by_word(texts)
    text, low, high = bags(counts)
    begin, size, each = ends[low], ends[high] - ends[low], np.bincount(text, minlength=len(texts))[text]
    label, rng = toxic[text], np.random.default_rng(seed)
    state = {"e": rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)), "v": rng.normal(0, 0.5, DIMENSIONS), "b": np.array(-1.0)}
    first, second = ({k: np.zeros_like(x) for k, x in state.items()} for _ in range(2))
    seen, step = np.zeros(BUCKETS, bool), 0
    for r in range(rounds):
        weight = (state["e"] @ state["v"]).astype(np.float32)
        word = [np.add.reduceat(weight[bucket[ends[a] : ends[z]]], ends[a:z] - ends[a]) for a, z in spans(len(ends) - 1)]
        total = np.concatenate([[0.0], np.cumsum(np.concatenate([np.zeros(0), *word]))])
        odds = (total[high] - total[low]) / size
        rank = np.empty(len(text), np.int64)
        rank[np.lexsort((-odds, text))] = np.arange(len(text))
        rank -= np.searchsorted(text, text)
        if r < 3:
            used = np.flatnonzero(rng.random(len(text)) < 4 / each)
        else:
            used = np.flatnonzero(np.where(label, rank < 1, rank < 2))
        weight = np.where(label[used], 0.25 if r < 3 else 1.0, 0.25 if r < 3 else 0.5)
        weight = weight / weight.sum()
        n = size[used]
        index = bucket[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[used], n)]
        bag = np.repeat(np.arange(len(used)), n)
        used_now = np.zeros(BUCKETS, bool)
        used_now[index] = True
        part, inverse = np.flatnonzero(used_now), (np.cumsum(used_now) - 1)[index]
        seen |= used_now
        for _ in range(steps):
            step += 1
            score = state["e"][part] @ state["v"]
            odds = np.bincount(bag, score[inverse], len(used)) / n + state["b"]
            delta = weight * (1 / (1 + np.exp(-odds)) - label[used])
            pull = np.bincount(inverse, (delta / n)[bag], len(part))
            grads = {"e": (part, pull[:, None] * state["v"] + decay * state["e"][part]), "v": (..., pull @ state["e"][part] + decay * state["v"]), "b": (..., np.array(delta.sum()))}
            for k, (at, g) in grads.items():
                first[k][at] = 0.9 * first[k][at] + 0.1 * g
                second[k][at] = 0.99 * second[k][at] + 0.01 * g * g
                state[k][at] -= rate * (first[k][at] / (1 - 0.9**step)) / (np.sqrt(second[k][at] / (1 - 0.99**step)) + 1e-8)
    return Model(np.where(seen, state["e"] @ state["v"], 0.0), float(state["b"]))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = ROWS, most: int = BYTES) -> Model:
    """Trains on a bounded sample: `rows` documents of each label, by a hash of the id, of at most `most` bytes.

    The sample is trained on in one task; only the weights come to the driver.
    labels has doc_id and toxic; learn is a condition on doc_id that says which
    labels may be used. An id is toxic if any of its labels is; labels without
    id or value are left out. Of several rows of one id the smallest text counts.
    """
    known = labels.where(learn & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    first = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    sample = known.withColumn("__n", F.row_number().over(first)).where(F.col("__n") <= rows).select(F.col("doc_id").alias("__doc"), "toxic")
    texts = docs.select("doc_id", "text").where(F.octet_length("text") <= most)
    found = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("__doc")).groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    trained = found.withColumn("__all", F.lit(1)).groupBy("__all").applyInArrow(trained_weights, "weight binary, bias double").first()
    return Model(np.frombuffer(trained["weight"]), trained["bias"]) if trained else train([], np.zeros(0, bool))


def trained_weights(table: pa.Table) -> pa.Table:
    sampled = sorted(zip(table["doc_id"].to_pylist(), table["text"].cast(pa.large_binary()).to_pylist(), table["toxic"].to_pylist(), strict=True))
    model = train([text for _, text, _ in sampled], np.array([toxic for _, _, toxic in sampled], bool))
    return pa.table({"weight": pa.array([model.weight.tobytes()], pa.binary()), "bias": pa.array([model.bias], pa.float64())})


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score, the chance that the text is toxic: 0 to 1, the highest of its overlapping bags of words.

    All columns are kept; one named score is replaced. Null, empty and wordless
    texts get the score of an empty bag. Nothing but the text is looked at.
    """
    docs = docs.drop("score")
    weight, bias = docs.sparkSession.sparkContext.broadcast(model.weight.astype(np.float32)), model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = Model(weight.value, bias)
        for batch, texts in gathered(batches, "text", 1 << 20):
            score = 1 / (1 + np.exp(-local.log_odds(texts)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], names=[*batch.schema.names, "score"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())]))


def without_toxic(docs: DataFrame, labels: DataFrame, learn: Column, threshold: float = THRESHOLD) -> DataFrame:
    """docs, with all their columns, whose score is below the threshold."""
    names = docs.columns
    held = docs.withColumnsRenamed({c: f"__{c}" for c in names if c == "score"})
    return scored(held, fit(docs, labels, learn)).where(F.col("score") < threshold).select(*[F.col(f"__{c}" if c == "score" else c).alias(c) for c in names])
