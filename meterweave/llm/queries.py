"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterweave.llm import ngrams
from meterweave.llm.common import remainder, table
from meterweave.llm.decontamination import find_leaks
from meterweave.llm.divergence import source_divergence
from meterweave.llm.encoding import decoded, encoded
from meterweave.llm.lines import drop_frequent_lines, line_runs
from meterweave.llm.mixing import mix_taken
from meterweave.llm.near import near_duplicates
from meterweave.llm.neighbours import nearest
from meterweave.llm.passages import passage_classes, repeated_passages
from meterweave.llm.repeats import remove_repeats
from meterweave.llm.sharding import shard_rows
from meterweave.llm.toxicity import THRESHOLD, fit, scored
from meterweave.llm.variants import spelling_variants


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder("doc_id", 10) == 0
    model = ngrams.train(docs.where(~held_out), order=3)
    scores = ngrams.score(docs, model, ["doc_id", held_out.alias("held_out")])
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), similarity=85)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_taken(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    left = drop_frequent_lines(docs, line_runs(docs))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passage_classes(repeated_passages(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", "n_words", "n_repeated", "n_later", F.size("passages").cast("long").alias("n_passages"),
        F.size("partners").cast("long").alias("n_links"), "class_id", (F.col("n_later") > 0).alias("repeats"), "partners",
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents").select("doc_id", "text"), remainder("doc_id", 3) == 1
    model = fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return scored(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
    )
    sharded = shard_rows(rows, 24, ["doc_id", "text_hash"])
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    back = decoded(encoded(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_lm_score": op2_lm_score,
    "op3_mixing": op3_mixing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_near_dedup": op5_near_dedup,
    "op6_neighbours": op6_neighbours,
    "op7_line_dedup": op7_line_dedup,
    "op8_fuzzy_passages": op8_fuzzy_passages,
    "op9_toxicity": op9_toxicity,
    "op10_sharding": op10_sharding,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_encoding": op12_encoding,
    "op13_source_divergence": op13_source_divergence,
}

ORACLES: dict[str, str] = {
    "op1_decontamination": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents
        ), items AS (
            SELECT row_number() OVER () AS irn, CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, least(10, len(words)) AS w, array_to_string(words[i : i + least(10, len(words)) - 1], ' ') AS gram
            FROM (SELECT *, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM items WHERE len(words) > 0)
        ), lengths AS (SELECT DISTINCT w FROM windows), grams AS (
            SELECT rn, i, w, array_to_string(words[i : i + w - 1], ' ') AS gram
            FROM (SELECT rn, words, w, unnest(range(1, len(words) - w + 2)) AS i FROM docs, lengths WHERE len(words) >= w)
        ), hits AS (SELECT g.rn, g.i, g.w, x.item_id FROM grams g JOIN windows x ON g.w = x.w AND g.gram = x.gram),
        words_hit AS (SELECT rn, count(DISTINCT p) AS n FROM (SELECT rn, unnest(range(i, i + w)) AS p FROM hits) GROUP BY rn),
        items_hit AS (SELECT rn, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rn, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY rn)
        SELECT doc_id, len(words) AS n_words, coalesce(w.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
            sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(w.n, 0) > 0 AS contaminated
        FROM docs d LEFT JOIN words_hit w ON d.rn = w.rn LEFT JOIN items_hit i ON d.rn = i.rn
    """,
    "op7_line_dedup": r"""
        WITH lines AS (
            SELECT rn, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
            FROM (SELECT *, row_number() OVER () AS rn FROM documents)
        ), keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
        ), frequent AS (
            SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rn) >= 10
        ), marked AS (
            SELECT k.*, f.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN frequent f ON k.key = f.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY rn, doc_id
    """,
    "op11_spelling_variants": r"""
        WITH RECURSIVE bits AS (
            SELECT list(c ORDER BY b) AS crc FROM (
                SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384)) AS c FROM (SELECT unnest(range(256)) AS b)
            )
        ), docs AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+') AS runs
            FROM documents
        ), found AS (
            SELECT doc, run, count(*) AS n FROM (SELECT doc, unnest(runs) AS run FROM docs) GROUP BY doc, run
        ), bytes AS (
            SELECT doc, run, n, list_transform(string_split(doc || ':' || run, ''), lambda c: unicode(c)) AS points FROM found WHERE length(run) >= 5
        ), summed AS (
            SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(points, lambda p:
                CASE WHEN p < 128 THEN [p] ELSE [192 + (p >> 6), 128 + (p & 63)] END))), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) AS h
            FROM bytes, bits
        ), words AS (
            SELECT word, sum(n)::BIGINT AS n FROM (
                SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM summed
            ) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
        ), cut AS (
            SELECT DISTINCT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
        ), pairs AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION
            SELECT a.word, b.word, b.n FROM words a JOIN cut b ON a.word = b.rest
            UNION
            SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
        ), near AS (
            SELECT word, count(*) AS n_near, max(other_n) AS top, first(other ORDER BY other_n DESC, encode(other)) AS other FROM pairs GROUP BY word
        ), forms AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * w.n THEN other END AS form, CASE WHEN top >= 2 * w.n THEN top END AS form_n
            FROM words w LEFT JOIN near r ON w.word = r.word
        ), steps AS (
            SELECT word, word AS root FROM forms
            UNION ALL
            SELECT s.word, f.form FROM steps s JOIN forms f ON s.root = f.word WHERE f.form IS NOT NULL
        )
        SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n FROM forms f JOIN steps s ON f.word = s.word JOIN forms g ON s.root = g.word WHERE g.form IS NULL
    """,
    "op13_source_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS rn, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), words AS (SELECT rn, lang, source, unnest(terms) AS term FROM docs),
        kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT rn) >= 10),
        counts AS (SELECT w.lang, source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY w.lang, source, w.term),
        sources AS (SELECT DISTINCT lang, source FROM docs),
        totals AS (SELECT s.lang, s.source, coalesce(sum(n), 0) AS total FROM sources s LEFT JOIN counts c ON s.lang = c.lang AND s.source = c.source GROUP BY s.lang, s.source),
        langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
        shares AS (
            SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
                1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (t.total + 2 * l.v) AS p,
                1 + 1000000000::HUGEINT * (k.n + 2) // (l.total + 2 * l.v) AS whole
            FROM totals t JOIN langs l ON t.lang = l.lang JOIN kept k ON t.lang = k.lang
            LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
        ), rows AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term
                    WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
            FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - whole) * (p - whole) // (p + whole) FROM shares WHERE n > 0 AND p > whole
        ), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM rows)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
    """,
}
