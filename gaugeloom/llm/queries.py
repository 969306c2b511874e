"""Registered queries of the text operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.llm import (
    bpe,
    hard_negatives,
    language,
    line_dedup,
    mixing,
    near_duplicates,
    pii,
    quality,
    sketches,
    spelling,
    suffix_dedup,
    token_files,
    vectors,
)
from gaugeloom.session import new_table_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TOKENIZER = "word_bpe_49k.json"


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query("op1_mixing")
def mixed_sources(spark: SparkSession, folder: str) -> DataFrame:
    taken = mixing.mix(documents(spark, folder), weights=(5, 2, 1), share=1.5, cap=2.0)
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query("op2_bpe")
def bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    ids = bpe.encode(documents(spark, folder).select("doc_id", "text"), path).select("doc_id", "ids")
    return bpe.decode(ids, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op3_line_dedup",
    r"""
WITH rows AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS no FROM rows),
placed AS (
  SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id, text ORDER BY no
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s,
    trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS normal FROM lines),
units AS (
  SELECT *, row_number() OVER (PARTITION BY normal ORDER BY doc_id NULLS LAST, no) AS rank FROM placed
  WHERE normal <> '' AND length(normal) - length(replace(normal, ' ', '')) >= 4),
gone AS (SELECT doc_id, text, no FROM units WHERE rank > 1),
kept AS (
  SELECT p.doc_id, p.text, string_agg(p.line, chr(10) ORDER BY p.no) FILTER (g.no IS NULL) AS kept,
    string_agg(p.s::BIGINT || ':' || (p.s + length(p.line))::BIGINT, ',' ORDER BY p.no) FILTER (g.no IS NOT NULL) AS removed,
    count(g.no) AS n_removed, count(*) AS n_lines
  FROM placed p LEFT JOIN gone g ON p.doc_id IS NOT DISTINCT FROM g.doc_id AND p.text = g.text AND p.no = g.no
  GROUP BY p.doc_id, p.text)
SELECT d.doc_id, k.n_lines, k.n_removed, coalesce(k.removed, '') AS removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d JOIN kept k ON d.doc_id IS NOT DISTINCT FROM k.doc_id AND coalesce(d.text, '') = k.text""",
)
def lines_met_before(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.without_repeated_lines(documents(spark, folder).select("doc_id", "text"))
    spans = F.transform("_removed", lambda x: F.concat_ws(":", x["s"], x["e"]))
    return found.select(
        "doc_id",
        F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines"),
        F.size("_removed").cast("long").alias("n_removed"),
        F.array_join(spans, ",").alias("removed"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


@query("op4_token_counts")
def tokens_of_flat_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_table_path(spark, "tokens")
    token_files.write_texts(documents(spark, folder), public_tokenizers.path(TOKENIZER), path)
    found = token_files.token_counts(spark, path)
    # a task's later files end in c001, c002 and so on
    part, later = (F.regexp_extract("file", p, 1).cast("long") for p in (r"part-(\d+)", r"-c(\d+)[^/]*$"))
    return found.select((part * 1_000_000 + later).alias("file_no"), "doc_no", "start", "n_tokens", "closed")


@query("op5_vectors")
def near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    found = vectors.near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


@query("op6_sketches")
def fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = sketches.with_sketch(docs.withColumn("mark", F.xxhash64("text")), "text", "sketch")
    docs = sketches.with_next(docs, "doc_id", ["mark", "text"], {"next_text": "text", "next_sketch": "sketch"})
    docs = docs.withColumn("n_chars", F.length("text"))
    part = F.floor(F.col("n_chars") / 4).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), F.col("n_chars") - part)
    docs = docs.withColumn("edited", F.concat(kept, F.substring(F.col("next_text"), F.lit(1), part)))
    docs = sketches.with_sketch(docs, "edited", "edited_sketch")
    return docs.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        sketches.written(F.col("sketch")).alias("fingerprint"),
        sketches.written(F.col("edited_sketch")).alias("edited_fingerprint"),
        sketches.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        sketches.likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


@query("op7_suffix_dedup")
def repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.without_repeats(documents(spark, folder), words=50)
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return found.select(
        "doc_id",
        "n_bytes",
        length.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        (length > 0).alias("repeats"),
        "passage",
    )


@query("op8_pii")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    found = pii.of_documents(pii.findings(docs)).withColumnsRenamed({"doc_id": "_d", "mark": "_m"})
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m")), "left")
    rows = rows.withColumn("spans", F.coalesce("spans", F.array().cast(pii.SPANS)))
    counts = [
        F.size(pii.of_kind(F.col("spans"), n)).cast("long").alias(f"n_{kind}")
        for n, kind in enumerate((*pii.KINDS, pii.TERM))
    ]
    base = F.sha2(pii.described(F.col("spans"), len(pii.KINDS)), 256).alias("base_sha256")
    described = pii.described(F.col("spans"), len(pii.KINDS) + 1).alias("spans")
    return rows.select("doc_id", *counts, base, described, (F.size("spans") > 0).alias("private"))


@query("op9_near_duplicates")
def ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates.near_duplicates(documents(spark, folder))
    kept = (F.col("doc_id") == F.col("component_id")).alias("kept")
    return found.select("doc_id", "n_links", F.col("component_id").alias("class_id"), kept)


@query("op10_language")
def language_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).withColumn("held_out", language.held_out())
    network = language.fit(docs.where("not held_out"))
    found = language.identify(docs.select("doc_id", "held_out", "text"), network)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query(
    "op11_spelling",
    r"""
WITH RECURSIVE texts AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS d,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
runs AS (SELECT d, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM texts),
counted AS (SELECT d, run, count(*) AS k FROM runs WHERE length(run) >= 5 GROUP BY d, run),
crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
marked AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(hex(d || run)) // 2),
    lambda i: ('0x' || hex(d || run)[2 * i + 1 : 2 * i + 2])::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM counted, crc),
made AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k
  FROM marked),
vocabulary AS (
  SELECT word, sum(k)::BIGINT AS n FROM made WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
places AS (SELECT word, n, unnest(range(length(word))) AS i FROM vocabulary),
shorter AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS s FROM places),
ordered AS (
  SELECT v.word AS a, v.n AS an, s.word AS b, s.n AS bn FROM vocabulary v JOIN shorter s ON v.word = s.s
  UNION SELECT s.word, s.n, v.word, v.n FROM vocabulary v JOIN shorter s ON v.word = s.s
  UNION SELECT x.word, x.n, y.word, y.n FROM shorter x JOIN shorter y ON x.s = y.s AND x.i = y.i AND x.word <> y.word),
best AS (
  SELECT a AS word, an AS n, count(*) AS n_near, max(bn) AS most,
    first(b ORDER BY bn DESC, b) AS near FROM ordered GROUP BY a, an),
forms AS (SELECT word, n_near, CASE WHEN most >= 2 * n THEN near END AS form, CASE WHEN most >= 2 * n THEN most END AS form_n FROM best),
chains AS (
  SELECT word, form AS root, 1 AS step FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form, step + 1 FROM chains c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, step) AS root FROM chains GROUP BY word)
SELECT v.word, f.form, coalesce(r.root, v.word) AS root, v.n, coalesce(f.n_near, 0)::BIGINT AS n_near, f.form_n
FROM vocabulary v LEFT JOIN forms f ON v.word = f.word LEFT JOIN roots r ON v.word = r.word""",
)
def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.words(documents(spark, folder)))


@query("op12_quality")
def quality_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).withColumn("held_out", language.held_out())
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    classifier = quality.fit(docs.where("not held_out"), labels)
    found = quality.scored(docs.select("doc_id", "held_out", "text"), classifier)
    good = (F.col("score") >= quality.GOOD).cast("int").alias("predicted")
    return found.select("doc_id", "held_out", "score", good)


@query(
    "op13_hard_negatives",
    r"""
WITH known AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM known a JOIN known b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor, other AS positive, score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5),
ranked AS (
  SELECT p.anchor, p.positive, p.score, n.other AS negative, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY n.score DESC, n.other) AS rank
  FROM positives p JOIN pairs n ON p.anchor = n.anchor AND NOT n.same
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor AS anchor_id, positive AS positive_id, rank::INTEGER AS rank, negative AS negative_id,
  score AS positive_score, negative_score
FROM ranked WHERE rank <= 3""",
)
def hard_negatives_of_anchors(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    value = F.transform("embedding", lambda x: x.cast("double"))
    whole = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select(
        "vec_id", moved.alias("label"), F.when(whole, F.transform(value, lambda x: F.floor(x * 256))).alias("vector")
    )
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)
