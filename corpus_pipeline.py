"""The corpus pipeline: documents in, token ids of a clean and balanced corpus out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's docs. All but the last return the columns of documents.

All stages: an empty table gives an empty one. Columns beyond those of documents, of any name that does not
begin with ``_gl_``, go through unchanged up to the last stage. Very long texts are worked on whole. Null
identifiers are allowed, and rows with equal identifiers are documents of their own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.llm import bpe, language, mixing, near_duplicates, pii
from gaugeloom.session import staged

#: Least probability of the predicted language; with four or more languages a guess has far less.
LEAST_SCORE = 0.4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letters or whose language is not told with ``LEAST_SCORE``.

    Null and empty texts have no letters and go. Repeated rows get equal scores and stay or go together; a tie
    between languages goes to the first in code point order. If no row outside the held-out quarter is
    labelled, no language is told and all documents go.
    """
    network = language.fit(docs.where(~language.held_out()))
    found = language.identify(docs, network, lang="_gl_lang", score="_gl_score")
    kept = (F.col("_gl_lang") != language.UNDETERMINED) & (F.col("_gl_score") >= LEAST_SCORE)
    return found.where(kept).select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays.

    Null and empty texts, and those without words, are near to nothing and stay. Of a group the row of the
    smallest identifier that is not null stays; of several rows of it, one.
    """
    return near_duplicates.one_of_each(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced; ``n_chars`` follows the text.

    Null texts stay null, empty ones empty, and all rows stay. Repeated rows get equal texts. Findings that
    overlap are replaced as one, by the kind of the first.
    """
    clean = pii.sanitised(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document comes as often as the mix takes it.

    Documents are taken whole, at most twice. Null and empty texts have no words and are drawn like others of
    their source; null sources form one source. Repeated rows are drawn one by one, ties by their content.
    """
    return mixing.mixed(docs, weights=(5, 2, 1), share=1.5, cap=2.0)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number and their text as decoded.

    Null and empty texts have no ids. Every row is encoded by itself, repeated ones alike; of the columns only
    identifier, source and text are kept, besides those made.
    """
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = bpe.encode(docs.select("doc_id", "source", "text"), path).select("doc_id", "source", "ids")
    return bpe.decode(ids, path).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_near_duplicates),
    ("personal_data", without_personal_data),
    ("mixing", mixed_sources),
    ("encoding", encoded),
]

#: A trained network, MinHash groups and random draws are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
