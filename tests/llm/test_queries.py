"""Registered queries: SQL twins, contracts over the small tables, the pipeline's stages."""

import importlib
import os
import sys
from collections import Counter

import pytest
from helpers import DOCUMENTS, docs, odd_rows

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

from gaugeloom.llm.queries import ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_operators():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    entry = importlib.import_module("__spark_entry__")
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    from compare import connect, differences

    assert differences(spark, connect(FOLDER), FOLDER, name, QUERIES[name], ORACLES[name]) is None


def test_token_counts_are_those_of_the_encoder(spark):
    counts = Counter(r.n_tokens for r in QUERIES["op4_token_counts"](spark, FOLDER).collect())
    assert counts == Counter(r.n_tokens for r in QUERIES["op2_bpe"](spark, FOLDER).collect())


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and all(r.n_tokens == len(r.ids) for r in rows)
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_take_odd_tables(spark):
    table = docs(spark, [(i, f"the word number {i} is here and a@b{i}.com too", "en", f"s{i % 3}") for i in range(30)] + odd_rows())
    for frame in (table, table.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, FOLDER)
            if name != "encoding":
                assert out.schema.names == DOCUMENTS.names
                assert [f.dataType for f in out.schema] == [f.dataType for f in DOCUMENTS]
            out.count()


def test_a_stage_works_on_what_the_one_before_kept(spark):
    table = docs(spark, [(1, "12345 !!!"), (2, None), (3, "words that are here")])
    kept = corpus_pipeline.known_language(spark, table, FOLDER)
    assert kept.count() == 0  # nothing is labelled
