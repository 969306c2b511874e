from helpers import docs, odd_rows

from gaugeloom.llm import language
from gaugeloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = QUERIES["op10_language"](spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 150
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    sample = [("en", "the cat and the dog went out of the house " * 5), ("de", "der Hund und die Katze gehen über die Straße " * 5)]
    network = language.train(sample, steps=60)
    rows = [*odd_rows(), (20, sample[0][1]), (21, sample[1][1])]
    found = {(r.doc_id, r.text): r for r in language.identify(docs(spark, rows), network).collect()}
    for (doc_id, text), r in found.items():
        if not text or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "de") and 0 < r.score <= 1
    assert found[20, sample[0][1]].lang_pred == "en"
    assert found[21, sample[1][1]].lang_pred == "de"


def test_batches_do_not_matter(spark):
    network = language.train([("a", "abc abd " * 30), ("b", "xyz xyw " * 30)], steps=30)
    rows = docs(spark, [(i, "abc xyz " * i) for i in range(1, 60)])
    one = {r.doc_id: r.score for r in language.identify(rows.coalesce(1), network).collect()}
    many = {r.doc_id: r.score for r in language.identify(rows.repartition(7), network).collect()}
    assert one == many


def test_without_labels(spark):
    table = docs(spark, [(1, "words here"), (2, None)])
    assert language.fit(table) is None
    assert {r.lang_pred for r in language.identify(table, None).collect()} == {"und"}
    assert language.identify(table.where("false"), language.train([("a", "some text")], steps=1)).count() == 0


def test_sample_is_bounded(spark):
    table = docs(spark, [(i, f"word number {i}", "en" if i % 3 else "de", None) for i in range(100)])
    size = language.SampleSize(rows=10, languages=2, characters=8)
    rows = language.sample(table, "lang", "text", size).collect()
    assert len(rows) == 20 and all(len(r.text) <= 8 for r in rows)


def test_copies_enter_the_sample_once(spark):
    rows = [(i, f"word number {i}", "en", None) for i in range(40)] + [(100 + i, "a copied text", "en", None) for i in range(3000)]
    got = language.sample(docs(spark, rows), "lang", "text", language.SampleSize(rows=41)).collect()
    assert len(got) == 41 and sum(r.text == "a copied text" for r in got) == 1
