import random

import pytest
from helpers import docs, odd_rows, prose

from gaugeloom.llm import quality
from gaugeloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def junk(seed, words):
    r = random.Random(seed)
    return " ".join("".join(r.choice("KLMNOP%$#") for _ in range(r.randint(2, 7))) + "!!" for _ in range(words))


def labelled(n=120):
    return [(1, prose(i, 80)) for i in range(n)] + [(0, junk(i, 80)) for i in range(n // 4)]


def test_held_out_accuracy(spark):
    found = QUERIES["op12_quality"](spark, FOLDER)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 900
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    for label, least in ((0, 0.9), (1, 0.97)):
        some = [r for r in rows if r.quality == label]
        assert sum(r.predicted == label for r in some) / len(some) > least


def test_scores_are_probabilities(spark):
    """In each band of scores the share of good held-out texts is about the mean score."""
    found = QUERIES["op12_quality"](spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    mean = sum(r.score for r in rows) / len(rows)
    assert abs(mean - sum(r.quality for r in rows) / len(rows)) < 0.03
    brier = sum((r.score - r.quality) ** 2 for r in rows) / len(rows)
    assert brier < 0.03


def test_the_difference_decides():
    """With exchanged labels the scores turn round: nothing else of the text is used."""
    rows = labelled()
    there = quality.train(rows, {0: 30, 1: 120})
    back = quality.train([(1 - k, t) for k, t in rows], {1: 30, 0: 120})
    for text, good in ((prose(999, 70), True), (junk(999, 70), False)):
        for classifier, want in ((there, good), (back, not good)):
            size = classifier.sizes()(text.encode())
            assert (size[1] < size[0]) == want
            score = classifier.scores(__import__("numpy").array([size], float), __import__("numpy").array([len(text)]))[0]
            assert (score >= 0.5) == want


def test_odd_rows(spark):
    classifier = quality.train(labelled(), {0: 30, 1: 120})
    rows = [*odd_rows(), (20, prose(1000, 100)), (21, junk(1000, 100)), (22, junk(3, 40_000))]
    found = quality.scored(docs(spark, rows), classifier).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    score = {(r.doc_id, r.text): r.score for r in found}
    assert score[None, None] == score[1, None] == score[2, ""]
    assert score[2, ""] > 0.5  # the labels' proportion
    assert score[20, prose(1000, 100)] > 0.7 > score[21, junk(1000, 100)]
    assert score[22, junk(3, 40_000)] < 0.1
    assert len({r.score for r in found if r.text == prose(5, 50)}) == 1
    table = docs(spark, rows)
    assert quality.scored(table.where("false"), classifier).count() == 0
    assert quality.scored(table, classifier).columns == [*table.columns, "score"]
    with pytest.raises(ValueError):
        quality.scored(table.withColumnRenamed("line", "Score"), classifier)


def keyed(spark, rows):
    """Texts with a clashing column, and their labels under the same identifiers."""
    texts = spark.createDataFrame([(i, t, "x") for i, (_, t) in enumerate(rows)], "doc_id long, text string, label string")
    return texts, spark.createDataFrame([(i, k) for i, (k, _) in enumerate(rows)], "doc_id long, quality int")


def test_missing_labels(spark):
    empty = keyed(spark, [])
    one = keyed(spark, [(1, "good text"), (1, "more good text"), (None, "x"), (7, "y"), (1, None), (0, "")])
    few = keyed(spark, [(1, "good text here"), (0, "XX%% YY%%")])
    table = docs(spark, [(1, "any text"), (2, None)])
    assert {r.score for r in quality.scored(table, quality.fit(*empty)).collect()} == {0.5}
    assert {r.score for r in quality.scored(table, quality.fit(*one)).collect()} == {0.75}
    assert all(0 <= r.score <= 1 for r in quality.scored(table, quality.fit(*few)).collect())


def test_repeated_labels_and_identifiers(spark):
    texts, labels = keyed(spark, labelled(40))
    again = texts.unionAll(texts).unionAll(spark.createDataFrame([(None, "no label", "x")], texts.schema))
    size = quality.SampleSize()
    wanted, counts = quality.sample(texts, labels, "doc_id", "quality", "text", size)
    got, other = quality.sample(again, labels.unionAll(labels), "doc_id", "quality", "text", size)
    assert counts == other == {0: 10, 1: 40}
    assert got.collect() == wanted.collect()


def test_sample_is_bounded_and_copies_enter_once(spark):
    rows = [(i % 2, f"text number {i} " * 30) for i in range(400)] + [(1, "one copied text " * 30)] * 500
    size = quality.SampleSize(rows=50, characters=64)
    got, counts = quality.sample(*keyed(spark, rows), "doc_id", "quality", "text", size)
    got = got.collect()
    assert counts == {0: 200, 1: 201}
    assert len(got) == 100 and all(len(r.text) <= 64 for r in got)
    assert sum("copied" in r.text for r in got) <= 1
