import hashlib
import re

import pytest
from helpers import docs, odd_rows, prose
from pyspark.sql import functions as F

from gaugeloom.llm import sketches
from gaugeloom.llm.queries import QUERIES


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def sketch_of(spark, rows):
    df = docs(spark, rows).withColumn("text", F.coalesce("text", F.lit("")))
    return sketches.with_sketch(df, "text", "sketch")


def test_all_hashes_without_threshold(spark):
    df = sketches.with_sketch(docs(spark, [(i, prose(i, i)) for i in range(40)]), "text", "sketch", fraction=1.0)
    for r in df.collect():
        assert len(r.sketch) == len(grams(r.text))


def test_retained_fraction_and_merge(spark):
    rows = [(0, prose(1, 8_000)), (1, prose(2, 8_000)), (2, prose(1, 8_000) + " " + prose(2, 8_000))]
    found = {r.doc_id: r.sketch for r in sketch_of(spark, rows).collect()}
    assert abs(len(found[0]) / 8_000 - sketches.FRACTION) < 0.02
    assert found[0] == sorted(found[0]) and set(found[0]) | set(found[1]) <= set(found[2]) | {min(found[0]), min(found[1])}
    df = spark.createDataFrame([(found[0], found[1], found[2])], "a array<long>, b array<long>, c array<long>")
    row = df.select(
        sketches.merged(F.col("a"), F.col("b")).alias("m"),
        sketches.containment(F.col("a"), F.col("c")).alias("inside"),
        sketches.likeness(F.col("a"), F.col("c")).alias("like"),
    ).first()
    assert len(set(row.m) ^ set(found[2])) <= 4 and row.inside > 0.99 and 0.45 < row.like < 0.55


def test_odd_rows(spark):
    rows = sketch_of(spark, odd_rows()).collect()
    by_text = {}
    for r in rows:
        assert bool(r.sketch) == bool(grams(r.text))
        assert by_text.setdefault(r.text, r.sketch) == r.sketch
    assert sketch_of(spark, odd_rows()).where("false").count() == 0


@pytest.mark.parametrize("partitions", [1, 6])
def test_next_rows(spark, partitions):
    rows = odd_rows() + [(100 + 7 * i, prose(i, 12)) for i in range(300)]
    df = docs(spark, rows).repartition(partitions).withColumn("text", F.coalesce("text", F.lit("")))
    df = df.withColumn("h", F.xxhash64("text"))
    got = sketches.with_next(df, "doc_id", ["h", "text"], {"next": "text"}, rows=20).collect()
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.h, r.text)
    order = sorted(got, key=key)
    assert len(order) == len(rows)
    assert [r.next for r in order] == [r.text for r in order[1:] + order[:1]]
    assert sketches.with_next(df.where("false"), "doc_id", ["h"], {"next": "text"}).count() == 0
    only = sketches.with_next(df.where("doc_id = 100"), "doc_id", ["h"], {"next": "text"}).collect()
    assert only[0].next == only[0].text


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = [r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()]
    rows = sorted(QUERIES["op6_sketches"](spark, folder).collect(), key=lambda r: r.doc_id)
    off = 0.0
    for text, next_, r in zip(texts, texts[1:] + texts[:1], rows, strict=True):
        n = len(text) // 4
        edited = text[: len(text) - n] + next_[:n]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = grams(text), grams(edited)
        off += abs(r.near_edited - len(a & b) / len(a | b)) if a | b else 0
    assert off / len(rows) < 0.1


def test_next_row_over_groups_of_borders(spark, monkeypatch):
    """Many ranges, whose borders are sought group by group; null, repeated and negative identifiers too."""
    monkeypatch.setattr(sketches, "GROUP", 3)
    ids = [None, None, -5, -5, *range(0, 400, 3), 7, 7, 7, 1000]
    df = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id long, text string").repartition(3)
    rows = sketches.with_next(df, "doc_id", ["text"], {"next": "text"}, rows=4).collect()
    order = sorted(((i, f"t{k}") for k, i in enumerate(ids)), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    wanted = {(a[0], a[1], b[1]) for a, b in zip(order, [*order[1:], order[0]])}
    assert len(rows) == len(ids) and {(r.doc_id, r.text, r.next) for r in rows} == wanted
