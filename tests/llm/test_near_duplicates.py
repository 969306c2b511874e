import random
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import docs, odd_rows, prose

from gaugeloom.llm import near_duplicates
from gaugeloom.llm.components import components
from gaugeloom.llm.shingles import shingle_sets


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_force(rows, threshold=0.8):
    sets = [grams(t) for _, t in rows]
    links = [[] for _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                links[i].append(j)
                links[j].append(i)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(links[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def changed(text, n, seed):
    r, words = random.Random(seed), text.split()
    for _ in range(n):
        words[r.randrange(len(words))] = "changed%d" % r.randrange(10**6)
    return " ".join(words)


def found(spark, rows):
    df = near_duplicates.near_duplicates(docs(spark, rows))
    return sorted(((r.doc_id, r.n_links, r.component_id) for r in df.collect()), key=str)


def test_hashes_are_of_words():
    texts = ["a b c d e f", "A", "a  b\tc\nd e f", "", None, "x y z", "b c d e f", "é ü"]
    sets = list(shingle_sets(pa.array([t and t.lower() for t in texts]).slice(0), 5))
    assert [len(s) for s in sets] == [2, 1, 2, 0, 0, 1, 1, 1]
    assert (sets[0] == sets[2]).all() and sets[6][0] in sets[0]
    long_ = [prose(i, 3_000) for i in range(400)]
    for text, s in zip(long_, shingle_sets(pa.array(long_), 5), strict=True):
        assert len(s) == len(grams(text))


def test_against_brute_force(spark):
    rows = odd_rows()
    for k in range(12):
        base = prose(100 + k, 60 + 20 * k)
        rows += [(1000 + 20 * k + v, changed(base, v, v)) for v in range(7)]
        rows += [(1000 + 20 * k + 10, base), (1000 + 20 * k + 11, base.upper())]
    assert found(spark, rows) == brute_force(rows)


def test_large_groups_are_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 8)
    base = prose(1, 200)
    rows = [(i, changed(base, 1 + i % 3, i)) for i in range(60)] + [(100 + i, base) for i in range(20)]
    assert found(spark, rows) == brute_force(rows)


def test_all_pairs_of_a_large_bucket_meet(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 8)
    r = np.random.default_rng(3)
    rows = []
    for k in range(40):  # one bucket; two classes are alike, and unlike the first and all others
        marks = r.integers(0, 2**16, 40).astype(np.uint16)
        marks[:4] = 7
        rows += [(2 * k, marks.tobytes()), (2 * k + 1, marks.tobytes())]
    classes = spark.createDataFrame(rows, "node long, signature binary")
    links = near_duplicates._likely_links(classes, 1, 4, 0.6).collect()
    assert {(x.a, x.b) for x in links} == {(2 * k + 1, 2 * k) for k in range(40)}


def test_one_of_each(spark):
    rows = odd_rows() + [(50, prose(5, 50)), (51, changed(prose(9, 100), 1, 1)), (52, prose(9, 100))]
    table = docs(spark, rows)
    kept = near_duplicates.one_of_each(table)
    assert kept.columns == table.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(["None", "None", "1", "2", "3", "4", "5", "5", "7", "8", "9", "51"])
    assert near_duplicates.one_of_each(table.where("false")).count() == 0


def test_one_of_each_of_groups_under_one_name(spark):
    a, b, c, d = (prose(k, 100) for k in (20, 21, 22, 23))
    rows = [(5, a), (6, changed(a, 1, 1)), (5, b), (7, changed(b, 1, 1))]
    rows += [(None, t) for x in (c, d) for t in (x, x, changed(x, 1, 1))]
    kept = [(r.doc_id, r.text) for r in near_duplicates.one_of_each(docs(spark, rows)).collect()]
    assert sorted(t for i, t in kept if i is not None) == sorted([a, b])
    left = [t for i, t in kept if i is None]
    assert len(kept) == 4 and {t in (c, changed(c, 1, 1)) for t in left} == {True, False}


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    r = np.random.default_rng(seed)
    links = r.integers(0, 200, (150, 2)).tolist() + [[1000 + i, 1001 + i] for i in range(40)] + [[5, 5]]
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = list(range(2000))
    for _ in range(2000):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: root[n] for a, b in links if a != b for n in (a, b)}


def test_banding_reaches_recall():
    settings = near_duplicates.Settings()
    bands, rows = settings.banding()
    assert 1 - (1 - settings.threshold**rows) ** bands >= settings.recall
