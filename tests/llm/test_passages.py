import random

import pytest
from helpers import docs, odd_rows, prose

from gaugeloom.llm import passages, queries, suffix_dedup


def brute_force(rows, words):
    met = {}
    for k, (_, t) in enumerate(rows):
        w = (t or "").split()
        for i in range(len(w) - words + 1):
            met.setdefault(tuple(w[i : i + words]), set()).add(k)
    shared = set().union(*(ks for ks in met.values() if len(ks) > 1))
    return sorted(((d, k in shared) for k, (d, _) in enumerate(rows)), key=str)


def found(spark, rows, words=50):
    df = suffix_dedup.without_repeats(docs(spark, rows), words=words)
    return sorted(((r.doc_id, r.passage) for r in df.collect()), key=str)


def case(seed):
    """Texts that share runs of 30 to 70 words, some of exactly 49 and 50, inside otherwise different ones."""
    r = random.Random(seed)
    rows = []
    for i in range(40):
        size = r.choice([49, 50, r.randint(30, 70)])
        shared = prose(seed * 1000 + i, size)
        for k in range(r.randint(2, 3)):
            between = [prose(r.randrange(10**9), r.randint(0, 120)), shared, prose(r.randrange(10**9), r.randint(0, 120))]
            rows.append((10 * i + k, r.choice([" ", "\n", " \t "]).join(between).strip()))
    twice = prose(seed + 77, 60)
    rows.append((900, " x ".join([twice, twice])))
    return rows + [(901, rows[0][1]), (902, rows[1][1] + " more"), (902, rows[2][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = case(seed) + [r for r in odd_rows() if len(r[1] or "") < 50_000]
    expected = brute_force(rows, 50)
    assert found(spark, rows) == expected
    assert 20 < sum(x for _, x in expected) < len(rows) - 20


def test_slices(spark, monkeypatch):
    monkeypatch.setattr(passages, "SLICE", 37)
    rows = case(3)
    assert found(spark, rows) == brute_force(rows, 50)


def test_short_passage_of_many_words(spark, tmp_path):
    """A passage of 55 words and fewer than 400 bytes: nothing is removed, and both documents are told of."""
    shared = prose(8, 55)
    assert len(shared) < 400
    rows = [(1, f"{prose(1, 200)} {shared} {prose(2, 90)}"), (2, f"{prose(3, 20)}\n{shared}\n{prose(4, 300)}"), (3, prose(5, 300))]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op7_suffix_dedup"](spark, str(tmp_path)).select("doc_id", "n_removed", "passage").collect()
    assert sorted(map(tuple, got)) == [(1, 0, True), (2, 0, True), (3, 0, False)]


def test_one_shuffle_of_the_texts(spark):
    """The texts are shuffled once for all joins with them; there were two such shuffles before."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plan = suffix_dedup.without_repeats(docs(spark, case(4)))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    lines = plan.splitlines()
    texts = [a for a, b in zip(lines, lines[1:], strict=False) if "Exchange hashpartitioning" in a and "AS body" in b]
    assert len(texts) == 1
