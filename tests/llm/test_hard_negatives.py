import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeloom.llm import hard_negatives
from gaugeloom.llm.hard_negatives import Settings, hard_negatives as mined
from gaugeloom.llm.queries import QUERIES


def brute(rows, every=50, positives=5, negatives=3):
    """(anchor, positive, rank, negative, scores) of (vec_id, label, vector) rows; the anchors are every n-th identifier."""
    rows = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[2]]
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for i, (a, label, v) in enumerate(rows):
        if a is None or a % every:
            continue
        others = [(sum(p * q for p, q in zip(v, w)), b, k) for j, (b, k, w) in enumerate(rows) if j != i and len(w) == len(v)]
        for s, b, _ in sorted((x for x in others if x[2] == label), key=order)[:positives]:
            hard = [x for x in others if x[2] != label and 50 * s <= 100 * x[0] <= 95 * s]
            for rank, (score, c, _) in enumerate(sorted(hard, key=order)[:negatives], 1):
                out.append((a, b, rank, c, s, score))
    return sorted(out, key=str)


def frame(spark, rows):
    schema = "vec_id long, label int, vector array<long>, node string, size int, part int, block string, search int, norm int"
    return spark.createDataFrame([(*r, "n", 1, 2, "b", 3, 4) for r in rows], schema).repartition(4)


def found(df, every=50, settings=Settings()):
    got = mined(df, F.col("vec_id") % every == 0, settings=settings)
    return sorted((tuple(r) for r in got.collect()), key=str)


def clustered(n, width=12, labels=4, seed=0, scale=100):
    r = np.random.default_rng(seed)
    centres = r.normal(0, scale, (labels, width))
    return [(i, int(i * 7 % labels), [int(x) for x in np.floor(centres[i % labels] * 0.6 + r.normal(0, scale, width))]) for i in range(n)]


@pytest.mark.parametrize("block, anchors", [(4096, 64), (8, 3)])
def test_against_brute_force(spark, block, anchors):
    rows = clustered(400)
    got = found(frame(spark, rows), 20, Settings(block=block, anchors=anchors))
    assert got == brute(rows, 20) and len(got) > 50


def test_ties_copies_and_negative_scores(spark):
    r = random.Random(3)
    rows = [(i, r.randrange(3), [r.randrange(-2, 3) for _ in range(3)]) for i in range(300)]
    rows += [(1000 + i, 1, [2, 2, 2]) for i in range(100)]  # a third of one vector
    got = found(frame(spark, rows), 10, Settings(block=16))
    assert got == brute(rows, 10) and len(got) > 100


def test_odd_rows(spark):
    rows = clustered(60, 4, 2) + [
        (None, 0, [9, 9, 9, 9]),
        (None, 1, [9, 9, 9, 9]),
        (100, None, [1, 2, 3, 4]),
        (150, 1, None),
        (200, 1, [1, None, 3, 4]),
        (250, 1, []),
        (300, 0, []),
        (350, 1, []),
        (400, 0, [0, 0, 0, 0]),
        (401, 0, [0, 0, 0, 0]),
        (402, 1, [0, 0, 0, 0]),
        (450, 0, [50, -20, 7]),
        (451, 0, [45, -20, 7]),
        (452, 1, [40, -20, 7]),
        (500, 1, [10**8, 3, -(10**8), 7]),
        (501, 1, [10**8, 5, -(10**8), 1]),
        (502, 0, [9 * 10**7, 5, -(10**8), 1]),
        (50, 0, [30, 40, 50, 60]),
        (50, 0, [30, 40, 50, 60]),
    ]
    table = frame(spark, rows)
    got = found(table)
    assert got == brute(rows)
    assert {250, 400, 450, 500} <= {g[0] for g in got}
    assert found(table.where("false")) == []
    assert found(table.where("vec_id = 50")) == []


def test_bounds_hold_and_rule_out(spark):
    """Every score lies within its bounds, and with clear clusters most pairs need no score."""
    rng = np.random.default_rng(1)
    x = np.floor(np.repeat(np.eye(8), 40, 0) * 900 + rng.normal(0, 40, (320, 8))).astype(np.int64)
    references = np.eye(8)
    norms = np.sqrt((x.astype(float) ** 2).sum(1))
    theta = np.arccos(np.clip((x @ references.T) / norms[:, None], -1, 1))

    class Part:
        pass

    part = Part()
    part.cos, part.sin, part.norm, part.node = np.cos(theta), np.sin(theta), norms, np.arange(320)
    low, high = hard_negatives._bounds(part, part)
    scores = x @ x.T
    assert (low <= scores).all() and (scores <= high).all()
    wanted = high >= 0.5 * scores.max(1, keepdims=True)
    assert wanted.mean() < 0.3


def test_query_on_unclean_components(spark, tmp_path):
    nan, inf = math.nan, math.inf
    rows = [(i, i % 3, [((i * 37 + k * 11) % 100) / 100 - 0.3 for k in range(6)]) for i in range(200)]
    rows += [(200, 1, [nan] * 6), (250, 1, [inf, 0.0, 0.0, 0.0, 0.0, 0.0]), (300, None, [0.5] * 6), (350, 1, None), (400, 1, [None] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    got = sorted((tuple(r) for r in QUERIES["op13_hard_negatives"](spark, str(tmp_path)).collect()), key=str)
    clean = []
    for i, label, v in rows[:200]:
        label = (label + 1) % 10 if i % 7 == 0 else label
        clean.append((i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    assert got == brute(clean) and got
