"""Rank tests and step-up against brute force."""

import itertools
import math

import numpy as np
import pytest

from gaugeloom.operators import relevance as rel


def table(spark, n=150, seed=0):
    draw = np.random.default_rng(seed)
    target = draw.normal(size=n).round(1)
    rows = []
    for i in range(n):
        told = float(target[i] + draw.normal(0, 0.5))
        rows.append((told, float(round(target[i])), float(draw.normal()), 1.0, None if i % 3 else told, float(target[i]), "abc"[int(draw.integers(0, 3)) if i % 2 else int(target[i] > 0)]))
    names = "near double, tied double, noise double, fixed double, gaps double, target double, class string"
    return spark.createDataFrame(rows, names).repartition(3)


def brute_kendall(x, y):
    """Score over the deviation, the variance with ties from its three terms."""
    n = len(x)
    score = sum(np.sign(x[i] - x[j]) * np.sign(y[i] - y[j]) for i, j in itertools.combinations(range(n), 2))
    t, u = (np.unique(v, return_counts=True)[1].astype(float) for v in (x, y))
    var = (n * (n - 1) * (2 * n + 5) - (t * (t - 1) * (2 * t + 5)).sum() - (u * (u - 1) * (2 * u + 5)).sum()) / 18
    var += (t * (t - 1)).sum() * (u * (u - 1)).sum() / (2 * n * (n - 1))
    var += (t * (t - 1) * (t - 2)).sum() * (u * (u - 1) * (u - 2)).sum() / (9 * n * (n - 1) * (n - 2))
    return score / math.sqrt(var)


@pytest.mark.parametrize("block", [1_000_000, 20])
def test_values(spark, block):
    df = table(spark)
    found = {r.variable: r for r in rel.relevance(df, "target", ["near", "tied", "noise", "fixed", "gaps"], block_rows=block).collect()}
    rows = df.toPandas()
    for c in ("near", "tied", "noise", "gaps"):
        both = rows[[c, "target"]].dropna()
        z = brute_kendall(both[c].to_numpy(), both.target.to_numpy())
        assert found[c].z == pytest.approx(z) and found[c].n == len(both)
        assert found[c].p_value == pytest.approx(math.erfc(abs(z) / math.sqrt(2)))
    assert found["fixed"].z is None and found["fixed"].p_value == 1.0
    assert {c for c, r in found.items() if r.relevant} == {"near", "tied", "gaps"}
    assert rel.select_relevant(df, "target", ["near", "noise", "fixed"]).columns == ["near", "tied", "gaps", "target", "class"]


def brute_rank_sum(x, mine):
    """U by comparing all values of the class with all others."""
    a, b = x[mine], x[~mine]
    u = sum((p > b).sum() + (p == b).sum() / 2 for p in a)
    t = np.unique(x, return_counts=True)[1].astype(float)
    n, m, k = len(x), len(a), len(b)
    var = m * k / 12 * (n + 1 - (t**3 - t).sum() / (n * (n - 1)))
    away = u - m * k / 2
    return math.copysign(max(abs(away) - 0.5, 0), away) / math.sqrt(var)


@pytest.mark.parametrize("max_rows", [1_000_000, 0])
def test_classes(spark, max_rows):
    df = table(spark)
    cols = ["near", "tied", "noise", "fixed", "gaps"]
    found = {(r.variable, r["class"]): r for r in rel.relevance(df, "class", cols, classes=True, max_rows=max_rows).collect()}
    assert len(found) == 15
    rows = df.toPandas()
    for c, name in itertools.product(("near", "tied", "noise", "gaps"), "abc"):
        both = rows[[c, "class"]].dropna()
        z = brute_rank_sum(both[c].to_numpy(), (both["class"] == name).to_numpy())
        assert found[c, name].z == pytest.approx(z), (c, name)
    assert not found["fixed", "a"].relevant and found["near", "a"].relevant
    two = rel.relevance(df.where("class <> 'c'"), "class", cols, classes=True).collect()
    assert {r["class"] for r in two} == {"b"} and len(two) == 5
    assert "noise" not in rel.select_relevant(df, "class", cols, classes=True).columns
    assert "near" not in rel.select_relevant(df, "class", cols, classes=True, least_classes=4).columns


def brute_step_up(p, level):
    """Every set of the k smallest is tried."""
    order = sorted(range(len(p)), key=lambda i: p[i])
    keep = set()
    for k in range(1, len(p) + 1):
        if p[order[k - 1]] <= level * k / len(p):
            keep = {i for i in range(len(p)) if p[i] <= p[order[k - 1]]}
    return [i in keep for i in range(len(p))]


def test_step_up():
    draw = np.random.default_rng(1)
    for _ in range(200):
        p = draw.choice([0.001, 0.004, 0.01, 0.02, 0.03, 0.04, 0.05, 0.2, 0.9], draw.integers(1, 9)).tolist()
        assert rel.step_up(p, 0.05, True) == brute_step_up(p, 0.05)
        assert rel.step_up(p, 0.05) == brute_step_up(p, 0.05 / sum(1 / i for i in range(1, len(p) + 1)))
    assert rel.step_up([0.04, 0.05], 0.05, True) == [True, True]  # the larger one carries the smaller
    assert rel.step_up([], 0.05) == []


def test_empty_and_tiny_tables(spark):
    df = table(spark)
    for few in (df.where("false"), df.limit(1)):
        assert all(r.p_value == 1.0 and not r.relevant for r in rel.relevance(few, "target", ["near", "gaps"]).collect())
        assert all(not r.relevant for r in rel.relevance(few, "class", ["near", "gaps"], classes=True).collect())
