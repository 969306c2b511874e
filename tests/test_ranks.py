"""Rank correlations and contingency tables of all pairs against brute force, with gaps, ties and hot values."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest

from gaugeloom.operators import correlation, ranks


def columns(n=400, seed=0):
    draw = np.random.default_rng(seed)
    x = pd.DataFrame({"a": draw.normal(size=n), "b": draw.integers(0, 9, n).astype(float)})
    x["c"] = np.where(draw.random(n) < 0.4, 0.0, x.a + draw.normal(size=n))  # one hot value
    x["d"] = x.b * 3 - np.round(x.a)
    x["e"] = 5.0
    x["f"] = draw.exponential(size=n)
    x.loc[draw.random(n) < 0.2, "d"] = np.nan
    x.loc[draw.random(n) < 0.3, "f"] = np.nan
    return x


def frame(spark, x):
    rows = [tuple(None if i % 2 and math.isnan(v) else float(v) for v in r) for i, r in enumerate(x.itertuples(index=False))]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in x.columns)).repartition(5)


def brute_counts(x, y):
    both = ~(np.isnan(x) | np.isnan(y))
    x, y = x[both], y[both]
    i, j = np.triu_indices(len(x), 1)
    return len(x), int(((x[i] - x[j]) * (y[i] - y[j]) < 0).sum()), int((x[i] == x[j]).sum()), int((y[i] == y[j]).sum())


@pytest.mark.parametrize("block", [1_000_000, 60, 7])
def test_kendall_of_all_pairs(spark, block):
    x = columns()
    pairs = list(itertools.combinations(x.columns, 2))
    found = ranks.kendall_counts(frame(spark, x), pairs, block)
    for (a, b), c in zip(pairs, found):
        assert (c["n"], c["discordant"], c["x2"], c["y2"]) == brute_counts(x[a].to_numpy(), x[b].to_numpy()), (a, b)
    taus = dict(zip(pairs, ranks.kendall_pairs(frame(spark, x), pairs, block)))
    n, less, tx, ty = brute_counts(x.a.to_numpy(), x.b.to_numpy())
    i, j = np.triu_indices(n, 1)
    more = int(((x.a.to_numpy()[i] - x.a.to_numpy()[j]) * (x.b.to_numpy()[i] - x.b.to_numpy()[j]) > 0).sum())
    whole = n * (n - 1) / 2
    assert taus["a", "b"] == pytest.approx((more - less) / math.sqrt((whole - tx) * (whole - ty)))
    assert taus["a", "e"] is None


@pytest.mark.parametrize("max_rows", [1_000_000, 0])
def test_spearman_of_all_pairs(spark, max_rows):
    x = columns(200)
    got = {(r.variable, r.other): r.r for r in correlation.correlations(frame(spark, x), list(x.columns), "spearman", max_rows).collect()}
    assert len(got) == 30
    for a, b in itertools.permutations(x.columns, 2):
        both = x[[a, b]].dropna().rank()
        wanted = both[a].corr(both[b]) if "e" not in (a, b) else None
        assert got[a, b] == (None if wanted is None else pytest.approx(wanted)), (a, b)


def test_the_number_of_jobs_does_not_grow_with_the_pairs(spark):
    x = columns(60)
    df = frame(spark, x).cache()
    df.count()
    tracker = spark.sparkContext.statusTracker()

    def jobs(method, cols):
        group = f"{method}-{len(cols)}"
        spark.sparkContext.setJobGroup(group, group)
        correlation.correlations(df, cols, method)
        spark.sparkContext.setJobGroup("", "")
        return len(tracker.getJobIdsForGroup(group))

    for method in ("spearman", "kendall", "cramers"):
        assert jobs(method, ["a", "b", "c", "d", "f"]) <= jobs(method, ["a", "b"]) + 4, method


def test_inversions_by_digits():
    draw = np.random.default_rng(3)
    for n, most in ((0, 5), (1, 5), (50, 4), (300, 1000)):
        y, w = draw.integers(0, most, n), draw.integers(1, 9, n).astype(float)
        wanted = sum(w[i] * w[j] for i in range(n) for j in range(i + 1, n) if y[i] > y[j])
        assert ranks.later_smaller(y, w) == wanted


def test_cramers_of_all_pairs(spark):
    draw = np.random.default_rng(4)
    rows = [(str(draw.integers(0, 3)), int(v := draw.integers(0, 4)), float(v % 2), f"id{i}", "one", None) for i, _ in enumerate(range(300))]
    rows += [(None, 1, 0.0, "x", "one", None), ("0", None, -0.0, "y", "one", None)]
    df = spark.createDataFrame(rows, "t string, i int, d double, id string, one string, none string")
    names = ["t", "i", "d", "id", "one", "none"]
    got = {(r.variable, r.other): r.r for r in correlation.correlations(df, names, "cramers").collect()}
    x = pd.DataFrame(rows, columns=names)
    for a, b in itertools.combinations(names, 2):
        if {"id", "none"} & {a, b}:
            assert got[a, b] is None
            continue
        both = x[[a, b]].dropna()
        assert got[a, b] == pytest.approx(ranks.cramers(pd.crosstab(both[a], both[b]).to_numpy().astype(float))), (a, b)
    assert got["i", "d"] > 0.95


def test_empty_table(spark):
    df = spark.createDataFrame([], "a double, b double")
    for method in ("spearman", "kendall", "cramers"):
        assert [r.r for r in correlation.correlations(df, ["a", "b"], method).collect()] == [None, None]


@pytest.mark.parametrize("few", [0, 20, 10_000])
def test_spearman_with_ranks_looked_up_and_joined(spark, few, monkeypatch):
    """The staged rows are those of the table, not one for each ranking of each."""
    x = columns(150, 5)
    pairs = list(itertools.combinations(x.columns, 2))
    sizes = {}
    kept = ranks.staged
    monkeypatch.setattr(ranks, "staged", lambda df, name: sizes.setdefault(name, kept(df, name)))
    found = ranks.spearman_pairs(frame(spark, x), pairs, few=few)
    for (a, b), r in zip(pairs, found):
        both = x[[a, b]].dropna().rank()
        assert r == (None if "e" in (a, b) else pytest.approx(both[a].corr(both[b]))), (a, b)
    assert sizes["ranked_values"].count() == 150
    assert ("ranks" in sizes) == (few < 10_000)
