"""The ways taken beyond the size limits give what the short ways give, with a hot series."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeloom.operators import clean, correlation, evaluate, features, ordered
from gaugeloom.operators import windows as win
from gaugeloom.operators.split import split_rows, split_series, validation_tail


@pytest.fixture(scope="module")
def hot(spark):
    """One series holds more than a third of the rows; values repeat a lot, some are null."""
    draw = random.Random(5)
    rows = []
    for s, n in enumerate([400, 90, 1, 2, 130, 77, 200, 33]):
        for t in range(n):
            x = float(draw.choice([0, 0, 0, 1, 2, 50])) + (draw.random() if draw.random() < 0.3 else 0)
            rows.append((s, t * 3 + draw.randrange(3), x, draw.gauss(0, 1)))
    draw.shuffle(rows)
    return spark.createDataFrame(rows, "s int, t int, x double, y double").cache()


def same(a, b):
    names = sorted(a.columns)
    assert names == sorted(b.columns)
    one, two = (sorted(map(repr, (tuple(r) for r in df.select(*names).collect()))) for df in (a, b))
    assert one == two and one


@pytest.mark.parametrize("series", [["s"], []])
def test_positions(hot, series):
    order = ["t", "s"]
    same(ordered.positions(hot, series, order), ordered.positions(hot, series, order, max_rows=0))


@pytest.mark.parametrize("series", [["s"], []])
def test_running_total(hot, series):
    df = hot.withColumn("w", (F.col("t") % 5).cast("long"))
    args = (df, series, ["t", "s"], "w", "before", "whole")
    same(ordered.running_total(*args), ordered.running_total(*args, max_rows=0))


def test_positions_with_null_series(spark, hot):
    df = hot.withColumn("s", F.when(F.col("s") != 0, F.col("s")))
    same(ordered.positions(df, ["s"], ["t", "y"]), ordered.positions(df, ["s"], ["t", "y"], max_rows=0))


@pytest.mark.parametrize("block_rows", [1, 7, 64])
@pytest.mark.parametrize("future", [False, True])
def test_windows(hot, block_rows, future):
    parts = split_rows(hot, 0.6, 0.2, ["s"], ["t"])
    wide = split_rows(hot, 0.6, 0.2, ["s"], ["t"], max_rows=0)
    args = (["x", "y"], "y", 5, 2, ["s"], ["t"], None, future)
    same(win.windows(parts, *args), win.windows(wide, *args, block_rows=block_rows))


def test_rolling_features(hot):
    args = (["x"], 9, ["s"], ["t"])
    names = ["s", "t", "x_mean", "x_min", "x_max"]
    short, long = (
        features.add_rolling_features(hot, *args, **limits).select(*names).withColumn("x_mean", F.round("x_mean", 9))
        for limits in ({}, {"max_rows": 0, "block_rows": 10})
    )
    same(short, long)


@pytest.mark.parametrize("window_rows", [None, 12])
def test_prefix_windows(hot, window_rows):
    df = hot.withColumn("t2", F.col("t").cast("double"))
    one = features.prefix_windows(df, "t2", ["s"], ["t"], window_rows)
    same(one, features.prefix_windows(df, "t2", ["s"], ["t"], window_rows, max_rows=0, block_rows=16))


def test_split_series_and_tail(hot):
    same(split_series(hot, 0.5, 0.2, ["s"]), split_series(hot, 0.5, 0.2, ["s"], max_rows=0))
    tail = validation_tail(hot, 0.25, ["s"], ["t"])
    same(tail, validation_tail(hot, 0.25, ["s"], ["t"], max_rows=0))
    n = hot.count()
    assert tail.where("validation").count() == n - int(n * 0.75)


def test_monotonic(hot):
    for limit in (ordered.MAX_SERIES_ROWS, 0):
        assert clean.is_monotonic(hot, "t", ["s"], ["t"], limit)
        assert not clean.is_monotonic(hot, "y", ["s"], ["t"], limit)


def test_shuffle_thin_overlay(hot):
    df = ordered.positions(hot, ["s"], ["t"]).drop("n_rows")
    for combined in (False, True):
        same(
            win.shuffle_samples(df, 3, ["s"], combined=combined),
            win.shuffle_samples(df, 3, ["s"], combined=combined, max_rows=0),
        )
    sequences = df.select("s", "idx", F.array("x", "y").alias("predicted"))
    same(win.thin_sequences(sequences, 2, series=["s"]), win.thin_sequences(sequences, 2, series=["s"], max_rows=0))
    guess, truth = win.x_windows(hot, ["y"], 4, 0, ["s"], ["t"]), hot.select("s", "t", "y")
    same(evaluate.overlay(truth, guess, 4, ["s"], ["t"]), evaluate.overlay(truth, guess, 4, ["s"], ["t"], max_rows=0))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.sampled_from([-3.5, 0.0, 1.0, 1.0, 2.5, 1e9]) | st.floats(-1e6, 1e6), min_size=1, max_size=80))
def test_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    probs = [0.0, 0.05, 0.5, 0.75, 1.0]
    for limit in (10**6, 0):
        found = ordered.quantile_values(df, {"x": probs}, exact_rows=limit)
        assert [found["x", p] for p in probs] == pytest.approx(list(np.quantile(values, probs)), rel=1e-9, abs=1e-9)


def test_missed_brackets_are_found(hot, monkeypatch):
    values = sorted(r.x for r in hot.collect())
    monkeypatch.setattr(ordered, "_merged", lambda intervals: [(1e12, 2e12)])
    found = ordered.order_statistics(hot, {"x": [0, 500, len(values) - 1]})
    assert [found["x", r] for r in (0, 500, len(values) - 1)] == [values[0], values[500], values[-1]]


def test_kth_largest(hot):
    values = sorted((r.y for r in hot.collect()), reverse=True)
    for k in (1, 17, len(values)):
        assert ordered.kth_largest(hot, "y", k) == values[k - 1]


def ranks(values):
    at = sorted(values)
    first = {v: i for i, v in reversed(list(enumerate(at)))}
    return np.array([first[v] + (at.count(v) + 1) / 2 for v in values])


@pytest.mark.parametrize("max_rows", [ordered.MAX_SERIES_ROWS, 0])
def test_rank_correlations_equal_brute_force(hot, max_rows):
    rows = hot.limit(300).collect()
    df = hot.sparkSession.createDataFrame([(r.x, float(r.t % 11)) for r in rows], "a double, b double")
    a, b = [r.x for r in rows], [float(r.t % 11) for r in rows]
    assert correlation.spearman(df, "a", "b", max_rows) == pytest.approx(np.corrcoef(ranks(a), ranks(b))[0, 1])
    pairs = list(itertools.combinations(range(len(a)), 2))
    score = sum(np.sign(a[i] - a[j]) * np.sign(b[i] - b[j]) for i, j in pairs)
    free = [sum(v[i] != v[j] for i, j in pairs) for v in (a, b)]
    assert correlation.kendall(df, "a", "b", max_rows) == pytest.approx(score / np.sqrt(free[0] * free[1]))


def test_pearson_equals_numpy_on_complete_pairs(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(500, 4)) + 1e6
    x[:, 1] += x[:, 0] * 0.5
    x[:, 3] = 7.3
    x[draw.random((500, 4)) < 0.1] = np.nan
    df = spark.createDataFrame([tuple(float(v) for v in row) for row in x], "a double, b double, c double, d double")
    df = df.select(*[F.nanvl(c, F.lit(None)).alias(c) for c in df.columns])
    found = {(r.variable, r.other): r.r for r in correlation.correlations(df, df.columns).collect()}
    assert len(found) == 12
    for (i, a), (j, b) in itertools.permutations(enumerate("abcd"), 2):
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        if "d" in (a, b):
            assert found[a, b] is None
        else:
            assert found[a, b] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


def test_cramers_v_two_by_two(spark):
    rows = [("a", "x")] * 30 + [("a", "y")] * 10 + [("b", "x")] * 5 + [("b", "y")] * 25
    df = spark.createDataFrame(rows, "u string, v string")
    o = np.array([[30, 10], [5, 25]])
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    chi2 = ((np.abs(o - e) - 0.5) ** 2 / e).sum()
    n = o.sum()
    phi2 = max(0, chi2 / n - 1 / (n - 1))
    assert correlation.cramers_v(df, "u", "v") == pytest.approx(np.sqrt(phi2 / (1 - 1 / (n - 1))))
    assert correlation.cramers_v(df, "u", "v", max_distinct=1) is None
