"""Merged states against the profile of the whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeloom.operators import profile_state as ps
from gaugeloom.operators import profiling
from gaugeloom.session import new_table_path


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(0)
    rows = []
    for i in range(3000):
        a = float(draw.exponential() * 1e3 + 1e6)
        rows.append((f"f{i % 7}" if i % 500 else "rare", a, None if i % 5 == 0 else float(i % 3 - 1), int(draw.integers(0, 50)), f"t{i % 40}", 4.0, None))
    rows += [("odd", float("inf"), float("nan"), None, None, 4.0, None), ("odd", float("-inf"), 0.0, 1, "", 4.0, None)]
    names = "file string, a double, b double, c int, t string, same double, none double"
    return spark.createDataFrame(rows, names).repartition(6).cache()


COLS = ["a", "b", "c", "t", "same", "none"]


def test_merged_equals_whole(spark, table):
    parts = ps.states(table, COLS, "file")
    assert parts.count() == 9 * 6
    whole = {r.variable: r for r in ps.described(ps.merged(ps.states(table, COLS))).collect()}
    found = {r.variable: r for r in ps.described(ps.merged(parts)).collect()}
    finite = table.where(F.abs("a") < float("inf"))
    wanted = {r.variable: r for df, c in ((finite, "a"), (table, "c")) for r in profiling.numeric_stats(df, [c]).collect()}
    counts = {r.variable: r for r in profiling.count_stats(table, COLS).collect()}
    for c in COLS:
        assert (found[c].n, found[c].n_missing) == (counts[c].n, counts[c].n_missing), c
        assert found[c].n_distinct == whole[c].n_distinct
        assert abs(found[c].n_distinct - counts[c].n_distinct) <= 0.06 * counts[c].n_distinct
    for c in ("a", "c"):
        for name in ("min", "max", "mean", "std", "variance", "skewness", "kurtosis"):
            assert found[c][name] == pytest.approx(wanted[c][name], rel=1e-9), (c, name)
            assert found[c][name] == pytest.approx(whole[c][name], rel=1e-9)
    assert found["same"].variance == 0 and found["same"].skewness is None
    assert found["a"].n_infinite == 2 and found["t"].n_zeros is None and found["t"].mean is None
    assert found["none"].n_distinct == 0 and found["none"].q50 is None


def test_quantiles_are_near(table):
    found = {r.variable: r for r in ps.described(ps.merged(ps.states(table, COLS, "file"))).collect()}
    for c in ("a", "c"):
        values = np.sort([r[0] for r in table.where((F.abs(c) < float("inf"))).select(F.col(c).cast("double")).collect()])
        for share in (5, 25, 50, 75, 95):
            got = found[c][f"q{share:02d}"]
            low, high = np.searchsorted(values, got, "left"), np.searchsorted(values, got, "right")
            assert low / len(values) - 0.01 <= share / 100 <= high / len(values) + 0.01


def test_states_merge_in_any_order(table):
    parts = ps.states(table, COLS, "file")
    first = ps.merged(parts.where("piece < 'f3'"))
    both = ps.merged(first.unionByName(ps.merged(parts.where("piece >= 'f3'"))))
    for a, b in zip(ps.described(both).orderBy("variable").collect(), ps.described(ps.merged(parts)).orderBy("variable").collect()):
        for name in ("n", "n_missing", "n_distinct", "min", "max"):
            assert a[name] == b[name]
        for name in ("mean", "std", "skewness", "kurtosis"):
            assert a[name] == (None if b[name] is None else pytest.approx(b[name], rel=1e-9))


def test_new_files_only_are_read(spark, table):
    path = new_table_path(spark, "states")
    assert ps.add_pieces(table.where("file < 'f3'"), path, "file", COLS).select("piece").distinct().count() == 3
    # the rows of known pieces are not looked at again
    changed = table.withColumn("a", F.when(F.col("file") < "f3", 0.0).otherwise(F.col("a")))
    rows = ps.add_pieces(changed, path, "file", COLS)
    assert rows.count() == 9 * 6
    found = {r.variable: r for r in ps.described(ps.merged(rows)).collect()}
    assert found["a"].n_zeros == 0 and found["a"].n == table.count()
    assert ps.add_pieces(table, path, "file", COLS).count() == 9 * 6


def test_empty(spark, table):
    assert ps.described(ps.merged(ps.states(table.where("false"), COLS, "file"))).count() == 0


def test_repeated_rows_by_hash(spark):
    rows = [(i % 5, None if i % 2 else "x", float(i % 3)) for i in range(60)] + [(100 + i, "y", float("nan")) for i in range(7)]
    rows += [(200, "z", 0.0), (200, "z", -0.0), (300, None, float("nan")), (300, None, float("nan"))]
    df = spark.createDataFrame(rows, "a int, `b.c` string, d double").withColumnRenamed("b.c", "b")
    groups = df.groupBy("a", "b", "d").count()
    wanted = groups.agg(F.sum(F.col("count") - 1)).first()[0]
    got = profiling.duplicate_count(df).first()
    assert got.n_duplicates == wanted and got.p_duplicates == pytest.approx(wanted / len(rows))
    copies = sorted(r.n_copies for r in profiling.duplicates(df, 1000).collect())
    assert copies == sorted(r["count"] for r in groups.where("count > 1").collect())
    assert tuple(profiling.duplicate_count(df.where("a >= 100 and a < 110")).first()) == (0, 0.0)
    assert profiling.duplicate_count(df.where("false")).first().n_duplicates is None
