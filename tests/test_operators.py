"""Hand-sized cases with exact results."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugeloom.functions import columns as fn
from gaugeloom.operators import clean, encode, evaluate, features, ordered, profiling, registry
from gaugeloom.operators import windows as win
from gaugeloom.operators.scale import apply_scaler, fit_scaler, invert_scaler, scale_pair
from gaugeloom.operators.split import split_rows, split_series, validation_tail


def series(spark, n, name="a"):
    return spark.createDataFrame([(name, i, float(i), float(10 * i)) for i in range(n)], "s string, t int, x double, y double")


def column(df, name):
    return [r[0] for r in df.select(name).collect()]


def test_drop_null_rows_drops_nan_too(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (4.0, math.nan)], "a double, b double")
    assert clean.drop_null_rows(df).count() == 1


def test_move_column_honours_place(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert clean.move_column(df, "a", 2).columns == ["b", "c", "a"]
    assert clean.move_column(df, "c", 0).columns == ["c", "a", "b"]


def test_select_features_without_list_keeps_all(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, y int")
    assert clean.select_features(df, [], "y").columns == ["y", "a", "b"]


def test_select_numeric_keeps_booleans(spark):
    df = spark.createDataFrame([(1, True, "x")], "a int, b boolean, c string")
    assert clean.select_numeric(df).columns == ["a", "b"]


def test_require_features(spark):
    with pytest.raises(ValueError, match="pressure"):
        clean.require_features(series(spark, 1), ["x", "pressure"])


def test_every_kth(spark):
    assert sorted(column(ordered.every_kth(series(spark, 25), 10, ["s"], ["t"]), "t")) == [0, 10, 20]


def test_segments_of_every_kth_row(spark):
    thin = ordered.every_kth(series(spark, 95), 10, ["s"], ["t"])
    cut = features.segment(thin, 5, ["s"], ["t"])
    assert {r.t: r.segment for r in cut.collect()} == {10 * i: i // 5 + 1 for i in range(10)}
    assert features.segment(ordered.every_kth(series(spark, 89), 10, ["s"], ["t"]), 5, ["s"], ["t"]).count() == 5


def test_positions_are_counted_anew_after_dropping_rows(spark):
    df = ordered.positions(series(spark, 6), ["s"], ["t"]).withColumn("x", F.when(F.col("t") != 2, F.col("x")))
    made = win.windows(clean.drop_null_rows(df), ["x"], "y", 2, 1, ["s"], ["t"]).orderBy("idx").collect()
    assert [r.X for r in made] == [[[a], [b]] for a, b in ((0.0, 1.0), (1.0, 3.0), (3.0, 4.0), (4.0, 5.0))]


def test_constant_and_zero_columns(spark):
    df = spark.createDataFrame([(5, 1, 0), (5, 2, 0), (5, 3, 1), (5, 4, 2)], "a int, b int, c int")
    assert column(clean.constant_columns(profiling.count_stats(df, ["a", "b"])), "variable") == ["a"]
    zeros = profiling.zero_stats(df, ["a", "b", "c"])
    assert column(clean.zero_columns(zeros, 0.5), "variable") == []
    assert column(clean.zero_columns(zeros, 0.4), "variable") == ["c"]


def pairs(spark, *rows):
    both = [r for a, b, v in rows for r in ((a, b, v), (b, a, v))]
    return spark.createDataFrame(both, "variable string, other string, r double")


def test_greedy_correlation_rule(spark):
    table = pairs(spark, ("a", "b", 0.99), ("b", "c", 0.99), ("a", "c", 0.5))
    assert clean.correlated_columns(table, 0.9, order=["a", "b", "c"]) == ["b"]
    assert clean.correlated_columns(pairs(spark, ("a", "b", -0.99)), 0.9, order=["a", "b"]) == []
    assert clean.correlated_columns(pairs(spark, ("a", "b", 0.99)), 0.9, "a", order=["a", "b"]) == []


def test_removed_columns_do_not_remove_others(spark):
    table = pairs(spark, ("a", "b", 0.99))
    assert clean.correlated_columns(table, 0.9, order=["a", "b"], removed=["a"]) == []


def test_label_encode(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "c"), (3, "a")], "i int, t string")
    assert column(encode.label_encode(df, "t").orderBy("i"), "t") == [1, 0, 2, 0]
    numbers = spark.createDataFrame([(0, 10), (1, 2), (2, 10)], "i int, t int")
    assert column(encode.label_encode(numbers, "t").orderBy("i"), "t") == [1, 0, 1]


def test_onehot(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "c")], "i int, t string")
    made, names = encode.onehot_encode(df, "t")
    assert names == ["t_0", "t_1", "t_2"] and "t" not in made.columns
    assert [tuple(r)[1:] for r in made.orderBy("i").collect()] == [(0, 1, 0), (1, 0, 0), (0, 0, 1)]
    with pytest.raises(ValueError):
        encode.onehot_encode(df.where("t <> 'c'"), "t")


def test_decoders(spark):
    df = spark.createDataFrame([([0.1, 0.7, 0.2],), ([0.5, 0.5],)], "p array<double>")
    assert column(encode.decode_argmax(df, "p"), "predicted") == [1, 0]
    scores = spark.createDataFrame([(0.5,), (0.51,), (math.nan,)], "p double")
    assert column(encode.decode_binary(scores, "p"), "predicted") == [0, 1, 0]


def scaled(spark, train, test, method):
    rows = [("train", float(v)) for v in train] + [("test", float(v)) for v in test]
    df = spark.createDataFrame(rows, "part string, x double").coalesce(1)
    return [round(v, 6) for v in column(apply_scaler(df, fit_scaler(df, ["x"], method)), "x")]


def test_scalers(spark):
    assert scaled(spark, [0, 10], [15], "minmax") == [0, 1, 1.5]
    assert scaled(spark, [7, 7], [], "minmax") == [0, 0]
    assert scaled(spark, [1, 2, 3], [], "standard") == [-1.224745, 0, 1.224745]
    assert scaled(spark, [0, 1, 2, 3, 4], [], "robust") == [-1, -0.5, 0, 0.5, 1]
    assert scaled(spark, [1, 2], [3], None) == scaled(spark, [1, 2], [3], "none") == [1, 2, 3]
    with pytest.raises(NotImplementedError):
        scaled(spark, [1], [], "log")
    with pytest.raises(ValueError):
        scaled(spark, [], [1], "minmax")


def test_scale_pair_and_inverse(spark):
    a, b, scaler = scale_pair(series(spark, 11).limit(11), series(spark, 3), ["x"])
    assert column(b, "x") == [0.0, 0.1, 0.2]
    assert column(invert_scaler(b, scaler), "x") == [0, 1, 2]


def sizes(df):
    return {r.part: r["count"] for r in df.groupBy("part").count().collect()}


def test_split_rows(spark):
    assert sizes(split_rows(series(spark, 10), 0.7, 0, ["s"], ["t"])) == {"train": 7, "test": 3}
    assert sizes(split_rows(series(spark, 10), 0.7, 0.2, ["s"], ["t"])) == {"train": 7, "calibrate": 2, "test": 1}
    assert sizes(split_rows(series(spark, 100), 0.29, 0, ["s"], ["t"])) == {"train": 28, "test": 72}


def test_split_series(spark):
    df = spark.createDataFrame([(i,) for i in (1, 2, 3, 10, 20)], "s int")
    found = {r.s: r.part for r in split_series(df, 0.5, 0.2, ["s"]).collect()}
    assert found == {1: "train", 10: "train", 2: "calibrate", 20: "test", 3: "test"}
    shuffled = split_series(df, 0.5, 0.2, ["s"], shuffle=True)
    assert sizes(shuffled) == {"train": 2, "calibrate": 1, "test": 2}
    assert sizes(split_series(df, 1.0, 0.0, ["s"])) == {"train": 5}
    assert sizes(split_series(df, 0.1, 0.0, ["s"])) == {"test": 5}


def test_validation_tail(spark):
    df = series(spark, 6, "a").unionByName(series(spark, 4, "b"))
    found = validation_tail(df, 0.25, ["s"], ["t"]).where("validation").select("s", "t").collect()
    assert sorted(map(tuple, found)) == [("b", 1), ("b", 2), ("b", 3)]
    assert validation_tail(df, 0.0, ["s"], ["t"]).where("validation").count() == 0
    assert validation_tail(df.where("s = 'a'"), 0.5, [], ["t"]).where("validation").count() == 3


def ends(df):
    return sorted(column(df, "idx"))


def test_windows(spark):
    made = win.windows(series(spark, 5), ["x"], "y", 3, 2, ["s"], ["t"]).orderBy("idx").collect()
    assert [r.X for r in made] == [[[0.0], [1.0], [2.0]], [[1.0], [2.0], [3.0]], [[2.0], [3.0], [4.0]]]
    assert [r.y for r in made] == [[10.0, 20.0], [20.0, 30.0], [30.0, 40.0]]
    assert win.windows(series(spark, 2), ["x"], "y", 3, 1, ["s"], ["t"]).count() == 0
    with pytest.raises(ValueError):
        win.windows(series(spark, 5), ["x"], "y", 2, 3, ["s"], ["t"])


def test_windows_keep_null_inputs_in_place(spark):
    df = series(spark, 4).withColumn("x", F.when(F.col("t") != 1, F.col("x")))
    made = win.windows(df, ["x"], "y", 3, 1, ["s"], ["t"]).orderBy("idx").collect()
    assert made[0].X == [[0.0], [None], [2.0]]


def test_windows_overlap_and_future(spark):
    assert ends(win.x_windows(series(spark, 10), ["x"], 4, 0, ["s"], ["t"])) == [3, 7]
    assert ends(win.x_windows(series(spark, 10), ["x"], 4, 2, ["s"], ["t"])) == [3, 5, 7, 9]
    made = win.windows(series(spark, 5), ["x"], "x", 2, 1, ["s"], ["t"], future=True).orderBy("idx").collect()
    assert [(r.X, r.y) for r in made] == [
        ([[0.0], [1.0]], [2.0]),
        ([[1.0], [2.0]], [3.0]),
        ([[2.0], [3.0]], [4.0]),
    ]


def test_windows_stay_in_series_and_part(spark):
    df = series(spark, 9, "a").unionByName(series(spark, 4, "b"))
    parts = split_rows(df, 0.6, 0, ["s"], ["t"])
    counts = {(r.s, r.part): r["count"] for r in parts.groupBy("s", "part").count().collect()}
    made = win.windows(parts, ["x"], "y", 3, 1, ["s"], ["t"])
    assert made.count() == sum(max(0, n - 2) for n in counts.values())


def test_two_input_samples(spark):
    df = spark.createDataFrame([([[1.0, 9.0], [2.0, 8.0]],)], "X array<array<double>>")
    row = win.split_hist_added(df, ["h", "a"], ["a"]).first()
    assert (row.X_hist, row.X_added) == ([[1.0], [2.0]], [8.0])
    assert win.merge_hist_added(win.split_hist_added(df, ["h", "a"], ["a"])).first().X == [1.0, 2.0, 8.0]
    assert win.flatten_windows(df).first().X == [1.0, 9.0, 2.0, 8.0]
    with pytest.raises(TypeError):
        win.merge_hist_added(df, ["X"])


def test_shuffle_is_a_permutation_and_repeats(spark):
    df = series(spark, 50).withColumnRenamed("t", "idx")
    once = {r.idx: r["sample"] for r in win.shuffle_samples(df, 1, ["s"]).collect()}
    again = {r.idx: r["sample"] for r in win.shuffle_samples(df, 1, ["s"]).collect()}
    other = {r.idx: r["sample"] for r in win.shuffle_samples(df, 2, ["s"]).collect()}
    assert sorted(once.values()) == list(range(50)) and once == again != other


def test_combine_needs_train_and_test(spark):
    df = spark.createDataFrame([("train", 1)], "part string, x int")
    assert win.combine(df, "train").count() == 1
    assert win.combine(df, "calibrate").count() == 0
    with pytest.raises(ValueError):
        win.combine(df, "test")


def test_thin_sequences_drops_incomplete_tail(spark):
    rows = [(i, [float(i), float(i + 100)]) for i in range(5)]
    df = spark.createDataFrame(rows, "idx int, predicted array<double>")
    found = sorted(map(tuple, win.thin_sequences(df, 2).collect()))
    assert found == [(0, 0.0, 0), (1, 100.0, 0), (2, 2.0, 1), (3, 102.0, 1)]


def test_segments(spark):
    cut = features.segment(series(spark, 250), 100, ["s"], ["t"])
    assert sizes(cut.withColumnRenamed("segment", "part")) == {1: 100, 2: 100}
    assert column(features.segment_target(cut, "y", ["s"]).orderBy("segment"), "target") == [990.0, 1990.0]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 4.0)], "y double, p double")
    row = evaluate.regression_metrics(df).first()
    assert (round(row.mse, 6), round(row.r2, 6)) == (0.333333, 0.5)
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert evaluate.regression_metrics(flat).first().r2 == 1.0
    assert evaluate.regression_metrics(flat.withColumn("p", F.lit(2.0))).first().r2 == 0.0


@pytest.mark.parametrize("n, k", [(19, 1), (39, 2), (5, 1)])
def test_conformal_border(spark, n, k):
    df = spark.range(1, n + 1).select(F.col("id").cast("double").alias("y"), F.lit(0.0).alias("p"))
    assert evaluate.conformal_border(df, 0.05) == n + 1 - k


def test_conformal_covers_its_calibration_part(spark):
    df = spark.range(200).select(F.rand(3).alias("y"), F.rand(4).alias("p"))
    table = evaluate.predictions(evaluate.conformal(df, df, 0.1))
    assert evaluate.interval_quality(table).first().coverage >= 0.9


def test_midpoint(spark):
    df = spark.createDataFrame([(1.0, 4.0)], "lower_bound double, upper_bound double")
    assert evaluate.midpoint(df).first().predicted == 2.5


def test_history(spark):
    first = spark.createDataFrame([(0, 3.0), (1, 2.0)], "epoch long, val_loss double")
    both = evaluate.concat_history(first, first.withColumn("val_loss", F.col("val_loss") - 1))
    assert sorted(column(both, "epoch")) == [0, 1, 2, 3]
    assert evaluate.best_epoch(both).first().epoch == 3


def test_text_to_bool(spark):
    df = spark.createDataFrame([("True",), ("False",)], "t string")
    assert column(df.select(fn.text_to_bool(F.col("t")).alias("b")), "b") == [True, False]
    with pytest.raises(PySparkException):
        df.select(fn.text_to_bool(F.lit("maybe"))).collect()


def test_stage_name(spark):
    df = spark.createDataFrame([("raw/cnc/01.csv",)], "p string")
    assert df.select(fn.stage_name(F.col("p"), "clean")).first()[0] == "01-clean.csv"


def test_params():
    made = registry.params_from_form("mill", "wear", "rf", 7)
    assert made["split"]["train_split"] == 0.7 and made["clean"]["target"] == "wear"
    assert made["sequentialize"]["window_size"] == 10
    assert registry.DEFAULT_PARAMS["clean"]["target"] is None


def test_registry(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert registry.list_sensors(spark, path).count() == 0
    registry.register(registry.registry_row(spark, registry.params_from_form("a", "t", "rf", 5), {"r2": 0.5}, {}, 1), path)
    registry.register(registry.registry_row(spark, registry.params_from_form("b", "t", "rf", 5), {"r2": 0.7}), path)
    rows = registry.overview(registry.list_sensors(spark, path)).collect()
    assert [(r.dataset, r.target, r.r2) for r in rows] == [("b", "t", 0.7), ("a", "t", 0.5)]
    assert rows[0].id > 1_600_000_000
    with pytest.raises(FileNotFoundError):
        registry.require_assets(registry.list_sensors(spark, path))


def test_profile_kinds_and_messages(spark):
    rows = [(float(i % 3), float(i), -float(i), "yes" if i % 2 else "no", f"w{i}", 1.0, None if i < 30 else 1.5) for i in range(100)]
    df = spark.createDataFrame(rows, "few double, up double, down double, flag string, word string, one double, gap double")
    variables, pairs_found, found = profiling.profile(df)
    kinds = {r.variable: r.kind for r in variables.collect()}
    assert kinds["few"] == "Categorical" and kinds["up"] == "Numeric" and kinds["flag"] == "Boolean"
    got = {(r.kind, r.variable) for r in found.collect()}
    assert {("CONSTANT", "one"), ("MISSING", "gap"), ("HIGH_CORRELATION", "up"), ("HIGH_CORRELATION", "down")} <= got
    assert {("UNIQUE", "up"), ("HIGH_CARDINALITY", "word"), ("ZEROS", "few"), ("UNIFORM", "up")} <= got
    assert {r.variable for r in profiling.rejected(found).collect()} == {"one", "gap", "up", "down"}
    r = {(p.variable, p.other): p.r for p in pairs_found.collect()}
    assert r["up", "down"] == pytest.approx(-1) and r["up", "one"] is None and r["gap", "up"] is None


def test_approximate_counts(spark):
    row = profiling.count_stats(series(spark, 50), ["x"], approximate=True).first()
    assert row.n_unique is None and abs(row.n_distinct - 50) <= 5


def test_chi_square_tail_is_that_of_the_library():
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.stat import Statistics

    for counts in ([5, 7], [1] * 60, [3, 9, 1, 22, 8], list(range(1, 300)), [1000] * 40 + [1100]):
        mean = sum(counts) / len(counts)
        statistic = sum((n - mean) ** 2 / mean for n in counts)
        want = Statistics.chiSqTest(Vectors.dense(counts)).pValue
        assert abs(profiling.chi_square_tail(statistic, len(counts) - 1) - want) < 1e-9
    assert abs(profiling.chi_square_tail(100_300.0, 100_000) - profiling.chi_square_tail(100_301.0, 100_001)) < 1e-4
    assert profiling.chi_square_tail(0.0, 10**9) == 1.0


def test_large_integers_stay_apart(spark):
    df = spark.createDataFrame([(2**53, 1.0), (2**53 + 1, 1.0), (2**53 + 1, 2.0)], "id long, x double")
    counts = {r.variable: (r.n_distinct, r.n_unique) for r in profiling.count_stats(df, ["id", "x"]).collect()}
    assert counts == {"id": (2, 1), "x": (2, 1)}
    assert clean.constant_columns(profiling.count_stats(df, ["id", "x"])).count() == 0
    exact = df.selectExpr("id", "cast(id as decimal(30,2)) + 0.01 as d")
    assert {r.variable: r.n_distinct for r in profiling.count_stats(exact, ["id", "d"]).collect()} == {"id": 2, "d": 2}
    assert sorted(r.n for r in profiling.value_counts(df, ["id", "x"]).collect()) == [1, 1, 2, 2]


def test_cramers_sees_text_columns(spark):
    df = spark.createDataFrame([("a", "a", 1), ("b", "b", 1), ("a", "a", 2), ("b", "b", 2)] * 5, "p string, q string, k int")
    _, pairs, _ = profiling.profile(df, correlation_metric="cramers")
    found = {(r.variable, r.other): r.r for r in pairs.collect()}
    assert found["p", "q"] > 0.8 and abs(found["p", "k"]) < 0.1


def test_label_encoder_on_null_and_unknown_classes(spark):
    codes = encode.fit_label_encoder(spark.createDataFrame([("a",), ("b",)], "t string"), "t")
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "t string, n int")
    assert sorted((r.n, r.t) for r in encode.apply_label_encoder(df, codes, "t").collect()) == [(1, 0), (2, None), (3, 1)]
    with pytest.raises(Exception, match="class without a code: z"):
        encode.apply_label_encoder(df.unionByName(spark.createDataFrame([("z", 4)], df.schema)), codes, "t").collect()


def test_null_series_are_joined(spark):
    a = spark.createDataFrame([(None, 0, 1.0), ("s", 0, 2.0)], "s string, idx int, x double")
    b = spark.createDataFrame([(None, 0, 3.0), ("s", 0, 4.0)], "s string, idx int, y double")
    rows = evaluate.join_by_position(a, b, ["s"]).collect()
    assert sorted((str(r.s), r.x, r.y) for r in rows) == [("None", 1.0, 3.0), ("s", 2.0, 4.0)]
