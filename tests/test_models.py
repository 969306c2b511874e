"""Models against direct computation, and a sensor from raw rows to predictions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeloom.operators import models, registry
from gaugeloom.plans import sensor as plans


@pytest.fixture(scope="module")
def classes(spark):
    draw = np.random.default_rng(0)
    rows = []
    for c, (center, width) in enumerate([((0, 0, 0), 1.0), ((2, 1, 0), 0.5), ((-1, 2, 1), 2.0)]):
        for x in draw.normal(center, width, size=(120, 3)):
            rows.append(([float(v) for v in x], [float(c)]))
    return spark.createDataFrame(rows, "X array<double>, y array<double>").cache()


@pytest.mark.parametrize("method", ["lda", "qda"])
def test_discriminants(spark, classes, method, tmp_path):
    rows = classes.collect()
    x, y = np.array([r.X for r in rows]), np.array([r.y[0] for r in rows])
    groups = [x[y == c] for c in range(3)]
    covariances = [np.cov(g.T) for g in groups]
    if method == "lda":
        covariances = [sum((len(g) - 1) * c for g, c in zip(groups, covariances)) / (len(x) - 3)] * 3
    scores = [
        -0.5 * (np.einsum("ij,jk,ik->i", x - g.mean(0), np.linalg.inv(c), x - g.mean(0)) + np.log(np.linalg.det(c)))
        + np.log(len(g) / len(x))
        for g, c in zip(groups, covariances)
    ]
    expected = np.argmax(scores, axis=0)
    model = models.train(classes, method, classification=True)
    models.save_model(spark, model, str(tmp_path / "model"))
    model = models.load_model(spark, str(tmp_path / "model"), models.model_kind(model))
    found = [r.predicted for r in models.predict(model, classes).collect()]
    assert found == expected.tolist()


def test_unknown_and_unfit_methods(classes):
    with pytest.raises(NotImplementedError):
        models.train(classes, "cnn")
    with pytest.raises(ValueError):
        models.train(classes, "lda")
    with pytest.warns(UserWarning, match="no early stopping"):
        models.train(classes, "dt", early_stopping=True)


def milling(spark):
    """Ten short experiments; wear shows in vibration, position follows command."""
    rows = []
    draw = np.random.default_rng(3)
    for s in range(10):
        worn = s % 2
        for t in range(60):
            command = float(np.sin(t / 6 + s))
            rows.append(
                (s, t, "worn" if worn else "unworn", command + draw.normal(0, 0.02), command,
                 worn * 2 + draw.normal(0, 0.3), 4.0, draw.normal())
            )
    names = "s int, t int, tool string, position double, command double, vibration double, fixed double, noise double"
    return spark.createDataFrame([tuple(v.item() if hasattr(v, "item") else v for v in r) for r in rows], names)


def test_classification_sensor(spark):
    params = {
        "clean": {"target": "tool", "classification": True},
        "split": {"train_split": 0.6},
        "scale": {"input": "standard"},
        "sequentialize": {"window_size": 5},
        "train": {"learning_method": "xgboost", "n_epochs": 10, "early_stopping": False},
    }
    made, scores = plans.create_sensor(milling(spark), params, ["s"], ["t"], by_series=True)
    assert made.metrics["accuracy"] > 0.9
    assert "fixed" not in made.inputs and made.classes == ["unworn", "worn"]
    assert scores.select("s").distinct().count() == 4


def test_regression_sensor_saved_and_loaded(spark, tmp_path):
    params = {
        "clean": {"target": "position"},
        "split": {"train_split": 0.6, "calibrate_split": 0.2},
        "scale": {"input": "standard", "output": "minmax"},
        "sequentialize": {"window_size": 5},
        "featurize": {"add_rolling_features": True, "rolling_window_size": 3, "remove_features": ["noise"]},
        "train": {"learning_method": "linear", "n_epochs": 50, "early_stopping": False},
    }
    df = milling(spark)
    made, scores = plans.create_sensor(df, params, ["s"], ["t"], by_series=False)
    assert made.metrics["r2"] > 0.8 and "noise" not in made.inputs
    assert scores.where("lower_bound > predicted OR predicted > upper_bound").count() == 0
    assets = plans.save_sensor(spark, made, str(tmp_path / "sensor"))
    path = str(tmp_path / "registry")
    registry.register(registry.registry_row(spark, made.params, made.metrics, assets, 7), path)
    row = registry.require_assets(registry.get_sensor(registry.list_sensors(spark, path), 7)).first()
    loaded = plans.load_sensor(spark, row)
    found = plans.infer(loaded, df.drop("position", "tool"), ["s"], ["t"])
    assert found.count() == 10 * 12
    truth = df.join(found.withColumnRenamed("idx", "t"), ["s", "t"])
    assert truth.agg(F.corr("position", "predicted")).first()[0] > 0.95
    with pytest.raises(ValueError):
        plans.infer(loaded, df.drop("command"), ["s"], ["t"])


def test_several_target_steps(spark):
    params = {
        "clean": {"target": "position"},
        "featurize": {"features": ["command", "vibration"]},
        "scale": {"output": "minmax"},
        "sequentialize": {"window_size": 4, "target_size": 2, "future_predict": True},
        "train": {"learning_method": "dt", "early_stopping": False},
    }
    df = milling(spark)
    made, scores = plans.create_sensor(df, params, ["s"], ["t"], by_series=False)
    assert len(scores.first().predicted) == 2 and made.metrics["r2"] > 0.8
    assert len(plans.infer(made, df.drop("position"), ["s"], ["t"]).first().predicted) == 2
    with pytest.raises(ValueError):
        plans.create_sensor(df, params | {"split": {"calibrate_split": 0.2}}, ["s"], ["t"], by_series=False)


def test_boosting_stops_early(spark):
    df = milling(spark)
    params = {
        "clean": {"target": "noise"},
        "featurize": {"features": ["command"]},
        "sequentialize": {"window_size": 3},
        "train": {"learning_method": "xgboost", "n_epochs": 12, "patience": 3},
    }
    made, _ = plans.create_sensor(df, params, ["s"], ["t"], by_series=False)
    assert models.FIRST_EPOCHS + 3 <= made.model.getNumTrees < models.FIRST_EPOCHS + 12


def test_combined_and_shuffled(spark):
    params = {
        "clean": {"target": "position", "combine_files": True, "correlation_metric": "spearman"},
        "featurize": {"features": ["command", "vibration"], "target_min_correlation_threshold": 0.5},
        "sequentialize": {"window_size": 3, "shuffle_samples": True},
        "train": {"learning_method": "xgboost", "n_epochs": 10},
    }
    df = milling(spark).select("s", "t", "command", "vibration", "position")
    made, scores = plans.create_sensor(df, params, ["s"], ["t"], by_series=False)
    assert made.inputs == ["command"] and "s" not in scores.columns
    assert scores.count() == 300 - 2 and made.metrics["r2"] > 0.8


def test_one_against_rest_is_saved(spark, classes, tmp_path):
    model = models.train(classes, "svm", True, n_epochs=20)
    found = models.predict(model, classes).select("X", "predicted")
    models.save_model(spark, model, str(tmp_path / "svm"))
    loaded = models.load_model(spark, str(tmp_path / "svm"), models.model_kind(model))
    assert models.predict(loaded, classes).select("X", "predicted").collect() == found.collect()
    hits = models.predict(model, classes).where("predicted = y[0]").count()
    assert hits > 0.7 * classes.count()


def test_boosting_of_three_classes(spark, classes):
    samples = classes.withColumn("idx", F.monotonically_increasing_id())
    model = models.train(samples, "xgboost", True, n_epochs=5, early_stopping=True)
    assert models.predict(model, samples).where("predicted = y[0]").count() > 0.8 * classes.count()


def test_inference_drops_null_rows_before_rolling(spark):
    params = {
        "clean": {"target": "position"},
        "featurize": {"features": ["command"], "add_rolling_features": True, "rolling_window_size": 3},
        "sequentialize": {"window_size": 4},
        "train": {"learning_method": "dt", "early_stopping": False},
    }
    df = milling(spark)
    made, _ = plans.create_sensor(df, params, ["s"], ["t"], by_series=False)
    assert made.base == ["command"] and len(made.inputs) == 5
    gaps = df.withColumn("command", F.when(F.col("t") % 10 != 3, F.col("command")))
    assert plans.infer(made, gaps, ["s"], ["t"]).count() == 10 * (54 // 4)


def test_several_series_are_split_by_series(spark):
    params = {
        "clean": {"target": "position"},
        "featurize": {"features": ["command"]},
        "split": {"train_split": 0.6, "calibrate_split": 0.2},
        "sequentialize": {"window_size": 2},
        "train": {"learning_method": "linear", "early_stopping": False},
    }
    df = milling(spark)
    several = plans.prepare(df, registry.merge_params(params), ["s"], ["t"]).samples
    assert several.select("s", "part").distinct().groupBy("s").count().where("count > 1").count() == 0
    one = plans.prepare(df.where("s = '01'"), registry.merge_params(params), ["s"], ["t"]).samples
    assert one.select("part").distinct().count() == 3


def test_patience():
    assert models.patient_rounds([5, 4, 3, 3, 3, 3], 2, 2) == 5
    assert models.patient_rounds([1, 9, 8, 7, 6], 1, 2) == 5
    assert models.patient_rounds([1, 2, 2, 2], 0, 2) == 3
    assert models.patient_rounds([3, 3, 3, 3], 0, None) == 4
