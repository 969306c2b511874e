"""Boosting of values on counts of bins against Spark's."""

import glob

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from gaugeloom import session
from gaugeloom.operators import models, value_boosting


def frame(spark, rows=1500, seed=0):
    draw = np.random.default_rng(seed)
    x = np.column_stack([draw.normal(size=rows), draw.integers(0, 11, rows) / 10, draw.integers(0, 3, rows), np.zeros(rows)])
    y = np.sin(x[:, 0]) + x[:, 1] * x[:, 2] + draw.normal(0, 0.2, rows)
    cells = [(i, [float(v) for v in a], [float(b)]) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(cells, "idx int, X array<double>, y array<double>").repartition(4, "idx")
    return models.to_vectors(df)


@pytest.mark.parametrize("depth,rounds,bins", [(5, 6, 32), (2, 4, 7), (0, 2, 32)])
def test_trees_are_those_of_spark(spark, monkeypatch, depth, rounds, bins):
    monkeypatch.setattr(value_boosting, "BLOCK_ROWS", 100)
    df = frame(spark)
    whole = GBTRegressor(maxIter=rounds, maxDepth=depth, maxBins=bins, seed=1).fit(df)
    model = value_boosting.fit_value_boosting(df, rounds, depth=depth, bins=bins)
    wanted = {r.idx: r.prediction for r in whole.transform(df).select("idx", "prediction").collect()}
    found = {r.idx: r.prediction for r in model.transform(df).select("idx", "prediction").collect()}
    assert found == pytest.approx(wanted, abs=1e-9)
    losses, held = model.losses(df)
    assert losses == pytest.approx(whole.evaluateEachIteration(df, "squared")) and np.isnan(held).all()


def test_train_boosts_values_on_bins_and_stops(spark, tmp_path):
    """Spark's own keeps every sample as an object; here a task holds a few blocks."""
    df = frame(spark).select("idx", "X", "y")
    model = models.train(df, "xgboost", n_epochs=4, early_stopping=True, patience=2)
    assert isinstance(model, value_boosting.ValueBoosting) and 12 <= model.getNumTrees <= 14
    held = models.validation_tail(df, 0.25, [], ["idx"])
    whole = GBTRegressor(maxIter=model.getNumTrees, seed=1).fit(models.to_vectors(held).where("not validation"))
    history = [tuple(r) for r in models.boosting_history(model, held).collect()]
    data = models.to_vectors(held)
    assert [h[1] for h in history] == pytest.approx(whole.evaluateEachIteration(data.where("not validation"), "squared"))
    assert [h[2] for h in history] == pytest.approx(whole.evaluateEachIteration(data.where("validation"), "squared"))
    models.save_model(spark, model, str(tmp_path / "m"))
    assert models.load_model(spark, str(tmp_path / "m"), models.model_kind(model)) == model
    other = models.train(df, "xgboost", n_epochs=2, subsamplingRate=0.5)
    assert type(other).__name__ == "GBTRegressionModel"


def test_only_the_last_blocks_are_kept_while_trees_are_made(spark):
    before = set(glob.glob(f"{session.shared_dir(spark).removeprefix('file:')}/tables/value_boosting-*"))
    value_boosting.fit_value_boosting(frame(spark, 300), 3)
    assert set(glob.glob(f"{session.shared_dir(spark).removeprefix('file:')}/tables/value_boosting-*")) == before
    assert not any("value_boosting-" in p for p in session._TABLES)


def test_missing_numbers_are_refused(spark):
    df = frame(spark, 50)
    for bad in (df.withColumn("label", F.lit(None).cast("double")), df.withColumn("features", array_to_vector(F.array(F.lit(float("nan")))))):
        with pytest.raises(Exception, match="must not be null"):
            value_boosting.fit_value_boosting(bad, 2).getNumTrees
