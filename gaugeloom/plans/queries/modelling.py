"""Queries that fit models on windows of the given tables and score the test part.

Models of one input have SQL twins: the fit is a regression line or a mean and variance per class.
The others have none; tests compare the discriminants with a direct computation.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeloom.operators import encode, models, registry, windows as win
from gaugeloom.operators.scale import apply_scaler, fit_scaler
from gaugeloom.operators.split import split_rows, validation_tail
from gaugeloom.plans import sensor
from gaugeloom.plans.queries.catalog import (
    EVENT_ORDER,
    EVENT_SERIES,
    EVENTS,
    LINE_ORDER,
    LINE_SERIES,
    event_parts,
    events,
    lines,
    query,
    rounded,
    table,
)
from gaugeloom.session import new_table_path, staged
from gaugeloom.sources.tables import write_metrics


def _value_windows(spark, folder):
    """Price from quantity, discount and tax of the last four rows of a supplier."""
    rows = split_rows(lines(spark, folder), 0.6, 0.2, LINE_SERIES, LINE_ORDER)
    scaled = apply_scaler(rows, fit_scaler(rows, ["quantity", "discount", "tax", "price"], "minmax"))
    return win.windows(scaled, ["quantity", "discount", "tax"], "price", 4, 1, LINE_SERIES, LINE_ORDER)


def _class_windows(spark, folder):
    """Line status from price, quantity and age of the last three rows of a supplier."""
    df = lines(spark, folder).withColumns(
        {
            "status": (F.col("l_linestatus") == "O").cast("int"),
            "age": F.datediff(F.lit("2002-01-01").cast("date"), F.col("l_shipdate").cast("date")),
        }
    )
    rows = split_rows(df, 0.6, 0.0, LINE_SERIES, LINE_ORDER)
    scaled = apply_scaler(rows, fit_scaler(rows, ["quantity", "price", "age"], "standard"))
    return win.windows(scaled, ["quantity", "price", "age"], "status", 3, 1, LINE_SERIES, LINE_ORDER)


def _test_scores(model, samples):
    test = samples.where(F.col("part") == "test")
    scored = models.predict(model, test)
    return rounded(scored.select("l_suppkey", "idx", F.col("y")[0].alias("truth"), "predicted"), "predicted", "truth")


def _fit(method, classification, **params):
    def run(spark, folder):
        samples = (_class_windows if classification else _value_windows)(spark, folder)
        return _test_scores(models.train(samples, method, classification, **params), samples)

    return run


query("M2_decision_tree")(_fit("dt", False))
query("M2_decision_tree_classes")(_fit("dt", True))
query("M3_random_forest")(_fit("rf", False, numTrees=10))
query("M3_random_forest_classes")(_fit("rf", True, numTrees=10))
query("M4_boosting")(_fit("xgboost", False, n_epochs=10))
query("M4_boosting_classes")(_fit("xgboost", True, n_epochs=5))
query("M5_support_vector")(_fit("svm", True, n_epochs=10))
query("M5_support_vector_values")(_fit("svm", False, n_epochs=15))
query("M6_dense_network")(_fit("dnn", True, n_epochs=20))
query("M6_dense_network_values")(_fit("dnn", False, n_epochs=20))
query("M6_linear_stand_in")(_fit("linear", False, n_epochs=10))


def _embedding_samples(spark, folder):
    df = table(spark, folder, "embeddings")
    return df.select(
        "vec_id",
        F.transform("embedding", lambda v: v.cast("double")).alias("X"),
        F.array(F.col("label").cast("double")).alias("y"),
    )


def _discriminant(method):
    def run(spark, folder):
        samples = _embedding_samples(spark, folder)
        model = models.train(samples, method, True)
        return models.predict(model, samples).select("vec_id", F.col("y")[0].alias("truth"), "predicted")

    return run


query("M7_linear_discriminant")(_discriminant("lda"))
query("M8_quadratic_discriminant")(_discriminant("qda"))


def _class_scores(variance):
    """Posterior scores of one input per class, as SQL; the highest wins."""
    return f"""WITH rows AS (SELECT event_id, k AS x, dense_rank() OVER (ORDER BY event_type) - 1.0::DOUBLE AS y FROM {EVENTS}),
c AS (SELECT y, avg(x) AS m, count(*) AS n, var_samp(x) AS v FROM rows GROUP BY y),
d AS (SELECT y, m, {variance} AS v, ln(n / sum(n) OVER ()) AS prior FROM c)
SELECT event_id, max(rows.y) AS truth, arg_max(d.y, prior - 0.5 * ((x - m) * (x - m) / v + ln(v))) AS predicted
FROM rows, d GROUP BY event_id"""


def _one_input_discriminant(method):
    def run(spark, folder):
        df = encode.label_encode(events(spark, folder), "event_type")
        code = F.col("event_type").cast("double")
        samples = df.select("event_id", F.array("k").alias("X"), F.array(code).alias("y"))
        model = models.train(samples, method, True)
        return models.predict(model, samples).select("event_id", F.col("y")[0].alias("truth"), "predicted")

    return run


POOLED = "sum((n - 1) * v) OVER () / (sum(n) OVER () - count(*) OVER ())"
query("M7_linear_discriminant_one_input", _class_scores(POOLED))(_one_input_discriminant("lda"))
query("M8_quadratic_discriminant_one_input", _class_scores("v"))(_one_input_discriminant("qda"))


@query("M10_early_stopping")
def early_stopping(spark, folder):
    samples = _value_windows(spark, folder)
    train = staged(samples.where(F.col("part") == "train"), "train_part")
    train = validation_tail(train, 0.25, LINE_SERIES, ["idx"])
    model = models.train(samples, "xgboost", n_epochs=10, early_stopping=True, series=LINE_SERIES)
    return rounded(models.boosting_history(model, train), "loss", "val_loss")


@query("M10_early_stopping_network")
def network_early_stopping(spark, folder):
    """Losses of a network of values until the held-out loss has not improved for three epochs."""
    samples = _value_windows(spark, folder)
    model = models.train(samples, "dnn", n_epochs=25, early_stopping=True, patience=3, series=LINE_SERIES)
    return rounded(models.training_history(spark, model), "loss", "val_loss")


@query("M4_M10_boosting_of_event_types")
def boosting_of_event_types(spark, folder):
    """Losses of boosting the event type from value and k of a user's last two events, one tree a class and round."""
    df = encode.label_encode(events(spark, folder), "event_type")
    samples = win.windows(split_rows(df, 0.8, 0.0, EVENT_SERIES, EVENT_ORDER), ["value", "k"], "event_type", 2, 1, EVENT_SERIES, EVENT_ORDER)
    model = models.train(samples, "xgboost", True, n_epochs=1, early_stopping=True, patience=1, series=EVENT_SERIES, depth=3)
    return rounded(models.training_history(spark, model), "loss", "val_loss")


SENSOR_PARAMS = {
    "profile": {"dataset": "lineitem"},
    "clean": {"target": "price"},
    "featurize": {"features": ["quantity", "discount", "tax", "fixed"]},
    "split": {"train_split": 0.6, "calibrate_split": 0.2},
    "scale": {"input": "standard", "output": "minmax"},
    "sequentialize": {"window_size": 4},
    "train": {"learning_method": "dt", "early_stopping": False},
}


def _line_rows(spark, folder):
    kept = [*LINE_SERIES, *LINE_ORDER, "quantity", "discount", "tax", "fixed", "price"]
    return lines(spark, folder).select(*kept)


@query("V1_M1_create_and_evaluate")
def create_and_evaluate(spark, folder):
    _, scores = sensor.create_sensor(_line_rows(spark, folder), SENSOR_PARAMS, LINE_SERIES, LINE_ORDER, by_series=False)
    return scores


@query("I1_infer")
def infer(spark, folder):
    """Fit, save, register, look up, load and score."""
    df = _line_rows(spark, folder)
    params = registry.merge_params(SENSOR_PARAMS)
    made, _ = sensor.create_sensor(df, params, LINE_SERIES, LINE_ORDER, by_series=False)
    assets = sensor.save_sensor(spark, made)
    path = new_table_path(spark, "registry")
    registry.register(registry.registry_row(spark, made.params, made.metrics, assets, 1), path)
    row = registry.require_assets(registry.get_sensor(registry.list_sensors(spark, path), 1)).first()
    return sensor.infer(sensor.load_sensor(spark, row), df.drop("price"), LINE_SERIES, LINE_ORDER)


# A regression line on one scaled input, cut into windows of one row.
LINE_PARAMS = {
    "profile": {"dataset": "events"},
    "clean": {"target": "value"},
    "featurize": {"features": ["k"]},
    "split": {"train_split": 0.5, "calibrate_split": 0.2},
    "scale": {"input": "standard", "output": "minmax"},
    "sequentialize": {"window_size": 1},
    "train": {"learning_method": "linear", "early_stopping": False},
}
LINE_FIT = f"""WITH p AS (SELECT * FROM {event_parts(0.5, 0.2)}),
s AS (SELECT avg(k) AS mk, stddev_pop(k) AS sk, min(value) AS lo, max(value) - min(value) AS w FROM p WHERE part = 'train'),
z AS (SELECT user_id, part, idx, (k - mk) / sk AS x, (value - lo) / w AS y FROM p, s),
m AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM z WHERE part = 'train'),
g AS (SELECT z.*, a * x + b AS guess FROM z, m),
e AS (SELECT abs(y - guess) AS e, row_number() OVER (ORDER BY abs(y - guess) DESC) AS r, count(*) OVER () AS n FROM g
  WHERE part = 'calibrate'),
t AS (SELECT e AS border FROM e WHERE r = least(greatest(floor(0.05::DOUBLE * (n + 1)), 1), n))"""


def _line_sensor(spark, folder):
    df = events(spark, folder).select("user_id", "ts", "event_id", "value", "k")
    return df, *sensor.create_sensor(df, LINE_PARAMS, EVENT_SERIES, EVENT_ORDER, by_series=False)


@query(
    "V1_M1_linear_sensor",
    LINE_FIT
    + """ SELECT user_id, part, idx, round(y, 6) AS ground_truth, round(guess, 6) + 0.0 AS predicted,
  round(guess - border, 6) + 0.0 AS lower_bound, round(guess + border, 6) + 0.0 AS upper_bound FROM g, t WHERE part = 'test'""",
)
def linear_sensor(spark, folder):
    """Clean, split, scale, cut, fit, calibrate and score."""
    _, _, scores = _line_sensor(spark, folder)
    return rounded(scores, "ground_truth", "predicted", "lower_bound", "upper_bound")


@query(
    "V1_S11_linear_sensor_metrics",
    LINE_FIT
    + """ SELECT round(avg((y - guess) * (y - guess)), 6) AS mse,
  round(1 - sum((y - guess) * (y - guess)) / (var_pop(y) * count(*)), 6) + 0.0 AS r2 FROM g WHERE part = 'test'""",
)
def linear_sensor_metrics(spark, folder):
    _, made, _ = _line_sensor(spark, folder)
    path = new_table_path(spark, "metrics")
    write_metrics(spark.createDataFrame([(made.metrics["mse"], made.metrics["r2"])], "mse double, r2 double"), path)
    return rounded(spark.read.schema("mse double, r2 double").json(path), "mse", "r2")


@query(
    "I1_linear_inference",
    LINE_FIT + " SELECT user_id, idx, round(guess * w + lo, 4) + 0.0 AS predicted FROM g, s",
)
def linear_inference(spark, folder):
    """All rows scored without their target, in original units."""
    df, made, _ = _line_sensor(spark, folder)
    found = sensor.infer(made, df.drop("value"), EVENT_SERIES, EVENT_ORDER)
    return rounded(found.select("user_id", "idx", "predicted"), "predicted", places=4)


@query("E2_E6_onehot_sensor")
def onehot_sensor(spark, folder):
    """Event type, one-hot encoded, from value and k."""
    params = {
        "profile": {"dataset": "events"},
        "clean": {"target": "event_type", "classification": True, "onehot_encode_target": True},
        "split": {"train_split": 0.6},
        "sequentialize": {"window_size": 3},
        "train": {"learning_method": "rf", "early_stopping": False},
    }
    df = events(spark, folder).select("user_id", "ts", "event_id", "event_type", "value", "k")
    _, scores = sensor.create_sensor(df, params, EVENT_SERIES, EVENT_ORDER, by_series=False)
    return scores
