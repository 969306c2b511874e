"""Queries of metrics, conformal intervals and positional joins, on a stand-in prediction."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeloom.operators import evaluate, ordered, windows as win
from gaugeloom.plans.queries.catalog import (
    EVENT_GUESS,
    EVENT_ORDER,
    EVENT_ROWS,
    EVENT_SERIES,
    event_guess,
    events,
    query,
    r6,
    rounded,
)


@query(
    "A9_A10_regression_metrics",
    f"""SELECT part, round(avg((value - p) * (value - p)), 4) AS mse,
  round(1 - sum((value - p) * (value - p)) / (var_pop(value) * count(*)), 6) AS r2, count(*) AS n FROM {EVENT_GUESS} GROUP BY part""",
)
def regression_metrics(spark, folder):
    df = evaluate.regression_metrics(event_guess(spark, folder), "value", "p", ["part"])
    return rounded(rounded(df, "mse", places=4), "r2")


@query(
    "A9_A10_vector_metrics",
    f"""SELECT round(avg(mse), 4) AS mse, round(avg(r2), 6) AS r2 FROM (
SELECT avg((value - p) * (value - p)) AS mse, 1 - sum((value - p) * (value - p)) / (var_pop(value) * count(*)) AS r2 FROM {EVENT_GUESS}
UNION ALL SELECT avg((k - p) * (k - p)), 1 - sum((k - p) * (k - p)) / (var_pop(k) * count(*)) FROM {EVENT_GUESS})""",
)
def vector_metrics(spark, folder):
    df = event_guess(spark, folder).select(F.array("value", "k").alias("y"), F.array("p", "p").alias("p"))
    return rounded(rounded(evaluate.vector_metrics(df), "mse", places=4), "r2")


@query(
    "A11_accuracy",
    f"""SELECT part, round(avg(CAST((value > 25) = (p > 25) AS INT)), 6) AS accuracy, count(*) AS n FROM {EVENT_GUESS} GROUP BY part""",
)
def accuracy(spark, folder):
    df = event_guess(spark, folder).select("part", (F.col("value") > 25).alias("y"), (F.col("p") > 25).alias("p"))
    return rounded(evaluate.classification_metrics(df, by=["part"]), "accuracy")


# One made-up epoch per calendar hour: its losses are the errors in and out of train.
HISTORY = f"""(SELECT event_type, CAST(hour(ts) AS BIGINT) AS epoch, avg((value - p) * (value - p)) FILTER (part = 'train') AS loss,
  avg((value - p) * (value - p)) FILTER (part <> 'train') AS val_loss FROM {EVENT_GUESS} GROUP BY ALL)"""


def _history(spark, folder):
    error = (F.col("value") - F.col("p")) * (F.col("value") - F.col("p"))
    train = F.col("part") == "train"
    return event_guess(spark, folder).groupBy("event_type", F.hour("ts").cast("long").alias("epoch")).agg(
        F.avg(F.when(train, error)).alias("loss"), F.avg(F.when(~train, error)).alias("val_loss")
    )


@query(
    "A14_best_epoch",
    f"SELECT event_type, arg_min(epoch, val_loss) AS epoch, round(min(val_loss), 4) AS val_loss FROM {HISTORY} GROUP BY event_type",
)
def best_epoch(spark, folder):
    return rounded(evaluate.best_epoch(_history(spark, folder), ["event_type"]), "val_loss", places=4)


@query(
    "A14_concat_history",
    f"""SELECT epoch, round(loss, 4) AS loss FROM {HISTORY} WHERE event_type = 'click'
UNION ALL SELECT epoch + (SELECT max(epoch) + 1 FROM {HISTORY} WHERE event_type = 'click'), round(loss, 4) FROM {HISTORY} WHERE event_type = 'view'""",
)
def concat_history(spark, folder):
    history = _history(spark, folder)
    first, second = (history.where(F.col("event_type") == t) for t in ("click", "view"))
    return rounded(evaluate.concat_history(first, second).select("epoch", "loss"), "loss", places=4)


def _border_sql(alpha):
    return f"""(SELECT e AS border FROM (SELECT abs(value - p) AS e, row_number() OVER (ORDER BY abs(value - p) DESC) AS k, count(*) OVER () AS n
  FROM {EVENT_GUESS} WHERE part = 'calibrate') WHERE k = least(greatest(floor({alpha}::DOUBLE * (n + 1)), 1), n))"""


def _intervals(spark, folder, alpha):
    df = event_guess(spark, folder)
    test = evaluate.conformal(df.where("part = 'calibrate'"), df.where("part = 'test'"), alpha, "value", "p")
    return evaluate.predictions(test, "value", ["event_id"])


@query(
    "V2_conformal",
    f"""SELECT event_id, round(p - border, 4) + 0.0 AS lower_bound, round(p + border, 4) + 0.0 AS upper_bound
FROM {EVENT_GUESS}, {_border_sql(0.05)} WHERE part = 'test'""",
)
def conformal(spark, folder):
    df = _intervals(spark, folder, 0.05).select("event_id", "lower_bound", "upper_bound")
    return rounded(df, "lower_bound", "upper_bound", places=4)


@query(
    "V2_conformal_border",
    " UNION ALL ".join(f"SELECT {a}::DOUBLE AS alpha, round(border, 6) AS border FROM {_border_sql(a)}" for a in (0.01, 0.05, 0.3)),
)
def conformal_border(spark, folder):
    cal = event_guess(spark, folder).where("part = 'calibrate'")
    rows = [(a, evaluate.conformal_border(cal, a, "value", "p")) for a in (0.01, 0.05, 0.3)]
    return rounded(spark.createDataFrame(rows, "alpha double, border double"), "border")


@query("V3_midpoint", f"SELECT event_id, round(p, 4) + 0.0 AS predicted FROM {EVENT_GUESS} WHERE part = 'test'")
def midpoint(spark, folder):
    return rounded(_intervals(spark, folder, 0.1).select("event_id", "predicted"), "predicted", places=4)


@query(
    "V4_predictions",
    f"""SELECT event_id, round(value, 4) AS ground_truth, round(p, 4) + 0.0 AS predicted, round(p - border, 4) + 0.0 AS lower_bound,
  round(p + border, 4) + 0.0 AS upper_bound FROM {EVENT_GUESS}, {_border_sql(0.2)} WHERE part = 'test'""",
)
def predictions(spark, folder):
    df = _intervals(spark, folder, 0.2)
    return rounded(df, "ground_truth", "predicted", "lower_bound", "upper_bound", places=4)


@query(
    "V5_interval_quality",
    f"""SELECT round(avg(CAST(value BETWEEN p - border AND p + border AS INT)), 6) AS coverage, round(avg(2 * border), 4) AS mean_width
FROM {EVENT_GUESS}, {_border_sql(0.2)} WHERE part = 'test'""",
)
def interval_quality(spark, folder):
    df = evaluate.interval_quality(_intervals(spark, folder, 0.2))
    return rounded(rounded(df, "coverage"), "mean_width", places=4)


def _scored_windows(spark, folder):
    made = win.windows(events(spark, folder), ["k", "value"], "value", 3, 2, EVENT_SERIES, EVENT_ORDER)
    return made.withColumn("predicted", F.transform("y", lambda v: v * 2))


VIEW_SQL = f"""SELECT user_id, idx, value AS truth, value * 2 AS prediction, k, value FROM {EVENT_ROWS} WHERE idx >= 2"""


@query("V6_prediction_series", VIEW_SQL)
def prediction_series(spark, folder):
    return evaluate.prediction_series(_scored_windows(spark, folder), ["k", "value"])


@query("V7_last_inputs", f"SELECT user_id, idx, k, value FROM {EVENT_ROWS} WHERE idx >= 2")
def last_inputs(spark, folder):
    flat = win.flatten_windows(_scored_windows(spark, folder)).drop("y", "predicted")
    return evaluate.last_inputs(flat, ["k", "value"])


@query("J1_join_target_inputs", f"SELECT user_id, idx, value, k FROM {EVENT_ROWS}")
def join_target_inputs(spark, folder):
    rows = ordered.positions(events(spark, folder), EVENT_SERIES, EVENT_ORDER)
    return evaluate.join_by_position(
        rows.select("user_id", "idx", "value"), rows.select("user_id", "idx", "k"), EVENT_SERIES
    )


@query(
    "J2_join_truth_prediction",
    f"SELECT user_id, idx, value, round(p, 4) AS p FROM {EVENT_GUESS}",
)
def join_truth_prediction(spark, folder):
    truth = ordered.positions(events(spark, folder), EVENT_SERIES, EVENT_ORDER).select("user_id", "idx", "value")
    guess = event_guess(spark, folder).select("user_id", "idx", r6("p", 4).alias("p"))
    return evaluate.join_by_position(truth, guess, EVENT_SERIES)


@query(
    "J7_I3_overlay",
    f"""SELECT t.user_id, t.idx // 4 AS step, t.value, g.k AS predicted FROM {EVENT_ROWS} t JOIN {EVENT_ROWS} g
ON t.user_id = g.user_id AND t.idx // 4 = (g.idx - 3) // 4 AND (g.idx - 3) % 4 = 0 AND g.idx >= 3 WHERE t.idx % 4 = 0""",
)
def overlay(spark, folder):
    """Windows of four rows end to end; the stand-in prediction is the window's last input."""
    df = events(spark, folder)
    predicted = win.x_windows(df, ["k"], 4, 0, EVENT_SERIES, EVENT_ORDER)
    predicted = predicted.select("user_id", "idx", F.col("X")[3][0].alias("predicted"))
    truth = df.select("user_id", "ts", "event_id", "value")
    shown = evaluate.overlay(truth, predicted, 4, EVENT_SERIES, EVENT_ORDER)
    return shown.select("user_id", "step", "value", "predicted")
