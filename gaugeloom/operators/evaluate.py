"""Metrics, conformal intervals and tables behind the evaluation views."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.functions.columns import midpoint as middle
from gaugeloom.operators.ordered import MAX_SERIES_ROWS, every_kth, null_safe_join, order_statistics, running_total
from gaugeloom.session import staged


def _scores(y: Column, p: Column) -> list[Column]:
    n = F.count(F.lit(1)).cast("double")
    residual = F.sum((y - p) * (y - p))
    total = F.var_pop(y) * n
    r2 = F.when(total == 0, F.when(residual == 0, 1.0).otherwise(0.0)).otherwise(
        1 - residual / F.nullif(total, F.lit(0.0))
    )
    return [(residual / n).alias("mse"), r2.alias("r2"), F.count(F.lit(1)).alias("n")]


def regression_metrics(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Mean squared error and R², per group of ``by``. A constant truth scores 1 if met, else 0."""
    return df.groupBy(*by).agg(*_scores(F.col(y).cast("double"), F.col(p).cast("double")))


def vector_metrics(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """The same for array outputs: per position, then averaged over positions."""
    pairs = df.select(F.posexplode(F.arrays_zip(F.col(y).alias("y"), F.col(p).alias("p"))).alias("pos", "s"))
    per_output = pairs.groupBy("pos").agg(*_scores(F.col("s.y"), F.col("s.p")))
    return per_output.agg(F.avg("mse").alias("mse"), F.avg("r2").alias("r2"))


def classification_metrics(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose predicted class is the true one."""
    return df.groupBy(*by).agg(
        F.avg(F.col(y).eqNullSafe(F.col(p)).cast("int")).alias("accuracy"), F.count(F.lit(1)).alias("n")
    )


def conformal_border(
    calibration: DataFrame, alpha: float = 0.05, y: str = "y", p: str = "p", error: Column | None = None
) -> float:
    """The k-th largest calibration error, ``k = floor(alpha * (n + 1))`` kept within 1..n.

    The errors are written once, so that a model behind them scores the calibration part once.
    """
    residual = F.abs(F.col(y) - F.col(p)) if error is None else error
    residuals = staged(calibration.select(residual.cast("double").alias("e")), "residuals")
    n = residuals.agg(F.count("e")).first()[0]
    if not n:
        raise ValueError("no calibration rows")
    k = min(max(math.floor(alpha * (n + 1)), 1), n)
    return order_statistics(residuals, {"e": [n - k]}, {"e": n})["e", n - k]


def conformal(
    calibration: DataFrame,
    test: DataFrame,
    alpha: float = 0.05,
    y: str = "y",
    p: str = "p",
    error: Column | None = None,
) -> DataFrame:
    """Add ``lower_bound`` and ``upper_bound``: the prediction plus and minus the border."""
    border = F.lit(conformal_border(calibration, alpha, y, p, error))
    return test.withColumns({"lower_bound": F.col(p) - border, "upper_bound": F.col(p) + border})


def midpoint(df: DataFrame, out: str = "predicted") -> DataFrame:
    """Point prediction: the middle of the interval."""
    return df.withColumn(out, middle(F.col("lower_bound"), F.col("upper_bound")))


def predictions(df: DataFrame, y: str = "y", keep: Sequence[str] = ()) -> DataFrame:
    """Truth, interval middle and bounds."""
    return midpoint(df).select(
        *keep, F.col(y).cast("double").alias("ground_truth"), "predicted", "lower_bound", "upper_bound"
    )


def interval_quality(df: DataFrame) -> DataFrame:
    """Share of truths inside their interval, and mean interval width."""
    inside = F.col("ground_truth").between(F.col("lower_bound"), F.col("upper_bound"))
    return df.agg(
        F.avg(inside.cast("int")).alias("coverage"),
        F.avg(F.col("upper_bound") - F.col("lower_bound")).alias("mean_width"),
    )


def join_by_position(a: DataFrame, b: DataFrame, series: Sequence[str], idx: str = "idx") -> DataFrame:
    """Put two frames side by side by series and position; the position keeps the keys balanced."""
    return null_safe_join(a, b, [*series, idx])


def prediction_series(df: DataFrame, inputs: Sequence[str], y: str = "y", p: str = "predicted") -> DataFrame:
    """Last true and predicted value of each window with the last time step of every input."""
    last = F.element_at("X", -1)
    cells = [last[i].alias(c) for i, c in enumerate(inputs)]
    kept = [c for c in df.columns if c not in ("X", y, p)]
    return df.select(*kept, F.element_at(y, -1).alias("truth"), F.element_at(p, -1).alias("prediction"), *cells)


def last_inputs(df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Last time step of a flattened window: its last ``len(inputs)`` values."""
    n = len(inputs)
    kept = [c for c in df.columns if c != "X"]
    return df.select(*kept, *[F.element_at("X", i - n).alias(c) for i, c in enumerate(inputs)])


def overlay(
    truth: DataFrame,
    predicted: DataFrame,
    k: int,
    series: Sequence[str],
    order: Sequence[str],
    max_rows: int = MAX_SERIES_ROWS,
) -> DataFrame:
    """Every k-th true row beside the prediction of the same rank, per series.

    ``predicted`` is ordered by its own ``idx``; rows without a partner are left out.
    """
    thin = every_kth(truth, k, series, order, max_rows)
    thin = thin.withColumnRenamed("idx", "step").drop("n_rows")
    ranked = running_total(predicted, series, ["idx"], out="step", total="_size", max_rows=max_rows)
    return null_safe_join(thin, ranked.drop("idx", "_size"), [*series, "step"])


def concat_history(first: DataFrame, second: DataFrame) -> DataFrame:
    """Training history of two fits in a row; the epochs of the second go on after the first."""
    last = first.agg(F.max("epoch")).first()[0]
    offset = 0 if last is None else last + 1
    return first.unionByName(second.withColumn("epoch", F.col("epoch") + offset))


def best_epoch(history: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Epoch of the lowest validation loss; the earliest on ties."""
    first = F.min_by("epoch", F.struct("val_loss", "epoch"))
    return history.groupBy(*by).agg(first.alias("epoch"), F.min("val_loss").alias("val_loss"))
