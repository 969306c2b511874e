"""Rolling, prefix and segment features, and feature selection by correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.operators.correlation import correlations
from gaugeloom.operators.ordered import BLOCK_ROWS, MAX_SERIES_ROWS, null_safe_join, over_rows_back, positions

# Fixed value: how near the median counts as close, as a share of the value range.
CLOSE_SHARE = 0.1


def target_correlations(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Correlation of each input with the target: variable, r. One scan."""
    cols = [c for c in (cols or df.columns) if c != target]
    return correlations(df, [target, *cols]).where(F.col("other") == target).select("variable", "r")


def select_by_target_corr(
    df: DataFrame, target: str, min_corr: float = 0.0, cols: Sequence[str] | None = None
) -> DataFrame:
    """Keep inputs whose absolute correlation with the target reaches ``min_corr``; 0.0 keeps all."""
    if min_corr <= 0.0:
        return df
    found = {r.variable: r.r for r in target_correlations(df, target, cols).collect()}
    return df.drop(*[c for c, r in found.items() if r is None or abs(r) < min_corr])


def add_rolling_features(
    df: DataFrame,
    cols: Sequence[str],
    rolling_window_size: int,
    series: Sequence[str],
    order: Sequence[str],
    max_rows: int = MAX_SERIES_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Mean, minimum, maximum and population std of the last rows, the current one among them.

    The first rows of a series use the rows there are.
    """
    back = rolling_window_size - 1
    made = {}
    for c in cols:
        for name, stat in (("mean", F.avg), ("min", F.min), ("max", F.max), ("std", F.stddev_pop)):
            made[f"{c}_{name}"] = lambda w, c=c, stat=stat: stat(c).over(w.rowsBetween(-back, 0))
    return over_rows_back(positions(df, series, order, max_rows), series, back, made, block_rows=block_rows)


def add_features(df: DataFrame, features: dict) -> DataFrame:
    """Hook for engineered features: new columns from expressions."""
    return df.withColumns(features) if features else df


def segment(
    df: DataFrame, size: int, series: Sequence[str], order: Sequence[str], max_rows: int = MAX_SERIES_ROWS
) -> DataFrame:
    """Add ``segment``: 1.. for each full run of ``size`` rows; the incomplete tail is cut off."""
    rows = positions(df, series, order, max_rows)
    number = F.expr(f"idx div {size}") + 1
    return rows.withColumn("segment", number).where(F.col("segment") <= F.expr(f"n_rows div {size}"))


def segment_target(segments: DataFrame, target: str, series: Sequence[str]) -> DataFrame:
    """Last target value of each segment."""
    return segments.groupBy(*series, "segment").agg(F.max_by(target, "idx").alias("target"))


def segment_stats(
    segments: DataFrame, col: str, series: Sequence[str], time: str | None = None
) -> DataFrame:
    """Shape statistics per segment. A segment has a fixed number of rows, so it fits one task.

    Slopes are per unit of ``time``, a numeric column, or per row without it.
    """
    whole = Window.partitionBy(*series, "segment")
    ordered = whole.orderBy("idx")
    x, t = F.col("_x"), F.col(time or "idx").cast("double")
    rows = segments.select(*series, "segment", "idx", F.col(col).cast("double").alias("_x"), t.alias("_t"))
    rows = rows.withColumns(
        {
            "_mean": F.avg(x).over(whole),
            "_std": F.stddev_pop(x).over(whole),
            "_median": F.percentile(x, 0.5).over(whole),
            "_range": F.max(x).over(whole) - F.min(x).over(whole),
            "_rise": x - F.lag(x).over(ordered),
            "_run": F.col("_t") - F.lag("_t").over(ordered),
        }
    )
    away = F.abs(x - F.col("_median"))
    return rows.groupBy(*series, "segment").agg(
        ((F.max(x) - F.min(x)) / 2).alias("amplitude"),
        F.avg((F.abs(x - F.col("_mean")) > F.col("_std")).cast("int")).alias("percent_beyond_1_std"),
        F.max(x).alias("maximum"),
        F.max(F.abs(F.col("_rise") / F.nullif(F.col("_run"), F.lit(0.0)))).alias("max_slope"),
        F.max("_median").alias("median"),
        F.percentile(away, 0.5).alias("median_absolute_deviation"),
        F.avg((away < F.col("_range") * CLOSE_SHARE).cast("int")).alias("percent_close_to_median"),
        F.min(x).alias("minimum"),
        F.skewness(x).alias("skew"),
        F.stddev_pop(x).alias("std"),
        F.avg(x).alias("weighted_average"),
    )


def relevant_features(
    features: DataFrame, targets: DataFrame, series: Sequence[str], min_corr: float = 0.0
) -> DataFrame:
    """Correlation of each segment feature with the segment's target, where it reaches ``min_corr``."""
    keys = [*series, "segment"]
    joined = null_safe_join(features, targets, keys)
    names = [c for c in features.columns if c not in keys]
    found = target_correlations(joined, "target", names)
    return found.where(F.abs(F.col("r")) >= min_corr)


def prefix_windows(
    df: DataFrame,
    col: str,
    series: Sequence[str],
    order: Sequence[str],
    window_rows: int | None = None,
    max_rows: int = MAX_SERIES_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Count, sum, mean, minimum and maximum over the rows of the series up to each row.

    ``window_rows`` limits the window to that many last rows. Without it the blocks before a row
    enter as one row of totals, so that a long series is spread over its blocks.
    """
    rows = positions(df, series, order, max_rows)
    if window_rows is not None:
        back = window_rows - 1
        stats = {
            "rows": lambda c: F.count(F.lit(1)),
            "_values": F.count,
            "sum": F.sum,
            "minimum": F.min,
            "maximum": F.max,
        }
        made = {
            name: lambda w, stat=stat: stat(col).over(w.rowsBetween(-back, 0)) for name, stat in stats.items()
        }
        return _with_mean(over_rows_back(rows, series, back, made, block_rows=block_rows))
    rows = rows.withColumn("_block", F.expr(f"idx div {block_rows}"))
    earlier = Window.partitionBy(*series).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*series, "_block").agg(
        F.sum(col).alias("_sum"), F.count(col).alias("_count"), F.min(col).alias("_min"), F.max(col).alias("_max")
    )
    totals = totals.withColumns(
        {
            "_sum": F.sum("_sum").over(earlier),
            "_count": F.sum("_count").over(earlier),
            "_min": F.min("_min").over(earlier),
            "_max": F.max("_max").over(earlier),
        }
    )
    upto = Window.partitionBy(*series, "_block").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    own, none = F.sum(col).over(upto), F.lit(0).cast(rows.schema[col].dataType)
    total = F.coalesce(F.col("_sum"), none) + F.coalesce(own, none)
    joined = null_safe_join(rows, totals, [*series, "_block"]).withColumns(
        {
            "rows": F.col("idx") + 1,
            "_values": F.coalesce(F.col("_count"), F.lit(0)) + F.count(col).over(upto),
            "sum": F.when(F.col("_sum").isNotNull() | own.isNotNull(), total),
            "minimum": F.least(F.col("_min"), F.min(col).over(upto)),
            "maximum": F.greatest(F.col("_max"), F.max(col).over(upto)),
        }
    )
    return _with_mean(joined.drop("_block", "_sum", "_count", "_min", "_max"))


def _with_mean(df):
    """The mean is of the values that are not null."""
    return df.withColumn("mean", F.col("sum") / F.nullif("_values", F.lit(0))).drop("_values")
