"""Correlation tables over columns, never over pairs of rows."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.operators.ordered import MAX_SERIES_ROWS
from gaugeloom.operators.ranks import cramers_pairs, kendall_pairs, spearman_pairs

# Below this share of the raw second moment a variance is rounding error of the sums.
ROUNDING = 1e-12


def _moments(columns, shift):
    """Per task: for each pair of columns the sums over rows where both are finite."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, len(columns), len(columns)))
        for batch in batches:
            x = np.column_stack([np.asarray(c.to_numpy(zero_copy_only=False), dtype=float) for c in batch.columns])
            there = np.isfinite(x)
            x = np.where(there, x - shift, 0.0)
            both = there.astype(float)
            sums += [both.T @ both, x.T @ both, both.T @ x, (x * x).T @ both, both.T @ (x * x), x.T @ x]
        i, j = np.triu_indices(len(columns), 1)
        arrays = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(s[i, j]) for s in sums]]
        yield pa.RecordBatch.from_arrays(arrays, ["i", "j", "n", "x", "y", "xx", "yy", "xy"])

    return run


def pearson(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlations ``a, b, r``, each pair once; null where a column is constant.

    Each task reduces its rows to one row of sums per pair, by matrix products on Arrow batches, so
    one scan serves any number of columns and only columns² rows per task are shuffled. Values are
    taken relative to the column mean to keep the sums accurate.
    """
    view = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    finite = [F.when(F.abs(F.col(c)) < math.inf, F.col(c)) for c in cols]
    means = view.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(finite)]).first()
    shift = np.array([m or 0.0 for m in means])
    schema = "i int, j int, n double, x double, y double, xx double, yy double, xy double"
    parts = view.mapInArrow(_moments(list(cols), shift), schema)
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    names = F.array(*map(F.lit, cols))
    floors = F.array(*[F.lit(float((1e-14 * m) ** 2)) for m in shift])

    def variance(total, squares, i):
        raw = F.col(squares) / F.col("n")
        spread = raw - (F.col(total) / F.col("n")) * (F.col(total) / F.col("n"))
        real = (spread > raw * ROUNDING) & (raw > F.get(floors, F.col(i)))
        return F.when(real, spread)

    sums = sums.withColumn("n", F.nullif(F.col("n"), F.lit(0.0)))
    sums = sums.withColumns({"vx": variance("x", "xx", "i"), "vy": variance("y", "yy", "j")})
    covariance = F.col("xy") / F.col("n") - (F.col("x") / F.col("n")) * (F.col("y") / F.col("n"))
    r = covariance / F.sqrt(F.col("vx") * F.col("vy"))
    return sums.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), r.alias("r"))


def _mirrored(pairs: DataFrame) -> DataFrame:
    """Both directions of each pair."""
    there = F.struct(F.col("a").alias("variable"), F.col("b").alias("other"), F.col("r"))
    back = F.struct(F.col("b").alias("variable"), F.col("a").alias("other"), F.col("r"))
    return pairs.select(F.explode(F.array(there, back)).alias("s")).select("s.*")


def correlations(
    df: DataFrame, cols: Sequence[str], method: str = "pearson", max_rows: int = MAX_SERIES_ROWS
) -> DataFrame:
    """Table ``variable, other, r`` over all ordered pairs of different columns, in a fixed number of jobs."""
    pairs = list(combinations(cols, 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], "variable string, other string, r double")
    if method == "pearson":
        return _mirrored(pearson(df, cols))
    measures = {"spearman": spearman_pairs, "kendall": kendall_pairs, "cramers": cramers_pairs}
    if method not in measures:
        raise ValueError(f"unknown correlation {method}")
    found = measures[method](df, pairs) if method == "cramers" else measures[method](df, pairs, max_rows)
    rows = [(a, b, r) for (a, b), r in zip(pairs, found)]
    return _mirrored(df.sparkSession.createDataFrame(rows, "a string, b string, r double"))


def spearman(df: DataFrame, a: str, b: str, max_rows: int = MAX_SERIES_ROWS) -> float | None:
    """Correlation of average ranks over rows where both columns have a value."""
    return spearman_pairs(df, [(a, b)], max_rows)[0]


def kendall(df: DataFrame, a: str, b: str, max_rows: int = MAX_SERIES_ROWS) -> float | None:
    """Kendall's tau-b in n log n work, without comparing rows pairwise."""
    return kendall_pairs(df, [(a, b)], max_rows)[0]


def cramers_v(df: DataFrame, a: str, b: str, max_distinct: int = 100) -> float | None:
    """Bias-corrected Cramér's V of two categorical columns; null above ``max_distinct`` values."""
    return cramers_pairs(df, [(a, b)], max_distinct)[0]
