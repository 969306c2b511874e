"""A profile that is kept and merged: one row of state per piece of the data and variable.

Counts, extremes and central moments are exact, distinct values and quantiles are sketches. A new file adds
its rows to the table of states and nothing else is read; the profile of all is merged from the states, which
are as many as pieces times columns, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.operators.profiling import as_value, numeric_columns

#: Base-2 logarithm of the distinct sketch's registers: 4,096, about 1.6 % of standard error.
REGISTERS = 12
#: Size of the quantile sketch: ranks are off by well below 1 %.
QUANTILE_SIZE = 400
COUNTS = ("n", "n_values", "n_finite", "n_zeros", "n_negative", "n_infinite")


def _long(df: DataFrame, cols: Sequence[str], piece: str | None) -> DataFrame:
    """(piece, variable, value, name): numbers as doubles, and every value as text."""
    numeric = set(numeric_columns(df.select(*[f"`{c}`" for c in cols])))
    parts = []
    for c in cols:
        value = as_value(f"`{c}`") + F.lit(0.0) if c in numeric else F.lit(None).cast("double")
        text = F.when(value.isNotNull(), value.cast("string")) if c in numeric else F.col(f"`{c}`").cast("string")
        parts.append(F.struct(F.lit(c).alias("variable"), value.alias("value"), text.alias("text"), F.lit(c in numeric).alias("number")))
    of = (F.col(f"`{piece}`").cast("string") if piece else F.lit("")).alias("piece")
    return df.select(of, F.explode(F.array(*parts)).alias("e")).select("piece", "e.*")


def states(df: DataFrame, cols: Sequence[str] | None = None, piece: str | None = None) -> DataFrame:
    """The state of each variable in each ``piece`` of the data, a column of ``df``: one aggregate, combined map-side.

    NaN counts as missing. Infinite values are counted, but not part of moments and quantiles.
    """
    cols = [c for c in (cols or df.columns) if c != piece]
    value, finite = F.col("value"), F.col("finite")
    rows = _long(df, cols, piece).withColumn("finite", F.when(F.abs(value) < math.inf, value))
    spread = F.var_pop(finite)
    n = F.count(finite).cast("double")
    return rows.groupBy("piece", "variable", "number").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("text").alias("n_values"),
        F.count(finite).alias("n_finite"),
        F.count_if(value == 0).alias("n_zeros"),
        F.count_if(value < 0).alias("n_negative"),
        F.count_if(F.abs(value) == math.inf).alias("n_infinite"),
        F.min("finite").alias("min"),
        F.max("finite").alias("max"),
        F.avg("finite").alias("mean"),
        (spread * n).alias("m2"),
        F.when(spread > 0, F.skewness("finite") * n * spread * F.sqrt(spread)).when(n > 0, 0.0).alias("m3"),
        F.when(spread > 0, (F.kurtosis("finite") + 3) * n * spread * spread).when(n > 0, 0.0).alias("m4"),
        F.hll_sketch_agg("text", REGISTERS).alias("distinct"),
        F.kll_sketch_agg_double("finite", QUANTILE_SIZE).alias("quantiles"),
    )


def merged(rows: DataFrame) -> DataFrame:
    """One state per variable from those of all pieces; a merged state can be merged again.

    Moments move to the common mean: with d the way of a piece's mean, m2 gains n d², m3 gains 3 d m2 + n d³
    and m4 gains 4 d m3 + 6 d² m2 + n d⁴.
    """
    n = F.col("n_finite")
    whole = rows.groupBy("variable").agg((F.sum(n * F.col("mean")) / F.nullif(F.sum(n), F.lit(0))).alias("_mean"))
    d = F.col("mean") - F.col("_mean")
    moved = rows.join(whole, "variable").groupBy("variable", "number").agg(
        *[F.sum(c).cast("long").alias(c) for c in COUNTS],
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.max("_mean").alias("mean"),
        F.sum(F.col("m2") + n * d * d).alias("m2"),
        F.sum(F.col("m3") + 3 * d * F.col("m2") + n * d * d * d).alias("m3"),
        F.sum(F.col("m4") + 4 * d * F.col("m3") + 6 * d * d * F.col("m2") + n * d * d * d * d).alias("m4"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )
    return moved.select(F.lit("").alias("piece"), "*").select(rows.columns)


def described(state: DataFrame, shares: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """The report's numbers of each variable, from merged states."""
    n, m2 = F.col("n_finite").cast("double"), F.col("m2")
    some = F.col("n_finite") > 0

    def share(c: str) -> Column:
        return F.col(c) / F.nullif("n", F.lit(0))

    variance = F.when(n > 1, m2 / (n - 1))
    skewness = F.sqrt(n) * F.col("m3") / F.pow(F.nullif(m2, F.lit(0.0)), 1.5) * F.sqrt(n * (n - 1)) / (n - 2)
    kurtosis = n * F.col("m4") / F.pow(F.nullif(m2, F.lit(0.0)), 2) - 3
    kurtosis = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * kurtosis + 6)
    estimate = F.hll_sketch_estimate("distinct")
    return state.select(
        "variable",
        "n",
        (F.col("n") - F.col("n_values")).alias("n_missing"),
        (1 - share("n_values")).alias("p_missing"),
        F.when(F.col("n_values") > 0, estimate).otherwise(F.lit(0)).alias("n_distinct"),
        *[F.when(F.col("number"), F.col(c)).alias(c) for c in ("n_zeros", "n_negative", "n_infinite")],
        "min",
        "max",
        "mean",
        F.sqrt(variance).alias("std"),
        variance.alias("variance"),
        F.when(n > 2, skewness).alias("skewness"),
        F.when(n > 3, kurtosis).alias("kurtosis"),
        *[F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))).alias(f"q{round(p * 100):02d}") for p in shares],
    )


def add_pieces(df: DataFrame, path: str, piece: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Append the states of those pieces that the table at ``path`` does not have, and return the whole table.

    The known pieces become a filter on ``df``: with one piece a file or partition, known ones are not read.
    """
    spark: SparkSession = df.sparkSession
    reader = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if reader.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(reader):
        known = [r.piece for r in spark.read.parquet(path).select("piece").distinct().collect()]
        df = df.where(~F.col(f"`{piece}`").cast("string").isin(known)) if known else df
    states(df, cols, piece).write.mode("append").parquet(path)
    return spark.read.parquet(path)
