"""Profile tables: statistics per variable, value counts, histograms, warnings.

Scalars of all columns come from one aggregate. Value counts are the base of distinct counts,
frequencies, extremes and uniformity; values are shuffled after a map-side count only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.mllib.linalg import Vectors
from pyspark.mllib.stat import Statistics
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeloom.functions.columns import choose, share
from gaugeloom.operators.correlation import correlations as correlation_table
from gaugeloom.operators.ordered import EXACT_ROWS, quantile_values, top_k

# Report settings.
QUANTILES = [0.05, 0.25, 0.5, 0.75, 0.95]
SKEWNESS_THRESHOLD = 20
LOW_CATEGORICAL_THRESHOLD = 5
CARDINALITY_THRESHOLD = 50
UNIFORM_THRESHOLD = 0.999
CORRELATION_THRESHOLD = 0.9
NOTABLE_SHARE = 0.01
BOOLEAN_PAIRS = [("t", "f"), ("yes", "no"), ("y", "n"), ("true", "false")]
HISTOGRAM_BINS = 50
TOP_VALUES = 10
PIE_VALUES = 10
EXTREME_VALUES = 5
TEXT_SAMPLES = 5
SAMPLE_ROWS = 10
DUPLICATE_ROWS = 10

COLUMNS_PER_SCAN = 100


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def as_value(column: str) -> Column:
    """Numeric column as double, NaN as null."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def numeric_view(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[as_value(c).alias(c) for c in cols])


def per_variable(df: DataFrame, cols: Sequence[str], make: Callable[[str], list[Column]]) -> DataFrame:
    """One aggregate over all columns, then one row per column; very wide frames take several."""
    tables = []
    for start in range(0, len(cols), COLUMNS_PER_SCAN):
        cells = [F.struct(F.lit(c).alias("variable"), *make(c)) for c in cols[start : start + COLUMNS_PER_SCAN]]
        tables.append(df.agg(F.array(*cells).alias("s")).select(F.inline("s")))
    return reduce(DataFrame.unionByName, tables)


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-null values with their counts: variable, value, n. Columns must share one type family.

    Values are told apart in their own type. ``value`` is a bigint if all columns are integers, else a
    double; two integers or decimals that a double cannot tell apart are two rows.
    """
    picked = df.select(*cols)
    numeric = set(numeric_columns(picked))
    if numeric and numeric != set(cols):
        raise ValueError("count numeric and text columns apart")
    exact = [c for c in numeric if not isinstance(picked.schema[c].dataType, (T.FloatType, T.DoubleType))]
    if numeric and all(isinstance(picked.schema[c].dataType, T.IntegralType) for c in cols):
        picked = df.select(*[F.col(c).cast("bigint").alias(c) for c in cols])
    elif exact:
        cells = [
            F.struct(F.lit(c).alias("variable"), as_value(c).alias("value"), own.cast("string").alias("exact"))
            for c in cols
            for own in [F.col(c) if c in exact else F.lit(None)]
        ]
        long = df.select(F.explode(F.array(*cells)).alias("s")).select("s.*").where(F.col("value").isNotNull())
        return long.groupBy("variable", "value", "exact").agg(F.count("*").alias("n")).drop("exact")
    else:
        picked = numeric_view(df, cols) if numeric else df.select(*[F.col(c).cast("string") for c in cols])
    long = picked.unpivot([], [F.col(c) for c in cols], "variable", "value")
    return long.where(F.col("value").isNotNull()).groupBy("variable", "value").agg(F.count("*").alias("n"))


def count_stats(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """Rows, missing, distinct and unique (seen once) values, with their shares.

    ``approximate`` estimates distinct counts in the one scalar scan, exactly for constants, and
    leaves unique counts null.
    """
    numeric = numeric_columns(df.select(*cols))
    other = [c for c in cols if c not in numeric]
    floats = [c for c in numeric if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))]
    values = [as_value(c).alias(c) if c in floats else F.col(c) if c in numeric else F.col(c).cast("string").alias(c) for c in cols]
    picked = df.select(*values)

    def scalars(c):
        cells = [F.count("*").alias("n"), F.count(c).alias("n_values")]
        if approximate:
            several = F.greatest(F.approx_count_distinct(c), F.lit(2).cast("long"))
            distinct = F.when(F.min(c) == F.max(c), 1).when(F.count(c) > 0, several).otherwise(0)
            cells += [distinct.alias("n_distinct"), F.lit(None).cast("long").alias("n_unique")]
        return cells

    base = per_variable(picked, cols, scalars)
    if not approximate:
        groups = [
            value_counts(picked, same)
            .groupBy(F.col("variable").alias("_v"))
            .agg(F.count("*").alias("n_distinct"), F.count_if(F.col("n") == 1).alias("n_unique"))
            for same in (numeric, other)
            if same
        ]
        base = base.join(reduce(DataFrame.unionByName, groups), F.col("variable") == F.col("_v"), "left")
        base = base.fillna(0, ["n_distinct", "n_unique"]).drop("_v")
    return base.select(
        "variable",
        "n",
        (F.col("n") - F.col("n_values")).alias("n_missing"),
        share(F.col("n") - F.col("n_values"), F.col("n")).alias("p_missing"),
        "n_distinct",
        share(F.col("n_distinct"), F.col("n_values")).alias("p_distinct"),
        "n_unique",
        share(F.col("n_unique"), F.col("n_values")).alias("p_unique"),
    )


def _moments(c: str) -> list[Column]:
    n = F.count(c).cast("double")
    skewness = F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)
    kurtosis = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6)
    return [
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        (F.max(c) - F.min(c)).alias("range"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.var_samp(c).alias("variance"),
        F.sum(c).alias("sum"),
        (F.stddev_samp(c) / F.nullif(F.avg(c), F.lit(0.0))).alias("cv"),
        F.when(n > 2, skewness).alias("skewness"),
        F.when(n > 3, kurtosis).alias("kurtosis"),
    ]


def _zeros(c: str) -> list[Column]:
    tests = {
        "zeros": F.col(c) == 0,
        "negative": F.col(c) < 0,
        "infinite": F.abs(F.col(c)) == F.lit(math.inf),
    }
    cells = []
    for name, test in tests.items():
        cells.append(F.count_if(test).alias(f"n_{name}"))
        cells.append(share(F.count_if(test), F.count("*")).alias(f"p_{name}"))
    return cells


def per_number(df: DataFrame, cols: Sequence[str], make: Callable[[str], list[Column]]) -> DataFrame:
    """Statistics of numeric columns, one row per column.

    Columns become rows before they are aggregated: one small set of aggregates, combined map-side,
    serves any number of columns.
    """
    long = numeric_view(df, cols).unpivot([], [F.col(c) for c in cols], "variable", "value")
    return long.groupBy("variable").agg(*make("value"))


def numeric_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Moments and range. Skewness and kurtosis are adjusted for the sample size."""
    return per_number(df, cols, _moments)


def zero_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Zeros, negatives and infinities; shares are of all rows, missing ones too."""
    return per_number(df, cols, _zeros)


def quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float] = tuple(QUANTILES), exact_rows: int = EXACT_ROWS
) -> DataFrame:
    """Exact interpolated quantiles: variable, prob, value."""
    found = quantile_values(numeric_view(df, cols), {c: list(probs) for c in cols}, exact_rows)
    rows = [(c, float(p), v) for (c, p), v in found.items()]
    return df.sparkSession.createDataFrame(rows, "variable string, prob double, value double")


def deviation_stats(
    df: DataFrame, cols: Sequence[str], exact_rows: int = EXACT_ROWS, sizes: dict[str, int] | None = None
) -> DataFrame:
    """Quantiles, interquartile range and median absolute deviation per variable.

    Columns: variable, iqr, mad, and one ``qNN`` per quantile.
    """
    view = numeric_view(df, cols)
    found = quantile_values(view, {c: list(QUANTILES) for c in cols}, exact_rows, sizes)
    away = view.select(*[F.abs(F.col(c) - F.lit(found[c, 0.5])).cast("double").alias(c) for c in cols])
    mads = quantile_values(away, {c: [0.5] for c in cols}, exact_rows, sizes)
    rows = []
    for c in cols:
        spread = None if found[c, 0.5] is None else found[c, 0.75] - found[c, 0.25]
        rows.append((c, spread, mads[c, 0.5], *[found[c, p] for p in QUANTILES]))
    names = ", ".join(f"q{round(p * 100):02d} double" for p in QUANTILES)
    return df.sparkSession.createDataFrame(rows, f"variable string, iqr double, mad double, {names}")


def low_cardinality(counts: DataFrame, threshold: int = LOW_CATEGORICAL_THRESHOLD) -> DataFrame:
    """Variables with fewer distinct values than the threshold, from ``count_stats`` rows."""
    return counts.where(F.col("n_distinct") < threshold).select("variable", "n_distinct")


def map_boolean(df: DataFrame, col: str, pairs: Sequence[tuple[str, str]] = tuple(BOOLEAN_PAIRS)) -> Column:
    """Truth value of a text by the pairs of (true, false) words; other texts give null."""
    word = F.lower(F.trim(F.col(col)))
    return F.when(word.isin([t for t, _ in pairs]), True).when(word.isin([f for _, f in pairs]), False)


def infer_kind(df: DataFrame, cols: Sequence[str], counts: DataFrame | None = None) -> DataFrame:
    """Kind of each variable: Numeric, Categorical or Boolean; other types are Unsupported."""
    counts = count_stats(df, cols) if counts is None else counts
    numeric, text = set(numeric_columns(df.select(*cols))), text_columns(df.select(*cols))
    texts = df.select(*[F.col(c).cast("string") for c in text])
    booleans = per_variable(
        texts, text, lambda c: [F.bool_and(map_boolean(texts, c).isNotNull() | F.col(c).isNull()).alias("is_boolean")]
    ) if text else df.sparkSession.createDataFrame([], "variable string, is_boolean boolean")
    few = F.col("n_distinct") < LOW_CATEGORICAL_THRESHOLD
    kind = (
        F.when(F.col("variable").isin(list(numeric)) & few, "Categorical")
        .when(F.col("variable").isin(list(numeric)), "Numeric")
        .when(F.col("is_boolean"), "Boolean")
        .when(F.col("variable").isin(text), "Categorical")
        .otherwise("Unsupported")
    )
    return counts.join(booleans, "variable", "left").select(
        "variable",
        kind.alias("kind"),
        F.when(kind == "Categorical", F.col("n_distinct")).alias("n_category"),
    )


def histogram(
    df: DataFrame,
    cols: Sequence[str],
    bins: int = HISTOGRAM_BINS,
    ends: dict[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """Equal-width bins over finite values, the last one closed: variable, bin (1-based), low, high, n.

    ``ends``, the finite minimum and maximum per column, saves a scan.
    """
    finite = numeric_view(df, cols)
    finite = finite.select(*[F.when(F.abs(F.col(c)) < math.inf, F.col(c)).alias(c) for c in cols])
    if ends is None:
        row = finite.agg(*[F.struct(F.min(c), F.max(c)).alias(c) for c in cols]).first()
        ends = {c: tuple(row[c]) for c in cols}
    filled = [c for c in cols if ends[c][0] is not None]
    if not filled:
        schema = "variable string, bin int, low double, high double, n long"
        return df.sparkSession.createDataFrame([], schema)
    value = F.col("value")
    start = choose(F.col("variable"), {c: F.lit(float(ends[c][0])) for c in filled})
    width = choose(F.col("variable"), {c: F.lit((ends[c][1] - ends[c][0]) / bins) for c in filled})
    long = finite.unpivot([], [F.col(c) for c in filled], "variable", "value").where(value.isNotNull())
    long = long.withColumns({"start": start, "width": width})
    place = F.coalesce(F.floor((value - F.col("start")) / F.nullif(F.col("width"), F.lit(0.0))) + 1, F.lit(1))
    counted = long.groupBy("variable", F.least(place, F.lit(bins)).cast("int").alias("bin"), "start", "width")
    low = F.col("start") + F.col("width") * (F.col("bin") - 1)
    return counted.agg(F.count("*").alias("n")).select(
        "variable", "bin", low.alias("low"), (low + F.col("width")).alias("high"), "n"
    )


def frequencies(counts: DataFrame, k: int = TOP_VALUES) -> DataFrame:
    """The k most frequent values per variable; ties go to the smaller value."""
    order = Window.partitionBy("variable").orderBy(F.col("n").desc(), F.col("value"))
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def pie(counts: DataFrame, most: int = PIE_VALUES) -> DataFrame:
    """Shares of all values, for variables with at most ``most`` distinct values."""
    ranked = frequencies(counts, most + 1)
    whole = Window.partitionBy("variable")
    sized = ranked.withColumn("_k", F.count("*").over(whole)).withColumn("_n", F.sum("n").over(whole))
    return sized.where(F.col("_k") <= most).select(
        "variable", "value", "n", share(F.col("n"), F.col("_n")).alias("share")
    )


def extremes(counts: DataFrame, k: int = EXTREME_VALUES) -> DataFrame:
    """The k smallest and k largest distinct values per variable with their counts."""
    ends = []
    for side, order in (("smallest", F.col("value").asc()), ("largest", F.col("value").desc())):
        ranked = counts.withColumn("place", F.row_number().over(Window.partitionBy("variable").orderBy(order)))
        ends.append(ranked.where(F.col("place") <= k).withColumn("side", F.lit(side)))
    return ends[0].unionByName(ends[1])


def uniformity(counts: DataFrame) -> DataFrame:
    """χ² statistic of counts against equal counts: variable, statistic, cells.

    Takes rows ``variable, n`` — one per value or per histogram bin.
    """
    agg = counts.groupBy("variable").agg(
        F.count("*").alias("cells"),
        F.sum("n").cast("double").alias("total"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
    )
    statistic = F.col("squares") * F.col("cells") / F.col("total") - F.col("total")
    return agg.select("variable", statistic.alias("statistic"), "cells")


def filled_histogram(bins: DataFrame, n_bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Histogram rows with the empty bins put in as zeros: variable, bin, n."""
    by_bin = bins.groupBy("variable").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"))
    every = by_bin.select("variable", "m", F.explode(F.sequence(F.lit(1), F.lit(n_bins))).alias("bin"))
    n = F.coalesce(F.try_element_at(F.col("m"), F.col("bin")), F.lit(0))
    return every.select("variable", "bin", n.cast("long").alias("n"))


def uniform_p_values(
    df: DataFrame, cols: Sequence[str], bins: int = HISTOGRAM_BINS, ends: dict | None = None
) -> dict[str, float]:
    """p-values of the χ² test of each numeric column's histogram against equal counts."""
    by_variable: dict[str, list[int]] = {}
    for r in filled_histogram(histogram(df, cols, bins, ends), bins).collect():
        by_variable.setdefault(r.variable, []).append(r.n)
    return {v: Statistics.chiSqTest(Vectors.dense(ns)).pValue for v, ns in by_variable.items()}


def chi_square_tail(statistic: float, freedom: int) -> float:
    """Chance of a χ² value above ``statistic``: the upper incomplete gamma function of half of both.

    The series or the continued fraction, whichever converges; a normal approximation of the cube root
    for very many degrees of freedom, where it is exact to more digits than a threshold needs.
    """
    if statistic <= 0:
        return 1.0
    if freedom > 100_000:
        spread = 2 / (9 * freedom)
        z = ((statistic / freedom) ** (1 / 3) - 1 + spread) / math.sqrt(spread)
        return 0.5 * math.erfc(z / math.sqrt(2))
    a, x = freedom / 2, statistic / 2
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while term > total * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1 - front * total)
    below, k = x + 1 - a, 0
    c, d = math.inf, 1 / below
    total = d
    while True:
        k += 1
        step = -k * (k - a)
        below += 2
        d = 1 / (step * d + below)
        c = below + step / c
        total *= c * d
        if abs(c * d - 1) < 1e-15:
            return front * total


def category_p_values(counts: DataFrame) -> dict[str, float]:
    """p-values of the χ² test of value counts against equal counts, for any number of values."""
    found = uniformity(counts).where(F.col("cells") > 1).collect()
    return {r.variable: chi_square_tail(r.statistic, r.cells - 1) for r in found}


def text_lengths(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Length statistics of text columns in characters, with the total number of characters."""
    lengths = df.select(*[F.length(c).alias(c) for c in cols])
    medians = quantile_values(lengths, {c: [0.5] for c in cols})

    def stats(c):
        return [
            F.min(c).cast("long").alias("min_length"),
            F.max(c).cast("long").alias("max_length"),
            F.avg(c).alias("mean_length"),
            F.lit(medians[c, 0.5]).cast("double").alias("median_length"),
            F.sum(c).cast("long").alias("n_characters"),
        ]

    return per_variable(lengths, cols, stats)


def character_counts(df: DataFrame, col: str) -> DataFrame:
    """How often each character occurs in a text column, over whole texts."""
    return _token_counts(df.select(F.explode(F.split(F.col(col), "")).alias("character")), "character")


def word_counts(df: DataFrame, col: str) -> DataFrame:
    """How often each lower-cased, blank-separated word occurs, over whole texts."""
    return _token_counts(df.select(F.explode(F.split(F.lower(F.col(col)), r"[ \t\r\n]+")).alias("word")), "word")


def _token_counts(tokens, name):
    return tokens.where(F.col(name) != "").groupBy(name).agg(F.count("*").alias("n"))


def text_samples(df: DataFrame, col: str, order: Sequence[str], k: int = TEXT_SAMPLES) -> DataFrame:
    """The first k values of a text column."""
    return top_k(df.select(*dict.fromkeys([*order, col])).where(F.col(col).isNotNull()), order, k)


def missing_bar(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null and non-null counts per column."""
    return per_variable(
        df, cols, lambda c: [F.count(c).alias("n_values"), F.count_if(F.col(c).isNull()).alias("n_missing")]
    )


def missing_matrix(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Null flags per row, as 0/1 columns."""
    return df.select(*keep, *[F.col(c).isNull().cast("int").alias(c) for c in cols])


def missing_heatmap(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Correlation of the null flags of each pair of columns."""
    return correlation_table(missing_matrix(df, cols), cols)


def _row_hashes(df: DataFrame) -> DataFrame:
    """Hashes of whole rows and how often each occurs."""
    return df.select(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))


def _may_repeat(df: DataFrame, hashes: DataFrame) -> DataFrame:
    """The rows whose hash occurs again: whole rows are shuffled only for these."""
    again = hashes.where(F.col("_n") > 1).select("_hash")
    rows = df.withColumn("_hash", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    return rows.join(again, "_hash", "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])


def duplicates(df: DataFrame, k: int = DUPLICATE_ROWS) -> DataFrame:
    """The k most frequent repeated rows with their counts."""
    rows = _may_repeat(df, _row_hashes(df))
    counted = rows.groupBy(*df.columns).agg(F.count("*").alias("n_copies")).where(F.col("n_copies") > 1)
    return top_k(counted, [F.col("n_copies").desc(), *df.columns], k)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier one: n_duplicates, p_duplicates."""
    hashes = _row_hashes(df)
    groups = _may_repeat(df, hashes).groupBy(*df.columns).agg(F.count("*").alias("n"))
    none = F.lit(None).cast("long")
    parts = groups.agg(F.sum(F.col("n") - 1).alias("again"), none.alias("rows")).unionByName(
        hashes.agg(none.alias("again"), F.sum("_n").alias("rows"))
    )
    one = parts.agg(F.max("again").alias("again"), F.max("rows").alias("rows"))
    n = F.when(F.col("rows").isNotNull(), F.coalesce("again", F.lit(0)))
    return one.select(n.alias("n_duplicates"), share(n, F.col("rows")).alias("p_duplicates"))


def samples(df: DataFrame, order: Sequence[str], head: int = SAMPLE_ROWS, tail: int = SAMPLE_ROWS) -> DataFrame:
    """The first and the last rows, marked in ``sample``."""
    first = top_k(df, [F.col(c).asc() for c in order], head).withColumn("sample", F.lit("head"))
    last = top_k(df, [F.col(c).desc() for c in order], tail).withColumn("sample", F.lit("tail"))
    return first.unionByName(last)


def kept(table: DataFrame) -> DataFrame:
    """A table of one row per column or pair of columns, computed once."""
    return table.sparkSession.createDataFrame(table.toArrow())


def variable_table(
    df: DataFrame, cols: Sequence[str] | None = None, approximate: bool = False, detail: bool = True
) -> DataFrame:
    """One row per variable with every statistic the rules read, computed once.

    ``approximate`` estimates distinct counts instead of shuffling all values; without ``detail``
    quantiles and deviations are left out.
    """
    cols = list(cols or df.columns)
    numeric = numeric_columns(df.select(*cols))
    counts = kept(count_stats(df, cols, approximate))
    table = counts.join(infer_kind(df, cols, counts), "variable")
    if numeric:
        scalars = per_number(df, numeric, lambda c: _moments(c) + _zeros(c))
        table = table.join(scalars, "variable", "left")
    if numeric and detail:
        sizes = {r.variable: r.n - r.n_missing for r in counts.collect()}
        table = table.join(deviation_stats(df, numeric, sizes=sizes), "variable", "left")
    return kept(table)


def messages(
    variables: DataFrame,
    correlations: DataFrame,
    uniform: dict[str, float] | None = None,
    n_duplicates: int = 0,
    correlation_threshold: float = CORRELATION_THRESHOLD,
) -> DataFrame:
    """Warnings as rows: kind, variable, value."""
    spark = variables.sparkSession
    name = F.col("variable")
    rules = [
        ("CONSTANT", F.col("n_distinct") == 1, F.col("n_distinct")),
        ("MISSING", F.col("p_missing") > NOTABLE_SHARE, F.col("p_missing")),
        ("UNIQUE", (F.col("n_unique") == F.col("n")) & (F.col("n") > 1), F.col("n_unique")),
        (
            "HIGH_CARDINALITY",
            (F.col("kind") == "Categorical") & (F.col("n_distinct") > CARDINALITY_THRESHOLD),
            F.col("n_distinct"),
        ),
    ]
    if "p_zeros" in variables.columns:
        rules += [
            ("ZEROS", F.col("p_zeros") > NOTABLE_SHARE, F.col("p_zeros")),
            ("INFINITE", F.col("p_infinite") > NOTABLE_SHARE, F.col("p_infinite")),
            ("SKEWED", F.abs(F.col("skewness")) > SKEWNESS_THRESHOLD, F.col("skewness")),
        ]
    flags = [
        F.when(test, F.struct(F.lit(kind).alias("kind"), name, value.cast("double").alias("value")))
        for kind, test, value in rules
    ]
    found = variables.select(F.explode(F.array_compact(F.array(*flags))).alias("s")).select("s.*")
    related = correlations.where(
        (F.abs(F.col("r")) >= correlation_threshold) & (F.col("variable") != F.col("other"))
    )
    related = related.groupBy("variable").agg(F.max(F.abs(F.col("r"))).alias("value"))
    found = found.unionByName(related.withColumn("kind", F.lit("HIGH_CORRELATION")))
    extra = [("UNIFORM", v, p) for v, p in (uniform or {}).items() if p > UNIFORM_THRESHOLD]
    if n_duplicates:
        extra.append(("DUPLICATES", None, float(n_duplicates)))
    if extra:
        found = found.unionByName(spark.createDataFrame(extra, "kind string, variable string, value double"))
    return found


def rejected(found: DataFrame) -> DataFrame:
    """Variables the report rejects: constant ones and highly correlated ones."""
    kinds = ["CONSTANT", "HIGH_CORRELATION"]
    return found.where(F.col("kind").isin(kinds)).select("variable").distinct()


def profile(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    correlation_metric: str = "pearson",
    approximate: bool = False,
    detail: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The whole report as three tables: variables, correlations, messages.

    Without ``detail`` only what the rejection rules read: no quantiles, uniformity, repeated rows.
    """
    cols = list(cols or df.columns)
    picked = df.select(*cols)
    numeric, text = numeric_columns(picked), text_columns(picked)
    variables = variable_table(picked, approximate=approximate, detail=detail)
    related = numeric_view(picked, numeric)
    if correlation_metric == "cramers":  # of categories, whatever their type
        related = picked.select(*[F.col(c).cast("string").alias(c) for c in numeric + text])
    pairs = kept(correlation_table(related, related.columns, correlation_metric))
    if not detail:
        return variables, pairs, kept(messages(variables, pairs))
    uniform: dict[str, float] = {}
    if numeric:
        found = variables.where((F.col("n_infinite") == 0) & F.col("min").isNotNull())
        ends = {r.variable: (r.min, r.max) for r in found.select("variable", "min", "max").collect()}
        finite = [c for c in numeric if c in ends]
        uniform |= uniform_p_values(picked, finite, ends=ends) if finite else {}
        other = [c for c in numeric if c not in ends]
        uniform |= uniform_p_values(picked, other) if other else {}
    if text:
        uniform |= category_p_values(value_counts(picked, text))
    copies = duplicate_count(picked).first().n_duplicates or 0
    return variables, pairs, kept(messages(variables, pairs, uniform, copies))
