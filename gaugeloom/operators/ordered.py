"""Row positions, running totals, sliding frames and order statistics that survive one huge series.

A window partitioned by series puts a whole series into one task. That is right while every series
is short, which is checked first. Beyond the limit the rows are range-partitioned on
(series, order) instead, so a series spreads over as many tasks as it needs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gaugeloom.functions.columns import choose
from gaugeloom.session import staged

MAX_SERIES_ROWS = 1_000_000
PIECE_ROWS = 20_000_000
BLOCK_ROWS = 1_000_000
EXACT_ROWS = 100_000
SKETCH_ACCURACY = 10_000


def series_sizes(df: DataFrame, series: Sequence[str]) -> tuple[int, int]:
    """Rows of the longest series and of all: one column scan, combined before the shuffle."""
    row = df.groupBy(*series).count().agg(F.max("count"), F.sum("count")).first()
    return row[0] or 0, row[1] or 0


def running_total(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    value: str | None = None,
    out: str = "idx",
    total: str = "n_rows",
    max_rows: int = MAX_SERIES_ROWS,
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """Add ``out``, the sum of ``value`` over earlier rows of the series, and ``total``, over all.

    Without ``value`` every row weighs 1: ``out`` is the zero-based position, ``total`` the length.
    ``order`` must be unique inside a series. Weights must not be null. ``sizes``, bounds on the
    rows of the longest series and of all that are known already, save counting them.
    """
    longest, rows = sizes or series_sizes(df, series)
    if longest <= max_rows:
        return _total_by_window(df, series, order, value, out, total)
    return _total_by_range(df, series, order, value, out, total, rows)


def positions(
    df: DataFrame, series: Sequence[str], order: Sequence[str], max_rows: int = MAX_SERIES_ROWS
) -> DataFrame:
    """Add ``idx`` and ``n_rows``; a frame that already has them is returned as it is.

    They hold for all rows of a series or of a part of it. Filter before, or ``forget_positions``.
    """
    if {"idx", "n_rows"} <= set(df.columns):
        return df
    return running_total(df, series, order, max_rows=max_rows)


def null_safe_join(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys, where null equals null; keys first, then the columns of a, then of b."""
    other = b.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    match = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    rest = [c for c in a.columns if c not in keys]
    return a.join(other, match).select(*keys, *rest, *[c for c in b.columns if c not in keys])


def forget_positions(df: DataFrame) -> DataFrame:
    """Drop positions, which do not hold any more once single rows are gone."""
    return df.drop("idx", "n_rows", "part_idx") if {"idx", "n_rows"} <= set(df.columns) else df


def _total_by_window(df, series, order, value, out, total):
    whole = Window.partitionBy(*series)
    ordered = whole.orderBy(*order)
    if value is None:
        before = F.row_number().over(ordered).cast("long") - 1
        size = F.count(F.lit(1)).over(whole)
    else:
        earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
        zero = F.lit(0).cast(df.schema[value].dataType)
        before = F.coalesce(F.sum(value).over(earlier), zero)
        size = F.sum(value).over(whole)
    return df.withColumn(out, before).withColumn(total, size)


def _total_by_range(df, series, order, value, out, total, rows):
    """Range pieces are balanced whatever the keys; only one row per (series, piece) is summed up.

    The written table pins the pieces: totals and rows see the same ones, also after a lost executor.
    """
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / PIECE_ROWS))
    ranged = (
        df.repartitionByRange(tasks, *series, *order)
        .sortWithinPartitions(*series, *order)
        .withColumn("_piece", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id())
    )
    ranged = staged(ranged, "ranged")
    size = F.count(F.lit(1)) if value is None else F.sum(value)
    by_series = Window.partitionBy(*[f"_s_{k}" for k in series])
    earlier = by_series.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        ranged.groupBy(*[F.col(k).alias(f"_s_{k}") for k in series], F.col("_piece").alias("_p"))
        .agg(F.min("_row").alias("_first"), size.alias("_size"))
        .withColumn("_before", F.sum("_size").over(earlier))
        .withColumn(total, F.sum("_size").over(by_series))
    )
    match = [F.col("_piece") == F.col("_p")]
    match += [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in series]
    joined = ranged.join(pieces, reduce(Column.__and__, match))
    if value is None:
        inside = F.col("_row") - F.col("_first")
    else:
        piece = Window.partitionBy(*series, "_piece").orderBy("_row")
        inside = F.sum(value).over(piece.rowsBetween(Window.unboundedPreceding, -1))
    zero = F.lit(0).cast("long" if value is None else df.schema[value].dataType)
    before = F.coalesce(F.col("_before"), zero) + F.coalesce(inside, zero)
    return joined.withColumn(out, before).select(*df.columns, out, total)


def with_halo(df: DataFrame, rows_back: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Cut each series into blocks of ``block_rows`` positions, each led by the rows before it.

    Frames reaching at most ``rows_back`` rows back may then run per ``(series, _block)``. Rows with
    ``_own`` false are the copies and must be dropped afterwards.
    """
    size = max(block_rows, rows_back, 1)
    block = F.expr(f"idx div {size}")
    lent = F.col("idx") % size >= size - rows_back
    both = F.when(lent, F.array(block, block + 1)).otherwise(F.array(block))
    return df.select("*", F.explode(both).alias("_block")).withColumn("_own", F.col("_block") == block)


def over_rows_back(
    df: DataFrame,
    series: Sequence[str],
    rows_back: int,
    columns: dict[str, Callable[[WindowSpec], Column]],
    keep: Column | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add window expressions over frames of at most ``rows_back`` earlier rows.

    ``columns`` maps names to functions of the ordered window specification.
    """
    spec = Window.partitionBy(*series, "_block").orderBy("idx")
    framed = with_halo(df, rows_back, block_rows)
    for name, make in columns.items():
        framed = framed.withColumn(name, make(spec))
    owned = F.col("_own") if keep is None else F.col("_own") & keep
    return framed.where(owned).drop("_block", "_own")


def order_statistics(
    df: DataFrame,
    ranks: dict[str, Sequence[int]],
    sizes: dict[str, int] | None = None,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[tuple[str, int], float]:
    """Exact values at zero-based ascending ranks of the non-null values of several columns.

    One sketch per column brackets its ranks. Values outside the brackets are only counted, values
    inside are grouped, and running counts then place each rank. A rank its bracket misses is
    looked for again without brackets.
    """
    wanted = {c: sorted(set(rs)) for c, rs in ranks.items() if rs}
    if not wanted:
        return {}
    if sizes is None:
        sizes = df.agg(*[F.count(c).alias(c) for c in wanted]).first().asDict()
    shares = {}
    for c, rs in wanted.items():
        middles = [(r + 1) / sizes[c] for r in rs]
        shares[c] = [min(1.0, max(0.0, m + d)) for m in middles for d in (-2 / accuracy, 2 / accuracy)]
    sketches = [F.percentile_approx(c, F.array(*map(F.lit, ps)), accuracy).alias(c) for c, ps in shares.items()]
    row = df.agg(*sketches).first()
    brackets = {c: _merged(zip(row[c][::2], row[c][1::2])) for c in wanted}
    found = _pick(df, wanted, brackets)
    missed = {c: [r for r in rs if (c, r) not in found] for c, rs in wanted.items()}
    missed = {c: rs for c, rs in missed.items() if rs}
    if missed:
        found |= _pick(df, missed, {c: [(-math.inf, math.inf)] for c in missed})
    return found


def _merged(intervals):
    """Sorted intervals with those that touch put together."""
    merged: list[tuple[float, float]] = []
    for low, high in sorted((float(a), float(b)) for a, b in intervals):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _pick(df, wanted, brackets):
    """Values go to numbered stretches: odd ones are brackets, even ones the gaps around them."""
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in wanted])
    long = doubles.unpivot([], [F.col(c) for c in wanted], "name", "value").where("value IS NOT NULL")
    value = F.col("value")
    passed = {
        c: [test.cast("int") for low, high in brackets[c] for test in (value >= low, value > high)] for c in wanted
    }
    stretch = choose(F.col("name"), {c: reduce(Column.__add__, tests) for c, tests in passed.items()})
    inside = F.when(F.col("stretch") % 2 == 1, value)
    counts = (
        long.withColumn("stretch", stretch)
        .groupBy("name", "stretch", inside.alias("v"))
        .agg(F.count(F.lit(1)).alias("w"))
    )
    totals = running_total(staged(counts, "bracketed"), ["name"], ["stretch", "v"], "w", "before", "size")
    after = F.col("before") + F.col("w")
    tests = [
        (F.col("name") == c) & (F.col("before") <= r) & (after > r) for c, rs in wanted.items() for r in rs
    ]
    hits = totals.where(F.col("v").isNotNull() & reduce(Column.__or__, tests))
    return {
        (h.name, r): h.v
        for h in hits.select("name", "v", "before", after.alias("after")).collect()
        for r in wanted[h.name]
        if h.before <= r < h.after
    }


def quantile_values(
    df: DataFrame,
    probs: dict[str, Sequence[float]],
    exact_rows: int = EXACT_ROWS,
    sizes: dict[str, int] | None = None,
) -> dict[tuple[str, float], float | None]:
    """Exact quantiles with linear interpolation, on the driver: one number per column and share.

    ``percentile`` keeps all distinct values in one task, so it is used up to ``exact_rows`` only.
    ``sizes``, the non-null values per column, saves counting them.
    """
    columns = list(probs)
    if sizes is None:
        sizes = df.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    if max(sizes[c] for c in columns) <= exact_rows:
        cells = [F.percentile(c, F.array(*map(F.lit, probs[c]))).alias(c) for c in columns]
        row = df.agg(*cells).first()
        return {
            (c, p): None if row[c] is None else row[c][i]
            for c in columns
            for i, p in enumerate(probs[c])
        }
    ranks = {
        c: [f(p * (sizes[c] - 1)) for p in probs[c] for f in (math.floor, math.ceil)]
        for c in columns
        if sizes[c]
    }
    values = order_statistics(df, ranks, sizes)
    result = {}
    for c in columns:
        for p in probs[c]:
            if not sizes[c]:
                result[c, p] = None
                continue
            place = p * (sizes[c] - 1)
            low, high = values[c, math.floor(place)], values[c, math.ceil(place)]
            result[c, p] = low if low == high else low + (high - low) * (place - math.floor(place))
    return result


def kth_largest(df: DataFrame, col: str, k: int) -> float:
    """The k-th largest value of a column, exact for any k."""
    size = df.agg(F.count(col)).first()[0]
    rank = size - k
    return order_statistics(df, {col: [rank]}, {col: size})[col, rank]


def top_k(df: DataFrame, by: Sequence[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows in the given order."""
    return df.orderBy(*by).limit(k)


def every_kth(
    df: DataFrame, k: int, series: Sequence[str], order: Sequence[str], max_rows: int = MAX_SERIES_ROWS
) -> DataFrame:
    """Rows 0, k, 2k, … of each series, numbered anew."""
    kept = positions(df, series, order, max_rows).where(F.col("idx") % k == 0)
    return kept.withColumns({"idx": F.expr(f"idx div {k}"), "n_rows": F.expr(f"(n_rows + {k - 1}) div {k}")})
