"""Order-keeping splits into train, calibration and test parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.functions.columns import truncated_share
from gaugeloom.operators.ordered import MAX_SERIES_ROWS, positions, running_total
from gaugeloom.session import staged


def split_rows(
    df: DataFrame,
    train: float,
    calibrate: float = 0.0,
    series: Sequence[str] = (),
    order: Sequence[str] = (),
    max_rows: int = MAX_SERIES_ROWS,
) -> DataFrame:
    """Add ``part`` and ``part_idx``: the first rows of each series train, then calibrate, rest test.

    Each size is truncated alone. Positions are all it needs, so no further shuffle.
    """
    rows = positions(df, series, order, max_rows)
    n_train = truncated_share(F.col("n_rows"), train)
    n_both = n_train + truncated_share(F.col("n_rows"), calibrate)
    idx = F.col("idx")
    part = F.when(idx < n_train, "train").when(idx < n_both, "calibrate").otherwise("test")
    start = F.when(idx < n_train, 0).when(idx < n_both, n_train).otherwise(n_both)
    return rows.withColumn("part", part).withColumn("part_idx", idx - start)


def series_name(series: Sequence[str]):
    """Name of a series, as text: names are compared as text, so 10 comes before 2."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in series])


def split_series(
    df: DataFrame,
    train: float,
    calibrate: float = 0.0,
    series: Sequence[str] = (),
    shuffle: bool = False,
    seed: int = 2020,
    max_rows: int = MAX_SERIES_ROWS,
) -> DataFrame:
    """Add ``part``: whole series, in name order or shuffled by a seeded digest.

    Only the two names at the part borders are looked up; rows are then compared with them, which
    needs neither a join nor a shuffle of the rows.
    """
    key = series_name(series)
    if shuffle:
        key = F.concat_ws("|", F.md5(F.concat_ws("|", F.lit(str(seed)), key)), key)
    names = running_total(df.select(key.alias("key")).distinct(), [], ["key"], max_rows=max_rows)
    n_train = truncated_share(F.col("n_rows"), train)
    n_both = n_train + truncated_share(F.col("n_rows"), calibrate)
    borders = names.agg(
        F.max(F.when(F.col("idx") < n_train, F.col("key"))).alias("train"),
        F.max(F.when(F.col("idx") < n_both, F.col("key"))).alias("both"),
    ).first()
    part = F.lit("test")
    if borders.both is not None:
        part = F.when(key <= borders.both, "calibrate").otherwise(part)
    if borders.train is not None:
        part = F.when(key <= borders.train, "train").otherwise(part)
    return df.withColumn("part", part)


def validation_tail(
    df: DataFrame,
    share: float = 0.25,
    series: Sequence[str] = (),
    order: Sequence[str] = (),
    max_rows: int = MAX_SERIES_ROWS,
) -> DataFrame:
    """Add ``validation``: true for the last ``share`` of all samples, series after series.

    Only the key of the first held-out sample is looked up, first its series among the series
    lengths, then its place in that series. Samples are compared with it where they are; the keys are
    staged for it, so that what makes the samples runs once.
    """
    keys = staged(df.select(*dict.fromkeys([*series, *order])), "sample_keys")
    lengths = keys.groupBy(*series).agg(F.count(F.lit(1)).alias("_n"))
    lengths = running_total(lengths, [], series, "_n", "_before", "_all", max_rows) if series else lengths
    if not series:
        lengths = lengths.withColumns({"_before": F.lit(0), "_all": F.col("_n")})
    first = truncated_share(F.col("_all"), 1 - share)
    inside = (F.col("_before") <= first) & (first < F.col("_before") + F.col("_n"))
    named = [F.col(c).cast("string").alias(c) for c in series]
    home = lengths.where(inside).select(*named, (first - F.col("_before")).alias("_rank")).first()
    if home is None:
        return df.withColumn("validation", F.lit(False))
    key = {c: F.lit(home[c]).cast(df.schema[c].dataType) for c in series}
    members = keys
    for c in series:
        members = members.where(F.col(c) == key[c])
    placed = running_total(members, [], order, out="_place", total="_size", max_rows=max_rows)
    named = [F.col(c).cast("string").alias(c) for c in order]
    border = placed.where(F.col("_place") == home["_rank"]).select(*named).first()
    key |= {c: F.lit(border[c]).cast(df.schema[c].dataType) for c in order}
    here, there = (F.struct(*[f(c).alias(c) for c in [*series, *order]]) for f in (F.col, key.__getitem__))
    return df.withColumn("validation", here >= there)
