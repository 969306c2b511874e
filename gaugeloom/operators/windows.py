"""Sample windows: fixed numbers of consecutive rows as model inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.operators.ordered import (
    BLOCK_ROWS,
    MAX_SERIES_ROWS,
    over_rows_back,
    positions,
    running_total,
)


def _numbers(columns):
    return F.array(*[F.col(c).cast("double") for c in columns])


def windows(
    df: DataFrame,
    inputs: Sequence[str],
    targets: Sequence[str] | str,
    window_size: int,
    target_size: int = 1,
    series: Sequence[str] = (),
    order: Sequence[str] = (),
    overlap: int | None = None,
    future: bool = False,
    max_rows: int = MAX_SERIES_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Samples ``X`` (window_size × inputs) and ``y`` (last target_size target values).

    ``n - window_size + 1`` samples per series and part at stride 1; ``overlap`` sets the stride to
    ``window_size - overlap``. With ``future`` the targets are the rows after the window. ``idx`` is
    the position of the last row a sample reads. Several targets give ``y`` as their concatenation.
    """
    targets = [targets] if isinstance(targets, str) else list(targets)
    if target_size > window_size and not future:
        raise ValueError("target_size is larger than window_size")
    if overlap is not None and not 0 <= overlap < window_size:
        raise ValueError("overlap must be at least 0 and below window_size")
    known = [c for c in ("part", "part_idx", "idx", "n_rows") if c in df.columns]
    placing = [] if "idx" in known else order
    rows = df.select(*dict.fromkeys([*series, *placing, *known, *inputs, *targets]))
    rows = positions(rows, series, order, max_rows)
    shift = target_size if future else 0
    reach = window_size - 1 + shift
    keys = [*series, *(["part"] if "part" in rows.columns else [])]
    place = F.col("part_idx" if "part_idx" in rows.columns else "idx")
    complete = place >= reach
    if overlap is not None:
        complete &= (place - reach) % (window_size - overlap) == 0
    needed = rows.select(
        *keys,
        "idx",
        complete.alias("_complete"),
        _numbers(inputs).alias("_x"),
        _numbers(targets).alias("_y"),
    )
    framed = over_rows_back(
        needed,
        keys,
        reach,
        {
            "X": lambda w: F.collect_list("_x").over(w.rowsBetween(-reach, -shift)),
            "y": lambda w: F.collect_list("_y").over(w.rowsBetween(1 - target_size, 0)),
        },
        F.col("_complete"),
        block_rows,
    )
    return framed.select(*keys, "idx", "X", F.flatten("y").alias("y"))


def x_windows(
    df: DataFrame,
    inputs: Sequence[str],
    window_size: int,
    overlap: int = 0,
    series: Sequence[str] = (),
    order: Sequence[str] = (),
    max_rows: int = MAX_SERIES_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Input-only windows, as for inference; overlap 0 puts them end to end."""
    made = windows(
        df, inputs, inputs[:1], window_size, 1, series, order, overlap, False, max_rows, block_rows
    )
    return made.drop("y")


def flatten_windows(df: DataFrame) -> DataFrame:
    """Replace ``X`` by its values, time step after time step."""
    return df.withColumn("X", F.flatten("X"))


def split_hist_added(df: DataFrame, columns: Sequence[str], added: Sequence[str]) -> DataFrame:
    """Replace ``X`` by ``X_hist``, all steps of the other columns, and ``X_added``, the last step of these."""
    kept = [i for i, c in enumerate(columns) if c not in added]
    extra = [i for i, c in enumerate(columns) if c in added]

    def pick(row, places):
        return F.array(*[row[i] for i in places]) if places else F.array().cast("array<double>")

    hist = F.transform("X", lambda row: pick(row, kept))
    return df.withColumns({"X_hist": hist, "X_added": pick(F.element_at("X", -1), extra)}).drop("X")


def merge_hist_added(df: DataFrame, parts: Sequence[str] = ("X_hist", "X_added")) -> DataFrame:
    """Flat sample of two parts: flattened history, then the added values."""
    if len(parts) != 2:
        raise TypeError("a two-input sample has exactly two parts")
    hist, extra = parts
    return df.withColumn("X", F.concat(F.flatten(hist), F.col(extra))).drop(*parts)


def shuffle_samples(
    df: DataFrame,
    seed: int = 2020,
    series: Sequence[str] = (),
    order: Sequence[str] = ("idx",),
    combined: bool = False,
    max_rows: int = MAX_SERIES_ROWS,
) -> DataFrame:
    """Add ``sample``, the place of each sample in a seeded shuffle, per series unless combined."""
    named = [F.col(c).cast("string") for c in [*series, *order]]
    keyed = df.withColumn("_key", F.md5(F.concat_ws("|", F.lit(str(seed)), *named)))
    placed = running_total(
        keyed, [] if combined else series, ["_key", *series, *order], out="sample", total="_size", max_rows=max_rows
    )
    return placed.drop("_key", "_size")


def combine(df: DataFrame, part: str) -> DataFrame:
    """Samples of one part over all series. Train and test must hold samples, calibrate may be empty."""
    if part not in ("train", "test", "calibrate"):
        raise ValueError(f"unknown part {part}")
    rows = df.where(F.col("part") == part)
    if part != "calibrate" and rows.limit(1).count() == 0:
        raise ValueError(f"no {part} samples")
    return rows


def thin_sequences(
    df: DataFrame,
    target_size: int,
    values: str = "predicted",
    series: Sequence[str] = (),
    order: Sequence[str] = ("idx",),
    max_rows: int = MAX_SERIES_ROWS,
) -> DataFrame:
    """Every target_size-th predicted sequence as rows: time step, value, curve. An incomplete tail is dropped."""
    rows = running_total(df, series, order, out="_place", total="_size", max_rows=max_rows)
    place = F.col("_place")
    kept = rows.where((place % target_size == 0) & (place + target_size <= F.col("_size")))
    curve = F.expr(f"_place div {target_size}")
    long = kept.select(*series, "_place", curve.alias("curve"), F.posexplode(values).alias("step", "value"))
    return long.select(*series, (place + F.col("step")).alias("time_step"), "value", "curve")
