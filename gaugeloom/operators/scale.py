"""Scalers fitted on train rows and applied as literal expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.operators.ordered import EXACT_ROWS, quantile_values

# Scaling methods.
METHODS = ["standard", "minmax", "robust", "none"]


@dataclass(frozen=True)
class Scaler:
    """Center and scale per column: two numbers each, whatever the rows."""

    center: dict[str, float]
    scale: dict[str, float]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, float(self.center[c]), float(self.scale[c])) for c in self.center]
        return spark.createDataFrame(rows, "feature string, center double, scale double")

    @staticmethod
    def from_table(table: DataFrame) -> Scaler:
        rows = table.collect()
        return Scaler({r.feature: r.center for r in rows}, {r.feature: r.scale for r in rows})


def train_rows(df: DataFrame) -> DataFrame:
    """Train rows of all series; every row of a frame that was not split."""
    return df.where(F.col("part") == "train") if "part" in df.columns else df


def fit_scalers(
    df: DataFrame, wanted: Sequence[tuple[Sequence[str], str | None]], exact_rows: int = EXACT_ROWS
) -> list[Scaler]:
    """Fit one scaler per (columns, method) on the train rows, all with one aggregate.

    Robust scaling reads quantiles besides. A scale of zero becomes 1.
    """
    rows = train_rows(df)
    methods = [method or "none" for _, method in wanted]
    unknown = [m for m in methods if m not in METHODS]
    if unknown:
        raise NotImplementedError(f"scaling method {unknown[0]}")
    cells, quantiled = {}, []
    for i, ((cols, _), method) in enumerate(zip(wanted, methods)):
        for c in cols:
            x = F.col(c).cast("double")
            if method == "minmax":
                cells[i, c] = F.struct(F.min(x).alias("at"), (F.max(x) - F.min(x)).alias("by"))
            elif method == "standard":
                cells[i, c] = F.struct(F.avg(x).alias("at"), F.stddev_pop(x).alias("by"))
            elif method == "robust":
                quantiled.append((i, c))
    found: dict[tuple[int, str], tuple] = {}
    if cells:
        row = rows.agg(*[cell.alias(f"s{j}") for j, cell in enumerate(cells.values())]).first()
        found |= {key: (row[j]["at"], row[j]["by"]) for j, key in enumerate(cells)}
    if quantiled:
        q = quantile_values(rows, {c: [0.25, 0.5, 0.75] for _, c in quantiled}, exact_rows)
        found |= {
            (i, c): (None, None) if q[c, 0.5] is None else (q[c, 0.5], q[c, 0.75] - q[c, 0.25])
            for i, c in quantiled
        }
    empty = sorted({c for (_, c), (at, _) in found.items() if at is None})
    if empty:
        raise ValueError(f"no train values to fit a scaler on: {empty}")
    return [
        Scaler(
            {c: at for (j, c), (at, _) in found.items() if j == i},
            {c: by or 1.0 for (j, c), (_, by) in found.items() if j == i},
        )
        for i in range(len(wanted))
    ]


def fit_scaler(
    df: DataFrame, cols: Sequence[str], method: str | None = "minmax", exact_rows: int = EXACT_ROWS
) -> Scaler:
    """Fit one scaler on the train rows; ``None`` or "none" is the identity."""
    return fit_scalers(df, [(cols, method)], exact_rows)[0]


def apply_scaler(df: DataFrame, scaler: Scaler) -> DataFrame:
    """``(x - center) / scale``, without clipping."""
    scaled = {c: (F.col(c) - F.lit(scaler.center[c])) / F.lit(scaler.scale[c]) for c in scaler.center if c in df.columns}
    return df.withColumns(scaled) if scaled else df


def invert_scaler(df: DataFrame, scaler: Scaler) -> DataFrame:
    """``x * scale + center``."""
    restored = {c: F.col(c) * F.lit(scaler.scale[c]) + F.lit(scaler.center[c]) for c in scaler.center if c in df.columns}
    return df.withColumns(restored) if restored else df


def scale_pair(
    train: DataFrame, other: DataFrame, cols: Sequence[str], method: str = "minmax"
) -> tuple[DataFrame, DataFrame, Scaler]:
    """Fit on one frame, transform both, return the scaler too."""
    scaler = fit_scaler(train, cols, method)
    return apply_scaler(train, scaler), apply_scaler(other, scaler), scaler


def scale_in_out(
    df: DataFrame,
    inputs: Sequence[str],
    outputs: Sequence[str],
    input_method: str | None,
    output_method: str | None,
) -> tuple[DataFrame, Scaler, Scaler]:
    """Separate scalers for inputs and outputs, both fitted on train rows."""
    input_scaler, output_scaler = fit_scalers(df, [(inputs, input_method), (outputs, output_method)])
    return apply_scaler(apply_scaler(df, input_scaler), output_scaler), input_scaler, output_scaler
