"""Column selection, null removal and the rules that reject columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeloom.functions.columns import first_token, last_token
from gaugeloom.operators.ordered import MAX_SERIES_ROWS, forget_positions, over_rows_back, positions


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; absent names are ignored."""
    return df.drop(*columns)


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows with any null or NaN."""
    return forget_positions(df.dropna("any"))


def move_column(df: DataFrame, name: str, place: int) -> DataFrame:
    """Move a column to a zero-based place."""
    columns = [c for c in df.columns if c != name]
    columns.insert(place, name)
    return df.select(*columns)


def select_features(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Target first, then the listed features that exist; no list means all columns."""
    wanted = features or df.columns
    return df.select(target, *[c for c in wanted if c in df.columns and c != target])


def select_numeric(df: DataFrame) -> DataFrame:
    """Numeric and boolean columns only."""
    kept = [f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    return df.select(*kept)


def remove_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop raw features after features were made from them."""
    return df.drop(*columns)


def missing_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per requested feature: is it there, and how many values does it hold."""
    cells = [
        F.struct(
            F.lit(name).alias("feature"),
            F.lit(name in df.columns).alias("present"),
            (F.count(name) if name in df.columns else F.lit(0).cast("long")).alias("n_values"),
        )
        for name in features
    ]
    return df.agg(F.array(*cells).alias("s")).select(F.inline("s"))


def require_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The frame itself, or an error naming the features it lacks."""
    absent = [c for c in features if c not in df.columns]
    if absent:
        raise ValueError(f"input data lacks required features: {absent}")
    return df


def verify_schema(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """One row per expected column: presence, type as expected, null count, constant or not."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    cells = []
    for name, wanted in spec.items():
        there = name in types
        cells.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(there).alias("present"),
                F.lit(types.get(name) == wanted).alias("type_ok"),
                (F.count_if(F.col(name).isNull()) if there else F.lit(None).cast("long")).alias("n_null"),
                (
                    F.min(name).eqNullSafe(F.max(name)) if there else F.lit(None).cast("boolean")
                ).alias("constant"),
            )
        )
    return df.agg(F.array(*cells).alias("s")).select(F.inline("s"))


def is_monotonic(
    df: DataFrame, column: str, series: Sequence[str], order: Sequence[str], max_rows: int = MAX_SERIES_ROWS
) -> bool:
    """Whether the column never falls along the order inside any series."""
    rows = positions(df.select(*dict.fromkeys([column, *series, *order])), series, order, max_rows)
    steps = over_rows_back(
        rows.withColumn("_value", F.col(column)), series, 1, {"_last": lambda w: F.lag("_value").over(w)}
    )
    return steps.where(F.col("_value") < F.col("_last")).limit(1).count() == 0


def drop_monotonic_first(
    df: DataFrame, series: Sequence[str], order: Sequence[str], max_rows: int = MAX_SERIES_ROWS
) -> DataFrame:
    """Drop the first column if it never falls along the order, as an index column would."""
    first = df.columns[0]
    return df.drop(first) if is_monotonic(df, first, series, order, max_rows) else df


def constant_columns(variables: DataFrame) -> DataFrame:
    """Variables with a single distinct value."""
    return variables.where(F.col("n_distinct") == 1).select("variable")


def zero_columns(variables: DataFrame, threshold: float) -> DataFrame:
    """Variables whose share of zeros is strictly above the threshold."""
    return variables.where(F.col("p_zeros") > threshold).select("variable")


def parse_messages(messages: DataFrame, text: str = "message") -> DataFrame:
    """Kind and variable from message texts such as ``[ZEROS] … name``."""
    kind = F.regexp_replace(first_token(F.col(text)), r"[\[\]]", "")
    return messages.select(kind.alias("kind"), last_token(F.col(text)).alias("variable"))


def correlated_columns(
    correlations: DataFrame,
    threshold: float,
    target: str | None = None,
    flag: float = 0.9,
    order: Sequence[str] = (),
    removed: Sequence[str] = (),
) -> list[str]:
    """Columns to drop because an earlier kept column has a signed correlation above the threshold.

    Every variable flagged by an absolute correlation of at least ``flag`` is visited in ``order``;
    unless it was itself dropped before, its partners go. With a target, pairs with it are passed
    over. The table has one row per pair of columns, so it is small whatever the rows.
    """
    pairs = correlations.where(F.col("r").isNotNull()).select("variable", "other", "r").collect()
    partners: dict[str, list[tuple[str, float]]] = {}
    for p in pairs:
        if p.variable != p.other:
            partners.setdefault(p.variable, []).append((p.other, p.r))
    gone = dict.fromkeys(removed)
    place = {c: i for i, c in enumerate(order)}
    for variable in sorted(partners, key=lambda c: (place.get(c, len(place)), c)):
        found = partners[variable]
        if variable in gone or variable == target or max(abs(r) for _, r in found) < flag:
            continue
        gone.update(dict.fromkeys(o for o, r in found if r > threshold and o != target))
    return [c for c in gone if c not in set(removed)]


def removable_columns(
    variables: DataFrame,
    correlations: DataFrame,
    zeros_threshold: float = 1.0,
    correlation_threshold: float = 1.0,
    target: str | None = None,
    order: Sequence[str] = (),
    skip_target_pairs: bool = True,
) -> list[str]:
    """All columns the rules reject, each once; the target is never among them."""
    flagged = constant_columns(variables).unionByName(zero_columns(variables, zeros_threshold))
    removed = [r.variable for r in flagged.distinct().collect()]
    removed += correlated_columns(
        correlations,
        correlation_threshold,
        target if skip_target_pairs else None,
        order=order,
        removed=removed,
    )
    return sorted(c for c in set(removed) if c != target)
