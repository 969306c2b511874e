"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts (or numbers cast to text) read as true and as false.
TRUE_TEXTS = ["True", "1"]
FALSE_TEXTS = ["False", "0"]


def first_token(text: Column) -> Column:
    """First blank-separated token."""
    return F.element_at(F.split(F.trim(text), r"\s+"), 1)


def last_token(text: Column) -> Column:
    """Last blank-separated token."""
    return F.element_at(F.split(F.trim(text), r"\s+"), -1)


def base_name(path: Column) -> Column:
    """File name without its folders."""
    return F.substring_index(path, "/", -1)


def stage_name(path: Column, stage: str) -> Column:
    """File name with the stage put before its extension: ``01.csv`` becomes ``01-clean.csv``."""
    return F.replace(base_name(path), F.lit("."), F.lit(f"-{stage}."))


def part_of_name(path: Column) -> Column:
    """The part a file name speaks of; train is tested first."""
    parts = F.when(F.contains(path, F.lit("train")), "train")
    for part in ("test", "calibrate"):
        parts = parts.when(F.contains(path, F.lit(part)), part)
    return parts


def truncated_share(n: Column, share: float) -> Column:
    """Whole rows in a share of ``n``, in double arithmetic."""
    return F.floor(n.cast("double") * F.lit(float(share)))


def argmax(values: Column) -> Column:
    """Zero-based place of the first maximum of an array."""
    return F.array_position(values, F.array_max(values)) - 1


def above(score: Column, threshold: float = 0.5) -> Column:
    """1 where the score is strictly above the threshold, else 0; NaN gives 0."""
    return ((score > threshold) & ~F.isnan(score)).cast("int")


def midpoint(low: Column, high: Column) -> Column:
    """Middle of an interval."""
    return low + (high - low) / 2


def text_to_bool(text: Column) -> Column:
    """Truth value of a text; any other text is an error."""
    return (
        F.when(text.isin(TRUE_TEXTS), True)
        .when(text.isin(FALSE_TEXTS), False)
        .when(text.isNotNull(), F.raise_error(F.concat(F.lit("not a truth value: "), text)).cast("boolean"))
    )


def choose(key: Column, choices: dict[str, Column]) -> Column:
    """The expression that goes with the value of ``key``; null for other values."""
    cases = F.when(F.lit(False), None)
    for name, value in choices.items():
        cases = cases.when(key == name, value)
    return cases


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, null for an empty whole."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
