"""Class codes and one-hot columns for a target or for inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gaugeloom.functions.columns import above, argmax
from gaugeloom.operators.ordered import positions

#: Copies of each class that rows are dealt over.
SALTS = 16


def fit_label_encoder(df: DataFrame, target: str, code: str = "code") -> DataFrame:
    """Table of the sorted distinct classes with their codes 0..n-1."""
    classes = df.select(target).where(F.col(target).isNotNull()).distinct()
    return positions(classes, [], [target]).select(target, F.col("idx").alias(code))


def apply_label_encoder(df: DataFrame, codes: DataFrame, target: str, code: str = "code") -> DataFrame:
    """Replace classes by their codes; null stays null, a class without a code is an error.

    Rows are dealt over ``SALTS`` copies of each class, so a class of most rows does not meet in one task
    where the codes are too many to be broadcast.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(SALTS))
    salted = codes.select(F.col(target).alias("_class"), F.col(code).alias("_code"))
    salted = salted.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    joined = df.withColumn("_salt", salt).join(
        salted, (F.col(target) == F.col("_class")) & (F.col("_salt") == F.col("_copy")), "left"
    )
    unknown = F.raise_error(F.concat(F.lit("class without a code: "), F.col(target).cast("string")))
    found = F.when(F.col(target).isNotNull() & F.col("_code").isNull(), unknown).otherwise(F.col("_code"))
    return joined.withColumn(target, found).select(*df.columns)


def label_encode(df: DataFrame, target: str) -> DataFrame:
    """Fit on all series together, apply to each row."""
    return apply_label_encoder(df, fit_label_encoder(df, target), target)


def class_count(df: DataFrame, target: str) -> int:
    return df.agg(F.count_distinct(target)).first()[0]


def _classes(df, columns, most=None):
    """Sorted classes of each column on the driver, by one scan; each class becomes a column there.

    ``most`` bounds them for a caller who wants an error rather than a very wide frame.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)])
    found = df.select(F.explode(cells).alias("x")).select("x.*").where("v IS NOT NULL").distinct()
    if most is not None:
        found = found.limit(most * len(columns) + 1)
    texts = [(r.i, r.v) for r in found.collect()]
    out = []
    for i, column in enumerate(columns):
        values = [v for k, v in texts if k == i]
        if most is not None and len(values) > most:
            raise ValueError(f"{column} has more than {most} classes; use class codes")
        kind = df.schema[column].dataType
        typed = df.sparkSession.createDataFrame([(v,) for v in values], "v string").select(F.col("v").cast(kind))
        out.append(sorted(r[0] for r in typed.collect()) if not isinstance(kind, StringType) else sorted(values))
    return out


def onehot_encode(df: DataFrame, target: str, most: int | None = None) -> tuple[DataFrame, list[str]]:
    """Replace a target of more than two classes by 0/1 columns ``target_0..``; an error beyond ``most``."""
    [classes] = _classes(df, [target], most)
    if len(classes) <= 2:
        raise ValueError("one-hot encoding needs more than two classes; use class codes")
    return _spread(df, target, classes)


def _spread(df, column, classes):
    names = [f"{column}_{i}" for i in range(len(classes))]
    flags = [(F.col(column) == F.lit(c)).cast("int").alias(n) for c, n in zip(classes, names)]
    return df.select(*[c for c in df.columns if c != column], *flags), names


def onehot_inputs(df: DataFrame, columns: Sequence[str], most: int | None = None) -> DataFrame:
    """One-hot encode categorical inputs, fitted on all series together."""
    for column, classes in zip(columns, _classes(df, columns, most) if columns else ()):
        df, _ = _spread(df, column, classes)
    return df


def encode_target(df: DataFrame, target: str, onehot: bool = False) -> tuple[DataFrame, list[str]]:
    """Encode a class target; returns the frame and the names of its target columns."""
    if onehot:
        return onehot_encode(df, target)
    return label_encode(df, target), [target]


def categorical_columns(variables: DataFrame) -> DataFrame:
    """Variables the profile gives a number of categories."""
    return variables.where(F.col("n_category").isNotNull()).select("variable", "n_category")


def decode_argmax(df: DataFrame, column: str, out: str = "predicted") -> DataFrame:
    """Class code with the highest score; the first one on ties."""
    return df.withColumn(out, argmax(F.col(column)))


def decode_binary(df: DataFrame, column: str, threshold: float = 0.5, out: str = "predicted") -> DataFrame:
    """1 where the score is strictly above the threshold."""
    return df.withColumn(out, above(F.col(column), threshold))
