"""Expressions over arrays that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places that are summed one by one; whole blocks are summed once.
BLOCK = 256


def with_before(df: DataFrame, sizes: str, out: str) -> DataFrame:
    """Add for each place of the array column ``sizes`` the sum before it; empty and null arrays give null.

    Whole blocks are summed once, so the work grows far less than with the square of the length.
    """
    some = F.size(sizes) > 0

    def total(array: Column) -> Column:
        return F.aggregate(array, F.lit(0), lambda a, x: a + x)

    blocks = F.transform(
        F.sequence(F.lit(0), F.expr(f"cast((size({sizes}) - 1) div {BLOCK} as int)")),
        lambda b: total(F.slice(F.col(sizes), b * BLOCK + 1, F.lit(BLOCK))),
    )
    of_block = F.transform(
        F.sequence(F.lit(0), F.size("_blocks") - 1), lambda b: total(F.slice(F.col("_blocks"), F.lit(1), b))
    )
    # the sums before the blocks are a lambda's argument: a column would be put in and summed again for each place
    def places(bases: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(sizes) - 1),
            lambda i: F.get(bases, F.floor(i / BLOCK).cast("int"))
            + total(F.slice(F.col(sizes), F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)),
        )

    before = F.get(F.transform(F.array(of_block), places), F.lit(0))
    return df.withColumn("_blocks", F.when(some, blocks)).withColumn(out, F.when(some, before)).drop("_blocks")
