"""Document fingerprints: threshold-scaled sketches of word shingles.

A text's shingles are its runs of five words (a shorter text is one shingle). Of their 64-bit hashes the
sketch retains every one below a fixed fraction of the hash range, and the smallest, so that a text with
words never has an empty sketch. Since the threshold is the same for all texts, sketches of parts can be
merged by union and cut again, and the share of one sketch found in another estimates containment however
unequal the texts are. Only built-in functions are used.

Defined cases: words are maximal runs without ASCII white space, in lower case. Null texts are empty;
texts without words have the empty sketch, which is like another empty one and unlike all others. Repeated rows
have equal sketches; in ``with_next`` they follow one another, ties in an order of their content. A very long
text is one row whose sketch grows with it. An empty table gives an empty result. Other columns stay as they
are; names beginning with ``_`` and the names of the columns added are the operator's own.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORDS = 5
FRACTION = 1 / 4
#: Borders of ranges that a value is compared with at once.
GROUP = 256


def _most(fraction: float) -> int:
    """The largest hash that is retained; hashes are longs of all values alike."""
    return -(2**63) + int(2**64 * fraction) - 1


def with_sketch(df: DataFrame, text: str, out: str, words: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """Add ``out``: the sorted distinct shingle hashes (long) that the sketch of ``text`` retains."""
    hashes, grams = f"{out}_w", f"{out}_g"
    found = F.array_remove(F.split(F.lower(F.col(text)), SPACE, -1), "")
    df = df.withColumn(hashes, F.transform(found, lambda w: F.xxhash64(w)))
    size = F.size(hashes)
    shingle = lambda i: F.xxhash64(*[F.get(F.col(hashes), i + k) for k in range(words)])
    some = F.when(size >= words, F.transform(F.sequence(F.lit(0), size - words), shingle))
    some = some.when(size > 0, F.array(F.xxhash64(F.col(hashes)))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(grams, some)
    kept = F.filter(F.col(grams), lambda g: g <= F.lit(_most(fraction)))
    least = F.when(F.size(grams) > 0, F.array(F.array_min(grams))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(out, F.array_sort(F.array_union(kept, least))).drop(hashes, grams)


def merged(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of both texts' shingles together."""
    both = F.array_union(a, b)
    kept = F.filter(both, lambda g: (g <= F.lit(_most(fraction))) | (g == F.array_min(both)))
    return F.array_sort(kept)


def likeness(a: Column, b: Column) -> Column:
    """Shared part of two sketches, 0 to 1; two empty ones are alike."""
    common = F.size(F.array_intersect(a, b)).cast("double")
    all_ = F.size(a) + F.size(b) - common
    return F.when(all_ > 0, common / all_).otherwise(F.lit(1.0))


def containment(a: Column, b: Column) -> Column:
    """Part of sketch a that is in b: null if a is empty."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a))


def written(sketch: Column) -> Column:
    """The sketch as text: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(sketch, lambda g: F.lpad(F.lower(F.hex(g)), 16, "0")), "")


def _range_of(borders: list[int], value: Column) -> tuple[Column, Column]:
    """How many of the sorted borders are not above the value, and whether one is equal to it.

    Borders are literals in groups of ``GROUP``: a value is compared with the groups' first ones, then with one group.
    """
    if not borders:
        return F.lit(0), F.lit(False)
    groups = [borders[i : i + GROUP] for i in range(0, len(borders), GROUP)]
    firsts = F.from_json(F.lit(json.dumps([g[0] for g in groups])), "array<bigint>")
    nested = F.from_json(F.lit(json.dumps(groups)), "array<array<bigint>>")
    group = F.size(F.filter(firsts, lambda x: x <= value)) - 1
    within = F.get(nested, group)
    place = group * GROUP + F.size(F.filter(within, lambda x: x <= value))
    return F.when(group >= 0, place).otherwise(0), (group >= 0) & F.coalesce(F.array_contains(within, value), F.lit(False))


def with_next(df: DataFrame, order: str, ties: list[str], next_of: dict[str, str], rows: int = 100_000) -> DataFrame:
    """Add for each row columns of the next one, by ``order`` (null first) and ``ties``; the last's is the first.

    Rows are dealt in ranges of ``order`` of about ``rows`` rows. Borders are values of the column, so the
    next range's first rows are known by value and are dealt to both ranges.
    """
    total = df.count()
    parts = max(4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / rows))
    at = [k / parts for k in range(1, parts)]
    borders = df.agg(F.percentile_approx(order, F.array(*map(F.lit, at)), 10 * parts)).first()[0] or []
    least = df.agg(F.min(order)).first()[0]
    borders = sorted({x for x in borders if x is not None and x > least})
    own, at_border = _range_of(borders, F.col(order))
    own = F.when(F.col(order).isNull(), 0).otherwise(own)
    place = lambda part, lent: F.struct(part.cast("int").alias("part"), F.lit(lent).alias("lent"))
    both = F.when(at_border, F.array(place(own, False), place(own - 1, True)))
    dealt = df.withColumn("_at", F.explode(both.otherwise(F.array(place(own, False)))))
    sort = [F.col(order).asc_nulls_first(), *[F.col(t) for t in ties]]
    first = df.orderBy(*sort).limit(1).withColumn("_at", place(F.lit(len(borders)), True))
    within = Window.partitionBy("_part").orderBy("_lent", *sort)
    dealt = dealt.unionByName(first).select(*df.columns, F.col("_at.part").alias("_part"), F.col("_at.lent").alias("_lent"))
    dealt = dealt.withColumns({new: F.lead(old).over(within) for new, old in next_of.items()})
    return dealt.where("not _lent").drop("_part", "_lent")
