"""Documents that share a passage: a run of words that stands in another document as well.

Words are the bytes between white space. A run of ``words`` words has an anchor, the smallest hash of ``GRAM`` words
in it, so equal runs have equal anchors. Each document sends one row an anchor, with the digest of all runs that the
anchor stands for. Equal digests in two documents settle both. What is left are anchors met in several documents of
which one is not settled yet: their runs are hashed one by one, and equal ones meet.

Defined cases: null texts are empty; texts of fewer words share nothing; a run that occurs twice in one document only
is not shared; rows that are equal, identifier included, share what they hold. Null identifiers are allowed. Words
and runs are compared by 64-bit hashes. A very long text is cut into slices of words that overlap by a run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeloom.llm.runs import least_places
from gaugeloom.session import staged

#: Words of an anchor: many documents share lines of fewer.
GRAM = 16
#: Words that are hashed at once.
SLICE = 100_000
#: Rows that are handed back at once, about.
RETURNED = 200_000
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: list[np.ndarray] = []


def _mixed(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


BYTES = _mixed(np.arange(1, 257, dtype=np.uint64))


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the factor and of its inverse, n of each at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(n, 1 << 16).bit_length()
        steps = [np.full(size, f, np.uint64) for f in (FACTOR, INVERSE)]
        for s in steps:
            s[0] = 1
        _POWERS[:] = [np.multiply.accumulate(s) for s in steps]
    return _POWERS


def hashes(values: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A hash of the values from each s to each e, whatever lies before and behind."""
    up, down = _powers(len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return _mixed((total[e] - total[s]) * down[s])


def sliced(body: pa.Buffer, words: int) -> Iterator[np.ndarray]:
    """Hashes of the words of a text, slice by slice; texts of fewer than ``words`` words have none."""
    data = np.frombuffer(body, np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], SPACE[data], [True]])))
    starts, ends = edges[::2], edges[1::2]
    for a in range(0, len(starts) - words + 1, SLICE):
        s, e = starts[a : a + SLICE + words - 1], ends[a : a + SLICE + words - 1]
        yield hashes(BYTES[data[s[0] : e[-1]]], s - s[0], e - s[0])


def _anchors(found: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each anchor, and the first and the last run that it is the anchor of."""
    place = np.arange(len(found) - GRAM + 1)
    grams = hashes(found, place, place + GRAM)
    place, first, last = least_places(grams, words - GRAM + 1)
    return grams[place].view(np.int64), first, last


def _cut(narrow: DataFrame, words: int) -> DataFrame:
    """(id, mark, hash, digest): the different anchors of every row, with the digest of their runs."""

    def anchors(batch, i):
        parts = []
        for found in sliced(batch.column(2)[i].as_buffer(), words):
            hash_, first, last = _anchors(found, words)
            parts.append(np.stack([hash_, hashes(found, first, last + words).view(np.int64)]))
        if len(parts) < 2:
            return _once(parts[0]) if parts else None
        return np.unique(np.concatenate(parts, axis=1), axis=1)

    return _made(narrow, narrow, anchors, "hash", "digest")


def _once(columns: np.ndarray) -> np.ndarray:
    """Rows of which no two have the same digest."""
    return columns[:, np.unique(columns[1], return_index=True)[1]]


def _made(narrow: DataFrame, rows: DataFrame, of_row: Callable[[pa.RecordBatch, int], np.ndarray | None], *names: str) -> DataFrame:
    """(id, mark, names): what ``of_row`` makes of each row, an array of as many columns or None."""

    def joined(batch, at, parts):
        place = pa.array(np.repeat(at, [x.shape[1] for x in parts]))
        columns = np.concatenate(parts, axis=1)
        arrays = [batch.column(0).take(place), batch.column(1).take(place), *map(pa.array, columns)]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "mark", *names])

    def run(batches):
        for batch in batches:
            at, parts, size = [], [], 0
            for i in range(batch.num_rows):
                found = of_row(batch, i)
                if found is None:
                    continue
                at.append(i)
                parts.append(found)
                size += found.shape[1]
                if size >= RETURNED:
                    yield joined(batch, at, parts)
                    at, parts, size = [], [], 0
            if at:
                yield joined(batch, at, parts)

    return rows.mapInArrow(run, _schema(narrow, *names))


def _schema(narrow: DataFrame, *names: str) -> T.StructType:
    schema = T.StructType([narrow.schema["id"], T.StructField("mark", T.LongType())])
    for name in names:
        schema.add(name, T.LongType())
    return schema


def _runs(narrow: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(id, mark, run): the different runs of every row at the wanted anchors (id, mark, hash)."""
    lists = wanted.groupBy(F.col("id").alias("_id"), F.col("mark").alias("_mark")).agg(F.collect_set("hash").alias("wanted"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    rows = narrow.join(lists, same).select("id", "mark", "body", "wanted")

    def at_anchors(batch, i):
        asked, parts = batch.column(3)[i].values.to_numpy(), []
        for found in sliced(batch.column(2)[i].as_buffer(), words):
            hash_, first, last = _anchors(found, words)
            mine = np.flatnonzero(np.isin(hash_, asked))
            at = np.concatenate([np.arange(0), *(np.arange(first[k], last[k] + 1) for k in mine.tolist())])
            parts.append(hashes(found, at, at + words).view(np.int64))
        return np.unique(np.concatenate(parts))[None] if parts else None

    return _made(narrow, rows, at_anchors, "run")


def sharing(narrow: DataFrame, words: int) -> DataFrame:
    """(id, mark) of the rows (id, mark, body) that share a run of ``words`` words with another row."""
    if words < GRAM:
        raise ValueError(f"passages have at least {GRAM} words")
    order = Window.partitionBy("hash").orderBy("digest")
    before, after = F.lag("digest").over(order), F.lead("digest").over(order)
    met = _cut(narrow, words).withColumns({"before": before, "after": after})
    met = met.where("before IS NOT NULL OR after IS NOT NULL")
    equal = F.coalesce(F.col("before") == F.col("digest"), F.lit(False)) | F.coalesce(F.col("after") == F.col("digest"), F.lit(False))
    met = staged(met.select("id", "mark", "hash", equal.alias("equal")), "met_anchors")
    settled = F.max("equal").over(Window.partitionBy("id", "mark")).alias("settled")
    open_ = met.select("hash", settled).where("not settled").select("hash").distinct()
    runs = _runs(narrow, met.select("id", "mark", "hash").join(open_, "hash", "left_semi"), words)
    order = Window.partitionBy("run").orderBy("mark")
    several = F.lag("mark").over(order).isNotNull() | F.lead("mark").over(order).isNotNull()
    runs = runs.withColumn("several", several).where("several").select("id", "mark")
    return met.where("equal").select("id", "mark").unionByName(runs).distinct()
