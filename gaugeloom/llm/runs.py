"""Arrow batches cut and joined: by key, to fewer, and to smaller ones."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[int], most: int | None = None) -> Iterator[pa.Table]:
    """A table for each run of equal values in the key columns (integers without null).

    With ``most`` a run comes in several tables of that many rows, and of one batch's rows beyond it at most.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[begin] for c in columns)
            if held and (key != last or most and sum(x.num_rows for x in held) >= most):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a key in one partition, one after another."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def fewer(batches: Iterator[pa.RecordBatch], most_bytes: int = 4_000_000, most: int = 500) -> Iterator[pa.RecordBatch]:
    """The rows of many small batches in few, as each batch costs a message between the processes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most_bytes or len(held) >= most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def lots(batch: pa.RecordBatch, column: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``most_bytes`` of a text or binary column, whole rows each."""
    values = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = sizes.cumsum() // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(begin, end - begin)


def least_places(keys: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the least keys of all stretches of ``wide`` keys, the first of equal ones, and for each the first and
    the last stretch that it is the least of. Keys count by their upper 40 bits; there are fewer than 2^24."""
    count = len(keys) - wide + 1
    low = np.uint64((1 << 24) - 1)
    key = (keys & ~low) | np.arange(len(keys), dtype=np.uint64)
    padded = np.full(-(-len(key) // wide) * wide, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(key)] = key
    blocks = padded.reshape(-1, wide)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(right[:count], left[wide - 1 : wide - 1 + count])
    place = (least & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return place[first], first, np.concatenate([first[1:], [count]]) - 1
