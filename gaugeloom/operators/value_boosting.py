"""Boosting of values by regression trees on counts of bins, the way Spark's gradient boosting grows them.

Samples are staged as blocks: the bin of each input in a byte, the target and what the trees predict so far. A level of a
tree is one scan, in which each task counts and sums the residuals of its blocks by node, input and bin; only these sums
reach the driver, which picks the splits. A round ends with a scan that writes the blocks with new predictions. So a
task holds a few megabytes whatever the number of samples, where Spark keeps all samples as objects in memory or on disk.

As in Spark: borders lie at equal steps of the sorted values of a sample of at least 10,000 rows, or between all values if
they are few; the first tree counts whole, the others by the rate; a residual is twice the difference; of equal gains the
first input and the lowest border win.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.operators.boosting import Tree
from gaugeloom.session import drop_staged, small_batches, staged

#: Samples of a block, and bytes of blocks that a task holds at a time.
BLOCK_ROWS = 4096
HELD_BYTES = 4_000_000
#: Tasks in which the sums of all tasks are added up.
GROUPS = 8
#: Least rows from which borders are chosen.
SAMPLED = 10_000


@dataclass(frozen=True)
class ValueBoosting:
    """Trees, each with its weight."""

    trees: list[dict]
    weights: list[float]
    history: list[list[float]] = field(default_factory=list)

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def first(self, rounds: int) -> ValueBoosting:
        return ValueBoosting(self.trees[:rounds], self.weights[:rounds], self.history[:rounds])

    def steps(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """What each round adds to the predictions."""
        for tree, weight in zip(self.trees, self.weights):
            yield Tree(**tree).values(x) * weight

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``; batches go through numpy."""

        @F.pandas_udf("double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                x = np.stack(batch.to_numpy()) if len(batch) else np.empty((0, 1))
                yield pd.Series(sum(self.steps(x), np.zeros(len(x))), dtype="float64")

        flat = "X" if df.schema["X"].dataType.simpleString() == "array<double>" else F.flatten("X")
        return df.withColumn("prediction", run(flat))

    def losses(self, data: DataFrame) -> tuple[list[float], list[float]]:
        """Mean squared error after each round, of samples to learn from and of those held out: one scan."""
        rounds = len(self.trees)

        def run(batches):
            sums, counts = np.zeros((2, rounds)), np.zeros(2)
            for batch in batches:
                x, y, held = _numbers(batch)
                out = np.zeros(len(y))
                for n, step in enumerate(self.steps(x)):
                    out = out + step
                    error = (y - out) ** 2
                    sums[0, n] += error[~held].sum()
                    sums[1, n] += error[held].sum()
                counts += (~held).sum(), held.sum()
            yield pa.RecordBatch.from_arrays([pa.array([np.append(sums.ravel(), counts)], pa.list_(pa.float64()))], names=["sums"])

        found = _plain(data).mapInArrow(run, "sums array<double>").collect()
        total = np.sum([r.sums for r in found], axis=0)
        sums, counts = total[:-2].reshape(2, rounds), total[-2:]
        return tuple((s / n if n else np.full(rounds, np.nan)).tolist() for s, n in zip(sums, counts))


def _plain(data: DataFrame) -> DataFrame:
    held = F.col("validation") if "validation" in data.columns else F.lit(False)
    return data.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"), held.alias("held"))


def _numbers(batch):
    x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    y = batch.column(1).to_numpy(zero_copy_only=False)
    if not (np.isfinite(x).all() and np.isfinite(y).all()):
        raise ValueError("labels and inputs must not be null, NaN or infinite")
    return x, y, batch.column(2).to_numpy(zero_copy_only=False).astype(bool)


def borders(values: np.ndarray, most: int, total: float) -> np.ndarray:
    """At most ``most`` borders between the values: all if these are few, else at equal steps of their counts.

    ``total`` is the size that the sample was to have; what it has less counts as zeros, as in Spark.
    """
    known, counts = np.unique(values[values != 0], return_counts=True)
    counts = counts.astype(float)
    if not len(known):
        return known
    lacking = total - counts.sum()
    if lacking > np.finfo(float).eps * counts.sum() * 100:
        at = int(np.searchsorted(known, 0.0))
        known, counts = np.insert(known, at, 0.0), np.insert(counts, at, lacking)
    middles = (known[:-1] + known[1:]) / 2
    if len(middles) <= most:
        return middles
    stride = total / (most + 1)
    found, reached, target = [], counts[0], stride
    for i in range(1, len(known)):
        before, reached = reached, reached + counts[i]
        if abs(before - target) < abs(reached - target):
            found.append(middles[i - 1])
            target += stride
    return np.array(found)


def _drawn(data: DataFrame, share: float, seed: int) -> np.ndarray:
    """Inputs of a share of the samples, those that Spark's trees draw for their borders."""
    if share < 1:
        spark = data.sparkSession
        draw = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom(seed)
        rows = data._jdf.rdd().sample(False, share, draw.nextInt())
        data = DataFrame(spark._jsparkSession.createDataFrame(rows, data._jdf.schema()), spark)
    return np.stack(data.select(vector_to_array("features").alias("x")).toPandas()["x"].to_numpy())


def _blocks(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """Stage samples as blocks: targets, predictions, then bins input after input."""

    def pack(batches):
        for batch in batches:
            x, y, _ = _numbers(batch)
            bins = np.empty((len(cuts), len(y)), np.uint8)
            for i, cut in enumerate(cuts):
                bins[i] = np.searchsorted(cut, x[:, i])
            yield _packed([(y[at], np.zeros_like(y[at]), bins[:, at]) for at in _stretches(len(y))])

    return staged(rows.mapInArrow(pack, "block binary"), "value_boosting", HELD_BYTES)


def _stretches(rows: int) -> list[slice]:
    return [slice(at, at + BLOCK_ROWS) for at in range(0, rows, BLOCK_ROWS)]


def _packed(blocks) -> pa.RecordBatch:
    parts = [y.tobytes() + out.tobytes() + bins.tobytes() for y, out, bins in blocks]
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], names=["block"])


def _unpacked(block, inputs: int):
    buffer = block.as_buffer()
    rows = buffer.size // (16 + inputs)
    numbers = np.frombuffer(buffer, np.float64, 2 * rows).reshape(2, rows)
    bins = np.frombuffer(buffer, np.uint8, offset=16 * rows).reshape(inputs, rows)
    return numbers[0], numbers[1], bins


class _Grown:
    """A tree while it grows: nodes with a split on bins, or values."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right, self.value = [], [], [], [], []
        self.depth = 0
        self.add(0.0)

    def add(self, value: float) -> int:
        for part, v in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.value, value)):
            part.append(v)
        return len(self.feature) - 1

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node that each sample has come to."""
        rows = bins.shape[1]
        at, flat, place = np.zeros(rows, np.int64), bins.ravel(), np.arange(rows)
        feature, inner = np.array(self.feature), np.array(self.feature) >= 0
        begin = np.where(inner, feature, 0) * rows
        border = np.where(inner, self.bin, 255).astype(np.uint8)
        left = np.where(inner, self.left, np.arange(len(feature)))  # the right one follows; leaves stay where they are
        for _ in range(self.depth):
            at = left[at] + (flat[begin[at] + place] > border[at])
        return at

    def tree(self, cuts: list[np.ndarray]) -> Tree:
        threshold = [float(cuts[f][b]) if f >= 0 else 0.0 for f, b in zip(self.feature, self.bin)]
        return Tree(self.feature, threshold, self.left, self.right, self.value)


def _level(data: DataFrame, grown: _Grown, nodes: list[int], first: bool, width: list[int]) -> np.ndarray:
    """Counts and sums of residuals of the nodes by input and bin: one scan."""
    place = np.full(len(grown.feature), -1)
    place[nodes] = np.arange(len(nodes))
    inputs, wide = len(width), max(width)
    size = len(nodes) * wide

    def partial(batches):
        sums = np.zeros((2, inputs, size))
        for batch in batches:
            for block in batch.column(0):
                y, out, bins = _unpacked(block, inputs)
                at = place[grown.leaves(bins)]
                if (at < 0).any():
                    kept = np.flatnonzero(at >= 0)
                    at, y, out, bins = at[kept], y[kept], out[kept], bins[:, kept]
                if not len(at):
                    continue
                residual = y if first else 2 * (y - out)
                base, key = at * wide, np.empty(len(at), np.int64)
                for i in range(inputs):
                    np.add(base, bins[i], out=key)
                    sums[0, i] += np.bincount(key, minlength=size)
                    sums[1, i] += np.bincount(key, residual, minlength=size)
        yield _row(TaskContext.get().partitionId(), sums.ravel())

    def _row(task, sums):
        columns = [pa.array([task % GROUPS], pa.int32()), pa.array([task], pa.int32()), pa.array([sums], pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(columns, names=["part", "task", "sums"])

    def total(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, row in zip(batch.column(0).to_pylist(), batch.column(2)):
                sums[part] = sums.get(part, 0.0) + row.values.to_numpy()
        for part, values in sums.items():
            yield _row(part, values)

    schema = "part int, task int, sums array<double>"
    added = data.mapInArrow(partial, schema).repartition(GROUPS, "part").sortWithinPartitions("part", "task").mapInArrow(total, schema)
    with small_batches(data.sparkSession, HELD_BYTES):
        rows = sorted(added.collect(), key=lambda r: r.part)
    return np.sum([np.array(r["sums"]) for r in rows], axis=0).reshape(2, inputs, len(nodes), wide)


def _split(counts: np.ndarray, sums: np.ndarray, width: list[int]):
    """The split of most gain in the squares of a node: gain, input, bin, counts and sums of both sides."""
    n, s = counts[0].sum(), sums[0].sum()
    best = None
    for i, wide in enumerate(width):
        nl, sl = counts[i, : wide - 1].cumsum(), sums[i, : wide - 1].cumsum()
        nr, sr = n - nl, s - sl
        some = (nl > 0) & (nr > 0)
        if not some.any():
            continue
        gain = np.full(wide - 1, -np.inf)
        gain[some] = (sl[some] ** 2 / nl[some] + sr[some] ** 2 / nr[some] - s * s / n) / n
        b = int(gain.argmax())
        if best is None or gain[b] > best[0]:
            best = gain[b], i, b, (nl[b], sl[b]), (nr[b], sr[b])
    return best


def _grow(data: DataFrame, cuts: list[np.ndarray], first: bool, depth: int) -> _Grown:
    width = [len(c) + 1 for c in cuts]
    grown, nodes = _Grown(), [0]
    for level in range(max(depth, 1)):
        sums = _level(data, grown, nodes, first, width)
        if not level:
            grown.value[0] = float(sums[1, 0, 0].sum() / sums[0, 0, 0].sum())
        following = []
        for k, node in enumerate(nodes):
            found = _split(sums[0][:, k], sums[1][:, k], width)
            if level >= depth or found is None or found[0] <= 0:
                continue
            _, grown.feature[node], grown.bin[node], (nl, sl), (nr, sr) = found
            grown.left[node], grown.right[node] = grown.add(float(sl / nl)), grown.add(float(sr / nr))
            following += [child for child, n in ((grown.left[node], nl), (grown.right[node], nr)) if n > 1]
        grown.depth += any(f >= 0 for f in (grown.feature[node] for node in nodes))
        nodes = following
        if not nodes:
            break
    return grown


def _moved(data: DataFrame, grown: _Grown, weight: float, inputs: int) -> DataFrame:
    values = np.array(grown.value)

    def run(batches):
        for batch in batches:
            for block in batch.column(0):
                y, out, bins = _unpacked(block, inputs)
                yield _packed([(y, out + values[grown.leaves(bins)] * weight, bins)])

    with small_batches(data.sparkSession, HELD_BYTES):
        return staged(data.mapInArrow(run, "block binary"), "value_boosting", HELD_BYTES)


def fit_value_boosting(data: DataFrame, rounds: int, rate: float = 0.1, depth: int = 5, bins: int = 32, seed: int = 0) -> ValueBoosting:
    """Boost the frame ``features``, ``label``; those marked ``validation``, if any, are not learnt from."""
    rows = _plain(data)
    learn = rows.where(~F.col("held"))
    n = learn.count()
    if not n:
        raise ValueError("no samples to learn from")
    share = min(1.0, max(bins * bins, SAMPLED) / n)
    kept = data.where(~F.col("validation")) if "validation" in data.columns else data
    sample = _drawn(kept.select("label", "features"), share, seed)
    cuts = [borders(sample[:, i], min(bins, n) - 1, share * n) for i in range(sample.shape[1])]
    data = _blocks(learn, cuts)
    trees, weights = [], []
    for m in range(rounds):
        grown, weight = _grow(data, cuts, not m, depth), rate if m else 1.0
        trees.append(asdict(grown.tree(cuts)))
        weights.append(weight)
        if m + 1 < rounds:
            before, data = data, _moved(data, grown, weight, len(cuts))
            drop_staged(before)
    drop_staged(data)
    return ValueBoosting(trees, weights)
