"""Dense networks and support-vector regression, fitted by quasi-Newton steps over whole scans.

Each evaluation is one scan of the samples, staged as blocks: every task sums loss and gradient of its blocks, the sums are added up in a few tasks in a fixed order, and only those few rows reach the driver. So a fit does
not depend on how the samples are dealt out but for rounding, and its cost is epochs times one scan. Parameters live on the
driver: thousands, whatever the number of samples. The held-out loss comes from the same scan.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.session import small_batches, staged

#: Tasks in which the sums of all tasks are added up.
GROUPS = 8
#: Numbers in a block of staged samples.
BLOCK_VALUES = 16_384
#: Bytes of staged blocks that a task holds at a time: of a row group, and of a batch handed to Python.
HELD_BYTES = 4_000_000
#: Rows whose random cosines are made at a time, so that they stay in the processor's cache.
COSINE_ROWS = 128
#: Factors of the odd powers of h in sin(2 pi h), to double precision for |h| <= 1/4.
SINE = [(-1) ** k * (2 * np.pi) ** (2 * k + 1) / math.factorial(2 * k + 1) for k in range(10)]
MEMORY = 10
HALVINGS = 20
EPOCHS = 100


class Dense:
    """Layers of rectified units and a linear last one; squared loss of a value, or softmax over classes."""

    def __init__(self, layers: Sequence[int], classes: int = 0):
        self.layers, self.classes = tuple(layers), classes
        self.size = sum((a + 1) * b for a, b in zip(layers, layers[1:]))

    def start(self, seed: int) -> np.ndarray:
        draw = np.random.default_rng(seed)
        parts = []
        for a, b in zip(self.layers, self.layers[1:]):
            parts += [draw.normal(0, np.sqrt(2 / a), a * b), np.zeros(b)]
        return np.concatenate(parts)

    def _unpacked(self, w: np.ndarray):
        at = 0
        for a, b in zip(self.layers, self.layers[1:]):
            yield w[at : at + a * b].reshape(a, b), w[at + a * b : at + (a + 1) * b]
            at += (a + 1) * b

    def _forward(self, w, x):
        active, steps = [x], list(self._unpacked(w))
        for k, (weights, offset) in enumerate(steps):
            x = x @ weights + offset
            if k + 1 < len(steps):
                x = np.maximum(x, 0)
            active.append(x)
        return active, steps

    def predict(self, w: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = self._forward(w, x)[0][-1]
        return out.argmax(1).astype(float) if self.classes else out[:, 0]

    def losses(self, w: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return self._loss(self._forward(w, x)[0][-1], y)[0]

    def _loss(self, out, y):
        if not self.classes:
            away = out[:, 0] - y
            return away * away, 2 * away[:, None]
        shifted = out - out.max(1, keepdims=True)
        p = np.exp(shifted)
        total = p.sum(1, keepdims=True)
        rows, at = np.arange(len(y)), y.astype(int)
        slope = p / total
        slope[rows, at] -= 1
        return np.log(total[:, 0]) - shifted[rows, at], slope

    def batch(self, w: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        active, steps = self._forward(w, x)
        loss, slope = self._loss(active[-1], y)
        parts = []
        for k in range(len(steps) - 1, -1, -1):
            parts = [(active[k].T @ slope).ravel(), slope.sum(0), *parts]
            if k:
                slope = (slope @ steps[k][0].T) * (active[k] > 0)
        return float(loss.sum()), np.concatenate(parts)

    def penalty(self, w: np.ndarray) -> tuple[float, np.ndarray]:
        return 0.0, np.zeros(len(w))


class SupportVector:
    """Squared loss beyond ``epsilon`` with a penalty on the weights.

    ``rbf`` maps the inputs to random cosines whose products come near the Gaussian kernel of width ``gamma``;
    ``linear`` takes them as they are. The smooth form of the loss lets quasi-Newton steps find its one minimum.
    """

    def __init__(self, inputs: int, epsilon: float, ridge: float, kernel: str = "linear", cosines: int = 256, gamma: float | None = None, seed: int = 0):
        if kernel not in ("linear", "rbf"):
            raise ValueError(f"unknown kernel {kernel}")
        self.inputs, self.epsilon, self.ridge, self.kernel = inputs, epsilon, ridge, kernel
        self.classes = 0
        if kernel == "rbf":
            draw = np.random.default_rng(seed)
            self.turns = draw.normal(0, np.sqrt(2 * (gamma or 1 / inputs)), (inputs, cosines))
            self.shift = draw.uniform(0, 2 * np.pi, cosines)
        self.size = (cosines if kernel == "rbf" else inputs) + 1

    def start(self, seed: int) -> np.ndarray:
        return np.zeros(self.size)

    def _mapped(self, x: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """Stretches of the rows and their mapped inputs, which hold until the next stretch."""
        if self.kernel == "linear":
            yield slice(0, len(x)), x
            return
        turns, shift = self.turns / (2 * np.pi), self.shift / (2 * np.pi)
        factors = [f * np.sqrt(2 / len(shift)) for f in SINE]
        spaces = [np.empty((min(COSINE_ROWS, len(x)), len(shift))) for _ in range(3)]
        for start in range(0, len(x), COSINE_ROWS):
            here = slice(start, min(start + COSINE_ROWS, len(x)))
            yield here, _cosines(x[here], turns, shift, factors, [s[: here.stop - start] for s in spaces])

    def predict(self, w: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for here, z in self._mapped(x):
            out[here] = z @ w[:-1]
        return out + w[-1]

    def losses(self, w: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.maximum(np.abs(self.predict(w, x) - y) - self.epsilon, 0) ** 2

    def batch(self, w: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        loss, total = 0.0, np.zeros(self.size)
        for here, z in self._mapped(x):
            away = z @ w[:-1] + w[-1] - y[here]
            beyond = np.maximum(np.abs(away) - self.epsilon, 0)
            slope = 2 * beyond * np.sign(away)
            loss += float((beyond * beyond).sum())
            total[:-1] += slope @ z
            total[-1] += slope.sum()
        return loss, total

    def penalty(self, w: np.ndarray) -> tuple[float, np.ndarray]:
        return self.ridge * float(w[:-1] @ w[:-1]), np.append(2 * self.ridge * w[:-1], 0.0)


def _cosines(x, turns, shift, factors, spaces) -> np.ndarray:
    """Scaled cosines of x @ turns + shift, in whole turns, by the sine of what lacks to a quarter turn.

    ``np.cos`` on doubles is several times slower where numpy has no vector instructions for it.
    """
    h, square, out = spaces
    np.dot(x, turns, out=out)
    out += shift
    np.rint(out, out=h)
    np.subtract(out, h, out=h)
    np.abs(h, out=h)
    np.subtract(0.25, h, out=h)
    np.multiply(h, h, out=square)
    np.multiply(square, factors[-1], out=out)
    for factor in factors[-2:0:-1]:
        out += factor
        out *= square
    out += factors[0]
    out *= h
    return out


def _objective(kind: str, settings: dict):
    return {"dense": Dense, "support_vector": SupportVector}[kind](**settings)


@dataclass(frozen=True)
class GradientModel:
    """A fitted objective with the scales of inputs and target, and its losses epoch by epoch."""

    kind: str
    settings: dict
    weights: list[float]
    centre: list[float]
    scale: list[float]
    target_centre: float
    target_scale: float
    history: list[list[float]] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``; batches go through numpy."""
        made, w = _objective(self.kind, self.settings), np.array(self.weights)
        centre, scale = np.array(self.centre), np.array(self.scale)
        back = (0.0, 1.0) if made.classes else (self.target_centre, self.target_scale)

        @F.pandas_udf("double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                if batch.empty:
                    yield pd.Series([], dtype="float64")
                    continue
                x = (np.stack(batch.to_numpy()) - centre) / scale
                yield pd.Series(made.predict(w, x) * back[1] + back[0])

        flat = "X" if df.schema["X"].dataType.simpleString() == "array<double>" else F.flatten("X")
        return df.withColumn("prediction", run(flat))


def _scan(data: DataFrame, objective, w: np.ndarray, size: int) -> tuple[float, np.ndarray, float | None]:
    """Mean loss and gradient of the samples to learn from, and mean loss of those held out: one job over their blocks."""

    def partial(batches):
        sums = np.zeros(4 + objective.size)
        for batch in batches:
            for block in batch.column(0):
                numbers = np.frombuffer(block.as_buffer()).reshape(2 + size, -1)
                y, held, x = numbers[0], numbers[1] > 0, numbers[2:].T
                watched = held.any()
                loss, slope = objective.batch(w, x[~held], y[~held]) if watched else objective.batch(w, x, y)
                sums[:2] += (~held).sum(), loss
                sums[4:] += slope
                if watched:
                    sums[2:4] += held.sum(), objective.losses(w, x[held], y[held]).sum()
        yield _row(TaskContext.get().partitionId(), sums)

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
    sums = np.sum([np.array(r["sums"]) for r in rows], axis=0)
    n, held = max(sums[0], 1.0), sums[2]
    penalty, slope = objective.penalty(w)
    return sums[1] / n + penalty, sums[4:] / n + slope, sums[3] / held if held else None


def minimise(
    evaluate: Callable[[np.ndarray], tuple[float, np.ndarray, float | None]],
    w: np.ndarray,
    epochs: int,
    first: int = 0,
    patience: int | None = None,
    keep_best: bool = False,
) -> tuple[np.ndarray, list[list[float]]]:
    """Quasi-Newton steps with limited memory; the weights and rows (epoch, loss, held-out loss or NaN).

    An epoch is one accepted step. With ``keep_best`` the epochs after the ``first`` ones are watched: the
    weights of the least held-out loss are returned, and ``patience`` epochs without a better one end the fit.
    """
    loss, slope, _ = evaluate(w)
    history: list[list[float]] = []
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    best, chosen, since = np.inf, None, 0
    for epoch in range(1, epochs + 1):
        moved = None
        while moved is None:
            direction = _direction(slope, steps)
            downhill = float(slope @ direction)
            length = 1.0 if steps else min(1.0, 1 / max(np.abs(slope).max(), 1e-300))
            for _ in range(HALVINGS):
                there = evaluate(w + length * direction)
                if there[0] <= loss + 1e-4 * length * downhill:
                    moved = length * direction
                    break
                length /= 2
            if moved is None and not steps:
                break
            if moved is None:
                steps = []
        if moved is None:
            break
        turned = there[1] - slope
        if moved @ turned > 1e-12 * (turned @ turned):
            steps = [*steps, (moved, turned)][-MEMORY:]
        gain, w = loss - there[0], w + moved
        loss, slope, held = there
        history.append([epoch, float(loss), float("nan") if held is None else float(held)])
        if keep_best and epoch > first and held is not None:
            since = 0 if held < best else since + 1
            if held < best:
                best, chosen = held, w
            if patience is not None and since >= patience:
                break
        if gain <= 1e-12 * abs(loss) or np.abs(slope).max() < 1e-9:
            break
    return w if chosen is None else chosen, history


def _direction(slope: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Downhill by the curvature of the last steps."""
    q, pairs = -slope, []
    for s, y in reversed(steps):
        a = (s @ q) / (s @ y)
        q = q - a * y
        pairs.append((a, s, y))
    if steps:
        s, y = steps[-1]
        q = q * ((s @ y) / (y @ y))
    for a, s, y in reversed(pairs):
        q = q + s * (a - (y @ q) / (s @ y))
    return q


def _prepared(data: DataFrame, target_scaled: bool):
    """Scaled samples, written once as blocks, and the mean and spread of inputs and target."""
    held = F.col("validation") if "validation" in data.columns else F.lit(False)
    rows = data.select("label", held.alias("held"), "features")
    fit = rows.where(~F.col("held")).agg(
        Summarizer.metrics("mean", "variance").summary(F.col("features")).alias("m"),
        F.avg("label").alias("centre"),
        F.stddev_pop("label").alias("scale"),
        F.max("label").alias("most"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    if not fit.n:
        raise ValueError("no samples to learn from")
    spread = np.sqrt(fit.m.variance.toArray())
    scales = fit.m.mean.toArray(), np.where(spread > 0, spread, 1.0)
    target = (fit.centre, fit.scale or 1.0) if target_scaled else (0.0, 1.0)
    return _blocks(rows, *scales, *target), (*scales, *target), int(fit.n), fit.most


def _blocks(rows: DataFrame, centre: np.ndarray, scale: np.ndarray, y_centre: float, y_scale: float) -> DataFrame:
    """Stage scaled samples as blocks of doubles: targets, marks of those held out, then input after input.

    A scan hands a block to Python in one copy; single numbers would take most of its time. A block is one row, and
    Spark reads and hands over thousands of rows at a time, so row groups and batches are bounded by bytes.
    """
    size = len(centre)
    step = max(1, BLOCK_VALUES // (2 + size))

    def pack(batches):
        for batch in batches:
            numbers = np.empty((2 + size, batch.num_rows))
            numbers[0] = (batch.column(0).to_numpy(zero_copy_only=False) - y_centre) / y_scale
            numbers[1] = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            numbers[2:] = ((x - centre) / scale).T
            blocks = [numbers[:, at : at + step].tobytes() for at in range(0, batch.num_rows, step)]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], names=["block"])

    return staged(rows.select("label", "held", vector_to_array("features").alias("x")).mapInArrow(pack, "block binary"), "gradient", HELD_BYTES)


def _fitted(data, kind, settings, scales, seed, epochs, first, patience, keep_best):
    objective = _objective(kind, settings)
    w, history = minimise(
        lambda at: _scan(data, objective, at, len(scales[0])), objective.start(seed), epochs, first, patience, keep_best
    )
    centre, scale, y_centre, y_scale = scales
    if not objective.classes:  # losses in the target's own units
        history = [[e, a * y_scale**2, b * y_scale**2] for e, a, b in history]
    return GradientModel(kind, settings, w.tolist(), centre.tolist(), scale.tolist(), y_centre, y_scale, history)


def fit_dense(
    data: DataFrame,
    classes: int = 0,
    layers: Sequence[int] = (16, 16),
    epochs: int = EPOCHS,
    first: int = 0,
    patience: int | None = None,
    keep_best: bool = False,
    seed: int = 0,
) -> GradientModel:
    """A network of the frame ``features``, ``label``, ``validation`` if some are held out; ``layers`` are the hidden ones."""
    data, scales, _, _ = _prepared(data, not classes)
    settings = {"layers": [len(scales[0]), *layers, classes or 1], "classes": classes}
    return _fitted(data, "dense", settings, scales, seed, epochs, first, patience, keep_best)


def fit_support_vector(
    data: DataFrame,
    epsilon: float = 0.1,
    cost: float = 1.0,
    kernel: str = "rbf",
    cosines: int = 256,
    gamma: float | None = None,
    epochs: int = EPOCHS,
    first: int = 0,
    patience: int | None = None,
    keep_best: bool = False,
    seed: int = 0,
) -> GradientModel:
    """Support-vector regression; ``epsilon`` in units of the target, ``gamma`` of inputs of unit spread (1 / inputs)."""
    data, scales, n, _ = _prepared(data, True)
    settings = {
        "inputs": len(scales[0]),
        "epsilon": epsilon / scales[3],
        "ridge": 1 / (2 * cost * n),
        "kernel": kernel,
        "cosines": cosines,
        "gamma": gamma,
        "seed": seed,
    }
    return _fitted(data, "support_vector", settings, scales, seed, epochs, first, patience, keep_best)
