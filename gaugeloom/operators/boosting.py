"""Boosting of several classes: one regression tree a class and round, on residuals that the classes share.

In each round the probabilities of all classes come from all margins, and each class's tree is fitted to its
Newton targets, residual over p(1 - p) with weight p(1 - p), so that a leaf holds the best step of its samples.
Margins are carried along in a stage table: a round reads what the one before wrote, whatever the number of trees. The
table also holds the targets and weights of all classes, so that the many scans of a fit do not make them anew.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.session import staged

#: Steps of leaves that hold nearly sure samples are cut to this.
LARGEST = 4.0
#: Bytes of a row group of staged samples: each task of an executor holds one.
GROUP_BYTES = 16_000_000
#: Least weight of a sample.
LEAST = 1e-9
_SPLIT = re.compile(r"\(feature (\d+) (<=|>) (\S+)\)")


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays; a leaf has feature -1."""

    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]

    def values(self, x: np.ndarray) -> np.ndarray:
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right = np.array(self.left), np.array(self.right)
        at = np.zeros(len(x), int)
        while (inner := np.flatnonzero(feature[at] >= 0)).size:
            node = at[inner]
            at[inner] = np.where(x[inner, feature[node]] <= threshold[node], left[node], right[node])
        return np.array(self.value)[at]


def read_tree(description: str) -> Tree:
    """The tree of a fitted model's ``toDebugString``."""
    lines = [line.strip() for line in description.splitlines()[1:] if line.strip()]
    tree, at = Tree([], [], [], [], []), 0

    def node() -> int:
        nonlocal at
        place = len(tree.feature)
        for part, value in ((tree.feature, -1), (tree.threshold, 0.0), (tree.left, -1), (tree.right, -1), (tree.value, 0.0)):
            part.append(value)
        line = lines[at]
        at += 1
        if line.startswith("Predict:"):
            tree.value[place] = float(line.split(":")[1])
            return place
        split = _SPLIT.search(line)
        tree.feature[place], tree.threshold[place] = int(split[1]), float(split[3])
        tree.left[place] = node()
        at += 1  # the line of the other branch
        tree.right[place] = node()
        return place

    node()
    return tree


@dataclass(frozen=True)
class SoftmaxBoosting:
    """Margins at the start, then for each round a tree of each class; losses round by round."""

    start: list[float]
    rate: float
    rounds: list[list[dict]]
    history: list[list[float]] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``, the class of the largest margin; batches go through numpy."""
        trees = [[Tree(**t) for t in r] for r in self.rounds]
        start, rate = np.array(self.start), self.rate

        @F.pandas_udf("double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                if batch.empty:
                    yield pd.Series([], dtype="float64")
                    continue
                x = np.stack(batch.to_numpy())
                margins = np.tile(start, (len(x), 1))
                for step in trees:
                    margins += _step(step, x, rate)
                yield pd.Series(margins.argmax(1).astype(float))

        flat = "X" if df.schema["X"].dataType.simpleString() == "array<double>" else F.flatten("X")
        return df.withColumn("prediction", run(flat))


def _step(trees: list[Tree], x: np.ndarray, rate: float) -> np.ndarray:
    """What a round adds to the margins; they keep their mean."""
    values = np.stack([np.clip(t.values(x), -LARGEST, LARGEST) for t in trees], axis=1)
    return rate * (len(trees) - 1) / len(trees) * (values - values.mean(1, keepdims=True))


def _moved(data: DataFrame, trees: list[Tree], rate: float) -> DataFrame:
    def run(batches):
        for batch in batches:
            x, now = (np.reshape(batch.column(c).flatten().to_numpy(zero_copy_only=False), (batch.num_rows, -1)) for c in ("x", "margins"))
            made = now + _step(trees, x, rate) if batch.num_rows else now
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * len(trees)
            margins = pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel(), pa.float64()))
            yield batch.set_column(batch.schema.get_field_index("margins"), "margins", margins)

    # Vectors stay vectors in what is staged; Arrow has them as plain arrays only.
    kept = data.select("x", "label", "held", "margins")
    moved = kept.mapInArrow(run, kept.schema)
    return moved.select(array_to_vector("x").alias("features"), "x", "label", "held", "margins")


def _with_targets(data: DataFrame, classes: int) -> DataFrame:
    """Add target and weight of each class, and the loss, all from the margins."""
    most = F.array_max("margins")
    parts = F.transform("margins", lambda m: F.exp(m - most))
    whole = F.aggregate("parts", F.lit(0.0), lambda a, b: a + b)
    data = data.withColumn("parts", parts).withColumn("whole", whole)
    made = {"loss": F.log("whole") + most - F.get(F.col("margins"), F.col("label"))}
    for k in range(classes):
        p = F.get(F.col("parts"), F.lit(k)) / F.col("whole")
        weight = F.greatest(p * (1 - p), F.lit(LEAST))
        made |= {f"target{k}": ((F.col("label") == k).cast("double") - p) / weight, f"weight{k}": weight}
    return data.select("features", "x", "label", "held", "margins", *[c.alias(name) for name, c in made.items()])


def fit_softmax_boosting(
    data: DataFrame,
    classes: int,
    rounds: int,
    first: int = 0,
    patience: int | None = None,
    keep_best: bool = False,
    rate: float = 0.3,
    depth: int = 4,
    seed: int = 0,
) -> SoftmaxBoosting:
    """Boost the frame ``features``, ``label`` (codes from 0), ``validation`` if some are held out.

    With ``keep_best`` the rounds after the ``first`` ones are watched: the trees up to the least held-out
    loss are kept, and ``patience`` rounds without a better one end the fit.
    """
    held = F.col("validation") if "validation" in data.columns else F.lit(False)
    rows = data.select("features", vector_to_array("features").alias("x"), F.col("label").cast("int").alias("label"), held.alias("held"))
    data = staged(rows, "boosting", GROUP_BYTES)
    counts = {r["label"]: r["count"] for r in data.where(~F.col("held")).groupBy("label").count().collect()}
    if not counts:
        raise ValueError("no samples to learn from")
    total = sum(counts.values())
    start = [float(np.log(max(counts.get(k, 0), 0.5) / total)) for k in range(classes)]
    data = staged(_with_targets(data.withColumn("margins", F.array(*map(F.lit, start))), classes), "boosting", GROUP_BYTES)
    made: list[list[dict]] = []
    history: list[list[float]] = []
    best, since, kept = np.inf, 0, rounds
    for n in range(1, rounds + 1):
        trees = []
        for k in range(classes):
            learn = data.where(~F.col("held")).select("features", F.col(f"target{k}").alias("target"), F.col(f"weight{k}").alias("weight"))
            tree = DecisionTreeRegressor(labelCol="target", weightCol="weight", maxDepth=depth, seed=seed).fit(learn)
            trees.append(read_tree(tree.toDebugString))
        data = staged(_with_targets(_moved(data, trees, rate), classes), "boosting", GROUP_BYTES)
        sums = data.agg(F.avg(F.when(~F.col("held"), F.col("loss"))).alias("loss"), F.avg(F.when(F.col("held"), F.col("loss"))).alias("held")).first()
        made.append([asdict(t) for t in trees])
        history.append([n, sums["loss"], float("nan") if sums["held"] is None else sums["held"]])
        if keep_best and n > first and sums["held"] is not None:
            since = 0 if sums["held"] < best else since + 1
            if sums["held"] < best:
                best, kept = sums["held"], n
            if patience is not None and since >= patience:
                break
    return SoftmaxBoosting(start, rate, made[:kept], history)
