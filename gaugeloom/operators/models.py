"""Training on sample windows with Spark ML, and two discriminant classifiers."""

from __future__ import annotations

import json
import math
import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    MultilayerPerceptronClassifier,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.operators.boosting import SoftmaxBoosting, fit_softmax_boosting
from gaugeloom.operators.gradient import GradientModel, fit_dense, fit_support_vector
from gaugeloom.operators.split import validation_tail
from gaugeloom.operators.value_boosting import ValueBoosting, fit_value_boosting
from gaugeloom.session import staged

SEED = 2020
# Share held out for validation, and epochs trained before early stopping may act.
VALIDATION_SHARE = 0.25
FIRST_EPOCHS = 10
#: Rounds of boosting if none are given.
ROUNDS = 20
CLASSIFIERS_ONLY = ["lda", "qda"]
REGRESSORS = ["dt", "rf", "xgboost", "linear", "svm", "dnn"]
STOPPABLE = ["xgboost", "dnn"]
#: Methods that scan the samples many times, with results that do not depend on how these are dealt to tasks but for
#: rounding. Trees pick the borders they try by samples of each task, so theirs are not dealt anew without need.
ITERATED = ["svm", "dnn"]
TREES = ["dt", "rf", "xgboost"]
#: Spark's names of what this library's boosting of values can be told; with others Spark fits it.
BOOSTED = {"stepSize": "rate", "maxDepth": "depth", "maxBins": "bins"}
#: Most input values that a task holds while trees grow: Spark keeps the samples as objects, far larger than their files.
TASK_VALUES = 8_000_000
#: Bytes of a row group of staged windows: each task of an executor holds one.
GROUP_BYTES = 16_000_000
#: Samples, and time of a scan as a multiple of that of even tasks, from which samples scanned many times are dealt anew.
EVEN_SAMPLES = 1_000_000
UNEVEN = 1.2


def to_vectors(samples: DataFrame, output: int = 0) -> DataFrame:
    """Add ``features``, the flattened window as a vector, and ``label``, one value of ``y``."""
    flat = "X" if samples.schema["X"].dataType.simpleString() == "array<double>" else F.flatten("X")
    df = samples.withColumn("features", array_to_vector(flat))
    return df.withColumn("label", F.col("y")[output]) if "y" in df.columns else df


@dataclass(frozen=True)
class Discriminant:
    """Linear (one shared covariance) or quadratic discriminant: moments per class."""

    classes: list[float]
    log_prior: list[float]
    means: list[list[float]]
    precisions: list[list[list[float]]]
    log_dets: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``, the class of the highest posterior; batches go through numpy."""
        classes, prior = np.array(self.classes), np.array(self.log_prior)
        means, precisions, dets = np.array(self.means), np.array(self.precisions), np.array(self.log_dets)

        @F.pandas_udf("double")
        def classify(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                if batch.empty:
                    yield pd.Series([], dtype="float64")
                    continue
                x = np.stack(batch.to_numpy())
                scores = [
                    k - 0.5 * (d + np.einsum("ij,jk,ik->i", x - m, s, x - m))
                    for k, m, s, d in zip(prior, means, precisions, dets)
                ]
                yield pd.Series(classes[np.argmax(np.stack(scores, axis=1), axis=1)])

        flat = "X" if df.schema["X"].dataType.simpleString() == "array<double>" else F.flatten("X")
        return df.withColumn("prediction", classify(flat))


def fit_discriminant(samples: DataFrame, quadratic: bool) -> Discriminant:
    """Counts and means of all classes in one scan, products about the means in a second.

    Only moments reach the driver. The quadratic kind holds features squared numbers per class there and
    in every task, so its classes are bounded by memory; the linear kind holds one such matrix for all.
    """
    df = to_vectors(samples).select("features", "label")
    moments = df.groupBy("label").agg(F.count("*").alias("count"), Summarizer.mean(F.col("features")).alias("mean"))
    counts = moments.orderBy("label").collect()
    total = sum(r["count"] for r in counts)
    means = [r["mean"].toArray() for r in counts]
    products = _centred_products(df, [r.label for r in counts], means, quadratic)
    if quadratic:
        covariances = [p / max(r["count"] - 1, 1) for p, r in zip(products, counts)]
    else:
        covariances = [products[0] / max(total - len(counts), 1)] * len(counts)
    spectra = [np.linalg.eigvalsh(c) for c in covariances]
    floors = [s.max() * 1e-10 if s.size else 0.0 for s in spectra]
    return Discriminant(
        [r.label for r in counts],
        [float(np.log(r["count"] / total)) for r in counts],
        [m.tolist() for m in means],
        [np.linalg.pinv(c, rcond=1e-10, hermitian=True).tolist() for c in covariances],
        [float(np.log(s[s > f]).sum()) if quadratic else 0.0 for s, f in zip(spectra, floors)],
    )


def _centred_products(df: DataFrame, labels: list, means: list[np.ndarray], by_class: bool) -> list[np.ndarray]:
    """Sums of products of the features about their class means, per class or over all: one scan."""
    place, centre = {label: i for i, label in enumerate(labels)}, np.array(means)
    size = centre.shape[1]

    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            at = np.array([place[v] for v in batch.column(1).to_pylist()])
            x = x - centre[at]
            for i in np.unique(at).tolist() if by_class else [0]:
                part = x[at == i] if by_class else x
                sums[i] = sums.get(i, 0.0) + part.T @ part
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int64()), pa.array([m.ravel() for m in sums.values()], pa.list_(pa.float64()))],
                names=["i", "products"],
            )

    def total(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[i] = sums.get(i, 0.0) + row.values.to_numpy()
        if sums:
            columns = [pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "products"])

    flat = df.select(vector_to_array("features").alias("x"), "label")
    schema = "i long, products array<double>"
    rows = flat.mapInArrow(partial, schema).repartition("i").mapInArrow(total, schema).collect()
    found = {r.i: np.array(r.products).reshape(size, size) for r in rows}
    return [found.get(i, np.zeros((size, size))) for i in range(len(labels) if by_class else 1)]


def _estimator(method, classification, n_classes, n_inputs, params):
    seed = {"seed": SEED}
    if method == "dt":
        return (DecisionTreeClassifier if classification else DecisionTreeRegressor)(**seed, **params)
    if method == "rf":
        return (RandomForestClassifier if classification else RandomForestRegressor)(**seed, **params)
    if method == "xgboost":
        return (GBTClassifier if classification else GBTRegressor)(**seed, **params)
    if method == "svm":
        machine = LinearSVC(**params)
        return OneVsRest(classifier=machine) if n_classes > 2 else machine
    if method == "dnn":
        layers = [n_inputs, *params.pop("layers", [16, 16]), n_classes]
        return MultilayerPerceptronClassifier(layers=layers, **seed, **params)
    return LinearRegression(**params)


def train(
    samples: DataFrame,
    learning_method: str,
    classification: bool = False,
    output: int = 0,
    n_epochs: int | None = None,
    early_stopping: bool = False,
    patience: int | None = None,
    series: Sequence[str] = (),
    order: Sequence[str] = ("idx",),
    **params,
) -> Transformer | Discriminant | GradientModel | SoftmaxBoosting | ValueBoosting:
    """Fit one output of the train windows.

    ``dt``, ``rf`` and ``xgboost`` are tree models, ``linear`` a linear model of values, ``dnn`` a dense
    network, ``svm`` a support-vector machine: linear for classes, of ``kernel`` rbf or linear for values.
    ``lda`` and ``qda`` need classes; classes are given as codes from 0. ``n_epochs`` is the number of rounds
    or iterations. With early stopping ``xgboost`` and ``dnn`` train ten epochs more first, watch the last
    quarter of the samples and end when their loss has not improved for ``patience`` epochs, or at the last
    one without ``patience``. ``dnn`` and boosting of more than two classes return what had the least loss;
    ``training_history`` gives their losses. The other methods have no epochs to stop at and say so.
    Networks are fitted to all samples at once, so there is no batch size, and they have no kernels.
    """
    known = REGRESSORS + CLASSIFIERS_ONLY
    if learning_method not in known:
        raise NotImplementedError(f"learning method {learning_method}; known are {known}")
    if learning_method in CLASSIFIERS_ONLY and not classification:
        raise ValueError(f"{learning_method} needs a classification target")
    if learning_method == "linear" and classification:
        raise ValueError("linear is for values")
    stops = early_stopping and learning_method in STOPPABLE
    if early_stopping and not stops:
        warnings.warn(f"{learning_method} has no early stopping; it is trained in full", stacklevel=2)
    if "part" in samples.columns:
        samples = samples.where(F.col("part") == "train")
    if learning_method in ("lda", "qda"):
        return fit_discriminant(samples, learning_method == "qda")
    made = learning_method in ITERATED and (stops or not classification)
    if made:
        # Windows are made once; the scans that follow read them from the shared folder.
        keys = [c for c in dict.fromkeys([*series, *order]) if stops]
        samples = staged(samples.select(*keys, "X", "y"), "train_windows", GROUP_BYTES)
    if stops:
        samples = validation_tail(samples, VALIDATION_SHARE, series, order)
    if n_epochs and learning_method not in ("dt", "rf"):
        params["maxIter"] = FIRST_EPOCHS + n_epochs if stops else n_epochs
    data = to_vectors(samples, output)
    kept = ["features", "label", *(["validation"] if stops else [])]
    data = data.select(*kept)
    if classification and not made:
        data = staged(data, "samples")
    n_classes = int(data.agg(F.max("label")).first()[0]) + 1 if classification else 0
    if learning_method in STOPPABLE + ["svm"]:
        model = _by_epochs(data, learning_method, n_classes, stops, patience, dict(params))
        if model is not None:
            return model
    if learning_method in TREES and classification:
        data = _spread(data)
    n_inputs = data.first().features.size if learning_method == "dnn" else 0
    estimator = _estimator(learning_method, classification, n_classes, n_inputs, dict(params))
    if learning_method == "dnn":
        data = _even(data, estimator.getBlockSize())
    if not stops:
        return estimator.fit(data)
    model = estimator.fit(data.where("not validation"))
    held = data.where("validation")
    losses = model.evaluateEachIteration(held) if classification else model.evaluateEachIteration(held, "squared")
    rounds = patient_rounds(losses, FIRST_EPOCHS, patience)
    if rounds == len(losses):
        return model
    return estimator.copy({estimator.maxIter: rounds}).fit(data.where("not validation"))


def _spread(data: DataFrame) -> DataFrame:
    """Staged samples dealt over more tasks if one would hold more than ``TASK_VALUES`` input values on average.

    The files of a stage table are small for the rows they hold, so one task may be given very many samples.
    """
    first = data.select("features").first()
    needed = math.ceil(data.count() * first.features.size / TASK_VALUES) if first else 0
    return data.repartition(needed) if needed > data.rdd.getNumPartitions() else data


def _even(data: DataFrame, block: int) -> DataFrame:
    """Staged samples dealt evenly over the cores, if many cores would wait for a few tasks in every scan.

    Spark packs the files of a stage table into tasks by their bytes, often into a few tasks more than there are cores,
    and each scan then takes a second round for these. Only whole blocks of ``block`` samples of a task move, and its
    incomplete last one stays the last of a task: Spark's network gives each block one weight, whatever its size.
    """
    found = data.select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    total = sum(r["count"] for r in found)
    if total < EVEN_SAMPLES:
        return data
    cores = data.sparkSession.sparkContext.defaultParallelism
    tasks, most = max(r.task for r in found) + 1, max(r["count"] for r in found)
    rounds = math.ceil(tasks / cores)
    if min(rounds * most, total / cores + most) <= UNEVEN * total / cores:
        return data
    whole = np.zeros(tasks, np.int64)
    for r in found:
        whole[r.task] = r["count"] // block
    before = np.cumsum(whole) - whole
    task, row = F.shiftright("_place", 33).cast("int"), F.col("_place").bitwiseAND((1 << 33) - 1)
    number = F.floor(row / block)
    dealt = (F.get(F.lit(before), task) + number) % (rounds * cores)
    data = data.withColumn("_place", F.monotonically_increasing_id())
    data = data.withColumn("_last", number >= F.get(F.lit(whole), task))
    data = data.withColumn("_to", F.when(F.col("_last"), task).otherwise(dealt).cast("int"))
    data = data.repartitionById(rounds * cores, "_to").sortWithinPartitions("_last", "_place")
    return data.drop("_place", "_last", "_to")


def _by_epochs(data, method, n_classes, stops, patience, params):
    """The methods that this library steps through itself; None for those that Spark fits in one call."""
    watch = {"first": FIRST_EPOCHS, "patience": patience, "keep_best": True} if stops else {}
    epochs = params.pop("maxIter", None)
    if method == "dnn" and (stops or not n_classes):
        return fit_dense(data, n_classes, **({"epochs": epochs} if epochs else {}), **watch, seed=SEED, **params)
    if method == "svm" and not n_classes:
        return fit_support_vector(data, **({"epochs": epochs} if epochs else {}), seed=SEED, **params)
    if method == "xgboost" and not n_classes and set(params) <= set(BOOSTED):
        named = {BOOSTED[name]: value for name, value in params.items()}
        model = fit_value_boosting(data, epochs or ROUNDS, **named, seed=SEED)
        if not stops:
            return model
        return model.first(patient_rounds(model.losses(data)[1], FIRST_EPOCHS, patience))
    if method == "xgboost" and n_classes > 2:
        return fit_softmax_boosting(data, n_classes, epochs or ROUNDS, **watch, seed=SEED, **params)
    return None


def patient_rounds(losses: Sequence[float], first: int, patience: int | None) -> int:
    """Rounds until the loss has not improved for ``patience`` rounds, not counting the ``first`` ones."""
    best, since = float("inf"), 0
    for n, loss in enumerate(losses, 1):
        if n <= first or patience is None:
            continue
        best, since = (loss, 0) if loss < best else (best, since + 1)
        if since >= patience:
            return n
    return len(losses)


#: Models that are plain data; they are saved as one row.
PLAIN = (Discriminant, GradientModel, SoftmaxBoosting, ValueBoosting)


@dataclass(frozen=True)
class MultiOutput:
    """One model per target step."""

    models: list


def train_outputs(samples: DataFrame, learning_method: str, n_outputs: int, **options):
    """A model of each target step; a single step gives the model itself."""
    fitted = [train(samples, learning_method, output=i, **options) for i in range(n_outputs)]
    return fitted[0] if n_outputs == 1 else MultiOutput(fitted)


def predict(model, samples: DataFrame, out: str = "predicted") -> DataFrame:
    """Add the model's prediction of each window; several target steps give an array."""
    if isinstance(model, MultiOutput):
        steps = [f"_step{i}" for i in range(len(model.models))]
        for name, one in zip(steps, model.models):
            samples = predict(one, samples, name)
        return samples.withColumn(out, F.array(*steps)).drop(*steps)
    if isinstance(model, PLAIN):
        return model.transform(samples).withColumnRenamed("prediction", out)
    kept = [c for c in samples.columns if c != out]
    vectors = to_vectors(samples)
    return model.transform(vectors).select(*kept, F.col("prediction").alias(out))


def training_history(spark: SparkSession, model) -> DataFrame:
    """Loss of a network or of boosting of several classes after each epoch, on train and on held-out samples."""
    rows = [(int(e), float(a), None if np.isnan(b) else float(b)) for e, a, b in model.history]
    return spark.createDataFrame(rows, "epoch long, loss double, val_loss double")


def boosting_history(model, samples: DataFrame) -> DataFrame:
    """Loss of a boosted regressor after each round, on train and on held-out samples."""
    data = to_vectors(samples)
    if isinstance(model, ValueBoosting):
        losses = model.losses(data)
    else:
        losses = [
            model.evaluateEachIteration(data.where(held), "squared")
            for held in (~F.col("validation"), F.col("validation"))
        ]
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(*losses))]
    return samples.sparkSession.createDataFrame(rows, "epoch long, loss double, val_loss double")


def model_kind(model) -> str:
    """Class name of a model; of several, their names as a JSON list."""
    if isinstance(model, MultiOutput):
        return json.dumps([model_kind(one) for one in model.models])
    return type(model).__name__


def save_model(spark: SparkSession, model, path: str) -> None:
    """Persist a fitted model in the shared folder."""
    if isinstance(model, MultiOutput):
        for i, one in enumerate(model.models):
            save_model(spark, one, f"{path}/{i}")
    elif isinstance(model, PLAIN):
        row = [(json.dumps(model.__dict__),)]
        spark.createDataFrame(row, "model string").write.mode("errorifexists").json(path)
    elif isinstance(model, OneVsRestModel):
        model.write().save(path)
    else:
        PipelineModel([model]).write().save(path)


def load_model(spark: SparkSession, path: str, kind: str):
    """Load what ``save_model`` wrote; ``kind`` is what ``model_kind`` said of the model."""
    if kind.startswith("["):
        return MultiOutput([load_model(spark, f"{path}/{i}", k) for i, k in enumerate(json.loads(kind))])
    if kind in (plain := {c.__name__: c for c in PLAIN}):
        return plain[kind](**json.loads(spark.read.schema("model string").json(path).first().model))
    return OneVsRestModel.load(path) if kind == "OneVsRestModel" else PipelineModel.load(path)


