"""From raw rows to a finished sensor, and from a finished sensor to predictions."""

from __future__ import annotations

import json
import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.functions.columns import above, argmax
from gaugeloom.operators import clean, encode, evaluate, features, models, profiling, registry
from gaugeloom.operators.scale import Scaler, apply_scaler, invert_scaler, scale_in_out
from gaugeloom.operators.split import split_rows, split_series
from gaugeloom.operators.windows import shuffle_samples, windows, x_windows
from gaugeloom.session import new_table_path, staged
from gaugeloom.sources.tables import write_metrics, write_profile, write_table


# Variables, correlations and messages.
Profile = tuple[DataFrame, DataFrame, DataFrame]


@dataclass(frozen=True)
class Prepared:
    """Windows of all parts with what was fitted on the way."""

    samples: DataFrame
    base: list[str]
    inputs: list[str]
    outputs: list[str]
    input_scaler: Scaler
    output_scaler: Scaler
    classes: list
    profile: Profile


@dataclass(frozen=True)
class Sensor:
    """A fitted sensor: parameters, columns it reads, inputs made of them, scalers, model, class names."""

    params: dict
    base: list[str]
    inputs: list[str]
    input_scaler: Scaler
    output_scaler: Scaler
    model: object
    classes: list
    metrics: dict
    profile: Profile | None = None


def rejected_columns(
    df: DataFrame, params: dict, keep: Sequence[str], profile: Profile | None = None, report: bool = False
) -> tuple[list[str], Profile]:
    """Columns the profile rules reject, and the profile they were read from.

    Unless a profile is given, what the rules read is computed in a few scans: constants, shares of zeros and
    correlations are exact, distinct counts estimated. ``report`` asks for the whole exact report.
    """
    cols = [c for c in df.columns if c not in keep]
    settings = params["clean"]
    metric = settings["correlation_metric"]
    tables = profile or profiling.profile(df, cols, metric, approximate=not report, detail=report)
    gone = clean.removable_columns(
        tables[0],
        tables[1],
        settings["percentage_zeros_threshold"],
        settings["input_max_correlation_threshold"],
        settings["target"],
        cols,
    )
    return gone, tables


def prepare(
    df: DataFrame,
    params: dict,
    series: Sequence[str],
    order: Sequence[str],
    by_series: bool | None = None,
    profile: Profile | None = None,
    report: bool = False,
) -> Prepared:
    """Profile, clean, featurize, split, scale and cut into windows.

    Several series are split into whole series, a single one into runs of rows; ``by_series`` decides
    otherwise.

    The split rows are written once: scalers, training and scoring all read them. A one-hot target
    makes ``y`` the class code again once its columns went through the windows. ``combine_files``
    makes one series of all of them, in their order, and that is always split by rows.
    """
    settings = params["clean"]
    if settings["combine_files"]:
        series, order = [], [*series, *order]
    target, keys = settings["target"], list(dict.fromkeys([*series, *order]))
    gone, tables = rejected_columns(df, params, keys, profile, report)
    rows = clean.drop_null_rows(clean.drop_columns(df, [c for c in gone if c not in keys]))
    classes: list = []
    outputs = [target]
    if settings["classification"]:
        codes = encode.fit_label_encoder(rows, target)
        classes = [r[0] for r in codes.orderBy("code").collect()]
        if settings["onehot_encode_target"]:
            rows, outputs = encode.onehot_encode(rows, target)
        else:
            rows = encode.apply_label_encoder(rows, codes, target)
    rows, base, inputs = _featurize(rows, params, keys, outputs, series, order)
    settings = params["split"]
    if by_series is None:
        by_series = bool(series) and len(rows.select(*series).distinct().head(2)) > 1
    if by_series and series:
        parted = split_series(
            rows, settings["train_split"], settings["calibrate_split"], series, settings["shuffle_files"]
        )
    else:
        parted = split_rows(rows, settings["train_split"], settings["calibrate_split"], series, order)
    parted = staged(parted, "split")
    scaled, input_scaler, output_scaler = scale_in_out(
        parted,
        inputs,
        [] if params["clean"]["classification"] else outputs,
        params["scale"]["input"],
        params["scale"]["output"],
    )
    cut = params["sequentialize"]
    samples = windows(
        scaled,
        inputs,
        outputs,
        cut["window_size"],
        1 if params["clean"]["classification"] else cut["target_size"],
        series,
        order,
        cut.get("overlap") or None,
        cut["future_predict"],
    )
    if len(outputs) > 1:
        samples = samples.withColumn("y", F.array(argmax(F.col("y")).cast("double")))
    if cut["shuffle_samples"]:
        samples = shuffle_samples(samples, models.SEED, series)
    return Prepared(samples, base, inputs, outputs, input_scaler, output_scaler, classes, tables)


def _featurize(rows, params, keys, outputs, series, order):
    """Choose and make the inputs; returns the frame, the columns read and the input names."""
    settings = params["featurize"]
    numeric = clean.select_numeric(rows).columns
    wanted = settings["features"] or [c for c in rows.columns if c not in keys]
    absent = [c for c in wanted if c not in rows.columns]
    if absent:
        warnings.warn(f"features that the cleaned rows lack: {', '.join(absent)}", stacklevel=3)
    base = [c for c in wanted if c in numeric and c not in outputs]
    rows, inputs = _with_rolling(rows, base, settings, series, order)
    inputs = [c for c in inputs if c not in settings["remove_features"]]
    minimum = settings["target_min_correlation_threshold"]
    if minimum > 0:  # of one-hot classes any one may be what an input tells
        kept = {
            c for y in outputs for c in features.select_by_target_corr(rows.select(*inputs, y), y, minimum).columns
        }
        inputs = [c for c in inputs if c in kept]
    extra = [c for c in ("idx", "n_rows") if c in rows.columns]
    return rows.select(*dict.fromkeys([*keys, *outputs, *inputs, *extra])), base, inputs


def _with_rolling(rows, base, settings, series, order):
    """The frame with rolling features of the columns if asked for, and all input names."""
    if not settings["add_rolling_features"]:
        return rows, list(base)
    before = set(rows.columns)
    rows = features.add_rolling_features(rows, base, settings["rolling_window_size"], series, order)
    return rows, [*base, *[c for c in rows.columns if c not in before and c not in ("idx", "n_rows")]]


def create_sensor(
    df: DataFrame,
    params: dict,
    series: Sequence[str],
    order: Sequence[str],
    by_series: bool | None = None,
    profile: Profile | None = None,
    report: bool = False,
) -> tuple[Sensor, DataFrame]:
    """Fit a sensor; returns it with its predictions on the test part.

    ``report`` makes the whole profile report on the way, as an asset of the sensor.
    """
    params = registry.merge_params(params)
    made = prepare(df, params, series, order, by_series, profile, report)
    settings = params["train"]
    classification = params["clean"]["classification"]
    n_outputs = 1 if classification else params["sequentialize"]["target_size"]
    calibrated = params["split"]["calibrate_split"] > 0
    if n_outputs > 1 and calibrated:
        raise ValueError("calibration needs a target_size of 1")
    model = models.train_outputs(
        made.samples,
        settings["learning_method"],
        n_outputs,
        classification=classification,
        n_epochs=settings["n_epochs"],
        early_stopping=settings["early_stopping"],
        patience=settings["patience"],
        series=[] if params["clean"]["combine_files"] else series,
        order=["sample" if params["sequentialize"]["shuffle_samples"] else "idx"],
    )
    table = staged(evaluate_model(model, made.samples, calibrated), "predictions")
    measure = evaluate.vector_metrics if n_outputs > 1 else evaluate.regression_metrics
    scores = measure(table, "ground_truth", "predicted").first()
    metrics = {"mse": scores.mse, "r2": scores.r2}
    if classification:
        metrics["accuracy"] = evaluate.classification_metrics(table, "ground_truth", "predicted").first().accuracy
    scalers = made.input_scaler, made.output_scaler
    sensor = Sensor(params, made.base, made.inputs, *scalers, model, made.classes, metrics, made.profile)
    return sensor, table


def evaluate_model(model, samples: DataFrame, calibrated: bool = False, alpha: float = 0.05) -> DataFrame:
    """Truth and prediction of the test windows, in scaled units, with bounds if calibrated."""
    truth = F.col("y") if isinstance(model, models.MultiOutput) else F.col("y")[0]
    keys = [c for c in samples.columns if c not in ("X", "y")]

    def scored(part):
        return models.predict(model, samples.where(F.col("part") == part), "_guess").withColumn("_truth", truth)

    test = scored("test")
    if not calibrated:
        return test.select(*keys, F.col("_truth").alias("ground_truth"), F.col("_guess").alias("predicted"))
    bounded = evaluate.conformal(scored("calibrate"), test, alpha, "_truth", "_guess")
    return evaluate.predictions(bounded, "_truth", keys)


def infer(sensor: Sensor, df: DataFrame, series: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Predictions for new rows: check inputs, clean, scale, cut into windows, predict, decode."""
    if sensor.params["clean"]["combine_files"]:
        series, order = [], [*series, *order]
    clean.require_features(df, sensor.base)
    rows = clean.drop_null_rows(df.select(*dict.fromkeys([*series, *order, *sensor.base])))
    rows, _ = _with_rolling(rows, sensor.base, sensor.params["featurize"], series, order)
    cut = sensor.params["sequentialize"]
    samples = x_windows(
        apply_scaler(rows, sensor.input_scaler), sensor.inputs, cut["window_size"], cut.get("overlap") or 0, series, order
    )
    scored = models.predict(sensor.model, samples)
    if not sensor.params["clean"]["classification"]:
        target = sensor.params["clean"]["target"]
        if isinstance(sensor.model, models.MultiOutput):
            scaler = sensor.output_scaler
            center, scale = scaler.center.get(target, 0.0), scaler.scale.get(target, 1.0)
            return scored.withColumn("predicted", F.transform("predicted", lambda p: p * scale + center)).drop("X")
        restored = invert_scaler(scored.withColumnRenamed("predicted", target), sensor.output_scaler)
        return restored.withColumnRenamed(target, "predicted").drop("X")
    if sensor.params["clean"]["onehot_encode_target"]:
        return scored.drop("X")
    code = above(F.col("predicted")) if len(sensor.classes) == 2 else F.col("predicted").cast("int")
    return scored.withColumn("predicted", code).drop("X")


def save_sensor(
    spark: SparkSession, sensor: Sensor, path: str | None = None, predictions: DataFrame | None = None
) -> dict[str, str]:
    """Write every asset of a newly made sensor, its metrics and, if given, its predictions; returns their paths."""
    base = path or new_table_path(spark, "sensor")
    assets = {name: f"{base}/{name}" for name in registry.REQUIRED_ASSETS}
    write_profile(*sensor.profile, assets["profile"])
    names = [(role, i, c) for role in ("base", "inputs") for i, c in enumerate(getattr(sensor, role))]
    spark.createDataFrame(names, "role string, pos int, name string").write.parquet(assets["features"])
    sensor.input_scaler.table(spark).write.parquet(assets["input_scaler"])
    sensor.output_scaler.table(spark).write.parquet(assets["output_scaler"])
    models.save_model(spark, sensor.model, assets["model"])
    assets["metrics"] = f"{base}/metrics"
    write_metrics(spark.createDataFrame([(k, float(v)) for k, v in sensor.metrics.items()], "name string, value double"), assets["metrics"])
    if predictions is not None:
        assets["predictions"] = f"{base}/predictions"
        write_table(predictions, assets["predictions"])
    assets["kind"] = models.model_kind(sensor.model)
    assets["classes"] = json.dumps(sensor.classes)
    return assets


def load_sensor(spark: SparkSession, row) -> Sensor:
    """The sensor of one registry row."""
    assets = json.loads(row.assets)
    names = spark.read.parquet(assets["features"]).orderBy("pos").collect()
    return Sensor(
        json.loads(row.params),
        [r.name for r in names if r.role == "base"],
        [r.name for r in names if r.role == "inputs"],
        Scaler.from_table(spark.read.parquet(assets["input_scaler"])),
        Scaler.from_table(spark.read.parquet(assets["output_scaler"])),
        models.load_model(spark, assets["model"], assets["kind"]),
        json.loads(assets["classes"]),
        json.loads(row.metrics),
    )
