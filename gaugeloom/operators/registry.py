"""Table of finished sensors with their parameters and metrics."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the registry and the default parameters of a sensor.
REGISTRY_SCHEMA = "id long, params string, metrics string, assets string"
DEFAULT_PARAMS = {
    "profile": {"dataset": None},
    "clean": {
        "target": None,
        "classification": False,
        "onehot_encode_target": False,
        "combine_files": False,
        "percentage_zeros_threshold": 1.0,
        "correlation_metric": "pearson",
        "input_max_correlation_threshold": 1.0,
    },
    "featurize": {
        "features": [],
        "add_rolling_features": False,
        "rolling_window_size": 100,
        "remove_features": [],
        "target_min_correlation_threshold": 0.0,
    },
    "split": {"train_split": 0.5, "shuffle_files": False, "calibrate_split": 0.0},
    "scale": {"input": "minmax", "output": None},
    "sequentialize": {
        "window_size": 10,
        "overlap": 0,
        "target_size": 1,
        "shuffle_samples": False,
        "future_predict": False,
    },
    "train": {
        "learning_method": "rf",
        "n_epochs": 200,
        "early_stopping": True,
        "patience": 40,
    },
}
REQUIRED_ASSETS = ["profile", "features", "input_scaler", "output_scaler", "model"]


def merge_params(given: dict, defaults: dict = DEFAULT_PARAMS) -> dict:
    """Defaults with the given values put over them, section by section."""
    merged = {name: dict(section) for name, section in defaults.items()}
    for name, section in given.items():
        merged.setdefault(name, {}).update(section or {})
    return merged


def params_from_form(dataset: str, target: str, learning_method: str, train_tenths: float) -> dict:
    """Default parameters with the four values of the form; the train share is given in tenths."""
    return merge_params(
        {
            "profile": {"dataset": dataset},
            "clean": {"target": target},
            "train": {"learning_method": learning_method},
            "split": {"train_split": float(train_tenths) / 10},
        }
    )


def registry_row(
    spark: SparkSession, params: dict, metrics: dict, assets: dict | None = None, sensor_id: int | None = None
) -> DataFrame:
    """One registry row; the id is the current Unix second unless given."""
    row = [(sensor_id, json.dumps(params), json.dumps(metrics), json.dumps(assets or {}))]
    df = spark.createDataFrame(row, REGISTRY_SCHEMA)
    return df.withColumn("id", F.coalesce("id", F.unix_timestamp()))


def register(rows: DataFrame, path: str) -> None:
    """Append sensors to the registry table."""
    rows.select("id", "params", "metrics", "assets").write.mode("append").parquet(path)


def list_sensors(spark: SparkSession, path: str) -> DataFrame:
    """All sensors, newest first; none if there is no registry yet."""
    try:
        table = spark.read.schema(REGISTRY_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], REGISTRY_SCHEMA)
    return newest_first(table)


def newest_first(registry: DataFrame) -> DataFrame:
    return registry.orderBy(F.col("id").desc())


def get_sensor(registry: DataFrame, sensor_id: int) -> DataFrame:
    """The row of one sensor."""
    return registry.where(F.col("id") == sensor_id)


def overview(registry: DataFrame) -> DataFrame:
    """Id, data set, target and R² of each sensor, newest first."""
    return newest_first(registry).select(
        "id",
        F.get_json_object("params", "$.profile.dataset").alias("dataset"),
        F.get_json_object("params", "$.clean.target").alias("target"),
        F.get_json_object("metrics", "$.r2").cast("double").alias("r2"),
    )


def check_assets(registry: DataFrame) -> DataFrame:
    """One row per sensor and required asset: is its path on record."""
    paths = F.from_json("assets", "map<string,string>")
    asset = F.explode(F.array(*map(F.lit, REQUIRED_ASSETS)))
    listed = registry.select("id", paths.alias("paths"), asset.alias("asset"))
    return listed.select("id", "asset", F.try_element_at("paths", "asset").isNotNull().alias("present"))


def require_assets(registry: DataFrame) -> DataFrame:
    """The registry itself, or an error naming what is missing."""
    missing = check_assets(registry).where(~F.col("present")).groupBy("id")
    first = missing.agg(F.sort_array(F.collect_list("asset")).alias("assets")).orderBy("id").first()
    if first:
        raise FileNotFoundError(f"sensor {first.id} lacks {', '.join(first.assets)}")
    return registry
