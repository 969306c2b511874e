"""Queries of sources, sinks, unions and the registry table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.operators import evaluate, ordered, profiling, registry
from gaugeloom.operators.clean import drop_monotonic_first
from gaugeloom.operators.windows import windows
from gaugeloom.plans.queries.catalog import (
    EVENT_GUESS,
    EVENT_ORDER,
    EVENT_ROWS,
    EVENT_SERIES,
    EVENTS,
    LINE_ORDER,
    LINE_SERIES,
    LINES,
    event_guess,
    events,
    lines,
    query,
    r6,
    rounded,
    table,
)
from gaugeloom.session import new_table_path
from gaugeloom.sources import tables as io

CSV_SCHEMA = "event_id long, user_id long, value double, k double"


def _events_csv(spark, folder, df=None):
    path = new_table_path(spark, "events-csv")
    df = events(spark, folder) if df is None else df
    io.write_table(df.select("event_id", "user_id", "value", "k"), path, "csv")
    return path


@query(
    "S1_series_folder",
    "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY user_id",
)
def series_folder(spark, folder):
    path = new_table_path(spark, "series")
    io.write_series(events(spark, folder).select("user_id", "value"), path, "user_id", "csv", folders=True)
    df = io.read_series(spark, path, "csv", "value double, user_id long")
    return df.groupBy("user_id").agg(F.count("*").alias("n"), r6(F.sum("value"), 2).alias("total"))


@query("S2_csv_without_index", f"SELECT user_id, value, k FROM {EVENTS}")
def csv_without_index(spark, folder):
    return io.read_series(spark, _events_csv(spark, folder), "csv", CSV_SCHEMA, drop_index=True)


@query("S3_csv_all_columns", f"SELECT event_id, user_id, value, k FROM {EVENTS}")
def csv_all_columns(spark, folder):
    """Types inferred from the files."""
    df = io.read_series(spark, _events_csv(spark, folder), "csv")
    return df.select(F.col("event_id").cast("long"), F.col("user_id").cast("long"), "value", F.col("k"))


def _reordered_csv(spark, folder):
    """Files of three headers: other orders of the columns, one without the price."""
    path = new_table_path(spark, "lines-csv")
    headers = [
        ["l_linenumber", "l_orderkey", "l_quantity", "l_extendedprice"],
        ["l_linenumber", "l_extendedprice", "l_orderkey", "l_quantity"],
        ["l_linenumber", "l_quantity", "l_orderkey"],
    ]
    for n, names in enumerate(headers):
        rows = table(spark, folder, "lineitem").where(F.col("l_orderkey") % 3 == n).select(names)
        rows.write.mode("append").option("header", True).csv(path)
    return path


REORDERED_SQL = """SELECT l_orderkey::BIGINT AS l_orderkey, l_quantity::DOUBLE AS l_quantity,
  CASE WHEN l_orderkey % 3 < 2 THEN l_extendedprice::DOUBLE END AS l_extendedprice FROM lineitem"""


@query("S1_csv_by_name", REORDERED_SQL)
def csv_by_name(spark, folder):
    schema = "l_orderkey long, l_quantity double, l_extendedprice double"
    return io.read_series(spark, _reordered_csv(spark, folder), "csv", schema)


@query("S2_S3_csv_by_name_inferred", REORDERED_SQL)
def csv_by_name_inferred(spark, folder):
    df = io.read_series(spark, _reordered_csv(spark, folder), "csv", drop_index=True)
    return df.select(F.col("l_orderkey").cast("long"), F.col("l_quantity").cast("double"), "l_extendedprice")


@query("S4_drop_monotonic_first", f"SELECT ts, user_id, value FROM {EVENTS}")
def monotonic_first(spark, folder):
    df = events(spark, folder).select("event_id", "ts", "user_id", "value")
    return drop_monotonic_first(df, EVENT_SERIES, ["ts"])


@query("S4_keep_unordered_first", "SELECT l_extendedprice, l_suppkey, l_shipdate FROM lineitem")
def unordered_first(spark, folder):
    df = table(spark, folder, "lineitem")
    return drop_monotonic_first(
        df.select("l_extendedprice", *[c for c in LINE_ORDER if c != "l_extendedprice"], "l_suppkey"),
        LINE_SERIES,
        LINE_ORDER,
    ).select("l_extendedprice", "l_suppkey", "l_shipdate")


@query("S5_read_clean", f"SELECT event_id, user_id, value FROM {EVENTS} WHERE k <> 0 AND value > 10")
def read_clean(spark, folder):
    """Nulls in a deleted column do not cost rows; nulls in a kept one do."""
    df = events(spark, folder).where("k <> 0")
    df = df.withColumn("value", F.when(F.col("value") > 10, F.col("value")))
    df = df.withColumn("k", F.when(F.col("k") > 50, F.col("k")))
    return io.read_clean(spark, _events_csv(spark, folder, df), ["k"], fmt="csv", schema=CSV_SCHEMA)


@query("S6_dataset_folder", "SELECT event_id, value FROM events WHERE event_type = 'click'")
def dataset_folder(spark, folder):
    path = new_table_path(spark, "datasets")
    io.write_series(events(spark, folder).select("event_id", "value", "event_type"), path, "event_type", folders=True)
    return io.read_series(spark, path, "parquet", dataset="event_type=click").select("event_id", "value")


@query("S7_series_sink", "SELECT l_suppkey, l_orderkey, l_quantity, l_tax FROM lineitem")
def series_sink(spark, folder):
    path = new_table_path(spark, "series")
    df = table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey", "l_quantity", "l_tax")
    io.write_series(df, path, "l_suppkey")
    back = io.read_series(spark, path, "parquet")
    return back.withColumn("l_suppkey", F.col("l_suppkey").cast("long"))


@query("S8_combined_sink", f"SELECT event_id, ts, user_id, event_type, value, k FROM {EVENTS}")
def combined_sink(spark, folder):
    path = new_table_path(spark, "combined")
    io.write_table(events(spark, folder), path)
    return io.read_series(spark, path, "parquet").select("event_id", "ts", "user_id", "event_type", "value", "k")


@query(
    "S9_window_table",
    f"""SELECT user_id, idx, lag(k, 2) OVER w AS x0, lag(k) OVER w AS x1, k AS x2, value AS y
FROM {EVENT_ROWS} WINDOW w AS (PARTITION BY user_id ORDER BY idx) QUALIFY idx >= 2""",
)
def window_table(spark, folder):
    path = new_table_path(spark, "windows")
    io.write_table(windows(events(spark, folder), ["k"], "value", 3, 1, EVENT_SERIES, EVENT_ORDER), path)
    x = [F.col("X")[i][0].alias(f"x{i}") for i in range(3)]
    return io.read_series(spark, path, "parquet").select("user_id", "idx", *x, F.col("y")[0].alias("y"))


@query(
    "S10_profile_json",
    f"""SELECT 'value' AS variable, count(DISTINCT value) AS n_distinct, round(avg(value), 6) AS mean FROM {EVENTS}
UNION ALL SELECT 'k', count(DISTINCT k), round(avg(k), 6) FROM {EVENTS}""",
)
def profile_json(spark, folder):
    path = new_table_path(spark, "profile")
    io.write_profile(*profiling.profile(events(spark, folder), ["value", "k"]), path)
    variables, _, _ = io.read_profile(spark, path)
    return variables.select("variable", "n_distinct", r6("mean").alias("mean"))


@query(
    "S11_metrics_json",
    f"SELECT round(avg((value - p) * (value - p)), 4) AS mse, count(*) AS n FROM {EVENT_GUESS}",
)
def metrics_json(spark, folder):
    path = new_table_path(spark, "metrics")
    io.write_metrics(evaluate.regression_metrics(event_guess(spark, folder), "value", "p"), path)
    return spark.read.schema("mse double, r2 double, n long").json(path).select(r6("mse", 4).alias("mse"), "n")


@query(
    "S12_predictions_csv",
    f"""SELECT round(value, 4) AS ground_truth, round(p, 4) AS predicted, round(p - 100, 4) AS lower_bound,
  round(p + 100, 4) AS upper_bound FROM {EVENT_GUESS} WHERE part = 'test'""",
)
def predictions_csv(spark, folder):
    path = new_table_path(spark, "predictions")
    test = event_guess(spark, folder).where("part = 'test'")
    test = test.withColumns({"lower_bound": F.col("p") - 100, "upper_bound": F.col("p") + 100})
    io.write_predictions(evaluate.predictions(test, "value"), path)
    return rounded(io.read_predictions(spark, path), "ground_truth", "predicted", "lower_bound", "upper_bound", places=4)


@query(
    "S13_feature_list",
    f"""SELECT 0 AS pos, 'quantity' AS name, count(quantity) AS n_values FROM {LINES}
UNION ALL SELECT 1, 'sparse', count(sparse) FROM {LINES}""",
)
def feature_list(spark, folder):
    return io.feature_list(lines(spark, folder), ["quantity", "sparse"])


@query(
    "U1_union_by_name",
    """SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier""",
)
def union_by_name(spark, folder):
    a = table(spark, folder, "customer").selectExpr("c_custkey AS id", "c_acctbal AS balance", "c_mktsegment AS segment")
    b = table(spark, folder, "supplier").selectExpr("s_suppkey AS id", "s_acctbal AS balance")
    return io.union_by_name([a, b])


@query("U4_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_discount FROM lineitem")
def distinct_rows(spark, folder):
    return table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_discount").distinct()


@query(
    "U5_series_in_name_order",
    """SELECT name, row_number() OVER (ORDER BY name) - 1 AS place FROM
(SELECT DISTINCT CAST(user_id AS VARCHAR) AS name FROM events)""",
)
def series_in_name_order(spark, folder):
    names = events(spark, folder).select(F.col("user_id").cast("string").alias("name")).distinct()
    return ordered.positions(names, [], ["name"]).select("name", F.col("idx").alias("place"))


@query("U7_top_k", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem ORDER BY 4 DESC, 1, 2, 3 LIMIT 10")
def top_k(spark, folder):
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return ordered.top_k(df, [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey"], 10)


@query(
    "U8_kth_largest",
    """SELECT k, value FROM (SELECT value, row_number() OVER (ORDER BY value DESC) AS k FROM events)
WHERE k = 100 OR k = (SELECT count(*) // 2 FROM events)""",
)
def kth_largest(spark, folder):
    df = events(spark, folder)
    half = df.count() // 2
    rows = [(k, ordered.kth_largest(df, "value", k)) for k in (100, half)]
    return spark.createDataFrame(rows, "k long, value double")


# One registered sensor per user: its stand-in prediction scored on its own rows.
SENSORS = f"""(SELECT user_id AS id, CAST(user_id AS VARCHAR) AS dataset, 'value' AS target,
  round(1 - sum((value - p) * (value - p)) / nullif(var_pop(value) * count(*), 0), 6) AS r2
  FROM {EVENT_GUESS} GROUP BY user_id)"""


def _registry(spark, folder):
    path = new_table_path(spark, "registry")
    scores = evaluate.regression_metrics(event_guess(spark, folder), "value", "p", ["user_id"])
    params = F.struct(
        F.struct(F.col("user_id").cast("string").alias("dataset")).alias("profile"),
        F.struct(F.lit("value").alias("target")).alias("clean"),
    )
    assets = F.when(
        F.col("user_id") % 2 == 0,
        F.to_json(F.create_map(*[F.lit(x) for a in registry.REQUIRED_ASSETS for x in (a, f"models/{a}")])),
    ).otherwise("{}")
    rows = scores.select(
        F.col("user_id").alias("id"),
        F.to_json(params).alias("params"),
        F.to_json(F.struct("mse", "r2")).alias("metrics"),
        assets.alias("assets"),
    )
    registry.register(rows, path)
    return registry.list_sensors(spark, path)


@query("G1_register", f"SELECT id, dataset FROM {SENSORS}")
def register(spark, folder):
    return _registry(spark, folder).select("id", F.get_json_object("params", "$.profile.dataset").alias("dataset"))


@query("G2_list_sensors", f"SELECT id, r2 FROM {SENSORS}")
def list_sensors(spark, folder):
    return _registry(spark, folder).select("id", r6(F.get_json_object("metrics", "$.r2")).alias("r2"))


@query("G3_U6_overview_newest_first", f"SELECT *, row_number() OVER (ORDER BY id DESC) - 1 AS place FROM {SENSORS}")
def overview(spark, folder):
    rows = registry.overview(_registry(spark, folder)).withColumn("newest", -F.col("id"))
    placed = ordered.running_total(rows, [], ["newest"], out="place", total="n")
    return rounded(placed.drop("newest", "n"), "r2")


@query("J5_get_sensor", f"SELECT id, dataset FROM {SENSORS} WHERE id = (SELECT max(user_id) FROM events)")
def get_sensor(spark, folder):
    newest = events(spark, folder).agg(F.max("user_id")).first()[0]
    found = registry.get_sensor(_registry(spark, folder), newest)
    return found.select("id", F.get_json_object("params", "$.profile.dataset").alias("dataset"))


@query(
    "I2_check_assets",
    f"""SELECT id, asset, id % 2 = 0 AS present FROM {SENSORS},
(VALUES ('profile'), ('features'), ('input_scaler'), ('output_scaler'), ('model')) AS a(asset)""",
)
def check_assets(spark, folder):
    return registry.check_assets(_registry(spark, folder))


FORM = """SELECT r_regionkey AS id, r_name AS dataset, 'value' AS target, 'dt' AS learning_method,
  (r_regionkey + 3) / 10.0::DOUBLE AS train_split, 10::BIGINT AS window_size, 200::BIGINT AS n_epochs, 'minmax' AS input_scaler FROM region"""


@query("G4_parameters_of_a_form", FORM)
def parameters_of_a_form(spark, folder):
    """A form for each region, laid over the default parameters and read back from the registry's text."""
    forms = table(spark, folder, "region").select("r_regionkey", "r_name").collect()
    rows = [
        registry.registry_row(spark, registry.params_from_form(r.r_name, "value", "dt", r.r_regionkey + 3), {}, sensor_id=r.r_regionkey)
        for r in forms
    ]
    found = reduce(DataFrame.unionByName, rows)
    fields = {
        "dataset": ("profile.dataset", "string"),
        "target": ("clean.target", "string"),
        "learning_method": ("train.learning_method", "string"),
        "train_split": ("split.train_split", "double"),
        "window_size": ("sequentialize.window_size", "long"),
        "n_epochs": ("train.n_epochs", "long"),
        "input_scaler": ("scale.input", "string"),
    }
    cells = [F.get_json_object("params", f"$.{place}").cast(kind).alias(name) for name, (place, kind) in fields.items()]
    return found.select("id", *cells)


@query("X8_second_as_id", "SELECT epoch(max(ts))::BIGINT AS id, 'events' AS dataset FROM events")
def second_as_id(spark, folder):
    """The second of the newest event as the id of a sensor, where a caller gives one."""
    newest = events(spark, folder).agg(F.max(F.unix_timestamp("ts"))).first()[0]
    row = registry.registry_row(spark, {"profile": {"dataset": "events"}}, {}, sensor_id=newest)
    return row.select("id", F.get_json_object("params", "$.profile.dataset").alias("dataset"))
