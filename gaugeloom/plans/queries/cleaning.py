"""Queries of column selection, rejection rules, encoders and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeloom.functions import columns as fn
from gaugeloom.operators import clean, encode, features, ordered, profiling
from gaugeloom.operators.correlation import correlations
from gaugeloom.plans.queries.catalog import (
    EVENT_ORDER,
    EVENT_ROWS,
    EVENT_SERIES,
    EVENTS,
    LINE_NUMBERS,
    LINES,
    events,
    lines,
    per_column,
    query,
    r6,
    rounded,
    table,
)
from gaugeloom.session import new_table_path
from gaugeloom.sources.tables import read_report

LINE_COLUMNS = [*LINE_NUMBERS, "fixed"]


@query("F1_drop_columns", "SELECT event_id, ts, user_id, event_type, value FROM events")
def drop_columns(spark, folder):
    return clean.drop_columns(events(spark, folder), ["k", "absent"])


@query("F2_drop_null_rows", f"SELECT l_orderkey, quantity, sparse FROM {LINES} WHERE sparse IS NOT NULL")
def drop_null_rows(spark, folder):
    return clean.drop_null_rows(lines(spark, folder).select("l_orderkey", "quantity", "sparse"))


@query("F3_move_column", f"SELECT value, event_id, user_id, k FROM {EVENTS}")
def move_column(spark, folder):
    return clean.move_column(events(spark, folder).select("event_id", "user_id", "k", "value"), "value", 0)


@query("F4_select_features", f"SELECT value, k, user_id FROM {EVENTS}")
def select_features(spark, folder):
    return clean.select_features(events(spark, folder), ["k", "user_id", "absent"], "value")


@query("F5_select_numeric", f"SELECT event_id, user_id, value, k FROM {EVENTS}")
def select_numeric(spark, folder):
    return clean.select_numeric(events(spark, folder))


@query(
    "F6_missing_features",
    f"""SELECT 'k' AS feature, true AS present, count(k) AS n_values FROM {EVENTS}
UNION ALL SELECT 'value', true, count(value) FROM events UNION ALL SELECT 'pressure', false, 0""",
)
def missing_features(spark, folder):
    return clean.missing_features(events(spark, folder), ["k", "value", "pressure"])


@query("F7_require_features", f"SELECT event_id, value, k FROM {EVENTS}")
def require_features(spark, folder):
    return clean.require_features(events(spark, folder), ["k", "value"]).select("event_id", "value", "k")


@query("F8_remove_features", f"SELECT event_id, value, k / 100 AS k_share FROM {EVENTS}")
def remove_features(spark, folder):
    made = features.add_features(events(spark, folder), {"k_share": F.col("k") / 100})
    return clean.remove_features(made, ["k"]).select("event_id", "value", "k_share")


@query("F9_select_by_target_corr", f"SELECT price, net FROM {LINES}")
def select_by_target_corr(spark, folder):
    """Only net goes with the price; quantity, discount and tax are drawn apart from it."""
    df = lines(spark, folder).select("price", "quantity", "net", "discount", "tax")
    return features.select_by_target_corr(df, "price", 0.1)


@query(
    "F9_target_correlations",
    per_column(["quantity", "net", "discount", "tax"], "round(corr({c}, price), 6) + 0.0 AS r", LINES),
)
def target_correlations(spark, folder):
    df = lines(spark, folder).select("price", "quantity", "net", "discount", "tax")
    return rounded(features.target_correlations(df, "price"), "r")


@query("F10_split_target", f"SELECT value AS y, k AS x FROM {EVENTS}")
def split_target(spark, folder):
    return events(spark, folder).select(F.col("value").alias("y"), F.col("k").alias("x"))


@query(
    "F11_verify_schema",
    f"""SELECT 'sparse' AS "column", true AS present, true AS type_ok, count(*) - count(sparse) AS n_null,
  false AS "constant" FROM {LINES}
UNION ALL SELECT 'fixed', true, false, 0, true UNION ALL SELECT 'absent', false, false, NULL, NULL""",
)
def verify_schema(spark, folder):
    spec = {"sparse": "double", "fixed": "string", "absent": "double"}
    return clean.verify_schema(lines(spark, folder), spec)


@query("F12_every_kth_row", f"SELECT user_id, event_id, idx // 10 AS idx, (n_rows + 9) // 10 AS n_rows FROM {EVENT_ROWS} WHERE idx % 10 = 0")
def every_kth(spark, folder):
    df = ordered.every_kth(events(spark, folder), 10, EVENT_SERIES, EVENT_ORDER)
    return df.select("user_id", "event_id", "idx", "n_rows")


@query(
    "C1_constant_columns",
    "SELECT variable FROM (" + per_column(LINE_COLUMNS, "min({c}) = max({c}) AS hit", LINES) + ") WHERE hit",
)
def constant_columns(spark, folder):
    return clean.constant_columns(profiling.count_stats(lines(spark, folder), LINE_COLUMNS))


LARGE = "9007199254740992 + (l_orderkey % 2)"
LARGE_SQL = f"""SELECT 'large' AS variable, count(DISTINCT {LARGE}) AS n_distinct FROM lineitem
UNION ALL SELECT 'fixed', 1"""


@query("C1_P2_large_integers", LARGE_SQL)
def large_integers(spark, folder):
    """Integers that are equal as doubles are told apart."""
    rows = lines(spark, folder).select(F.expr(LARGE.replace("9007199254740992", "9007199254740992L")).alias("large"), F.lit(5).alias("fixed"))
    return profiling.count_stats(rows, ["large", "fixed"]).select("variable", "n_distinct")


ZEROS = per_column(LINE_COLUMNS, "avg(CASE WHEN {c} = 0 THEN 1.0 ELSE 0.0 END) AS p_zeros", LINES)


@query("C2_zero_columns", f"SELECT variable FROM ({ZEROS}) WHERE p_zeros > 0.055")
def zero_columns(spark, folder):
    return clean.zero_columns(profiling.zero_stats(lines(spark, folder), LINE_COLUMNS), 0.055)


CORR = " UNION ALL ".join(
    f"SELECT '{a}' AS variable, '{b}' AS other, corr({a}, {b}) AS r FROM {LINES}"
    for a in LINE_NUMBERS
    for b in LINE_NUMBERS
    if a != b
)


@query(
    "C3_correlated_pairs",
    f"SELECT variable, other, round(r, 6) + 0.0 AS r FROM ({CORR}) WHERE abs(r) >= 0.9",
)
def correlated_pairs(spark, folder):
    pairs = correlations(lines(spark, folder), LINE_NUMBERS)
    return rounded(pairs.where(F.abs("r") >= 0.9), "r")


def _removed(spark, folder, target):
    pairs = correlations(lines(spark, folder), LINE_NUMBERS)
    gone = clean.correlated_columns(pairs, 0.9, target, order=LINE_NUMBERS)
    return spark.createDataFrame([(c,) for c in gone], "variable string")


# discount and sparse agree wherever sparse has a value, price and net nearly do.
@query(
    "C3_correlated_columns",
    f"""SELECT DISTINCT other AS variable FROM ({CORR})
WHERE r > 0.9 AND (variable, other) IN (('price', 'net'), ('discount', 'sparse'))""",
)
def correlated_columns(spark, folder):
    return _removed(spark, folder, None)


@query(
    "C4_correlated_columns_but_target",
    f"""SELECT DISTINCT other AS variable FROM ({CORR})
WHERE r > 0.9 AND (variable, other) = ('discount', 'sparse')""",
)
def correlated_but_target(spark, folder):
    return _removed(spark, folder, "price")


@query(
    "C5_C6_removable_columns",
    f"""SELECT DISTINCT variable FROM (
SELECT variable FROM ({per_column(LINE_COLUMNS, "min({c}) = max({c}) AS hit", LINES)}) WHERE hit
UNION ALL SELECT variable FROM ({ZEROS}) WHERE p_zeros > 0.04
UNION ALL SELECT other FROM ({CORR}) WHERE r > 0.9 AND (variable, other) = ('price', 'net'))
WHERE variable <> 'tax'""",
)
def removable_columns(spark, folder):
    """Discount and tax have too many zeros, but tax is the target; sparse lost its partner first."""
    df = lines(spark, folder)
    variables = profiling.count_stats(df, LINE_COLUMNS).join(profiling.zero_stats(df, LINE_COLUMNS), "variable")
    pairs = correlations(df, LINE_NUMBERS)
    gone = clean.removable_columns(variables, pairs, 0.04, 0.9, "tax", LINE_NUMBERS)
    return spark.createDataFrame([(c,) for c in gone], "variable string")


@query(
    "C7_parse_messages",
    "SELECT upper(l_returnflag) AS kind, l_linestatus AS variable, count(*) AS n FROM lineitem GROUP BY ALL",
)
def parse_messages(spark, folder):
    texts = table(spark, folder, "lineitem").select(
        F.format_string("[%s] has a remark on %s", "l_returnflag", "l_linestatus").alias("message")
    )
    return clean.parse_messages(texts).groupBy("kind", "variable").agg(F.count("*").alias("n"))


@query(
    "C8_report_alerts",
    "SELECT '[ZEROS]' || ' ' || variable AS message FROM ("
    + per_column(LINE_NUMBERS, "avg(CASE WHEN {c} = 0 THEN 1.0 ELSE 0.0 END) AS p_zeros", LINES)
    + ") WHERE p_zeros > 0.01",
)
def report_alerts(spark, folder):
    """Warnings of the data as a report document under the newer name of the list."""
    found = clean.zero_columns(profiling.zero_stats(lines(spark, folder), LINE_NUMBERS), 0.01)
    texts = found.agg(F.collect_list(F.concat(F.lit("[ZEROS] "), "variable")).alias("alerts"))
    path = new_table_path(spark, "report")
    texts.write.json(path)
    return read_report(spark, path)


@query("E1_label_encode_text", f"SELECT event_id, dense_rank() OVER (ORDER BY event_type) - 1 AS event_type FROM {EVENTS}")
def label_encode(spark, folder):
    return encode.label_encode(events(spark, folder), "event_type").select("event_id", "event_type")


@query("E1_label_encode_number", f"SELECT event_id, dense_rank() OVER (ORDER BY k) - 1 AS k FROM {EVENTS}")
def label_encode_number(spark, folder):
    df = encode.label_encode(events(spark, folder), "k")
    return df.select("event_id", "k")


@query("J4_apply_class_codes", "SELECT event_id, dense_rank() OVER (ORDER BY user_id) - 1 AS user_id FROM events")
def apply_codes(spark, folder):
    """Codes fitted on one frame, applied to another."""
    df = events(spark, folder)
    codes = encode.fit_label_encoder(df.select("user_id"), "user_id")
    return encode.apply_label_encoder(df, codes, "user_id").select("event_id", "user_id")


CLASS_RANK = f"(SELECT *, dense_rank() OVER (ORDER BY event_type) - 1 AS code FROM {EVENTS})"


@query(
    "E2_E3_onehot_encode",
    "SELECT event_id, " + ", ".join(f"CAST(code = {i} AS INT) AS event_type_{i}" for i in range(5)) + f" FROM {CLASS_RANK}",
)
def onehot_encode(spark, folder):
    df, names = encode.onehot_encode(events(spark, folder), "event_type")
    return df.select("event_id", *names)


@query(
    "E4_categorical_columns",
    """SELECT * FROM (SELECT 'event_type' AS variable, count(DISTINCT event_type) AS n_category FROM events
UNION ALL SELECT 'value', count(DISTINCT value) FROM events) WHERE variable = 'event_type' OR n_category < 5""",
)
def categorical_columns(spark, folder):
    kinds = profiling.infer_kind(events(spark, folder), ["event_type", "value"])
    return encode.categorical_columns(kinds)


@query(
    "E5_onehot_inputs",
    """SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'A' AS INT) AS l_returnflag_0,
  CAST(l_returnflag = 'N' AS INT) AS l_returnflag_1, CAST(l_returnflag = 'R' AS INT) AS l_returnflag_2,
  CAST(l_linestatus = 'F' AS INT) AS l_linestatus_0, CAST(l_linestatus = 'O' AS INT) AS l_linestatus_1 FROM lineitem""",
)
def onehot_inputs(spark, folder):
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return encode.onehot_inputs(df, ["l_returnflag", "l_linestatus"])


@query("E6_X6_decode_argmax", "SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS predicted FROM embeddings")
def decode_argmax(spark, folder):
    return encode.decode_argmax(table(spark, folder, "embeddings"), "embedding").select("vec_id", "predicted")


@query("E7_decode_binary", f"SELECT event_id, CAST(k > 50 AS INT) AS predicted FROM {EVENTS}")
def decode_binary(spark, folder):
    return encode.decode_binary(events(spark, folder), "k", 50).select("event_id", "predicted")


@query("E8_A12_class_count", "SELECT count(DISTINCT event_type) AS n_classes, count(DISTINCT user_id) AS n_users FROM events")
def class_count(spark, folder):
    return events(spark, folder).agg(
        F.count_distinct("event_type").alias("n_classes"), F.count_distinct("user_id").alias("n_users")
    )


@query(
    "X1_tokens",
    "SELECT item_id, regexp_extract(trim(text), '^\\S+') AS first, regexp_extract(trim(text), '\\S+$') AS last FROM benchmark",
)
def tokens(spark, folder):
    text = F.col("text")
    return table(spark, folder, "benchmark").select(
        "item_id", fn.first_token(text).alias("first"), fn.last_token(text).alias("last")
    )


@query(
    "X2_part_of_name",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'test' ELSE 'calibrate' END AS part,
  ends_with(event_type, 'k') AS ends FROM events""",
)
def part_of_name(spark, folder):
    part = F.element_at(F.array(*map(F.lit, ("train", "test", "calibrate"))), (F.col("event_id") % 3 + 1).cast("int"))
    path = F.concat(F.lit("split/"), F.col("user_id"), F.lit("-"), part, F.lit(".csv"))
    return events(spark, folder).select(
        "event_id", fn.part_of_name(path).alias("part"), F.endswith("event_type", F.lit("k")).alias("ends")
    )


@query(
    "X3_stage_name",
    "SELECT page_id, replace(regexp_extract(url, '[^/]*$'), '.', '-clean.') AS name, regexp_extract(url, '[^/]*$') AS base FROM pages",
)
def stage_name(spark, folder):
    url = F.col("url")
    return table(spark, folder, "pages").select(
        "page_id", fn.stage_name(url, "clean").alias("name"), fn.base_name(url).alias("base")
    )


@query(
    "X4_truncated_share",
    """SELECT user_id, count(*) AS n, CAST(floor(CAST(count(*) AS DOUBLE) * CAST(0.29 AS DOUBLE)) AS BIGINT) AS n_train
FROM events GROUP BY user_id""",
)
def truncated_share(spark, folder):
    df = events(spark, folder).groupBy("user_id").agg(F.count("*").alias("n"))
    return df.withColumn("n_train", fn.truncated_share(F.col("n"), 0.29))


@query(
    "X5_array_functions",
    """SELECT vec_id, round(embedding[-1]::DOUBLE, 6) + 0.0 AS last,
  round(embedding[1]::DOUBLE + embedding[2]::DOUBLE + embedding[3]::DOUBLE, 6) + 0.0 AS first_three,
  len(embedding) + 1 AS longer FROM embeddings""",
)
def array_functions(spark, folder):
    x = F.transform("embedding", lambda v: v.cast("double"))
    df = table(spark, folder, "embeddings").select("vec_id", x.alias("x"))
    total = F.aggregate(F.slice("x", 1, 3), F.lit(0.0), lambda a, b: a + b)
    return df.select(
        "vec_id",
        r6(F.element_at("x", -1)).alias("last"),
        r6(total).alias("first_three"),
        F.size(F.concat("x", F.array(F.lit(0.0)))).cast("long").alias("longer"),
    )


@query("X7_midpoint", "SELECT l_orderkey, l_linenumber, round(l_tax + (l_discount - l_tax) / 2, 6) + 0.0 AS mid FROM lineitem")
def midpoint(spark, folder):
    mid = fn.midpoint(F.col("l_tax"), F.col("l_discount"))
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", r6(mid).alias("mid"))


@query("X9_json_fields", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, props AS text FROM events")
def json_fields(spark, folder):
    df = table(spark, folder, "events")
    parsed = F.from_json("props", "map<string,long>")
    back = F.regexp_replace(F.to_json(parsed), ":", ": ")
    return df.select("event_id", F.get_json_object("props", "$.k").cast("double").alias("k"), back.alias("text"))


@query("X10_text_to_bool", "SELECT doc_id, quality = 1 AS good, toxic = 1 AS toxic FROM labels")
def text_to_bool(spark, folder):
    df = table(spark, folder, "labels")
    word = F.when(F.col("quality") == 1, "True").otherwise("False")
    return df.select(
        "doc_id",
        fn.text_to_bool(word).alias("good"),
        fn.text_to_bool(F.col("toxic").cast("string")).alias("toxic"),
    )
