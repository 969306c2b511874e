"""Queries of splits, scalers, windows, rolling and segment features."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeloom.operators import features, ordered, relevance, windows as win
from gaugeloom.operators.ordered import null_safe_join
from gaugeloom.operators.scale import Scaler, apply_scaler, fit_scaler, invert_scaler, scale_in_out, scale_pair, train_rows
from gaugeloom.operators.split import split_rows, split_series, validation_tail
from gaugeloom.plans.queries.catalog import (
    EVENT_ORDER,
    EVENT_ROWS,
    EVENT_SERIES,
    EVENTS,
    LINE_ORDER,
    LINE_SERIES,
    LINE_SQL_ORDER,
    LINES,
    event_parts,
    events,
    lines,
    query,
    r6,
    rounded,
)
from gaugeloom.session import staged

LINE_ROWS = f"""(SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {LINE_SQL_ORDER}) - 1 AS idx,
  count(*) OVER (PARTITION BY l_suppkey) AS n_rows FROM {LINES})"""
PARTS = event_parts(0.7)


def parts(spark, folder, train=0.7, calibrate=0.0):
    return split_rows(events(spark, folder), train, calibrate, EVENT_SERIES, EVENT_ORDER)


def split_once(spark, folder):
    """The split rows written once, for a fit and its application to read."""
    kept = ["user_id", "event_id", "part", "part_idx", "idx", "n_rows", "k", "value"]
    return staged(parts(spark, folder).select(*kept), "split")


def flagship(spark, folder):
    """Split each user's events, scale the input by the train part, cut windows of five rows."""
    rows = split_once(spark, folder)
    scaled = apply_scaler(rows, fit_scaler(rows, ["k"], "minmax"))
    made = win.windows(scaled, ["k"], "value", 5, 1, EVENT_SERIES, EVENT_ORDER)
    x = [r6(F.col("X")[i][0]).alias(f"x{i}") for i in range(5)]
    return made.select("user_id", "part", "idx", *x, F.col("y")[0].alias("y"))


SCALED_K = f"(SELECT p.* REPLACE ((k - lo) / (hi - lo) AS k) FROM {PARTS} p, (SELECT min(k) AS lo, max(k) AS hi FROM {PARTS} WHERE part = 'train'))"
FLAGSHIP_SQL = f"""SELECT user_id, part, idx,
  {", ".join(f"round(lag(k, {4 - i}) OVER w, 6) AS x{i}" for i in range(5))}, value AS y
FROM {SCALED_K} WINDOW w AS (PARTITION BY user_id, part ORDER BY idx) QUALIFY part_idx >= 4"""
query("flagship_scaled_windows", FLAGSHIP_SQL)(flagship)


@query("A13_row_counts", f"SELECT user_id, event_id, idx, n_rows FROM {EVENT_ROWS}")
def row_counts(spark, folder):
    return ordered.positions(events(spark, folder), EVENT_SERIES, EVENT_ORDER).select("user_id", "event_id", "idx", "n_rows")


@query("A13_row_counts_any_size", f"SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, idx, n_rows FROM {LINE_ROWS}")
def row_counts_any_size(spark, folder):
    """The way taken when a series is too long for one task."""
    df = ordered.positions(lines(spark, folder), LINE_SERIES, LINE_ORDER, max_rows=0)
    return df.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "idx", "n_rows")


@query("W1_split_rows", f"SELECT user_id, event_id, part, part_idx FROM {PARTS}")
def split_by_rows(spark, folder):
    return parts(spark, folder).select("user_id", "event_id", "part", "part_idx")


@query("W2_split_rows_calibrate", f"SELECT user_id, event_id, part, part_idx FROM {event_parts(0.6, 0.2)}")
def split_calibrate(spark, folder):
    return parts(spark, folder, 0.6, 0.2).select("user_id", "event_id", "part", "part_idx")


def _series_split_sql(key):
    return f"""SELECT e.user_id, e.event_id, CASE WHEN place < n_train THEN 'train' WHEN place < n_train + n_cal THEN 'calibrate'
  ELSE 'test' END AS part FROM events e JOIN (SELECT user_id, row_number() OVER (ORDER BY {key}) - 1 AS place,
  floor(CAST(count(*) OVER () AS DOUBLE) * 0.6::DOUBLE) AS n_train, floor(CAST(count(*) OVER () AS DOUBLE) * 0.2::DOUBLE) AS n_cal
  FROM (SELECT DISTINCT user_id FROM events)) s ON e.user_id = s.user_id"""


@query("W3_split_series", _series_split_sql("CAST(user_id AS VARCHAR)"))
def split_by_series(spark, folder):
    return split_series(events(spark, folder), 0.6, 0.2, EVENT_SERIES).select("user_id", "event_id", "part")


@query("W4_split_shuffled_series", _series_split_sql("md5('2020|' || CAST(user_id AS VARCHAR))"))
def split_shuffled(spark, folder):
    df = split_series(events(spark, folder), 0.6, 0.2, EVENT_SERIES, shuffle=True)
    return df.select("user_id", "event_id", "part")


@query(
    "M9_validation_tail",
    f"""SELECT user_id, event_id, row_number() OVER (ORDER BY user_id, ts, event_id) - 1 >=
  floor(CAST(count(*) OVER () AS DOUBLE) * 0.75::DOUBLE) AS validation FROM {EVENTS}""",
)
def validation(spark, folder):
    df = validation_tail(events(spark, folder), 0.25, EVENT_SERIES, EVENT_ORDER)
    return df.select("user_id", "event_id", "validation")


def _scaled(method):
    def run(spark, folder):
        rows = split_once(spark, folder)
        scaler = fit_scaler(rows, ["k", "value"], method)
        return rounded(apply_scaler(rows, scaler).select("event_id", "part", "k", "value"), "k", "value")

    return run


def _scaled_sql(center, scale):
    at = {c: center.format(c=c) for c in ("k", "value")}
    by = {c: scale.format(c=c) for c in ("k", "value")}
    return f"""SELECT event_id, part, round((k - ck) / sk, 6) + 0.0 AS k, round((value - cv) / sv, 6) + 0.0 AS value
FROM {PARTS}, (SELECT {at["k"]} AS ck, {by["k"]} AS sk, {at["value"]} AS cv, {by["value"]} AS sv FROM {PARTS} WHERE part = 'train')"""


query("A1_A4_minmax", _scaled_sql("min({c})", "max({c}) - min({c})"))(_scaled("minmax"))
query("A2_A4_standard", _scaled_sql("avg({c})", "stddev_pop({c})"))(_scaled("standard"))
ROBUST_SQL = _scaled_sql("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)")
query("A3_A4_robust", ROBUST_SQL)(_scaled("robust"))
query("A5_identity", f"SELECT event_id, part, k, value FROM {PARTS}")(_scaled(None))


@query("A3_robust_any_size", ROBUST_SQL)
def robust_any_size(spark, folder):
    rows = split_once(spark, folder)
    scaler = fit_scaler(rows, ["k", "value"], "robust", exact_rows=0)
    return rounded(apply_scaler(rows, scaler).select("event_id", "part", "k", "value"), "k", "value")


@query(
    "A6_separate_scalers",
    f"""SELECT event_id, round((k - ck) / sk, 6) + 0.0 AS k, round((value - cv) / sv, 6) + 0.0 AS value FROM {PARTS},
  (SELECT avg(k) AS ck, stddev_pop(k) AS sk, min(value) AS cv, max(value) - min(value) AS sv FROM {PARTS} WHERE part = 'train')""",
)
def separate_scalers(spark, folder):
    df, _, _ = scale_in_out(split_once(spark, folder), ["k"], ["value"], "standard", "minmax")
    return rounded(df.select("event_id", "k", "value"), "k", "value")


@query(
    "A7_scale_pair",
    f"""SELECT l_orderkey, l_linenumber, round((price - lo) / (hi - lo), 6) + 0.0 AS price FROM {LINES},
  (SELECT min(price) AS lo, max(price) AS hi FROM {LINES} WHERE l_returnflag = 'A') WHERE l_returnflag <> 'A'""",
)
def pair_scaled(spark, folder):
    df = lines(spark, folder).select("l_orderkey", "l_linenumber", "l_returnflag", "price")
    _, other, _ = scale_pair(df.where("l_returnflag = 'A'"), df.where("l_returnflag <> 'A'"), ["price"])
    return rounded(other.drop("l_returnflag"), "price")


@query("A8_inverse", f"SELECT event_id, round(k, 6) + 0.0 AS k, round(value, 6) AS value FROM {EVENTS}")
def inverse(spark, folder):
    rows = split_once(spark, folder)
    scaler = fit_scaler(rows, ["k", "value"], "standard")
    restored = invert_scaler(apply_scaler(rows, scaler), scaler)
    return rounded(restored.select("event_id", "k", "value"), "k", "value")


@query(
    "J3_scaler_table",
    f"""SELECT 'k' AS feature, round(avg(k), 6) AS center, round(stddev_pop(k), 6) AS scale FROM {PARTS} WHERE part = 'train'
UNION ALL SELECT 'value', round(avg(value), 6), round(stddev_pop(value), 6) FROM {PARTS} WHERE part = 'train'""",
)
def scaler_table(spark, folder):
    table = fit_scaler(parts(spark, folder), ["k", "value"], "standard").table(spark)
    return rounded(Scaler.from_table(table).table(spark), "center", "scale")


@query("U3_train_rows", f"SELECT event_id, k FROM {PARTS} WHERE part = 'train'")
def only_train(spark, folder):
    return train_rows(parts(spark, folder)).select("event_id", "k")


WINDOW3 = "WINDOW w AS (PARTITION BY l_suppkey ORDER BY idx)"


@query(
    "W5_W7_windows",
    f"""SELECT l_suppkey, idx, lag(quantity, 2) OVER w AS q0, lag(quantity) OVER w AS q1, quantity AS q2,
  lag(tax, 2) OVER w AS t0, lag(tax) OVER w AS t1, tax AS t2, lag(price) OVER w AS y0, price AS y1
FROM {LINE_ROWS} {WINDOW3} QUALIFY idx >= 2""",
)
def plain_windows(spark, folder):
    made = win.windows(lines(spark, folder), ["quantity", "tax"], "price", 3, 2, LINE_SERIES, LINE_ORDER)
    x = [F.col("X")[i][j].alias(f"{n}{i}") for j, n in enumerate("qt") for i in range(3)]
    return made.select("l_suppkey", "idx", *x, *[F.col("y")[i].alias(f"y{i}") for i in range(2)])


@query(
    "W5_windows_wide",
    f"""SELECT l_suppkey, idx, 60 AS n_values, round(sum(quantity + discount + tax) OVER w, 4) AS total, price AS y
FROM {LINE_ROWS} WINDOW w AS (PARTITION BY l_suppkey ORDER BY idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) QUALIFY idx >= 19""",
)
def wide_windows(spark, folder):
    made = win.windows(lines(spark, folder), ["quantity", "discount", "tax"], "price", 20, 1, LINE_SERIES, LINE_ORDER)
    flat = F.flatten("X")
    total = F.aggregate(flat, F.lit(0.0), lambda a, b: a + b)
    return made.select("l_suppkey", "idx", F.size(flat).alias("n_values"), r6(total, 4).alias("total"), F.col("y")[0].alias("y"))


@query(
    "W5_windows_one_long_series",
    f"""SELECT idx, lag(k, 4) OVER w AS x0, lag(k, 3) OVER w AS x1, lag(k, 2) OVER w AS x2, lag(k) OVER w AS x3, k AS x4, value AS y
FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS idx FROM {EVENTS}) WINDOW w AS (ORDER BY idx) QUALIFY idx >= 4""",
)
def long_series_windows(spark, folder):
    """All events as one series, spread over range pieces and blocks."""
    made = win.windows(events(spark, folder), ["k"], "value", 5, 1, [], EVENT_ORDER, max_rows=0, block_rows=512)
    return made.select("idx", *[F.col("X")[i][0].alias(f"x{i}") for i in range(5)], F.col("y")[0].alias("y"))


@query(
    "W8_x_windows",
    f"""SELECT user_id, idx, lag(k, 3) OVER w AS first, k AS last FROM {EVENT_ROWS}
WINDOW w AS (PARTITION BY user_id ORDER BY idx) QUALIFY idx >= 3 AND (idx - 3) % 4 = 0""",
)
def input_windows(spark, folder):
    made = win.x_windows(events(spark, folder), ["k"], 4, 0, EVENT_SERIES, EVENT_ORDER)
    return made.select("user_id", "idx", F.col("X")[0][0].alias("first"), F.col("X")[3][0].alias("last"))


@query(
    "W9_windows_overlap",
    f"""SELECT user_id, part, idx, lag(k, 3) OVER w AS first, k AS last, value AS y FROM {PARTS}
WINDOW w AS (PARTITION BY user_id, part ORDER BY idx) QUALIFY part_idx >= 3 AND (part_idx - 3) % 2 = 0""",
)
def overlapping_windows(spark, folder):
    made = win.windows(parts(spark, folder), ["k"], "value", 4, 1, EVENT_SERIES, EVENT_ORDER, overlap=2)
    x = F.col("X")
    return made.select("user_id", "part", "idx", x[0][0].alias("first"), x[3][0].alias("last"), F.col("y")[0].alias("y"))


@query(
    "W10_windows_future",
    f"""SELECT user_id, idx, lag(k, 4) OVER w AS x0, lag(k, 3) OVER w AS x1, lag(k, 2) OVER w AS x2,
  lag(value) OVER w AS y0, value AS y1 FROM {EVENT_ROWS} WINDOW w AS (PARTITION BY user_id ORDER BY idx) QUALIFY idx >= 4""",
)
def future_windows(spark, folder):
    made = win.windows(events(spark, folder), ["k"], "value", 3, 2, EVENT_SERIES, EVENT_ORDER, future=True)
    x = [F.col("X")[i][0].alias(f"x{i}") for i in range(3)]
    return made.select("user_id", "idx", *x, *[F.col("y")[i].alias(f"y{i}") for i in range(2)])


@query(
    "W11_shuffle_samples",
    f"""SELECT user_id, idx, row_number() OVER (PARTITION BY user_id ORDER BY
  md5('2020|' || CAST(user_id AS VARCHAR) || '|' || CAST(idx AS VARCHAR)), idx) - 1 AS sample FROM {EVENT_ROWS}""",
)
def shuffled_samples(spark, folder):
    rows = ordered.positions(events(spark, folder), EVENT_SERIES, EVENT_ORDER).select("user_id", "idx")
    return win.shuffle_samples(rows, 2020, EVENT_SERIES)


@query(
    "W11_shuffle_samples_combined",
    """SELECT user_id, event_id, row_number() OVER (ORDER BY
  md5('7|' || CAST(user_id AS VARCHAR) || '|' || CAST(event_id AS VARCHAR)), user_id, event_id) - 1 AS sample FROM events""",
)
def shuffled_combined(spark, folder):
    rows = events(spark, folder).select("user_id", "event_id")
    return win.shuffle_samples(rows, 7, EVENT_SERIES, ["event_id"], combined=True)


def _line_windows(spark, folder):
    return win.windows(lines(spark, folder), ["quantity", "tax"], "price", 2, 1, LINE_SERIES, LINE_ORDER)


FLAT_SQL = f"""SELECT l_suppkey, idx, lag(quantity) OVER w AS a, lag(tax) OVER w AS b, quantity AS c, tax AS d
FROM {LINE_ROWS} {WINDOW3} QUALIFY idx >= 1"""


@query("W12_flatten_windows", FLAT_SQL)
def flat_windows(spark, folder):
    flat = win.flatten_windows(_line_windows(spark, folder))
    return flat.select("l_suppkey", "idx", *[F.col("X")[i].alias(n) for i, n in enumerate("abcd")])


@query(
    "W13_split_hist_added",
    f"""SELECT l_suppkey, idx, lag(quantity) OVER w AS h0, quantity AS h1, tax AS added FROM {LINE_ROWS} {WINDOW3} QUALIFY idx >= 1""",
)
def hist_added(spark, folder):
    df = win.split_hist_added(_line_windows(spark, folder), ["quantity", "tax"], ["tax"])
    h = F.col("X_hist")
    return df.select("l_suppkey", "idx", h[0][0].alias("h0"), h[1][0].alias("h1"), F.col("X_added")[0].alias("added"))


@query(
    "W14_merge_hist_added",
    f"""SELECT l_suppkey, idx, lag(quantity) OVER w AS a, quantity AS b, tax AS c FROM {LINE_ROWS} {WINDOW3} QUALIFY idx >= 1""",
)
def merged(spark, folder):
    df = win.merge_hist_added(win.split_hist_added(_line_windows(spark, folder), ["quantity", "tax"], ["tax"]))
    return df.select("l_suppkey", "idx", *[F.col("X")[i].alias(n) for i, n in enumerate("abc")])


ROLLING_SQL = f"""SELECT l_suppkey, idx, round(avg(quantity) OVER w, 6) AS quantity_mean, min(quantity) OVER w AS quantity_min,
  max(quantity) OVER w AS quantity_max, round(stddev_pop(quantity) OVER w, 5) + 0.0 AS quantity_std FROM {LINE_ROWS}
WINDOW w AS (PARTITION BY l_suppkey ORDER BY idx ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"""


def _rolling(spark, folder, **limits):
    df = features.add_rolling_features(lines(spark, folder), ["quantity"], 10, LINE_SERIES, LINE_ORDER, **limits)
    df = df.select("l_suppkey", "idx", "quantity_mean", "quantity_min", "quantity_max", "quantity_std")
    return rounded(rounded(df, "quantity_mean"), "quantity_std", places=5)


@query("W15_rolling_features", ROLLING_SQL)
def rolling(spark, folder):
    return _rolling(spark, folder)


@query("W15_rolling_features_blocks", ROLLING_SQL)
def rolling_blocks(spark, folder):
    """The same frames with every series cut into blocks of 64 rows."""
    return _rolling(spark, folder, max_rows=0, block_rows=64)


def _segments(spark, folder):
    return features.segment(lines(spark, folder), 100, LINE_SERIES, LINE_ORDER)


SEGMENTS = f"(SELECT *, idx // 100 + 1 AS segment FROM {LINE_ROWS} WHERE idx // 100 + 1 <= n_rows // 100)"


@query("W16_segments", f"SELECT l_suppkey, idx, segment FROM {SEGMENTS}")
def segments(spark, folder):
    return _segments(spark, folder).select("l_suppkey", "idx", "segment")


TARGETS = f"SELECT l_suppkey, segment, max_by(price, idx) AS target FROM {SEGMENTS} GROUP BY ALL"


@query("W17_segment_target", TARGETS)
def segment_target(spark, folder):
    return features.segment_target(_segments(spark, folder), "price", LINE_SERIES)


STATS = f"""SELECT l_suppkey, segment, (max(x) - min(x)) / 2 AS amplitude, avg(CAST(abs(x - m) > s AS INT)) AS percent_beyond_1_std,
  max(x) AS maximum, max(abs(x - before)) AS max_slope, any_value(med) AS median, quantile_cont(abs(x - med), 0.5) AS median_absolute_deviation,
  avg(CAST(abs(x - med) < width * 0.1 AS INT)) AS percent_close_to_median, min(x) AS minimum, any_value(g) AS skew,
  stddev_pop(x) AS std, avg(x) AS weighted_average
FROM (SELECT l_suppkey, segment, quantity AS x, avg(quantity) OVER w AS m, stddev_pop(quantity) OVER w AS s, quantile_cont(quantity, 0.5) OVER w AS med,
  max(quantity) OVER w - min(quantity) OVER w AS width, lag(quantity) OVER (PARTITION BY l_suppkey, segment ORDER BY idx) AS before,
  skewness(quantity) OVER w * 98 / sqrt(100 * 99) AS g FROM {SEGMENTS} WINDOW w AS (PARTITION BY l_suppkey, segment)) GROUP BY ALL"""
STAT_NAMES = [
    "amplitude", "percent_beyond_1_std", "maximum", "max_slope", "median", "median_absolute_deviation",
    "percent_close_to_median", "minimum", "skew", "std", "weighted_average",
]


@query(
    "W20_segment_stats",
    "SELECT l_suppkey, segment, " + ", ".join(f"round({c}, 5) + 0.0 AS {c}" for c in STAT_NAMES) + f" FROM ({STATS})",
)
def segment_stats(spark, folder):
    return rounded(features.segment_stats(_segments(spark, folder), "quantity", LINE_SERIES), *STAT_NAMES, places=5)


@query(
    "W19_relevant_features",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, round(corr({c}, target), 5) + 0.0 AS r FROM ({STATS}) JOIN ({TARGETS}) USING (l_suppkey, segment)"
        for c in STAT_NAMES
    )
    + ") WHERE abs(r) >= 0.0",
)
def relevant(spark, folder):
    rows = _segments(spark, folder)
    stats = features.segment_stats(rows, "quantity", LINE_SERIES)
    targets = features.segment_target(rows, "price", LINE_SERIES)
    return rounded(features.relevant_features(stats, targets, LINE_SERIES), "r", places=5)


#: Twice the normal tail beyond z, by Simpson's rule over 2,000 steps.
TAIL = """greatest(0, 1 - sqrt(2 / pi()) * w / 6000 * list_sum(list_transform(range(2001), lambda i:
  (CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(-(i * w / 2000) * (i * w / 2000) / 2))))"""


def _step_up_sql(tests, independent):
    """Tests (variable, class, n, z) with p-values and those that a step-up at 0.05 within each class keeps."""
    divisor = "1" if independent else "list_sum(list_transform(range(1, m + 1), lambda i: 1.0::DOUBLE / i))"
    return f"""WITH t AS ({tests}), p AS (SELECT *, CASE WHEN z IS NULL THEN 1 ELSE {TAIL} END AS p
  FROM (SELECT *, least(abs(z), 10) AS w FROM t)),
o AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY p) AS k, count(*) OVER (PARTITION BY class) AS m FROM p),
l AS (SELECT *, max(CASE WHEN p <= 0.05 * k / m / {divisor} THEN p ELSE -1 END) OVER (PARTITION BY class) AS border FROM o)
SELECT variable, class, n::BIGINT AS n, round(z, 5) + 0.0 AS z, round(p, 6) + 0.0 AS p_value, p <= border AS relevant FROM l"""


def _kendall_sql(c):
    """Kendall's score over its deviation, rows compared pairwise."""
    ties = "(SELECT struct_pack(t2 := sum(k * (k - 1) / 2), t3 := sum(k * (k - 1) * (k - 2)), t5 := sum(k * (k - 1) * (2 * k + 5))) FROM (SELECT count(*)::DOUBLE AS k FROM g GROUP BY {s}))"
    return f"""SELECT '{c}' AS variable, NULL::VARCHAR AS class, n, CASE WHEN a.t2 < n * (n - 1) / 2 AND b.t2 < n * (n - 1) / 2 THEN
  score / sqrt((n * (n - 1) * (2 * n + 5) - a.t5 - b.t5) / 18 + 2 * a.t2 * b.t2 / (n * (n - 1)) + a.t3 * b.t3 / (9 * n * (n - 1) * (n - 2))) END AS z FROM (
WITH g AS (SELECT round({c}, 5) AS x, target AS y FROM s WHERE {c} IS NOT NULL)
SELECT (SELECT count(*)::DOUBLE FROM g) AS n, {ties.format(s='x')} AS a, {ties.format(s='y')} AS b,
  (SELECT sum(sign(q.y - p.y))::DOUBLE FROM g p JOIN g q ON p.x < q.x) AS score)"""


W19_VALUES = f"WITH s AS (SELECT * FROM ({STATS}) JOIN ({TARGETS}) USING (l_suppkey, segment)) " + " UNION ALL ".join(map(_kendall_sql, STAT_NAMES))


@query("W19_relevance_of_statistics", _step_up_sql(W19_VALUES, False))
def relevance_of_statistics(spark, folder):
    """Segment statistics tested against the segment's last price; the tests depend on each other."""
    rows = _segments(spark, folder)
    stats = rounded(features.segment_stats(rows, "quantity", LINE_SERIES), *STAT_NAMES, places=5)
    joined = null_safe_join(stats, features.segment_target(rows, "price", LINE_SERIES), [*LINE_SERIES, "segment"])
    found = relevance.relevance(joined, "target", STAT_NAMES)
    return rounded(rounded(found, "z", places=5), "p_value")


W19_COLUMNS = ["quantity", "price", "discount", "tax", "sparse"]


def _rank_sum_sql(c, target, classes):
    name = f"(SELECT DISTINCT {target} AS class FROM {LINES} WHERE {target} IS NOT NULL{classes})"
    return f"""SELECT '{c}' AS variable, class, n, CASE WHEN spread > 0 THEN sign(away) * greatest(abs(away) - 0.5, 0) / sqrt(spread) END AS z FROM (
SELECT class, n, ranks - m * (n + 1) / 2 AS away, m * (n - m) / 12 * (n + 1 - ties / (n * (n - 1))) AS spread FROM (
SELECT class, count(*)::DOUBLE AS n, count(*) FILTER (y = class)::DOUBLE AS m, sum(r) FILTER (y = class) AS ranks, sum((k * k - 1))::DOUBLE AS ties
FROM (SELECT {target} AS y, count(*) OVER (PARTITION BY {c})::DOUBLE AS k, rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS r
  FROM {LINES} WHERE {c} IS NOT NULL AND {target} IS NOT NULL), {name} GROUP BY class))"""


def _class_tests(target, classes):
    return " UNION ALL ".join(_rank_sum_sql(c, target, classes) for c in W19_COLUMNS)


@query("W19_relevance_for_two_classes", _step_up_sql(_class_tests("l_linestatus", " AND l_linestatus = 'O'"), True))
def relevance_for_two_classes(spark, folder):
    found = relevance.relevance(lines(spark, folder), "l_linestatus", W19_COLUMNS, classes=True, independent=True)
    return rounded(rounded(found, "z", places=5), "p_value")


@query("W19_relevance_for_three_classes", _step_up_sql(_class_tests("l_returnflag", ""), False))
def relevance_for_three_classes(spark, folder):
    found = relevance.relevance(lines(spark, folder), "l_returnflag", W19_COLUMNS, classes=True)
    return rounded(rounded(found, "z", places=5), "p_value")


def _prefix_sql(frame):
    """Whole cents, so that sums are exact and means equal to the last digit."""
    return f"""SELECT l_suppkey, idx, count(*) OVER w AS rows, sum(cents) OVER w AS sum, min(cents) OVER w AS minimum,
  max(cents) OVER w AS maximum, sum(cents) OVER w / count(*) OVER w AS mean
FROM (SELECT *, round(price * 100) AS cents FROM {LINE_ROWS})
WINDOW w AS (PARTITION BY l_suppkey ORDER BY idx ROWS BETWEEN {frame} PRECEDING AND CURRENT ROW)"""


def _prefix(spark, folder, window_rows):
    df = lines(spark, folder).withColumn("cents", F.round(F.col("price") * 100))
    df = features.prefix_windows(df, "cents", LINE_SERIES, LINE_ORDER, window_rows, block_rows=256)
    return df.select("l_suppkey", "idx", "rows", "sum", "minimum", "maximum", "mean")


@query("W18_prefix_windows", _prefix_sql("UNBOUNDED"))
def prefixes(spark, folder):
    return _prefix(spark, folder, None)


@query("W18_prefix_windows_bounded", _prefix_sql("24"))
def bounded_prefixes(spark, folder):
    return _prefix(spark, folder, 25)


SPARSE_CENTS = "CASE WHEN l_linenumber > 2 THEN round(price * 100) END"
SPARSE_SERIES = "nullif(l_suppkey, 1)"


@query(
    "W18_prefix_windows_nulls",
    f"""SELECT series, idx, count(*) OVER w AS rows, sum(cents) OVER w AS sum, min(cents) OVER w AS minimum,
  max(cents) OVER w AS maximum, avg(cents) OVER w AS mean
FROM (SELECT *, {SPARSE_SERIES} AS series, {SPARSE_CENTS} AS cents FROM {LINE_ROWS})
WINDOW w AS (PARTITION BY series ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def prefixes_with_nulls(spark, folder):
    """Null values, blocks that begin with them, and a series without a name."""
    df = lines(spark, folder).select(
        F.expr(SPARSE_SERIES).alias("series"), F.expr(SPARSE_CENTS).alias("cents"), *[c for c in LINE_ORDER]
    )
    df = features.prefix_windows(df, "cents", ["series"], LINE_ORDER, block_rows=4)
    return df.select("series", "idx", "rows", "sum", "minimum", "maximum", "mean")


@query(
    "U2_combine_parts",
    f"SELECT user_id, idx, k AS last, value AS y FROM {PARTS} WHERE part = 'test' AND part_idx >= 2",
)
def combine(spark, folder):
    made = win.windows(parts(spark, folder), ["k"], "value", 3, 1, EVENT_SERIES, EVENT_ORDER)
    test = win.combine(made, "test")
    return test.select("user_id", "idx", F.col("X")[2][0].alias("last"), F.col("y")[0].alias("y"))


@query(
    "W21_thin_sequences",
    f"""SELECT user_id, idx + step AS time_step, CASE step WHEN 0 THEN k WHEN 1 THEN value ELSE k + value END AS value, idx // 3 AS curve
FROM {EVENT_ROWS}, (VALUES (0), (1), (2)) AS s(step) WHERE idx % 3 = 0 AND idx + 3 <= n_rows""",
)
def thin(spark, folder):
    rows = ordered.positions(events(spark, folder), EVENT_SERIES, EVENT_ORDER)
    sequences = rows.select("user_id", "idx", F.array("k", "value", F.col("k") + F.col("value")).alias("predicted"))
    return win.thin_sequences(sequences, 3, "predicted", EVENT_SERIES)
