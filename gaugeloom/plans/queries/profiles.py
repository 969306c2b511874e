"""Queries of the profile tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeloom.operators import correlation, profile_state, profiling, ranks
from gaugeloom.plans.queries.catalog import (
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

LINE_COLUMNS = [*LINE_NUMBERS, "fixed"]
COUNTED = [*LINE_COLUMNS, "l_returnflag"]


def value_sql(columns: list[str], source: str) -> str:
    parts = [
        f"SELECT '{c}' AS variable, {c} AS value, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in columns
    ]
    return "(" + " UNION ALL ".join(parts) + ")"


COUNTS_SQL = per_column(
    COUNTED,
    "count(*) AS n, count(*) - count({c}) AS n_missing, round(1 - count({c}) / count(*), 6) + 0.0 AS p_missing, "
    "count(DISTINCT {c}) AS n_distinct, round(count(DISTINCT {c}) / count({c}), 6) AS p_distinct, "
    f"(SELECT count(*) FROM (SELECT {{c}} FROM {LINES} WHERE {{c}} IS NOT NULL GROUP BY {{c}} HAVING count(*) = 1)) AS n_unique",
    LINES,
)


@query("P2_count_stats", COUNTS_SQL)
def count_stats(spark, folder):
    df = profiling.count_stats(lines(spark, folder), COUNTED).drop("p_unique")
    return rounded(df, "p_missing", "p_distinct")


STATS_SQL = per_column(
    LINE_NUMBERS,
    "round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(max({c}) - min({c}), 6) AS range, "
    "round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(var_samp({c}), 2) AS variance, "
    "round(sum({c}), 2) AS sum, round(stddev_samp({c}) / avg({c}), 6) AS cv, "
    "round(skewness({c}), 5) + 0.0 AS skewness, round(kurtosis({c}), 5) + 0.0 AS kurtosis",
    LINES,
)


@query("P3_numeric_stats", STATS_SQL)
def numeric_stats(spark, folder):
    df = rounded(profiling.numeric_stats(lines(spark, folder), LINE_NUMBERS), "min", "max", "range", "cv")
    df = rounded(df, "mean", "std", places=4)
    return rounded(rounded(df, "skewness", "kurtosis", places=5), "variance", "sum", places=2)


MERGED_SQL = per_column(
    LINE_NUMBERS,
    "count(*) AS n, count(*) - count({c}) AS n_missing, count(*) FILTER ({c} = 0) AS n_zeros, round(min({c}), 6) AS min, "
    "round(max({c}), 6) AS max, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
    "round(skewness({c}), 5) + 0.0 AS skewness, round(kurtosis({c}), 5) + 0.0 AS kurtosis",
    LINES,
)


@query("P0_P2_P3_merged_profile", MERGED_SQL)
def merged_profile(spark, folder):
    """States per month of shipping, written as a table in two goes, then merged."""
    df = lines(spark, folder).withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    path = new_table_path(spark, "states")
    profile_state.add_pieces(df.where("month < '1995-01'"), path, "month", LINE_NUMBERS)
    rows = profile_state.add_pieces(df, path, "month", LINE_NUMBERS)
    found = profile_state.described(profile_state.merged(rows))
    kept = ["variable", "n", "n_missing", "n_zeros", "min", "max", "mean", "std", "skewness", "kurtosis"]
    return rounded(rounded(rounded(found.select(*kept), "min", "max"), "mean", "std", places=4), "skewness", "kurtosis", places=5)


@query(
    "P3_deviation_stats",
    per_column(
        LINE_NUMBERS,
        "round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 4) + 0.0 AS iqr, round(mad({c}), 4) AS mad",
        LINES,
    ),
)
def deviation_stats(spark, folder):
    df = profiling.deviation_stats(lines(spark, folder), LINE_NUMBERS).select("variable", "iqr", "mad")
    return rounded(df, "iqr", "mad", places=4)


QUANTILE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, CAST({p} AS DOUBLE) AS prob, round(quantile_cont({c}, {p}), 4) AS value FROM {LINES}"
    for c in LINE_NUMBERS
    for p in profiling.QUANTILES
)


@query("P3b_quantiles", QUANTILE_SQL)
def quantiles(spark, folder):
    return rounded(profiling.quantiles(lines(spark, folder), LINE_NUMBERS), "value", places=4)


@query("P3b_quantiles_any_size", QUANTILE_SQL)
def quantiles_any_size(spark, folder):
    """The way taken beyond the size limit: bracket, count, pick."""
    return rounded(profiling.quantiles(lines(spark, folder), LINE_NUMBERS, exact_rows=0), "value", places=4)


@query(
    "P4_low_cardinality",
    "SELECT * FROM (" + per_column(COUNTED, "count(DISTINCT {c}) AS n_distinct", LINES) + ") WHERE n_distinct < 5",
)
def low_cardinality(spark, folder):
    return profiling.low_cardinality(profiling.count_stats(lines(spark, folder), COUNTED))


@query(
    "P5_zero_stats",
    per_column(
        LINE_COLUMNS,
        "count(*) FILTER ({c} = 0) AS n_zeros, round(count(*) FILTER ({c} = 0) / count(*), 6) AS p_zeros, "
        "count(*) FILTER ({c} < 0) AS n_negative, round(count(*) FILTER ({c} < 0) / count(*), 6) AS p_negative, "
        "count(*) FILTER (isinf({c})) AS n_infinite, 0.0::DOUBLE AS p_infinite",
        LINES,
    ),
)
def zero_stats(spark, folder):
    return rounded(profiling.zero_stats(lines(spark, folder), LINE_COLUMNS), "p_zeros", "p_negative", "p_infinite")


@query(
    "P6_text_lengths",
    """SELECT 'text' AS variable, min(length(text)) AS min_length, max(length(text)) AS max_length,
  round(avg(length(text)), 6) AS mean_length, round(quantile_cont(length(text), 0.5), 6) AS median_length,
  CAST(sum(length(text)) AS BIGINT) AS n_characters FROM documents""",
)
def text_lengths(spark, folder):
    df = profiling.text_lengths(table(spark, folder, "documents"), ["text"])
    return rounded(df, "mean_length", "median_length")


@query(
    "P6_word_counts",
    r"""SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[ \t\r\n]+')) AS word
FROM documents) WHERE word <> '' GROUP BY word""",
)
def word_counts(spark, folder):
    return profiling.word_counts(table(spark, folder, "documents"), "text")


@query(
    "P6_character_counts",
    """SELECT character, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '(?s).')) AS character FROM documents)
GROUP BY character""",
)
def character_counts(spark, folder):
    return profiling.character_counts(table(spark, folder, "documents"), "text")


@query("P6_text_samples", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 5")
def text_samples(spark, folder):
    return profiling.text_samples(table(spark, folder, "documents"), "text", ["doc_id"])


@query(
    "P7_map_boolean",
    """SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN true WHEN 'N' THEN false END AS flag FROM lineitem""",
)
def map_boolean(spark, folder):
    word = F.when(F.col("l_returnflag") == "R", "Yes").when(F.col("l_returnflag") == "N", " no").otherwise("maybe")
    df = table(spark, folder, "lineitem").withColumn("word", word)
    return df.select("l_orderkey", "l_linenumber", profiling.map_boolean(df, "word").alias("flag"))


@query(
    "P1_infer_kind",
    """SELECT * FROM (SELECT 'quantity' AS variable, CASE WHEN count(DISTINCT l_quantity) < 5 THEN 'Categorical' ELSE 'Numeric' END AS kind FROM lineitem
UNION ALL SELECT 'fixed', 'Categorical' UNION ALL SELECT 'l_returnflag', 'Categorical' UNION ALL SELECT 'l_shipdate', 'Unsupported'
UNION ALL SELECT 'answer', CASE WHEN bool_and(l_linestatus IN ('F', 'O')) THEN 'Boolean' ELSE 'Categorical' END FROM lineitem)""",
)
def infer_kind(spark, folder):
    df = lines(spark, folder).withColumn("answer", F.when(F.col("l_linestatus") == "F", "yes").when(F.col("l_linestatus") == "O", "no"))
    return profiling.infer_kind(df, ["quantity", "fixed", "l_returnflag", "l_shipdate", "answer"]).select("variable", "kind")


PEARSON_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS variable, '{b}' AS other, "
    + ("CAST(NULL AS DOUBLE)" if "fixed" in (a, b) else f"round(corr({a}, {b}), 6) + 0.0")
    + f" AS r{f' FROM {LINES}' if 'fixed' not in (a, b) else ''}"
    for a in LINE_COLUMNS
    for b in LINE_COLUMNS
    if a != b
)


@query("P9_pearson", PEARSON_SQL)
def pearson(spark, folder):
    return rounded(correlation.correlations(lines(spark, folder), LINE_COLUMNS), "r")


def _spearman_sql(a, b, source):
    rank = "rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"
    return (
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr(ra, rb), 6) + 0.0 AS r FROM (SELECT {rank.format(c=a)} AS ra, "
        f"{rank.format(c=b)} AS rb FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    )


PAIRS = [("quantity", "price"), ("discount", "tax"), ("price", "sparse")]


@query("P10_spearman", " UNION ALL ".join(_spearman_sql(a, b, LINES) for a, b in PAIRS))
def spearman(spark, folder):
    found = ranks.spearman_pairs(lines(spark, folder), PAIRS)
    rows = [(a, b, r) for (a, b), r in zip(PAIRS, found)]
    return rounded(spark.createDataFrame(rows, "a string, b string, r double"), "r")


RANKED = ["quantity", "price", "discount", "tax", "sparse"]
RANKED_PAIRS = [(a, b) for i, a in enumerate(RANKED) for b in RANKED[i + 1 :]]


@query("P10_spearman_all_columns", " UNION ALL ".join(_spearman_sql(a, b, LINES) for a, b in RANKED_PAIRS))
def spearman_all_columns(spark, folder):
    found = correlation.correlations(lines(spark, folder), RANKED, "spearman")
    first = F.array_position(F.array(*map(F.lit, RANKED)), F.col("variable")) < F.array_position(
        F.array(*map(F.lit, RANKED)), F.col("other")
    )
    return rounded(found.where(first).select(F.col("variable").alias("a"), F.col("other").alias("b"), "r"), "r")


def _kendall_sql(a, b, source):
    ties = "(SELECT sum(w * (w - 1) / 2) FROM (SELECT sum(w) AS w FROM g GROUP BY {s}))"
    return f"""SELECT '{a}' AS a, '{b}' AS b, round(cd / sqrt((n0 - n1) * (n0 - n2)), 6) + 0.0 AS tau FROM (
WITH g AS (SELECT {a}::DOUBLE AS x, {b}::DOUBLE AS y, count(*)::DOUBLE AS w FROM {source} GROUP BY ALL)
SELECT (SELECT sum(p.w * q.w * sign(q.y - p.y)) FROM g p JOIN g q ON p.x < q.x) AS cd,
  (SELECT sum(w) * (sum(w) - 1) / 2 FROM g) AS n0, {ties.format(s='x')} AS n1, {ties.format(s='y')} AS n2)"""


@query("P11_kendall", _kendall_sql("discount", "tax", LINES) + " UNION ALL " + _kendall_sql("quantity", "discount", LINES))
def kendall(spark, folder):
    return _kendall_rows(spark, folder, [("discount", "tax"), ("quantity", "discount")])


def _kendall_rows(spark, folder, pairs, **options):
    found = ranks.kendall_pairs(lines(spark, folder), pairs, **options)
    rows = [(a, b, r) for (a, b), r in zip(pairs, found)]
    return rounded(spark.createDataFrame(rows, "a string, b string, tau double"), "tau")


STEPPED_PAIRS = [("discount", "tax"), ("quantity", "discount"), ("quantity", "sparse")]


@query("P11_kendall_in_blocks", " UNION ALL ".join(_kendall_sql(a, b, f"(SELECT * FROM {LINES} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)") for a, b in STEPPED_PAIRS))
def kendall_in_blocks(spark, folder):
    """The way taken beyond a block's rows, forced by small blocks."""
    return _kendall_rows(spark, folder, STEPPED_PAIRS, block_rows=40)


def _cramers_sql(a, b, source):
    """Without zero cells the statistic is n (Σ O²/(row·column) - 1); none of the pairs is two by two."""
    return f"""SELECT '{a}' AS a, '{b}' AS b, round(sqrt(greatest(0, chi2 / n - (k - 1) * (r - 1) / (n - 1)) /
  least(r - (r - 1) ** 2 / (n - 1) - 1, k - (k - 1) ** 2 / (n - 1) - 1)), 6) + 0.0 AS v FROM (
WITH g AS (SELECT {a} AS x, {b} AS y, count(*)::DOUBLE AS o FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL),
m AS (SELECT *, sum(o) OVER (PARTITION BY x) AS ox, sum(o) OVER (PARTITION BY y) AS oy, sum(o) OVER () AS n FROM g)
SELECT any_value(n) AS n, any_value(n) * (sum(o * o / (ox * oy)) - 1) AS chi2,
  count(DISTINCT x)::DOUBLE AS r, count(DISTINCT y)::DOUBLE AS k FROM m)"""


CATEGORIES = [("l_returnflag", "l_linestatus"), ("l_returnflag", "discount"), ("l_linestatus", "tax")]


@query("P12_cramers_v", " UNION ALL ".join(_cramers_sql(a, b, LINES) for a, b in CATEGORIES))
def cramers_v(spark, folder):
    found = ranks.cramers_pairs(lines(spark, folder), CATEGORIES)
    rows = [(a, b, v) for (a, b), v in zip(CATEGORIES, found)]
    return rounded(spark.createDataFrame(rows, "a string, b string, v double"), "v")


def _bins_sql(c, source, bins=50):
    return f"""SELECT '{c}' AS variable, CAST(least(floor(({c} - lo) / ((hi - lo) / {bins})) + 1, {bins}) AS INT) AS bin, count(*) AS n
FROM (SELECT {c}, min({c}) OVER () AS lo, max({c}) OVER () AS hi FROM {source}) WHERE {c} IS NOT NULL GROUP BY ALL"""


@query("P14_histogram", " UNION ALL ".join(_bins_sql(c, EVENTS) for c in ("value", "k")))
def histogram(spark, folder):
    return profiling.histogram(events(spark, folder), ["value", "k"]).select("variable", "bin", "n")


@query(
    "P13_uniformity",
    f"""SELECT variable, round(sum(n * n) * 50 / sum(n) - sum(n), 4) AS statistic, CAST(50 AS BIGINT) AS cells
FROM ({" UNION ALL ".join(_bins_sql(c, EVENTS) for c in ("value", "k"))}) GROUP BY variable
UNION ALL SELECT 'event_type', round(sum(n * n) * count(*) / sum(n) - sum(n), 4), count(*)
FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)""",
)
def uniformity(spark, folder):
    df = events(spark, folder)
    bins = profiling.filled_histogram(profiling.histogram(df, ["value", "k"])).select("variable", "n")
    classes = profiling.value_counts(df, ["event_type"]).select("variable", "n")
    return rounded(profiling.uniformity(bins.unionByName(classes)), "statistic", places=4)


FREQ_SQL = """SELECT variable, value, n, place FROM (SELECT *, row_number() OVER
  (PARTITION BY variable ORDER BY n DESC, value) AS place FROM {src}) WHERE place <= 10"""


@query("P15_frequencies_numeric", FREQ_SQL.format(src=value_sql(["quantity", "discount", "price"], LINES)))
def frequencies_numeric(spark, folder):
    return profiling.frequencies(profiling.value_counts(lines(spark, folder), ["quantity", "discount", "price"]))


@query("P15_frequencies_text", FREQ_SQL.format(src=value_sql(["l_returnflag", "l_linestatus"], LINES)))
def frequencies_text(spark, folder):
    return profiling.frequencies(profiling.value_counts(lines(spark, folder), ["l_returnflag", "l_linestatus"]))


@query(
    "P15_pie",
    f"""SELECT variable, value, n, round(n / sum(n) OVER (PARTITION BY variable), 6) AS share
FROM {value_sql(["l_returnflag", "l_linestatus"], LINES)}""",
)
def pie(spark, folder):
    counts = profiling.value_counts(lines(spark, folder), ["l_returnflag", "l_linestatus"])
    return rounded(profiling.pie(counts), "share")


EXTREME_SQL = " UNION ALL ".join(
    f"""SELECT variable, value, n, place, '{side}' AS side FROM (SELECT *, row_number() OVER
  (PARTITION BY variable ORDER BY value {way}) AS place FROM {value_sql(["price", "quantity"], LINES)}) WHERE place <= 5"""
    for side, way in (("smallest", "ASC"), ("largest", "DESC"))
)


@query("P16_extremes", EXTREME_SQL)
def extremes(spark, folder):
    return profiling.extremes(profiling.value_counts(lines(spark, folder), ["price", "quantity"]))


GAPPY = f"(SELECT *, nullif(tax, 0) AS gap FROM {LINES})"


def _gappy(spark, folder):
    return lines(spark, folder).withColumn("gap", F.nullif(F.col("tax"), F.lit(0.0)))


@query(
    "P17_missing_bar",
    per_column(["quantity", "sparse", "gap"], "count({c}) AS n_values, count(*) - count({c}) AS n_missing", GAPPY),
)
def missing_bar(spark, folder):
    return profiling.missing_bar(_gappy(spark, folder), ["quantity", "sparse", "gap"])


@query(
    "P17_missing_matrix",
    f"SELECT l_orderkey, l_linenumber, CAST(sparse IS NULL AS INT) AS sparse, CAST(gap IS NULL AS INT) AS gap FROM {GAPPY}",
)
def missing_matrix(spark, folder):
    return profiling.missing_matrix(_gappy(spark, folder), ["sparse", "gap"], ["l_orderkey", "l_linenumber"])


HEAT = "round(corr(CAST(sparse IS NULL AS INT), CAST(gap IS NULL AS INT)), 6) + 0.0"


@query(
    "P17_missing_heatmap",
    f"SELECT 'sparse' AS variable, 'gap' AS other, {HEAT} AS r FROM {GAPPY} UNION ALL SELECT 'gap', 'sparse', {HEAT} FROM {GAPPY}",
)
def missing_heatmap(spark, folder):
    return rounded(profiling.missing_heatmap(_gappy(spark, folder), ["sparse", "gap"]), "r")


DUPLICATED = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query(
    "P18_duplicates",
    f"""SELECT {", ".join(DUPLICATED)}, count(*) AS n_copies FROM lineitem GROUP BY ALL HAVING count(*) > 1
ORDER BY n_copies DESC, {", ".join(DUPLICATED)} LIMIT 10""",
)
def duplicates(spark, folder):
    return profiling.duplicates(table(spark, folder, "lineitem").select(*DUPLICATED))


@query(
    "P18_duplicate_count",
    f"""SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates, round(sum(n - 1) / sum(n), 6) AS p_duplicates
FROM (SELECT count(*) AS n FROM lineitem GROUP BY {", ".join(DUPLICATED)})""",
)
def duplicate_count(spark, folder):
    return rounded(profiling.duplicate_count(table(spark, folder, "lineitem").select(*DUPLICATED)), "p_duplicates")


@query(
    "P19_samples",
    """(SELECT event_id, ts, value, 'head' AS sample FROM events ORDER BY ts, event_id LIMIT 10)
UNION ALL (SELECT event_id, ts, value, 'tail' FROM events ORDER BY ts DESC, event_id DESC LIMIT 10)""",
)
def samples(spark, folder):
    return profiling.samples(events(spark, folder).select("event_id", "ts", "value"), ["ts", "event_id"])


VARIABLES_SQL = f"""SELECT s.*, c.n, c.n_missing, c.n_distinct, c.n_unique FROM ({STATS_SQL}) s JOIN ({COUNTS_SQL}) c USING (variable)"""


@query("P0_P21_variable_table", VARIABLES_SQL)
def variable_table(spark, folder):
    variables, _, _ = profiling.profile(lines(spark, folder), LINE_NUMBERS)
    df = rounded(variables, "min", "max", "range", "cv")
    df = rounded(rounded(df, "mean", "std", places=4), "skewness", "kurtosis", places=5)
    df = rounded(df, "variance", "sum", places=2)
    kept = ["min", "max", "range", "mean", "std", "variance", "sum", "cv", "skewness", "kurtosis"]
    return df.select("variable", *kept, "n", "n_missing", "n_distinct", "n_unique")


CORR_MAX = " UNION ALL ".join(
    f"SELECT '{a}' AS variable, abs(corr({a}, {b})) AS r FROM {LINES}" for a in LINE_NUMBERS for b in LINE_NUMBERS if a != b
)
COPIES_SQL = f"""SELECT sum(n - 1) AS n FROM (SELECT count(*) AS n FROM (SELECT {', '.join(COUNTED)} FROM {LINES}) GROUP BY {', '.join(COUNTED)})"""
# Uniformity needs the tail of a distribution and has tests and a query of its own.
MESSAGES_SQL = f"""SELECT 'CONSTANT' AS kind, variable FROM ({COUNTS_SQL}) WHERE n_distinct = 1
UNION ALL SELECT 'MISSING', variable FROM ({COUNTS_SQL}) WHERE p_missing > 0.01
UNION ALL SELECT 'UNIQUE', variable FROM ({COUNTS_SQL}) WHERE n_unique = n
UNION ALL SELECT 'ZEROS', variable FROM ({per_column(LINE_COLUMNS, "avg(CASE WHEN {c} = 0 THEN 1.0 ELSE 0.0 END) AS p", LINES)}) WHERE p > 0.01
UNION ALL SELECT 'SKEWED', variable FROM ({STATS_SQL}) WHERE abs(skewness) > 20
UNION ALL SELECT 'HIGH_CORRELATION', variable FROM ({CORR_MAX}) GROUP BY variable HAVING max(r) >= 0.9
UNION ALL SELECT 'DUPLICATES', NULL FROM ({COPIES_SQL}) WHERE n > 0"""


@query("P8_messages", MESSAGES_SQL)
def messages(spark, folder):
    _, _, found = profiling.profile(lines(spark, folder), COUNTED)
    return found.where(F.col("kind") != "UNIFORM").select("kind", "variable")


@query(
    "P8_P13_uniform_texts",
    "SELECT 'UNIFORM' AS kind, 'many' AS variable, count(DISTINCT l_orderkey) AS n_values FROM lineitem",
)
def uniform_texts(spark, folder):
    """A text of as many values as there are orders, each met once, and one that is far from uniform."""
    orders = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.min("l_returnflag").alias("flag"))
    rows = orders.select(F.col("l_orderkey").cast("string").alias("many"), F.when(F.col("flag") < "R", "a").otherwise("b").alias("few"))
    variables, _, found = profiling.profile(rows)
    found = found.where(F.col("kind") == "UNIFORM").join(variables.select("variable", "n_distinct"), "variable")
    return found.select("kind", "variable", F.col("n_distinct").alias("n_values"))


@query("P20_rejected", f"SELECT DISTINCT variable FROM ({MESSAGES_SQL}) WHERE kind IN ('CONSTANT', 'HIGH_CORRELATION')")
def rejected(spark, folder):
    df = lines(spark, folder)
    variables = profiling.variable_table(df, LINE_COLUMNS)
    return profiling.rejected(profiling.messages(variables, correlation.correlations(df, LINE_COLUMNS)))


@query(
    "J6_profile_lookup",
    "SELECT 'price' AS variable, round(avg(l_extendedprice), 4) AS mean, count(DISTINCT l_extendedprice) AS n_distinct FROM lineitem",
)
def profile_lookup(spark, folder):
    df = lines(spark, folder)
    variables = profiling.variable_table(df, ["price", "tax"])
    return variables.where(F.col("variable") == "price").select("variable", r6("mean", 4).alias("mean"), "n_distinct")
