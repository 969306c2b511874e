"""Plans: columns read, shuffles made, no Python in the row work of the flagship."""

from pyspark.sql import functions as F

from gaugeloom.operators import profiling
from gaugeloom.operators import windows as win
from gaugeloom.operators.split import split_rows
from gaugeloom.plans.queries.catalog import EVENT_ORDER, EVENT_SERIES, events, lines
from gaugeloom.plans.queries.series import flagship

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_and_windows_share_one_shuffle(spark):
    parts = split_rows(events(spark, FOLDER), 0.7, 0.0, EVENT_SERIES, EVENT_ORDER)
    text = plan(win.windows(parts, ["k"], "value", 5, 1, EVENT_SERIES, EVENT_ORDER))
    assert text.count("Exchange ") == 1 and "hashpartitioning(user_id" in text
    assert "event_type" not in text.split("ReadSchema")[1]


def test_flagship_runs_in_the_jvm(spark):
    text = plan(flagship(spark, FOLDER))
    assert "Python" not in text and "SinglePartition" not in text and text.count("Exchange ") == 1


def test_series_filter_reaches_the_scan(spark):
    parts = split_rows(events(spark, FOLDER), 0.7, 0.0, EVENT_SERIES, EVENT_ORDER)
    assert "EqualTo(user_id,3)" in plan(parts.where(F.col("user_id") == 3))


def test_frequencies_cut_before_the_shuffle(spark):
    counts = profiling.value_counts(lines(spark, FOLDER), ["price", "tax"])
    assert plan(profiling.frequencies(counts)).count("WindowGroupLimit") == 2
    assert plan(profiling.extremes(counts)).count("WindowGroupLimit") >= 2


def test_scalars_come_from_one_scan(spark):
    text = plan(profiling.numeric_stats(lines(spark, FOLDER), ["price", "tax"]))
    assert text.count("FileScan") == 1 and "partial_" in text
