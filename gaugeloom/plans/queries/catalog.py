"""Catalog of queries and the bindings they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.operators.ordered import over_rows_back
from gaugeloom.operators.split import split_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (session, folder) under a name, with its SQL if there is one."""

    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep


def r6(column: Column | str, places: int = 6) -> Column:
    """Rounded double without a negative zero, as the SQL twins round."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column.cast("double"), places) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: r6(c, places) for c in columns})


# events: one series per user in time order; `value` is the target, `k` the input.
EVENT_SERIES = ["user_id"]
EVENT_ORDER = ["ts", "event_id"]
EVENTS = """(SELECT event_id, ts, user_id, event_type, value,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)"""


def events(spark: SparkSession, folder: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/events.parquet")
    return df.withColumn("k", F.get_json_object("props", "$.k").cast("double")).drop("props")


# lineitem: one series per supplier; the listed columns order it without ties.
LINE_SERIES = ["l_suppkey"]
LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
LINE_SQL_ORDER = ", ".join(LINE_ORDER)
LINE_NUMBERS = ["quantity", "price", "discount", "tax", "net", "sparse"]
LINES = """(SELECT *, l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
  l_extendedprice * (1 - l_discount) AS net, nullif(l_discount, 0) AS sparse,
  l_quantity * 0 + 7 AS fixed FROM lineitem)"""


def lines(spark: SparkSession, folder: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/lineitem.parquet")
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return df.withColumns(
        {
            "quantity": F.col("l_quantity"),
            "price": price,
            "discount": discount,
            "tax": F.col("l_tax"),
            "net": price * (1 - discount),
            "sparse": F.nullif(discount, F.lit(0.0)),
            "fixed": F.col("l_quantity") * 0 + 7,
        }
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def per_column(columns: list[str], select: str, source: str) -> str:
    """SQL of one SELECT per column, united; ``{c}`` stands for the column."""
    parts = [f"SELECT '{c}' AS variable, {select.replace('{c}', c)} FROM {source}" for c in columns]
    return "\nUNION ALL\n".join(parts)


# Positions and parts of events, as SQL.
EVENT_ROWS = f"""(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx,
  count(*) OVER (PARTITION BY user_id) AS n_rows FROM {EVENTS})"""


def event_parts(train: float, calibrate: float = 0.0) -> str:
    t = f"CAST(floor(CAST(n_rows AS DOUBLE) * CAST({train} AS DOUBLE)) AS BIGINT)"
    b = f"({t} + CAST(floor(CAST(n_rows AS DOUBLE) * CAST({calibrate} AS DOUBLE)) AS BIGINT))"
    return f"""(SELECT *, CASE WHEN idx < {t} THEN 'train' WHEN idx < {b} THEN 'calibrate' ELSE 'test' END AS part,
  idx - CASE WHEN idx < {t} THEN 0 WHEN idx < {b} THEN {t} ELSE {b} END AS part_idx FROM {EVENT_ROWS})"""


# Stand-in prediction for the metrics: the mean of up to four earlier values of the user.
EVENT_GUESS = f"""(SELECT * FROM (SELECT *, avg(value) OVER (PARTITION BY user_id ORDER BY idx
  ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS p FROM {event_parts(0.5, 0.2)}) WHERE p IS NOT NULL)"""


def event_guess(spark: SparkSession, folder: str) -> DataFrame:
    rows = split_rows(events(spark, folder), 0.5, 0.2, EVENT_SERIES, EVENT_ORDER)
    guess = {"p": lambda w: F.avg("value").over(w.rowsBetween(-4, -1))}
    return over_rows_back(rows, EVENT_SERIES, 4, guess, F.col("p").isNotNull())
