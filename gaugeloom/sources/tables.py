"""Reading and writing series, stage tables, reports and column lists."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeloom.functions.columns import base_name


def read_series(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    dataset: str | None = None,
    drop_index: bool = False,
    file_column: str | None = None,
) -> DataFrame:
    """All files of one format in a folder as one frame, united by column name.

    ``dataset`` picks a sub-folder, ``drop_index`` drops the first column, ``file_column`` adds the
    name of the file each row came from. CSV files are matched by their own header lines; of a file larger
    than a task's share only the beginning and the last piece are read for that. Without a schema a scan finds
    the types. Columns that a file lacks
    are null; with a schema, columns that it lacks are left out.
    """
    folder = f"{path}/{dataset}" if dataset else path
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    if fmt == "csv":
        return _read_csv(spark, folder, schema, drop_index, file_column)
    reader = spark.read.option("pathGlobFilter", f"*.{fmt}")
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "parquet":
        reader = reader.option("mergeSchema", True)
    df = reader.format(fmt).load(folder)
    if drop_index:
        df = df.drop(df.columns[0])
    return _with_file(df, file_column)


def _with_file(df: DataFrame, file_column: str | None) -> DataFrame:
    return df.withColumn(file_column, base_name(F.col("_metadata.file_path"))) if file_column else df


def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, head): the first line of each file that begins in this task's pieces.

    A piece that is not its file's last one fills a task by itself, so after its first batch nothing is read any
    more. Small files and last pieces share tasks and are read through.
    """
    seen: set[str] = set()
    for batch in batches:
        if not batch.num_rows:
            continue
        value, path, start, length, size = batch.columns
        begins = np.flatnonzero(start.to_numpy() == 0)
        paths = path.take(pa.array(begins)).to_pylist()
        new = {p: i for p, i in zip(reversed(paths), reversed(begins.tolist())) if p not in seen}
        if new:
            seen.update(new)
            heads = value.take(pa.array(list(new.values())))
            yield pa.RecordBatch.from_arrays([pa.array(list(new), pa.string()), heads], names=["path", "head"])
        if start[0].as_py() + length[0].as_py() < size[0].as_py():
            return


def _files_by_header(spark: SparkSession, folder: str) -> list[list[str]]:
    """Paths of the CSV files of a folder, those of one header line together, in order of their names."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text(folder)
    pieces = [F.col(f"_metadata.{c}") for c in ("file_path", "file_block_start", "file_block_length", "file_size")]
    heads = lines.select("value", *pieces).mapInArrow(first_lines, "path string, head string")
    found = heads.groupBy("head").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return sorted([unquote(p) for p in row.paths] for row in found.collect())


def _read_csv(spark, folder, schema, drop_index, file_column):
    frames, wanted = [], schema
    if wanted is not None and drop_index:
        wanted = T.StructType(wanted.fields[1:])
    for paths in _files_by_header(spark, folder):
        reader = spark.read.option("header", True).option("basePath", folder)
        names = reader.csv(paths[:1]).columns
        types = {f.name.lower(): f.dataType for f in wanted or ()}
        fields = [T.StructField(c, types.get(c.lower(), T.StringType())) for c in names]
        df = _with_file(reader.schema(T.StructType(fields)).csv(paths), file_column)
        own = names[1:] if drop_index else names
        if wanted is not None:
            present = {c.lower() for c in own}
            cells = [F.col(f"`{f.name}`") if f.name.lower() in present else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted]
        else:
            cells = [F.col(f"`{c}`") for c in own]
        frames.append(df.select(*cells, *([file_column] if file_column else [])))
    if not frames:
        return spark.createDataFrame([], schema or T.StructType())
    united = union_by_name(frames)
    if schema is None:
        united = _typed(united, [c for c in united.columns if c != file_column])
    return united


# Types a text column may turn out to hold, the first that takes all its values.
_TYPES = ("int", "bigint", "double", "boolean", "timestamp")
#: What a text that can be cast must look like; a cast that fails costs many times one that succeeds.
_LOOKS = {
    "bigint": r"^[^0-9A-Za-z.:+-]*[+-]?0*[0-9]{1,19}[^0-9A-Za-z.:+-]*$",
    "double": r"(?i)^[^0-9a-z.+-]*[+-]?(infinity|inf|nan|0x[0-9a-f.]+p[+-]?[0-9]+|[0-9]*[.]?[0-9]*(e[+-]?[0-9]+)?)[df]?[^0-9a-z.+-]*$",
    "boolean": r"(?i)^[^0-9a-z]*(t|true|y|yes|1|f|false|n|no|0)[^0-9a-z]*$",
}
_INT = (-(2**31), 2**31 - 1)


def _taken(c: str, kind: str) -> Column:
    """Whether ``try_cast`` to the type takes the value; never null."""
    if kind == "int":
        return F.coalesce(_tried(c, "bigint").between(*_INT), F.lit(False))
    return _tried(c, kind).isNotNull()


def _tried(c: str, kind: str) -> Column:
    cast = F.expr(f"try_cast(`{c}` AS {kind})")
    return F.when(F.col(f"`{c}`").rlike(_LOOKS[kind]), cast) if kind in _LOOKS else cast


def _typed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns cast to the narrowest type that takes all their values.

    One scan tries the number types on all columns, a second the others on the columns that hold no numbers.
    """
    found: dict[str, str] = {}
    for kinds in (_TYPES[:3], _TYPES[3:]):
        left = [(i, c) for i, c in enumerate(columns) if c not in found]
        if not left:
            break
        misfits = df.agg(
            *[
                F.count(F.when(F.col(f"`{c}`").isNotNull() & ~_taken(c, kind), 1)).alias(f"{i}_{kind}")
                for i, c in left
                for kind in kinds
            ]
        ).first()
        for i, c in left:
            kind = next((k for k in kinds if not misfits[f"{i}_{k}"]), None)
            if kind:
                found[c] = kind
    return df.select(*[F.col(f"`{c}`").cast(found[c]).alias(c) if c in found else F.col(f"`{c}`") for c in df.columns])


def read_clean(spark: SparkSession, path: str, delete_columns: Sequence[str] = (), **options) -> DataFrame:
    """Read a folder, delete columns, then drop rows with any null."""
    return read_series(spark, path, **options).drop(*delete_columns).dropna()


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames by column name; columns a frame lacks become null."""
    united = frames[0]
    for df in frames[1:]:
        united = united.unionByName(df, allowMissingColumns=True)
    return united


def list_files(spark: SparkSession, path: str, extension: str = "") -> DataFrame:
    """Files of a folder with the extension, by name. Columns: file, bytes."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{extension}")
        .load(path)
        .select(base_name(F.col("path")).alias("file"), F.col("length").alias("bytes"))
        .orderBy("file")
    )


def write_series(df: DataFrame, path: str, series: str, fmt: str = "parquet", folders: bool = False) -> None:
    """Files of whole series, each file sorted by series; with ``folders`` a folder per series.

    The rebalance hint brings rows of a series together, splits a series too large for one task and
    merges small ones, all by measured sizes. So there are as many files as tasks, and readers skip
    files by their ranges. Folders suit few series: read them back with a schema if names look like
    numbers, as without one ``01`` comes back as 1.
    """
    dealt = df.hint("rebalance", series)
    writer = dealt if folders else dealt.sortWithinPartitions(series)
    writer = writer.write.mode("errorifexists").format(fmt)
    if folders:
        writer = writer.partitionBy(series)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One stage table; arrays need parquet."""
    writer = df.write.mode("errorifexists").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Metrics rows as JSON lines."""
    write_table(metrics, path, "json")


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Truth, prediction and bounds as CSV with a header."""
    write_table(predictions, path, "csv")


# The columns of a predictions file.
PREDICTION_SCHEMA = "ground_truth double, predicted double, lower_bound double, upper_bound double"


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return read_series(spark, path, "csv", PREDICTION_SCHEMA)


def feature_list(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column list as a table: position, name, and how many non-null values the column holds."""
    cells = [
        F.struct(F.lit(i).alias("pos"), F.lit(c).alias("name"), F.count(c).alias("n_values"))
        for i, c in enumerate(columns)
    ]
    return df.agg(F.array(*cells).alias("s")).select(F.inline("s"))


def write_profile(variables: DataFrame, correlations: DataFrame, messages: DataFrame, path: str) -> None:
    """The three profile tables as JSON folders."""
    for name, table in (("variables", variables), ("correlations", correlations), ("messages", messages)):
        write_table(table, f"{path}/{name}", "json")


def read_profile(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The profile tables written by ``write_profile``."""
    return tuple(spark.read.json(f"{path}/{name}") for name in ("variables", "correlations", "messages"))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Messages of a report document, under ``messages`` or its other name ``alerts``."""
    report = spark.read.json(path, multiLine=True)
    for name in ("messages", "alerts"):
        if name not in report.columns:
            report = report.withColumn(name, F.lit(None).cast("array<string>"))
    return report.select(F.explode(F.coalesce("messages", "alerts")).alias("message"))
