"""Session settings and the shared folder for checkpoints and stage tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Paths of the stage tables that this process has made and not deleted.
_TABLES: list[str] = []


def local_session(cores: int | str = "*", app: str = "gaugeloom") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made only for a local master that names none.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            named = tempfile.mkdtemp(prefix="gaugeloom-")
        context.setCheckpointDir(named)
        folder = context.getCheckpointDir()
    return folder


def staged(df: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """The frame written once to the shared folder and read back.

    Cuts the lineage like a checkpoint, and later scans read only the columns they need. A task that writes or
    reads holds row groups of ``group_bytes``, of 128 MB without it; sizes are then checked every few rows, not after hundreds
    by the size of the first ones, as rows may be large.
    """
    path = new_table_path(df.sparkSession, name)
    checks = {"parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 16}
    df.write.options(**({"parquet.block.size": group_bytes, **checks} if group_bytes else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, most_bytes: int) -> Iterator[None]:
    """What runs inside hands rows to Python in Arrow batches of about ``most_bytes``; Spark's own bound is 64 MB."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, most_bytes)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one stage table inside the shared folder."""
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    _TABLES.append(path)
    return path


def drop_staged(df: DataFrame) -> None:
    """Delete a stage table that nothing reads any more."""
    paths = {file.rsplit("/", 1)[0] for file in df.inputFiles()}
    for path in paths:
        _delete(df.sparkSession, path)
        _TABLES[:] = [p for p in _TABLES if p.rsplit("/", 1)[1] != path.rsplit("/", 1)[1]]


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Stage tables made inside are deleted at the end, when what was made of them is written or collected."""
    before = len(_TABLES)
    try:
        yield
    finally:
        while len(_TABLES) > before:
            _delete(spark, _TABLES.pop())
