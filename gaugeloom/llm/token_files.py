"""Token counts of flat, unindexed token files, by a separator scan.

A flat token file is nothing but token identifiers of a fixed width, one document after another, each
ended by the identifier of end-of-document. Files are cut into blocks. A task searches a block for
separators with numpy; what crosses block borders is stitched by prefix scans over the blocks of a file:
tokens before a block, separators before it, and the place of the last separator before it.

A file is read whole before it is cut into blocks, so files are kept small: a new one is begun after ``DOCUMENTS``
documents. Texts go to bytes in one pass, a few rows at a time, and a block is small enough for the heap's
ordinary regions.

Defined cases: an empty document is two separators in a row and counts 0 tokens; tokens after a file's
last separator are a document that is not closed; empty files give no rows. Documents do not cross files, and
a very long one is many blocks of one file. Null texts and null ids are empty documents. Repeated rows are
documents of their own; an empty table gives no rows. Other columns of any name are not written.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeloom.llm import bpe
from gaugeloom.llm.runs import fewer

#: Big-endian 16-bit identifiers. The separator lies beyond the vocabularies of up to 50,304 tokens, and
#: its two bytes are one character in UTF-8, which lets Spark's text sink write it between documents.
WIDTH = ">u2"
SEPARATOR = 0xC480
BLOCK_TOKENS = 1 << 17
#: Documents of a file at most, and rows turned to bytes at once.
DOCUMENTS = 2_000
ROWS = 256


def write_token_files(df: DataFrame, ids: str, path: str, separator: int = SEPARATOR, documents: int = DOCUMENTS) -> None:
    """Write the ids of each row (array<int>, null: none) followed by the separator."""
    at = df.columns.index(ids)
    _write(df, at, lambda: lambda x: x.values.to_numpy(zero_copy_only=False), path, separator, documents)


def write_texts(
    df: DataFrame, tokenizer: str, path: str, text: str = "text", separator: int = SEPARATOR, documents: int = DOCUMENTS
) -> None:
    """Write the ids of each text by the tokenizer file ``tokenizer``, followed by the separator."""
    spec = bpe.specification(tokenizer)

    def made():
        model = bpe.model_of(spec)
        return lambda x: np.fromiter(model.encode(x.as_py()), np.int64)

    _write(df.select(text), 0, made, path, separator, documents)


def _write(df: DataFrame, at: int, made, path: str, separator: int, documents: int) -> None:
    """``made()`` gives, inside a task, the function from a value that is not null to its ids."""
    end = separator.to_bytes(2, "big").decode()

    def run(batches):
        ids_of = made()
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                column = batch.column(at).slice(begin, ROWS)
                flat = [ids_of(x).astype(WIDTH).tobytes() if x.is_valid else b"" for x in column]
                yield pa.RecordBatch.from_arrays([pa.array(flat, pa.binary())], names=["value"])

    written = df.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    options = {"lineSep": end, "compression": "none", "maxRecordsPerFile": documents}
    written.write.options(**options).text(path)


def blocks_of(spark: SparkSession, path: str, width: str = WIDTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, data): the files' bytes in blocks."""
    size = np.dtype(width).itemsize * block_tokens
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    pieces = F.expr(
        f"transform(sequence(0, cast((length - 1) div {size} as int)), i -> substring(content, i * {size} + 1, {size}))"
    )
    return files.select(F.col("path").alias("file"), F.posexplode(pieces).alias("block", "data"))


def scanned(blocks: DataFrame, separator: int = SEPARATOR, width: str = WIDTH) -> DataFrame:
    """(file, block, tokens, ends): the places of separators in each block."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch.column(2)[i].as_buffer(), width)
                ends = np.flatnonzero(data == separator).astype(np.int32)
                columns = [
                    batch.column(0).slice(i, 1),
                    batch.column(1).slice(i, 1),
                    pa.array([len(data)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(ends)], pa.int32()), pa.array(ends)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "tokens", "ends"])

    return blocks.mapInArrow(lambda batches: fewer(run(batches)), "file string, block int, tokens long, ends array<int>")


def documents_of(scan: DataFrame) -> DataFrame:
    """(file, doc_no, start, n_tokens, closed): every document of every file, by stitching the blocks."""
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("tokens").over(earlier), F.lit(0))
    rows = scan.withColumn("before", before).withColumn("found", F.size("ends"))
    rows = rows.withColumn("last", F.when(F.col("found") > 0, F.col("before") + F.element_at("ends", -1)))
    rows = rows.withColumns(
        {
            "done": F.coalesce(F.sum("found").over(earlier), F.lit(0)),
            "previous": F.coalesce(F.max("last").over(earlier), F.lit(-1)),
            "next": F.lead("block").over(order),
        }
    )
    places = F.transform("ends", lambda x, i: F.struct(
        (F.when(i == 0, F.col("previous")).otherwise(F.col("before") + F.get("ends", i - 1)) + 1).alias("start"),
        (F.col("before") + x).alias("end"),
        F.lit(True).alias("closed"),
    ))
    start, end = F.coalesce("last", "previous") + 1, F.col("before") + F.col("tokens")
    rest = F.struct(start.alias("start"), end.alias("end"), F.lit(False).alias("closed"))
    open_ = F.when(F.col("next").isNull() & (start < end), F.array(rest)).otherwise(F.filter(F.array(rest), lambda x: F.lit(False)))
    rows = rows.select("file", "done", F.posexplode(F.concat(places, open_)).alias("k", "x"))
    n_tokens = (F.col("x.end") - F.col("x.start")).alias("n_tokens")
    return rows.select("file", (F.col("done") + F.col("k")).alias("doc_no"), "x.start", n_tokens, "x.closed")


def token_counts(spark: SparkSession, path: str, separator: int = SEPARATOR) -> DataFrame:
    """The documents of the files in a folder and their numbers of tokens."""
    return documents_of(scanned(blocks_of(spark, path), separator))
