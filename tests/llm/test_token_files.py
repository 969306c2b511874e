import random

import numpy as np
import pytest
from pyspark.sql import types as T

from gaugeloom.llm import token_files
from gaugeloom.session import new_table_path


@pytest.mark.parametrize("block", [1, 3, 64, 1 << 19])
def test_counts(spark, block):
    r = random.Random(1)
    lists = [[r.randrange(50_000) for _ in range(r.choice([0, 0, 1, 2, 50, 400]))] for _ in range(200)]
    lists[10] = None
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    df = spark.createDataFrame(list(enumerate(lists)), schema).coalesce(1).repartition(3, "n")
    path = new_table_path(spark, "tokens")
    token_files.write_token_files(df, "ids", path)
    size = 4 if block == 1 else block
    found = token_files.documents_of(token_files.scanned(token_files.blocks_of(spark, path, block_tokens=size))).collect()
    assert all(x.closed for x in found)
    assert sorted(x.n_tokens for x in found) == sorted(len(x or []) for x in lists)
    by_file = {}
    for x in sorted(found, key=lambda x: (x.file, x.doc_no)):
        at = by_file.get(x.file, (0, 0))
        assert (x.doc_no, x.start) == at
        by_file[x.file] = (x.doc_no + 1, x.start + x.n_tokens + 1)


def test_open_document_and_flat_bytes(spark, tmp_path):
    end = token_files.SEPARATOR
    np.array([5, end, end, 7, 8, end, 9, 10, 11], ">u2").tofile(tmp_path / "a.bin")
    np.array([1, 2, 3], ">u2").tofile(tmp_path / "b.bin")
    np.array([end], ">u2").tofile(tmp_path / "c.bin")
    (tmp_path / "d.bin").touch()
    found = token_files.documents_of(token_files.scanned(token_files.blocks_of(spark, str(tmp_path), block_tokens=2)))
    rows = sorted((x.file[-5], x.doc_no, x.start, x.n_tokens, x.closed) for x in found.collect())
    assert rows == [
        ("a", 0, 0, 1, True), ("a", 1, 2, 0, True), ("a", 2, 3, 2, True), ("a", 3, 6, 3, False), ("b", 0, 0, 3, False), ("c", 0, 0, 0, True),
    ]


def test_empty(spark):
    path = new_table_path(spark, "tokens")
    token_files.write_token_files(spark.createDataFrame([], "ids array<int>"), "ids", path)
    assert token_files.token_counts(spark, path).count() == 0


def test_a_file_of_many_blocks_and_files_of_few_documents(spark):
    """One document over several blocks of the size that is used, and a task's documents in several files."""
    r = np.random.default_rng(0)
    long_ = r.integers(0, 50_000, 3 * token_files.BLOCK_TOKENS + 77).tolist()
    lists = [*([7] * k for k in range(40)), long_, *([8] * k for k in range(40))]
    path = new_table_path(spark, "tokens")
    df = spark.createDataFrame([(x,) for x in lists], "ids array<int>").coalesce(1)
    token_files.write_token_files(df, "ids", path, documents=60)
    blocks = token_files.blocks_of(spark, path)
    assert blocks.count() == 5 and blocks.select("file").distinct().count() == 2
    found = token_files.token_counts(spark, path).collect()
    assert [x.n_tokens for x in sorted(found, key=lambda x: (x.file.split("-c")[-1], x.doc_no))] == [len(x) for x in lists]


def test_texts_are_written_as_the_encoder_has_them(spark):
    from helpers import docs, odd_rows

    from gaugeloom.llm import bpe
    from gaugeloom.llm.queries import TOKENIZER

    tokenizer = __import__("public_tokenizers").path(TOKENIZER)
    table = docs(spark, odd_rows())
    path = new_table_path(spark, "tokens")
    token_files.write_texts(table, tokenizer, path, documents=3)
    wanted = sorted(len(x.ids) for x in bpe.encode(table.select("text"), tokenizer).collect())
    assert sorted(x.n_tokens for x in token_files.token_counts(spark, path).collect()) == wanted
