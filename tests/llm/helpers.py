"""Small tables with the cases every operator must take."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators might use themselves
        T.StructField("size", T.StringType()),
        T.StructField("mark", T.LongType()),
        T.StructField("node", T.LongType()),
        T.StructField("line", T.StringType()),
    ]
)


def docs(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, None, None)[:4] if len(row) < 4 else row
        full.append((doc_id, text, lang, source, len(text or ""), "x", 7, 9, "y"))
    return spark.createDataFrame(full, DOCUMENTS).repartition(3)


def prose(seed: int, words: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(words))


def odd_rows():
    """Nulls, empty, blank, very long, tied and repeated rows."""
    long_ = prose(99, 60_000)
    return [
        (None, None),
        (None, "only null id " + prose(1, 40)),
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, long_),
        (5, prose(5, 50)),
        (5, prose(5, 50)),
        (5, prose(6, 50)),
        (6, prose(5, 50)),
        (7, "a"),
        (8, "!!! ??? 123"),
        (9, "é" * 30_000),
    ]
