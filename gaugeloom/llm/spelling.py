"""Grouping of spelling variants by asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced code point makes one of the other. A word of L code
points is cut into two disjoint chunks of q = L div 2. One edit spares one of them: the first stays where it
is, or the second moves by the difference in length. So one word gives its two chunks, the other its grams of
q code points with their places, and chunks meet grams of the same text within a shift of one. Grams that
start where no chunk can come to lie meet nothing and are not written.

Common halves would bring thousands of words together, so what is left of the words beside the chunk, which
again differs by one edit, is cut in the same way, and both chunks are the key of the join. A group then
holds words that agree in about three quarters of their code points in the same places. Every pair that
meets is compared exactly. Each pair is sought from the shorter word, or from both if they are equally long.

The joins are sorted merges by hint: Spark sizes a side by the compressed files it comes from and does not count
the rows that an explode adds, so it would send millions of chunks through the driver.

Defined cases: null and empty texts have no words; a null identifier enters the checksum as an empty text;
repeated rows count as often as they stand; ties between near words of equal count go to the smallest in code
point order; very long runs are words like others; an empty table gives an empty result. Only the identifier
and the text are read, so other columns of any name do not matter.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.session import staged

# Runs of letters, and which of them lose a code point.
LETTERS = "[A-Za-zÀ-ÿ]+"
DIVISOR = 97


def words(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 5, least: int = 3) -> DataFrame:
    """Table ``word, n`` of the words of all texts that have ``least_length`` code points and stand ``least`` times.

    Words are lower-cased runs of letters. A run whose checksum with the identifier is divisible by 97 loses
    the code point that the checksum points at. Counts are combined before the shuffle.
    """
    lowered = F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)
    found = F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))
    # an outer explode: the other adds a filter that would repeat the extraction
    runs = df.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("d"), F.explode_outer(found).alias("run"))
    runs = runs.where(F.length("run") >= least_length)
    mark = F.crc32(F.concat("d", F.lit(":"), "run"))
    at = (mark % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    made = runs.select(F.when(mark % DIVISOR == 0, short).otherwise(F.col("run")).alias("word"))
    made = made.where(F.length("word") >= least_length)
    return made.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _keys(word: Column, grams: bool) -> Column:
    """Hashes of the chunks of a word, or of its grams where chunks of near words would lie."""

    def part(of: Column, begin: Column, length: Column) -> Column:
        return F.substring(of, begin + 1, length)

    def without(of: Column, begin: Column, length: Column) -> Column:
        return F.concat(F.substring(of, F.lit(1), begin), F.substring(of, begin + length + 1, F.length(of)))

    keys = []
    for longer in (0, 1):  # code points that the gram side has more than the chunk side
        length = F.length(word) - (longer if grams else 0)
        moved = longer if grams else 0
        half = F.floor(length / 2).cast("int")
        quarter = F.floor((length - half) / 2).cast("int")
        for i in (0, 1):
            begin = i * (half + moved)
            rest = without(word, begin, half)
            for j in (0, 1):
                second = part(rest, j * (quarter + moved), quarter)
                keys.append(F.xxhash64(F.lit(4 * longer + 2 * i + j), length, part(word, begin, half), second))
    return F.array(*keys)


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """Pairs of near words of ``word, n``, each once: word, n, other, other_n. Words are unique, of 4 code points at least."""
    chunks = vocabulary.select("word", "n", F.explode(_keys(F.col("word"), False)).alias("key"))
    grams = vocabulary.select(
        F.col("word").alias("other"), F.col("n").alias("other_n"), F.explode(_keys(F.col("word"), True)).alias("key")
    )
    longer = F.length("other") - F.length("word")
    once = (longer == 1) | ((longer == 0) & (F.col("word") < F.col("other")))
    near = F.levenshtein("word", "other", 1) == 1
    return chunks.join(grams.hint("merge"), "key").where(once & near).select("word", "n", "other", "other_n").distinct()


def variants(vocabulary: DataFrame, factor: int = 2) -> DataFrame:
    """For each word of ``word, n``: form, root, n, n_near, form_n.

    ``form`` is the near word of largest count if that is ``factor`` (above 1) times the word's count, ``root``
    what following forms leads to. Counts grow along a chain by the factor, so its length is known beforehand
    and halved by each join of the forms with themselves.
    """
    vocabulary = staged(vocabulary.select("word", "n"), "vocabulary")
    pairs = near_pairs(vocabulary)
    there = F.struct("word", "n", "other", "other_n")
    back = F.struct(
        F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")
    )
    both = pairs.select(F.explode(F.array(there, back)).alias("p")).select("p.*")
    first = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("first")
    best = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), first)
    large = -F.col("first.less") >= factor * F.col("n")
    best = staged(
        best.select(
            "word",
            "n_near",
            F.when(large, F.col("first.form")).alias("form"),
            F.when(large, -F.col("first.less")).alias("form_n"),
        ),
        "forms",
    )
    forms = best.where(F.col("form").isNotNull())
    roots = forms.select("word", F.col("form").alias("root"))
    most = vocabulary.agg(F.max("n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(max(2.0, 1 + math.log(most, factor))))):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        joined = roots.join(onward.hint("merge"), "root", "left")
        roots = staged(joined.select("word", F.coalesce("onward", "root").alias("root")), "roots")
    found = vocabulary.join(best.hint("merge"), "word", "left").join(roots.hint("merge"), "word", "left")
    return found.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
