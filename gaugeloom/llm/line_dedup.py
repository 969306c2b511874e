"""Substring dedup by line hashing: every line after its first occurrence in the corpus goes.

Lines are normalised (lower case, runs of white space as one space, trimmed) and named by a digest. The
first occurrence of each digest, by identifier and place, comes from one aggregate combined before the
shuffle; a line that half of the corpus shares is one row of it a task. Lines are then compared with it by
a join that adaptive execution splits where one line is very common. What goes is returned as offsets in
the original text.

Defined cases: null texts are empty; a null identifier ranks after all others; lines of fewer than
``words`` words are never removed; rows equal in identifier and text are one document, whose result each
of them gets. The line end goes with a removed line. Ties cannot be: place decides within a text. A very long
text is many lines, and what is left of it is put together from the runs of lines between removed ones. An
empty table gives an empty result. An output column that exists already is an error, others stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.arrays import with_before

WORDS = 5
SPACE = r"[\x20\x09-\x0D]+"


def normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), SPACE, " "))


def _units(rows: DataFrame, words: int) -> DataFrame:
    """(doc_id, mark, no, s, e, digest) of the lines long enough."""
    rows = rows.withColumn("lines", F.split("text", "\n", -1))
    rows = with_before(rows.withColumn("steps", F.transform("lines", lambda x: F.length(x) + 1)), "steps", "starts")
    units = rows.select("doc_id", "mark", F.posexplode_outer(F.arrays_zip("lines", "starts")).alias("no", "x"))
    line, start = F.col("x.lines"), F.col("x.starts")
    units = units.select("doc_id", "mark", "no", start.alias("s"), (start + F.length(line)).alias("e"), normal(line).alias("line"))
    enough = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) >= words - 1
    return units.where(enough & (F.col("line") != "")).select("doc_id", "mark", "no", "s", "e", F.unhex(F.md5("line")).alias("digest"))


def repeated_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, mark, no, s, e): every line that occurs earlier; ``mark`` is the hash of the text."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("mark"), body.alias("text"))
    units = _units(rows, words)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "no")
    # a digest met once in all goes no further
    first = units.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = units.join(first, "digest").where(place > F.col("first"))
    return later.select("doc_id", "mark", "no", "s", "e").distinct()


def without_repeated_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``df`` with ``_removed`` (array of (s, e) in code points) and ``_kept`` (the rest of the text)."""
    for name in ("_removed", "_kept"):
        if name in map(str.lower, df.columns):
            raise ValueError(f"column {name} exists")
    gone = repeated_lines(df, doc_id, text, words).groupBy("doc_id", "mark")
    gone = gone.agg(F.sort_array(F.collect_list(F.struct("no", "s", "e"))).alias("_gl_gone"))
    gone = gone.withColumnsRenamed({"doc_id": "_gl_d", "mark": "_gl_m"})
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.withColumn("_gl_mark", F.xxhash64(body))
    rows = rows.join(gone, F.col(doc_id).eqNullSafe(F.col("_gl_d")) & (F.col("_gl_mark") == F.col("_gl_m")), "left")
    some = F.col("_gl_gone").isNotNull()

    def between(lines: Column) -> Column:
        """Runs of lines before, between and after the removed ones."""
        first = lambda k: F.coalesce(F.get("_gl_gone", k - 1)["no"] + 1, F.lit(0))
        runs = F.transform("_gl_gone", lambda x, k: F.slice(lines, first(k) + 1, x["no"] - first(k)))
        rest = F.slice(lines, F.element_at("_gl_gone", -1)["no"] + 2, F.size(lines))
        return F.concat(F.flatten(runs), rest)

    # the lines are a lambda's argument, so that the text is split once and not once a run
    left = F.get(F.transform(F.array(F.split(body, "\n", -1)), between), F.lit(0))
    removed = F.transform("_gl_gone", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    nothing = F.array().cast("array<struct<s:int,e:int>>")
    rows = rows.withColumns(
        {"_removed": F.coalesce(removed, nothing), "_kept": F.when(some, F.array_join(left, "\n")).otherwise(body)}
    )
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], "_removed", "_kept")
