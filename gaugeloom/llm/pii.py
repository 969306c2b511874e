"""Personal data and the terms that give it away: information-theoretic sanitisation.

Base findings are emails, ip addresses, card and phone numbers. They are the protected entities. Over all
lines of the corpus, counts of terms and of terms beside an entity estimate how much a term tells: the
pointwise mutual information of term and kind of entity, log2(p(kind | term) / p(kind)), as a share of the
kind's whole information, -log2 p(kind). A term is disclosing for a kind if that share reaches
``threshold`` and it stands in ``support`` different lines of that kind at least. Such a term is found
wherever it stands, in lines and documents without an entity too, as it discloses the kind there as well.
Findings are replaced by the name of their kind, terms by a general ``<TERM>``.

Patterns never match across a line end, so all work is done on lines and a long text is many rows. They
are written with possessive steps, to stay linear on any text; they match what the plain patterns match.

Defined cases: null texts are empty and have no findings. A term is a run of letters and digits outside
base findings, in lower case. Rows of equal identifier and text get equal findings; null identifiers are
allowed. Ties cannot be: spans are sorted by kind and place. An empty table gives an empty result. Columns
beside identifier and text stay as they are, those beginning with ``_gl_`` are the operator's own. Only
built-in functions are used.

Terms are judged against kinds of entities, not against single ones: the same entity beside the same word in
several different lines is, in a corpus, nearly always a near copy of a text, and would flag its plain words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.arrays import with_before
from gaugeloom.session import staged

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Kind to (what every match holds, pattern). ``\G`` is the end of the match before.
PATTERNS = {
    "email": ("@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9][\x20-]?[0-9]", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
WORD = r"[\p{L}\p{N}]+"
SPANS = "array<struct<kind:int,s:int,e:int>>"


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.8
    support: int = 5


def _matches(df: DataFrame, text: str, sign: str | None, pattern: str, out: str) -> DataFrame:
    """Add ``out``: an array of (found, s, e), the leftmost matches without overlap; null if there is none."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    if sign is not None:
        found = F.when(F.col(text).rlike(sign), found)
    df = df.withColumn("_found", found)
    df = df.withColumn("_gaps", F.when(F.size("_found") > 0, F.split(F.col(text), pattern, -1)))
    steps = F.zip_with(F.slice("_gaps", F.lit(1), F.size("_found")), "_found", lambda g, m: F.length(g) + F.length(m))
    df = with_before(df.withColumn("_steps", steps), "_steps", "_starts")
    spans = F.transform(
        F.arrays_zip("_found", "_gaps", "_starts"),
        lambda x: F.struct(
            x["_found"].alias("found"),
            (x["_starts"] + F.length(x["_gaps"])).alias("s"),
            (x["_starts"] + F.length(x["_gaps"]) + F.length(x["_found"])).alias("e"),
        ),
    )
    spans = F.when(F.size("_gaps") > 0, F.filter(spans, lambda x: x["found"].isNotNull()))
    return df.withColumn(out, spans).drop("_found", "_gaps", "_steps", "_starts")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled; the digits' sum ends in 0."""
    doubled = F.transform(
        F.reverse(F.split(digits, "")),
        lambda d, i: (lambda n: F.when(i % 2 == 0, n).when(n > 4, n * 2 - 9).otherwise(n * 2))(d.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        return text.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.length(_digits(text)).between(16, 19) & _luhn(_digits(text))
    if kind == "phone":
        return F.length(_digits(text)).between(8, 15)
    return F.lit(True)


def base_findings(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: an array of (kind, s, e) in ``text``, by kind as listed, then start; never null."""
    for n, kind in enumerate(KINDS):
        df = _matches(df, text, *PATTERNS[kind], f"_m{n}")

    def part(n: int, kind: str) -> Column:
        valid = F.filter(F.col(f"_m{n}"), lambda x: _valid(kind, x["found"]))
        spans = F.transform(valid, lambda x: F.struct(F.lit(n).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
        return F.coalesce(spans, F.array().cast(SPANS))

    parts = [part(n, kind) for n, kind in enumerate(KINDS)]
    return df.withColumn(out, F.concat(*parts)).drop(*[f"_m{n}" for n in range(len(KINDS))])


def _masked(text: Column, spans: Column) -> Column:
    """``text`` with spaces in place of the spans."""
    return F.aggregate(
        spans, text, lambda t, x: F.overlay(t, F.repeat(F.lit(" "), x["e"] - x["s"]), x["s"] + 1, x["e"] - x["s"])
    )


def _terms_beside(df: DataFrame, settings: Settings) -> DataFrame:
    """(word, kinds): the disclosing terms, from counts over all lines of ``df`` (column text)."""
    # outer explodes: the others add filters, which would repeat all that their arrays are made of
    lines = df.select(F.explode_outer(F.split("text", "\n", -1)).alias("line"))
    lines = base_findings(lines, "line", "base")
    some = F.size("base") > 0
    words = F.regexp_extract_all(F.lower(F.when(some, _masked(F.col("line"), F.col("base"))).otherwise(F.col("line"))), F.lit(WORD), F.lit(0))
    beside = [F.array_contains(F.transform("base", lambda x: x["kind"]), n).cast("int").alias(f"k{n}") for n in range(len(KINDS))]
    # the empty word stands for the line itself
    rows = lines.select(
        F.when(some, F.xxhash64("line")).alias("seen"),
        *beside,
        F.explode_outer(F.concat(F.array(F.lit("")), F.array_distinct(words))).alias("word"),
    )
    kinds = [f"k{n}" for n in range(len(KINDS))]
    first = rows.groupBy("word", "seen").agg(F.count(F.lit(1)).alias("n"), *[F.sum(k).alias(k) for k in kinds])
    support = [F.count(F.when(F.col(k) > 0, 1)).alias(f"d{k}") for k in kinds]
    counts = first.groupBy("word").agg(F.sum("n").alias("n"), *[F.sum(k).alias(k) for k in kinds], *support)
    enough = F.greatest(*[F.col(f"d{k}") for k in kinds]) >= settings.support
    counts = staged(counts.where(enough | (F.col("word") == "")), "terms")
    total = counts.where("word = ''").first()
    if total is None:
        return counts.select("word", F.array(F.lit(0)).alias("kinds")).limit(0)
    revealed = []
    for n, k in enumerate(kinds):
        if not total[k] or total[k] == total["n"]:
            continue  # a kind of no line or of every line has nothing to disclose
        whole = F.log2(F.lit(total["n"] / total[k]))
        told = F.log2(F.col(k) / F.col("n")) + whole
        enough = (F.col(f"d{k}") >= settings.support) & (told >= settings.threshold * whole)
        revealed.append(F.when(enough, F.lit(n)))
    kinds_of = F.array_compact(F.array(*revealed)) if revealed else F.array().cast("array<int>")
    return counts.where("word != ''").select("word", kinds_of.alias("kinds")).where(F.size("kinds") > 0)


def _narrow(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("mark"), body.alias("text"))


def _lines(narrow: DataFrame) -> DataFrame:
    """(doc_id, mark, no, at, line): the lines of each text and their offsets."""
    rows = narrow.withColumn("lines", F.split("text", "\n", -1))
    rows = rows.withColumn("steps", F.transform("lines", lambda x: F.length(x) + 1))
    rows = with_before(rows, "steps", "starts")
    lines = rows.select("doc_id", "mark", F.posexplode_outer(F.arrays_zip("lines", "starts")).alias("no", "x"))
    return lines.select("doc_id", "mark", "no", F.col("x.starts").alias("at"), F.col("x.lines").alias("line"))


def findings(df: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Lines with findings: doc_id, mark (hash of the text), no, at (offset), found.

    ``found`` is an array of (kind, s, e), kinds numbered as in ``KINDS`` and terms as the next number; offsets
    are code points in the line. Lines of equal rows come once.
    """
    narrow = _narrow(df, doc_id, text)
    place = ["doc_id", "mark", "no", "at"]
    lines = _lines(narrow.where(F.col("text").rlike("[0-9@]")))
    lines = base_findings(lines.where(F.col("line").rlike("[0-9@]")), "line", "all")
    some = F.explode_outer(F.when(F.size("all") > 0, F.array("all"))).alias("found")
    lines = lines.select(*place, some).where(F.col("found").isNotNull())
    lines = staged(lines.dropDuplicates(["doc_id", "mark", "no"]), "entity_lines")

    # few terms, so that adaptive execution can send them to the lines and no word is shuffled
    terms = staged(_terms_beside(narrow, settings).select("word"), "disclosing")
    # places are sought only in texts that hold a term, or an entity that might hide the end of one
    words = F.explode_outer(F.array_distinct(F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0)))).alias("word")
    hits = narrow.select("doc_id", "mark", words).select("doc_id", "mark", F.lower("word").alias("word")).join(terms, "word")
    hits = hits.select("doc_id", "mark").unionByName(lines.select("doc_id", "mark")).distinct()
    hits = staged(hits.select(F.col("doc_id").alias("_d"), F.col("mark").alias("_m")), "hits")
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m"))
    masked = base_findings(_lines(narrow.join(hits, same, "left_semi")), "line", "base")
    masked = masked.withColumn("masked", F.when(F.size("base") > 0, _masked(F.col("line"), F.col("base"))).otherwise(F.col("line")))
    masked = _matches(masked, "masked", None, WORD, "words")
    words = masked.select(*place, F.explode_outer("words").alias("w"))
    told = words.select(*place, F.lower("w.found").alias("word"), "w.s", "w.e").join(terms, "word")
    span = F.struct(F.lit(len(KINDS)).alias("kind"), "s", "e")
    told = told.groupBy(*place).agg(F.sort_array(F.collect_set(span)).alias("found"))
    every = lines.unionByName(told).groupBy(*place)
    return every.agg(F.flatten(F.collect_list("found")).alias("found"))


def of_documents(found: DataFrame) -> DataFrame:
    """(doc_id, mark, spans): all spans of a document as (kind, s, e) in code points of its text, sorted."""
    moved = F.transform(
        "found", lambda x: F.struct(x["kind"].alias("kind"), (x["s"] + F.col("at")).alias("s"), (x["e"] + F.col("at")).alias("e"))
    )
    spans = found.select("doc_id", "mark", moved.alias("spans")).groupBy("doc_id", "mark")
    return spans.agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))


def sanitised(df: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``df`` with every finding of ``text`` replaced by the name of its kind; null texts stay null."""
    found = findings(df, doc_id, text, settings)
    empty = F.array().cast(SPANS)
    order = F.array_sort("found", lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(b["e"] - a["e"]))

    def merge(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        wider = F.struct(last["kind"].alias("kind"), last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(wider))
        return F.when(F.size(done) == 0, F.array(x)).when(x["s"] < last["e"], joined).otherwise(F.concat(done, F.array(x)))

    names = F.array(*[F.lit(f"<{k.upper()}>") for k in (*KINDS, TERM)])

    def clean(line: Column, spans: Column) -> Column:
        return F.aggregate(
            F.reverse(spans), line, lambda t, x: F.overlay(t, F.get(names, x["kind"]), x["s"] + 1, x["e"] - x["s"])
        )

    lines = found.withColumn("merged", F.aggregate(order, empty, merge))
    new = lines.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list(F.struct("no", "merged"))).alias("some"))
    # the spans of line i at place i, null for lines without
    before = lambda k: F.coalesce(F.get("some", k - 1)["no"], F.lit(-1))
    gap = lambda x, k: F.array_repeat(F.lit(None).cast(SPANS), x["no"] - before(k) - 1)
    spans = F.flatten(F.transform("some", lambda x, k: F.concat(gap(x, k), F.array(x["merged"]))))
    new = new.select(F.col("doc_id").alias("_gl_d"), F.col("mark").alias("_gl_m"), spans.alias("_gl_spans"))
    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = df.withColumn("_gl_mark", mark).join(
        new, F.col(doc_id).eqNullSafe(F.col("_gl_d")) & (F.col("_gl_mark") == F.col("_gl_m")), "left"
    )
    lines_of = F.transform(F.split(F.col(text), "\n", -1), lambda x, i: F.coalesce(clean(x, F.get("_gl_spans", i)), x))
    cleaned = F.when(F.col("_gl_spans").isNotNull(), F.array_join(lines_of, "\n")).otherwise(F.col(text))
    return rows.withColumn(text, cleaned).select(*[F.col(f"`{c}`") for c in df.columns])


def of_kind(spans: Column, kind: int) -> Column:
    return F.filter(spans, lambda x: x["kind"] == kind)


def described(spans: Column, kinds: int) -> Column:
    """``kind:start:end`` of the spans of the first kinds, joined by commas."""
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    chosen = F.filter(spans, lambda x: x["kind"] < kinds)
    return F.array_join(F.transform(chosen, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"], x["e"])), ",")
