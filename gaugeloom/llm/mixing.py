"""Mixing sources to target weights: cube-method balanced sampling.

Each source gets a target number of words: its weight's share of the mix, at most ``cap`` times what it
has, with the excess shared by weight among the others. A document is taken whole, ``floor(ratio)`` times
for certain and once more with probability ``ratio - floor(ratio)``, where ratio is target over size. The
cube method draws those extra copies: it moves the probabilities along directions that leave the expected
number of documents and of words unchanged, until a document reaches 0 or 1. Two constraints need three
undecided documents for such a direction, so a flight over a chunk of a source ends with at most two
undecided ones. Those of all chunks fly again, chunk by chunk, until one chunk a source is left. Documents fly
from long to short, so that short ones are left to the end.

The landing draws the last two and then keeps the words: where a long document among them has thrown the sum
off, single documents of the last chunk change sides while that brings the sum nearer, the longest that help
first. Of the ``LANDING`` shortest documents the subset nearest the target is then sought among all subsets. So
a source's words come as near to its target as its short documents allow, and in a source of few documents the
chances of inclusion give way to the words.

Chunks and random numbers follow from the rows' content alone: reruns agree. Defined cases: a null text
has size 0; null sources form one source, last in the order of weights; null identifiers and rows that are
equal in identifier, source and text are documents of their own; an empty table gives no rows; a source
without words has target 0 and is not taken; a very long text is one document of many words. Only identifier,
text and source are read; other columns of any name are returned as they are by ``mixed``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from gaugeloom.operators.ordered import positions
from gaugeloom.session import staged

#: Documents of a source that one task moves through the constraints.
CHUNK = 20_000
#: Shortest documents whose subsets are all tried at the end, and most changes of single documents before.
LANDING = 14
CHANGES = 64
WORD = r"[^\x20\x09-\x0D]+"
NEAR = 1e-9
#: Types without a hash.
_UNHASHED = (MapType, VariantType)


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """From (source, size) add ``target``: the mix has ``share`` of all sizes, no source above cap * size.

    Sources in code point order, null last, take the weights in turn. Only two sums come to the driver in
    each round, and rounds end when no further source is above its cap.
    """
    ranked = sizes.withColumn("none", F.col("source").isNull())
    ranked = positions(ranked, [], ["none", "source"])
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", turn[(F.col("idx") % len(weights)).cast("int")])
    ranked = staged(ranked.select("source", "size", "weight", "n"), "sources")
    ceiling = F.col("size") * float(cap)
    total = ranked.agg(F.sum("size")).first()[0] or 0
    level, above = 0.0, -1
    while True:
        full = F.col("weight") * level >= ceiling
        row = ranked.agg(
            F.count(F.when(full, 1)), F.sum(F.when(full, ceiling)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if row[0] == above or not row[2]:
            break
        above = row[0]
        level = (total * share - (row[1] or 0.0)) / row[2]
    return ranked.withColumn("target", F.least(F.col("weight") * level, ceiling) if row[2] else ceiling)


def _step(a: float, b: float, c: float, p: float, q: float, r: float, draw: float) -> tuple[float, float, float]:
    """Move three probabilities so that their sum and the sum weighted by sizes a, b, c stay."""
    u, v, w = b - c, c - a, a - b
    if not (u or v or w):
        u, v, w = 1.0, -1.0, 0.0
    up = down = float("inf")
    for x, chance in ((u, p), (v, q), (w, r)):
        if x:
            up = min(up, ((1 - chance) if x > 0 else chance) / abs(x))
            down = min(down, (chance if x > 0 else (1 - chance)) / abs(x))
    move = up if draw * (up + down) < down else -down
    return p + move * u, q + move * v, r + move * w


def flight(sizes: np.ndarray, chance: np.ndarray, random: np.random.Generator, land: bool) -> np.ndarray:
    """Probabilities after the flight over units in the given order; at most two are not 0 or 1.

    ``land`` settles those two: first keeping their number, then by a draw.
    """
    p, size = chance.tolist(), sizes.astype(float).tolist()
    draws = random.random(len(p) + 3).tolist()
    flying: list[int] = []
    for unit in range(len(p)):
        flying.append(unit)
        if len(flying) == 3:
            i, j, k = flying
            p[i], p[j], p[k] = _step(size[i], size[j], size[k], p[i], p[j], p[k], draws[unit])
            flying = _undecided(p, flying)
    flying = _undecided(p, flying)
    if land and len(flying) == 2:
        i, j = flying
        p[i], p[j], _ = _step(0.0, 0.0, 0.0, p[i], p[j], 0.5, draws[-2])
        flying = _undecided(p, flying)
    if land and flying:
        p[flying[0]] = float(draws[-1] < p[flying[0]])
    return np.array(p, float)


def _undecided(p: list[float], units: list[int]) -> list[int]:
    left = []
    for i in units:
        if p[i] < NEAR or p[i] > 1 - NEAR:
            p[i] = round(p[i])
        else:
            left.append(i)
    return left


def landed(sizes: np.ndarray, chance: np.ndarray, drawn: np.ndarray) -> np.ndarray:
    """``drawn``, a choice of documents, changed until its words are near the expected ones, ``chance`` by size."""
    out, size = drawn.copy(), sizes.astype(float)
    free = np.flatnonzero((chance > NEAR) & (chance < 1 - NEAR) & (size > 0))
    if not len(free):
        return out
    away = float(((out - chance) * size).sum())
    change = np.where(out[free] > 0.5, -size[free], size[free])
    for _ in range(CHANGES):
        k = int(np.abs(away + change).argmin())
        if abs(away + change[k]) >= abs(away) - NEAR:
            break
        away += change[k]
        change[k] = -change[k]
        out[free[k]] = 1 - out[free[k]]
    last = np.argsort(size[free], kind="stable")[:LANDING]
    totals, flips = np.zeros(1), np.zeros(1, int)
    for c in change[last]:
        totals, flips = np.concatenate([totals, totals + c]), np.concatenate([flips, flips + 1])
    best = int(np.lexsort((flips, np.abs(away + totals).round(6)))[0])
    for bit, k in enumerate(last):
        if best >> bit & 1:
            out[free[k]] = 1 - out[free[k]]
    return out


def _fly(units: DataFrame, land: bool) -> DataFrame:
    """One flight over every (source, chunk); column ``chance`` is moved."""

    def run(table: pa.Table) -> pa.Table:
        size, mark = table.column("size").to_numpy(), table.column("mark").to_numpy()
        order = np.lexsort((table.column("number").to_numpy(), mark, -size))
        table = table.take(pa.array(order))
        seed = [int(x) % 2**32 for x in (mark[order[0]], len(order))]
        chance = table.column("chance").to_numpy()
        moved = flight(size[order], chance, np.random.default_rng(seed), land)
        if land:
            moved = landed(size[order], chance, moved)
        at = table.schema.get_field_index("chance")
        return table.set_column(at, "chance", pa.array(moved))

    return units.groupBy("source", "chunk").applyInArrow(run, units.schema)


def keyed(df: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """``df`` with the content hash that names a document in the mix."""
    hashed = F.xxhash64(F.col(doc_id).cast("string"), F.col(source).cast("string"), F.col(text))
    return df.withColumns({"_gl_mark": hashed, "_gl_id": F.coalesce(F.col(doc_id).cast("string"), F.lit(""))})


def mix(
    df: DataFrame,
    weights: Sequence[float],
    share: float,
    cap: float = 2.0,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per row of ``df``: id (as text), mark, number, doc_id, size, source_size, target, copies, taken.

    ``number`` tells rows of the same id and mark apart.
    """
    rows = keyed(df, doc_id, text, source).select(
        F.col("_gl_id").alias("id"),
        F.col("_gl_mark").alias("mark"),
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        word_count(F.col(text)).alias("size"),
    )
    rows = staged(rows, "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    goals = targets(sizes, weights, share, cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = goals.select(
        F.coalesce("source", F.lit("")).alias("_source"),
        F.col("source").isNull().alias("_none"),
        F.col("size").alias("source_size"),
        "target",
        F.ceil(F.col("n") / CHUNK).alias("chunks"),
    ).withColumn("ratio", ratio)
    goals = staged(goals, "goals")
    same = (F.coalesce("source", F.lit("")) == F.col("_source")) & (F.col("source").isNull() == F.col("_none"))
    units = rows.join(goals, same).drop("_source", "_none")
    units = units.withColumns(
        {
            "number": F.row_number().over(Window.partitionBy("id", "mark").orderBy("mark")),
            "sure": F.floor("ratio"),
            "chance": F.col("ratio") - F.floor("ratio"),
        }
    )
    most = goals.agg(F.max("chunks")).first()[0] or 1
    chunk = F.pmod(F.xxhash64("id", "mark", "number"), F.col("chunks"))
    left, done = units.withColumn("chunk", chunk), []
    while True:
        left = staged(_fly(left, most == 1), "flight")
        open_ = (F.col("chance") > 0) & (F.col("chance") < 1)
        if most == 1:
            done.append(left)
            break
        done.append(left.where(~open_))
        fewer = F.ceil(F.col("chunks") * 2 / CHUNK)
        left = left.where(open_).withColumn("chunks", fewer).withColumn("chunk", F.pmod("chunk", F.col("chunks")))
        most = -(-most * 2 // CHUNK)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    copies = (F.col("sure") + F.round("chance")).cast("long")
    out = out.withColumn("copies", F.when(F.col("source_size") > 0, copies).otherwise(F.lit(0)))
    out = out.withColumn("taken", F.col("copies") * F.col("size"))
    return out.select("id", "mark", "number", "doc_id", "source", "size", "source_size", "target", "copies", "taken")


def mixed(df: DataFrame, weights: Sequence[float], share: float, cap: float = 2.0, **columns: str) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken."""
    names = {"doc_id": "doc_id", "text": "text", "source": "source"} | columns
    taken = mix(df, weights, share, cap, **names)
    taken = taken.select(*[F.col(c).alias(f"_gl_m_{c}") for c in ("id", "mark", "number", "copies")])
    same = Window.partitionBy("_gl_id", "_gl_mark")
    rest = [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if not isinstance(df.schema[c].dataType, _UNHASHED)])]
    rows = keyed(df, **names).withColumn("_gl_number", F.row_number().over(same.orderBy(*rest)))
    match = [F.col(f"_gl_{c}") == F.col(f"_gl_m_{c}") for c in ("id", "mark", "number")]
    rows = rows.join(taken, match[0] & match[1] & match[2]).where("_gl_m_copies > 0")
    rows = rows.withColumn("_gl_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_gl_m_copies"))))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns])

