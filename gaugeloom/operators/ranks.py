"""Rank correlations and contingency tables of all column pairs at once, in a number of jobs that is fixed."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.operators.ordered import BLOCK_ROWS, MAX_SERIES_ROWS, running_total
from gaugeloom.session import staged

Pairs = Sequence[tuple[str, str]]
#: Most blocks that the rows of a pair are cut into; the table of blocks by buckets is one task's.
MOST_BLOCKS = 2_048
#: Most distinct values, about, of a column whose ranks every task looks up.
FEW_VALUES = 10_000


def _known(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns as doubles named by number; NaN counts as missing, and there is one zero."""
    values = [F.col(f"`{c}`").cast("double") + F.lit(0.0) for c in cols]
    return df.select(*[F.nanvl(v, F.lit(None)).alias(f"c{i}") for i, v in enumerate(values)])


def spearman_pairs(
    df: DataFrame, pairs: Pairs, max_rows: int = MAX_SERIES_ROWS, few: int = FEW_VALUES
) -> list[float | None]:
    """Correlation of average ranks for each pair, over the rows where both columns have a value.

    A column is ranked once for all partners without gaps, and once more for each partner with gaps, over the
    rows that partner has. Values of all rankings are counted in one long table, and one running total for each
    ranking gives the ranks. Ranks of columns of few values are small tables that every task looks up; those of
    many values go back to the rows by a join. One pass sums the products of all pairs.
    """
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    number = {c: i for i, c in enumerate(cols)}
    rows = _known(df, cols)
    seen = [F.count_if(F.col(c).isNull()).alias(c) for c in rows.columns]
    seen += [F.approx_count_distinct(c).alias(f"d{c}") for c in rows.columns]
    gaps = rows.agg(*seen).first()
    partial = {i for i in range(len(cols)) if gaps[f"c{i}"]}
    many = {i for i in range(len(cols)) if gaps[f"dc{i}"] > few}
    rankings: dict[tuple[int, int | None], int] = {}
    sides = []
    for a, b in pairs:
        i, j = number[a], number[b]
        keys = (i, j if j in partial else None), (j, i if i in partial else None)
        sides.append(tuple(rankings.setdefault(k, len(rankings)) for k in keys))
    entries, listed = {}, [s for (i, _), s in rankings.items() if i not in many]
    for (i, mask), s in rankings.items():
        there = F.col(f"c{i}").isNotNull() & (F.col(f"c{mask}").isNotNull() if mask is not None else F.lit(True))
        entries[s] = F.when(there, F.struct(F.lit(s).alias("s"), F.col(f"c{i}").alias("v")))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "ranked_values")
    values = rows.select(F.explode(F.array_compact(F.array(*entries.values()))).alias("e"))
    values = values.groupBy("e.s", "e.v").agg(F.count(F.lit(1)).alias("k"))
    totals = running_total(values, ["s"], ["v"], "k", "before", "total", max_rows)
    rank = F.col("before") + (F.col("k") + 1) / 2 - (F.col("total") + 1) / 2
    totals = totals.select("s", "v", rank.alias("rank"))
    if many:
        totals = staged(totals, "ranks")
    tables = {}
    if listed:
        found = totals.where(F.col("s").isin(listed)).toPandas().sort_values(["s", "v"])
        tables = {s: (t["v"].to_numpy(), t["rank"].to_numpy()) for s, t in found.groupby("s")}
    masked = {s: (i, mask) for (i, mask), s in rankings.items() if s in tables}
    plain = [F.col(f"c{i}") for i in range(len(cols))]
    empty = F.array().cast("array<struct<s:int,rank:double>>")
    back = rows.select(F.array(*plain).alias("values"), empty.alias("ranks"))
    if many:
        long = rows.select("row", F.explode(F.array_compact(F.array(*[e for s, e in entries.items() if s not in listed]))).alias("e"))
        long = long.select("row", "e.s", "e.v").join(totals.where(~F.col("s").isin(listed)), ["s", "v"])
        ends = F.struct("s", "rank").alias("rank"), F.lit(None).cast("array<double>").alias("values")
        both = long.select("row", *ends).union(rows.select("row", F.lit(None), F.array(*plain)))
        back = both.groupBy("row").agg(F.flatten(F.collect_list("values")).alias("values"), F.collect_list("rank").alias("ranks"))
        back = back.select("values", "ranks")
    left, right = (np.array([p[side] for p in sides]) for side in (0, 1))

    def sums(batches):
        out = np.zeros((3, len(sides)))
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            lists = batch.column(1)
            of = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            x = np.full((batch.num_rows, len(rankings)), np.nan)
            for s, (i, mask) in masked.items():
                there = ~np.isnan(values[:, i])
                if mask is not None:
                    there &= ~np.isnan(values[:, mask])
                known, ranked = tables[s]
                x[there, s] = ranked[np.searchsorted(known, values[there, i])]
            x[of, flat.field("s").to_numpy()] = flat.field("rank").to_numpy()
            for p in range(len(sides)):
                a, b = x[:, left[p]], x[:, right[p]]
                both = ~(np.isnan(a) | np.isnan(b))
                a, b = a[both], b[both]
                out[:, p] += a @ b, a @ a, b @ b
        columns = [pa.array(np.arange(len(sides)), pa.int32()), *[pa.array(v) for v in out]]
        yield pa.RecordBatch.from_arrays(columns, names=["p", "xy", "xx", "yy"])

    parts = back.mapInArrow(sums, "p int, xy double, xx double, yy double")
    found = {r.p: r for r in parts.groupBy("p").agg(*[F.sum(c).alias(c) for c in ("xy", "xx", "yy")]).collect()}
    return [
        found[p].xy / math.sqrt(found[p].xx * found[p].yy) if p in found and found[p].xx and found[p].yy else None
        for p in range(len(sides))
    ]


def later_smaller(y: np.ndarray, w: np.ndarray) -> float:
    """Sum of w[i] w[j] over places i < j with y[i] > y[j].

    Ranks differ first at one binary digit. Among those that share all higher digits, in their order, a rank
    with digit 0 meets the weights with digit 1 before it.
    """
    rank = np.unique(y, return_inverse=True)[1]
    total = 0.0
    for digit in range(int(rank.max(initial=0)).bit_length()):
        order = np.argsort(rank >> (digit + 1), kind="stable")
        ones, weight = (rank[order] >> digit) & 1, w[order]
        before = np.cumsum(weight * ones) - weight * ones
        group = rank[order] >> (digit + 1)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        before -= np.repeat(before[first], np.diff(np.r_[first, len(group)]))
        total += float((weight * before)[ones == 0].sum())
    return total


def _inversions(first: str):
    """Of the rows of one group, pairs with smaller ``first`` and larger y: one row (p, found)."""

    def run(table: pa.Table) -> pa.Table:
        x, y, w = (table[c].to_numpy() for c in (first, "y", "w"))
        order = np.lexsort((y, x))
        found = later_smaller(y[order], w[order].astype(float))
        return pa.table({"p": pa.array([table["p"][0].as_py()], pa.int32()), "found": pa.array([found])})

    return run


def _crossed(table: pa.Table) -> pa.Table:
    """Of the weights by block and bucket, pairs in an earlier block and a later bucket."""
    a, b, w = (table[c].to_numpy() for c in ("xb", "yb", "w"))
    grid = np.zeros((a.max() + 1, b.max() + 1))
    grid[a, b] = w
    before = np.cumsum(grid, 0) - grid
    beyond = np.cumsum(before[:, ::-1], 1)[:, ::-1] - before
    return pa.table({"p": pa.array([table["p"][0].as_py()], pa.int32()), "found": pa.array([float((grid * beyond).sum())])})


def _placed(long: DataFrame, borders: dict[str, dict[int, list[float]]]) -> DataFrame:
    """Add block and bucket: how many of the pair's borders are not above x and y."""

    def run(batches):
        for batch in batches:
            p = batch.column(0).to_numpy()
            added = []
            for k, side in ((1, "x"), (2, "y")):
                value, at = batch.column(k).to_numpy(), np.zeros(len(p), np.int32)
                for pair in np.intersect1d(p, list(borders[side])).tolist():
                    here = np.flatnonzero(p == pair)
                    at[here] = np.searchsorted(borders[side][pair], value[here], "right")
                added.append(pa.array(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=["p", "x", "y", "w", "xb", "yb"])

    return long.select("p", "x", "y", "w").mapInArrow(run, "p int, x double, y double, w long, xb int, yb int")


def kendall_counts(df: DataFrame, pairs: Pairs, block_rows: int = BLOCK_ROWS) -> list[dict[str, float]]:
    """For each pair: rows n, discordant pairs of rows, and sums over ties of x, of y and of both.

    Ties give t2 = Σ t(t-1)/2, t3 = Σ t(t-1)(t-2) and t5 = Σ t(t-1)(2t+5). Equal value pairs are counted first.
    A pair with many is cut into blocks by x and buckets by y, at quantiles. A discordant pair of rows lies in
    one block, which is counted in the block; or in two blocks and one bucket, counted in the bucket; or in
    two of both, counted from the weights of the crossings. So each row is shuffled twice, and no task holds
    more than about a block. Blocks of one x and buckets of one y hold nothing to count and may be of any size.
    """
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    number = {c: f"c{i}" for i, c in enumerate(cols)}
    rows = _known(df, cols)
    entries = []
    for p, (a, b) in enumerate(pairs):
        x, y = F.col(number[a]), F.col(number[b])
        entries.append(F.when(x.isNotNull() & y.isNotNull(), F.struct(F.lit(p).alias("p"), x.alias("x"), y.alias("y"))))
    long = rows.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.p", "e.x", "e.y")
    long = staged(long.groupBy("p", "x", "y").agg(F.count(F.lit(1)).alias("w")), "pairs")

    out = [dict.fromkeys(("n", "discordant", *[f"{s}{t}" for s in ("x", "y", "both") for t in ("2", "3", "5")]), 0.0) for _ in pairs]
    k = F.col("k").cast("double")
    measures = [F.sum(k), F.sum(k * (k - 1) / 2), F.sum(k * (k - 1) * (k - 2)), F.sum(k * (k - 1) * (2 * k + 5))]
    tables = []
    for side, keys in (("x", ["p", "x"]), ("y", ["p", "y"]), ("both", ["p", "x", "y"])):
        groups = long.groupBy(*keys).agg(F.sum("w").alias("k"))
        named = [m.alias(n) for m, n in zip(measures, ("n", "t2", "t3", "t5"))]
        tables.append(groups.groupBy("p").agg(F.count(F.lit(1)).alias("values"), *named).withColumn("side", F.lit(side)))
    sizes = [1] * len(pairs)
    for r in reduce(DataFrame.unionByName, tables).collect():
        out[r.p]["n"] = r.n
        out[r.p] |= {f"{r.side}2": r.t2, f"{r.side}3": r.t3, f"{r.side}5": r.t5}
        if r.side == "both":
            sizes[r.p] = r["values"]

    blocks = {p: min(MOST_BLOCKS, max(1, math.ceil(n / max(block_rows, 1)))) for p, n in enumerate(sizes)}
    several = [p for p, n in blocks.items() if n > 1]
    borders: dict[str, dict[int, list[float]]] = {"x": {}, "y": {}}
    if several:
        most = max(blocks.values())
        shares = [i / most for i in range(1, most)]
        cuts = long.where(F.col("p").isin(several)).groupBy("p")
        for r in cuts.agg(*[F.percentile_approx(s, shares, 100 * most).alias(s) for s in ("x", "y")]).collect():
            for s in ("x", "y"):
                # a hot value is a block of its own: it begins at a border and the next value begins another
                values = sorted(r[s])
                hot = {a for a, b in zip(values, values[1:]) if a == b}
                borders[s][r.p] = sorted({*values, *[math.nextafter(v, math.inf) for v in hot]})
    schema = "p int, found double"
    found = []
    inside = long.withColumn("xb", F.lit(0))
    if several:
        placed = staged(_placed(long, borders), "placed")
        kinds = [placed.groupBy("p", b).agg(F.min(s).alias("low"), F.max(s).alias("high")).where("low < high").select("p", b) for s, b in (("x", "xb"), ("y", "yb"))]
        inside = placed.join(kinds[0], ["p", "xb"])
        bucket = placed.join(kinds[1], ["p", "yb"]).where(F.col("p").isin(several))
        found.append(bucket.groupBy("p", "yb").applyInArrow(_inversions("xb"), schema))
        cells = placed.where(F.col("p").isin(several)).groupBy("p", "xb", "yb").agg(F.sum(F.col("w").cast("double")).alias("w"))
        found.append(cells.groupBy("p").applyInArrow(_crossed, schema))
    found.append(inside.groupBy("p", "xb").applyInArrow(_inversions("x"), schema))
    for r in reduce(DataFrame.unionByName, found).groupBy("p").agg(F.sum("found").alias("found")).collect():
        out[r.p]["discordant"] = r.found
    return out


def kendall_score(c: dict[str, float]) -> float:
    """Concordant less discordant pairs of rows."""
    whole = c["n"] * (c["n"] - 1) / 2
    return whole - c["x2"] - c["y2"] + c["both2"] - 2 * c["discordant"]


def kendall_pairs(df: DataFrame, pairs: Pairs, block_rows: int = BLOCK_ROWS) -> list[float | None]:
    """Kendall's tau-b of each pair."""
    out: list[float | None] = []
    for c in kendall_counts(df, pairs, block_rows):
        whole = c["n"] * (c["n"] - 1) / 2
        scale = (whole - c["x2"]) * (whole - c["y2"])
        out.append(kendall_score(c) / math.sqrt(scale) if scale > 0 else None)
    return out


def cramers_pairs(df: DataFrame, pairs: Pairs, max_distinct: int = 100) -> list[float | None]:
    """Bias-corrected Cramér's V of each pair of categories; null above ``max_distinct`` values.

    A sketch of each column leaves out those of far too many values, the rest are counted exactly. Then one
    scan counts the cells of all pairs, and each pair's table, bounded by ``max_distinct``, is one group.
    """
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    plain = {c: (F.col(f"`{c}`") + F.lit(0).cast(t) if t in ("float", "double") else F.col(f"`{c}`")) for c, t in df.select(*[f"`{c}`" for c in cols]).dtypes}
    rows = df.select(*[plain[c].cast("string").alias(f"c{i}") for i, c in enumerate(cols)])
    rough = rows.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in rows.columns]).first()
    few = [c for c in rows.columns if 0 < rough[c] <= 2 * max_distinct]
    sizes = rows.agg(*[F.count_distinct(c).alias(c) for c in few]).first() if few else {}
    few = {c for c in few if sizes[c] <= max_distinct}
    number = {c: f"c{i}" for i, c in enumerate(cols)}
    entries = []
    for p, (a, b) in enumerate(pairs):
        x, y = number[a], number[b]
        if {x, y} <= few:
            both = F.struct(F.lit(p).alias("p"), F.col(x).alias("x"), F.col(y).alias("y"))
            entries.append(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), both))
    if not entries:
        return [None] * len(pairs)
    long = rows.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.p", "e.x", "e.y")
    cells = long.groupBy("p", "x", "y").agg(F.count(F.lit(1)).alias("w"))

    def measured(table: pa.Table) -> pa.Table:
        (x, i), (y, j) = (np.unique(table[c].to_numpy(zero_copy_only=False).astype(str), return_inverse=True) for c in ("x", "y"))
        grid = np.zeros((len(x), len(y)))
        grid[i, j] = table["w"].to_numpy()
        v = pa.array([cramers(grid)], pa.float64())
        return pa.table({"p": pa.array([table["p"][0].as_py()], pa.int32()), "v": v})

    found = {r.p: r.v for r in cells.groupBy("p").applyInArrow(measured, "p int, v double").collect()}
    return [found.get(p) for p in range(len(pairs))]


def cramers(observed: np.ndarray) -> float | None:
    """Bias-corrected Cramér's V of a contingency table, with Yates' correction for two by two."""
    n = observed.sum()
    if n < 2:
        return None
    r, c = observed.shape
    expected = np.outer(observed.sum(1), observed.sum(0)) / n
    away = np.abs(observed - expected)
    if r == c == 2:
        away -= np.minimum(0.5, away)
    phi2 = max(0.0, (away * away / expected).sum() / n - (r - 1) * (c - 1) / (n - 1))
    rest = min(r - (r - 1) ** 2 / (n - 1), c - (c - 1) ** 2 / (n - 1)) - 1
    return math.sqrt(phi2 / rest) if rest else 1.0
