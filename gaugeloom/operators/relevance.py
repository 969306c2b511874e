"""Which features tell something of a target: a rank test for each feature, and a step-up over the p-values.

The tests run on counts, all features at once: Kendall's rank test for a target of values, the rank-sum test
of one class against the rest for a target of classes. Only a few numbers a feature reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.operators.ordered import BLOCK_ROWS, MAX_SERIES_ROWS, running_total
from gaugeloom.operators.ranks import kendall_counts, kendall_score
from gaugeloom.session import staged

SCHEMA = "variable string, class string, n long, z double, p_value double, relevant boolean"


def two_sided(z: float | None) -> float:
    """Probability of a normal value at least as far from zero; 1 where nothing could be tested."""
    return 1.0 if z is None else math.erfc(abs(z) / math.sqrt(2))


def step_up(p_values: Sequence[float], level: float = 0.05, independent: bool = False) -> list[bool]:
    """Which hypotheses are rejected at a false discovery rate of ``level``.

    The k-th smallest of m p-values is compared with level k / m; all up to the last that is not above go. If
    the tests may depend on each other, the level is divided by 1 + 1/2 + ... + 1/m.
    """
    m = len(p_values)
    if not independent:
        level = level / sum(1 / i for i in range(1, m + 1)) if m else level
    ordered = sorted(p_values)
    border = max((p for k, p in enumerate(ordered, 1) if p <= level * k / m), default=-1.0)
    return [p <= border for p in p_values]


def kendall_z(c: dict[str, float]) -> float | None:
    """Kendall's score over its standard deviation under independence, with ties."""
    n = c["n"]
    if n < 2:
        return None
    spread = (n * (n - 1) * (2 * n + 5) - c["x5"] - c["y5"]) / 18
    spread += 4 * c["x2"] * c["y2"] / (2 * n * (n - 1))
    if n > 2:
        spread += c["x3"] * c["y3"] / (9 * n * (n - 1) * (n - 2))
    untied = c["x2"] < n * (n - 1) / 2 and c["y2"] < n * (n - 1) / 2
    return kendall_score(c) / math.sqrt(spread) if untied and spread > 0 else None


def rank_sum_z(n: int, total: int, ranks: float, ties: float) -> float | None:
    """The rank-sum of n out of total values, over its standard deviation, half a rank nearer to its mean."""
    if not 0 < n < total:
        return None
    spread = n * (total - n) / 12 * (total + 1 - ties / (total * (total - 1)))
    if spread <= 0:
        return None
    away = ranks - n * (total + 1) / 2
    return math.copysign(max(abs(away) - 0.5, 0.0), away) / math.sqrt(spread)


def _rank_sums(df: DataFrame, target: str, cols: Sequence[str], max_rows: int):
    """(variable, class, values of the class, of all, rank sum, Σ t³ - t over ties), all features in one long table."""
    parts = [
        F.struct(F.lit(i).alias("f"), (F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) + F.lit(0.0)).alias("v"))
        for i, c in enumerate(cols)
    ]
    named = F.col(f"`{target}`").cast("string").alias("class")
    long = df.where(F.col(f"`{target}`").isNotNull()).select(named, F.explode(F.array(*parts)).alias("e"))
    counts = long.where(F.col("e.v").isNotNull()).groupBy("e.f", "e.v", "class").agg(F.count(F.lit(1)).alias("w"))
    counts = staged(counts, "class_values")
    values = counts.groupBy("f", "v").agg(F.sum("w").alias("k"))
    ranked = staged(running_total(values, ["f"], ["v"], "k", "before", "total", max_rows), "value_ranks")
    k = F.col("k").cast("double")
    ties = ranked.groupBy("f").agg(F.max("total").alias("total"), F.sum(k * k * k - k).alias("ties"))
    rank = F.col("before") + (F.col("k") + 1) / 2
    sums = counts.join(ranked.select("f", "v", rank.alias("rank")), ["f", "v"]).groupBy("f", "class")
    sums = sums.agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("rank")).alias("ranks"))
    return sums.join(ties, "f").select("f", "class", "n", "total", "ranks", "ties").orderBy("f", "class").collect()


def relevance(
    df: DataFrame,
    target: str,
    cols: Sequence[str] | None = None,
    classes: bool = False,
    level: float = 0.05,
    independent: bool = False,
    max_rows: int = MAX_SERIES_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Table ``variable, class, n, z, p_value, relevant`` of the features ``cols`` against ``target``.

    Rows without a value of feature or target are left out of that feature's test. A feature of one value has
    no z and a p-value of 1. A target of two classes is tested once, one of more once a class, with a step-up
    for each class; ``class`` is null for a target of values.
    """
    cols = [c for c in (cols or df.columns) if c != target]
    tests: dict[str | None, list[tuple[str, int, float | None]]] = {}
    if not classes:
        found = kendall_counts(df, [(c, target) for c in cols], block_rows) if cols else []
        tests[None] = [(c, int(k["n"]), kendall_z(k)) for c, k in zip(cols, found)]
    else:
        rows = _rank_sums(df, target, cols, max_rows) if cols else []
        names = sorted({r["class"] for r in rows})
        known = {(r.f, r["class"]): r for r in rows}
        totals = {r.f: r.total for r in rows}
        for name in names[1:] if len(names) == 2 else names:
            tests[name] = []
            for i, c in enumerate(cols):
                r = known.get((i, name))
                z = rank_sum_z(r.n, r.total, r.ranks, r.ties) if r else None
                tests[name].append((c, int(totals.get(i, 0)), z))
    out = []
    for name, some in tests.items():
        p = [two_sided(z) for _, _, z in some]
        chosen = step_up(p, level, independent)
        out += [(c, name, n, z, q, keep) for (c, n, z), q, keep in zip(some, p, chosen)]
    return df.sparkSession.createDataFrame(out, SCHEMA)


def select_relevant(df: DataFrame, target: str, cols: Sequence[str] | None = None, least_classes: int = 1, **options) -> DataFrame:
    """``df`` without the features that are relevant to the target, or to ``least_classes`` of its classes, nowhere."""
    cols = [c for c in (cols or df.columns) if c != target]
    hits: dict[str, int] = {}
    for r in relevance(df, target, cols, **options).where("relevant").collect():
        hits[r.variable] = hits.get(r.variable, 0) + 1
    return df.drop(*[c for c in cols if hits.get(c, 0) < least_classes])
