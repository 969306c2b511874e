"""Hard negatives of anchors: rows of other labels that score below a positive, but not far below.

Vectors are scored by integer inner products. Each row stores its angles to a few reference directions. By the
triangle inequality on the sphere, the angle of two rows lies between the difference and the sum of their
angles to any reference. The cosines of these, times the norms and widened for rounding, bound the score. Only
pairs whose bounds overlap the wanted window of scores are scored; blocks of rows whose bounds to their own
reference lie below all windows of an anchor do not meet it at all. The references are cluster centres of a
bounded sample (``Settings.sample``): they decide how much is scored, never the result.

Anchors are a stated set of rows that meet all rows in blocks. A row lies in one block, blocks hold about
``Settings.block`` rows however many share a label or a reference, and a task keeps one block and a bounded
number of anchors. Each block gives the few best per anchor or positive, which are merged.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part. Rows of
other lengths do not meet, empty vectors score 0 with each other. Null identifiers are no anchors, and come
last among ties; repeated identifiers are rows of their own. Scores beyond a long wrap around. An empty table,
and an anchor without positives or negatives, gives no rows. Other columns of any name are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.llm.runs import fewer, runs
from gaugeloom.llm.vectors import kmeans
from gaugeloom.session import staged


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the rows that the reference directions are found from."""

    positives: int = 5
    negatives: int = 3
    least: int = 50  # percent of the positive's score
    most: int = 95
    references: int = 16
    sample: int = 4_096
    block: int = 4_096
    anchors: int = 64  # bounded at once
    salts: int = 16
    seed: int = 7


ROW = (
    "node long, vec_id long, label long, size long, vector array<long>, anchor boolean,"
    " part long, angles array<double>, norm double"
)
#: Bounds are widened by this share of the norms' product, and by one: more than rounding can take away.
SLACK = 1e-6


def _matrix(column, dtype) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(dtype).reshape(len(column), -1)


def directions(sample: pa.Table, settings: Settings) -> dict[int, np.ndarray]:
    """Unit references for each length in the sample."""
    out, sizes = {}, sample["size"].to_numpy()
    for size in np.unique(sizes[sizes > 0]).tolist():
        x = _matrix(sample["vector"].filter(pa.array(sizes == size)), np.float64)
        norms = np.sqrt((x**2).sum(1))
        x = x[norms > 0] / norms[norms > 0, None]
        if len(x):
            centres = kmeans(x, min(settings.references, len(x)), np.random.default_rng(settings.seed))
            lengths = np.sqrt((centres**2).sum(1))
            out[size] = centres[lengths > 0] / lengths[lengths > 0, None]
    return out


def _with_angles(rows: DataFrame, references: dict[int, np.ndarray]) -> DataFrame:
    """Add norm, angles to the references of the row's length, and the nearest one as ``part``."""

    def run(batches):
        for batch in batches:
            sizes = batch.column(3).to_numpy()
            norms, part = np.zeros(len(sizes)), np.zeros(len(sizes), np.int64)
            angles: list = [[]] * len(sizes)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                x = _matrix(batch.column(4).take(pa.array(at)), np.float64)
                norms[at] = np.sqrt((x**2).sum(1))
                found = references.get(size)
                if found is None or not len(found):
                    continue
                cosines = (x @ found.T) / np.where(norms[at] > 0, norms[at], 1)[:, None]
                theta = np.arccos(np.clip(cosines, -1, 1))
                part[at] = theta.argmin(1)
                for i, row in zip(at.tolist(), theta, strict=True):
                    angles[i] = row
            added = [pa.array(part), pa.array(angles, pa.list_(pa.float64())), pa.array(norms)]
            names = [*batch.schema.names, "part", "angles", "norm"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    return rows.mapInArrow(run, ROW)


class _Rows:
    """Rows of one block, or some anchors, as arrays."""

    def __init__(self, table: pa.Table):
        self.node = table["node"].to_numpy()
        self.label = table["label"].to_numpy()
        ids = table["vec_id"].combine_chunks()
        self.unknown = ids.is_null().to_numpy(zero_copy_only=False)
        self.id = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.vector = _matrix(table["vector"], np.int64)
        self.norm = table["norm"].to_numpy()
        angles = _matrix(table["angles"], np.float64)
        self.cos, self.sin = np.cos(angles), np.sin(angles)


def _bounds(a: _Rows, x: _Rows) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of each anchor with each row."""
    low, high = np.full((2, len(a.node), len(x.node)), [[[-1.0]], [[1.0]]])
    for k in range(a.cos.shape[1]):
        straight, turned = np.outer(a.cos[:, k], x.cos[:, k]), np.outer(a.sin[:, k], x.sin[:, k])
        np.minimum(high, straight + turned, out=high)
        np.maximum(low, straight - turned, out=low)
    norms = np.outer(a.norm, x.norm)
    slack = norms * SLACK + 1
    return low * norms - slack, high * norms + slack


def _scores(a: np.ndarray, x: np.ndarray, at: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products with the rows ``at``; in doubles where these hold them exactly."""
    rows = x[at]
    return (rows @ a).astype(np.int64) if exact else (rows.astype(np.int64) @ a.astype(np.int64))


def _best(score: np.ndarray, at: np.ndarray, x: _Rows, n: int) -> np.ndarray:
    """Places in ``at`` of the n highest scores, ties by smaller identifier."""
    places = np.arange(len(at))
    if len(at) > n:
        places = np.flatnonzero(score >= np.partition(score, len(at) - n)[len(at) - n])
    order = np.lexsort((x.id[at[places]], x.unknown[at[places]], -score[places]))
    return places[order[:n]]


def _in_blocks(met: DataFrame, found, schema: str, settings: Settings) -> DataFrame:
    """``found(anchors, rows, table of the anchors)`` for the anchors that meet each block, a few at a time."""

    def run(batches):
        members, key = None, None
        # a block comes whole; anchors may be many more
        for table in runs(batches, (0, 1, 2, 3), 4 * settings.block):
            now = tuple(table[k][0].as_py() for k in range(3))
            if not table["search"][0].as_py():
                members, key = _Rows(table), now
            elif key == now:
                for begin in range(0, table.num_rows, settings.anchors):
                    part = table.slice(begin, settings.anchors).combine_chunks()
                    yield from found(_Rows(part), members, part)

    keys = ["size", "part", "block"]
    met = met.repartition(*keys).sortWithinPartitions(*keys, "search")
    return met.mapInArrow(lambda batches: fewer(run(batches)), schema)


def _prepared(a: _Rows, x: _Rows) -> tuple[np.ndarray, np.ndarray, bool]:
    most = a.norm.max(initial=0.0) * x.norm.max(initial=0.0)
    exact = bool(most < 2**52)
    kind = np.float64 if exact else np.int64
    return a.vector.astype(kind), x.vector.astype(kind), exact


def _met(rows: DataFrame, blocks: DataFrame, searches: DataFrame, settings: Settings) -> DataFrame:
    """Rows in their blocks and the anchors that meet them, in one table."""
    own = rows.join(blocks.select("size", "part", "blocks").distinct(), ["size", "part"])
    own = own.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).drop("blocks")
    own = own.withColumn("search", F.lit(0)).withColumns({"ids": F.array().cast("array<long>"), "scores": F.array().cast("array<long>")})
    columns = ["size", "part", "block", "search", "node", "vec_id", "label", "vector", "angles", "norm", "ids", "scores"]
    return own.select(columns).unionByName(searches.withColumn("search", F.lit(1)).select(columns))


def _blocks(rows: DataFrame, settings: Settings) -> DataFrame:
    return rows.groupBy("size", "part").agg(F.ceil(F.count(F.lit(1)) / settings.block).alias("blocks"))


def _positives(rows: DataFrame, anchors: DataFrame, settings: Settings) -> DataFrame:
    """The best other rows of each anchor's label: node, ids, scores, best first."""

    def found(a: _Rows, x: _Rows, table: pa.Table):
        av, xv, exact = _prepared(a, x)
        _, high = _bounds(a, x)
        high[a.node[:, None] == x.node[None]] = -np.inf
        n = min(settings.positives, len(x.node))
        first = min(8 * n, len(x.node))
        for i in range(len(a.node)):
            tried = np.argpartition(-high[i], first - 1)[:first]
            tried = tried[high[i, tried] > -np.inf]
            if not len(tried):
                continue
            score = _scores(av[i], xv, tried, exact)
            if len(tried) >= n:
                # what cannot reach the n-th best of these is not scored
                least = np.partition(score, len(score) - n)[len(score) - n]
                tried = np.flatnonzero((high[i] >= least) & (high[i] > -np.inf))
                score = _scores(av[i], xv, tried, exact)
            best = _best(score, tried, x, n)
            ids = pa.array(x.id[tried[best]], mask=x.unknown[tried[best]])
            nodes = pa.array(np.repeat(a.node[i], len(best)))
            yield pa.RecordBatch.from_arrays([nodes, ids, pa.array(score[best])], names=["node", "id", "score"])

    rows, anchors = (t.drop("part").withColumn("part", F.col("label")) for t in (rows, anchors))
    blocks = _blocks(rows, settings)
    none = {"ids": F.array().cast("array<long>"), "scores": F.array().cast("array<long>")}
    searches = anchors.join(blocks, ["size", "part"]).withColumns(none)
    searches = searches.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    best = _in_blocks(_met(rows, blocks, searches, settings), found, "node long, id long, score long", settings)
    order = Window.partitionBy("node").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    best = best.withColumn("k", F.row_number().over(order)).where(F.col("k") <= settings.positives)
    listed = F.array_sort(F.collect_list(F.struct("k", "id", "score")))
    best = best.groupBy("node").agg(listed.alias("b"))
    return best.select("node", F.col("b.id").alias("ids"), F.col("b.score").alias("scores"))


def _windows(scores: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of a negative for each positive's score."""
    return -((-settings.least * scores) // 100), (settings.most * scores) // 100


def _negatives(rows: DataFrame, anchors: DataFrame, settings: Settings) -> DataFrame:
    """For each anchor and positive the best few of each block, then of all."""

    def found(a: _Rows, x: _Rows, table: pa.Table):
        av, xv, exact = _prepared(a, x)
        low, high = _bounds(a, x)
        ids, scores = table["ids"].to_pylist(), table["scores"].to_pylist()
        out: list[tuple] = []
        for i in range(len(a.node)):
            least, most = _windows(np.array(scores[i], np.int64), settings)
            some = least <= most
            if not some.any():
                continue
            wanted = (high[i] >= least[some].min()) & (low[i] <= most[some].max()) & (x.label != a.label[i])
            at = np.flatnonzero(wanted)
            score = _scores(av[i], xv, at, exact)
            for k in np.flatnonzero(some).tolist():
                inside = np.flatnonzero((score >= least[k]) & (score <= most[k]))
                best = inside[_best(score[inside], at[inside], x, settings.negatives)]
                for j in best.tolist():
                    p = at[j]
                    negative = None if x.unknown[p] else int(x.id[p])
                    out.append((int(a.node[i]), int(a.id[i]), k, ids[i][k], scores[i][k], negative, int(score[j])))
        if out:
            kinds = [pa.int64()] * 7
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    schema = "node long, anchor_id long, k long, positive_id long, positive_score long, negative_id long, negative_score long"
    # a block's rows lie at angles from near to far of their own reference
    own = F.when(F.size("angles") > 0, F.element_at("angles", (F.col("part") + 1).cast("int"))).otherwise(F.lit(0.0))
    blocks = _blocks(rows, settings)
    placed = rows.join(blocks, ["size", "part"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    ranges = placed.groupBy("size", "part", "block").agg(
        F.min(own).alias("near"), F.max(own).alias("far"), F.max("norm").alias("long")
    )
    salted = ranges.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(settings.salts - 1))))
    salted = salted.withColumnRenamed("part", "p")
    angle = F.when(F.size("angles") > 0, F.element_at("angles", (F.col("p") + 1).cast("int"))).otherwise(F.lit(0.0))
    apart: Column = F.greatest(F.lit(0.0), F.col("near") - angle, angle - F.col("far"))
    norms = F.col("norm") * F.col("long")
    highest = F.greatest(F.lit(0.0), norms * F.cos(apart)) + norms * SLACK + 1
    lowest = F.array_min(F.transform("scores", lambda s: F.ceil(s.cast("double") * settings.least / 100)))
    salt = F.pmod(F.xxhash64("node"), F.lit(settings.salts)).cast("int")
    met = anchors.withColumn("salt", salt).join(salted, ["size", "salt"]).where(highest >= lowest)
    searches = met.drop("part").withColumnRenamed("p", "part")
    best = _in_blocks(_met(rows, blocks, searches, settings), found, schema, settings)
    order = Window.partitionBy("node", "k").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.negatives)


def hard_negatives(
    df: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "vector", label: str = "label", settings: Settings = Settings()
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of the rows where ``anchor`` holds.

    ``vector`` is an array of integers. An anchor's positives are its best other rows of the same label. For
    each of them the best rows of other labels are returned whose score is between ``least`` and ``most``
    percent of the positive's.
    """
    rows = df.select(
        F.monotonically_increasing_id().alias("node"),
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"),
        F.size(vector).cast("long").alias("size"),
        F.col(vector).cast("array<long>").alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    whole = F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    rows = staged(rows.where(whole), "integer_vectors")
    taken = rows.select("size", "vector").orderBy(F.xxhash64("vector"), "node").limit(settings.sample).toArrow()
    references = directions(taken, settings)
    rows = staged(_with_angles(rows, references), "angles")
    anchors = rows.where(F.col("anchor") & F.col("vec_id").isNotNull())
    positives = staged(_positives(rows, anchors, settings), "positives")
    return _negatives(rows, anchors.join(positives, "node"), settings).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
