"""Near-duplicate documents: n-gram Jaccard join by MinHash banding.

A document is the set of its word n-grams (five words; a shorter text is one n-gram), as 64-bit hashes.
Documents with equal sets form a class, found by one aggregate, and only one of each class goes on. From
``threshold`` and a target recall follow the bands and rows of the MinHash signature. Classes are
shuffled on their band hashes; band hashes met by one class, or by the same classes as another band hash,
are dropped. The classes of a bucket compare whole signatures in their task, which returns a spanning
forest of the likely links, never the pairs. A class then travels to its group of likely links, where
full n-gram sets are compared. A bucket or a group beyond ``BLOCK`` classes is dealt as pairs of blocks
over many tasks, so that every two of its classes meet. Links are counted, and contracted to a forest, where they are found.

Defined cases: words are maximal runs without ASCII white space, in lower case. Null texts and texts
without words link with nothing. Null identifiers are allowed; a component is named by its smallest
identifier that is not null. Rows that repeat an identifier are documents of their own, and equal texts, of
any number, one class. A very long text is hashed whole. An empty table gives an empty result. Identifier and
text alone are read for the links; ``one_of_each`` returns the other columns as they are, but for names
beginning with ``_gl_``, which are the operator's own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.components import components
from gaugeloom.llm.runs import by_key, fewer, runs
from gaugeloom.llm.shingles import shingle_sets
from gaugeloom.session import staged

#: Classes of a bucket or of a group that one task compares with each other.
BLOCK = 1_024
#: Columns of n-grams in one matrix product.
COLUMNS = 8_192


@dataclass(frozen=True)
class Settings:
    """``slack``: by how much a signature may fall short of the threshold before sets are compared."""

    words: int = 5
    threshold: float = 0.8
    recall: float = 0.9995
    hashes: int = 170
    slack: float = 0.2

    def banding(self) -> tuple[int, int]:
        """Bands and rows: the most rows whose bands reach the recall within the number of hashes."""
        for rows in range(16, 0, -1):
            bands = math.ceil(math.log(1 - self.recall) / math.log(1 - self.threshold**rows))
            if bands * rows <= self.hashes:
                return bands, rows
        raise ValueError("more hashes are needed for this recall")


def _maps(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    odd = random.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, random.integers(0, 2**63, n, dtype=np.uint64)


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """16 bits of the smallest value of each linear map of the hashes."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for part in np.array_split(hashes, max(1, len(hashes) // 512)):
        np.minimum(least, (part[:, None] * a + b).min(0), out=least)
    return (least >> np.uint64(20)).astype(np.uint16)


def _narrow(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("mark"), F.lower(F.col(text)).alias("text")
    )


def _signed(df: DataFrame, words: int, n: int) -> DataFrame:
    """(doc_id, mark, key, signature): equal sets have equal keys; both are null without words."""
    a, b = _maps(n)

    def run(batches):
        for batch in batches:
            keys, signatures = [], []
            for hashes in shingle_sets(batch.column(2), words):
                keys.append(None)
                signatures.append(None)
                if len(hashes):
                    turned = (hashes >> np.uint64(31)) * hashes
                    keys[-1] = np.array([hashes.sum(), turned.sum(), len(hashes)], np.uint64).tobytes()
                    signatures[-1] = signature(hashes, a, b).tobytes()
            added = [pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *added], names=["doc_id", "mark", "key", "signature"]
            )

    return df.mapInArrow(run, "doc_id long, mark long, key binary, signature binary")


def joined_roots(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest place reachable from each place, after joining the pairs to the state ``root``."""
    while len(left):
        a, b = root[left], root[right]
        open_ = a != b
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        if not len(left):
            break
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _buckets(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(bucket, parts, node): band buckets of several classes, each set of classes once.

    ``parts`` is the number of blocks of about ``BLOCK`` classes that the bucket is dealt in.
    """
    width = 2 * rows
    place = F.posexplode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band", "n")
    met = classes.select("node", "signature", place)
    part = F.expr(f"substring(signature, n * {width} + 1, {width})")
    met = met.select("node", F.xxhash64("band", part).alias("bucket"))
    sets = met.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"),
        F.min("node").alias("first"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members"),
    )
    sets = sets.where("size > 1").groupBy("size", "first", "members").agg(F.min("bucket").alias("bucket"))
    sets = sets.withColumn("parts", F.ceil(F.col("size") / BLOCK)).select("bucket", "parts")
    return met.join(sets, "bucket").select("bucket", "parts", "node")


def _likely_links(classes: DataFrame, bands: int, rows: int, least: float) -> DataFrame:
    """A forest (a, b) of the classes alike in some bucket; all pairs of blocks of a bucket meet."""
    met = _buckets(classes, bands, rows).join(classes.select("node", "signature"), "node")
    met = met.withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")))
    meetings = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")
    met = met.select("bucket", "block", "node", "signature", meetings)
    met = met.select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "signature"
    )

    def run(batches):
        for rows_ in runs(batches, (0, 1, 2)):
            nodes = rows_.column(4).to_numpy()
            marks = np.frombuffer(b"".join(rows_.column(5).to_pylist()), np.uint16).reshape(len(nodes), -1)
            order = np.argsort(nodes, kind="stable")
            nodes, marks, block = nodes[order], marks[order], rows_.column(3).to_numpy()[order]
            i, j = rows_.column(1)[0].as_py(), rows_.column(2)[0].as_py()
            ones, others = np.flatnonzero(block == i), np.flatnonzero(block == j)
            theirs = marks[others]
            root = np.arange(len(nodes))
            for k in range(0, len(ones), 16):
                begin = k if i == j else 0  # within a block each pair is met once
                alike = (marks[ones[k : k + 16], None] == theirs[None, begin:]).mean(2) >= least
                left, right = np.nonzero(alike)
                root = joined_roots(root, ones[left + k], others[right + begin])
            other = np.flatnonzero(root != np.arange(len(nodes)))
            if len(other):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(nodes[root[other]])], names=["a", "b"])

    met = by_key(met, "bucket", "i", "j")
    return met.mapInArrow(lambda batches: fewer(run(batches)), "a long, b long")


def shared_grams(sets: list[np.ndarray]) -> np.ndarray:
    """For all pairs of sets the number of common members, by products of bounded 0/1 matrices."""
    sizes = [len(x) for x in sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = often > 1  # a gram of one set is in no intersection
    renamed = np.cumsum(several) - 1
    use = several[column]
    owner, column = owner[use], renamed[column[use]]
    common = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for begin in range(0, int(several.sum()), COLUMNS):
        low, high = np.searchsorted(column, (begin, begin + COLUMNS))
        matrix = np.zeros((len(sets), COLUMNS), np.float32)
        matrix[owner[low:high], column[low:high] - begin] = 1
        common += matrix @ matrix.T
    np.fill_diagonal(common, sizes)
    return common


def _verified(members: DataFrame, words: int, threshold: float) -> DataFrame:
    """From (lot, i, j, block, node, copies, text): rows (a, b, links); b null: links of a, else a link."""

    def run(batches):
        for rows in runs(batches, (0, 1, 2)):
            _, first = np.unique(rows.column(4).to_numpy(), return_index=True)
            rows = rows.take(pa.array(first)).combine_chunks()
            nodes, copies = rows.column(4).to_numpy(), rows.column(5).to_numpy()
            sets = list(shingle_sets(rows.column(6).chunk(0), words))
            common = shared_grams(sets)
            sizes = np.fromiter(map(len, sets), np.float64, len(sets))
            linked = common >= threshold * (sizes[:, None] + sizes - common) - 1e-9
            np.fill_diagonal(linked, False)
            i, j = rows.column(1)[0].as_py(), rows.column(2)[0].as_py()
            if i != j:
                block = rows.column(3).to_numpy()
                linked &= block[:, None] != block
            left, right = np.nonzero(np.triu(linked))
            root = joined_roots(np.arange(len(nodes)), left, right)
            other = np.flatnonzero(root != np.arange(len(nodes)))
            links = linked @ copies
            some = np.flatnonzero(links)
            a = np.concatenate([nodes[some], nodes[other]])
            b = pa.array([None] * len(some) + nodes[root[other]].tolist(), pa.int64())
            n = np.concatenate([links[some], np.zeros(len(other), np.int64)]).astype(np.int64)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(n)], names=["a", "b", "links"])

    return members.mapInArrow(lambda batches: fewer(run(batches)), "a long, b long, links long")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``df``: doc_id, mark (hash of the text), n_links, component_id, component.

    ``n_links`` counts the other rows of similarity ``threshold`` or more; ``component_id`` is the smallest
    doc_id reachable over links (the row's own without links). Components of null or repeated identifiers may
    share that name; ``component`` tells them apart (null for texts without words).
    """
    bands, rows = settings.banding()
    narrow = _narrow(df, doc_id, text)
    signed = staged(_signed(narrow, settings.words, bands * rows), "signed")
    known = signed.where(F.col("key").isNotNull())
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("least")
    classes = known.groupBy("key").agg(least, F.count(F.lit(1)).alias("copies"), F.first("signature").alias("signature"))
    classes = classes.select("key", "least.doc_id", "least.mark", "copies", "signature")
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    likely = staged(_likely_links(classes, bands, rows, settings.threshold - settings.slack), "likely")
    lots = components(likely).select("node", F.col("component").alias("lot"))
    sizes = lots.groupBy("lot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    members = classes.select("node", "doc_id", "mark", "copies").join(lots, "node").join(sizes, "lot")
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    texts = narrow.withColumnRenamed("doc_id", "_id").withColumnRenamed("mark", "_mark")
    members = members.join(texts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")))
    meetings = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    members = members.select("lot", "block", "node", "copies", "text", meetings)
    members = members.select(
        "lot", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "copies", "text"
    )
    found = staged(_verified(by_key(members, "lot", "i", "j"), settings.words, settings.threshold), "verified")

    counts = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(found.where(F.col("b").isNotNull()).select("a", "b"))
    named = classes.select("node", "doc_id", "key", "copies").join(roots, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    result = named.join(names, "component").join(counts, "node", "left")
    result = result.select(
        F.col("key").alias("_key"), "component_id", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    joined = signed.join(result, F.col("key") == F.col("_key"), "left")
    return joined.select(
        "doc_id",
        "mark",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "component",
    )


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The rows of ``df`` that stay: of each component the row of its smallest identifier.

    Of rows that share that identifier the one of the smallest text hash stays, of equal rows one. A
    component whose identifiers are all null keeps the row of the smallest text hash.
    """
    found = near_duplicates(df, doc_id, text, settings)
    linked = found.where("n_links > 0")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    stays = linked.groupBy(F.col("component").alias("_c")).agg(F.min(place).alias("least"))
    stays = stays.select("_c", F.col("least.doc_id").alias("_d"), F.col("least.mark").alias("_m"))
    goes = linked.select(F.col("doc_id").alias("_gl_id"), F.col("mark").alias("_gl_mark"), "component").distinct()
    same = (F.col("component") == F.col("_c")) & F.col("_gl_id").eqNullSafe(F.col("_d")) & (F.col("_gl_mark") == F.col("_m"))
    marked = goes.join(stays, same, "left").select("_gl_id", "_gl_mark", F.col("_m").isNotNull().alias("_gl_stays"))
    rows = df.withColumn("_gl_text", F.xxhash64(F.col(text)))
    match = F.col(doc_id).cast("long").eqNullSafe(F.col("_gl_id")) & (F.col("_gl_text") == F.col("_gl_mark"))
    rows = rows.join(marked, match, "left")
    alone = rows.where(F.col("_gl_stays").isNull())
    kept = rows.where("_gl_stays").dropDuplicates([doc_id, "_gl_text"])
    return alone.unionByName(kept).select(*[F.col(f"`{c}`") for c in df.columns])
