"""Suffix-array dedup: bytes covered by long strings that occur elsewhere, found by merging transforms.

A window is ``length`` bytes from a place. Every window has an anchor: the place of the smallest hash of
``GRAM`` bytes in it, the first of equal ones. Equal windows have equal anchor hashes, so only texts around
anchors of one hash have to meet. The windows of one anchor are a stretch of text, the fragment. Equal
fragments are collapsed before anything is sent: they come as one text with their number. Fragments whose
anchor hash occurs once are dropped. The others are dealt by anchor hash; a task cuts its fragments into
shards, builds each shard's Burrows-Wheeler transform and merges them by interleave refinement
(``bwt_merge``), which gives the windows with a common prefix of ``length`` bytes with another one.
An anchor hash of more than ``HOT`` different fragments would be too much for a task: there each window is
a fragment of its own, collapsed like the others, and equal windows meet in the count.

Defined cases: null texts are empty; texts shorter than ``length`` have nothing removed; matches never
cross documents; rows that are equal, identifier included, repeat each other and lose what they share. Null
identifiers are allowed. Ties between equal hashes go to the first place. A very long text is one row, whose
windows are dealt like others. An empty table gives an empty result. Only identifier and text are read, so
other columns of any name do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeloom.llm.bwt_merge import repeated_windows
from gaugeloom.llm.passages import sharing
from gaugeloom.llm.runs import by_key, fewer, least_places, lots, runs
from gaugeloom.session import staged

LENGTH = 400
#: Bytes of a symbol of the transforms; it divides LENGTH.
SYMBOL = 100
GRAM = 32
#: Bytes that are hashed at once; a longer text is cut into slices that overlap by a window.
SLICE = 1_000_000
#: Bytes of fragments whose transforms are merged at once, and different fragments of one anchor hash in them.
LOT = 1_500_000
#: Bytes of texts that are cut and handed back at once.
RETURNED = 4_000_000
HOT = 10_000


def _digest(data) -> int:
    """64 bits; with the hash of the anchor they name a fragment or a window."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "big", signed=True)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place, from their four words of eight bytes."""
    n = len(data) - GRAM + 1
    out = np.zeros(n, np.uint64)
    for k in range(0, GRAM, 8):
        word = np.ndarray((n,), "<u8", data, k, (1,)).astype(np.uint64)
        out = (out ^ word) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(32)
    return out


def anchors_of(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each anchor of a byte string, and the first and the last window that it is the anchor of."""
    grams = _gram_hashes(data)
    place, first, last = least_places(grams, length - GRAM + 1)
    return grams[place].view(np.int64), first, last


def _narrow(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return df.select(F.col(doc_id).alias("id"), F.xxhash64(body).alias("mark"), body.alias("body"))


def fragments(narrow: DataFrame, length: int) -> DataFrame:
    """(id, mark, hash, digest, s, n): the fragment of every anchor starts at byte s and holds n windows."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                buffer = batch.column(2)[i].as_buffer()
                data = np.frombuffer(buffer, np.uint8)
                for begin in range(0, max(len(data) - length + 1, 0), SLICE):
                    part = data[begin : begin + SLICE + length - 1]
                    hashes, first, last = anchors_of(part, length)
                    view = memoryview(part)
                    digests = [_digest(view[a : b + length]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                    n = len(first)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([batch.column(0)[i].as_py()] * n, batch.schema.field(0).type),
                            pa.array(np.full(n, batch.column(1)[i].as_py())),
                            pa.array(hashes),
                            pa.array(digests, pa.int64()),
                            pa.array(first + begin),
                            pa.array(last - first + 1),
                        ],
                        names=["id", "mark", "hash", "digest", "s", "n"],
                    )

    schema = T.StructType([narrow.schema["id"]])
    for name in ("mark", "hash", "digest", "s", "n"):
        schema.add(name, T.LongType())
    return narrow.mapInArrow(lambda batches: fewer(run(batches)), schema)


def _with_text(narrow: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(hash, digest, times, body) of the wanted fragments (id, mark, s, n, hash, digest, times)."""
    lists = wanted.groupBy(F.col("id").alias("_id"), F.col("mark").alias("_mark"))
    lists = lists.agg(F.collect_list(F.struct("hash", "digest", "times", "s", "n")).alias("wanted"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    rows = narrow.join(lists, same).select("body", "wanted")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                view = memoryview(batch.column(0)[i].as_buffer())
                parts = batch.column(1)[i].values
                s, n = parts.field("s").to_numpy(), parts.field("n").to_numpy()
                bodies = [bytes(view[a : a + b + length - 1]) for a, b in zip(s.tolist(), n.tolist(), strict=True)]
                columns = [parts.field("hash"), parts.field("digest"), parts.field("times"), pa.array(bodies, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["hash", "digest", "times", "body"])

    return rows.mapInArrow(lambda batches: fewer(run(batches)), "hash long, digest long, times long, body binary")


def _spans(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return [{"s": a, "e": b - 1} for a, b in edges.reshape(-1, 2).tolist()]


_FOUND = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))


def _merged(texts: DataFrame, length: int, symbol: int) -> DataFrame:
    """(hash, digest, windows): the repeated windows of each fragment, as runs of first places."""

    def groups(batches):
        held, size = [], 0
        for rows in runs(batches, (0,)):
            held.append(rows)
            size += rows.column(3).nbytes
            if size >= LOT:
                yield pa.concat_tables(held)
                held, size = [], 0
        if held:
            yield pa.concat_tables(held)

    def run(batches):
        for lot in groups(batches):
            digests = lot.column(1).to_pylist()
            place = list(dict(zip(digests, range(len(digests)), strict=True)).values())  # equal rows come once
            lot = lot.take(pa.array(place))
            found = repeated_windows(lot.column(3).to_pylist(), lot.column(2).to_numpy(), length, symbol)
            some = [k for k, flags in enumerate(found) if flags.any()]
            if some:
                part = lot.take(pa.array(some))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).combine_chunks(),
                        part.column(1).combine_chunks(),
                        pa.array([_spans(found[k]) for k in some], _FOUND),
                    ],
                    names=["hash", "digest", "windows"],
                )

    return by_key(texts, "hash").mapInArrow(lambda batches: fewer(run(batches)), "hash long, digest long, windows array<struct<s:long,e:long>>")


def _by_window(texts: DataFrame, length: int) -> DataFrame:
    """As ``_merged``, for anchors of very many fragments: every window is collapsed by itself."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                view = memoryview(batch.column(3)[i].as_buffer())
                n = len(view) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array([batch.column(k)[i].as_py()] * n, batch.schema.field(k).type) for k in range(3)),
                        pa.array(np.arange(n)),
                        pa.array([_digest(view[p : p + length]) for p in range(n)], pa.int64()),
                    ],
                    names=["hash", "digest", "times", "at", "window"],
                )

    rows = texts.mapInArrow(lambda batches: fewer(run(batches)), "hash long, digest long, times long, at long, window long")
    several = rows.groupBy("hash", "window").agg(F.sum("times").alias("all")).where(F.col("all") > 1).drop("all")
    place = F.struct(F.col("at").alias("s"), F.col("at").alias("e"))
    return rows.join(several, ["hash", "window"]).groupBy("hash", "digest").agg(F.collect_list(place).alias("windows"))


def repeated_spans(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, symbol: int = SYMBOL, hot: int = HOT
) -> DataFrame:
    """(id, mark, runs): for each document with repeats its repeated windows as runs (s, e) of first bytes."""
    narrow = _narrow(df, doc_id, text)
    every = staged(fragments(narrow, length), "fragments")
    first = F.min(F.struct("id", "mark", "s", "n")).alias("first")
    distinct = every.groupBy("hash", "digest").agg(F.count(F.lit(1)).alias("times"), first)
    distinct = staged(distinct, "distinct_fragments")
    met = distinct.groupBy("hash").agg(F.count(F.lit(1)).alias("kinds"), F.sum("times").alias("all")).where(F.col("all") > 1)
    known = distinct.join(met, "hash")
    wanted = known.where(F.col("kinds") > 1).select("hash", "digest", "times", "kinds", "first.*")
    wanted = staged(wanted, "wanted_fragments")
    some = _merged(_with_text(narrow, wanted.where(F.col("kinds") <= hot), length), length, symbol)
    many = _by_window(_with_text(narrow, wanted.where(F.col("kinds") > hot), length), length)
    whole = known.where((F.col("kinds") == 1) & (F.col("times") > 1))
    all_ = F.array(F.struct(F.lit(0).cast("long").alias("s"), (F.col("first.n") - 1).alias("e")))
    found = some.unionByName(many).unionByName(whole.select("hash", "digest", all_.alias("windows")))
    rows = every.join(found, ["hash", "digest"])
    moved = F.transform("windows", lambda x: F.struct((x["s"] + F.col("s")).alias("s"), (x["e"] + F.col("s")).alias("e")))
    rows = rows.select("id", "mark", moved.alias("windows")).groupBy("id", "mark")
    return rows.agg(F.flatten(F.collect_list("windows")).alias("runs"))


def without_repeats(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    symbol: int = SYMBOL,
    hot: int = HOT,
    words: int | None = None,
) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): maximal removed byte runs [s, e), and the bytes that stay.

    With ``words`` also ``passage``: whether a run of that many words stands in another document too, however few
    bytes it has. It does not change what is removed.
    """
    found = repeated_spans(df, doc_id, text, length, symbol, hot).withColumnsRenamed({"id": "_id", "mark": "_mark"})
    # the texts are shuffled as for _with_text, so that one shuffle serves all
    rows = narrow = _narrow(df, doc_id, text)
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    rows = rows.join(found, same, "left").select("id", "mark", "body", "runs")
    if words is None:
        rows = rows.select(F.col("id").alias("doc_id"), "body", "runs")
    else:
        shared = sharing(narrow, words).select(F.col("id").alias("_id"), F.col("mark").alias("_mark"))
        shared = shared.withColumn("_shared", F.lit(True))
        passage = F.coalesce("_shared", F.lit(False)).alias("passage")
        rows = rows.join(shared, same, "left").select(F.col("id").alias("doc_id"), "body", "runs", passage)

    def run(batches):
        for batch in (lot for whole in batches for lot in lots(whole, 1, RETURNED)):
            sizes, spans, kept = [], [], []
            for i in range(batch.num_rows):
                body, runs_ = batch.column(1)[i].as_py(), batch.column(2)[i]
                removed = covered(runs_.values, length) if runs_.is_valid else []
                at, parts = 0, []
                for a, b in removed:
                    parts.append(body[at:a])
                    at = b
                sizes.append(len(body))
                spans.append([{"s": a, "e": b} for a, b in removed])
                kept.append(b"".join([*parts, body[at:]]))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, _FOUND), pa.array(kept, pa.binary())]
            columns += batch.columns[3:]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "spans", "kept", "passage"][: len(columns)])

    spans = T.ArrayType(T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())]))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("spans", spans)])
    schema = schema.add("kept", T.BinaryType())
    return rows.mapInArrow(run, schema if words is None else schema.add("passage", T.BooleanType()))


def covered(windows: pa.StructArray, length: int) -> list[tuple[int, int]]:
    """The bytes that runs of windows cover, as maximal runs [s, e)."""
    s, e = windows.field("s").to_numpy(), windows.field("e").to_numpy() + length
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    if not len(s):
        return []
    cut = np.flatnonzero(s[1:] > e[:-1])
    return list(zip(s[[0, *(cut + 1)]].tolist(), e[[*cut, len(e) - 1]].tolist(), strict=True))
