"""Quality of texts by compression with dictionaries of good and of bad text.

Two zstandard dictionaries are trained on slices of labelled texts, one a label. A text is cut into pieces of
``piece`` bytes, and every piece is compressed with each dictionary: good text becomes smaller with the good
one. The difference of the two sizes, divided by the text's length (plus a constant, as the sizes of short
texts say little), is the measure. A logistic curve, fitted on labelled slices that the dictionaries have not
seen, makes of it the probability of label 1; its second term, the length's share of length plus constant,
lets the curve fall back to the labels' proportion for short texts.

The labelled rows are learned from by a bounded sample (``SampleSize``); every text is scored whole.

Defined cases: null texts count as empty, and score by the proportion alone; so does every text if one of the
labels is missing (0.5 without any). Labels other than 0 and 1 and those of null identifiers are not learned
from. Repeated rows get equal scores, and equal texts of one label enter the sample once. Very long texts are compressed piece by piece. An
empty table gives an empty result; an output column that exists already is an error, others stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeloom.session import staged

#: Score from which a text is called good.
GOOD = 0.7


@dataclass(frozen=True)
class SampleSize:
    """Bounds of what is learned from: slices of each label and code points of a slice; bytes of a dictionary."""

    rows: int = 2_000
    characters: int = 1_024
    dictionary: int = 65_536


@dataclass(frozen=True)
class Classifier:
    dictionaries: tuple[bytes, bytes]  # of label 0, of label 1
    curve: tuple[float, float, float]  # constant, measure, share of the length
    constant: float
    piece: int = 1_024
    level: int = 3

    def sizes(self):
        """A function from bytes to the two compressed sizes; it holds compressors, so it is made where it is used."""
        params = zstandard.ZstdCompressionParameters.from_level(
            self.level,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        tools = [
            zstandard.ZstdCompressor(compression_params=params, dict_data=_dictionary(d)) if d else None
            for d in self.dictionaries
        ]

        def run(text: bytes) -> tuple[int, int]:
            bad, good = tools
            if not (bad and good):
                return 0, 0
            pieces = [text[i : i + self.piece] for i in range(0, len(text), self.piece)]
            return sum(len(bad.compress(p)) for p in pieces), sum(len(good.compress(p)) for p in pieces)

        return run

    def scores(self, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        z = _terms(sizes, lengths, self.constant) @ np.array(self.curve)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(content)


def _terms(sizes: np.ndarray, lengths: np.ndarray, constant: float) -> np.ndarray:
    share = lengths / (lengths + constant)
    return np.column_stack([np.ones(len(lengths)), (sizes[:, 0] - sizes[:, 1]) / (lengths + constant), share])


def sample(
    df: DataFrame, labels: DataFrame, key: str, label: str, text: str, size: SampleSize
) -> tuple[DataFrame, dict[int, int]]:
    """At most ``size.rows`` slices (label, mark, text) of each label, and the number of its distinct texts.

    Texts are drawn and cut by their hash. Identifiers and hashes alone meet the labels for the counts; then
    slices of the texts in the share of the hashes that holds about twice the wanted number. Whole texts are
    never shuffled, and what meets in a task does not grow with the table.
    """
    labels = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1))
    labels = labels.distinct()
    rows = df.where(F.length(text) > 0).select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("text"))
    counted = rows.select("key", "mark").join(labels, "key").groupBy("label").agg(F.count_distinct("mark").alias("n"))
    counts = {r["label"]: r["n"] for r in counted.collect()}
    shares = {k: min(1.0, (2 * size.rows + 50) / n) for k, n in counts.items()}
    place = F.pmod("mark", F.lit(1 << 30)) / F.lit(1 << 30)
    longest = F.greatest(F.length("text") - size.characters, F.lit(0)) + 1
    cut = F.substring(F.col("text"), (F.pmod("mark", longest) + 1).cast("int"), F.lit(size.characters))
    low = rows.where(place <= max(shares.values(), default=0.0)).select("key", "mark", cut.alias("text"))
    found = low.join(labels, "key").where(F.coalesce(*[F.when(F.col("label") == k, place <= v) for k, v in shares.items()], F.lit(False)))
    found = staged(found.groupBy("label", "mark").agg(F.min("text").alias("text")), "labelled")
    parts = [found.where(F.col("label") == k).orderBy("mark").limit(size.rows) for k in (0, 1)]
    return parts[0].unionAll(parts[1]), counts


def _trained(texts: list[bytes], most: int) -> bytes:
    """A dictionary; of a few short texts, too few to train on, the texts themselves."""
    try:
        return zstandard.train_dictionary(most, texts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-most:]


def _curve(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-6) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, halved where the loss would rise; coefficients and loss."""
    scale = np.maximum(np.abs(x).max(0), 1e-12)
    x = x / scale

    def loss(b):
        z = x @ b
        return float((weights * (np.logaddexp(0, z) - y * z)).sum() + ridge * weights.sum() * (b @ b) / 2)

    b, now = np.zeros(x.shape[1]), loss(np.zeros(x.shape[1]))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -500, 500)))
        slope = x.T @ (weights * (p - y)) + ridge * weights.sum() * b
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + ridge * weights.sum() * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        while (then := loss(b - step)) > now and np.abs(step).max() > 1e-10:
            step = step / 2
        if np.abs(step).max() <= 1e-10:
            break
        b, now = b - step, then
    return b / scale, now


def train(rows: list[tuple[int, str]], counts: dict[int, int], size: SampleSize = SampleSize()) -> Classifier:
    """Dictionaries from two thirds of the (label, text) rows, the curve from the rest.

    ``counts`` tells how many texts of each label there are; the curve weighs the labels by it.
    """
    total = sum(counts.values())
    if min(counts.get(0, 0), counts.get(1, 0)) == 0:
        p = (counts.get(1, 0) + 1) / (total + 2)
        return Classifier((b"", b""), (float(np.log(p / (1 - p))), 0.0, 0.0), 1.0)
    by_label = [[t.encode() for label, t in rows if label == k] for k in (0, 1)]
    dictionaries = tuple(_trained([t for i, t in enumerate(x) if i % 3 or len(x) < 3], size.dictionary) for x in by_label)
    plain = Classifier(dictionaries, (0.0, 0.0, 0.0), 1.0)
    measure = plain.sizes()
    seen = [(k, t) for k in (0, 1) for i, t in enumerate(by_label[k]) if i % 3 == 0 or len(by_label[k]) < 3]
    # heads of the slices too, for short texts
    seen += [(k, t[: 8 << (i % 6)]) for i, (k, t) in enumerate(seen)]
    y = np.array([k for k, _ in seen], float)
    sizes = np.array([measure(t) for _, t in seen], float)
    lengths = np.array([len(t) for _, t in seen], float)
    share = np.array([counts[k] / total / (y == k).sum() for k in (0, 1)])
    weights = share[y.astype(int)] * len(y)
    fits = [(*_curve(_terms(sizes, lengths, c), y, weights), c) for c in (16.0, 64.0, 256.0)]
    curve, _, constant = min(fits, key=lambda f: f[1])
    return Classifier(dictionaries, tuple(float(v) for v in curve), constant)


def fit(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text", size: SampleSize = SampleSize()
) -> Classifier:
    """Train on a bounded sample of ``df``, labelled by ``key``; the caller leaves out rows that must not be learned from."""
    rows, counts = sample(df, labels, key, label, text, size)
    return train([(r["label"], r["text"]) for r in rows.collect()], counts, size)


def scored(df: DataFrame, classifier: Classifier, text: str = "text", score: str = "score") -> DataFrame:
    """Add the probability that a text is good."""
    if score.lower() in map(str.lower, df.columns):
        raise ValueError(f"column {score} exists")
    at = df.columns.index(text)

    def run(batches):
        measure = classifier.sizes()
        for batch in batches:
            column = batch.column(at).cast(pa.binary())
            texts = (column[i].as_py() or b"" for i in range(batch.num_rows))
            found = np.array([(*measure(t), len(t)) for t in texts], float).reshape(-1, 3)
            scores = classifier.scores(found[:, :2], found[:, 2]).round(9)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, score])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(score, T.DoubleType())]))
