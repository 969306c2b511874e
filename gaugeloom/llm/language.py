"""Language identification by a byte convolutional network, trained here on labelled text.

The network sees fixed-length windows of UTF-8 bytes: byte embeddings, filters of several widths, the
largest value of each filter over the window, one linear layer and softmax. It is trained in numpy on a
bounded sample of labelled rows (``SampleSize``), and sent to the tasks as one small array. Because
embedding and filters are linear, a filter's value is a sum of table rows chosen by bytes or pairs of
bytes, so applying it needs look-ups and additions only. A text's score is the mean of its windows'
probabilities, weighted by the bytes they hold; every window of every text counts.

Null texts and texts without a letter get the language ``und`` and score 0; so does every text if there
is no labelled one. Ties go to the first language in code point order. Rows are judged one by one, so
repeated rows get equal results, and copies enter the sample once. The ``SampleSize.languages`` labels of most
texts are learned, rarer ones cannot be predicted. An empty table gives an empty result. An output column that
exists already is an error, others stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNDETERMINED = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
#: Windows scored at once: bounds the memory of the look-ups.
BLOCK_WINDOWS = 32


@dataclass(frozen=True)
class SampleSize:
    """Bounds of the training sample: rows a language, languages, and bytes of each row's slice."""

    rows: int = 600
    languages: int = 200
    characters: int = 1_024


@dataclass(frozen=True)
class Network:
    languages: tuple[str, ...]
    embedding: np.ndarray  # 256 x d
    filters: tuple[np.ndarray, ...]  # for each width: width x d x f
    bias: np.ndarray  # widths x f
    weights: np.ndarray  # (widths * f) x languages
    offset: np.ndarray  # languages

    def tables(self) -> list[list[np.ndarray]]:
        """For each width, what every pair of bytes (and a single last byte) adds to the filters."""
        out = []
        for filters, bias in zip(self.filters, self.bias, strict=True):
            single = [(self.embedding @ part).astype(np.float32) for part in filters]
            steps = []
            for k in range(0, len(single) - 1, 2):
                steps.append((single[k][:, None] + single[k + 1][None]).reshape(65536, -1))
            if len(single) % 2:
                steps.append(single[-1])
            steps[0] = steps[0] + bias.astype(np.float32)
            out.append(steps)
        return out


def letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def sample(df: DataFrame, label: str, text: str, size: SampleSize, seed: int = 0) -> DataFrame:
    """At most ``size.rows`` slices of text per label, chosen and cut by the hash of the row.

    The distinct texts of each label are counted first. Then only texts whose hash lies in the share of its
    range that holds about twice the rows wanted are ranked, copies once, so that what meets in a task does not
    grow with the table.
    """
    rows = df.where(F.col(label).isNotNull() & letters(F.col(text))).select(
        F.col(label).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(F.lit(seed), F.col(text)).alias("mark")
    )
    counted = rows.groupBy("lang").agg(F.count_distinct("mark").alias("count"))
    counts = counted.orderBy(F.desc("count"), "lang").limit(size.languages).collect()
    if not counts:
        return rows.limit(0)
    parts = [F.when(F.col("lang") == r["lang"], F.lit(min(1.0, (2 * size.rows + 50) / r["count"]))) for r in counts]
    low = F.pmod("mark", F.lit(1 << 30)) / F.lit(1 << 30) <= F.coalesce(*parts)
    longest = F.greatest(F.length("text") - size.characters, F.lit(0)) + 1
    cut = F.substring(F.col("text"), (F.pmod("mark", longest) + 1).cast("int"), F.lit(size.characters))
    rows = rows.where(low).select("lang", "mark", cut.alias("text")).groupBy("lang", "mark").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("mark", "text")
    return rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= size.rows).orderBy("mark", "lang").drop("n")


def train(
    rows: list[tuple[str, str]],
    dims: int = 8,
    filters: int = 16,
    steps: int = 500,
    batch: int = 64,
    rate: float = 0.01,
    seed: int = 0,
) -> Network | None:
    """Fit the network to (language, text) pairs by Adam; None without rows."""
    if not rows:
        return None
    random = np.random.default_rng(seed)
    names = tuple(sorted({lang for lang, _ in rows}))
    by_lang = [[np.frombuffer(t.encode(), np.uint8) for lang, t in rows if lang == name] for name in names]
    p = {"e": random.normal(0, 0.3, (256, dims))}
    for w in WIDTHS:
        p[f"f{w}"] = random.normal(0, 0.5 / np.sqrt(w * dims), (w, dims, filters))
    p["b"] = np.zeros((len(WIDTHS), filters))
    p["w"] = random.normal(0, 0.1, (len(WIDTHS) * filters, len(names)))
    p["o"] = np.zeros(len(names))
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        x = np.full((batch, WINDOW), 32, np.uint8)
        y = random.integers(0, len(names), batch)
        for i, lang in enumerate(y):
            text = by_lang[lang][random.integers(0, len(by_lang[lang]))]
            # short windows too, for short texts and the ends of long ones
            length = int(min(len(text), WINDOW, random.choice((24, 64, 128, WINDOW))))
            at = random.integers(0, len(text) - length + 1)
            x[i, :length] = text[at : at + length]
        grad = _gradient(p, x, y)
        for k, g in grad.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Network(names, p["e"], tuple(p[f"f{w}"] for w in WIDTHS), p["b"], p["w"], p["o"])


def _gradient(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """The gradient of the mean cross-entropy; only the place of each largest value passes it on."""
    n = np.arange(len(x))
    e = p["e"][x]
    values, places = [], []
    for k, w in enumerate(WIDTHS):
        seen = np.lib.stride_tricks.sliding_window_view(e, w, axis=1)  # n, places, d, w
        out = np.einsum("npdw,wdf->npf", seen, p[f"f{w}"], optimize=True) + p["b"][k]
        at = out.argmax(1)
        places.append(at)
        values.append(np.take_along_axis(out, at[:, None], 1)[:, 0])
    pooled = np.concatenate(values, 1)
    active = np.maximum(pooled, 0)
    logits = active @ p["w"] + p["o"]
    delta = np.exp(logits - logits.max(1, keepdims=True))
    delta /= delta.sum(1, keepdims=True)
    delta[n, y] -= 1
    delta /= len(x)
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    grad["w"], grad["o"] = active.T @ delta, delta.sum(0)
    back = (delta @ p["w"].T) * (pooled > 0)
    for k, w in enumerate(WIDTHS):
        part = np.split(back, len(WIDTHS), 1)[k]
        grad["b"][k] = part.sum(0)
        for step in range(w):
            chosen = x[n[:, None], places[k] + step]  # n, f
            grad[f"f{w}"][step] = np.einsum("nfd,nf->df", p["e"][chosen], part)
            np.add.at(grad["e"], chosen, part[:, :, None] * p[f"f{w}"][step].T[None])
    return grad


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts cut into windows, filled up with spaces; each window's text and bytes of text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.maximum(1, -(-sizes // WINDOW))
    flat = np.full(int(counts.sum()) * WINDOW, 32, np.uint8)
    starts = (counts.cumsum() - counts) * WINDOW
    for at, text in zip(starts.tolist(), texts, strict=True):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(owner)) - np.repeat(counts.cumsum() - counts, counts)
    filled = np.minimum(WINDOW, sizes[owner] - number * WINDOW)
    return flat, owner, np.maximum(filled, 1)


def probabilities(network: Network, tables: list[list[np.ndarray]], texts: list[bytes]) -> np.ndarray:
    """For each text the weighted mean of its windows' probabilities."""
    flat, owner, filled = _windows(texts)
    out = np.zeros((len(texts), len(network.languages)))
    for begin in range(0, len(owner), BLOCK_WINDOWS):
        rows = slice(begin, begin + BLOCK_WINDOWS)
        bytes_ = flat[begin * WINDOW : (begin + BLOCK_WINDOWS) * WINDOW].reshape(-1, WINDOW)
        pairs = bytes_[:, :-1].astype(np.int32) * 256 + bytes_[:, 1:]
        pooled = []
        for width, steps in zip(WIDTHS, tables, strict=True):
            places = WINDOW - width + 1
            value = np.take(steps[0], pairs[:, :places], axis=0)
            for k, table in enumerate(steps[1:], 1):
                index = pairs if len(table) == 65536 else bytes_
                value += np.take(table, index[:, 2 * k : 2 * k + places], axis=0)
            pooled.append(value.max(1))
        active = np.maximum(np.concatenate(pooled, 1), 0).astype(np.float64)
        logits = np.einsum("nf,fl->nl", active, network.weights) + network.offset
        share = np.exp(logits - logits.max(1, keepdims=True))
        share *= (filled[rows] / share.sum(1))[:, None]
        np.add.at(out, owner[rows], share)
    return out / out.sum(1, keepdims=True)


def identify(
    df: DataFrame, network: Network | None, text: str = "text", lang: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """Add the predicted language and its probability."""
    for name in (lang, score):
        if name.lower() in map(str.lower, df.columns):
            raise ValueError(f"column {name} exists")
    if network is None:
        return df.withColumns({lang: F.lit(UNDETERMINED), score: F.lit(0.0)})
    at, words = df.columns.index(text), "_gl_letters"
    fields = [*df.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]
    tables: list = []

    def run(batches):
        tables.extend(() if tables else network.tables())
        for batch in batches:
            known = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            names, scores = np.full(batch.num_rows, UNDETERMINED, object), np.zeros(batch.num_rows)
            places = np.flatnonzero(known)
            column = batch.column(at).cast(pa.binary())
            for part in _parts(column, places):
                share = probabilities(network, tables, [column[i].as_py() for i in part])
                best = share.argmax(1)
                names[part] = np.asarray(network.languages, object)[best]
                scores[part] = share[np.arange(len(part)), best].round(9)
            added = [pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names=[f.name for f in fields])

    return df.withColumn(words, letters(F.col(text))).mapInArrow(run, T.StructType(fields))


def _parts(column: pa.Array, places: np.ndarray, most: int = 4_000_000):
    """Places in runs of about ``most`` bytes of text, whole texts each."""
    sizes = np.fromiter((len(column[i].as_buffer()) for i in places.tolist()), np.int64, len(places))
    run = sizes.cumsum() // most
    return np.split(places, np.flatnonzero(np.diff(run)) + 1) if len(places) else []


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from learning: a quarter, by the checksum of the identifier (null: of an empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def fit(df: DataFrame, label: str = "lang", text: str = "text", size: SampleSize = SampleSize()) -> Network | None:
    """Train on a bounded sample of ``df``; the caller leaves out rows that must not be learned from."""
    rows = sample(df, label, text, size).collect()
    return train([(r.lang, r.text) for r in rows])
