"""Word n-grams of texts as 64-bit hashes, computed with numpy over the bytes of an Arrow column.

Words are maximal runs of bytes other than ASCII white space. A text of fewer than n words, but one at
least, has one n-gram: all its words. Null and empty texts have none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text hashed at once; a longer text is hashed whole.
CHUNK = 2_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts that lie one after another, and each text's first word (one more)."""
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    borders = offsets[:-1][offsets[:-1] < len(data)]
    begins[borders] = inside[borders]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    begin_of = np.zeros(len(data), np.int64)
    begin_of[starts] = starts
    place = np.arange(len(data)) - np.maximum.accumulate(begin_of)
    place[~inside] = 0
    value = (data.astype(np.uint64) + np.uint64(1)) * _powers(int(place.max()) + 1)[place]
    value[~inside] = 0
    return mixed(np.add.reduceat(value, starts)), first


def _ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place; the last n - 1 places hold nothing of use."""
    out = np.zeros(len(words), np.uint64)
    for k, factor in enumerate(_powers(n + 1)[1:].tolist()):
        out[: len(words) - k] += words[k:] * np.uint64(factor)
    return mixed(out)


def shingle_sets(texts: pa.Array, n: int = 5) -> Iterator[np.ndarray]:
    """For each text its distinct n-grams as sorted uint64."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    known = texts.is_valid().to_numpy(zero_copy_only=False)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + CHUNK, "right")) - 1)
        end = min(end, len(texts))
        low, high = int(offsets[begin]), int(offsets[end])
        words, first = word_hashes(data[low:high], offsets[begin : end + 1] - low)
        grams = _ngrams(words, n)
        for i in range(end - begin):
            a, b = int(first[i]), int(first[i + 1])
            if a == b or not known[begin + i]:
                yield np.zeros(0, np.uint64)
            elif b - a < n:
                yield mixed((words[a:b] * _powers(b - a + 1)[1:]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
            else:
                yield np.unique(grams[a : b - n + 1])
        begin = end
