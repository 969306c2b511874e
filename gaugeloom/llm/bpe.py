"""Byte-pair encoding and decoding with a published vocabulary of word-ending pieces.

A word is a string of symbols: one per UTF-8 byte, the last one marked as a word end. A dynamic program
over its prefixes keeps, for each prefix, the one token that ends the encoding of that prefix. An
automaton over the vocabulary (trie with suffix links) names the tokens that are suffixes of a prefix,
longest first; such a token is the last one if it is compatible with the last token of the prefix before
it, that is, if merging would never cross the border between the two. Following the stored tokens
backwards from the end gives the ids of the greedy merge order, without running merges.

Nulls count as empty texts, which have no ids. Every row is encoded by itself, so ties and repeated rows
change nothing, a very long text is encoded whole, word by word, and an empty table gives an empty result; other columns of the input stay as they are, and an output name that is taken raises.
Letters that only the newest Unicode versions know may be cut otherwise than by a library of another version.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeloom.llm.runs import lots

WORD_END = "</w>"
#: Offset between the symbol of a byte inside a word and the symbol of the same byte at its end.
END_SHIFT = 0x4000
#: Words with the signs on them, and pairs, that a Python worker remembers; they are forgotten all at once beyond that.
CACHE_ENTRIES = 250_000
#: Bytes of text whose ids are held and handed back at once (whole texts each).
LOT = 2_000_000
_MODELS: dict[str, WordBpe] = {}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabularies of byte-level pieces."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


#: Contractions, runs of letters, single digits, runs of other signs but white space.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
#: Signs at which ``str.split`` cuts although they are no white space in Unicode.
NOT_SPACE = re.compile("[\x1c-\x1f]")


class _Remembered(dict):
    """Results of a function of one string, forgotten all at once when there are too many."""

    def __init__(self, function):
        self.function = function

    def __missing__(self, key: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        found = self[key] = self.function(key)
        return found


class WordBpe:
    """The model of one tokenizer file; pieces, merges and special tokens are read from it."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        ids = {self._symbols(piece): i for piece, i in vocab.items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.halves: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for n, pair in enumerate(merges):
            left, right = (self._symbols(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            whole = ids[left + right]
            self.merged[ids[left], ids[right]] = n
            self.halves.setdefault(whole, (ids[left], ids[right]))
            self.rank.setdefault(whole, n)
        self.tokens = ahocorasick.Automaton()
        for symbols, i in ids.items():
            self.tokens.add_word(symbols, (i, len(symbols)))
        self.tokens.make_automaton()
        self.byte = byte_symbols()
        self.ends: dict[int, list[tuple[int, float]]] = {}
        self.starts: dict[int, list[tuple[int, float]]] = {}
        self.pairs: dict[int, bool] = {}
        self.sound: dict[int, bool] = {}
        self.chunks = _Remembered(self.encode_chunk)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    @staticmethod
    def _symbols(piece: str) -> str:
        if piece.endswith(WORD_END) and len(piece) > len(WORD_END):
            piece = piece.removesuffix(WORD_END)
            return piece[:-1] + chr(ord(piece[-1]) + END_SHIFT)
        return piece

    def _border(self, token: int, side: int) -> list[tuple[int, float]]:
        """The pieces at one end of a token while it is being merged, each with the merge that ends it."""
        pieces, until = [], float("inf")
        while True:
            pieces.append((token, until))
            if token not in self.halves:
                return pieces
            until = self.rank[token]
            token = self.halves[token][side]

    def _crossed(self, left: int, right: int, until: float) -> bool:
        """Whether a merge across the border comes before both sides are whole, or before ``until``."""
        ends = self.ends.get(left) or self.ends.setdefault(left, self._border(left, 1))
        starts = self.starts.get(right) or self.starts.setdefault(right, self._border(right, 0))
        for a, a_until in ends:
            for b, b_until in starts:
                n = self.merged.get((a, b))
                # of equal merges the left one goes first
                if n is not None and n < a_until and n <= b_until and n < until:
                    return True
        return False

    def compatible(self, left: int, right: int) -> bool:
        """Whether the encoding of two tokens' joined symbols is just these two."""
        key = left << 32 | right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= CACHE_ENTRIES:
                self.pairs.clear()
            found = self.pairs[key] = not self._crossed(left, right, float("inf"))
        return found

    def reachable(self, token: int) -> bool:
        """Whether the token's own symbols are encoded as the token."""
        if token not in self.sound:
            halves = self.halves.get(token)
            self.sound[token] = halves is None or (
                all(map(self.reachable, halves)) and not self._crossed(*halves, self.rank[token])
            )
        return self.sound[token]

    def encode_symbols(self, symbols: str) -> tuple[int, ...]:
        last: list[tuple[int, int] | None] = [None] * (len(symbols) + 1)
        for at, (token, length) in self.tokens.iter(symbols):
            start = at + 1 - length
            if last[at + 1] is not None or (start and last[start] is None) or not self.reachable(token):
                continue
            if not start or self.compatible(last[start][0], token):
                last[at + 1] = (token, start)
        ids, end = [], len(symbols)
        while end:
            token, end = last[end]
            ids.append(token)
        return tuple(ids[::-1])

    def encode_word(self, word: str) -> bytes:
        symbols = "".join(map(self.byte.__getitem__, word.encode()))
        return array("i", self.encode_symbols(symbols[:-1] + chr(ord(symbols[-1]) + END_SHIFT))).tobytes()

    def encode_chunk(self, chunk: str) -> bytes:
        """The ids of all words of a text in normal form, as bytes: a fraction of the memory of numbers."""
        words = WORD.findall(chunk)
        if words == [chunk]:
            return self.encode_word(chunk)
        return b"".join(map(self.chunks.__getitem__, words))

    def normalise(self, text: str) -> str:
        """Composed and in lower case, letter by letter (a final sigma is no special case)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def encode(self, text: str) -> array[int]:
        """The ids of one text; special tokens written out in it count as such."""
        ids = array("i")
        ids.frombytes(b"".join(self._encoded(text)))
        return ids

    def _encoded(self, text: str) -> Iterator[bytes]:
        parts = self.split.split(text) if self.split and "<" in text else [text]
        for part in parts:
            if part in self.special:
                yield array("i", [self.special[part]]).tobytes()
            elif part:
                part = self.normalise(part)
                if NOT_SPACE.search(part):
                    yield self.encode_chunk(part)
                else:
                    yield b"".join(map(self.chunks.__getitem__, part.split()))

    @staticmethod
    def texts_of(spec: str) -> dict[int, str]:
        """The text of each id, special tokens included."""
        spec = json.loads(spec)
        texts = {i: piece for piece, i in spec["model"]["vocab"].items()}
        return texts | {x["id"]: x["content"] for x in spec["added_tokens"]}


def model_of(spec: str) -> WordBpe:
    """The model of a tokenizer file's contents, made once in a Python process."""
    if spec not in _MODELS:
        _MODELS.clear()
        _MODELS[spec] = WordBpe(spec)
    return _MODELS[spec]


def specification(path: str) -> str:
    """The tokenizer file's contents, read on the driver."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _new_column(df: DataFrame, name: str) -> None:
    if name.lower() in map(str.lower, df.columns):
        raise ValueError(f"column {name} exists")


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``, the ids of each text, by the tokenizer file at ``path`` (read on the driver)."""
    _new_column(df, out)
    spec, at = specification(path), df.columns.index(text)

    def run(batches):
        model = model_of(spec)
        for batch in batches:
            for lot in lots(batch, at, LOT):
                ends, ids = [0], array("i")
                for value in lot.column(at):
                    ids.extend(model.encode(value.as_py() or ""))
                    ends.append(len(ids))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32)))
                yield pa.RecordBatch.from_arrays([*lot.columns, lists], names=[*lot.schema.names, out])

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``, the text of each row's ids: their tokens joined by spaces, as the vocabulary has no decoder.

    Ids that no token has are left out; null ids give an empty text. The vocabulary is one literal array.
    """
    _new_column(df, out)
    texts = WordBpe.texts_of(specification(path))
    listed = F.split(F.lit("\n".join(texts.get(i, "") for i in range(max(texts) + 1))), "\n", -1)
    found = F.transform(F.col(ids), lambda i: F.nullif(F.get(listed, i), F.lit("")))
    return df.withColumn(out, F.coalesce(F.array_join(found, " "), F.lit("")))
