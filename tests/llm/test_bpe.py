import random
import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest
from helpers import docs, odd_rows
from tokenizers import Tokenizer

from gaugeloom.llm import bpe, runs

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def model():
    return bpe.WordBpe(open(PATH, encoding="utf-8").read())


def test_words_of_tokens_and_letters(library, model):
    r = random.Random(3)
    pieces = [x.removesuffix("</w>") for x in library.get_vocab()]
    texts = ["".join(r.choice(pieces) for _ in range(3)) for _ in range(3_000)]
    letters = "abAB 'sétrellΣσςİßĿ\u0085​\x1c 文字🙂👍🏽Å12½٣<>ẞ"
    texts += ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(2_000)]
    texts += ["<|endoftext|>a <|startoftext|>", "a" * 3_000, "ab" * 2_000, "'LL he'll", "\x1d", "x\x1fy z"]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert list(model.encode(text)) == want.ids, text


def test_memory_of_remembered_words():
    """Words are remembered once, with the signs on them, as bytes."""
    made = bpe.WordBpe(open(PATH, encoding="utf-8").read())
    r = random.Random(5)
    words = ["".join(r.choice("abcdehilnorst") for _ in range(12)) for _ in range(20_000)]
    made.encode(" ".join(words[:2_000]))
    made.chunks.clear()
    made.pairs.clear()
    tracemalloc.start()
    for word in words:
        for _ in made.encode(word):
            pass
    for other in (made.pairs, made.ends, made.starts):
        other.clear()
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 200 * len(words)  # it was 270


def test_lots_of_a_batch(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "LOT", 200)
    rows = odd_rows()
    found = bpe.encode(docs(spark, rows).coalesce(1), PATH).collect()
    assert len(found) == len(rows)
    assert all(r.ids == library.encode(r.text or "", add_special_tokens=False).ids for r in found)


@pytest.mark.parametrize("sizes, want", [([3, 30, 4, 4, 4, None], [1, 2, 3]), ([], [0]), ([50, 50, 1], [1, 2]), ([None, 0], [2])])
def test_lots(sizes, want):
    batch = pa.RecordBatch.from_arrays([pa.array([None if n is None else "x" * n for n in sizes], pa.string())], names=["t"])
    parts = list(runs.lots(batch, 0, 10))
    assert [p.num_rows for p in parts] == want
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))


def test_rows(spark, library):
    rows = odd_rows()
    found = bpe.decode(bpe.encode(docs(spark, rows), PATH), PATH).collect()
    assert len(found) == len(rows)
    for row in found:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == ids
        assert row.decoded == library.decode(ids, skip_special_tokens=False)


def test_empty_table_and_taken_name(spark):
    empty = docs(spark, [(1, "x")]).where("false")
    assert bpe.decode(bpe.encode(empty, PATH), PATH).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(empty, PATH, out="SIZE")
