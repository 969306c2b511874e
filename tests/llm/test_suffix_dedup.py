import random
import tracemalloc

import numpy as np
import pytest
from helpers import docs, odd_rows, prose

from gaugeloom.llm import bwt_merge, suffix_dedup


def brute_force(rows, length):
    bodies = [(t or "").encode() for _, t in rows]
    seen = {}
    for b in bodies:
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]] = seen.get(b[p : p + length], 0) + 1
    out = []
    for (doc_id, _), b in zip(rows, bodies, strict=True):
        gone = np.zeros(len(b) + 1, np.int64)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p] += 1
                gone[p + length] -= 1
        gone = gone.cumsum()[:-1] > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]))).reshape(-1, 2).tolist()
        out.append((doc_id, len(b), edges, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=str)


def found(spark, rows, **more):
    df = suffix_dedup.without_repeats(docs(spark, rows), **more)
    return sorted(((r.doc_id, r.n_bytes, [[x.s, x.e] for x in r.spans], bytes(r.kept)) for r in df.collect()), key=str)


def case(seed):
    r = random.Random(seed)
    shared = [prose(seed * 100 + k, r.choice([60, 80, 120, 300])) for k in range(5)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.randint(1, 4)):
            s = r.choice(shared)
            a = r.randint(0, 60)
            parts += [prose(r.randrange(10**6), r.randint(0, 60)), s[a : len(s) - r.randint(0, 60)]]
        rows.append((i, "é".join(parts)))
    return rows + [(100, rows[0][1]), (101, rows[1][1]), (101, rows[1][1])]


@pytest.mark.parametrize("hot", [10_000, 3, 0])
def test_against_brute_force(spark, hot):
    rows = case(hot) + [r for r in odd_rows() if len(r[1] or "") < 50_000] + [(300, "ab" * 400), (301, "x" * 700)]
    assert found(spark, rows, hot=hot) == brute_force(rows, 400)


def test_slices_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 1_000)
    monkeypatch.setattr(suffix_dedup, "LOT", 3_000)
    monkeypatch.setattr(suffix_dedup, "RETURNED", 2_000)
    rows = case(7) + [(200, prose(1, 3_000)), (201, prose(2, 900) + prose(1, 3_000)[4_000:9_000])]
    assert found(spark, rows) == brute_force(rows, 400)


def test_empty(spark):
    assert found(spark, [(1, None), (2, "")]) == [(1, 0, [], b""), (2, 0, [], b"")]
    assert suffix_dedup.without_repeats(docs(spark, [(1, "x")]).where("false")).count() == 0


@pytest.mark.parametrize("shards", [1, 2, 5])
@pytest.mark.parametrize("seed", range(4))
def test_merge_against_windows(seed, shards):
    r = random.Random(seed)
    texts = ["".join(r.choice("ab") for _ in range(r.randint(0, 40))).encode() for _ in range(30)]
    texts += ["".join(r.choice("abcdef") for _ in range(300)).encode(), b"ab" * 30]
    weights = np.array([2 if k % 11 == 0 else 1 for k in range(len(texts))])
    length, symbol = 12, 3
    seen = {}
    for t, w in zip(texts, weights.tolist(), strict=True):
        for p in range(len(t) - length + 1):
            seen[t[p : p + length]] = seen.get(t[p : p + length], 0) + w
    got = bwt_merge.repeated_windows(texts, weights, length, symbol, shards)
    for t, flags in zip(texts, got, strict=True):
        assert flags.tolist() == [seen[t[p : p + length]] > 1 for p in range(max(len(t) - length + 1, 0))]


def test_memory_of_near_copies():
    """A lot of near copies of a few texts takes a bounded multiple of its bytes; it took 116 times as much once."""
    r = random.Random(2)
    base = [bytes(r.randrange(97, 123) for _ in range(700)) for _ in range(40)]
    texts = [b[:at] + b"0" + b[at + 1 :] for b in base for at in r.sample(range(700), 40)]
    tracemalloc.start()
    found = bwt_merge.repeated_windows(texts, np.ones(len(texts), np.int64), 400, 100)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 85 * sum(map(len, texts))
    seen = {}
    for t in texts:
        for p in range(301):
            seen[t[p : p + 400]] = seen.get(t[p : p + 400], 0) + 1
    assert all(flags.tolist() == [seen[t[p : p + 400]] > 1 for p in range(301)] for t, flags in zip(texts, found, strict=True))


def test_symbols_in_pieces(monkeypatch):
    data = np.frombuffer(prose(4, 200).encode(), np.uint8)
    whole = bwt_merge._symbols(data, 30)
    monkeypatch.setattr(bwt_merge, "PIECE", 7)
    assert (bwt_merge._symbols(data, 30) == whole).all()
    assert len(whole) == len(data) - 29 and not len(bwt_merge._symbols(data[:29], 30))


def test_interleave_orders_all_suffixes():
    r = random.Random(1)
    words = [[r.randint(1, 3) for _ in range(r.randint(1, 9))] for _ in range(20)]
    shards, suffixes = [], []
    for part in (words[:7], words[7:12], words[12:]):
        symbol, after, own = [], [], []
        for w in part:
            for k in range(len(w)):
                after.append(len(symbol) + 1 if k + 1 < len(w) else -1)
                symbol.append(w[k])
                own.append(tuple(w[k:]))
        shards.append(bwt_merge.Shard(np.array(symbol), np.array(after)))
        suffixes.append(own)
    mark, _ = bwt_merge.interleave(shards, 12)
    merged, at = [], [0, 0, 0]
    for k in mark.tolist():
        place = shards[k].order[at[k]]
        at[k] += 1
        if place < shards[k].places:
            merged.append(suffixes[k][place])
    assert merged == sorted(merged)
