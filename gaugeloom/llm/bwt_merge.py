"""Burrows-Wheeler transforms of shards, merged by iterative interleave refinement.

The texts are byte strings; a symbol is the run of ``symbol`` bytes from a place, so every place is the
start of a symbol and its suffix goes on ``symbol`` bytes later. A shard's transform lists, in the order
of its suffixes, the symbol before each. Merging starts with the shards one after another. Each round
sorts the shards' marks stably by the transforms' next symbols: after h rounds the marks show the order of
all suffixes by their first h symbols, although suffixes of different shards are never compared or sorted
again. Where neighbours differ for the first time gives their common prefix, in symbols; neighbours with
a common prefix of the wanted length form a repeated interval.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Places whose symbols are hashed at once.
PIECE = 1_000_000


def _symbols(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place (the last places have none), piece by piece."""
    out = np.empty(max(len(data) - size + 1, 0), np.uint64)
    for at in range(0, len(out), PIECE):
        out[at : at + PIECE] = _hashed(data[at : at + PIECE + size - 1], size)
    return out


def _hashed(data: np.ndarray, size: int) -> np.ndarray:
    inverse = np.uint64(pow(int(_BASE), -1, 2**64))
    powers = np.full(len(data) + 1, _BASE)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    back = np.full(len(data) - size + 1, inverse)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    found = (sums[size:] - sums[:-size]) * back
    found ^= found >> np.uint64(32)
    found *= np.uint64(0xFF51AFD7ED558CCD)
    return found ^ (found >> np.uint64(29))


class Shard:
    """Suffixes of a shard's threads in order, and the symbol before each (0: none)."""

    def __init__(self, symbol: np.ndarray, after: np.ndarray):
        """``symbol`` (from 1) of each place; ``after``: the place its suffix goes on at, -1 at an end."""
        places = len(symbol)
        ends = np.flatnonzero(after < 0)
        last = np.arange(places, places + len(ends), dtype=np.int32)
        follow = np.concatenate([after.astype(np.int32), last])
        follow[ends] = last
        name = np.concatenate([symbol, np.zeros(len(ends), symbol.dtype)])
        rank = np.zeros(len(name), np.int32)
        rank[places:] = np.arange(len(ends))
        while True:
            # ends are told apart by their number, so in the end all ranks differ
            order = np.lexsort((rank[follow], name))
            new = np.empty(len(name), np.int32)
            change = np.ones(len(name), bool)
            a, b = order[:-1], order[1:]
            change[1:] = (name[a] != name[b]) | (rank[follow[a]] != rank[follow[b]])
            new[order] = change.cumsum() - 1
            if (new == rank).all():
                break
            rank = new
        before = np.zeros(len(name), symbol.dtype)
        before[follow[:places]] = symbol
        self.order = order
        self.places = places
        self.transform = before[order]


def interleave(shards: list[Shard], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard of each merged suffix, and the number of its interval of equal first ``rounds`` symbols."""
    mark = np.repeat(np.arange(len(shards), dtype=np.int32), [len(s.order) for s in shards])
    interval = np.zeros(len(mark), np.int32)
    before = np.empty(len(mark), shards[0].transform.dtype)
    for _ in range(rounds):
        for k, shard in enumerate(shards):
            before[mark == k] = shard.transform
        order = np.argsort(before, kind="stable")
        mark, name, old = mark[order], before[order], interval[order]
        change = np.zeros(len(mark), bool)
        change[1:] = (name[1:] != name[:-1]) | (old[1:] != old[:-1])
        interval = change.cumsum(dtype=np.int32)
    return mark, interval


def repeated_windows(
    texts: list[bytes], weights: np.ndarray, length: int, symbol: int, shards: int = 4
) -> list[np.ndarray]:
    """For each text, whether the ``length`` bytes from each place occur twice at least, weights counted.

    ``symbol`` divides ``length``; a text of weight 2 stands for two equal texts.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = sizes.cumsum() - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    windows = np.maximum(sizes - length + 1, 0)
    out = np.zeros(len(data), bool)
    rounds = length // symbol
    hashes = _symbols(data, symbol)
    # places are counted in 32 bits: half the memory, and a lot holds far fewer
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    window = np.arange(len(data), dtype=np.int32) < (starts + windows).astype(np.int32)[owner]
    if window.any():
        # a window whose symbols are not all repeated cannot be; its suffixes stay out of the transforms
        used = np.zeros(len(data), bool)
        for k in range(rounds):
            used[np.flatnonzero(window) + k * symbol] = True
        at = np.flatnonzero(used)
        _, name, often = np.unique(hashes[at], return_inverse=True, return_counts=True)
        several = np.zeros(len(data), bool)
        several[at] = often[name] > 1
        heavy = weights[owner] > 1
        for k in range(rounds):
            at_ = np.flatnonzero(window)
            window[at_] &= several[at_ + k * symbol] | heavy[at_]
        used[:] = False
        for k in range(rounds):
            used[np.flatnonzero(window) + k * symbol] = True
        keep = used[at]
        at = at[keep]
        names = np.zeros(len(data), np.int32)
        names[at] = name[keep] + 1
        del hashes, name, often, used, several, heavy, keep
        parts, where = [], []
        lot = np.minimum(starts * shards // max(len(data), 1), shards - 1)
        for k in range(shards):
            mine = at[lot[owner[at]] == k]
            if not len(mine):
                continue
            index = np.full(len(data) + symbol, -1, np.int32)
            index[mine] = np.arange(len(mine))
            after = index[mine + symbol]
            same = owner[np.minimum(mine + symbol, len(data) - 1)] == owner[mine]
            parts.append(Shard(names[mine], np.where(same, after, -1)))
            where.append(mine)
        if parts:
            mark, interval = interleave(parts, rounds)
            number = np.full(len(data), -1, np.int32)
            for k, (shard, mine) in enumerate(zip(parts, where, strict=True)):
                found = interval[mark == k]
                real = shard.order < shard.places
                number[mine[shard.order[real]]] = found[real]
            at = np.flatnonzero(window)
            total = np.bincount(number[at], weights=weights[owner[at]])
            out[at] = total[number[at]] > 1
    return [out[a : a + n] for a, n in zip(starts.tolist(), windows.tolist(), strict=True)]
