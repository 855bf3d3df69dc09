"""Merging Burrows-Wheeler transforms of shards by iterative interleave refinement, to a bounded depth.

A shard is a list of symbol strings, each closed by a sentinel of its own. Its transform comes from one suffix sort of the
shard alone. Shards are merged without sorting suffixes again: the interleave (which shard the next row of the merged
transform comes from) that orders suffixes by their first k symbols gives the one for k + 1 by one stable partition by the
transform's symbols. Rows that the partition, or a boundary before it, sets apart differ within k + 1 symbols; so after
``depth`` rounds the boundaries left out are the common prefixes of at least ``depth``, and the blocks between boundaries are
the repeated intervals.
"""

from __future__ import annotations

import numpy as np

#: Symbol of all sentinels; strings use 1 and up.
SENTINEL = 0


class Shard:
    """The transform of some strings and, for each of its rows, the string and the offset where the suffix begins."""

    def __init__(self, strings: list[np.ndarray]):
        n = sum(len(s) + 1 for s in strings)
        text = np.zeros(n, np.int64)
        self.string, self.offset = np.empty(n, np.int64), np.empty(n, np.int64)
        at = 0
        many = len(strings)
        for k, s in enumerate(strings):
            end = at + len(s)
            text[at:end] = s.astype(np.int64) + many  # sentinels are 0, 1, ... in the order of the strings
            text[end] = k
            self.string[at : end + 1] = k
            self.offset[at : end + 1] = np.arange(len(s) + 1)
            at = end + 1
        rank = text
        step = 1
        longest = max((len(s) for s in strings), default=0)
        while True:  # prefix doubling; all suffixes differ once a sentinel is reached
            second = np.zeros(n, np.int64)
            second[: max(0, n - step)] = rank[step:] + 1
            order = np.argsort(rank * np.int64(second.max() + 1) + second, kind="stable")
            a, b = rank[order], second[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
            step *= 2
            if step > longest or rank.max() == n - 1:
                break
        symbols = np.where(text >= many, text - many, SENTINEL)
        before = np.concatenate([[SENTINEL], symbols[:-1]])
        before[self.offset == 0] = SENTINEL
        self.symbols = before[order].astype(np.uint16)
        self.string, self.offset = self.string[order], self.offset[order]
        self.strings = many


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The interleave of the shards' rows and the boundaries of the blocks that share ``depth`` symbols.

    The first rows are the sentinels, in the order of shards and strings; each is a block of its own.
    """
    symbols = np.concatenate([s.symbols for s in shards])
    ends = sum(s.strings for s in shards)
    closed = np.repeat(np.arange(len(shards)), [s.strings for s in shards])
    kind = np.uint8 if len(shards) < 256 else np.uint16
    # depth 0: one block of all rows, the sentinels first, then the other suffixes, shard after shard
    rest = np.repeat(np.arange(len(shards)), [len(s.symbols) - s.strings for s in shards])
    interleave = np.concatenate([closed, rest]).astype(kind)
    cut = np.zeros(len(interleave), bool)
    cut[0] = True
    read = np.empty(len(interleave), np.uint16)
    for _ in range(depth):
        read[np.argsort(interleave, kind="stable")] = symbols
        block = np.cumsum(cut)
        order = np.argsort(read, kind="stable")[ends:]  # rows whose symbol is a sentinel lead nowhere
        by, inside = read[order], block[order]
        interleave = np.concatenate([closed.astype(kind), interleave[order]])
        cut[: ends + 1] = True
        cut[ends + 1 :] = (by[1:] != by[:-1]) | (inside[1:] != inside[:-1])
        if cut.all():
            break
    return interleave, cut


def repeated(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes whose first ``depth`` symbols begin another suffix too: shard, string and offset of each."""
    interleave, cut = merge(shards, depth)
    block = np.cumsum(cut) - 1
    many = np.bincount(block)[block] > 1
    where = np.argsort(interleave, kind="stable")
    string = np.empty(len(interleave), np.int64)
    offset = np.empty(len(interleave), np.int64)
    string[where] = np.concatenate([s.string for s in shards])
    offset[where] = np.concatenate([s.offset for s in shards])
    return interleave[many].astype(np.int64), string[many], offset[many]
