"""What each input adds to a score of boosted trees: exact Shapley values along the paths of the trees.

Inputs that are not known are averaged over by the rows that the trees were fitted on. On the path to one leaf the split inputs are
few, and a row either takes all splits of an input as the path does or it does not. So the values of a leaf depend on one bit for
each input of its path: they are worked out once for all bit patterns, and a batch of rows is a lookup for each leaf.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np


@dataclass
class Split:
    """Rows go left if ``slot`` is at most ``threshold``, or, if ``left`` is given, one of those levels."""

    slot: int
    threshold: float = 0.0
    left: tuple[float, ...] | None = None

    def goes_left(self, rows: np.ndarray) -> np.ndarray:
        x = rows[:, self.slot]
        return x <= self.threshold if self.left is None else np.isin(x, self.left)


@dataclass
class Node:
    """``cover``: the weight of the fitted rows that came here. A leaf has no split."""

    cover: float
    value: float = 0.0
    split: Split | None = None
    left: Node | None = None
    right: Node | None = None

    def document(self) -> dict:
        out = {"cover": self.cover, "value": self.value}
        if self.split is not None:
            out |= {"split": [self.split.slot, self.split.threshold, self.split.left], "left": self.left.document(), "right": self.right.document()}
        return out

    @staticmethod
    def of(document: dict) -> Node:
        out = Node(document["cover"], document["value"])
        if "split" in document:
            slot, threshold, left = document["split"]
            out.split = Split(slot, threshold, None if left is None else tuple(left))
            out.left, out.right = Node.of(document["left"]), Node.of(document["right"])
        return out


def nodes_of(model) -> Node:
    """The nodes of a fitted tree of ``pyspark.ml``."""

    def read(n) -> Node:
        out = Node(n.impurityStats().count(), n.prediction())
        if n.getClass().getSimpleName() == "InternalNode":
            s = n.split()
            left = tuple(s.leftCategories()) if s.getClass().getSimpleName() == "CategoricalSplit" else None
            out.split = Split(s.featureIndex(), 0.0 if left is not None else s.threshold(), left)
            out.left, out.right = read(n.leftChild()), read(n.rightChild())
        return out

    return read(model._java_obj.rootNode())


@dataclass
class Leaf:
    value: float
    players: list[int]
    #: For each player of the path the splits on it and whether the path goes left there.
    turns: list[list[tuple[Split, bool]]]
    table: np.ndarray = field(repr=False)
    expected: float


def _table(value: float, shares: list[float]) -> np.ndarray:
    """Shapley values of a leaf's players for each pattern of players that take its path.

    A set of known players is worth ``value`` if they all take the path, times the shares of the others.
    """
    d = len(shares)
    size = [math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)]
    out = np.zeros((1 << d, d))
    for pattern in range(1 << d):
        takes = [pattern >> j & 1 for j in range(d)]
        for i in range(d):
            known = np.ones(1)  # of the others, summed over sets by their size
            for j in range(d):
                if j != i:
                    known = np.convolve(known, [shares[j], takes[j]])
            out[pattern, i] = value * (takes[i] - shares[i]) * (known * size).sum()
    return out


class Explainer:
    """Contributions of players (inputs, each of one or more slots of the rows) to a weighted sum of trees, and its mean."""

    def __init__(self, trees: list[Node], weights: list[float], owners: list[int]):
        """``owners``: the player of each slot."""
        self.players = max(owners, default=-1) + 1
        self.leaves: list[Leaf] = []
        for tree, weight in zip(trees, weights):
            self._walk(tree, weight, owners, {})
        self.base = sum(leaf.expected for leaf in self.leaves)

    def _walk(self, node: Node, weight: float, owners: list[int], path: dict) -> None:
        if node.split is None:
            shares = [share for share, _ in path.values()]
            value = weight * node.value
            self.leaves.append(Leaf(value, list(path), [turns for _, turns in path.values()], _table(value, shares), value * math.prod(shares)))
            return
        player = owners[node.split.slot]
        for child, left in ((node.left, True), (node.right, False)):
            share, turns = path.get(player, (1.0, []))
            part = child.cover / node.cover if node.cover else 0.5
            self._walk(child, weight, owners, path | {player: (share * part, [*turns, (node.split, left)])})

    def contributions(self, rows: np.ndarray) -> np.ndarray:
        """(rows, players): with ``base``, each row sums to its score."""
        out = np.zeros((len(rows), self.players))
        for leaf in self.leaves:
            if leaf.players:
                pattern = np.zeros(len(rows), np.int64)
                for j, turns in enumerate(leaf.turns):
                    takes = np.ones(len(rows), bool)
                    for split, left in turns:
                        takes &= split.goes_left(rows) == left
                    pattern |= takes.astype(np.int64) << j
                out[:, leaf.players] += leaf.table[pattern]
        return out


def predicted(node: Node, rows: np.ndarray) -> np.ndarray:
    """The value of the leaf that each row reaches."""
    out = np.empty(len(rows))
    todo = [(node, np.arange(len(rows)))]
    while todo:
        n, at = todo.pop()
        if n.split is None:
            out[at] = n.value
        elif len(at):
            left = n.split.goes_left(rows[at])
            todo += [(n.left, at[left]), (n.right, at[~left])]
    return out
