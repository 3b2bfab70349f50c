"""Forests of bagged classification trees over binned features, grown level by level.

Everything random follows from hashes: how often a row is in a tree's bag from its key, the features that a
node may use from the node's place. So a tree does not depend on partitions or cores, the first trees of a
forest are a smaller forest, and a tree cut at a level is the tree of that depth. Split statistics are counts
of bagged rows per class and bin, whole numbers that add up exactly in any order; class weights come in
afterwards.

Trees grow in one of two ways with equal results. `grow_trees` has a task grow whole trees on rows that are
broadcast, which must be few enough for that. `grow_over_partitions` leaves the rows where they are, packed in
blocks: each level is one pass over them, whose tasks emit the counts of their rows, and the counts are summed by
a shuffle. Both count all slots of the smaller child of each split where they can.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructField, StructType

from campaignlake.operators.scan import quantiles, ranked_histogram
from campaignlake.session import BROADCAST_BYTES, materialize, scratch_path

# Workers get this module by value, so it need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
# Odd multipliers of the hash, below 2**63.
_MIX = (0x1E3779B97F4A7C15, 0x3F58476D1CE4E5B9)
_ROW, _TREE, _NODE = 0x2545F4914F6CDD1D, 0x5851F42D4C957F2D, 0x14057B7EF767814F
# Probabilities are summed as whole numbers of this unit, so sums do not depend on their order.
UNIT = 1 << 40
# Rows of a packed block, which a task counts at a time: few enough for a core's cache.
COUNT_ROWS = 1 << 15
# Trees that a pass over packed rows grows, and how many such passes run side by side.
PASS_TREES, PASSES = 20, 2
# Bytes of counts of all slots that the trees of a pass keep on the driver; one beyond its share counts drawn slots.
SUM_BYTES = 192 << 20
# A tree on broadcast rows counts all slots while their groups are at most so many times the slots drawn for a node.
MOST_GROUPS = 4
# Combinations of two-bin slots that are counted as one value, and cuts that are compared at a time.
GROUP_VALUES, BLOCK_CUTS = 64, 1 << 14


def looked_up(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """`table[at]` for places that are all in the table: numpy is faster when it need not raise."""
    return table.take(at, mode="clip")


def hashed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers."""
    x = x.astype(np.uint64) * np.uint64(_MIX[0])
    x ^= x >> np.uint64(29)
    x *= np.uint64(_MIX[1])
    x ^= x >> np.uint64(32)
    return x


def poisson_cuts(rate: float) -> list[int]:
    """Steps of the Poisson distribution, as numbers below 2**53: a draw's value is how many it reaches."""
    cuts, term, total, k = [], math.exp(-rate), 0.0, 0
    while total + term < 1 and len(cuts) < 24:
        total += term
        cuts.append(int(total * 2**53))
        k += 1
        term *= rate / k
    return cuts


def bag(rows: np.ndarray, tree: int, rate: float, seed: int) -> np.ndarray:
    """How often each row, given by its key, is in the bag of a tree: a Poisson count of mean `rate`."""
    return reached(draws(hashed(rows.view(np.uint64)), tree, seed), poisson_cuts(rate))


def draws(hashes: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Draws below 2**53 of a tree for rows given by the hashes of their keys, which serve all trees."""
    mask = 2**64 - 1
    salt = np.uint64(((seed * _ROW) ^ (tree * _TREE)) & mask)
    draw = hashed(hashes ^ salt)
    draw >>= np.uint64(11)
    return draw


def reached(draw: np.ndarray, cuts: Sequence[int]) -> np.ndarray:
    """How many of the rising `cuts` each draw reaches."""
    # Few draws reach a fourth step, so each further one looks at those only that reached the one before.
    times = np.zeros(len(draw), dtype=np.int64)
    for cut in cuts[:3]:
        times += draw >= np.uint64(cut)
    at = np.flatnonzero(times == 3)
    for cut in cuts[3:]:
        at = at[draw[at] >= np.uint64(cut)]
        if not len(at):
            break
        times[at] += 1
    return times


@dataclass(frozen=True)
class TreeParams:
    """Settings of a forest; `class_weight` is None, `balanced` or `balanced_subsample`."""

    max_depth: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    max_features: str | float = "sqrt"
    max_samples: float | None = None
    class_weight: str | None = None

    def features(self, n: int) -> int:
        share = {"sqrt": math.sqrt(n), "log2": math.log2(max(n, 2))}
        most = share[self.max_features] if isinstance(self.max_features, str) else self.max_features * n
        return max(1, int(most))


@dataclass
class Tree:
    """Nodes in level order: split feature (-1: leaf), last bin that goes left, left child, P(class 1)."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray
    level: np.ndarray

    def reach(self, bins: np.ndarray, deepest: int | None = None) -> np.ndarray:
        """P(class 1) of rows, in the tree cut at level `deepest`."""
        leaf = self.feature < 0 if deepest is None else (self.feature < 0) | (self.level >= deepest)
        # A row stays at a leaf; rows there are set aside now and then only.
        feature, cut = np.where(leaf, 0, self.feature), np.where(leaf, 255, self.cut).astype(np.uint8)
        child = np.where(leaf, np.arange(len(leaf)), self.child)
        flat, node, rows = bins.reshape(-1), np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
        at, first = node.copy(), rows * bins.shape[1]
        while len(rows):
            for _ in range(4):
                at = looked_up(child, at) + (looked_up(flat, first + looked_up(feature, at)) > looked_up(cut, at))
            inner = np.flatnonzero(~looked_up(leaf, at))
            if len(inner) < len(rows):
                node[rows] = at
                rows, at, first = (looked_up(x, inner) for x in (rows, at, first))
        return self.value[node]


def packed_nodes(feature: np.ndarray, cut: np.ndarray, child: np.ndarray) -> np.ndarray:
    """One number per node: left child, cut and feature. A leaf, of feature -1, is its own child."""
    leaf = feature < 0
    child, cut = np.where(leaf, np.arange(len(leaf)), child), np.where(leaf, 255, cut)
    return child << 40 | cut << 32 | np.where(leaf, 0, feature)


def walked(nodes: np.ndarray, bins: np.ndarray, held: np.ndarray, levels: int) -> np.ndarray:
    """The node that each of the rows `held` has come to from the root of a tree, after `levels` levels."""
    flat, node, rows = bins.reshape(-1), np.zeros(len(held), dtype=np.int64), np.arange(len(held))
    leaf = nodes >> 40 == np.arange(len(nodes))
    at, first = node.copy(), held * bins.shape[1]
    for level in range(1, levels + 1):
        of = looked_up(nodes, at)
        right = looked_up(flat, first + (of & 0xFFFFFFFF)) > (of >> 32 & 255).astype(np.uint8)
        at = of >> 40
        at += right
        # Rows at leaves are set aside now and then only.
        if level % 4 == 0 or level == levels:
            node[rows] = at
            inner = np.flatnonzero(~looked_up(leaf, at))
            if len(inner) < len(rows):
                rows, at, first = (looked_up(x, inner) for x in (rows, at, first))
    return node


# A row's draws stand in the low bits for class 0, above them for class 1, so one sum counts both exactly.
_CLASS_BITS = 26


def coded(label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return np.where(label == 1, weight << _CLASS_BITS, weight).astype(float)


class Growth:
    """A tree that is being grown: all nodes so far, and those that may still split.

    Nodes whose counts rule a split out, known from their parent's, are never open.
    """

    def __init__(self, number: int, widths: np.ndarray, params: TreeParams, seed: int, weights: tuple[float, float] | None):
        self.number, self.widths, self.params, self.seed = number, widths, params, seed
        # Class weights; those of the subsample follow from the root's counts.
        self.weights = weights
        self.level_now = 0
        self.feature, self.cut = np.full(1, -1), np.zeros(1, dtype=np.int64)
        self.child, self.value, self.level = np.full(1, -1), np.zeros(1), np.zeros(1, dtype=np.int64)
        self.open, self.paths, self.whole = np.zeros(1, dtype=np.int64), np.ones(1, dtype=np.uint64), None
        self._lay_out()

    def _lay_out(self) -> None:
        """Features that each open node may use, and where the counts of each of their bins stand."""
        n, k = len(self.widths), self.params.features(len(self.widths))
        salt = np.uint64((self.seed * _ROW + (self.number + 1) * _TREE) & (2**64 - 1))
        draws = hashed((hashed(self.paths ^ salt)[:, None] ^ (np.arange(n, dtype=np.uint64) * np.uint64(_NODE))[None, :]))
        self.features = np.sort(np.argpartition(draws, k - 1, axis=1)[:, :k], axis=1)
        self.width = self.widths[self.features]
        ends = np.cumsum(self.width.reshape(-1))
        self.total = int(ends[-1])
        self.starts = (ends - self.width.reshape(-1)).reshape(self.features.shape)
        # Number among the open nodes, by node.
        self.place = np.full(len(self.feature), -1)
        self.place[self.open] = np.arange(len(self.open))

    def counts(self, bins: np.ndarray, code: np.ndarray, node: np.ndarray) -> np.ndarray:
        """(3, bins of all open nodes): rows, their draws of class 0 and of class 1. `node` numbers open nodes."""
        at = np.arange(0, bins.size, bins.shape[1])[:, None] + self.features[node]
        at = (self.starts[node] + bins.reshape(-1)[at]).reshape(-1)
        both = np.bincount(at, weights=np.repeat(code, self.features.shape[1]), minlength=self.total).astype(np.int64)
        rows = np.bincount(at, minlength=self.total)
        return np.stack([rows, both & ((1 << _CLASS_BITS) - 1), both >> _CLASS_BITS])

    def split(self, counts: np.ndarray) -> None:
        """`divide` by the counts that `counts` gives."""
        first = self.starts[:, 0]
        running = np.concatenate([np.zeros((3, 1), dtype=np.int64), np.cumsum(counts, axis=1)], axis=1)
        if self.whole is None:
            self.whole = running[:, self.width[:, 0]] - running[:, first]
        left = running[:, 1:] - np.repeat(running[:, self.starts.reshape(-1)], self.width.reshape(-1), axis=1)
        cuts = np.ones(self.total, dtype=bool)
        cuts[(self.starts + self.width - 1)[self.width > 1]] = False
        self.divide(*self.best(left[:, cuts]))

    def split_by(self, left) -> tuple[np.ndarray, np.ndarray]:
        """`divide` by the counts `left(a, b)` of what each cut sends to the left, some open nodes at a time.

        Gives the open nodes that were split and the counts of their children.
        """
        per_node = self.params.features(len(self.widths)) * -(-all_cuts(self.widths)[0] // len(self.widths))
        step = max(1, BLOCK_CUTS // per_node)
        found = [self.best(left(a, a + step), a, a + step) for a in range(0, len(self.open), step)]
        own, slot, cut, goes = (np.concatenate(x, axis=-1) for x in zip(*found))
        return own, self.divide(own, slot, cut, goes)

    def cut_layout(self, a: int = 0, b: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Cuts of each drawn slot of open nodes `a` to `b`, and where they stand. The last bin of a slot divides nothing."""
        cuts = slot_cuts(self.widths)[self.features[a:b]]
        return cuts, (np.cumsum(cuts.reshape(-1)) - cuts.reshape(-1)).reshape(cuts.shape)

    def best(self, left: np.ndarray, a: int = 0, b: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(open nodes to split, drawn slots, last bins that go left, (3, nodes) what goes left) of open nodes `a` to `b`.

        `left` counts, as (3, cuts of these nodes), what each cut sends to the left.
        """
        whole, p = self.whole[:, a:b], self.params
        cuts, starts = self.cut_layout(a, b)
        first, spans = starts[:, 0], cuts.sum(axis=1)
        if self.weights is None:
            totals = whole[1:, 0].astype(float)
            self.weights = tuple(float(totals.sum() / (2 * t)) if t else 1.0 for t in totals)
        scale = np.array(self.weights)[:, None]

        def purity(zero, one):
            zero, one = zero * scale[0], one * scale[1]
            return (zero * zero + one * one) / np.maximum(zero + one, 1e-300)

        right = np.repeat(whole, spans, axis=1) - left
        least = max(1, p.min_samples_leaf)
        gain = purity(left[1], left[2]) + purity(right[1], right[2])
        gain[(left[0] < least) | (right[0] < least)] = -1.0
        best = np.maximum.reduceat(gain, first)
        at = np.flatnonzero(gain == np.repeat(best, spans))
        at = at[np.searchsorted(at, first)]
        goes = (best > purity(whole[1], whole[2]) * (1 + 1e-12)) & self._may_split(whole, self.level_now)
        at, own = at[goes], np.flatnonzero(goes)
        slot = (starts[own] <= at[:, None]).sum(axis=1) - 1
        return own + a, slot, at - starts[own, slot], left[:, at]

    def divide(self, own: np.ndarray, slot: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Split open nodes as `best` says and open the children that may split; gives the children's counts."""
        scale = np.array(self.weights)[:, None]

        def chance(of):
            weighted = of[1:] * scale
            return weighted[1] / np.maximum(weighted.sum(axis=0), 1e-300)

        if self.level_now == 0:
            self.value[:] = chance(self.whole)
        ids, size = self.open[own], len(self.feature)
        self.feature[ids], self.cut[ids] = self.features[own, slot], cut
        self.child[ids] = size + 2 * np.arange(len(ids))
        sides = np.stack([left, self.whole[:, own] - left], axis=2).reshape(3, -1)
        paths = np.stack([self.paths[own] * np.uint64(2), self.paths[own] * np.uint64(2) + np.uint64(1)], axis=1).reshape(-1)
        self.level_now += 1
        # A path grows by a bit each level; mixing keeps places apart beyond 64 levels.
        if self.level_now % 30 == 0:
            paths = hashed(paths)
        more = sides.shape[1]
        for name, x in (("feature", np.full(more, -1)), ("cut", np.zeros(more, dtype=np.int64)), ("child", np.full(more, -1)),
                        ("value", chance(sides)), ("level", np.full(more, self.level_now))):
            setattr(self, name, np.concatenate([getattr(self, name), x]))
        may = self._may_split(sides, self.level_now)
        self.open, self.paths, self.whole = size + np.flatnonzero(may), paths[may], sides[:, may]
        if len(self.open):
            self._lay_out()
        return sides

    def _may_split(self, counts: np.ndarray, level: int) -> np.ndarray:
        p = self.params
        may = (counts[0] >= max(2, p.min_samples_split, 2 * p.min_samples_leaf)) & (counts[1] > 0) & (counts[2] > 0)
        return may if p.max_depth is None or level < p.max_depth else np.zeros_like(may)

    def standing(self, bins: np.ndarray, held: np.ndarray) -> np.ndarray:
        """The node that each of the rows `held` has come to."""
        return walked(packed_nodes(self.feature, self.cut, self.child), bins, held, self.level_now)

    def tree(self) -> Tree:
        return Tree(self.feature, self.cut, self.child, self.value, self.level)


def slot_cuts(widths: np.ndarray) -> np.ndarray:
    """Cuts of each slot; one that divides nothing where a slot has a single bin."""
    return np.maximum(widths - 1, 1)


def slot_groups(bins: np.ndarray, widths: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray | None]]:
    """(first slot, value per row, left) of slots whose bins one small number per row tells.

    A slot of more than two bins stands alone, with its bin as the value and no `left`. Neighbours of two bins stand
    together while their rows show at most GROUP_VALUES combinations, as the slots of one category do: the value
    numbers these, and `left` (values, slots) has 1 where a slot is in bin 0.
    """
    groups: list[tuple[int, np.ndarray, np.ndarray | None]] = []
    for slot, width in enumerate(widths):
        column = np.ascontiguousarray(bins[:, slot])
        if width > 2:
            groups.append((slot, column, None))
            continue
        joins = bool(groups) and groups[-1][2] is not None
        if joins:
            first, value, left = groups[-1]
            both = value.astype(np.int64) * 2 + column
            shown = np.flatnonzero(np.bincount(both))
            joins = len(shown) <= GROUP_VALUES
        if joins:
            number = np.zeros(2 * len(left), dtype=np.uint8)
            number[shown] = np.arange(len(shown))
            groups[-1] = first, number[both], np.column_stack([left[shown // 2], 1.0 - shown % 2])
        else:
            groups.append((slot, column, np.array([[1.0], [0.0]])))
    return groups


class Sums:
    """Counts that all cuts of all slots send to the left, by node, as sums over a tree's bag.

    Rows, draws of class 0 and draws of class 1 share a number wherever their sums stay exact in it.
    """

    def __init__(self, groups: Sequence[tuple], widths: np.ndarray, label: np.ndarray, weight: np.ndarray):
        self.groups, self.widths = groups, widths
        self.size, self.starts = all_cuts(widths)
        one = label == 1
        ones = int(weight[one].sum())
        self.whole = np.array([[np.count_nonzero(weight)], [int(weight.sum()) - ones], [ones]])
        self.low, self.middle, high = (int(x).bit_length() for x in self.whole[:, 0])
        if self.low + self.middle + high <= 53:
            codes = [1 + (weight << np.where(one, self.low + self.middle, self.low))]
        else:
            codes = [np.ones(len(weight)), weight << np.where(one, self.middle, 0)]
        self.codes = [x.astype(float) for x in codes]

    def of(self, rows: np.ndarray, node: np.ndarray, nodes: int) -> np.ndarray:
        """(numbers, nodes, cuts of all slots) of rows of the bag at `nodes` nodes."""
        return self.coded_of([looked_up(x, rows) for x in self.codes], rows, node, nodes)

    def coded_of(self, weights: Sequence[np.ndarray], rows: np.ndarray, node: np.ndarray, nodes: int) -> np.ndarray:
        out = np.empty((len(weights), nodes, self.size))
        for first, value, left in self.groups:
            bins = int(self.widths[first]) if left is None else len(left)
            at = node * bins
            at += looked_up(value, rows)
            for into, weight in zip(out, weights):
                found = np.bincount(at, weights=weight, minlength=nodes * bins).reshape(nodes, bins)
                if left is None:
                    np.cumsum(found[:, :-1], axis=1, out=into[:, self.starts[first]:self.starts[first] + bins - 1])
                else:
                    into[:, self.starts[first]:self.starts[first] + left.shape[1]] = found @ left
        return out

    def drawn(self, sums: np.ndarray, growth: Growth, a: int, b: int) -> np.ndarray:
        """(3, cuts of open nodes `a` to `b`) of the slots that these nodes of a tree may use."""
        at = drawn_places(growth, self.size, self.starts, a, b)
        return self.counts([looked_up(x.reshape(-1), at) for x in sums])

    def counts(self, sums: Sequence[np.ndarray]) -> np.ndarray:
        """(3, …): the rows, draws of class 0 and draws of class 1 that the numbers of `sums` hold."""
        found = [x.astype(np.int64) for x in sums]
        out = np.empty((3, *found[0].shape), dtype=np.int64)
        rest = found[-1]
        if len(found) == 1:
            np.bitwise_and(rest, (1 << self.low) - 1, out=out[0])
            rest >>= self.low
        else:
            out[0] = found[0]
        np.bitwise_and(rest, (1 << self.middle) - 1, out=out[1])
        np.right_shift(rest, self.middle, out=out[2])
        return out


def all_cuts(widths: np.ndarray) -> tuple[int, np.ndarray]:
    """Cuts of all slots, and where those of each slot begin."""
    cuts = slot_cuts(widths)
    return int(cuts.sum()), np.cumsum(cuts) - cuts


def drawn_places(growth: Growth, size: int, starts: np.ndarray, a: int, b: int) -> np.ndarray:
    """Where the cuts of the slots that open nodes `a` to `b` may use stand among all cuts of all open nodes."""
    cuts, first = growth.cut_layout(a, b)
    base = np.arange(a, a + len(cuts))[:, None] * size + starts[growth.features[a:b]] - first
    at = np.repeat(base.reshape(-1), cuts.reshape(-1))
    at += np.arange(len(at))
    return at


class Children:
    """The children of a level's splits, of which the smaller of each pair is counted if one of both is open."""

    def __init__(self, growth: Growth, own: np.ndarray, sides: np.ndarray):
        # Children are numbered by pairs, left ones first; `place` is a child's number among the open nodes.
        self.place = growth.place[-2 * len(own):]
        small = 2 * np.arange(len(own)) + (sides[0, ::2] > sides[0, 1::2])
        large = small ^ 1
        wanted = (self.place[small] >= 0) | (self.place[large] >= 0)
        self.small, self.large, self.own = small[wanted], large[wanted], own[wanted]
        # A counted child's number among these, by child.
        self.counted = np.full(len(self.place), -1)
        self.counted[self.small] = np.arange(len(self.small))

    def sums(self, parents: np.ndarray, less: np.ndarray, nodes: int) -> np.ndarray:
        """Sums of the open nodes: those of the smaller children, and what remains of their parents for the others."""
        out = np.empty((len(less), nodes, less.shape[2]), dtype=less.dtype)
        more = self.place[self.large] >= 0
        out[:, self.place[self.large[more]]] = parents[:, self.own[more]] - less[:, more]
        more = self.place[self.small] >= 0
        out[:, self.place[self.small[more]]] = less[:, more]
        return out


def grow_tree(
    rows: np.ndarray, bins: np.ndarray, label: np.ndarray, widths: np.ndarray, number: int, params: TreeParams, seed: int,
    weights: tuple[float, float] | None, groups: Sequence[tuple] | None = None,
) -> Tree:
    """One tree from all training rows; `groups` are their `slot_groups`.

    Where groups are not many more than the slots that a node may use, all slots are counted: then only the smaller
    child of each split is, and the other has what remains of its parent. Else the drawn slots alone are counted.
    """
    weight = bag(rows, number, params.max_samples or 1.0, seed)
    growth = Growth(number, widths, params, seed, weights)
    groups = slot_groups(bins, widths) if groups is None else groups
    if len(groups) > MOST_GROUPS * params.features(len(widths)):
        return _grow_drawn(growth, bins, label, weight)
    counter = Sums(groups, widths, label, weight)
    flat, slots = bins.reshape(-1), bins.shape[1]
    held = np.flatnonzero(weight)
    node = np.zeros(len(held), dtype=np.int64)
    sums, growth.whole = counter.of(held, node, 1), counter.whole
    while len(growth.open):
        ids = growth.open
        own, sides = growth.split_by(lambda a, b: counter.drawn(sums, growth, a, b))
        if not len(growth.open):
            break
        # Rows of nodes that are not split go to a last pair, which is never open.
        pair = np.full(len(ids), 2 * len(own))
        pair[own] = 2 * np.arange(len(own))
        bin_ = looked_up(flat, held * slots + looked_up(np.maximum(growth.feature[ids], 0), node))
        child = looked_up(pair, node) + (bin_ > looked_up(growth.cut[ids].astype(np.uint8), node))
        children = Children(growth, own, sides)
        of = looked_up(np.append(children.counted, [-1, -1]), child)
        inner = np.flatnonzero(of >= 0)
        less = counter.of(looked_up(held, inner), looked_up(of, inner), len(children.small))
        sums = children.sums(sums, less, len(growth.open))
        node = looked_up(np.append(children.place, [-1, -1]), child)
        inner = np.flatnonzero(node >= 0)
        held, node = looked_up(held, inner), looked_up(node, inner)
    return growth.tree()


def _grow_drawn(growth: Growth, bins: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Tree:
    held = np.flatnonzero(weight)
    bins, code = bins[held], coded(label[held], weight[held])
    node = np.zeros(len(held), dtype=np.int64)
    while len(growth.open):
        ids = growth.open
        growth.split(growth.counts(bins, code, node))
        if not len(growth.open):
            break
        at = ids[node]
        inner = np.flatnonzero(growth.feature[at] >= 0)
        at = at[inner]
        node = growth.place[growth.child[at] + (bins[inner, growth.feature[at]] > growth.cut[at])]
        keep = node >= 0
        bins, code, node = bins[inner[keep]], code[inner[keep]], node[keep]
    return growth.tree()


def learn_cuts(df: DataFrame, features: str = "features", bins: int = BINS) -> list[np.ndarray]:
    """Cut points of each slot of a vector column: its distinct values, or `bins` - 1 quantiles of many.

    A value is in the bin whose number is how many cut points lie below it.
    """
    width = len(df.select(features).first()[0])
    values = {f"s{i}": vector_to_array(F.col(features))[i] for i in range(width)}
    ranked = materialize(ranked_histogram(df, values), "slots")
    probabilities = {f"q{i}": ("n", i / bins) for i in range(1, bins)}
    at = {r["feature"]: r for r in quantiles(ranked, probabilities).collect()}
    few = ranked.groupBy("feature").agg(F.count(F.lit(1)).alias("k"), F.max("value").alias("top"))
    few = {r["feature"]: r for r in few.collect()}
    listed = ranked.join(F.broadcast(ranked.groupBy("feature").count().where(F.col("count") <= bins)), "feature")
    short: dict[str, list[float]] = {}
    for r in listed.select("feature", "value").collect():
        short.setdefault(r["feature"], []).append(r["value"])
    out = []
    for name in values:
        chosen = short.get(name) or [at[name][q] for q in probabilities]
        out.append(np.array(sorted({x for x in chosen if x < few[name]["top"]}), dtype=float))
    return out


def binned(df: DataFrame, cuts: Sequence[np.ndarray], key: str, target: str, features: str = "features") -> DataFrame:
    """(id, row, label, bins): the key, its number for hashing, the class and one byte per slot."""
    whole = dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
    number: Column = F.col(key).cast("long") if whole else F.xxhash64(F.col(key))
    rows = df.select(
        F.col(key).alias("id"), number.alias("row"), F.col(target).cast("int").alias("label"),
        vector_to_array(F.col(features)).alias("x"))
    cuts = list(cuts)

    def run(batches):
        for batch in batches:
            flat = batch.column("x").flatten().to_numpy().reshape(len(batch.column("x")), -1)
            out = np.empty(flat.shape, dtype=np.uint8)
            for i, cut in enumerate(cuts):
                out[:, i] = np.searchsorted(cut, flat[:, i], side="left")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), batch.column("label"), pa.array([x.tobytes() for x in out], pa.binary())],
                names=["id", "row", "label", "bins"])

    schema = StructType([StructField("id", df.schema[key].dataType), *StructType.fromDDL("row long, label int, bins binary")])
    return rows.mapInArrow(run, schema)


def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, labels, bins) of a table from `binned`."""
    flat = np.frombuffer(b"".join(table.column("bins").to_pylist()), dtype=np.uint8)
    return table.column("row").to_numpy(), table.column("label").to_numpy(), flat.reshape(table.num_rows, -1)


def slot_widths(cuts: Sequence[np.ndarray]) -> np.ndarray:
    return np.array([len(c) + 1 for c in cuts], dtype=np.int64)


def class_weights(params: TreeParams, label_counts: Mapping[int, int]) -> tuple[float, float] | None:
    """Weights of both classes, None where each tree's bag decides."""
    if params.class_weight == "balanced_subsample":
        return None
    if params.class_weight is None:
        return 1.0, 1.0
    n = sum(label_counts.values())
    return n / (2 * label_counts[0]), n / (2 * label_counts[1])


BLOCKS = "row binary, label binary, bins binary, groups binary, many long"


def packed(rows: DataFrame, cuts: Sequence[np.ndarray]) -> DataFrame:
    """A stored table from `binned` as a stored table of blocks of about COUNT_ROWS rows, with their `slot_groups`.

    Each level of each tree reads all rows: a block is read as a few large values, not as values of single rows.
    """
    widths = slot_widths(cuts)

    def pack(batches):
        for table in joined(batches, COUNT_ROWS):
            row, label, bins = matrix(table)
            groups = slot_groups(bins, widths)
            values = [np.ascontiguousarray(x).tobytes() for x in (row, label, bins)] + [pickle.dumps(groups)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([x], pa.binary()) for x in values], pa.array([len(groups)])], names=["row", "label", "bins", "groups", "many"])

    return materialize(rows.mapInArrow(pack, BLOCKS), "packed")


def _blocks(batches, slots: int):
    """(row, label, bins, groups) of the blocks of a table from `packed`."""
    for batch in batches:
        for row, label, bins, groups in zip(*[batch.column(x) for x in ("row", "label", "bins", "groups")]):
            yield (np.frombuffer(row.as_buffer(), dtype=np.int64), np.frombuffer(label.as_buffer(), dtype=np.int32),
                   np.frombuffer(bins.as_buffer(), dtype=np.uint8).reshape(-1, slots), pickle.loads(groups.as_buffer()))


@dataclass
class Counting:
    """What a level counts for a tree: where the rows of each node are counted, by node, in `nodes` places.

    With `every`, all slots are counted, and the whole bag after them at the root; else those drawn for open nodes.
    """

    growth: Growth
    at: np.ndarray
    nodes: int
    every: bool

    def of(self, hashes: np.ndarray, label: np.ndarray, bins: np.ndarray, groups: Sequence[tuple]) -> np.ndarray:
        """(3, nodes, counts of a node) of a block's rows in the tree's bag, or (3, counts) of the drawn slots."""
        growth = self.growth
        draw, steps = draws(hashes, growth.number, growth.seed), poisson_cuts(growth.params.max_samples or 1.0)
        held = np.flatnonzero(draw >= np.uint64(steps[0]))
        place = looked_up(self.at, growth.standing(bins, held))
        inner = np.flatnonzero(place >= 0)
        held, place = looked_up(held, inner), looked_up(place, inner)
        label, weight = looked_up(label, held), reached(looked_up(draw, held), steps)
        if not self.every:
            return growth.counts(bins[held], coded(label, weight), place)
        sums = Sums(groups, growth.widths, label, weight)
        found = sums.counts(sums.coded_of(sums.codes, held, place, self.nodes))
        return found if growth.level_now else np.concatenate([found, sums.whole[:, None]], axis=2)

    def pieces(self, counts: np.ndarray, chunk: int):
        """(first node, counts) in pieces of `chunk` nodes."""
        growth = self.growth
        for first in range(0, self.nodes, chunk):
            stop = min(first + chunk, self.nodes)
            if self.every:
                yield first, counts[:, first:stop]
            else:
                a, b = growth.starts[first, 0], growth.starts[stop - 1, -1] + growth.width[stop - 1, -1]
                yield first, counts[:, a:b]


class Spread:
    """A tree that grows by counts of rows that lie elsewhere, and of which the driver holds `most` bytes."""

    def __init__(self, growth: Growth, every: bool, most: int):
        self.growth, self.most = growth, most
        self.size, self.starts = all_cuts(growth.widths)
        self.sums, self.children = None, None
        self.counting = Counting(growth, growth.place, 1, every and self._holds())

    def _holds(self) -> bool:
        return 24 * self.size * len(self.growth.open) <= self.most

    def grow(self, pieces: Sequence[bytes]) -> None:
        """A level more, by the summed counts of what `counting` names."""
        growth, found = self.growth, [np.frombuffer(x, dtype=np.int64) for x in pieces]
        if not self.counting.every:
            growth.split(np.concatenate([x.reshape(3, -1) for x in found], axis=1))
            self.counting = Counting(growth, growth.place, len(growth.open), False)
            return
        if self.children is None:
            root = found[0].reshape(3, 1, -1)
            growth.whole, self.sums = root[:, :, -1], root[:, :, :-1]
        else:
            less = np.concatenate([x.reshape(3, -1, self.size) for x in found], axis=1)
            self.sums = self.children.sums(self.sums, less, len(growth.open))
        flat = np.ascontiguousarray(self.sums).reshape(3, -1)
        own, sides = growth.split_by(
            lambda a, b: flat.take(drawn_places(growth, self.size, self.starts, a, b), axis=1))
        if not len(growth.open):
            return
        if not self._holds():
            self.sums = None
            self.counting = Counting(growth, growth.place, len(growth.open), False)
            return
        self.children = Children(growth, own, sides)
        at = np.full(len(growth.feature), -1)
        at[-len(self.children.counted):] = self.children.counted
        self.counting = Counting(growth, at, len(self.children.small), True)


def grow_over_partitions(
    rows: DataFrame, cuts: Sequence[np.ndarray], trees: Sequence[int], params: TreeParams, seed: int, chunk: int = 256,
    blocks: DataFrame | None = None, label_counts: Mapping[int, int] | None = None,
) -> list[Tree]:
    """Trees grown without moving rows: `rows` is a stored table from `binned`, of any size, and `blocks` it `packed`.

    Each level is one job. Its tasks walk their rows down the trees so far and emit counts, summed within
    the task, in pieces of `chunk` nodes; sums of a piece meet in one task. The driver holds the trees, and the
    counts of their open nodes while all slots are counted. `label_counts` are the rows per class.
    """
    widths = slot_widths(cuts)
    blocks = packed(rows, cuts) if blocks is None else blocks
    counted = label_counts or {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    weights = class_weights(params, counted)
    many = blocks.agg(F.max("many")).first()[0] or 0
    every = many <= MOST_GROUPS * params.features(len(widths))
    spreads = {t: Spread(Growth(t, widths, params, seed, weights), every, SUM_BYTES // max(1, len(trees))) for t in trees}
    context = blocks.sparkSession.sparkContext
    while active := [s for s in spreads.values() if len(s.growth.open)]:
        shared = context.broadcast([s.counting for s in active])

        def count(batches):
            sums: list[np.ndarray | None] = [None] * len(shared.value)
            for row, label, bins, groups in _blocks(batches, len(widths)):
                hashes = hashed(row.view(np.uint64))
                for i, counting in enumerate(shared.value):
                    found = counting.of(hashes, label, bins, groups)
                    sums[i] = found if sums[i] is None else sums[i] + found
            for counting, found in zip(shared.value, sums):
                if found is None:
                    continue
                for piece, part in counting.pieces(found, chunk):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([counting.growth.number]), pa.array([piece]), pa.array([part.tobytes()], pa.binary())],
                        names=["tree", "piece", "counts"])

        def add(key, table):
            total = sum(np.frombuffer(x, dtype=np.int64) for x in table.column("counts").to_pylist())
            return pa.table({"tree": [key[0].as_py()], "piece": [key[1].as_py()], "counts": pa.array([total.tobytes()], pa.binary())})

        schema = "tree long, piece long, counts binary"
        parts = blocks.mapInArrow(count, schema).groupBy("tree", "piece").applyInArrow(add, schema).collect()
        by_tree: dict[int, list] = {}
        for r in sorted(parts, key=lambda r: (r["tree"], r["piece"])):
            by_tree.setdefault(r["tree"], []).append(r["counts"])
        for spread in active:
            spread.grow(by_tree[spread.growth.number])
        shared.unpersist()
    return [spreads[t].growth.tree() for t in trees]


def joined(batches, rows: int):
    """Tables of successive batches, of at least `rows` rows but for the last one."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def fits_broadcast(rows: DataFrame, cuts: Sequence[np.ndarray], most: int = BROADCAST_BYTES) -> bool:
    """Whether a table from `binned` may be broadcast: a byte per slot and 32 for the rest of a row."""
    return rows.count() * (len(cuts) + 32) <= most


def grow_trees(
    rows: DataFrame, cuts: Sequence[np.ndarray], n: int, params: TreeParams, seed: int, block: int = 16,
) -> list[Tree]:
    """The first `n` trees, each grown whole by a task on broadcast rows. The driver holds the trees."""
    table = rows.select("row", "label", "bins").toArrow()
    widths, spark = slot_widths(cuts), rows.sparkSession
    shared = spark.sparkContext.broadcast(matrix(table))
    labels = shared.value[1]
    weights = class_weights(params, {c: int((labels == c).sum()) for c in (0, 1)})

    def run(batches):
        number, label, bins = shared.value
        groups = slot_groups(bins, widths)
        for batch in batches:
            for at in batch.column("id").to_pylist():
                for i in range(at * block, min(n, (at + 1) * block)):
                    t = grow_tree(number, bins, label, widths, i, params, seed, weights, groups)
                    yield _tree_rows([i], [t])

    blocks = -(-n // block)
    found = spark.range(0, blocks, 1, blocks).mapInArrow(run, TREES).toArrow()
    return trees_of(found)


TREES = "tree long, feature array<long>, cut array<long>, child array<long>, value array<double>, level array<long>"


def _tree_rows(numbers: Sequence[int], trees: Sequence[Tree]) -> pa.RecordBatch:
    parts = {name: pa.array([getattr(t, name).tolist() for t in trees], pa.list_(pa.float64() if name == "value" else pa.int64()))
             for name in ("feature", "cut", "child", "value", "level")}
    return pa.RecordBatch.from_pydict({"tree": pa.array(numbers, pa.int64()), **parts})


def trees_of(table: pa.Table) -> list[Tree]:
    """Trees of a table with the columns TREES, in their order."""
    rows = sorted(table.to_pylist(), key=lambda r: r.pop("tree"))
    return [Tree(**{k: np.array(v, dtype=float if k == "value" else np.int64) for k, v in r.items()}) for r in rows]


@dataclass
class ForestModel:
    """A fitted forest: adds `score`, the mean of its trees' P(class 1), to rows with `features`."""

    cuts: list[np.ndarray]
    trees: list[Tree]

    def transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast((self.cuts, self.trees))

        def scores(vectors: pd.Series) -> pd.Series:
            cuts, trees = shared.value
            flat = np.stack(vectors.to_numpy()) if len(vectors) else np.zeros((0, len(cuts)))
            bins = np.stack([np.searchsorted(c, flat[:, i], side="left") for i, c in enumerate(cuts)], axis=1).astype(np.uint8)
            total = np.zeros(len(flat), dtype=np.int64)
            for tree in trees:
                total += np.rint(tree.reach(bins) * UNIT).astype(np.int64)
            return pd.Series(total / (UNIT * len(trees)))

        return df.withColumn("score", F.pandas_udf(scores, "double")(vector_to_array(F.col("features"))))

    def save(self, spark, path: str) -> None:
        rows = pa.Table.from_batches([_tree_rows(range(len(self.trees)), self.trees)])
        spark.createDataFrame(rows).write.mode("overwrite").parquet(f"{path}/trees")
        cuts = pa.table({"slot": range(len(self.cuts)), "cuts": pa.array([c.tolist() for c in self.cuts], pa.list_(pa.float64()))})
        spark.createDataFrame(cuts).write.mode("overwrite").parquet(f"{path}/cuts")

    @staticmethod
    def load(spark, path: str) -> ForestModel:
        cuts = sorted(spark.read.parquet(f"{path}/cuts").collect(), key=lambda r: r["slot"])
        trees = spark.read.parquet(f"{path}/trees").toArrow()
        return ForestModel([np.array(r["cuts"], dtype=float) for r in cuts], trees_of(trees))


@dataclass
class StoredTrees:
    """Trees of a two-class forest of Spark, which score many rows tree by tree as it does row by row.

    Rows are seen in columns: a slot's place among the thresholds of all trees, and whether a two-valued slot has
    the value that goes left. `trees` has `packed_nodes`, the levels, and the leaves' shares of both classes.
    """

    slots: list[tuple[int, int, np.ndarray]]
    trees: list[tuple[np.ndarray, int, np.ndarray, np.ndarray]]

    @staticmethod
    def of(model) -> StoredTrees | None:
        """The trees of a fitted forest, read from its stored form; None for one that splits in other ways."""
        spark = SparkSession.active()
        path = scratch_path(spark, "trees")
        model.write().save(path)
        node = F.col("nodeData")
        split, stats = node["split"], node["impurityStats"]
        found = spark.read.parquet(f"{path}/data").select(
            F.col("treeID").alias("tree"), node["id"].alias("id"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
            split["featureIndex"].alias("feature"), split["numCategories"].alias("categories"),
            F.size(split["leftCategoriesOrThreshold"]).alias("values"), F.try_element_at(split["leftCategoriesOrThreshold"], F.lit(1)).alias("value"),
            F.size(stats).alias("classes"), F.get(stats, F.lit(0)).alias("zero"), F.get(stats, F.lit(1)).alias("one"),
        ).toPandas().sort_values(["tree", "id"])
        inner = found["left"] >= 0
        plain = (found["categories"] < 0) | ((found["categories"] == 2) & found["value"].isin([0.0, 1.0]))
        if (found["classes"] != 2).any() or (inner & ~(plain & (found["values"] == 1))).any():
            return None
        # Kind of a split: by a threshold, by value 0 to the left, by value 1 to the left.
        kind = np.where(found["categories"] < 0, 0, 1 + found["value"].fillna(0).to_numpy().astype(int))
        found = found.assign(kind=kind)
        slots, columns = [], {}
        for (slot, kind), part in found[inner].groupby(["feature", "kind"]):
            columns[slot, kind] = len(slots)
            slots.append((int(slot), int(kind), np.unique(part["value"]) if kind == 0 else np.zeros(1)))
        if any(len(x) > 254 for _, _, x in slots):
            return None
        trees = []
        for _, tree in found.groupby("tree"):
            old = {x: tree[x].to_numpy() for x in ("left", "right", "feature", "kind", "value")}
            splits = np.flatnonzero(old["left"] >= 0)
            # Children are numbered by pairs, in the order of their parents.
            number = np.zeros(len(tree), dtype=np.int64)
            number[old["left"][splits]], number[old["right"][splits]] = 1 + 2 * np.arange(len(splits)), 2 + 2 * np.arange(len(splits))
            feature, cut, child = np.full(len(tree), -1), np.zeros(len(tree), dtype=np.int64), np.full(len(tree), -1)
            for j, i in enumerate(splits):
                column = columns[old["feature"][i], old["kind"][i]]
                feature[number[i]], child[number[i]] = column, 1 + 2 * j
                cut[number[i]] = np.searchsorted(slots[column][2], old["value"][i]) if old["kind"][i] == 0 else 0
            level = np.zeros(len(tree), dtype=np.int64)
            for i in splits:
                level[old["left"][i]] = level[old["right"][i]] = level[i] + 1
            zero, one = tree["zero"].to_numpy(), tree["one"].to_numpy()
            total = zero + one
            shares = [np.divide(x, total, out=np.zeros(len(tree)), where=total != 0) for x in (zero, one)]
            back = np.argsort(number)
            trees.append((packed_nodes(feature, cut, child), int(level.max()), *[x[back] for x in shares]))
        return StoredTrees(slots, trees)

    def columns(self, flat: np.ndarray) -> np.ndarray:
        out = np.empty((len(flat), max(1, len(self.slots))), dtype=np.uint8)
        for i, (slot, kind, values) in enumerate(self.slots):
            out[:, i] = np.searchsorted(values, flat[:, slot], side="left") if kind == 0 else flat[:, slot] != kind - 1
        return out

    def scores(self, flat: np.ndarray) -> np.ndarray:
        """P(class 1) of rows of slots: class shares summed in the order of the trees, as Spark does."""
        bins, rows = self.columns(flat), np.arange(len(flat))
        zero, one = np.zeros(len(flat)), np.zeros(len(flat))
        for nodes, levels, to_zero, to_one in self.trees:
            at = walked(nodes, bins, rows, levels)
            zero += looked_up(to_zero, at)
            one += looked_up(to_one, at)
        total = zero + one
        return np.divide(one, total, out=one, where=total != 0)

    def column(self, spark, features: str) -> Column:
        shared = spark.sparkContext.broadcast(self)

        def score(vectors: pa.Array) -> pa.Array:
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            return pa.array(shared.value.scores(flat.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 1))))

        return F.arrow_udf(score, "double")(vector_to_array(F.col(features)))


def fit_forest(
    train: DataFrame, key: str, target: str, n: int, params: TreeParams, seed: int, most: int = BROADCAST_BYTES,
) -> ForestModel:
    """A forest of `n` trees on a frame with the key, the target and `features`.

    Rows of at most `most` bytes are broadcast, others stay where they are; the trees are the same.
    """
    cuts = learn_cuts(train)
    rows = materialize(binned(train, cuts, key, target), "binned")
    if fits_broadcast(rows, cuts, most):
        return ForestModel(cuts, grow_trees(rows, cuts, n, params, seed))
    blocks = packed(rows, cuts)
    counted = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}

    def grow(first: int) -> list[Tree]:
        numbers = range(first, min(n, first + PASS_TREES))
        return grow_over_partitions(rows, cuts, numbers, params, seed, blocks=blocks, label_counts=counted)

    # One pass computes while the counts of another are summed and its trees split.
    with ThreadPoolExecutor(PASSES) as pool:
        return ForestModel(cuts, [tree for trees in pool.map(grow, range(0, n, PASS_TREES)) for tree in trees])


def bag_table(df: DataFrame, key: str, target: str, trees: int, rate: float, seed: int) -> DataFrame:
    """Per tree and class: rows in the bag, their draws, and the class weight that the bag gives.

    Columns tree, label, bagged, draws, class_weight; the weight of class c is all draws / (2 * draws of c).
    """
    rows = df.select(F.col(key).cast("long").alias("row"), F.col(target).cast("int").alias("label"))

    def run(batches):
        sums = np.zeros((trees, 2, 2), dtype=np.int64)
        for batch in batches:
            number, label = batch.column("row").to_numpy(), batch.column("label").to_numpy()
            for t in range(trees):
                weight = bag(number, t, rate, seed)
                for c in (0, 1):
                    of = weight[label == c]
                    sums[t, c] += [(of > 0).sum(), of.sum()]
        t, c = np.divmod(np.arange(2 * trees), 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(t), pa.array(c.astype(np.int32)), pa.array(sums[:, :, 0].reshape(-1)), pa.array(sums[:, :, 1].reshape(-1))],
            names=["tree", "label", "bagged", "draws"])

    counted = rows.mapInArrow(run, "tree long, label int, bagged long, draws long").groupBy("tree", "label").agg(
        F.sum("bagged").alias("bagged"), F.sum("draws").alias("draws"))
    # One group of two rows per tree.
    whole = F.sum("draws").over(Window.partitionBy("tree"))
    return counted.withColumn("class_weight", whole / (2 * F.col("draws")))
