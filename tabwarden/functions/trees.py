"""Histogram trees in numpy: split search and routing, for use inside tasks.

Rows come as codes: a numeric cell is the number of its bin, a categorical one the number of its
category, each shifted to a place of its own in one row of histogram cells. Sums are of whole numbers
(gradients in units of 2**-26), so they are the same in whatever order and pieces rows are added up.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

import numpy as np

UNIT = float(1 << 26)
JOINT_CELLS = 1 << 12
#: Two sums of whole numbers below this are counted as one.
PACKED = 1 << 26
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_POISSON = np.cumsum([np.exp(-1.0) / f for f in np.cumprod([1.0, *range(1, 16)])])
_STEPS = 1 << 14
_FEWEST = np.searchsorted(_POISSON, np.arange(_STEPS) / _STEPS, side="right").astype(np.uint8)
_OPEN = _FEWEST < np.searchsorted(_POISSON, np.arange(1, _STEPS + 1) / _STEPS, side="left")


def mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit numbers from any."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def uniform(keys: np.ndarray, *salt: int) -> np.ndarray:
    """A number in [0, 1) for each row key, another one for each salt."""
    x = np.asarray(keys).view(np.uint64) if np.asarray(keys).dtype == np.int64 else np.asarray(keys, np.uint64)
    for s in salt:
        x = mixed(x + np.uint64((s * 0x9E3779B97F4A7C15 + 1) & ((1 << 64) - 1)))
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def poisson(u: np.ndarray) -> np.ndarray:
    """Draws of Poisson(1), the weights of a bootstrap, from uniform numbers: a step of a table decides most of them."""
    step = (u * _STEPS).astype(np.int64)
    out = _FEWEST[step]
    open_ = np.flatnonzero(_OPEN[step])
    out[open_] = np.searchsorted(_POISSON, u[open_], side="right")
    return out


@dataclass
class Layout:
    """Histogram cells and candidate splits of a table.

    ``sizes``: bins of each feature; ``numeric``: how many features come first that are numbers. A
    number splits behind each of its bins but the last; each category splits from all others.
    """

    sizes: list[int]
    numeric: int

    def __post_init__(self):
        self.starts = np.cumsum([0, *self.sizes])[:-1]
        self.cells = int(sum(self.sizes))
        feature, cut, output = [], [], []
        for f, (start, size) in enumerate(zip(self.starts, self.sizes)):
            for b in range(size - 1 if f < self.numeric else size):
                feature.append(f)
                cut.append(int(start) + b)
                output.append(f if f < self.numeric else self.numeric + int(start - self.starts[self.numeric]) + b)
        self.feature, self.cut, self.output = (np.array(x, np.int64) for x in (feature, cut, output))
        self.ordered = self.feature < self.numeric
        self.outputs = self.numeric + sum(self.sizes[self.numeric :])

    @cached_property
    def groups(self) -> list[list[int]]:
        """Neighbouring features whose bins are counted together, up to ``JOINT_CELLS`` combinations."""
        out: list[list[int]] = []
        for f, size in enumerate(self.sizes):
            if out and size * int(np.prod([self.sizes[k] for k in out[-1]])) <= JOINT_CELLS:
                out[-1].append(f)
            else:
                out.append([f])
        return out

    def joint(self, columns: np.ndarray) -> list[np.ndarray]:
        """One code per group and row, from bin numbers (features x rows)."""
        out = []
        for group in self.groups:
            code = columns[group[0]].astype(np.int32)
            for f in group[1:]:
                code = code * self.sizes[f] + columns[f]
            out.append(code)
        return out

    def left(self, cells: np.ndarray) -> np.ndarray:
        """Sums on the left of each split, from sums per cell (nodes x cells)."""
        out = np.empty((len(cells), len(self.cut)), np.float64)
        total = self.totals(cells)
        done = 0
        for f in range(self.numeric):
            start, size = int(self.starts[f]), self.sizes[f]
            out[:, done : done + size - 1] = np.cumsum(cells[:, start : start + size - 1], axis=1)
            done += size - 1
        out[:, done:] = total[:, None] - cells[:, self.cut[done:]]
        return out

    def totals(self, cells: np.ndarray) -> np.ndarray:
        return cells[:, : self.sizes[0]].sum(axis=1) if self.sizes else np.zeros(len(cells))

    def goes_right(self, codes: np.ndarray, split: np.ndarray) -> np.ndarray:
        """Whether each row (codes: rows x features) goes right at its split."""
        code = np.take_along_axis(codes, self.feature[split][:, None], axis=1)[:, 0]
        cut = self.cut[split]
        return np.where(self.ordered[split], code > cut, code == cut)


def histogram(layout: Layout, codes: np.ndarray, node: np.ndarray, nodes: int, weights: list[np.ndarray]) -> np.ndarray:
    """Sums of each weight per node and cell, as whole numbers (weights x nodes x cells)."""
    out = np.zeros((len(weights), nodes, layout.cells), np.int64)
    for f, (start, size) in enumerate(zip(layout.starts, layout.sizes)):
        at = node * size + (codes[:, f] - start)
        for k, w in enumerate(weights):
            out[k, :, start : start + size] = np.rint(np.bincount(at, w, nodes * size)).reshape(nodes, size)
    return out


def joint_histogram(layout: Layout, joint: list[np.ndarray], node: np.ndarray, nodes: int, weights: list[np.ndarray | None]) -> np.ndarray:
    """``histogram`` from codes of groups; a weight of None is 1 for each row."""
    both = packed(weights)
    out = np.zeros((len(weights), nodes, layout.cells), np.int64)
    for group, codes in zip(layout.groups, joint):
        sizes = [layout.sizes[f] for f in group]
        at = node * int(np.prod(sizes)) + codes
        for k, w in enumerate(weights if both is None else [both]):
            found = np.rint(np.bincount(at, w, nodes * int(np.prod(sizes)))).reshape(nodes, *sizes)
            for axis, f in enumerate(group, 1):
                others = tuple(i for i in range(1, len(group) + 1) if i != axis)
                cells = found.sum(axis=others)
                out[slice(None) if both is not None else k, :, layout.starts[f] : layout.starts[f] + layout.sizes[f]] = cells if both is None else unpacked(cells)
    return out


def packed(weights: list[np.ndarray | None]) -> np.ndarray | None:
    """Two weights in one, if they are whole numbers that are not negative and have small sums."""
    if len(weights) != 2 or any(w is None or w.dtype.kind not in "iu" for w in weights):
        return None
    if any(len(w) and (w.min() < 0 or w.sum() >= PACKED) for w in weights):
        return None
    return weights[0] + weights[1] * float(PACKED)


def unpacked(sums: np.ndarray) -> list[np.ndarray]:
    whole = sums.astype(np.int64)
    return [(whole & (PACKED - 1)).astype(np.float64), (whole >> 26).astype(np.float64)]


def placed(tree: Tree, layout: Layout, columns: np.ndarray) -> np.ndarray:
    """``route`` from the root, for bin numbers (features x rows): split by split over whole columns, fast for small trees."""
    kind = np.min_scalar_type(len(tree.split)).type
    at = np.zeros(columns.shape[1], kind)
    for node, (split, child) in enumerate(zip(tree.split, tree.child)):  # a node comes before its children
        if child >= 0:
            f = layout.feature[split]
            bin_ = int(layout.cut[split] - layout.starts[f])
            right = columns[f] > bin_ if layout.ordered[split] else columns[f] == bin_
            at += (at == node) * (right + kind(child - node))
    return at


def best_splits(layout: Layout, hist: np.ndarray, unit: float, least: int, allowed: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """For each node the split with the largest gain in squared error (-1: none), the gain, left sums and all sums.

    ``hist``: counts, then sums of what is predicted, then any others. ``allowed``: nodes x outputs.
    """
    left, whole_sums = [layout.left(h) for h in hist], np.array([layout.totals(h).astype(np.float64) for h in hist])
    n, g = left[0], left[1] / unit
    all_n, all_g = whole_sums[0], whole_sums[1] / unit
    rest_n, rest_g = all_n[:, None] - n, all_g[:, None] - g
    whole = all_g**2 / np.maximum(all_n, 1)
    gain = g**2 / np.maximum(n, 1) + rest_g**2 / np.maximum(rest_n, 1) - whole[:, None]
    open_ = (n >= max(least, 1)) & (rest_n >= max(least, 1))
    if allowed is not None:
        open_ &= allowed[:, layout.output]
    gain = np.where(open_, gain, -1.0)
    if not gain.shape[1]:
        pick, top = np.full(len(gain), -1), np.zeros(len(gain))
    else:
        pick = gain.argmax(axis=1)
        top = np.take_along_axis(gain, pick[:, None], axis=1)[:, 0]
    pick = np.where(top > 1e-9 * (1 + whole), pick, -1)
    chosen = np.maximum(pick, 0)[:, None]
    lefts = np.array([np.take_along_axis(x, chosen, axis=1)[:, 0] for x in left]) if gain.shape[1] else whole_sums
    return pick, np.where(pick < 0, 0.0, top), lefts, whole_sums


def searched(
    layout: Layout, codes: np.ndarray, node: np.ndarray, nodes: int, weights: list[np.ndarray], unit: float, least: int, allowed: np.ndarray | None
) -> tuple[np.ndarray, ...]:
    """``best_splits`` of the rows' ``histogram``, feature by feature: a node counts only the features that it may split on."""
    if not len(layout.cut):
        return best_splits(layout, histogram(layout, codes, node, nodes, weights), unit, least, allowed)
    both = packed(weights)
    return _searched(layout, codes.T - layout.starts[:, None], node, nodes, weights if both is None else [both], both is not None, unit, least, allowed)


def _searched(layout: Layout, columns: np.ndarray, node, nodes: int, weights: list[np.ndarray], both: bool, unit: float, least: int, allowed) -> tuple[np.ndarray, ...]:
    """``searched`` for bin numbers (features x rows); ``both``: the weights are ``packed``."""
    parts = (lambda x: unpacked(x[0])) if both else (lambda x: x)
    sums = [np.rint(np.bincount(node, w, nodes)) for w in weights]
    totals = np.array(parts(sums))
    whole = (totals[1] / unit) ** 2 / np.maximum(totals[0], 1)
    top, pick, lefts = np.full(nodes, -1.0), np.full(nodes, -1), totals.copy()
    least = max(least, 1)
    for f, size in enumerate(layout.sizes):
        splits = np.flatnonzero(layout.feature == f)
        if not len(splits):
            continue
        free = np.ones((nodes, len(splits)), bool) if allowed is None else allowed[:, layout.output[splits]]
        mine, rows, place = np.flatnonzero(free.any(axis=1)), slice(None), node
        if not len(mine):
            continue
        if len(mine) < nodes:
            back = np.full(nodes, -1)
            back[mine] = np.arange(len(mine))
            place = back[node]
            rows = np.flatnonzero(place >= 0)
            place = place[rows]
        at = place * size + columns[f][rows]
        cells = [np.rint(np.bincount(at, w[rows], len(mine) * size)) for w in weights]
        if f < layout.numeric:  # a node may split on all bins of a number, or on none
            left = [np.cumsum(c.reshape(len(mine), size)[:, :-1], axis=1).ravel() for c in cells]
            begins, of = np.arange(len(mine)) * (size - 1), np.repeat(mine, size - 1)
        else:
            asked = np.flatnonzero(free[mine])
            of = mine[asked // size]
            left = [t[of] - c[asked] for t, c in zip(sums, cells)]
            begins = np.searchsorted(of, mine)
        left = parts(left)
        n, g, all_n, all_g = left[0], left[1] / unit, totals[0][of], totals[1][of] / unit
        rest_n, rest_g = all_n - n, all_g - g
        gain = g**2 / np.maximum(n, 1) + rest_g**2 / np.maximum(rest_n, 1) - whole[of]
        gain[(n < least) | (rest_n < least)] = -1.0
        if f < layout.numeric:
            best = begins + gain.reshape(len(mine), -1).argmax(axis=1)
            split = splits[best - begins]
        else:
            equal = np.flatnonzero(gain == np.repeat(np.maximum.reduceat(gain, begins), np.diff([*begins, len(of)])))[::-1]
            best = np.empty(nodes, np.int64)
            best[of[equal]] = equal  # the first of equal gains is written last
            best = best[mine]
            split = splits[asked[best] % size]
        better = gain[best] > top[mine]  # of equal gains the first split
        where, best = mine[better], best[better]
        top[where], pick[where] = gain[best], split[better]
        for k, x in enumerate(left):
            lefts[k, where] = x[best]
    pick = np.where(top > 1e-9 * (1 + whole), pick, -1)
    return pick, np.where(pick < 0, 0.0, top), lefts, totals


def outputs_of(keys: np.ndarray, outputs: int, sampled: int) -> np.ndarray | None:
    """The outputs each node may split on: ``sampled`` of them, drawn by the node's key."""
    if not sampled or sampled >= outputs:
        return None
    draw = mixed(keys[:, None] + mixed(np.arange(1, outputs + 1, dtype=np.uint64))[None, :])
    out = np.zeros(draw.shape, bool)
    np.put_along_axis(out, np.argpartition(draw, sampled - 1, axis=1)[:, :sampled], True, axis=1)
    return out


@dataclass
class Tree:
    """A tree that grows level by level; node 0 is the root. ``sums`` are a node's totals, once known."""

    key: int
    depth: int
    least: int
    sampled: int = 0
    split: list[int] = field(default_factory=lambda: [-1])
    child: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [0.0])
    sums: list[tuple] = field(default_factory=lambda: [()])
    keys: list[int] = field(default_factory=list)
    level: int = 0
    frontier: list[int] = field(default_factory=lambda: [0])

    def __post_init__(self):
        if not self.keys:
            self.keys = [self.key]

    @property
    def growing(self) -> bool:
        """A tree without a level to grow still wants the sums of its root."""
        return bool(self.frontier)

    def allowed(self, outputs: int, nodes: list[int]) -> np.ndarray | None:
        return outputs_of(np.array([self.keys[i] for i in nodes], np.uint64), outputs, self.sampled)

    def grow(self, pick, gain, lefts, totals) -> None:
        """Take the splits of the frontier; children that may split are the next frontier."""
        nodes, self.frontier = self.frontier, []
        self.level += 1
        own = np.array([self.keys[i] for i in nodes], np.uint64)
        keys = [mixed(own * np.uint64(2) + np.uint64(1 + right)).tolist() for right in (0, 1)]
        sides = [lefts.T.tolist(), (totals - lefts).T.tolist()]
        for k, (node, sums) in enumerate(zip(nodes, totals.T.tolist())):
            self.sums[node] = tuple(sums)
            if pick[k] < 0 or self.level > self.depth:
                continue
            self.split[node], self.child[node], self.gain[node] = int(pick[k]), len(self.split), float(gain[k])
            for right in (0, 1):
                self.keys.append(keys[right][k])
                self.split.append(-1)
                self.child.append(-1)
                self.gain.append(0.0)
                self.sums.append(tuple(sides[right][k]))
                if self.level < self.depth and sides[right][k][0] >= 2 * max(self.least, 1):
                    self.frontier.append(len(self.split) - 1)

    def route(self, layout: Layout, codes: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """The deepest node of each row, from the node it was known to be in."""
        split, child = np.asarray(self.split), np.asarray(self.child)
        at = np.zeros(len(codes), np.int64) if at is None else at.copy()
        moving = np.flatnonzero(child[at] >= 0)
        while len(moving):
            node = at[moving]
            at[moving] = child[node] + layout.goes_right(codes[moving], split[node])
            moving = moving[child[at[moving]] >= 0]
        return at

    def packed(self) -> Grown:
        """The tree in arrays."""
        width = max(len(x) for x in self.sums)
        totals = np.array([x or (0.0,) * width for x in self.sums], np.float64).reshape(len(self.sums), width)
        return Grown(np.array(self.split, np.int32), np.array(self.child, np.int32), np.array(self.gain, np.float64), totals)


@dataclass
class Grown:
    """A finished tree in arrays; ``totals`` are sums per node."""

    split: np.ndarray
    child: np.ndarray
    gain: np.ndarray
    totals: np.ndarray

    @cached_property
    def sums(self) -> list[tuple]:
        return [tuple(x) for x in self.totals.tolist()]

    route = Tree.route


def joined(top: Tree, parts: dict[int, Grown]) -> Grown:
    """``top`` with finished trees in the places of some of its nodes."""
    whole = top.packed()
    if not whole.totals.shape[1]:  # nothing was summed before the parts
        whole.totals = np.zeros((len(top.split), next(iter(parts.values())).totals.shape[1] if parts else 0))
    cells = {c: [getattr(whole, c)] for c in ("split", "child", "gain", "totals")}
    base = len(top.split) - 1
    for node, part in sorted(parts.items()):  # node 0 of a part takes the place of ``node``
        child = np.where(part.child < 0, -1, part.child + base).astype(np.int32)
        for name, values in (("split", part.split), ("child", child), ("gain", part.gain), ("totals", part.totals)):
            cells[name][0][node] = values[0]
            cells[name].append(values[1:])
        base += len(child) - 1
    return Grown(**{c: np.concatenate(x) for c, x in cells.items()})


def grown(tree: Tree, layout: Layout, codes: np.ndarray, weights: list[np.ndarray], unit: float) -> Tree:
    """Grow a tree to its end from rows at hand."""
    if tree.growing:
        whole = grown_arrays(tree, layout, np.ascontiguousarray(codes.T - layout.starts[:, None]), weights, unit)
        tree.split, tree.child, tree.gain, tree.sums = whole.split.tolist(), whole.child.tolist(), whole.gain.tolist(), whole.sums
        tree.frontier = []
    return tree


def grown_arrays(tree: Tree, layout: Layout, columns: np.ndarray, weights: list[np.ndarray], unit: float) -> Grown:
    """What grows from the root of ``tree``, from bin numbers (features x rows)."""
    if not len(layout.cut):
        totals = np.array([[np.rint(w.sum(dtype=np.float64)) for w in weights]])
        return Grown(np.full(1, -1, np.int32), np.full(1, -1, np.int32), np.zeros(1), totals)
    both = packed(weights)
    width, used = len(weights), weights if both is None else [both]
    split, child, gain, totals = np.full(1, -1, np.int32), np.full(1, -1, np.int32), np.zeros(1), np.zeros((1, width))
    frontier, keys, node, level, least = np.zeros(1, np.int64), np.array([tree.key], np.uint64), np.zeros(columns.shape[1], np.int64), tree.level, max(tree.least, 1)
    while len(frontier):
        allowed = outputs_of(keys, layout.outputs, tree.sampled)
        pick, top, lefts, whole = _searched(layout, columns, node, len(frontier), used, both is not None, unit, least, allowed)
        totals[frontier], level = whole.T, level + 1
        cut = np.flatnonzero(pick >= 0) if level <= tree.depth else np.zeros(0, np.int64)
        own, size = frontier[cut], 2 * len(cut)
        split[own], child[own], gain[own] = pick[cut], len(split) + np.arange(0, size, 2), top[cut]
        pairs = lambda a, b: np.stack([a, b], axis=1).reshape(size, *a.shape[1:])  # noqa: E731  left and right in turn
        sums = pairs(lefts.T[cut], (whole - lefts).T[cut])
        goes_on = (sums[:, 0] >= 2 * least) & (level < tree.depth)
        keys = pairs(*[mixed(keys[cut] * np.uint64(2) + np.uint64(1 + right)) for right in (0, 1)])[goes_on]
        frontier = len(split) + np.flatnonzero(goes_on)
        split, child = (np.concatenate([x, np.full(size, -1, np.int32)]) for x in (split, child))
        gain, totals = np.concatenate([gain, np.zeros(size)]), np.concatenate([totals, sums])
        if not len(frontier):
            break
        to = np.full((len(pick), 2), -1)
        to[cut] = np.where(goes_on, np.cumsum(goes_on) - 1, -1).reshape(-1, 2)
        feature = layout.feature[pick]
        last = (layout.cut[pick] - layout.starts[feature]).astype(np.int32)
        ordered, rows = layout.ordered[pick], columns.shape[1]
        low, high = np.where(ordered, last + 1, last), np.where(ordered, np.int32(2**31 - 1), last)
        code = columns.ravel()[(feature * rows)[node] + np.arange(rows)]
        right = (code >= low[node]) & (code <= high[node])
        node = to.ravel()[2 * node + right]
        if (node < 0).any():  # rows in a leaf are done with
            here = np.flatnonzero(node >= 0)
            columns, node, used = columns[:, here], node[here], [w[here] for w in used]
    return Grown(split, child, gain, totals)
