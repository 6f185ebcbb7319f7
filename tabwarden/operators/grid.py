"""All fits of a parameter search together: boosted trees, forests and logistic regressions.

The training rows are binned once, at quantiles, and stored as blocks of numpy arrays. A fit is one
(candidate, draw, fold left out); all fits read the same blocks and none keeps a copy.

Trees of all fits grow side by side: a job of one stage grows a level of every tree of every fit, from the
histograms of its tasks. Boosting keeps codes and margins in memory, as tasks read them once a level, and
stores them now and then. A node of a forest with at most ``TASK_ROWS``
rows is grown to its end in one task, from its rows; rows left out go along and come back with their
shares, so that only the trees of whole fits reach the driver. Logistic regressions take Newton steps,
whose sums come from the same blocks.

Rows of at most ``TASK_ROWS`` in number are few enough for one task; each fit then takes its steps in a
task of its own, all fits in one job. The steps and the sums are the same, so are the models: sums of
trees are of whole numbers, and the draws of a row depend on its cells and the seed alone.
"""

from __future__ import annotations

import base64
import json
import pickle
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwarden import fixed
from tabwarden.functions import sizing, trees
from tabwarden.operators.encode import TabularEncoderModel, category

#: Bins of a numeric column, rows of a block, rows that one task may hold, outputs of a logistic regression.
BINS, BLOCK_ROWS, TASK_ROWS, WIDEST = 64, 1 << 15, 200_000, 2_000
#: Rows of the levels that a task counts at once.
PIECE_ROWS = 1 << 17
#: Boosting rounds between stored states and, a part of them, between states in memory; the depth that stands for an unlimited one.
ROUNDS_KEPT, ROUNDS_HELD, DEEPEST = 50, 5, 30
#: Nodes of a tree that is read split by split.
SMALL_TREE = 127
BLOCK = "n bigint, num binary, cat binary, y binary, fold binary, h binary"
SMALLEST_STEP = 1e-8


@dataclass
class Fit:
    """One fit: what to train, on which rows (``fold`` is left out, None trains on all), with which encoder."""

    slot: int
    name: str
    params: dict[str, Any]
    fold: int | None
    encoder: dict
    seed: int = fixed.SEED


@dataclass
class Table:
    """Columns of the blocks, their bounds and categories, and where the blocks are."""

    numeric: list[str]
    categorical: list[str]
    edges: list[list[float]]
    levels: list[list[str]]
    rows: int
    blocks: DataFrame | None = None

    @property
    def layout(self) -> trees.Layout:
        return trees.Layout([len(e) + 1 for e in self.edges] + [len(v) for v in self.levels], len(self.numeric))


@dataclass
class Rows:
    """Rows of one or more blocks, side by side."""

    num: np.ndarray
    cat: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    h: np.ndarray
    drawn: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)


def store(train: DataFrame, encoder: TabularEncoderModel, label: str, fold: str) -> Table:
    """Bin bounds and categories of the training rows, and the rows as stored blocks."""
    fitted = encoder.fitted()
    numeric, levels = list(fitted["numeric"]), {c: v for c, v in fitted["levels"].items() if v}
    steps = [i / BINS for i in range(1, BINS)]
    bounds = train.agg(F.count(F.lit(1)).alias("rows"), *[F.percentile_approx(F.col(c).cast("double"), steps, 10_000).alias(f"q{i}") for i, c in enumerate(numeric)]).first()
    edges = [sorted(set(bounds[f"q{i}"])) for i in range(len(numeric))]
    table = Table(numeric, list(levels), edges, list(levels.values()), bounds["rows"])
    cells = [F.col(f"`{c}`").cast("double").alias(f"n{i}") for i, c in enumerate(numeric)]
    cells += [category(c).alias(f"c{i}") for i, c in enumerate(levels)]
    wide = train.select(*cells, F.col(label).cast("int").alias("y"), F.col(fold).cast("int").alias("fold"))
    wide = wide.withColumn("h", F.xxhash64(*wide.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(k, BLOCK_ROWS)
                dense = lambda c: pc.cast(piece.column(c), pa.float64()).to_numpy(zero_copy_only=False)
                num = np.array([dense(f"n{i}") for i in range(len(numeric))]).reshape(len(numeric), -1).T
                cat = [pc.index_in(piece.column(f"c{i}"), pa.array(v)).to_numpy(zero_copy_only=False) for i, v in enumerate(levels.values())]
                cat = np.array(cat, np.int32).reshape(len(levels), -1).T
                y, folds, h = (piece.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold", "h"))
                cells = [np.ascontiguousarray(num, "<f8"), np.ascontiguousarray(cat, "<i4"), y.astype("<i4"), folds.astype("<i4"), h.astype("<i8")]
                yield pa.record_batch([pa.array([piece.num_rows], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in cells]], [x.split()[0] for x in BLOCK.split(", ")])

    table.blocks = sizing.cut_lineage(wide.mapInArrow(run, BLOCK), "blocks")
    return table


def _rows(table: Table, cells: Sequence[dict]) -> Rows:
    read = lambda name, kind, width: np.concatenate([np.frombuffer(c[name], kind).reshape(c["n"], width) if width else np.frombuffer(c[name], kind) for c in cells])
    return Rows(
        read("num", "<f8", len(table.numeric)) if table.numeric else np.zeros((sum(c["n"] for c in cells), 0)),
        read("cat", "<i4", len(table.categorical)) if table.categorical else np.zeros((sum(c["n"] for c in cells), 0), np.int32),
        read("y", "<i4", 0), read("fold", "<i4", 0), read("h", "<i8", 0),
    )


def _codes(table: Table, layout: trees.Layout, fit: Fit, rows: Rows) -> np.ndarray:
    """Histogram cell of each cell; a missing number is the median of the fit's rows."""
    out = np.empty((len(rows.y), len(layout.sizes)), np.int64)
    for i, c in enumerate(table.numeric):
        x = rows.num[:, i]
        out[:, i] = np.searchsorted(table.edges[i], np.where(np.isnan(x), _median(fit, c), x), side="left") + layout.starts[i]
    for i in range(len(table.categorical)):
        out[:, len(table.numeric) + i] = rows.cat[:, i] + layout.starts[len(table.numeric) + i]
    return out


def _median(fit: Fit, column: str) -> float:
    """A column without values in the fit's rows is 0 throughout."""
    return fit.encoder["numeric"].get(column, {"median": 0.0})["median"]


def _dense(table: Table, fit: Fit, rows: Rows) -> np.ndarray:
    """Inputs of a linear model: scaled numbers, then a mark per category but the first, then 1."""
    cells = []
    for i, c in enumerate(table.numeric):
        f = fit.encoder["numeric"].get(c)
        if f is None:
            cells.append(np.zeros(len(rows.y)))
            continue
        spread = f["std"] if f["std"] > 1e-12 * max(1.0, abs(f["mean"])) else 1.0
        x = rows.num[:, i]
        cells.append((np.where(np.isnan(x), f["median"], x) - f["mean"]) / spread)
    for i, (c, values) in enumerate(zip(table.categorical, table.levels)):
        kept = set(fit.encoder["levels"].get(c, []))
        cells += [(rows.cat[:, i] == k).astype(float) for k, v in enumerate(values) if v in kept]
    return np.array([*cells, np.ones(len(rows.y))]).T


def _used(fit: Fit, rows: Rows) -> np.ndarray:
    return np.ones(len(rows.y), bool) if fit.fold is None else rows.fold != fit.fold


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


# --- boosted trees ----------------------------------------------------------


@dataclass
class Boosting:
    """Trees so far, the tree that grows, and the margin to begin with."""

    fit: Fit
    start: float
    trees: list[trees.Tree] = field(default_factory=list)
    stored: int = 0

    def __post_init__(self):
        self.tree = self._next()

    def _next(self) -> trees.Tree | None:
        if len(self.trees) == self.fit.params.get("n_estimators", 100):
            return None
        return trees.Tree(len(self.trees), self.fit.params.get("max_depth") or DEEPEST, self.fit.params.get("min_samples_leaf", 1))

    def values(self, tree: trees.Tree) -> np.ndarray:
        """What each node adds to the margin: a Newton step, shortened by the learning rate."""
        step = [s[1] / max(s[2], 1e-9) if s else 0.0 for s in tree.sums]
        return self.fit.params.get("learning_rate", 0.1) * np.array(step)

    def weights(self, rows: Rows, margin: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Rows of this round, and their counts, residuals and curvatures in whole units."""
        use = _used(self.fit, rows)
        share, at = self.fit.params.get("subsample", 1.0), (self.fit.seed, len(self.trees))
        if share < 1:
            if at not in rows.drawn:  # fits of one seed draw alike
                rows.drawn = {at: trees.uniform(rows.h, *at)}
            use = use & (rows.drawn[at] < share)
        p = _sigmoid(margin)
        return use, [use.astype(float), np.rint((rows.y - p) * trees.UNIT) * use, np.rint(p * (1 - p) * trees.UNIT) * use]

    def advance(self) -> trees.Tree | None:
        """Keep the finished tree and begin the next."""
        done = self.tree
        self.trees.append(done)
        self.tree = self._next()
        return done

    def margin(self, layout: trees.Layout, codes: np.ndarray, margin: np.ndarray) -> np.ndarray:
        columns = np.ascontiguousarray(_narrow(codes - layout.starts).T)
        for t in self.trees:
            margin = margin + self.values(t)[_place(t, layout, columns)]
        return margin


def _start(positives: int, n: int) -> float:
    share = min(max(positives / max(n, 1), 1e-6), 1 - 1e-6)
    return float(np.log(share / (1 - share)))


def _boost_here(table: Table, fit: Fit, rows: Rows) -> Boosting:
    layout = table.layout
    codes, use = _codes(table, layout, fit, rows), _used(fit, rows)
    state = Boosting(fit, _start(int(rows.y[use].sum()), int(use.sum())))
    margin = np.full(len(rows.y), state.start)
    while state.tree is not None:
        picked, weights = state.weights(rows, margin)
        trees.grown(state.tree, layout, codes[picked], [w[picked] for w in weights], trees.UNIT)
        done = state.advance()
        margin = margin + state.values(done)[done.route(layout, codes)]
    return state


# --- forests ----------------------------------------------------------------


def _forest_trees(fit: Fit, layout: trees.Layout) -> list[trees.Tree]:
    depth = fit.params.get("max_depth") or DEEPEST
    sampled = max(1, int(np.sqrt(layout.outputs)))
    return [
        trees.Tree(int(trees.mixed(np.array([fit.seed * 1_000_003 + k], np.uint64))[0]), depth, fit.params.get("min_samples_leaf", 1), sampled)
        for k in range(fit.params.get("n_estimators", 100))
    ]


def _forest_weights(fit: Fit, k: int, rows: Rows) -> np.ndarray:
    """How often a row is in tree ``k``'s sample; fits of one seed draw alike."""
    use = _used(fit, rows)
    if not fit.params.get("bootstrap", True):
        return use.astype(np.uint8)
    at = fit.seed, k
    if at not in rows.drawn:
        rows.drawn[at] = trees.poisson(trees.uniform(rows.h, fit.seed, 7_000_000 + k))
    return rows.drawn[at] * use


def _forest_here(table: Table, fit: Fit, rows: Rows) -> list[trees.Tree]:
    layout = table.layout
    codes, out = _codes(table, layout, fit, rows), _forest_trees(fit, layout)
    for k, tree in enumerate(out):
        w = _forest_weights(fit, k, rows)
        here = w > 0
        trees.grown(tree, layout, codes[here], [w[here], w[here] * rows.y[here]], 1.0)
        rows.drawn.clear()
    return out


def _leaf_shares(tree: trees.Tree | trees.Grown) -> np.ndarray:
    if isinstance(tree, trees.Grown):
        return tree.totals[:, 1] / np.maximum(tree.totals[:, 0], 1)
    return np.array([s[1] / max(s[0], 1) if s else 0.0 for s in tree.sums])


# --- logistic regression ----------------------------------------------------


@dataclass
class Newton:
    """Weights by Newton steps on the summed loss; an l1 or l2 penalty weighed by 1 / C spares the intercept."""

    fit: Fit
    w: np.ndarray
    best: float = np.inf
    old: np.ndarray | None = None
    left: int = 0

    def __post_init__(self):
        self.left = self.fit.params.get("max_iter", 100)

    def sums(self, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        m = x @ self.w
        p = _sigmoid(m)
        loss = float((np.logaddexp(0, m) - y * m).sum())
        return loss, x.T @ (p - y), (x * (p * (1 - p))[:, None]).T @ x

    def _penalty(self, w: np.ndarray) -> float:
        each = np.abs(w[:-1]).sum() if self.fit.params.get("penalty", "l2") == "l1" else 0.5 * (w[:-1] ** 2).sum()
        return float(each) / self.fit.params.get("C", 1.0)

    def step(self, loss: float, gradient: np.ndarray, curve: np.ndarray) -> None:
        """The next weights; a step that made things worse is halved instead."""
        total = loss + self._penalty(self.w)
        self.left -= 1
        if total > self.best + 1e-12 * abs(self.best):
            self.w = (self.w + self.old) / 2
            if np.abs(self.w - self.old).max() < SMALLEST_STEP:
                self.left = 0
            return
        self.best, self.old = total, self.w
        self.w = self._solved(gradient, curve)
        if np.abs(self.w - self.old).max() < SMALLEST_STEP:
            self.left = 0

    def _solved(self, gradient: np.ndarray, curve: np.ndarray) -> np.ndarray:
        """Least point of the quadratic model with the penalty; for l1 by coordinate descent."""
        size, weight = len(self.w), 1 / self.fit.params.get("C", 1.0)
        curve = curve + 1e-9 * np.eye(size) * max(1.0, float(np.trace(curve)) / size)
        if self.fit.params.get("penalty", "l2") != "l1":
            ridge = weight * np.diag([*[1.0] * (size - 1), 0.0])
            return self.w - np.linalg.solve(curve + ridge, gradient + ridge @ self.w)
        new, slope = self.w.copy(), gradient.copy()
        for _ in range(1000):
            most = 0.0
            for j in range(size):
                z = new[j] - slope[j] / curve[j, j]
                z = np.sign(z) * max(abs(z) - weight / curve[j, j], 0.0) if j < size - 1 else z
                if z != new[j]:
                    slope += curve[:, j] * (z - new[j])
                    most, new[j] = max(most, abs(z - new[j])), z
            if most < SMALLEST_STEP / 10:
                break
        return new


def _linear_here(table: Table, fit: Fit, rows: Rows) -> Newton:
    use = _used(fit, rows)
    x, y = _dense(table, fit, rows)[use], rows.y[use]
    state = Newton(fit, np.zeros(x.shape[1]))
    while state.left > 0:
        state.step(*state.sums(x, y))
    return state


# --- probabilities ----------------------------------------------------------


def _probabilities(table: Table, fit: Fit, made, rows: Rows) -> np.ndarray:
    if fit.name == "logistic_regression":
        return _sigmoid(_dense(table, fit, rows) @ (made.w if made.old is None else made.old))
    layout = table.layout
    codes = _codes(table, layout, fit, rows)
    if fit.name == "gradient_boosting":
        return _sigmoid(made.margin(layout, codes, np.full(len(rows.y), made.start)))
    total = np.zeros(len(rows.y))
    for tree in made:
        total += _leaf_shares(tree)[tree.route(layout, codes)]
    return total / max(len(made), 1)


#: The candidates that can be trained.
CANDIDATES = ("logistic_regression", "random_forest", "gradient_boosting")
_HERE = {"logistic_regression": _linear_here, "random_forest": _forest_here, "gradient_boosting": _boost_here}
_OUT = "slot int, made binary, tn bigint, fp bigint, fn bigint, tp bigint"


def _counts(table: Table, fit: Fit, made, rows: Rows) -> list[int]:
    """Confusion counts of the rows left out."""
    out = ~_used(fit, rows)
    held = Rows(*(x[out] for x in (rows.num, rows.cat, rows.y, rows.fold, rows.h)))
    hit = _probabilities(table, fit, made, held) >= fixed.DECISION_THRESHOLD if out.any() else np.zeros(0, bool)
    return [int(((held.y == y) & (hit == h)).sum()) for y, h in ((0, False), (0, True), (1, False), (1, True))]


def _bare(table: Table) -> Table:
    return Table(table.numeric, table.categorical, table.edges, table.levels, table.rows)


def _in_tasks(table: Table, fits: Sequence[Fit]) -> dict[int, tuple[Any, list[int]]]:
    """Every fit in a task of its own. The rows are ``TASK_ROWS`` at most."""
    bare, by_slot = _bare(table), {f.slot: f for f in fits}

    def run(part: pa.Table) -> pa.Table:
        fit = by_slot[part.column("slot")[0].as_py()]
        rows = _rows(bare, sorted(part.to_pylist(), key=lambda c: c["h"]))
        made = _HERE[fit.name](bare, fit, rows)
        counts = _counts(bare, fit, made, rows)
        kept = pickle.dumps(made) if fit.fold is None else b""
        return pa.table({"slot": pa.array([fit.slot], pa.int32()), "made": pa.array([kept], pa.binary()), **{n: pa.array([c], pa.int64()) for n, c in zip(("tn", "fp", "fn", "tp"), counts)}})

    each = table.blocks.withColumn("slot", F.explode(F.array(*[F.lit(s) for s in by_slot])))
    found = each.repartition(3 * len(fits), "slot").groupBy("slot").applyInArrow(run, _OUT).collect()
    return {r["slot"]: (pickle.loads(r["made"]) if r["made"] else None, [r["tn"], r["fp"], r["fn"], r["tp"]]) for r in found}


# --- level by level ---------------------------------------------------------


def _levels(table: Table, fits: Sequence[Fit]) -> dict[int, tuple[Any, list[int]]]:
    """Every step of every fit is a sum over the blocks."""
    bare, layout = _bare(table), table.layout
    made: dict[int, Any] = {}
    totals = _summed(table, {f.slot: f for f in fits}, lambda fit, rows: [np.array([_used(fit, rows).sum(), rows.y[_used(fit, rows)].sum()], np.int64)])
    boosts = {f.slot: Boosting(f, _start(int(totals[f.slot][0][1]), int(totals[f.slot][0][0]))) for f in fits if f.name == "gradient_boosting"}
    if boosts:
        _boost(table, bare, layout, boosts)
    made |= boosts
    forests = {f.slot: (f, _forest_trees(f, layout)) for f in fits if f.name == "random_forest"}
    left_out = _grow_forests(table, bare, layout, forests) if forests else {}
    made |= {k: own for k, (_, own) in forests.items()}
    lines = {f.slot: Newton(f, np.zeros(_width(table, f))) for f in fits if f.name == "logistic_regression"}
    while open_ := {k: s for k, s in lines.items() if s.left > 0}:
        sums = _summed(table, open_, lambda s, rows: _newton_sums(bare, s, rows))
        for slot, state in open_.items():
            state.step(float(sums[slot][0][0]), *sums[slot][1:])
    made |= lines
    by_slot = {f.slot: f for f in fits if f.slot not in forests}
    counts = _summed(table, by_slot, lambda fit, rows: [np.array(_counts(bare, fit, made[fit.slot], rows), np.int64)]) if by_slot else {}
    return {f.slot: (made[f.slot], left_out[f.slot] if f.slot in forests else counts[f.slot][0].tolist()) for f in fits}


def best_splits_of(layout: trees.Layout, tree: trees.Tree, sums: list[np.ndarray], unit: float) -> tuple[np.ndarray, ...]:
    return trees.best_splits(layout, sums[0], unit, tree.least, tree.allowed(layout.outputs, tree.frontier))


def _width(table: Table, fit: Fit) -> int:
    return len(table.numeric) + sum(len(set(fit.encoder["levels"].get(c, [])) & set(v)) for c, v in zip(table.categorical, table.levels)) + 1


def _newton_sums(table: Table, state: Newton, rows: Rows) -> list[np.ndarray]:
    use = _used(state.fit, rows)
    loss, gradient, curve = state.sums(_dense(table, state.fit, rows)[use], rows.y[use])
    return [np.array([loss]), gradient, curve]


def _packed(arrays: list[np.ndarray]) -> bytes:
    return pickle.dumps(arrays)


def _summed(table: Table, states: Mapping[int, Any], sums, most: int = 1) -> dict[int, list[np.ndarray]]:
    """``sums(state, rows)``, a list of arrays, added up over all blocks for each state: in tasks, then per state.
    Blocks are joined up to ``most`` rows."""
    bare, states = _bare(table), dict(states)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[np.ndarray]] = {}
        for piece in _pieces((cell for batch in batches for cell in batch.to_pylist()), most):
            rows = _rows(bare, piece)
            for slot, state in states.items():
                got = sums(state, rows)
                found[slot] = [a + b for a, b in zip(found[slot], got)] if slot in found else got
        if found:
            yield pa.record_batch([pa.array(list(found), pa.int32()), pa.array([_packed(v) for v in found.values()], pa.binary())], ["slot", "sums"])

    def whole(piece: pa.Table) -> pa.Table:
        parts = [pickle.loads(x) for x in piece.column("sums").to_pylist()]
        total = [np.sum(np.array(x), axis=0) for x in zip(*parts)]
        return pa.table({"slot": piece.column("slot").slice(0, 1), "sums": pa.array([_packed(total)], pa.binary())})

    schema = "slot int, sums binary"
    found = table.blocks.mapInArrow(part, schema).groupBy("slot").applyInArrow(whole, schema).collect()  # a row a state
    return {r["slot"]: pickle.loads(r["sums"]) for r in found}


def _boost(table, bare, layout, boosts: dict[int, Boosting]) -> None:
    """All rounds of all fits, a job a level. Every job makes the round's margins from the last ones held and the trees
    since then, draws the rows again, and counts one of two siblings: the other's sums are what the parent's leave."""
    spark = table.blocks.sparkSession
    context, fits = spark.sparkContext, {slot: s.fit for slot, s in boosts.items()}
    pieces = max(1, min(context.defaultParallelism, -(-table.rows // BLOCK_ROWS)))

    def first(cells) -> Iterator[dict]:
        for piece in _pieces((cell.asDict() for cell in cells), PIECE_ROWS):
            rows = _rows(bare, piece)
            columns, known = {}, [[] for _ in layout.sizes]
            for slot, fit in fits.items():
                bins = np.ascontiguousarray(_narrow(_codes(bare, layout, fit, rows) - layout.starts).T)
                columns[slot] = [_shared(x, own) for x, own in zip(bins, known)]
            yield {"rows": Rows(rows.num[:, :0], rows.cat[:, :0], _narrow(rows.y), _narrow(rows.fold), rows.h), "columns": columns, "margin": {}}

    def margin_of(slot: int, s: Boosting, block: dict, columns: np.ndarray) -> np.ndarray:
        margin = block["margin"].get(slot)
        if margin is None:
            margin = np.full(len(block["rows"].y), s.start)
        for t in s.trees[s.stored :]:
            margin = margin + s.values(t)[_place(t, layout, columns)]
        return margin

    def begun(states: dict[int, Boosting]):
        def run(blocks) -> Iterator[dict]:
            for block in blocks:
                stacked = {slot: _stacked(block["columns"][slot], slice(None), len(block["rows"].y)) for slot in states}
                yield {**block, "margin": {slot: margin_of(slot, s, block, stacked[slot]) for slot, s in states.items()}}

        return run

    def level(states: dict[int, Boosting], asked: dict[int, tuple[trees.Tree, list[int]]]):
        def run(blocks) -> Iterator[dict[int, np.ndarray]]:
            total: dict[int, np.ndarray] = {}
            for block in blocks:
                rows = replace(block["rows"], drawn={})
                for slot, (tree, nodes) in asked.items():
                    s, columns = states[slot], _stacked(block["columns"][slot], slice(None), len(rows.y))
                    use, (_, *weights) = s.weights(rows, margin_of(slot, s, block, columns))
                    place = np.full(len(tree.split), -1)
                    place[nodes] = np.arange(len(nodes))
                    node = place[_place(tree, layout, columns)]
                    here = np.flatnonzero(use & (node >= 0))
                    hist = trees.joint_histogram(layout, [c[here] for c in layout.joint(columns)], node[here], len(nodes), [None, *[w[here] for w in weights]])
                    total[slot] = total[slot] + hist if slot in total else hist
            yield total

        return run

    made = table.blocks.repartition(pieces).rdd.mapPartitions(first)
    held: list[RDD] = []
    context.setCheckpointDir(sizing.shared_dir(spark))
    round_ = 0
    while open_ := {slot: s for slot, s in boosts.items() if s.tree is not None}:
        if round_ % ROUNDS_HELD == 0:
            made = made.mapPartitions(begun(_only_last(open_))).persist(StorageLevel.MEMORY_AND_DISK)
            if round_ % ROUNDS_KEPT == 0:
                made.checkpoint()
            for s in open_.values():
                s.stored = len(s.trees)
        known: dict[int, dict[int, np.ndarray]] = {slot: {} for slot in open_}
        while growing := {slot: s for slot, s in open_.items() if s.tree.growing}:
            asked = {slot: (s.tree, _asked(s.tree, known[slot])) for slot, s in growing.items()}
            parts = made.mapPartitions(level(_only_last(growing), asked)).collect()  # a histogram a level and task
            for slot, s in growing.items():
                known[slot] = _grow(layout, s.tree, known[slot], asked[slot][1], np.sum([p[slot] for p in parts if slot in p], axis=0), trees.UNIT)
        for s in open_.values():
            s.advance()
        for old in held:
            if old is not made:
                old.unpersist()
        held, round_ = [made], round_ + 1
    for old in held:
        old.unpersist()


def _pieces(cells, most: int) -> Iterator[list[dict]]:
    """Neighbouring blocks, so many that they have ``most`` rows or a little more."""
    piece, n = [], 0
    for cell in cells:
        piece.append(cell)
        n += cell["n"]
        if n >= most:
            yield piece
            piece, n = [], 0
    if piece:
        yield piece


def _siblings(tree: trees.Tree, known) -> dict[int, tuple[int, int]]:
    """Nodes of the frontier whose sums follow from their parent's (it is ``known``) and their sibling's, which has no more rows."""
    out, open_ = {}, set(tree.frontier)
    for parent in known:
        child = tree.child[parent]
        if child >= 0:
            less, more = sorted((child, child + 1), key=lambda i: tree.sums[i][0])
            if more in open_:
                out[more] = parent, less
    return out


def _asked(tree: trees.Tree, known) -> list[int]:
    """The nodes whose rows are counted so that the sums of the whole frontier are known."""
    follows = _siblings(tree, known)
    return sorted({i for i in tree.frontier if i not in follows} | {other for _, other in follows.values()})


def _grow(layout: trees.Layout, tree: trees.Tree, known, asked: list[int], hist: np.ndarray, unit: float) -> dict[int, np.ndarray]:
    """Grow a level from the sums of the nodes asked for; gives the sums of each node of the frontier."""
    found = dict(zip(asked, hist.swapaxes(0, 1)))
    for node, (parent, other) in _siblings(tree, known).items():
        found[node] = known[parent] - found[other]
    frontier = {i: found[i] for i in tree.frontier}
    tree.grow(*best_splits_of(layout, tree, [np.array(list(frontier.values())).swapaxes(0, 1)], unit))
    return frontier


def _shared(x: np.ndarray, known: list[np.ndarray]) -> np.ndarray:
    """The array of ``known`` that equals ``x``, which joins them if there is none: equal columns of fits are kept once."""
    for other in known:
        if other.dtype == x.dtype and np.array_equal(other, x):
            return other
    known.append(x)
    return x


def _stacked(columns: list[np.ndarray], rows, n: int) -> np.ndarray:
    """``n`` rows of the columns (features x rows)."""
    return np.array([x[rows] for x in columns], None if columns else np.uint8).reshape(len(columns), n)


def _only_last(states: dict[int, Boosting]) -> dict[int, Boosting]:
    """The states with the trees that their stored margins lack; the others stay as places."""
    return {slot: replace(s, trees=[None] * s.stored + s.trees[s.stored :]) for slot, s in states.items()}


def _place(tree: trees.Tree, layout: trees.Layout, columns: np.ndarray) -> np.ndarray:
    """The node of each row in a tree, from bin numbers (features x rows)."""
    if len(tree.split) <= SMALL_TREE:
        return trees.placed(tree, layout, columns)
    return tree.route(layout, columns.T + layout.starts)


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest type that holds them."""
    return x.astype(np.result_type(np.min_scalar_type(x.min()), np.min_scalar_type(x.max()))) if x.size else x.astype(np.uint8)


def _grow_forests(table, bare, layout, forests) -> dict[int, list[int]]:
    """Grow every tree and give the confusion counts of the rows left out.

    Nodes above ``TASK_ROWS`` are grown level by level, those below each in one task, from its rows. A fold's
    trees stay in those tasks; the trees of a whole fit take their places in ``forests``.
    """
    small: dict[int, list[list[int]]] = {slot: [[] for _ in own] for slot, (_, own) in forests.items()}
    sizes = _summed(table, forests, lambda s, rows: [np.array([_forest_weights(s[0], k, rows).sum() for k in range(len(s[1]))], np.int64)])
    for slot, (_, own) in forests.items():
        for k, tree in enumerate(own):
            if sizes[slot][0][k] <= TASK_ROWS:
                small[slot][k], tree.frontier = [0], []

    def sums(state, rows: Rows) -> list[np.ndarray]:
        fit, own = state
        columns, out = np.ascontiguousarray(_narrow(_codes(bare, layout, fit, rows) - layout.starts).T), []
        joint = layout.joint(columns)
        for k, tree, nodes in own:
            w = _forest_weights(fit, k, rows)
            place = np.full(len(tree.split), -1)
            place[nodes] = np.arange(len(nodes))
            node = place[_place(tree, layout, columns)]
            here = np.flatnonzero((node >= 0) & (w > 0))
            used = w[here].astype(np.int64)
            out.append(trees.joint_histogram(layout, [c[here] for c in joint], node[here], len(nodes), [used, used * rows.y[here]]))
        return out

    known: dict[tuple[int, int], dict[int, np.ndarray]] = {}
    while open_ := {slot: (fit, [(k, t, _asked(t, known.get((slot, k), {}))) for k, t in enumerate(own) if t.growing]) for slot, (fit, own) in forests.items() if any(t.growing for t in own)}:
        found = _summed(table, open_, sums, PIECE_ROWS)
        before, known = known, {}
        for slot, (_, own) in open_.items():
            for (k, tree, nodes), hist in zip(own, found[slot]):
                known[slot, k] = _grow(layout, tree, before.get((slot, k), {}), nodes, hist, 1.0)
                small[slot][k] += [i for i in tree.frontier if tree.sums[i][0] <= TASK_ROWS]
                tree.frontier = [i for i in tree.frontier if tree.sums[i][0] > TASK_ROWS]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for piece in _pieces((cell for batch in batches for cell in batch.to_pylist()), BLOCK_ROWS):
            rows, block = _rows(bare, piece), block + 1
            for slot, (fit, own) in forests.items():
                short, y, out = _narrow(_codes(bare, layout, fit, rows) - layout.starts), _narrow(rows.y), np.flatnonzero(~_used(fit, rows))
                bins = np.ascontiguousarray(short.T)
                for k, tree in enumerate(own):
                    at, w = _place(tree, layout, bins), _narrow(_forest_weights(fit, k, rows))
                    drawn, found = np.flatnonzero(w), []
                    for node in small[slot][k]:
                        mine, asked = drawn[at[drawn] == node], out[at[out] == node]
                        found.append((node, [short[mine], w[mine], y[mine], short[asked], y[asked], _narrow(asked)]))
                    ended = out[~np.isin(at[out], small[slot][k])]  # in a leaf already
                    if len(ended):
                        found.append((-1, [_leaf_shares(tree)[at[ended]], y[ended], _narrow(ended)]))
                    if found:
                        columns = [[slot] * len(found), [k] * len(found), [n for n, _ in found], [block] * len(found), [_packed(x) for _, x in found]]
                        yield pa.record_batch([pa.array(x, f.type) for x, f in zip(columns, sent)], schema=sent)

    def finish(piece: pa.Table) -> pa.Table:
        slot, k, node = (piece.column(c)[0].as_py() for c in ("slot", "tree", "node"))
        fit, own = forests[slot]
        blocks, parts = piece.column("block").to_pylist(), [pickle.loads(x) for x in piece.column("rows").to_pylist()]
        if node >= 0:
            codes, w, y = (np.concatenate(x) for x in list(zip(*parts))[:3])
            top = own[k]
            tree = trees.Tree(top.keys[node], top.depth, top.least, top.sampled, level=_level(top, node))
            w = w.astype(np.int64)
            done = trees.grown_arrays(tree, layout, np.ascontiguousarray(codes.T), [w, w * y], 1.0)
            if fit.fold is None:
                blocks, parts = [-1], [done]
            else:
                share = _leaf_shares(done)
                parts = [[share[done.route(layout, p[3] + layout.starts)], p[4], p[5]] for p in parts]
        columns = [[slot] * len(parts), [k] * len(parts), [node] * len(parts), blocks, [pickle.dumps(p) for p in parts]]
        return pa.table([pa.array(x, f.type) for x, f in zip(columns, sent)], schema=sent)

    def count(piece: pa.Table) -> pa.Table:
        """A block's rows left out of a fit: shares are added in the order of the trees."""
        shares = [pickle.loads(x) for x in piece.sort_by("tree").column("rows").to_pylist()]
        size = max(int(at.max()) + 1 if len(at) else 0 for _, _, at in shares)
        total, label = np.zeros(size), np.full(size, -1)
        for share, y, at in shares:
            total[at] += share
            label[at] = y
        hit = total / max(len(forests[piece.column("slot")[0].as_py()][1]), 1) >= fixed.DECISION_THRESHOLD
        counts = {n: [int(((label == y) & (hit == h)).sum())] for n, y, h in (("tn", 0, False), ("fp", 0, True), ("fn", 1, False), ("tp", 1, True))}
        return pa.table({"slot": piece.column("slot").slice(0, 1), **{n: pa.array(v, pa.int64()) for n, v in counts.items()}})

    sent = pa.schema([("slot", pa.int32()), ("tree", pa.int32()), ("node", pa.int32()), ("block", pa.int64()), ("rows", pa.binary())])
    schema, by = "slot int, tree int, node int, block bigint, rows binary", ["slot", "tree", "node"]
    groups = sum(len(nodes) for own in small.values() for nodes in own)
    grown = table.blocks.mapInArrow(send, schema).repartition(groups // 8 + 1, *by).groupBy(*by).applyInArrow(finish, schema)
    grown = sizing.cut_lineage(grown, "grown")
    whole: dict[int, list[dict]] = {slot: [{} for _ in own] for slot, (_, own) in forests.items()}
    for r in grown.where("block < 0").collect():  # the nodes of the models
        whole[r["slot"]][r["tree"]][r["node"]] = pickle.loads(r["rows"])
    cells = "slot int, tn bigint, fp bigint, fn bigint, tp bigint"
    tested = grown.where("block >= 0").groupBy("slot", "block").applyInArrow(count, cells)
    counts = {slot: [0] * 4 for slot in forests}
    for r in tested.groupBy("slot").agg(*[F.sum(n).alias(n) for n in ("tn", "fp", "fn", "tp")]).collect():  # a row a fit
        counts[r["slot"]] = [r["tn"], r["fp"], r["fn"], r["tp"]]
    for slot, (fit, own) in forests.items():
        forests[slot] = fit, [trees.joined(t, sub) for t, sub in zip(own, whole[slot])] if fit.fold is None else None
    return counts


def _level(tree: trees.Tree, node: int) -> int:
    parent = {c + side: i for i, c in enumerate(tree.child) if c >= 0 for side in (0, 1)}
    level = 0
    while node in parent:
        node, level = parent[node], level + 1
    return level


def run(table: Table, fits: Sequence[Fit]) -> dict[int, tuple[Any, list[int]]]:
    """By slot: what was fitted (None for folds, if they ran in tasks), and confusion counts of the rows left out."""
    wide = [f.name for f in fits if f.name == "logistic_regression" and _width(table, f) > WIDEST]
    if wide:
        raise ValueError(f"a logistic regression of more than {WIDEST} outputs")
    return _in_tasks(table, fits) if table.rows <= TASK_ROWS else _levels(table, fits)


# --- the fitted model -------------------------------------------------------


def fitted_model(table: Table, fit: Fit, made) -> GridModel:
    """The model of a fit over all rows, on the outputs of the fit's encoder."""
    if fit.name == "logistic_regression":
        w = made.w if made.old is None else made.old
        state = {"kind": "linear", "weights": w[:-1].tolist(), "intercept": float(w[-1])}
    else:
        layout = table.layout
        at = np.array([table.edges[f][c - layout.starts[f]] if o else 0.5 for f, c, o in zip(layout.feature, layout.cut, layout.ordered)])
        forest = fit.name == "random_forest"
        own = made if forest else made.trees
        value = _leaf_shares if forest else made.values
        cells = {"output": [], "at": [], "child": [], "value": [], "gain": []}
        for t in own:
            split = np.array(t.split)
            cells["output"].append(np.where(split < 0, -1, layout.output[np.maximum(split, 0)] if len(layout.output) else -1))
            cells["at"].append(np.where(split < 0, 0.0, at[np.maximum(split, 0)] if len(at) else 0.0))
            cells["child"].append(np.array(t.child))
            cells["value"].append(value(t))
            cells["gain"].append(np.array(t.gain))
        kinds = {"output": "<i4", "at": "<f8", "child": "<i4", "value": "<f8", "gain": "<f8"}
        text = lambda x: base64.b64encode(x.tobytes()).decode()
        state = {"kind": "forest" if forest else "boosted", "start": 0.0 if forest else made.start, "outputs": layout.outputs, "sizes": [len(t.split) for t in own]}
        state |= {k: text(np.concatenate(v).astype(kinds[k]) if v else np.zeros(0, kinds[k])) for k, v in cells.items()}
    model = GridModel()
    model._set(state=json.dumps(state))
    return model


class GridModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` of both classes to rows with ``features``."""

    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    def __init__(self):
        super().__init__()

    def _arrays(self) -> dict:
        state = json.loads(self.getOrDefault("state"))
        for name, kind in (("output", "<i4"), ("at", "<f8"), ("child", "<i4"), ("value", "<f8"), ("gain", "<f8")):
            if name in state:
                state[name] = np.frombuffer(base64.b64decode(state[name]), kind)
        return state

    def importances(self) -> np.ndarray:
        """Shares of the gain by output, a forest's trees at equal weight; coefficients of a linear model."""
        state = self._arrays()
        if state["kind"] == "linear":
            return np.array(state["weights"])
        total, done = np.zeros(state["outputs"]), 0
        for size in state["sizes"]:
            here = slice(done, done + size)
            used = state["output"][here] >= 0
            own = np.bincount(state["output"][here][used], state["gain"][here][used], state["outputs"])
            total += own / own.sum() if state["kind"] == "forest" and own.sum() else own
            done += size
        return total / total.sum() if total.sum() else total

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = self._arrays()
        if state["kind"] == "linear":
            products = F.zip_with(vector_to_array("features"), F.array(*map(F.lit, state["weights"])), lambda x, w: x * w)
            margin = F.aggregate(products, F.lit(state["intercept"]), lambda a, x: a + x)
            p = 1 / (1 + F.exp(-margin))
        else:
            p = _tree_probability(state)(vector_to_array("features"))
        return dataset.withColumn("probability", array_to_vector(F.array(1 - p, p)))


def _tree_probability(state: dict):
    @F.arrow_udf("double")
    def predict(features: Iterator[pa.Array]) -> Iterator[pa.Array]:
        begins = np.cumsum([0, *state["sizes"]])
        for cells in features:
            x = cells.flatten().to_numpy(zero_copy_only=False).reshape(len(cells), -1) if len(cells) else np.zeros((0, state["outputs"]))
            total = np.full(len(x), state["start"])
            for a, b in zip(begins, begins[1:]):
                output, at, child = state["output"][a:b], state["at"][a:b], state["child"][a:b]
                node = np.zeros(len(x), np.int64)
                moving = np.flatnonzero(child[node] >= 0)
                while len(moving):
                    here = node[moving]
                    node[moving] = child[here] + (x[moving, output[here]] > at[here])
                    moving = moving[child[node[moving]] >= 0]
                total += state["value"][a:b][node]
            yield pa.array(_sigmoid(total) if state["kind"] == "boosted" else total / max(len(state["sizes"]), 1))

    return predict
