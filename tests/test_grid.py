"""The search over all fits: both ways of running it, split search by hand, Spark's own regression as a check."""

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tabwarden.functions import trees
from tabwarden.operators import grid, train

FOLDS = 3
NAMES = ["logistic_regression", "random_forest", "gradient_boosting"]
PARAMS = {
    "logistic_regression": [{"C": 0.5, "penalty": "l2", "max_iter": 50}, {"C": 0.3, "penalty": "l1", "max_iter": 50}],
    "random_forest": [{"n_estimators": 7, "max_depth": None, "min_samples_leaf": 2, "bootstrap": True}, {"n_estimators": 3, "max_depth": 4, "min_samples_leaf": 1, "bootstrap": False}],
    "gradient_boosting": [{"n_estimators": 23, "learning_rate": 0.1, "max_depth": 3, "subsample": 0.8}, {"n_estimators": 5, "learning_rate": 0.3, "max_depth": 2, "subsample": 1.0}],
}


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    out = []
    for i in range(900):
        x, z, c = rng.gauss(0, 1), rng.gauss(5, 20), rng.choice(["a", "b", "c", None])
        p = x * x + (c == "b") + z / 40 + rng.gauss(0, 0.4)
        out.append((i, x if i % 17 else None, z, c, "q" if i % 2 else "r", int(p > 1.2), i % FOLDS))
    df = spark.createDataFrame(out, "id int, x double, z double, c string, d string, y int, fold int")
    return df.repartition(5, "id").cache()


@pytest.fixture(scope="module")
def encoders(rows):
    return train.fit_encoders(rows, NAMES, ["x", "z"], ["c", "d"], "fold", FOLDS)


def fits_of(encoders):
    jobs = [(n, p, k) for n in NAMES for p in PARAMS[n] for k in (0, 2, None)]
    return [grid.Fit(slot, n, p, k, encoders[train.is_linear(n), k].fitted()) for slot, (n, p, k) in enumerate(jobs)]


def same(a, b, name):
    if name == "logistic_regression":
        return np.allclose(a.w, b.w, atol=1e-6)
    mine, others = (a, b) if name == "random_forest" else (a.trees, b.trees)
    parts = lambda t: {(t.split[i], t.sums[i]) for i in range(len(t.split))}  # noqa: E731  subtrees may hang in another order
    return len(mine) == len(others) and all(parts(s) == parts(t) and len(s.split) == len(t.split) for s, t in zip(mine, others))


def test_tasks_and_levels_give_the_same_models(rows, encoders, monkeypatch):
    table, fits = grid.store(rows, encoders[False, None], "y", "fold"), fits_of(encoders)
    here = grid.run(table, fits)
    monkeypatch.setattr(grid, "TASK_ROWS", 200)  # roots are open nodes, and most others are small
    there = grid.run(table, fits)
    for fit in fits:
        assert here[fit.slot][1] == there[fit.slot][1], fit
        assert sum(here[fit.slot][1]) == (300 if fit.fold is not None else 0)
        assert fit.fold is not None or same(here[fit.slot][0], there[fit.slot][0], fit.name), fit
    right = {(f.name, f.fold): (here[f.slot][1][0] + here[f.slot][1][3]) / 300 for f in fits if f.fold is not None and f.params == PARAMS[f.name][0]}
    assert all(right[n, 0] > 0.85 for n in NAMES[1:])


def test_trees_of_folds_stay_in_tasks_and_levels_take_one_stage(spark, rows, encoders, monkeypatch):
    table = grid.store(rows, encoders[False, None], "y", "fold")
    fits = [grid.Fit(i, n, PARAMS[n][0], k, encoders[False, k].fitted()) for i, (n, k) in enumerate([("random_forest", 0), ("random_forest", None), ("gradient_boosting", 1)])]
    monkeypatch.setattr(grid, "TASK_ROWS", 200)
    spark.sparkContext.setJobGroup("levels", "a search in levels")
    found = grid.run(table, fits)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    levels = [j for j in tracker.getJobIdsForGroup("levels") if (i := tracker.getJobInfo(j)) and len(i.stageIds) <= 2]
    assert found[0][0] is None and len(found[1][0]) == 7 and all(isinstance(t, trees.Grown) for t in found[1][0])
    assert sum(found[0][1]) == sum(found[2][1]) == 300 and len(found[2][0].trees) == 23
    assert len(levels) >= 23  # a round's levels read its kept state


def test_models_give_the_probabilities_of_their_fit(spark, rows, encoders, tmp_path):
    table, fits = grid.store(rows, encoders[False, None], "y", "fold"), [f for f in fits_of(encoders) if f.fold is None]
    found, cells = grid.run(table, fits), [r.asDict() for r in table.blocks.collect()]
    block = grid._rows(table, cells)
    for fit in fits:
        model = PipelineModel([encoders[train.is_linear(fit.name), None], grid.fitted_model(table, fit, found[fit.slot][0])])
        path = str(tmp_path / f"m{fit.slot}")
        model.save(path)
        hashed = F.xxhash64(F.col("x"), F.col("z"), F.coalesce("c", F.lit("nan")), "d", "y", "fold")
        got = {r["h"]: r["p"] for r in train.scored(PipelineModel.load(path), rows.withColumn("h", hashed), ["h"]).collect()}
        want = dict(zip(block.h.tolist(), grid._probabilities(table, fit, found[fit.slot][0], block).tolist()))
        assert got.keys() == want.keys() and all(abs(got[h] - want[h]) < 1e-9 for h in want)
        shares = {r["feature"]: r["importance"] for r in train.feature_importance(spark, model).collect()}
        assert set(shares) == {"x", "z", *(["c_b", "c_c", "c_nan", "d_r"] if train.is_linear(fit.name) else ["c_a", "c_b", "c_c", "c_nan", "d_q", "d_r"])}
        assert train.is_linear(fit.name) or (abs(sum(shares.values()) - 1) < 1e-4 and (fit.name == "random_forest" or max(shares, key=shares.get) == "x"))


@pytest.mark.parametrize("which", [0, 1])
def test_regression_agrees_with_spark(rows, encoders, which):
    params = PARAMS["logistic_regression"][which]
    fit = grid.Fit(0, "logistic_regression", params, None, encoders[True, None].fitted())
    table = grid.store(rows, encoders[False, None], "y", "fold")
    w = grid.run(table, [fit])[0][0].w
    last = LogisticRegression(labelCol="y", regParam=1 / (params["C"] * 900), elasticNetParam=float(params["penalty"] == "l1"), standardization=False, maxIter=500, tol=1e-12)
    want = last.fit(encoders[True, None].transform(rows))
    assert np.allclose(w, [*want.coefficients.toArray(), want.intercept], atol=2e-4)


def test_split_search_by_hand():
    rng = np.random.default_rng(5)
    layout = trees.Layout([4, 3, 2], 2)
    codes = np.stack([rng.integers(0, s, 60) for s in layout.sizes], axis=1)
    node, w, y = rng.integers(0, 2, 60), rng.integers(0, 3, 60), rng.integers(0, 2, 60)
    hist = trees.histogram(layout, codes + layout.starts, node, 2, [w, w * y])
    pick, gain, lefts, totals = trees.best_splits(layout, hist, 1.0, 2, None)
    for k in (0, 1):
        best = (-1.0, None)
        for s, (f, cut) in enumerate([(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (2, 0), (2, 1)]):
            right = codes[:, f] > cut if f < 2 else codes[:, f] == cut
            sums = [[(w * (node == k) * side * v).sum() for v in (1, y)] for side in (~right, right, True)]
            if min(sums[0][0], sums[1][0]) >= 2:
                value = sum(g * g / n for n, g in sums[:2]) - sums[2][1] ** 2 / sums[2][0]
                best = max(best, (value, -s), key=lambda x: (round(x[0], 12), x[1] if x[1] is not None else -99))
                if s == pick[k]:
                    assert [lefts[0][k], lefts[1][k]] == sums[0] and [totals[0][k], totals[1][k]] == sums[2]
        assert gain[k] == pytest.approx(best[0]) and pick[k] == -best[1]


def test_draws_follow_the_row():
    keys = np.arange(200_000, dtype=np.int64)
    u = trees.uniform(keys, 1, 2)
    assert np.array_equal(u[5:9], trees.uniform(keys[5:9], 1, 2)) and abs(u.mean() - 0.5) < 0.005 and not np.allclose(u, trees.uniform(keys, 1, 3))
    w = trees.poisson(u)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02


def test_what_cannot_be_searched(spark, rows, encoders):
    with pytest.raises(ValueError, match="unknown candidate"):
        train.search(rows, {"nearest_neighbours": {"k": [1]}}, encoders, "y")
    other = PipelineModel([encoders[False, None], encoders[False, None]])
    assert "not support" in train.feature_importance(spark, other).first()["message"]

    def broken():
        raise OSError("no such file")

    assert train.champion_metrics(broken, rows, "y").count() == 0


def test_joint_histograms_and_searched_splits_are_the_same():
    rng = np.random.default_rng(6)
    for sizes, numeric in (([64, 64, 40, 5, 25], 3), ([1, 3, 2], 1), ([9, 4], 2), ([70, 80], 0)):
        layout, n = trees.Layout(sizes, numeric), 3_000
        columns = np.stack([rng.integers(0, s, n) for s in sizes])
        codes, node = columns.T + layout.starts, rng.integers(0, 7, n)
        weights = [rng.integers(-(1 << 26), 1 << 26, n).astype(float), rng.integers(0, 1 << 24, n).astype(float)]
        want = trees.histogram(layout, codes, node, 7, [np.ones(n), *weights])
        assert np.array_equal(want, trees.joint_histogram(layout, layout.joint(columns.astype(np.uint8)), node, 7, [None, *weights]))
        for sampled in (0, 2):
            tree = trees.Tree(11, 6, 2, sampled)
            tree.keys = list(range(5, 12))
            allowed = tree.allowed(layout.outputs, range(7))
            best = trees.best_splits(layout, want, trees.UNIT, 2, allowed)
            got = trees.searched(layout, codes, node, 7, [np.ones(n), *weights], trees.UNIT, 2, allowed)
            split = best[0] >= 0
            assert split.any() and all(np.array_equal(a, b) for a, b in zip(best[:2], got[:2]))
            assert np.array_equal(best[2][:, split], got[2][:, split]) and np.array_equal(best[3], got[3])
        deep = trees.grown(trees.Tree(3, 6, 2), layout, codes, [np.ones(n), *weights], trees.UNIT)
        assert np.array_equal(trees.placed(deep, layout, columns.astype(np.uint8)), deep.route(layout, codes))


def test_packed_counts_and_tabled_draws_are_exact():
    rng = np.random.default_rng(8)
    u = np.concatenate([rng.random(50_000), trees._POISSON[:9], np.nextafter(trees._POISSON[:9], 0), [0.0, np.nextafter(1.0, 0)]])
    assert np.array_equal(trees.poisson(u), np.searchsorted(trees._POISSON, u, side="right"))
    layout, n = trees.Layout([6, 9, 4, 25], 2), 4_000
    columns = np.stack([rng.integers(0, s, n) for s in layout.sizes]).astype(np.uint8)
    codes, node, w = columns.T + layout.starts, rng.integers(0, 30, n), rng.integers(0, 6, n)
    weights = [w, w * rng.integers(0, 2, n)]
    assert trees.packed(weights) is not None and trees.packed([w * trees.PACKED, w]) is None and trees.packed([w, -w]) is None
    hist = trees.histogram(layout, codes, node, 30, weights)
    assert np.array_equal(hist, trees.joint_histogram(layout, layout.joint(columns), node, 30, weights))
    allowed = trees.outputs_of(np.arange(30, dtype=np.uint64), layout.outputs, 5)
    best, got = trees.best_splits(layout, hist, 1.0, 2, allowed), trees.searched(layout, codes, node, 30, weights, 1.0, 2, allowed)
    split = best[0] >= 0
    assert split.any() and all(np.array_equal(a, b) for a, b in zip(best[:2], got[:2])) and np.array_equal(best[2][:, split], got[2][:, split])
    level, at = trees.Tree(9, 7, 2, 5), np.zeros(n, np.int64)  # level by level, as nodes of many rows grow
    while level.growing:
        place = np.full(len(level.split), -1)
        place[level.frontier] = np.arange(len(level.frontier))
        here = place[at] >= 0
        sums = trees.histogram(layout, codes[here], place[at][here], len(level.frontier), [x[here] for x in weights])
        level.grow(*trees.best_splits(layout, sums, 1.0, 2, level.allowed(layout.outputs, level.frontier)))
        at = level.route(layout, codes, at)
    whole = trees.grown_arrays(trees.Tree(9, 7, 2, 5), layout, columns, weights, 1.0)
    assert len(level.split) > 50 and level.split == whole.split.tolist() and level.child == whole.child.tolist() and level.sums == whole.sums and level.gain == whole.gain.tolist()


def test_equal_columns_are_kept_once_and_margins_come_from_held_rounds(rows, encoders, monkeypatch):
    a, b, known = np.arange(5, dtype=np.uint8), np.arange(5, dtype=np.uint8), []
    assert grid._shared(a, known) is a and grid._shared(b, known) is a and grid._shared(a + 1, known) is not a and len(known) == 2
    assert grid._stacked([], slice(None), 4).shape == (0, 4) and grid._stacked([a, b], np.array([1, 3]), 2).tolist() == [[1, 3], [1, 3]]
    table = grid.store(rows, encoders[False, None], "y", "fold")
    fits = [grid.Fit(i, "gradient_boosting", p, None, encoders[False, None].fitted()) for i, p in enumerate([{"n_estimators": 4, "max_depth": 2, "subsample": 0.8}, {"n_estimators": 7, "max_depth": 3, "subsample": 0.8}])]
    monkeypatch.setattr(grid, "TASK_ROWS", 200)
    found = []
    for held in (1, 3):
        monkeypatch.setattr(grid, "ROUNDS_HELD", held)
        found.append(grid.run(table, fits))
    for fit in fits:
        one, other = (f[fit.slot][0].trees for f in found)
        assert len(one) == fit.params["n_estimators"] and [(t.split, t.sums) for t in one] == [(t.split, t.sums) for t in other]


def test_siblings_follow_from_their_parent_and_pieces_join_blocks(rows, encoders, monkeypatch):
    tree = trees.Tree(1, 3, 1)
    tree.grow(np.array([0]), np.array([1.0]), np.array([[30.0], [5.0]]), np.array([[100.0], [9.0]]))
    assert tree.frontier == [1, 2] and grid._siblings(tree, {}) == {} and grid._siblings(tree, {0: None}) == {2: (0, 1)}
    assert grid._asked(tree, {}) == [1, 2] and grid._asked(tree, {0: None}) == [1]
    tree.frontier = [2]  # of the other one all rows go to one task
    assert grid._siblings(tree, {0: None}) == {2: (0, 1)} and grid._asked(tree, {0: None}) == [1]
    tree.frontier = [1]
    assert grid._siblings(tree, {0: None}) == {} and grid._asked(tree, {0: None}) == [1]
    cells = [{"n": n} for n in (3, 4, 1, 9, 2)]
    assert [[c["n"] for c in piece] for piece in grid._pieces(cells, 5)] == [[3, 4], [1, 9], [2]] and not list(grid._pieces([], 5))
    table = grid.store(rows, encoders[False, None], "y", "fold")
    fits = [grid.Fit(i, "gradient_boosting", {"n_estimators": 6, "max_depth": d, "subsample": 0.8}, k, encoders[False, k].fitted()) for i, (d, k) in enumerate([(2, None), (4, 1), (9, None)])]
    fits += [grid.Fit(3 + i, "random_forest", {"n_estimators": 4, "min_samples_leaf": 2, "bootstrap": bool(i)}, k, encoders[False, k].fitted()) for i, k in enumerate([None, 2])]
    here = grid.run(table, fits)
    monkeypatch.setattr(grid, "TASK_ROWS", 200)
    counted = []
    monkeypatch.setattr(grid, "_siblings", lambda tree, known, real=grid._siblings: counted.append((len(tree.frontier), len(out := real(tree, known)), bool(known))) or out)
    for most in (1, 1 << 17):
        monkeypatch.setattr(grid, "PIECE_ROWS", most)
        there = grid.run(table, fits)
        assert all(here[f.slot][1] == there[f.slot][1] for f in fits) and all(same(here[f.slot][0], there[f.slot][0], f.name) for f in fits if f.fold is None)
    assert all(n <= of and (n > 0) == below for of, n, below in counted) and sum(below for *_, below in counted) > 20
