"""The training run on a small table with a known answer."""

import random

import pytest

from tabwarden import fixed
from tabwarden.operators import train
from tabwarden.operators.clean import CleanSpec
from tabwarden.operators.contract import from_dict
from tabwarden.plans import training
from tabwarden.sources import readers

GRIDS = {
    "logistic_regression": {"C": [1.0], "penalty": ["l2"], "max_iter": [20]},
    "random_forest": {"n_estimators": [5], "max_depth": [4], "min_samples_leaf": [1], "bootstrap": [True]},
}
CONTRACT = {"columns": {"x": {"expected_dtype": "floating"}, "c": {"expected_dtype": "string"}, "y": {"expected_dtype": "integer"}}}


@pytest.fixture(scope="module")
def stored(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        x = rng.gauss(0, 1)
        rows.append((i, x if i % 20 else None, rng.choice("ab"), "Yes" if x + rng.gauss(0, 0.3) > 0 else "No"))
    df = spark.createDataFrame(rows, "id bigint, x double, c string, y string")
    spec = CleanSpec(target="y", target_map={"Yes": 1, "No": 0})
    return training.prepare(df, spec, "y", ["id"], folds=3)


def test_parts_and_folds(spark, stored):
    df = spark.read.parquet(stored)
    sizes = {(r["split"], r["y"], r["fold"]): r["count"] for r in df.groupBy("split", "y", "fold").count().collect()}
    for part in ("train", "validation", "test"):
        for y in (0, 1):
            per_fold = [sizes.get((part, y, k), 0) for k in range(3)]
            assert max(per_fold) - min(per_fold) <= 1
    assert df.count() == 600


def test_run_and_champion(spark, stored):
    contract = from_dict({**CONTRACT, "dtype_mapping": {}})
    run = training.run(stored, spark, "y", GRIDS, contract=contract, folds=3, skip=["id"])
    found = {r["model"]: r for r in run.metrics.collect()}
    assert set(found) == set(GRIDS) and all(r["roc_auc"] > 0.9 for r in found.values())
    assert run.decision.first()["approved"]
    assert all(r["mean_score"] > 0.8 for r in run.cv.collect())
    best = run.candidates[0].model
    again = training.run(stored, spark, "y", GRIDS, champion=best, folds=3, skip=["id"]).decision.first()
    assert again["champion_recall"] == found["logistic_regression"]["recall"]
    test = readers.read_part(spark, stored, "test")
    assert train.champion_metrics(best, test.drop("x"), "y").count() == 0
    assert train.champion_metrics(None, test, "y").count() == 0
    names = [r["feature"] for r in train.feature_importance(spark, best).collect()]
    assert names[0] == "x" and set(names) == {"x", "c_b"}


def test_gate(spark, stored):
    rows = readers.read_part(spark, stored, "train").drop("fold", "id")
    assert training.gate(rows, from_dict(CONTRACT)).count() == 3
    wrong = {"columns": {**CONTRACT["columns"], "c": {"expected_dtype": "floating", "severity": "error"}}}
    with pytest.raises(ValueError, match="'c'"):
        training.gate(rows, from_dict(wrong))


def test_missing_target_stops_the_run(spark):
    df = spark.createDataFrame([(1, 1.0, "Yes"), (2, 2.0, "?")], "id bigint, x double, y string")
    with pytest.raises(Exception, match="target column y"):
        training.prepare(df, CleanSpec(target="y", target_map={"Yes": 1, "No": 0}), "y", ["id"])


def test_draws_are_reproducible():
    grid = fixed.PARAMETER_GRIDS["random_forest"]
    assert train.draw_parameters(grid, 3) == train.draw_parameters(grid, 3)
    assert len(train.draw_parameters({"a": [1, 2]}, 9)) == 2
    for g in fixed.PARAMETER_GRIDS.values():
        assert len(train.draw_parameters(g, 1)) == 1
