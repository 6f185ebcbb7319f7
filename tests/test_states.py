"""Daily states against the rows they came from."""

import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwarden import fixed
from tabwarden.functions import sizing
from tabwarden.operators import profile, states

FIRST, LAST = "2024-03-02", "2024-03-08"


@pytest.fixture(scope="module")
def rows(spark):
    path = sizing.run_dir(spark, "state-rows")
    i = F.col("id")
    spark.range(90_000).select(
        F.when(i % 1000 > 0, F.timestamp_seconds(F.lit(1709251200) + (i * 7919) % (9 * 86400)).cast("timestamp_ntz")).alias("at"),
        F.when(i % 31 > 0, F.round(F.exp(F.randn(5) * 2), 3)).alias("x"), (i % 7).alias("k"), F.lit(None).cast("double").alias("none"),
        F.when(i % 13 > 0, F.concat(F.lit("v"), i % 5)).alias("c"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def in_window(rows):
    return rows.where(F.to_date("at").between(FIRST, LAST))


def test_a_window_from_states_reads_no_row_again(spark, rows):
    copy, path = sizing.run_dir(spark, "state-copy"), sizing.run_dir(spark, "states")
    rows.write.parquet(copy)
    states.store(states.daily(spark.read.parquet(copy), "at", ["x", "k", "none"], ["c"]), path)
    shutil.rmtree(copy)
    state = states.merged(states.window(spark, path, FIRST, LAST))
    got = {(r["feature"], r["stat"], r["value"]): r["number"] for r in states.report(state).collect()}
    want = {(r["feature"], r["stat"], r["value"]): r["number"] for r in profile.baseline_report(in_window(rows).drop("at")).collect()}
    assert got.keys() - want.keys() == {(f, "unique_values", None) for f in ("x", "k", "none")} and not want.keys() - got.keys()
    for key, number in want.items():
        if key[1] not in fixed.QUANTILES:
            assert got[key] == pytest.approx(number, rel=1e-9) if number is not None else got[key] is None, key
    values = {c: np.sort([r[c] for r in in_window(rows).where(f"{c} IS NOT NULL").select(c).collect()]) for c in ("x", "k")}
    for c, v in values.items():
        for name, p in fixed.QUANTILES.items():
            low, high = np.searchsorted(v, got[c, name, None], "left") / len(v), np.searchsorted(v, got[c, name, None], "right") / len(v)
            assert low - states.RANK_ERROR <= p <= high + states.RANK_ERROR + 1 / len(v), (c, name)
        assert abs(got[c, "unique_values", None] / len(set(v)) - 1) < 4 * states.DISTINCT_ERROR
    plan = states.window(spark, path, FIRST, LAST)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_a_day_that_comes_again_replaces_its_state(spark, rows):
    path = sizing.run_dir(spark, "states")
    states.store(states.daily(rows, "at", ["x"], ["c"]), path)
    states.store(states.daily(rows.where(F.to_date("at") == "2024-03-04").limit(10), "at", ["x"], ["c"]), path)
    n = {str(r["day"]): r["n"] for r in spark.read.schema(states.SCHEMA).parquet(path).where("numeric").collect()}
    assert n["2024-03-04"] == 10 and len(n) == 9 and sum(n.values()) == rows.where(F.col("at").isNotNull() & (F.to_date("at") != "2024-03-04")).count() + 10


@pytest.mark.parametrize("error", [states.RANK_ERROR, 0.0])
def test_refined_percentiles_are_exact_even_if_the_sketch_is_wrong(spark, rows, monkeypatch, error):
    state = states.merged(sizing.cut_lineage(states.daily(in_window(rows), "at", ["x", "k", "none"], []), "states"))
    monkeypatch.setattr(states, "RANK_ERROR", error)
    got = {r["feature"]: r for r in states.refined(state, in_window(rows)).collect()}
    for c in ("x", "k"):
        v = [r[c] for r in in_window(rows).where(f"{c} IS NOT NULL").select(c).collect()]
        assert [got[c][n] for n in fixed.QUANTILES] == pytest.approx([np.quantile(v, p) for p in fixed.QUANTILES.values()])
    assert got["none"]["p50"] is None


def test_no_days(spark, rows):
    with pytest.raises(profile.NoRows):
        states.report(states.merged(states.daily(rows.where("at IS NULL"), "at", ["x"], ["c"])))
