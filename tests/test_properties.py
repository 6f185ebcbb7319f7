"""Properties that hold for any input, and plans that hold at any size."""

import random
from datetime import datetime, timedelta
from multiprocessing.pool import ThreadPool

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tabwarden.functions import ordered, sizing
from tabwarden.operators import drift, encode, fingerprint, labels, metrics, percentiles, profile, registry, split, trigger, versions
from tabwarden.sources import claims


@pytest.fixture(scope="module")
def lopsided(spark):
    """One stratum holds nearly all rows."""
    rows = [(i, "big" if i % 50 else ("small" if i % 100 else None)) for i in range(3000)]
    return spark.createDataFrame(rows, "k bigint, s string").repartition(5).cache()


def parts_of(df):
    return {r["k"]: r["split"] for r in df.collect()}


def test_split_is_exact_and_stable(spark, lopsided):
    got = split.stratified_split(lopsided, "s", ["k"])
    parts = parts_of(got)
    assert len(parts) == 3000
    assert parts == parts_of(split.stratified_split(lopsided.repartition(2).orderBy("k"), "s", ["k"]))
    for row in got.groupBy("s").agg(*[F.count_if(F.col("split") == p).alias(p) for p in ("train", "validation", "test")]).collect():
        n = row["train"] + row["validation"] + row["test"]
        assert row["train"] == n * 70 // 100 and row["train"] + row["validation"] == n * 85 // 100
    assert parts != parts_of(split.stratified_split(lopsided, "s", ["k"], seed=7))


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_split_does_not_depend_on_buckets(spark, lopsided, digits):
    assert parts_of(split.stratified_split(lopsided, "s", ["k"], digits=digits)) == parts_of(split.stratified_split(lopsided, "s", ["k"]))


def test_split_with_more_strata_than_a_broadcast_holds(spark):
    df = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 40).cast("string").alias("s"))
    want = parts_of(split.stratified_split(df, "s", ["k"]))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert parts_of(split.stratified_split(df, "s", ["k"])) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_copies_of_a_key_stay_together(spark):
    df = spark.createDataFrame([(i if i < 600 else 0, "s") for i in range(900)], "k bigint, s string")
    per_key = split.stratified_split(df, "s", ["k"]).groupBy("k").agg(F.count_distinct("split").alias("n"))
    assert per_key.where("n > 1").count() == 0


def test_folds(spark, lopsided):
    sizes = split.stratified_folds(lopsided, "s", ["k"]).groupBy("s", "fold").count().groupBy("s").agg(
        (F.max("count") - F.min("count")).alias("gap"), F.count(F.lit(1)).alias("folds")
    )
    assert all(r["gap"] <= 1 and r["folds"] == 5 for r in sizes.collect())


def test_fingerprint(spark):
    df = spark.createDataFrame([("a", None), ("ab", 1), ("b", 2)], "t string, n int")
    same = fingerprint.fingerprint(df.repartition(3).orderBy(F.desc("t"))).first()
    assert fingerprint.fingerprint(df).first() == same
    moved = spark.createDataFrame([("a", None), ("a", 1), ("bb", 2)], "t string, n int")
    assert fingerprint.fingerprint(moved).first() != same
    twice = fingerprint.fingerprint(df.union(df)).first()
    assert twice["hash_xor"] == 0 and twice["n_rows"] == 6 and twice["hash_sum"] == str(2 * int(same["hash_sum"]))


@pytest.mark.parametrize("seed", range(3))
def test_percentiles_match_pandas(spark, seed, monkeypatch):
    rng = random.Random(seed)
    values = [rng.choice([5.0, rng.gauss(0, 1), float(rng.randint(0, 9)), None]) for _ in range(5000)]
    pdf = pd.DataFrame({"x": values, "y": [abs(v) ** 3 if v is not None else 1.0 for v in values]})
    df = spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in pdf.itertuples(index=False)], "x double, y double")
    # Narrow brackets already on this many rows.
    monkeypatch.setattr(percentiles, "WIDE_ROWS", 2000)
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.77, "e": 1.0}
    for row in percentiles.exact_percentiles(df, ["x", "y"], probs).collect():
        for name, p in probs.items():
            assert row[name] == pytest.approx(pdf[row["feature"]].quantile(p), abs=1e-12)


def test_summary_matches_pandas(spark):
    pdf = pd.DataFrame({"x": [1.5, 2.5, None, 9.0, 2.5]})
    df = spark.createDataFrame([(None if pd.isna(v) else v,) for v in pdf.x], "x double")
    row = profile.numeric_baseline(df, ["x"]).first()
    assert row["std"] == pytest.approx(pdf.x.std()) and row["mean"] == pdf.x.mean() and row["p25"] == pdf.x.quantile(0.25)
    want = pdf.x.astype(str).replace("nan", None).value_counts(normalize=True, dropna=False)
    got = {r["value"]: r["ratio"] for r in profile.value_distribution(df, ["x"]).collect()}
    assert got == {(None if pd.isna(k) else k): v for k, v in want.items()}


def test_grouped_distribution(spark):
    df = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "a"), (None, "a")], "g string, c string")
    got = {(r["g"], r["value"]): r["ratio"] for r in profile.value_distribution(df, ["c"], by=["g"]).collect()}
    assert got == {("g", "a"): 0.5, ("g", "b"): 0.5, ("h", "a"): 1.0, (None, "a"): 1.0}


def test_psi_properties(spark):
    df = spark.createDataFrame([(random.Random(i).choice("aabc"), i % 3 == 0) for i in range(500)], "c string, late boolean")
    one, two = (profile.value_distribution(df.where(w), ["c"]) for w in ("late", "NOT late"))
    forth, back = drift.psi(one, two).first()["score"], drift.psi(two, one).first()["score"]
    assert forth == back >= 0 and drift.psi(one, one).first()["score"] == 0
    tagged = drift.tagged_distribution(df, ["c"], F.col("late"))
    both = drift.compare_distributions(two, one)
    key = lambda rows: sorted((r["value"], r["expected"], r["actual"]) for r in rows.collect())
    assert key(tagged) == key(both)


def scores(spark, seed, hot):
    rng = random.Random(seed)
    rows = [("m" if i % 3 else "n", 0.25 if rng.random() < hot else round(rng.random() ** 4, 3), rng.randint(0, 1)) for i in range(3000)]
    return spark.createDataFrame(rows, "model string, p double, label int")


@pytest.mark.parametrize("hot", [0.0, 0.4])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_in_pieces_equal_one_window(spark, hot, descending):
    df = metrics.score_counts(scores(spark, 1, hot), ["model"])
    order = F.col("score").desc() if descending else F.col("score")
    whole = Window.partitionBy("model").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    want = sorted(map(tuple, df.withColumn("t", F.sum("pos").over(whole)).collect()))
    for buckets in (2, 64):
        got = ordered.running_totals(df, ["model"], "score", {"pos": "t"}, descending, buckets)
        assert sorted(map(tuple, got.select(*df.columns, "t").collect())) == want


def test_auc_ignores_monotone_maps(spark):
    df = scores(spark, 2, 0.1)
    key = lambda d: sorted(map(tuple, d.collect()))
    mapped = df.withColumn("p", F.col("p") * 0.5 + 0.1)
    assert key(metrics.roc_auc(df, ["model"])) == key(metrics.roc_auc(mapped, ["model"]))


def test_running_totals(spark):
    df = spark.createDataFrame([(i % 2, float((i * 37) % 101), 1) for i in range(202)], "g int, x double, n int")
    collapsed = df.groupBy("g", "x").agg(F.sum("n").alias("n"))
    key = lambda d: sorted(map(tuple, d.select("g", "x", "n", "t").collect()))
    for descending in (False, True):
        whole = ordered.running_totals(collapsed, ["g"], "x", {"n": "t"}, 1, descending)
        assert key(whole) == key(ordered.running_totals(collapsed, ["g"], "x", {"n": "t"}, 16, descending))


def test_as_of_join_matches_pandas(spark):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    # One key holds most rows, on both sides.
    make = lambda n: sorted((start + timedelta(minutes=rng.randint(0, 20000)), 1 if rng.random() < 0.8 else rng.randint(2, 9)) for _ in range(n))
    h = pd.DataFrame([(t, k, i) for i, (t, k) in enumerate(make(400))], columns=["at", "k", "v"]).drop_duplicates(["at", "k"])
    f = pd.DataFrame([(t, k, i) for i, (t, k) in enumerate(make(300))], columns=["at", "k", "id"])
    want = pd.merge_asof(f, h, on="at", by="k")
    got = labels.latest_before(
        spark.createDataFrame([(t.to_pydatetime(), k, i) for t, k, i in f.itertuples(index=False, name=None)], "at timestamp, k bigint, id bigint"),
        spark.createDataFrame([(t.to_pydatetime(), k, i) for t, k, i in h.itertuples(index=False, name=None)], "at timestamp, k bigint, v bigint"),
        ["k"], "at", "v",
    )
    assert {r["id"]: r["v"] for r in got.collect()} == {i: (None if pd.isna(v) else int(v)) for i, v in zip(want.id, want.v)}


def test_curate_prefers_new_rows(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, y int")
    new = spark.createDataFrame([("b", 0), ("c", 3)], "k string, y int")
    assert sorted(map(tuple, labels.curate(old, new, ["k"]).collect())) == [("a", 1), ("b", 0), ("c", 3)]


def test_encoder_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (None, None), (5.0, "a")], "x double, c string")
    model = encode.TabularEncoder(numericCols=["x"], categoricalCols=["c"], scale=True, dropFirst=True).fit(df)
    assert model.output_names() == ["x", "c_b", "c_nan"]
    model.save(str(tmp_path / "m"))
    loaded = encode.TabularEncoderModel.load(str(tmp_path / "m"))
    new = spark.createDataFrame([(3.0, "b"), (3.0, "zzz")], "x double, c string")
    got = [list(r["features"].toArray()) for r in loaded.transform(new).collect()]
    assert got == [[0.0, 1.0, 0.0], [0.0, 0.0, 0.0]]
    with pytest.raises(ValueError, match="missing"):
        loaded.transform(new.drop("c"))


def test_a_column_without_values_gives_no_output(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (2.0, None, "b")], "x double, y double, c string")
    model = encode.TabularEncoder(numericCols=["x", "y"], categoricalCols=["c"]).fit(df)
    assert model.output_names() == ["x", "c_a", "c_b"]
    assert [list(r["features"].toArray()) for r in model.transform(df).collect()] == [[1.0, 1.0, 0.0], [2.0, 0.0, 1.0]]


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert encode.impute_and_scale(df, ["x"], encode.fit_numeric(df, ["x"])).first()["x"] == 0.0


def test_registry(spark, tmp_path):
    empty = registry.empty(spark)
    names = spark.createDataFrame([("m",)], "name string")
    assert registry.next_version(empty, names).first()["next_version"] == "v1"
    rows = [("m", "v9", True, None, None, None, None, None), ("m", "v10", False, None, None, None, None, None)]
    some = spark.createDataFrame(rows, registry.SCHEMA)
    assert registry.next_version(some).first()["next_version"] == "v11"
    with pytest.raises(ValueError, match="already registered"):
        registry.refuse_existing(some, some)
    assert registry.pointer(some).first()["version"] == "v9"
    base = spark.createDataFrame([("f", 1.0)], "feature string, number double")
    registry.store_artifact(base, str(tmp_path / "b"), "m", "v9")
    assert registry.load_artifact(str(tmp_path / "b"), registry.pointer(some)).count() == 1
    with pytest.raises(ValueError, match="no stored artifact"):
        registry.load_artifact(str(tmp_path / "b"), registry.pointer(some).withColumn("name", F.lit("x")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_row_level_window_over_one_partition(spark, sf):
    for name in ("stratified_split", "psi_by_feature", "baseline_numeric", "class_metrics", "labelled_predictions", "dataset_fingerprint"):
        text = plan(contract.queries()[name](spark, sf))
        assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text, name
        assert "Python" not in text, name


def test_split_does_not_shuffle_rows(spark, sf):
    assert "Exchange hashpartitioning" not in plan(contract.queries()["stratified_split"](spark, sf))


def test_scans_read_only_what_they_need(spark, sf):
    window = plan(contract.queries()["scan_window_flatten"](spark, sf))
    assert "GreaterThanOrEqual(ts" in window and "LessThan(ts" in window and "user_id" not in window
    assert "text:string" not in plan(contract.queries()["confusion_by_model"](spark, sf))


def test_encoder_holds_many_categories(spark):
    df = spark.range(50_000).select(F.col("id").cast("double").alias("x"), F.format_string("v%06d", "id").alias("c"))
    model = encode.TabularEncoder(numericCols=["x"], categoricalCols=["c"]).fit(df)
    assert len(model.output_names()) == 50_001
    probe = spark.createDataFrame([(1.0, "v000007"), (2.0, "unseen"), (3.0, None)], "x double, c string")
    vectors = [r["features"] for r in model.transform(probe).orderBy("x").collect()]
    assert [(v.size, v.indices.tolist()) for v in vectors] == [(50_001, [0, 8]), (50_001, [0]), (50_001, [0])]


def test_replay_is_a_walk(spark):
    """Pointers reach what a walk in order of time fires, over long histories, with NULLs and repeats."""
    rng = random.Random(9)
    begin, rows = datetime(2024, 1, 1), []
    for name, n, span in (("a", 300, 9000), (None, 40, 400), ("b", 60, 60_000), ("c", 1, 1)):
        rows += [(name, "x" if k % 2 else None, begin + timedelta(minutes=rng.randrange(span)), rng.choice([True, True, False, None])) for k in range(n)]
    rows += [rows[0], rows[0], ("a", "x", None, True), ("a", "x", None, False)]
    want = []
    for key in {r[:2] for r in rows}:
        last = None
        for _, _, at, bad in sorted((r for r in rows if r[:2] == key), key=lambda r: (r[2] is None, r[2] or begin)):
            fire = bool(bad) and at is not None and (last is None or at >= last + timedelta(days=1))
            last = at if fire else last
            want.append((*key, at, "fire" if fire else "suppressed" if bad else "healthy"))
    df = spark.createDataFrame(rows, "monitor string, part string, at timestamp, drifted boolean")
    got = [tuple(r) for r in trigger.replay(df, ["monitor", "part"]).select("monitor", "part", "at", "action").collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and sum(x[3] == "fire" for x in want) > 30
    assert trigger.replay(df.where("part = 'none'"), ["monitor"]).count() == 0


def test_versions_are_compared_where_they_differ(spark):
    """Random edits, NULL and repeated keys; leaves without a change are not opened."""
    rng = random.Random(4)
    rows = [(i if i % 50 else None, rng.choice("ab"), rng.randrange(5)) for i in range(2000)] + [(7, "a", 1), (7, "a", 1), (8, "b", None)]
    later = [r for r in rows if rng.random() > 0.01]
    later = [(k, c, (v or 0) + 9) if rng.random() < 0.01 else (k, c, v) for k, c, v in later] + [(5000 + i, "z", None) for i in range(8)] + [(None, "a", 77)]
    bags = []
    for part in (rows, later):
        bag = {}
        for k, c, v in part:
            bag.setdefault((k, c), []).append(str(v))
        bags.append({k: sorted(v) for k, v in bag.items()})
    want = {k: "added" if k not in bags[0] else "removed" if k not in bags[1] else "changed" for k in bags[0].keys() | bags[1].keys() if bags[0].get(k) != bags[1].get(k)}
    paths = [sizing.run_dir(spark, "version") for _ in range(3)]
    for path, part in zip(paths, (rows, later, list(reversed(rows)))):
        versions.store(spark.createDataFrame(part, "k bigint, c string, v int").repartition(3), ["k", "c"], path, 3)
    got = {(r["k"], r["c"]): r["change"] for r in versions.changed_rows(spark, paths[0], paths[1], ["k", "c"], 3).collect()}
    assert got == want and set(want.values()) == {"added", "removed", "changed"}
    assert versions.changed_leaves(spark, paths[0], paths[1], 3).count() <= len(want)
    assert versions.changed_rows(spark, paths[0], paths[2], ["k", "c"], 3).count() == 0


def test_pieces_of_versions_do_not_grow_with_them(spark, monkeypatch):
    monkeypatch.setattr(versions, "PIECE_ROWS", 100)
    most = {}
    for n in (400, 2000):
        old, new = (sizing.run_dir(spark, "version") for _ in range(2))
        versions.store(spark.range(n), ["id"], old, 2)
        versions.store(spark.range(3, n + 3), ["id"], new, 2)
        changed = versions.changed_rows(spark, old, new, ["id"], 2)
        assert sorted((r["id"], r["change"]) for r in changed.collect()) == [(i, "removed") for i in range(3)] + [(n + i, "added") for i in range(3)]
        files = spark.read.parquet(f"{old}/rows").groupBy(F.input_file_name()).count()
        most[n] = files.agg(F.max("count")).first()[0]
    assert max(most.values()) <= 300


def test_writers_claim_different_versions(spark):
    path = sizing.run_dir(spark, "claims")
    with ThreadPool(8) as pool:
        got = pool.map(lambda i: claims.claim_version(spark, path, "m", str(i)), range(24))
    assert sorted(got, key=lambda v: int(v[1:])) == [f"v{i}" for i in range(1, 25)] == [f"v{i}" for i in claims.versions(spark, path, "m")]
    assert claims.claim_version(spark, path, "other") == "v1"


def test_readers_see_a_table_whole_during_reloads(spark):
    path, seen = sizing.run_dir(spark, "reload"), []
    load = lambda i: claims.reload_table(spark.range(100).withColumn("load", F.lit(i)).repartition(3), path)
    load(0)
    with ThreadPool(2) as pool:
        writing = pool.map_async(load, range(1, 7), chunksize=6)
        while not writing.ready():
            seen.append([tuple(r) for r in claims.read_table(spark, path).groupBy("load").count().collect()])
        writing.get()
    assert all(len(x) == 1 and x[0][1] == 100 for x in seen) and claims.read_table(spark, path).first()["load"] == 6
