"""Hand-made cases."""

import math

import pytest
from pyspark.sql import functions as F

from tabwarden.functions import cells, stats
from tabwarden.operators import clean, contract, decide, drift, encode, labels, metrics, percentiles, registry, rules, score, trigger
from tabwarden.operators.profile import baseline_report, column_profile, numeric_summary
from tabwarden.plans import monitoring, training
from tabwarden.sources import readers, writers


def shares(spark, d):
    return spark.createDataFrame([("f", k, float(v)) for k, v in d.items()], "feature string, value string, ratio double")


@pytest.mark.parametrize(
    "expected, actual, want",
    [
        ({"Yes": 0.5, "No": 0.5}, {"Yes": 0.7, "No": 0.3}, 0.1695),
        ({"Yes": 0.5, "No": 0.5}, {"Yes": 0.75, "No": 0.25}, 0.2747),
        ({"A": 1.0}, {"A": 0.9, "B": 0.1}, 0.7006),
        ({"A": 0.4, "B": 0.6}, {"A": 0.4, "B": 0.6}, 0.0),
        ({None: 0.4, "B": 0.6}, {None: 0.4, "B": 0.6}, 0.0),
        ({"A": 0.6, "B": 0.4}, {"C": 1.0}, None),
    ],
)
def test_psi(spark, expected, actual, want):
    if want is None:
        floor = 1e-4
        want = sum((a - e) * math.log(a / e) for e, a in ((0.6, floor), (0.4, floor), (floor, 1.0)))
        want = round(want, 4)
    e, a = shares(spark, expected), shares(spark, actual)
    assert drift.psi(e, a).first()["score"] == want
    grouped = drift.psi_against(e, a.withColumn("g", F.lit(1)), ["g"])
    assert grouped.first()["score"] == want


def test_psi_of_an_empty_side(spark):
    e = spark.createDataFrame([(0.5, None), (0.5, None)], "expected double, actual double")
    got = e.agg(F.round(F.sum(stats.psi_term(F.col("expected"), F.col("actual"))), 4).alias("s")).first()["s"]
    assert got == 8.5155


def test_psi_skips_features_of_one_side(spark):
    e = shares(spark, {"A": 1.0})
    a = e.withColumn("feature", F.lit("g"))
    assert drift.psi(e, a).count() == 0


def test_mean_shift(spark):
    e = spark.createDataFrame([("a", 0.0), ("b", 10.0), ("c", 1.0)], "feature string, mean double")
    a = spark.createDataFrame([("a", 0.25), ("b", 11.0)], "feature string, mean double")
    found = {r["feature"]: (r["score"], r["is_drifted"]) for r in drift.verdicts(None, drift.mean_shift(e, a)).collect()}
    assert found == {"a": (0.25, True), "b": (0.1, False)}


def test_missing_mean_is_drift_only_if_asked(spark):
    e = spark.createDataFrame([("a", 1.0)], "feature string, mean double")
    a = spark.createDataFrame([("a", None)], "feature string, mean double")
    shift = drift.mean_shift(e, a)
    assert not drift.verdicts(None, shift).first()["is_drifted"]
    assert drift.verdicts(None, shift, missing_is_drift=True).first()["is_drifted"]


FIVE = [("m", 0.9, 1), ("m", 0.8, 0), ("m", 0.7, 1), ("m", 0.4, 0), ("m", 0.4, 1)]


def test_areas(spark):
    df = spark.createDataFrame(FIVE, "model string, p double, label int")
    assert metrics.roc_auc(df, ["model"]).first()["roc_auc"] == 0.583333
    assert metrics.average_precision(df, ["model"]).first()["pr_auc"] == 0.755556
    every = metrics.class_metrics(df, ["model"]).first()
    assert (every["roc_auc"], every["pr_auc"]) == (0.583333, 0.755556)
    assert (every["tn"], every["fp"], every["fn"], every["tp"]) == (1, 1, 1, 2)


def test_rates_without_positives(spark):
    df = spark.createDataFrame([("m", 0.1, 0), ("m", 0.2, 0)], "model string, p double, label int")
    got = metrics.class_metrics(df, ["model"]).first()
    assert (got["accuracy"], got["precision"], got["recall"], got["f1"], got["roc_auc"]) == (1.0, 0.0, 0.0, 0.0, None)


def test_log_loss_is_finite_at_the_ends(spark):
    df = spark.createDataFrame([("m", 1.0, 0), ("m", 0.0, 1)], "model string, p double, label int")
    assert metrics.log_loss(df, ["model"]).first()["log_loss"] == round(-math.log(stats.DOUBLE_EPS), 6)


def test_percentiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    row = percentiles.exact_percentiles(df, ["x"], {"a": 0.1, "b": 0.5, "c": 1.0}).first()
    assert (round(row["a"], 9), row["b"], row["c"]) == (1.3, 2.5, 10.0)


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert percentiles.exact_percentiles(df, ["x"], {"a": 0.5}).first()["a"] is None


def test_numbers(spark):
    texts = ["1d", " 12.5 ", "", " ", "1_000", "1e3", "inf", "NaN", "-.5", "+7.", "\t3\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(cells.to_number(F.col("t"))).collect()]
    assert got == [None, 12.5, None, None, None, 1000.0, None, None, -0.5, 7.0, 3.0]


def test_clean_modes(spark):
    spec = clean.CleanSpec(drop=("id",), value_maps={"s": {1: "Yes", 0: "No"}}, target="y", target_map={"Yes": 1, "No": 0})
    df = spark.createDataFrame([("1", "Yes", "na", "k"), ("0", "No", "", "k"), ("x", "?", " ", "k")], "s string, y string, t string, id string")
    train = clean.clean(df, spec, "train").collect()
    assert [tuple(r) for r in train] == [("Yes", 1, None), ("No", 0, ""), (None, None, " ")]
    live = clean.clean(df, spec, "score").drop("y", "id").collect()
    assert [tuple(r) for r in live] == [("Yes", None), ("No", None), ("x", None)]
    with pytest.raises(Exception, match="target column y"):
        clean.require_target(clean.clean(df, spec, "train"), "y").collect()


@pytest.mark.parametrize("kind", ["int", "double", "string"])
def test_codes_of_any_type(spark, kind):
    df = spark.createDataFrame([("1",), ("0",), ("2",), (None,)], "s string").select(F.col("s").cast(kind).alias("s"))
    spec = clean.CleanSpec(value_maps={"s": {1: "Yes", 0: "No"}})
    assert [r["s"] for r in clean.clean(df, spec, "train").collect()] == ["Yes", "No", None, None]
    assert [r["s"] for r in clean.clean(df, spec, "score").collect()] == ["Yes", "No", "2", None]


def test_an_empty_live_window_is_an_error(spark):
    rows = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, c string")
    with pytest.raises(ValueError, match="no live rows"):
        monitoring.compare_windows(rows, rows.limit(0))
    assert not monitoring.compare_windows(rows, rows).summary.first()["drift_detected"]


@pytest.mark.parametrize("kinds", [("x double", "x string"), ("x string", "x double")])
def test_a_changed_type_is_drift(spark, kinds):
    before, after = (spark.createDataFrame([("1", "a"), ("2", "b")], "x string, c string").selectExpr(f"CAST(x AS {k.split()[1]}) AS x", "c") for k in kinds)
    rows = {r["feature"]: r for r in monitoring.compare_windows(before, after).verdicts.collect()}
    assert rows["x"]["metric"] == "type_changed" and rows["x"]["is_drifted"]
    assert not rows["c"]["is_drifted"]


def test_a_known_version_is_refused(spark):
    rows = spark.createDataFrame([("m", "v1")], "name string, version string")
    assert registry.refuse_existing(rows.limit(0), rows).count() == 1
    with pytest.raises(ValueError, match="already registered"):
        registry.refuse_existing(rows, rows)


def test_fits_do_not_depend_on_the_partitions_of_the_rows(spark):
    rows = spark.range(500).selectExpr("id", "id % 7 AS x", "cast(id % 3 AS string) AS c")
    dealt = [training.deal(rows.repartition(n)).rdd.glom().collect() for n in (1, 5)]
    assert dealt[0] == dealt[1]


def test_strip_takes_every_whitespace(spark):
    df = spark.createDataFrame([("\t\u00a0 a b \u3000\n",)], "t string")
    assert clean.strip_strings(df).first()["t"] == "a b"


def test_distinct_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 2)], "t string, n int")
    assert clean.distinct_rows(df).count() == 2
    assert tuple(clean.duplicate_count(df).first()) == (3, 2, 1)


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    row = numeric_summary(clean.nan_cells_to_null(df), ["x"]).first()
    assert (row["mean"], row["max"], round(row["missing_ratio"], 6), row["std"]) == (1.0, 1.0, 0.666667, None)


def test_walk_is_chained(spark):
    rows = [("a", 0.800, 0.50), ("b", 0.798, 0.60), ("c", 0.794, 0.70)]
    df = spark.createDataFrame(rows, "model string, recall double, precision double")
    assert decide.select_candidate(df).first()["best_model"] == "c"


@pytest.mark.parametrize("mine, theirs, approved", [(0.80, 0.79, True), (0.82, 0.81, True), (0.799, 0.79, False), (0.5, None, True)])
def test_champion(spark, mine, theirs, approved):
    candidate = spark.createDataFrame([("a", mine, 0.5)], "best_model string, recall double, precision double")
    champion = spark.createDataFrame([] if theirs is None else [(theirs,)], "recall double")
    assert decide.champion_decision(candidate, champion).first()["approved"] is approved


def test_cooldown(spark):
    rows = [("m", h, True) for h in (0, 12, 25, 30)] + [("m", 60, False)]
    df = spark.createDataFrame(rows, "monitor string, h int, drifted boolean")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.expr("make_dt_interval(0, h)")
    got = trigger.replay(df.withColumn("at", at), ["monitor"]).orderBy("at").collect()
    assert [r["action"] for r in got] == ["fire", "suppressed", "fire", "suppressed", "healthy"]


CONTRACT = contract.load(__file__.rsplit("/tests/", 1)[0] + "/contracts/churn.yaml")


def churn_rows(spark):
    base = {c: (r.get("allowed_values") or ["x"])[0] for c, r in CONTRACT.columns.items()}
    base.update(tenure=5, MonthlyCharges=20.0, TotalCharges="100.5", SeniorCitizen="1")
    del base["Churn"]
    rows = [
        {**base, "customerID": "ok"},
        {**base, "customerID": "low", "tenure": -1},
        {**base, "customerID": "two", "MonthlyCharges": 300.0, "gender": "na"},
        {**base, "customerID": "open", "SeniorCitizen": "maybe"},
        {**base, "customerID": "text", "TotalCharges": " "},
    ]
    return spark.createDataFrame(rows)


SPEC = clean.CleanSpec(numeric_text=("TotalCharges",), value_maps={"SeniorCitizen": {1: "Yes", 0: "No"}}, drop=("customerID",))


def test_row_rules(spark):
    annotated = rules.annotate(clean.clean(churn_rows(spark), SPEC, "score"), CONTRACT)
    found = {r["customerID"]: sorted(e["error_reason"] for e in r["errors"]) for r in annotated.collect()}
    assert found == {
        "ok": [],
        "low": ["Column 'tenure' value falls below minimum (0)."],
        "two": ["Column 'MonthlyCharges' value exceeds maximum (200.0).", "Column 'gender' contains null/missing values."],
        "open": [],
        "text": [],
    }
    assert tuple(rules.batch_summary(annotated).first()) == (5, 3, 2, 3)
    strict = rules.annotate(clean.clean(churn_rows(spark), SPEC, "score"), CONTRACT, allowed_values=True)
    assert [e["column"] for e in strict.where("customerID = 'open'").first()["errors"]] == ["SeniorCitizen"]
    with pytest.raises(ValueError, match="gender"):
        rules.annotate(churn_rows(spark).drop("gender"), CONTRACT)


def test_contract_file(spark):
    assert contract.allowed_spark_types("floating", CONTRACT.dtype_mapping) == ["double", "float"]
    cleaned = clean.clean(churn_rows(spark), SPEC, "train").withColumn("Churn", F.lit(1))
    checks = {r["column"]: (r["status"], list(r["details"])) for r in contract.check_profile(column_profile(cleaned), CONTRACT).collect()}
    assert checks["tenure"] == ("warning", ["Observed min below expected min"])
    assert checks["MonthlyCharges"] == ("warning", ["Observed max above expected max"])
    assert checks["SeniorCitizen"] == ("error", ["Null values present in non-nullable column"])
    assert checks["gender"][0] == "warning" and checks["Partner"][0] == "pass"


def test_dataset_rules_lenient(spark):
    rows = spark.createDataFrame([(1, 0), (2, 1)], "x int, y int")
    doc = {"dataset": {"target_column": "y"}, "dataset_constraints": {"min_rows": 3}, "columns": {}, "enforcement_mode": "lenient"}
    assert contract.check_dataset(rows, contract.from_dict(doc)).first()["status"] == "warning"
    doc["enforcement_mode"] = "strict"
    assert contract.check_dataset(rows, contract.from_dict(doc)).first()["status"] == "error"


def test_baseline_needs_a_target(spark):
    with pytest.raises(ValueError):
        baseline_report(spark.createDataFrame([(1,)], "x int"), target="y").collect()


def test_key_is_made_up_if_absent(spark):
    df = spark.createDataFrame([(0.5,), (0.4,)], "p double")
    log = score.prediction_log(df, F.lit("r"), F.lit("v1"), F.current_timestamp(), ["p"], "key")
    rows = score.flatten(log, "prediction_output").collect()
    assert len({r["key"] for r in rows}) == 2
    assert [r["decision"] for r in rows] == ["Yes", "No"]


def test_csv_edges(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.csv").write_text("k,t\n9,late\n")
    (tmp_path / "in" / "a.csv").write_text("k,t\n1,NA\n2,na\n3,\n4,x\n")
    (tmp_path / "in" / "c.txt").write_text("k,t\n5,no\n")
    path = str(tmp_path / "in")
    assert [r["t"] for r in readers.read_csv(spark, path, "k int, t string", first_file=True).orderBy("k").collect()] == [None, "na", None, "x"]
    assert readers.read_batch(spark, path, "k int, t string").count() == 5
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "a.csv").write_text("k,t\n")
    with pytest.raises(ValueError):
        readers.read_batch(spark, str(tmp_path / "empty"), "k int, t string")


def test_csv_goes_by_header_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,x y,a\n1.5,p,7\n nan ,None,8.0\n1d,,oops\n")
    rows = readers.read_csv(spark, str(tmp_path), "a int, b double, `x y` string, absent string")
    assert rows.dtypes == [("a", "int"), ("b", "double"), ("x y", "string")]
    assert [tuple(r) for r in rows.collect()] == [(7, 1.5, "p"), (8, None, None), (None, None, None)]
    with pytest.raises(ValueError):
        rules.require_columns(rows, contract.from_dict({"columns": {"absent": {"required": True}}}))


def test_csv_files_of_one_folder_go_by_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n3,4\n")
    (tmp_path / "b.csv").write_text("b,a\n5,6\n")
    assert sorted(map(tuple, readers.read_csv(spark, str(tmp_path), "a int, b int").collect())) == [(1, 2), (3, 4), (6, 5)]


def test_csv_malformed_lines_are_dead_letters(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n3\n4,5,6\n")
    rows = readers.read_csv(spark, str(tmp_path), "b int, a int", corrupt=rules.CORRUPT_LINE)
    marked = rules.annotate(rows, contract.from_dict({"columns": {"a": {"required": True}}}))
    assert [r["a"] for r in rules.valid_rows(marked).collect()] == [1]
    reasons = [e["error_reason"] for r in rules.invalid_rows(marked).collect() for e in r["errors"]]
    assert sorted(reasons) == ["Malformed line: 3", "Malformed line: 4,5,6"]


def test_load_counts(spark, tmp_path):
    df = spark.range(7)
    assert writers.load_table(df, str(tmp_path / "t")) == 7
    assert writers.load_table(df.limit(0), str(tmp_path / "t"), replace=False) == 0
    assert writers.load_table(df.limit(3), str(tmp_path / "t")) == 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_rows_without_a_score_or_label_are_counted_apart(spark):
    rows = [("m", 0.9, 1), ("m", 0.2, 0), ("m", None, 1), ("m", float("nan"), 0), ("m", 0.7, None), (None, 0.6, 1), ("none", None, 1)]
    df = spark.createDataFrame(rows, "model string, p double, label int")
    got = {r["model"]: r for r in metrics.class_metrics(df, ["model"]).collect()}
    assert [got["m"][c] for c in ("n_samples", "n_unscored", "tn", "fp", "fn", "tp", "recall", "roc_auc")] == [2, 3, 1, 0, 0, 1, 1.0, 1.0]
    assert got["m"]["log_loss"] == pytest.approx(0.164252, abs=1e-6) and got[None]["tp"] == 1 and got["none"]["n_samples"] == 0
    again = {r["model"]: tuple(r)[1:] for r in metrics.confusion(df, ["model"]).collect()}
    assert again == {k: (r["tn"], r["fp"], r["fn"], r["tp"]) for k, r in got.items()}
    assert {r["model"]: r["log_loss"] for r in metrics.log_loss(df, ["model"]).collect()} == {k: r["log_loss"] for k, r in got.items()}
    for one, name in ((metrics.roc_auc, "roc_auc"), (metrics.average_precision, "pr_auc")):
        assert {r["model"]: r[name] for r in one(df, ["model"]).collect()} == {k: r[name] for k, r in got.items()}


def test_no_fact_is_lost(spark):
    day = "timestamp_ntz'2024-01-0{}'".format
    facts = spark.sql(f"SELECT * FROM VALUES (1, {day(3)}, 'a'), (NULL, {day(3)}, 'b'), (1, NULL, 'c'), (NULL, NULL, 'd'), (2, {day(1)}, 'e') AS t(k, at, name)")
    history = spark.sql(f"SELECT * FROM VALUES (1, {day(2)}, 10), (NULL, {day(1)}, 20), (1, NULL, 30), (NULL, NULL, 40), (2, {day(2)}, 50) AS t(k, at, v)")
    got = labels.latest_before(facts, history, ["k"], "at", "v")
    assert got.columns == ["k", "at", "name", "v"]
    assert {r["name"]: r["v"] for r in got.collect()} == {"a": 10, "b": 20, "c": None, "d": None, "e": None}


def test_a_missing_cell_is_not_the_text_nan(spark):
    df = spark.createDataFrame([("nan",), (None,), ("'nan'",), ("a",), ("a",)], "c string")
    model = encode.TabularEncoder(numericCols=["x"], categoricalCols=["c"]).fit(df.withColumn("x", F.lit(0.0)))
    assert model.output_names() == ["x", "c_''nan''", "c_a", "c_'nan'", "c_nan"] and model.for_linear().output_names() == ["x", "c_a", "c_'nan'", "c_nan"]
    vectors = [tuple(r["features"].toArray()) for r in model.transform(df.withColumn("x", F.lit(0.0))).collect()]
    assert len(set(vectors)) == 4 and all(sum(v) == 1 for v in vectors)
    hot = encode.one_hot_rows(df.withColumn("k", F.monotonically_increasing_id()), ["k"], ["c"], encode.fit_categories(df, ["c"]), True)
    assert sorted(r["output"] for r in hot.collect()) == ["c_'nan'", "c_a", "c_a", "c_nan"]


def test_a_baseline_needs_rows(spark):
    df = spark.createDataFrame([(1.0, "a")], "x double, c string")
    with pytest.raises(ValueError, match="no rows"):
        baseline_report(df.limit(0))
    assert baseline_report(df).count() > 0
