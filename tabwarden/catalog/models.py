"""Queries: training, cross-validation, evaluation, scoring with fitted models."""

from __future__ import annotations

from pathlib import Path

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tabwarden import fixed
from tabwarden.catalog import frames as fr
from tabwarden.functions import sizing
from tabwarden.operators import lineage, metrics, score, train
from tabwarden.operators.clean import CleanSpec
from tabwarden.operators.contract import from_dict, load
from tabwarden.plans import training
from tabwarden.sources import readers, writers

FEATURES = [*fr.NUMERIC, *fr.CATEGORICAL]
TRAINED = [fr.KEY, *FEATURES, fr.LABEL]

CONTRACT = from_dict(
    {
        "columns": {
            "c_custkey": {"required": True, "nullable": False},
            "c_acctbal": {"nullable": True, "min": 50.0, "max": 9900.0},
            "n_orders": {"required": True, "nullable": False, "min": 3},
            "c_mktsegment": {"required": True, "nullable": False},
        }
    }
)

CUSTOMERS = load(str(Path(__file__).resolve().parents[2] / "contracts" / "customers.yaml"))

_runs: dict[tuple[str, str], training.TrainingRun] = {}


def _run(spark, d) -> training.TrainingRun:
    """One training run per session and input, shared by the queries below."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _runs:
        path = training.prepare(fr.churn(spark, d), CleanSpec(), fr.LABEL, [fr.KEY])
        _runs[at] = training.run(path, spark, fr.LABEL, contract=CUSTOMERS, skip=[fr.KEY])
    return _runs[at]


def training_folds(spark, d):
    """Customers per part, class and fold of the stored split."""
    stored = spark.read.parquet(_run(spark, d).path)
    return stored.groupBy("split", fr.LABEL, "fold").agg(F.count(F.lit(1)).alias("n"))


def training_gate(spark, d):
    """The training rows against their YAML contract, which let the run begin."""
    return _run(spark, d).checks.withColumn("details", F.concat_ws("; ", "details"))


def made_up_keys(spark, d):
    """A batch without a key column is logged under fresh ids, one a row."""
    rows = fr.churn(spark, d).drop(fr.KEY).withColumn("p", F.lit(0.25))
    at = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    path = sizing.run_dir(spark, "made-up-keys")
    writers.append_log(score.prediction_log(rows, F.lit("req-1"), F.lit("v1"), at, FEATURES, fr.KEY), path)
    key = F.col("prediction_output.key")
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"), F.max(F.length(key)).alias("key_length"))


def _checked(measured):
    """Counts of a metrics table that SQL can repeat, and whether its rates follow from them."""
    rates = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")
    again = metrics.rates(measured.select("model", "tn", "fp", "fn", "tp").withColumnRenamed("model", "_model"))
    again = again.select("_model", F.struct("accuracy", "precision", "recall", "f1").alias("_again"))
    in_range = F.col("log_loss") >= 0
    for r in rates:
        in_range = in_range & F.col(r).between(0, 1)
    return measured.join(again, F.col("model") == F.col("_model")).select(
        "model", "n_samples",
        (F.col("tp") + F.col("fn")).alias("positives"), (F.col("tn") + F.col("fp")).alias("negatives"),
        (F.struct("accuracy", "precision", "recall", "f1") == F.col("_again")).alias("rates_follow"), in_range.alias("in_range"),
    )


def train_candidates(spark, d):
    """Every candidate on the test part."""
    return _checked(_run(spark, d).metrics)


def validation_metrics(spark, d):
    """Every candidate on the validation part."""
    return _checked(_run(spark, d).validation)


def cv_summary(spark, d):
    """Drawn parameters of every candidate; its recall over the folds lies where it can."""
    return _run(spark, d).cv.select(
        "model", "params", F.col("mean_score").between(0, 1).alias("mean_in_range"), F.col("std_score").between(0, 0.5).alias("std_in_range")
    )


def lineage_train(spark, d):
    """The training rows behind every candidate, all of their cells hashed."""
    run = _run(spark, d)
    part = readers.read_part(spark, run.path, "train")
    return lineage.training(part, TRAINED, run.cv).select("model", "params", "train_rows", "train_hash_sum")


def training_decision(spark, d):
    """The decision without a champion; the best recall is missed by a tolerance per step at most."""
    run = _run(spark, d)
    top = run.metrics.agg(F.max("recall")).scalar()
    slack = fixed.RECALL_TOLERANCE * (len(run.candidates) - 1)
    return run.decision.withColumn("_top", top).select(
        F.col("best_model").isin([c.name for c in run.candidates]).alias("known_model"),
        (F.col("recall") >= F.col("_top") - slack - 1e-9).alias("near_best"), "champion_recall", "approved", "reason",
    )


def _candidate(spark, d, name):
    return next(c for c in _run(spark, d).candidates if c.name == name)


def _best(spark, d):
    return _candidate(spark, d, _run(spark, d).decision.first()["best_model"])


def feature_importance(spark, d):
    """Outputs of the forest: shares that sum to 1, up to the five places of each."""
    found = train.feature_importance(spark, _candidate(spark, d, "random_forest").model)
    total = found.agg(F.sum("importance")).scalar()
    return found.withColumn("_total", total).select(
        "feature", F.col("importance").between(0, 1).alias("in_range"), F.col("_total").between(0.999, 1.001).alias("sums_to_one")
    )


def champion_metrics(spark, d):
    """The best model as champion: stored, loaded and measured again, it measures the same."""
    best, path = _best(spark, d), sizing.run_dir(spark, "model")
    best.model.save(path)
    test = readers.read_part(spark, _run(spark, d).path, "test")
    again = train.champion_metrics(PipelineModel.load(path), test, fr.LABEL)
    before = _run(spark, d).metrics.where(F.col("model") == best.name).select(F.struct(*again.columns)).scalar()
    return again.withColumn("_before", before).select("n_samples", (F.struct(*again.columns) == F.col("_before")).alias("same"))


def score_batch(spark, d):
    """A CSV batch of all customers scored by the best model; log and dead letters counted."""
    model = _best(spark, d).model
    base = sizing.run_dir(spark, "batch")
    writers.write_csv(fr.churn(spark, d).drop(fr.LABEL), f"{base}/in")
    schema = fr.churn(spark, d).drop(fr.LABEL).schema
    batch = readers.read_batch(spark, f"{base}/in", schema)
    out = score.score_batch(batch, CONTRACT, CleanSpec(), lambda df: score.with_probability(df, model))
    at = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    log = score.prediction_log(out.scored, F.lit("req-1"), F.lit("v1"), at, FEATURES, fr.KEY)
    writers.append_log(log, f"{base}/log")
    writers.append_log(score.dead_letters(out.dead, F.lit("req-1"), at, FEATURES, fr.KEY), f"{base}/dead")
    good = spark.read.parquet(f"{base}/log").agg(F.count(F.lit(1)).alias("logged"), F.avg("prediction_output.probability").alias("p"))
    dead = spark.read.parquet(f"{base}/dead").agg(F.count(F.lit(1))).scalar()
    return good.select("logged", dead.alias("dead"), F.col("p").between(0, 1).alias("mean_in_range"))


def candidate_metrics(spark, d):
    """The figures behind ``train_candidates`` and ``validation_metrics``: no SQL repeats a fitted model."""
    run = _run(spark, d)
    parts = [m.withColumn("part", F.lit(part)) for part, m in (("validation", run.validation), ("test", run.metrics))]
    return parts[0].unionByName(parts[1])


def fold_recalls(spark, d):
    """Recall of every candidate on every fold left out."""
    return train.fold_frame(spark, _run(spark, d).candidates)


def importances(spark, d):
    """Importances and coefficients of every candidate, by output name."""
    frames = [train.feature_importance(spark, c.model).withColumn("model", F.lit(c.name)) for c in _run(spark, d).candidates]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def decision_figures(spark, d):
    """The decision with its figures."""
    return _run(spark, d).decision


def foreign_model(spark, d):
    """A model that only knows pandas frames, scored through Arrow batches."""

    def predict(pdf):
        return (pdf["n_orders"] / (pdf["n_orders"] + 10.0)).to_numpy()

    frame = fr.churn(spark, d).select(fr.KEY, "n_orders")
    return score.with_foreign_probability(frame, predict).select(fr.KEY, F.round("p", 6).alias("p"))


QUERIES = {
    f.__name__: f
    for f in (
        training_folds, training_gate, made_up_keys, train_candidates, validation_metrics, cv_summary, lineage_train, training_decision, feature_importance, champion_metrics, score_batch, foreign_model,
        candidate_metrics, fold_recalls, importances, decision_figures,
    )
}

_PARTS = f"""{fr.CHURN_SQL}, ranked AS (
    SELECT *, row_number() OVER (PARTITION BY churn ORDER BY md5('42|' || c_custkey::VARCHAR)) - 1 AS r, count(*) OVER (PARTITION BY churn) AS n FROM churn),
  parted AS (SELECT *, CASE WHEN r < n * 70 // 100 THEN 'train' WHEN r < n * 85 // 100 THEN 'validation' ELSE 'test' END AS split FROM ranked),
  dealt AS (SELECT *, row_number() OVER (PARTITION BY split, churn ORDER BY md5('43|' || c_custkey::VARCHAR)) - 1 AS i, count(*) OVER (PARTITION BY split, churn) AS m FROM parted),
  parts AS (SELECT *, CAST((i >= m // 5)::INT + (i >= m * 2 // 5)::INT + (i >= m * 3 // 5)::INT + (i >= m * 4 // 5)::INT AS INTEGER) AS fold FROM dealt),
  drawn AS (SELECT * FROM (VALUES
    ('logistic_regression', '{{"C": 10.0, "max_iter": 500, "penalty": "l1"}}'),
    ('random_forest', '{{"bootstrap": true, "max_depth": 20, "min_samples_leaf": 2, "n_estimators": 100}}'),
    ('gradient_boosting', '{{"learning_rate": 0.1, "max_depth": 3, "n_estimators": 300, "subsample": 0.8}}')) AS t(model, params))"""


def _measured(part: str) -> str:
    return f"""WITH {_PARTS} SELECT model, count(*) AS n_samples, count(*) FILTER (churn = 1) AS positives, count(*) FILTER (churn = 0) AS negatives,
        true AS rates_follow, true AS in_range FROM parts, drawn WHERE split = '{part}' GROUP BY model"""


ORACLES = {
    "training_folds": f"WITH {_PARTS} SELECT split, churn, fold, count(*) AS n FROM parts GROUP BY ALL",
    "training_gate": f"""WITH {_PARTS}, s AS (SELECT min(c_acctbal) AS low, max(n_orders) AS high FROM parts WHERE split = 'train')
        SELECT 'c_acctbal' AS "column", CASE WHEN low < 100 THEN 'warning' ELSE 'pass' END AS status, CASE WHEN low < 100 THEN 'Observed min below expected min' ELSE '' END AS details FROM s
        UNION ALL SELECT 'n_orders', CASE WHEN high > 8 THEN 'warning' ELSE 'pass' END, CASE WHEN high > 8 THEN 'Observed max above expected max' ELSE '' END FROM s
        UNION ALL SELECT 'avg_price', 'warning', 'Invalid dtype ''double'', expected semantic type ''integer''' FROM s
        UNION ALL SELECT 'phone', 'warning', 'Missing optional column' FROM s
        UNION ALL SELECT 'last_priority', 'warning', 'Unexpected column not defined in reference schema' FROM s
        UNION ALL SELECT name, 'pass', '' FROM s, (VALUES ('total_price'), ('c_mktsegment'), ('n_name'), ('churn')) AS v(name)""",
    "made_up_keys": f"WITH {fr.CHURN_SQL} SELECT count(*) AS n_rows, count(*) AS n_keys, 36 AS key_length FROM churn",
    "train_candidates": _measured("test"),
    "validation_metrics": _measured("validation"),
    "cv_summary": f"WITH {_PARTS} SELECT model, params, true AS mean_in_range, true AS std_in_range FROM drawn",
    "lineage_train": f"""WITH {_PARTS} SELECT model, params, count(*) AS train_rows, CAST(sum(h::HUGEINT) AS VARCHAR) AS train_hash_sum
        FROM (SELECT {fr.row_hash_sql(TRAINED)} AS h FROM parts WHERE split = 'train'), drawn GROUP BY ALL""",
    "training_decision": """SELECT true AS known_model, true AS near_best, NULL::DOUBLE AS champion_recall, true AS approved,
        'approved: no champion' AS reason FROM (SELECT count(*) FROM orders)""",
    "feature_importance": f"WITH {_PARTS}, names AS ("
    + " UNION ".join(
        [f"SELECT '{c}' AS feature" for c in fr.NUMERIC] + [f"SELECT '{c}_' || {c} FROM parts WHERE split = 'train'" for c in fr.CATEGORICAL]
    )
    + ") SELECT feature, true AS in_range, true AS sums_to_one FROM names",
    "champion_metrics": f"WITH {_PARTS} SELECT count(*) AS n_samples, true AS same FROM parts WHERE split = 'test'",
    "score_batch": f"""WITH {fr.CHURN_SQL}, bad AS (
        SELECT *, coalesce(c_acctbal < 50, false) OR coalesce(c_acctbal > 9900, false) OR n_orders < 3 AS is_bad FROM churn)
        SELECT count(*) FILTER (NOT is_bad) AS logged, count(*) FILTER (is_bad) AS dead, true AS mean_in_range FROM bad""",
    "foreign_model": f"WITH {fr.CHURN_SQL} SELECT c_custkey, round(n_orders / (n_orders + 10.0::DOUBLE), 6) AS p FROM churn",
}
