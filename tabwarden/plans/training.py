"""Training run: clean, split, check, train, evaluate, decide.

The split is written once, partitioned by part, in the shared folder; all later steps read
that table, so nothing is recomputed from the raw source and lost executors cost no restart.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwarden import fixed
from tabwarden.functions import sizing
from tabwarden.operators import clean as cleaning
from tabwarden.operators import contract as contracts
from tabwarden.operators import decide, metrics, profile, split, train
from tabwarden.sources import readers, writers


#: Rows of a partition of the training rows, and the fewest partitions. Rows are dealt by the hash of
#: all their cells and sorted, so a fit depends on the rows alone, not on how they were stored.
FIT_ROWS, FIT_PARTITIONS = 100_000, 8


@dataclass
class TrainingRun:
    path: str
    checks: DataFrame | None
    candidates: list[train.Candidate]
    cv: DataFrame
    validation: DataFrame
    metrics: DataFrame
    decision: DataFrame


def prepare(
    df: DataFrame, spec: cleaning.CleanSpec, stratum: str, key: Sequence[str], folds: int = fixed.N_FOLDS, seed: int = fixed.SEED, drop: Sequence[str] = ()
) -> str:
    """Clean, split and fold; returns the path of the stored table."""
    spark = df.sparkSession
    path = sizing.run_dir(spark, "split")
    cleaned = cleaning.distinct_rows(cleaning.clean(df, spec, "train"))
    cleaned = sizing.cut_lineage(cleaning.require_target(cleaned, stratum), "cleaned")
    parts = split.stratified_split(cleaned, stratum, key, seed=seed)
    # Folds are equal shares of every class of every part. Their hash has its own seed, so a
    # fold is not a slice of the split's order.
    within = parts.withColumn("_within", F.concat_ws("|", "split", F.col(stratum).cast("string")))
    folded = split.stratified_folds(within, "_within", key, folds, seed + 1).drop("_within", *drop)
    writers.write_parts(folded, path, "split", "fold")
    return path


def gate(train_rows: DataFrame, contract: contracts.Contract) -> DataFrame:
    """Column checks of the training part; raises if one of them is an error."""
    checks = contracts.check_profile(profile.column_profile(train_rows), contract)
    if not contracts.summarize(checks).first()["passed"]:
        bad = [r["column"] for r in checks.where("status = 'error'").collect()]
        raise ValueError(f"contract violated by {bad}")
    return checks


def deal(rows: DataFrame) -> DataFrame:
    """The same rows in partitions and an order that follow from the rows alone."""
    pieces = max(FIT_PARTITIONS, rows.count() // FIT_ROWS)
    return rows.repartition(pieces, *rows.columns).sortWithinPartitions(*rows.columns)


def run(
    path: str,
    spark,
    label: str,
    grids: Mapping[str, Mapping] = fixed.PARAMETER_GRIDS,
    contract: contracts.Contract | None = None,
    champion: PipelineModel | Callable[[], PipelineModel] | None = None,
    folds: int = fixed.N_FOLDS,
    draws: int = 1,
    parallelism: int = 8,
    skip: Sequence[str] = (),
) -> TrainingRun:
    """Train every candidate on the stored training part, measure it on the validation part and
    decide on the test part.

    ``parallelism`` bounds the encoders that are fitted side by side.
    """
    fit_rows, validation_rows, test_rows = (readers.read_part(spark, path, p) for p in ("train", "validation", "test"))
    fit_rows = deal(fit_rows)
    checks = gate(fit_rows.drop("fold", *skip), contract) if contract else None
    numeric, categorical = cleaning.feature_groups(fit_rows, exclude=[label, "fold", *skip], both=True)
    encoders = train.fit_encoders(fit_rows, list(grids), numeric, categorical, "fold", folds, parallelism)
    candidates = train.search(fit_rows, grids, encoders, label, folds=folds, draws=draws)
    validation = train.evaluate(candidates, validation_rows, label)
    result = train.evaluate(candidates, test_rows, label)
    current = train.champion_metrics(champion, test_rows, label)
    decision = decide.champion_decision(decide.select_candidate(result), current)
    cv = metrics.fold_summary(train.fold_frame(spark, candidates), ["model", "params"])
    return TrainingRun(path, checks, candidates, cv, validation, result, decision)
