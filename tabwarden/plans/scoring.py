"""Scoring run: read a batch, score it, log predictions and dead letters."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation

from tabwarden.operators import rules
from tabwarden.operators import score as scoring
from tabwarden.operators.clean import CleanSpec
from tabwarden.operators.contract import Contract
from tabwarden.sources import writers


def run(
    df: DataFrame,
    contract: Contract,
    spec: CleanSpec,
    score: Callable[[DataFrame], DataFrame],
    request_id: Column,
    model_version: Column,
    at: Column,
    features: Sequence[str],
    key: str,
    log_path: str,
    dead_path: str,
    allowed_values: bool = False,
) -> DataFrame:
    """Append the prediction log and the dead letters; returns the batch summary.

    Two passes over the batch, one per sink. The counters are observed while the log is
    written, so the summary costs no third pass.
    """
    seen = Observation()
    batch = scoring.score_batch(df, contract, spec, score, allowed_values, seen)
    writers.append_log(scoring.prediction_log(batch.scored, request_id, model_version, at, features, key), log_path)
    writers.append_log(scoring.dead_letters(batch.dead, request_id, at, features, key), dead_path)
    counters = rules.batch_counters()
    schema = ", ".join(f"{name} bigint" for name in counters)
    return df.sparkSession.createDataFrame([tuple(int(seen.get[name]) for name in counters)], schema)
