"""Batch scoring: probabilities, decisions, prediction log and dead letters."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwarden import fixed
from tabwarden.operators import clean as cleaning
from tabwarden.operators import rules
from tabwarden.operators.contract import Contract


def decision(p: Column, threshold: float = fixed.DECISION_THRESHOLD) -> list[Column]:
    """Decision from the unrounded probability, the probability rounded to 4 places."""
    return [F.round(p, 4).alias("probability"), F.when(p >= threshold, "Yes").otherwise("No").alias("decision")]


def row_key(df: DataFrame, key: str) -> Column:
    """The key as text, or a fresh id where the batch has no key column."""
    return F.col(key).cast("string") if key in df.columns else F.expr("uuid()")


def with_probability(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``p``; all input columns stay on their row."""
    out = model.transform(df)
    return out.select(*df.columns, vector_to_array("probability")[1].alias("p"))


def with_foreign_probability(df: DataFrame, predict: Callable[[pd.DataFrame], Sequence[float]]) -> DataFrame:
    """Add ``p`` from a model that only knows pandas frames, Arrow batch by Arrow batch."""
    schema = T.StructType([*df.schema.fields, T.StructField("p", T.DoubleType())])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(p=pd.Series(predict(batch), index=batch.index, dtype="float64"))

    return df.mapInPandas(score, schema)


def prediction_log(
    scored: DataFrame, request_id: Column, model_version: Column, at: Column, features: Sequence[str], key: str
) -> DataFrame:
    """Nested documents, one per scored row."""
    rounded, verdict = decision(F.col("p"))
    return scored.select(
        request_id.alias("request_id"),
        model_version.alias("model_version"),
        at.alias("timestamp_utc"),
        F.struct(*features).alias("raw_features"),
        F.struct(row_key(scored, key).alias("key"), rounded, verdict).alias("prediction_output"),
    )


def dead_letters(invalid: DataFrame, request_id: Column, at: Column, features: Sequence[str], key: str) -> DataFrame:
    """Nested documents, one per rejected row, each with its own errors."""
    return invalid.select(
        request_id.alias("request_id"),
        at.alias("timestamp_utc"),
        F.struct(row_key(invalid, key).alias("key"), *features).alias("raw_features"),
        F.col("errors"),
    )


def flatten(documents: DataFrame, *structs: str) -> DataFrame:
    """Nested documents back to columns; only the asked structs are read from storage."""
    plain = [c for c in documents.columns if c not in structs and not isinstance(documents.schema[c].dataType, (T.StructType, T.ArrayType))]
    return documents.select(*plain, *[f"{s}.*" for s in structs])


def output_violations(scored: DataFrame, p: str = "p") -> DataFrame:
    """Rows whose probability is missing or outside [0, 1]."""
    return scored.where(F.col(p).isNull() | ~F.col(p).between(0, 1))


@dataclass
class ScoredBatch:
    scored: DataFrame
    dead: DataFrame
    summary: DataFrame


def score_batch(
    df: DataFrame,
    contract: Contract,
    spec: cleaning.CleanSpec,
    score: Callable[[DataFrame], DataFrame],
    allowed_values: bool = False,
    seen: Observation | None = None,
) -> ScoredBatch:
    """Clean, check, split and score a batch. All results come from one annotated plan.

    ``seen`` collects the batch counters while the scored side is written.
    """
    annotated = rules.annotate(cleaning.clean(df, spec, "score"), contract, allowed_values)
    counters = rules.batch_counters()
    watched = annotated.observe(seen, *[c.alias(n) for n, c in counters.items()]) if seen else annotated
    return ScoredBatch(score(rules.valid_rows(watched)), rules.invalid_rows(annotated), rules.batch_summary(annotated))
