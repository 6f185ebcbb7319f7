"""Choosing a candidate and comparing it with the champion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwarden import fixed


def rank_candidates(metrics: DataFrame, name: str = "model") -> DataFrame:
    """Candidates by recall, best first; equal recalls by name."""
    return metrics.orderBy(F.desc("recall"), name)


def select_candidate(
    metrics: DataFrame, by: Sequence[str] = (), name: str = "model", tolerance: float = fixed.RECALL_TOLERANCE
) -> DataFrame:
    """Walk the candidates of a group by falling recall and keep the current best; a candidate
    within ``tolerance`` of it and more precise takes over, from then on setting the mark.

    The walk is a fold over one array per group: as many entries as there are models.
    """
    entry = F.struct((-F.col("recall")).alias("k"), F.col(name).alias("name"), "recall", "precision")
    lists = metrics.groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("c"))

    def step(best, cand):
        # Rates carry six decimals; rounding the gap removes float noise.
        near = F.abs(F.round(best["recall"] - cand["recall"], 6)) <= tolerance
        return F.when(near & (cand["precision"] > best["precision"]), cand).otherwise(best)

    folded = lists.withColumn("b", F.aggregate(F.expr("slice(c, 2, greatest(size(c) - 1, 0))"), F.col("c")[0], step))
    return folded.select(*by, F.col("b.name").alias("best_model"), F.col("b.recall").alias("recall"), F.col("b.precision").alias("precision"))


def champion_decision(
    candidate: DataFrame,
    champion: DataFrame,
    on: Sequence[str] = (),
    min_gain: float = fixed.MIN_RECALL_GAIN,
) -> DataFrame:
    """Approve without a champion, or with enough recall gained over it.

    Both sides have one row (per ``on`` group); recalls carry six decimals, so the gain is
    rounded to six before the comparison.
    """
    right = champion.select(*on, F.col("recall").alias("champion_recall"))
    if on:
        joined = candidate.join(right, list(on), "left")
    else:
        joined = candidate.withColumn("champion_recall", right.select(F.max("champion_recall")).scalar())
    gain = F.round(F.col("recall") - F.col("champion_recall"), 6)
    return (
        joined.withColumn("gain", gain)
        .withColumn("approved", F.col("champion_recall").isNull() | (F.col("gain") >= min_gain))
        .withColumn(
            "reason",
            F.when(F.col("champion_recall").isNull(), "approved: no champion")
            .when(F.col("approved"), "approved: enough gain")
            .otherwise("rejected: gain below threshold"),
        )
    )
