"""Delayed labels: arrival, joining with predictions, curated training sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def new_labels(labels: DataFrame, processed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Labels that no earlier run has used."""
    return labels.join(processed.select(*key), list(key), "left_anti")


def latest_before(
    facts: DataFrame, history: DataFrame, key: Sequence[str], at: str, value: str, bucket: str = "DAY"
) -> DataFrame:
    """As-of join: each fact with the latest ``history`` value of its key at or before ``at``.

    No pairs are built. Both sides are stacked and cut into (key, time bucket) pieces, so a
    key that holds a third of all rows is spread over its buckets; a table with one row per
    piece carries the last value into the pieces after it.

    NULL is a key like any other. A fact without a time keeps its row and gets no value; history
    without a time is at no time.
    """
    key = list(key)
    timeless = facts.where(F.col(at).isNull())
    facts, history = facts.where(F.col(at).isNotNull()), history.where(F.col(at).isNotNull())
    # The history value is wrapped, so that its NULL differs from "no history".
    h = history.select(*key, at, F.struct(F.col(value).alias("v")).alias("_h"), F.lit(None).alias("_f"), F.lit(0).alias("_side"))
    f = facts.select(
        *key, at, F.lit(None).alias("_h"),
        F.struct(*[c for c in facts.columns if c not in (*key, at)]).alias("_f"), F.lit(1).alias("_side"),
    )
    h = h.withColumn("_f", F.lit(None).cast(f.schema["_f"].dataType))
    f = f.withColumn("_h", F.lit(None).cast(h.schema["_h"].dataType))
    both = f.select(*key, at, "_h", "_f", "_side").unionByName(h).withColumn("_b", F.date_trunc(bucket, F.col(at)).cast("timestamp"))
    both = both.withColumn("_k", F.struct(*key)).drop(*key)  # equal where its cells are, NULLs too

    inside = Window.partitionBy("_k", "_b").orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    local = both.withColumn("_local", F.last("_h", ignorenulls=True).over(inside)).where("_side = 1")

    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        both.groupBy("_k", "_b")
        .agg(F.max_by("_h", F.when(F.col("_h").isNotNull(), F.col(at))).alias("_end"))
        .withColumn("_carry", F.last("_end", ignorenulls=True).over(before))
        .drop("_end")
    )
    joined = local.join(carry, ["_k", "_b"])
    found = joined.select("_k.*", at, "_f.*", F.coalesce("_local", "_carry")["v"].alias(value))
    return found.unionByName(timeless.select(*found.columns[:-1], F.lit(None).cast(found.schema[value].dataType).alias(value)))


def performance_gate(metrics: DataFrame, min_f1: float) -> DataFrame:
    """Flag for retraining from joined-label performance."""
    return metrics.withColumn("retraining_required", F.col("f1") < min_f1)


def curate(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Union of the old set and newly labelled rows; a key in both keeps the new row.

    Grouping keeps one row per key on the map side already.
    """
    both = old.withColumn("_rank", F.lit(0)).unionByName(new.withColumn("_rank", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in (*key, "_rank")]
    best = both.groupBy(*key).agg(F.max(F.struct("_rank", *rest)).alias("_best"))
    return best.select(*key, *[F.col(f"_best.{c}").alias(c) for c in rest])
