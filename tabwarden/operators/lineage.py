"""Lineage reports: one row per run or per part, assembled from other operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwarden.functions import sizing
from tabwarden.operators import fingerprint as fp


def ingestion(raw: DataFrame, split: DataFrame, split_col: str, columns: Sequence[str], target: str) -> DataFrame:
    """Rows, share, fingerprint and rows per target value of the raw table, the cleaned table and
    every part.

    The cleaned table is the union of its parts: its fingerprint and its counts are added up from
    theirs, and those from one stored row per part and class, so the split is scanned once. Target counts are ``value=n`` texts in the order of the values; the raw table, whose
    target is not cleaned yet, has none.
    """
    raw_row = fp.fingerprint(raw).select(F.lit("raw").alias("dataset"), "n_rows", "hash_sum", "hash_xor")
    label = F.coalesce(F.col(target).cast("string"), F.lit("null"))
    tagged = split.withColumns({"_dataset": F.col(split_col), "_value": label})
    per = sizing.cut_lineage(fp.fingerprint(tagged, columns, by=["_dataset", "_value"]), "lineage")
    sums = [
        F.sum("n_rows").alias("n_rows"),
        F.sum(F.col("hash_sum").cast("decimal(38,0)")).cast("decimal(38,0)").cast("string").alias("hash_sum"),
        F.bit_xor("hash_xor").alias("hash_xor"),
    ]
    parts = per.groupBy(F.col("_dataset").alias("dataset")).agg(*sums)
    whole = per.agg(*sums).select(F.lit("cleaned").alias("dataset"), "n_rows", "hash_sum", "hash_xor")
    total = per.agg(F.sum("n_rows")).scalar()
    per_class = per.select(F.col("_dataset").alias("dataset"), F.col("_value").alias("value"), F.col("n_rows").alias("n"))
    every = per_class.unionByName(per_class.groupBy("value").agg(F.sum("n").alias("n")).withColumn("dataset", F.lit("cleaned")))
    cell = F.struct("value", F.concat_ws("=", "value", F.col("n").cast("string")).alias("text"))
    # One entry per class of the target.
    classes = every.groupBy("dataset").agg(F.array_sort(F.collect_list(cell))["text"].alias("target_counts"))
    out = raw_row.unionByName(whole).unionByName(parts).join(classes, "dataset", "left")
    is_part = ~F.col("dataset").isin("raw", "cleaned")
    return out.withColumn("ratio", F.when(is_part, F.round(F.col("n_rows") / total, 4)))


def transformation(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], cardinality: DataFrame) -> DataFrame:
    """One row: fingerprint of the training rows, feature groups and encoded widths."""
    widths = cardinality.agg(
        F.coalesce(F.sum("linear_outputs"), F.lit(0)).alias("l"), F.coalesce(F.sum("tree_outputs"), F.lit(0)).alias("t")
    )
    w = widths.select(F.struct("l", "t").alias("w")).scalar()
    return fp.fingerprint(train, [*numeric, *categorical]).withColumn("_w", w).select(
        "n_rows",
        "hash_sum",
        "hash_xor",
        F.lit(len(numeric)).alias("numeric_features"),
        F.lit(len(categorical)).alias("categorical_features"),
        (F.lit(len(numeric)) + F.col("_w.l")).alias("linear_width"),
        (F.lit(len(numeric)) + F.col("_w.t")).alias("tree_width"),
    )


def training(train: DataFrame, columns: Sequence[str], summary: DataFrame) -> DataFrame:
    """Per model: cross-validation summary next to the fingerprint of the training rows."""
    stamp = fp.fingerprint(train, columns).select(F.struct("n_rows", "hash_sum").alias("s")).scalar()
    return summary.withColumn("_s", stamp).select(
        *summary.columns, F.col("_s.n_rows").alias("train_rows"), F.col("_s.hash_sum").alias("train_hash_sum")
    )


def evaluation(metrics: DataFrame, decision: DataFrame) -> DataFrame:
    """Per candidate: its metrics, whether it was chosen, and the approval."""
    return metrics.join(
        decision.select(F.col("best_model").alias("model"), F.lit(True).alias("_best"), "approved", "reason"), "model", "left"
    ).select(
        "model", "recall", "precision", "f1", F.coalesce("_best", F.lit(False)).alias("is_best"), "approved", "reason"
    )
