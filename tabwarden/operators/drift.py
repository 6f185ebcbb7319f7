"""Distribution drift between a baseline and current statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwarden import fixed
from tabwarden.functions import stats
from tabwarden.operators.profile import long_cells


def compare_distributions(expected: DataFrame, actual: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Union of keys of two ``(feature, value, ratio)`` tables with both shares.

    The sides are stacked and regrouped instead of joined: one shuffle on the key, no
    null-safe outer join, and an absent side is simply a NULL share.
    """
    e = expected.select(*by, "feature", "value", F.col("ratio").alias("expected"), F.lit(None).cast("double").alias("actual"))
    a = actual.select(*by, "feature", "value", F.lit(None).cast("double").alias("expected"), F.col("ratio").alias("actual"))
    return (
        e.unionByName(a)
        .groupBy(*by, "feature", "value")
        .agg(F.max("expected").alias("expected"), F.max("actual").alias("actual"))
    )


def psi(expected: DataFrame, actual: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Population stability index per feature present on both sides."""
    both = compare_distributions(expected, actual, by)
    scored = both.groupBy(*by, "feature").agg(
        F.round(F.sum(stats.psi_term(F.col("expected"), F.col("actual"))), 4).alias("score"),
        F.count("expected").alias("_e"),
        F.count("actual").alias("_a"),
    )
    return scored.where((F.col("_e") > 0) & (F.col("_a") > 0)).drop("_e", "_a")


def psi_against(expected: DataFrame, actual: DataFrame, by: Sequence[str]) -> DataFrame:
    """PSI of many groups against one baseline, without a copy of the baseline per group.

    A baseline value that a group lacks adds ``term(e, floor)``. The sum of that over the whole
    baseline is one number per feature; values a group does have are then exchanged for their
    real term, so only rows of the groups themselves are joined.
    """
    absent = stats.psi_term(F.col("expected"), F.lit(None).cast("double"))
    e = expected.select(F.col("feature").alias("_f"), F.col("value").alias("_v"), F.col("ratio").alias("expected"))
    # One row per feature.
    base = e.groupBy(F.col("_f").alias("_bf")).agg(F.sum(absent).alias("_base"))
    joined = actual.join(e, (F.col("feature") == F.col("_f")) & F.col("value").eqNullSafe(F.col("_v")), "left")
    change = stats.psi_term(F.col("expected"), F.col("ratio")) - F.when(F.col("expected").isNotNull(), absent).otherwise(0.0)
    per_group = joined.groupBy(*by, "feature").agg(F.sum(change).alias("_change"))
    return per_group.join(base, F.col("feature") == F.col("_bf")).select(
        *by, "feature", F.round(F.col("_change") + F.col("_base"), 4).alias("score")
    )


def mean_shift(expected: DataFrame, actual: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Relative mean shift per feature from two ``(feature, mean)`` tables."""
    a = actual.select(*by, "feature", F.col("mean").alias("_actual"))
    # One row per feature (and group) on both sides.
    return expected.join(a, [*by, "feature"]).select(
        *by, "feature", F.round(stats.mean_shift(F.col("mean"), F.col("_actual")), 4).alias("score")
    )


def verdicts(
    psi_scores: DataFrame | None,
    shift_scores: DataFrame | None,
    by: Sequence[str] = (),
    psi_threshold: float = fixed.PSI_THRESHOLD,
    shift_threshold: float = fixed.MEAN_SHIFT_THRESHOLD,
    missing_is_drift: bool = False,
) -> DataFrame:
    """``(by…, feature, type, metric, score, is_drifted)``; thresholds are strict."""
    parts = []
    for scores, kind, metric, limit in (
        (psi_scores, "categorical", "psi", psi_threshold),
        (shift_scores, "numerical", "relative_mean_shift", shift_threshold),
    ):
        if scores is not None:
            parts.append(
                scores.select(
                    *by,
                    "feature",
                    F.lit(kind).alias("type"),
                    F.lit(metric).alias("metric"),
                    "score",
                    F.coalesce(F.col("score") > limit, F.lit(missing_is_drift)).alias("is_drifted"),
                )
            )
    if not parts:
        raise ValueError("drift needs at least one side with features")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def missing_shift(baseline: DataFrame, current: DataFrame, section: str, threshold: float) -> DataFrame:
    """Verdicts on the share of missing cells: how far it has moved, either way."""

    def ratios(report: DataFrame, name: str) -> DataFrame:
        cell = F.when((F.col("stat") == "missing_ratio") | ((F.col("stat") == "ratio") & F.col("value").isNull()), F.col("number"))
        return report.where(F.col("section") == section).groupBy("feature", "feature_type").agg(F.coalesce(F.max(cell), F.lit(0.0)).alias(name))

    both = ratios(baseline, "e").join(ratios(current, "a").drop("feature_type"), "feature")  # a row a feature
    score = F.round(F.abs(F.col("a") - F.col("e")), 4)
    return both.select("feature", F.col("feature_type").alias("type"), F.lit("missing_ratio_shift").alias("metric"), score.alias("score"), (score > threshold).alias("is_drifted"))


def detect(baseline: DataFrame, current: DataFrame, section: str = "features", missing_threshold: float | None = None, **options) -> DataFrame:
    """Verdict per feature from two long baseline reports.

    The type comes from the baseline; features without current statistics are left out. With
    ``missing_threshold`` each feature also gets a verdict on its share of missing cells.
    """
    def shares(report: DataFrame) -> DataFrame:
        # The type is a literal in each branch of a fresh report: the other branch is pruned.
        rows = report.where((F.col("section") == section) & (F.col("feature_type") == "categorical"))
        return rows.select("feature", "value", F.col("number").alias("ratio"))

    def means(report: DataFrame) -> DataFrame:
        rows = report.where((F.col("section") == section) & (F.col("feature_type") == "numerical") & (F.col("stat") == "mean"))
        return rows.select("feature", F.col("number").alias("mean"))

    found = verdicts(psi(shares(baseline), shares(current)), mean_shift(means(baseline), means(current)), **options)
    return found if missing_threshold is None else found.unionByName(missing_shift(baseline, current, section, missing_threshold))


def skipped_features(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Baseline features that current data does not have."""
    return baseline.select("feature").distinct().join(current.select("feature").distinct(), "feature", "left_anti")


def summary(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts of verdicts; one without a score, whose live cells are all missing, was not judged unless it is drift."""
    aggs: list[Column] = [
        F.count(F.lit(1)).alias("total_features_evaluated"),
        F.count_if("is_drifted").alias("drifted_features_count"),
        F.count_if(F.col("score").isNull() & ~F.col("is_drifted")).alias("features_not_judged"),
        F.coalesce(F.bool_or("is_drifted"), F.lit(False)).alias("drift_detected"),
    ]
    return report.groupBy(*by).agg(*aggs) if by else report.agg(*aggs)


def tagged_distribution(df: DataFrame, columns: Sequence[str], is_actual: Column) -> DataFrame:
    """Both shares of every value in one scan and one shuffle, for two parts of one table."""
    counts = (
        long_cells(df.withColumn("_actual", is_actual), columns, ["_actual"])
        .groupBy("feature", "value")
        .agg(F.count_if("_actual").alias("a"), F.count_if(~F.col("_actual")).alias("e"))
    )
    # Every column has the same totals; the shuffle of the counts is reused for them.
    k = len(columns)
    totals = counts.agg(F.struct(F.expr(f"sum(a) div {k}").alias("a"), F.expr(f"sum(e) div {k}").alias("e")).alias("t")).scalar()
    share = {n: F.try_divide(F.col(c).cast("double"), F.col(f"_t.{c}").cast("double")).alias(n) for n, c in (("expected", "e"), ("actual", "a"))}
    return counts.withColumn("_t", totals).select("feature", "value", share["expected"], share["actual"])
