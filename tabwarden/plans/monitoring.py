"""Monitoring run: live window, statistics, drift, trigger decision."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwarden import fixed
from tabwarden.operators import clean, drift, profile
from tabwarden.operators.trigger import action, cooldown_active


@dataclass
class MonitoringRun:
    verdicts: DataFrame
    summary: DataFrame
    skipped: DataFrame


def compare_windows(baseline: DataFrame, live: DataFrame, exclude: Sequence[str] = (), **thresholds) -> MonitoringRun:
    """Drift of live rows against baseline rows. Only means and shares enter a verdict, so the
    reports leave percentiles out."""
    b = profile.baseline_report(baseline, exclude=exclude, percentiles=False)
    return against_stored(b, live, exclude, _types(baseline, exclude), **thresholds)


def _types(df: DataFrame, exclude: Sequence[str]) -> dict[str, str]:
    numeric, categorical = clean.feature_groups(df, exclude=exclude)
    return {c: "numerical" for c in numeric} | {c: "categorical" for c in categorical}


def against_stored(
    report: DataFrame, live: DataFrame, exclude: Sequence[str] = (), types: Mapping[str, str] | None = None, **thresholds
) -> MonitoringRun:
    """Drift of live rows against a stored baseline report.

    No live rows is an error: an empty window says nothing about drift, and has no baseline. A feature whose type has
    changed between the two sides is drifted, by the metric ``type_changed``.
    """
    try:
        c = profile.baseline_report(live, exclude=exclude, percentiles=False)
    except profile.NoRows:
        raise profile.NoRows("no live rows to compare with the baseline") from None
    verdicts = drift.detect(report, c, **thresholds)
    if types is None:  # one row per feature of the stored report
        types = dict(report.where("section = 'features'").select("feature", "feature_type").distinct().collect())
    now = _types(live, exclude)
    changed = [(f, t, "type_changed", None, True) for f, t in sorted(types.items()) if now.get(f, t) != t]
    if changed:
        verdicts = verdicts.unionByName(live.sparkSession.createDataFrame(changed, verdicts.schema))
    return MonitoringRun(verdicts, drift.summary(verdicts), drift.skipped_features(report, c))


def decide(summary: DataFrame, state: DataFrame, asof: str, days: int = fixed.COOLDOWN_DAYS) -> DataFrame:
    """One decision row from a drift summary and the trigger table ``(fired_at)``."""
    last = state.agg(F.max("fired_at")).scalar()
    now = F.lit(asof).cast("timestamp_ntz")
    return summary.withColumn("last_trigger", last).withColumn(
        "action", action(F.col("drift_detected"), cooldown_active(now, F.col("last_trigger"), days))
    )
