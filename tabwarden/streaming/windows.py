"""Event-time windows of feature statistics, the same for batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwarden.operators import drift


def event_time(df: DataFrame, at: str) -> DataFrame:
    """Zone-less times as UTC instants, whatever the session zone: watermarks need instants."""
    if not zone_less(df, at):
        return df
    return df.withColumn(at, F.from_utc_timestamp(F.col(at).cast("timestamp"), F.current_timezone()))


def wall_time(c: Column) -> Column:
    """UTC instants back to zone-less times."""
    return F.to_utc_timestamp(c, F.current_timezone()).cast("timestamp_ntz")


def zone_less(df: DataFrame, at: str) -> bool:
    return isinstance(df.schema[at].dataType, T.TimestampNTZType)


def windowed_stats(
    df: DataFrame,
    at: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    size: str,
    slide: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """``(window_start, window_end, feature, numeric, value, n, total)`` in one stateful aggregation.

    Windows are of the type of ``at``; zone-less times count as UTC.

    Categories count in ``n`` under their ``value``; numeric features have a NULL value, the
    count of present cells in ``n`` and their sum in ``total``.
    """
    timed = event_time(df, at).withWatermark(at, watermark) if watermark else df
    empty = F.lit(None)
    cells = [
        F.struct(F.lit(c).alias("feature"), F.lit(False).alias("numeric"), F.col(c).cast("string").alias("value"), empty.cast("double").alias("x"))
        for c in categorical
    ] + [
        F.struct(F.lit(c).alias("feature"), F.lit(True).alias("numeric"), empty.cast("string").alias("value"), F.col(c).cast("double").alias("x"))
        for c in numeric
    ]
    long = timed.select(at, F.explode(F.array(*cells)).alias("_c")).select(at, "_c.*")
    keys = ["feature", "numeric", "value"]
    counts = [F.count_if(~F.col("numeric") | F.col("x").isNotNull()).alias("n"), F.sum("x").alias("total")]
    if slide and not watermark and pd.Timedelta(size) % pd.Timedelta(slide) == pd.Timedelta(0):
        # A batch is summed per pane of one slide first; only pane sums are copied to windows.
        panes = long.groupBy(F.window(at, slide).alias("_p"), *keys).agg(*counts)
        windows = panes.groupBy(F.window(F.col("_p.start"), size, slide).alias("w"), *keys)
        grouped = windows.agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    else:
        frame = F.window(at, size, slide) if slide else F.window(at, size)
        grouped = long.groupBy(frame.alias("w"), *keys).agg(*counts)
    start, end = F.col("w.start"), F.col("w.end")
    if watermark and zone_less(df, at):
        start, end = wall_time(start), wall_time(end)
    return grouped.select(start.alias("window_start"), end.alias("window_end"), *keys, "n", "total")


def shares(stats: DataFrame) -> DataFrame:
    """Category shares per window, from ``windowed_stats``. A window has one total per feature,
    summed from its counts."""
    rows = stats.where(~F.col("numeric"))
    totals = rows.groupBy("window_start", "feature").agg(F.sum("n").alias("_t"))
    return rows.join(totals, ["window_start", "feature"]).select(
        "window_start", "window_end", "feature", "value", "n", (F.col("n") / F.col("_t")).alias("ratio")
    )


def means(stats: DataFrame) -> DataFrame:
    rows = stats.where("numeric")
    return rows.select(
        "window_start", "window_end", "feature", F.try_divide(F.col("total"), F.col("n").cast("double")).alias("mean")
    )


def drift_against(stats: DataFrame, expected_shares: DataFrame, expected_means: DataFrame) -> DataFrame:
    """Verdicts per window against one fixed baseline."""
    actual = means(stats)
    known = actual.select("window_start", "feature").join(expected_means.select("feature", "mean"), "feature")
    return drift.verdicts(
        drift.psi_against(expected_shares, shares(stats), ["window_start"]),
        drift.mean_shift(known, actual, ["window_start"]),
        ["window_start"],
    )


def drift_against_previous(stats: DataFrame, step: str) -> DataFrame:
    """Verdicts of each window against the one ``step`` before it."""
    later = F.col("window_start") + F.expr(f"INTERVAL {step}")
    now_shares, now_means = shares(stats), means(stats)
    # Only windows that exist can be judged; the shifted side may name one beyond the last.
    old_shares = now_shares.select(later.alias("window_start"), "feature", "value", "ratio")
    old_means = now_means.select(later.alias("window_start"), "feature", "mean")
    return drift.verdicts(
        drift.psi(old_shares, now_shares.select("window_start", "feature", "value", "ratio"), ["window_start"]),
        drift.mean_shift(old_means, now_means.select("window_start", "feature", "mean"), ["window_start"]),
        ["window_start"],
    )
