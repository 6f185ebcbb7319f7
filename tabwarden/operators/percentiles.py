"""Exact interpolated percentiles at any size.

The built-in ``percentile`` keeps a map of all distinct values in one task. Here a sketch first
brackets every wanted rank; then one scan counts the rows below each bracket and the values inside,
which are stored, cut into slices and sorted slice by slice. The input is scanned twice, and only
values near a wanted rank are shuffled. Other statistics can ride along with the sketch.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, Window
from pyspark.sql import functions as F

from tabwarden.functions import sizing

#: The sketch is off by at most 1/ACCURACY of the rows; brackets are twice as wide.
ACCURACY = 1000
SLICES = 1024
#: Inputs up to this many values get a bracket as wide as the column.
WIDE_ROWS = 50 * ACCURACY


def _brackets(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float], others: Sequence[Column]) -> tuple[list[tuple], Row]:
    """``(id, feature, prob, lo, hi, rank, frac)`` of every wanted point that has values, and the other aggregates."""
    slack = 2.0 / ACCURACY
    lows = [max(p - slack, 0.0) for p in probs.values()]
    highs = [min(p + slack, 1.0) for p in probs.values()]
    stats = list(others)
    for i, name in enumerate(columns):
        c = F.col(name).cast("double")
        stats += [F.count(c).alias(f"_n{i}"), F.min(c).alias(f"_a{i}"), F.max(c).alias(f"_b{i}")]
        stats.append(F.percentile_approx(c, lows + highs, ACCURACY).alias(f"_q{i}"))
    row = df.agg(*stats).first()
    out = []
    for i, name in enumerate(columns):
        n = row[f"_n{i}"]
        if not n:
            continue
        for j, (prob, p) in enumerate(probs.items()):
            narrow = n > WIDE_ROWS
            lo = row[f"_q{i}"][j] if narrow and lows[j] > 0 else row[f"_a{i}"]
            hi = row[f"_q{i}"][j + len(probs)] if narrow and highs[j] < 1 else row[f"_b{i}"]
            out.append(bracket(len(out), name, prob, lo, hi, p, n))
    return out, row


def bracket(i: int, column: str, prob: str, lo: float, hi: float, p: float, n: int) -> tuple:
    """A wanted point: the values that hold it, its rank among ``n`` values, and how far it lies towards the next."""
    place = float(p) * (n - 1)
    return i, column, prob, float(lo), float(hi), math.floor(place), place - math.floor(place)


def exact_percentiles(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """One row per column: ``feature`` and one DOUBLE per entry of ``probs``. Both scans run when this is called."""
    return percentiles_and(df, columns, probs, [])[0]


def percentiles_and(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float], others: Sequence[Column]) -> tuple[DataFrame, Row]:
    """``exact_percentiles``, and other aggregates of the same rows from the first of the two scans."""
    brackets, row = _brackets(df, columns, probs, others)
    return settled(df, columns, probs, brackets), row


def settled(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float], brackets: list[tuple], bounds: Mapping[str, tuple] | None = None) -> DataFrame:
    """The points that the brackets hold, from one scan.

    With ``bounds`` (least and largest value of a column) brackets may be wrong: one that does not hold
    its point is replaced by the bounds, at the price of another scan.
    """
    spark = df.sparkSession
    # Columns times probabilities: as many rows as the caller wrote down.
    every = spark.createDataFrame([(c,) for c in columns], "feature string")
    if not brackets:
        return every.select("feature", *[F.lit(None).cast("double").alias(p) for p in probs])
    table = F.broadcast(
        spark.createDataFrame(brackets, "id int, feature string, prob string, lo double, hi double, rank bigint, frac double")
    )

    def value(name: str) -> Column:
        return F.col(name).cast("double")

    seen = Observation()
    watched = df.observe(seen, *[F.count_if(value(name) < lo).alias(f"_{i}") for i, name, _, lo, *_ in brackets])
    inside = [value(name).between(lo, hi) for _, name, _, lo, hi, *_ in brackets]
    any_inside = inside[0]
    for hit in inside[1:]:
        any_inside = any_inside | hit
    hits = F.array_compact(
        F.array(
            *[F.when(hit, F.struct(F.lit(b[0]).alias("id"), value(b[1]).alias("value"))) for hit, b in zip(inside, brackets)]
        )
    )
    counted = watched.where(any_inside).select(F.inline(hits)).groupBy("id", "value").agg(F.count(F.lit(1)).alias("n"))
    counted = sizing.cut_lineage(counted, "percentiles")
    if bounds:
        inside_ = dict(counted.groupBy("id").agg(F.sum("n")).collect())  # a row a bracket
        wrong = {b[0] for b in brackets if not seen.get[f"_{b[0]}"] <= b[5] <= b[5] + (b[6] > 0) < seen.get[f"_{b[0]}"] + inside_.get(b[0], 0)}
        if wrong:
            return settled(df, columns, probs, [(*b[:3], *map(float, bounds[b[1]]), *b[5:]) if b[0] in wrong else b for b in brackets])
    below = spark.createDataFrame([(i, seen.get[f"_{i}"]) for i, *_ in brackets], "id int, below bigint")
    width = F.col("hi") - F.col("lo")
    piece = F.when(width <= 0, 0).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width * SLICES), F.lit(SLICES - 1))
    )
    sliced = counted.join(table, "id").select("id", "value", "n", piece.cast("int").alias("slice"))

    before = Window.partitionBy("id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy("id", "slice")
        .agg(F.sum("n").alias("m"))
        .withColumn("in_front", F.coalesce(F.sum("m").over(before), F.lit(0)))
        .join(F.broadcast(below), "id")
        .join(table, "id")
        .withColumn("start", F.col("below") + F.col("in_front"))
        # Slices that hold the rank or the one after it: at most two per point.
        .where((F.col("start") + F.col("m") > F.col("rank")) & (F.col("start") <= F.col("rank") + 1))
        .select("id", "slice", "start", "rank", "frac")
    )
    in_slice = Window.partitionBy("id", "slice").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        sliced.join(F.broadcast(starts), ["id", "slice"])
        .withColumn("end", F.col("start") + F.sum("n").over(in_slice))
        .withColumn("begin", F.col("end") - F.col("n"))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("begin") <= rank) & (rank < F.col("end")), F.col("value")))

    pairs = placed.groupBy("id", "frac").agg(at(F.col("rank")).alias("a"), at(F.col("rank") + 1).alias("b"))
    point = F.col("a") + (F.coalesce(F.col("b"), F.col("a")) - F.col("a")) * F.col("frac")
    points = pairs.select("id", point.alias("v")).join(table, "id")
    wide = points.groupBy("feature").agg(*[F.max(F.when(F.col("prob") == p, F.col("v"))).alias(p) for p in probs])
    return every.join(F.broadcast(wide), "feature", "left")
