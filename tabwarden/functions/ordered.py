"""Exact running totals over a global order without one task seeing the whole order."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Pieces of a global order for each shuffle partition of the session, so that AQE can even them out.
PIECES_PER_PARTITION = 4


def value_bucket(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """Add ``_bucket``: the position of ``column`` among ``buckets`` quantile bounds.

    The bounds come from a sketch of ``df`` itself that runs as a scalar subquery of the same
    plan and reuses its shuffle. They only decide which task sees a value, never the result.
    """
    steps = [i / buckets for i in range(1, buckets)]
    sketch = F.array_distinct(F.percentile_approx(F.col(column).cast("double"), steps, max(1000, 2 * buckets)))
    # Two short searches instead of a long one: among every ``stride``-th bound, then between two.
    stride = max(1, math.isqrt(buckets))
    coarse = F.filter("b", lambda _, i: i % stride == 0)
    bounds = df.agg(sketch.alias("b")).select(F.struct("b", coarse.alias("c")).alias("s"))
    x = F.col(column)
    rank = F.size(F.filter("_bounds.c", lambda b: b < x))
    start = (rank - 1) * stride
    inside = F.size(F.filter(F.slice("_bounds.b", start + 1, F.lit(stride)), lambda b: b < x))
    return (
        df.withColumn("_bounds", bounds.scalar())
        # Never NULL, so no null filter is pushed into one of the two uses and the shuffle of
        # ``df`` stays shared.
        .withColumn("_bucket", F.coalesce(F.when(rank <= 0, 0).otherwise(start + inside), F.lit(0)))
        .drop("_bounds")
    )


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    totals: Mapping[str, str],
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Add, per ``by`` group, inclusive running sums along ``order``.

    ``totals`` maps a source column to the name of its running sum. The order is cut by value:
    each task sums one (group, bucket), and a table with one row per (group, bucket) carries the
    sums of the buckets before. The number of buckets follows the session's shuffle partitions.
    """
    group = F.struct(*by) if by else F.lit(0)  # equal where its cells are, NULLs too
    direction = F.col(order).desc() if descending else F.col(order).asc()
    if buckets is None:
        buckets = PIECES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = value_bucket(df, order, buckets).withColumn("_group", group)
    bucket_dir = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    before = Window.partitionBy("_group").orderBy(bucket_dir).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy("_group", "_bucket")
        .agg(*[F.sum(src).alias(f"_sum_{src}") for src in totals])
        .select(
            "_group",
            "_bucket",
            *[F.coalesce(F.sum(f"_sum_{src}").over(before), F.lit(0)).alias(f"_before_{src}") for src in totals],
        )
    )
    inside = Window.partitionBy("_group", "_bucket").orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({name: F.sum(src).over(inside) for src, name in totals.items()})
    joined = local.join(offsets, ["_group", "_bucket"])
    return joined.withColumns({name: F.col(name) + F.col(f"_before_{src}") for src, name in totals.items()}).drop(
        "_group", "_bucket", *[f"_before_{src}" for src in totals]
    )
