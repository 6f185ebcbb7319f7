"""Statistics as mergeable state per day, so that a window is put together without reading a row again.

State of a day: for each categorical column its value counts, exact; for each numeric column counts, mean
and squared deviations, bounds, a KLL sketch of its quantiles and an HLL sketch of its distinct values.
States of any days merge into the long baseline format, so drift works on them as on fresh reports.

Quantiles from a merged sketch are off by at most ``RANK_ERROR`` of the rows in rank (with probability
0.99 each), distinct counts by about ``DISTINCT_ERROR`` (standard error). ``refined`` makes quantiles exact:
the sketch brackets each of them, and one scan of the window's rows settles it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwarden import fixed
from tabwarden.operators import percentiles
from tabwarden.operators.profile import NoRows, _section

#: Size of the KLL sketch, and what follows from it; the same for HLL (2**LG cells).
K, LG = 2048, 14
RANK_ERROR, DISTINCT_ERROR = 2.296 / K**0.9021, 1.04 / 2 ** (LG / 2)

SCHEMA = (
    "day date, feature string, numeric boolean, value string, n bigint, present bigint, mean double, m2 double, "
    "min double, max double, kll binary, hll binary"
)


def daily(df: DataFrame, at: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """States of every day that has rows, from one scan. Rows without a time belong to no day and are left out."""
    none = F.lit(None)
    cells = [F.struct(F.lit(c).alias("feature"), F.lit(True).alias("numeric"), none.cast("string").alias("value"), F.col(c).cast("double").alias("x")) for c in numeric]
    cells += [F.struct(F.lit(c).alias("feature"), F.lit(False).alias("numeric"), F.col(c).cast("string").alias("value"), none.cast("double").alias("x")) for c in categorical]
    long = df.where(F.col(at).isNotNull()).select(F.to_date(at).alias("day"), F.inline(F.array(*cells)))
    x = F.col("x")
    grouped = long.groupBy("day", "feature", "numeric", "value").agg(
        F.count(F.lit(1)).alias("n"), F.count(x).alias("present"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"),
        F.min(x).alias("min"), F.max(x).alias("max"), F.kll_sketch_agg_double(x, K).alias("kll"), F.hll_sketch_agg(F.hash(x), LG).alias("hll"),
    )
    only = {c: F.when(F.col("numeric"), F.col(c)).alias(c) for c in ("kll", "hll")}
    return grouped.select(*[only.get(c, F.col(c)) for c in (f.split()[0] for f in SCHEMA.split(", "))])


def store(states: DataFrame, path: str) -> None:
    """Write states, a folder a day. A day that comes again replaces its folder; the others stay."""
    states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def window(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """Stored states of the days from ``first`` to ``last``; no other folder is read."""
    return spark.read.schema(SCHEMA).parquet(path).where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def merged(states: DataFrame) -> DataFrame:
    """One state for all days: rows as in ``daily``, without ``day``."""
    moments = F.aggregate(
        F.sort_array(F.collect_list(F.when(F.col("present") > 0, F.struct("day", F.col("present").cast("double").alias("n"), "mean", "m2")))),  # a row a day
        F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2")),
        lambda a, b: F.struct(
            (a["n"] + b["n"]).alias("n"),
            (a["mean"] + (b["mean"] - a["mean"]) * b["n"] / (a["n"] + b["n"])).alias("mean"),
            (a["m2"] + b["m2"] + (b["mean"] - a["mean"]) * (b["mean"] - a["mean"]) * a["n"] * b["n"] / (a["n"] + b["n"])).alias("m2"),
        ),
    )
    rows = states.groupBy("feature", "numeric", "value").agg(
        F.sum("n").alias("n"), F.sum("present").alias("present"), moments.alias("_m"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("kll").alias("kll"), F.hll_union_agg("hll").alias("hll"),
    )
    some = F.col("present") > 0
    return rows.select("feature", "numeric", "value", "n", "present", F.when(some, F.col("_m.mean")).alias("mean"), F.when(some, F.col("_m.m2")).alias("m2"), "min", "max", "kll", "hll")


def report(state: DataFrame) -> DataFrame:
    """The long baseline of a merged state; percentiles and distinct values are estimates."""
    if state.isEmpty():
        raise NoRows("baseline of no rows")
    some = F.col("present") > 0
    at = {name: F.when(some, F.kll_sketch_get_quantile_double("kll", F.lit(p))) for name, p in fixed.QUANTILES.items()}
    stats = {
        "missing_ratio": 1 - F.col("present") / F.col("n"), "mean": F.col("mean"),
        "std": F.when(F.col("present") > 1, F.sqrt(F.col("m2") / (F.col("present") - 1))), "min": F.col("min"), "max": F.col("max"),
        **at, "unique_values": F.when(some, F.hll_sketch_estimate("hll")).otherwise(0).cast("double"),
    }
    cells = F.array(*[F.struct(F.lit(n).alias("stat"), c.cast("double").alias("number")) for n, c in stats.items()])
    numbers = state.where("numeric").select("feature", F.inline(cells))
    values = state.where("NOT numeric")
    # A day's columns all have its rows, so every categorical column has the same total.
    total = values.groupBy(F.col("feature").alias("_f")).agg(F.sum("n").alias("_total"))
    shares = values.join(total, F.col("feature") == F.col("_f")).select("feature", "value", F.lit("ratio").alias("stat"), (F.col("n") / F.col("_total")).alias("number"))
    return _section(numbers, "features", "numerical", F.lit(None).cast("string")).unionByName(_section(shares, "features", "categorical", F.col("value")))


def refined(state: DataFrame, rows: DataFrame, probs: dict[str, float] = fixed.QUANTILES) -> DataFrame:
    """Exact interpolated percentiles of the window whose merged state and rows these are; one scan of the rows."""
    slack = 4 * RANK_ERROR
    near = lambda p, by: F.kll_sketch_get_quantile_double("kll", F.lit(min(max(p + by, 0.0), 1.0)))
    known = state.where("numeric").select("feature", F.when(F.col("present") > 0, F.array(*[F.struct(near(p, -slack).alias("lo"), near(p, slack).alias("hi")) for p in probs.values()])).alias("at"), "present", "min", "max").collect()
    brackets = []
    for r in known:  # a row a column
        for (name, p), cell in zip(probs.items(), r["at"] or []):
            lo = r["min"] if p - slack <= 0 else cell["lo"]
            hi = r["max"] if p + slack >= 1 else cell["hi"]
            brackets.append(percentiles.bracket(len(brackets), r["feature"], name, lo, hi, p, r["present"]))
    columns = [r["feature"] for r in known]
    return percentiles.settled(rows, columns, probs, brackets, {r["feature"]: (r["min"], r["max"]) for r in known})
