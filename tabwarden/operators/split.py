"""Reproducible stratified splits that never move the rows.

A row's place in its stratum is its rank by a seeded hash key. Instead of ranking rows,
``hash_cuts`` finds the hash value at each cut rank: counts per (stratum, hash prefix) locate
the prefix that holds the cut, counts per next digits narrow it down, and only the hashes that
are left are ordered one by one. Rows are then compared with their stratum's cuts, in a
map-side join if the stored cuts are small. The table is scanned three times and
never shuffled, however lopsided the strata are; hand in a stored table, not a long plan.
Copies of one key share a hash and stay on one side of a cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwarden import fixed
from tabwarden.functions import cells
from tabwarden.functions.sizing import cut_lineage

#: Hex digits of the hash that name a bucket. Buckets are cut twice by this many.
PREFIX_DIGITS = 3


def _locate(counts: DataFrame, ranks: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Find the ``order`` value that holds each rank of a ``by`` group.

    ``counts`` has ``_n`` rows per (by, order); ``ranks`` has ``(by…, _i, _rank)``. Returns
    ``(by…, order, _i, _rank)`` with the rank counted from the start of that value.
    """
    through = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ended = counts.withColumn("_end", F.sum("_n").over(through))
    wanted = ranks.select(*[F.col(b).alias(f"r{b}") for b in by], "_i", "_rank")
    hit = (F.col("_rank") >= F.col("_end") - F.col("_n")) & (F.col("_rank") < F.col("_end"))
    for b in by:
        hit = hit & F.col(b).eqNullSafe(F.col(f"r{b}"))
    return ended.join(wanted, hit).select(*by, order, "_i", (F.col("_rank") - F.col("_end") + F.col("_n")).alias("_rank"))


def _among(rows: DataFrame, wanted: DataFrame, on: Sequence[str]) -> DataFrame:
    w = wanted.select(*[F.col(c).alias(f"w{c}") for c in on])
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"w{c}"))
    return rows.join(w, same, "left_semi")


def hash_cuts(
    df: DataFrame, stratum: str, key: Sequence[str], weights: Sequence[int], seed: int, digits: int = PREFIX_DIGITS
) -> DataFrame:
    """One row per stratum: ``cuts``, the ascending hash values at which the parts after the
    first begin. A part that begins beyond the last row gets a cut above every hash."""
    total = sum(weights)
    marks = [sum(weights[: i + 1]) for i in range(len(weights) - 1)]
    hashed = df.select(F.col(stratum).alias("_s"), cells.hash_key(seed, *[F.col(k) for k in key]).alias("_h"))
    rows = hashed.withColumns({"_p": F.substring("_h", 1, digits), "_q": F.substring("_h", digits + 1, digits)})

    counts = rows.groupBy("_s", "_p").agg(F.count(F.lit(1)).alias("_n"))
    cut = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).alias("m")) for i, m in enumerate(marks)]))
    ranks = (
        counts.groupBy("_s").agg(F.sum("_n").alias("_all")).select("_s", "_all", cut.alias("_c"))
        .select("_s", F.col("_c.i").alias("_i"), F.expr(f"(_all * _c.m) div {total}").alias("_rank"))
    )
    # One row per (stratum, cut). Stored before the second scan: Spark knows the size of the file
    # and broadcasts it to the scan if it is small, so only rows of cut prefixes are shuffled.
    at_prefix = cut_lineage(_locate(counts, ranks, ["_s"], "_p"), "cut-prefixes")
    # Copies of a key collapse into one row with their number.
    near = _among(rows, at_prefix, ["_s", "_p"]).groupBy("_s", "_p", "_q", "_h").agg(F.count(F.lit(1)).alias("_n"))
    finer = near.groupBy("_s", "_p", "_q").agg(F.sum("_n").alias("_n"))
    at_finer = _locate(finer, at_prefix, ["_s", "_p"], "_q")
    at_hash = _locate(_among(near, at_finer, ["_s", "_p", "_q"]), at_finer, ["_s", "_p", "_q"], "_h")
    # 'g' sorts above every hex digit.
    slots = [F.coalesce(F.max(F.when(F.col("_i") == i, F.col("_h"))), F.lit("g")) for i in range(len(marks))]
    return at_hash.groupBy("_s").agg(F.array(*slots).alias("cuts"))


def stratified_split(
    df: DataFrame,
    stratum: str,
    key: Sequence[str],
    weights: Mapping[str, int] | None = None,
    seed: int = fixed.SEED,
    into: str = "split",
    digits: int = PREFIX_DIGITS,
) -> DataFrame:
    """Add ``into``: the part of each row. Exact per stratum up to the copies of one key.

    The cuts are found by two jobs when this is called; assigning the rows is lazy.
    """
    weights = dict(weights or fixed.SPLIT_WEIGHTS)
    names = list(weights)
    cuts = cut_lineage(hash_cuts(df, stratum, key, list(weights.values()), seed, digits), "cuts")
    joined = df.join(cuts, F.col(stratum).eqNullSafe(F.col("_s")), "left")
    h = cells.hash_key(seed, *[F.col(k) for k in key])
    part = F.lit(names[-1])
    for i in reversed(range(len(names) - 1)):
        part = F.when(F.coalesce(h < F.col("cuts")[i], F.lit(True)), F.lit(names[i])).otherwise(part)
    return joined.withColumn(into, part).drop("_s", "cuts")


def stratified_folds(
    df: DataFrame, stratum: str, key: Sequence[str], folds: int = fixed.N_FOLDS, seed: int = fixed.SEED, into: str = "fold"
) -> DataFrame:
    """Add ``into``: a fold number, equal shares of every stratum."""
    out = stratified_split(df, stratum, key, {str(i): 1 for i in range(folds)}, seed, into)
    return out.withColumn(into, F.col(into).cast("int"))


def hash_share(key: Sequence[Column], seed: int = fixed.SEED) -> Column:
    """Uniform integer in [0, 1,000,000) of a key."""
    return F.conv(F.substring(cells.hash_key(seed, *key), 1, 8), 16, 10).cast("bigint") % 1_000_000


def stratified_sample(
    df: DataFrame, stratum: str, key: Sequence[str], fractions: Mapping, seed: int = fixed.SEED
) -> DataFrame:
    """Approximate stratified sample in one narrow pass; shares hold in expectation."""
    limit = F.lit(0)
    for level, share in fractions.items():
        limit = F.when(F.col(stratum) == level, F.lit(round(share * 1_000_000))).otherwise(limit)
    return df.where(hash_share([F.col(k) for k in key], seed) < limit)


def require_two_classes(df: DataFrame, target: str) -> DataFrame:
    """One row: the number of classes and whether a stratified split is possible."""
    return df.agg(F.count_distinct(target).alias("classes")).withColumn("splittable", F.col("classes") >= 2)


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows and share of every part."""
    counts = df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("ratio", F.round(F.col("n") / counts.agg(F.sum("n")).scalar(), 4))


def target_distribution(df: DataFrame, target: str, split: str = "split") -> DataFrame:
    """Share of every target value inside every part."""
    counts = df.where(F.col(target).isNotNull()).groupBy(split, target).agg(F.count(F.lit(1)).alias("n"))
    per_part = Window.partitionBy(split)  # over one row per class
    return counts.withColumn("ratio", F.round(F.col("n") / F.sum("n").over(per_part), 4))
