"""Order-free dataset fingerprint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwarden.functions import cells


def row_hash(columns: Sequence[Column]) -> Column:
    """60 bits of the md5 of a row's canonical text, as BIGINT."""
    return F.conv(F.substring(F.md5(cells.canonical_text(columns)), 1, 15), 16, 10).cast("bigint")


def aggregates(columns: Sequence[Column]) -> list[Column]:
    h = F.col("_h") if not columns else row_hash(columns)
    return [
        F.count(F.lit(1)).alias("n_rows"),
        # Sums of 28 digits run in 38: 2^60 times 10^18 rows still fits.
        F.coalesce(F.sum(h.cast("decimal(28,0)")).cast("string"), F.lit("0")).alias("hash_sum"),
        F.coalesce(F.bit_xor(h), F.lit(0).cast("bigint")).alias("hash_xor"),
    ]


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Row count, sum and xor of row hashes, per ``by`` group.

    Independent of row order and partitioning; every task sends one row per group.
    """
    names = list(columns or [c for c in df.columns if c not in by])
    hashed = df.select(*by, row_hash([F.col(n) for n in names]).alias("_h"))
    grouped = hashed.groupBy(*by) if by else hashed
    return grouped.agg(*aggregates([]))
