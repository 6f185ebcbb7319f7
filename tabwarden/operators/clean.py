"""Table cleaning: one implementation with a training and a scoring mode."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwarden import fixed
from tabwarden.functions import cells


@dataclass(frozen=True)
class CleanSpec:
    """What to clean. Columns that a frame does not have are skipped."""

    drop: Sequence[str] = ()
    numeric_text: Sequence[str] = ()
    value_maps: Mapping[str, Mapping] = field(default_factory=dict)
    target: str | None = None
    target_map: Mapping = field(default_factory=dict)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def strip_strings(df: DataFrame) -> DataFrame:
    """Strip whitespace on every string column."""
    names = string_columns(df)
    return df.withColumns({n: cells.strip_whitespace(F.col(n)) for n in names}) if names else df


def nan_cells_to_null(df: DataFrame) -> DataFrame:
    """NaN to NULL on every floating column, once, at the edge."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({n: cells.nan_to_null(F.col(n)) for n in names}) if names else df


def null_tokens(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    names = string_columns(df)
    return df.withColumns({n: cells.tokens_to_null(F.col(n), tokens) for n in names}) if names else df


def add_lineage(df: DataFrame, source: str, at: Column | str) -> DataFrame:
    """Add literal ``data_source`` and ``ingested_at_utc`` columns."""
    ts = F.lit(at).cast("timestamp_ntz") if isinstance(at, str) else at
    return df.withColumns({"data_source": F.lit(source), "ingested_at_utc": ts})


def clean(df: DataFrame, spec: CleanSpec, mode: str) -> DataFrame:
    """Coerce, map and blank cells.

    ``mode="train"`` uses closed value maps, maps the target and knows the training null
    tokens; ``mode="score"`` keeps unmapped values and knows the scoring null tokens.
    """
    if mode not in ("train", "score"):
        raise ValueError(f"unknown mode: {mode}")
    train = mode == "train"
    out = df.drop(*spec.drop) if train else df
    changes: dict[str, Column] = {}
    for name in spec.numeric_text:
        if name in out.columns:
            changes[name] = cells.to_number(F.col(name))
    for name, mapping in spec.value_maps.items():
        if name in out.columns:
            code = cells.code_text(F.col(name), isinstance(out.schema[name].dataType, T.NumericType))
            changes[name] = cells.map_codes(code, mapping, keep_unmapped=not train)
    if train and spec.target and spec.target_map and spec.target in out.columns:
        changes[spec.target] = cells.map_closed(F.col(spec.target), spec.target_map)
    if changes:
        out = out.withColumns(changes)
    return null_tokens(out, fixed.TRAIN_NULL_TOKENS if train else fixed.SCORE_NULL_TOKENS)


def distinct_rows(df: DataFrame, on: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows over all columns or over ``on``. Nulls compare equal; every task drops
    its own copies before the shuffle, so a group of many copies travels as few rows."""
    if on is None:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c not in on]
    if not rest:
        return df.select(*on).dropDuplicates()
    kept = df.groupBy(*on).agg(F.min(F.struct(*rest)).alias("_kept"))
    return kept.select(*[F.col(c) if c in on else F.col(f"_kept.{c}").alias(c) for c in df.columns])


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: rows, distinct rows and the surplus of copies."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return per_row.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def require_target(df: DataFrame, target: str) -> DataFrame:
    """Fail the run on the first row whose target is missing. Lazy, no job of its own."""
    checked = F.when(F.col(target).isNull(), F.raise_error(F.lit(f"target column {target} contains nulls")))
    return df.withColumn(target, F.coalesce(F.col(target), checked.cast(df.schema[target].dataType)))


def feature_frame(df: DataFrame, target: str) -> DataFrame:
    return df.drop(target)


def feature_groups(df: DataFrame, exclude: Sequence[str] = (), both: bool = False) -> tuple[list[str], list[str]]:
    """Numeric and categorical columns by type."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    categorical = [f.name for f in fields if f.name not in numeric]
    if both and not numeric:
        raise ValueError("no numeric features")
    if both and not categorical:
        raise ValueError("no categorical features")
    return numeric, categorical
