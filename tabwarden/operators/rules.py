"""Row rules: every row carries the errors it caused, in one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwarden import fixed
from tabwarden.functions import cells
from tabwarden.operators.contract import Contract

#: Column of ``readers.read_csv(corrupt=…)`` whose lines are errors of their rows.
CORRUPT_LINE = "_corrupt_line"


def require_columns(df: DataFrame, contract: Contract) -> None:
    """A batch without a required column cannot be processed at all."""
    missing = [c for c in contract.required() if c not in df.columns and c != contract.target]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def _error(column: str, reason: str) -> Column:
    return F.struct(F.lit(column).alias("column"), F.lit(reason).alias("error_reason"))


def row_errors(df: DataFrame, contract: Contract, allowed_values: bool = False) -> Column:
    """Array of ``(column, error_reason)`` of one row."""
    found: list[Column] = []
    if CORRUPT_LINE in df.columns:
        line = F.col(CORRUPT_LINE)
        malformed = F.struct(F.lit(CORRUPT_LINE).alias("column"), F.concat(F.lit(fixed.MALFORMED_REASON), line).alias("error_reason"))
        found.append(F.when(line.isNotNull(), malformed))
    for name, rule in contract.columns.items():
        if name not in df.columns:
            continue
        c = F.col(name)
        if rule.get("nullable") is False:
            found.append(F.when(c.isNull(), _error(name, fixed.NULL_REASON.format(column=name))))
        number = c.cast("double") if isinstance(df.schema[name].dataType, T.NumericType) else cells.to_number(c)
        if "min" in rule:
            found.append(F.when(number < float(rule["min"]), _error(name, fixed.MIN_REASON.format(column=name, bound=rule["min"]))))
        if "max" in rule:
            found.append(F.when(number > float(rule["max"]), _error(name, fixed.MAX_REASON.format(column=name, bound=rule["max"]))))
        if allowed_values and rule.get("allowed_values") and not rule.get("allow_new_categories", False):
            known = [str(v) for v in rule["allowed_values"]]
            found.append(F.when(~c.cast("string").isin(*known), _error(name, fixed.ALLOWED_REASON.format(column=name))))
    if not found:
        return F.expr("cast(array() as array<struct<column:string,error_reason:string>>)")
    return F.array_compact(F.array(*found))


def annotate(df: DataFrame, contract: Contract, allowed_values: bool = False) -> DataFrame:
    """Add ``errors``; valid rows have an empty array."""
    require_columns(df, contract)
    return df.withColumn("errors", row_errors(df, contract, allowed_values))


def valid_rows(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.size("errors") == 0).drop("errors")


def invalid_rows(annotated: DataFrame) -> DataFrame:
    """Dead letters: the row together with its own errors."""
    return annotated.where(F.size("errors") > 0)


def error_details(annotated: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per error, named by the key of its row."""
    return annotated.select(*key, F.inline("errors"))


def batch_counters() -> dict[str, Column]:
    """Rows received, accepted and rejected; errors are counted apart from rows."""
    return {
        "total_rows_received": F.count(F.lit(1)),
        "total_success": F.count_if(F.size("errors") == 0),
        "total_failed_rows": F.count_if(F.size("errors") > 0),
        "total_errors": F.coalesce(F.sum(F.size("errors").cast("bigint")), F.lit(0).cast("bigint")),
    }


def batch_summary(annotated: DataFrame) -> DataFrame:
    return annotated.agg(*[c.alias(n) for n, c in batch_counters().items()])
