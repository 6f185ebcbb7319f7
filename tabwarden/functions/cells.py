"""Column expressions for cleaning single cells. All of them run inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Plain decimal or scientific notation. Engines disagree on ``1d``, ``1_000`` and ``inf``;
#: the guard makes every one of them a missing value.
NUMERIC_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def strip_whitespace(c: Column) -> Column:
    """Remove every kind of leading and trailing whitespace, Unicode's included (``trim`` removes spaces only)."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+", ""), r"(?U)[\s\x1c-\x1f]+$", "")


def to_number(c: Column) -> Column:
    """Text to DOUBLE; anything that is not a plain number becomes NULL."""
    text = c.cast("string")
    return F.when(text.rlike(NUMERIC_TEXT), strip_whitespace(text).try_cast("double"))


def tokens_to_null(c: Column, tokens: Iterable[str]) -> Column:
    """Whole-cell tokens to NULL."""
    return F.when(~c.isin(*tokens), c)


def nan_to_null(c: Column) -> Column:
    """NaN is a value in Spark; this library knows one missing value, NULL."""
    return F.when(~F.isnan(c), c)


def map_closed(c: Column, mapping: Mapping) -> Column:
    """Value map whose unmapped input becomes NULL."""
    out = None
    for key, value in mapping.items():
        hit = c == F.lit(key)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out


def code_text(c: Column, numeric: bool) -> Column:
    """A code as text; a whole number is written without a fraction, so 1.0 and 1 are one code."""
    text = c.cast("string")
    return F.when(c == F.floor(c), c.try_cast("bigint").cast("string")).otherwise(text) if numeric else text


def map_codes(code: Column, mapping: Mapping, keep_unmapped: bool) -> Column:
    """Value map over codes as text; unmapped codes are kept or become NULL."""
    mapped = map_closed(code, {str(k): v for k, v in mapping.items()})
    return F.coalesce(mapped, code) if keep_unmapped else mapped


def safe_ratio(a: Column, b: Column) -> Column:
    """``a / b`` with 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def canonical_text(columns: Iterable[Column]) -> Column:
    """One text per row that differs whenever any cell differs.

    Every cell is prefixed by its length, so no separator inside a value can imitate
    a cell boundary; NULL has its own mark.
    """
    parts = []
    for c in columns:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.concat(*parts)


def hash_key(seed: int, *columns: Column) -> Column:
    """Uniform, engine-independent 32 digit hex key of some columns under a seed."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def clean_path(c: Column) -> Column:
    """Drop leading ``.``, ``/`` and ``\\`` of a stored path."""
    return F.regexp_replace(c, r"^[./\\]+", "")
