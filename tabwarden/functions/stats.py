"""Scalar formulas of drift and classification, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabwarden import fixed

#: Spacing of doubles at 1, the clip that keeps a logarithm finite.
DOUBLE_EPS = 2.220446049250313e-16


def psi_term(expected: Column, actual: Column, floor: float = fixed.PSI_FLOOR) -> Column:
    """One summand of the population stability index; an absent share counts as the floor."""
    e = F.greatest(F.coalesce(expected, F.lit(0.0)), F.lit(floor))
    a = F.greatest(F.coalesce(actual, F.lit(0.0)), F.lit(floor))
    return (a - e) * F.ln(a / e)


def mean_shift(expected: Column, actual: Column) -> Column:
    """Relative distance of two means, absolute where the expected mean is 0."""
    return F.when(expected != 0, F.abs(actual - expected) / F.abs(expected)).otherwise(F.abs(actual))


def log_loss_term(label: Column, p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(DOUBLE_EPS)), F.lit(1.0 - DOUBLE_EPS))
    return F.when(label == 1, -F.ln(q)).otherwise(-F.ln(F.lit(1.0) - q))
