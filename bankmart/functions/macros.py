"""The project's public scalar functions (its reusable macros) as Column functions.

All are plain Spark expressions: no Python UDF, so they stay inside
whole-stage code generation and never block filter pushdown.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bankmart.functions.columns import (ColumnOrName, col, days_between,
                                        months_between_boundaries, nonzero)
from bankmart.functions.rules import risk_tier, utilization_band

__all__ = ["safe_divide", "delinquency_bucket", "utilization_risk", "months_since",
           "days_since", "surrogate_key"]


def safe_divide(numerator: ColumnOrName, denominator: ColumnOrName, default=0) -> Column:
    """numerator / denominator, or ``default`` when the denominator is 0 or null.

    A null numerator over a valid denominator stays null.
    """
    num, den = col(numerator), col(denominator)
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.when(den.isNull() | (den == 0), fallback).otherwise(num / nonzero(den))


def delinquency_bucket(status: ColumnOrName) -> Column:
    """Loan status -> ordered delinquency tier; the status is matched as given."""
    return risk_tier(col(status))


def utilization_risk(balance: ColumnOrName, limit: ColumnOrName) -> Column:
    """HIGH / MEDIUM / LOW on balance / limit; a zero or null limit counts as 0 (LOW)."""
    return utilization_band(col(balance), col(limit))


def months_since(date: ColumnOrName, today: Column | None = None) -> Column:
    """Month boundaries from ``date`` to today."""
    return months_between_boundaries(col(date).cast("date"),
                                      today if today is not None else F.current_date())


def days_since(date: ColumnOrName, today: Column | None = None) -> Column:
    """Days from ``date`` to today."""
    return days_between(col(date).cast("date"),
                        today if today is not None else F.current_date())


def surrogate_key(*fields: ColumnOrName) -> Column:
    """md5 of the fields joined by '|', each null rendered as the text NULL."""
    parts = [F.coalesce(col(f).cast("string"), F.lit("NULL")) for f in fields]
    return F.md5(F.concat_ws("|", *parts))
