"""Shares, gaps and ratios in exact decimals, rounded half away from zero.

Gaps and ratios take shares that are already rounded, so the order of rounding is part of the
result. Decimals keep the halves exact; convert to double only where results leave Spark.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

SHARE_TYPE = DecimalType(12, 1)
COUNT_TYPE = DecimalType(20, 0)


def share(part: Column, whole: Column) -> Column:
    """`part` as a percentage of `whole` to one decimal; null when `whole` is zero."""
    return F.round(part * F.lit(Decimal("100.0")) / F.nullif(whole, F.lit(0)), 1).cast(SHARE_TYPE)


def gap(observed: Column, benchmark: Column) -> Column:
    """Difference of two shares in percentage points."""
    return F.round(observed - benchmark, 1).cast(SHARE_TYPE)


def ratio(observed: Column, benchmark: Column) -> Column:
    """Quotient of two shares to two decimals; null when the benchmark share is zero."""
    return F.round(observed / F.nullif(benchmark, F.lit(0)), 2).cast(DecimalType(14, 2))
