"""Number expressions with the rounding and division rules the metrics need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL where the denominator is zero or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def float_ratio(numerator: Column, denominator: Column) -> Column:
    """Double division by floating-point rules: x/0 is infinite, 0/0 is NaN."""
    n, d = numerator.cast("double"), denominator.cast("double")
    by_zero = (
        F.when(n > 0, F.lit(float("inf")))
        .when(n < 0, F.lit(float("-inf")))
        .when(n.isNotNull(), F.lit(float("nan")))
    )
    return F.when(d == 0, by_zero).otherwise(F.try_divide(n, d))


def round_even_2(column: Column) -> Column:
    """Two decimals, halves to even, the way numpy rounds doubles."""
    return F.rint(column * 100) / 100


def percent_of(part: Column, total: Column) -> Column:
    """100 * part / total to two decimals, halves up, as a double."""
    share = F.try_divide((part * 100).cast("decimal(20,0)"), total.cast("decimal(18,0)"))
    return F.round(share, 2).cast("double")


def percent_text(part: Column, total: Column) -> Column:
    """``12.34%``; halves to even; ``0%`` where there is nothing to divide by."""
    share = F.try_divide(part.cast("double"), total.cast("double")) * 100
    two_decimals = F.bround(share.cast("decimal(24,14)"), 2).cast("decimal(12,2)")
    return F.when(total == 0, F.lit("0%")).otherwise(F.concat(two_decimals.cast("string"), F.lit("%")))
