"""Currency conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.config import USD


def to_usd(amount: Column, rate: Column) -> Column:
    """``amount`` over units of local currency per dollar; NULL without a usable rate, or if the
    result does not fit, which the check of conversions counts.

    Eighteen digits keep the value in a machine word, so sums stay exact and fast.
    """
    return F.try_divide(amount, rate).try_cast(USD)
