"""Rounding to three places as Python's round(x, 3) does it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE = float(2**52)  # from here on every double is a whole number
_LARGE = float(2**42)  # below, thousandths and their halves are exact doubles
_SPLITTER = float(2**27 + 1)


def round3(value: Column) -> Column:
    """Round the exact binary value, halves to even, without leaving the JVM.

    round, bround and format_string look at the shortest decimal form of the
    double and so are off by one in the last place for values such as 0.9135,
    which lies just below the half. Here the value is scaled by 1000. Rounding
    of that product keeps the order, so it can only mislead where it lands on a
    half; there the sign of its error, computed exactly from the two parts of a
    split double, decides. ``value`` appears many times: pass a plain column.
    """
    product = value * 1000.0
    high = value * _SPLITTER - (value * _SPLITTER - value)
    error = (high * 1000.0 - product) + (value - high) * 1000.0

    below = F.floor(product).cast("double")
    thousandths = (
        F.when(product - below != 0.5, F.rint(product))
        .when(error > 0, below + 1.0)
        .when(error < 0, below)
        .otherwise(F.rint(product))
    )
    fraction = value % 1.0
    return (
        F.when(F.isnan(value) | (F.abs(value) >= _WHOLE), value)
        .when(F.abs(value) >= _LARGE, (value - fraction) + F.rint(fraction * 1000.0) / 1000.0)
        .otherwise(thousandths / 1000.0)
    )
