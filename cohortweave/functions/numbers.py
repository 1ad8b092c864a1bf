"""Numeric helpers that treat NaN and infinity as missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def finite(value: Column) -> Column:
    return F.when(is_finite(value), value)


def ratio(part: Column, whole: Column, default: float | None = 0.0) -> Column:
    """``part / whole``, or ``default`` when ``whole`` is zero."""
    share = F.try_divide(part.cast("double"), whole.cast("double"))
    return share if default is None else F.coalesce(share, F.lit(default))
