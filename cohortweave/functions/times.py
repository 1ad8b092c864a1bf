"""Parse-or-null timestamps and ISO output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.schemas import TIME


def as_time(df: DataFrame, name: str | None, formats: Sequence[str] = ()) -> Column:
    """Column ``name`` of ``df`` as a zone-free timestamp.

    Unparsable text becomes NULL, and so does a column that is absent. Numbers count
    nanoseconds since 1970, as they do in data frames written by pandas.
    """
    if not name or name not in df.columns:
        return F.lit(None).cast(TIME)
    column, dtype = F.col(name), df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return column
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return column.cast(TIME)
    if isinstance(dtype, T.StringType):
        attempts = [F.try_to_timestamp(column)]
        attempts += [F.try_to_timestamp(column, F.lit(fmt)) for fmt in formats]
        return F.coalesce(*attempts).cast(TIME)
    if isinstance(dtype, T.NumericType):
        seconds = F.expr(f"cast(try_cast(`{name}` AS decimal(28, 0)) / 1000000000 AS decimal(18, 6))")
        return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)
    return F.lit(None).cast(TIME)


def iso_time(time: Column) -> Column:
    """``2025-02-01T00:00:00``, with six fraction digits only when they are not zero."""
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(time, ".SSSSSS")
    return F.when(fraction == ".000000", whole).otherwise(F.concat(whole, fraction))
