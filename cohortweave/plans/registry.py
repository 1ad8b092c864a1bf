"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def presented(df: DataFrame) -> DataFrame:
    """Result columns in comparable form: six digits, text times, joined lists."""
    columns = []
    for f in df.schema:
        name = f"`{f.name}`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            columns.append(f"round(cast({name} AS double), 6) + 0.0D AS {name}")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            columns.append(f"date_format({name}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS {name}")
        elif isinstance(f.dataType, T.ArrayType):
            columns.append(f"array_join({name}, '|') AS {name}")
        else:
            columns.append(name)
    return df.selectExpr(*columns)
