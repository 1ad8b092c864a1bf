"""Table sinks and hand-over between stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cohortweave.sources.tables import normalize_format


def write_table(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    mode: str = "overwrite",
    sort_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> str:
    """Write a table; parent folders are made. ``sort_by`` gives a global range order."""
    name = normalize_format(file_format)
    if sort_by:
        df = df.orderBy(*sort_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name == "parquet":
        writer.parquet(path)
    else:
        # Quotes inside a text are doubled, as the readers expect.
        compression = "gzip" if name == "csv.gz" else "none"
        writer.options(header=True, escape='"', compression=compression).csv(path)
    return path


def hand_over(df: DataFrame, path: str, label: str, notes: list[str]) -> DataFrame:
    """Write a stage's Parquet output and read it back with its types; note when empty.

    The next stage then starts from files, with no lineage to recompute.
    """
    write_table(df, path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    if stored.isEmpty():
        notes.append(f"{label} was empty")
    return stored


def reload(
    spark: SparkSession, path: str | None, label: str, notes: list[str], schema: StructType | str | None = None
) -> DataFrame | None:
    """Output of an earlier run, or None with a note when none was produced.

    CSV text takes its types from ``schema``; without one every column stays text, so no id loses its zeros.
    """
    if path is None:
        notes.append(f"{label} path was not produced")
        return None
    text = path.lower().endswith((".csv", ".csv.gz"))
    if text:
        reader = spark.read.options(header=True, escape='"')
        df = (reader.schema(schema) if schema is not None else reader).csv(path)
    else:
        df = spark.read.parquet(path)
    if df.isEmpty():
        notes.append(f"{label} was empty")
    return df
