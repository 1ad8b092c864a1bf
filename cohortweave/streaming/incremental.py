"""Batched load of a growing folder with the file stream source.

Each run picks up the files that arrived since the last one, in batches of a set
number of files, and appends rows to a table together with a load log. Rows and log
of a batch are written under the batch number, so a batch that is run again after a
failure replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.sources.tables import (
    TableRequest,
    check_required,
    clean,
    project,
    request_notes,
    resolve_format,
)


def stream_table(
    spark: SparkSession, request: TableRequest, schema: T.StructType, files_per_batch: int, glob: str | None = None
) -> DataFrame:
    """Streaming frame of a CSV folder (or of Parquet when ``glob`` names the files)."""
    if files_per_batch is None or files_per_batch <= 0:
        raise ValueError("files_per_batch must be set to a positive integer for incremental loading.")
    file_format, _ = resolve_format(request)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if file_format == "parquet":
        return reader.parquet(request.path)
    return reader.options(header=True, escape='"').csv(request.path)


def load_increment(
    spark: SparkSession,
    request: TableRequest,
    schema: T.StructType,
    files_per_batch: int,
    table_path: str,
    log_path: str,
    state_path: str,
    glob: str | None = None,
) -> DataFrame:
    """Load everything new, then return the load log ``(batch_id, row_count, …)``."""
    stream, column_notes = project(stream_table(spark, request, schema, files_per_batch, glob), request.columns)
    check_required(stream, request)
    notes = [*resolve_format(request)[1], *column_notes, *request_notes(request, batches=True)]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = clean(batch, request).persist()
        try:
            rows.write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")
            rows.agg(F.expr("count(1) AS row_count")).select(
                "row_count",
                F.lit(request.path).alias("path"),
                F.array(*[F.lit(c) for c in rows.columns]).alias("loaded_columns"),
                F.lit(True).alias("used_chunking"),
                F.array(*[F.lit(n) for n in dict.fromkeys(notes)]).cast("array<string>").alias("notes"),
            ).coalesce(1).write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", state_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(log_path)


def loaded_rows(spark: SparkSession, table_path: str, schema: T.StructType) -> DataFrame:
    """All rows loaded so far with their ``batch_id``. A batch has one folder, which it replaces when it runs again."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])).parquet(table_path)
