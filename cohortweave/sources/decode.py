"""Decode many binary files into rows; a bad file becomes an error row.

A decoder is a function ``(content: bytes) -> iterator of column dictionaries``: each dictionary maps the data columns to
equally long sequences. It yields in pieces, so a worker holds a bounded number of rows, and its failure never ends the job.

A file gives all its rows or none: a decoder is run to its end before its first row is handed on, unless it says by
``validates_first = True`` that it never fails after its first piece.

A decoder that says ``reads_file = True`` gets the open file in place of its bytes, so that a worker need not hold the whole
of it; this holds for ``read_files``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

Decoder = Callable[[bytes], Iterator[Mapping[str, Sequence]]]
ERROR_FIELDS = [T.StructField("error_type", T.StringType()), T.StructField("error_message", T.StringType())]
# Decoded rows and bytes per Arrow batch handed back to Spark.
BATCH_ROWS = 65_536
BATCH_BYTES = 8 << 20
TASKS_PER_CORE = 32  # at most, when files are read


def open_bytes(path: str) -> bytes:
    """The bytes of a file at a local path or at an address that Arrow's file systems know."""
    if "://" not in path and not path.startswith("file:"):
        with open(path, "rb") as file:
            return file.read()
    store, inside = pa.fs.FileSystem.from_uri(path)
    with store.open_input_stream(inside) as stream:
        return stream.read()


def open_file(path: str):
    """Like ``open_bytes``, the open file itself."""
    if "://" not in path and not path.startswith("file:"):
        return open(path, "rb")
    store, inside = pa.fs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


def _tables(record: dict, content: Callable, decoder: Decoder, arrow: pa.Schema, first: str) -> Iterator[pa.Table]:
    """Rows of one file, or its error row."""

    def table(columns: Mapping[str, Sequence], rows: int, error: Exception | None = None) -> pa.Table:
        fixed = {**record, "error_type": error and type(error).__name__, "error_message": error and str(error)}
        arrays = []
        for f in arrow:
            if f.name in columns:
                arrays.append(pa.array(columns[f.name], type=f.type))
            else:
                arrays.append(pa.repeat(pa.scalar(fixed.get(f.name), type=f.type), rows))
        return pa.Table.from_arrays(arrays, schema=arrow)

    def tables(data) -> Iterator[pa.Table]:
        for columns in decoder(data):
            total = len(columns[first])
            # Cut before the keys are repeated, so that no text column outgrows its offsets.
            for start in range(0, total, BATCH_ROWS):
                yield table({k: v[start : start + BATCH_ROWS] for k, v in columns.items()}, min(BATCH_ROWS, total - start))

    try:
        data = content()
        rows = tables(data)
        if getattr(decoder, "validates_first", False):
            head = next(rows, None)
        else:
            head = None
            for _ in tables(data):
                pass
            if getattr(decoder, "reads_file", False):
                data.seek(0)
    except Exception as error:  # any failure of file or decoder belongs to the error table
        yield table({}, 1, error)
        return
    if head is not None:
        yield head
    yield from rows


def _batches(tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    rows = size = 0
    for piece in tables:
        held.append(piece)
        rows, size = rows + piece.num_rows, size + piece.nbytes
        if rows >= BATCH_ROWS or size >= BATCH_BYTES:
            yield from pa.concat_tables(held).combine_chunks().to_batches(max_chunksize=BATCH_ROWS)
            held, rows, size = [], 0, 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches(max_chunksize=BATCH_ROWS)


def _schema(keys: Sequence[T.StructField], data: T.StructType) -> T.StructType:
    return T.StructType([*keys, *data.fields, *ERROR_FIELDS])


def decode(files: DataFrame, keys: Sequence[str], decoder: Decoder, data: T.StructType) -> DataFrame:
    """Rows of ``keys`` + ``data`` + error columns, which are NULL on data rows.

    ``files`` carries ``keys`` and ``content``. Write the result before reading both
    halves with ``decoded_rows`` and ``decode_errors``, so files are decoded once.
    """
    keys = list(keys)
    schema = _schema([files.schema[k] for k in keys], data)
    arrow, first = to_arrow_schema(schema), data.fields[0].name

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tables() -> Iterator[pa.Table]:
            for batch in batches:
                for i in range(batch.num_rows):
                    record = {k: batch.column(k)[i].as_py() for k in keys}
                    yield from _tables(record, batch.column("content")[i].as_py, decoder, arrow, first)

        return _batches(tables())

    return files.select(*keys, "content").mapInArrow(run, schema)


@dataclass
class _Files(InputPartition):
    """Files that one task reads, with their keys."""

    records: list[dict]


def read_files(inventory: DataFrame, path: str, keys: Sequence[str], decoder: Decoder, data: T.StructType) -> DataFrame:
    """Like ``decode``, for files named by the column ``path`` of an inventory: each task opens its own files.

    The partitions of this data source are lists of paths, so no file is shuffled or joined. The driver holds the list of
    paths and keys, as it does for any source of files, and never a byte of content.
    """
    keys = list(keys)
    spark = inventory.sparkSession
    schema = _schema([inventory.schema[k] for k in keys], data)
    listed = [row.asDict() for row in inventory.select(*dict.fromkeys([*keys, path])).filter(f"`{path}` IS NOT NULL").toLocalIterator()]
    listed.sort(key=lambda record: record[path])
    each = -(-len(listed) // (TASKS_PER_CORE * spark.sparkContext.defaultParallelism)) or 1
    parts = [_Files(listed[i : i + each]) for i in range(0, len(listed), each)]
    if not parts:
        return spark.createDataFrame([], schema)
    label = f"decoded_files_{uuid.uuid4().hex}"

    class Reader(DataSourceReader):
        def partitions(self) -> Sequence[InputPartition]:
            return parts

        def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
            arrow, first = to_arrow_schema(schema), data.fields[0].name
            opened = open_file if getattr(decoder, "reads_file", False) else open_bytes

            def tables() -> Iterator[pa.Table]:
                for record in partition.records:
                    yield from _tables({k: record[k] for k in keys}, lambda at=record[path]: opened(at), decoder, arrow, first)

            yield from _batches(tables())

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return label

        def schema(self) -> T.StructType:
            return schema

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return Reader()

    spark.dataSource.register(Source)
    return spark.read.format(label).load()


def stored(decoded: DataFrame, path: str) -> DataFrame:
    """Decode once into Parquet at ``path`` and return the stored rows."""
    decoded.write.mode("overwrite").parquet(path)
    return decoded.sparkSession.read.schema(decoded.schema).parquet(path)


def decode_to(files: DataFrame, keys: Sequence[str], decoder: Decoder, data: T.StructType, path: str) -> DataFrame:
    return stored(decode(files, keys, decoder, data), path)


def decoded_rows(decoded: DataFrame) -> DataFrame:
    """Data rows; a file that failed has none."""
    return decoded.filter("error_type IS NULL").drop("error_type", "error_message")


def decode_errors(decoded: DataFrame, keys: Sequence[str]) -> DataFrame:
    return decoded.filter("error_type IS NOT NULL").select(*keys, "error_type", "error_message")
