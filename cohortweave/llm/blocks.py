"""Shared helpers: bounded Arrow batches, stored text blocks, packed rows per bucket.

A block is a run of documents of about ``BLOCK_BYTES`` of text, stored once in the
shared folder. Later passes read the stored blocks, so a lost task sees the same block
again. Tasks exchange packed rows: one row per block and bucket instead of one per item.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.session import drop_path, fresh_path, recorded_paths

BATCH_BYTES = 8 << 20  # Arrow bytes handed to a Python worker at once; one row may be larger
BLOCK_BYTES = 4 << 20  # text bytes per block; one document may be larger
ROW_BITS = 20  # a block holds fewer rows, and a partition fewer blocks, than 2**ROW_BITS

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

KEY_SCHEMA = "block long, keys array<string>"
BLOCK_SCHEMA = f"{KEY_SCHEMA}, ends binary, data binary"


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, so long texts never add up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write once below the shared folder and read back: cuts the lineage.

    The shuffle files of the write go when it ends; otherwise they stay until the driver collects its garbage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def stored_alone(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``stored(build())``; what ``build`` stored on the way is deleted, so nothing else may read it."""
    with recorded_paths() as made:
        rows = build()
    result = stored(rows, label)
    for path in made:
        drop_path(spark, path)
    return result


def byte_pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of about ``limit`` bytes of ``column``: small ones joined, large ones sliced."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.concat_batches(held)

    for batch in batches:
        lengths = binary_lengths(batch.column(column))
        start = 0
        for i, n in enumerate(lengths.tolist()):
            if size and size + n > limit:
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield joined()
                held, size, start = [], 0, i
            size += n + 16
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield joined()


def binary_lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def pack(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def squeeze(data: bytes, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def squeeze_planes(array: np.ndarray) -> bytes:
    """Squeeze integers by their bytes: all lowest bytes first, so the empty high ones cost nothing."""
    wide = np.ascontiguousarray(array)
    return squeeze(np.ascontiguousarray(wide.view(np.uint8).reshape(len(wide), wide.itemsize).T).tobytes(), 1)


def from_planes(raw: bytes, kind: type) -> np.ndarray:
    """The integers of ``squeeze_planes`` from its expanded bytes."""
    planes = np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    whole = np.empty(planes.shape[::-1], np.uint8)
    for i, plane in enumerate(planes):
        whole[:, i] = plane
    return whole.reshape(-1).view(kind)


def write_blocks(docs: DataFrame, key: str, text: str, label: str, extra: Callable | None = None, fields: str = "", texts: bool = True) -> DataFrame:
    """Store ``docs`` as blocks: row keys as text, end offsets and the joined UTF-8 bytes.

    A NULL text counts as empty and a NULL key stays NULL; repeated rows stay apart.
    ``extra(data, ends)`` may add the columns declared in ``fields`` to each block; without ``texts`` they replace
    offsets and bytes.
    """
    spark = docs.sparkSession
    bounded_batches(spark)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << ROW_BITS
        for seq, piece in enumerate(byte_pieces(batches, "text", BLOCK_BYTES)):
            ends = np.cumsum(binary_lengths(piece.column("text")))
            data = b"".join(x or b"" for x in piece.column("text").cast(pa.binary()).to_pylist())
            row = {"block": [part + seq], "keys": [piece.column("key").to_pylist()]}
            if texts:
                row |= {"ends": [pack(ends)], "data": [squeeze(data)]}
            if extra:
                row |= {k: [v] for k, v in extra(data, ends).items()}
            yield pa.RecordBatch.from_pydict(row)

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    return stored(rows.mapInArrow(build, (BLOCK_SCHEMA if texts else KEY_SCHEMA) + (", " + fields if fields else "")), label)


def buckets_for(spark: SparkSession, total_bytes: int, bucket_bytes: int) -> int:
    """Number of exchange buckets: grows with the data, and uses the whole cluster."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total_bytes // bucket_bytes), 1)


def by_bucket(rows: DataFrame, buckets: int, key: str = "bucket") -> DataFrame:
    """One partition per bucket number."""
    return rows.repartitionById(buckets, F.col(key).cast("int"))


def per_block(rows: DataFrame) -> DataFrame:
    """Gather packed rows (block, ...) into ``parts`` per block; at most one row per bucket."""
    rest = [c for c in rows.columns if c != "block"]
    return rows.groupBy("block").agg(F.collect_list(F.struct(*rest)).alias("parts"))


def bucket_pieces(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by bucket, the buckets that occur and their bounds in that order."""
    low = len(bucket) and int(bucket.min()) >= 0 and int(bucket.max()) < 1 << 16
    order = np.argsort(bucket.astype(np.uint16) if low else bucket, kind="stable")  # two bytes are sorted by their digits
    placed = bucket[order]
    starts = np.flatnonzero(np.append(True, placed[1:] != placed[:-1])) if len(placed) else np.zeros(0, np.int64)
    return order, placed[starts], np.append(starts, len(bucket))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mix of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def ragged(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated slices ``[offset, offset + length)``."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(offsets - (ends - lengths), lengths) + np.arange(total)
