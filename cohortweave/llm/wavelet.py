"""Token ids in files of wavelet matrices: one compressed succinct shard per run of documents."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm.blocks import bounded_batches, byte_pieces, expand, squeeze
from cohortweave.llm.bpe import Coded, WordTable, tokenizer_text
from cohortweave.session import fresh_path

SHARD_TEXT_BYTES = 8 << 20
WORD_BITS = 512  # bits between two stored ranks

# Fixed values of the file format.
MAGIC = b"WMX1"
HEAD = struct.Struct("<4sBQQ")  # magic, planes, tokens, documents


class WaveletMatrix:
    """Bit planes from the highest bit down; each plane moves zeros before ones, stably."""

    def __init__(self, n: int, planes: list[np.ndarray]):
        self.n, self.planes = n, planes
        self.ranks = []
        self.zeros = []
        for plane in planes:
            words = np.bitwise_count(plane.view(np.uint64)).reshape(-1, WORD_BITS // 64).sum(1)
            self.ranks.append(np.append(0, np.cumsum(words, dtype=np.int64)))
            self.zeros.append(n - int(self.ranks[-1][-1]))

    @staticmethod
    def build(values: np.ndarray) -> "WaveletMatrix":
        n = len(values)
        high = int(values.max()).bit_length() if n else 0
        planes = []
        now = values
        padded = -(-max(n, 1) // WORD_BITS) * WORD_BITS // 8
        for b in range(max(high, 1) - 1, -1, -1):
            bits = (now >> np.asarray(b, now.dtype)) & np.asarray(1, now.dtype)
            mask = bits.astype(bool)
            plane = np.zeros(padded, np.uint8)
            packed = np.packbits(mask, bitorder="little")
            plane[: len(packed)] = packed
            planes.append(plane)
            now = np.concatenate([now[~mask], now[mask]])
        return WaveletMatrix(n, planes)

    def _rank1(self, p: int, at: np.ndarray) -> np.ndarray:
        """Ones before position ``at`` in plane ``p``."""
        plane, word = self.planes[p].view(np.uint64), at // WORD_BITS
        out = self.ranks[p][word].copy()
        for k in range(WORD_BITS // 64):
            upto = np.clip(at - word * WORD_BITS - 64 * k, 0, 64)
            index = np.minimum(word * (WORD_BITS // 64) + k, len(plane) - 1)
            mask = np.where(upto == 64, ~np.uint64(0), (np.uint64(1) << (upto % 64).astype(np.uint64)) - np.uint64(1))
            out += np.bitwise_count(plane[index] & mask)
        return out

    def access(self, at: np.ndarray) -> np.ndarray:
        """Values at the given positions."""
        at = np.asarray(at, np.int64).copy()
        value = np.zeros(len(at), np.int64)
        for p in range(len(self.planes)):
            bit = (self.planes[p][at >> 3] >> (at & 7).astype(np.uint8)) & 1
            ones = self._rank1(p, at)
            at = np.where(bit == 1, self.zeros[p] + ones, at - ones)
            value = (value << 1) | bit
        return value

    def _range(self, value: int, start: int, end: int) -> tuple[int, int]:
        if value < 0 or value >> len(self.planes):
            return 0, 0
        for p in range(len(self.planes)):
            a, b = self._rank1(p, np.array([start, end]))
            one = (value >> (len(self.planes) - 1 - p)) & 1
            start, end = (self.zeros[p] + int(a), self.zeros[p] + int(b)) if one else (start - int(a), end - int(b))
        return start, end

    def count(self, value: int, start: int = 0, end: int | None = None) -> int:
        """How often ``value`` occurs in ``[start, end)``."""
        a, b = self._range(value, start, self.n if end is None else end)
        return b - a

    def _select(self, p: int, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) ``bit`` in plane ``p``."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = int(self._rank1(p, np.array([mid + 1]))[0])
            if (ones if bit else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def select(self, value: int, k: int) -> int:
        """Position of the ``k``-th (from 0) occurrence of ``value``, or -1."""
        a, b = self._range(value, 0, self.n)
        if k < 0 or a + k >= b:
            return -1
        at = a + k
        for p in range(len(self.planes) - 1, -1, -1):
            one = (value >> (len(self.planes) - 1 - p)) & 1
            at = self._select(p, one, at - self.zeros[p] if one else at)
        return at

    def values(self) -> np.ndarray:
        """All values, from the lowest plane up."""
        now = np.zeros(self.n, np.uint32)
        for p in range(len(self.planes) - 1, -1, -1):
            mask = np.unpackbits(self.planes[p], count=self.n, bitorder="little").view(bool)
            before = np.empty(self.n, np.uint32)
            before[~mask] = now[: self.zeros[p]]
            before[mask] = now[self.zeros[p] :] | np.uint32(1 << (len(self.planes) - 1 - p))
            now = before
        return now

    def dump(self, ends: np.ndarray) -> bytes:
        """File content: head, end of each document, planes. Ranks are rebuilt when read."""
        body = np.ascontiguousarray(ends, "<u8").tobytes() + b"".join(x.tobytes() for x in self.planes)
        return HEAD.pack(MAGIC, len(self.planes), self.n, len(ends)) + squeeze(body, 1)

    @staticmethod
    def load(content: bytes) -> tuple["WaveletMatrix", np.ndarray]:
        magic, n_planes, n, docs = HEAD.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("Not a token shard.")
        body = expand(content[HEAD.size :])
        rest = np.frombuffer(body, np.uint8, offset=8 * docs)
        planes = [rest[i * len(rest) // n_planes : (i + 1) * len(rest) // n_planes].copy() for i in range(n_planes)]
        return WaveletMatrix(n, planes), np.frombuffer(body, "<u8", docs).astype(np.int64)


_TABLES: dict[bytes, WordTable] = {}


def _library_table(squeezed: bytes) -> WordTable:
    if squeezed not in _TABLES:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(expand(squeezed).decode())
        library.no_padding()
        library.no_truncation()

        def encode_words(words: list[str]) -> Coded:
            if not words:
                return np.zeros(0, np.uint32), np.zeros(0, np.int64)
            found = library.encode(words, is_pretokenized=True, add_special_tokens=False)
            return np.array(found.ids, np.uint32), np.bincount(np.array(found.word_ids, np.int64), minlength=len(words))

        _TABLES.clear()
        _TABLES[squeezed] = WordTable(encode_words)
    return _TABLES[squeezed]


def write_shards(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = 2,
) -> str:
    """Encode whole texts, append ``end_id`` to each and store wavelet shards at ``path``.

    Documents are ordered by ``key`` over all shards (NULL keys first, repeated keys side by
    side). A NULL text counts as empty and has the end id only. Shards are rows of a Parquet
    table: ``part`` and ``seq`` order them, ``keys`` lists their documents, ``content`` is
    the shard in its file format.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    squeezed = squeeze(tokenizer_text(tokenizer).encode(), 9)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _library_table(squeezed)
        part = TaskContext.get().partitionId()
        for seq, piece in enumerate(byte_pieces(batches, "text", SHARD_TEXT_BYTES)):
            tokens, ends = table.ids(piece.column("text"))
            stream = np.insert(tokens, ends, np.uint32(end_id))
            ends = ends + np.arange(1, len(ends) + 1)
            dtype = np.uint16 if len(stream) == 0 or stream.max() < 1 << 16 else np.uint32
            content = WaveletMatrix.build(stream.astype(dtype)).dump(ends)
            keys = pa.ListArray.from_arrays(pa.array([0, len(ends)], pa.int32()), piece.column("key"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(stream)], pa.int64()), keys, pa.array([content], pa.binary())],
                names=["part", "seq", "n", "keys", "content"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first())
    ordered.mapInArrow(run, f"part int, seq int, n long, keys array<{kind}>, content binary").write.parquet(path)
    return path


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Documents read back from shards: key, start, n_tokens and packed uint32 ids."""
    bounded_batches(spark)
    shards = spark.read.parquet(path)
    kind = shards.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                matrix, ends = WaveletMatrix.load(batch.column("content")[i].as_py())
                raw = matrix.values().astype("<u4").tobytes()
                starts = np.append(0, ends[:-1])
                for a in range(0, len(ends), 2048):
                    lo, hi = starts[a : a + 2048], ends[a : a + 2048]
                    m = len(lo)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([batch.column("part")[i].as_py()] * m, pa.int32()),
                            pa.array([batch.column("seq")[i].as_py()] * m, pa.int32()),
                            batch.column("keys")[i].values.slice(a, m),
                            pa.array(lo, pa.int64()),
                            pa.array(hi - lo, pa.int64()),
                            pa.array([raw[4 * x : 4 * y] for x, y in zip(lo, hi)], pa.binary()),
                        ],
                        names=["part", "seq", "key", "local", "n_tokens", "ids"],
                    )

    return shards.select("part", "seq", "keys", "content").mapInArrow(
        run, f"part int, seq int, key {kind}, local long, n_tokens long, ids binary"
    )


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, offset): ids before each shard; one row per shard, not per document.

    Offsets inside a part and of whole parts are summed apart, so no task orders all shards.
    """
    sizes = spark.read.parquet(path).select("part", "seq", "n")
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before = parts.selectExpr("part", "coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base")
    within = sizes.selectExpr(
        "part", "seq", "coalesce(sum(n) OVER (PARTITION BY part ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inside"
    )
    return within.join(before, "part").selectExpr("part", "seq", "base + inside AS offset")


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Write shards below the shared folder and read every document back: key, start, n_tokens, ids."""
    spark = docs.sparkSession
    path = write_shards(docs, fresh_path(spark, "token-shards"), key, text, tokenizer, end_id)
    rows = read_shards(spark, path).join(shard_starts(spark, path), ["part", "seq"])
    return rows.select(F.col("key").alias(key), (F.col("offset") + F.col("local")).alias("start"), "n_tokens", "ids")
