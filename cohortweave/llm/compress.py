"""Quality classifier by compression: zstandard dictionaries of good and of bad labelled text.

Each text is compressed piece by piece under both dictionaries. The size differences, normalised by the text, become
a probability by a logistic calibration on labelled rows that were not used for the dictionaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.blocks import bounded_batches, byte_pieces

PIECE = 1024  # bytes compressed at once; a dictionary matters most for short inputs
LEVEL = 3
FEATURES = 3


class SizeDifference:
    """Normalised compressed-size differences of a text under a good and a bad dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.sides = []
        for content in (good, bad):
            kept = zstandard.ZstdCompressionDict(content)
            kept.precompute_compress(level=LEVEL)
            self.sides.append(
                zstandard.ZstdCompressor(level=LEVEL, dict_data=kept, write_content_size=False, write_checksum=False, write_dict_id=False)
            )

    def features(self, text: bytes) -> tuple[float, float, float]:
        """Difference per byte, largest relative difference of a piece, log of the mean size per byte."""
        good, bad = self.sides
        pieces = [text[i : i + PIECE] for i in range(0, len(text), PIECE)] or [b""]
        g = [len(good.compress(p)) for p in pieces]
        b = [len(bad.compress(p)) for p in pieces]
        whole = (sum(g) - sum(b)) / max(1, len(text))
        most = max((x - y) / (x + y) for x, y in zip(g, b))
        return whole, most, float(np.log((sum(g) + sum(b) + 20) / (2 * len(text) + 20)))


def piece_sample(rows: DataFrame, pieces: int) -> list[bytes]:
    """At most ``pieces`` pieces of the rows' whole texts, by least hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in byte_pieces(batches, "text"):
            for text in piece.column("text").to_pylist():
                data = (text or "").encode()
                found = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
                yield pa.RecordBatch.from_pydict({"piece": pa.array(found, pa.binary())})

    listed = rows.select("text").mapInArrow(cut, "piece binary").orderBy(F.xxhash64("piece"), "piece").limit(pieces)
    return [bytes(r["piece"]) for r in listed.collect()]


def dictionary(pieces: list[bytes], size: int) -> bytes:
    """A trained dictionary; too few pieces to train on serve as they are."""
    try:
        return zstandard.train_dictionary(size, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-size:] or b"\n" * 8


def calibration(features: np.ndarray, good: np.ndarray, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, means and scales of a ridge logistic fit by Newton's method."""
    mean, scale = features.mean(0), features.std(0)
    scale[scale == 0] = 1
    x = np.c_[np.ones(len(features)), (features - mean) / scale]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = probability(x @ w)
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + ridge * np.eye(len(w)), x.T @ (good - p) - ridge * w)
        size = np.abs(step).max()
        w += step * min(1.0, 4 / max(size, 1e-12))
        if size < 1e-8:
            break
    return w, mean, scale


def probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    learn: str = "true",
    sample_rows: int = 8192,
    sample_pieces: int = 4096,
    dictionary_bytes: int = 112 << 10,
) -> DataFrame:
    """Per row of ``docs``: ``key``, ``score`` (probability of label 1) and ``predicted`` (1 from 0.5 on).

    Learns from a bounded sample: of each label the ``sample_rows`` keys of least hash among those that meet
    ``learn`` (SQL over ``key``), half for the dictionaries (at most ``sample_pieces`` pieces of 1 kB per label), half for
    the calibration. Of several marks of a key the lowest counts; other marks than 0 and 1 and NULL keys are
    ignored. With one label only, the score is 1 or 0 throughout; without any it is 0.5. NULL and
    empty texts are scored like any other text. Every row is scored on its whole text.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[key].dataType.simpleString()
    marks = (
        labels.filter(f"`{quality}` IN (0, 1) AND `{key}` IS NOT NULL AND ({learn})")
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(quality).alias("_good"))
        .withColumn("_hash", F.xxhash64(F.col("_key").cast("string")))
    )
    # Bounded by sample_rows per label, so it may be broadcast.
    chosen = [marks.filter(f"_good = {g}").orderBy("_hash", "_key").limit(sample_rows) for g in (0, 1)]
    sample = F.broadcast(chosen[0].unionAll(chosen[1]).withColumn("_fit", F.expr("_hash % 2 = 0")))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    known = rows.join(sample, F.expr("key = _key"))
    good, bad = (piece_sample(known.filter(f"_fit AND _good = {g}"), sample_pieces) for g in (1, 0))
    fixed = None
    model = None
    if good and bad:
        content = dictionary(good, dictionary_bytes), dictionary(bad, dictionary_bytes)

        def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            differ = SizeDifference(*content)
            for piece in byte_pieces(batches, "text"):
                x = np.array([differ.features(t.encode()) for t in piece.column("text").to_pylist()]).reshape(-1, FEATURES)
                yield pa.RecordBatch.from_arrays([piece.column("_good").cast(pa.int32()), *[pa.array(c) for c in x.T]], names=["good", "f0", "f1", "f2"])

        seen = known.filter("NOT _fit").select("_good", "text").mapInArrow(measured, "good int, f0 double, f1 double, f2 double").toPandas()
        if seen["good"].nunique() == 2:
            model = calibration(seen[["f0", "f1", "f2"]].to_numpy(), seen["good"].to_numpy(float))
    if model is None:
        found = [r["_good"] for r in chosen[0].unionAll(chosen[1]).select("_good").distinct().collect()]
        fixed = float(found[0]) if len(found) == 1 else 0.5

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        differ = SizeDifference(*content) if model else None
        for piece in byte_pieces(batches, "text"):
            if model:
                w, mean, scale = model
                x = np.array([differ.features(t.encode()) for t in piece.column("text").to_pylist()]).reshape(-1, FEATURES)
                p = probability(np.c_[np.ones(len(x)), (x - mean) / scale] @ w)
            else:
                p = np.full(piece.num_rows, fixed)
            yield pa.RecordBatch.from_arrays([piece.column("key"), pa.array(p)], names=["key", "score"])

    scored = rows.mapInArrow(score, f"key {kind}, score double")
    return scored.selectExpr(f"key AS `{key}`", "score", "cast(score >= 0.5 AS int) AS predicted")
