"""Totals of values over all blocks, and connected classes of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.blocks import bounded_batches, bucket_pieces, by_bucket, expand, from_planes, pack, per_block, squeeze, squeeze_planes, stored

VALUE_ROWS = "bucket int, block long, values binary, counts binary"


def value_rows(block: int, values: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[dict]:
    """Packed rows per bucket of a block's distinct uint64 ``values``, as differences, and their int64 ``counts``."""
    order, found, bounds = bucket_pieces((values % np.uint64(buckets)).astype(np.int64))
    values, counts = values[order], counts[order]
    for b, lo, hi in zip(found.tolist(), bounds, bounds[1:]):
        yield {"bucket": b, "block": block, "values": squeeze_planes(np.diff(values[lo:hi], prepend=np.uint64(0))), "counts": squeeze_planes(counts[lo:hi].astype(np.int32))}


def batch_of(rows: list[dict], schema: pa.Schema | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


VALUE_SCHEMA = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("values", pa.binary()), ("counts", pa.binary())])
TOTAL_SCHEMA = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("totals", pa.binary()), ("ranks", pa.binary())])
SUMMARY = -1  # block number of the row that sums up a bucket


def value_totals(rows: DataFrame, buckets: int, ranked: bool = False) -> DataFrame:
    """For ``VALUE_ROWS``: per block the totals of its values over all blocks, as ``parts`` for ``totals_of``.

    A block sends each of its distinct values once, so a value of any frequency takes at most one entry per
    block in its bucket. Totals return in the order in which the values were sent; most are 1 and squeeze well. They take four
    bytes, or eight in a part that needs them.
    ``ranked`` adds the rank of each value in its bucket, and a row for block ``SUMMARY`` whose totals are the
    sum, the number of values of any total above 0, and the number of all values, of each bucket.
    """
    bounded_batches(rows.sparkSession)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, values, counts = [], [], []
        for batch in batches:
            for bucket, block, v, c in zip(*(batch.column(k).to_pylist() for k in VALUE_SCHEMA.names)):
                values.append(np.cumsum(from_planes(expand(v), np.uint64)))
                counts.append(from_planes(expand(c), np.int32))
                sent.append((bucket, block, len(values[-1])))
        if not sent:
            return
        every, inverse = np.unique(np.concatenate(values), return_inverse=True)
        sums = np.bincount(inverse, np.concatenate(counts), len(every)).astype(np.int64)
        del every, values, counts
        at = 0
        for bucket, block, n in sent:
            totals = sums[inverse[at : at + n]]
            totals = totals.astype(np.int64 if totals.max(initial=0) >> 31 else np.int32)
            at += n
            ranks = squeeze_planes(inverse[at - n : at].astype(np.int64)) if ranked else None
            yield batch_of([{"bucket": bucket, "block": block, "totals": squeeze_planes(totals), "ranks": ranks}], TOTAL_SCHEMA)
        if ranked:
            yield batch_of([{"bucket": sent[0][0], "block": SUMMARY, "totals": pack(np.array([sums.sum(), (sums > 0).sum(), len(sums)])), "ranks": None}], TOTAL_SCHEMA)

    return per_block(by_bucket(rows, buckets).mapInArrow(total, "bucket int, block long, totals binary, ranks binary"))


def totals_of(values: np.ndarray, parts: list[dict] | None, buckets: int) -> np.ndarray:
    """Totals of a block's distinct ``values``, the same array that was sent."""
    order, found, bounds = bucket_pieces((values % np.uint64(buckets)).astype(np.int64))
    by_number = {p["bucket"]: p["totals"] for p in parts or ()}
    out = np.zeros(len(values), np.int64)
    for b, lo, hi in zip(found.tolist(), bounds, bounds[1:]):
        raw = expand(by_number[b])
        out[order[lo:hi]] = from_planes(raw, np.int64 if len(raw) == 8 * (hi - lo) else np.int32)
    return out


def ids_of(values: np.ndarray, parts: list[dict], buckets: int) -> np.ndarray:
    """Whole numbers that tell the block's ``values`` apart in all blocks: rank in the bucket, then bucket."""
    order, found, bounds = bucket_pieces((values % np.uint64(buckets)).astype(np.int64))
    by_number = {p["bucket"]: p["ranks"] for p in parts}
    out = np.zeros(len(values), np.int64)
    for b, lo, hi in zip(found.tolist(), bounds, bounds[1:]):
        out[order[lo:hi]] = from_planes(expand(by_number[b]), np.int64) * buckets + b
    return out


def gathered(parts: list[dict], fields: tuple[str, ...], kinds: tuple) -> tuple[np.ndarray, ...]:
    """Arrays joined over the parts of a block."""
    return tuple(np.concatenate([np.frombuffer(p[f], k) for p in parts or ()] or [np.zeros(0, k)]) for f, k in zip(fields, kinds))


def components(links: DataFrame) -> DataFrame:
    """Classes of ``links`` (a, b: long): (node, root) with the least reachable node, for linked nodes.

    Alternates the large-star and small-star steps; each result is written to the shared
    folder. Neighbour lists are never gathered, only their least member is.
    """
    edges = stored(links.filter("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "links")
    before = None
    while True:
        both = edges.unionAll(edges.selectExpr("b AS a", "a AS b"))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).selectExpr("a", "least(a, _m) AS m")
        large = both.join(least, "a").filter("b > a").selectExpr("b AS a", "m AS b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a").selectExpr("inline(array(struct(a AS x, m AS y), struct(b AS x, m AS y)))").filter("x <> y")
        edges = stored(small.selectExpr("greatest(x, y) AS a", "least(x, y) AS b").distinct(), "links")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.expr("cast(xxhash64(a, b) AS decimal(38, 0))")).alias("h")).first()
        if state == before:
            return edges.selectExpr("a AS node", "b AS root").unionAll(edges.selectExpr("b AS node", "b AS root").distinct())
        before = state


def joined_classes(classes: DataFrame | None, links: DataFrame) -> DataFrame:
    """``classes`` (node, root) after further ``links`` (a, b), as ``components`` of all links; stored.

    Only links between classes are followed: those inside a class add nothing, and a class is one node.
    """
    if classes is None:
        return stored(components(links), "classes")
    roots = classes.selectExpr("node", "root AS _root")
    for side in "ab":
        links = links.join(roots, F.col(side) == F.col("node"), "left").withColumn(side, F.expr(f"coalesce(_root, {side})")).drop("node", "_root")
    between = stored(components(links), "class-links")
    moved = classes.join(between.selectExpr("node AS root", "root AS _to"), "root", "left").selectExpr("node", "coalesce(_to, root) AS root")
    return stored(moved.unionAll(between.join(classes.select("node"), "node", "left_anti")), "classes")
