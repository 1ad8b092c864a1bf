"""Removal of byte strings that occur more than once, by a distributed merge of sorted suffix runs.

A repeated string of ``length`` bytes is found through an anchor: of the ``gram``-byte strings inside
it, the one with the least hash. Equal strings have equal anchors at equal offsets, so

1. every block sends the hashes of its anchors; an anchor that occurs once proves that none of its
   strings repeats, and drops out;
2. the suffixes at the other anchors are sorted per block into runs, front-coded (shared prefix length and
   rest), and exchanged by anchor;
3. a loser tree merges the runs of a bucket. Players carry the prefix they share with the last winner;
   only equal lengths need a comparison, which starts behind that prefix. The shared prefix lengths of
   the merged order cut the suffixes into classes for every string length at once; the bytes before the
   anchors, ordered from right to left, give the other side. A string repeats when its two classes hold
   another suffix;
4. every block cuts the repeated ranges out of its documents.

An anchor that occurs in every block several times (copies, common passages) would bring one suffix per
occurrence with ever other surroundings. Its strings are first reduced, by hash, to those that repeat as
a whole; these are the same in all blocks, so a run holds each once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.blocks import (
    bounded_batches,
    bucket_pieces,
    buckets_for,
    by_bucket,
    expand,
    mix64,
    pack,
    per_block,
    ragged,
    squeeze,
    stored,
    write_blocks,
)
from cohortweave.llm.exchange import VALUE_ROWS, VALUE_SCHEMA, batch_of, gathered, totals_of, value_rows, value_totals

LENGTH = 200
GRAM = 64
FREQUENT_PER_BLOCK = 8
BUCKET_BYTES = 48 << 20
SLICE_BYTES = 1 << 20


def rolled(data: bytes, sizes: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Hash of the ``size`` bytes at every position, for sizes of 8 and more."""
    out = {}
    n = len(data) - 7
    word = np.zeros(max(n, 0), np.uint64)
    for j in range(8 if n > 0 else 0):
        part = np.frombuffer(data, "<u8", (len(data) - j) // 8, j)
        word[j::8] = part[: len(word[j::8])]
    levels = {8: mix64(word)}
    size = 8
    while 2 * size <= max(sizes):
        now = levels[size]
        m = max(len(now) - size, 0)
        levels[2 * size] = _joined(now[:m], now[size : size + m])
        size *= 2
    for want in sizes:
        at = 1 << (want.bit_length() - 1)
        now, done = levels[at], at
        while done < want:
            piece = max(s for s in levels if s <= max(want - done, 8))
            done = min(done + piece, want)
            other = levels[piece][done - piece :]
            m = min(len(now), len(other))
            now = _joined(now[:m], other[:m])
        out[want] = now[: max(len(data) - want + 1, 0)]
    return out


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a * np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    out += b
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def slices(ends: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray]]:
    """Byte ranges of whole documents of about ``limit`` bytes, with the ends inside: work arrays stay small."""
    ends = ends[ends > 0]
    at = begin = 0
    while at < len(ends):
        stop = max(int(np.searchsorted(ends, begin + limit, "right")), at + 1)
        yield begin, int(ends[stop - 1]), ends[at:stop] - begin
        at, begin = stop, int(ends[stop - 1])


def anchors(data: bytes, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor position, gram hash, least and greatest distance back to the strings it stands for."""
    found = [(pos + a, *rest) for a, b, inside in slices(ends) for pos, *rest in [_slice_anchors(data[a:b], inside, length, gram)]]
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (empty, empty.view(np.uint64), empty, empty)


def string_hashes(data: bytes, ends: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes at each of ``starts``."""
    out = np.zeros(len(starts), np.uint64)
    for a, b, _ in slices(ends):
        own = np.flatnonzero((starts >= a) & (starts < b))
        if len(own):
            out[own] = rolled(data[a:b], (length,))[length][starts[own] - a]
    return out


def _slice_anchors(data: bytes, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty.view(np.uint64), empty, empty
    hashes = rolled(data, (gram,))[gram]
    # Leftmost least hash: the upper half orders, the position breaks ties.
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    width, have = length - gram + 1, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    starts = np.append(0, ends[:-1])
    counts = np.maximum(ends - starts - length + 1, 0)
    s = ragged(starts, counts)
    at = (least[s] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(at):
        return empty, empty.view(np.uint64), empty, empty
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    last = np.append(first[1:], len(at)) - 1
    pos = at[first]
    return pos, hashes[pos], pos - s[last], pos - s[first]


def short(positions: np.ndarray, size: int) -> np.ndarray:
    """Positions in four bytes where the block is small enough, as all but single huge texts are."""
    return positions.astype(np.int32 if size < 1 << 31 else np.int64)


def width(packed: bytes, n: int) -> type:
    return np.int64 if n and len(packed) == 8 * n else np.int32


class Run:
    """A sorted run of distinct (right, left) byte strings, front-coded on the right side."""

    FIELDS = ("lcp", "size", "left", "times", "at", "bytes")

    @staticmethod
    def encode(data: bytes, pos: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> dict[str, bytes]:
        """``right``: from ``pos`` up to the end of the last string; ``left``: back to the start of the first."""
        places: dict[tuple[bytes, bytes], list[int]] = {}
        for p, a, b in zip(pos.tolist(), low.tolist(), high.tolist()):
            places.setdefault((data[p : p + length - a], data[p - b : p][::-1]), []).append(p)
        items = sorted(places)
        lcp, rest, before = [], [], b""
        for right, _ in items:
            h = shared_prefix(before, right, 0)
            lcp.append(h)
            rest.append(right[h:])
            before = right
        return {
            "lcp": pack(np.array(lcp, np.int32)),
            "size": pack(np.array([len(r) for r in rest], np.int32)),
            "left": pack(np.array([len(x) for _, x in items], np.int32)),
            "times": pack(np.array([len(places[i]) for i in items], np.int32)),
            "at": pack(short(np.array([p for i in items for p in places[i]], np.int64), len(data))),
            "bytes": squeeze(b"".join(rest) + b"".join(x for _, x in items)),
        }

    def __init__(self, block: int, row: dict):
        self.block = block
        self.lcp = np.frombuffer(row["lcp"], np.int32).tolist()
        size, self.left_size = np.frombuffer(row["size"], np.int32), np.frombuffer(row["left"], np.int32)
        self.times = np.frombuffer(row["times"], np.int32)
        self.at = np.frombuffer(row["at"], width(row["at"], int(self.times.sum()))).astype(np.int64)
        body = expand(row["bytes"])
        ends = np.append(0, np.cumsum(np.concatenate([size, self.left_size]))).tolist()
        n = len(self.lcp)
        self.rest = [body[a:b] for a, b in zip(ends[:n], ends[1 : n + 1])]
        self.left = [body[a:b] for a, b in zip(ends[n:], ends[n + 1 :])]
        self.next = 0
        self.head = b""

    def advance(self) -> int:
        """Make the next suffix the head; its prefix shared with the one before, or -1 at the end."""
        if self.next >= len(self.lcp):
            return -1
        h = self.lcp[self.next]
        self.head = self.head[:h] + self.rest[self.next]
        self.next += 1
        return h


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, when the first ``known`` bytes are known to agree."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    differ = int.from_bytes(a[known:n]) ^ int.from_bytes(b[known:n])
    return n - (differ.bit_length() + 7) // 8


def merged(runs: list[Run]) -> Iterator[tuple[int, int]]:
    """(run, prefix shared with the suffix before) in sorted order, by a loser tree.

    A player's shared prefix is the one with the last winner, which no waiting suffix precedes. The longer
    it is the smaller the suffix; on a tie the bytes behind it decide, and the loser keeps what was found.
    """
    k = 1
    while k < len(runs):
        k *= 2
    known = [r.advance() for r in runs] + [-1] * (k - len(runs))  # -1: no suffix left
    heads = [r.head for r in runs]

    def beats(a: int, b: int) -> bool:
        ha, hb = known[a], known[b]
        if ha != hb:
            return ha > hb
        if ha < 0:
            return True
        x, y = heads[a], heads[b]
        h = shared_prefix(x, y, ha)
        first = h == len(x) or (h < len(y) and x[h] < y[h])
        known[b if first else a] = h
        return first

    losers = [0] * k
    winners = list(range(k))
    width = k
    while width > 1:
        half = []
        for i in range(0, width, 2):
            a, b = winners[i], winners[i + 1]
            won = beats(a, b)
            losers[(width + i) // 2] = b if won else a
            half.append(a if won else b)
        winners, width = half, width // 2
    best = winners[0]
    while known[best] >= 0:
        yield best, known[best]
        known[best] = runs[best].advance()
        heads[best] = runs[best].head
        node = (k + best) // 2
        while node:
            other = losers[node]
            if not beats(best, other):
                losers[node], best = best, other
            node //= 2


def repeats(runs: list[Run], length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block, starts, ends) of byte ranges made of repeated strings, from the runs of one bucket."""
    order, lcp, seen = [], [], [0] * len(runs)
    offsets = np.append(0, np.cumsum([len(r.lcp) for r in runs]))
    for run, h in merged(runs):
        order.append(int(offsets[run]) + seen[run])
        lcp.append(h)
        seen[run] += 1
    n = len(order)
    if not n:
        return
    order, lcp = np.array(order), np.array(lcp)
    lcp[0] = -1
    lefts = [x for r in runs for x in r.left]
    rights = np.concatenate([np.array(r.lcp) + np.array([len(x) for x in r.rest], np.int64) for r in runs])
    low, high = length - rights, np.array([len(x) for x in lefts])
    times = np.concatenate([r.times for r in runs])
    by_left = np.array(sorted(range(n), key=lefts.__getitem__))
    left_lcp = np.array([-1] + [shared_prefix(lefts[a], lefts[b], 0) for a, b in zip(by_left[:-1].tolist(), by_left[1:].tolist())])
    opened = np.full(n, -1)
    spans: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    top = int(high.max())
    for o in range(int(low.min()), top + 2):
        flagged = np.zeros(n, bool)
        active = np.flatnonzero((low <= o) & (high >= o))
        if len(active):
            right_class[order] = np.cumsum(lcp < length - o)
            left_class[by_left] = np.cumsum(left_lcp < o)
            _, inverse = np.unique(right_class[active] * (n + 1) + left_class[active], return_inverse=True)
            flagged[active] = np.bincount(inverse, times[active])[inverse] >= 2
        closing = np.flatnonzero((opened >= 0) & ~flagged)
        if len(closing):
            spans.append((closing, opened[closing], np.full(len(closing), o - 1)))
            opened[closing] = -1
        opened[flagged & (opened < 0)] = o
    if not spans:
        return
    item, first, last = (np.concatenate(x) for x in zip(*spans))
    for i, run in enumerate(runs):
        own = (item >= offsets[i]) & (item < offsets[i + 1])
        if own.any():
            local = item[own] - offsets[i]
            places = np.append(0, np.cumsum(run.times))
            counts = run.times[local].astype(np.int64)
            at = run.at[ragged(places[local], counts)]
            yield run.block, at - np.repeat(last[own], counts), at - np.repeat(first[own], counts) + length


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}


def _block_anchors(row: dict, buckets: int, frequent: int) -> tuple[np.ndarray, ...]:
    """Anchors of a block that occur again, and which of them are frequent."""
    hashes = np.frombuffer(row["hashes"], np.uint64)
    values, inverse = np.unique(hashes, return_inverse=True)
    totals = totals_of(values, row["parts"], buckets)[inverse]
    again = totals >= 2
    pos, low, high = (np.frombuffer(row[c], c_type).astype(np.int64)[again] for c, c_type in (("pos", width(row["pos"], len(hashes))), ("low", np.int16), ("high", np.int16)))
    return pos, hashes[again], low, high, totals[again] >= frequent


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, decoded: bool = False) -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_bytes``, ``spans`` (removed byte ranges) and ``kept`` (remaining bytes).

    With ``decoded``, ``kept`` is text; characters of which a part was removed are left out.

    Removed is each byte inside a string of ``length`` bytes that starts anywhere else too, in the same or
    another row; strings never cross rows and all are judged on the input. A NULL text is empty; a text
    shorter than ``length`` stays whole. Repeated rows of enough bytes remove each other.
    """
    if gram >= length or gram < 8 or length > 32000:
        raise ValueError("gram must be at least 8 and below length; length at most 32000")
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[key].dataType.simpleString()

    def find(data: bytes, ends: np.ndarray) -> dict:
        pos, hashes, low, high = anchors(data, ends, length, gram)
        return {"pos": pack(short(pos, len(data))), "hashes": pack(hashes), "low": pack(low.astype(np.int16)), "high": pack(high.astype(np.int16)), "n_bytes": len(data)}

    blocks = write_blocks(docs, key, text, "suffix-blocks", find, "pos binary, hashes binary, low binary, high binary, n_bytes long")
    size = blocks.agg(F.sum("n_bytes").alias("total"), F.count("*").alias("n")).first()
    buckets = buckets_for(spark, size["total"] or 0, BUCKET_BYTES)
    frequent = FREQUENT_PER_BLOCK * max(size["n"], 1)

    def anchor_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            values, counts = np.unique(np.frombuffer(row["hashes"], np.uint64), return_counts=True)
            if len(values):
                yield batch_of(list(value_rows(row["block"], values, counts, buckets)), VALUE_SCHEMA)

    again = stored(value_totals(blocks.select("block", "hashes").mapInArrow(anchor_values, VALUE_ROWS), buckets), "suffix-anchors")
    known = blocks.select("block", "ends", "data", "pos", "hashes", "low", "high").join(again, "block")

    def string_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            pos, _, low, high, often = _block_anchors(row, buckets, frequent)
            if often.any():
                starts = ragged(pos[often] - high[often], high[often] - low[often] + 1)
                values, counts = np.unique(string_hashes(expand(row["data"]), np.frombuffer(row["ends"], np.int64), starts, length), return_counts=True)
                yield batch_of(list(value_rows(row["block"], values, counts, buckets)), VALUE_SCHEMA)

    strings = stored(value_totals(known.mapInArrow(string_values, VALUE_ROWS), buckets), "suffix-strings")
    ready = known.join(strings.withColumnRenamed("parts", "strings"), "block", "left")
    run_fields = "bucket int, block long, " + ", ".join(f"{c} binary" for c in Run.FIELDS)

    def sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            data = expand(row["data"])
            pos, hashes, low, high, often = _block_anchors(row, buckets, frequent)
            if often.any():
                starts = ragged(pos[often] - high[often], high[often] - low[often] + 1)
                own = string_hashes(data, np.frombuffer(row["ends"], np.int64), starts, length)
                values, inverse = np.unique(own, return_inverse=True)
                hit = (totals_of(values, row["strings"], buckets) >= 2)[inverse]
                none = np.zeros(int(hit.sum()), np.int64)
                pos, hashes = np.append(pos[~often], starts[hit]), np.append(hashes[~often], own[hit])
                low, high = np.append(low[~often], none), np.append(high[~often], none)
            order, found, bounds = bucket_pieces((hashes % np.uint64(buckets)).astype(np.int64))
            for b, x, y in zip(found.tolist(), bounds, bounds[1:]):
                z = order[x:y]
                yield batch_of([{"bucket": b, "block": row["block"], **Run.encode(data, pos[z], low[z], high[z], length)}], run_schema)

    run_schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), *((c, pa.binary()) for c in Run.FIELDS)])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, starts, ends in repeats([Run(row["block"], row) for row in _each(batches)], length):
            yield pa.RecordBatch.from_pydict({"block": [block], "starts": [pack(starts)], "ends": [pack(ends)]})

    runs = by_bucket(ready.mapInArrow(sorted_runs, run_fields), buckets)
    ranges = stored(per_block(runs.mapInArrow(merge, "block long, starts binary, ends binary").withColumnRenamed("ends", "stops")), "suffix-ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            data, ends = expand(row["data"]), np.frombuffer(row["ends"], np.int64)
            edges = np.zeros(len(data) + 1, np.int32)
            starts, stops = gathered(row["parts"], ("starts", "stops"), (np.int64, np.int64))
            np.add.at(edges, starts, 1)
            np.add.at(edges, stops, -1)
            gone = np.cumsum(edges[:-1]) > 0
            begin = np.append(0, ends[:-1])
            # Removed runs, cut at document bounds.
            turn = gone.copy()
            turn[1:] &= ~gone[:-1]
            inner = begin[(begin > 0) & (begin < len(data))]
            turn[inner] = gone[inner]
            firsts = np.flatnonzero(turn)
            closing = gone.copy()
            closing[:-1] &= ~gone[1:]
            closing[inner - 1] = gone[inner - 1]
            lasts = np.flatnonzero(closing) + 1
            left = np.frombuffer(data, np.uint8)[~gone].tobytes()
            left_ends = np.append(0, np.cumsum(~gone))
            of_doc = np.searchsorted(firsts, np.append(begin, len(data)))
            for a in range(0, len(ends), 1024):
                out = {"key": row["keys"][a : a + 1024], "n_bytes": (ends - begin)[a : a + 1024].tolist(), "spans": [], "kept": []}
                for i in range(a, min(a + 1024, len(ends))):
                    z = slice(of_doc[i], of_doc[i + 1])
                    out["spans"].append([{"start": int(x - begin[i]), "end": int(y - begin[i])} for x, y in zip(firsts[z], lasts[z])])
                    rest = left[left_ends[begin[i]] : left_ends[ends[i]]]
                    out["kept"].append(rest.decode("utf-8", "ignore") if decoded else rest)
                yield pa.RecordBatch.from_pydict(out, cut_schema)

    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    cut_schema = pa.schema([("key", pa.string()), ("n_bytes", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.string() if decoded else pa.binary())])
    finished = blocks.select("block", "keys", "ends", "data").join(ranges, "block", "left")
    rows = finished.mapInArrow(cut, f"key string, n_bytes long, spans array<struct<start:int,end:int>>, kept {'string' if decoded else 'binary'}")
    return rows.select(F.col("key").cast(kind).alias(key), "n_bytes", "spans", "kept")
