"""Benchmark decontamination as a prefix-filtered join of item windows and documents.

Every window of an item is a sequence of shingles (``SHINGLE`` consecutive words). A text holds
the window only if it holds all of its shingles, so one shingle per window is a sufficient
prefix: the rarest, counted over all documents. A document position with that shingle fixes where
the window would lie; windows that would leave the document drop out by that bound, the rest
is verified word by word.

Windows are handed to the document pass in blocks of at most ``BLOCK_WINDOWS``: the size of
what a task holds is bounded whatever the number of items, at one pass per block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.blocks import bounded_batches, byte_pieces, expand, mix64, squeeze, stored

WINDOW = 10
SHINGLE = 3
BLOCK_WINDOWS = 200_000

# Bytes that part words, after lower-casing A-Z; all others belong to words.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPLITTING = bytes(b for b in range(128) if not re.match(rb"[0-9a-z]", bytes([b])))
TO_SPACE = bytes(32 if b in SPLITTING and not 65 <= b <= 90 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TO_SPACE).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive word hashes at each start position."""
    n = len(words) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        out = mix64(out + words[k : k + n] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))
    return out


def item_windows(items: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """One row per distinct window of an item: ``item`` (as text), ``words`` (joined by spaces), ``n``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, value in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(value)
                size = min(window, len(words))
                found = {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()
                yield pa.RecordBatch.from_pydict(
                    {"item": pa.array([item] * len(found), pa.string()), "words": pa.array(sorted(found), pa.binary()).cast(pa.string()), "n": pa.array([size] * len(found), pa.int32())}
                )

    bounded_batches(items.sparkSession)
    rows = items.select(F.col(key).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    return rows.filter("text IS NOT NULL").mapInArrow(cut, "item string, words string, n int")


class TextPiece:
    """Words of a batch of texts as one array of ids, with hashes per word and document bounds."""

    def __init__(self, texts: pa.Array):
        data = pc.fill_null(texts, "").cast(pa.binary())
        spaced = pa.array([x.translate(TO_SPACE) for x in data.to_pylist()], pa.binary()).cast(pa.string())
        lists = pc.ascii_split_whitespace(spaced)
        flat = lists.values
        bounds = lists.offsets.to_numpy().astype(np.int64)
        there = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        self.bounds = np.append(0, np.cumsum(there))[bounds]
        coded = flat.filter(pa.array(there)).dictionary_encode()
        self.names = coded.dictionary.cast(pa.binary()).to_pylist()
        self.code = coded.indices.to_numpy()
        self.hashes = word_hashes(self.names)[self.code] if len(self.names) else np.zeros(0, np.uint64)
        self.doc = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


class Lookup:
    """Sorted shingle hashes behind a bit table of their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(keys >> np.uint64(44)).astype(np.int64)] = True

    @staticmethod
    def of(grams: list[list[bytes]], size: int) -> tuple["Lookup", np.ndarray]:
        """Lookup of the shingles and the order in which it holds them."""
        hashes = np.concatenate([shingle_hashes(word_hashes(g), size) for g in grams])
        order = np.argsort(hashes, kind="stable")
        return Lookup(hashes[order]), order

    def find(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions that hold a key, and the bounds of the equal keys."""
        near = np.flatnonzero(self.bits[(shingles >> np.uint64(44)).astype(np.int64)])
        left, right = np.searchsorted(self.keys, shingles[near]), np.searchsorted(self.keys, shingles[near], "right")
        hit = right > left
        return near[hit], left[hit], right[hit]


class WindowBlock:
    """A block of windows with their prefix shingle, ready to be looked up."""

    def __init__(self, rows: list[tuple[str, int, int]], sizes: list[int]):
        # rows: (words, prefix position, prefix size); sizes are the prefix sizes that occur
        self.words = [r[0].encode().split(b" ") for r in rows]
        self.tables = []
        for size in sizes:
            own = [i for i, r in enumerate(rows) if r[2] == size]
            lookup, order = Lookup.of([self.words[i][rows[i][1] : rows[i][1] + size] for i in own], size)
            self.tables.append((size, lookup, np.array(own)[order], np.array([rows[i][1] for i in own])[order]))

    def occurrences(self, piece: TextPiece) -> Iterator[tuple[int, int, int]]:
        """(window, first position, size) of every occurrence in the piece."""
        place = {w: i for i, w in enumerate(piece.names)}
        spelled = [[place.get(w, -1) for w in ws] for ws in self.words]
        for size, lookup, window, offset in self.tables:
            near, left, right = lookup.find(shingle_hashes(piece.hashes, size))
            for at, a, b in zip(near.tolist(), left.tolist(), right.tolist()):
                doc = piece.doc[at]
                for k in range(a, b):
                    first, words = at - int(offset[k]), spelled[window[k]]
                    # Positional bound, then the words themselves.
                    if first >= piece.bounds[doc] and first + len(words) <= piece.bounds[doc + 1]:
                        if piece.code[first : first + len(words)].tolist() == words:
                            yield int(window[k]), first, len(words)


def _prefixes(windows: DataFrame, docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """Add ``at`` and ``size``: the rarest shingle of each distinct window, counted over all documents."""
    spark = docs.sparkSession
    cut = windows.select("words", "n").distinct().selectExpr(
        "words", f"split(words, ' ') AS _w", f"least(n, {shingle}) AS size"
    ).selectExpr("words", "size", "posexplode(transform(sequence(1, size(_w) - size + 1), i -> array_join(slice(_w, i, size), ' '))) AS (at, gram)")
    cut = stored(cut, "window-shingles")
    grams = cut.select("gram").distinct()
    counts = None
    for chunk in _blocks(grams, "gram", BLOCK_WINDOWS):
        listed = squeeze("\n".join(r["gram"] for r in chunk).encode())

        def count(batches: Iterator[pa.RecordBatch], listed: bytes = listed) -> Iterator[pa.RecordBatch]:
            names = expand(listed).decode().split("\n")
            sizes = sorted({g.count(" ") + 1 for g in names})
            tables = []
            for k in sizes:
                own = [i for i, g in enumerate(names) if g.count(" ") + 1 == k]
                tables.append((k, *Lookup.of([names[i].encode().split(b" ") for i in own], k), np.array(own)))
            total = np.zeros(len(names), np.int64)
            for piece in byte_pieces(batches, "text"):
                hashes = TextPiece(piece.column("text")).hashes
                for k, lookup, order, own in tables:
                    _, left, _ = lookup.find(shingle_hashes(hashes, k))
                    total[own[order]] += np.bincount(left, minlength=len(own))
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"gram": pa.array([names[i] for i in some], pa.string()), "c": pa.array(total[some], pa.int64())})

        part = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "gram string, c long")
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        counts = spark.createDataFrame([], "gram string, c long")
    totals = counts.groupBy("gram").agg(F.sum("c").alias("c"))
    # Order of rarity: count, then the shingle itself; a shingle in no document makes its window absent.
    return (
        cut.join(totals, "gram")
        .groupBy("words")
        .agg(F.expr("min_by(struct(at, size), struct(c, gram, at)) AS _p"), F.expr("count(*) AS _found"), F.first(F.expr("size(split(words, ' ')) - size + 1")).alias("_all"))
        .filter("_found = _all")
        .selectExpr("words", "_p.at AS at", "_p.size AS size")
    )


def _blocks(rows: DataFrame, order: str, limit: int) -> Iterator[list]:
    """Rows of a small stated table in blocks of at most ``limit``."""
    held: list = []
    for row in rows.orderBy(order).toLocalIterator():
        held.append(row)
        if len(held) == limit:
            yield held
            held = []
    if held:
        yield held


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_words``, ``n_hit`` (words inside an occurring window), ``items`` (sorted ids as text).

    A window is ``window`` consecutive words of an item, or all words of a shorter one. NULL and
    empty texts have no words; items without words match nothing. Repeated documents are
    searched one by one and repeated items count once per id; an item without an id matches nothing.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[key].dataType.simpleString()
    windows = stored(item_windows(items.filter(F.col(item_key).isNotNull()), item_key, item_text, window).distinct(), "item-windows")
    prefixes = stored(_prefixes(windows, docs, text, shingle), "window-prefixes")
    owners = windows.groupBy("words").agg(F.expr("array_sort(collect_set(item)) AS items"))
    listed = prefixes.join(owners, "words")
    fields = f"row string, key {kind}, n_words long, hits binary, items array<string>"
    rows = docs.select(F.expr("uuid()").alias("row"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    blocks = list(_blocks(listed, "words", BLOCK_WINDOWS)) or [[]]
    if len(blocks) > 1:  # the rows of several passes meet by a stored row id
        rows = stored(rows, "decontamination-rows")
    found = None
    for block in blocks:
        content = squeeze("\n".join(f"{r['words']}\t{r['at']}\t{r['size']}\t" + "\x1f".join(r["items"]) for r in block).encode())
        part = rows.mapInArrow(_search(content), fields)
        found = part if found is None else found.unionByName(part)
    if len(blocks) > 1:
        found = found.groupBy("row").applyInArrow(_merge, found.schema)
    found = found.selectExpr("key", "n_words", "hits", "items")
    return found.selectExpr(f"key AS `{key}`", "n_words", "cast(length(hits) / 8 AS bigint) AS n_hit", "items")


def _search(content: bytes):
    """Find the windows of a block in batches of documents; hits are packed word positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = [x.split("\t") for x in expand(content).decode().split("\n") if x]
        block = WindowBlock([(w, int(a), int(s)) for w, a, s, _ in lines], sorted({int(x[2]) for x in lines}))
        owners = [x[3].split("\x1f") for x in lines]
        for piece in byte_pieces(batches, "text"):
            texts = TextPiece(piece.column("text"))
            edges = np.zeros(len(texts.code) + 1, np.int64)
            items: dict[int, set[str]] = {}
            for window, first, size in block.occurrences(texts):
                edges[first] += 1
                edges[first + size] -= 1
                items.setdefault(int(texts.doc[first]), set()).update(owners[window])
            hit = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
            starts = np.searchsorted(hit, texts.bounds)
            n = piece.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("row"),
                    piece.column("key"),
                    pa.array(np.diff(texts.bounds), pa.int64()),
                    pa.array([(hit[starts[i] : starts[i + 1]] - texts.bounds[i]).tobytes() for i in range(n)], pa.binary()),
                    pa.array([sorted(items.get(i, ())) for i in range(n)], pa.list_(pa.string())),
                ],
                names=["row", "key", "n_words", "hits", "items"],
            )

    return run


def _merge(group: pa.Table) -> pa.Table:
    """One document's results of several window blocks."""
    hits = np.unique(np.concatenate([np.frombuffer(x, np.int64) for x in group.column("hits").to_pylist()]))
    items = sorted({i for x in group.column("items").to_pylist() for i in x})
    return group.slice(0, 1).set_column(3, "hits", pa.array([hits.tobytes()], pa.binary())).set_column(4, "items", pa.array([items], pa.list_(pa.string())))
