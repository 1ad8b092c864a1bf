"""Scoring by an n-gram model whose tries are built, stored and queried in shards.

Words are counted over all training texts first. Then each level's n-grams of every block go to the shard of their
context (a frequent context is split by its successors); a shard sums them up, stores its trie level and
answers the same blocks with probability codes and nodes, which are the contexts of the next level. An n-gram whose first
or last words are not in the level below has no count either and is not sent. Blocks add up the scores of their documents.

Smoothing: P(w | context) = (c(context w) + strength * P(w | shorter context)) / (c(context) + strength); the first
level adds one to every count and keeps one share for unseen words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.blocks import (
    bounded_batches,
    bucket_pieces,
    buckets_for,
    by_bucket,
    expand,
    from_planes,
    mix64,
    per_block,
    squeeze_planes,
    stored,
    stored_alone,
    write_blocks,
)
from cohortweave.llm.exchange import SUMMARY, VALUE_ROWS, VALUE_SCHEMA, batch_of, ids_of, totals_of, value_rows, value_totals
from cohortweave.llm.trie import TrieLevel, quantised, restored
from cohortweave.session import drop_path, recorded_paths

ORDER = 3
STRENGTH = 16.0
BUCKET_BYTES = 48 << 20
END = xxhash.xxh3_64_intdigest(b"\n")  # no word holds white space
ANSWERS = 64  # rows handed on at once
PAIR_BITS = 31  # two numbers below this make one of at most 62 bits


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}


def packed(values: np.ndarray) -> bytes:
    """Whole numbers of 0 and more, squeezed in as few bytes each as the largest needs; the first byte tells how many."""
    top = int(values.max(initial=0))
    width = next(k for k in (1, 2, 4, 8) if not top >> (8 * k))
    return bytes([width]) + squeeze_planes(values.astype(f"u{width}"))


def unpacked(data: bytes, wide: bool = True) -> np.ndarray:
    """The numbers of ``packed``, in eight bytes each or as they were stored."""
    values = from_planes(expand(memoryview(data)[1:]), f"u{data[0]}")
    return values.astype(np.int64) if wide or data[0] == 8 else values


def rising(values: np.ndarray) -> bytes:
    """``packed`` differences of values that do not fall."""
    return packed(np.diff(values, prepend=values[:1] * 0))


def in_order(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers of 0 and more, ascending, and where each stood; equal ones in their order."""
    bits = len(values).bit_length()
    if not len(values) or int(values.max()) >> (63 - bits):
        order = np.argsort(values, kind="stable")
        return values[order], order
    both = values.astype(np.int64) << bits  # value and place in one number: no indirect sort
    both |= np.arange(len(values))
    both.sort()
    ascending = both >> bits
    both &= (1 << bits) - 1
    return ascending, both


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct whole numbers of 0 and more, ascending, and the place of each value among them."""
    ascending, order = in_order(values)
    first = starts_of(ascending)
    return ascending[first], _places(first, order)


def _places(first: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The run of each value, for values that stood at ``order`` and runs that begin at ``first``."""
    inverse = np.empty(len(order), np.int32 if len(order) < 1 << 31 else np.int64)
    inverse[order] = np.repeat(np.arange(len(first), dtype=inverse.dtype), np.diff(np.append(first, len(order))))
    return inverse


def starts_of(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def words_of(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words ascending, tokens as places among them with an end after each text, ends of the texts."""
    data, cuts = data.lower(), np.append(0, ends).tolist()
    texts = pa.array([data[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()).cast(pa.string())
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.values
    bounds = lists.offsets.to_numpy().astype(np.int64)
    there = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    bounds = np.append(0, np.cumsum(there))[bounds]
    coded = flat.filter(pa.array(there)).dictionary_encode()
    names = coded.dictionary.cast(pa.large_binary())
    held, cuts = names.buffers()[2], np.frombuffer(names.buffers()[1] or b"", np.int64)[: len(names) + 1].tolist()
    raw = held.to_pybytes() if held else b""
    hashes = np.frombuffer(b"".join([xxhash.xxh3_64_digest(raw[a:b]) for a, b in zip(cuts, cuts[1:])] + [xxhash.xxh3_64_digest(b"\n")]), ">u8").astype(np.uint64)
    values, place = np.unique(hashes, return_inverse=True)
    words = place[:-1][coded.indices.to_numpy()] if len(names) else np.zeros(0, np.int64)
    return values, np.insert(words, bounds[1:], place[-1]), bounds[1:] + np.arange(1, len(bounds))


def commonest_first(totals: np.ndarray) -> np.ndarray:
    """Places by falling totals: tokens numbered so are mostly small and squeeze well."""
    return np.argsort(-totals, kind="stable")


class BlockTokens:
    """Tokens of a block, an end token after each document, as indices into its distinct words."""

    def __init__(self, tokens: np.ndarray, ends: np.ndarray, held: np.ndarray):
        self.tokens, self.ends, self.held = tokens, ends, held
        sizes = np.diff(np.append(0, ends))
        self.train = np.repeat(~held, sizes)
        self.starts = np.zeros(len(tokens), bool)
        self.starts[np.append(0, ends[:-1])[sizes > 0]] = True

    def counts(self, n: int) -> np.ndarray:
        return np.bincount(self.tokens[self.train], minlength=n)


class Shards:
    """Which shard an n-gram goes to, and under which number it knows the context.

    A context is ``shard * width + place``, as the level below numbers its n-grams from 1 on in every shard, and stays in that
    shard under its place. One of more than a share of a shard is split by successor, alike in all blocks, and
    goes under ``width`` + context, which no place reaches.
    """

    def __init__(self, shards: int, width: int, total: int):
        self.shards, self.width, self.total = shards, width, total

    def deal(self, context: np.ndarray, context_count: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        salts = context_count * 4 * self.shards // max(self.total, 1) + 1
        shard = context // self.width
        number = context - shard * self.width
        z = np.flatnonzero(salts > 1)
        salt = mix64(successor[z].astype(np.uint64)) % salts[z].astype(np.uint64)
        shard[z] = mix64(context[z].astype(np.uint64) + mix64(salt)) % np.uint64(self.shards)
        number[z] = self.width + context[z]
        return shard, number


class Grams:
    """Distinct n-grams of a block as context keys and successors, sorted by both."""

    def __init__(self, key: np.ndarray, context_count: np.ndarray, successor: np.ndarray, train: np.ndarray):
        ranked = max(int(key.max(initial=0)), int(successor.max(initial=0))) >> PAIR_BITS
        (keys, key), (successors, successor) = (distinct(x) if ranked else (None, x) for x in (key, successor))
        span = int(successor.max(initial=0)) + 1
        code, order = in_order(key.astype(np.int64) * span + successor)
        first = starts_of(code)
        self.inverse = _places(first, order)
        code = code[first]
        self.key = code // span
        self.successor = code - self.key * span
        if ranked:
            self.key, self.successor = keys[self.key], successors[self.successor]
        self.context_count = context_count[order[first]]
        learned = np.append(0, np.cumsum(train[order], dtype=np.int64))
        self.count = np.diff(learned[np.append(first, len(order))]) if len(order) else np.zeros(0, np.int64)

    def deal(self, keys: np.ndarray, ids: np.ndarray, shards: Shards, known: bool) -> None:
        """The shard of each n-gram, and the order in which they are sent: by shard, number of the context, successor.

        ``keys`` and ``ids``, both ascending, are the contexts and words at the places that ``key`` and ``successor`` hold so far. Unless
        the answers are ``known``, these and the counts become what the shards get.
        """
        successor = ids[self.successor]
        shard, number = shards.deal(keys[self.key], self.context_count, successor)
        order, *_ = bucket_pieces(2 * shard + (number >= shards.width))  # numbers ascend within either kind of context
        rank = np.empty(len(order), self.inverse.dtype)
        rank[order] = np.arange(len(order), dtype=rank.dtype)
        self.inverse, self.shard = rank[self.inverse], shard[order]
        if not known:
            self.key, self.successor, self.context_count, self.count = (x[order] for x in (number, successor, self.context_count, self.count))


GRAM_COLUMNS = ("contexts", "context_counts", "sizes", "successors", "counts")
GRAM_ROWS = "bucket int, block long, " + ", ".join(f"{c} binary" for c in GRAM_COLUMNS)
GRAM_SCHEMA = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), *((c, pa.binary()) for c in GRAM_COLUMNS)])
ANSWER_SCHEMA = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), *((c, pa.binary()) for c in ("codes", "totals", "nodes"))])
CODED = ("tokens", "ends", "ids", "totals")


def _sent(grams: Grams, shard: np.ndarray, block: int) -> Iterator[pa.RecordBatch]:
    """A row for each shard; the n-grams are in the order of their shards."""
    rows, cuts = [], starts_of(shard).tolist()
    for lo, hi in zip(cuts, [*cuts[1:], len(shard)]):
        first = lo + starts_of(grams.key[lo:hi])
        columns = (grams.context_count[first], np.diff(np.append(first, hi)), grams.successor[lo:hi], grams.count[lo:hi])
        content = {"contexts": rising(grams.key[first])} | {c: packed(x) for c, x in zip(GRAM_COLUMNS[1:], columns)}
        rows.append({"bucket": int(shard[lo]), "block": block, **content})
    yield batch_of(rows, GRAM_SCHEMA)


def _received(row: dict) -> tuple[np.ndarray, ...]:
    """Context keys and counts, successors per context, and successors and counts per n-gram, in few bytes each."""
    contexts, *rest = (unpacked(row[c], wide=False) for c in GRAM_COLUMNS)
    return np.cumsum(contexts, dtype=np.int64), *rest


def _level(context: np.ndarray, context_count: np.ndarray, of: np.ndarray, successor: np.ndarray, count: np.ndarray, strength: float) -> tuple[int, bytes]:
    """Number of n-grams with a count, and the trie level of these; ``of`` has the place of each one's context."""
    some = np.flatnonzero(count > 0)
    held = of[some]
    first = starts_of(held)
    codes = quantised(count[some] / (context_count[held] + strength))
    return len(some), TrieLevel.build(context[held[first]], np.diff(np.append(first, len(held))), successor[some], codes).dump() if len(some) else b""


def _trie_and_answers(batches: Iterator[pa.RecordBatch], strength: float, wanted: bool) -> Iterator[pa.RecordBatch]:
    """The trie level of a shard, and answers to the blocks that sent it n-grams."""
    sent = [((row["bucket"], row["block"]), _received(row)) for row in _each(batches)]
    if not sent:
        return
    whose, columns = zip(*sent)
    contexts, context_counts, sizes, successors, counts = zip(*columns)
    lengths = [len(x) for x in counts]
    del sent, columns
    context, by_context = distinct(np.concatenate(contexts))
    context_count = np.empty(len(context), np.int64)
    context_count[by_context] = np.concatenate(context_counts)
    del contexts, context_counts
    word, by_word = distinct(np.concatenate(successors))
    del successors
    code = np.repeat(by_context, np.concatenate(sizes)).astype(np.int64)
    code *= len(word)
    code += by_word
    del sizes, by_context, by_word
    code, inverse = distinct(code)
    count = np.bincount(inverse, np.concatenate(counts), len(code)).astype(np.int64)
    of = code // len(word)
    code -= of * len(word)
    successor = word[code]
    del counts, code

    n, level = _level(context, context_count, of, successor, count, strength)
    yield batch_of([{"bucket": whose[0][0], "block": SUMMARY, "n": n, "codes": level, "totals": None, "nodes": None}], ANSWER_SCHEMA)

    first = starts_of(of)
    found, node = np.zeros(len(of), np.uint16), np.full(len(of), -1)
    if level:
        found, node = TrieLevel.load(level).lookup(context[of[first]], np.diff(np.append(first, len(of))), successor)
    at, answers = 0, []
    for (bucket, block), n in zip(whose, lengths):
        z = inverse[at : at + n]
        at += n
        answers.append({"bucket": bucket, "block": block, "n": n, "codes": squeeze_planes(found[z]), "totals": None, "nodes": None})
        if wanted:
            totals = count[z]
            answers[-1] |= {"totals": packed(totals), "nodes": rising(node[z][totals > 0] + 1)}
        if len(answers) == ANSWERS or at == len(inverse):
            yield batch_of(answers, ANSWER_SCHEMA)
            answers = []


def _joined(rows: DataFrame, parts: DataFrame, name: str, n: int) -> DataFrame:
    """``rows`` with the ``parts`` of their block as ``name``, in ``n`` partitions: that number grows with the data, the session's does not."""
    parts = parts.repartition(n, "block")
    parts = parts if "parts" in parts.columns else per_block(parts)
    return rows.repartition(n, "block").join(parts.withColumnRenamed("parts", name), "block", "left")


def _answers(rows: DataFrame, shards: int, strength: float, label: str, wanted: bool) -> tuple[DataFrame, DataFrame, int]:
    """Trie levels (shard, trie); per block and shard the codes and, if ``wanted``, totals and nodes of its n-grams, in sent order; most n-grams of a trie."""
    build = partial(_trie_and_answers, strength=strength, wanted=wanted)
    answered = stored(by_bucket(rows, shards).mapInArrow(build, "bucket int, block long, n long, codes binary, totals binary, nodes binary"), label)
    tries = answered.filter(f"block = {SUMMARY}")
    most = (tries.agg(F.max("n")).first()[0] or 0) if wanted else 0
    return tries.selectExpr("bucket AS shard", "codes AS trie"), answered.filter(f"block <> {SUMMARY}").drop("n"), most


def _of_parts(grams: Grams, parts: list[dict] | None, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, totals and, as contexts of the next level, nodes of a block's n-grams."""
    parts = sorted(parts or (), key=lambda p: p["bucket"])  # the shards in the order of the n-grams
    codes = np.concatenate([from_planes(expand(p["codes"]), np.uint16) for p in parts] or [np.zeros(0, np.uint16)])
    totals, nodes = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
    if parts and parts[0]["totals"] is not None:
        totals = np.concatenate([unpacked(p["totals"]) for p in parts])
        z = np.flatnonzero(totals > 0)
        nodes[z] = grams.shard[z] * width + np.concatenate([np.cumsum(unpacked(p["nodes"])) for p in parts])
    return codes, totals, nodes


def score(
    docs: DataFrame,
    held_out: Callable[[str | None], bool],
    key: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    strength: float = STRENGTH,
) -> DataFrame:
    """Per row of ``docs``: ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are the words of the whole text, A-Z lower-cased, and one end; a NULL text has the end only. Learns
    from every row whose key, as text, ``held_out`` does not hold back; repeated rows count each time. Scores
    are log10 probabilities; ``base_score`` is that of the add-one word model. Words are told apart by a 64-bit hash. Without
    training rows every word is unknown.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[key].dataType.simpleString()
    is_held = lambda row: np.array([held_out(k) for k in row["keys"]], bool)
    known: list[tuple[int, int, int]] = []  # of each bucket: tokens, distinct words in training, distinct words
    widths: dict[int, int] = {}  # above the places of a level's n-grams in their shards
    buckets = 0

    def tokens_of(data: bytes, ends: np.ndarray) -> dict:
        values, tokens, ends = words_of(data, ends)
        return {"n_bytes": len(data), "hashes": squeeze_planes(np.diff(values, prepend=np.uint64(0))), "tokens": packed(tokens), "ends": rising(ends)}

    def hashed(row: dict) -> tuple[np.ndarray, BlockTokens]:
        values = np.cumsum(from_planes(expand(row["hashes"]), np.uint64))
        return values, BlockTokens(unpacked(row["tokens"]), np.cumsum(unpacked(row["ends"])), is_held(row))

    def counted_words() -> DataFrame:
        """Per block its keys, tokens as places by falling totals, and ids and totals of its words by ascending ids; no hashes any more."""
        nonlocal buckets
        blocks = write_blocks(docs, key, text, "lm-blocks", tokens_of, "n_bytes long, hashes binary, tokens binary, ends binary", texts=False)
        size = blocks.agg(F.sum("n_bytes")).first()[0] or 0
        parts = buckets = buckets_for(spark, 4 * size, BUCKET_BYTES)

        def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _each(batches):
                values, block = hashed(row)
                yield batch_of(list(value_rows(row["block"], values, block.counts(len(values)), parts)), VALUE_SCHEMA)

        content = blocks.drop("n_bytes")
        counted = stored(value_totals(content.mapInArrow(words, VALUE_ROWS), parts, ranked=True), "lm-words")
        summary = counted.filter(f"block = {SUMMARY}").selectExpr("explode(parts.totals) AS t").collect()
        known.extend(tuple(np.frombuffer(r["t"], np.int64).tolist()) for r in summary)
        width = widths[1] = max((x[2] for x in known), default=0) + 1

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _each(batches):
                values, block = hashed(row)
                found = ids_of(values, row["words"], parts)
                ids = found % parts * width + found // parts + 1
                order_ = np.argsort(ids)
                ids, totals = ids[order_], totals_of(values, row["words"], parts)[order_]
                by_total = order_[commonest_first(totals)]
                place = np.empty_like(order_)
                place[by_total] = np.arange(len(order_))
                last = place[np.searchsorted(values, np.uint64(END))]
                columns = (packed(place[block.tokens]), row["ends"], rising(ids), packed(totals))
                yield pa.RecordBatch.from_pydict(
                    {"block": [row["block"]], "keys": pa.array([row["keys"]], pa.list_(pa.string())), "last": pa.array([last], pa.int64())}
                    | {c: pa.array([x], pa.binary()) for c, x in zip(CODED, columns)}
                )

        joined = _joined(content, counted, "words", parts)
        return joined.mapInArrow(coded, "block long, keys array<string>, last long, " + ", ".join(f"{c} binary" for c in CODED))

    with recorded_paths() as spent:
        state = stored_alone(spark, "lm-tokens", counted_words)
    total, distinct_words = sum(x[0] for x in known), sum(x[1] for x in known)

    def replay(row: dict, upto: int, width: dict[int, int]) -> tuple[BlockTokens, np.ndarray, np.ndarray, Grams | None]:
        """Tokens, word totals, log probability by the levels below ``upto``, and the n-grams of level ``upto``."""
        places, ends, ids, totals = (unpacked(row[c]) for c in CODED)
        by_total = commonest_first(totals)
        ids, tokens, last = np.cumsum(ids), by_total[places], by_total[row["last"]]
        block = BlockTokens(tokens, np.cumsum(ends), is_held(row))
        p = ((totals + 1) / (total + distinct_words + 1))[tokens]
        # Before a first token stands the end, and nothing before that.
        before = np.append(last, tokens[:-1])
        before[block.starts] = last
        keys, key_counts, context, own_count = ids, totals, before, totals[tokens]
        grams = None
        for m in range(2, upto + 1):
            context_count = key_counts[context]
            sent = np.flatnonzero((context_count > 0) & (own_count > 0))
            grams = Grams(context[sent], context_count[sent], tokens[sent], block.train[sent])
            known = f"level{m}" in row
            grams.deal(keys, ids, Shards(buckets, width[m - 1], total), known)
            if not known:
                break
            codes, sums, nodes = _of_parts(grams, row[f"level{m}"], width.get(m, 0))
            p = strength * p / (context_count + strength)
            p[sent] += restored(codes)[grams.inverse]
            if m < order:
                own, own_count = np.ones(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
                # The next context is this n-gram, one token earlier; place 0 is that of a first token, place 1 that of n-grams that are not there.
                own[sent], own_count[sent] = grams.inverse + 2, sums[grams.inverse]
                keys, key_counts = np.append([0, 0], nodes), np.append([totals[last], 0], sums)
                context = np.append(0, own[:-1])
                context[block.starts] = 0
        return block, totals, p, grams

    def with_level(m: int, state: DataFrame) -> DataFrame:
        width = dict(widths)

        def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _each(batches):
                grams = replay(row, m, width)[3]
                yield from _sent(grams, grams.shard, row["block"])

        level = f"level{m}"
        _, answers, most = _answers(state.mapInArrow(grams_of, GRAM_ROWS), buckets, strength, f"lm-{level}", m < order)
        widths[m] = most + 1
        return _joined(state, answers, level, buckets)

    for m in range(2, order):
        with recorded_paths() as made:
            state = stored_alone(spark, f"lm-state{m}", partial(with_level, m, state))
        for path in spent:
            drop_path(spark, path)
        spent = made
    if order > 1:
        state = with_level(order, state)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            block, totals, p, _ = replay(row, order, widths)
            seen = totals[block.tokens]
            base = np.log10((totals + 1) / (total + distinct_words + 1))[block.tokens]
            at = np.append(0, block.ends[:-1])
            n = len(block.ends)
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array(row["keys"], pa.string()),
                    "held_out": block.held,
                    "n_tokens": np.diff(np.append(0, block.ends)),
                    "n_known": np.add.reduceat((seen > 0).astype(np.int64), at) if n else [],
                    "train_tokens": np.full(n, total, np.int64),
                    "base_score": np.add.reduceat(base, at) if n else [],
                    "score": np.add.reduceat(np.log10(p), at) if n else [],
                }
            )

    fields = "key string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    rows = state.mapInArrow(scores, fields)
    return rows.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
