"""Similarity join of documents on word shingles with adaptive multi-match prefixes.

Sets that overlap in ``need`` elements share at least ``k`` elements of their prefixes, when a prefix holds the
``size - need + k`` rarest elements. Each document picks ``k`` by the candidates its prefix would
raise (a sum of frequencies, over ``k``), so documents of frequent shingles take longer prefixes and
demand more shared elements before a pair is verified.

Only classes of links are wanted, so pairs inside a class are not all formed: first each document
meets one leader per prefix element, then only documents of different classes meet. These carry a parity
sketch: bits that differ between two sketches are at most the elements in which the sets differ, so the join
itself leaves out pairs that differ in too many of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.blocks import (
    ROW_BITS,
    bounded_batches,
    buckets_for,
    by_bucket,
    expand,
    mix64,
    pack,
    squeeze,
    stored,
    write_blocks,
)
from cohortweave.llm.exchange import VALUE_ROWS, VALUE_SCHEMA, batch_of, joined_classes, totals_of, value_rows, value_totals

WORDS = 5
SHARE = 75  # percent of the union that two linked sets have in common
MATCHES = (1, 2, 3, 4)
LEADERS = 3
FIRST_PART = 10  # the first filter demands a tenth of a set's elements
SKETCH = 8  # 64-bit words of a parity sketch; its row size is fixed, longer sets only weaken the bound
LONG_SKETCH = 32  # words of a second sketch, which only sets of LONG elements and more carry: the first one is full with these
LONG = 640
SKETCH_ROWS = 1024  # sets whose sketches are made at once
EARLIER = 32  # leading tokens of a document that its rows carry, so that a pair is not met again at each shared token
PAIRS_PER_SALT = 500
BUCKET_BYTES = 64 << 20


def needed(n: np.ndarray, share: int) -> np.ndarray:
    """Least overlap of a set of size ``n`` with any set it links to."""
    return -(-n * share // 100)


def shingle_sets(data: bytes, ends: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a block; no word: no shingle."""
    docs, at = [], 0
    low = data.lower()
    for end in ends.tolist():
        docs.append(low[at:end])
        at = end
    lists = pc.ascii_split_whitespace(pa.array(docs, pa.binary()).cast(pa.string()))
    flat = lists.values
    bounds = lists.offsets.to_numpy().astype(np.int64)
    there = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    bounds = np.append(0, np.cumsum(there))[bounds]
    coded = flat.filter(pa.array(there)).dictionary_encode()
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))[coded.indices.to_numpy()] if names else np.zeros(0, np.uint64)
    grams = _rolled(hashes, words)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            out.append(_rolled(hashes[a:b], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    n = max(len(hashes) - size + 1, 0)
    out = np.full(n, size, np.uint64)
    for k in range(size if n else 0):
        out = mix64(out + hashes[k : k + n] * np.uint64(0x9E3779B97F4A7C15))
    return out


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}


def _set_rows(docs: DataFrame, key: str, text: str, words: int) -> tuple[DataFrame, DataFrame]:
    """Stored blocks, and one row per document: ``rid``, ``key`` as text, set size ``n``, set digest ``sig``."""

    def digests(data: bytes, ends: np.ndarray) -> dict:
        sets = shingle_sets(data, ends, words)
        return {"sizes": pack(np.array([len(s) for s in sets], np.int64)), "sigs": b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets)}

    blocks = write_blocks(docs, key, text, "near-blocks", digests, "sizes binary, sigs binary")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            n = len(row["keys"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(n) + (row["block"] << ROW_BITS), pa.int64()),
                    pa.array(row["keys"], pa.string()),
                    pa.array(np.frombuffer(row["sizes"], np.int64)),
                    pa.array([row["sigs"][16 * i : 16 * i + 16] for i in range(n)], pa.binary()),
                ],
                names=["rid", "key", "n", "sig"],
            )

    rows = blocks.select("block", "keys", "sizes", "sigs").mapInArrow(unpack, "rid long, key string, n long, sig binary")
    return blocks, rows


def _first_prefix(s: np.ndarray, share: int) -> tuple[np.ndarray, int]:
    """Prefix in the order of hashes, and how many of its elements a linked set has in its own prefix."""
    need = int(needed(len(s), share))
    k = min(need, len(s) // FIRST_PART + 1)
    return s[: len(s) - need + k], k


def _first_values(row: dict, words: int, share: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Sets of a block, and the distinct elements of their first prefixes with counts; equal sets count once."""
    sets = shingle_sets(expand(row["data"]), np.frombuffer(row["ends"], np.int64), words)
    seen: set[bytes] = set()
    heads = [np.zeros(0, np.uint64)]
    for i, s in enumerate(sets):
        sig = row["sigs"][16 * i : 16 * i + 16]
        if len(s) and sig not in seen:
            seen.add(sig)
            heads.append(_first_prefix(s, share)[0])
    return sets, *np.unique(np.concatenate(heads), return_counts=True)


def _surviving_texts(blocks: DataFrame, firsts: DataFrame, words: int, share: int, buckets: int) -> DataFrame:
    """Texts of documents that may link, one row per block; of equal sets only the first document's.

    Any fixed order gives valid prefixes. In the order of hashes, which needs no counts, a third of all elements
    tells which documents can link at all.
    """

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            _, found, counts = _first_values(row, words, share)
            if len(found):
                yield batch_of(list(value_rows(row["block"], found, counts, buckets)), VALUE_SCHEMA)

    content = blocks.select("block", "ends", "data", "sigs")
    totals = stored(value_totals(content.mapInArrow(values, VALUE_ROWS), buckets), "near-first-totals")
    chosen = firsts.selectExpr(f"shiftright(rid, {ROW_BITS}) AS block", f"cast(rid & {(1 << ROW_BITS) - 1} AS int) AS i").groupBy("block").agg(F.collect_list("i").alias("chosen"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            sets, found, _ = _first_values(row, words, share)
            shared = found[totals_of(found, row["parts"], buckets) >= 2]
            data, ends = expand(row["data"]), np.append(0, np.frombuffer(row["ends"], np.int64))
            kept = []
            for i in sorted(row["chosen"]):
                head, k = _first_prefix(sets[i], share)
                if len(shared) and (shared[np.minimum(np.searchsorted(shared, head), len(shared) - 1)] == head).sum() >= k:
                    kept.append(i)
            if kept:
                texts = [data[ends[i] : ends[i + 1]] for i in kept]
                yield batch_of(
                    [
                        {
                            "block": row["block"],
                            "rids": pack(np.array(kept, np.int64) + (row["block"] << ROW_BITS)),
                            "ends": pack(np.cumsum([len(t) for t in texts])),
                            "data": squeeze(b"".join(texts)),
                        }
                    ]
                )

    joined = content.join(totals, "block").join(chosen, "block")
    return stored(joined.mapInArrow(keep, "block long, rids binary, ends binary, data binary"), "near-texts")


def _sets_of(row: dict, words: int) -> tuple[list[int], list[np.ndarray]]:
    return np.frombuffer(row["rids"], np.int64).tolist(), shingle_sets(expand(row["data"]), np.frombuffer(row["ends"], np.int64), words)


def parity_sketches(sets: list[np.ndarray], size: int = SKETCH) -> np.ndarray:
    """Per set ``size`` signed words; bit ``b`` is the parity of the number of elements that fall on ``b``."""
    bits = 64 * size
    out = np.zeros((len(sets), size), np.int64)
    for a in range(0, len(sets), SKETCH_ROWS):
        part = sets[a : a + SKETCH_ROWS]
        owner = np.repeat(np.arange(len(part)), [len(s) for s in part])
        at = (np.concatenate(part) >> np.uint64(17)) % np.uint64(bits)
        odd = (np.bincount(owner * bits + at.astype(np.int64), minlength=len(part) * bits) & 1).astype(np.uint8)
        out[a : a + len(part)] = np.packbits(odd, bitorder="little").view(np.int64).reshape(len(part), size)
    return out


def _close(share: int) -> str:
    """SQL of what linked sets ``a`` and ``b`` fulfil: their sketches differ in no more bits than the sets may in elements."""
    apart = " + ".join(f"bit_count(s{i}_a ^ s{i}_b)" for i in range(SKETCH))
    far = "aggregate(zip_with(more_a, more_b, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"
    short = f"{100 + share} * ({apart}) <= {100 - share} * (n_a + n_b)"
    return f"{short} AND (more_a IS NULL OR more_b IS NULL OR {100 + share} * {far} <= {100 - share} * (n_a + n_b))"


def _prefix_rows(texts: DataFrame, words: int, share: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Rows (token, rid, n, k) of the adaptive prefixes, rarest elements first, and (rid, s0, s1, ..., more) with the sketches.

    Elements of one set only are not sent, but hold their place in the prefix.
    """
    words_of_sketch = [f"s{i}" for i in range(SKETCH)]
    names = ["token", "rid", "n", "k", *words_of_sketch, "more"]
    more = pa.list_(pa.int64())
    fields = pa.schema([("token", pa.int64()), ("rid", pa.int64()), ("n", pa.int32()), ("k", pa.int32()), *((c, pa.int64()) for c in words_of_sketch), ("more", more)])

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            found, counts = np.unique(np.concatenate(_sets_of(row, words)[1]), return_counts=True)
            yield batch_of(list(value_rows(row["block"], found, counts, buckets)), VALUE_SCHEMA)

    totals = value_totals(texts.mapInArrow(values, VALUE_ROWS), buckets)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            rids, sets = _sets_of(row, words)
            tokens, inverse = np.unique(np.concatenate(sets), return_inverse=True)
            often = totals_of(tokens, row["parts"], buckets)[inverse]
            start, out = 0, []
            for rid, s in zip(rids, sets):
                n = len(s)
                f = often[start : start + n]
                start += n
                order = np.lexsort((s, f))
                s, f = s[order], f[order]
                need = int(needed(n, share))
                cost = np.append(0, np.cumsum(f - 1))
                # Candidates are at most the sum of partners over k; each costs about its set to verify.
                k = min((m for m in MATCHES if m <= need), key=lambda m: cost[min(n, n - need + m)] * (1 + n / 16 / m))
                end = min(n, n - need + k)
                pos = np.flatnonzero(f[:end] > 1)
                if len(pos):
                    out.append((s[pos], np.full(len(pos), rid), np.full(len(pos), n), np.full(len(pos), k)))
            if out:
                t, r, n, k = (np.concatenate(x) for x in zip(*out))
                for a in range(0, len(t), 65536):
                    z = slice(a, a + 65536)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(t[z].view(np.int64)), pa.array(r[z], pa.int64()), pa.array(n[z], pa.int32()), pa.array(k[z], pa.int32())]
                        + [pa.nulls(len(t[z]), pa.int64())] * SKETCH
                        + [pa.nulls(len(t[z]), more)],
                        names=names,
                    )
                # Then one row without a token per set that has a prefix.
                with_prefix = set(r.tolist())
                own = [(rid, s) for rid, s in zip(rids, sets) if rid in with_prefix]
                sketches = parity_sketches([s for _, s in own])
                long = [i for i, (_, s) in enumerate(own) if len(s) >= LONG]
                longer = dict(zip(long, parity_sketches([own[i][1] for i in long], LONG_SKETCH).tolist()))
                yield pa.RecordBatch.from_pydict(
                    {"token": [None] * len(own), "rid": [rid for rid, _ in own], "n": [None] * len(own), "k": [None] * len(own)}
                    | {c: sketches[:, i] for i, c in enumerate(words_of_sketch)}
                    | {"more": [longer.get(i) for i in range(len(own))]},
                    fields,
                )

    joined = texts.join(totals, "block")
    both = stored(joined.mapInArrow(prefixes, "token long, rid long, n int, k int, " + ", ".join(f"{c} long" for c in words_of_sketch) + ", more array<long>"), "near-prefixes")
    return both.filter("token IS NOT NULL").select("token", "rid", "n", "k"), both.filter("token IS NULL").select("rid", *words_of_sketch, "more")


def _groups(prefixes: DataFrame) -> DataFrame:
    """Rows (token, rid, n, k, w) with one ``token`` for all ``w`` elements that lie in the same prefixes.

    A passage gives many elements, all shared by the same documents; they meet once instead of once each. The
    new token is a hash of the set of documents; sets that collide would only raise more candidates.
    """
    same = prefixes.groupBy("token").agg(F.expr("xxhash64(bit_xor(xxhash64(rid)), count(*)) AS _set"), F.count("*").alias("_c")).filter("_c > 1")
    rows = prefixes.join(same, "token").groupBy(F.col("_set").alias("token"), "rid", "n", "k").agg(F.count("*").alias("w"))
    return stored(rows, "near-groups")


def _candidates(pairs: DataFrame, share: int) -> DataFrame:
    """Pairs (a, b, m) whose ``m`` shared prefix elements are as many as the shorter of both prefixes demands.

    ``pairs`` has a row per shared token: a, b, n and k of both sides, and w.
    """
    return (
        pairs.filter(f"100 * least(n_a, n_b) >= {share} * greatest(n_a, n_b)")
        .groupBy("a", "b")
        .agg(F.sum("w").alias("m"), F.expr("any_value(least(k_a, k_b)) AS _k"))
        .filter("m >= _k")
        .select("a", "b", "m")
    )


def _verified(pairs: DataFrame, texts: DataFrame, words: int, share: int, buckets: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets overlap enough.

    Sets meet in the bucket of ``b``: that of ``b`` comes once, that of each ``a`` once per pair. The pairs of a
    ``b`` are spread by salts, one per ``PAIRS_PER_SALT`` pairs, so a leader of many pairs fills no single task.
    """
    pairs = stored(pairs.select("a", "b"), "near-pairs")
    salts = pairs.groupBy("b").agg(F.expr(f"count(*) div {PAIRS_PER_SALT} + 1").alias("salts"))
    pairs = stored(
        pairs.join(salts, "b").selectExpr("a", "b", f"cast(pmod(xxhash64(b, pmod(xxhash64(a), salts)), {buckets}) AS int) AS bucket"), "near-pairs"
    )
    sends = pairs.selectExpr("a AS rid", "bucket", "b AS other").unionAll(
        pairs.selectExpr("b AS rid", "bucket", "-1L AS other").distinct()
    )
    wanted = sends.selectExpr(f"shiftright(rid, {ROW_BITS}) AS block", "rid", "bucket", "other").groupBy("block").agg(F.collect_list(F.struct("rid", "bucket", "other")).alias("sends"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            rids, sets = _sets_of(row, words)
            of = dict(zip(rids, sets))
            listed = sorted(row["sends"], key=lambda x: (x["rid"], x["bucket"], x["other"]))
            for c in range(0, len(listed), 512):
                part = listed[c : c + 512]
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([x["bucket"] for x in part], pa.int32()),
                        "rid": [x["rid"] for x in part],
                        "other": [x["other"] for x in part],
                        "s": [pack(of[x["rid"]]) for x in part],
                    }
                )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaders: dict[int, np.ndarray] = {}
        for batch in batches:  # rows without a partner come first
            for rid, other, s in zip(*(batch.column(c).to_pylist() for c in ("rid", "other", "s"))):
                own = np.frombuffer(s, np.uint64)
                if other < 0:
                    leaders[rid] = own
                    continue
                with_it = leaders[other]
                at = np.minimum(np.searchsorted(with_it, own), len(with_it) - 1)
                both = int((with_it[at] == own).sum())
                if 100 * both >= share * (len(own) + len(with_it) - both):
                    yield pa.RecordBatch.from_pydict({"a": [rid], "b": [other]})

    sent = texts.join(wanted, "block").select("rids", "ends", "data", "sends").mapInArrow(send, "bucket int, rid long, other long, s binary")
    dealt = by_bucket(sent, buckets).sortWithinPartitions("other")
    return stored(dealt.mapInArrow(verify, "a long, b long"), "near-links")


def link_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, share: int = SHARE
) -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_shingles`` and ``component_id``, the least key reachable by links.

    A set holds the distinct runs of ``words`` words (A-Z lower-cased), or the whole text of fewer words as one. Two
    rows link when ``100 * overlap >= share * union``; equal sets always link. NULL, empty and blank
    texts have no shingle and link with nothing. Repeated rows link like any others. A NULL key
    stays NULL and is never a class id unless it is alone.
    """
    return classes_and_links(docs, key, text, words, share)[0]


def classes_and_links(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, share: int = SHARE
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``link_classes``, and the verified links between different texts that join them.

    A link (``rep_a``, ``rep_b``, ``a``, ``b``) names the first row of both texts by number and by key, each pair once. The links
    span every class; further pairs inside a class that would link are not all verified, so they give no counts.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[key].dataType.simpleString()
    blocks, rows = _set_rows(docs, key, text, words)
    rows = stored(rows.selectExpr("rid", f"cast(key AS {kind}) AS key", "n", "sig"), "near-rows")
    total = rows.agg(F.sum("n")).first()[0] or 0
    buckets = buckets_for(spark, 2 * total, BUCKET_BYTES)
    reps = rows.filter("n > 0").groupBy("sig").agg(F.min("rid").alias("rep"), F.min("key").alias("low"))
    reps = stored(reps, "near-firsts")
    texts = _surviving_texts(blocks, reps.selectExpr("rep AS rid"), words, share, buckets)
    prefixes, sketches = _prefix_rows(texts, words, share, buckets)
    prefixes = _groups(prefixes)
    links = classes = None
    for turn in range(LEADERS):
        left = prefixes.withColumn("class", F.col("rid")) if classes is None else _split_tokens(prefixes, classes)
        leader = left.groupBy("token").agg(F.expr(f"min_by(struct(rid, n, k, class), xxhash64(rid, {turn}))").alias("l"))
        met = left.join(leader, "token").filter("class <> l.class")
        pairs = met.selectExpr("rid AS a", "l.rid AS b", "n AS n_a", "l.n AS n_b", "k AS k_a", "l.k AS k_b", "w")
        # Of its leaders a document tries the one it shares most with; the others are left to the last step.
        best = _candidates(pairs, share).groupBy("a").agg(F.expr("max_by(b, struct(m, b))").alias("b"))
        found = _verified(best, texts, words, share, buckets)
        links = found if links is None else links.unionAll(found)
        classes = joined_classes(classes, found)
    left = _with_earlier(stored(_split_tokens(prefixes, classes), "near-open"), sketches)
    sides = ("rid", "n", "k", "class", "earlier", *(c for c in sketches.columns if c != "rid"))
    a, b = (left.select("token", *[F.col(c).alias(f"{c}_{s}") for c in sides], *(["w"] if s == "a" else [])) for s in "ab")
    needed_yet = "size(array_intersect(earlier_a, earlier_b)) * w < least(k_a, k_b)"
    crossing = a.join(b, "token").filter(f"class_a < class_b AND {_close(share)} AND {needed_yet}").selectExpr("rid_a AS a", "rid_b AS b", "n_a", "n_b", "k_a", "k_b", "w")
    found = _verified(_candidates(crossing, share), texts, words, share, buckets)
    links = links.unionAll(found)
    classes = joined_classes(classes, found)
    # Classes of first documents, then the least key of each class, then every document.
    rooted = reps.join(classes, F.expr("rep = node"), "left").selectExpr("sig", "low", "coalesce(root, rep) AS root")
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stored(rooted.join(least, "root").select("sig", "component_id"), "near-named")
    members = rows.join(named, "sig", "left").selectExpr(f"key AS `{key}`", "n AS n_shingles", "coalesce(component_id, key) AS component_id")
    pairs = links.selectExpr("least(a, b) AS rep_a", "greatest(a, b) AS rep_b").distinct()
    a, b = (rows.selectExpr(f"rid AS rep_{s}", f"key AS {s}") for s in "ab")
    return members, pairs.join(a, "rep_a").join(b, "rep_b").select("rep_a", "rep_b", "a", "b")


def _with_earlier(rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """Add each document's sketch, and ``earlier``: those of its ``EARLIER`` leading tokens that come before the row's own.

    Tokens are ordered by falling ``w``, which all documents of a token share. Earlier tokens that two documents share weigh at
    least ``w`` each; once they weigh what the pair demands, later tokens need not join it. The shared tokens that are still
    joined weigh enough whenever all of them do.
    """
    order = "struct(-w AS w, token AS token)"
    leading = rows.groupBy("rid").agg(F.expr(f"slice(array_sort(collect_list({order})), 1, {EARLIER}) AS _leading"))
    known = leading.join(sketches, "rid")
    earlier = f"transform(filter(_leading, x -> x < {order}), x -> x.token) AS earlier"
    return stored(rows.join(known, "rid").selectExpr(*rows.columns, *[c for c in sketches.columns if c != "rid"], earlier), "near-open")


def _split_tokens(prefixes: DataFrame, classes: DataFrame) -> DataFrame:
    """Prefix rows with their ``class``, of elements whose documents lie in several classes."""
    known = prefixes.join(classes.withColumnRenamed("node", "rid"), "rid", "left").selectExpr(*prefixes.columns, "coalesce(root, rid) AS class")
    split = known.groupBy("token").agg(F.min("class").alias("_lo"), F.max("class").alias("_hi")).filter("_lo < _hi").select("token")
    return known.join(split, "token", "left_semi")
