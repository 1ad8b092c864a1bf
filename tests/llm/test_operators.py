"""Corpus operators against brute force on small tables with nulls, ties, repeated rows and odd texts."""

import collections
import hashlib
import math
import os
import random
import re
import time
import zlib

import numpy as np
import pytest

from cohortweave.llm import blocks, bpe, chat, compress, contamination, exchange, html_text, lm, near, queries, rules, suffix, trie, wavelet
from cohortweave.llm.merge_automaton import MergeAutomaton, WordCoder

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(f"[^{SPACE}]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def corpus():
    """(doc_id, text): prose, exact and near copies, a shared passage, and every odd case."""
    rnd = random.Random(5)
    words = [a + b for a in "ka lo mi né ruß tho".split() for b in "n r st lé".split()]

    def prose(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    passage = prose(60)
    texts = [prose(rnd.randint(1, 120)) for _ in range(40)]
    texts += [texts[3], texts[3], f"{prose(30)} {passage} {prose(20)}", f"{passage} {prose(45)}"]
    long = prose(3000)
    near_copy = long.split(" ")
    near_copy[1500] = "changed"
    texts += [long, " ".join(near_copy), "", " \n\t ", None, "x", "Ab aB ab", "a" * 900, "&&& ||| " * 40]
    texts += ["\x00 odd́ <|endoftext|> don't ﬁ İ 日本🙂", "ab\n" * 50]
    rows = list(enumerate(texts))
    return rows + [rows[0], rows[0], (None, "no id " * 20)]


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(ROWS, "doc_id long, text string")
    return plain.selectExpr("*", "'a' AS key", "'b' AS row", "3 AS n", "4 AS block", "'d' AS _key", "0 AS ends", "'s' AS sig", "'w' AS words").repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- BPE and token files


def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_bpe_as_the_library(docs, none):
    found = rows_of(bpe.encode_decode(docs).select("doc_id", "n_tokens", "ids", "decoded"))
    tool = library()
    expected = []
    for key, text in ROWS:
        ids = tool.encode(text or "", add_special_tokens=False).ids
        expected.append((key, len(ids), bytearray(np.array(ids, "<u4").tobytes()), tool.decode(ids, skip_special_tokens=False)))
    assert found == sorted(expected, key=repr)
    assert bpe.encode_decode(none).count() == 0


def test_automaton_is_the_merge_order():
    """All strings over two letters: the one accepted path is what merging by rank gives."""
    merges = [("a", "b"), ("a", "a"), ("ab", "a"), ("aa", "ab"), ("b", "b"), ("aba", "aba")]
    names = ["a", "b", *[u + v for u, v in merges]]
    auto = MergeAutomaton(names, merges)
    ids = {n: i for i, n in enumerate(names)}

    def merged(word):
        parts = list(word)
        for u, v in merges:
            i = 0
            while i < len(parts) - 1:
                if (parts[i], parts[i + 1]) == (u, v):
                    parts[i : i + 2] = [u + v]
                i += 1
        return parts

    def paths(word, state=-1):
        if not word:
            yield []
        for name in names:
            if word.startswith(name) and auto.arc(state, ids[name]):
                for rest in paths(word[len(name) :], ids[name]):
                    yield [name, *rest]

    for n in range(1, 9):
        for bits in range(2**n):
            word = "".join("ab"[bits >> i & 1] for i in range(n))
            assert list(paths(word)) == [merged(word)], word


def test_coder_on_random_strings():
    coder, tool = WordCoder(bpe.tokenizer_text()), library()
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abehorst'AÉé1２ßﬁ́\x85日🙂|<>.") for _ in range(rnd.randint(1, 14))) for _ in range(3000)]
    words += ["aaaa" * 40, "<|endoftext|>x<|startoftext|>'s", "!" * 99]
    assert [coder.encode_chunk(w) for w in words] == [x.ids for x in tool.encode_batch(words, add_special_tokens=False)]


def test_token_files(docs, none, monkeypatch):
    monkeypatch.setattr(wavelet, "SHARD_TEXT_BYTES", 3000)
    found = sorted(((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, bytes(r.ids)) for r in wavelet.round_trip(docs).collect()))
    tool, at, expected = library(), 0, []
    ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    for key, text in ordered:
        ids = tool.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((key is not None, key or 0, at, len(ids), np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert found == sorted(expected)
    assert wavelet.round_trip(none).count() == 0


@pytest.mark.parametrize("n", [0, 1, 511, 5000])
def test_wavelet_matrix(n):
    values = np.random.default_rng(n).integers(0, 70, n).astype(np.uint16)
    matrix, ends = wavelet.WaveletMatrix.load(wavelet.WaveletMatrix.build(values).dump(np.array([n])))
    assert (matrix.values() == values).all() and ends.tolist() == [n]
    if n:
        assert (matrix.access(np.arange(n)) == values).all()
        places = np.flatnonzero(values == values[-1])
        assert matrix.count(int(values[-1])) == len(places)
        assert matrix.count(int(values[-1]), 100, n) == (places >= 100).sum()
        assert [matrix.select(int(values[-1]), k) for k in range(len(places))] == places.tolist()
    assert matrix.select(9999, 0) == -1 and matrix.count(9999) == 0


# --- Suffix dedup


def removed(rows, length):
    starts = collections.Counter(t[i : i + length] for _, t in rows for i in range(len(t) - length + 1))
    for key, text in rows:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if starts[text[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        yield key, len(text), spans, bytes(x for x, g in zip(text, gone) if not g)


@pytest.mark.parametrize("length, gram, frequent", [(200, 64, 8), (200, 64, 0.01), (37, 13, 8), (40, 11, 0.01)])
def test_suffix_runs_by_brute_force(docs, length, gram, frequent, monkeypatch):
    monkeypatch.setattr(suffix, "FREQUENT_PER_BLOCK", frequent)
    monkeypatch.setattr(suffix, "SLICE_BYTES", 4000)
    found = suffix.remove_repeats(docs, length=length, gram=gram).collect()
    got = sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in found), key=repr)
    assert got == sorted(removed([(k, (t or "").encode()) for k, t in ROWS], length), key=repr)


def test_suffix_empty(none, spark):
    assert suffix.remove_repeats(none).count() == 0
    one = spark.createDataFrame([(1, None), (2, "short")], "doc_id long, text string")
    assert [bytes(r.kept) for r in suffix.remove_repeats(one).orderBy("doc_id").collect()] == [b"", b"short"]


def test_loser_tree_merges_and_shares_prefixes():
    rnd = random.Random(3)
    for _ in range(30):
        lists = [sorted({bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(0, 12))}) for _ in range(rnd.randint(1, 6))]
        runs = []
        for items in lists:
            data = b"".join(items)
            pos = np.cumsum([0, *map(len, items)])[:-1]
            low = np.array([9 - len(x) for x in items], np.int64)
            runs.append(suffix.Run(0, suffix.Run.encode(data, pos, low, np.zeros(len(items), np.int64), 9)))
        seen, out = [0] * len(runs), []
        for run, shared in suffix.merged(runs):
            item = lists[run][seen[run]]
            seen[run] += 1
            if out:
                assert shared == suffix.shared_prefix(out[-1], item, 0)
            out.append(item)
        assert out == sorted(x for items in lists for x in items)


# --- Near duplicates


def classes(rows, words=5, share=75):
    sets = []
    for _, text in rows:
        w = WORD.findall(lower(text))
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= share * (len(a) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        r = find(i)
        keys = [k for k in (least.get(r), key) if k is not None]
        least[r] = min(keys) if keys else None
    return sorted(((key, len(sets[i]), least[find(i)]) for i, (key, _) in enumerate(rows)), key=repr)


def test_near_duplicates_by_brute_force(docs, none):
    assert rows_of(near.link_classes(docs)) == classes(ROWS)
    assert near.link_classes(none).count() == 0


def test_near_duplicate_chains(spark):
    """Chains of edits, boilerplate shared by unlike texts, and thresholds met exactly."""
    rnd = random.Random(9)
    line = " ".join(f"w{i}" for i in range(30))
    rows = []
    for g in range(6):
        words = [f"g{g}x{i}" for i in range(120)]
        for step in range(8):
            words = list(words)
            for _ in range(2):
                words[rnd.randrange(len(words))] = f"e{g}y{step}z{rnd.randrange(1000)}"
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + i, f"{line} {' '.join(f'o{i}p{j}' for j in range(rnd.randint(5, 40)))}") for i in range(20)]
    got = rows_of(near.link_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    assert got == classes(rows)
    got = rows_of(near.link_classes(spark.createDataFrame(rows, "doc_id long, text string"), words=2, share=40))
    assert got == classes(rows, 2, 40)


def test_near_duplicate_links(spark):
    """Each link is a pair above the threshold, given once, and the links alone give the classes of different texts."""
    rows = []
    for g in range(4):
        words = [f"g{g}x{i}" for i in range(80)]
        for step in range(6):
            words[13 * step] = f"e{g}y{step}"
            rows.append((len(rows), " ".join(words)))
    table = spark.createDataFrame([*rows, (99, rows[0][1]), (100, "alone")], "doc_id long, text string").repartition(3)
    members, links = near.classes_and_links(table)
    pairs = [tuple(sorted((r.a, r.b))) for r in links.collect()]
    sets = {k: {tuple(t.split()[i : i + 5]) for i in range(76)} for k, t in [*rows, (99, rows[0][1])]}
    assert len(pairs) == len(set(pairs))
    assert all(100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) for a, b in pairs)
    of = {k: c for k, _, c in rows_of(members)}
    root = {k: k for k in of}
    for _ in pairs:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    named = {of[k]: {root[j] for j in of if of[j] == of[k] and j not in (0, 99)} for k in range(1, 24)}
    assert all(len(x) == 1 for x in named.values()) and len(named) == 4 and of[99] == of[0] == of[1]


# --- Decontamination


def hits(rows, items, size=10):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))

    windows = []
    for key, text in items:
        w = words(text)
        n = min(size, len(w))
        windows += [(key, w[i : i + n]) for i in range(len(w) - n + 1) if n]
    for key, text in rows:
        w, hit, found = words(text), set(), set()
        for item, x in windows:
            for i in range(len(w) - len(x) + 1):
                if w[i : i + len(x)] == x:
                    hit.update(range(i, i + len(x)))
                    found.add(str(item))
        yield key, len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block", [200_000, 7])
def test_contamination_by_brute_force(docs, spark, block, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_WINDOWS", block)
    text = dict(ROWS[:60])
    items = [(1, text[42][:150]), (2, " ".join(text[5].split()[:4])), (3, None), (4, ""), (5, "never seen words at all in any of these texts here"), (6, "X"), (6, "X"), (7, text[44][400:700].upper()), (7, "ab, ab; AB")]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS words", "2 AS n", "3 AS item")
    expected = sorted(hits(ROWS, items), key=repr)
    assert rows_of(contamination.decontaminate(docs, bench)) == expected
    assert any(r[2] for r in expected)


def test_contamination_empty(docs, none, spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert contamination.decontaminate(docs, bench).filter("n_hit > 0").count() == 0
    assert contamination.decontaminate(none, bench).count() == 0


# --- Rules


def test_text_counts_by_brute_force(docs):
    got = rows_of(rules.text_counts(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    expected = []
    for key, text in ROWS:
        w = WORD.findall(text or "")
        seen = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        inside = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        expected.append((key, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)))
    assert got == sorted(expected, key=repr)


def test_decision_list_learns_a_threshold(spark):
    rnd = random.Random(4)
    texts = [" ".join(f"w{rnd.randrange(5000)}" for _ in range(60)) + (" &&&&&&&&&&&&" * 5 if i % 4 == 0 else "") for i in range(400)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(300)] + [(None, 0), (3, None), (5, 7)], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in rules.judge(table, labels).collect()}
    assert sum(kept[i] == (i % 4 != 0) for i in range(400)) >= 396
    assert all(kept[i] for i in range(400) if i % 4)


def test_rules_without_labels(docs, none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = rules.judge(docs, labels)
    assert got.filter("rule IS NOT NULL").count() == 0 and got.count() == len(ROWS)
    assert got.filter("kept <> (NOT base_failed)").count() == 0
    assert rules.judge(none, labels).count() == 0


# --- Classifier


def test_classifier_held_out(spark):
    rnd = random.Random(8)
    good = [f"{a}{b}" for a in "kal mor ten sil".split() for b in "a en or is".split()]
    texts = [" ".join(rnd.choice(good) if i % 2 else rnd.choice(good).upper() + "!!" for _ in range(80)) for i in range(600)]
    table = spark.createDataFrame([*enumerate(texts), (1000, None), (1001, ""), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)] + [(None, 1), (7, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in compress.classify(table, labels, learn="doc_id % 3 <> 1").collect()}
    assert len(got) == 603 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [i for i in range(600) if i % 3 == 1]
    assert sum(got[i].predicted == i % 2 for i in held) >= 0.97 * len(held)


@pytest.mark.parametrize("marks, score", [([], 0.5), ([(1, 1)], 1.0), ([(1, 0)], 0.0)])
def test_classifier_without_both_labels(docs, none, spark, marks, score):
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    assert {r.score for r in compress.classify(docs, labels).collect()} == {score}
    assert compress.classify(none, labels).count() == 0


# --- Language model


def word_model(rows, held, order, strength):
    texts = [(key, WORD.findall(lower(text)) + ["\n"]) for key, text in rows]
    grams = [collections.Counter() for _ in range(order + 1)]
    padded = [(key, w, [("",) * (order - 2) + ("\n",), w][0:1] and (("",) * (order - 2) + ("\n",) + tuple(w))) for key, w in texts]
    for key, w, p in padded:
        if not held(key):
            grams[1].update((x,) for x in w)
            for m in range(2, order + 1):
                grams[m].update(p[i + order - m : i + order] for i in range(len(w)))
    total, distinct = sum(grams[1].values()), len(grams[1])

    def chance(gram):
        if len(gram) == 1:
            return (grams[1][gram] + 1) / (total + distinct + 1)
        context = gram[:-1]
        seen = grams[len(context)][context] if context[0] != "" else grams[1][("\n",)]
        return (grams[len(gram)][gram] + strength * chance(gram[1:])) / (seen + strength)

    for key, w, p in padded:
        base = sum(math.log10(chance((x,))) for x in w)
        yield key, len(w), sum(grams[1][(x,)] > 0 for x in w), total, base, sum(math.log10(chance(p[i : i + order])) for i in range(len(w)))


@pytest.mark.parametrize("order", [2, 3])
def test_language_model_by_brute_force(docs, order):
    held = lambda key: key is not None and zlib.crc32(str(key).encode()) % 7 == 2
    got = sorted((tuple(r) for r in lm.score(docs, held, order=order, strength=4.0).select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=lambda r: repr(r[:3]))
    expected = sorted(word_model(ROWS, held, order, 4.0), key=lambda r: repr(r[:3]))
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    for kind, slack in ((4, 1e-9), (5, 0.004)):
        a, b = sorted(g[kind] / g[1] for g in got), sorted(e[kind] / e[1] for e in expected)
        assert np.allclose(a, b, atol=slack, rtol=0)


def test_language_model_empty(none, docs):
    assert lm.score(none, lambda key: False).count() == 0
    assert {r.train_tokens for r in lm.score(docs, lambda key: True).collect()} == {0}


def test_language_model_query_looks_at_two_words(spark, tmp_path):
    spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op3_language_model"](spark, str(tmp_path)).collect()
    held = lambda key: key is not None and zlib.crc32(str(key).encode()) % 7 == 2
    expected = list(word_model(ROWS, held, 3, lm.STRENGTH))
    assert np.allclose(sorted(r.score / r.n_tokens for r in got), sorted(e[5] / e[1] for e in expected), atol=0.004, rtol=0)


def plain_scores(rows, held, order, strength):
    """Like ``word_model`` for any order: a context that begins in front of the text has a count of its own once it holds a word."""
    texts = [("",) * max(order - 2, 0) + ("\n",) + tuple(WORD.findall(lower(text)) + ["\n"]) for _, text in rows]
    grams, first = collections.Counter(), max(order - 1, 1)
    for (key, _), p in zip(rows, texts):
        if not held(key):
            grams.update(p[i - m + 1 : i + 1] for i in range(first, len(p)) for m in range(1, order + 1))
    total, distinct = sum(c for g, c in grams.items() if len(g) == 1), sum(len(g) == 1 for g in grams)

    def chance(gram):
        if len(gram) == 1:
            return (grams[gram] + 1) / (total + distinct + 1)
        context = gram[:-1]
        seen = grams[("\n",)] if set(context[:-1]) <= {""} and context[-1] == "\n" else grams[context]
        return (grams[gram] + strength * chance(gram[1:])) / (seen + strength)

    return [sum(math.log10(chance(p[i - order + 1 : i + 1])) for i in range(first, len(p))) / (len(p) - first) for p in texts]


@pytest.mark.parametrize("order, parts", [(1, 2), (4, 2), (3, 7)])
def test_language_model_of_other_orders_and_shards(spark, docs, order, parts):
    held = lambda key: key is not None and zlib.crc32(str(key).encode()) % 7 == 2
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = lm.score(docs, held, order=order).select("n_tokens", "score").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert np.allclose(sorted(r.score / r.n_tokens for r in got), sorted(plain_scores(ROWS, held, order, lm.STRENGTH)), atol=0.004, rtol=0)


def test_language_model_sends_no_ngrams_of_unseen_words(spark, monkeypatch):
    table = spark.createDataFrame([(0, "a b a")] + [(i, " ".join(f"w{i}x{j}" for j in range(200))) for i in range(1, 20)], "doc_id long, text string")
    sent, deal = [], lm.by_bucket
    monkeypatch.setattr(lm, "by_bucket", lambda rows, buckets: sent.append(rows) or deal(rows, buckets))
    monkeypatch.setattr(lm, "drop_path", lambda spark, path: None)  # what was sent is read again
    for held, most in ((lambda key: int(key) >= 1, 2000), (lambda key: True, 0)):
        sent.clear()
        assert lm.score(table, held).count() == 20 and len(sent) == 2
        for rows in sent:
            size = " + ".join(f"length({c})" for c, kind in rows.dtypes if kind == "binary")
            assert rows.selectExpr(f"coalesce(sum({size}), 0) AS n").first().n <= most


def test_language_model_keeps_little_per_ngram(spark, monkeypatch):
    """A level costs few bytes per n-gram: sent contexts are numbers of the level below, and tries hold the same."""
    rnd = random.Random(3)
    table = spark.createDataFrame([(i, " ".join(f"w{min(rnd.randrange(30_000), rnd.randrange(30_000))}" for _ in range(4000))) for i in range(60)], "doc_id long, text string").repartition(2)
    sizes, write = {}, lm.stored

    def weighed(rows, label):
        found = write(rows, label)
        binary = [f"coalesce(length({c}), 0)" for c, kind in found.dtypes if kind == "binary"]
        sizes[label] = found.selectExpr(f"sum({' + '.join(binary)}) AS n").first().n if binary else 0
        return found

    monkeypatch.setattr(lm, "stored", weighed)
    assert lm.score(table, lambda key: False).count() == 60
    assert sizes["lm-level3"] < 9 * 60 * 4000


@pytest.mark.parametrize("values", [[], [0], [5, 5, 1], [1 << 62, 3, 1 << 62], list(range(70000, 0, -1))])
def test_distinct_and_packed(values):
    values = np.array(values, np.int64)
    found, inverse = lm.distinct(values)
    assert (found == np.unique(values)).all() and (found[inverse] == values).all()
    assert (lm.unpacked(lm.packed(values)) == values).all() and (np.cumsum(lm.unpacked(lm.rising(np.sort(values)))) == np.sort(values)).all()
    order, buckets, bounds = blocks.bucket_pieces(values)
    assert (order == np.argsort(values, kind="stable")).all() and (buckets == found).all() and len(bounds) == len(found) + 1


def test_totals_above_four_bytes(spark):
    values, many = np.array([7, 9], np.uint64), np.array([1_500_000_000, 1])
    rows = [tuple(r.values()) for block in (0, 1) for r in exchange.value_rows(block, values, many, 1)]
    sent = spark.createDataFrame([(b, k, bytearray(v), bytearray(c)) for b, k, v, c in rows], exchange.VALUE_ROWS)
    for ranked in (False, True):
        totals = [exchange.totals_of(values, r.parts, 1).tolist() for r in exchange.value_totals(sent, 1, ranked=ranked).collect() if r.block != exchange.SUMMARY]
        assert totals == [[3_000_000_000, 2]] * 2


@pytest.mark.parametrize("n, top", [(0, 10), (1, 1), (50, 20), (3000, 1 << 40), (70000, 1 << 20)])
def test_elias_fano(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top, n))
    coded, _ = trie.EliasFano.load(memoryview(trie.EliasFano.build(values).dump()))
    assert (coded.values() == values).all()
    asked = np.append(values, [0, top + 5]) + 1
    assert (coded.next_geq(asked) == np.searchsorted(values, asked)).all()


# --- HTML


PAGES = {
    "<html><body><nav><ul><li><a href=x>Menu<li>two</ul></nav><div class='ad'>buy</div><article><h1>T &amp; x</h1><p>One\n  two<p>Three</article><footer>f</footer>": "T & x\nOne two\nThree",
    "<p>" + "long text here " * 20 + "</p><aside>side</aside><form>q</form><script>var a='<p>';</script>": ("long text here " * 20).strip(),
    "<article><p>a<!-- c --> b &copy; &#233;</p><div id='comments'><p>reader</p></div><ul><li>i<li>j</ul></article>": "a b © é\ni\nj",
    "": "",
    "plain words only": "plain words only",
    "<<>>&&am <p": "<<>>&&am",
}


@pytest.mark.parametrize("page", PAGES)
def test_pages(page):
    assert html_text.main_text(page) == PAGES[page]


BODY = "words of the body that run on " * 8


@pytest.mark.parametrize(
    "page, kept",
    [
        (f"<article><p>teaser</article><div><p>{BODY}<p>{BODY}</div>", ["teaser", BODY.strip(), BODY.strip()]),
        (f"<div><p>{BODY}<p>{BODY}</div><nav><p>a<p>b<p>c</nav><article><p>x</article>", [BODY.strip()] * 2),
        (f"<article><p>{BODY}</article><nav><p>a<p>b<p>c</nav><div>stray</div>", [BODY.strip()]),
        (f"<article><p>{BODY}<p><a href=x>a source</a><p>{BODY}<p><a href=y>another</a></article>", [BODY.strip(), "a source", BODY.strip(), "another"]),
        (f"<div><p>{BODY}<p><a href=x>a source</a><p>{BODY}<p><a href=y>next page</a></div>", [BODY.strip(), "a source", BODY.strip()]),
        (f"<article><h1>T</h1><p>s<p>s<p>s<p>{BODY}<div class=related><p>a<p>b<p>c<p>d</div><p>end</article>", ["T", "s", "s", "s", BODY.strip(), "end"]),
        (f"<div class='content has-sidebar'><p>{BODY}<div class='box sidebar'>s</div></div><div class=cookie_notice>c</div>", [BODY.strip()]),
    ],
)
def test_surges_decide_on_pages_with_an_article(page, kept):
    assert html_text.main_text(page).split("\n") == kept


def test_extract(spark):
    rows = [(i, f"u{i}", p) for i, p in enumerate(PAGES)] + [(99, None, None), (99, None, None), (None, "z", "<p>" * 5000 + "deep")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS key", "3 AS c0")
    got = rows_of(html_text.extract(pages))
    assert len(got) == len(rows)
    assert all(len(r[2]) == r[3] for r in got) and (99, None, "", 0) in got and (None, "z", "deep", 4) in got
    assert html_text.extract(pages.limit(0)).count() == 0


# --- Chat


def test_reply_tree_branches(spark):
    nodes = [
        ("t", 1, None, "user", "q <|im_end|> \\ <|", 0.0),
        ("t", 2, 1, "assistant", "bad", -1.0),
        ("t", 3, 1, "assistant", "good <\\|im_end|>\n", 2.0),
        ("t", 4, 3, "user", None, 0.0),
        ("t", 5, 4, "assistant", "end<", 1.0),
        ("u", 1, 9, "a|b\n%7C", "lost parent", None),
        ("v", 1, 2, "user", "on a cycle", 0.0),
        ("v", 2, 1, "user", "on a cycle", 0.0),
        ("v", 3, 2, "user", "below a cycle", 0.0),
        (None, 1, None, "user", "no tree id", 0.0),
    ]
    table = spark.createDataFrame(nodes, "tree string, node long, parent long, role string, text string, score double")
    told = {(r.tree, r.branch): r for r in chat.read_back(chat.conversations(table, branches=5)).collect()}
    assert set(told) == {("t", 1), ("t", 2), ("u", 1), (None, 1)}
    best = told["t", 1]
    assert [tuple(x) for x in best.turns] == [("user", "q <|im_end|> \\ <|"), ("assistant", "good <\\|im_end|>\n"), ("user", ""), ("assistant", "end<")]
    assert best.loss_text == "good <\\|im_end|>\nend<"
    assert best.formatted.count("<|im_end|>") == 4 == best.formatted.count("<|im_start|>")
    assert tuple(told["u", 1].turns[0]) == ("a|b\n%7C", "lost parent")
    assert chat.conversations(table.limit(0)).count() == 0


def test_escape_is_reversible(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("<|\\a\n$1") for _ in range(rnd.randint(0, 12))) for _ in range(2000)]
    table = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", f"{chat.escaped('t')} AS e").selectExpr("t", "e", f"{chat.unescaped('e')} AS back")
    rows = table.collect()
    assert all(r.back == r.t and "<|" not in r.e for r in rows)
    assert len({r.e for r in rows}) == len({r.t for r in rows})


def test_long_chain_of_replies(spark):
    nodes = spark.range(1, 301).selectExpr("1 AS tree", "id AS node", "nullif(id - 1, 0) AS parent", "'user' AS role", "cast(id AS string) AS text", "1D AS score")
    (row,) = chat.read_back(chat.conversations(nodes)).collect()
    assert [x.text for x in row.turns] == [str(i) for i in range(1, 301)]


def test_branches_store_no_paths(spark, monkeypatch):
    """Random forests by brute force; a chain of n nodes stores far less than n * n / 2 ids."""
    rnd = random.Random(6)
    nodes = []
    for tree in range(12):
        for node in range(1, 40):
            parent = None if node == 1 else rnd.randint(max(1, node - rnd.choice([2, 30])), node - 1)
            nodes.append((tree, node, parent, "assistant" if node % 2 else "user", f"é{node}<|", float(rnd.randint(0, 3))))
        nodes += [(tree, 50, 52, "user", "c", 9.0), (tree, 51, 50, "user", "c", 9.0), (tree, 52, 51, "user", "c", 9.0), (tree, 53, 51, "user", "c", 9.0)]
    expected = []
    for tree in range(12):
        own = {n: (p, s) for t, n, p, _, _, s in nodes if t == tree and n < 50}
        paths = []
        for leaf in set(own) - {p for p, _ in own.values()}:
            path = [leaf]
            while own[path[0]][0]:
                path.insert(0, own[path[0]][0])
            paths.append((-sum(own[x][1] for x in path) / len(path), leaf, path))
        expected += [(tree, i + 1, leaf, [f"é{x}<|" for x in path], "".join(f"é{x}<|" for x in path if x % 2)) for i, (_, leaf, path) in enumerate(sorted(paths)[:3])]
    fields = "tree long, node long, parent long, role string, text string, score double"
    told = chat.read_back(chat.conversations(spark.createDataFrame(nodes, fields), branches=3)).collect()
    assert sorted((r.tree, r.branch, r.leaf, [x.text for x in r.turns], r.loss_text) for r in told) == expected
    cells, keep = [], chat.stored

    def counted(df, label):
        out = keep(df, label)
        cells.extend(len(v) if isinstance(v, list) else 1 for row in out.collect() for v in row)
        return out

    monkeypatch.setattr(chat, "stored", counted)
    chain = [(1, i, i - 1 or None, "user", "", 0.0) for i in range(1, 601)]
    assert chat.conversations(spark.createDataFrame(chain, fields)).first().n_turns == 600
    assert sum(cells) < 600 * 600 / 4


# --- Helpers


def test_byte_pieces_keep_rows_and_bounds():
    import pyarrow as pa

    texts = ["x" * n for n in (0, 5, 300, 2, 40, 0, 90)] + [None]
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts)})] * 3
    pieces = list(blocks.byte_pieces(iter(batches), "text", 150))
    assert [t for p in pieces for t in p.column("text").to_pylist()] == texts * 3
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= 150 for p in pieces)


def test_digest_helper():
    assert hashlib.sha256(blocks.expand(blocks.squeeze(b"abc"))).hexdigest() == hashlib.sha256(b"abc").hexdigest()


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_stored_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    kept = blocks.stored(spark.range(1000).repartition(3, "id"), "kept")
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and kept.count() == 1000
    assert spark.conf.get(blocks.SHUFFLE_CLEANUP, "false") == "false"


def test_stored_alone_deletes_what_it_took(spark):
    taken = []

    def build():
        taken.append(blocks.stored(spark.range(10), "taken"))
        return taken[0].filter("id > 4")

    kept = blocks.stored_alone(spark, "kept", build)
    assert kept.count() == 5
    assert not any(os.path.exists(f.removeprefix("file://")) for f in taken[0].inputFiles()) and all(os.path.exists(f.removeprefix("file://")) for f in kept.inputFiles())


@pytest.mark.parametrize("kind", [np.uint16, np.int32, np.int64, np.uint64])
@pytest.mark.parametrize("n", [0, 1, 1000])
def test_planes(kind, n):
    values = np.random.default_rng(n).integers(0, np.iinfo(kind).max, n, kind, endpoint=True)
    assert (blocks.from_planes(blocks.expand(blocks.squeeze_planes(values)), kind) == values).all()


def test_sent_grams_are_small():
    rnd = np.random.default_rng(3)
    words = rnd.integers(0, 1 << 18, 60_002)
    grams = lm.Grams((words[:-2] << lm.PAIR_BITS) + words[1:-1], np.ones(60_000, np.int64), words[2:], np.ones(60_000, bool))
    (sent,) = lm._sent(grams, np.zeros(len(grams.key), np.int64), 0)
    (row,) = sent.to_pylist()
    key, context_count, sizes, successor, count = lm._received(row)
    assert (np.repeat(key, sizes) == grams.key).all() and (np.repeat(context_count, sizes) == grams.context_count).all()
    assert (successor == grams.successor).all() and (count == grams.count).all()
    assert sum(len(row[c]) for c in lm.GRAM_COLUMNS) < 8 * len(grams.key)


def test_further_links_follow_classes_only(spark, monkeypatch):
    def plain(links):
        root = {x: x for link in links for x in link}
        for _ in root:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        return sorted(root.items())

    first, then = [(1, 2), (2, 3), (7, 8), (20, 21)], [(3, 8), (9, 30), (2, 1), (30, 7)]
    table = lambda links: spark.createDataFrame(links, "a long, b long")
    classes_ = exchange.joined_classes(None, table(first))
    seen, whole = [], exchange.components
    monkeypatch.setattr(exchange, "components", lambda links: seen.append(links.filter("a <> b").count()) or whole(links))
    got = exchange.joined_classes(classes_, table(then))
    assert sorted(tuple(r) for r in got.select("node", "root").collect()) == plain(first + then)
    assert seen == [3]


def test_sketches_part_long_sets(spark):
    rnd = np.random.default_rng(1)
    a, other = (rnd.integers(0, 1 << 63, 1000).astype(np.uint64) for _ in "ab")
    linked = np.append(a[:860], other[:140])  # 860 of 1140
    sets = [np.unique(x) for x in (a, linked, other)]
    rows = [[*map(int, s), list(map(int, m)), len(x)] for s, m, x in zip(near.parity_sketches(sets), near.parity_sketches(sets, near.LONG_SKETCH), sets)]
    names = [f"s{i}" for i in range(near.SKETCH)] + ["more", "n"]
    sides = [spark.createDataFrame(x, ", ".join(f"{n}_{side} {'array<long>' if n == 'more' else 'long'}" for n in names)) for side, x in (("a", rows[:1]), ("b", rows[1:]))]
    assert [[r.close for r in sides[0].crossJoin(sides[1].filter(f"more_b = array({', '.join(f'{x}L' for x in row[-2])})")).selectExpr(f"{near._close(75)} AS close").collect()] for row in rows[1:]] == [[True], [False]]
