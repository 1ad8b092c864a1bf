"""The whole pipeline against brute force on small tables."""

import os
import re

import numpy as np

import corpus_pipeline
from .test_operators import WORD, classes, corpus, hits, library, removed


def base_failed(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    inside = {j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(i, i + 5)}
    return len(w) < 10 or 100 * len(inside) > 20 * len(w)


def test_pipeline_by_brute_force(spark, tmp_path):
    rows = [r for r in corpus() if r[0] is None or len(r[1] or "") < 5000]
    rows += [(100, rows[2][1] + " one more word"), (101, "clean words that no other row holds at all " + " ".join(f"u{i}" for i in range(40)))]
    items = [(7, " ".join(WORD.findall(rows[6][1])[:12]) if len(WORD.findall(rows[6][1])) >= 12 else rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.selectExpr("*", "'en' AS lang", "'s' AS source", "cast(length(text) AS bigint) AS n_chars", "'x' AS _row", "1 AS key").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()), key=repr)

    rows = [r for r in rows if not base_failed(r[1])]
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    least, kept = {i: c for i, (_, _, c) in enumerate(classes_in_order(order))}, []
    for i, row in enumerate(order):
        if least[i] == i:
            kept.append(row)
    cut = [(k, rest.decode("utf-8", "ignore")) for k, _, _, rest in removed([(k, t.encode()) for k, t in kept], 200)]
    clean = [(k, t) for (k, t), h in zip(cut, hits(cut, items)) if not h[2]]
    tool, expected = library(), []
    for key, text in clean:
        ids = tool.encode(text, add_special_tokens=False).ids
        expected.append((key, len(ids), np.array(ids, "<u4").tobytes(), tool.decode(ids, skip_special_tokens=False)))
    assert got == sorted(expected, key=repr)
    assert 0 < len(got) < len(rows)


def classes_in_order(rows):
    """Classes with the position in ``rows`` as the key, in that order."""
    return sorted(classes([(i, t) for i, (_, t) in enumerate(rows)]))


def test_stages_keep_the_columns_and_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert tuple(out.columns) == corpus_pipeline.COLUMNS, name
    assert [re.sub("_.*", "", n) for n, _ in corpus_pipeline.STAGES] == ["quality", "near", "suffix", "decontamination", "bpe"]


def test_stages_delete_their_steps(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"some words of text number {i} " * 3, "en", "s", 9) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, "no such item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    shared = spark.conf.get("spark.checkpoint.dir")
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.decontamination):
        before = set(os.listdir(shared))
        out = stage(spark, docs, str(tmp_path))
        assert len(set(os.listdir(shared)) - before) == 1
        assert out.count() == 20
