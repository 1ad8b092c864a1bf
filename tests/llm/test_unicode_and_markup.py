"""Ids over all planes against the library, and pages with broken or deep markup."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
import tokenizers

from cohortweave.llm import bpe, html_text
from cohortweave.llm.blocks import squeeze


def strings():
    points = [n for n in range(0x110000) if not 0xD800 <= n < 0xE000]
    rnd = random.Random(11)
    each = [f"{chr(n)}.x {chr(n)},{chr(n)}a1{chr(n)}'s" for n in points if n < 0x1000 or 0xF900 <= n < 0xFE00 or n % 101 == 0]
    mixed = ["".join(chr(rnd.choice(points[:0x20000])) if rnd.random() < 0.5 else rnd.choice("aZ.,'sİé1 \n<|क़יִ") for _ in range(8)) for _ in range(20000)]
    return ["İ.x", "Ɤ.Ɤa", "\U00010d50x\U00016ea1", *each, *mixed]


def test_ids_over_all_planes():
    spec = bpe.tokenizer_text()
    library = tokenizers.Tokenizer.from_str(spec)
    library.no_truncation()
    library.no_padding()

    def by_library(words):
        ids = [e.ids for e in library.encode_batch_fast(words, add_special_tokens=False)]
        return np.fromiter((i for x in ids for i in x), np.uint32), np.array([len(x) for x in ids], np.int64)

    texts = strings()
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for table in (bpe.WordTable(by_library), bpe.coder_of(squeeze(spec.encode(), 9))[1]):
        ids, ends = table.ids(pa.array(texts))
        starts = np.append(0, ends[:-1])
        assert [t for t, a, b, w in zip(texts, starts, ends, wanted) if ids[a:b].tolist() != w] == []


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>x</p><![foo[ bar ]]><p>y</p>", "x\ny"),
        ("<p>x</p><![CDATA[ bar ]]><p>y</p>", "x\ny"),
        ("<p>a</p><!-- unclosed <p>text", "a"),
        ("<p>a</p><!-- closed --><p>b</p>", "a\nb"),
        ("<script>var a = '<!-- open';</script><p>b</p>", "b"),
        ("<!DOCTYPE x [<!FOO bar>]><p>body</p>", "body"),
        ("<p>A<span hidden>secret</span>B</p>", "AB"),
        ("<p>A<b class='menu'>one <i>two</b> three</i> B</p>", "A three B"),
        ("</p></b></li></nope><p>still</p>", "still"),
        ("<p>a</p><!x", "a"),
    ],
)
def test_broken_markup(page, text):
    assert html_text.main_text(page) == text


def test_deep_nesting_takes_time_in_proportion():
    def seconds(page):
        began = time.process_time()
        assert html_text.main_text(page).count("x") == page.count("x")
        return time.process_time() - began

    for piece in ("<div>x", "<b>x</i>", "<p>x<div>", "<em>x"):
        assert seconds(piece * 32_000) < 20 * seconds(piece * 4_000) + 1


def test_random_markup_never_stops_a_job():
    rnd = random.Random(3)
    parts = ["<", ">", "<!", "<![", "]]>", "[", "]", "<!--", "-->", "<?", "?>", "</", "<p", "<div>", "</div>", "&", "&#", "&#x110000;", ";", "'", '"', "=", "a", " ", "script", "<script>", "<title>", "<svg>", "<![if", "<!doctype", "\x00", "퟿"]
    for _ in range(4000):
        html_text.main_text("".join(rnd.choices(parts, k=rnd.randint(1, 14))))
