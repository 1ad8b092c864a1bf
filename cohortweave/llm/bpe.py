"""BPE encoding and decoding of whole texts with a token automaton."""

from __future__ import annotations

import os
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.blocks import bounded_batches, byte_pieces, expand, ragged, squeeze
from cohortweave.llm.merge_automaton import WordCoder

CACHED_WORDS = 150_000  # words remembered per worker; a cache only, never a limit on the input


def tokenizer_text(path: str | None = None) -> str:
    """Content of a tokenizer file; by default the public word-level vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(os.fspath(path), encoding="utf-8") as file:
        return file.read()


@cache
def parted_stops() -> str:
    """Pattern of a letter before a full stop or comma.

    Letters that normalisation and lower-casing turn into a letter and a combining mark are left out: the mark is no letter
    and stays with the stop.
    """
    marked = []
    for n in range(0x80, sys.maxunicode + 1):
        c = chr(n)
        if unicodedata.category(c)[0] == "L" and unicodedata.decomposition(c):
            if unicodedata.category(unicodedata.normalize("NFC", c).lower()[-1])[0] != "L":
                marked.append(f"\\x{{{n:X}}}")
    return rf"([^\PL{''.join(marked)}])([.,])"


Coded = tuple[np.ndarray, np.ndarray]  # ids of all words in order, and how many each word has


class WordTable:
    """Token ids of a batch of texts, found once per distinct word of the batch.

    ``encode_words`` maps a list of texts without ASCII white space to their ids. Tokens never span
    white space, nor the place between a letter and a full stop or comma, and A-Z are lower-cased
    anyway, so the ids of a text are those of its words in order.
    """

    def __init__(self, encode_words: Callable[[list[str]], Coded]):
        self.encode_words = encode_words
        self.known: dict[str, np.ndarray] = {}

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the batch (uint32) and where each text ends."""
        texts = pc.fill_null(texts, "")
        plain = pc.ascii_lower(pc.replace_substring_regex(texts, parted_stops(), r"\1 \2"))
        # Strings of special tokens are told apart by case, so such texts stay as they are.
        words = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, plain))
        bounds = words.offsets.to_numpy().astype(np.int64)
        coded = words.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds -= bounds[0]
        code = coded.indices.to_numpy()
        if not len(code):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        distinct = coded.dictionary.to_pylist()
        held = [self.known.get(w) for w in distinct]
        fresh = np.array([i for i, x in enumerate(held) if x is None], np.int64)
        old = [x for x in held if x is not None]
        flat, sizes = self.encode_words([distinct[i] for i in fresh])
        lengths, offsets = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        lengths[fresh] = sizes
        offsets[fresh] = np.cumsum(sizes) - sizes
        again = np.array([i for i, x in enumerate(held) if x is not None], np.int64)
        lengths[again] = [len(x) for x in old]
        offsets[again] = len(flat) + np.cumsum(lengths[again]) - lengths[again]
        flat = np.concatenate([flat.astype(np.uint32), *old])
        often = np.bincount(code, minlength=len(distinct)) > 1
        for i in fresh[often[fresh]].tolist():
            if len(distinct[i]) <= 32:
                if len(self.known) >= CACHED_WORDS:
                    self.known.clear()
                self.known[distinct[i]] = flat[offsets[i] : offsets[i] + lengths[i]].copy()
        of_word = lengths[code]
        tokens = flat[ragged(offsets[code], of_word)]
        return tokens, np.append(0, np.cumsum(of_word))[bounds[1:]]


_CODERS: dict[bytes, tuple[WordCoder, WordTable, pa.Array]] = {}


def coder_of(squeezed: bytes) -> tuple[WordCoder, WordTable, pa.Array]:
    """The compiled automaton, once per worker process."""
    if squeezed not in _CODERS:
        _CODERS.clear()
        coder = WordCoder(expand(squeezed).decode())

        def encode_words(words: list[str]) -> Coded:
            each = [coder.encode_chunk(w) for w in words]
            flat = np.fromiter((i for ids in each for i in ids), np.uint32)
            return flat, np.array([len(ids) for ids in each], np.int64)

        _CODERS[squeezed] = coder, WordTable(encode_words), pa.array(coder.names, pa.string())
    return _CODERS[squeezed]


def encode_decode(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_tokens``, ``ids`` (packed little-endian uint32), ``decoded``.

    Ids are those of the tokenizers library without special tokens added; strings of special
    tokens inside a text become those tokens, as in the library. ``decoded`` joins the labels
    of the ids by spaces, as the library does for a vocabulary without a decoder.
    A NULL or blank text gives no ids and an empty decoded text. Rows are coded one by one:
    repeated rows and NULL keys stay, other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    squeezed = squeeze(tokenizer_text(tokenizer).encode(), 9)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, table, labels = coder_of(squeezed)
        for piece in byte_pieces(batches, "text"):
            tokens, ends = table.ids(piece.column("text"))
            starts = np.append(0, ends[:-1])
            tokens = np.ascontiguousarray(tokens, "<u4")
            raw = tokens.tobytes()
            offsets = np.append(0, ends)
            spelled = pc.binary_join(
                pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), labels.take(pa.array(tokens))), " "
            )
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("key"),
                    pa.array(ends - starts, pa.int64()),
                    pa.array([raw[4 * a : 4 * b] for a, b in zip(starts, ends)], pa.binary()),
                    spelled.cast(pa.string()),
                ],
                names=["key", "n_tokens", "ids", "decoded"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    coded = rows.mapInArrow(run, f"key {kind}, n_tokens long, ids binary, decoded string")
    return coded.withColumnRenamed("key", key) if key not in ("n_tokens", "ids", "decoded") else coded
