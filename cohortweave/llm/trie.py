"""N-gram trie levels in Elias-Fano form: monotone contexts, pointers and successors, quantised probabilities."""

from __future__ import annotations

import struct

import numpy as np

STEP = 64  # probability codes per factor of two
PIECE = 1 << 16  # contexts looked up at once

# Fixed values of the file format.
HEAD = struct.Struct("<4sQQBQ")  # magic, values, universe, low bits, bytes of the low part
MAGIC = b"EFS1"


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary as a bit vector.

    Reads from any buffer, a memory map included: nothing of the sequence is copied until it is asked for.
    """

    def __init__(self, n: int, universe: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.universe, self.width, self.low_bytes, self.high_bytes = n, universe, width, low, high
        self._starts: np.ndarray | None = None
        self._low: np.ndarray | None = None

    @staticmethod
    def build(values: np.ndarray) -> "EliasFano":
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        v = values.astype(np.uint64)
        shifts = np.arange(width, dtype=np.uint64)
        low = np.concatenate(
            [np.packbits(((v[a : a + 65536, None] >> shifts) & np.uint64(1)).astype(bool).ravel(), bitorder="little") for a in range(0, n, 65536)] or [np.zeros(0, np.uint8)]
        )
        at = (v >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(at[-1]) if n else 0) + 1, bool)
        bits[at] = True
        return EliasFano(n, universe, width, low, np.packbits(bits, bitorder="little"))

    def dump(self) -> bytes:
        return HEAD.pack(MAGIC, self.n, self.universe, self.width, len(self.low_bytes)) + len(self.high_bytes).to_bytes(8, "little") + self.low_bytes.tobytes() + self.high_bytes.tobytes()

    @staticmethod
    def load(buffer: memoryview | bytes, at: int = 0) -> tuple["EliasFano", int]:
        magic, n, universe, width, low = HEAD.unpack_from(buffer, at)
        if magic != MAGIC:
            raise ValueError("Not an Elias-Fano sequence.")
        at += HEAD.size
        high = int.from_bytes(buffer[at : at + 8], "little")
        at += 8
        return EliasFano(n, universe, width, np.frombuffer(buffer, np.uint8, low, at), np.frombuffer(buffer, np.uint8, high, at + low)), at + low + high

    def _open(self) -> tuple[np.ndarray, np.ndarray]:
        """First index of each high part, and the low parts."""
        if self._starts is None:
            ones = np.flatnonzero(np.unpackbits(self.high_bytes, bitorder="little"))[: self.n]
            self._high = ones - np.arange(self.n)
            buckets = (self.universe >> self.width) + 2
            self._starts = np.append(0, np.cumsum(np.bincount(self._high, minlength=buckets)))
            if self.width:
                parts = []
                step = 65536  # a multiple of 8 values starts on a whole byte
                for a in range(0, self.n, step):
                    m = min(step, self.n - a)
                    raw = self.low_bytes[a * self.width // 8 : -(-(a + m) * self.width // 8)]
                    bits = np.unpackbits(raw, count=m * self.width, bitorder="little").reshape(m, self.width)
                    padded = np.zeros((m, 64), np.uint8)
                    padded[:, : self.width] = bits
                    parts.append(np.packbits(padded, axis=1, bitorder="little").view(np.uint64).ravel())
                self._low = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            else:
                self._low = np.zeros(self.n, np.uint64)
        return self._starts, self._low

    def values(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """The values, or those at the places ``at``."""
        _, low = self._open()
        return (self._high[at].astype(np.uint64) << np.uint64(self.width)) | low[at]

    def next_geq(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value of at least ``x`` (``n`` where there is none), by successor search."""
        starts, low = self._open()
        x = x.astype(np.uint64)
        inside = x < np.uint64(self.universe)
        high = np.where(inside, x >> np.uint64(self.width), np.uint64(0)).astype(np.int64)
        rest = x & np.uint64((1 << self.width) - 1)
        a, b = starts[high], starts[high + 1]
        open_ = np.flatnonzero(a < b)
        while len(open_):
            lo, hi = a[open_], b[open_]
            mid = (lo + hi) // 2
            less = low[mid] < rest[open_]
            a[open_], b[open_] = lo, hi = np.where(less, mid + 1, lo), np.where(less, hi, mid)
            open_ = open_[lo < hi]
        return np.where(inside, a, self.n)


def quantised(probability: np.ndarray) -> np.ndarray:
    """Code from 1 on of a probability in (0, 1]; 0 is kept for absence."""
    return np.minimum(np.rint(-np.log2(probability) * STEP) + 1, 65535).astype(np.uint16)


def restored(code: np.ndarray) -> np.ndarray:
    """Probability of a code; 0 for absence."""
    return np.where(code == 0, 0.0, np.exp2(-(code.astype(float) - 1) / STEP))


class TrieLevel:
    """One level: contexts, where the successors of each begin, successors and their codes.

    Successors are kept relative to their context: each context adds the span of those before it, so that all
    successors form one non-decreasing sequence and a single successor search finds an n-gram.
    """

    def __init__(self, contexts: EliasFano, pointers: EliasFano, bases: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.contexts, self.pointers, self.bases, self.successors, self.codes = contexts, pointers, bases, successors, codes

    @staticmethod
    def build(contexts: np.ndarray, sizes: np.ndarray, successors: np.ndarray, codes: np.ndarray) -> "TrieLevel":
        """``contexts`` ascending and distinct; ``successors`` ascending within each."""
        ends = np.cumsum(sizes)
        spans = successors[ends - 1].astype(np.uint64) + np.uint64(1) if len(ends) else np.zeros(0, np.uint64)
        bases = np.cumsum(spans) - spans
        relative = np.repeat(bases, sizes) + successors.astype(np.uint64)
        build = EliasFano.build
        return TrieLevel(build(contexts), build(np.append(0, ends)), build(np.append(bases, bases[-1:] + spans[-1:])), build(relative), codes)

    def dump(self) -> bytes:
        return b"".join(x.dump() for x in (self.contexts, self.pointers, self.bases, self.successors)) + self.codes.astype("<u2").tobytes()

    @staticmethod
    def load(buffer: memoryview | bytes) -> "TrieLevel":
        at, parts = 0, []
        for _ in range(4):
            part, at = EliasFano.load(buffer, at)
            parts.append(part)
        return TrieLevel(*parts, np.frombuffer(buffer, "<u2", parts[3].n, at))

    def lookup(self, contexts: np.ndarray, sizes: np.ndarray, successors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and nodes of n-grams given by distinct contexts and the successors of each; 0 and -1 where absent."""
        codes, nodes = np.zeros(len(successors), np.uint16), np.full(len(successors), -1)
        ends = np.cumsum(sizes)
        for a in range(0, len(contexts) if self.successors.n else 0, PIECE):
            z = slice(a, a + PIECE)
            node = self.contexts.next_geq(contexts[z])
            known = node < self.contexts.n
            node = np.minimum(node, self.contexts.n - 1)
            known &= self.contexts.values(node) == contexts[z].astype(np.uint64)
            rows = slice(ends[a] - sizes[a], ends[z][-1])
            key = np.repeat(self.bases.values(node), sizes[z]) + successors[rows].astype(np.uint64)
            inside = np.repeat(known, sizes[z]) & (key < np.repeat(self.bases.values(node + 1), sizes[z]))
            at = self.successors.next_geq(key)
            found = inside & (at < self.successors.n)
            at = np.minimum(at, self.successors.n - 1)
            found &= self.successors.values(at) == key
            codes[rows], nodes[rows] = np.where(found, self.codes[at], 0), np.where(found, at, -1)
        return codes, nodes
