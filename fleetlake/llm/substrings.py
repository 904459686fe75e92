"""Removal of repeated word passages by fixed-block anchors.

A passage of `window` words that occurs twice covers a whole reference block wherever
blocks of (window + 1) // 2 words lie end to end. So the blocks of every document are
an index, and each rolling window of block length is a probe: where it meets a block
of another place, a passage may extend on both sides. The extension is decided for
all places at once: the windows of `window` words around hits are compared by 128-bit
hashes, and their union is the maximal repeats. Pairs of places never arise, so the
work grows with the text however many copies a passage has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import passages as P
from .common import stored

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUES = P.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_VALUES[_SPACE] = 0
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_powers: dict[int, np.ndarray] = {}
_ENTRIES = "batch long, bucket int, payload binary"


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2 ** 64."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, 1 << 12), base, np.uint64)
        table[0] = 1
        _powers[base] = table = np.cumprod(table, dtype=np.uint64)
    return table[:n]


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and first byte of every word."""
    raw = np.frombuffer(text, np.uint8)
    inside = ~_SPACE[raw]
    starts = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]])) if len(raw) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    first = starts[0]
    nth = np.arange(first, len(raw)) - np.repeat(starts, np.diff(starts, append=len(raw)))
    weighed = _VALUES[raw[first:]] * _power(_BASES[0], int(nth.max()) + 1)[nth]
    return P.mix(np.add.reduceat(weighed, starts - first)), starts


def rolling(words: np.ndarray, length: int, base: int = _BASES[0]) -> np.ndarray:
    """Hash of each run of `length` consecutive words."""
    n = len(words)
    if n < length:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _power(base, n), dtype=np.uint64)])
    inverse = pow(base, -1, 1 << 64)
    return P.mix((sums[length:] - sums[:-length]) * _power(inverse, n - length + 1))


class Batch:
    """The words of a batch's documents, one after the other."""

    def __init__(self, blob: bytes) -> None:
        self.ids, self.texts = P.unpack(blob)
        self.words, starts = word_hashes(b"\n".join(self.texts) + b"\n")
        ends = np.cumsum([len(t) + 1 for t in self.texts])
        self.bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
        sizes = np.diff(self.bounds)
        self.left = np.repeat(self.bounds[1:], sizes) - np.arange(len(self.words))
        self.nth = np.arange(len(self.words)) - np.repeat(self.bounds[:-1], sizes)
        self.size = np.repeat(sizes, sizes)

    def anchors(self, window: int, block: int, drop: int):
        """Distinct hashes of block length with flags, and each probe's place and entry."""
        at = np.flatnonzero((self.left >= block) & (self.size >= window))
        keys = rolling(self.words, block)[at] >> np.uint64(drop) << np.uint64(drop) if len(at) else np.zeros(0, np.uint64)
        distinct, entry, counts = np.unique(keys, return_inverse=True, return_counts=True)
        flags = (counts > 1).astype(np.uint8)
        flags[entry[self.nth[at] % block == 0]] |= 2
        return distinct, flags, at, entry

    def extensions(self, window: int, block: int, hits: np.ndarray):
        """Windows that hold a hit: their starts, and their distinct 128-bit hashes in order."""
        near = np.concatenate([[0], np.cumsum(hits)])
        starts = np.flatnonzero(self.left >= window)
        starts = starts[near[starts + window - block + 1] > near[starts]]
        halves = [rolling(self.words, window, base)[starts] if len(starts) else np.zeros(0, np.uint64) for base in _BASES]
        high, low, entry = P.distinct_wide(*halves)
        return starts, high, low, entry, np.bincount(entry, minlength=len(high))


def _anchor_entries(drop: int, buckets: int, window: int, block: int):
    def make(batch: int, blob: bytes) -> Iterator[tuple]:
        keys, flags, _, _ = Batch(blob).anchors(window, block, drop)
        cuts = P.splits(keys, buckets)
        for b in range(buckets):
            lo, hi = int(cuts[b]), int(cuts[b + 1])
            if lo < hi:
                bits = np.packbits(flags[lo:hi] & 1).tobytes() + np.packbits(flags[lo:hi] >> 1).tobytes()
                yield batch, b, len(bits).to_bytes(4, "little") + bits + P.pack_sorted(keys[lo:hi], drop)

    return make


def _compare_anchors(drop: int):
    def compare(payloads: list[bytes]) -> list[np.ndarray]:
        keys, repeated, blocks = [], [], []
        for p in payloads:
            n = int.from_bytes(p[:4], "little")
            keys.append(P.unpack_sorted(p[4 + n :], drop))
            bits = np.frombuffer(p, np.uint8, n, 4)
            repeated.append(np.unpackbits(bits[: n // 2])[: len(keys[-1])])
            blocks.append(np.unpackbits(bits[n // 2 :])[: len(keys[-1])])
        joined = np.concatenate(keys)
        _, entry, counts = np.unique(joined, return_inverse=True, return_counts=True)
        counts += np.bincount(entry, np.concatenate(repeated), len(counts)).astype(np.int64)
        reference = np.bincount(entry, np.concatenate(blocks), len(counts)) > 0
        hit = (reference & (counts > 1))[entry].astype(np.uint8)
        return np.split(hit, np.cumsum([len(k) for k in keys])[:-1])

    return compare


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 35, batch_bytes: int = P.BATCH_BYTES
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept (words joined by one space).

    A word goes if it lies in a window of `window` consecutive words of one document
    that also starts anywhere else, same document included. Words are runs of bytes
    other than space and 0x09-0x0D. Null texts are empty; short, empty and null texts
    keep all words; null or repeated ids stay rows of their own, so a repeated row is
    a copy and loses what the other one loses. Other columns are ignored. An empty
    table gives no rows. Bits of the anchor hash follow the number of words; a chance
    anchor costs a comparison and removes nothing.
    """
    block = (window + 1) // 2
    held = P.batches(docs, id_column, text_column, batch_bytes)
    words = (held.agg(F.sum("n_bytes")).first()[0] or 0) // 5 + 1  # close enough: it only sizes buckets
    buckets = math.ceil(words / P.BUCKET_ENTRIES)
    drop = 64 - min(60, max(32, math.ceil(math.log2(words)) + 13))
    anchors = P.per_batch(held, _anchor_entries(drop, buckets, window, block), _ENTRIES, ("batch", "blob"))
    hits = stored(P.answers(anchors, buckets, _compare_anchors(drop)))
    probed = P.with_answers(held, hits, "hits")

    def candidates(blob: bytes, answer: list | None):
        batch = Batch(blob)
        keys, _, at, entry = batch.anchors(window, block, drop)
        found = P.codes_of(answer, np.diff(P.splits(keys, buckets)))
        marks = np.zeros(len(batch.words), np.int64)
        marks[at] = found[entry]
        return batch, batch.extensions(window, block, marks)

    def window_entries(batch: int, blob: bytes, answer: list | None) -> Iterator[tuple]:
        if not answer:
            return
        _, (_, high, low, _, counts) = candidates(blob, answer)
        cuts = P.splits(high, buckets)
        for b in range(buckets):
            lo, hi = int(cuts[b]), int(cuts[b + 1])
            if lo < hi:
                yield batch, b, P.pack_wide(high[lo:hi], low[lo:hi], counts[lo:hi] > 1)

    windows = P.per_batch(probed, window_entries, _ENTRIES, ("batch", "blob", "hits"))
    repeats = stored(P.answers(windows, buckets, P.compare_wide))

    def removed(blob: bytes, answer: list | None, again: list | None) -> Iterator[pa.RecordBatch]:
        batch, (starts, high, _, entry, _) = candidates(blob, answer)
        found = P.codes_of(again, np.diff(P.splits(high, buckets)))
        gone = np.zeros(len(batch.words) + 1, np.int64)
        hit = starts[found[entry] > 0]
        np.add.at(gone, hit, 1)
        np.add.at(gone, hit + window, -1)
        gone = np.cumsum(gone[:-1]) > 0
        kept, n_removed = [], []
        for i, text in enumerate(batch.texts):
            mine = gone[batch.bounds[i] : batch.bounds[i + 1]]
            n = int(mine.sum())
            n_removed.append(n)
            parts = text.split()
            kept.append(b" ".join(parts if not n else [w for w, g in zip(parts, mine.tolist()) if not g]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.ids.cast(pa.int64()),
                pa.array(np.diff(batch.bounds), pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept"],
        )

    both = P.with_answers(probed, repeats, "repeats")
    return P.per_batch(both, removed, "doc_id long, n_words long, n_removed long, kept string", ("blob", "hits", "repeats"))
