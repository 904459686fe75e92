"""Removal of repeated byte strings by suffix arrays of bounded shards.

Every window of `length` bytes names an anchor: its 24-byte string with the smallest
hash, the leftmost of equals. Equal windows name equal anchors, so shards by anchor
never part them. Neighbouring windows with one anchor form a piece of text; a window
lies in exactly one piece. Pieces are compared by hash first, which leaves out anchors
that occur once and settles copies, so a text in a third of all documents is one piece.

Where an anchor has several different pieces, these are joined in a text of bounded
size. Its suffixes are sorted, and common prefixes are found from the Burrows-Wheeler
transform: intervals of equal prefixes are extended backwards breadth first, which
gives common prefixes by increasing value, seeded with those below eight bytes and
stopped at `length`. Boundaries that are still open then separate suffixes that share
`length` bytes.

An anchor may be crowded: a line in a third of all documents, each time before other text.
Batches first say how many different pieces each anchor has there, a few bytes an anchor.
Anchors of one piece alone are done with; those with more than `crowd_limit` never meet as
pieces. Their windows, and those of anchors with more than `piece_limit` pieces that differ,
are compared by 128-bit hash in ranges of that hash, each once per batch, so that no task
gets what belongs to one anchor.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import passages as P
from .common import stored

ANCHOR = 24
PIECE_LIMIT = 1500
CROWD_LIMIT = 50_000
TEXT_BYTES = 1_000_000
_SEED = 8
_ENTRIES = "batch long, bucket int, payload binary"
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_KEY = np.dtype([("anchor", "<u8"), ("high", "<u8"), ("low", "<u8"), ("left", "<u4"), ("right", "<u4")])
_SIZE = _KEY.itemsize
_CHUNK = 1 << 15


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def _anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of each window's anchor, and the hash at each place; by parts that fit a cache."""
    n = len(text)
    raw = np.frombuffer(text + bytes(8), np.uint8)
    word = np.ndarray((n,), "<u8", raw, strides=(1,))
    width = length - ANCHOR + 1
    lowest, gram = np.empty(n - length + 1, np.int32), np.empty(n - ANCHOR + 1, np.uint64)
    mask = np.uint64(0xFFFF)
    for a in range(0, n - length + 1, _CHUNK):
        m = min(_CHUNK, n - length + 1 - a) + width - 1
        mine = word[a : a + m] * _ODD[0] ^ P.mix(word[a + 8 : a + 8 + m] * _ODD[1] + word[a + 16 : a + 16 + m] * _ODD[2])
        mine = P.mix(mine)
        gram[a : a + m] = mine
        near = _sliding_minimum(mine & ~mask | np.arange(m, dtype=np.uint64), width) & mask
        lowest[a : a + m - width + 1] = near.astype(np.int32) + np.int32(a)
    return lowest, gram


class Pieces:
    """The pieces of a batch and their distinct entries in order of anchor and content."""

    def __init__(self, blob: bytes, length: int) -> None:
        self.ids, self.texts = P.unpack(blob)
        self.length = length
        self.buffer = b"".join(self.texts)
        self.bounds = np.concatenate([[0], np.cumsum([len(t) for t in self.texts])]).astype(np.int64)
        self.first = self.windows = np.zeros(0, np.int64)
        keys = np.zeros(0, _KEY)
        n = len(self.buffer)
        if n >= length:
            valid = np.zeros(n - length + 1, bool)
            for x, y in zip(self.bounds[:-1].tolist(), (self.bounds[1:] - length + 1).tolist()):
                valid[x : max(x, y)] = True
            lowest, gram = _anchors(self.buffer, length)
            new = valid.copy()
            new[1:] &= (lowest[1:] != lowest[:-1]) | ~valid[:-1]
            self.first = np.flatnonzero(new)
            if len(self.first):
                last = self.bounds[np.searchsorted(self.bounds, self.first, "right")] - length + 1
                self.windows = np.minimum(np.append(self.first[1:], n), last) - self.first
                at_anchor = lowest[self.first].astype(np.int64)
                keys = np.empty(len(self.first), _KEY)
                # anchors have the smallest hashes; spread them again over all buckets
                keys["anchor"] = P.mix(gram[at_anchor] ^ _ODD[2])
                ends = self.first + self.windows + length - 1
                digest, short, text = xxhash.xxh3_128_digest, xxhash.xxh32_intdigest, self.buffer
                hashes = np.frombuffer(b"".join([digest(text[a:b]) for a, b in zip(self.first.tolist(), ends.tolist())]), "<u8")
                keys["high"], keys["low"] = hashes[::2], hashes[1::2]
                side = (length - ANCHOR) // 2
                for name, a, b in (("left", at_anchor - side, at_anchor + ANCHOR), ("right", at_anchor, at_anchor + ANCHOR + side)):
                    there = np.flatnonzero((a >= self.first) & (b <= ends))
                    keys[name] = 0
                    keys[name][there] = [short(text[x:y]) or 1 for x, y in zip(a[there].tolist(), b[there].tolist())]
        order = np.lexsort((keys["low"], keys["high"], keys["anchor"]))
        ranked = keys[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(keys) else np.zeros(0, bool)
        self.entry = np.empty(len(keys), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.keys = ranked[new]
        self.example = order[new]
        self.twice = np.bincount(self.entry, minlength=len(self.keys)) > 1

    def text(self, entry: int) -> bytes:
        piece = self.example[entry]
        start = int(self.first[piece])
        return self.buffer[start : start + int(self.windows[piece]) + self.length - 1]


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first `depth` symbols at least, and the sorted first eight."""
    n = len(text)
    raw = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.ndarray((n,), ">u8", raw, strides=(1,)).astype(np.uint64)
    order = np.argsort(key, kind="stable")
    heads = key[order]
    slots = np.arange(n)
    start = np.maximum.accumulate(np.where(np.concatenate([[True], heads[1:] != heads[:-1]]), slots, 0))
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = start, -1
    known = _SEED
    while known < depth:
        size = np.bincount(start, minlength=n)
        open_slots = np.flatnonzero(size[start] > 1)
        if not len(open_slots):
            break
        suffixes = order[open_slots]
        pair = rank[suffixes] * (n + 1) + rank[np.minimum(suffixes + known, n)] + 1
        sorting = np.argsort(pair, kind="stable")
        pair, suffixes = pair[sorting], suffixes[sorting]
        order[open_slots] = suffixes
        new = np.concatenate([[True], pair[1:] != pair[:-1]])
        start[open_slots] = np.maximum.accumulate(np.where(new, open_slots, 0))
        rank[suffixes] = start[open_slots]
        known *= 2
    return order, heads


def shared_prefixes(order: np.ndarray, heads: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """For each suffix in order, the number of its class of suffixes that share `length` symbols."""
    n = len(text)
    bwt = text[order - 1]
    follow = np.empty(n, np.int64)
    follow[np.argsort(bwt, kind="stable")] = np.arange(n)
    closed = np.zeros(n + 1, bool)
    closed[[0, n]] = True
    change = np.flatnonzero(heads[1:] != heads[:-1]) + 1
    closed[change] = True
    low = np.concatenate([[0], change])[:-1] if len(change) else np.zeros(0, np.int64)
    high = change
    only_last = (heads[high] ^ heads[high - 1]) < np.uint64(256)  # seven of eight bytes agree
    low, high = low[only_last], high[only_last]
    for _ in range(_SEED, length):
        if not len(low):
            break
        sizes = high - low
        inner = np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        symbol = bwt[inner].astype(np.int64)
        _, at, counts = np.unique(
            np.repeat(np.arange(len(low)), sizes) * 256 + symbol, return_index=True, return_counts=True
        )
        real = symbol[at] > 0
        left = follow[inner[at[real]]]
        right = left + counts[real]
        fresh = ~closed[right]
        low, high = left[fresh], right[fresh]
        closed[high] = True
    return np.cumsum(closed[:n]) - 1


def repeated_windows(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, which of its windows also start elsewhere among the pieces."""
    text = np.frombuffer(b"".join(pieces), np.uint8) + np.uint8(1)  # UTF-8 has no byte 0xFF
    text = np.append(text, np.uint8(0))
    order, heads = suffix_order(text, length + 1)
    group = shared_prefixes(order, heads, text, length)
    whole = np.zeros(len(text), bool)
    at = 0
    spans = []
    for piece in pieces:
        spans.append((at, at + len(piece) - length + 1))
        whole[at : spans[-1][1]] = True
        at += len(piece)
    inside = whole[order]
    members = np.bincount(group, inside)
    found = np.zeros(len(text), bool)
    found[order] = inside & (members[group] > 1)
    return [found[a:b] for a, b in spans]


def _compare_pieces(limit: int):
    """0 alone, 1 copies only, 2 and 3 to be sorted, 4 and 5 too many to sort; odd ones have copies.

    A window that recurs shares its anchor with half the rest of the window on one side
    at least; pieces that share neither half with another piece are alone.
    """

    def compare(payloads: list[bytes]) -> list[np.ndarray]:
        counts = [len(p) // (_SIZE + 1) for p in payloads]
        keys = [np.frombuffer(p, _KEY, n) for p, n in zip(payloads, counts)]
        twice = np.concatenate([np.frombuffer(p, np.uint8, n, n * _SIZE) for p, n in zip(payloads, counts)])
        joined = np.concatenate(keys)
        order = np.lexsort((joined["low"], joined["high"], joined["anchor"]))
        ranked = joined[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        content = np.cumsum(new) - 1
        copies = np.bincount(content) + np.bincount(content, twice[order]).astype(np.int64) > 1
        anchor = np.cumsum(np.concatenate([[True], ranked["anchor"][1:] != ranked["anchor"][:-1]])) - 1
        joins = np.zeros(len(ranked), bool)
        for side in ("left", "right"):
            both = (anchor << 32) + ranked[side]
            distinct, counts = np.unique(both[new], return_counts=True)
            joins |= (counts[np.searchsorted(distinct, both)] > 1) & (ranked[side] > 0)
        different = np.bincount(anchor[new & joins], minlength=anchor[-1] + 1)[anchor]
        code = np.where(~joins, 0, np.where(different <= limit, 2, 4)) + copies[content]
        out = np.empty(len(joined), np.uint8)
        out[order] = code
        return np.split(out, np.cumsum([len(k) for k in keys])[:-1])

    return compare


def _anchor_payload(pieces: Pieces, anchors: np.ndarray, start: np.ndarray, lo: int, hi: int) -> bytes:
    """Anchors in order; how many different pieces each has, whether any comes twice, and a sign of its first one."""
    ends = np.append(start, len(pieces.keys))
    many = np.minimum(np.diff(ends)[lo:hi], 0xFFFF).astype("<u2")
    twice = np.add.reduceat(pieces.twice, start)[lo:hi] > 0
    sign = pieces.keys["high"][start[lo:hi]].astype("<u4")
    return (hi - lo).to_bytes(4, "little") + many.tobytes() + twice.astype(np.uint8).tobytes() + sign.tobytes() + P.pack_sorted(anchors[lo:hi], 0)


def _compare_anchors(limit: int):
    """0 one piece that comes once, 1 pieces to be compared, 2 crowded.

    The first pieces of batches count once where they are equal, further ones of a batch each time,
    so that a piece copied into all batches does not crowd its anchor.
    """

    def compare(payloads: list[bytes]) -> list[np.ndarray]:
        anchors, many, twice, signs = [], [], [], []
        for p in payloads:
            n = int.from_bytes(p[:4], "little")
            many.append(np.frombuffer(p, "<u2", n, 4))
            twice.append(np.frombuffer(p, np.uint8, n, 4 + 2 * n))
            signs.append(np.frombuffer(p, "<u4", n, 4 + 3 * n))
            anchors.append(P.unpack_sorted(p[4 + 7 * n :], 0))
        sizes = [len(x) for x in anchors]
        joined, every = np.concatenate(anchors), np.concatenate(many).astype(np.int64)
        order = np.lexsort((np.concatenate(signs), joined))
        _, entry = np.unique(joined, return_inverse=True)
        sign = np.concatenate(signs)[order]
        first = np.ones(len(order), bool)
        first[1:] = (joined[order][1:] != joined[order][:-1]) | (sign[1:] != sign[:-1])
        different = np.bincount(entry, every - 1) + np.bincount(entry[order], first)
        places = np.bincount(entry, every + np.concatenate(twice))
        code = np.where(places < 2, 0, np.where(different > limit, 2, 1)).astype(np.uint8)[entry]
        return np.split(code, np.cumsum(sizes)[:-1])

    return compare


def _text_payload(pieces: Pieces, which: np.ndarray) -> bytes:
    """Keys, sizes and texts of pieces to sort."""
    texts = [pieces.text(e) for e in which.tolist()]
    sizes = np.array([len(t) for t in texts], np.int64)
    body = pa.compress(b"".join(texts), "zstd", asbytes=True)
    head = np.array([len(which), sizes.sum()], np.int64)
    return b"T" + head.tobytes() + pieces.keys[which].tobytes() + sizes.tobytes() + body


def _windows(pieces: Pieces, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct 128-bit hashes of all windows of pieces, the entry of each window, and which come twice."""
    digest, length = xxhash.xxh3_128_digest, pieces.length
    hashes = b"".join([digest(t[i : i + length]) for t in map(pieces.text, which.tolist()) for i in range(len(t) - length + 1)])
    values = np.frombuffer(hashes, "<u8").reshape(-1, 2)
    high, low, entry = P.distinct_wide(values[:, 0], values[:, 1])
    counts = np.bincount(entry, np.repeat(1 + pieces.twice[which], pieces.windows[pieces.example[which]]), len(high))
    return high, low, entry, counts > 1


def _compare_texts(length: int):
    """Whether each window of the pieces, or each hash, starts elsewhere too."""

    def compare(payloads: list[bytes]) -> list[np.ndarray]:
        if payloads[0][:1] == b"W":  # a bucket has one kind
            return P.compare_wide([p[1:] for p in payloads])
        held: dict[bytes, bytes] = {}
        rows: list[list[bytes]] = []
        for p in (memoryview(p)[1:] for p in payloads):
            n, total = (int(x) for x in np.frombuffer(p, np.int64, 2))
            sizes = np.frombuffer(p, np.int64, n, 16 + _SIZE * n).tolist()
            body = pa.decompress(pa.py_buffer(p[16 + (_SIZE + 8) * n :]), total, "zstd", asbytes=True)
            at, mine = 0, []
            for i, size in enumerate(sizes):
                key = bytes(p[16 + _SIZE * i : 16 + _SIZE * (i + 1)])
                held.setdefault(key, body[at : at + size])
                mine.append(key)
                at += size
            rows.append(mine)
        flags: dict[bytes, np.ndarray] = {}
        shard: list[bytes] = []
        total = 0
        ordered = sorted(held, key=lambda k: k[:8])
        for i, key in enumerate(ordered):
            shard.append(key)
            total += len(held[key])
            if i + 1 == len(ordered) or total > TEXT_BYTES and ordered[i + 1][:8] != key[:8]:
                for k, f in zip(shard, repeated_windows([held[k] for k in shard], length)):
                    flags[k] = f
                shard, total = [], 0
        return [np.concatenate([flags[k] for k in mine]) for mine in rows]

    return compare


class _Judged:
    """The pieces of a batch with what has been found out of them.

    Codes are those of `_compare_pieces`; an entry of a crowded anchor is like one of too many to sort.
    """

    def __init__(self, blob: bytes, length: int, buckets: int, crowds: list | None, kinds: list | None = None) -> None:
        self.pieces = pieces = Pieces(blob, length)
        anchors, start = np.unique(pieces.keys["anchor"], return_index=True)
        state = P.codes_of(crowds, np.diff(P.splits(anchors, buckets)))
        self.state = np.repeat(state, np.diff(np.append(start, len(pieces.keys))))
        self.asked = np.flatnonzero(self.state == 1)
        self.cuts = P.splits(pieces.keys["anchor"][self.asked], buckets)
        self.codes = np.where(self.state == 2, 4, 0).astype(np.uint8)
        self.codes[self.asked] = P.codes_of(kinds, np.diff(self.cuts))
        self.sorted = np.flatnonzero((self.codes == 2) | (self.codes == 3))
        self.crowded = np.flatnonzero(self.codes >= 4)


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = 400,
    piece_limit: int = PIECE_LIMIT,
    batch_bytes: int = P.BATCH_BYTES,
    crowd_limit: int = CROWD_LIMIT,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept (binary).

    A byte goes if a string of `length` bytes of its document that covers it also
    starts anywhere else, same document included. Null texts are empty; texts shorter
    than `length` stay whole; null or repeated ids stay rows of their own, so that a
    repeated row is a copy. Other columns are ignored; an empty table gives no rows.
    `length` is 32 to 32,000. The limits choose how windows are compared, not which.
    """
    held = P.batches(docs, id_column, text_column, batch_bytes)
    n_bytes = held.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(1, math.ceil(n_bytes / (10 * P.BATCH_BYTES)))
    text_buckets = max(1, math.ceil(n_bytes / (3 * P.BATCH_BYTES)))

    def anchor_entries(batch: int, blob: bytes) -> Iterator[tuple]:
        pieces = Pieces(blob, length)
        anchors, start = np.unique(pieces.keys["anchor"], return_index=True)
        cuts = P.splits(anchors, buckets)
        for b in range(buckets):
            lo, hi = int(cuts[b]), int(cuts[b + 1])
            if lo < hi:
                yield batch, b, _anchor_payload(pieces, anchors, start, lo, hi)

    anchors = P.per_batch(held, anchor_entries, _ENTRIES, ("batch", "blob"))
    crowds = stored(P.answers(anchors, buckets, _compare_anchors(crowd_limit)))
    counted = P.with_answers(held, crowds, "crowds")

    def key_entries(batch: int, blob: bytes, crowds: list | None) -> Iterator[tuple]:
        judged = _Judged(blob, length, buckets, crowds)
        for b in range(buckets):
            some = judged.asked[int(judged.cuts[b]) : int(judged.cuts[b + 1])]
            if len(some):
                yield batch, b, judged.pieces.keys[some].tobytes() + judged.pieces.twice[some].astype(np.uint8).tobytes()

    keys = P.per_batch(counted, key_entries, _ENTRIES, ("batch", "blob", "crowds"))
    kinds = stored(P.answers(keys, buckets, _compare_pieces(piece_limit)))
    judged_batches = P.with_answers(counted, kinds, "kinds")

    def text_entries(batch: int, blob: bytes, crowds: list | None, kinds: list | None) -> Iterator[tuple]:
        judged = _Judged(blob, length, buckets, crowds, kinds)
        cuts = P.splits(judged.pieces.keys["anchor"][judged.sorted], text_buckets)
        for b in range(text_buckets):
            lo, hi = int(cuts[b]), int(cuts[b + 1])
            if lo < hi:
                yield batch, b, _text_payload(judged.pieces, judged.sorted[lo:hi])
        if len(judged.crowded):
            high, low, _, twice = _windows(judged.pieces, judged.crowded)
            cuts = P.splits(high, text_buckets)
            for b in range(text_buckets):
                lo, hi = int(cuts[b]), int(cuts[b + 1])
                if lo < hi:
                    yield batch, text_buckets + b, b"W" + P.pack_wide(high[lo:hi], low[lo:hi], twice[lo:hi])

    texts = P.per_batch(judged_batches, text_entries, _ENTRIES, ("batch", "blob", "crowds", "kinds"))
    repeats = stored(P.answers(texts, 2 * text_buckets, _compare_texts(length)))

    def removed(blob: bytes, crowds: list | None, kinds: list | None, repeats: list | None) -> Iterator[pa.RecordBatch]:
        judged = _Judged(blob, length, buckets, crowds, kinds)
        pieces, codes = judged.pieces, judged.codes
        n = len(pieces.buffer)
        change = np.zeros(n + 1, np.int64)
        if len(pieces.first):
            # flags of the windows of sorted pieces, in order, and then of the distinct hashes of crowded ones
            windows = pieces.windows[pieces.example]
            ends = np.concatenate([[0], np.cumsum(windows[judged.sorted])])
            sizes = np.diff(ends[P.splits(pieces.keys["anchor"][judged.sorted], text_buckets)])
            entry = np.zeros(0, np.int64)
            if len(judged.crowded):
                high, _, entry, _ = _windows(pieces, judged.crowded)
                sizes = np.concatenate([sizes, np.diff(P.splits(high, text_buckets))])
            found = P.codes_of(repeats, sizes)
            found = np.concatenate([found[: ends[-1]], found[ends[-1] :][entry]])
            slot = np.full(len(pieces.keys), -1)
            slot[judged.sorted] = ends[:-1]
            slot[judged.crowded] = ends[-1] + np.cumsum(windows[judged.crowded]) - windows[judged.crowded]
            code = codes[pieces.entry]
            for piece in np.flatnonzero(code & 1).tolist():
                change[pieces.first[piece]] += 1
                change[pieces.first[piece] + pieces.windows[piece] + length - 1] -= 1
            for piece in np.flatnonzero((code >= 2) & (code & 1 == 0)).tolist():
                at = slot[pieces.entry[piece]]
                hit = pieces.first[piece] + np.flatnonzero(found[at : at + pieces.windows[piece]])
                change[hit] += 1
                change[hit + length] -= 1
        gone = np.cumsum(change[:-1]) > 0
        raw = np.frombuffer(pieces.buffer, np.uint8)
        n_removed, n_spans, kept = [], [], []
        for i, text in enumerate(pieces.texts):
            a, b = pieces.bounds[i], pieces.bounds[i + 1]
            mine = gone[a:b]
            count = int(mine.sum())
            n_removed.append(count)
            n_spans.append(int(mine[0]) + int((mine[1:] & ~mine[:-1]).sum()) if count else 0)
            kept.append(raw[a:b][~mine].tobytes() if count else text)
        yield pa.RecordBatch.from_arrays(
            [
                pieces.ids.cast(pa.int64()),
                pa.array(np.diff(pieces.bounds), pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(n_spans, pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )

    both = P.with_answers(judged_batches, repeats, "repeats")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return P.per_batch(both, removed, schema, ("blob", "crowds", "kinds", "repeats"))
