"""Alignment of the tokens of two tokenizers, by anchors before space-marked tokens.

Both tokenizers encode a whole text. Where a token of each begins with a space at the same
byte, what lies before them ends together; these anchors split a document into windows of
token ids. A window's alignment depends on its ids alone, so it is made once and remembered
by the pair of id tuples: the bytes at which tokens of both end cut it into groups, and the
tokens that end a group are linked.

How often a pair of ids is linked in the whole corpus is counted from the windows of batches
of documents: a batch names each of its pairs once, with its number, however often it comes.
Counts travel back to a batch the same way, so no pair's links gather anywhere.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import ship, stored
from .packing import _byte_of, _tokenizer

BATCH_BYTES = 4_000_000
BATCH_ROWS = 100_000
REMEMBERED = 250_000
LONG_RUN = 2000
_TEXTS = 64
_BITS = 20
_NAMES = [str(i) for i in range(1 << 17)]
_IPC = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))


class Pieces:
    """The bytes of a tokenizer's tokens by id, their lengths, and whether they begin with a space."""

    def __init__(self, of: dict[int, bytes]) -> None:
        self.of = of
        top = max(of, default=-1) + 1
        if top > len(_NAMES) or b"" in of.values():
            raise ValueError(f"ids are below {len(_NAMES)}, and no token is empty")
        self.lengths = [len(of.get(i, b"")) for i in range(top)]
        self.length = np.array(self.lengths, np.int64)
        self.spaced = np.array([of.get(i, b"")[:1] == b" " for i in range(top)], bool)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.of.__getitem__, ids))


def piece_bytes(piece: str) -> bytes:
    """The bytes of a piece: `<0xHH>` is a byte, U+2581 a space."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def entry_bytes(path: str) -> dict[int, bytes]:
    """The bytes of each id of a byte-level vocabulary; special strings are never made from a text."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    alphabet = _byte_of()
    return {i: bytes(alphabet[c] for c in entry) for entry, i in vocabulary.items() if all(c in alphabet for c in entry)}


@lru_cache(maxsize=2)
def _pieces(path: str):
    """The second tokenizer and its pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, Pieces({i: piece_bytes(model.id_to_piece(i)) for i in range(model.get_piece_size())})


@lru_cache(maxsize=2)
def _entries(path: str) -> Pieces:
    return Pieces(entry_bytes(path))


def window_links(a: list[int], b: list[int], first: Pieces, second: Pieces) -> tuple[str, bytes]:
    """The groups of a window as text, and its links as 64-bit numbers first id << 20 | second id, in order.

    Both sides have the same bytes. A group ends where tokens of both end.
    """
    length_a, length_b, names = first.lengths, second.lengths, _NAMES
    if len(a) == 1 or len(b) == 1:  # one group
        return ",".join([names[x] for x in a]) + "|" + ",".join([names[x] for x in b]), struct.pack("<q", a[-1] << _BITS | b[-1])
    groups, links = [], []
    i = j = from_a = from_b = 0
    end_a, end_b = length_a[a[0]], length_b[b[0]]
    while True:
        if end_a < end_b:
            i += 1
            end_a += length_a[a[i]]
        elif end_b < end_a:
            j += 1
            end_b += length_b[b[j]]
        else:
            groups.append(",".join([names[x] for x in a[from_a : i + 1]]) + "|" + ",".join([names[x] for x in b[from_b : j + 1]]))
            links.append(a[i] << _BITS | b[j])
            i, j = i + 1, j + 1
            if i == len(a):
                return ";".join(groups), struct.pack(f"<{len(links)}q", *links)
            from_a, from_b = i, j
            end_a += length_a[a[i]]
            end_b += length_b[b[j]]


class Aligner:
    """Splits documents at anchors, and remembers a bounded number of windows by their id tuples."""

    def __init__(self, first: Pieces, second: Pieces) -> None:
        self.first, self.second = first, second
        self.windows: dict[tuple[bytes, bytes], tuple[str, bytes]] = {}

    def cut(self, a: np.ndarray, b: np.ndarray) -> list[tuple[bytes, bytes]]:
        """Windows of a document as pairs of id tuples, each packed as little-endian 32-bit numbers."""
        ends_a, ends_b = np.cumsum(self.first.length[a]), np.cumsum(self.second.length[b])
        starts_a = np.flatnonzero(self.first.spaced[a])
        starts_b = np.flatnonzero(self.second.spaced[b])
        # the first token of either begins the text; an anchor is an end before two space-marked tokens
        starts_a, starts_b = starts_a[starts_a > 0], starts_b[starts_b > 0]
        _, i, j = np.intersect1d(ends_a[starts_a - 1], ends_b[starts_b - 1], assume_unique=True, return_indices=True)
        edges_a = [0, *(4 * starts_a[i]).tolist(), 4 * len(a)]
        edges_b = [0, *(4 * starts_b[j]).tolist(), 4 * len(b)]
        left, right = a.tobytes(), b.tobytes()
        return [(left[p:q], right[r:s]) for p, q, r, s in zip(edges_a, edges_a[1:], edges_b, edges_b[1:])]

    def aligned(self, window: tuple[bytes, bytes]) -> tuple[str, bytes]:
        found = self.windows.get(window)
        if found is None:
            found = window_links(*(memoryview(side).cast("I").tolist() for side in window), self.first, self.second)
            if len(self.windows) < REMEMBERED:  # what comes often comes early
                self.windows[window] = found
        return found


@lru_cache(maxsize=1)
def _aligner(entries: str, pieces: str) -> Aligner:
    return Aligner(_entries(entries), _pieces(pieces)[1])


def _first_ids(text: str, entries: str) -> list[int]:
    """Ids of a text by the byte-level vocabulary, special strings as plain text.

    The faster encoder of the same vocabulary does not like long runs without white space.
    """
    whole, fast = _tokenizer(entries)
    if max(map(len, text.split()), default=LONG_RUN + 1) > LONG_RUN:
        return whole.encode(" " + text, add_special_tokens=False).ids
    return fast.encode_ordinary(" " + text)


def encode(texts: list[str], entries: str, pieces: str) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """Ids of both tokenizers for each text, or None where there are none or their bytes are not space and text."""
    first, (model, second) = _entries(entries), _pieces(pieces)
    for text, b in zip(texts, model.encode(texts, num_threads=1)):
        size = len(text.encode()) + 1
        b = np.array(b, "<u4")
        # the second tokenizer changes a text by making it shorter, or where it has U+2581
        if not text or second.length[b].sum() != size or "▁" in text and second.joined(b.tolist()) != (" " + text).encode():
            yield None
            continue
        a = np.array(_first_ids(text, entries), "<u4")
        yield (a, b) if first.length[a].sum() == size else None


class _Batch:
    """Documents with their windows by number, and the windows' links."""

    def __init__(self, ids: pa.DataType) -> None:
        self.ids, self.size, self.rows = ids, 0, 0
        self.numbers: dict[tuple[bytes, bytes], int] = {}
        self.texts: list[str] = []
        self.links: list[bytes] = []
        self.docs: dict[str, list] = {name: [] for name in ("doc_id", "n_a", "n_b", "groups_sha256", "windows")}

    def add(self, name, found: tuple[np.ndarray, np.ndarray] | None, size: int, aligner: Aligner) -> None:
        a, b = found if found is not None else ((), ())
        numbers: list[int] = []
        if found is not None:
            cut = aligner.cut(a, b)
            known = self.numbers
            numbers = list(map(known.get, cut))
            if None in numbers:
                numbers = [self._number(window, aligner) if number is None else number for window, number in zip(cut, numbers)]
        texts = self.texts
        digest = hashlib.sha256(";".join([texts[i] for i in numbers]).encode()).hexdigest() if numbers else ""
        for column, value in zip(self.docs.values(), (name, len(a), len(b), digest, np.array(numbers, np.int32).tobytes())):
            column.append(value)
        self.size += size
        self.rows += 1

    def _number(self, window: tuple[bytes, bytes], aligner: Aligner) -> int:
        number = self.numbers.get(window)
        if number is None:
            number = self.numbers[window] = len(self.numbers)
            text, links = aligner.aligned(window)
            self.texts.append(text)
            self.links.append(links)
        return number

    def out(self) -> pa.RecordBatch:
        """The documents as one compressed table, the distinct links in order, how often each comes, and which windows hold them."""
        sizes = np.array([len(x) // 8 for x in self.links], np.int64)
        every = np.frombuffer(b"".join(self.links), np.int64)
        pairs, index = np.unique(every, return_inverse=True)
        windows = [np.frombuffer(blob, np.int32) for blob in self.docs["windows"]]
        uses = np.bincount(np.concatenate([np.zeros(0, np.int32), *windows]), minlength=len(sizes))
        counts = np.bincount(index, np.repeat(uses, sizes), len(pairs)).astype(np.int64)
        kinds = [self.ids, *[pa.int64()] * 2, pa.string(), pa.large_binary()]
        table = pa.table([pa.array(v, k) for v, k in zip(self.docs.values(), kinds)], list(self.docs))
        table = table.append_column("n_groups", pa.array([int(sizes[w].sum()) for w in windows], pa.int64()))
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, table.schema, options=_IPC) as writer:
            writer.write_table(table)
        held = pa.compress(index.astype(np.int32).tobytes(), "zstd", asbytes=True)
        return pa.RecordBatch.from_pydict(
            {
                "docs": [sink.getvalue()],
                "pairs": [pairs.tobytes()],
                "counts": [counts.tobytes()],
                "sizes": [sizes.astype(np.int32).tobytes()],
                "held": [held],
            }
        )


_BATCH = "docs binary, pairs binary, counts binary, sizes binary, held binary"


def link(docs: DataFrame, entries: str, pieces: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Stored batches of aligned documents; a batch has about `BATCH_BYTES` bytes of text, or one longer document."""
    ship(docs.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, made = _aligner(entries, pieces), None
        for batch in rows:
            names = batch.column(0)
            made = made or _Batch(names.type)
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), _TEXTS):
                some = texts[at : at + _TEXTS]
                for i, found in enumerate(encode(some, entries, pieces)):
                    size = len(some[i])
                    if made.rows and (made.size + size > BATCH_BYTES or made.rows == BATCH_ROWS):
                        yield made.out()
                        made = _Batch(names.type)
                    made.add(names[at + i].as_py(), found, size, aligner)
        if made is not None and made.rows:
            yield made.out()

    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
    return stored(rows.mapInArrow(run, _BATCH).withColumn("batch", F.monotonically_increasing_id()))


def pair_counts(batches: DataFrame) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold a pair, and whether no pair with its second id is held by more."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for i in range(batch.num_rows):
                sides = [pa.array(np.frombuffer(batch.column(c)[i].as_py(), np.int64)) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays(sides, ["pair", "n"])

    named = batches.select("pairs", "counts").mapInArrow(run, "pair long, n long")
    counted = named.groupBy("pair").agg(F.sum("n").alias("n"))
    # a window holds one second id: as many rows as the first vocabulary at most
    most = F.max("n").over(Window.partitionBy(F.col("pair").bitwiseAND((1 << _BITS) - 1)))
    return counted.select("pair", "n", (F.col("n") == most).alias("best"))


def score(batches: DataFrame, counts: DataFrame, id_type: str) -> DataFrame:
    """A row per document: its links, those whose pair is the best of its second id, and the sum of their counts."""

    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for i in range(batch.num_rows):
                pairs = np.frombuffer(batch.column(1)[i].as_py(), np.int64)
                number = np.full(len(pairs), batch.column(0)[i].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(pairs)], ["batch", "pair"])

    def answer(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for i in range(batch.num_rows):
                docs, sizes, held, found = (batch.column(c)[i] for c in range(4))
                yield _scored(docs.as_py(), np.frombuffer(sizes.as_py(), np.int32), held.as_py(), found)

    asked = batches.select("batch", "pairs").mapInArrow(ask, "batch long, pair long")
    told = asked.join(counts, "pair").groupBy("batch").agg(F.collect_list(F.struct("pair", "n", "best")).alias("found"))
    # the batches hold all documents, and the answers grow with them: neither is broadcast
    whole = batches.select("batch", "docs", "sizes", "held").join(told.hint("merge"), "batch", "left")
    return whole.select("docs", "sizes", "held", "found").mapInArrow(
        answer,
        f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    )


def _scored(docs: bytes, sizes: np.ndarray, held: bytes, found: pa.ListScalar) -> pa.RecordBatch:
    table = pa.ipc.open_stream(docs).read_all()
    total = int(sizes.sum())
    n = best = np.zeros(0, np.int64)
    if total:
        pairs = found.values.field("pair").to_numpy()
        order = np.argsort(pairs)
        index = np.frombuffer(pa.decompress(held, 4 * total, "zstd", asbytes=True), np.int32)
        n = found.values.field("n").to_numpy()[order][index]
        best = found.values.field("best").to_numpy(zero_copy_only=False)[order][index].astype(np.int64)
    # sums of each window, then of the windows of each document
    ends = np.cumsum(sizes)
    sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], ends])]) for x in (n, best)]
    windows = [np.frombuffer(blob, np.int32) for blob in table.column("windows").to_pylist()]
    n_sum, n_best = (pa.array([int(x[w].sum()) for w in windows], pa.int64()) for x in sums)
    groups = table.column("n_groups")
    columns = [*(table.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")), groups, n_best, n_sum, table.column("groups_sha256")]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], names)


def align(docs: DataFrame, entries: str, pieces: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `entries` and `pieces` are the files of a byte-level and of a piece tokenizer on the
    executors. The first encodes a space and the text, the second the text, before which it puts
    a space itself. Null and empty texts, and those whose tokens' bytes are not a space and the
    text, have no tokens: zeros, and an empty digest. Tokens end together at most once in a
    byte, so a group has one link. Null and repeated ids are documents of their own, repeated rows count
    each time, other columns are ignored, an empty table gives no rows. A text is encoded whole, in one task.
    """
    batches = link(docs, entries, pieces, id_column, text_column)
    counts = stored(pair_counts(batches))
    kind = docs.select(id_column).schema[0].dataType.simpleString()
    return score(batches, counts, kind)
