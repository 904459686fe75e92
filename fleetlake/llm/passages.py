"""Batches of documents, and the exchange that finds which of their hashes recur elsewhere.

Documents are stored once as compressed batches of bounded size. A batch says which
hashes it holds, each once with what matters about it, so that a passage in a third
of all documents is one entry per batch and no group grows with its copies. Entries
go by range of hash to buckets, where a reducer compares them and answers every batch
with one code per entry, in the order of the entries. The batch makes the same entries
again later and reads the answer beside them: no hash or position travels back.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

BATCH_BYTES = 3_000_000
BATCH_ROWS = 200_000
BUCKET_ENTRIES = 2_000_000
MOST_PARTITIONS = 20_000
OUT_ROWS = 1024
OUT_BYTES = 4_000_000
_IPC = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
_ANSWERS = "batch long, bucket int, codes binary"


def _blob(table: pa.Table) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema, options=_IPC) as writer:
        writer.write_table(table)
    return sink.getvalue()


def unpack(blob: bytes) -> tuple[pa.Array, list[bytes]]:
    """Ids and UTF-8 texts of a batch."""
    table = pa.ipc.open_stream(blob).read_all()
    return table.column(0).combine_chunks(), table.column(1).cast(pa.large_binary()).to_pylist()


def batches(docs: DataFrame, id_column: str, text_column: str, size: int = BATCH_BYTES) -> DataFrame:
    """(batch, blob, n_bytes, n_docs): all rows in stored batches of about `size` bytes of text.

    A null text is stored as empty; a longer document is a batch of its own, or with empty
    ones before it. A batch has `BATCH_ROWS` rows at most.
    """

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        n = n_rows = 0

        def out() -> pa.RecordBatch:
            table = pa.concat_tables(held)
            return pa.RecordBatch.from_pydict(
                {"blob": [_blob(table)], "n_bytes": [n], "n_docs": [table.num_rows]},
                schema=pa.schema([("blob", pa.binary()), ("n_bytes", pa.int64()), ("n_docs", pa.int64())]),
            )

        for batch in rows:
            table = pa.Table.from_batches([batch])
            lengths = pa.compute.binary_length(table.column(1)).to_numpy()
            start = 0
            for i, length in enumerate(lengths):
                if n and n + length > size or n_rows == BATCH_ROWS:
                    held.append(table.slice(start, i - start))
                    yield out()
                    held, n, n_rows, start = [], 0, 0, i
                n += int(length)
                n_rows += 1
            held.append(table.slice(start))
        if n_rows:
            yield out()

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    made = rows.mapInArrow(cut, "blob binary, n_bytes long, n_docs long")
    return stored(made.select(F.monotonically_increasing_id().alias("batch"), "blob", "n_bytes", "n_docs"))


def splits(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of equal ranges starts among sorted 64-bit keys, and the end."""
    width = (1 << 64) // buckets
    edges = np.array([min(i * width, (1 << 64) - 1) for i in range(1, buckets)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def pack_sorted(keys: np.ndarray, drop_bits: int) -> bytes:
    """Sorted distinct keys as differences of as few bytes as hold them.

    Keys are multiples of 1 << drop_bits. A few wide gaps are bridged by a key that is
    not there; bridges are marked by position at the front.
    """
    if not len(keys):
        return b""
    values = keys >> np.uint64(drop_bits)
    gaps = np.diff(values, prepend=np.uint64(0))
    gaps[0] = 0
    n = len(values)
    for width in range(1, 9):
        top = (1 << (8 * width)) - 1
        wide = np.flatnonzero(gaps > np.uint64(top)) if width < 8 else np.zeros(0, np.int64)
        if len(wide) <= n // 64:
            break
    exact = gaps[wide].copy()
    gaps[wide] = 0
    low = gaps.view(np.uint8).reshape(n, 8)[:, :width]
    head = np.array([n, int(values[0]), width, len(wide)], dtype=np.uint64)
    return head.tobytes() + wide.astype(np.uint64).tobytes() + exact.tobytes() + np.ascontiguousarray(low.T).tobytes()


def unpack_sorted(blob: bytes, drop_bits: int) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    n, first, width, n_wide = (int(x) for x in np.frombuffer(blob, np.uint64, 4))
    at = 32
    wide = np.frombuffer(blob, np.uint64, n_wide, at).astype(np.int64)
    exact = np.frombuffer(blob, np.uint64, n_wide, at + 8 * n_wide)
    at += 16 * n_wide
    whole = np.zeros((n, 8), np.uint8)
    whole[:, :width] = np.frombuffer(blob, np.uint8, n * width, at).reshape(width, n).T
    gaps = whole.reshape(-1).view(np.uint64).copy()
    gaps[wide] = exact
    gaps[0] = first
    return np.cumsum(gaps, dtype=np.uint64) << np.uint64(drop_bits)


def per_batch(frame: DataFrame, make: Callable, schema: str, arguments: tuple[str, ...]) -> DataFrame:
    """make(row values...) yields tuples of `schema`, or record batches, for every row.

    One row is in memory at a time. Tuples go out together, up to `OUT_ROWS` or `OUT_BYTES`.
    """
    made_schema = _arrow(schema)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            columns = [pa.array(values, field.type) for values, field in zip(zip(*held), made_schema)]
            return pa.RecordBatch.from_arrays(columns, schema=made_schema)

        for batch in rows:
            for i in range(batch.num_rows):
                values = [batch.column(batch.schema.get_field_index(a))[i].as_py() for a in arguments]
                for made in make(*values):
                    if isinstance(made, pa.RecordBatch):
                        yield made
                        continue
                    held.append(made)
                    size += sum(len(x) for x in made if isinstance(x, bytes))
                    if len(held) == OUT_ROWS or size > OUT_BYTES:
                        yield out()
                        held, size = [], 0
        if held:
            yield out()

    return frame.select(*arguments).mapInArrow(run, schema)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (p.split() for p in schema.split(", "))])


def answers(entries: DataFrame, buckets: int, compare: Callable[[list[bytes]], list[np.ndarray]]) -> DataFrame:
    """One answer per batch and bucket: compare() gets the payloads of one bucket.

    `entries` has batch, bucket and payload; compare() returns an array of small codes
    for each payload. Codes are kept as bytes, compressed.
    """

    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("batch")
        codes = compare(list(group["payload"]))
        return pd.DataFrame(
            {
                "batch": group["batch"].to_numpy(),
                "bucket": group["bucket"].to_numpy(),
                "codes": [pa.compress(c.astype(np.uint8).tobytes(), "zstd", asbytes=True) for c in codes],
            }
        )

    # as many partitions as buckets: comparing costs more than its bytes say
    return entries.repartition(min(buckets, MOST_PARTITIONS), "bucket").groupBy("bucket").applyInPandas(reduce, _ANSWERS)


def with_answers(stored_batches: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """The batches with their answers as an array of (bucket, codes); at most one per bucket.

    Answers grow with the batches, so neither side is ever broadcast.
    """
    gathered = found.groupBy("batch").agg(F.collect_list(F.struct("bucket", "codes")).alias(name))
    return stored_batches.join(gathered.hint("merge"), "batch", "left")


def codes_of(answer: list[dict] | None, sizes: np.ndarray) -> np.ndarray:
    """The codes of a batch's entries in order; sizes are the entries of each bucket."""
    out = np.zeros(int(sizes.sum()), np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for one in answer or ():
        b = one["bucket"]
        n = int(sizes[b])
        if n:
            out[starts[b] : starts[b] + n] = np.frombuffer(
                pa.decompress(one["codes"], n, "zstd", asbytes=True), np.uint8
            )
    return out


def pack_wide(high: np.ndarray, low: np.ndarray, repeated: np.ndarray) -> bytes:
    """Distinct 128-bit hashes in order of their high half, and whether each one recurs in its batch."""
    n = len(high)
    return n.to_bytes(4, "little") + low.tobytes() + repeated.astype(np.uint8).tobytes() + pack_sorted(high, 0)


def compare_wide(payloads: list[bytes]) -> list[np.ndarray]:
    """For each hash of `pack_wide`, 1 where it recurs in its batch or comes from another one too."""
    highs, lows, repeated = [], [], []
    for p in payloads:
        n = int.from_bytes(p[:4], "little")
        lows.append(np.frombuffer(p, np.uint64, n, 4))
        repeated.append(np.frombuffer(p, np.uint8, n, 4 + 8 * n))
        highs.append(unpack_sorted(p[4 + 9 * n :], 0))
    high, low = np.concatenate(highs), np.concatenate(lows)
    order = np.lexsort((low, high))
    h, w = high[order], low[order]
    same = (h[1:] == h[:-1]) & (w[1:] == w[:-1])
    found = np.concatenate(repeated).copy()
    # every member of a run of equal hashes has an equal neighbour, so all are marked
    found[order[1:][same]] = 1
    found[order[:-1][same]] = 1
    return np.split(found, np.cumsum([len(x) for x in highs])[:-1])


def distinct_wide(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, as high and low halves, and the entry of each given one."""
    order = np.lexsort((low, high))
    h, w = high[order], low[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])])[: len(h)]
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(new) - 1
    return h[new], w[new], entry


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words (an invertible finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
