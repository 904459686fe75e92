"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks.

Two fingerprints that differ in two bits at most agree in two of four 16-bit blocks,
so close pairs meet in a join on one of six pairs of blocks and are verified there.
Equal fingerprints are one class before anything is paired. Where few fingerprints
share two blocks, the join verifies pairs inside the join; where many do, they are
compared in square cells of bounded size that report only a spanning set of links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import components, ship, stored

PAIRED = 32
CELL = 2048
_PAIRS = ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """Bits set in over half of the XXH64 hashes of the word shingles; zero without a word."""
    parts = text.translate(_LOWER).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    n = max(1, len(parts) - words + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(starts, ends[-n:].tolist())])
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 19):
        counts += np.unpackbits(np.frombuffer(hashes[at : at + (1 << 19)], np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and fingerprint (the 64 bits as a signed long) of every row; a null text is empty."""
    ship(docs.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            bits = [fingerprint(t.as_buffer().to_pybytes()) for t in batch.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(bits, np.uint64).view(np.int64))], ["doc_id", "fingerprint"]
            )

    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fingerprint long")


def _cell_links(distance: int):
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        left = group.loc[group["side"] != 1, "fingerprint"].to_numpy().view(np.uint64)
        right = group.loc[group["side"] != 0, "fingerprint"].to_numpy().view(np.uint64)
        nodes, slot = np.unique(np.concatenate([left, right]), return_inverse=True)
        root = np.arange(len(nodes))
        for at in range(0, len(left), 256):
            near = np.bitwise_count(left[at : at + 256, None] ^ right[None, :]) <= distance
            a, b = np.nonzero(near)
            a, b = slot[a + at], slot[b + len(left)]
            while True:
                low = np.minimum(root[a], root[b])
                old = root.copy()
                np.minimum.at(root, root[a], low)
                np.minimum.at(root, root[b], low)
                root = root[root]
                if (old == root).all() and (root[a] == root[b]).all():
                    break
        linked = np.flatnonzero(root != np.arange(len(nodes)))
        return pd.DataFrame({"a": nodes[linked].view(np.int64), "b": nodes[root[linked]].view(np.int64)})

    return compare


def links(distinct: DataFrame, distance: int = 2) -> DataFrame:
    """Edges (a, b) that connect just what pairs of fingerprints within `distance` bits connect.

    `distinct` has one column, fingerprint, without repeats or nulls; `distance` is two at most.
    """
    if not 0 <= distance <= 2:
        raise ValueError("four blocks serve distances up to two")
    value = F.col("fingerprint")
    blocks = [F.shiftrightunsigned(value, 16 * i).bitwiseAND(0xFFFF) for i in range(4)]
    keyed = distinct.select(
        value,
        F.explode(
            F.array(
                *[
                    F.lit(k * (1 << 32)) + blocks[i] * (1 << 16) + blocks[j]
                    for k, (i, j) in enumerate(_PAIRS)
                ]
            )
        ).alias("key"),
    )
    sizes = stored(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    shared = stored(keyed.join(sizes, "key"))
    few, many = shared.where(F.col("n") <= PAIRED), shared.where(F.col("n") > PAIRED)
    other = few.select("key", value.alias("b"))
    pairs = few.select("key", value.alias("a")).join(
        other, (few["key"] == other["key"]) & (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    )
    # a member of part p stands on one side of the cells (p, q) and on the other of (q, p); p = q has both
    parts = F.ceil(F.col("n") / CELL).cast("int")
    member = many.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
    placed = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = placed.select(
        "key",
        "fingerprint",
        F.least("part", "other").alias("row"),
        F.greatest("part", "other").alias("col"),
        F.when(F.col("part") == F.col("other"), 2).when(F.col("part") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    spanned = cells.groupBy("key", "row", "col").applyInPandas(_cell_links(distance), "a long, b long")
    return pairs.select("a", "b").union(spanned)


def _grouped(marked: DataFrame, distance: int) -> DataFrame:
    """(fingerprint, root, component_id): the group of each fingerprint, and the least id in the group."""
    classes = stored(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    roots = components(links(classes.select("fingerprint"), distance))
    rooted = stored(classes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint")))
    least = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    return stored(rooted.join(least, "root").select("fingerprint", "root", "component_id"))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", distance: int = 2
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints within `distance` bits link; component_id is the smallest id that links
    reach. Null, empty and blank texts have fingerprint zero and link like others. Null
    ids are kept and never name a component unless all its ids are null; repeated rows
    stay. Only ids and texts are read; an empty table gives no rows. A text is read whole, by
    the task that has its row, a word at a time.
    """
    marked = stored(fingerprints(docs, id_column, text_column))
    named = _grouped(marked, distance).select("fingerprint", "component_id")
    return marked.join(named, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def first_of_groups(marked: DataFrame, distance: int = 2) -> DataFrame:
    """(doc_id, fingerprint): the row that names its group, once for each group with an id.

    `marked` has doc_id and fingerprint, as a long, of every row. Groups are told apart by their
    links, not by ids: different documents may share an id.
    """
    marked = marked.select("doc_id", "fingerprint")
    named = marked.join(_grouped(marked, distance), "fingerprint").where("doc_id = component_id")
    return named.groupBy("root").agg(F.min("doc_id").alias("doc_id"), F.min("fingerprint").alias("fingerprint")).drop("root")


def with_fingerprint(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """All rows and columns, and the fingerprint of each row's text as a signed long; a null text is empty."""
    ship(docs.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = batch.column(batch.schema.get_field_index(text_column)).fill_null("").cast(pa.large_binary())
            bits = np.array([fingerprint(t.as_buffer().to_pybytes()) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits)], [*batch.schema.names, "fingerprint"])

    return docs.mapInArrow(run, StructType([*docs.schema, StructField("fingerprint", LongType())]))
