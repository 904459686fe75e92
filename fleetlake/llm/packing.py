"""Packing by power-of-two decomposition.

A document's tokens, with an end token, are cut into pieces whose lengths are powers of
two: as many of the longest as fit, then the binary digits of the rest. Each piece is a
sequence of its own, pieces of equal length are one bucket, and batches are drawn from
one bucket; so no sequence crosses documents and none has padding.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

LONGEST = 2048
END = 1
REMEMBERED = 500_000
_STOPS = ".,;:!?"
# A single space between two characters that are not white space begins a token of a
# byte-level vocabulary, whatever stands around it.
_CUT = regex.compile(r"(?<=\S) (?=\S)")


# Fixed value: the pre-tokenisation pattern of the byte-level vocabulary.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones stand for
    themselves, the others follow from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The tokenizer, and a faster encoder of its vocabulary."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    alphabet, special = _byte_of(), set(whole.get_added_tokens_decoder())
    ranks = {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items() if i not in special}
    merged = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"]["".join(m)] for m in merged]
    if order != sorted(order):
        raise ValueError("ids of the vocabulary do not follow its merges")
    return whole, tiktoken.Encoding("packing", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


class _Encoder:
    """Ids of texts. Texts are cut where tokens begin anyway: before single spaces, around
    single line ends, and between a word and the stops after it. Ids of cuts are remembered,
    a bounded number of them."""

    def __init__(self, path: str) -> None:
        self.whole, self.fast = _tokenizer(path)
        self.spaced: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}

    def plain(self, text: str) -> bytes:
        if len(text) > 2000:  # rare: a long run without a cut
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self.fast.encode_ordinary(text)).tobytes()

    def cut(self, text: str, space: bool) -> bytes:
        memory = self.spaced if space else self.bare
        if text in memory:
            return memory[text]
        core = text.rstrip(_STOPS)
        if "\n" in text and not any(not x or x[0].isspace() or x[-1].isspace() for x in text.split("\n")):
            first, *rest = text.split("\n")
            end = self.cut("\n", False) if text != "\n" else b""
            return end.join([self.cut(first, space), *[self.cut(x, False) for x in rest]])
        if core != text and core.isalpha():
            found = self.cut(core, space) + self.cut(text[len(core) :], False)
        else:
            found = self.plain(" " + text if space else text)
        if len(memory) < REMEMBERED:  # what comes often comes early
            memory[text] = found
        return found

    def ids(self, text: str) -> bytes:
        first, *parts = text.split(" ")
        memory = self.spaced
        new = set(parts).difference(memory)
        # a remembered cut neither starts nor ends with white space, so only new ones may
        if first[-1:].isspace() or not first or any(not p or p[0].isspace() or p[-1].isspace() for p in new):
            first, *parts = _CUT.split(text)
            new = set(parts).difference(memory)
        lines = {p: self.cut(p, True) for p in new}
        known = [memory[p] if p in memory else lines[p] for p in parts] if lines else [memory[p] for p in parts]
        return self.cut(first, False) + b"".join(known)


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def token_ids(texts: list[str], path: str) -> list[bytes]:
    """Token ids of each text as little-endian unsigned 32-bit numbers, special strings as plain text."""
    encoder = _encoder(path)
    return [encoder.ids(text) for text in texts]


def pieces(n: int, longest: int = LONGEST) -> list[int]:
    """Lengths of the pieces of n tokens, longest first."""
    lengths = [longest] * (n // longest)
    rest = n % longest
    return lengths + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", longest: int = LONGEST, end: int = END
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset.

    `vocabulary` is the path of a tokenizer file on the executors; `longest` is a power
    of two. Null and empty texts have the end token alone. Null and repeated ids are
    documents of their own. sequence_id is unique and follows the order of input
    partitions, offset is always zero. Other columns are ignored; an empty table gives
    no rows. `bucketed` orders pieces for batches of one length.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece is a power of two")
    ship(docs.sparkSession)
    closing = int(end).to_bytes(4, "little")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            names = batch.column(0)
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 200):
                index, columns = [], ([], [], [], [])
                for i, ids in enumerate(token_ids(texts[at : at + 200], vocabulary)):
                    ids += closing
                    start, total = 0, len(ids) // 4
                    for length in pieces(total, longest):
                        index.append(at + i)
                        for column, value in zip(columns, (start, length, ids[4 * start : 4 * (start + length)], total)):
                            column.append(value)
                        start += length
                yield pa.RecordBatch.from_arrays(
                    [
                        names.take(pa.array(index, pa.int64())),
                        *[pa.array(c, pa.binary() if k == 2 else pa.int64()) for k, c in enumerate(columns)],
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens"],
                )

    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    made = rows.mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long")
    return made.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def bucketed(packed: DataFrame, path: str) -> None:
    """Write sequences by bucket of equal length, shuffled within it, without a hot writer."""
    packed.withColumn("bucket", F.col("length")).repartition("bucket", F.pmod(F.xxhash64("sequence_id"), F.lit(256))).write.partitionBy(
        "bucket"
    ).parquet(path)
