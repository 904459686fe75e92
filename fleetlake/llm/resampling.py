"""Resampling documents toward a target distribution by hashed word features.

An untrained splitter of the `tokenizers` library (one regular expression, no vocabulary)
cuts ASCII-lowered texts into words with offsets. Windows over pairs of offsets, the start of
a word and the end of the same or the next one, are the features; their CRC-32 gives buckets.
Histograms over all documents and over the target texts give each bucket a gain, the log of
its share in the target over its share in the documents. A document's weight is the mean
gain of its features, and noise from the hash of its id turns the largest sums into a sample
drawn without replacement.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import ship, stored

BUCKETS = 10_000
WORDS = r"[0-9a-z\x{80}-\x{10FFFF}]+"
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
_TEXTS = 256


@lru_cache(maxsize=2)
def _splitter(words: str):
    """A tokenizer whose only work is to split; its model knows no word."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    splitter = Tokenizer(models.WordLevel({"": 0}, unk_token=""))
    splitter.pre_tokenizer = pre_tokenizers.Split(Regex(words), "removed", invert=True)
    return splitter


def feature_buckets(text: str, buckets: int = BUCKETS, words: str = WORDS) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every single word and then of every two neighbours.

    Only A to Z are lowered. Two words are joined by one space, whatever parts them.
    """
    lowered = text.encode().lower()
    text = lowered.decode()
    offsets = _splitter(words).encode(text, add_special_tokens=False).offsets
    found = [text[start:end].encode() for start, end in offsets]
    if not found:
        return 0, np.zeros(0, np.uint16)
    # a window's CRC goes on from that of its first word
    single = list(map(crc32, found))
    double = map(crc32, [b" " + word for word in found[1:]], single)
    hashes = np.fromiter(chain(single, double), np.uint32, 2 * len(found) - 1)
    return len(found), (hashes % np.uint32(buckets)).astype(np.uint16)


def features(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", buckets: int = BUCKETS, words: str = WORDS
) -> DataFrame:
    """(doc_id, n_words, n_features, buckets): a row per document; the buckets are little-endian unsigned 16-bit numbers.

    A null text has no words. Whole texts are read, whatever their length.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are numbered in 16 bits")
    ship(docs.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for at in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(at, _TEXTS)
                made = [feature_buckets(text, buckets, words) for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([n for n, _ in made], pa.int64()),
                        pa.array([len(b) for _, b in made], pa.int64()),
                        pa.array([b.astype("<u2").tobytes() for _, b in made], pa.binary()),
                    ],
                    ["doc_id", "n_words", "n_features", "buckets"],
                )

    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, buckets binary")


def histogram(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all features; every partition adds its own up first."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in rows:
            for blob in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(blob, "<u2"), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["bucket", "n"])

    counted = found.select("buckets").mapInArrow(run, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of every bucket, from two histograms: floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))), in doubles.

    As many numbers as buckets come to the driver, whatever the tables hold.
    """
    s, t = ([0.0] * buckets for _ in range(2))
    for counts, found in ((s, documents), (t, target)):
        for row in found.collect():
            counts[row["bucket"]] = float(row["n"])
    all_s, all_t = sum(s) + buckets, sum(t) + buckets
    return [math.floor(1000 * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s, t)]


def weigh(found: DataFrame, table: list[int]) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean of the gains of a document's features, 0 without any."""
    gain = np.array(table, np.int64)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            sums = [int(gain[np.frombuffer(blob, "<u2")].sum()) for blob in batch.column(3).to_pylist()]
            means = [s // n if n else 0 for s, n in zip(sums, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(means, pa.int64())], ["doc_id", "n_words", "n_features", "weight"]
            )

    kind = found.schema["doc_id"].dataType.simpleString()
    made = found.select("doc_id", "n_words", "n_features", "buckets")
    return made.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(id_column: str = "doc_id", seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from the SHA-256 of seed and id; a null id is empty text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """All rows with `rank`: 1, 2, 3 by falling score, then id, of the drawn, null of the others.

    Floor(percent * N / 100) of the N rows with at least `least_words` words are drawn. Rows are
    dealt by ranges of score and id, and a number of their own, so that neither equal scores
    nor repeated ids gather in one task; ranges are stored, a row's place in its range is its
    number, and only the number of rows of each range is summed. Rows equal in score and id are ranked one after the
    other, null ids first.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("row")]
    known = stored(scored.withColumn("row", F.monotonically_increasing_id()))
    fit = known.where(F.col("n_words") >= least_words)
    n = fit.count() * percent // 100
    # number of the range, and place in it, in the upper and lower bits
    dealt = stored(fit.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    part, within = F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each range
    sizes = dealt.groupBy(part).agg(F.count("*").alias("size")).select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    rank = F.col("before") + within + 1
    columns = scored.columns
    ranked = dealt.withColumn("part", part).join(F.broadcast(sizes), "part")
    drawn = ranked.withColumn("rank", F.when(rank <= n, rank).cast("long")).select(*columns, "rank")
    rest = known.where(~(F.coalesce(F.col("n_words"), F.lit(0)) >= least_words)).select(*columns)
    return drawn.union(rest.withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    words: str = WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): one row per document, `rank` null where it is not drawn.

    Null and empty texts have no words, weight 0, and are never drawn where words are asked for.
    Repeated rows are documents of their own; equal scores go by id, a null id first; a null id is
    hashed as empty text. An empty target has no features, and every bucket the gain of its
    rarity alone; an empty table gives no rows. Other columns are ignored. Histograms cover
    all documents; the gains, one number per bucket, go through the driver.
    """
    found = stored(features(docs, id_column, text_column, buckets, words))
    sample = features(target.select(F.lit(0).alias("doc_id"), F.col(target_column).alias("text")), buckets=buckets, words=words)
    weighed = weigh(found, gains(histogram(found, buckets), histogram(sample, buckets), buckets))
    scored = weighed.withColumn("score", F.col("weight") + noise("doc_id", seed))
    return draw(scored, percent, least_words)
