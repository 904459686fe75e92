"""From raw documents to training sequences, in five stages that are each stored.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as
Parquet and read again as the next one's documents. All but the last return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm import mixing, packing, pii, quality, simhash
from fleetlake.llm.common import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects, repeated ones each time.

    A null or empty text has too few words and goes; null ids and sources stay; texts of
    any length are measured whole. Further columns are left behind.
    """
    return quality.keep(docs.select(COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document that names its group, of each group of near duplicates, and once where it is repeated.

    Documents without an id stay, as no id tells which of them names a group.
    """
    marked = stored(simhash.with_fingerprint(docs.select(COLUMNS)))
    first = stored(simhash.first_of_groups(marked))
    named = marked.join(first, ["doc_id", "fingerprint"], "left_semi").dropDuplicates(["doc_id", "fingerprint"])
    return named.select(COLUMNS).union(marked.where("doc_id IS NULL").select(COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, and their new length; a null text becomes empty."""
    clean = pii.redact(docs.select(COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture, by number of the file that each task writes and place in it.

    A reader gets files in an order of its own; `in_stored_order` brings this one back.
    """
    mixed = mixing.mix(docs.select(COLUMNS))
    return mixed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select(COLUMNS)


def in_stored_order(docs: DataFrame) -> DataFrame:
    """Rows of a stored table in the order they were written: by number of file, and place in it.

    Null, empty and repeated rows have places like any other; no rows give no rows.
    """
    name = F.col("_metadata.file_name")
    order = {
        "_file": F.regexp_extract(name, r"part-(\d+)", 1).cast("long"),
        "_next": F.regexp_extract(name, r"-c(\d+)", 1).cast("long"),
        "_row": F.col("_metadata.row_index"),
    }
    placed = docs.select(*COLUMNS, *[place.alias(key) for key, place in order.items()])
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select(COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents of power-of-two length, each a sequence; sequence_id rises in the order of the mixture.

    A null or empty text is its end token alone, a repeated row packs again, null ids stay null.
    """
    import public_tokenizers

    return packing.pack(in_stored_order(docs), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mixture),
    ("packing", sequences),
]

#: SQL cannot express the fingerprints of the second stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
