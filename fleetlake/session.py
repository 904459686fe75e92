"""Session settings the layers are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Event times are wall-clock values; the session must not shift them.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution sizes shuffles and splits a hot month on rebalance.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Files of a few hundred MB instead of the 64 MB default. Input too small for
    # that is still spread over all cores (parallelismFirst stays on).
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Upper bound for adaptive execution to coalesce from.
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(name: str = "fleetlake", **overrides: str) -> SparkSession:
    """A session with these settings; ``**{"spark.key": "value"}`` overrides them."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
