"""Trips derived from the generated order tables.

Line items play the yellow fleet and orders the green one. Every value follows
from the row's keys, so the same trips can be written in SQL elsewhere. Keys
spread the faults: each rule fails on some rows at every scale.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.timing import month_text, year_text
from fleetlake.model import FILE_MONTH, GREEN, SOURCE_FILE, YELLOW, Fleet, Limits
from fleetlake.sinks.tables import unsorted_writes, whole_timestamps

LIMITS = Limits(window_start="1996-01-01", window_end="2001-01-01")
FOCUS = ("1998", "05")
FOCUS_RANGE = ("1998-05-01", "1998-06-01")


def _keyed(spark: SparkSession, directory: str, fleet: Fleet) -> DataFrame:
    """id, base time, vendor and amount of the source row, and its file name."""
    table = {YELLOW.name: "lineitem", GREEN.name: "orders"}[fleet.name]
    rows = spark.read.parquet(f"{directory.rstrip('/')}/{table}.parquet")
    if fleet == YELLOW:
        number = F.col("l_orderkey") * 7 + F.col("l_linenumber")
        base, vendor = F.col("l_shipdate"), F.col("l_suppkey")
        amount = F.floor("l_extendedprice") / F.lit(100.0)
    else:
        number = F.col("o_orderkey") + 1
        base, vendor = F.col("o_orderdate"), F.col("o_custkey")
        amount = F.floor(F.col("o_totalprice") / F.lit(10.0)) / F.lit(100.0)
    return rows.select(
        number.alias("id"),
        base.cast("timestamp").alias("base"),
        (vendor % 2 + 1).cast("bigint").alias("VendorID"),
        amount.alias("amount"),
        F.col("_metadata.file_name").alias(SOURCE_FILE),
    )


def _later(moment: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(moment) + seconds.cast("bigint") * 1_000_000)


def sample_trips(spark: SparkSession, directory: str, fleet: Fleet) -> DataFrame:
    """Trips of one fleet in the trusted layout, without the ingestion time."""
    number = F.col("id")

    def every(n: int) -> Column:
        return number % n == 0

    start = _later(F.col("base"), 60 * ((number * 13) % 1440))
    length = (
        F.when(every(211), F.lit(90_000))
        .when(every(199), F.lit(0))
        .when(every(193), F.lit(-300))
        .when(every(197), F.lit(30))
        .otherwise(60 * (1 + (number * 37) % 180))
    )
    riders = F.when(every(13), F.lit(None)).when(number % 9 == 8, F.lit(-1.0))
    paid = F.when(every(307), F.lit(None)).when(every(101), -F.col("amount"))
    file_day = F.to_date(
        F.when(every(500), _later(F.col("base"), F.lit(31 * 86_400))).otherwise(F.col("base"))
    )
    return (
        _keyed(spark, directory, fleet)
        .select("*", start.alias("start"), file_day.alias("file_day"))
        .select(
            "VendorID",
            riders.otherwise((number % 9).cast("double")).alias("passenger_count"),
            paid.when(every(103), F.lit(0.0)).otherwise(F.col("amount")).alias(
                "total_amount"
            ),
            F.when(~every(997), F.col("start")).alias(fleet.pickup),
            F.when(~every(991), _later(F.col("start"), length)).alias(fleet.dropoff),
            SOURCE_FILE,
            year_text(F.col("file_day")).alias(FILE_MONTH[0]),
            month_text(F.col("file_day")).alias(FILE_MONTH[1]),
        )
    )


def drifting_files(trips: DataFrame, fleet: Fleet) -> list[DataFrame]:
    """The trips as published files, whose columns change over the years.

    Before 1998 the fee is a whole number; from 1998 on it is fractional under
    another spelling, with the vendor as double and one column more.
    """
    month = [F.col(name) for name in FILE_MONTH]
    times = (fleet.pickup, fleet.dropoff)
    vendor, riders = F.col("VendorID"), F.col("passenger_count")
    early = trips.where(F.col(FILE_MONTH[0]) < "1998").select(
        "VendorID",
        *times,
        riders,
        (vendor % 2).alias("RatecodeID"),
        vendor.alias("airport_fee"),
        "total_amount",
        *month,
    )
    late = trips.where(F.col(FILE_MONTH[0]) >= "1998").select(
        vendor.cast("double").alias("VendorID"),
        *times,
        riders,
        (vendor % 2).alias("RatecodeID"),
        (vendor * 1.25).alias("Airport_fee"),
        (vendor + 10).alias("PULocationID"),
        "total_amount",
        *month,
    )
    return [early, late]


def land(spark: SparkSession, directory: str, fleet: Fleet, root: str) -> None:
    """Write the drifting files below ``root``, laid out by file month.

    The parts share no month, so landing again replaces what is there.
    """
    for part in drifting_files(sample_trips(spark, directory, fleet), fleet):
        writer = (
            part.hint("rebalance", *FILE_MONTH)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*FILE_MONTH)
        )
        with whole_timestamps(spark), unsorted_writes(spark):
            writer.parquet(f"{root.rstrip('/')}/{fleet.name}")


def published_names(trips: dict[Fleet, DataFrame]) -> DataFrame:
    """A file name for every trip: its month's, and some that follow no pattern."""

    def names(fleet: Fleet, rows: DataFrame) -> DataFrame:
        ending = F.when(F.col("VendorID") == 1, ".parquet").otherwise(".parquet.part")
        month = F.concat_ws("-", *FILE_MONTH)
        return rows.select(F.concat(F.lit(f"{fleet.file_stem}_"), month, ending).alias("name"))

    return reduce(DataFrame.unionByName, (names(f, rows) for f, rows in trips.items()))
