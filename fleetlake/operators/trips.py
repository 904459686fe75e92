"""The canonical trip: one shape for every fleet."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.timing import minutes_between, month_text, year_text
from fleetlake.model import FILE_MONTH, SOURCE_FILE, Fleet


def canonical(trusted: DataFrame, fleet: Fleet) -> DataFrame:
    """A trusted table as canonical trips, with the event-time columns added."""
    shared = trusted.select(
        F.lit(fleet.name).alias("trip_type"),
        F.col("VendorID").alias("vendor_id"),
        F.col(fleet.pickup).alias("pickup_datetime"),
        F.col(fleet.dropoff).alias("dropoff_datetime"),
        "passenger_count",
        "total_amount",
        *FILE_MONTH,
        SOURCE_FILE,
    )
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    day = F.to_date(pickup)
    return shared.select(
        "*",
        minutes_between(pickup, dropoff).alias("trip_duration_minutes"),
        year_text(day).alias("pickup_year"),
        month_text(day).alias("pickup_month"),
        F.hour(pickup).alias("pickup_hour"),
        day.alias("pickup_date"),
    )


def all_fleets(trusted: Mapping[Fleet, DataFrame]) -> DataFrame:
    """Canonical trips of every fleet; columns must agree by name."""
    frames = [canonical(frame, fleet) for fleet, frame in trusted.items()]
    return reduce(DataFrame.unionByName, frames)
