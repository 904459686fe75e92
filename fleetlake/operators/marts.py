"""The two aggregate marts, and the states the monthly one is made of.

Group counts are bounded by fleets x months (x 24 hours), so after map-side
aggregation only that many rows per task are shuffled, however skewed a month is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH_KEYS = ("trip_type", "pickup_year", "pickup_month")
HOUR_KEYS = (*MONTH_KEYS, "pickup_hour")

# The monthly mart's columns after its keys, as published.
MONTHLY_COLUMNS = (
    "trip_count",
    "total_revenue",
    "avg_total_amount_per_trip",
    "median_total_amount",
    "total_passengers",
    "reference_month",
)

#: Size of a quantile state: exact up to as many amounts, half a megabyte to one beyond.
SKETCH_SIZE = 32_768
#: Error of a rank beyond that, as a share of all ranks, in 99 of 100 states.
RANK_ERROR = 2.296 / SKETCH_SIZE**0.9723


def monthly_states(fact: DataFrame) -> DataFrame:
    """What a month's figures are made of, per fleet and event month: sums that add and a
    quantile state that merges. One scan and one shuffle."""
    amount = F.col("total_amount")
    return fact.groupBy(*MONTH_KEYS).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.count(amount).alias("amounts"),
        F.sum(amount).alias("total_revenue"),
        F.sum("passenger_count").alias("total_passengers"),
        F.kll_sketch_agg_double(amount, SKETCH_SIZE).alias("amount_state"),
    )


def merged_states(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """States of larger groups, from stored ones and not from trips."""
    return states.groupBy(*by).agg(
        *(F.sum(name).alias(name) for name in ("trip_count", "amounts", "total_revenue", "total_passengers")),
        F.kll_merge_agg_double("amount_state").alias("amount_state"),
    )


def quantile_of(state: str, share: float) -> Column:
    """The value at rank ``ceil(share * n)`` of a state; NULL of an empty one. NaN is not counted."""
    value = F.kll_sketch_get_quantile_double(state, F.lit(share))
    return F.when(F.kll_sketch_get_n_double(state) > 0, value)


def quantiles_of_states(states: DataFrame, shares: Mapping[str, float], by: Sequence[str]) -> DataFrame:
    """Quantiles of the amount per group of stored states, a column per share's name."""
    columns = (quantile_of("amount_state", share).alias(name) for name, share in shares.items())
    return merged_states(states, by).select(*by, *columns)


def monthly_of_states(states: DataFrame) -> DataFrame:
    """The monthly mart, a projection of its states."""
    return states.select(
        *MONTH_KEYS,
        "trip_count",
        "total_revenue",
        F.try_divide("total_revenue", "amounts").alias("avg_total_amount_per_trip"),
        quantile_of("amount_state", 0.5).alias("median_total_amount"),
        "total_passengers",
        F.concat_ws("-", "pickup_year", "pickup_month").alias("reference_month"),
    ).select(*MONTH_KEYS, *MONTHLY_COLUMNS)


def monthly_mart(fact: DataFrame) -> DataFrame:
    """Volume, revenue, ticket and median per fleet and event month.

    The median is exact in months of up to ``SKETCH_SIZE`` trips; beyond, its rank is
    off by ``RANK_ERROR`` of the month's trips at most, in 99 of 100 months.
    """
    return monthly_of_states(monthly_states(fact))


def hourly_mart(fact: DataFrame) -> DataFrame:
    """Trips and passengers per fleet, event month and hour of day.

    The group fixes the month, so its distinct dates are its distinct days of
    the month: one bit each in an integer. That keeps a single shuffle where a
    distinct count would add a second one.
    """
    riders = F.when(F.col("passenger_count") > 0, F.col("passenger_count"))
    day_bit = F.expr("shiftleft(1, dayofmonth(pickup_date) - 1)")
    return fact.groupBy(*HOUR_KEYS).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum(riders).alias("total_passengers"),
        F.count(riders).alias("trips_with_passenger_count"),
        F.avg(riders).alias("avg_passenger_count"),
        F.coalesce(F.bit_count(F.bit_or(day_bit)), F.lit(0))
        .cast("bigint")
        .alias("distinct_days"),
    )
