"""Profiles of the unfiltered tables: what the quality rules are based on.

Months are grouped as dates and histograms as small integers; text is made from
the few groups that remain.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions import buckets
from fleetlake.functions.timing import minutes_between
from fleetlake.model import FILE_MONTH, SOURCE_FILE, Fleet
from fleetlake.operators.quantiles import exact_quantiles, value_counts
from fleetlake.sources.landing import ref_month_of


#: Registers of a distinct-count state, as a power of two: 4,096.
DISTINCT_BITS = 12


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def rows_by_file_month(frames: Mapping[Fleet, DataFrame], count: str) -> DataFrame:
    """Rows per fleet and file month. Both keys are partition columns on disk."""
    counted = [
        frame.groupBy(*FILE_MONTH)
        .agg(F.count(F.lit(1)).alias(count))
        .select(F.lit(fleet.name).alias("trip_type"), *FILE_MONTH, count)
        for fleet, frame in frames.items()
    ]
    return _stack(counted).orderBy("trip_type", *FILE_MONTH)


def rows_by_source_file(raw: DataFrame) -> DataFrame:
    """Lineage check: which files each month came from."""
    keys = (*FILE_MONTH, SOURCE_FILE)
    return raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas")).orderBy(*keys)


def lineage_by_month(frames: Mapping[Fleet, DataFrame]) -> DataFrame:
    """Rows of each file month by the month that their file's path names, and by having a file."""
    counted = []
    for fleet, raw in frames.items():
        year, month = ref_month_of(F.col(SOURCE_FILE))
        files = rows_by_source_file(raw).select(
            *FILE_MONTH, year.alias("path_year"), month.alias("path_month"), (F.length(SOURCE_FILE) > 0).alias("has_file"), "linhas"
        )
        summed = files.groupBy(*FILE_MONTH, "path_year", "path_month", "has_file").agg(F.sum("linhas").alias("linhas"))
        counted.append(summed.select(F.lit(fleet.name).alias("trip_type"), "*"))
    return _stack(counted).orderBy("trip_type", *FILE_MONTH)


def column_profile(trusted: DataFrame, fleet: Fleet) -> DataFrame:
    rows = F.count(F.lit(1))
    amount, riders = F.col("total_amount"), F.col("passenger_count")
    return trusted.agg(
        rows.alias("total_corridas"),
        (rows - F.count("VendorID")).alias("vendorid_nulos"),
        F.count_distinct("VendorID").alias("vendorid_distintos"),
        (rows - F.count(riders)).alias("passenger_count_nulos"),
        F.min(riders).alias("passenger_count_min"),
        F.max(riders).alias("passenger_count_max"),
        (rows - F.count(amount)).alias("total_amount_nulos"),
        F.round(F.min(amount), 2).alias("total_amount_min"),
        F.round(F.max(amount), 2).alias("total_amount_max"),
        F.round(F.avg(amount), 2).alias("total_amount_medio"),
        F.min(fleet.pickup).alias("pickup_mais_antigo"),
        F.max(fleet.pickup).alias("pickup_mais_recente"),
    )


def profile_states(trusted: DataFrame, fleet: Fleet) -> DataFrame:
    """The profile's measures per file month, as states that merge: one scan, one shuffle.

    Distinct vendors are a HyperLogLog state, which counts small sets exactly; beyond, its
    standard error is 0.8 / sqrt(2 ** DISTINCT_BITS).
    """
    amount, riders = F.col("total_amount"), F.col("passenger_count")
    return trusted.groupBy(*FILE_MONTH).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("VendorID").alias("vendors"),
        F.hll_sketch_agg("VendorID", DISTINCT_BITS).alias("vendor_state"),
        F.count(riders).alias("riders"),
        F.min(riders).alias("riders_min"),
        F.max(riders).alias("riders_max"),
        F.count(amount).alias("amounts"),
        F.min(amount).alias("amount_min"),
        F.max(amount).alias("amount_max"),
        F.sum(amount).alias("amount_sum"),
        F.min(fleet.pickup).alias("pickup_min"),
        F.max(fleet.pickup).alias("pickup_max"),
    )


def profile_of_states(states: DataFrame) -> DataFrame:
    """``column_profile`` of all file months from their states."""
    rows = F.coalesce(F.sum("rows"), F.lit(0))
    vendors = F.hll_sketch_estimate(F.hll_union_agg("vendor_state"))

    def missing(name: str) -> Column:
        return rows - F.coalesce(F.sum(name), F.lit(0))

    return states.agg(
        rows.alias("total_corridas"),
        missing("vendors").alias("vendorid_nulos"),
        F.coalesce(vendors, F.lit(0)).alias("vendorid_distintos"),
        missing("riders").alias("passenger_count_nulos"),
        F.min("riders_min").alias("passenger_count_min"),
        F.max("riders_max").alias("passenger_count_max"),
        missing("amounts").alias("total_amount_nulos"),
        F.round(F.min("amount_min"), 2).alias("total_amount_min"),
        F.round(F.max("amount_max"), 2).alias("total_amount_max"),
        F.round(F.try_divide(F.sum("amount_sum"), F.sum("amounts")), 2).alias("total_amount_medio"),
        F.min("pickup_min").alias("pickup_mais_antigo"),
        F.max("pickup_max").alias("pickup_mais_recente"),
    )


def rows_by_event_month(trusted: DataFrame, fleet: Fleet) -> DataFrame:
    return (
        trusted.groupBy(F.trunc(fleet.pickup, "month").alias("first_day"))
        .agg(F.count(F.lit(1)).alias("corridas"))
        .select(F.date_format("first_day", "yyyy-MM").alias("mes_do_pickup"), "corridas")
        .orderBy(F.desc("corridas"), "mes_do_pickup")
    )


def misplaced_months(trusted: DataFrame, fleet: Fleet, top: int = 30) -> DataFrame:
    """Largest groups whose event month is not their file month.

    Ties in the count are broken by the months, so the cut is deterministic.
    """
    file_month = F.concat_ws("-", *FILE_MONTH)
    return (
        trusted.groupBy(*FILE_MONTH, F.trunc(fleet.pickup, "month").alias("first_day"))
        .agg(F.count(F.lit(1)).alias("corridas"))
        .select(
            file_month.alias("mes_do_arquivo"),
            F.date_format("first_day", "yyyy-MM").alias("mes_do_pickup"),
            "corridas",
        )
        .where("mes_do_arquivo <> mes_do_pickup")
        .orderBy(F.desc("corridas"), "mes_do_arquivo", "mes_do_pickup")
        .limit(top)
    )


def _histogram(
    values: DataFrame, scale: buckets.Buckets, *measures: Column
) -> DataFrame:
    """Rows per bucket with their share. The window sees one row per bucket."""
    everything = Window.partitionBy()
    share = F.col("corridas") * F.lit(100.0) / F.sum("corridas").over(everything)
    return (
        values.groupBy(scale.ordinal(F.col("value")).alias("ordinal"))
        .agg(F.count(F.lit(1)).alias("corridas"), *measures)
        .withColumn("faixa", scale.label(F.col("ordinal")))
        .withColumn("pct", F.round(share, 4))
        .drop("ordinal")
        .orderBy("faixa")
    )


def duration_histogram(frames: Mapping[Fleet, DataFrame]) -> DataFrame:
    minutes = [
        frame.select(
            minutes_between(F.col(fleet.pickup), F.col(fleet.dropoff)).alias("value")
        )
        for fleet, frame in frames.items()
    ]
    return _histogram(_stack(minutes), buckets.DURATION).select("faixa", "corridas", "pct")


def passenger_histogram(frames: Mapping[Fleet, DataFrame]) -> DataFrame:
    riders = [f.select(F.col("passenger_count").alias("value")) for f in frames.values()]
    return _histogram(_stack(riders), buckets.PASSENGERS).select("faixa", "corridas", "pct")


def amount_histogram(trusted: DataFrame) -> DataFrame:
    amounts = trusted.select(F.col("total_amount").alias("value"))
    total = F.round(F.sum("value"), 2).alias("soma")
    return _histogram(amounts, buckets.AMOUNT, total).select(
        "faixa", "corridas", "pct", "soma"
    )


def histograms(frames: Mapping[Fleet, DataFrame]) -> DataFrame:
    """The three histograms of each fleet from one scan of it.

    Rows are counted by the three ordinals together, 594 groups of a fleet at most;
    grouping sets then add these few up by each ordinal, and no trip is repeated.
    """
    scales = {"duration": buckets.DURATION, "passengers": buckets.PASSENGERS, "amount": buckets.AMOUNT}
    counted = []
    for fleet, frame in frames.items():
        values = {
            "duration": minutes_between(F.col(fleet.pickup), F.col(fleet.dropoff)),
            "passengers": F.col("passenger_count"),
            "amount": F.col("total_amount"),
        }
        ordinals = [scales[name].ordinal(value).alias(name) for name, value in values.items()]
        rows = frame.groupBy(*ordinals).agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("amounts"))
        counted.append(rows.select(F.lit(fleet.name).alias("trip_type"), "*"))
    sets = [["trip_type", F.col(name)] for name in scales]
    summed = (
        _stack(counted)
        .groupingSets(sets, "trip_type", *scales)
        .agg(F.sum("n").alias("corridas"), F.round(F.sum("amounts"), 2).alias("soma"))
    )
    each = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, scale in scales.items():
        there = F.col(name).isNotNull()
        each = F.when(there, name).otherwise(each[0]), F.when(there, scale.label(F.col(name))).otherwise(each[1])
    share = F.col("corridas") * F.lit(100.0) / F.sum("corridas").over(Window.partitionBy("trip_type", "histogram"))
    return (
        summed.select("trip_type", each[0].alias("histogram"), each[1].alias("faixa"), "corridas", "soma")
        .withColumn("pct", F.round(share, 4))
        .orderBy("trip_type", "histogram", "faixa")
    )


def amount_quantiles(trusted: DataFrame) -> DataFrame:
    """Quantiles beside the mean: how far the tail pulls it.

    Exact, unlike a sketch over one global group, and with no task holding more
    than counts: see ``exact_quantiles``.
    """
    shares = {
        "p01": 0.01, "p25": 0.25, "mediana": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99,
    }
    counts = value_counts(trusted, "total_amount")
    mean = F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum("n"))
    both = exact_quantiles(counts, shares).unionByName(
        counts.agg(mean.alias("media")), allowMissingColumns=True
    )
    names = (*shares, "media")
    return both.agg(*(F.round(F.max(name), 2).alias(name) for name in names))


def sorted_report(report: DataFrame) -> DataFrame:
    return report.select(
        "rule_name",
        "blocking",
        "rows_evaluated",
        "rows_failed",
        "failure_pct",
        "description",
    ).orderBy(F.desc("blocking"), F.desc("rows_failed"), "rule_name")


def quarantine_share(fact: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Accepted and rejected rows and the rejected share; one row per source is
    all that meets in the final aggregate."""

    def rows(frame: DataFrame, name: str) -> DataFrame:
        return frame.agg(F.count(F.lit(1)).alias(name))

    both = rows(fact, "aprovadas").unionByName(
        rows(quarantine, "em_quarentena"), allowMissingColumns=True
    )
    kept, held = F.sum("aprovadas"), F.sum("em_quarentena")
    share = F.round(F.try_divide(held * F.lit(100.0), kept + held), 4)
    return both.agg(
        kept.alias("aprovadas"), held.alias("em_quarentena"), share.alias("pct_quarentena")
    )


def trusted_sample(trusted: DataFrame, fleet: Fleet, rows: int = 10) -> DataFrame:
    """Sample of a trusted table; ordered, so that it is the same every time."""
    columns = (
        "VendorID", "passenger_count", "total_amount", fleet.pickup, fleet.dropoff,
    )
    return trusted.select(*columns).orderBy(*columns).limit(rows)
