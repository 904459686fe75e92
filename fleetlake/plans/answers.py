"""The business answers, from the marts and again from the fact.

Column names in the results are fixed values: readers of the published answers
rely on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.timing import event_range, two_digits
from fleetlake.model import REASONS

APPROVED = "aprovadas (fato)"
WITH_NEGATIVES = "aprovadas + negativos"
NEGATIVE_RULE = "total_amount_negativo"


def _fleet(name: str) -> Column:
    return F.col("trip_type") == name


def _month(year: str, month: str) -> Column:
    return (F.col("pickup_year") == year) & (F.col("pickup_month") == month)


def _ratio(top: Column, bottom: Column) -> Column:
    """NULL instead of a division by zero."""
    return F.try_divide(top, bottom)


def average_ticket(monthly: DataFrame, fleet: str = "yellow") -> DataFrame:
    """Question 1, reading A: ticket per trip, by month."""
    return (
        monthly.where(_fleet(fleet))
        .select(
            F.col("reference_month").alias("mes"),
            F.col("trip_count").alias("corridas"),
            F.round("avg_total_amount_per_trip", 2).alias("ticket_medio"),
            F.round("median_total_amount", 2).alias("mediana"),
            F.round("total_revenue", 2).alias("receita_total"),
        )
        .orderBy("mes")
    )


def average_ticket_from_fact(fact: DataFrame, fleet: str = "yellow") -> DataFrame:
    """The same without the mart, as its proof. Months become text per group."""
    return (
        fact.where(_fleet(fleet))
        .groupBy(F.trunc("pickup_datetime", "month").alias("first_day"))
        .agg(
            F.count(F.lit(1)).alias("corridas"),
            F.round(F.avg("total_amount"), 2).alias("ticket_medio"),
        )
        .select(
            F.date_format("first_day", "yyyy-MM").alias("mes"), "corridas", "ticket_medio"
        )
        .orderBy("mes")
    )


def average_monthly_revenue(monthly: DataFrame, fleet: str = "yellow") -> DataFrame:
    """Question 1, reading B: what the fleet takes in an average month."""
    return monthly.where(_fleet(fleet)).agg(
        F.count(F.lit(1)).alias("meses_considerados"),
        F.round(F.sum("total_revenue"), 2).alias("receita_do_periodo"),
        F.round(F.avg("total_revenue"), 2).alias("receita_media_mensal"),
        F.round(F.avg("trip_count"), 0).alias("corridas_media_mensal"),
    )


def weighted_and_simple_ticket(monthly: DataFrame, fleet: str = "yellow") -> DataFrame:
    """Average over trips against average over months."""
    return monthly.where(_fleet(fleet)).agg(
        F.round(_ratio(F.sum("total_revenue"), F.sum("trip_count")), 2).alias(
            "ticket_ponderado"
        ),
        F.round(F.avg("avg_total_amount_per_trip"), 2).alias("ticket_simples"),
    )


def _scenarios(fact: DataFrame, quarantine: DataFrame, fleet: str) -> DataFrame:
    """Count, known amounts and their sum per scenario, not rounded.

    Each source is reduced to one row before its row is repeated per scenario;
    repeating the trips instead would double the fact.
    """
    only_negative = F.array_contains(REASONS, NEGATIVE_RULE) & (F.size(REASONS) == 1)
    both = F.array(F.lit(APPROVED), F.lit(WITH_NEGATIVES))
    one = F.array(F.lit(WITH_NEGATIVES))

    def reduced(rows: DataFrame, scenarios: Column) -> DataFrame:
        return rows.agg(
            F.count(F.lit(1)).alias("n"),
            F.count("total_amount").alias("known"),
            F.sum("total_amount").alias("amount"),
        ).select("*", F.explode(scenarios).alias("cenario"))

    parts = reduced(fact.where(_fleet(fleet)), both).unionByName(
        reduced(quarantine.where(_fleet(fleet) & only_negative), one)
    )
    return (
        parts.where("n > 0")
        .groupBy("cenario")
        .agg(
            F.sum("n").alias("corridas"),
            F.sum("known").alias("known"),
            F.sum("amount").alias("amount"),
        )
        .withColumn("ticket", _ratio(F.col("amount"), F.col("known")))
    )


def sensitivity(fact: DataFrame, quarantine: DataFrame, fleet: str = "yellow") -> DataFrame:
    """Question 1, reading C: what holding back negative amounts changes."""
    return (
        _scenarios(fact, quarantine, fleet)
        .select(
            "cenario",
            "corridas",
            F.round("ticket", 4).alias("ticket_medio"),
            F.round("amount", 2).alias("receita"),
        )
        .orderBy("cenario")
    )


def sensitivity_change(
    fact: DataFrame, quarantine: DataFrame, fleet: str = "yellow"
) -> DataFrame:
    """Change of ticket and revenue, in percent of the accepted trips alone."""

    def change(name: str) -> Column:
        base = F.max(F.when(F.col("cenario") == APPROVED, F.col(name)))
        other = F.max(F.when(F.col("cenario") == WITH_NEGATIVES, F.col(name)))
        return F.round(_ratio((other - base) * F.lit(100.0), base), 2)

    return _scenarios(fact, quarantine, fleet).agg(
        change("ticket").alias("variacao_ticket_pct"),
        change("amount").alias("variacao_receita_pct"),
    )


def hourly_occupancy(hourly: DataFrame, year: str, month: str) -> DataFrame:
    """Question 2, reading A: passengers per trip, by hour, over all fleets.

    A ratio of sums; averaging the fleets' averages would weigh them equally.
    """
    riders, trips = F.sum("total_passengers"), F.sum("trips_with_passenger_count")
    return (
        hourly.where(_month(year, month))
        .groupBy("pickup_hour")
        .agg(
            trips.alias("corridas"),
            F.round(_ratio(riders, trips), 4).alias("media_passageiros_por_corrida"),
        )
        .select(
            two_digits(F.col("pickup_hour")).alias("hora"),
            "corridas",
            "media_passageiros_por_corrida",
        )
        .orderBy("hora")
    )


def hourly_occupancy_from_fact(fact: DataFrame, start: str, end: str) -> DataFrame:
    """The same without the mart; hours with no counted passenger are absent."""
    return (
        fact.where(event_range(start, end) & (F.col("passenger_count") > 0))
        .groupBy(F.hour("pickup_datetime").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("corridas"),
            F.round(F.avg("passenger_count"), 4).alias("media_passageiros_por_corrida"),
        )
        .select(
            two_digits(F.col("hour")).alias("hora"),
            "corridas",
            "media_passageiros_por_corrida",
        )
        .orderBy("hora")
    )


def typical_day(hourly: DataFrame, year: str, month: str) -> DataFrame:
    """Question 2, reading B: passengers in that hour of a day with data."""
    riders, days = F.sum("total_passengers"), F.max("distinct_days")
    return (
        hourly.where(_month(year, month))
        .groupBy("pickup_hour")
        .agg(
            riders.alias("passageiros_no_mes"),
            days.alias("dias_com_dado"),
            F.round(_ratio(riders, days), 1).alias("passageiros_por_hora_dia_tipico"),
        )
        .select(
            two_digits(F.col("pickup_hour")).alias("hora"),
            "passageiros_no_mes",
            "dias_com_dado",
            "passageiros_por_hora_dia_tipico",
        )
        .orderBy("hora")
    )


def occupancy_by_fleet(
    hourly: DataFrame, year: str, month: str, fleets: tuple[str, ...] = ("yellow", "green")
) -> DataFrame:
    """Occupancy per hour, one column per fleet. The values are given, so the
    pivot needs no pass to find them."""
    return (
        hourly.where(_month(year, month))
        .groupBy("pickup_hour")
        .pivot("trip_type", list(fleets))
        .agg(F.round(F.max("avg_passenger_count"), 4))
        .select(two_digits(F.col("pickup_hour")).alias("hora"), *fleets)
        .orderBy("hora")
    )


def volume_and_occupancy(hourly: DataFrame, year: str, month: str) -> DataFrame:
    """Chart data, 24 rows at most: safe to take to the driver."""
    riders, trips = F.sum("total_passengers"), F.sum("trips_with_passenger_count")
    return (
        hourly.where(_month(year, month))
        .groupBy("pickup_hour")
        .agg(_ratio(riders, trips).alias("ocupacao_media"), trips.alias("corridas"))
        .orderBy("pickup_hour")
    )


def fact_month_sample(fact: DataFrame, year: str, month: str, rows: int = 100) -> DataFrame:
    """Sample of one month; ordered, so that it is the same every time."""
    columns = ("trip_type", "pickup_datetime", "passenger_count", "total_amount")
    return fact.where(_month(year, month)).select(*columns).orderBy(*columns).limit(rows)
