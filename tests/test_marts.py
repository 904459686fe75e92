from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import marts
from fleetlake.operators.quantiles import exact_quantiles, value_counts
from fleetlake.plans import answers, exploration

FACT = (
    "trip_type string, pickup_year string, pickup_month string, pickup_hour int, "
    "pickup_date date, pickup_datetime timestamp, passenger_count double, total_amount double"
)


def fact(spark, *trips):
    return spark.createDataFrame(
        [
            (kind, f"{t:%Y}", f"{t:%m}", t.hour, t.date(), t, riders, amount)
            for kind, t, riders, amount in trips
        ],
        FACT,
    )


def test_monthly(spark):
    t = dt.datetime(2023, 5, 1, 8)
    frame = fact(spark, *(("yellow", t, r, a) for r, a in [(1.0, 10.0), (-1.0, 20.0), (None, 60.0)]))
    row = marts.monthly_mart(frame).first()
    assert row.asDict() == {
        "trip_type": "yellow",
        "pickup_year": "2023",
        "pickup_month": "05",
        "trip_count": 3,
        "total_revenue": 90.0,
        "avg_total_amount_per_trip": 30.0,
        "median_total_amount": 20.0,
        "total_passengers": 0.0,
        "reference_month": "2023-05",
    }


def test_hourly_counts_positive_passengers_and_days(spark):
    frame = fact(
        spark,
        ("green", dt.datetime(2023, 5, 1, 8), 2.0, 1.0),
        ("green", dt.datetime(2023, 5, 1, 8, 30), 0.0, 1.0),
        ("green", dt.datetime(2023, 5, 31, 8), 3.0, 1.0),
        ("green", dt.datetime(2023, 5, 2, 9), None, 1.0),
    )
    eight, nine = marts.hourly_mart(frame).orderBy("pickup_hour").collect()
    assert (eight.trip_count, eight.total_passengers, eight.trips_with_passenger_count) == (3, 5.0, 2)
    assert (eight.avg_passenger_count, eight.distinct_days) == (2.5, 2)
    assert (nine.trip_count, nine.total_passengers, nine.trips_with_passenger_count) == (1, None, 0)
    assert (nine.avg_passenger_count, nine.distinct_days) == (None, 1)


def test_days_are_counted_as_a_distinct_count_would(spark):
    """All days of a month, repeated, against Spark's own distinct count."""
    frame = spark.sql(
        "SELECT 'yellow' AS trip_type, timestampadd(HOUR, CAST(id * 7 AS INT), "
        "timestamp'2022-12-30') AS pickup_datetime FROM range(3000)"
    ).select(
        "*",
        F.date_format("pickup_datetime", "yyyy").alias("pickup_year"),
        F.date_format("pickup_datetime", "MM").alias("pickup_month"),
        F.hour("pickup_datetime").alias("pickup_hour"),
        F.to_date("pickup_datetime").alias("pickup_date"),
        F.lit(1.0).alias("passenger_count"),
    )
    ours = marts.hourly_mart(frame).select(*marts.HOUR_KEYS, "distinct_days")
    plain = frame.groupBy(*marts.HOUR_KEYS).agg(F.count_distinct("pickup_date").alias("d"))
    assert ours.exceptAll(plain).count() == 0 and ours.count() == plain.count()


def test_the_hourly_mart_shuffles_once(spark, plan):
    frame = fact(spark, ("green", dt.datetime(2023, 5, 1, 8), 2.0, 1.0))
    assert plan(marts.hourly_mart(frame), "simple").count("Exchange") == 1


def test_the_median_is_exact_in_a_large_month(spark):
    """More trips with different amounts than a sketch would keep apart."""
    frame = spark.range(25_001).selectExpr(
        "'green' AS trip_type", "'2031' AS pickup_year", "'07' AS pickup_month",
        "(id * 7919 % 25001) / 100D AS total_amount", "1D AS passenger_count",
    )
    assert marts.monthly_mart(frame).first().median_total_amount == 125.0


def test_answers_over_marts_equal_answers_over_the_fact(spark):
    rng = random.Random(7)
    start = dt.datetime(2023, 4, 28)
    frame = fact(
        spark,
        *(
            (
                rng.choice(["yellow", "green"]),
                start + dt.timedelta(minutes=rng.randrange(60 * 24 * 40)),
                rng.choice([None, -1.0, 0.0, 1.0, 2.0, 5.0]),
                round(rng.uniform(1, 90), 2),
            )
            for _ in range(3000)
        ),
    )
    monthly, hourly = marts.monthly_mart(frame), marts.hourly_mart(frame)
    ticket = answers.average_ticket(monthly).select("mes", "corridas", "ticket_medio")
    assert ticket.collect() == answers.average_ticket_from_fact(frame).collect()
    mart = answers.hourly_occupancy(hourly, "2023", "05").where("corridas > 0")
    direct = answers.hourly_occupancy_from_fact(frame, "2023-05-01", "2023-06-01")
    assert mart.collect() == direct.collect()
    total = monthly.agg(F.sum("trip_count")).first()[0]
    assert total == hourly.agg(F.sum("trip_count")).first()[0] == 3000


def test_hours_without_passengers_do_not_divide_by_zero(spark):
    frame = fact(spark, ("green", dt.datetime(2023, 5, 1, 8), 0.0, 1.0))
    hourly = marts.hourly_mart(frame)
    assert tuple(answers.hourly_occupancy(hourly, "2023", "05").first()) == ("08", 0, None)
    assert answers.volume_and_occupancy(hourly, "2023", "05").first().ocupacao_media is None
    assert tuple(answers.occupancy_by_fleet(hourly, "2023", "05").first()) == ("08", None, None)


def test_occupancy_is_a_ratio_of_sums(spark):
    t = dt.datetime(2023, 5, 1, 8)
    frame = fact(spark, *[("yellow", t, 1.0, 1.0)] * 9, ("green", t, 6.0, 1.0))
    row = answers.hourly_occupancy(marts.hourly_mart(frame), "2023", "05").first()
    assert row.media_passageiros_por_corrida == 1.5


VALUES = {
    "cents": lambda r: round(r.uniform(-50, 300), 2),
    "one value mostly": lambda r: 10.0 if r.random() < 0.7 else r.uniform(0, 100),
    "wide": lambda r: math.copysign(10 ** r.uniform(-5, 300), r.random() - 0.5),
    "dense": lambda r: 100.0 + r.random() * 1e-7,
    "special": lambda r: r.choice([float("inf"), float("-inf"), float("nan"), 0.0, -0.0, 1.0]),
}


@pytest.mark.parametrize("kind", VALUES)
@pytest.mark.parametrize("size", [1, 7, 1000])
def test_quantiles_against_sorting(spark, kind, size):
    rng = random.Random(size)
    data = [(rng.choice("ab") if size > 1 else "a", VALUES[kind](rng)) for _ in range(size)]
    frame = spark.createDataFrame([*data, ("a", None)], "g string, v double")
    shares = {"low": 0.01, "mid": 0.5, "high": 0.99, "top": 1.0}

    def expected(values):
        ordered = sorted(values, key=lambda v: (math.isnan(v), v))
        at = [ordered[max(1, math.ceil(s * len(ordered))) - 1] for s in shares.values()]
        return repr([v + 0.0 for v in at])

    found = exact_quantiles(value_counts(frame, "v"), shares).first()
    assert repr([v + 0.0 for v in found]) == expected([v for _, v in data])
    grouped = exact_quantiles(value_counts(frame, "v", ["g"]), shares, ["g"])
    for row in grouped.collect():
        values = [v for g, v in data if g == row.g]
        assert repr([v + 0.0 for v in tuple(row)[1:]]) == expected(values)


def test_quantiles_of_a_null_group_and_of_nothing(spark):
    frame = spark.createDataFrame([(None, 1.0), (None, 3.0)], "g string, v double")
    found = exact_quantiles(value_counts(frame, "v", ["g"]), {"m": 0.5}, ["g"]).collect()
    assert [tuple(r) for r in found] == [(None, 1.0)]
    nothing = exploration.amount_quantiles(
        frame.where("false").withColumnRenamed("v", "total_amount")
    )
    assert set(nothing.first()) == {None}


def test_quantiles_read_their_input_once(spark, plan, tmp_path):
    path = str(tmp_path / "amounts")
    spark.range(1000).select((F.col("id") / 7).alias("total_amount")).write.parquet(path)
    frame = exploration.amount_quantiles(spark.read.parquet(path))
    frame.collect()
    final = plan(frame, "simple").split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and final.count("ReusedExchange") == 5
    assert "CartesianProduct" not in final and "NestedLoop" not in final
