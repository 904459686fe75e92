from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlake.functions import buckets
from fleetlake.model import REASONS, YELLOW
from fleetlake.plans import answers, exploration


@pytest.mark.parametrize(
    ("scale", "value", "label"),
    [
        (buckets.DURATION, None, "0 · nula"),
        (buckets.DURATION, -0.5, "1 · negativa"),
        (buckets.DURATION, 0.0, "2 · zerada"),
        (buckets.DURATION, 0.5, "3 · menos de 1 min"),
        (buckets.DURATION, 1.0, "4 · 1 a 5 min"),
        (buckets.DURATION, 59.9, "7 · 30 a 60 min"),
        (buckets.DURATION, 1439.9, "9 · 2 a 24 h"),
        (buckets.DURATION, 1440.0, "A · mais de 24 h"),
        (buckets.PASSENGERS, -1.0, "1 · negativo"),
        (buckets.PASSENGERS, 0.0, "2 · zero"),
        (buckets.PASSENGERS, 4.0, "3 · 1 a 4"),
        (buckets.PASSENGERS, 6.0, "4 · 5 a 6"),
        (buckets.PASSENGERS, 6.5, "5 · acima de 6"),
        (buckets.AMOUNT, None, "0 · nulo"),
        (buckets.AMOUNT, 9.99, "3 · até 10"),
        (buckets.AMOUNT, 10.0, "4 · 10 a 25"),
        (buckets.AMOUNT, 999.99, "7 · 100 a 1.000"),
        (buckets.AMOUNT, 1000.0, "8 · acima de 1.000"),
        (buckets.AMOUNT, float("nan"), "8 · acima de 1.000"),
    ],
)
def test_bucket_edges(spark, scale, value, label):
    frame = spark.createDataFrame([(value,)], "v double")
    assert frame.select(scale.label(scale.ordinal(F.col("v")))).first()[0] == label


def test_buckets_need_a_label_each():
    with pytest.raises(ValueError, match="label"):
        buckets.Buckets(labels=("a", "b"), edges=(("<", 0.0),))


def test_histogram_shares_add_up(spark):
    frame = spark.createDataFrame([(a,) for a in [None, -1.0, 5.0, 5.0]], "total_amount double")
    found = [tuple(r) for r in exploration.amount_histogram(frame).collect()]
    assert found == [
        ("0 · nulo", 1, 25.0, None),
        ("1 · negativo", 1, 25.0, -1.0),
        ("3 · até 10", 2, 50.0, 10.0),
    ]


TRUSTED = (
    "VendorID bigint, passenger_count double, total_amount double, "
    "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
    "ref_year string, ref_month string"
)


def trusted(spark, *pickups, month=("2023", "01")):
    return spark.createDataFrame([(1, 1.0, 5.0, p, p, *month) for p in pickups], TRUSTED)


def test_event_months_include_missing_ones(spark):
    frame = trusted(spark, dt.datetime(2023, 1, 5), dt.datetime(2023, 1, 6), None)
    found = exploration.rows_by_event_month(frame, YELLOW).collect()
    assert [tuple(r) for r in found] == [("2023-01", 2), (None, 1)]


def test_misplaced_months(spark):
    pickups = [dt.datetime(2023, 1, 5), None, *[dt.datetime(2090, 7, 1)] * 2]
    found = exploration.misplaced_months(trusted(spark, *pickups), YELLOW).collect()
    assert [tuple(r) for r in found] == [("2023-01", "2090-07", 2)]


def test_misplaced_months_are_cut_in_a_fixed_order(spark):
    pickups = [dt.datetime(1990 + i, 1, 1) for i in range(40)]
    frame = trusted(spark, *pickups, month=("2031", "01"))
    first = exploration.misplaced_months(frame, YELLOW).collect()
    assert len(first) == 30
    assert [r.mes_do_pickup for r in first] == sorted(r.mes_do_pickup for r in first)
    assert first == exploration.misplaced_months(frame.repartition(7), YELLOW).collect()


def test_sensitivity_adds_back_only_the_purely_negative(spark):
    fact = spark.createDataFrame([("yellow", 10.0), ("green", 99.0)], "trip_type string, total_amount double")
    rejects = spark.createDataFrame(
        [
            ("yellow", -4.0, ["total_amount_negativo"]),
            ("yellow", -7.0, ["duracao_nao_positiva", "total_amount_negativo"]),
            ("yellow", None, ["total_amount_nulo"]),
            ("green", -1.0, ["total_amount_negativo"]),
        ],
        f"trip_type string, total_amount double, {REASONS} array<string>",
    )
    found = [tuple(r) for r in answers.sensitivity(fact, rejects).collect()]
    assert found == [
        ("aprovadas (fato)", 1, 10.0, 10.0),
        ("aprovadas + negativos", 2, 3.0, 6.0),
    ]
    assert tuple(answers.sensitivity_change(fact, rejects).first()) == (-70.0, -40.0)


def test_quarantine_share_of_nothing(spark):
    empty = spark.range(0)
    assert tuple(exploration.quarantine_share(empty, empty).first()) == (0, 0, None)


def test_weighted_and_simple_ticket(spark):
    monthly = spark.createDataFrame(
        [("yellow", 100.0, 10, 10.0), ("yellow", 60.0, 2, 30.0), ("green", 1.0, 1, 1.0)],
        "trip_type string, total_revenue double, trip_count bigint, "
        "avg_total_amount_per_trip double",
    )
    assert tuple(answers.weighted_and_simple_ticket(monthly).first()) == (13.33, 20.0)
    revenue = answers.average_monthly_revenue(monthly).first()
    assert tuple(revenue) == (2, 160.0, 80.0, 6.0)
