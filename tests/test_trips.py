from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlake.functions.timing import event_range, minutes_between, year_text
from fleetlake.model import GREEN, YELLOW
from fleetlake.operators.trips import all_fleets, canonical

COLUMNS = [
    "trip_type", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
    "total_amount", "ref_year", "ref_month", "_source_file", "trip_duration_minutes",
    "pickup_year", "pickup_month", "pickup_hour", "pickup_date",
]


def trusted(spark, fleet, pickup, dropoff):
    schema = (
        "VendorID bigint, passenger_count double, total_amount double, "
        f"{fleet.pickup} timestamp, {fleet.dropoff} timestamp, "
        "ref_year string, ref_month string, _source_file string, _ingested_at timestamp"
    )
    row = (1, 2.0, 18.5, pickup, dropoff, "2023", "05", "f.parquet", dt.datetime(2024, 1, 1))
    return spark.createDataFrame([row], schema)


def test_canonical_shape_and_derived_columns(spark):
    start = dt.datetime(2031, 12, 31, 23, 47)
    frame = canonical(trusted(spark, YELLOW, start, start + dt.timedelta(minutes=41)), YELLOW)
    assert frame.columns == COLUMNS
    row = frame.first()
    assert row.trip_type == "yellow" and row.vendor_id == 1
    assert row.trip_duration_minutes == 41.0
    assert (row.pickup_year, row.pickup_month, row.pickup_hour) == ("2031", "12", 23)
    assert row.pickup_date == dt.date(2031, 12, 31)
    kinds = dict(frame.dtypes)
    assert kinds["pickup_hour"] == "int" and kinds["trip_duration_minutes"] == "double"


def test_fleets_unite(spark):
    yellow = trusted(spark, YELLOW, dt.datetime(2029, 2, 28, 22), dt.datetime(2029, 3, 1, 1, 15))
    green = trusted(spark, GREEN, dt.datetime(2030, 9, 4, 6), dt.datetime(2030, 9, 4, 6, 7))
    both = all_fleets({YELLOW: yellow, GREEN: green})
    assert both.columns == COLUMNS
    assert sorted((r.trip_type, r.trip_duration_minutes) for r in both.collect()) == [
        ("green", 7.0),
        ("yellow", 195.0),
    ]


def test_missing_pickup_leaves_the_derived_columns_null(spark):
    row = canonical(trusted(spark, GREEN, None, dt.datetime(2023, 5, 1)), GREEN).first()
    derived = COLUMNS[COLUMNS.index("trip_duration_minutes") :]
    assert [row[name] for name in derived] == [None] * 5


@pytest.mark.parametrize(
    ("start", "end", "minutes"),
    [
        ("2023-01-01 00:00:00.9", "2023-01-01 00:00:01.1", 1 / 60),
        ("2023-01-01 00:00:00.1", "2023-01-01 00:00:00.9", 0.0),
        ("1969-12-31 23:59:58.5", "1969-12-31 23:59:59.5", 1 / 60),
        ("2023-01-02 00:00:00", "2023-01-01 00:00:00", -1440.0),
    ],
)
def test_duration_counts_whole_seconds(spark, start, end, minutes):
    frame = spark.createDataFrame([(start, end)], "a string, b string").select(
        minutes_between(F.col("a").cast("timestamp"), F.col("b").cast("timestamp")).alias("m")
    )
    assert frame.first().m == pytest.approx(minutes)


def test_duration_of_timestamps_without_zone(spark):
    frame = spark.sql(
        "SELECT timestamp_ntz'2023-01-01 00:00:00' a, timestamp_ntz'2023-01-01 00:45:00' b"
    )
    assert frame.select(minutes_between(F.col("a"), F.col("b"))).first()[0] == 45.0


def test_year_text_keeps_four_digits(spark):
    days = spark.sql("SELECT explode(array(date'0987-03-01', date'2090-12-31')) AS d")
    assert [r[0] for r in days.select(year_text(F.col("d"))).collect()] == ["0987", "2090"]


@pytest.mark.parametrize(
    ("start", "end", "months"),
    [
        ("2022-08-01", "2022-09-01", 1),
        ("2022-08-01", "2022-08-01 00:00:00.000001", 1),
        ("2021-12-31", "2022-02-01 00:00:01", 3),
    ],
)
def test_event_range_prunes_month_directories(spark, plan, tmp_path, start, end, months):
    path = str(tmp_path / "fact")
    frame = spark.sql(
        "SELECT explode(sequence(timestamp'2021-01-01', timestamp'2024-12-31', "
        "interval 1 day)) AS pickup_datetime"
    ).select(
        "pickup_datetime",
        F.date_format("pickup_datetime", "yyyy").alias("pickup_year"),
        F.date_format("pickup_datetime", "MM").alias("pickup_month"),
    )
    frame.coalesce(1).write.partitionBy("pickup_year", "pickup_month").parquet(path)
    fact = spark.read.schema(frame.schema).parquet(path)
    found = fact.where(event_range(start, end))
    assert found.count() == fact.where(
        (F.col("pickup_datetime") >= start) & (F.col("pickup_datetime") < end)
    ).count()
    assert "PartitionFilters: [(" in plan(found)
    executed = found.select("pickup_datetime")
    executed.collect()
    scan = executed._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numPartitions").value() == months
    assert scan.metrics().apply("numFiles").value() == months
