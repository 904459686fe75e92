"""The layers end to end on a small landing directory written here."""

from __future__ import annotations

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from fleetlake.model import EVENT_MONTH, FLEETS, GREEN, REASONS, YELLOW, Lake
from fleetlake.operators import quality
from fleetlake.plans import answers, exploration
from fleetlake.plans.pipeline import Pipeline
from fleetlake.sinks import tables


def publish(spark, root, fleet, month, trips):
    """One month's file; from March on under other types and spellings."""
    late = month >= 3
    rows = [
        (
            float(vendor) if late else vendor,
            pickup,
            dropoff,
            riders,
            amount,
            1.25 if late else 1,
        )
        for vendor, pickup, dropoff, riders, amount in trips
    ]
    number = "double" if late else "bigint"
    schema = (
        f"VendorID {number}, {fleet.pickup} timestamp, {fleet.dropoff} timestamp, "
        f"passenger_count double, total_amount double, "
        f"{'Airport_fee' if late else 'airport_fee'} {number}"
    )
    path = Lake(root).landing_month(fleet, 2023, month)
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)


def month_of_trips(rng, month, size=60):
    trips = []
    for _ in range(size):
        start = dt.datetime(2023, month, rng.randint(1, 28), rng.randrange(24), rng.randrange(60))
        end = start + dt.timedelta(minutes=rng.choice([-3, 0, 7, 20, 45, 3000]))
        start, end = rng.choice([start] * 20 + [None]), rng.choice([end] * 20 + [None])
        if start and rng.random() < 0.05:
            start = start.replace(year=rng.choice([2001, 2090]))
        amount = rng.choice([None, -5.0, 0.0] + [round(rng.uniform(3, 90), 2)] * 12)
        trips.append((rng.choice([1, 2]), start, end, rng.choice([None, 0.0, 1.0, 2.0]), amount))
    return trips


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root, rng = str(tmp_path_factory.mktemp("lake")), random.Random(3)
    lake = Lake(f"{root}/landing", prefix=f"p{uuid.uuid4().hex[:8]}_", location=f"{root}/tables")
    published = {}
    for fleet in FLEETS:
        for month in range(1, 6):
            published[fleet, month] = month_of_trips(rng, month)
            publish(spark, lake.landing, fleet, month, published[fleet, month])
    pipeline = Pipeline(spark, lake)
    pipeline.run()
    return pipeline, published


def content(frame, *without):
    return sorted((tuple(r) for r in frame.drop(*without).collect()), key=repr)


def test_raw_keeps_every_row_as_text(spark, built):
    pipeline, published = built
    for fleet in FLEETS:
        raw = spark.table(pipeline.lake.raw(fleet))
        kinds = dict(raw.dtypes)
        assert kinds.pop("_ingested_at") == "timestamp" and set(kinds.values()) == {"string"}
        assert raw.count() == sum(len(t) for (f, _), t in published.items() if f == fleet)
        vendors = {r.vendor_id for r in raw.where("ref_month = '04'").collect()}
        assert vendors <= {"1.0", "2.0"}


def test_trusted_is_typed_and_unfiltered(spark, built):
    pipeline, published = built
    for fleet in FLEETS:
        trusted = spark.table(pipeline.lake.trusted(fleet))
        assert {n: t for n, t in trusted.dtypes} == {
            n: kind for n, (_, kind) in fleet.contract().items()
        }
        expected = sorted(
            (trip for (f, _), trips in published.items() if f == fleet for trip in trips), key=repr
        )
        found = trusted.select(
            "VendorID", fleet.pickup, fleet.dropoff, "passenger_count", "total_amount"
        )
        assert content(found) == expected


def test_accepted_and_rejected_make_the_whole(spark, built):
    pipeline, _ = built
    lake, trips = pipeline.lake, pipeline.trips()
    fact, quarantine = spark.table(lake.fact), spark.table(lake.quarantine)
    both = fact.select(*trips.columns).unionByName(quarantine.drop(REASONS))
    assert content(both) == content(trips)
    assert quarantine.where(F.size(REASONS) == 0).count() == 0
    assert fact.where("pickup_year <> '2023'").count() == 0
    share = exploration.quarantine_share(fact, quarantine).first()
    assert share.aprovadas + share.em_quarentena == trips.count()


def test_stored_report_is_the_direct_report(spark, built):
    pipeline, _ = built
    stored = spark.table(pipeline.lake.report)
    direct = quality.rule_report(pipeline.trips(), quality.standard_rules(pipeline.limits))
    assert content(stored, "measured_at") == content(direct)
    assert stored.where("measured_at IS NULL").count() == 0
    blocking = exploration.sorted_report(stored).select("blocking", "rows_failed").collect()
    assert blocking == sorted(blocking, reverse=True)


def test_marts_answer_as_the_fact_does(spark, built):
    lake = built[0].lake
    fact, monthly, hourly = (spark.table(t) for t in (lake.fact, lake.monthly, lake.hourly))
    for fleet in ("yellow", "green"):
        ticket = answers.average_ticket(monthly, fleet).select("mes", "corridas", "ticket_medio")
        assert ticket.collect() == answers.average_ticket_from_fact(fact, fleet).collect()
    mart = answers.hourly_occupancy(hourly, "2023", "05").where("corridas > 0").collect()
    assert mart == answers.hourly_occupancy_from_fact(fact, "2023-05-01", "2023-06-01").collect()


def test_answers_from_the_stored_fact_prune(spark, built, plan):
    fact = spark.table(built[0].lake.fact)
    text = plan(answers.hourly_occupancy_from_fact(fact, "2023-05-01", "2023-06-01"))
    assert "PartitionFilters: [(" in text
    assert "GreaterThanOrEqual(pickup_datetime" in text
    assert "ReadSchema: struct<pickup_datetime:timestamp,passenger_count:double>" in text


def test_rules_reach_the_scan_of_the_trusted_tables(built, plan):
    pipeline, _ = built
    text = plan(quality.accepted(pipeline.trips(), quality.standard_rules(pipeline.limits)))
    for pushed in ("IsNotNull(total_amount)", "GreaterThanOrEqual(total_amount,0.0)"):
        assert text.count(pushed) == 2
    assert "LessThan(tpep_pickup_datetime,2023-06-01" in text
    assert "Exchange" not in text


def test_report_reads_few_columns(built, spark, plan):
    pipeline, _ = built
    report = quality.rule_report_from_quarantine(
        pipeline.trips(),
        spark.table(pipeline.lake.quarantine),
        quality.standard_rules(pipeline.limits),
    )
    text = plan(report)
    assert text.count("ReadSchema: struct<passenger_count:double>") == 2
    assert "ReadSchema: struct<_rejection_reasons:array<string>>" in text


def test_running_again_changes_nothing(spark, built):
    pipeline, _ = built
    lake = pipeline.lake
    names = [lake.raw(YELLOW), lake.trusted(GREEN), lake.fact, lake.quarantine, lake.monthly]
    names += [lake.hourly, lake.report]
    skip = ("_ingested_at", "measured_at")
    before = {name: content(spark.table(name), *skip) for name in names}
    pipeline.run()
    assert {name: content(spark.table(name), *skip) for name in names} == before


def test_one_month_again_leaves_the_others(spark, built, tmp_path_factory):
    """A landing with May only replaces May in raw and trusted, and nothing else."""
    pipeline, _ = built
    root = str(tmp_path_factory.mktemp("again"))
    trips = month_of_trips(random.Random(99), 5, size=7)
    publish(spark, f"{root}/landing", YELLOW, 5, trips)
    lake = pipeline.lake
    again = Pipeline(spark, Lake(f"{root}/landing", lake.prefix, lake.location))
    earlier = spark.table(lake.trusted(YELLOW)).where("ref_month < '05'")
    before = content(earlier)
    again.load_raw(YELLOW)
    again.load_trusted(YELLOW)
    after = spark.table(lake.trusted(YELLOW))
    assert content(after.where("ref_month < '05'"), "_ingested_at") == [
        row for row in content(earlier, "_ingested_at")
    ]
    assert len(before) == 4 * 60 and after.where("ref_month = '05'").count() == 7
    fact, _, _ = again.load_fact()
    assert {r.pickup_month for r in fact.select("pickup_month").distinct().collect()} <= {
        f"{m:02d}" for m in range(1, 6)
    }


def test_optimizing_keeps_the_fact(spark, built):
    pipeline, _ = built
    before = content(spark.table(pipeline.lake.fact))
    pipeline.optimize()
    assert content(spark.table(pipeline.lake.fact)) == before
    assert "rows" in tables.table_detail(spark, pipeline.lake.fact, "Statistics")
    assert tables.partitions(spark, pipeline.lake.fact) <= {
        f"{EVENT_MONTH[0]}=2023/{EVENT_MONTH[1]}={m:02d}" for m in range(1, 6)
    }
    pipeline.load_fact()
    pipeline.load_marts()


def test_tables_carry_comments(spark, built):
    lake = built[0].lake
    for name in (lake.raw(GREEN), lake.trusted(GREEN), lake.fact, lake.quarantine, lake.hourly):
        assert tables.table_detail(spark, name, "Comment")
