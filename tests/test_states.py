"""Stored states, one-pass histograms, interleaved clustering and statistics by partition."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fleetlake.model import FILE_MONTH, GREEN, YELLOW
from fleetlake.operators import marts
from fleetlake.plans import exploration
from fleetlake.sinks import tables

KEYS = ("'yellow' AS trip_type", "'2031' AS pickup_year", "lpad(CAST(1 + id % 3 AS STRING), 2, '0') AS pickup_month")


def content(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_the_monthly_mart_scans_and_shuffles_once(spark, plan, tmp_path):
    path = str(tmp_path / "fact")
    spark.range(300).selectExpr(*KEYS, "id / 7D AS total_amount", "1D AS passenger_count").write.parquet(path)
    text = plan(marts.monthly_mart(spark.read.parquet(path)), "simple")
    assert text.count("Exchange") == 1 and text.count("FileScan parquet") == 1


def test_medians_of_odd_months(spark):
    rows = [("yellow", "2023", "01", None, 1.0), ("yellow", "2023", "02", float("nan"), None), ("yellow", "2023", "03", -5.0, 1.0), ("yellow", "2023", "03", None, 1.0)]
    rows += [("yellow", "2023", "04", v, 1.0) for v in (4.0, 1.0, 3.0, 2.0, 2.0, float("nan"))] + [(None, None, None, 1.0, 1.0)]
    frame = spark.createDataFrame(rows, "trip_type string, pickup_year string, pickup_month string, total_amount double, passenger_count double")
    got = {r.pickup_month: (r.trip_count, r.median_total_amount) for r in marts.monthly_mart(frame).collect()}
    assert got == {"01": (1, None), "02": (1, None), "03": (2, -5.0), "04": (6, 2.0), None: (1, 1.0)}
    assert marts.monthly_mart(frame.where("false")).count() == 0


def test_states_of_months_merge_to_the_year(spark):
    """Exact while all fits one state; states are merged, trips are not read again."""
    fact = spark.range(30_000).selectExpr(*KEYS, "(id * 7919 % 30000) / 100D AS total_amount", "1D AS passenger_count")
    states = marts.monthly_states(fact)
    shares = {"low": 0.01, "mid": 0.5, "top": 1.0}
    found = marts.quantiles_of_states(states, shares, ("trip_type", "pickup_year")).first()
    assert (found.low, found.mid, found.top) == (2.99, 149.99, 299.99)
    whole = marts.merged_states(states, ("trip_type",)).first()
    assert whole.trip_count == whole.amounts == 30_000


def test_ranks_of_large_states_are_within_their_error(spark):
    n = 600_000
    fact = spark.range(n).selectExpr(*KEYS, f"CAST(id * 7919 % {n} AS DOUBLE) AS total_amount", "1D AS passenger_count")
    states = marts.monthly_states(fact)
    for by in (("trip_type",), marts.MONTH_KEYS):
        shares = {f"q{i}": i / 20 for i in range(1, 20)}
        for row in marts.quantiles_of_states(states, shares, by).collect():
            off = [abs(row[name] / n - share) for name, share in shares.items()]
            assert sum(o > marts.RANK_ERROR for o in off) <= 1 and max(off) < 3 * marts.RANK_ERROR


def test_the_profile_merges_from_months(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice([None, 1, 2, 7]), rng.choice([None, 0.0, 3.0]), rng.choice([None, -2.5, round(rng.uniform(0, 90), 2)]), f"2023-01-{rng.randint(1, 28):02d} 10:00:00", "2023", f"0{rng.randint(1, 3)}")
        for _ in range(500)
    ]
    names = "VendorID long, passenger_count double, total_amount double, t string, ref_year string, ref_month string"
    frame = spark.createDataFrame(rows, names).withColumn(YELLOW.pickup, F.col("t").cast("timestamp"))
    for part in (frame, frame.where("ref_month = '02'"), frame.where("false")):
        states = exploration.profile_states(part, YELLOW)
        direct = exploration.column_profile(part, YELLOW)
        merged = exploration.profile_of_states(states)
        assert merged.columns == direct.columns and content(merged) == content(direct)


def test_distinct_counts_of_many_values_are_within_their_error(spark):
    frame = spark.range(400_000).selectExpr(
        "id % 100000 AS VendorID", "1D AS passenger_count", "1D AS total_amount", f"timestamp'2023-01-01' AS {YELLOW.pickup}",
        "'2023' AS ref_year", "lpad(CAST(1 + id % 9 AS STRING), 2, '0') AS ref_month",
    )
    found = exploration.profile_of_states(exploration.profile_states(frame, YELLOW)).first().vendorid_distintos
    assert abs(found / 100_000 - 1) < 4 * 0.8 / 2 ** (exploration.DISTINCT_BITS / 2)


def trips(spark, fleet, n, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice([None, -1.0, 0.0, 2.0, 5.0, 9.0]), rng.choice([None, -3.0, 0.0, 7.0, 40.0, 2000.0]), rng.choice([None, 0]), rng.choice([-60, 0, 30, 600, 90_000]))
        for _ in range(n)
    ]
    frame = spark.createDataFrame(rows, "passenger_count double, total_amount double, start int, seconds int")
    start = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("start"))
    return frame.select("passenger_count", "total_amount", start.alias(fleet.pickup), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("start") + F.col("seconds")).alias(fleet.dropoff))


def test_histograms_of_one_scan_equal_the_single_ones(spark, plan, tmp_path):
    frames = {}
    for fleet, n in ((YELLOW, 400), (GREEN, 90)):
        trips(spark, fleet, n, n).write.parquet(str(tmp_path / fleet.name))
        frames[fleet] = spark.read.parquet(str(tmp_path / fleet.name))
    whole = exploration.histograms(frames)
    assert plan(whole, "simple").count("FileScan parquet") == len(frames)
    for fleet, frame in frames.items():
        mine = whole.where(F.col("trip_type") == fleet.name)
        for name, single in (
            ("duration", exploration.duration_histogram({fleet: frame})),
            ("passengers", exploration.passenger_histogram({fleet: frame})),
            ("amount", exploration.amount_histogram(frame)),
        ):
            found = mine.where(F.col("histogram") == name).select(*single.columns)
            assert found.collect() == single.collect()


def files_opened(table, condition):
    """Files whose range of values does not rule the condition out, and all files."""
    name, low, high = condition
    ranges = table.groupBy("_metadata.file_path").agg(F.min(name).alias("lo"), F.max(name).alias("hi")).collect()
    return sum(not (r.hi < low or r.lo > high) for r in ranges), len(ranges)


def test_interleaved_files_serve_both_filters(spark, database):
    """Skewed amounts, a third of them one value, in one partition of 16 files."""
    names = "'2023' AS ref_year", "'01' AS ref_month", "CASE WHEN id % 3 = 0 THEN 10D ELSE exp((id * 7919 % 40000) / 5000D) END AS amount"
    frame = spark.range(40_000).selectExpr("timestamp_seconds(1700000000 + id * 60) AS at", *names, "CAST(id AS STRING) AS note")
    opened = {}
    for way in (False, True):
        table = f"{database}.way{int(way)}"
        tables.replace_partitions(frame, table, FILE_MONTH)
        size = tables.table_bytes(spark, table)
        tables.cluster_table(spark, table, FILE_MONTH, ["at", "amount"], file_bytes=size // 16 + 1, interleave=way)
        stored = spark.table(table)
        assert content(stored.select("at", "amount", "note")) == content(frame.select("at", "amount", "note"))
        start = frame.agg(F.min("at")).first()[0]
        day = (start, frame.where("note = '1500'").first().at)
        opened[way] = files_opened(stored, ("at", *day)), files_opened(stored, ("amount", 1000.0, 1100.0))
        sizes = [r["count"] for r in stored.groupBy("_metadata.file_path").count().collect()]
        assert len(sizes) >= 12 and max(sizes) < 0.2 * 40_000  # the hot value is split
    (plain_time, plain_amount), (time, amount) = opened[False], opened[True]
    assert plain_amount[0] > 0.8 * plain_amount[1]
    assert amount[0] <= 0.5 * amount[1] and time[0] <= 0.5 * time[1]
    assert time[0] + amount[0] < 0.7 * (plain_time[0] + plain_amount[0])


def test_interleaving_of_odd_columns(spark, database):
    table = f"{database}.odd"
    rows = [(i, None if i % 2 else float("nan"), [None, "", "é", "zz"][i % 4]) for i in range(40)]
    frame = spark.createDataFrame(rows, "id long, v double, name string").select("*", F.lit("2023").alias("ref_year"), F.lit("01").alias("ref_month"))
    tables.replace_partitions(frame, table, FILE_MONTH)
    tables.cluster_table(spark, table, FILE_MONTH, ["v", "name", "id"], interleave=True)
    assert content(spark.table(table).select("id", "name")) == content(frame.select("id", "name"))


def test_ranks_count_the_bounds_reached(spark):
    bounds = [-3.0, 0.0, 0.0, 1.5, 8.0, 9.0, 20.0]
    values = [None, -9.0, -3.0, -1.0, 0.0, 1.0, 1.5, 8.5, 20.0, 99.0]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for n in range(len(bounds) + 1):
        found = frame.select("v", tables._rank_of(F.col("v"), bounds[:n]).alias("rank")).collect()
        assert [r["rank"] for r in found] == [0 if v is None else sum(b <= v for b in bounds[:n]) for v in values]


def test_only_the_partitions_named_are_analysed(spark, database):
    table = f"{database}.counted"
    frame = spark.range(60).select("id", F.lit("it's").alias("ref_year"), F.lpad((F.col("id") % 3).cast("string"), 2, "0").alias("ref_month"))
    tables.replace_partitions(frame, table, FILE_MONTH)
    tables.analyze_partitions(spark, table, FILE_MONTH, [("it's", "01")])
    assert tables.partition_rows(spark, table, FILE_MONTH) == {("it%27s", f"0{i}"): 20 if i == 1 else None for i in range(3)}


def test_replacing_all_drops_what_is_gone(spark, database):
    table = f"{database}.whole"
    frame = spark.range(9).select("id", F.lit("2023").alias("ref_year"), F.lpad((F.col("id") % 3).cast("string"), 2, "0").alias("ref_month"))
    tables.replace_all(frame, table, FILE_MONTH)
    tables.replace_all(frame.where("id % 3 = 1"), table, FILE_MONTH, scope={("2023", "01"), ("2023", "02")})
    assert {r.ref_month for r in spark.table(table).collect()} == {"00", "01"}
    tables.replace_all(frame.where("false"), table, FILE_MONTH)
    assert spark.table(table).isEmpty() and tables.partitions(spark, table) == set()
    with pytest.raises(ValueError, match="empty"):
        tables.replace_partitions(frame.where("false"), table, FILE_MONTH)
