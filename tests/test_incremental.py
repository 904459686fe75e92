"""Loading what changed: one scan, counts taken where rows are written, partitions switched."""

from __future__ import annotations

import random
import re
import subprocess
import sys
import textwrap
import uuid
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from test_pipeline import content, month_of_trips, publish

from fleetlake.model import EVENT_MONTH, FILE_MONTH, FLEETS, GREEN, YELLOW, Lake
from fleetlake.plans.pipeline import Pipeline
from fleetlake.sinks import tables

SKIP = ("_ingested_at", "measured_at", "_source_file")


def new_lake(spark, root, months=(1, 2, 3, 4)):
    lake = Lake(f"{root}/landing", prefix=f"i{uuid.uuid4().hex[:8]}_", location=f"{root}/tables")
    rng = random.Random(11)
    for fleet in FLEETS:
        for month in months:
            trips = month_of_trips(rng, month, size=40)
            # some trips of a file belong to the month after it, as they do in published files
            late = [t for t in month_of_trips(rng, month + 1, size=6) if t[1] and t[1].year == 2023]
            publish(spark, lake.landing, fleet, month, trips + late)
    return Pipeline(spark, lake)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    pipeline = new_lake(spark, str(tmp_path_factory.mktemp("changes")))
    pipeline.run()
    return pipeline


def versions(spark, table):
    """The directory of each partition."""
    return tables.locations(spark, table)


def results(spark, lake):
    names = (lake.fact, lake.quarantine, lake.report, lake.monthly, lake.hourly)
    return {name.split("_", 1)[1]: content(spark.table(name), *SKIP) for name in names}


def test_fact_quarantine_and_report_share_one_scan(loaded, plan):
    text = plan(loaded.judged(Observation()))
    tree = text[: text.index("\n\n")]
    assert tree.count("Scan parquet") == len(FLEETS)
    assert tree.count("Exchange") == 1
    assert tree.index("CollectMetrics") < tree.index("Exchange")


def test_loading_reads_every_trip_once(spark, loaded):
    """Counted where trips are read, over all jobs of a load."""
    trips, read = loaded.trips(), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    class Counting(Pipeline):
        def trips(self):
            return trips.mapInArrow(counted, trips.schema)

    Counting(spark, loaded.lake, loaded.limits).load_fact()
    assert read.value == trips.count()


def test_one_month_again_equals_a_full_run(spark, loaded, tmp_path_factory):
    lake, rng = loaded.lake, random.Random(5)
    before = versions(spark, lake.fact)
    publish(spark, lake.landing, YELLOW, 2, month_of_trips(rng, 2, size=25))
    months = ("2023-02", "2023-02")
    loaded.setup()
    loaded.load_raw(YELLOW, months)
    loaded.load_trusted(YELLOW, months)
    events = loaded.touched_events(months)
    assert events == {"2023-02", "2023-03"}  # March had late trips of the file before
    loaded.load_fact(months, events)
    loaded.load_marts(events)
    after = versions(spark, lake.fact)
    moved = {v for v in after if after[v] != before.get(v)}
    assert moved == {("2023", "02"), ("2023", "03")}

    whole = Lake(lake.landing, prefix=f"w{uuid.uuid4().hex[:8]}_", location=f"{tmp_path_factory.mktemp('whole')}")
    Pipeline(spark, whole).run()
    assert results(spark, lake) == results(spark, whole)


def test_a_month_that_empties_leaves_the_fact(spark, tmp_path_factory):
    pipeline = new_lake(spark, str(tmp_path_factory.mktemp("emptied")), months=(1, 4))
    pipeline.run()
    lake, months = pipeline.lake, ("2023-04", "2023-04")
    absurd = [(v, p and p.replace(year=2090), d, r, a) for v, p, d, r, a in month_of_trips(random.Random(1), 4, 9)]
    for fleet in FLEETS:
        publish(spark, lake.landing, fleet, 4, absurd)
    pipeline.run(months=months)
    left = spark.table(lake.fact).select(*EVENT_MONTH).distinct().collect()
    assert {r.pickup_month for r in left} == {"01", "02"}
    assert spark.table(lake.quarantine).where("ref_month = '04'").count() == 2 * len(absurd)
    report = {r.rule_name: r for r in spark.table(lake.report).collect()}
    assert {r.rows_evaluated for r in report.values()} == {pipeline.trips().count()}
    assert spark.table(lake.monthly).where("pickup_month > '03'").isEmpty()


def test_a_file_without_rejects_empties_its_quarantine(spark, tmp_path_factory):
    pipeline = new_lake(spark, str(tmp_path_factory.mktemp("clean")), months=(1, 2))
    pipeline.run()
    lake = pipeline.lake
    good = [t for t in month_of_trips(random.Random(2), 2, 60) if t[1] and t[1].year == 2023 and t[2] and t[2] > t[1]]
    good = [(v, p, d, 1.0, 5.0) for v, p, d, _, _ in good if (d - p).days == 0]
    for fleet in FLEETS:
        publish(spark, lake.landing, fleet, 2, good)
    pipeline.run(months=("2023-02", "2023-02"))
    assert spark.table(lake.quarantine).where("ref_month = '02'").isEmpty()
    assert spark.table(lake.quarantine).where("ref_month = '01'").count() > 0


def test_an_interrupted_load_is_followed_by_a_full_one(spark, tmp_path_factory, monkeypatch):
    pipeline = new_lake(spark, str(tmp_path_factory.mktemp("stopped")), months=(1, 2))
    pipeline.run()
    lake, expected = pipeline.lake, None
    expected = results(spark, lake)

    def stop(*_, **__):
        raise KeyboardInterrupt

    months = ("2023-02", "2023-02")
    with monkeypatch.context() as patched:
        patched.setattr(tables, "drop_partitions", stop)
        with pytest.raises(KeyboardInterrupt):
            pipeline.load_fact(months)
    assert not tables.table_exists(spark, lake.report)
    pipeline.load_fact(months)
    assert results(spark, lake) == expected


def test_no_reader_sees_half_a_month(spark, loaded):
    """A reader that began before a switch goes on with the rows it began with."""
    lake = loaded.lake
    reader = spark.table(lake.fact)
    planned = content(reader)
    kept = reader.select("*").cache  # the plan is made by the read above
    loaded.load_fact()
    assert content(reader) == planned and kept is not None
    assert content(spark.table(lake.fact)) == planned


def test_a_killed_write_leaves_the_old_rows(spark, database):
    table = f"{database}.killed"
    frame = spark.range(20).select("id", F.lit("2023").alias("ref_year"), F.lpad((F.col("id") % 4).cast("string"), 2, "0").alias("ref_month"))
    tables.replace_partitions(frame, table, FILE_MONTH)
    before, places = content(spark.table(table)), tables.locations(spark, table)
    # fails after other tasks have written files of every month
    bad = F.when(F.col("id") == 7, F.raise_error(F.lit("stopped"))).otherwise(F.col("id") + 100)
    failing = frame.repartition(4, "id").withColumn("id", bad.cast("long"))
    with pytest.raises(PySparkException, match="stopped"):
        tables.replace_partitions(failing, table, FILE_MONTH)
    spark.catalog.refreshTable(table)
    assert content(spark.table(table)) == before
    assert tables.locations(spark, table) == places


def test_a_frame_may_read_the_table_it_replaces(spark, database):
    table = f"{database}.itself"
    frame = spark.range(8).select("id", F.lit("2023").alias("ref_year"), F.lit("01").alias("ref_month"))
    tables.replace_partitions(frame, table, FILE_MONTH)
    tables.replace_partitions(spark.table(table).withColumn("id", F.col("id") * 2), table, FILE_MONTH)
    assert sorted(r.id for r in spark.table(table).collect()) == list(range(0, 16, 2))


def test_vacuum_deletes_only_what_nothing_points_at(spark, database):
    table = f"{database}.swept"
    frame = spark.range(8).select("id", F.lit("it's 5%").alias("ref_year"), F.lpad((F.col("id") % 2).cast("string"), 2, "0").alias("ref_month"))
    tables.replace_partitions(frame, table, FILE_MONTH)
    tables.replace_partitions(frame.where("id % 2 = 0"), table, FILE_MONTH)
    before = content(spark.table(table))
    directory = tables.versions_of(spark, table)
    assert tables.vacuum(spark, directory, (table,)) == []
    gone = tables.vacuum(spark, directory, (table,), keep_hours=-1)
    assert len(gone) == 1 and "ref_month=00" in gone[0]
    spark.catalog.refreshTable(table)
    assert content(spark.table(table)) == before
    assert tables.vacuum(spark, directory, (table,), keep_hours=-1) == []


def test_clustering_some_partitions_leaves_the_others(spark, database):
    table = f"{database}.some"
    frame = spark.range(400).select(
        (F.col("id") * 7 % 400).alias("id"), F.lit("2023").alias("ref_year"), F.lpad((F.col("id") % 3).cast("string"), 2, "0").alias("ref_month")
    )
    tables.replace_partitions(frame, table, FILE_MONTH, rebalance=True)
    rows, before = content(spark.table(table)), tables.locations(spark, table)
    tables.cluster_table(spark, table, FILE_MONTH, ["id"], only=[("2023", "01")])
    after = tables.locations(spark, table)
    assert {v for v in after if after[v] != before[v]} == {("2023", "01")}
    assert content(spark.table(table)) == rows


RETRY = """
import sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import Observation, SparkSession, functions as F
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")

def once(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

seen = Observation()
rows = spark.range(1000).repartition(3).observe(seen, F.count(F.lit(1)).alias("n"))
rows.mapInPandas(once, "id long").write.parquet({out!r})
print("counted", seen.get["n"], spark.read.parquet({out!r}).count())
"""


def test_a_task_that_runs_again_counts_once(tmp_path):
    """Every writing task fails after its rows were counted, and runs again."""
    root = str(Path(__file__).resolve().parents[1])
    script = textwrap.dedent(RETRY).format(root=root, out=str(tmp_path / "out"))
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert re.search(r"counted 1000 1000", done.stdout), done.stderr[-2000:]


def test_the_job_takes_months(spark, tmp_path_factory):
    from fleetlake.__main__ import parse, run

    pipeline = new_lake(spark, str(tmp_path_factory.mktemp("job")), months=(1, 2))
    lake = pipeline.lake
    pipeline.run()
    publish(spark, lake.landing, GREEN, 2, month_of_trips(random.Random(8), 2, size=10))
    arguments = ["--landing", lake.landing, "--location", lake.location, "--prefix", lake.prefix]
    steps = ["raw", "trusted", "refined", "marts"]
    run(parse([*arguments, "--months", "2023-02", "2023-02", "--steps", *steps]), spark)
    one = results(spark, lake)
    run(parse([*arguments, "--steps", *steps]), spark)
    assert results(spark, lake) == one
