"""Incremental landing: only new files are taken, failures repeat nothing and lose nothing."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from test_pipeline import content, month_of_trips, publish

from fleetlake.model import FLEETS, GREEN, YELLOW, Lake
from fleetlake.plans.pipeline import Pipeline
from fleetlake.streaming.landing import follow, take_new_files

SKIP = ("_ingested_at", "measured_at", "_source_file")


@pytest.fixture
def landing(spark, tmp_path):
    lake = Lake(f"{tmp_path}/landing", prefix=f"s{uuid.uuid4().hex[:8]}_", location=f"{tmp_path}/tables")
    rng = random.Random(23)
    for fleet in FLEETS:
        for month in (1, 2):
            publish(spark, lake.landing, fleet, month, month_of_trips(rng, month, size=20))
    return Pipeline(spark, lake), f"{tmp_path}/checkpoint"


def results(spark, lake):
    names = (lake.raw(YELLOW), lake.trusted(GREEN), lake.fact, lake.quarantine, lake.report, lake.monthly, lake.hourly)
    return {name.split("_", 1)[1]: content(spark.table(name), *SKIP) for name in names}


def test_a_run_takes_only_what_is_new(spark, landing, tmp_path):
    pipeline, checkpoint = landing
    lake, rng = pipeline.lake, random.Random(5)
    assert follow(pipeline, checkpoint) == {YELLOW: ["2023-01", "2023-02"], GREEN: ["2023-01", "2023-02"]}
    assert follow(pipeline, checkpoint) == {YELLOW: [], GREEN: []}
    # a month of another schema, and a changed month of one fleet
    publish(spark, lake.landing, YELLOW, 3, month_of_trips(rng, 3, size=20))
    publish(spark, lake.landing, GREEN, 1, month_of_trips(rng, 1, size=9))
    assert follow(pipeline, checkpoint) == {YELLOW: ["2023-03"], GREEN: ["2023-01"]}
    whole = Lake(lake.landing, prefix=f"w{uuid.uuid4().hex[:8]}_", location=f"{tmp_path}/whole")
    Pipeline(spark, whole).run()
    assert results(spark, lake) == results(spark, whole)


def test_a_failed_batch_is_taken_again(spark, landing, tmp_path):
    pipeline, checkpoint = landing
    root, seen, broken = pipeline.lake.landing_root(YELLOW), [], [True]

    def load(month):
        seen.append(month)
        if broken and month == "2023-02":
            raise RuntimeError("stopped")

    with pytest.raises(StreamingQueryException, match="stopped"):
        take_new_files(spark, root, checkpoint, load, files_per_batch=1)
    first = list(seen)
    broken.clear()
    assert take_new_files(spark, root, checkpoint, load, files_per_batch=1)[-1] == "2023-02"
    # what was taken before the failure is not taken again
    assert "2023-02" in first and seen.count("2023-01") == 1
    assert take_new_files(spark, root, checkpoint, load) == []


def test_an_interrupted_fact_is_made_up_for(spark, landing, tmp_path, monkeypatch):
    pipeline, checkpoint = landing
    follow(pipeline, checkpoint)
    publish(spark, pipeline.lake.landing, YELLOW, 2, month_of_trips(random.Random(1), 2, size=12))

    def stop(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(Pipeline, "load_marts", stop)
        with pytest.raises(KeyboardInterrupt):
            follow(pipeline, checkpoint)
    assert follow(pipeline, checkpoint) == {YELLOW: [], GREEN: []}
    whole = Lake(pipeline.lake.landing, prefix=f"w{uuid.uuid4().hex[:8]}_", location=f"{tmp_path}/whole")
    Pipeline(spark, whole).run()
    assert results(spark, pipeline.lake) == results(spark, whole)


def test_files_outside_the_layout_are_an_error(spark, landing, tmp_path):
    pipeline, checkpoint = landing
    root = pipeline.lake.landing_root(YELLOW)
    spark.range(3).write.parquet(f"{root}/elsewhere")
    with pytest.raises(StreamingQueryException, match="outside the expected layout"):
        take_new_files(spark, root, checkpoint, lambda month: None)


def test_the_months_of_a_batch_are_loaded_together(spark, landing, monkeypatch):
    pipeline, checkpoint = landing
    loads, whole = [], Pipeline.load_trusted

    def load_trusted(self, fleet, months=None):
        loads.append((fleet, months))
        return whole(self, fleet, months)

    monkeypatch.setattr(Pipeline, "load_trusted", load_trusted)
    both = ["2023-01", "2023-02"]
    assert follow(pipeline, checkpoint) == {YELLOW: both, GREEN: both}
    assert loads == [(fleet, frozenset(both)) for fleet in FLEETS]
