"""Every registered query against its SQL oracle, value by value."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import check
from fleetlake.checks import oracle, queries

DIRECTORY = entry.SMOKE_DIRECTORY
needs_data = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no generated tables")


@pytest.fixture(scope="module")
def connection():
    return check.connect(DIRECTORY)


def test_every_query_has_an_oracle():
    assert set(queries.queries()) == set(oracle.oracle_sql())
    assert set(queries.queries()) <= set(entry.queries())


@needs_data
@pytest.mark.parametrize("name", ["q1a_avg_ticket", "q2a_hourly_occupancy", "q2b_typical_day", "q2c_by_fleet"])
def test_answers_read_the_marts(spark, plan, name):
    text = plan(queries.queries()[name](spark, DIRECTORY))
    assert text.count("Scan parquet") == 2 and text.count("agg_trip_") >= 1 and "fct_taxi_trip" not in text


@needs_data
@pytest.mark.parametrize("name", ["q2a_from_fact", "fact_month_sample"])
def test_answers_about_a_month_open_its_partition(spark, plan, name):
    text = plan(queries.queries()[name](spark, DIRECTORY))
    assert "fct_taxi_trip" in text and "PartitionFilters: [" in text and "PartitionFilters: []" not in text


@needs_data
@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_equals_oracle(spark, connection, name):
    assert check.compare(spark, connection, DIRECTORY, name) is None


@needs_data
def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["mes", "corridas", "ticket_medio", "mediana", "receita_total"]
    assert frame.count() == 60


@needs_data
def test_every_rule_fails_somewhere(spark):
    report = entry.queries()["dq_report"](spark, DIRECTORY).collect()
    assert all(row.rows_failed > 0 for row in report)
