from __future__ import annotations

import datetime as dt
from itertools import product

import pytest
from pyspark.sql import functions as F

from fleetlake.model import REASONS, Limits
from fleetlake.operators import quality
from fleetlake.operators.quality import Rule

SCHEMA = (
    "trip_type string, vendor_id bigint, pickup_datetime timestamp, "
    "dropoff_datetime timestamp, passenger_count double, total_amount double, "
    "trip_duration_minutes double"
)
RULES = quality.standard_rules(Limits())
GOOD = {
    "trip_type": "yellow",
    "vendor_id": 1,
    "pickup_datetime": dt.datetime(2023, 3, 10, 12),
    "dropoff_datetime": dt.datetime(2023, 3, 10, 12, 20),
    "passenger_count": 1.0,
    "total_amount": 20.0,
    "trip_duration_minutes": 20.0,
}


def trips(spark, *changes):
    return spark.createDataFrame([tuple({**GOOD, **c}.values()) for c in changes], SCHEMA)


def reasons(spark, **change):
    return quality.with_reasons(trips(spark, change), RULES).first()[REASONS]


def test_good_trip_has_no_reason(spark):
    assert reasons(spark) == []


@pytest.mark.parametrize(
    ("change", "expected"),
    [
        ({"pickup_datetime": None, "trip_duration_minutes": None}, ["pickup_datetime_nulo"]),
        ({"dropoff_datetime": None, "trip_duration_minutes": None}, ["dropoff_datetime_nulo"]),
        ({"trip_duration_minutes": -5.0}, ["duracao_nao_positiva"]),
        ({"trip_duration_minutes": 0.0}, ["duracao_nao_positiva"]),
        ({"trip_duration_minutes": 1440.0}, []),
        ({"trip_duration_minutes": 1440.1}, ["duracao_acima_de_24h"]),
        ({"pickup_datetime": dt.datetime(2008, 1, 1)}, ["fora_da_janela_de_analise"]),
        ({"pickup_datetime": dt.datetime(2023, 1, 1)}, []),
        ({"pickup_datetime": dt.datetime(2023, 5, 31, 23, 59, 59)}, []),
        ({"pickup_datetime": dt.datetime(2023, 6, 1)}, ["fora_da_janela_de_analise"]),
        ({"total_amount": None}, ["total_amount_nulo"]),
        ({"total_amount": -0.01}, ["total_amount_negativo"]),
        ({"total_amount": 0.0}, []),
        ({"total_amount": float("nan")}, []),
        ({"trip_duration_minutes": float("nan")}, ["duracao_acima_de_24h"]),
        ({"passenger_count": None}, []),
        ({"passenger_count": 0.0}, []),
        (
            {
                "pickup_datetime": dt.datetime(2041, 6, 30, 5),
                "trip_duration_minutes": 0.0,
                "total_amount": -73.25,
            },
            ["duracao_nao_positiva", "fora_da_janela_de_analise", "total_amount_negativo"],
        ),
    ],
)
def test_reasons(spark, change, expected):
    assert reasons(spark, **change) == expected


def everything(spark):
    """Every combination of ordinary, odd and missing values."""
    pickups = [None, dt.datetime(2023, 3, 1), dt.datetime(2002, 1, 1)]
    dropoffs = [None, dt.datetime(2023, 3, 2)]
    minutes = [None, -1.0, 0.0, 30.0, 5000.0, float("nan")]
    amounts = [None, -1.0, 0.0, 10.0, float("nan")]
    riders = [None, -1.0, 0.0, 2.0]
    return spark.createDataFrame(
        [
            ("yellow", 1, p, d, r, a, m)
            for p, d, m, a, r in product(pickups, dropoffs, minutes, amounts, riders)
        ],
        SCHEMA,
    )


RULE_SETS = {
    "standard": RULES,
    # Without the null rules a NULL condition must still not reject.
    "no null rules": tuple(r for r in RULES if not r.name.endswith("_nulo")),
    "only measured": tuple(r for r in RULES if not r.blocking),
    "none": (),
    "reversed": tuple(reversed(RULES)),
}


@pytest.mark.parametrize("name", RULE_SETS)
def test_split_agrees_with_the_reasons(spark, name):
    """Accepted and rejected are found by predicates; the array is the judge."""
    rules, frame = RULE_SETS[name], everything(spark)
    flagged = quality.with_reasons(frame, rules)
    expected = flagged.groupBy(F.size(REASONS) == 0).count()
    counts = {bool(ok): n for ok, n in expected.collect()}
    accepted, rejected = quality.accepted(frame, rules), quality.rejected(frame, rules)
    assert accepted.columns == frame.columns
    assert accepted.count() == counts.get(True, 0)
    assert rejected.count() == counts.get(False, 0)
    kept = flagged.where(F.size(REASONS) > 0)
    assert rejected.exceptAll(kept).count() == 0 and kept.exceptAll(rejected).count() == 0


def test_reasons_without_blocking_rules_are_text(spark):
    frame = quality.with_reasons(trips(spark, {}), ())
    assert dict(frame.dtypes)[REASONS] == "array<string>"
    assert frame.first()[REASONS] == []


def test_own_rules(spark):
    rule = Rule("cheap", "Costs less than 15.", lambda: F.col("total_amount") < 15)
    frame = trips(spark, {}, {"total_amount": 3.0}, {"total_amount": None})
    assert [r.total_amount for r in quality.rejected(frame, [rule]).collect()] == [20.0]
    assert quality.accepted(frame, [rule]).count() == 2


def test_report(spark):
    report = quality.rule_report(trips(spark, {}, {"total_amount": -5.0}), RULES)
    assert [(n, t) for n, t in report.dtypes] == [
        ("rule_name", "string"),
        ("description", "string"),
        ("blocking", "boolean"),
        ("rows_evaluated", "bigint"),
        ("rows_failed", "bigint"),
        ("failure_pct", "double"),
    ]
    rows = {r.rule_name: r for r in report.collect()}
    assert list(rows) == [rule.name for rule in RULES]
    failed = rows["total_amount_negativo"]
    assert (failed.rows_evaluated, failed.rows_failed, failed.failure_pct) == (2, 1, 50.0)
    assert rows["passenger_count_ausente"].blocking is False
    assert rows["pickup_datetime_nulo"].rows_failed == 0


def test_report_of_no_rows(spark):
    report = quality.rule_report(trips(spark, {}).where("false"), RULES).collect()
    assert {(r.rows_evaluated, r.rows_failed, r.failure_pct) for r in report} == {(0, 0, 0.0)}


def test_report_from_quarantine_is_the_same(spark):
    frame = everything(spark)
    direct = quality.rule_report(frame, RULES)
    derived = quality.rule_report_from_quarantine(frame, quality.rejected(frame, RULES), RULES)
    assert sorted(map(tuple, derived.collect())) == sorted(map(tuple, direct.collect()))
    empty = frame.where("false")
    none = quality.rule_report_from_quarantine(empty, quality.rejected(empty, RULES), RULES)
    assert {r.rows_failed for r in none.collect()} == {0} and none.count() == len(RULES)


def test_rejections_by_reason_count_a_row_per_reason(spark):
    frame = trips(spark, {"total_amount": -1.0, "trip_duration_minutes": 0.0}, {"total_amount": -2.0})
    counted = quality.rejections_by_reason(quality.rejected(frame, RULES))
    assert dict(map(tuple, counted.collect())) == {
        "total_amount_negativo": 2,
        "duracao_nao_positiva": 1,
    }
