from __future__ import annotations

import uuid
from datetime import date

import pytest

from fleetlake.__main__ import parse, run
from fleetlake.model import FLEETS, Lake, Limits
from fleetlake.session import SETTINGS


def test_options():
    options = parse(["--landing", "/x", "--first", "2022-11", "--last", "2022-12"])
    assert (options.first, options.last) == (date(2022, 11, 1), date(2022, 12, 1))
    assert "optimize" not in options.steps
    default = parse(["--landing", "/x"])
    assert (default.first, default.last) == (date(2023, 1, 1), date(2023, 5, 1))


def test_default_limits():
    assert Limits() == Limits("2023-01-01", "2023-06-01", 1440)


def test_settings_are_known_to_spark(spark):
    for key in SETTINGS:
        assert spark.conf.get(key) is not None


def test_job_from_landing_to_marts(spark, tmp_path):
    for fleet in FLEETS:
        for month in (11, 12):
            spark.sql(
                f"SELECT 1L AS VendorID, timestamp'2022-{month}-05 08:00:00' AS {fleet.pickup}, "
                f"timestamp'2022-{month}-05 08:30:00' AS {fleet.dropoff}, "
                "2.0D AS passenger_count, 9.5D AS total_amount"
            ).write.parquet(Lake(str(tmp_path)).landing_month(fleet, 2022, month))
    prefix = f"j{uuid.uuid4().hex[:8]}_"
    where = ["--landing", str(tmp_path), "--prefix", prefix]
    run(parse([*where, "--first", "2022-11", "--last", "2022-12"]), spark)
    lake = Lake(str(tmp_path), prefix)
    assert spark.table(lake.monthly).count() == 4
    assert spark.table(lake.fact).count() == 4
    with pytest.raises(ValueError, match="2023-01"):
        run(parse([*where, "--first", "2022-11", "--last", "2023-01"]), spark)
