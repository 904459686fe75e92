from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from fleetlake.model import GREEN, YELLOW, Lake
from fleetlake.sources import landing


def put(frame, root, year, month, mode="errorifexists"):
    frame.coalesce(1).write.mode(mode).parquet(f"{root}/ref_year={year}/ref_month={month}")


def columns(spark, **values):
    """One row of the given values; a tuple is (expression, type)."""
    exprs = (
        f"CAST({v[0]} AS {v[1]}) AS `{k}`" if isinstance(v, tuple) else f"{v} AS `{k}`"
        for k, v in values.items()
    )
    return spark.sql(f"SELECT {', '.join(exprs)}")


@pytest.fixture
def drifted(spark, tmp_path):
    """Months whose fee column changes type and spelling, and one column that comes."""
    root = str(tmp_path / "landing" / "yellow")
    for month in ("01", "02", "03"):
        put(columns(spark, VendorID=("1", "bigint"), airport_fee=("1", "bigint")), root, 2023, month)
    for month in ("04", "05", "06", "07"):
        frame = columns(
            spark, VendorID=("2", "bigint"), Airport_fee=("1.75", "double"), Extra=("7", "int")
        )
        put(frame, root, 2023, month)
    return root


def test_union_of_drifting_months(spark, drifted):
    frame = landing.read_landing(spark, drifted)
    assert set(frame.columns) == {
        "vendor_id", "airport_fee", "extra", "_source_file", "_ingested_at",
        "ref_year", "ref_month",
    }
    kinds = dict(frame.dtypes)
    assert kinds.pop("_ingested_at") == "timestamp" and set(kinds.values()) == {"string"}
    found = {(r.ref_month, r.vendor_id, r.airport_fee, r.extra) for r in frame.collect()}
    assert found == {
        *((m, "1", "1", None) for m in ("01", "02", "03")),
        *((m, "2", "1.75", "7") for m in ("04", "05", "06", "07")),
    }
    for row in frame.select("_source_file", "ref_month", "_ingested_at").collect():
        assert f"ref_month={row.ref_month}/" in row._source_file and row._ingested_at


def test_one_branch_per_schema_and_pruned_months(spark, drifted, plan):
    frame = landing.read_landing(spark, drifted)
    assert plan(frame, "simple").count("FileScan parquet") == 2
    one = frame.where("ref_month = '05'")
    assert "PartitionFilters: [isnotnull(ref_month" in plan(one)
    assert [r.vendor_id for r in one.collect()] == ["2"]


def test_groups_follow_the_schema_not_the_file(spark, drifted):
    months = [f"{drifted}/ref_year=2023/ref_month={m:02d}" for m in range(1, 8)]
    groups = landing.schema_groups(spark, months)
    assert sorted(len(g.paths) for g in groups) == [3, 4]


def test_columns_that_come_are_null_before(spark, tmp_path):
    root = str(tmp_path / "green")
    put(columns(spark, a=("1", "int")), root, 2023, "01")
    put(columns(spark, a=("2", "int"), b=("3", "int")), root, 2023, "02")
    frame = landing.read_landing(spark, root)
    assert sorted((r.a, r.b) for r in frame.collect()) == [("1", None), ("2", "3")]


def test_a_column_in_some_files_of_a_month_is_not_missed(spark, tmp_path, plan):
    root = str(tmp_path / "green")
    for _ in range(3):
        put(columns(spark, a=("1", "int")), root, 2023, "01", mode="append")
    put(columns(spark, a=("2", "int"), b=("3", "int")), root, 2023, "01", mode="append")
    frame = landing.read_landing(spark, root)
    assert plan(frame, "simple").count("FileScan parquet") == 1
    assert sorted((r.a, r.b) for r in frame.collect()) == [*[("1", None)] * 3, ("2", "3")]


def test_files_of_one_month_may_disagree(spark, tmp_path):
    root = str(tmp_path / "green")
    put(columns(spark, fee=("1", "bigint")), root, 2023, "01")
    put(columns(spark, fee=("1.5", "double")), root, 2023, "01", mode="append")
    put(columns(spark, fee=("'x'", "string")), root, 2023, "01", mode="append")
    frame = landing.read_landing(spark, root)
    assert sorted(r.fee for r in frame.collect()) == ["1", "1.5", "x"]


def test_probing_grows_with_conflicts(spark, tmp_path, monkeypatch):
    root, probed = str(tmp_path / "green"), []
    for month in range(1, 13):
        kind = "int" if month < 8 else "string"
        put(columns(spark, fee=("3", kind)), root, 2021, f"{month:02d}")
    whole = landing._common_schema
    monkeypatch.setattr(landing, "_common_schema", lambda s, paths: probed.append(len(paths)) or whole(s, paths))
    assert landing.read_landing(spark, root, ("2021-01", "2021-07")).count() == 7
    assert probed == [7]
    probed.clear()
    assert landing.read_landing(spark, root).count() == 12
    assert probed[0] == 12 and len(probed) < 9


def test_chosen_months_alone_are_opened(spark, drifted):
    frame = landing.read_landing(spark, drifted, ("2023-03", "2023-04"))
    assert {f.rsplit("/", 2)[-2] for f in frame.inputFiles()} == {"ref_month=03", "ref_month=04"}
    with pytest.raises(ValueError, match="from 2024-01"):
        landing.read_landing(spark, drifted, ("2024-01", "2024-02"))


def test_directories_in_a_month_are_listed_and_read(spark, tmp_path):
    root = str(tmp_path / "green")
    put(columns(spark, a=("1", "int")), root, 2022, "05")
    columns(spark, a=("2", "int")).coalesce(1).write.parquet(f"{root}/ref_year=2022/ref_month=05/more")
    assert landing.inventory(spark, root).count() == 2
    rows = landing.read_landing(spark, root).select("a", "ref_year", "ref_month").collect()
    assert sorted(map(tuple, rows)) == [("1", "2022", "05"), ("2", "2022", "05")]


def test_colliding_names_in_a_file_are_refused(spark, tmp_path):
    root = str(tmp_path / "green")
    put(columns(spark, VendorID="1", vendor_id="2"), root, 2023, "01")
    with pytest.raises(ValueError, match="collide.*vendor_id"):
        landing.read_landing(spark, root)


def test_lineage_columns_of_the_source_give_way(spark, tmp_path):
    root = str(tmp_path / "green")
    put(columns(spark, a="1", _source_file="'theirs'", ref_month="'99'"), root, 2023, "01")
    row = landing.read_landing(spark, root).first()
    assert row.ref_month == "01" and "ref_month=01" in row._source_file


def test_no_files_and_foreign_directories(spark, tmp_path):
    with pytest.raises(ValueError, match="no parquet file"):
        landing.read_landing(spark, str(tmp_path))
    root = str(tmp_path / "green")
    put(columns(spark, a="1"), root, 2023, "1")
    with pytest.raises(ValueError, match="layout.*ref_month=1/"):
        landing.read_landing(spark, root)


def test_other_files_are_not_read(spark, drifted, tmp_path):
    (tmp_path / "landing" / "yellow" / "ref_year=2023" / "ref_month=01" / "note.txt").write_text("x")
    assert landing.read_landing(spark, drifted).count() == 7


@pytest.mark.parametrize(
    ("path", "month"),
    [
        ("/any/yellow/ref_year=2023/ref_month=01/data.parquet", ("2023", "01")),
        ("C:\\any\\ref_year=2022\\ref_month=12\\data.parquet", ("2022", "12")),
        ("/tmp/anywhere/data.parquet", ("", "")),
    ],
)
def test_month_of_a_path(spark, path, month):
    frame = spark.createDataFrame([(path,)], "p string")
    assert tuple(frame.select(*landing.ref_month_of(F.col("p"))).first()) == month


@pytest.mark.parametrize(
    ("name", "route"),
    [
        ("yellow_tripdata_2023-01.parquet", ("yellow", "2023", "01")),
        ("/up/loads/green_tripdata_2023-12.parquet", ("green", "2023", "12")),
        ("yellow_tripdata_2023-01.parquet.part", (None, None, None)),
        ("fhv_tripdata_2023-01.parquet", (None, None, None)),
    ],
)
def test_route_by_name(spark, name, route):
    frame = spark.createDataFrame([(name,)], "n string")
    assert tuple(frame.select(landing.route_by_name(F.col("n")).alias("r")).first().r) == route


@pytest.mark.parametrize(
    ("start", "end", "months"),
    [
        (date(2027, 12, 31), date(2028, 1, 1), ["2027-12", "2028-01"]),
        (date(2026, 8, 9), date(2026, 8, 9), ["2026-08"]),
        (date(1999, 6, 20), date(2001, 6, 2), [f"{y}-{m:02}" for y in (1999, 2000, 2001) for m in range(1, 13)][5:30]),
    ],
)
def test_months_between(spark, start, end, months):
    found = landing.months_between(spark, start, end).collect()
    assert ["-".join(r) for r in found] == months


def test_months_in_the_wrong_order(spark):
    with pytest.raises(ValueError, match="after"):
        landing.months_between(spark, date(2023, 5, 1), date(2023, 1, 1))


def test_coverage(spark, drifted):
    landed = landing.inventory(spark, drifted)
    landing.require_months(landed, date(2023, 2, 3), date(2023, 7, 9))
    with pytest.raises(ValueError, match="2022-12.*2023-08"):
        landing.require_months(landed, date(2022, 12, 1), date(2023, 8, 1))


def test_inventory_lists_without_reading(spark, drifted, tmp_path, plan):
    found = landing.inventory(spark, drifted)
    assert "content" not in plan(found)
    assert found.count() == 7 and found.where("size_bytes > 0 AND size_mb = 0.0").count() == 7
    months = landing.landed_months(spark, str(tmp_path / "landing"), YELLOW)
    assert {(r.trip_type, r.files) for r in months.collect()} == {("yellow", 1)}


def test_landing_paths():
    lake = Lake("/data/landing/")
    assert lake.landing_month(YELLOW, 2023, 1) == "/data/landing/yellow/ref_year=2023/ref_month=01"
    assert lake.raw(GREEN) == "raw.ny_taxi_trip_green"
