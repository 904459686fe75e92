from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fleetlake.model import Lake
from fleetlake.sinks import tables

KEYS = ("ref_year", "ref_month")


def months(spark, *rows, columns="v int, ref_year string, ref_month string"):
    return spark.createDataFrame(list(rows), columns)


def stored(spark, table, *columns):
    found = spark.table(table).select(*(columns or ("v", *KEYS)))
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_first_write_creates_a_partitioned_table(spark, database):
    table = f"{database}.t"
    tables.replace_partitions(months(spark, (1, "2023", "01")), table, KEYS, comment="it's \\ a test")
    assert tables.partitions(spark, table) == {"ref_year=2023/ref_month=01"}
    assert stored(spark, table) == [(1, "2023", "01")]
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert details["Comment"] == "it's \\ a test"


@pytest.mark.parametrize("options", [{}, {"rebalance": True}, {"rebalance": True, "sort_by": ["v"]}])
def test_only_the_partitions_present_are_replaced(spark, database, options):
    table = f"{database}.t"
    first = months(spark, (1, "2023", "01"), (2, "2023", "02"), (3, "2022", "01"))
    tables.replace_partitions(first, table, KEYS, **options)
    tables.replace_partitions(months(spark, (9, "2023", "02")), table, KEYS, **options)
    assert stored(spark, table) == [(1, "2023", "01"), (3, "2022", "01"), (9, "2023", "02")]


def test_a_second_identical_run_changes_nothing(spark, database):
    table = f"{database}.t"
    frame = months(spark, (1, "2023", "01"), (2, "2023", "02"))
    tables.replace_partitions(frame, table, KEYS)
    before = stored(spark, table)
    tables.replace_partitions(frame, table, KEYS)
    assert stored(spark, table) == before


def test_untouched_partitions_keep_their_files(spark, database):
    table = f"{database}.t"

    def files():
        found = spark.table(table).select(
            "ref_month", "_metadata.file_path", "_metadata.file_modification_time"
        )
        return {tuple(r) for r in found.where("ref_month = '01'").collect()}

    tables.replace_partitions(months(spark, (1, "2023", "01"), (2, "2023", "02")), table, KEYS)
    before = files()
    tables.replace_partitions(months(spark, (5, "2023", "02")), table, KEYS)
    assert files() == before and len(before) == 1


def test_replacing_does_not_depend_on_the_session_setting(spark, database):
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_new_columns_are_added(spark, database):
    table = f"{database}.t"
    tables.replace_partitions(months(spark, (1, "2023", "01")), table, KEYS)
    wider = months(spark, (2, "2023", "02")).withColumn("w", F.lit(0.5))
    tables.replace_partitions(wider, table, KEYS)
    tables.replace_partitions(months(spark, (3, "2023", "03")), table, KEYS)
    assert stored(spark, table, "v", "w") == [(1, None), (2, 0.5), (3, None)]
    assert spark.table(table).columns == ["v", "w", *KEYS]


def test_changed_types_are_refused(spark, database):
    table = f"{database}.t"
    tables.replace_partitions(months(spark, (1, "2023", "01")), table, KEYS)
    text = months(spark, ("x", "2023", "01"), columns="v string, ref_year string, ref_month string")
    with pytest.raises(ValueError, match="v: int -> string"):
        tables.replace_partitions(text, table, KEYS)
    assert stored(spark, table) == [(1, "2023", "01")]


def test_empty_frames(spark, database):
    table, empty = f"{database}.t", months(spark, (1, "2023", "01")).where("v > 5")
    tables.replace_partitions(empty, table, KEYS)
    assert stored(spark, table) == [] and tables.partitions(spark, table) == set()
    tables.replace_partitions(months(spark, (1, "2023", "01")), table, KEYS)
    with pytest.raises(ValueError, match="empty"):
        tables.replace_partitions(empty, table, KEYS)
    assert stored(spark, table) == [(1, "2023", "01")]


def test_missing_partition_values(spark, database):
    table = f"{database}.t"
    frame = months(spark, (1, None, "01"), (2, "2023", "01"))
    tables.replace_partitions(frame, table, KEYS, rebalance=True)
    tables.replace_partitions(frame, table, KEYS, rebalance=True)
    assert stored(spark, table) == [(1, None, "01"), (2, "2023", "01")]


def test_predicate_of_the_partitions(spark):
    one = months(spark, (40, "1999", "12"))
    assert tables.partition_predicate(one, KEYS) == "(ref_year = '1999' AND ref_month = '12')"
    several = months(spark, *[(v, year, "07") for v, year in enumerate(("2031", "2008", "2031", "2019", "2008"))])
    assert tables.partition_predicate(several, KEYS) == " OR ".join(
        f"(ref_year = '{year}' AND ref_month = '07')" for year in (2008, 2019, 2031)
    )
    with pytest.raises(ValueError, match="empty"):
        tables.partition_predicate(one.where("v > 50"), KEYS)


def test_predicate_selects_exactly_its_partitions(spark):
    odd = months(spark, (1, "it's", "01"), (2, None, "02"), (3, "a\\b", "03"))
    other = odd.unionByName(months(spark, (4, "2023", "04")))
    found = other.where(tables.partition_predicate(odd, KEYS))
    assert sorted(r.v for r in found.collect()) == [1, 2, 3]


def test_overwrite_replaces_the_schema(spark, database):
    table = f"{database}.t"
    tables.overwrite_table(months(spark, (1, "2023", "01")), table)
    tables.overwrite_table(spark.range(3), table, comment="numbers")
    assert [tuple(r) for r in spark.table(table).orderBy("id").collect()] == [(0,), (1,), (2,)]


def test_overwrite_from_the_table_itself(spark, database):
    table = f"{database}.t"
    tables.overwrite_table(spark.range(3), table)
    tables.overwrite_table(spark.table(table).where("id > 0"), table)
    assert spark.table(table).count() == 2


def test_a_failed_overwrite_keeps_the_old_rows(spark, database):
    table = f"{database}.t"
    tables.overwrite_table(spark.range(3), table)
    broken = spark.range(3).select(F.expr("assert_true(id < 2, 'broken')").isNull().alias("x"))
    with pytest.raises(Exception, match="broken"):
        tables.overwrite_table(broken, table)
    assert spark.table(table).count() == 3
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()] == ["t"]
    tables.overwrite_table(spark.range(5), table)
    assert spark.table(table).count() == 5


def test_table_exists(spark, database):
    tables.overwrite_table(spark.range(1), f"{database}.t")
    assert tables.table_exists(spark, f"{database}.t")
    assert not tables.table_exists(spark, f"{database}.other")
    assert not tables.table_exists(spark, "nowhere.t")
    assert not tables.table_exists(spark, "no_catalog.nowhere.t")


def test_databases(spark, tmp_path):
    lake = Lake(str(tmp_path), prefix="lay_", location=str(tmp_path / "tables"))
    tables.create_databases(spark, lake)
    tables.create_databases(spark, lake)
    names = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    assert {"lay_landing", "lay_raw", "lay_trusted", "lay_refined", "lay_quality"} <= names


FACT = "trip_type string, t timestamp, v bigint, pickup_year string, pickup_month string"
EVENT = ("pickup_year", "pickup_month")


def skewed(spark, rows=4000):
    """One month holds most rows, and half of those are copies of one row."""
    return spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, "green").otherwise("yellow").alias("trip_type"),
        F.expr("timestampadd(SECOND, CAST(id * 7919 % 80000 AS INT), timestamp'2023-05-01')").alias("t"),
        (F.col("id") % 10).alias("v"),
        F.when(F.col("id") >= 0, "2023").alias("pickup_year"),
        F.when(F.col("id") % 10 == 0, "04").otherwise("05").alias("pickup_month"),
    ).withColumns(
        {
            "trip_type": F.when(F.col("v") < 5, "green").otherwise(F.col("trip_type")),
            "t": F.when(F.col("v") < 5, F.lit("2023-05-01 08:00:00").cast("timestamp")).otherwise(F.col("t")),
            "v": F.when(F.col("v") < 5, 1).otherwise(F.col("v")),
        }
    )


def in_file_order(spark, table):
    """(file, row position) -> (fleet, time), in file order."""
    found = spark.table(table).select(
        "_metadata.file_path", "_metadata.row_index", "trip_type", "t"
    )
    files: dict[str, list] = {}
    for r in sorted(found.collect(), key=lambda r: (r.file_path, r.row_index)):
        files.setdefault(r.file_path, []).append((r.trip_type, r.t))
    return files


def test_written_files_are_sorted(spark, database):
    table = f"{database}.t"
    tables.replace_partitions(skewed(spark), table, EVENT, rebalance=True, sort_by=("trip_type", "t"))
    for rows in in_file_order(spark, table).values():
        assert rows == sorted(rows)


def test_a_hot_month_is_written_by_several_tasks(spark, database):
    """One month holds nine rows of ten."""
    table, key = f"{database}.t", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    usual = spark.conf.get(key)
    frame = spark.range(0, 200_000, 1, 8).select(
        F.xxhash64("id").alias("v"),
        F.when(F.col("id") >= 0, "2023").alias("pickup_year"),
        F.when(F.col("id") % 10 > 0, "05")
        .otherwise(F.lpad((F.col("id") / 10 % 4 + 1).cast("int").cast("string"), 2, "0"))
        .alias("pickup_month"),
    )
    spark.conf.set(key, "128k")
    try:
        tables.replace_partitions(frame, table, EVENT, rebalance=True, sort_by=("v",))
    finally:
        spark.conf.set(key, usual)
    files = spark.table(table).select("pickup_month", "_metadata.file_path").distinct()
    per_month = dict(map(tuple, files.groupBy("pickup_month").count().collect()))
    assert per_month["05"] >= 4 and min(per_month.values()) == 1
    assert spark.table(table).exceptAll(frame).count() == 0
    assert spark.table(table).count() == 200_000


def test_clustering_keeps_rows_and_separates_files(spark, database):
    table = f"{database}.t"
    frame = skewed(spark)
    tables.replace_partitions(frame, table, EVENT, comment="kept")
    tables.cluster_table(spark, table, EVENT, ("trip_type", "t"), file_bytes=4000)
    assert spark.table(table).exceptAll(frame.select(*spark.table(table).columns)).count() == 0
    assert spark.table(table).count() == 4000
    files = in_file_order(spark, table)
    assert len(files) > 4
    for rows in files.values():
        assert rows == sorted(rows)
    by_month: dict[str, list] = {}
    for path, rows in files.items():
        by_month.setdefault(path.rsplit("/", 1)[0], []).append((rows[0], rows[-1]))
    for ranges in by_month.values():
        ranges.sort()
        assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    # Copies of one row make up 45% of a month and still spread over files.
    assert max(map(len, files.values())) < 1600
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()] == ["t"]
    assert tables.table_detail(spark, table, "Comment") == "kept"
    # Later partial writes go on as before.
    one = frame.where("pickup_month = '04'").limit(3)
    tables.replace_partitions(one, table, EVENT)
    months = dict(map(tuple, spark.table(table).groupBy("pickup_month").count().collect()))
    assert months == {"04": 3, "05": 3600}


def test_statistics(spark, database):
    table = f"{database}.t"
    tables.replace_partitions(skewed(spark, 100), table, EVENT)
    tables.analyze_table(spark, table)
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert "100 rows" in details["Statistics"]
    assert {"v", "t"} <= {r.col_name for r in tables.describe(spark, table).collect()}


@pytest.mark.parametrize("interleave", [False, True])
def test_a_range_to_cluster_is_bounded_by_its_rows(spark, database, interleave):
    """Copies of few rows: their files are far smaller than what a task has to sort."""
    table = f"{database}.t"
    frame = skewed(spark, 20_000)
    tables.replace_partitions(frame, table, EVENT)
    tables.cluster_table(spark, table, EVENT, ("trip_type", "t"), interleave=interleave, file_rows=2_000)
    files = in_file_order(spark, table)
    assert len(files) >= 10 and max(map(len, files.values())) < 4_000
    assert spark.table(table).exceptAll(frame.select(*spark.table(table).columns)).count() == 0
    assert spark.table(table).count() == 20_000
