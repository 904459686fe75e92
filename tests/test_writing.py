"""Writing holds encoded columns, not the rows of a task."""

from __future__ import annotations

import json
import subprocess
import sys
import textwrap
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fleetlake.sinks import tables
from fleetlake.sources import landing

KEYS = ("ref_year", "ref_month")
SETTING = "spark.sql.maxConcurrentOutputFileWriters"

WRITE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
from fleetlake.sinks import tables
conf = {{"spark.ui.enabled": "false", "spark.eventLog.enabled": "true", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"}}
conf |= {{"spark.eventLog.dir": {out!r} + "/events", "spark.sql.warehouse.dir": {out!r} + "/tables"}}
spark = SparkSession.builder.master("local[2]").config(map=conf).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
month = F.lpad((F.col("id") % 5 + 1).cast("string"), 2, "0")
rows = spark.range(0, 120000, 1, 1).select("id", F.repeat(F.lit("x"), 300).alias("wide"), F.lit("2023").alias("ref_year"), month.alias("ref_month"))
tables.replace_partitions(rows, "t", ("ref_year", "ref_month"))
print("wrote", spark.table("t").count(), spark.table("t").select("id").distinct().count())
spark.stop()
"""


def test_rows_are_not_held_to_be_written(tmp_path):
    """One task with 36 MB of rows for five partitions."""
    root = str(Path(__file__).resolve().parents[1])
    (tmp_path / "events").mkdir()
    script = textwrap.dedent(WRITE).format(root=root, out=str(tmp_path))
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300, cwd=tmp_path)
    assert "wrote 120000 120000" in done.stdout, done.stderr[-2000:]
    (log,) = (tmp_path / "events").iterdir()
    ended = [e for e in map(json.loads, log.open()) if e["Event"] == "SparkListenerTaskEnd"]
    writing = [e["Task Metrics"] for e in ended if e["Task Metrics"]["Output Metrics"]["Records Written"] == 120_000]
    assert [m["Peak Execution Memory"] for m in writing] == [0]


def test_more_partitions_than_open_files(spark, database, monkeypatch):
    monkeypatch.setattr(tables, "OPEN_FILES", 3)
    table, usual = f"{database}.t", spark.conf.get(SETTING)
    month = F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0")
    frame = spark.range(0, 500, 1, 1).select("id", F.lit("2023").alias("ref_year"), F.nullif(month, F.lit("07")).alias("ref_month"))
    tables.replace_partitions(frame, table, KEYS)
    assert sorted(map(tuple, spark.table(table).collect()), key=repr) == sorted(map(tuple, frame.collect()), key=repr)
    assert spark.conf.get(SETTING) == usual


def test_a_failed_write_leaves_the_setting(spark, database):
    usual = spark.conf.get(SETTING)
    broken = spark.range(5).select(F.raise_error(F.lit("stopped")).cast("string").alias("v"), *(F.lit("2023").alias(k) for k in KEYS))
    with pytest.raises(Exception, match="stopped"):
        tables.replace_partitions(broken, f"{database}.t", KEYS)
    assert spark.conf.get(SETTING) == usual


def test_months_are_read_off_paths_without_a_look_at_every_character(spark, plan):
    paths = ["a/ref_year=2023/ref_month=05/x", "C:\\a\\ref_year=1999\\ref_month=12\\x", "a/b", "", None, "ref_year=1/ref_year=2001/ref_month=02/ref_year=2002/ref_month=03"]
    frame = spark.createDataFrame([(p,) for p in paths], "path string").select(*landing.ref_month_of(F.col("path")))
    assert [tuple(r) for r in frame.collect()] == [("2023", "05"), ("1999", "12"), ("", ""), ("", ""), (None, None), ("2001", "02")]
    assert "translate(" not in plan(frame)


def test_times_are_written_as_numbers_with_bounds(spark, database):
    setting, table = "spark.sql.parquet.outputTimestampType", f"{database}.t"
    usual = spark.conf.get(setting)
    times = ["0001-01-01 00:00:00", "1500-02-28 23:00:00", "2023-05-01 02:03:04.000005", "9999-12-31 23:59:59.999999", None]
    texts = spark.createDataFrame([(t, "2023", "05") for t in times], "t string, ref_year string, ref_month string")
    tables.replace_partitions(texts.withColumn("t", F.col("t").cast("timestamp")).coalesce(1), table, KEYS)
    assert {r.t for r in spark.table(table).select(F.col("t").cast("string")).collect()} == set(times)
    (path,) = spark.table(table).inputFiles()
    group = pq.ParquetFile(path.removeprefix("file://")).metadata.row_group(0).column(0)
    assert group.physical_type == "INT64" and group.statistics.has_min_max
    assert spark.conf.get(setting) == usual
