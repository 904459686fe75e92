"""Idempotent writes and maintenance for partitioned parquet tables.

Rows are written to a directory of their own, which no table knows yet. When it is
complete, each partition it holds is pointed at it by one statement to the catalog. So
a reader sees a partition as it was or as it is, a killed write changes nothing, and
neither a repair nor a scan is needed to find what was written. What a partition
pointed at before stays for readers that have begun, until ``vacuum``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import AbstractContextManager, contextmanager, nullcontext
from functools import reduce
from math import ceil
from urllib.parse import unquote
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from fleetlake.model import LAYERS, Lake
from fleetlake.operators.shaping import column

#: Hidden from readers of the directory; only the catalog points into it.
VERSIONS = "_versions"
#: Quantiles of a column that interleaved clustering tells apart, as a power of two.
INTERLEAVED_BITS = 8
#: Partitions that a task writes side by side.
OPEN_FILES = 100
# Fixed value: how a directory names a missing partition value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_exists(spark: SparkSession, table: str) -> bool:
    """False also when the database or the catalog does not exist."""
    try:
        return spark.catalog.tableExists(table)
    except AnalysisException:
        return False


def create_databases(spark: SparkSession, lake: Lake) -> None:
    for layer in LAYERS:
        name = lake.database(layer)
        place = f" LOCATION {_text(f'{lake.location}/{name}')}" if lake.location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def comment_table(spark: SparkSession, table: str, comment: str | None) -> None:
    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS {_text(comment)}")


def table_detail(spark: SparkSession, table: str, name: str) -> str | None:
    """A table property as DESCRIBE shows it, after any column of the same name."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    found = described.where(F.col("col_name") == name).collect()
    return found[-1]["data_type"] if found else None


def set_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    listed = ", ".join(f"{_text(name)} = {_text(value)}" for name, value in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def property_of(spark: SparkSession, table: str, name: str) -> str | None:
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == name).first()
    return found and found["value"]


def table_location(spark: SparkSession, table: str) -> str:
    return table_detail(spark, table, "Location")


def partitions(spark: SparkSession, table: str) -> set[str]:
    """Partition names from the catalog; one per month, so few."""
    return {row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def partition_slice(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: the predicate describing exactly the partitions present, in order.

    For audit; the writer does not need it and so does not scan for it.
    """

    def part(key: str) -> Column:
        value = F.regexp_replace(column(key).cast("string"), r"([\\'])", r"\\$1")
        equal = F.concat(F.lit(f"{key} = '"), value, F.lit("'"))
        return F.coalesce(equal, F.lit(f"{key} IS NULL"))

    clause = F.concat(F.lit("("), F.concat_ws(" AND ", *map(part, keys)), F.lit(")"))
    present = frame.select(*keys).distinct()
    ordered = F.array_sort(F.collect_list(F.struct(*keys, clause.alias("clause"))))
    return present.agg(F.array_join(ordered["clause"], " OR ").alias("predicate"))


def partition_predicate(frame: DataFrame, keys: Sequence[str]) -> str:
    predicate = partition_slice(frame, keys).first()["predicate"]
    if not predicate:
        raise ValueError("the frame is empty, there is no partition to describe")
    return predicate


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _columns(fields: Iterable[StructField]) -> str:
    return ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in fields)


def _evolve(spark: SparkSession, table: str, incoming: StructType) -> None:
    """Add the columns the table lacks; a changed type is refused."""
    known = {f.name.lower(): f.dataType.simpleString() for f in spark.table(table).schema}
    added = [f for f in incoming if f.name.lower() not in known]
    changed = [
        f"{f.name}: {known[f.name.lower()]} -> {f.dataType.simpleString()}"
        for f in incoming
        if known.get(f.name.lower(), f.dataType.simpleString()) != f.dataType.simpleString()
    ]
    if changed:
        raise ValueError(f"{table} would change column types: {changed}")
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(added)})")


def _create(
    spark: SparkSession, table: str, schema: StructType, keys: Sequence[str] = ()
) -> None:
    by = f" PARTITIONED BY ({', '.join(map(_quoted, keys))})" if keys else ""
    spark.sql(f"CREATE TABLE {table} ({_columns(schema)}) USING parquet{by}")


@contextmanager
def _settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    usual = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in usual.items():
            spark.conf.set(name, value)


def whole_timestamps(spark: SparkSession) -> AbstractContextManager[None]:
    """Write times as whole microseconds, not as the 12 bytes of Spark's default.

    These cost a hash of bytes each, and have no bounds in the footers to skip files by.
    """
    return _settings(spark, {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"})


def unsorted_writes(spark: SparkSession) -> AbstractContextManager[None]:
    """Let a task write several partitions at once, instead of sorting its rows by them.

    The sort would hold every row of a task, as wide as it is, where open files hold
    encoded columns. A task that meets more than ``OPEN_FILES`` partitions sorts the rest.
    """
    return _settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)})


def write_version(
    frame: DataFrame, directory: str, keys: Sequence[str], *, in_order: bool = False
) -> str:
    """Write rows by ``keys`` below a fresh directory in ``directory``, and return it.

    ``in_order`` is for rows already sorted by ``keys`` inside each task.
    """
    fresh, spark = f"{directory}/{uuid4().hex}", frame.sparkSession
    with whole_timestamps(spark), nullcontext() if in_order else unsorted_writes(spark):
        frame.write.partitionBy(*keys).parquet(fresh)
    return fresh


def written(spark: SparkSession, version: str) -> dict[tuple[str, ...], str]:
    """Partition directories of a version by their values, as directories spell them.

    Files are listed, not read; there is one directory per month.
    """
    leaf = F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("leaf")
    leaves = [row.leaf for row in _parquet_files(spark, version).select(leaf).distinct().collect()]
    mark = version.rsplit("/", 1)[1]
    return {
        tuple(part.split("=", 1)[1] for part in leaf.split(f"/{mark}/", 1)[1].split("/")): leaf
        for leaf in leaves
    }


def _specification(keys: Sequence[str], values: Sequence[str]) -> str:
    """Partition clause of directory values."""
    parts = (
        f"{_quoted(k)} = {'null' if v == _NO_VALUE else _text(unquote(v))}"
        for k, v in zip(keys, values)
    )
    return f"PARTITION ({', '.join(parts)})"


def switch_partitions(
    spark: SparkSession, table: str, keys: Sequence[str], found: Mapping[tuple[str, ...], str]
) -> None:
    """Point partitions at directories: known ones one by one, new ones in one statement."""
    known = partition_values(spark, table)
    for values in sorted(known.intersection(found)):
        spark.sql(
            f"ALTER TABLE {table} {_specification(keys, values)} SET LOCATION {_text(found[values])}"
        )
    new = [
        f"{_specification(keys, values)} LOCATION {_text(found[values])}"
        for values in sorted(found.keys() - known)
    ]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD {' '.join(new)}")
    spark.catalog.refreshTable(table)


def partition_values(spark: SparkSession, table: str) -> set[tuple[str, ...]]:
    """Values of each partition, as directories spell them."""
    return {tuple(part.split("=", 1)[1] for part in name.split("/")) for name in partitions(spark, table)}


def versions_of(spark: SparkSession, table: str) -> str:
    """Directory of what ``replace_partitions`` writes for a table."""
    return f"{table_location(spark, table)}/{VERSIONS}"


def drop_partitions(
    spark: SparkSession, table: str, keys: Sequence[str], gone: Iterable[tuple[str, ...]]
) -> None:
    for values in sorted(gone):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_specification(keys, values)}")
    spark.catalog.refreshTable(table)


def ensure_table(
    spark: SparkSession, table: str, schema: StructType, keys: Sequence[str] = ()
) -> bool:
    """Create the table, or add the columns it lacks; whether it was there."""
    there = table_exists(spark, table)
    if there:
        _evolve(spark, table, schema)
    else:
        _create(spark, table, schema, keys)
    return there


def replace_partitions(
    frame: DataFrame,
    table: str,
    keys: Sequence[str],
    comment: str | None = None,
    *,
    rebalance: bool = False,
    sort_by: Sequence[str] = (),
) -> None:
    """Write ``frame``, replacing the partitions it carries and no others.

    The first call creates the table. Later calls may add columns. An empty
    frame creates an empty table, but is an error once the table exists. ``frame``
    may read the table.

    ``rebalance`` gathers rows by partition first. It is for input that is not
    already laid out by ``keys``: without it each task would leave a small file
    in each partition it meets. Adaptive execution sizes the result, so a month
    holding a third of the rows is split over many tasks, and many small months
    share one. ``sort_by`` orders rows inside each file, which narrows the
    min/max of its row groups.
    """
    spark = frame.sparkSession
    there = ensure_table(spark, table, frame.schema, keys)
    laid_out = frame.hint("rebalance", *keys) if rebalance else frame
    if sort_by:
        laid_out = laid_out.sortWithinPartitions(*keys, *sort_by)
    version = write_version(laid_out, versions_of(spark, table), keys, in_order=bool(sort_by))
    found = written(spark, version)
    if there and not found:
        raise ValueError(f"the frame is empty, nothing to write to {table}")
    switch_partitions(spark, table, keys, found)
    comment_table(spark, table, comment)


def replace_all(
    frame: DataFrame,
    table: str,
    keys: Sequence[str],
    comment: str | None = None,
    scope: Iterable[tuple[str, ...]] | None = None,
) -> None:
    """Write ``frame`` and drop the partitions of ``scope`` that it does not carry.

    ``scope`` is by default the whole table. An empty frame empties it.
    """
    spark = frame.sparkSession
    ensure_table(spark, table, frame.schema, keys)
    found = written(spark, write_version(frame, versions_of(spark, table), keys))
    switch_partitions(spark, table, keys, found)
    there = partition_values(spark, table)
    gone = (there if scope is None else there.intersection(scope)) - found.keys()
    drop_partitions(spark, table, keys, gone)
    comment_table(spark, table, comment)


def locations(spark: SparkSession, table: str) -> dict[tuple[str, ...], str]:
    """Where each partition's files lie; a statement per partition, and so per month."""
    found = {}
    for name in partitions(spark, table):
        keys, values = zip(*(part.split("=", 1) for part in name.split("/")))
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {_specification(keys, values)}")
        at = described.where("col_name = 'Location'").first()["data_type"]
        found[values] = at
    return found


def vacuum(
    spark: SparkSession, directory: str, tables: Iterable[str], keep_hours: float = 168
) -> list[str]:
    """Delete partition directories below ``directory`` that no table points at.

    Only those whose files are all older than ``keep_hours`` go, so that readers and
    writers at work keep theirs. ``tables`` must name every table that may point there.
    """
    used = {_plain(at) for table in tables for at in locations(spark, table).values()}
    try:
        files = _parquet_files(spark, directory)
    except AnalysisException:
        return []
    leaf = F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("leaf")
    old = F.max("modificationTime") < F.current_timestamp() - F.make_dt_interval(
        mins=F.lit(keep_hours * 60).cast("int")
    )
    aged = files.groupBy(leaf).agg(old.alias("old")).where("old").collect()
    gone = [row.leaf for row in aged if _plain(row.leaf) not in used]
    for path in map(spark._jvm.org.apache.hadoop.fs.Path, gone):
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def _plain(location: str) -> str:
    """A path without the scheme's optional slashes, to compare spellings of one place."""
    scheme, rest = location.split(":", 1) if ":" in location else ("file", location)
    return f"{scheme}:/{unquote(rest).lstrip('/')}"


def _write_aside(frame: DataFrame, table: str) -> str:
    """Write the frame to a new table beside ``table``; nothing stays on failure."""
    spark, aside = frame.sparkSession, f"{table}__{uuid4().hex[:12]}"
    _create(spark, aside, frame.schema)
    try:
        frame.write.mode("overwrite").parquet(table_location(spark, aside))
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        raise
    return aside


def _take_place(spark: SparkSession, aside: str, table: str) -> None:
    """Let the finished table ``aside`` become ``table``.

    Only names and directories change. If this is interrupted, all rows are
    still there under one of the two names.
    """
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")


def overwrite_table(frame: DataFrame, table: str, comment: str | None = None) -> None:
    """Replace a table, schema included.

    The new rows are complete in a table of their own before the old ones go,
    so a failed job leaves the old table, and ``frame`` may read it.
    """
    spark = frame.sparkSession
    _take_place(spark, _write_aside(frame, table), table)
    comment_table(spark, table, comment)


def _parquet_files(spark: SparkSession, *directories: str) -> DataFrame:
    """Files below directories, from the listing alone."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return reader.option("recursiveFileLookup", True).load(list(directories)).drop("content")


def table_bytes(spark: SparkSession, table: str, only: Iterable[str] | None = None) -> int:
    """Size of the files of a partitioned table, or of the locations named."""
    places = list(locations(spark, table).values() if only is None else only)
    if not places:
        return 0
    files = _parquet_files(spark, *places)
    return files.agg(F.sum("length").alias("bytes")).first()["bytes"] or 0


def _rank_of(value: Column, bounds: Sequence[float]) -> Column:
    """How many of the sorted bounds a value reaches, found among groups of bounds first."""
    if not bounds:
        return F.lit(0)
    step = max(1, ceil(len(bounds) ** 0.5))
    groups = [list(bounds[i : i + step]) for i in range(0, len(bounds), step)]
    firsts = F.array(*(F.lit(group[0]) for group in groups))
    group = F.size(F.filter(firsts, lambda bound: bound <= value))
    nested = F.array(*(F.array(*map(F.lit, group)) for group in groups))
    inside = F.size(F.filter(F.element_at(nested, F.greatest(group, F.lit(1))), lambda bound: bound <= value))
    return F.coalesce(F.when(group > 0, (group - 1) * step + inside), F.lit(0))


def interleaved(rows: DataFrame, by: Sequence[str], bits: int = INTERLEAVED_BITS) -> Column:
    """A whole number that keeps rows near in every column of ``by`` near each other.

    Each value becomes its rank among 2 ** bits quantiles of its column, so that columns
    of any scale and skew weigh the same; the bits of the ranks take turns. Numbers, times
    and texts are ranked, texts by their first six bytes. Missing values come first. Quantiles
    are bounds from one scan of these columns, 2 ** bits numbers for each.
    """
    kinds = dict(rows.dtypes)

    def number(name: str) -> Column:
        if kinds[name] == "string":
            return F.conv(F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
        if kinds[name].startswith("timestamp") or kinds[name] == "date":
            return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
        return F.col(name).cast("double")

    shares = F.array(*(F.lit(i / 2**bits) for i in range(1, 2**bits)))
    sketches = rows.agg(*(F.kll_sketch_agg_double(number(name), 2048).alias(f"s{i}") for i, name in enumerate(by)))
    bounds = sketches.select(
        *(
            F.when(F.kll_sketch_get_n_double(f"s{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", shares)).alias(f"s{i}")
            for i in range(len(by))
        )
    ).first()
    ranks = [_rank_of(number(name), bounds[i] or []).cast("long") for i, name in enumerate(by)]
    turns = [
        F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(by) + i)
        for i, rank in enumerate(reversed(ranks))
        for bit in range(bits)
    ]
    return reduce(Column.bitwiseOR, turns)


def cluster_table(
    spark: SparkSession,
    table: str,
    keys: Sequence[str],
    by: Sequence[str],
    file_bytes: int = 256 * 1024 * 1024,
    only: Iterable[tuple[str, ...]] | None = None,
    interleave: bool = False,
    file_rows: int = 4_000_000,
) -> None:
    """Rewrite partitions with files that hold disjoint ranges of ``by``.

    With ``interleave`` the columns of ``by`` count alike, and filters on any of them skip
    files; without, the first one leads. ``only`` names the partitions, by values; by default
    all. A range is one task, which sorts its rows decoded, many times their size in files
    that compress well; so it has about ``file_rows`` rows at most, or ``file_bytes`` of the
    table's files where that is less. Ranges end with a hash of each row's file and position. That is stable when a
    task is run again, and splits a value (or a row) repeated any number of times. A
    partition's clustered copy is complete before it takes the partition's place.
    """
    places = locations(spark, table)
    chosen = set(places) if only is None else set(places).intersection(only)
    if not chosen:
        return
    rows = spark.table(table)
    if only is not None:
        rows = rows.where(_is_one_of(keys, chosen))
    stored = table_bytes(spark, table, (places[v] for v in chosen))
    files = max(1, ceil(stored / file_bytes), ceil(rows.count() / file_rows))
    own = {"_tie": F.xxhash64("_metadata.file_path", "_metadata.row_index")}
    order = [*keys, *by]
    if interleave:
        own["_curve"] = interleaved(rows, by)
        order = [*keys, "_curve"]
    clustered = (
        rows.select(*rows.columns, *(value.alias(name) for name, value in own.items()))
        .repartitionByRange(files, *order, "_tie")
        .sortWithinPartitions(*order)
        .drop(*own)
    )
    version = write_version(clustered, versions_of(spark, table), keys, in_order=True)
    switch_partitions(spark, table, keys, written(spark, version))


def _is_one_of(keys: Sequence[str], partitions: Iterable[tuple[str, ...]]) -> Column:
    """Whether a row is in one of the partitions, for the catalog to prune by."""

    def same(key: str, value: str) -> Column:
        return F.col(key).isNull() if value == _NO_VALUE else F.col(key) == unquote(value)

    each = [
        reduce(Column.__and__, (same(k, v) for k, v in zip(keys, values)))
        for values in sorted(partitions)
    ]
    return reduce(Column.__or__, each, F.lit(False))


def analyze_table(
    spark: SparkSession, table: str, columns: Sequence[str] | None = None
) -> None:
    """Row count and column statistics for the optimizer; by default all columns."""
    which = f"COLUMNS {', '.join(map(_quoted, columns))}" if columns else "ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR {which}")


def analyze_partitions(
    spark: SparkSession, table: str, keys: Sequence[str], values: Iterable[tuple[str, ...]]
) -> None:
    """Row count and size of the partitions named; no file of any other is read."""
    for partition in sorted(values):
        which = _specification(keys, partition)
        spark.sql(f"ANALYZE TABLE {table} {which} COMPUTE STATISTICS")


def partition_rows(spark: SparkSession, table: str, keys: Sequence[str]) -> dict[tuple[str, ...], int | None]:
    """Rows of each partition as the catalog knows them; None where it does not."""
    found = {}
    for values in partition_values(spark, table):
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {_specification(keys, values)}")
        known = described.where("col_name = 'Partition Statistics'").first()
        rows = known and re.search(r"(\d+) rows", known["data_type"])
        found[values] = int(rows[1]) if rows else None
    return found


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {table}")
