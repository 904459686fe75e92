"""Landing directory -> one all-string frame with lineage.

Files are laid out as ``ref_year=YYYY/ref_month=MM/*.parquet`` and their schemas
drift. Spark reads files of compatible schemas in one scan, so the plan gets one
branch per schema, not per file.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from fleetlake.functions.naming import snake_names
from fleetlake.model import FILE_MONTH, INGESTED_AT, SOURCE_FILE, Fleet
from fleetlake.operators.shaping import column

# Directory layout and published file name.
_MONTH_DIRECTORY = r"ref_year=(\d{4})/ref_month=(\d{2})"
_PUBLISHED_NAME = r"(yellow|green)_tripdata_(\d{4})-(\d{2})\.parquet$"

#: Months as YYYY-MM: first and last of a range, both included, or a set of them.
Months = tuple[str, str] | frozenset[str]


def ref_month_of(path: Column) -> tuple[Column, Column]:
    """Year and month text of a landing path; both empty when it has none."""
    # not translate, which looks up every character of every path
    forward = F.replace(path, F.lit("\\"), F.lit("/"))
    return tuple(F.regexp_extract(forward, _MONTH_DIRECTORY, part) for part in (1, 2))


def route_by_name(name: Column) -> Column:
    """Fleet and month of a published file name; NULL fields when it is no match."""
    fields = ("trip_type", *FILE_MONTH)
    return F.struct(
        *(
            F.nullif(F.regexp_extract(name, _PUBLISHED_NAME, part), F.lit("")).alias(field)
            for part, field in enumerate(fields, start=1)
        )
    )


def _parquet_files(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return reader.option("recursiveFileLookup", True).load(path).select("path", "length")


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Landed files: path, size, month. Reads the listing, never the contents.

    Each directory is listed once, however many files it holds. Directories inside
    a month belong to it, here as in reading.
    """
    months = f"{root.rstrip('/')}/ref_year=*/ref_month=*"
    try:
        files = _parquet_files(spark, months)
    except AnalysisException as missing:
        raise ValueError(f"no parquet file under {root}") from missing
    year, month = ref_month_of(F.col("path"))
    return files.select(
        "path",
        F.col("length").alias("size_bytes"),
        F.round(F.col("length") / F.lit(1024 * 1024), 1).alias("size_mb"),
        year.alias(FILE_MONTH[0]),
        month.alias(FILE_MONTH[1]),
    )


def months_between(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Every month from ``start`` to ``end``, both included; days do not count."""
    if (start.year, start.month) > (end.year, end.month):
        raise ValueError(f"start {start} is after end {end}")
    first, last = (F.lit(d.replace(day=1)).cast("date") for d in (start, end))
    months = F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month")
    return spark.range(1).select(months).select(
        F.date_format("month", "yyyy").alias(FILE_MONTH[0]),
        F.date_format("month", "MM").alias(FILE_MONTH[1]),
    )


def missing_months(landed: DataFrame, start: date, end: date) -> DataFrame:
    """Expected months with no landed file."""
    expected = months_between(landed.sparkSession, start, end)
    present = landed.select(*FILE_MONTH).distinct()
    return expected.join(present, list(FILE_MONTH), "left_anti")


def require_months(landed: DataFrame, start: date, end: date) -> None:
    missing = missing_months(landed, start, end).orderBy(*FILE_MONTH).collect()
    if missing:
        raise ValueError(f"months not landed: {['-'.join(row) for row in missing]}")


@dataclass(frozen=True)
class SchemaGroup:
    """Paths that one scan can read, and the columns that scan has."""

    paths: tuple[str, ...]
    schema: StructType


def _common_schema(spark: SparkSession, paths: list[str]) -> StructType | None:
    """Merged footer schema of months (or files); None when their files conflict.

    All footers are read, by executors, so a column that only some files have is
    not missed. Any failure other than a conflict is the caller's.
    """
    conflict = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")
    reader = spark.read.option("mergeSchema", True).option("pathGlobFilter", "*.parquet")
    try:
        schema = reader.option("recursiveFileLookup", True).parquet(*paths).schema
        snake_names(schema.names)
    except (Py4JJavaError, PySparkException) as error:
        if any(code in str(error) for code in conflict):
            return None
        raise
    except ValueError:
        return None
    return schema


def _agreeing(spark: SparkSession, paths: list[str]) -> Iterator[SchemaGroup]:
    """Runs of paths whose footers merge.

    One job merges all footers. Only where they conflict are the paths halved and
    tried again, down to the files of a month that disagree, so that jobs grow
    with the conflicts and not with months or files.
    """
    schema = _common_schema(spark, paths)
    if schema is not None:
        yield SchemaGroup(tuple(paths), schema)
        return
    if len(paths) == 1:
        paths = _files_of(spark, paths[0])
    middle = len(paths) // 2
    for half in (paths[:middle], paths[middle:]):
        if half:
            yield from _agreeing(spark, half)


def schema_groups(spark: SparkSession, paths: list[str]) -> list[SchemaGroup]:
    """The paths (months, usually) in groups that one scan each can read.

    Groups of equal schema are one.
    """
    found = list(_agreeing(spark, paths))
    groups: dict[frozenset[tuple[str, str]], SchemaGroup] = {}
    for group in found:
        columns = frozenset((f.name, f.dataType.simpleString()) for f in group.schema)
        known = groups.get(columns, SchemaGroup((), group.schema))
        groups[columns] = SchemaGroup(known.paths + group.paths, known.schema)
    return list(groups.values())


def _files_of(spark: SparkSession, path: str) -> list[str]:
    files = [row.path for row in _parquet_files(spark, path).orderBy("path").collect()]
    if files == [path]:
        snake_names(spark.read.parquet(path).columns)  # says which names collide
        raise ValueError(f"the schema of {path} cannot be read")
    return files


def _read_group(spark: SparkSession, root: str, group: SchemaGroup) -> DataFrame:
    """One scan: strings, lineage, and the month as a real partition column.

    The month columns are declared as strings; left to inference ``01`` would
    become the number 1. Declared, they also prune directories.
    """
    owned = {*FILE_MONTH, SOURCE_FILE, INGESTED_AT}
    data = {f.name: n for f, n in zip(group.schema, snake_names(group.schema.names))}
    declared = StructType([f for f in group.schema if f.name.lower() not in FILE_MONTH])
    for name in FILE_MONTH:
        declared = declared.add(name, StringType())
    rows = (
        spark.read.schema(declared)
        .option("basePath", root)
        .option("pathGlobFilter", "*.parquet")
        .parquet(*group.paths)
    )
    return rows.select(
        *(
            column(source).cast("string").alias(name)
            for source, name in data.items()
            if name not in owned
        ),
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.current_timestamp().alias(INGESTED_AT),
        *FILE_MONTH,
    )


def in_months(months: Months | None) -> Column:
    """Whether the file month is one of ``months``; always where none are given."""
    if months is None:
        return F.lit(True)
    month = F.concat_ws("-", *FILE_MONTH)
    return month.between(*months) if isinstance(months, tuple) else month.isin(sorted(months))


def covers(months: Months | None, month: str) -> bool:
    """The same for one month."""
    if isinstance(months, tuple):
        return months[0] <= month <= months[1]
    return months is None or month in months


def read_landing(spark: SparkSession, root: str, months: Months | None = None) -> DataFrame:
    """Landed files of one fleet, united by name; absent columns are NULL.

    ``months`` limits what is opened; by default it is everything.
    """
    root = root.rstrip("/")
    landed = (
        inventory(spark, root)
        .groupBy(*FILE_MONTH)
        .agg(F.min("path").alias("example"))
        .orderBy(*FILE_MONTH)
        .collect()
    )
    if not landed:
        raise ValueError(f"no parquet file under {root}")
    strays = [m.example for m in landed if not m.ref_year]
    if strays:
        raise ValueError(f"path outside the expected layout: {strays[0]}")
    chosen = [m for m in landed if covers(months, f"{m.ref_year}-{m.ref_month}")]
    if not chosen:
        wanted = f"from {months[0]} to {months[1]}" if isinstance(months, tuple) else sorted(months)
        raise ValueError(f"no parquet file under {root} in months {wanted}")
    directories = [f"{root}/ref_year={m.ref_year}/ref_month={m.ref_month}" for m in chosen]
    parts = [_read_group(spark, root, g) for g in schema_groups(spark, directories)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def landed_months(spark: SparkSession, root: str, fleet: Fleet) -> DataFrame:
    """Files and size per landed month of a fleet."""
    return (
        inventory(spark, f"{root.rstrip('/')}/{fleet.name}")
        .groupBy(*FILE_MONTH)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("size_bytes"))
        .select(F.lit(fleet.name).alias("trip_type"), "*")
    )
