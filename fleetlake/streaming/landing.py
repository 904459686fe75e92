"""Landing files as a stream: each run takes the files that no run before it took.

The file source's own log in the checkpoint says which files are new. A batch is the
list of new files, not their rows: their months are read and replaced as whole
partitions by the batch reader, which knows drifting schemas. Replacing a partition again
gives the same partition, so a batch that failed half way is simply run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.model import FILE_MONTH, Fleet
from fleetlake.plans.pipeline import Pipeline
from fleetlake.sources.landing import ref_month_of

# Fixed value: columns of Spark's binary file source.
_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, root: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of landed files: path, size and month. Contents are never read."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    year, month = ref_month_of(F.col("path"))
    return reader.load(root).select(
        "path", F.col("length").alias("size_bytes"), year.alias(FILE_MONTH[0]), month.alias(FILE_MONTH[1])
    )


def months_of(files: DataFrame) -> list[str]:
    """File months of some landed files, as YYYY-MM; a file outside the layout is an error."""
    months = files.groupBy(*FILE_MONTH).agg(F.min("path").alias("example")).orderBy(*FILE_MONTH).collect()
    strays = [row.example for row in months if not row.ref_year]
    if strays:
        raise ValueError(f"path outside the expected layout: {strays[0]}")
    return [f"{row.ref_year}-{row.ref_month}" for row in months]


def take_new_files(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    load: Callable[[str], None],
    files_per_batch: int | None = None,
) -> list[str]:
    """Call ``load`` with each month that has files no earlier call took, and return the months.

    Files count as taken when every month of their batch is loaded.
    """

    def each(months: list[str]) -> None:
        for month in months:
            load(month)

    return take_new_batches(spark, root, checkpoint, each, files_per_batch)


def take_new_batches(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    load: Callable[[list[str]], None],
    files_per_batch: int | None = None,
) -> list[str]:
    """The same with all months of a batch in one call, which can load them side by side."""
    taken: list[str] = []

    def batch(files: DataFrame, _: int) -> None:
        if months := months_of(files):
            load(months)
            taken.extend(months)

    query = (
        new_files(spark, root, files_per_batch)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(batch)
        .start()
    )
    query.awaitTermination()
    return sorted(set(taken))


def follow(pipeline: Pipeline, checkpoint: str, files_per_batch: int | None = None) -> dict[Fleet, list[str]]:
    """Bring all layers up to the landed files; layers without new files are left alone.

    Raw and trusted follow batch by batch, all months of a batch in one job; fact, quarantine, report and marts follow once,
    by the event months that the new file months touch. If that last step fails, its
    months are still marked below ``checkpoint``, and the next call makes up for them.
    """
    spark = pipeline.spark
    pipeline.setup()
    taken: dict[Fleet, list[str]] = {}
    for fleet in pipeline.fleets:

        def load(months: list[str], fleet: Fleet = fleet) -> None:
            pipeline.load_raw(fleet, frozenset(months))
            pipeline.load_trusted(fleet, frozenset(months))
            for month in months:
                _mark(spark, checkpoint, month)

        root = pipeline.lake.landing_root(fleet)
        taken[fleet] = take_new_batches(spark, root, f"{checkpoint}/{fleet.name}", load, files_per_batch)
    # together, for a month's trips may lie in event months that another one touches too
    if open_months := _marked(spark, checkpoint):
        pipeline.follow(frozenset(open_months))
        for month in open_months:
            _mark(spark, checkpoint, month, done=True)
    return taken


def _marks(spark: SparkSession, checkpoint: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/open_months")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    return path, files


def _mark(spark: SparkSession, checkpoint: str, month: str, done: bool = False) -> None:
    """An empty file for each month whose trusted rows the fact does not follow yet."""
    path, files = _marks(spark, checkpoint)
    mark = spark._jvm.org.apache.hadoop.fs.Path(path, month)
    if done:
        files.delete(mark, False)
    else:
        files.create(mark, True).close()


def _marked(spark: SparkSession, checkpoint: str) -> list[str]:
    path, files = _marks(spark, checkpoint)
    return sorted(status.getPath().getName() for status in files.listStatus(path))
