"""Shared folder, stored tables and connected components."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_written: list[tuple[SparkSession, str]] = []
_local: dict[str, str] = {}
_shipped: set[str] = set()
_PACKAGE = os.path.dirname(os.path.abspath(__file__))


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a temporary one where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _local:
        _local["dir"] = tempfile.mkdtemp(prefix="fleetlake-llm-")
    return _local["dir"]


@atexit.register
def _remove() -> None:
    for spark, path in _written:
        try:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # noqa: BLE001 - the session may have ended before
            return


def ship(spark: SparkSession) -> None:
    """Give executors this package, so that their Python needs no path of the driver."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(_PACKAGE))
    target = os.path.join(tempfile.mkdtemp(prefix="fleetlake-ship-"), "fleetlake_llm_files.zip")
    with zipfile.ZipFile(target, "w") as package:
        for folder in (os.path.dirname(_PACKAGE), _PACKAGE):
            for name in sorted(os.listdir(folder)):
                if name.endswith(".py") and (folder == _PACKAGE or name == "__init__.py"):
                    path = os.path.join(folder, name)
                    package.write(path, os.path.relpath(path, root))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def stored(frame: DataFrame) -> DataFrame:
    """The rows written as Parquet in the shared folder and read again: lineage ends there.

    The files go when the driver ends.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/fleetlake-llm-{uuid.uuid4().hex}"
    _written.append((spark, path))
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): one row (node, root) per node of an edge.

    Every round points each node at the neighbour, or itself, that comes first in a
    pseudo-random order, and replaces nodes by what they point at. About half of the
    nodes go in a round whatever the order of ids, so long chains take few rounds.
    Rounds are stored; nothing is collected. Null ends and loops are ignored, repeated
    edges count once, no edges give no rows. Roots are arbitrary members.
    """
    order = F.xxhash64
    left = stored(
        edges.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    steps: list[DataFrame] = []
    while not left.isEmpty():
        nearest = (
            left.union(left.select("b", "a"))
            .groupBy(F.col("a").alias("node"))
            .agg(F.min_by("b", order("b")).alias("best"))
        )
        earlier = (order("best") < order("node")) | (
            (order("best") == order("node")) & (F.col("best") < F.col("node"))
        )
        step = stored(nearest.select("node", F.when(earlier, F.col("best")).otherwise(F.col("node")).alias("root")))
        steps.append(step)
        moved = (
            left.join(step.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct()
        )
        left = stored(moved)
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = steps[0]
    for step in steps[1:]:
        onward = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found
