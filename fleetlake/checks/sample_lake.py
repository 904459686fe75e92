"""A whole lake built from the generated tables, for the queries about layers."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from fleetlake.model import FLEETS, Fleet, Lake
from fleetlake.operators import marts, quality
from fleetlake.operators.trips import all_fleets
from fleetlake.plans.pipeline import Pipeline
from fleetlake.sources import sample_trips
from fleetlake.streaming.landing import follow

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may go without: it gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError(f"set {_SETTING} to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="fleetlake-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


@dataclass
class Sample:
    """Frames over one directory of generated tables, all lazy, and the lake.

    The lake's layers are written when first asked for, once each.
    """

    spark: SparkSession
    directory: str
    name: str = field(default_factory=lambda: f"fleetlake_{uuid.uuid4().hex[:12]}")

    rules = quality.standard_rules(sample_trips.LIMITS)

    def derived(self, fleet: Fleet) -> DataFrame:
        """Trips computed from the order tables as they are read."""
        return sample_trips.sample_trips(self.spark, self.directory, fleet)

    @cached_property
    def fleets(self) -> dict[Fleet, DataFrame]:
        """The derived trips, stored.

        Queries start from stored columns, as they do in a lake. Rule conditions
        can then be pushed into the scan; over derived columns they would repeat
        the derivation in every condition.
        """
        stored = {f: f"{self.folder}/derived/{f.name}" for f in FLEETS}
        for fleet, path in stored.items():
            self.derived(fleet).write.mode("overwrite").parquet(path)
        return {fleet: self.spark.read.parquet(path) for fleet, path in stored.items()}

    def trusted(self, fleet: Fleet) -> DataFrame:
        return self.fleets[fleet]

    @cached_property
    def trips(self) -> DataFrame:
        return all_fleets(self.fleets)

    @cached_property
    def fact(self) -> DataFrame:
        return quality.accepted(self.trips, self.rules)

    @cached_property
    def quarantine(self) -> DataFrame:
        return quality.rejected(self.trips, self.rules)

    @cached_property
    def monthly(self) -> DataFrame:
        return marts.monthly_mart(self.fact)

    @cached_property
    def hourly(self) -> DataFrame:
        return marts.hourly_mart(self.fact)

    @cached_property
    def folder(self) -> str:
        return f"{shared_folder(self.spark)}/{self.name}"

    @cached_property
    def lake(self) -> Lake:
        return Lake(
            f"{self.folder}/landing",
            prefix=f"{self.name}_",
            location=f"{self.folder}/tables",
        )

    @cached_property
    def pipeline(self) -> Pipeline:
        pipeline = Pipeline(self.spark, self.lake, sample_trips.LIMITS)
        pipeline.setup()
        return pipeline

    @cached_property
    def landed(self) -> str:
        for fleet in FLEETS:
            sample_trips.land(self.spark, self.directory, fleet, self.lake.landing)
        return self.lake.landing

    @cached_property
    def raw_tables(self) -> dict[Fleet, DataFrame]:
        assert self.landed
        return {fleet: self.pipeline.load_raw(fleet) for fleet in FLEETS}

    @cached_property
    def trusted_tables(self) -> dict[Fleet, DataFrame]:
        assert self.raw_tables
        return {fleet: self.pipeline.load_trusted(fleet) for fleet in FLEETS}

    @cached_property
    def fact_tables(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        assert self.trusted_tables
        return self.pipeline.load_fact()

    @cached_property
    def mart_tables(self) -> tuple[DataFrame, DataFrame]:
        assert self.fact_tables
        return self.pipeline.load_marts()

    @cached_property
    def streamed(self) -> Pipeline:
        """A second lake, which took the landed files as a stream."""
        lake = Lake(self.landed, prefix=f"{self.name}_streamed_", location=f"{self.folder}/streamed")
        pipeline = Pipeline(self.spark, lake, sample_trips.LIMITS)
        follow(pipeline, f"{self.folder}/stream_checkpoint")
        return pipeline

    @cached_property
    def reloaded(self) -> Pipeline:
        """The second lake after one file month went through all layers once more."""
        month = "-".join(sample_trips.FOCUS)
        self.streamed.run(months=(month, month))
        return self.streamed

    def scratch_table(self, name: str) -> str:
        """A table of this lake that no other query uses."""
        assert self.pipeline
        return f"{self.lake.database('quality')}.{name}_{uuid.uuid4().hex[:8]}"


_samples: dict[tuple[int, str], Sample] = {}


def sample_of(spark: SparkSession, directory: str) -> Sample:
    """One sample per session and directory, so that stored data is shared."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # The sample keeps its session alive, so the identity is not used twice.
    return _samples.setdefault((id(spark), directory), Sample(spark, directory))
