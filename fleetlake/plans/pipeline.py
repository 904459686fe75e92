"""The layers end to end: landing -> raw -> trusted -> refined and quality.

Each step reads the tables before it, writes its own, and returns what it wrote
as a table scan, so that using the result does not compute it again.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetlake.model import EVENT_MONTH, FILE_MONTH, FLEETS, REASONS, Fleet, Lake, Limits
from fleetlake.operators import marts, quality
from fleetlake.operators.shaping import apply_contract
from fleetlake.operators.trips import all_fleets
from fleetlake.plans import exploration
from fleetlake.sinks import tables
from fleetlake.sources.landing import Months, covers, in_months, inventory, read_landing, require_months

CLUSTER_BY = ("trip_type", "pickup_datetime")

#: Where a judged trip is written: which table it is for, and that table's partition.
SIDE, ACCEPTED, REJECTED = "_side", "accepted", "rejected"
PLACE = (SIDE, "_year", "_month")

#: Properties of the fact and the marts: which load they come from.
LOAD, PREVIOUS = "fleetlake.load", "fleetlake.load.previous"

#: Event months as YYYY-MM.
Events = Collection[str]


def in_events(events: Events) -> Column:
    """Whether the event month is one of ``events``; partitions of the fact are pruned by it."""
    return F.concat_ws("-", *EVENT_MONTH).isin(sorted(events))


@dataclass(frozen=True)
class Pipeline:
    spark: SparkSession
    lake: Lake
    limits: Limits = field(default_factory=Limits)
    fleets: tuple[Fleet, ...] = FLEETS

    def setup(self) -> None:
        tables.create_databases(self.spark, self.lake)

    def load_raw(self, fleet: Fleet, months: Months | None = None) -> DataFrame:
        """Landed files are laid out by month already, so nothing is shuffled.

        ``months`` limits what is read and replaced, here and in the next layer.
        """
        table = self.lake.raw(fleet)
        tables.replace_partitions(
            read_landing(self.spark, self.lake.landing_root(fleet), months),
            table,
            FILE_MONTH,
            comment=f"{fleet.name} trips as landed: every column text, every row kept",
        )
        return self.spark.table(table)

    def load_trusted(self, fleet: Fleet, months: Months | None = None) -> DataFrame:
        """One projection over the raw table; the month layout carries over."""
        table = self.lake.trusted(fleet)
        raw = self.spark.table(self.lake.raw(fleet)).where(in_months(months))
        tables.replace_partitions(
            apply_contract(raw, fleet.contract()),
            table,
            FILE_MONTH,
            comment=f"{fleet.name} trips: selected columns, typed, not filtered",
        )
        return self.spark.table(table)

    def trips(self) -> DataFrame:
        """Canonical trips of all fleets, before any rule."""
        return all_fleets({f: self.spark.table(self.lake.trusted(f)) for f in self.fleets})

    @property
    def rules(self) -> tuple[quality.Rule, ...]:
        return quality.standard_rules(self.limits)

    @property
    def loads(self) -> str:
        """Directory of the files that fact and quarantine point at."""
        return f"{tables.table_location(self.spark, self.lake.fact).rsplit('/', 1)[0]}/_loads"

    def loaded(self) -> bool:
        """Whether fact, quarantine and report are there, and so no load was interrupted."""
        stored = (self.lake.fact, self.lake.quarantine, self.lake.report)
        return all(tables.table_exists(self.spark, table) for table in stored)

    def touched_events(self, months: Months) -> Events:
        """Event months that accepted trips of these file months have now, or have in the fact.

        A distinct over the changed months of the trusted tables, and over the fact, of which
        only row groups with these file months are read.
        """
        found = quality.accepted(self.trips().where(in_months(months)), self.rules).select(*EVENT_MONTH)
        if tables.table_exists(self.spark, self.lake.fact):
            stored = self.spark.table(self.lake.fact).where(in_months(months))
            found = found.unionByName(stored.select(*EVENT_MONTH))
        return frozenset("-".join(row) for row in found.distinct().collect())

    def _contributing(self, months: Months, events: Events) -> Column:
        """Whether a file month is one of ``months`` or has trips in these event months."""
        stored = self.spark.table(self.lake.fact).where(in_events(events))
        others = ["-".join(row) for row in stored.select(*FILE_MONTH).distinct().collect()]
        return in_months(months) | F.concat_ws("-", *FILE_MONTH).isin(others)

    def _replaced(self, months: Months, events: Events) -> Mapping[str, int]:
        """Counts for the report of the stored trips of ``months``."""
        fact = self.spark.table(self.lake.fact).where(in_events(events))
        none = F.lit(None).cast("array<string>").alias(REASONS)
        both = fact.select("*", none).unionByName(self.spark.table(self.lake.quarantine))
        return both.where(in_months(months)).agg(*quality.rule_counts(self.rules)).first().asDict()

    def judged(
        self, observation: Observation, months: Months | None = None, events: Events | None = None
    ) -> DataFrame:
        """Trips with their reasons, as they are written once for fact and quarantine.

        ``PLACE`` names the partition: an accepted trip goes by its event month, a rejected
        one by its file month, for its event may be missing or absurd. Counts for the
        report are taken behind the exchange, where the rows are written: Spark takes the
        numbers of a task that writes once however often it runs, but those of a task
        before an exchange again with each run.

        With ``months``, accepted trips of ``events`` and rejected trips of ``months``, read
        from the file months that have any; those of ``months`` are counted.
        """
        trips = self.trips()
        if months is not None:
            trips = trips.where(self._contributing(months, events))
        rejected = F.col(SIDE) == REJECTED
        place = [
            F.when(rejected, F.col(of_file)).otherwise(F.col(of_event)).alias(name)
            for name, of_file, of_event in zip(PLACE[1:], FILE_MONTH, EVENT_MONTH)
        ]
        sides = quality.with_reasons(trips, self.rules).withColumn(
            SIDE, F.when(F.size(REASONS) > 0, REJECTED).otherwise(ACCEPTED)
        )
        if months is not None:
            sides = sides.where(F.when(rejected, in_months(months)).otherwise(in_events(events)))
        return (
            sides.withColumn(REASONS, F.when(rejected, F.col(REASONS)))
            .select("*", *place)
            .hint("rebalance", *PLACE)
            .observe(observation, *quality.rule_counts(self.rules, in_months(months)))
            .sortWithinPartitions(*PLACE, *CLUSTER_BY)
        )

    def load_fact(
        self, months: Months | None = None, events: Events | None = None
    ) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Fact, quarantine and rule report, from one scan of the trusted tables.

        One write makes the files of both tables and counts the report on the way; then
        the catalog is pointed at them. Nothing is held in memory between the steps.

        With ``months``, only these file months have changed since the last load. The event
        months they touch (``events``, found here if not given) are written anew from the file
        months that have trips in them, the quarantine of ``months`` is replaced, and the
        report is that of before, less what is replaced, plus what is counted now. The
        report goes before the catalog changes and comes back after, so that the next
        load after an interrupted one is a full one. Without ``months`` event months that no
        trip has any more stay, as in any partition replace.
        """
        lake, spark, rules = self.lake, self.spark, self.rules
        if not self.loaded():
            months = None
        counts = dict.fromkeys(quality.count_names(rules), 0)
        if months is not None:
            events = self.touched_events(months) if events is None else events
            before, gone = quality.counts_of_report(spark.table(lake.report), rules), self._replaced(months, events)
            counts = {name: before[name] - gone[name] for name in counts}
        trips = self.trips()
        tables.ensure_table(spark, lake.fact, trips.schema, EVENT_MONTH)
        with_reasons = quality.with_reasons(trips, rules)
        tables.ensure_table(spark, lake.quarantine, with_reasons.schema, FILE_MONTH)

        observation = Observation()
        version = tables.write_version(self.judged(observation, months, events), self.loads, PLACE, in_order=True)
        found = tables.written(spark, version)
        if found:
            counts = {name: n + observation.get[name] for name, n in counts.items()}

        spark.sql(f"DROP TABLE IF EXISTS {lake.report}")
        accepted, rejected = ({v[1:]: at for v, at in found.items() if v[0] == side} for side in (ACCEPTED, REJECTED))
        tables.switch_partitions(spark, lake.fact, EVENT_MONTH, accepted)
        tables.switch_partitions(spark, lake.quarantine, FILE_MONTH, rejected)
        quarantined = tables.partition_values(spark, lake.quarantine)
        if months is not None:
            tables.drop_partitions(spark, lake.fact, EVENT_MONTH, {tuple(e.split("-", 1)) for e in events} - set(accepted))
            quarantined = {v for v in quarantined if covers(months, "-".join(v))}
        tables.drop_partitions(spark, lake.quarantine, FILE_MONTH, quarantined - set(rejected))
        tables.comment_table(spark, lake.fact, "Accepted trips of every fleet, by month of the event")
        tables.comment_table(spark, lake.quarantine, "Rejected trips with the names of the rules they failed, by file month")
        tables.overwrite_table(
            quality.report_of_counts(spark, counts, rules).withColumn("measured_at", F.current_timestamp()),
            lake.report,
            comment="Rows evaluated and failed per rule in the latest run",
        )
        load = {LOAD: version.rsplit("/", 1)[1], PREVIOUS: tables.property_of(spark, lake.fact, LOAD) or ""}
        tables.set_properties(spark, lake.fact, load)
        return tuple(spark.table(table) for table in (lake.fact, lake.quarantine, lake.report))

    def load_marts(self, events: Events | None = None) -> tuple[DataFrame, DataFrame]:
        """Both marts; with ``events`` only the groups of these event months are made anew.

        The monthly one is read off stored states, of which whole months are replaced. The
        marts note which load of the fact they follow; where it is not the one before the
        latest, other months may have changed as well, and all groups are made.
        """
        lake, spark = self.lake, self.spark
        fact = spark.table(lake.fact)
        latest, previous = (tables.property_of(spark, lake.fact, name) for name in (LOAD, PREVIOUS))
        known = tables.table_exists(spark, lake.monthly_states) and tables.table_exists(spark, lake.hourly)
        if not known or tables.property_of(spark, lake.hourly, LOAD) != previous:
            events = None
        changed = fact if events is None else fact.where(in_events(events))
        tables.replace_all(
            marts.monthly_states(changed),
            lake.monthly_states,
            EVENT_MONTH,
            comment="Sums and quantile states per fleet and month, which merge",
            scope=None if events is None else {tuple(e.split("-", 1)) for e in events},
        )
        tables.overwrite_table(
            marts.monthly_of_states(spark.table(lake.monthly_states)).orderBy(*marts.MONTH_KEYS),
            lake.monthly,
            comment="Volume, revenue and ticket per fleet and month",
        )
        hourly = marts.hourly_mart(changed)
        if events is not None:
            hourly = hourly.unionByName(spark.table(lake.hourly).where(~in_events(events)))
        tables.overwrite_table(
            hourly.orderBy(*marts.HOUR_KEYS),
            lake.hourly,
            comment="Trips and positive passenger counts per fleet, month and hour",
        )
        # the last write, so that an interrupted run is not taken for a finished one
        tables.set_properties(spark, lake.hourly, {LOAD: latest or ""})
        return spark.table(lake.monthly), spark.table(lake.hourly)

    def load_profile(self, fleet: Fleet, months: Months | None = None) -> DataFrame:
        """The column profile of a trusted table, from states stored per file month.

        With ``months`` only these are read; the others' states are as good as their rows.
        """
        table, spark = self.lake.profile_states(fleet), self.spark
        trusted = spark.table(self.lake.trusted(fleet)).where(in_months(months))
        scope = None
        if months is not None and tables.table_exists(spark, table):
            scope = {v for v in tables.partition_values(spark, table) if covers(months, "-".join(v))}
        tables.replace_all(
            exploration.profile_states(trusted, fleet),
            table,
            FILE_MONTH,
            comment=f"Profile of {fleet.name} trips per file month, which merges",
            scope=scope,
        )
        return exploration.profile_of_states(spark.table(table))

    def optimize(self, events: Events | None = None, keep_hours: float = 168) -> None:
        """Cluster the fact by time and fleet, collect column statistics, delete unused files.

        ``events`` limits the rewriting to these event months.
        """
        lake, only = self.lake, None if events is None else [tuple(e.split("-", 1)) for e in events]
        tables.cluster_table(self.spark, lake.fact, EVENT_MONTH, CLUSTER_BY, only=only)
        tables.analyze_table(self.spark, lake.fact)
        tables.vacuum(self.spark, self.loads, (lake.fact, lake.quarantine), keep_hours)
        layers = [table(fleet) for table in (lake.raw, lake.trusted) for fleet in self.fleets]
        for table in filter(lambda t: tables.table_exists(self.spark, t), (lake.fact, *layers)):
            tables.vacuum(self.spark, tables.versions_of(self.spark, table), (table,), keep_hours)

    def run(self, fleets: Iterable[Fleet] | None = None, months: Months | None = None) -> None:
        """Every layer once. ``fleets`` limits what is ingested; ``months`` limits all layers to
        what these file months change, which gives the same tables as a run over all of them."""
        self.setup()
        for fleet in fleets or self.fleets:
            self.load_raw(fleet, months)
            self.load_trusted(fleet, months)
        self.follow(months)

    def follow(self, months: Months | None = None) -> None:
        """Fact, quarantine, report and marts after the trusted tables of ``months`` have changed."""
        events = self.touched_events(months) if months is not None and self.loaded() else None
        self.load_fact(None if events is None else months, events)
        self.load_marts(events)

    def require_landed(self, start: date, end: date) -> None:
        """Stop unless every month from ``start`` to ``end`` has a file, per fleet."""
        for fleet in self.fleets:
            landed = inventory(self.spark, self.lake.landing_root(fleet))
            require_months(landed, start, end)
