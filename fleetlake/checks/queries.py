"""Registered queries: one per operator or report, over the generated tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from fleetlake.checks.sample_lake import Sample, sample_of
from fleetlake.model import (
    EVENT_MONTH,
    FILE_MONTH,
    FLEETS,
    GREEN,
    INGESTED_AT,
    REASONS,
    SOURCE_FILE,
    YELLOW,
)
from fleetlake.operators import marts, quality, shaping
from fleetlake.plans import answers, exploration
from fleetlake.plans.pipeline import CLUSTER_BY
from fleetlake.sinks import tables
from fleetlake.sources import landing, sample_trips

Query = Callable[[SparkSession, str], DataFrame]
_registered: dict[str, Query] = {}

YEAR, MONTH = sample_trips.FOCUS
# Wider than the data, so that months are missing on both sides.
COVERAGE = (date(1994, 11, 20), date(2002, 2, 10))

RULE_QUERIES = {
    "rule_pickup_null": "pickup_datetime_nulo",
    "rule_dropoff_null": "dropoff_datetime_nulo",
    "rule_duration_nonpositive": "duracao_nao_positiva",
    "rule_duration_over_24h": "duracao_acima_de_24h",
    "rule_outside_window": "fora_da_janela_de_analise",
    "rule_amount_null": "total_amount_nulo",
    "rule_amount_negative": "total_amount_negativo",
    "rule_passenger_missing": "passenger_count_ausente",
}


def _portable(frame: DataFrame) -> DataFrame:
    """Timestamps as wall-clock values, the type they have in the source tables."""
    return frame.select(
        *(
            shaping.column(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else shaping.column(f.name)
            for f in frame.schema
        )
    )


def _register(name: str, build: Callable[[Sample], DataFrame]) -> None:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        return _portable(build(sample_of(spark, directory)))

    _registered[name] = run


def _query(build: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
    _register(build.__name__, build)
    return build


def _money(frame: DataFrame, **digits: int) -> DataFrame:
    """Sums of doubles depend on their order in the last bits: rounded here only."""
    return frame.withColumns({name: F.round(name, n) for name, n in digits.items()})


def _rounded_monthly(monthly: DataFrame) -> DataFrame:
    return _money(monthly, total_revenue=2, avg_total_amount_per_trip=4)


def _rounded_hourly(hourly: DataFrame) -> DataFrame:
    return _money(hourly, avg_passenger_count=4)


def _reasons_text(frame: DataFrame) -> DataFrame:
    return frame.withColumn(REASONS, F.array_join(REASONS, ","))


def _both_fleets(frames: dict) -> DataFrame:
    """Tables of both fleets under shared names for the two time columns."""
    shared = [
        frame.withColumnsRenamed(
            {fleet.pickup: "pickup_datetime", fleet.dropoff: "dropoff_datetime"}
        ).withColumn("trip_type", F.lit(fleet.name))
        for fleet, frame in frames.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shared)


# --- sources, sinks and layers --------------------------------------------------


@_query
def landing_inventory(s: Sample) -> DataFrame:
    """Months found by listing the landing directories."""
    months = [landing.landed_months(s.spark, s.landed, fleet) for fleet in FLEETS]
    return reduce(DataFrame.unionByName, months).select(
        "trip_type",
        *FILE_MONTH,
        (F.col("files") > 0).alias("has_files"),
        (F.col("size_bytes") > 0).alias("has_bytes"),
    )


@_query
def landing_coverage(s: Sample) -> DataFrame:
    """Expected months with no file, per fleet."""
    gaps = [
        landing.missing_months(
            landing.inventory(s.spark, f"{s.landed}/{fleet.name}"), *COVERAGE
        ).withColumn("trip_type", F.lit(fleet.name))
        for fleet in FLEETS
    ]
    return reduce(DataFrame.unionByName, gaps)


@_query
def file_name_routing(s: Sample) -> DataFrame:
    """Files per fleet and month by their published name; NULL where it has none."""
    return (
        sample_trips.published_names(s.fleets)
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("linhas"))
        .select("name", landing.route_by_name(F.col("name")).alias("route"), "linhas")
        .select("name", "route.*", "linhas")
    )


@_query
def ref_month_from_path(s: Sample) -> DataFrame:
    """Rows per month, the month being read from each row's file path."""
    year, month = landing.ref_month_of(F.col("_metadata.file_path"))
    months = [
        s.spark.read.parquet(f"{s.landed}/{fleet.name}").select(
            year.alias("path_year"), month.alias("path_month")
        )
        for fleet in FLEETS
    ]
    return (
        reduce(DataFrame.unionByName, months)
        .groupBy("path_year", "path_month")
        .agg(F.count(F.lit(1)).alias("linhas"))
    )


def _with_lineage(raw: DataFrame) -> DataFrame:
    """Replace the run-dependent lineage values by what must hold for them."""
    year, month = landing.ref_month_of(F.col(SOURCE_FILE))
    return raw.withColumns(
        {
            "file_year": year,
            "file_month": month,
            "stamped": F.col(INGESTED_AT).isNotNull(),
        }
    ).drop(SOURCE_FILE, INGESTED_AT)


@_query
def raw_read(s: Sample) -> DataFrame:
    """Landed green files as text with lineage."""
    return _with_lineage(landing.read_landing(s.spark, f"{s.landed}/{GREEN.name}"))


@_query
def raw_union_drift(s: Sample) -> DataFrame:
    """Landed yellow files, whose names, types and columns change on the way."""
    return _with_lineage(landing.read_landing(s.spark, f"{s.landed}/{YELLOW.name}"))


@_query
def layer_raw(s: Sample) -> DataFrame:
    return _with_lineage(_both_fleets(s.raw_tables))


@_query
def layer_trusted(s: Sample) -> DataFrame:
    return _both_fleets(s.trusted_tables).drop(SOURCE_FILE, INGESTED_AT)


@_query
def layer_fact(s: Sample) -> DataFrame:
    return s.fact_tables[0].drop(SOURCE_FILE)


@_query
def layer_quarantine(s: Sample) -> DataFrame:
    return _reasons_text(s.fact_tables[1].drop(SOURCE_FILE))


@_query
def layer_report(s: Sample) -> DataFrame:
    return s.fact_tables[2].drop("measured_at")


@_query
def layer_monthly(s: Sample) -> DataFrame:
    return _rounded_monthly(s.mart_tables[0])


@_query
def layer_hourly(s: Sample) -> DataFrame:
    return _rounded_hourly(s.mart_tables[1])


@_query
def report_stamped(s: Sample) -> DataFrame:
    """How many rows of the stored report have a time, by rule."""
    return s.fact_tables[2].groupBy("rule_name", "rows_evaluated").agg(
        F.count("measured_at").alias("stamped")
    )


@_query
def fact_statistics(s: Sample) -> DataFrame:
    """Rows of the fact as the catalog knows them after its statistics were taken."""
    assert s.fact_tables
    tables.analyze_table(s.spark, s.lake.fact, ["total_amount"])
    known = s.spark.sql(f"DESCRIBE TABLE EXTENDED {s.lake.fact}").where("col_name = 'Statistics'")
    rows = F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long")
    return known.select(F.lit(tables.table_exists(s.spark, s.lake.fact)).alias("exists"), rows.alias("linhas"))


@_query
def fact_columns(s: Sample) -> DataFrame:
    """Columns of the fact as described, with their filled rows."""
    fact = s.fact_tables[0]
    described = (
        tables.describe(s.spark, s.lake.fact)
        .where("data_type <> '' AND NOT startswith(col_name, '#')")
        .select("col_name", "data_type")
        .distinct()
    )
    filled = fact.agg(*(F.count(name).alias(name) for name in fact.columns))
    return described.join(filled.unpivot([], fact.columns, "col_name", "preenchidos"), "col_name")


@_query
def partition_slice(s: Sample) -> DataFrame:
    """The predicate naming every file month of the yellow trips."""
    return tables.partition_slice(s.trusted(YELLOW), FILE_MONTH)


@_query
def partition_replace(s: Sample) -> DataFrame:
    """Write all months, then one month again with changed rows and a new column."""
    table, trips = s.scratch_table("replaced"), s.trusted(YELLOW)
    tables.replace_partitions(trips, table, FILE_MONTH, rebalance=True)
    month = (F.col(FILE_MONTH[0]) == YEAR) & (F.col(FILE_MONTH[1]) == MONTH)
    changed = trips.where(month & (F.col("VendorID") == 1)).withColumn("revised", F.lit(True))
    tables.replace_partitions(changed, table, FILE_MONTH, rebalance=True)
    return (
        s.spark.table(table)
        .groupBy(*FILE_MONTH)
        .agg(
            F.count(F.lit(1)).alias("linhas"),
            F.count("revised").alias("revisadas"),
            F.round(F.sum("total_amount"), 2).alias("receita"),
        )
    )


@_query
def table_overwrite(s: Sample) -> DataFrame:
    """Replace a table by one of another schema."""
    table = s.scratch_table("overwritten")
    tables.overwrite_table(exploration.rows_by_event_month(s.trusted(GREEN), GREEN), table)
    tables.overwrite_table(quality.rejections_by_reason(s.quarantine), table)
    return s.spark.table(table)


@_query
def clustered_fact(s: Sample) -> DataFrame:
    """The fact after its files were rewritten in order: same rows."""
    table = s.scratch_table("clustered")
    tables.replace_partitions(s.fact, table, EVENT_MONTH, rebalance=True)
    tables.cluster_table(s.spark, table, EVENT_MONTH, CLUSTER_BY)
    return s.spark.table(table).drop(SOURCE_FILE)


@_query
def clustered_fact_interleaved(s: Sample) -> DataFrame:
    """The fact after clustering by time and amount alike: same rows."""
    table = s.scratch_table("interleaved")
    tables.replace_partitions(s.fact, table, EVENT_MONTH, rebalance=True)
    tables.cluster_table(
        s.spark, table, EVENT_MONTH, ("pickup_datetime", "total_amount"), interleave=True
    )
    return s.spark.table(table).drop(SOURCE_FILE)


@_query
def partition_statistics(s: Sample) -> DataFrame:
    """Rows of one month of the fact as the catalog knows them after only it was analysed."""
    assert s.fact_tables
    tables.analyze_partitions(s.spark, s.lake.fact, EVENT_MONTH, [(YEAR, MONTH)])
    known = tables.partition_rows(s.spark, s.lake.fact, EVENT_MONTH)
    rows = [(YEAR, MONTH, known[YEAR, MONTH])]
    return s.spark.createDataFrame(rows, "pickup_year string, pickup_month string, linhas long")


@_query
def layer_report_after_month(s: Sample) -> DataFrame:
    """The report after one file month was loaded once more."""
    return s.spark.table(s.reloaded.lake.report).drop("measured_at")


@_query
def layer_monthly_after_month(s: Sample) -> DataFrame:
    """The monthly mart after one file month was loaded once more."""
    return _rounded_monthly(s.spark.table(s.reloaded.lake.monthly))


@_query
def streamed_fact(s: Sample) -> DataFrame:
    """The fact of a lake that takes the landed files as a stream."""
    return s.spark.table(s.streamed.lake.fact).drop(SOURCE_FILE)


# --- projections -----------------------------------------------------------------


def _source_names(s: Sample) -> DataFrame:
    """Yellow trips under names as they are found in published files."""
    trips = s.trusted(YELLOW)
    return trips.select(
        "VendorID",
        F.col("passenger_count").alias("passengerCount"),
        F.col("total_amount").alias("  total amount "),
        F.col(YELLOW.pickup).alias("tpep_pickup_datetime"),
        (F.col("VendorID") % 2).alias("RatecodeID"),
        (F.col("VendorID") + 10).alias("PULocationID"),
        (F.col("VendorID") * 1.25).alias("Airport_fee"),
        F.col(FILE_MONTH[1]).alias("ref.month"),
    )


@_query
def normalize_names(s: Sample) -> DataFrame:
    return shaping.normalize_names(_source_names(s))


@_query
def cast_all_string(s: Sample) -> DataFrame:
    return shaping.stringify(s.spark.read.parquet(f"{s.directory}/lineitem.parquet"))


@_query
def apply_schema(s: Sample) -> DataFrame:
    """Text back to types: decimal text for the vendor, some of it unreadable."""
    trips = s.trusted(YELLOW)
    text = shaping.stringify(
        trips.withColumn("vendor_id", F.col("VendorID").cast("double"))
        .withColumn("extra", F.lit("x"))
        .withColumn(INGESTED_AT, F.col(YELLOW.pickup))
    )
    unreadable = F.when(F.col("passenger_count") == "7.0", F.lit("many"))
    broken = text.withColumn(
        "passenger_count", F.coalesce(unreadable, F.col("passenger_count"))
    )
    return shaping.apply_contract(broken, YELLOW.contract())


@_query
def trip_duration(s: Sample) -> DataFrame:
    """Trips per duration."""
    return s.trips.groupBy("trip_type", "trip_duration_minutes").agg(
        F.count(F.lit(1)).alias("linhas")
    )


@_query
def canonical_trips(s: Sample) -> DataFrame:
    return s.trips


@_query
def trusted_sample(s: Sample) -> DataFrame:
    return exploration.trusted_sample(s.trusted(YELLOW), YELLOW)


@_query
def fact_month_sample(s: Sample) -> DataFrame:
    return answers.fact_month_sample(s.fact_tables[0], YEAR, MONTH)


# --- quality ---------------------------------------------------------------------


def _rule_query(rule: quality.Rule) -> Callable[[Sample], DataFrame]:
    return lambda s: s.trips.groupBy("trip_type", *FILE_MONTH).agg(
        F.count(F.lit(1)).alias("rows_evaluated"),
        F.count_if(rule.fails()).alias("rows_failed"),
    )


for _rule in Sample.rules:
    for _key, _name in RULE_QUERIES.items():
        if _name == _rule.name:
            _register(_key, _rule_query(_rule))


@_query
def rejection_reasons(s: Sample) -> DataFrame:
    return _reasons_text(quality.with_reasons(s.trips, s.rules))


@_query
def valid_trips(s: Sample) -> DataFrame:
    return s.fact


@_query
def rejected_trips(s: Sample) -> DataFrame:
    return _reasons_text(s.quarantine)


@_query
def dq_report(s: Sample) -> DataFrame:
    return quality.rule_report(s.trips, s.rules)


@_query
def dq_report_sorted(s: Sample) -> DataFrame:
    return exploration.sorted_report(s.fact_tables[2].drop("measured_at"))


@_query
def rejections_by_reason(s: Sample) -> DataFrame:
    return quality.rejections_by_reason(s.fact_tables[1]).orderBy(F.desc("linhas"), "motivo")


# --- marts -----------------------------------------------------------------------


@_query
def agg_monthly(s: Sample) -> DataFrame:
    return _rounded_monthly(s.monthly)


@_query
def agg_hourly(s: Sample) -> DataFrame:
    return _rounded_hourly(s.hourly)


@_query
def ticket_quantiles_by_year(s: Sample) -> DataFrame:
    """Quantiles of a year's tickets, merged from the stored states of its months."""
    assert s.mart_tables
    shares = {"p25": 0.25, "mediana": 0.5, "p75": 0.75}
    states = s.spark.table(s.lake.monthly_states)
    return marts.quantiles_of_states(states, shares, ("trip_type", "pickup_year"))


# --- exploration -----------------------------------------------------------------


@_query
def raw_partition_counts(s: Sample) -> DataFrame:
    return exploration.rows_by_file_month(s.raw_tables, "linhas")


@_query
def lineage_counts(s: Sample) -> DataFrame:
    return exploration.lineage_by_month(s.raw_tables)


@_query
def eda_volume_by_ref_month(s: Sample) -> DataFrame:
    return exploration.rows_by_file_month(s.fleets, "corridas")


@_query
def eda_profile(s: Sample) -> DataFrame:
    return exploration.column_profile(s.trusted(YELLOW), YELLOW)


@_query
def eda_event_month(s: Sample) -> DataFrame:
    return exploration.rows_by_event_month(s.trusted(YELLOW), YELLOW)


@_query
def eda_month_mismatch(s: Sample) -> DataFrame:
    return exploration.misplaced_months(s.trusted(YELLOW), YELLOW)


@_query
def eda_duration_hist(s: Sample) -> DataFrame:
    return exploration.duration_histogram(s.fleets)


@_query
def eda_passenger_hist(s: Sample) -> DataFrame:
    return exploration.passenger_histogram(s.fleets)


@_query
def eda_amount_hist(s: Sample) -> DataFrame:
    return exploration.amount_histogram(s.trusted(YELLOW))


@_query
def eda_histograms(s: Sample) -> DataFrame:
    """All three histograms of each fleet, from one scan of it."""
    return exploration.histograms(s.fleets)


@_query
def eda_profile_states(s: Sample) -> DataFrame:
    """The profile from states stored per file month."""
    assert s.trusted_tables
    return s.pipeline.load_profile(YELLOW)


@_query
def eda_quantiles(s: Sample) -> DataFrame:
    return exploration.amount_quantiles(s.trusted(YELLOW))


@_query
def eda_quarantine_share(s: Sample) -> DataFrame:
    return exploration.quarantine_share(*s.fact_tables[:2])


# --- answers, from the stored fact, marts and quarantine ---------------------------------------------------------------------


@_query
def q1a_avg_ticket(s: Sample) -> DataFrame:
    return answers.average_ticket(s.mart_tables[0])


@_query
def q1a_from_fact(s: Sample) -> DataFrame:
    return answers.average_ticket_from_fact(s.fact_tables[0])


@_query
def q1b_avg_monthly_revenue(s: Sample) -> DataFrame:
    return answers.average_monthly_revenue(s.mart_tables[0])


@_query
def q1c_sensitivity(s: Sample) -> DataFrame:
    return answers.sensitivity(*s.fact_tables[:2])


@_query
def q1_sensitivity_change(s: Sample) -> DataFrame:
    return answers.sensitivity_change(*s.fact_tables[:2])


@_query
def q1_weighted_vs_simple(s: Sample) -> DataFrame:
    return answers.weighted_and_simple_ticket(s.mart_tables[0])


@_query
def q2a_hourly_occupancy(s: Sample) -> DataFrame:
    return answers.hourly_occupancy(s.mart_tables[1], YEAR, MONTH)


@_query
def q2a_from_fact(s: Sample) -> DataFrame:
    return answers.hourly_occupancy_from_fact(s.fact_tables[0], *sample_trips.FOCUS_RANGE)


@_query
def q2b_typical_day(s: Sample) -> DataFrame:
    return answers.typical_day(s.mart_tables[1], YEAR, MONTH)


@_query
def q2c_by_fleet(s: Sample) -> DataFrame:
    return answers.occupancy_by_fleet(s.mart_tables[1], YEAR, MONTH)


@_query
def q2d_hourly_volume_occupancy(s: Sample) -> DataFrame:
    return answers.volume_and_occupancy(s.mart_tables[1], YEAR, MONTH)


def queries() -> dict[str, Query]:
    return dict(_registered)
