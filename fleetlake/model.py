"""Everything that is configuration: fleets, quality limits, table names.

No module below this one holds a business constant of its own; the window,
the duration limit and the names all arrive through these objects.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

# Names of the lineage and partition columns of the data model.
SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingested_at"
REASONS = "_rejection_reasons"
FILE_MONTH = ("ref_year", "ref_month")
EVENT_MONTH = ("pickup_year", "pickup_month")

# target column -> (normalised source column, Spark type)
Contract = Mapping[str, tuple[str, str]]


@dataclass(frozen=True)
class Fleet:
    """One published trip dataset; ``meter`` prefixes its two time columns."""

    name: str
    meter: str

    @property
    def pickup(self) -> str:
        return f"{self.meter}_pickup_datetime"

    @property
    def dropoff(self) -> str:
        return f"{self.meter}_dropoff_datetime"

    @property
    def file_stem(self) -> str:
        return f"{self.name}_tripdata"

    def contract(self) -> Contract:
        """Columns of the trusted table, in order."""
        same = lambda name, kind: {name: (name, kind)}
        return {
            "VendorID": ("vendor_id", "bigint"),
            **same("passenger_count", "double"),
            **same("total_amount", "double"),
            **same(self.pickup, "timestamp"),
            **same(self.dropoff, "timestamp"),
            **same(SOURCE_FILE, "string"),
            **same(INGESTED_AT, "timestamp"),
            **same(FILE_MONTH[0], "string"),
            **same(FILE_MONTH[1], "string"),
        }


YELLOW = Fleet("yellow", "tpep")
GREEN = Fleet("green", "lpep")
FLEETS = (YELLOW, GREEN)


@dataclass(frozen=True)
class Limits:
    """Bounds used by the quality rules. ``window_end`` is exclusive."""

    window_start: str = "2023-01-01"
    window_end: str = "2023-06-01"
    max_minutes: int = 24 * 60


LAYERS = ("landing", "raw", "trusted", "refined", "quality")


@dataclass(frozen=True)
class Lake:
    """Where the layers live.

    ``landing`` is the directory holding ``<fleet>/ref_year=/ref_month=``;
    ``prefix`` is put before every database name, so that several lakes can
    share one catalog; ``location`` is the directory of the databases, or None
    for the session's warehouse.
    """

    landing: str
    prefix: str = ""
    location: str | None = None

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def landing_root(self, fleet: Fleet) -> str:
        return f"{self.landing.rstrip('/')}/{fleet.name}"

    def landing_month(self, fleet: Fleet, year: int | str, month: int | str) -> str:
        year_dir, month_dir = f"ref_year={int(year):04d}", f"ref_month={int(month):02d}"
        return f"{self.landing_root(fleet)}/{year_dir}/{month_dir}"

    def raw(self, fleet: Fleet) -> str:
        return f"{self.database('raw')}.ny_taxi_trip_{fleet.name}"

    def trusted(self, fleet: Fleet) -> str:
        return f"{self.database('trusted')}.ny_taxi_trip_{fleet.name}"

    @property
    def fact(self) -> str:
        return f"{self.database('refined')}.fct_taxi_trip"

    @property
    def quarantine(self) -> str:
        return f"{self.database('refined')}.rej_taxi_trip"

    @property
    def monthly(self) -> str:
        return f"{self.database('refined')}.agg_trip_monthly"

    @property
    def monthly_states(self) -> str:
        return f"{self.database('refined')}.agg_trip_monthly_state"

    def profile_states(self, fleet: Fleet) -> str:
        return f"{self.database('quality')}.profile_state_{fleet.name}"

    @property
    def hourly(self) -> str:
        return f"{self.database('refined')}.agg_trip_hourly"

    @property
    def report(self) -> str:
        return f"{self.database('quality')}.dq_results"
