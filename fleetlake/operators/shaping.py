"""Schema shaping: names, text form, typed contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.casting import lenient_cast
from fleetlake.functions.naming import snake_names
from fleetlake.model import Contract


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters it contains."""
    return F.col("`" + name.replace("`", "``") + "`")


def normalize_names(frame: DataFrame) -> DataFrame:
    return frame.toDF(*snake_names(frame.columns))


def stringify(frame: DataFrame) -> DataFrame:
    return frame.select(*(column(n).cast("string").alias(n) for n in frame.columns))


def apply_contract(frame: DataFrame, contract: Contract) -> DataFrame:
    """Keep, rename and type the contract's columns, in its order.

    A missing source column stops the run here, naming what is missing and
    what there is. Malformed values become NULL.
    """
    present = dict(frame.dtypes)
    missing = sorted({source for source, _ in contract.values()} - present.keys())
    if missing:
        raise ValueError(f"missing source columns {missing}; available: {sorted(present)}")
    return frame.select(
        *(
            lenient_cast(column(source), kind, present[source] == "string").alias(target)
            for target, (source, kind) in contract.items()
        )
    )
