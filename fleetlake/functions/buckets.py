"""Histogram buckets: an ordinal per row, the label only after the aggregate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Buckets:
    """Labels in order; ``edges`` are the tests between the null and last label.

    An edge is an operator (``<``, ``<=`` or ``=``) and a bound; the first that
    holds decides. There is one label for NULL, one per edge and one for the rest.
    """

    labels: tuple[str, ...]
    edges: tuple[tuple[str, float], ...]

    def __post_init__(self) -> None:
        if len(self.labels) != len(self.edges) + 2:
            raise ValueError("one label for NULL, one per edge and one for the rest")

    def ordinal(self, value: Column) -> Column:
        """Position of the value's bucket. An integer key keeps the hash map small."""
        tests = {"<": value.__lt__, "<=": value.__le__, "=": value.__eq__}
        chosen = F.when(value.isNull(), F.lit(0))
        for position, (sign, bound) in enumerate(self.edges, start=1):
            chosen = chosen.when(tests[sign](F.lit(bound)), F.lit(position))
        return chosen.otherwise(F.lit(len(self.labels) - 1))

    def label(self, ordinal: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, self.labels)), ordinal + 1)


# Bucket labels and bounds of the three published histograms.
DURATION = Buckets(
    labels=(
        "0 · nula",
        "1 · negativa",
        "2 · zerada",
        "3 · menos de 1 min",
        "4 · 1 a 5 min",
        "5 · 5 a 15 min",
        "6 · 15 a 30 min",
        "7 · 30 a 60 min",
        "8 · 1 a 2 h",
        "9 · 2 a 24 h",
        "A · mais de 24 h",
    ),
    edges=(
        ("<", 0.0), ("=", 0.0), ("<", 1.0), ("<", 5.0), ("<", 15.0),
        ("<", 30.0), ("<", 60.0), ("<", 120.0), ("<", 1440.0),
    ),
)
PASSENGERS = Buckets(
    labels=(
        "0 · nulo",
        "1 · negativo",
        "2 · zero",
        "3 · 1 a 4",
        "4 · 5 a 6",
        "5 · acima de 6",
    ),
    edges=(("<", 0.0), ("=", 0.0), ("<=", 4.0), ("<=", 6.0)),
)
AMOUNT = Buckets(
    labels=(
        "0 · nulo",
        "1 · negativo",
        "2 · zero",
        "3 · até 10",
        "4 · 10 a 25",
        "5 · 25 a 50",
        "6 · 50 a 100",
        "7 · 100 a 1.000",
        "8 · acima de 1.000",
    ),
    edges=(
        ("<", 0.0), ("=", 0.0), ("<", 10.0), ("<", 25.0), ("<", 50.0),
        ("<", 100.0), ("<", 1000.0),
    ),
)
