"""Casts that give NULL for malformed text instead of stopping the job.

Spark 4 runs in ANSI mode, where a malformed cast raises. Here a bad value must
become NULL and be caught by the null rules further down.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE = {"bigint", "int", "smallint", "tinyint"}


def lenient_cast(column: Column, kind: str, text: bool = True) -> Column:
    """``try_cast``, reading whole numbers also from decimal text.

    An identifier published as double arrives as ``'1.0'`` and is read as one.
    Going through double would lose digits of large identifiers, so plain digits
    are read directly, and of decimal text the part before the point. Only text with
    an exponent goes through double: ``'1e3'`` is read as 1000, by choice. The point
    is looked for first, because a cast that fails inside ``try_cast`` costs an
    exception, far too much for every row.
    """
    if not text or kind not in _WHOLE:
        return column.try_cast(kind)
    through_double = column.try_cast("double").try_cast(kind)
    direct = F.coalesce(column.try_cast(kind), through_double)
    decimal = column.rlike(r"^\s*[+-]?[0-9]+\.[0-9]*\s*$")
    before_point = F.substring_index(column, ".", 1).try_cast(kind)
    with_point = F.when(decimal, before_point).otherwise(through_double)
    return F.when(column.contains("."), with_point).otherwise(direct)
