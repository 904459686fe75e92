"""Exact quantiles without sorting the data or holding a group in one task.

Equal values are first counted together (map-side, so a hot value or a hot group
costs one row per task). The rank is then found digit by digit: first among the
powers of two, then in three steps of 18 bits that use up all 52 bits of a double's
mantissa. Each step orders 262,144 sums per group at most, whatever the values are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DIGIT = 262_144
_DIGITS = 3
_ABOVE_ZERO = 1_100
_LAST = 3_000


def _exponent(value: Column) -> Column:
    """Power of two just below a positive finite value; the logarithm may round past it."""
    guess = F.floor(F.log2(value))
    return (
        F.when(F.pow(F.lit(2.0), guess) > value, guess - 1)
        .when((guess < 1023) & (F.pow(F.lit(2.0), F.least(guess + 1, F.lit(1023))) <= value), guess + 1)
        .otherwise(guess)
    )


def _digits(value: Column) -> list[Column]:
    """Whole numbers that order doubles from first to last; zero has a bucket of its own.

    Dividing by a power of two and taking off whole parts are exact. Negative values
    have negative digits. Infinity and NaN have buckets of their own. Declared non-null,
    so that the joins below add no null filter and all can reuse one shuffle.
    """
    size = F.abs(value)
    finite = (size > 0) & (size < float("inf"))
    power = F.when(finite, _exponent(size))
    sign = F.when(value < 0, -1).otherwise(1)
    first = (
        F.when(F.isnan(value), _LAST + 1)
        .when(size == 0, 0)
        .when(finite, sign * (power + _ABOVE_ZERO))
        .otherwise(sign * _LAST)
    )
    digits = [first]
    rest = size / F.pow(F.lit(2.0), power) - 1.0
    for _ in range(_DIGITS):
        digit = F.floor(rest * _DIGIT)
        digits.append(sign * digit)
        rest = rest * _DIGIT - digit
    return [F.coalesce(d.cast("int"), F.lit(0)) for d in digits]


def value_counts(frame: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per group and distinct value, NULL left out."""
    return (
        frame.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _holding_rank(frame: DataFrame, within: Sequence[str], order: str) -> DataFrame:
    """Of each group's rows in order, the one holding ``rank``, counted anew in it."""
    upwards = Window.partitionBy(*within).orderBy(order)
    below = F.sum("n").over(upwards) - F.col("n")
    return frame.withColumn("rank", F.col("rank") - below).where(
        (F.col("rank") > 0) & (F.col("rank") <= F.col("n"))
    )


def _inside(counted: DataFrame, targets: DataFrame, keys: list[str], path: list[str]) -> DataFrame:
    """The counts on the targets' path, once per target. NULL is a group as well."""
    renamed = targets.select(*(F.col(c).alias(f"at_{c}") for c in keys + path), "name", "rank")
    same = [F.col(k).eqNullSafe(F.col(f"at_{k}")) for k in keys]
    same += [F.col(c) == F.col(f"at_{c}") for c in path]
    return counted.join(renamed, same).select(*counted.columns, "name", "rank")


def exact_quantiles(
    counts: DataFrame, shares: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles of ``value_counts``: a row per group, a column per share's name.

    The quantile is the value at rank ``ceil(share * n)``.
    """
    keys, path = list(by), [f"digit{i}" for i in range(_DIGITS + 1)]
    value, target = F.col("value"), [*keys, "name"]
    counted = counts.select("*", *(d.alias(name) for d, name in zip(_digits(value), path)))
    wanted = F.inline(
        F.array(
            *(
                F.struct(F.lit(name).alias("name"), F.lit(share).alias("share"))
                for name, share in shares.items()
            )
        )
    )
    rank = F.greatest(F.ceil(F.col("share") * F.col("total")), F.lit(1).cast("bigint"))
    sums = (
        counted.groupBy(*keys, path[0])
        .agg(F.sum("n").alias("n"))
        .withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
        .select("*", wanted)
        .withColumn("rank", rank)
    )
    found = _holding_rank(sums, target, path[0])
    for known in range(1, len(path)):
        sums = (
            _inside(counted, found, keys, path[:known])
            .groupBy(*target, "rank", *path[: known + 1])
            .agg(F.sum("n").alias("n"))
        )
        found = _holding_rank(sums, target, path[known])
    # reading n keeps this use of the counts equal to the others, so that all share one shuffle
    return (
        _inside(counted, found, keys, path)
        .where("n > 0")
        .groupBy(*keys)
        .agg(*(F.min(F.when(F.col("name") == k, value)).alias(k) for k in shares))
    )
