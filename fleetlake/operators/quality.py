"""Declarative quality rules, quarantine and the rule report.

A rule states what a good row satisfies. SQL's third truth value matters: a row
fails a rule only when its condition is FALSE. When the condition is NULL (say,
a duration without an end) the rule stays silent and the null rule speaks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.model import REASONS, Limits


@dataclass(frozen=True)
class Rule:
    """``passes`` is called late, because a Column needs a running session.

    ``null_after`` names rules that fail whenever this rule's condition is NULL,
    for any data: the null rule of the one column it compares. When they block,
    the condition can be used as it is in the filter for accepted rows, and
    reaches the parquet scan. Durations have none, since a frame may come with
    any duration.
    """

    name: str
    description: str
    passes: Callable[[], Column]
    blocking: bool = True
    null_after: tuple[str, ...] = ()

    def fails(self) -> Column:
        return ~self.passes()


def standard_rules(limits: Limits) -> tuple[Rule, ...]:
    pickup, dropoff = "pickup_datetime", "dropoff_datetime"
    minutes, amount, riders = "trip_duration_minutes", "total_amount", "passenger_count"

    def in_window() -> Column:
        start = F.lit(limits.window_start).cast("timestamp")
        end = F.lit(limits.window_end).cast("timestamp")
        return (F.col(pickup) >= start) & (F.col(pickup) < end)

    # Rule names, as they appear in the quarantine and the report.
    no_pickup = "pickup_datetime_nulo"
    no_dropoff = "dropoff_datetime_nulo"
    not_positive = "duracao_nao_positiva"
    too_long = "duracao_acima_de_24h"
    out_of_window = "fora_da_janela_de_analise"
    no_amount = "total_amount_nulo"
    negative = "total_amount_negativo"
    no_riders = "passenger_count_ausente"

    return (
        Rule(no_pickup, "The trip has no start.", lambda: F.col(pickup).isNotNull()),
        Rule(no_dropoff, "The trip has no end.", lambda: F.col(dropoff).isNotNull()),
        Rule(
            not_positive,
            "The trip ends at or before its start.",
            lambda: F.col(minutes) > 0,
        ),
        Rule(
            too_long,
            f"The trip lasts more than {limits.max_minutes} minutes.",
            lambda: F.col(minutes) <= limits.max_minutes,
        ),
        Rule(
            out_of_window,
            f"The start is outside [{limits.window_start}, {limits.window_end}).",
            in_window,
            null_after=(no_pickup,),
        ),
        Rule(no_amount, "The trip has no amount.", lambda: F.col(amount).isNotNull()),
        Rule(
            negative,
            "The amount is negative; kept apart as a possible refund.",
            lambda: F.col(amount) >= 0,
            null_after=(no_amount,),
        ),
        Rule(
            no_riders,
            "No positive passenger count; measured only, the trip stays.",
            lambda: F.col(riders).isNotNull() & (F.col(riders) > 0),
            blocking=False,
        ),
    )


def _blocking(rules: Iterable[Rule]) -> list[Rule]:
    return [rule for rule in rules if rule.blocking]


def rejection_reasons(rules: Iterable[Rule]) -> Column:
    """Names of the failed blocking rules, in rule order; empty when none."""
    names = [F.when(r.fails(), F.lit(r.name)) for r in _blocking(rules)]
    return F.array_compact(F.array(*names).cast("array<string>"))


def with_reasons(frame: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    return frame.withColumn(REASONS, rejection_reasons(rules))


def accepted(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows no blocking rule rejects: the conjunction of the conditions.

    No reasons array is built to find them, so the simple comparisons can be
    pushed into the scan.
    """
    blocking = _blocking(rules)
    names = {rule.name for rule in blocking}

    def not_failed(rule: Rule) -> Column:
        nulls_caught = rule.null_after and names.issuperset(rule.null_after)
        return rule.passes() if nulls_caught else F.coalesce(rule.passes(), F.lit(True))

    return frame.where(reduce(Column.__and__, map(not_failed, blocking), F.lit(True)))


def rejected(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows with at least one failed blocking rule, with the reasons.

    ``a OR b`` is TRUE as soon as one side is, even beside NULL, which is just
    the set wanted. Only the rows kept get an array.
    """
    failed = [rule.fails() for rule in _blocking(rules)]
    return with_reasons(frame.where(reduce(Column.__or__, failed, F.lit(False))), rules)


def _report_rows(one_row: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Turn the one-row aggregate into a row per rule, without leaving Spark."""
    rows = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(rule.name).alias("rule_name"),
            F.lit(rule.description).alias("description"),
            F.lit(rule.blocking).alias("blocking"),
            F.col(f"failed_{position}").alias("rows_failed"),
        )
        for position, rule in enumerate(rules)
    ]
    return one_row.select("rows_evaluated", F.inline(F.array(*rows)))


def _finish_report(rows: DataFrame) -> DataFrame:
    share = F.round(F.col("rows_failed") * F.lit(100.0) / F.col("rows_evaluated"), 4)
    return rows.select(
        "rule_name",
        "description",
        "blocking",
        "rows_evaluated",
        "rows_failed",
        F.when(F.col("rows_evaluated") > 0, share).otherwise(F.lit(0.0)).alias("failure_pct"),
    )


def rule_report(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows evaluated and failed per rule: one pass, one row shuffled per task."""
    failures = [F.count_if(r.fails()).alias(f"failed_{i}") for i, r in enumerate(rules)]
    totals = frame.agg(F.count(F.lit(1)).alias("rows_evaluated"), *failures)
    return _finish_report(_report_rows(totals, rules))


def rule_report_from_quarantine(
    frame: DataFrame, quarantine: DataFrame, rules: Sequence[Rule]
) -> DataFrame:
    """The same report when ``quarantine`` already holds the rejects of ``frame``.

    Blocking rules are counted from the reasons in the (small) quarantine, so
    of the large input only the columns of the non-blocking rules are read.
    """
    failures = [
        (F.lit(None).cast("bigint") if r.blocking else F.count_if(r.fails())).alias(
            f"failed_{i}"
        )
        for i, r in enumerate(rules)
    ]
    totals = frame.agg(F.count(F.lit(1)).alias("rows_evaluated"), *failures)
    by_reason = rejections_by_reason(quarantine)
    rows = _report_rows(totals, rules).join(
        by_reason, F.col("rule_name") == F.col("motivo"), "left"
    )
    counted = F.coalesce("rows_failed", "linhas", F.lit(0).cast("bigint"))
    return _finish_report(rows.withColumn("rows_failed", counted))


def count_names(rules: Sequence[Rule]) -> list[str]:
    return ["rows_evaluated", *(f"failed_{i}" for i in range(len(rules)))]


def rule_counts(rules: Sequence[Rule], counted: Column | None = None) -> list[Column]:
    """Aggregates over rows with their reasons: rows, and failures of each rule.

    Blocking rules are counted from the reasons, NULL for none, which are not computed
    again. ``counted`` limits the rows that count.
    """
    failed = [
        F.array_contains(REASONS, rule.name) if rule.blocking else rule.fails() for rule in rules
    ]
    every = F.lit(True) if counted is None else counted
    tests = [every, *(every & f for f in failed)]
    return [F.count_if(test).alias(name) for test, name in zip(tests, count_names(rules))]


def report_of_counts(
    spark: SparkSession, counts: Mapping[str, int], rules: Sequence[Rule]
) -> DataFrame:
    """The report from counts already taken, one number per rule."""
    names = count_names(rules)
    schema = ", ".join(f"{name} bigint" for name in names)
    one_row = spark.createDataFrame([tuple(counts[name] for name in names)], schema)
    return _finish_report(_report_rows(one_row, rules))


def counts_of_report(report: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """The counts a report was made of."""
    rows = {row.rule_name: row for row in report.collect()}
    evaluated = max((row.rows_evaluated for row in rows.values()), default=0)
    failed = {f"failed_{i}": rows[rule.name].rows_failed for i, rule in enumerate(rules)}
    return {"rows_evaluated": evaluated, **failed}


def rejections_by_reason(quarantine: DataFrame) -> DataFrame:
    """Rows per reason; a row with several reasons counts once for each."""
    return (
        quarantine.select(F.explode(REASONS).alias("motivo"))
        .groupBy("motivo")
        .agg(F.count(F.lit(1)).alias("linhas"))
    )
