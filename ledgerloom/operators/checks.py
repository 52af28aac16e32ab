"""Declarative data-quality checks, their log and the gate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class RowRule:
    """Counts the rows of one table for which the condition is true."""

    table: str
    condition: Callable[[], Column]


@dataclass(frozen=True)
class Check:
    """A named rule. ``measure`` is a row rule, or a function from tables to one row ``failed_rows``."""

    name: str
    layer: str
    severity: str
    description: str
    measure: RowRule | Callable[[Tables], DataFrame]


class QualityGateError(RuntimeError):
    """Raised by the gate when a check has failed."""


def _entry(check: Check, failed: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.layer).alias("layer"),
        F.lit(check.severity).alias("severity"),
        failed.cast("long").alias("failed_rows"),
        F.lit(check.description).alias("description"),
    )


def run_checks(tables: Tables, checks: Sequence[Check], run_ts: dt.datetime | None = None) -> DataFrame:
    """One log row per check: run_ts, check_name, layer, severity, failed_rows, status, description.

    All row rules on the same table share one scan of it. A check without failing rows has the
    status PASS, any other that of its severity.
    """
    by_table: dict[str, list[Check]] = {}
    parts: list[DataFrame] = []
    for check in checks:
        if isinstance(check.measure, RowRule):
            by_table.setdefault(check.measure.table, []).append(check)
        else:
            parts.append(check.measure(tables).select(_entry(check, F.col("failed_rows")).alias("e")).select("e.*"))
    for table, group in by_table.items():
        counts = tables[table].agg(
            *[F.count_if(check.measure.condition()).alias(f"c{i}") for i, check in enumerate(group)]
        )
        parts.append(counts.select(F.inline(F.array(*[_entry(check, F.col(f"c{i}")) for i, check in enumerate(group)]))))
    stamp = F.lit(run_ts) if run_ts is not None else F.current_timestamp()
    return reduce(DataFrame.unionByName, parts).select(
        stamp.cast("timestamp").alias("run_ts"),
        "check_name",
        "layer",
        "severity",
        "failed_rows",
        F.when(F.col("failed_rows") == 0, "PASS").otherwise(F.col("severity")).alias("status"),
        "description",
    )


def check_number(checks: Sequence[Check], name: Column) -> Column:
    """Place of a check in a list; one that is not in it, such as a count asked for by the user, comes last."""
    place = F.array_position(F.array(*[F.lit(check.name) for check in checks]), name)
    return F.when(place > 0, place).otherwise(F.lit(len(checks) + 1))


def failing(log: DataFrame) -> DataFrame:
    """Rows that raise the alert."""
    return log.filter(F.col("status") == "FAIL")


def gate(log: DataFrame) -> None:
    """Raise if any check failed; the log holds one row per check, so little reaches the driver."""
    names = [f"{row.check_name} ({row.failed_rows})" for row in failing(log).collect()]
    if names:
        raise QualityGateError("failed checks: " + ", ".join(sorted(names)))


def append_log(log: DataFrame, path: str) -> None:
    """Add a run to the kept history, one folder per day and run; the same run again replaces itself."""
    rows = log.withColumn("run_date", F.to_date("run_ts")).withColumn("run", F.date_format("run_ts", "HHmmss"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_date", "run").parquet(path)
