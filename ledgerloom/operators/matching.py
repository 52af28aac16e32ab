"""Counts of rows that break a rule across tables; each returns one row with ``failed_rows``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _total(df: DataFrame, rows: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("failed_rows"))


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent; a NULL key counts.

    Both sides are brought to one row per key first, which combines before the shuffle and leaves
    them partitioned for the anti join, so a key held by most rows weighs as much as any other.
    """
    keys = child.groupBy(F.col(foreign_key).alias("_fk")).agg(F.count(F.lit(1)).alias("_rows"))
    parents = parent.select(F.col(key).alias("_pk")).distinct()
    return _total(keys.join(parents, F.col("_fk") == F.col("_pk"), "left_anti"), "_rows")


def without_match(rows: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Rows for which no row of ``other`` exists (NOT EXISTS).

    An anti join cannot split a hot key of its right side, so that side is made distinct before it.
    """
    wanted = other.select(F.col(other_key).alias("_key")).distinct()
    return rows.join(wanted, F.col(key) == F.col("_key"), "left_anti").agg(F.count(F.lit(1)).alias("failed_rows"))


def repeated_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of key values that occur more than once."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter("_rows > 1")
        .agg(F.count(F.lit(1)).alias("failed_rows"))
    )


def dated_before(child: DataFrame, key: str, day: str, parent: DataFrame, parent_key: str, parent_day: str) -> DataFrame:
    """Child rows dated before their parent; rows without a parent or a date do not count.

    Child rows are counted by key and day before they meet their parents, so a key with many rows
    takes part with its days only.
    """
    parents = parent.select(F.col(parent_key).alias("_key"), F.col(parent_day).alias("_day"))
    known = child.select(F.col(key).alias("_fk"), F.col(day).alias("_own")).dropna()
    cells = known.groupBy("_fk", "_own").agg(F.count(F.lit(1)).alias("_rows"))
    return _total(cells.join(parents, (F.col("_fk") == F.col("_key")) & (F.col("_own") < F.col("_day"))), "_rows")


def row_count_gap(whole: DataFrame, *parts: DataFrame) -> DataFrame:
    """``abs(rows of the whole - rows of all parts)``."""
    signs = [whole.select(F.lit(1).cast("long").alias("_sign"))]
    signs += [part.select(F.lit(-1).cast("long").alias("_sign")) for part in parts]
    union = reduce(DataFrame.unionAll, signs)
    return union.agg(F.coalesce(F.abs(F.sum("_sign")), F.lit(0)).alias("failed_rows"))
