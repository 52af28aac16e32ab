"""Operators that need a global order: positions, n-tiles, medians.

Spark evaluates a window without PARTITION BY in one task. Here the rows are range-partitioned,
sorted inside each partition and numbered locally; the counts per partition (one row per
partition, so their broadcast is bounded by the partition count) turn local into global numbers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.sources.tables import stored

# monotonically_increasing_id() holds the partition number above bit 33, the row number below.
_LOCAL_BITS = 33


def _range_sorted(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Rows written in global order with partition number and local row number attached."""
    numbered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _LOCAL_BITS))
        .withColumn("_local", F.col("_id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
        .drop("_id")
    )
    return stored(numbered, label)


def global_positions(df: DataFrame, order: list[Column], label: str = "ordered") -> DataFrame:
    """Rows with ``position`` (0-based rank in the global order) and ``total`` (number of rows).

    ``order`` should end in columns that make rows distinct, so that no value holds up a partition.
    """
    rows = _range_sorted(df, order, label)
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # At most one row per range partition.
    offsets = parts.select(
        "_part",
        (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_offset"),
        F.sum("_n").over(W.partitionBy()).alias("total"),
    )
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn("position", F.col("_offset") + F.col("_local"))
        .drop("_part", "_local", "_offset")
    )


def with_ntile(df: DataFrame, tiles: int, order: list[Column], name: str = "tile") -> DataFrame:
    """Exact ``ntile(tiles)`` over the whole input; the first ``total % tiles`` tiles hold one row more."""
    placed = global_positions(df, order, "ntile")
    size = F.expr(f"total div {tiles}")
    longer = F.expr(f"total % {tiles}")
    in_longer = longer * (size + 1)
    tile = F.when(
        F.col("position") < in_longer,
        F.expr(f"position div (total div {tiles} + 1)") + 1,
    ).otherwise(
        longer
        + F.expr(
            f"(position - (total % {tiles}) * (total div {tiles} + 1)) div greatest(total div {tiles}, 1)"
        )
        + 1
    )
    return placed.withColumn(name, tile.cast("int")).drop("position", "total")


def average_ranks(counted: DataFrame, group: str, value: str, count: str) -> DataFrame:
    """Adds ``rank``, the average rank (from 1) of the rows that hold a value, to distinct values with counts.

    ``counted`` has one row per group and value. Values are numbered like rows above, so neither a
    large group nor a frequent value gathers in one task.
    """
    ordered = _range_sorted(counted, [F.col(group), F.col(value)], "ranks")
    parts = ordered.groupBy(group, "_part").agg(F.sum(count).alias("_rows"))
    # At most one row per group and range partition.
    before = F.sum("_rows").over(W.partitionBy(group).orderBy("_part")) - F.col("_rows")
    offsets = parts.select(group, "_part", before.alias("_before"))
    inside = W.partitionBy(group, "_part").orderBy("_local")
    return (
        ordered.join(F.broadcast(offsets), [group, "_part"])
        .withColumn("_to", F.col("_before") + F.sum(count).over(inside))
        .withColumn("rank", F.col("_to") - (F.col(count) - 1) / 2)
        .drop("_part", "_local", "_before", "_to")
    )


def exact_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact median of each numeric column: rows (metric, row_count, median), NULLs left out.

    Equal values are counted before anything moves, so a value held by most rows costs one row. The
    input is read once per column, and only that column of it.
    """
    counted = reduce(
        DataFrame.unionAll,
        [
            df.select(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("double").alias("value"))
            .filter("value is not null")
            .groupBy("metric", "value")
            .agg(F.count(F.lit(1)).alias("_n"))
            for c in columns
        ],
    )
    ordered = _range_sorted(counted, [F.col("metric"), F.col("value")], "median")

    by_metric = W.partitionBy("metric")
    parts = (
        ordered.groupBy("metric", "_part")
        .agg(F.sum("_n").alias("_part_rows"))
        .withColumn("row_count", F.sum("_part_rows").over(by_metric))
        .withColumn("_end", F.sum("_part_rows").over(by_metric.orderBy("_part")))
        .withColumn("_low", F.expr("(row_count - 1) div 2"))
        .withColumn("_high", F.expr("row_count div 2"))
        .withColumn("_begin", F.col("_end") - F.col("_part_rows"))
        .filter("_begin <= _high and _end > _low")
        .drop("_end", "_part_rows")
    )
    inside = W.partitionBy("metric", "_part").orderBy("_local")
    return (
        ordered.join(F.broadcast(parts), ["metric", "_part"])
        .withColumn("_to", F.col("_begin") + F.sum("_n").over(inside))
        .withColumn("_from", F.col("_to") - F.col("_n"))
        .groupBy("metric", "row_count")
        .agg(
            F.max(F.when(F.expr("_from <= _low and _low < _to"), F.col("value"))).alias("_a"),
            F.max(F.when(F.expr("_from <= _high and _high < _to"), F.col("value"))).alias("_b"),
        )
        .select("metric", "row_count", ((F.col("_a") + F.col("_b")) / 2).alias("median"))
    )
