"""Aggregate expressions shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def percent(part: Column, whole: Column, digits: int | None = 1) -> Column:
    """``100 * part / whole`` as a double, NULL for an empty whole."""
    ratio = F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))
    return ratio if digits is None else F.round(ratio, digits)


def sum_where(amount: Column, condition: Column) -> Column:
    """Sum of the amounts meeting a condition; 0 where none does."""
    return F.sum(F.when(condition, amount).otherwise(F.lit(0)))


def exact_mean(amount: Column) -> Column:
    """Mean of a decimal as a double: exact sum first, so the order of the rows has no effect."""
    return F.try_divide(F.sum(amount).cast("double"), F.count(amount).cast("double"))


def with_doubles(df: DataFrame) -> DataFrame:
    """Decimals to doubles, for results that leave the engine."""
    return df.select(
        *[
            F.col(f"`{field.name}`").cast("double").alias(field.name)
            if isinstance(field.dataType, DecimalType)
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        ]
    )
