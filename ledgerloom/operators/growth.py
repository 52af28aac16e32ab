"""Change against the previous month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def month_over_month(monthly: DataFrame, value: str, month: str = "month", by: tuple[str, ...] = ()) -> DataFrame:
    """Adds the previous calendar month's value and the relative change (NULL without one, or at 0).

    ``monthly`` has one row per month (``yyyy-MM`` text) and group. An equi join with the table
    moved by one month: a gap gives NULL rather than the change since an older month, and unlike a
    window over all months it needs no single partition.
    """
    moved = monthly.select(
        F.date_format(F.add_months(F.to_date(F.concat(F.col(month), F.lit("-01"))), 1), "yyyy-MM").alias("_month"),
        *[F.col(c).alias(f"_{c}") for c in by],
        F.col(value).alias("previous"),
    )
    condition = F.col(month) == F.col("_month")
    for c in by:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_{c}"))
    change = F.try_divide((F.col(value) - F.col("previous")).cast("double"), F.col("previous").cast("double"))
    return (
        monthly.join(moved, condition, "left")
        .withColumn("mom_change", change)
        .drop("_month", *[f"_{c}" for c in by])
    )
