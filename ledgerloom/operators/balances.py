"""Month-end balances rebuilt from postings, and their reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.dates import Calendar, month_start, month_text
from ledgerloom.functions.measures import sum_where

FLOWS = ["credits", "debits", "net_flow", "txn_count"]


def month_spine(accounts: DataFrame, account: str, opened: str, first: str, last: str) -> DataFrame:
    """One row (account, month) from the month of opening, but not before ``first``, to ``last``.

    ``first`` and ``last`` are days like ``1993-01-01``. An account without an opening date, or
    opened after the end, has no months. The months are generated per account; nothing is joined.
    """
    calendar = Calendar(first, last)
    begin = _begin(calendar, opened)
    months = F.slice(calendar.texts(), begin, F.lit(calendar.months) + 1 - begin)
    return accounts.filter(begin <= calendar.months).select(account, F.explode(months).alias("month"))


def _begin(calendar: Calendar, opened: str):
    # greatest() skips NULL; an account without an opening date must stay without a month.
    number = calendar.number(F.col(opened))
    return F.when(number.isNotNull(), F.greatest(number, F.lit(1)))


def period_flows(postings: DataFrame, account: str, posted: str, amount: str) -> DataFrame:
    """Credits, debits, net flow and number of postings per account and month."""
    value = F.col(amount)
    flows = (
        postings.select(account, month_start(F.col(posted)).alias("_month"), value)
        .groupBy(account, "_month")
        .agg(
            sum_where(value, value > 0).alias("credits"),
            sum_where(-value, value < 0).alias("debits"),
            F.sum(value).alias("net_flow"),
            F.count(F.lit(1)).alias("txn_count"),
        )
    )
    # Months become text once they are few.
    return flows.select(account, month_text(F.col("_month")).alias("month"), *FLOWS)


def account_month(
    accounts: DataFrame,
    postings: DataFrame,
    *,
    account: str = "account_id",
    opened: str = "open_date",
    posted: str = "txn_date",
    amount: str = "signed_amount",
    first: str,
    last: str,
    carried: DataFrame | None = None,
) -> DataFrame:
    """Dense account x month table: flows (0 where none) and the running balance ``est_balance``.

    Postings before the account's first month or outside ``first`` .. ``last`` do not count, and
    postings of unknown accounts are left out. ``account`` is unique in ``accounts``.

    ``carried`` (account, est_balance) are the closing balances of the month before ``first``: with them
    the rows are those that a table from an earlier month on has from ``first`` on, out of the postings
    since then alone.

    The table is dense only in its last step. The opening months enter the monthly aggregation as
    empty postings; the running sum then works on the months that have something, at most one row
    per account and month whatever an account's share of the postings, and each row is unrolled up
    to the next one. That takes two shuffles, of aggregated rows, and no join; joining a spine to
    the flows would shuffle the dense table twice.
    """
    calendar = Calendar(first, last)
    begin, end = _begin(calendar, opened), calendar.months
    posted_in = calendar.number(F.col(posted))
    value_type = postings.schema[amount].dataType
    openings = accounts.filter(begin <= end).select(
        F.col(account), begin.alias("_month"), F.lit(None).cast(value_type).alias("_value"), F.lit(True).alias("_opening")
    )
    moves = postings.filter(posted_in.between(1, end)).select(
        F.col(account), posted_in.alias("_month"), F.col(amount).alias("_value"), F.lit(False).alias("_opening")
    )
    flow = F.col("_value")
    events = openings.unionByName(moves)
    if carried is not None:
        balances_before = carried.select(
            F.col(account), F.lit(1).alias("_month"), F.lit(None).cast(value_type).alias("_value"), F.lit(True).alias("_opening"),
            F.col("est_balance").alias("_carried"),
        )
        events = events.unionByName(balances_before, allowMissingColumns=True)
    active = (
        events.groupBy(account, "_month")
        .agg(
            F.bool_or("_opening").alias("_opening"),
            sum_where(flow, flow > 0).alias("credits"),
            sum_where(-flow, flow < 0).alias("debits"),
            F.count_if(~F.col("_opening")).alias("txn_count"),
            *([] if carried is None else [F.sum("_carried").alias("_carried")]),
        )
        .withColumn("net_flow", F.col("credits") - F.col("debits"))
    )
    by_month = W.partitionBy(account).orderBy("_month")
    so_far = by_month.rowsBetween(W.unboundedPreceding, W.currentRow)
    balances = (
        active.withColumn("_open", F.bool_or("_opening").over(so_far))
        .filter("_open")
        .withColumn("est_balance", F.sum("net_flow").over(so_far))
        .withColumn("_until", F.coalesce(F.lead("_month").over(by_month), F.lit(end + 1)))
    )
    if carried is not None:
        before = F.coalesce(F.sum("_carried").over(so_far), F.lit(0))
        kind = balances.schema["est_balance"].dataType
        balances = balances.withColumn("est_balance", (F.col("est_balance") + before).cast(kind))
    covered = F.slice(calendar.texts(), F.col("_month"), F.col("_until") - F.col("_month"))
    unrolled = balances.select(account, *FLOWS, "est_balance", F.posexplode(covered).alias("_later", "month"))
    flows = [F.when(F.col("_later") == 0, F.col(name)).otherwise(F.lit(0)).alias(name) for name in FLOWS]
    return unrolled.select(account, "month", *flows, "est_balance")


def balance_gaps(
    postings: DataFrame,
    *,
    account: str = "account_id",
    posted: str = "txn_date",
    amount: str = "signed_amount",
    reported: str = "balance_reported",
) -> DataFrame:
    """Per account the smallest gap between summed flows and a balance reported on its last day.

    Columns: account, n_rows_last_day, diff, n_txn. There is no order inside a day, so any row of
    the last day may settle the account. The totals combine before their shuffle; the join back is
    on account and day, and adaptive execution splits a day too heavy for one task.
    """
    totals = postings.groupBy(account).agg(
        F.sum(amount).alias("_total"), F.max(posted).alias("_last"), F.count(F.lit(1)).alias("n_txn")
    ).withColumnRenamed(account, "_account")
    closing = postings.select(account, posted, reported).join(
        totals, (F.col(account) == F.col("_account")) & (F.col(posted) == F.col("_last"))
    )
    return closing.groupBy(account, "n_txn").agg(
        F.count(F.lit(1)).alias("n_rows_last_day"),
        F.min(F.abs(F.col("_total") - F.col(reported))).alias("diff"),
    ).select(account, "n_rows_last_day", "diff", "n_txn")
