"""Account-month balances and the one-row-per-account profile."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.measures import exact_mean
from ledgerloom.operators.balances import account_month
from ledgerloom.operators.categories import best_category
from ledgerloom.operators.ordering import with_ntile
from ledgerloom.plans import fixed_values as fixed
from ledgerloom.sources.tables import read_table, replace_partitions, stored

#: Partition columns of the month table: the year, and the first month of the run that added the rows.
MONTH_PARTITIONS = ["year", "added_from"]


def _in_partitions(months: DataFrame, first: str) -> DataFrame:
    year = F.substring("month", 1, 4).cast("int")
    return months.withColumn("year", year).withColumn("added_from", F.lit(first[:7]))


def build_account_month(
    accounts: DataFrame, trans: DataFrame, first: str = fixed.FIRST_MONTH, last: str = fixed.LAST_MONTH
) -> DataFrame:
    return _in_partitions(account_month(accounts, trans, first=first, last=last), first)


def append_months(spark: SparkSession, path: str, accounts: DataFrame, trans: DataFrame, first: str, last: str) -> DataFrame:
    """Add the months from ``first`` to ``last`` to the month table at ``path`` and return it.

    Reads the closing balances of the month before ``first``, one partition of the table, and the
    postings of the new months. The result is the table that a full build up to ``last`` gives, as long
    as no posting of an earlier month came later. Adding the same months again replaces them.
    """
    day = dt.date.fromisoformat(first) - dt.timedelta(days=1)
    closed = read_table(spark, path).where((F.col("year") == day.year) & (F.col("month") == f"{day:%Y-%m}"))
    carried = stored(closed.select("account_id", "est_balance"), "closing-balances")
    since = trans.where(F.col("txn_date") >= F.lit(first).cast("date"))
    rows = account_month(accounts, since, first=first, last=last, carried=carried)
    return replace_partitions(_in_partitions(rows, first), path, MONTH_PARTITIONS)


def owners(disp: DataFrame, client: DataFrame) -> DataFrame:
    links = disp.filter(F.col("disp_type") == fixed.OWNER.lower()).select("account_id", "client_id")
    return links.join(client, "client_id").select(
        "account_id", F.col("client_id").alias("owner_client_id"), "gender", "age_at_1998"
    )


def report_year_balances(months: DataFrame) -> DataFrame:
    balance = F.col("est_balance")
    return (
        months.filter((F.col("year") >= fixed.REPORT_YEAR) & (F.col("month") >= fixed.REPORT_YEAR_FROM))
        .groupBy("account_id")
        .agg(
            exact_mean(balance).alias("avg_balance_1998"),
            F.max(F.when(F.col("month") == fixed.LAST_MONTH_TEXT, balance)).alias("balance_dec98"),
            F.min(balance).alias("min_balance_1998"),
            F.count_if(balance < 0).alias("negative_months_1998"),
            F.sum("txn_count").alias("txn_count_1998"),
        )
    )


def account_cards(card: DataFrame, disp: DataFrame) -> DataFrame:
    return (
        card.join(disp.select("disp_id", "account_id"), "disp_id")
        .groupBy("account_id")
        .agg(
            F.count(F.lit(1)).alias("cards"),
            best_category(F.col("card_type"), fixed.CARD_RANKS).alias("top_card"),
        )
    )


def account_base(
    account: DataFrame,
    disp: DataFrame,
    client: DataFrame,
    district: DataFrame,
    card: DataFrame,
    loan: DataFrame,
    months: DataFrame,
) -> DataFrame:
    """Account with owner, district, report-year balances, cards and loan.

    Owner and district are inner joins: an account without an owner drops out, one with two owners
    (or two loans) appears twice. All but the district join on the account, so they share its
    partitioning; the district table is broadcast by the planner as long as it is small.
    """
    places = district.select("district_id", "district_name", "region")
    loans = loan.select(
        "account_id",
        "loan_id",
        F.col("amount").alias("loan_amount"),
        F.col("status").alias("loan_status"),
        F.col("is_bad").alias("loan_is_bad"),
    )
    return (
        account.join(places, "district_id")
        .join(owners(disp, client), "account_id")
        .join(report_year_balances(months), "account_id", "left")
        .join(account_cards(card, disp), "account_id", "left")
        .join(loans, "account_id", "left")
        .select(
            "account_id",
            "open_date",
            "statement_frequency",
            "district_id",
            "district_name",
            "region",
            "owner_client_id",
            "gender",
            "age_at_1998",
            "avg_balance_1998",
            "balance_dec98",
            "min_balance_1998",
            "negative_months_1998",
            "txn_count_1998",
            F.coalesce("cards", F.lit(0)).alias("cards"),
            "top_card",
            "loan_id",
            "loan_amount",
            "loan_status",
            "loan_is_bad",
        )
    )


def with_tier(base: DataFrame) -> DataFrame:
    """Quartile label by report-year average balance; no balance sorts last, ids settle ties."""
    order = [
        F.desc_nulls_last("avg_balance_1998"),
        F.asc("account_id"),
        F.asc("owner_client_id"),
        F.asc_nulls_last("loan_id"),
    ]
    top, middle, bottom = fixed.TIERS
    tier = F.when(F.col("_tile") == 1, top).when(F.col("_tile") == 4, bottom).otherwise(middle)
    return with_ntile(base, 4, order, "_tile").withColumn("tier", tier).drop("_tile")
