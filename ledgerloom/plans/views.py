"""Reporting views: each is a function from a table lookup to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_start, month_text
from ledgerloom.functions.measures import percent, sum_where
from ledgerloom.plans import fixed_values as fixed

Tables = Mapping[str, DataFrame]


def _rows():
    return F.count(F.lit(1))


def _bad_loans():
    return F.sum(F.coalesce("loan_is_bad", F.lit(0)))


def balance_trend_monthly(t: Tables) -> DataFrame:
    groups = t["mart_account_360"].select("account_id", "tier", "region")
    return (
        t["mart_account_month"]
        .join(groups, "account_id")
        .groupBy("month", "tier", "region")
        .agg(
            _rows().alias("accounts"),
            F.sum("est_balance").alias("total_balance"),
            F.sum("credits").alias("credits"),
            F.sum("debits").alias("debits"),
        )
    )


def tier_summary(t: Tables) -> DataFrame:
    loans = F.count("loan_id")
    return (
        t["mart_account_360"]
        .groupBy("tier")
        .agg(
            _rows().alias("accounts"),
            F.round(F.avg("avg_balance_1998"), 0).alias("avg_balance"),
            percent(F.count_if(F.col("cards") > 0), _rows()).alias("card_penetration_pct"),
            loans.alias("loans"),
            percent(_bad_loans(), loans).alias("bad_loan_pct"),
            F.count_if(F.col("negative_months_1998") > 0).alias("accounts_overdrawn_1998"),
        )
    )


def cashflow_monthly(t: Tables) -> DataFrame:
    groups = ["txn_type", "operation", "k_symbol"]
    flows = (
        t["stg_trans"]
        .groupBy(month_start(F.col("txn_date")).alias("_month"), *groups)
        .agg(_rows().alias("txn_count"), F.sum("amount").alias("amount"))
    )
    return flows.select(month_text(F.col("_month")).alias("month"), *groups, "txn_count", "amount")


def loan_portfolio(t: Tables) -> DataFrame:
    homes = t["stg_account"].select("account_id", "district_id")
    places = t["stg_district"].select("district_id", "region", "district_name")
    return (
        t["stg_loan"]
        .join(homes, "account_id")
        .join(places, "district_id")
        .groupBy("region", "district_name", "status_desc", "duration_months")
        .agg(
            _rows().alias("loans"),
            F.sum("amount").alias("loan_amount"),
            sum_where(F.col("amount"), F.col("is_bad") == 1).alias("bad_amount"),
            F.sum("is_bad").alias("bad_loans"),
        )
    )


def loan_watchlist(t: Tables) -> DataFrame:
    profile = t["mart_account_360"].select(
        "account_id", "district_name", "region", "tier", "balance_dec98", "negative_months_1998"
    )
    balance = F.col("balance_dec98")
    cover = (
        F.when(balance < 0, fixed.OVERDRAWN)
        .when(balance < fixed.COVER_PAYMENTS * F.col("monthly_payment"), fixed.LOW_COVER)
        .otherwise(fixed.COVERED)
    )
    return (
        t["stg_loan"]
        .filter(F.col("status").isin(*fixed.BAD_STATUS))
        .join(profile, "account_id")
        .select(
            "loan_id",
            "account_id",
            "loan_date",
            "amount",
            "duration_months",
            "monthly_payment",
            "status",
            "status_desc",
            "district_name",
            "region",
            "tier",
            "balance_dec98",
            "negative_months_1998",
            cover.alias("balance_cover"),
        )
    )


def district_scorecard(t: Tables) -> DataFrame:
    """Every district, those without accounts included.

    The accounts are summed per district before the join, so a district holding most accounts
    costs one row there.
    """
    loans = F.count("loan_id")
    per_district = (
        t["mart_account_360"]
        .groupBy("district_id")
        .agg(
            _rows().alias("accounts"),
            F.round(F.avg("avg_balance_1998"), 0).alias("avg_balance"),
            loans.alias("loans"),
            _bad_loans().alias("bad_loans"),
            percent(_bad_loans(), loans).alias("bad_loan_pct"),
        )
    )
    return (
        t["stg_district"]
        .join(per_district, "district_id", "left")
        .select(
            "district_id",
            "district_name",
            "region",
            "inhabitants",
            "avg_salary",
            "unemployment_96",
            "crimes_96",
            F.coalesce("accounts", F.lit(0)).alias("accounts"),
            "avg_balance",
            F.coalesce("loans", F.lit(0)).alias("loans"),
            F.coalesce("bad_loans", F.lit(0)).alias("bad_loans"),
            "bad_loan_pct",
        )
    )


def card_summary(t: Tables) -> DataFrame:
    return (
        t["mart_account_360"]
        .groupBy(F.coalesce("top_card", F.lit(fixed.NO_CARD)).alias("card_type"), "tier")
        .agg(_rows().alias("accounts"), F.round(F.avg("avg_balance_1998"), 0).alias("avg_balance"))
    )


def standing_orders(t: Tables) -> DataFrame:
    return (
        t["stg_order"]
        .groupBy("purpose")
        .agg(
            _rows().alias("orders"),
            F.sum("amount").alias("total_amount"),
            F.round(F.sum("amount").cast("double") / F.count("amount"), 0).alias("avg_amount"),
        )
    )


VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "vw_balance_trend_monthly": balance_trend_monthly,
    "vw_tier_summary": tier_summary,
    "vw_cashflow_monthly": cashflow_monthly,
    "vw_loan_portfolio": loan_portfolio,
    "vw_loan_watchlist": loan_watchlist,
    "vw_district_scorecard": district_scorecard,
    "vw_card_summary": card_summary,
    "vw_standing_orders": standing_orders,
}


def raw_portfolio_by_region(t: Tables) -> DataFrame:
    """Loan book by region straight from the raw tables, the bad share as ``decimal(5,1)``."""
    bad = sum_where(F.col("amount"), F.col("status").isin(*fixed.BAD_STATUS))
    total = F.sum("amount")
    return (
        t["raw_loan"]
        .join(t["raw_account"].select("account_id", "district_id"), "account_id")
        .join(t["raw_district"].select(F.col("A1").alias("district_id"), F.col("A3").alias("region")), "district_id")
        .groupBy("region")
        .agg(
            _rows().alias("loans"),
            total.alias("loan_amount"),
            bad.alias("bad_amount"),
            percent(bad, total, None).cast("decimal(5,1)").alias("bad_amount_pct"),
        )
    )


def register_views(spark: SparkSession, t: Tables) -> list[str]:
    """Make the reporting views available to SQL under their names."""
    for name in VIEWS:
        t[name].createOrReplaceTempView(name)
    return [table.name for table in spark.catalog.listTables() if table.name in VIEWS]
