"""Findings on the loan book and dashboard roll-ups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.measures import percent, sum_where
from ledgerloom.operators.correlation import rank_correlation
from ledgerloom.operators.growth import month_over_month
from ledgerloom.plans import fixed_values as fixed

Tables = Mapping[str, DataFrame]


def _rows():
    return F.count(F.lit(1))


def loan_book(t: Tables) -> DataFrame:
    """Size of the loan book and its bad share by count and by amount."""
    bad = F.col("is_bad") == 1
    return t["stg_loan"].agg(
        _rows().alias("loans"),
        F.sum("amount").alias("loan_amount"),
        percent(F.sum("is_bad"), _rows(), None).alias("bad_pct_by_count"),
        percent(sum_where(F.col("amount"), bad), F.sum("amount"), None).alias("bad_pct_by_amount"),
    )


def _loans_by_region(t: Tables, *extra) -> DataFrame:
    loans = t["mart_account_360"].filter(F.col("loan_id").isNotNull())
    bad = F.sum(F.coalesce("loan_is_bad", F.lit(0)))
    return (
        loans.groupBy("region")
        .agg(
            F.count("loan_id").alias("loans"),
            *extra,
            bad.alias("bad_loans"),
            percent(bad, F.count("loan_id")).alias("bad_loan_pct"),
        )
        .orderBy(F.desc("bad_loan_pct"), "region")
    )


def bad_rate_by_region(t: Tables) -> DataFrame:
    return _loans_by_region(t)


def loans_by_region(t: Tables) -> DataFrame:
    """As above with the amount lent."""
    return _loans_by_region(t, F.sum("loan_amount").alias("loan_amount"))


def bad_rate_range(t: Tables) -> DataFrame:
    return _loans_by_region(t).agg(
        F.min("bad_loan_pct").alias("lowest_pct"), F.max("bad_loan_pct").alias("highest_pct")
    )


def bad_rate_by_duration(t: Tables) -> DataFrame:
    return (
        t["stg_loan"]
        .filter(F.col("duration_months").isNotNull())
        .groupBy("duration_months")
        .agg(F.count("loan_id").alias("loans"), percent(F.sum("is_bad"), _rows(), None).alias("bad_loan_pct"))
    )


def bad_rate_by_overdraft(t: Tables) -> DataFrame:
    """Loans by whether the account was overdrawn in the report year; no balance counts as not."""
    overdrawn = F.coalesce(F.col("negative_months_1998") > 0, F.lit(False))
    return (
        t["mart_account_360"]
        .filter(F.col("loan_id").isNotNull())
        .groupBy(overdrawn.cast("int").alias("overdrawn_1998"))
        .agg(
            F.count("loan_id").alias("loans"),
            F.sum("loan_is_bad").alias("bad_loans"),
            percent(F.sum("loan_is_bad"), _rows(), None).alias("bad_loan_pct"),
        )
    )


def tiers_in_order(t: Tables) -> DataFrame:
    place = F.array_position(F.array(*[F.lit(tier) for tier in fixed.TIERS]), F.col("tier"))
    return t["vw_tier_summary"].orderBy(place)


def district_correlations(t: Tables) -> DataFrame:
    """Spearman's rho of district metrics with the bad-loan rate, districts with enough loans only."""
    districts = t["vw_district_scorecard"].filter(F.col("loans") >= fixed.MIN_LOANS_PER_DISTRICT)
    return rank_correlation(districts, fixed.DISTRICT_METRICS, "bad_loan_pct").select(
        F.col("metric").alias("district_metric"),
        F.col("pairs").alias("districts"),
        F.round("rho", 2).alias("spearman_rho"),
        F.round("p_value", 2).alias("p_value"),
    )


# Dashboard roll-ups.


def balance_by_month_and_tier(t: Tables) -> DataFrame:
    return t["vw_balance_trend_monthly"].groupBy("month", "tier").agg(F.sum("total_balance").alias("total_balance"))


def flows_by_month(t: Tables, region: str | None = None) -> DataFrame:
    trend = t["vw_balance_trend_monthly"]
    if region is not None:
        trend = trend.filter(F.col("region") == region)
    return trend.groupBy("month").agg(F.sum("credits").alias("credits"), F.sum("debits").alias("debits"))


def bad_amount_rate(t: Tables, by: str) -> DataFrame:
    """Measure "Bad Loan %": bad over total amount as a fraction, NULL for an empty total."""
    return (
        t["vw_loan_portfolio"]
        .groupBy(by)
        .agg(
            F.sum("loans").alias("loans"),
            F.try_divide(F.sum("bad_amount").cast("double"), F.sum("loan_amount").cast("double")).alias("bad_loan_share"),
        )
    )


def unemployment_and_bad_rate(t: Tables) -> DataFrame:
    """Pairs for the scatter of district unemployment against the bad-loan rate."""
    return t["vw_district_scorecard"].select("district_id", "district_name", "unemployment_96", "bad_loan_pct")


def balance_growth(t: Tables) -> DataFrame:
    """Measure "Balance MoM %": change of the total balance against the previous month."""
    totals = t["vw_balance_trend_monthly"].groupBy("month").agg(F.sum("total_balance").alias("total_balance"))
    return month_over_month(totals, "total_balance")


def top_failing_checks(log: DataFrame, top: int = 3) -> DataFrame:
    return (
        log.filter(F.col("status") == "FAIL")
        .orderBy(F.desc("failed_rows"), "check_name")
        .limit(top)
        .select("check_name", "failed_rows", "description")
    )
