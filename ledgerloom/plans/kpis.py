"""KPI table and report sheets."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.measures import percent, sum_where
from ledgerloom.plans import fixed_values as fixed
from ledgerloom.plans.insights import loans_by_region

Tables = Mapping[str, DataFrame]


def _kpi(number: int, value: Column, decimals: int) -> Column:
    value = value.cast("double")
    return F.struct(
        F.lit(number).alias("kpi_no"),
        F.lit(fixed.KPI_NAMES[number]).alias("kpi"),
        value.alias("value"),
        F.format_number(value, decimals).alias("display"),
    )


def _kpis(df: DataFrame, *entries: Column) -> DataFrame:
    return df.select(F.inline(F.array(*entries)))


def kpi_table(t: Tables, log: DataFrame) -> DataFrame:
    """Rows (kpi_no, kpi, value, display); each source table is aggregated once.

    The first row, the reporting month, has a display text only.
    """
    profile = t["mart_account_360"].agg(
        F.count(F.lit(1)).alias("accounts"),
        F.sum("balance_dec98").alias("balance"),
        F.count_if(F.col("negative_months_1998") > 0).alias("overdrawn"),
    )
    months = (
        t["mart_account_month"]
        .filter((F.col("year") >= fixed.REPORT_YEAR) & (F.col("month") >= fixed.REPORT_YEAR_FROM))
        .agg(F.sum("net_flow").alias("net_flow"))
    )
    loans = t["stg_loan"].agg(
        F.count(F.lit(1)).alias("loans"),
        F.sum("amount").alias("amount"),
        percent(sum_where(F.col("amount"), F.col("is_bad") == 1), F.sum("amount")).alias("bad"),
    )
    checks = log.agg(
        F.count_if(F.col("status") == "FAIL").alias("failed"), F.count_if(F.col("status") == "WARN").alias("warned")
    )
    as_of = F.struct(
        F.lit(0).alias("kpi_no"),
        F.lit(fixed.KPI_NAMES[0]).alias("kpi"),
        F.lit(None).cast("double").alias("value"),
        F.lit(fixed.LAST_MONTH_TEXT).alias("display"),
    )
    return (
        _kpis(
            profile,
            as_of,
            _kpi(1, F.col("accounts"), 0),
            _kpi(2, F.col("balance"), 1),
            _kpi(7, F.col("overdrawn"), 0),
        )
        .unionByName(_kpis(months, _kpi(3, F.col("net_flow"), 1)))
        .unionByName(
            _kpis(loans, _kpi(4, F.col("loans"), 0), _kpi(5, F.col("amount"), 1), _kpi(6, F.col("bad"), 1))
        )
        .unionByName(_kpis(checks, _kpi(8, F.col("failed"), 0), _kpi(9, F.col("warned"), 0)))
        .orderBy("kpi_no")
    )


def watchlist_by_amount(t: Tables) -> DataFrame:
    return t["vw_loan_watchlist"].orderBy(F.desc("amount"), "loan_id")


def report_sheets(t: Tables, log: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """The five sheets of the monthly report pack."""
    return {
        "kpis": lambda: kpi_table(t, log),
        "tier_summary": lambda: t["vw_tier_summary"],
        "loans_by_region": lambda: loans_by_region(t),
        "loan_watchlist": lambda: watchlist_by_amount(t),
        "dq_status": lambda: log,
    }
