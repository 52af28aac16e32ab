"""Every registered query by name: ``(spark, folder of the star tables) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from ledgerloom.operators.balances import balance_gaps
from ledgerloom.operators.checks import append_log, failing, run_checks
from ledgerloom.plans import evidence, insights, kpis, star_queries
from ledgerloom.plans.bank import TABLE_NAMES, Bank
from ledgerloom.plans.marts import MONTH_PARTITIONS, append_months, build_account_month
from ledgerloom.plans.quality import SHORT_CHECKS, postings_by_spine, raw_row_counts, unparsed_dates
from ledgerloom.plans.star import raw_bank_tables
from ledgerloom.plans.views import VIEWS, raw_portfolio_by_region, register_views
from ledgerloom.sources.delimited import read_delimited, write_delimited
from ledgerloom.sources.schemas import CAUSES_SCHEMA
from ledgerloom.sources.tables import run_dir, write_table

Query = Callable[[SparkSession, str], DataFrame]

_banks: dict[tuple[str, str], Bank] = {}


def bank(spark: SparkSession, folder: str) -> Bank:
    """The bank read out of the star tables in ``folder``; its tables are written once per application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _banks:
        place = "-".join(part for part in folder.split("/") if part)
        _banks[key] = Bank(raw_bank_tables(spark, folder), f"{run_dir(spark)}/bank-{place}-{len(_banks)}")
    return _banks[key]


def forget_banks() -> None:
    """Let the next query build its bank tables again."""
    _banks.clear()


def _edge(df: DataFrame) -> DataFrame:
    """Values as they leave: decimals as doubles, dates and times as ISO text."""

    def out(field):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, TimestampType | TimestampNTZType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return column.alias(field.name)

    return df.select(*[out(field) for field in df.schema.fields])


def _on_bank(build: Callable[[Bank], DataFrame]) -> Query:
    return lambda spark, folder: _edge(build(bank(spark, folder)))


def _on_log(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: _edge(build(bank(spark, folder).check_log()))


def _on_star(build: Query) -> Query:
    return lambda spark, folder: _edge(build(spark, folder))


def _table(name: str) -> Query:
    return _on_bank(lambda b: b[name])


def _log_columns(log: DataFrame) -> DataFrame:
    return log.drop("run_ts")


def _account_months(months: DataFrame) -> DataFrame:
    return months.drop(*MONTH_PARTITIONS)


def _appended_months(b: Bank) -> DataFrame:
    """The month table built up to the calendar's last year but one, then month runs added to it, one of them twice."""
    first, last = b.months
    spark, year = b["stg_account"].sparkSession, int(last[:4])
    place = f"{run_dir(spark)}/appended-{uuid.uuid4().hex}"
    write_table(build_account_month(b["stg_account"], b["stg_trans"], first, f"{year - 2}-12-01"), place, MONTH_PARTITIONS)
    for start, end in ((f"{year - 1}-01-01", f"{year}-03-01"), (f"{year}-04-01", last), (f"{year}-04-01", last)):
        table = append_months(spark, place, b["stg_account"], b["stg_trans"], start, end)
    return _account_months(table)


def _known_causes(log: DataFrame) -> DataFrame:
    """What a user of the job might supply: two of the checks are explained, one twice."""
    rows = [
        ("TXN_DUPLICATE_POSTING", "second posting made for the query", "rejected"),
        ("NEGATIVE_BALANCE_TXNS", "orders outweigh payments", "kept"),
        ("NEGATIVE_BALANCE_TXNS", "closing sum is reported on each posting", "kept"),
    ]
    return log.sparkSession.createDataFrame(rows, CAUSES_SCHEMA)


def _history(spark: SparkSession, folder: str) -> DataFrame:
    """Checks kept per run after two runs, of which one was appended twice."""
    log, place = bank(spark, folder).check_log(), f"{run_dir(spark)}/history-{uuid.uuid4().hex}"
    for stamp in ("2024-05-06 07:08:09", "2024-05-07 00:00:01", "2024-05-06 07:08:09"):
        append_log(log.withColumn("run_ts", F.lit(stamp).cast("timestamp")), place)
    kept = spark.read.parquet(place)
    return kept.groupBy(F.col("run_ts").cast("string").alias("run")).agg(F.count(F.lit(1)).alias("checks"))


def _catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """The views as registered in the session, with their numbers of rows."""
    names = register_views(spark, bank(spark, folder))
    counts = [spark.table(name).agg(F.lit(name).alias("view"), F.count(F.lit(1)).alias("rows")) for name in sorted(names)]
    return reduce(DataFrame.unionAll, counts)


def _export(spark: SparkSession, folder: str) -> DataFrame:
    """The loan watchlist as exported text, read back."""
    rows, place = bank(spark, folder)["vw_loan_watchlist"], f"{run_dir(spark)}/export-{uuid.uuid4().hex}"
    write_delimited(rows, place)
    return read_delimited(spark, place, rows.schema, sep=",")


STAR_QUERIES: dict[str, Query] = {
    name: _on_star(getattr(star_queries, name))
    for name in (
        "orders_account_month",
        "orders_month_spine",
        "orders_period_flows",
        "orders_clean",
        "events_kept",
        "events_rejected",
        "events_conservation",
        "lines_kept",
        "lines_rejected",
        "customer_quartiles",
        "part_sevenths",
        "customer_best_priority",
        "lineitem_medians",
        "orders_balance_gaps",
        "orders_growth",
        "orders_growth_by_status",
        "nation_correlations",
        "line_correlations",
        "portfolio_by_region",
        "star_check_log",
    )
}

BANK_QUERIES: dict[str, Query] = {
    **{name: _table(name) for name in TABLE_NAMES},
    **{name: _table(name) for name in VIEWS},
    "mart_account_month": _on_bank(lambda b: _account_months(b["mart_account_month"])),
    "mart_account_month_appended": _on_bank(_appended_months),
    "raw_portfolio_by_region": _on_bank(raw_portfolio_by_region),
    "dq_log": _on_log(_log_columns),
    "dq_log_short": _on_bank(lambda b: _log_columns(run_checks(b, SHORT_CHECKS))),
    "dq_alert_rows": _on_log(lambda log: failing(log).select("check_name", "failed_rows")),
    "dq_unparsed_dates": _on_bank(unparsed_dates),
    "dq_postings_outside_spine": _on_bank(lambda b: postings_by_spine(b, *b.months)),
    "raw_row_counts": _on_bank(raw_row_counts),
    "top_failing_checks": _on_log(insights.top_failing_checks),
    "rca_status_summary": _on_log(evidence.status_counts),
    "rca_open_checks": _on_log(evidence.open_checks),
    "rca_passed_list": _on_log(evidence.passed_list),
    "rca_causes": _on_log(lambda log: evidence.causes(log, _known_causes(log))),
    "rca_missing_district_values": _on_bank(evidence.missing_district_values),
    "rca_symbol_encodings": _on_bank(evidence.symbol_encodings),
    "rca_legacy_codes_by_year": _on_bank(evidence.legacy_codes_by_year),
    "rca_zero_amounts": _on_bank(evidence.zero_amounts),
    "rca_rejected_duplicates": _on_bank(evidence.rejected_duplicates),
    "rca_transfers_without_counterparty": _on_bank(evidence.transfers_without_counterparty),
    "rca_negative_balances_by_year": _on_bank(evidence.negative_balances_by_year),
    "rca_reconciliation_stats": _on_bank(evidence.reconciliation_stats),
    "balance_gaps": _on_bank(lambda b: balance_gaps(b["stg_trans"])),
    "insight_loan_book": _on_bank(insights.loan_book),
    "insight_bad_rate_by_region": _on_bank(insights.bad_rate_by_region),
    "insight_bad_rate_range": _on_bank(insights.bad_rate_range),
    "insight_bad_rate_by_duration": _on_bank(insights.bad_rate_by_duration),
    "insight_bad_rate_by_overdraft": _on_bank(insights.bad_rate_by_overdraft),
    "insight_tiers_in_order": _on_bank(insights.tiers_in_order),
    "insight_district_correlations": _on_bank(insights.district_correlations),
    "kpi_table": _on_bank(lambda b: kpis.kpi_table(b, b.check_log())),
    "sheet_loans_by_region": _on_bank(insights.loans_by_region),
    "sheet_watchlist_by_amount": _on_bank(kpis.watchlist_by_amount),
    "dash_balance_by_month_and_tier": _on_bank(insights.balance_by_month_and_tier),
    "dash_flows_by_month": _on_bank(insights.flows_by_month),
    "dash_flows_by_month_one_region": _on_bank(lambda b: insights.flows_by_month(b, "EUROPE")),
    "dash_bad_amount_rate_by_region": _on_bank(lambda b: insights.bad_amount_rate(b, "region")),
    "dash_bad_amount_rate_by_duration": _on_bank(lambda b: insights.bad_amount_rate(b, "duration_months")),
    "dash_unemployment_and_bad_rate": _on_bank(insights.unemployment_and_bad_rate),
    "dash_balance_growth": _on_bank(insights.balance_growth),
    "exported_watchlist": _on_star(_export),
    "history_runs": _history,
    "registered_views": _catalogue,
    "delimited_round_trip": lambda spark, folder: _edge(
        star_queries.delimited_round_trip(spark, bank(spark, folder)["raw_trans"])
    ),
}

QUERIES: dict[str, Query] = {**STAR_QUERIES, **BANK_QUERIES}
