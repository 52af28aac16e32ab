"""The batch job: raw files in, tables, check log, evidence, findings and report pack out."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators.checks import append_log, gate
from ledgerloom.plans import evidence, insights, kpis
from ledgerloom.plans.bank import Bank
from ledgerloom.plans.fixed_values import FIRST_MONTH, LAST_MONTH
from ledgerloom.plans.quality import expected_row_checks, postings_by_spine
from ledgerloom.plans.views import VIEWS, raw_portfolio_by_region
from ledgerloom.session import build_session
from ledgerloom.sources.delimited import locate_input, read_delimited, read_raw_tables, write_delimited
from ledgerloom.sources.schemas import CAUSES_SCHEMA
from ledgerloom.sources.tables import in_parallel

EXPORTED_TABLES = ("mart_account_360", "stg_district")


Build = Callable[[], DataFrame]


def evidence_tables(bank: Bank, log: DataFrame, causes: DataFrame | None = None) -> dict[str, Build]:
    """Check summary, open checks with the causes that were given, and the evidence of each check."""
    tables: dict[str, Build] = {
        "summary": lambda: evidence.status_counts(log),
        "open_checks": lambda: evidence.open_checks(log),
        "passed": lambda: evidence.passed_list(log),
        "postings_by_spine": lambda: postings_by_spine(bank, *bank.months),
    }
    if causes is not None:
        tables["causes"] = lambda: evidence.causes(log, causes)
    return tables | {name.lower(): partial(build, bank) for name, build in evidence.EVIDENCE.items()}


def insight_tables(bank: Bank) -> dict[str, Build]:
    reports = {
        "loan_book": insights.loan_book,
        "bad_rate_by_region": insights.bad_rate_by_region,
        "bad_rate_range": insights.bad_rate_range,
        "bad_rate_by_duration": insights.bad_rate_by_duration,
        "bad_rate_by_overdraft": insights.bad_rate_by_overdraft,
        "tiers": insights.tiers_in_order,
        "district_correlations": insights.district_correlations,
        "balance_growth": insights.balance_growth,
        "portfolio_by_region": raw_portfolio_by_region,
    }
    return {name: partial(report, bank) for name, report in reports.items()}


def run_job(
    raw: Mapping[str, DataFrame],
    output: str,
    run_ts: dt.datetime | None = None,
    fail_on_error: bool = False,
    expected_rows: Mapping[str, int] | None = None,
    months: tuple[str, str] = (FIRST_MONTH, LAST_MONTH),
    causes: DataFrame | None = None,
) -> Bank:
    """All stages in order in one application; the first error stops the run.

    Below ``output``: ``tables/`` (Parquet), ``dq_history/`` (one log per run), ``exports/``,
    ``evidence/``, ``insights/`` and ``report/run_date=.../`` (delimited text). With
    ``fail_on_error`` failed checks raise after everything has been written. ``expected_rows`` adds
    a check on the number of rows of the raw tables it names. ``months`` are the first and last month
    of the month table; ``causes`` (check_name, likely_cause, treatment) is what is known about checks.
    ``run_ts`` is UTC, as the session's time zone is.
    """
    run_ts = run_ts or dt.datetime.now(dt.UTC).replace(microsecond=0, tzinfo=None)
    output = output.rstrip("/")
    bank = Bank(raw, f"{output}/tables", months)
    bank.build()
    log = bank.check_log(run_ts, expected_row_checks(expected_rows or {}))
    append_log(log, f"{output}/dq_history")

    exports: dict[str, Build] = {name: partial(bank.__getitem__, name) for name in (*VIEWS, *EXPORTED_TABLES)}
    exports["dq_log"] = lambda: log
    packs = {
        "exports": exports,
        "evidence": evidence_tables(bank, log, causes),
        "insights": insight_tables(bank),
        f"report/run_date={run_ts.date().isoformat()}": kpis.report_sheets(bank, log),
    }
    in_parallel(
        [
            lambda build=build, path=f"{output}/{folder}/{name}": write_delimited(build(), path)
            for folder, tables in packs.items()
            for name, build in tables.items()
        ]
    )
    if fail_on_error:
        gate(log)
    return bank


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", help="folder with the eight .asc files")
    parser.add_argument("--search", nargs="*", default=["data/raw", "data", ".", ".."], help="folders to look in otherwise")
    parser.add_argument("--output", required=True, help="folder for all results")
    parser.add_argument("--expect", nargs="*", default=[], metavar="TABLE=ROWS", help="rows the raw tables must have")
    parser.add_argument("--first-month", default=FIRST_MONTH, help="first month of the month table, as its first day")
    parser.add_argument("--last-month", default=LAST_MONTH, help="last month of the month table, as its first day")
    parser.add_argument("--causes", help="text table check_name;likely_cause;treatment to show with open checks")
    parser.add_argument("--gate", action="store_true", help="end with an error if a check fails")
    args = parser.parse_args(argv)
    spark: SparkSession = build_session()
    folder = locate_input(spark, args.input, args.search)
    expected = {table: int(rows) for table, rows in (entry.split("=") for entry in args.expect)}
    causes = read_delimited(spark, args.causes, CAUSES_SCHEMA) if args.causes else None
    run_job(
        read_raw_tables(spark, folder),
        args.output,
        fail_on_error=args.gate,
        expected_rows=expected,
        months=(args.first_month, args.last_month),
        causes=causes,
    )


if __name__ == "__main__":
    main()
