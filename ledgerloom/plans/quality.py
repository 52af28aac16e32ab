"""The checks of the bank tables, in report order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.codes import is_blank
from ledgerloom.operators.balances import balance_gaps
from ledgerloom.operators.checks import Check, RowRule, Tables, run_checks
from ledgerloom.operators.matching import dated_before, orphans, repeated_groups, row_count_gap, without_match
from ledgerloom.plans import fixed_values as fixed


def _check(name: str, layer: str, measure, severity: str = "FAIL") -> Check:
    return Check(name, layer, severity, fixed.CHECK_TEXTS[name], measure)


def _placeholder(column: str) -> Column:
    return F.trim(column) == "?"


def missing_counterparty() -> Column:
    return F.col("operation").isin(*fixed.TRANSFER_OPERATIONS) & (F.col("bank").isNull() | F.col("account").isNull())


def not_positive() -> Column:
    return F.col("amount") <= 0


def _unexplained_operation() -> Column:
    return F.col("operation").isNull() & (F.coalesce(F.trim("k_symbol"), F.lit("")) != fixed.INTEREST)


def _payments_differ() -> Column:
    gap = F.abs(F.col("payments") * F.col("duration") - F.col("amount"))
    return gap > F.lit(fixed.PAYMENT_TOLERANCE).cast("decimal(3,2)") * F.col("amount")


def unreconciled(trans: DataFrame) -> DataFrame:
    """Accounts whose summed flows miss every balance reported on their last day by over the tolerance."""
    return balance_gaps(trans).filter(F.col("diff") > fixed.RECONCILIATION_TOLERANCE)


def _owner_links(t: Tables) -> DataFrame:
    return t["raw_disp"].filter(F.col("type") == fixed.OWNER)


def _cards_with_account(t: Tables) -> DataFrame:
    return t["stg_card"].join(t["stg_disp"].select("disp_id", "account_id"), "disp_id")


def _foreign_key(child: str, column: str, parent: str, key: str):
    return lambda t: orphans(t[child], column, t[parent], key)


def _before_opening(rows, day: str):
    return lambda t: dated_before(rows(t), "account_id", day, t["stg_account"], "account_id", "open_date")


BANK_CHECKS: list[Check] = [
    # Completeness and consistency.
    _check("DISTRICT_MISSING_VALUE", "raw", RowRule("raw_district", lambda: _placeholder("A12") | _placeholder("A15"))),
    _check("TXN_SYMBOL_INCONSISTENT_ENCODING", "raw", RowRule("raw_trans", lambda: is_blank(F.col("k_symbol")))),
    _check("TXN_LEGACY_TYPE_CODE", "raw", RowRule("raw_trans", lambda: F.col("type") == fixed.LEGACY_DEBIT)),
    _check("TXN_ZERO_AMOUNT", "raw", RowRule("raw_trans", not_positive)),
    _check("TXN_DUPLICATE_POSTING", "raw", RowRule("rej_trans", lambda: F.lit(True))),
    _check("TRANSFER_MISSING_COUNTERPARTY", "raw", RowRule("raw_trans", missing_counterparty)),
    _check("TXN_NULL_OPERATION_UNEXPLAINED", "raw", RowRule("raw_trans", _unexplained_operation)),
    # Business flags.
    _check("NEGATIVE_BALANCE_TXNS", "stg", RowRule("stg_trans", lambda: F.col("balance_reported") < 0), "WARN"),
    _check(
        "BALANCE_RECON_ACCOUNT",
        "stg",
        RowRule("unreconciled_accounts", lambda: F.lit(True)),
    ),
    # Referential integrity.
    _check("FK_DISP_CLIENT", "raw", _foreign_key("raw_disp", "client_id", "raw_client", "client_id")),
    _check("FK_DISP_ACCOUNT", "raw", _foreign_key("raw_disp", "account_id", "raw_account", "account_id")),
    _check("FK_LOAN_ACCOUNT", "raw", _foreign_key("raw_loan", "account_id", "raw_account", "account_id")),
    _check("FK_TRANS_ACCOUNT", "raw", _foreign_key("raw_trans", "account_id", "raw_account", "account_id")),
    _check("FK_CARD_DISP", "raw", _foreign_key("raw_card", "disp_id", "raw_disp", "disp_id")),
    _check("FK_CLIENT_DISTRICT", "raw", _foreign_key("raw_client", "district_id", "raw_district", "A1")),
    # Business rules.
    _check(
        "ACCOUNT_WITHOUT_OWNER",
        "raw",
        lambda t: without_match(t["raw_account"], "account_id", _owner_links(t), "account_id"),
    ),
    _check("ACCOUNT_MULTIPLE_OWNERS", "raw", lambda t: repeated_groups(_owner_links(t), ["account_id"])),
    _check("LOAN_PAYMENT_ARITHMETIC", "raw", RowRule("raw_loan", _payments_differ)),
    _check("LOAN_BEFORE_ACCOUNT_OPEN", "stg", _before_opening(lambda t: t["stg_loan"], "loan_date")),
    _check("CARD_BEFORE_ACCOUNT_OPEN", "stg", _before_opening(_cards_with_account, "issued_date")),
    _check("TXN_BEFORE_ACCOUNT_OPEN", "stg", _before_opening(lambda t: t["stg_trans"], "txn_date")),
    # Stricter than a lenient date function: a 31st of February counts.
    _check("CLIENT_INVALID_BIRTH_DATE", "stg", RowRule("stg_client", lambda: F.col("birth_date").isNull())),
    _check("LOAN_MULTIPLE_PER_ACCOUNT", "raw", lambda t: repeated_groups(t["raw_loan"], ["account_id"])),
    # Reconciliation.
    _check(
        "RECON_RAW_VS_STG_TRANS", "recon", lambda t: row_count_gap(t["raw_trans"], t["stg_trans"], t["rej_trans"])
    ),
    # Despite its name this looks at the account profile, not at the month table.
    _check(
        "RECON_ACCOUNT_MONTH_SPINE",
        "mart",
        lambda t: without_match(t["stg_account"], "account_id", t["mart_account_360"], "account_id"),
    ),
]

# The three checks the stored-procedure variant of the reports runs.
SHORT_CHECKS = [
    check
    for check in BANK_CHECKS
    if check.name in ("TXN_LEGACY_TYPE_CODE", "FK_LOAN_ACCOUNT", "NEGATIVE_BALANCE_TXNS")
]


def bank_check_log(t: Tables, run_ts: dt.datetime | None = None, more: Sequence[Check] = ()) -> DataFrame:
    return run_checks(t, [*BANK_CHECKS, *more], run_ts)


def expected_row_checks(expected: Mapping[str, int]) -> list[Check]:
    """A check per raw table whose number of rows is known beforehand; it counts the rows too many or too few."""

    def gap(table: str, rows: int):
        return lambda t: t[f"raw_{table}"].agg(F.abs(F.count(F.lit(1)) - F.lit(rows)).alias("failed_rows"))

    return [
        Check(f"ROWS_{table.upper()}", "raw", "FAIL", f"{table} must hold {rows} rows", gap(table, rows))
        for table, rows in expected.items()
    ]


def raw_row_counts(t: Tables) -> DataFrame:
    """Rows loaded per raw table."""
    names = [name for name in t if name.startswith("raw_")]
    return reduce(
        DataFrame.unionAll,
        [t[name].agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")) for name in names],
    )


def unparsed_dates(t: Tables) -> DataFrame:
    """Per date column the raw values that are present but no date, and so leave the date checks."""
    # Rejected rows are raw rows that are not staged.
    pairs = [
        ("raw_account", "date", "stg_account", "open_date", None),
        ("raw_loan", "date", "stg_loan", "loan_date", None),
        ("raw_card", "issued", "stg_card", "issued_date", None),
        ("raw_trans", "date", "stg_trans", "txn_date", "rej_trans"),
    ]
    log = None
    for raw, raw_column, staged, column, rejected in pairs:
        counts = t[raw].agg(F.count(raw_column).alias("present"))
        counts = counts.unionAll(t[staged].agg((-F.count(column)).alias("present")))
        if rejected:
            counts = counts.unionAll(t[rejected].agg((-F.count(raw_column)).alias("present")))
        part = counts.agg(
            F.lit(f"{staged}.{column}").alias("column_name"), F.sum("present").alias("unparsed_rows")
        )
        log = part if log is None else log.unionAll(part)
    return log


def postings_by_spine(t: Tables, first: str, last: str) -> DataFrame:
    """How many staged postings the month table counts, and how many it leaves out for which reason.

    Rows (place, postings), also for places without postings; they add up to all staged postings.
    Postings are counted by account and month first, so the join moves aggregated rows only.
    """
    months = t["stg_trans"].groupBy("account_id", F.trunc("txn_date", "month").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    opened = t["stg_account"].select(F.col("account_id").alias("_account"), F.trunc("open_date", "month").alias("_opened"), F.lit(True).alias("_known"))
    joined = months.join(opened, F.col("account_id") == F.col("_account"), "left")
    month, start, end = F.col("month"), F.lit(first).cast("date"), F.lit(last).cast("date")
    place = (
        F.when(F.col("_known").isNull(), "unknown account")
        .when(F.col("_opened").isNull(), "account without opening date")
        .when(month.isNull(), "undated")
        .when(month < start, "before the first month")
        .when(month > end, "after the last month")
        .when(month < F.col("_opened"), "before opening")
        .otherwise("in the month table")
    )
    counted = joined.groupBy(place.alias("place")).agg(F.sum("n").alias("n"))
    places = F.array(*[F.lit(name) for name in SPINE_PLACES])
    every = t["stg_account"].sparkSession.range(1).select(F.explode(places).alias("place"))
    return every.join(counted, "place", "left").select("place", F.coalesce("n", F.lit(0)).cast("long").alias("postings"))


SPINE_PLACES = (
    "in the month table",
    "unknown account",
    "account without opening date",
    "undated",
    "before the first month",
    "after the last month",
    "before opening",
)
