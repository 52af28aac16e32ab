"""The partitioned month table, months added to it, and the table of kept and rejected postings."""

import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.matching import dated_before
from ledgerloom.plans import marts, staging
from ledgerloom.sources.tables import read_table, replace_partitions, write_table

FIRST, LAST = "1996-11-01", "1998-12-01"


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def ledger(spark):
    """Accounts opened before, within and after the calendar, or never; postings also before opening and of no account."""
    rng = random.Random(6)
    day = lambda: dt.date(1996, 6, 1) + dt.timedelta(days=rng.randrange(1000))
    accounts = [(i, rng.choice([None, dt.date(1990, 1, 1), day(), day(), day(), dt.date(1999, 5, 1)])) for i in range(60)]
    trans = [(rng.randrange(65), rng.choice([None, day(), day(), day()]), rng.randrange(-50_000, 50_000)) for _ in range(4000)]
    trans += [(1, dt.date(1998, 12, 31), 100)] * 1500  # a hot account and day
    accounts = spark.createDataFrame(accounts, "account_id int, open_date date")
    trans = spark.createDataFrame(trans, "account_id int, txn_date date, cents long")
    signed = (F.col("cents") / 100).cast("decimal(12,2)").alias("signed_amount")
    return accounts, trans.select("account_id", "txn_date", signed)


def rows_of(months):
    return sorted(map(tuple, months.drop(*marts.MONTH_PARTITIONS).collect()))


@pytest.mark.parametrize("cuts", [["1997-01-01"], ["1997-01-01", "1997-02-01", "1998-07-01", "1998-12-01"], ["1996-12-01"]])
def test_added_months_equal_a_full_build(spark, ledger, tmp_path, cuts):
    accounts, trans = ledger
    full = marts.build_account_month(accounts, trans, FIRST, LAST)
    path = str(tmp_path / "months")
    before = [str(dt.date.fromisoformat(cut) - dt.timedelta(days=1)) for cut in cuts]
    write_table(marts.build_account_month(accounts, trans, FIRST, before[0]), path, marts.MONTH_PARTITIONS)
    for start, end in zip(cuts, [*before[1:], LAST], strict=True):
        table = marts.append_months(spark, path, accounts, trans, start, end)
    assert rows_of(table) == rows_of(full) and rows_of(full)
    assert table.schema["est_balance"].dataType == full.schema["est_balance"].dataType
    again = marts.append_months(spark, path, accounts, trans, cuts[-1], LAST)  # a repeated run
    assert rows_of(again) == rows_of(full) == rows_of(read_table(spark, path))


def test_added_months_read_new_postings_and_one_closing_month_alone(spark, ledger, tmp_path):
    accounts, trans = ledger
    path = str(tmp_path / "months")
    write_table(marts.build_account_month(accounts, trans, FIRST, "1997-12-01"), path, marts.MONTH_PARTITIONS)
    expected = rows_of(marts.build_account_month(accounts, trans, FIRST, LAST))
    # Without any posting of the closed months the result is the same.
    since = trans.where(F.col("txn_date") >= F.lit("1998-01-01").cast("date"))
    assert rows_of(marts.append_months(spark, path, accounts, since, "1998-01-01", LAST)) == expected


def test_an_account_without_new_postings_keeps_its_balance(spark, ledger, tmp_path):
    accounts, trans = ledger
    path = str(tmp_path / "months")
    closed = write_table(marts.build_account_month(accounts, trans, FIRST, "1998-11-01"), path, marts.MONTH_PARTITIONS)
    last = {r.account_id: r.est_balance for r in closed.where("month = '1998-11'").collect()}
    table = marts.append_months(spark, path, accounts, trans.limit(0), "1998-12-01", LAST)
    new = {r.account_id: (r.est_balance, r.txn_count) for r in table.where("month = '1998-12'").collect()}
    assert last and all(new[account] == (balance, 0) for account, balance in last.items())


def test_report_year_reads_its_own_folder(spark, ledger, tmp_path):
    accounts, trans = ledger
    table = write_table(marts.build_account_month(accounts, trans, FIRST, LAST), str(tmp_path / "months"), marts.MONTH_PARTITIONS)
    plan = plan_of(marts.report_year_balances(table))
    assert "PartitionFilters: [isnotnull(year" in plan and "year#" in plan
    files = table.where(F.col("year") >= 1998).select(F.input_file_name().alias("name")).distinct().collect()
    assert files and all("year=1998" in r.name for r in files)


def test_months_are_not_added_to_a_table_that_was_never_written(spark, ledger, tmp_path):
    with pytest.raises(FileNotFoundError):
        replace_partitions(marts.build_account_month(*ledger, FIRST, LAST), str(tmp_path / "none"), marts.MONTH_PARTITIONS)


def test_kept_and_rejected_are_parts_of_one_table(spark, tmp_path):
    names = ["trans_id", "account_id", "date", "type", "operation", "amount", "balance", "k_symbol", "bank", "account"]
    rows = [(i, i % 7, 930101, "PRIJEM", None, 5.0, 9.0, " ", "AB", 3) for i in range(40)]
    raw = spark.createDataFrame(rows, "trans_id int, account_id int, date int, type string, operation string, amount double, balance double, k_symbol string, bank string, account int")
    assert raw.columns == names
    raw = raw.withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("amount", "balance")})
    split = staging.split_trans(raw)
    table = write_table(staging.tagged_trans(split), str(tmp_path / "trans"), ["is_kept"])
    kept, rejected = (staging.kept_or_rejected(table, name) for name in ("stg_trans", "rej_trans"))
    assert kept.columns == staging.stage_trans(split.kept).columns
    assert rejected.columns == staging.reject_trans(split.rejected).columns
    assert sorted(r.trans_id for r in kept.collect()) == list(range(7))
    assert sorted(r.trans_id for r in rejected.collect()) == list(range(7, 40))
    assert kept.where("operation IS NULL OR txn_date IS NULL").count() == 0
    assert "PartitionFilters: [isnotnull(is_kept" in plan_of(kept)


def test_days_are_counted_before_they_meet_their_parents(spark):
    child = spark.createDataFrame(
        [(1, "2020-01-01")] * 300 + [(1, "2020-01-05"), (2, "2019-01-01"), (3, None), (None, "2000-01-01"), (9, "1999-01-01")], "fk int, d string"
    )
    parent = spark.createDataFrame([(1, "2020-01-03"), (2, "2019-01-01"), (3, "2020-01-01"), (2, "2019-06-01"), (4, None)], "pk int, o string")
    early = dated_before(child, "fk", "d", parent, "pk", "o")
    assert early.head()[0] == 301  # the parent 2 has two rows, one of them later
    plan = plan_of(early)  # operators are described from the scan up
    assert plan.index("partial_count") < plan.rindex("Join condition")
