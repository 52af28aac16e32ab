"""The whole job over files with known defects, against plain Python."""

import csv
import datetime as dt
import threading
from collections import defaultdict

import pytest
from tests.pack import make_pack, write_pack

from ledgerloom.operators.checks import QualityGateError, gate
from ledgerloom.plans import marts
from ledgerloom.plans.bank import Bank
from ledgerloom.plans.fixed_values import CHECK_TEXTS
from ledgerloom.plans.job import run_job
from ledgerloom.plans.views import VIEWS, register_views
from ledgerloom.sources.delimited import locate_input, read_raw_tables

RUN = dt.datetime(2024, 5, 6, 7, 8, 9)


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    rows, expected = make_pack()
    folder = tmp_path_factory.mktemp("pack")
    write_pack(folder, rows)
    output = tmp_path_factory.mktemp("out")
    raw = read_raw_tables(spark, locate_input(spark, None, [str(folder / "none"), str(folder)]))
    return run_job(raw, str(output), RUN), rows, expected, output


def test_every_check_counts_what_was_put_in(job):
    bank, _, expected, _ = job
    log = {row.check_name: row for row in bank.check_log().collect()}
    assert list(CHECK_TEXTS) and set(log) == set(CHECK_TEXTS)
    assert {name: log[name].failed_rows for name in expected} == expected
    for row in log.values():
        assert row.run_ts == RUN
        assert row.status == ("PASS" if row.failed_rows == 0 else row.severity)
        assert row.description == CHECK_TEXTS[row.check_name]


def test_gate_raises_on_failed_checks_only(job):
    log = job[0].check_log()
    with pytest.raises(QualityGateError, match="TXN_DUPLICATE_POSTING"):
        gate(log)
    gate(log.filter("status <> 'FAIL'"))


def kept_transactions(rows):
    seen, kept, rejected = set(), [], []
    for row in sorted(rows["trans"], key=lambda r: r[0]):
        key = (row[1], row[2], row[3], row[4], row[6], row[7], row[5])
        (rejected if key in seen else kept).append(row)
        seen.add(key)
    return kept, rejected


def test_staged_and_rejected_transactions(job):
    bank, rows, _, _ = job
    kept, rejected = kept_transactions(rows)
    staged = {row.trans_id: row for row in bank["stg_trans"].collect()}
    assert set(staged) == {row[0] for row in kept}
    for row in kept:
        mine = staged[row[0]]
        assert mine.txn_date.strftime("%y%m%d") == f"{row[2]:06d}"
        assert mine.txn_type == ("VYDAJ" if row[3] == "VYBER" else row[3])
        assert mine.operation == (row[4] or "NOT_APPLICABLE")
        assert mine.k_symbol == (row[5].strip() or "NONE")
        assert float(mine.signed_amount) == (1 if row[3] == "PRIJEM" else -1) * float(row[6])
    assert {row.trans_id for row in bank["rej_trans"].collect()} == {row[0] for row in rejected}
    assert {row.reject_reason for row in bank["rej_trans"].collect()} == {"DUPLICATE_POSTING"}


def months_of(account_date):
    start = max(dt.datetime.strptime(f"{account_date:06d}", "%y%m%d").strftime("%Y-%m"), "1993-01")
    return [m for m in (f"{y}-{n:02d}" for y in range(1993, 1999) for n in range(1, 13)) if m >= start]


def test_account_month_equals_a_plain_running_sum(job):
    bank, rows, _, _ = job
    flows = defaultdict(lambda: defaultdict(list))
    for row in kept_transactions(rows)[0]:
        month = f"19{row[2]:06d}"[:4] + "-" + f"{row[2]:06d}"[2:4]
        cents = round(float(row[6]) * 100) * (1 if row[3] == "PRIJEM" else -1)
        flows[row[1]][month].append(cents)
    expected = {}
    for account in rows["account"]:
        total = 0
        for month in months_of(account[3]):
            moved = flows[account[0]][month]
            total += sum(moved)
            expected[account[0], month] = (
                sum(c for c in moved if c > 0), -sum(c for c in moved if c < 0), sum(moved), len(moved), total)
    mine = {
        (r.account_id, r.month): (
            int(r.credits * 100), int(r.debits * 100), int(r.net_flow * 100), r.txn_count, int(r.est_balance * 100))
        for r in bank["mart_account_month"].collect()
    }
    assert mine == expected


def test_profile_rows_and_tiers(job):
    bank, rows, _, _ = job
    profile = bank["mart_account_360"].collect()
    owners = [row for row in rows["disp"] if row[3] == "OWNER"]
    assert len(profile) >= len(owners)
    assert sorted({r.account_id for r in profile}) == sorted({row[2] for row in owners})
    assert len([r for r in profile if r.account_id == 11]) == 2
    place = sorted(
        profile,
        key=lambda r: (r.avg_balance_1998 is None, -(r.avg_balance_1998 or 0), r.account_id, r.owner_client_id,
                       r.loan_id is None, r.loan_id or 0))
    n = len(place)
    sizes = [n // 4 + (1 if q < n % 4 else 0) for q in range(4)]
    labels = [label for q, label in enumerate(["Premium", "Standard", "Standard", "Basic"]) for _ in range(sizes[q])]
    assert [r.tier for r in place] == labels


def test_views_agree_with_the_profile(job, spark):
    bank, rows, _, _ = job
    assert sorted(register_views(spark, bank)) == sorted(VIEWS)
    profile = bank["mart_account_360"].collect()
    tiers = {r.tier: r for r in spark.sql("select * from vw_tier_summary").collect()}
    for tier, row in tiers.items():
        of_tier = [r for r in profile if r.tier == tier]
        assert row.accounts == len(of_tier)
        assert row.loans == sum(r.loan_id is not None for r in of_tier)
    cards = spark.sql("select sum(accounts) n from vw_card_summary").head().n
    assert cards == len(profile)
    scorecard = {r.district_id: r for r in spark.sql("select * from vw_district_scorecard").collect()}
    assert set(scorecard) == {row[0] for row in rows["district"]}
    assert sum(r.accounts for r in scorecard.values()) == len(profile)
    bad = spark.sql("select * from vw_loan_watchlist").collect()
    assert {r.status for r in bad} == {"B", "D"}
    for r in bad:
        balance, payment = r.balance_dec98, r.monthly_payment
        cover = "Overdrawn" if balance < 0 else "Low cover" if balance < 3 * payment else "OK"
        assert r.balance_cover == cover
    orders = {r.purpose: r.orders for r in spark.sql("select * from vw_standing_orders").collect()}
    assert sum(orders.values()) == len(rows["order"])
    assert set(orders) == {"Household", "Loan payment", "Unspecified", "Leasing"}


def read_csv(folder):
    rows = []
    for part in sorted(folder.glob("part-*.csv")):
        with open(part, newline="") as lines:
            rows += list(csv.DictReader(lines))
    return rows


def test_written_reports(job):
    _, _, expected, output = job
    assert {p.name for p in (output / "exports").iterdir()} == {*VIEWS, "dq_log", "mart_account_360", "stg_district"}
    log = read_csv(output / "exports" / "dq_log")
    assert {row["check_name"]: int(row["failed_rows"]) for row in log if row["check_name"] in expected} == expected
    pack = output / "report" / "run_date=2024-05-06"
    assert {p.name for p in pack.iterdir()} == {"kpis", "tier_summary", "loans_by_region", "loan_watchlist", "dq_status"}
    kpis = {row["kpi"]: row["display"] for row in read_csv(pack / "kpis")}
    assert kpis["Data as of"] == "1998-12"
    assert int(kpis["DQ checks failed"]) == sum(row["status"] == "FAIL" for row in log)
    passed = read_csv(output / "evidence" / "passed")[0]["passed_checks"].split(", ")
    assert passed == [name for name in CHECK_TEXTS if name in {r["check_name"] for r in log if r["status"] == "PASS"}]
    amounts = [float(row["amount"]) for row in read_csv(pack / "loan_watchlist")]
    assert amounts == sorted(amounts, reverse=True)
    stats = read_csv(output / "evidence" / "balance_recon_account")[0]
    assert int(stats["accounts_failing"]) == 2
    assert float(stats["max_abs_diff"]) == 250.0
    assert float(stats["median_abs_diff"]) == pytest.approx((250 + 1.01) / 2)


def test_a_second_run_gives_the_same_tables_and_a_longer_history(job, spark):
    bank, rows, _, output = job
    before = sorted(map(tuple, bank["mart_account_360"].collect()), key=str)
    raw = {name: bank[f"raw_{name}"] for name in ("account", "client", "disp", "card", "loan", "order", "district", "trans")}
    copies = {name: spark.createDataFrame(df.collect(), df.schema) for name, df in raw.items()}
    expected_rows = {"loan": len(rows["loan"]), "card": len(rows["card"]) + 2}
    again = run_job(copies, str(output), RUN + dt.timedelta(days=1), expected_rows=expected_rows)
    log = {row.check_name: (row.failed_rows, row.status) for row in again.check_log().collect()}
    assert (log["ROWS_LOAN"], log["ROWS_CARD"]) == ((0, "PASS"), (2, "FAIL"))
    assert sorted(map(tuple, again["mart_account_360"].collect()), key=str) == before
    history = spark.read.parquet(str(output / "dq_history"))
    assert history.count() == len(CHECK_TEXTS) * 2 + 2
    assert history.select("run_date").distinct().count() == 2


def test_the_parts_of_the_profile_are_built_side_by_side(spark, monkeypatch):
    """Each part waits until another has begun; jobs of all keep the caller's local properties."""
    begun, groups, built = threading.Barrier(2, timeout=60), [], []

    class Parts(Bank):
        def __getitem__(self, name):
            if threading.current_thread() is not threading.main_thread():
                groups.append(spark.sparkContext.getLocalProperty("spark.jobGroup.id"))
                if name in ("stg_loan", "mart_account_month"):
                    begun.wait()
            built.append(name)
            return name

    monkeypatch.setattr(marts, "account_base", lambda *tables: tables)
    monkeypatch.setattr(marts, "with_tier", lambda base: base)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", "profile")
    try:
        parts = Parts({}, "nowhere")._build("mart_account_360")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert parts[0] == "stg_account" and parts[-1] == "mart_account_month" and len(parts) == 7
    assert set(groups) == {"profile"} and len(groups) == 7 and len(built) == 14
