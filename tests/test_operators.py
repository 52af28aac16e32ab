import contextlib
import datetime as dt
import io
import math
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.balances import account_month, balance_gaps, month_spine
from ledgerloom.operators.categories import best_category
from ledgerloom.operators.checks import Check, RowRule, run_checks
from ledgerloom.operators.correlation import rank_correlation
from ledgerloom.operators import dedupe
from ledgerloom.operators.dedupe import split_duplicates
from ledgerloom.operators.growth import month_over_month
from ledgerloom.operators.matching import dated_before, orphans, repeated_groups, row_count_gap, without_match
from ledgerloom.operators.ordering import exact_medians, global_positions, with_ntile


def first_rows(rows, keys, order):
    """Plain keep-first: NULLs first, ties by the remaining columns."""

    def rank(value):
        return (value is not None, value if value is not None else 0)

    groups = defaultdict(list)
    for row in rows:
        groups[tuple(row[k] for k in keys)].append(row)
    rest = [i for i in range(len(rows[0])) if i not in keys and i not in order]
    kept, rejected = [], []
    for group in groups.values():
        group.sort(key=lambda r: [rank(r[i]) for i in [*order, *rest]])
        kept.append(group[0])
        rejected += group[1:]
    return Counter(kept), Counter(rejected)


@pytest.mark.parametrize("order", [["id"], ["id", "day"]])
def test_split_duplicates_against_plain_python(spark, order):
    rng = random.Random(3)
    rows = [
        (
            rng.choice([None, "a", "b", "hot"]),
            rng.choice([None, 1, 2, 3]),
            rng.choice([None, *range(400)]),
            rng.randint(1, 3),
            rng.choice("xy"),
        )
        for _ in range(1500)
    ]
    rows += [("hot", 1, 5, 1, "x")] * 700  # a third of all rows is one and the same row
    rows += [("single", 9, 1, 1, "z")]
    df = spark.createDataFrame(rows, "k1 string, k2 int, id int, day int, extra string").repartition(6)
    split = split_duplicates(df, ["k1", "k2"], order)
    kept, rejected = first_rows(rows, [0, 1], [2] if order == ["id"] else [2, 3])
    assert Counter(map(tuple, split.kept.collect())) == kept
    assert Counter(map(tuple, split.rejected.collect())) == rejected
    assert row_count_gap(df, split.kept, split.rejected).head()[0] == 0


def test_split_duplicates_repeats_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "_EXPAND_BLOCK", 7)
    rows = [(1, 1)] * 50 + [(2, 2)] * 7 + [(3, 3)] * 8 + [(4, 4)]
    split = split_duplicates(spark.createDataFrame(rows, "k int, id int"), ["k"], ["id"])
    assert Counter(r.k for r in split.rejected.collect()) == {1: 49, 2: 6, 3: 7}
    assert sorted(r.k for r in split.kept.collect()) == [1, 2, 3, 4]


def test_split_duplicates_of_nothing(spark):
    split = split_duplicates(spark.createDataFrame([], "k int, id int"), ["k"], ["id"])
    assert split.kept.count() == split.rejected.count() == 0


def test_split_duplicates_joins_the_rows_once(spark, tmp_path):
    rows = [(None, "a", 1), ("a", None, 2), ("a", None, 3), ("b", "b", 4)]  # the first two keys have one hash
    df = spark.createDataFrame(rows, "k1 string, k2 string, id int")
    df.write.parquet(str(tmp_path / "rows"))
    split = split_duplicates(spark.read.parquet(str(tmp_path / "rows")), ["k1", "k2"], ["id"])
    assert sorted(r.id for r in split.kept.collect()) == [1, 2, 4]
    assert [r.id for r in split.rejected.collect()] == [3]
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        split.kept.explain()
        split.rejected.explain()
    assert "Join" not in out.getvalue() and str(tmp_path) not in out.getvalue()


ACCOUNTS = [(1, "1993-02-10"), (2, "1990-01-01"), (3, "1999-01-01"), (4, None), (5, "1993-04-30"), (6, "1993-01-01")]


def accounts(spark):
    return spark.createDataFrame(ACCOUNTS, "account_id int, d string").select("account_id", F.col("d").cast("date").alias("open_date"))


def test_month_spine(spark):
    spine = month_spine(accounts(spark), "account_id", "open_date", "1993-01-01", "1993-04-01")
    got = defaultdict(list)
    for row in sorted(spine.collect()):
        got[row.account_id].append(row.month)
    every = ["1993-01", "1993-02", "1993-03", "1993-04"]
    assert got == {1: every[1:], 2: every, 5: every[3:], 6: every}


def test_account_month_edges(spark):
    postings = spark.createDataFrame(
        [
            (1, "1993-01-31", "5.00"),  # before the month of opening
            (1, "1993-02-01", "7.00"),  # in it, though before the day
            (1, "1993-04-02", "-9.50"),
            (1, "1993-05-01", "1.00"),  # after the end
            (2, "1992-12-31", "3.00"),  # before the start
            (2, "1993-03-05", "0.00"),
            (3, "1993-03-05", "1.00"),  # account opened after the end
            (4, "1993-03-05", "1.00"),  # account without a date
            (9, "1993-03-05", "1.00"),  # no such account
            (2, None, "1.00"),
        ],
        "account_id int, d string, v string",
    ).select("account_id", F.col("d").cast("date").alias("txn_date"), F.col("v").cast("decimal(12,2)").alias("signed_amount"))
    got = account_month(accounts(spark), postings, first="1993-01-01", last="1993-04-01").filter("account_id < 5").collect()
    got = [(r.account_id, r.month, *[float(x) for x in r[2:]]) for r in sorted(got)]
    assert got == [
        (1, "1993-02", 7.0, 0.0, 7.0, 1, 7.0),
        (1, "1993-03", 0.0, 0.0, 0.0, 0, 7.0),
        (1, "1993-04", 0.0, 9.5, -9.5, 1, -2.5),
        (2, "1993-01", 0.0, 0.0, 0.0, 0, 0.0),
        (2, "1993-02", 0.0, 0.0, 0.0, 0, 0.0),
        (2, "1993-03", 0.0, 0.0, 0.0, 1, 0.0),
        (2, "1993-04", 0.0, 0.0, 0.0, 0, 0.0),
    ]


def test_account_month_shuffles_twice_and_joins_nothing(spark):
    postings = spark.createDataFrame([(1, dt.date(1993, 3, 1), Decimal("1.00"))], "account_id int, txn_date date, signed_amount decimal(12,2)")
    df = account_month(accounts(spark), postings, first="1993-01-01", last="1993-04-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan and "SinglePartition" not in plan


def test_balance_gaps(spark):
    rows = [
        (1, "1998-01-01", "10.00", "10.00"), (1, "1998-01-02", "5.00", "99.00"), (1, "1998-01-02", "5.00", "20.50"),
        (2, "1998-01-01", "1.00", "2.00"), (3, "1998-01-01", "1.00", "2.01"),
    ]
    df = spark.createDataFrame(rows, "account_id int, d string, s string, b string").select(
        "account_id", F.col("d").cast("date").alias("txn_date"), F.col("s").cast("decimal(12,2)").alias("signed_amount"),
        F.col("b").cast("decimal(12,2)").alias("balance_reported"))
    got = {r.account_id: (r.n_rows_last_day, float(r.diff), r.n_txn) for r in balance_gaps(df).collect()}
    assert got == {1: (2, 0.5, 3), 2: (1, 1.0, 1), 3: (1, 1.01, 1)}


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 1003])
def test_ntile(spark, n):
    rng = random.Random(n)
    rows = [(i, rng.choice([None, 1.0, 1.0, 1.0, rng.random()])) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, v double").repartition(5)
    got = {r.id: r.tile for r in with_ntile(df, 4, [F.desc_nulls_last("v"), F.asc("id")]).collect()}
    ranked = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    sizes = [n // 4 + (1 if q < n % 4 else 0) for q in range(4)]
    tiles = [q + 1 for q in range(4) for _ in range(sizes[q])]
    assert got == {row[0]: tile for row, tile in zip(ranked, tiles, strict=True)}


def test_positions_are_dense(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("v"))
    got = sorted((r.v, r.position, r.total) for r in global_positions(df, [F.asc("v")]).collect())
    assert got == [(i, i, 5000) for i in range(5000)]


def test_medians(spark):
    rows = [(1.0, 3), (5.0, None), (5.0, 9), (2.0, 4), (5.0, 4)] + [(5.0, 4)] * 6
    df = spark.createDataFrame(rows, "a double, b int")
    got = {r.metric: (r.row_count, r.median) for r in exact_medians(df, ["a", "b"]).collect()}
    assert got == {"a": (11, 5.0), "b": (10, 4.0)}
    pair = spark.createDataFrame([(1.0,), (4.0,)], "a double")
    assert exact_medians(pair, ["a"]).head().median == 2.5
    assert exact_medians(pair.filter("a > 9"), ["a"]).count() == 0


def test_best_category(spark):
    df = spark.createDataFrame(
        [(1, "junior"), (1, "gold"), (2, "classic"), (2, "junior"), (3, "other"), (4, None)], "k int, c string")
    got = dict(df.groupBy("k").agg(best_category(F.col("c"), {"gold": 3, "classic": 2, "junior": 1})).collect())
    assert got == {1: "gold", 2: "classic", 3: "junior", 4: "junior"}


def test_matching(spark):
    child = spark.createDataFrame([(1, "1998-01-01"), (1, "1999-01-01"), (2, "1998-01-01"), (None, "1998-01-01")], "fk int, d string")
    parent = spark.createDataFrame([(1, "1998-06-01"), (3, None)], "pk int, o string")
    assert orphans(child, "fk", parent, "pk").head()[0] == 2
    assert orphans(child.filter("fk = 1"), "fk", parent, "pk").head()[0] == 0
    assert without_match(parent, "pk", child, "fk").head()[0] == 1
    assert repeated_groups(child, ["fk"]).head()[0] == 1
    assert dated_before(child, "fk", "d", parent, "pk", "o").head()[0] == 1
    assert row_count_gap(child, parent, parent.limit(1)).head()[0] == 1
    assert row_count_gap(child.filter("fk > 9"), parent.filter("pk > 9")).head()[0] == 0


def test_checks_on_one_table_share_a_scan(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    checks = [
        Check("A", "raw", "FAIL", "a", RowRule("t", lambda: F.col("v") > 1)),
        Check("B", "raw", "WARN", "b", RowRule("t", lambda: F.col("v") > 0)),
        Check("C", "stg", "FAIL", "c", RowRule("t", lambda: F.col("v") > 5)),
        Check("D", "stg", "FAIL", "d", lambda t: repeated_groups(t["t"], ["v"])),
    ]
    log = run_checks({"t": df}, checks, dt.datetime(2024, 1, 1))
    assert {r.check_name: (r.failed_rows, r.status) for r in log.collect()} == {
        "A": (1, "FAIL"), "B": (2, "WARN"), "C": (0, "PASS"), "D": (0, "PASS")}
    assert log.columns == ["run_ts", "check_name", "layer", "severity", "failed_rows", "status", "description"]
    assert log._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2


def test_growth_needs_the_month_before(spark):
    df = spark.createDataFrame([("1997-12", 10.0), ("1998-01", 15.0), ("1998-03", 30.0), ("1998-04", 0.0), ("1998-05", 1.0)], "month string, v double")
    got = {r.month: (r.previous, r.mom_change) for r in month_over_month(df, "v").collect()}
    assert got == {"1997-12": (None, None), "1998-01": (10.0, 0.5), "1998-03": (None, None), "1998-04": (30.0, -1.0), "1998-05": (0.0, None)}


def average_ranks(values):
    return [sum(v < x for v in values) + (sum(v == x for v in values) + 1) / 2 for x in values]


def student_two_sided(t, df):
    """Simpson's rule over the density in the angle."""
    def area(upper, steps=4000):
        h = upper / steps
        return h / 3 * sum((1 if i in (0, steps) else 4 if i % 2 else 2) * math.cos(i * h) ** (df - 1) for i in range(steps + 1))
    return 1 - area(math.atan(abs(t) / math.sqrt(df))) / area(math.pi / 2)


@pytest.mark.parametrize("n", [3, 4, 5, 8, 41, 65])
def test_rank_correlation(spark, n):
    rng = random.Random(n)
    rows = [(float(rng.randint(1, 9)), rng.choice([None, rng.random()]) if i > 4 else float(i), 1.0, rng.randint(1, 12) / 3) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    got = {r.metric: r for r in rank_correlation(df, ["a", "b", "c"], "y").collect()}
    assert got["c"].rho is None and got["c"].p_value is None and got["c"].pairs == n
    for i, metric in enumerate("ab"):
        pairs = [(r[i], r[3]) for r in rows if r[i] is not None]
        x, y = (average_ranks([p[k] for p in pairs]) for k in (0, 1))
        mx, my = sum(x) / len(x), sum(y) / len(y)
        cov = sum((p - mx) * (q - my) for p, q in zip(x, y, strict=True))
        rho = cov / math.sqrt(sum((p - mx) ** 2 for p in x) * sum((q - my) ** 2 for q in y))
        assert got[metric].pairs == len(pairs)
        assert got[metric].rho == pytest.approx(rho, abs=1e-9)
        if abs(rho) < 1 - 1e-12 and len(pairs) > 2:
            t = rho * math.sqrt((len(pairs) - 2) / (1 - rho * rho))
            assert got[metric].p_value == pytest.approx(student_two_sided(t, len(pairs) - 2), abs=1e-6)


def test_published_p_values(spark):
    """rho and p as published for 65 districts."""
    from ledgerloom.operators.correlation import student_t_two_sided

    rows = [(0.0601, 0.6345), (-0.0548, 0.6646), (-0.0527, 0.677)]
    df = spark.createDataFrame(rows, "rho double, p double")
    t = F.col("rho") * F.sqrt(F.lit(63.0) / (1 - F.col("rho") * F.col("rho")))
    for row in df.select("p", student_t_two_sided(t, F.lit(63.0)).alias("mine")).collect():
        assert row.mine == pytest.approx(row.p, abs=1e-3)


def test_rank_correlation_counts_ties_before_ranking(spark):
    """A value that nearly all rows hold, and only one degree of freedom."""
    tied = spark.range(20_000).selectExpr("CAST(IF(id < 19990, 0, id % 7) AS DOUBLE) AS x", "CAST(id % 11 AS DOUBLE) AS y")
    rows = [(r.x, r.y) for r in tied.collect()]
    got = rank_correlation(tied, ["x"], "y").head()
    at = {k: {} for k in (0, 1)}
    for k in (0, 1):
        values = sorted(r[k] for r in rows)
        for v in set(values):
            low, n = values.index(v), values.count(v)
            at[k][v] = low + (n + 1) / 2
    mean = (len(rows) + 1) / 2
    a, b = ([at[k][r[k]] - mean for r in rows] for k in (0, 1))
    rho = sum(p * q for p, q in zip(a, b, strict=True)) / math.sqrt(sum(p * p for p in a) * sum(q * q for q in b))
    assert (got.pairs, got.rho) == (20_000, pytest.approx(rho, abs=1e-12))
    three = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 3.0)], "x double, y double")
    assert rank_correlation(three, ["x"], "y").head().p_value == pytest.approx(2 / 3, abs=1e-6)


def test_a_count_asked_for_by_the_user_comes_after_the_checks(spark):
    from ledgerloom.operators.checks import check_number
    from ledgerloom.plans.quality import BANK_CHECKS

    log = spark.createDataFrame([("ROWS_CARD",), (BANK_CHECKS[-1].name,), (BANK_CHECKS[0].name,)], "name string")
    names = [r.name for r in log.orderBy(check_number(BANK_CHECKS, F.col("name"))).collect()]
    assert names == [BANK_CHECKS[0].name, BANK_CHECKS[-1].name, "ROWS_CARD"]
