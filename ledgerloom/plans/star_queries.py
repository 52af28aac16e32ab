"""The operators on the star schema's own tables, lineitem included."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.codes import blank_to, decode_codes, flag, merge_code, signed
from ledgerloom.functions.dates import month_start, month_text
from ledgerloom.functions.measures import percent, sum_where
from ledgerloom.operators.balances import account_month, balance_gaps, month_spine, period_flows
from ledgerloom.operators.categories import best_category
from ledgerloom.operators.checks import Check, RowRule, run_checks
from ledgerloom.operators.correlation import rank_correlation
from ledgerloom.operators.dedupe import Split, split_duplicates
from ledgerloom.operators.growth import month_over_month
from ledgerloom.operators.matching import dated_before, orphans, repeated_groups, row_count_gap, without_match
from ledgerloom.operators.ordering import exact_medians, with_ntile
from ledgerloom.sources.delimited import read_delimited, write_delimited
from ledgerloom.sources.schemas import RAW_SCHEMAS
from ledgerloom.sources.tables import run_dir

MONEY = "decimal(18,2)"
PRIORITY_RANKS = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2, "5-LOW": 1}


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _postings(spark: SparkSession, folder: str) -> DataFrame:
    amount = F.col("o_totalprice").cast(MONEY)
    return _read(spark, folder, "orders").select(
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderdate").cast("date").alias("txn_date"),
        signed(F.col("o_orderstatus"), amount, "F").alias("signed_amount"),
    )


def _accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with the day of their first order; NULL for a customer without orders."""
    first_day = (
        _read(spark, folder, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("open_date"))
    )
    customer = _read(spark, folder, "customer").select(F.col("c_custkey").alias("account_id"))
    return customer.join(first_day, F.col("account_id") == F.col("o_custkey"), "left").drop("o_custkey")


def _order_months(spark: SparkSession, folder: str) -> tuple[str, str]:
    """First and last month with orders; one aggregated row comes to the driver."""
    day = F.col("o_orderdate").cast("date")
    row = _read(spark, folder, "orders").agg(
        *[F.date_format(F.trunc(edge(day), "month"), "yyyy-MM-dd") for edge in (F.min, F.max)]
    ).head()
    return (row[0], row[1]) if row[0] else ("1970-01-01", "1970-01-01")


def orders_account_month(spark: SparkSession, folder: str) -> DataFrame:
    """Month-end balance of every customer over a complete month spine."""
    first, last = _order_months(spark, folder)
    return account_month(_accounts(spark, folder), _postings(spark, folder), first=first, last=last)


def orders_month_spine(spark: SparkSession, folder: str) -> DataFrame:
    return month_spine(_accounts(spark, folder), "account_id", "open_date", *_order_months(spark, folder))


def orders_period_flows(spark: SparkSession, folder: str) -> DataFrame:
    return period_flows(_postings(spark, folder), "account_id", "txn_date", "signed_amount")


def orders_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Code, sign, blank and calendar functions over all orders."""
    status, priority, day = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate").cast("date")
    gappy = F.when(priority == "4-NOT SPECIFIED", "  ").when(priority != "5-LOW", F.concat(F.lit(" "), priority))
    return _read(spark, folder, "orders").select(
        "o_orderkey",
        merge_code(status, "P", "O").alias("status"),
        decode_codes(status, {"F": "Finished", "O": "Open"}).alias("status_desc"),
        decode_codes(priority, {"1-URGENT": "now", "2-HIGH": "soon"}, "later").alias("urgency"),
        signed(status, F.col("o_totalprice").cast(MONEY), "F").alias("signed_amount"),
        blank_to(gappy, "NONE").alias("symbol"),
        flag(priority.isin("1-URGENT", "2-HIGH")).alias("is_urgent"),
        month_text(day).alias("month"),
        F.year(day).cast("string").alias("year"),
    )


def _split_events(spark: SparkSession, folder: str) -> Split:
    events = _read(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))
    return split_duplicates(events, ["user_id", "event_type", "day"], ["event_id"])


def events_kept(spark: SparkSession, folder: str) -> DataFrame:
    return _split_events(spark, folder).kept


def events_rejected(spark: SparkSession, folder: str) -> DataFrame:
    return _split_events(spark, folder).rejected


def events_conservation(spark: SparkSession, folder: str) -> DataFrame:
    split = _split_events(spark, folder)
    return row_count_gap(_read(spark, folder, "events"), split.kept, split.rejected)


def _split_lines(spark: SparkSession, folder: str) -> Split:
    lines = _read(spark, folder, "lineitem")
    return split_duplicates(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"])


def lines_kept(spark: SparkSession, folder: str) -> DataFrame:
    return _split_lines(spark, folder).kept


def lines_rejected(spark: SparkSession, folder: str) -> DataFrame:
    return _split_lines(spark, folder).rejected


def customer_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    customer = _read(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return with_ntile(customer, 4, [F.desc_nulls_last("c_acctbal"), F.asc("c_custkey")], "quartile")


def part_sevenths(spark: SparkSession, folder: str) -> DataFrame:
    part = _read(spark, folder, "part").select("p_partkey", "p_size")
    return with_ntile(part, 7, [F.asc("p_size"), F.asc("p_partkey")], "seventh")


def customer_best_priority(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _read(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            best_category(F.col("o_orderpriority"), PRIORITY_RANKS).alias("top_priority"),
        )
    )


def lineitem_medians(spark: SparkSession, folder: str) -> DataFrame:
    return exact_medians(_read(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


def orders_balance_gaps(spark: SparkSession, folder: str) -> DataFrame:
    postings = _postings(spark, folder).withColumn("balance_reported", F.abs("signed_amount"))
    return balance_gaps(postings)


def _monthly_orders(spark: SparkSession, folder: str, *by: str) -> DataFrame:
    totals = (
        _read(spark, folder, "orders")
        .groupBy(*by, month_start(F.col("o_orderdate")).alias("_month"))
        .agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("total"))
    )
    return totals.select(*by, month_text(F.col("_month")).alias("month"), "total")


def orders_growth(spark: SparkSession, folder: str) -> DataFrame:
    return month_over_month(_monthly_orders(spark, folder), "total")


def orders_growth_by_status(spark: SparkSession, folder: str) -> DataFrame:
    return month_over_month(_monthly_orders(spark, folder, "o_orderstatus"), "total", by=("o_orderstatus",))


def nation_correlations(spark: SparkSession, folder: str) -> DataFrame:
    """Rank correlation of nation metrics with the share of finished orders."""
    balances = (
        _read(spark, folder, "customer")
        .groupBy("c_nationkey")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum(F.col("c_acctbal").cast(MONEY)).cast("double").alias("balance"),
            F.count_if(F.col("c_acctbal") < 0).alias("in_debt"),
        )
    )
    customer = _read(spark, folder, "customer").select("c_custkey", "c_nationkey")
    per_customer = (
        _read(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.count(F.lit(1)).alias("orders"))
    )
    shares = (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(percent(F.sum("finished"), F.sum("orders"), 1).alias("finished_pct"))
    )
    found = rank_correlation(balances.join(shares, "c_nationkey"), ["customers", "balance", "in_debt"], "finished_pct")
    return found.select("metric", "pairs", F.round("rho", 2).alias("rho"), F.round("p_value", 2).alias("p_value"))


def line_correlations(spark: SparkSession, folder: str) -> DataFrame:
    """Rank correlation of all line items' quantity, discount and tax, which are heavily tied, with their price."""
    lines = _read(spark, folder, "lineitem")
    found = rank_correlation(lines, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return found.select("metric", "pairs", F.round("rho", 6).alias("rho"), F.round("p_value", 2).alias("p_value"))


def portfolio_by_region(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by region and status with the share still pending; orders are summed per customer first."""
    amount = F.col("o_totalprice").cast(MONEY)
    per_customer = (
        _read(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("_orders"),
            F.sum(amount).alias("_amount"),
            sum_where(amount, F.col("o_orderstatus") == "P").alias("_pending"),
        )
    )
    return (
        per_customer.join(_read(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(_read(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_read(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.col("r_name").alias("region"))
        .agg(
            F.sum("_orders").alias("orders"),
            F.sum("_amount").alias("amount"),
            F.sum("_pending").alias("pending_amount"),
            percent(F.sum("_pending"), F.sum("_amount"), None).cast("decimal(5,1)").alias("pending_pct"),
        )
    )


def _order_totals_off(t) -> DataFrame:
    """Orders whose lines add up to something over 1 % away from the order's total."""
    lines = t["lineitem"].groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast(MONEY)).alias("_lines"))
    total = F.col("o_totalprice").cast(MONEY)
    joined = t["orders"].join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.agg(
        F.count_if(F.abs(F.col("_lines") - total) > F.lit("0.01").cast("decimal(3,2)") * total).alias("failed_rows")
    )


STAR_CHECKS = [
    Check("LINE_FULL_DISCOUNT", "raw", "WARN", "lines at the highest discount",
          RowRule("lineitem", lambda: F.col("l_discount") >= 0.1)),
    Check("LINE_NO_QUANTITY", "raw", "FAIL", "lines without a quantity",
          RowRule("lineitem", lambda: F.coalesce("l_quantity", F.lit(0)) <= 0)),
    Check("LINE_RETURNED_OPEN", "raw", "FAIL", "returned lines that are still open",
          RowRule("lineitem", lambda: (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"))),
    Check("FK_LINE_ORDER", "raw", "FAIL", "lines whose order is missing",
          lambda t: orphans(t["lineitem"], "l_orderkey", t["orders"], "o_orderkey")),
    Check("FK_LINE_SETTLED_ORDER", "raw", "FAIL", "lines whose order is missing or pending",
          lambda t: orphans(t["lineitem"], "l_orderkey", t["orders"].filter("o_orderstatus <> 'P'"), "o_orderkey")),
    Check("FK_LINE_SOLVENT_SUPPLIER", "raw", "FAIL", "lines whose supplier is missing or in debt",
          lambda t: orphans(t["lineitem"], "l_suppkey", t["supplier"].filter("s_acctbal >= 0"), "s_suppkey")),
    Check("FK_CUSTOMER_NATION", "raw", "FAIL", "customers whose nation is missing",
          lambda t: orphans(t["customer"], "c_nationkey", t["nation"], "n_nationkey")),
    Check("CUSTOMER_WITHOUT_FINISHED_ORDER", "raw", "FAIL", "customers without a finished order",
          lambda t: without_match(t["customer"], "c_custkey", t["orders"].filter("o_orderstatus = 'F'"), "o_custkey")),
    Check("LINE_NUMBER_REPEATED", "raw", "FAIL", "order and line number used more than once",
          lambda t: repeated_groups(t["lineitem"], ["l_orderkey", "l_linenumber"])),
    Check("LINE_SHIPPED_BEFORE_ORDER", "stg", "FAIL", "lines shipped before the order date",
          lambda t: dated_before(t["lineitem"], "l_orderkey", "l_shipdate", t["orders"], "o_orderkey", "o_orderdate")),
    Check("ORDER_TOTAL_ARITHMETIC", "stg", "FAIL", "orders whose lines differ from the total by >1%", _order_totals_off),
    Check("RECON_LINES", "recon", "FAIL", "lines by return flag must add up to all lines",
          RowRule("lineitem", lambda: ~F.coalesce(F.col("l_returnflag").isin("A", "N", "R"), F.lit(False)))),
]


def star_check_log(spark: SparkSession, folder: str) -> DataFrame:
    tables = {name: _read(spark, folder, name) for name in ("customer", "lineitem", "nation", "orders", "supplier")}
    return run_checks(tables, STAR_CHECKS).drop("run_ts")


def delimited_round_trip(spark: SparkSession, trans: DataFrame) -> DataFrame:
    """Raw transactions written as ``;`` text, the even ids in another order of columns, and read back by name."""
    path = f"{run_dir(spark)}/trans-{uuid.uuid4().hex}.asc"
    even = F.col("trans_id") % 2 == 0
    write_delimited(trans.where(even).select(*reversed(trans.columns)), path, sep=";")
    write_delimited(trans.where(~F.coalesce(even, F.lit(False))), path, sep=";", mode="append")
    return read_delimited(spark, path, RAW_SCHEMAS["trans"])
