"""The bank's raw tables read out of a sales star schema.

Customers hold the accounts, orders are their transactions and cards, a customer's latest order is the
loan, nations are the districts, line items the standing orders; suppliers are second holders. The queries below use
whole tables and plain SQL only, so any SQL engine can run them; ``{name}`` stands for a table.

The star tables are clean, so the defects a bank's data has come from natural conditions: codes for
one status or segment, customers or suppliers in debt, and so on. Order dates are moved back by 36
months, into the bank's years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.schemas import RAW_SCHEMAS

STAR_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")

_ORDER_DAY = "(CAST(o_orderdate AS DATE) - INTERVAL '36' MONTH)"


def _yymmdd(day: str) -> str:
    return f"((year({day}) - 1900) * 10000 + month({day}) * 100 + day({day}))"


_SIGN = "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE -1 END"

# Sum of an account's flows, which its reported balance should match.
_CLOSING = f"""
    SELECT o_custkey AS account_id,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2)) * ({_SIGN})) AS DECIMAL(18,2)) AS closing
    FROM {{orders}} GROUP BY o_custkey"""

# Postings under an id of their own: the first, a second of some, a third of a few.
_POSTINGS = f"""
    SELECT o_orderkey AS trans_id, orders.* FROM {{orders}} AS orders
    UNION ALL
    SELECT o_orderkey + 1000000000000, second.* FROM {{orders}} AS second
    WHERE o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
    UNION ALL
    SELECT o_orderkey + 2000000000000, third.* FROM {{orders}} AS third
    WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"""

_BORN = "(DATE '1930-01-01' + CAST(floor(c_acctbal) AS INT))"
_SUPPLIER_BORN = "(DATE '1905-01-01' + CAST(floor(s_acctbal) AS INT))"

RAW_QUERIES: dict[str, str] = {
    "district": """
        SELECT CAST(n.n_nationkey AS BIGINT) AS A1, n.n_name AS A2, r.r_name AS A3,
               CAST(c.customers AS INT) AS A4, CAST(c.automobile AS INT) AS A5, CAST(c.building AS INT) AS A6,
               CAST(c.furniture AS INT) AS A7, CAST(c.household AS INT) AS A8, CAST(c.machinery AS INT) AS A9,
               CAST(100 * CAST(c.household AS DOUBLE) / c.customers AS DECIMAL(5,1)) AS A10,
               CAST(floor(CAST(c.balance AS DOUBLE) / c.customers) AS INT) AS A11,
               CASE WHEN s.in_debt > 0 THEN CAST(s.in_debt AS STRING) ELSE '?' END AS A12,
               CAST(100 * CAST(c.in_debt AS DOUBLE) / c.customers AS DECIMAL(5,2)) AS A13,
               CAST(s.suppliers AS INT) AS A14,
               CASE WHEN s.wealthy > 0 THEN ' ' || CAST(s.wealthy AS STRING) ELSE ' ? ' END AS A15,
               CAST(c.wealthy AS INT) AS A16
        FROM {nation} n
        JOIN {region} r ON r.r_regionkey = n.n_regionkey
        JOIN (SELECT c_nationkey, COUNT(*) AS customers, SUM(CAST(c_acctbal AS DECIMAL(12,2))) AS balance,
                     COUNT(CASE WHEN c_acctbal < 0 THEN 1 END) AS in_debt,
                     COUNT(CASE WHEN c_acctbal > 9000 THEN 1 END) AS wealthy,
                     COUNT(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 END) AS automobile,
                     COUNT(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 END) AS building,
                     COUNT(CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 END) AS furniture,
                     COUNT(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 END) AS household,
                     COUNT(CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 END) AS machinery
              FROM {customer} GROUP BY c_nationkey) c ON c.c_nationkey = n.n_nationkey
        LEFT JOIN (SELECT s_nationkey, COUNT(*) AS suppliers, COUNT(CASE WHEN s_acctbal < 0 THEN 1 END) AS in_debt,
                          COUNT(CASE WHEN s_acctbal > 9000 THEN 1 END) AS wealthy
                   FROM {supplier} GROUP BY s_nationkey) s ON s.s_nationkey = n.n_nationkey""",
    # Opened with the first finished order; a customer without one has no opening date.
    "account": f"""
        SELECT c.c_custkey AS account_id, CAST(c.c_nationkey AS BIGINT) AS district_id,
               CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'POPLATEK MESICNE' WHEN 'BUILDING' THEN 'POPLATEK TYDNE'
                    WHEN 'FURNITURE' THEN 'POPLATEK PO OBRATU' WHEN 'HOUSEHOLD' THEN 'POPLATEK ROCNE' END AS frequency,
               CAST({_yymmdd("o.first_day")} AS INT) AS date
        FROM {{customer}} c
        LEFT JOIN (SELECT o_custkey, MIN({_ORDER_DAY}) AS first_day FROM {{orders}}
                   WHERE o_orderstatus = 'F' GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey""",
    # Customers in debt of one segment are born on a 31st, existing or not.
    "client": f"""
        SELECT c_custkey AS client_id,
               CAST(CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0
                         THEN (year({_BORN}) - 1900) * 10000 + month({_BORN}) * 100 + 31
                         ELSE {_yymmdd(_BORN)} END
                    + CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 5000 ELSE 0 END AS INT) AS birth_number,
               CAST(c_nationkey AS BIGINT) AS district_id
        FROM {{customer}}
        UNION ALL
        SELECT s_suppkey + 1000000000000,
               CAST({_yymmdd(_SUPPLIER_BORN)} + CASE WHEN s_acctbal > 5000 THEN 5000 ELSE 0 END AS INT),
               CASE WHEN s_acctbal > 9800 THEN NULL ELSE CAST(s_nationkey AS BIGINT) END
        FROM {{supplier}}""",
    # A customer deep in debt is no owner, a supplier in debt counts as one, a rich one lacks its client.
    "disp": """
        SELECT c_custkey * 2 AS disp_id, c_custkey AS client_id, c_custkey AS account_id,
               CASE WHEN c_acctbal > -950 THEN 'OWNER' ELSE 'DISPONENT' END AS type
        FROM {customer}
        UNION ALL
        SELECT s_suppkey * 2 + 1, s_suppkey + CASE WHEN s_acctbal > 9700 THEN 2000000000000 ELSE 1000000000000 END,
               s_suppkey, CASE WHEN s_acctbal < 0 THEN 'OWNER' ELSE 'DISPONENT' END
        FROM {supplier}""",
    # Every order; the cards of urgent pending ones name a link that does not exist.
    "card": f"""
        SELECT o_orderkey AS card_id,
               o_custkey * 2 + CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 4000000000000 ELSE 0 END
                 AS disp_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'gold' WHEN '2-HIGH' THEN 'classic'
                    WHEN '3-MEDIUM' THEN 'junior' WHEN '4-NOT SPECIFIED' THEN 'classic' ELSE 'platinum' END AS type,
               CAST({_yymmdd(_ORDER_DAY)} AS STRING) || ' 00:00:00' AS issued
        FROM {{orders}}""",
    # One loan per account with orders: the latest order id.
    "loan": f"""
        SELECT o.o_orderkey AS loan_id, o.o_custkey AS account_id, CAST({_yymmdd(_ORDER_DAY)} AS INT) AS date,
               CAST(floor(o.o_totalprice) AS DECIMAL(18,0)) AS amount,
               CASE o.o_orderpriority WHEN '1-URGENT' THEN 12 WHEN '2-HIGH' THEN 24 WHEN '3-MEDIUM' THEN 36
                    WHEN '4-NOT SPECIFIED' THEN 48 ELSE 60 END AS duration,
               CAST(floor(100 * CAST(floor(o.o_totalprice) AS DOUBLE)
                          / CASE o.o_orderpriority WHEN '1-URGENT' THEN 12 WHEN '2-HIGH' THEN 24 WHEN '3-MEDIUM' THEN 36
                                 WHEN '4-NOT SPECIFIED' THEN 48 ELSE 60 END
                          * CASE WHEN o.o_orderstatus = 'P' THEN 1.05E0 ELSE 1.0E0 END) / 100E0 AS DECIMAL(18,2)) AS payments,
               CASE WHEN o.o_orderstatus = 'F' THEN 'A' WHEN o.o_orderstatus = 'O' THEN 'C'
                    WHEN o.o_totalprice > 200000 THEN 'D' ELSE 'B' END AS status
        FROM {{orders}} o
        JOIN (SELECT MAX(o_orderkey) AS loan_id FROM {{orders}} GROUP BY o_custkey) pick
          ON pick.loan_id = o.o_orderkey""",
    "order": """
        SELECT l_orderkey * 10 + l_linenumber AS order_id, l_suppkey AS account_id, l_returnflag AS bank_to,
               CAST(l_partkey AS STRING) AS account_to, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
               CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'SIPO'
                    WHEN l_returnflag = 'A' THEN 'POJISTNE'
                    WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'LEASING '
                    WHEN l_returnflag = 'N' THEN ' UVER'
                    WHEN l_linestatus = 'F' THEN ' ' END AS k_symbol
        FROM {lineitem}""",
    # The reported balance is the account's closing sum, off by up to two units. The month of a large
    # pending order without a stated priority is one that does not exist.
    "trans": f"""
        SELECT p.trans_id, p.o_custkey AS account_id,
               CAST({_yymmdd(_ORDER_DAY)}
                    + CASE WHEN p.o_orderstatus = 'P' AND p.o_orderpriority = '4-NOT SPECIFIED' AND p.o_totalprice > 400000
                           THEN 2000 ELSE 0 END AS INT) AS date,
               CASE p.o_orderstatus WHEN 'F' THEN 'PRIJEM' WHEN 'O' THEN 'VYDAJ' ELSE 'VYBER' END AS type,
               CASE p.o_orderpriority WHEN '1-URGENT' THEN 'VKLAD' WHEN '2-HIGH' THEN 'VYBER'
                    WHEN '3-MEDIUM' THEN 'PREVOD NA UCET' WHEN '5-LOW' THEN 'PREVOD Z UCTU' END AS operation,
               CAST(CASE WHEN p.o_totalprice < 2000 THEN 0 ELSE p.o_totalprice END AS DECIMAL(18,2)) AS amount,
               CAST(b.closing + CAST(2 * (p.o_totalprice - floor(p.o_totalprice)) AS DECIMAL(18,2))
                    AS DECIMAL(18,2)) AS balance,
               CASE WHEN p.o_totalprice < 50000 THEN NULL WHEN p.o_totalprice < 100000 THEN ' '
                    WHEN p.o_totalprice < 150000 THEN ' SIPO ' WHEN p.o_totalprice < 300000 THEN 'UROK'
                    WHEN p.o_totalprice < 400000 THEN 'UVER' ELSE 'SLUZBY' END AS k_symbol,
               CASE WHEN p.o_orderpriority = '3-MEDIUM' AND p.o_totalprice > 450000 THEN NULL ELSE 'AB' END AS bank,
               CASE WHEN p.o_orderpriority = '5-LOW' AND p.o_totalprice > 480000 THEN NULL
                    ELSE CAST(p.o_custkey AS STRING) END AS account
        FROM ({_POSTINGS}) p
        JOIN ({_CLOSING}) b ON b.account_id = p.o_custkey""",
}


def load_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in STAR_TABLES}


def raw_bank_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The eight raw bank tables, typed as declared for the files."""
    star = load_star(spark, folder)
    raw = {}
    for name, query in RAW_QUERIES.items():
        used = {table: df for table, df in star.items() if f"{{{table}}}" in query}
        rows = spark.sql(query, **used)
        raw[name] = rows.select(
            *[F.col(field.name).cast(field.dataType).alias(field.name) for field in RAW_SCHEMAS[name].fields]
        )
    return raw
