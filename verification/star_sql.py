"""DuckDB SQL for the queries on the star schema's own tables."""

from __future__ import annotations

from verification.bank_sql import RHO_P, query

_SIGNED = "CAST(o_totalprice AS DECIMAL(18,2)) * CASE o_orderstatus WHEN 'F' THEN 1 ELSE -1 END"
_SPINE = """
    SELECT account_id, strftime(m, '%Y-%m') AS month
    FROM (SELECT o_custkey AS account_id, MIN(o_orderdate) AS opened FROM orders GROUP BY o_custkey),
         (SELECT unnest(generate_series(date_trunc('month', MIN(o_orderdate)), date_trunc('month', MAX(o_orderdate)),
                                        INTERVAL 1 MONTH)) AS m FROM orders)
    WHERE m >= date_trunc('month', opened)"""
_FLOWS = f"""
    SELECT o_custkey AS account_id, strftime(o_orderdate, '%Y-%m') AS month,
           COALESCE(SUM(v) FILTER (v > 0), 0) AS credits, COALESCE(-SUM(v) FILTER (v < 0), 0) AS debits,
           SUM(v) AS net_flow, COUNT(*) AS txn_count
    FROM (SELECT *, {_SIGNED} AS v FROM orders) GROUP BY ALL"""
_EVENTS = """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS day,
           row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id) AS place FROM events"""
_LINES = """
    SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate),
           row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                      l_linestatus) AS place FROM lineitem"""
_GROWTH = """
    SELECT {by} a.month, CAST(a.total AS DOUBLE) AS total, CAST(b.total AS DOUBLE) AS previous,
           CAST(a.total - b.total AS DOUBLE) / CAST(b.total AS DOUBLE) AS mom_change
    FROM monthly a LEFT JOIN monthly b ON {on} strptime(b.month || '-01', '%Y-%m-%d') + INTERVAL 1 MONTH
                                               = strptime(a.month || '-01', '%Y-%m-%d')"""
_MONTHLY = """WITH monthly AS (SELECT {by} strftime(o_orderdate, '%Y-%m') AS month,
    SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY ALL)"""

_NATIONS = """
    SELECT c_nationkey, COUNT(*) AS customers, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance,
           COUNT(*) FILTER (c_acctbal < 0) AS in_debt,
           (SELECT round(100.0 * COUNT(*) FILTER (o_orderstatus = 'F') / COUNT(*), 1)
            FROM orders JOIN customer i ON i.c_custkey = o_custkey WHERE i.c_nationkey = o.c_nationkey) AS share
    FROM customer o GROUP BY c_nationkey"""
_NATION_RHO = """
    SELECT '{m}' AS metric, COUNT(*) AS pairs, corr(rx, ry) AS rho
    FROM (SELECT rank() OVER (ORDER BY {m}) + (COUNT(*) OVER (PARTITION BY {m}) - 1) / 2.0 AS rx,
                 rank() OVER (ORDER BY share) + (COUNT(*) OVER (PARTITION BY share) - 1) / 2.0 AS ry
          FROM (%s) WHERE share IS NOT NULL)""" % _NATIONS

_CHECKS = [
    ("LINE_FULL_DISCOUNT", "raw", "WARN", "lines at the highest discount",
     "SELECT COUNT(*) FROM lineitem WHERE l_discount >= 0.1"),
    ("LINE_NO_QUANTITY", "raw", "FAIL", "lines without a quantity",
     "SELECT COUNT(*) FROM lineitem WHERE l_quantity IS NULL OR l_quantity <= 0"),
    ("LINE_RETURNED_OPEN", "raw", "FAIL", "returned lines that are still open",
     "SELECT COUNT(*) FROM lineitem WHERE l_returnflag || l_linestatus = 'RO'"),
    ("FK_LINE_ORDER", "raw", "FAIL", "lines whose order is missing",
     "SELECT COUNT(*) FROM lineitem WHERE NOT EXISTS (FROM orders WHERE o_orderkey = l_orderkey)"),
    ("FK_LINE_SETTLED_ORDER", "raw", "FAIL", "lines whose order is missing or pending",
     "SELECT COUNT(*) FROM lineitem WHERE NOT EXISTS (FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')"),
    ("FK_LINE_SOLVENT_SUPPLIER", "raw", "FAIL", "lines whose supplier is missing or in debt",
     "SELECT COUNT(*) FROM lineitem WHERE NOT EXISTS (FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal >= 0)"),
    ("FK_CUSTOMER_NATION", "raw", "FAIL", "customers whose nation is missing",
     "SELECT COUNT(*) FROM customer WHERE NOT EXISTS (FROM nation WHERE n_nationkey = c_nationkey)"),
    ("CUSTOMER_WITHOUT_FINISHED_ORDER", "raw", "FAIL", "customers without a finished order",
     "SELECT COUNT(*) FROM customer WHERE NOT EXISTS (FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')"),
    ("LINE_NUMBER_REPEATED", "raw", "FAIL", "order and line number used more than once",
     "SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)"),
    ("LINE_SHIPPED_BEFORE_ORDER", "stg", "FAIL", "lines shipped before the order date",
     "SELECT COUNT(*) FROM lineitem, orders WHERE o_orderkey = l_orderkey AND l_shipdate < o_orderdate"),
    ("ORDER_TOTAL_ARITHMETIC", "stg", "FAIL", "orders whose lines differ from the total by >1%",
     """SELECT COUNT(*) FROM (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_totalprice
        HAVING abs(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) - CAST(o_totalprice AS DECIMAL(18,2))) * 100
               > CAST(o_totalprice AS DECIMAL(18,2)))"""),
    ("RECON_LINES", "recon", "FAIL", "lines by return flag must add up to all lines",
     "SELECT COUNT(*) FROM lineitem WHERE l_returnflag IS NULL OR l_returnflag NOT IN ('A', 'N', 'R')"),
]
_LOG = "\nUNION ALL ".join(
    f"SELECT '{name}' AS check_name, '{layer}' AS layer, '{severity}' AS severity, ({sql}) AS failed_rows, '{text}' AS description"
    for name, layer, severity, text, sql in _CHECKS
)

STAR_SQL: dict[str, str] = {
    "orders_account_month": f"""
        SELECT s.account_id, s.month, CAST(ifnull(credits, 0) AS DOUBLE) AS credits,
               CAST(ifnull(debits, 0) AS DOUBLE) AS debits, CAST(ifnull(net_flow, 0) AS DOUBLE) AS net_flow,
               ifnull(txn_count, 0) AS txn_count,
               CAST(SUM(ifnull(net_flow, 0)) OVER (PARTITION BY s.account_id ORDER BY s.month
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS est_balance
        FROM ({_SPINE}) s LEFT JOIN ({_FLOWS}) f USING (account_id, month)""",
    "orders_month_spine": _SPINE,
    "orders_period_flows": f"""
        SELECT account_id, month, CAST(credits AS DOUBLE) AS credits, CAST(debits AS DOUBLE) AS debits,
               CAST(net_flow AS DOUBLE) AS net_flow, txn_count FROM ({_FLOWS})""",
    "orders_clean": f"""
        SELECT o_orderkey, replace(o_orderstatus, 'P', 'O') AS status,
               map {{'F': 'Finished', 'O': 'Open'}}[o_orderstatus] AS status_desc,
               ifnull(map {{'1-URGENT': 'now', '2-HIGH': 'soon'}}[o_orderpriority], 'later') AS urgency,
               CAST({_SIGNED} AS DOUBLE) AS signed_amount,
               CASE WHEN o_orderpriority[1:1] IN ('4', '5') THEN 'NONE' ELSE o_orderpriority END AS symbol,
               CAST(o_orderpriority[1:1] <= '2' AS INTEGER) AS is_urgent,
               strftime(o_orderdate, '%Y-%m') AS month, strftime(o_orderdate, '%Y') AS year FROM orders""",
    "events_kept": f"SELECT * EXCLUDE (place) FROM ({_EVENTS}) WHERE place = 1",
    "events_rejected": f"SELECT * EXCLUDE (place) FROM ({_EVENTS}) WHERE place > 1",
    "events_conservation": f"""
        SELECT COUNT(*) - COUNT(*) FILTER (place = 1) - COUNT(*) FILTER (place > 1) AS failed_rows FROM ({_EVENTS})""",
    "lines_kept": f"SELECT * EXCLUDE (place) FROM ({_LINES}) WHERE place = 1",
    "lines_rejected": f"SELECT * EXCLUDE (place) FROM ({_LINES}) WHERE place > 1",
    "customer_quartiles": """
        SELECT c_custkey, c_acctbal, CAST(ntile(4) OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS INTEGER) AS quartile
        FROM customer""",
    "part_sevenths": """
        SELECT p_partkey, p_size, CAST(ntile(7) OVER (ORDER BY p_size NULLS FIRST, p_partkey) AS INTEGER) AS seventh FROM part""",
    "customer_best_priority": """
        SELECT o_custkey, COUNT(*) AS orders, MIN(o_orderpriority) AS top_priority FROM orders GROUP BY o_custkey""",
    "lineitem_medians": """
        SELECT metric, COUNT(*) AS row_count, median(value) AS median
        FROM (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount FROM lineitem)
              ON l_quantity, l_extendedprice, l_discount INTO NAME metric VALUE value) GROUP BY metric""",
    "orders_balance_gaps": f"""
        SELECT o_custkey AS account_id, COUNT(*) AS n_rows_last_day,
               CAST(MIN(abs(total - CAST(o_totalprice AS DECIMAL(18,2)))) AS DOUBLE) AS diff, n_txn
        FROM (SELECT *, SUM({_SIGNED}) OVER w AS total, MAX(o_orderdate) OVER w AS last_day, COUNT(*) OVER w AS n_txn
              FROM orders WINDOW w AS (PARTITION BY o_custkey))
        WHERE o_orderdate = last_day GROUP BY o_custkey, n_txn""",
    "orders_growth": _MONTHLY.format(by="") + _GROWTH.format(by="", on=""),
    "orders_growth_by_status": _MONTHLY.format(by="o_orderstatus,")
    + _GROWTH.format(by="a.o_orderstatus,", on="a.o_orderstatus = b.o_orderstatus AND"),
    "nation_correlations": RHO_P.format(
        name="metric", count="pairs", rho="rho",
        source=" UNION ALL ".join(_NATION_RHO.format(m=m) for m in ("customers", "balance", "in_debt"))),
    "line_correlations": RHO_P.format(
        name="metric", count="pairs", rho="rho", source=" UNION ALL ".join(
            f"""SELECT '{m}' AS metric, COUNT(*) AS pairs, corr(rx, ry) AS rho
                FROM (SELECT rank() OVER (ORDER BY {m}) + (COUNT(*) OVER (PARTITION BY {m}) - 1) / 2.0 AS rx,
                             rank() OVER (ORDER BY l_extendedprice) + (COUNT(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS ry
                      FROM lineitem)""" for m in ("l_quantity", "l_discount", "l_tax"))).replace("round(rho, 2)", "round(rho, 6)"),
    "portfolio_by_region": """
        SELECT r_name AS region, COUNT(*) AS orders, CAST(SUM(amount) AS DOUBLE) AS amount,
               CAST(SUM(amount) FILTER (o_orderstatus = 'P') AS DOUBLE) AS pending_amount,
               CAST(CAST(100.0 * CAST(SUM(amount) FILTER (o_orderstatus = 'P') AS DOUBLE) / CAST(SUM(amount) AS DOUBLE)
                         AS DECIMAL(5,1)) AS DOUBLE) AS pending_pct
        FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders)
        JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey GROUP BY r_name""",
    "star_check_log": f"""
        SELECT check_name, layer, severity, failed_rows,
               CASE WHEN failed_rows = 0 THEN 'PASS' ELSE severity END AS status, description FROM ({_LOG})""",
    "delimited_round_trip": query(
        """SELECT trans_id, account_id, date, type, operation, CAST(amount AS DOUBLE) AS amount,
                  CAST(balance AS DOUBLE) AS balance, k_symbol, bank, account FROM raw_trans""", "raw_trans"),
}
