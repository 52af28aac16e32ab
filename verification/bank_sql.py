"""DuckDB SQL for the bank's tables, reports, checks and findings, written independently of the Spark code.

Only the reading of the raw tables out of the star schema is shared with it. Decimals leave as
doubles and dates as ISO text, as in the registered Spark queries.
"""

from __future__ import annotations

from ledgerloom.plans.fixed_values import CHECK_TEXTS
from ledgerloom.plans.star import RAW_QUERIES, STAR_TABLES

_DUCK_TYPES = {
    "district": "CAST(A1 AS BIGINT) AS A1, A2, A3, A4, A5, A6, A7, A8, A9, A10, A11, A12, A13, A14, A15, A16",
}


def _raw(name: str) -> str:
    query = RAW_QUERIES[name].format(**{table: table for table in STAR_TABLES})
    return f"SELECT {_DUCK_TYPES.get(name, '*')} FROM ({query})"


def _day(expression: str) -> str:
    return f"CAST(try_strptime({expression}, '%Y%m%d') AS DATE)"


_YYMMDD = _day("'19' || lpad(CAST(date AS VARCHAR), 6, '0')")

# name -> (tables it reads, body)
CTES: dict[str, tuple[list[str], str]] = {
    **{f"raw_{name}": ([], _raw(name)) for name in RAW_QUERIES},
    "stg_district": (
        ["raw_district"],
        """SELECT A1 AS district_id, A2 AS district_name, A3 AS region, A4 AS inhabitants, A10 AS urban_ratio_pct,
                  A11 AS avg_salary, TRY_CAST(trim(A12) AS DOUBLE) AS unemployment_95, A13 AS unemployment_96,
                  A14 AS entrepreneurs_per_1000, TRY_CAST(trim(A15) AS INTEGER) AS crimes_95, A16 AS crimes_96
           FROM raw_district""",
    ),
    "stg_account": (
        ["raw_account"],
        f"""SELECT account_id, district_id, COALESCE(f.label, 'Unknown') AS statement_frequency, {_YYMMDD} AS open_date
            FROM raw_account LEFT JOIN (VALUES ('POPLATEK MESICNE', 'Monthly statement'),
              ('POPLATEK TYDNE', 'Weekly statement'),
              ('POPLATEK PO OBRATU', 'Statement after transaction')) f(code, label) ON f.code = frequency""",
    ),
    "stg_client": (
        ["raw_client"],
        """SELECT client_id, district_id, CASE WHEN mm >= 51 THEN 'F' ELSE 'M' END AS gender,
                  CAST(try_strptime('19' || yy || lpad(CAST(CASE WHEN mm >= 51 THEN mm - 50 ELSE mm END AS VARCHAR), 2, '0')
                       || dd, '%Y%m%d') AS DATE) AS birth_date,
                  98 - CAST(yy AS INTEGER) AS age_at_1998
           FROM (SELECT client_id, district_id, s[1:2] AS yy, CAST(s[3:4] AS INTEGER) AS mm, s[5:6] AS dd
                 FROM (SELECT *, lpad(CAST(birth_number AS VARCHAR), 6, '0') AS s FROM raw_client))""",
    ),
    "stg_disp": (["raw_disp"], "SELECT disp_id, client_id, account_id, lower(type) AS disp_type FROM raw_disp"),
    "stg_card": (
        ["raw_card"],
        f"SELECT card_id, disp_id, type AS card_type, {_day('concat(19, left(issued, 6))')} AS issued_date FROM raw_card",
    ),
    "stg_loan": (
        ["raw_loan"],
        f"""SELECT loan_id, account_id, amount, duration AS duration_months, payments AS monthly_payment, status,
                   map {{'A': 'Finished, paid', 'B': 'Finished, unpaid', 'C': 'Running, OK', 'D': 'Running, in debt'}}[status]
                     AS status_desc,
                   CAST(COALESCE(status IN ('B', 'D'), FALSE) AS INTEGER) AS is_bad, {_YYMMDD} AS loan_date
            FROM raw_loan""",
    ),
    "stg_order": (
        ["raw_order"],
        """SELECT order_id, account_id, amount,
                  COALESCE(map {'SIPO': 'Household', 'POJISTNE': 'Insurance', 'LEASING': 'Leasing',
                                'UVER': 'Loan payment'}[trim(k_symbol)], 'Unspecified') AS purpose
           FROM raw_order""",
    ),
    "numbered": (
        ["raw_trans"],
        """SELECT *, row_number() OVER (PARTITION BY account_id, date, type, operation, amount, balance, k_symbol
                                        ORDER BY trans_id) AS place FROM raw_trans""",
    ),
    "stg_trans": (
        ["numbered"],
        f"""SELECT trans_id, account_id, {_YYMMDD} AS txn_date, CASE WHEN type = 'VYBER' THEN 'VYDAJ' ELSE type END AS txn_type,
                   ifnull(operation, 'NOT_APPLICABLE') AS operation, amount,
                   amount * (2 * CAST(type IS NOT DISTINCT FROM 'PRIJEM' AS INTEGER) - 1) AS signed_amount,
                   balance AS balance_reported,
                   CASE WHEN length(trim(ifnull(k_symbol, ''))) > 0 THEN trim(k_symbol) ELSE 'NONE' END AS k_symbol,
                   bank, account
            FROM numbered WHERE place = 1""",
    ),
    "rej_trans": (["numbered"], "SELECT *, 'DUPLICATE_POSTING' AS reject_reason FROM numbered WHERE place >= 2"),
    "months": (
        [],
        """SELECT CAST(range AS DATE) AS month_day, strftime(range, '%Y-%m') AS month
           FROM range(TIMESTAMP '1993-01-01', TIMESTAMP '1999-01-01', INTERVAL 1 MONTH)""",
    ),
    "mart_account_month": (
        ["stg_account", "stg_trans", "months"],
        """SELECT g.account_id, g.month, ifnull(f.credits, 0) AS credits, ifnull(f.debits, 0) AS debits,
                  ifnull(f.net_flow, 0) AS net_flow, ifnull(f.txn_count, 0) AS txn_count,
                  SUM(ifnull(f.net_flow, 0)) OVER (PARTITION BY g.account_id ORDER BY g.month
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS est_balance
           FROM (SELECT account_id, month FROM stg_account, months WHERE last_day(month_day) >= open_date) g
           LEFT JOIN (SELECT account_id, strftime(txn_date, '%Y-%m') AS month,
                             COALESCE(SUM(signed_amount) FILTER (signed_amount > 0), 0) AS credits,
                             COALESCE(-SUM(signed_amount) FILTER (signed_amount < 0), 0) AS debits,
                             SUM(signed_amount) AS net_flow, COUNT(*) AS txn_count
                      FROM stg_trans GROUP BY ALL) f USING (account_id, month)""",
    ),
    "mart_account_360": (
        ["stg_account", "stg_disp", "stg_client", "stg_district", "stg_card", "stg_loan", "mart_account_month"],
        """SELECT * EXCLUDE (tile), CASE tile WHEN 1 THEN 'Premium' WHEN 4 THEN 'Basic' ELSE 'Standard' END AS tier
           FROM (SELECT *, ntile(4) OVER (ORDER BY avg_balance_1998 DESC NULLS LAST, account_id, owner_client_id,
                                                   loan_id NULLS LAST) AS tile
                 FROM (SELECT a.account_id, a.open_date, a.statement_frequency, a.district_id, d.district_name, d.region,
                              c.client_id AS owner_client_id, c.gender, c.age_at_1998, b.* EXCLUDE (account_id),
                              ifnull(k.cards, 0) AS cards, k.top_card, l.loan_id, l.amount AS loan_amount,
                              l.status AS loan_status, l.is_bad AS loan_is_bad
                       FROM stg_account a
                       JOIN stg_district d USING (district_id)
                       JOIN stg_disp o ON o.account_id = a.account_id AND o.disp_type = 'owner'
                       JOIN stg_client c ON c.client_id = o.client_id
                       LEFT JOIN (SELECT account_id, CAST(SUM(est_balance) AS DOUBLE) / COUNT(*) AS avg_balance_1998,
                                         MAX(est_balance) FILTER (month = '1998-12') AS balance_dec98,
                                         MIN(est_balance) AS min_balance_1998,
                                         COUNT(*) FILTER (est_balance < 0) AS negative_months_1998,
                                         CAST(SUM(txn_count) AS BIGINT) AS txn_count_1998
                                  FROM mart_account_month WHERE starts_with(month, '1998') GROUP BY account_id) b
                              ON b.account_id = a.account_id
                       LEFT JOIN (SELECT p.account_id, COUNT(*) AS cards,
                                         CASE WHEN bool_or(c.card_type = 'gold') THEN 'gold'
                                              WHEN bool_or(c.card_type = 'classic') THEN 'classic'
                                              ELSE 'junior' END AS top_card
                                  FROM stg_card c JOIN stg_disp p USING (disp_id) GROUP BY p.account_id) k
                              ON k.account_id = a.account_id
                       LEFT JOIN stg_loan l ON l.account_id = a.account_id))""",
    ),
    "trend": (
        ["mart_account_month", "mart_account_360"],
        """SELECT m.month, a.tier, a.region, COUNT(*) AS accounts, SUM(m.est_balance) AS total_balance,
                  SUM(m.credits) AS credits, SUM(m.debits) AS debits
           FROM mart_account_360 a JOIN mart_account_month m USING (account_id) GROUP BY ALL""",
    ),
    "tiers": (
        ["mart_account_360"],
        """SELECT tier, COUNT(*) AS accounts, round(AVG(avg_balance_1998), 0) AS avg_balance,
                  round(100.0 * COUNT(*) FILTER (cards > 0) / COUNT(*), 1) AS card_penetration_pct,
                  COUNT(loan_id) AS loans,
                  round(100.0 * COUNT(*) FILTER (loan_is_bad = 1) / nullif(COUNT(loan_id), 0), 1) AS bad_loan_pct,
                  COUNT(*) FILTER (negative_months_1998 > 0) AS accounts_overdrawn_1998
           FROM mart_account_360 GROUP BY tier""",
    ),
    "portfolio": (
        ["stg_loan", "stg_account", "stg_district"],
        """SELECT d.region, d.district_name, l.status_desc, l.duration_months, COUNT(*) AS loans,
                  SUM(l.amount) AS loan_amount, SUM(l.amount * l.is_bad) AS bad_amount,
                  COUNT(*) FILTER (l.is_bad = 1) AS bad_loans
           FROM stg_district d JOIN stg_account a USING (district_id) JOIN stg_loan l USING (account_id) GROUP BY ALL""",
    ),
    "watchlist": (
        ["stg_loan", "mart_account_360"],
        """SELECT l.loan_id, l.account_id, l.loan_date, l.amount, l.duration_months, l.monthly_payment, l.status,
                  l.status_desc, a.district_name, a.region, a.tier, a.balance_dec98, a.negative_months_1998,
                  CASE WHEN a.balance_dec98 IS NULL OR a.balance_dec98 >= greatest(0, 3 * l.monthly_payment) THEN 'OK'
                       WHEN a.balance_dec98 >= 0 THEN 'Low cover' ELSE 'Overdrawn' END AS balance_cover
           FROM mart_account_360 a JOIN stg_loan l USING (account_id) WHERE l.is_bad = 1""",
    ),
    "scorecard": (
        ["stg_district", "mart_account_360"],
        """SELECT d.district_id, d.district_name, d.region, d.inhabitants, d.avg_salary, d.unemployment_96, d.crimes_96,
                  COUNT(a.account_id) AS accounts, round(AVG(a.avg_balance_1998), 0) AS avg_balance,
                  COUNT(a.loan_id) AS loans, COUNT(*) FILTER (a.loan_is_bad = 1) AS bad_loans,
                  round(100.0 * COUNT(*) FILTER (a.loan_is_bad = 1) / nullif(COUNT(a.loan_id), 0), 1) AS bad_loan_pct
           FROM mart_account_360 a RIGHT JOIN stg_district d ON d.district_id = a.district_id GROUP BY ALL""",
    ),
    "gaps": (
        ["stg_trans"],
        """SELECT account_id, COUNT(*) AS n_rows_last_day, MIN(abs(total - balance_reported)) AS diff, n_txn
           FROM (SELECT account_id, txn_date, balance_reported, MAX(txn_date) OVER w AS last_day,
                        SUM(signed_amount) OVER w AS total, COUNT(*) OVER w AS n_txn
                 FROM stg_trans WINDOW w AS (PARTITION BY account_id))
           WHERE txn_date = last_day GROUP BY account_id, n_txn""",
    ),
}

_MISSING_PARTNER = "operation IN ('PREVOD NA UCET', 'PREVOD Z UCTU') AND (bank IS NULL OR account IS NULL)"

# check -> (layer, severity, tables, query for the number of failing rows)
CHECKS: dict[str, tuple[str, str, list[str], str]] = {
    "DISTRICT_MISSING_VALUE": (
        "raw", "FAIL", ["raw_district"], "SELECT COUNT(*) FROM raw_district WHERE '?' IN (trim(A12), trim(A15))"),
    "TXN_SYMBOL_INCONSISTENT_ENCODING": (
        "raw", "FAIL", ["raw_trans"], "SELECT COUNT(*) FROM raw_trans WHERE k_symbol IS NOT NULL AND trim(k_symbol) = ''"),
    "TXN_LEGACY_TYPE_CODE": ("raw", "FAIL", ["raw_trans"], "SELECT COUNT(*) FROM raw_trans WHERE type = 'VYBER'"),
    "TXN_ZERO_AMOUNT": ("raw", "FAIL", ["raw_trans"], "SELECT COUNT(*) FROM raw_trans WHERE NOT amount > 0"),
    "TXN_DUPLICATE_POSTING": ("raw", "FAIL", ["rej_trans"], "SELECT COUNT(*) FROM rej_trans"),
    "TRANSFER_MISSING_COUNTERPARTY": (
        "raw", "FAIL", ["raw_trans"], f"SELECT COUNT(*) FROM raw_trans WHERE {_MISSING_PARTNER}"),
    "TXN_NULL_OPERATION_UNEXPLAINED": (
        "raw", "FAIL", ["raw_trans"],
        "SELECT COUNT(*) FROM raw_trans WHERE operation IS NULL AND trim(k_symbol) IS DISTINCT FROM 'UROK'"),
    "NEGATIVE_BALANCE_TXNS": (
        "stg", "WARN", ["stg_trans"], "SELECT COUNT(*) FROM stg_trans WHERE balance_reported < 0"),
    "BALANCE_RECON_ACCOUNT": ("stg", "FAIL", ["gaps"], "SELECT COUNT(*) FROM gaps WHERE diff > 1"),
    "FK_DISP_CLIENT": (
        "raw", "FAIL", ["raw_disp", "raw_client"],
        "SELECT COUNT(*) FROM raw_disp ANTI JOIN raw_client USING (client_id)"),
    "FK_DISP_ACCOUNT": (
        "raw", "FAIL", ["raw_disp", "raw_account"],
        "SELECT COUNT(*) FROM raw_disp ANTI JOIN raw_account USING (account_id)"),
    "FK_LOAN_ACCOUNT": (
        "raw", "FAIL", ["raw_loan", "raw_account"],
        "SELECT COUNT(*) FROM raw_loan ANTI JOIN raw_account USING (account_id)"),
    "FK_TRANS_ACCOUNT": (
        "raw", "FAIL", ["raw_trans", "raw_account"],
        "SELECT COUNT(*) FROM raw_trans ANTI JOIN raw_account USING (account_id)"),
    "FK_CARD_DISP": (
        "raw", "FAIL", ["raw_card", "raw_disp"], "SELECT COUNT(*) FROM raw_card ANTI JOIN raw_disp USING (disp_id)"),
    "FK_CLIENT_DISTRICT": (
        "raw", "FAIL", ["raw_client", "raw_district"],
        "SELECT COUNT(*) FROM raw_client c ANTI JOIN raw_district d ON d.A1 = c.district_id"),
    "ACCOUNT_WITHOUT_OWNER": (
        "raw", "FAIL", ["raw_account", "raw_disp"],
        "SELECT COUNT(*) FROM raw_account a ANTI JOIN raw_disp d ON d.account_id = a.account_id AND d.type = 'OWNER'"),
    "ACCOUNT_MULTIPLE_OWNERS": (
        "raw", "FAIL", ["raw_disp"],
        "SELECT COUNT(*) FROM (SELECT COUNT(*) AS n FROM raw_disp WHERE type = 'OWNER' GROUP BY account_id) WHERE n >= 2"),
    "LOAN_PAYMENT_ARITHMETIC": (
        "raw", "FAIL", ["raw_loan"],
        "SELECT COUNT(*) FROM raw_loan WHERE abs(duration * payments - amount) * 100 > amount"),
    "LOAN_BEFORE_ACCOUNT_OPEN": (
        "stg", "FAIL", ["stg_loan", "stg_account"],
        "SELECT COUNT(*) FROM stg_loan JOIN stg_account USING (account_id) WHERE open_date > loan_date"),
    "CARD_BEFORE_ACCOUNT_OPEN": (
        "stg", "FAIL", ["stg_card", "stg_disp", "stg_account"],
        """SELECT COUNT(*) FROM stg_account JOIN stg_disp USING (account_id) JOIN stg_card USING (disp_id)
           WHERE open_date > issued_date"""),
    "TXN_BEFORE_ACCOUNT_OPEN": (
        "stg", "FAIL", ["stg_trans", "stg_account"],
        "SELECT COUNT(*) FROM stg_trans JOIN stg_account USING (account_id) WHERE open_date > txn_date"),
    "CLIENT_INVALID_BIRTH_DATE": (
        "stg", "FAIL", ["stg_client"], "SELECT COUNT(*) - COUNT(birth_date) FROM stg_client"),
    "LOAN_MULTIPLE_PER_ACCOUNT": (
        "raw", "FAIL", ["raw_loan"],
        "SELECT COUNT(*) FROM (SELECT account_id FROM raw_loan GROUP BY account_id HAVING COUNT(*) > 1)"),
    "RECON_RAW_VS_STG_TRANS": (
        "recon", "FAIL", ["raw_trans", "stg_trans", "rej_trans"],
        "SELECT abs((SELECT COUNT(*) FROM raw_trans) - (SELECT COUNT(*) FROM stg_trans) - (SELECT COUNT(*) FROM rej_trans))"),
    "RECON_ACCOUNT_MONTH_SPINE": (
        "mart", "FAIL", ["stg_account", "mart_account_360"],
        "SELECT COUNT(*) FROM stg_account WHERE account_id NOT IN (SELECT account_id FROM mart_account_360)"),
}


def _log_body() -> str:
    rows = []
    for number, (name, (layer, severity, _, query)) in enumerate(CHECKS.items(), 1):
        text = CHECK_TEXTS[name]
        rows.append(
            f"SELECT {number} AS no, '{name}' AS check_name, '{layer}' AS layer, '{severity}' AS severity, "
            f"CAST(({query}) AS BIGINT) AS failed_rows, '{text}' AS description"
        )
    union = "\nUNION ALL ".join(rows)
    return f"SELECT *, CASE WHEN failed_rows = 0 THEN 'PASS' ELSE severity END AS status FROM ({union})"


CTES["dq_log"] = (sorted({table for check in CHECKS.values() for table in check[2]}), _log_body())


def query(select: str, *tables: str) -> str:
    """The select behind the definitions of the named tables and all they read."""
    needed: list[str] = []

    def need(name: str) -> None:
        for parent in CTES[name][0]:
            need(parent)
        if name not in needed:
            needed.append(name)

    for table in tables:
        need(table)
    definitions = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name][1]})" for name in needed)
    return f"WITH {definitions}\n{select}" if needed else select


def _d(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def _iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {column}"


_RHO = """
SELECT '{m}' AS district_metric, COUNT(*) AS districts, corr(rx, ry) AS rho
FROM (SELECT rank() OVER (ORDER BY x) + (COUNT(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY y) + (COUNT(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry
      FROM (SELECT CAST({m} AS DOUBLE) AS x, bad_loan_pct AS y FROM scorecard
            WHERE loans >= 5 AND {m} IS NOT NULL AND bad_loan_pct IS NOT NULL))"""

# p of |t| with n - 2 degrees of freedom: Simpson's rule over the density, integrated in the angle
# t = sqrt(df) * tan(a), where the density is proportional to cos(a) ** (df - 1).
RHO_P = """
SELECT {name}, {count}, round(rho, 2) AS {rho}, round(CASE WHEN rho IS NULL OR isnan(rho) THEN NULL
         WHEN abs(rho) >= 1 THEN 0 ELSE 1 - part / whole END, 2) AS p_value
FROM (SELECT {name}, {count}, rho,
             (SELECT SUM(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                         * pow(cos(i * asin(abs(rho)) / 2000), {count} - 3)) * asin(abs(rho))
              FROM range(2001) s(i)) AS part,
             (SELECT SUM(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                         * pow(cos(i * pi() / 4000), {count} - 3)) * pi() / 2
              FROM range(2001) s(i)) AS whole
      FROM ({source}))"""

_REGION_LOANS = """
SELECT region, COUNT(*) AS loans, {amount} COUNT(*) FILTER (loan_is_bad = 1) AS bad_loans,
       round(100.0 * COUNT(*) FILTER (loan_is_bad = 1) / COUNT(*), 1) AS bad_loan_pct
FROM mart_account_360 WHERE loan_id IS NOT NULL GROUP BY region"""

_YEAR = f"strftime({_YYMMDD}, '%Y')"

_KPI = """
SELECT no AS kpi_no, kpi, value,
       CASE WHEN no = 0 THEN '1998-12' ELSE format('{:,.' || digits || 'f}', value) END AS display
FROM (SELECT unnest([
  {'no': 0, 'kpi': 'Data as of', 'digits': '0', 'value': CAST(NULL AS DOUBLE)},
  {'no': 1, 'kpi': 'Accounts', 'digits': '0', 'value': (SELECT CAST(COUNT(*) AS DOUBLE) FROM mart_account_360)},
  {'no': 2, 'kpi': 'Total balance Dec-98 (reconstructed)', 'digits': '1',
   'value': (SELECT CAST(SUM(balance_dec98) AS DOUBLE) FROM mart_account_360)},
  {'no': 3, 'kpi': 'Net cash flow 1998', 'digits': '1',
   'value': (SELECT CAST(SUM(net_flow) AS DOUBLE) FROM mart_account_month WHERE starts_with(month, '1998'))},
  {'no': 4, 'kpi': 'Loans', 'digits': '0', 'value': (SELECT CAST(COUNT(*) AS DOUBLE) FROM stg_loan)},
  {'no': 5, 'kpi': 'Loan book (amount)', 'digits': '1', 'value': (SELECT CAST(SUM(amount) AS DOUBLE) FROM stg_loan)},
  {'no': 6, 'kpi': 'Bad loans % (by amount)', 'digits': '1',
   'value': (SELECT round(100.0 * CAST(SUM(amount * is_bad) AS DOUBLE) / CAST(SUM(amount) AS DOUBLE), 1) FROM stg_loan)},
  {'no': 7, 'kpi': 'Accounts overdrawn in 1998', 'digits': '0',
   'value': (SELECT CAST(COUNT(*) AS DOUBLE) FROM mart_account_360 WHERE negative_months_1998 > 0)},
  {'no': 8, 'kpi': 'DQ checks failed', 'digits': '0',
   'value': (SELECT CAST(COUNT(*) AS DOUBLE) FROM dq_log WHERE status = 'FAIL')},
  {'no': 9, 'kpi': 'DQ warnings', 'digits': '0',
   'value': (SELECT CAST(COUNT(*) AS DOUBLE) FROM dq_log WHERE status = 'WARN')}], recursive := true))"""

_CAUSE_ROWS = """('TXN_DUPLICATE_POSTING', 'second posting made for the query', 'rejected'),
              ('NEGATIVE_BALANCE_TXNS', 'orders outweigh payments', 'kept'),
              ('NEGATIVE_BALANCE_TXNS', 'closing sum is reported on each posting', 'kept')"""

BANK_SQL: dict[str, str] = {
    "stg_district": query(
        f"""SELECT district_id, district_name, region, inhabitants, {_d('urban_ratio_pct')}, avg_salary, unemployment_95,
                   {_d('unemployment_96')}, entrepreneurs_per_1000, crimes_95, crimes_96 FROM stg_district""",
        "stg_district"),
    "stg_account": query(
        f"SELECT account_id, district_id, statement_frequency, {_iso('open_date')} FROM stg_account", "stg_account"),
    "stg_client": query(
        f"SELECT client_id, district_id, gender, {_iso('birth_date')}, age_at_1998 FROM stg_client", "stg_client"),
    "stg_disp": query("SELECT * FROM stg_disp", "stg_disp"),
    "stg_card": query(f"SELECT card_id, disp_id, card_type, {_iso('issued_date')} FROM stg_card", "stg_card"),
    "stg_loan": query(
        f"""SELECT loan_id, account_id, {_d('amount')}, duration_months, {_d('monthly_payment')}, status, status_desc,
                   is_bad, {_iso('loan_date')} FROM stg_loan""", "stg_loan"),
    "stg_order": query(f"SELECT order_id, account_id, {_d('amount')}, purpose FROM stg_order", "stg_order"),
    "stg_trans": query(
        f"""SELECT trans_id, account_id, {_iso('txn_date')}, txn_type, operation,
                   {_d('amount', 'signed_amount', 'balance_reported')}, k_symbol, bank, account FROM stg_trans""",
        "stg_trans"),
    "rej_trans": query(
        f"""SELECT trans_id, account_id, date, type, operation, {_d('amount', 'balance')}, k_symbol, reject_reason
            FROM rej_trans""", "rej_trans"),
    "mart_account_month": query(
        f"""SELECT account_id, month, {_d('credits', 'debits', 'net_flow')}, txn_count, {_d('est_balance')}
            FROM mart_account_month""", "mart_account_month"),
    "mart_account_360": query(
        f"""SELECT * REPLACE ({_iso('open_date')}, {_d('balance_dec98')}, {_d('min_balance_1998')}, {_d('loan_amount')})
            FROM mart_account_360""", "mart_account_360"),
    "vw_balance_trend_monthly": query(
        f"SELECT month, tier, region, accounts, {_d('total_balance', 'credits', 'debits')} FROM trend", "trend"),
    "vw_tier_summary": query("SELECT * FROM tiers", "tiers"),
    "vw_cashflow_monthly": query(
        """SELECT strftime(txn_date, '%Y-%m') AS month, txn_type, operation, k_symbol, COUNT(*) AS txn_count,
                  CAST(SUM(amount) AS DOUBLE) AS amount FROM stg_trans GROUP BY ALL""", "stg_trans"),
    "vw_loan_portfolio": query(
        f"SELECT * REPLACE ({_d('loan_amount')}, {_d('bad_amount')}) FROM portfolio", "portfolio"),
    "vw_loan_watchlist": query(
        f"""SELECT * REPLACE ({_iso('loan_date')}, {_d('amount')}, {_d('monthly_payment')}, {_d('balance_dec98')})
            FROM watchlist""", "watchlist"),
    "exported_watchlist": query(
        f"""SELECT * REPLACE ({_iso('loan_date')}, {_d('amount')}, {_d('monthly_payment')}, {_d('balance_dec98')})
            FROM watchlist""", "watchlist"),
    "vw_district_scorecard": query(f"SELECT * REPLACE ({_d('unemployment_96')}) FROM scorecard", "scorecard"),
    "vw_card_summary": query(
        """SELECT ifnull(top_card, 'no card') AS card_type, tier, COUNT(*) AS accounts,
                  round(AVG(avg_balance_1998), 0) AS avg_balance FROM mart_account_360 GROUP BY ALL""",
        "mart_account_360"),
    "vw_standing_orders": query(
        """SELECT purpose, COUNT(*) AS orders, CAST(SUM(amount) AS DOUBLE) AS total_amount,
                  round(CAST(SUM(amount) AS DOUBLE) / COUNT(*), 0) AS avg_amount FROM stg_order GROUP BY purpose""",
        "stg_order"),
    "raw_portfolio_by_region": query(
        """SELECT A3 AS region, COUNT(*) AS loans, CAST(SUM(amount) AS DOUBLE) AS loan_amount,
                  CAST(SUM(amount) FILTER (status IN ('B', 'D')) AS DOUBLE) AS bad_amount,
                  CAST(CAST(100.0 * CAST(SUM(amount) FILTER (status IN ('B', 'D')) AS DOUBLE)
                            / CAST(SUM(amount) AS DOUBLE) AS DECIMAL(5,1)) AS DOUBLE) AS bad_amount_pct
           FROM raw_district JOIN raw_account ON A1 = district_id JOIN raw_loan USING (account_id) GROUP BY A3""",
        "raw_district", "raw_account", "raw_loan"),
    "dq_log": query("SELECT check_name, layer, severity, failed_rows, status, description FROM dq_log", "dq_log"),
    "dq_log_short": query(
        """SELECT check_name, layer, severity, failed_rows, status, description FROM dq_log
           WHERE check_name IN ('TXN_LEGACY_TYPE_CODE', 'FK_LOAN_ACCOUNT', 'NEGATIVE_BALANCE_TXNS')""", "dq_log"),
    "dq_alert_rows": query("SELECT check_name, failed_rows FROM dq_log WHERE status = 'FAIL'", "dq_log"),
    "dq_unparsed_dates": query(
        """SELECT 'stg_account.open_date' AS column_name,
                  (SELECT COUNT(date) FROM raw_account) - (SELECT COUNT(open_date) FROM stg_account) AS unparsed_rows
           UNION ALL SELECT 'stg_loan.loan_date',
                  (SELECT COUNT(date) FROM raw_loan) - (SELECT COUNT(loan_date) FROM stg_loan)
           UNION ALL SELECT 'stg_card.issued_date',
                  (SELECT COUNT(issued) FROM raw_card) - (SELECT COUNT(issued_date) FROM stg_card)
           UNION ALL SELECT 'stg_trans.txn_date', (SELECT COUNT(*) FROM stg_trans s JOIN raw_trans r USING (trans_id)
                  WHERE r.date IS NOT NULL AND s.txn_date IS NULL)""",
        "raw_account", "raw_loan", "raw_card", "stg_account", "stg_loan", "stg_card", "raw_trans", "stg_trans"),
    "dq_postings_outside_spine": query(
        """SELECT place, COUNT(trans_id) AS postings FROM (VALUES ('in the month table'), ('unknown account'),
                  ('account without opening date'), ('undated'), ('before the first month'), ('after the last month'),
                  ('before opening')) p(place)
           LEFT JOIN (SELECT trans_id, CASE WHEN a.account_id IS NULL THEN 'unknown account'
                             WHEN open_date IS NULL THEN 'account without opening date' WHEN txn_date IS NULL THEN 'undated'
                             WHEN txn_date < DATE '1993-01-01' THEN 'before the first month'
                             WHEN txn_date >= DATE '1999-01-01' THEN 'after the last month'
                             WHEN last_day(txn_date) < open_date THEN 'before opening' ELSE 'in the month table' END AS place
                      FROM stg_trans t LEFT JOIN stg_account a ON a.account_id = t.account_id) USING (place) GROUP BY place""",
        "stg_trans", "stg_account"),
    "history_runs": query(
        """SELECT run, (SELECT COUNT(*) FROM dq_log) AS checks
           FROM (VALUES ('2024-05-06 07:08:09'), ('2024-05-07 00:00:01')) v(run)""", "dq_log"),
    "top_failing_checks": query(
        """SELECT check_name, failed_rows, description FROM dq_log WHERE status = 'FAIL'
           ORDER BY failed_rows DESC, check_name LIMIT 3""", "dq_log"),
    "rca_status_summary": query(
        """SELECT COUNT(*) AS checks_run, COUNT(*) FILTER (status = 'PASS') AS passed,
                  COUNT(*) FILTER (status = 'FAIL') AS failed, COUNT(*) FILTER (status = 'WARN') AS warnings
           FROM dq_log""", "dq_log"),
    "rca_open_checks": query(
        "SELECT check_name, status, failed_rows, description FROM dq_log WHERE status <> 'PASS'", "dq_log"),
    "rca_passed_list": query(
        """SELECT COALESCE(string_agg(check_name, ', ' ORDER BY no), '') AS passed_checks
           FROM dq_log WHERE status = 'PASS'""", "dq_log"),
    "rca_causes": query(
        f"""SELECT check_name, status, failed_rows, likely_cause, treatment
            FROM dq_log LEFT JOIN (VALUES {_CAUSE_ROWS}) c(check_name, likely_cause, treatment) USING (check_name)
            WHERE status <> 'PASS'""", "dq_log"),
    "rca_missing_district_values": query(
        """SELECT d.district_id, d.district_name, d.region, CAST(d.unemployment_95 IS NULL AS INTEGER) AS unemployment_95_missing,
                  CAST(d.crimes_95 IS NULL AS INTEGER) AS crimes_95_missing, COUNT(a.account_id) AS accounts,
                  COUNT(a.loan_id) AS loans
           FROM stg_district d LEFT JOIN mart_account_360 a ON a.district_id = d.district_id
           WHERE d.unemployment_95 IS NULL OR d.crimes_95 IS NULL GROUP BY ALL""", "stg_district", "mart_account_360"),
    "rca_symbol_encodings": query(
        """SELECT ifnull(operation, '(null)') AS operation, COUNT(*) - COUNT(k_symbol) AS encoded_as_null,
                  COUNT(*) FILTER (trim(k_symbol) = '') AS encoded_as_space FROM raw_trans GROUP BY 1""", "raw_trans"),
    "rca_legacy_codes_by_year": query(
        f"""SELECT {_YEAR} AS year, COUNT(*) FILTER (type = 'VYBER') AS legacy_type_VYBER,
                   COUNT(*) FILTER (type = 'VYDAJ' AND operation = 'VYBER') AS standard_VYDAJ_cash_withdrawals
            FROM raw_trans GROUP BY 1""", "raw_trans"),
    "rca_zero_amounts": query(
        "SELECT k_symbol, type, COUNT(*) AS rows_ FROM raw_trans WHERE amount <= 0 GROUP BY ALL", "raw_trans"),
    "rca_rejected_duplicates": query(
        f"""SELECT trans_id, account_id, date, type, k_symbol, {_d('amount', 'balance')}, reject_reason
            FROM rej_trans""", "rej_trans"),
    "rca_transfers_without_counterparty": query(
        f"""SELECT trans_id, account_id, date, type, operation, k_symbol, {_d('amount')}
            FROM raw_trans WHERE {_MISSING_PARTNER}""", "raw_trans"),
    "rca_negative_balances_by_year": query(
        f"""SELECT {_YEAR} AS year, COUNT(*) AS txns_with_negative_balance, COUNT(DISTINCT account_id) AS accounts
            FROM raw_trans WHERE balance < 0 GROUP BY 1""", "raw_trans"),
    "rca_reconciliation_stats": query(
        """SELECT COUNT(*) AS accounts_failing, median(CAST(diff AS DOUBLE)) AS median_abs_diff,
                  CAST(MAX(diff) AS DOUBLE) AS max_abs_diff, median(CAST(n_txn AS DOUBLE)) AS median_txn_count,
                  (SELECT COUNT(*) / COUNT(DISTINCT account_id) FROM stg_trans) AS avg_txn_count_all_accounts
           FROM gaps WHERE diff > 1""", "gaps", "stg_trans"),
    "unreconciled_accounts": query(
        "SELECT account_id, n_rows_last_day, CAST(diff AS DOUBLE) AS diff, n_txn FROM gaps WHERE diff > 1", "gaps"),
    "raw_row_counts": query(
        " UNION ALL ".join(f"SELECT 'raw_{name}' AS table_name, COUNT(*) AS rows FROM raw_{name}" for name in RAW_QUERIES),
        *(f"raw_{name}" for name in RAW_QUERIES)),
    "balance_gaps": query("SELECT account_id, n_rows_last_day, CAST(diff AS DOUBLE) AS diff, n_txn FROM gaps", "gaps"),
    "insight_loan_book": query(
        """SELECT COUNT(*) AS loans, CAST(SUM(amount) AS DOUBLE) AS loan_amount,
                  100.0 * SUM(is_bad) / COUNT(*) AS bad_pct_by_count,
                  100.0 * CAST(SUM(amount * is_bad) AS DOUBLE) / CAST(SUM(amount) AS DOUBLE) AS bad_pct_by_amount
           FROM stg_loan""", "stg_loan"),
    "insight_bad_rate_by_region": query(_REGION_LOANS.format(amount=""), "mart_account_360"),
    "insight_bad_rate_range": query(
        f"""SELECT MIN(bad_loan_pct) AS lowest_pct, MAX(bad_loan_pct) AS highest_pct
            FROM ({_REGION_LOANS.format(amount="")})""", "mart_account_360"),
    "insight_bad_rate_by_duration": query(
        """SELECT duration_months, COUNT(*) AS loans, 100.0 * SUM(is_bad) / COUNT(*) AS bad_loan_pct
           FROM stg_loan GROUP BY duration_months""", "stg_loan"),
    "insight_bad_rate_by_overdraft": query(
        """SELECT CAST(ifnull(negative_months_1998, 0) > 0 AS INTEGER) AS overdrawn_1998, COUNT(*) AS loans,
                  CAST(SUM(loan_is_bad) AS BIGINT) AS bad_loans, 100.0 * SUM(loan_is_bad) / COUNT(*) AS bad_loan_pct
           FROM mart_account_360 WHERE loan_id IS NOT NULL GROUP BY 1""", "mart_account_360"),
    "insight_tiers_in_order": query("SELECT * FROM tiers", "tiers"),
    "insight_district_correlations": query(
        RHO_P.format(
            name="district_metric", count="districts", rho="spearman_rho",
            source=" UNION ALL ".join(_RHO.format(m=m) for m in ("unemployment_96", "avg_salary", "crimes_96"))),
        "scorecard"),
    "kpi_table": query(_KPI, "mart_account_360", "mart_account_month", "stg_loan", "dq_log"),
    "sheet_loans_by_region": query(
        _REGION_LOANS.format(amount="CAST(SUM(loan_amount) AS DOUBLE) AS loan_amount,"), "mart_account_360"),
    "sheet_watchlist_by_amount": query(
        f"""SELECT * REPLACE ({_iso('loan_date')}, {_d('amount')}, {_d('monthly_payment')}, {_d('balance_dec98')})
            FROM watchlist ORDER BY amount DESC, loan_id""", "watchlist"),
    "dash_balance_by_month_and_tier": query(
        "SELECT month, tier, CAST(SUM(total_balance) AS DOUBLE) AS total_balance FROM trend GROUP BY ALL", "trend"),
    "dash_flows_by_month": query(
        """SELECT month, CAST(SUM(credits) AS DOUBLE) AS credits, CAST(SUM(debits) AS DOUBLE) AS debits
           FROM trend GROUP BY month""", "trend"),
    "dash_flows_by_month_one_region": query(
        """SELECT month, CAST(SUM(credits) AS DOUBLE) AS credits, CAST(SUM(debits) AS DOUBLE) AS debits
           FROM trend WHERE region = 'EUROPE' GROUP BY month""", "trend"),
    "dash_bad_amount_rate_by_region": query(
        """SELECT region, CAST(SUM(loans) AS BIGINT) AS loans,
                  CAST(SUM(bad_amount) AS DOUBLE) / CAST(SUM(loan_amount) AS DOUBLE) AS bad_loan_share
           FROM portfolio GROUP BY region""", "portfolio"),
    "dash_bad_amount_rate_by_duration": query(
        """SELECT duration_months, CAST(SUM(loans) AS BIGINT) AS loans,
                  CAST(SUM(bad_amount) AS DOUBLE) / CAST(SUM(loan_amount) AS DOUBLE) AS bad_loan_share
           FROM portfolio GROUP BY duration_months""", "portfolio"),
    "dash_unemployment_and_bad_rate": query(
        f"SELECT district_id, district_name, {_d('unemployment_96')}, bad_loan_pct FROM scorecard", "scorecard"),
    "dash_balance_growth": query(
        """SELECT month, CAST(total AS DOUBLE) AS total_balance, CAST(before AS DOUBLE) AS previous,
                  CAST(total - before AS DOUBLE) / nullif(CAST(before AS DOUBLE), 0) AS mom_change
           FROM (SELECT month, total, lag(total) OVER (ORDER BY month) AS before
                 FROM (SELECT month, SUM(total_balance) AS total FROM trend GROUP BY month))""", "trend"),
}

BANK_SQL["registered_views"] = query(
    """SELECT 'vw_balance_trend_monthly' AS view, COUNT(*) AS rows FROM trend
       UNION ALL SELECT 'vw_tier_summary', COUNT(*) FROM tiers
       UNION ALL SELECT 'vw_cashflow_monthly', COUNT(*) FROM (
           SELECT DISTINCT strftime(txn_date, '%Y-%m'), txn_type, operation, k_symbol FROM stg_trans)
       UNION ALL SELECT 'vw_loan_portfolio', COUNT(*) FROM portfolio
       UNION ALL SELECT 'vw_loan_watchlist', COUNT(*) FROM watchlist
       UNION ALL SELECT 'vw_district_scorecard', COUNT(*) FROM scorecard
       UNION ALL SELECT 'vw_card_summary', COUNT(*) FROM (SELECT DISTINCT top_card, tier FROM mart_account_360)
       UNION ALL SELECT 'vw_standing_orders', COUNT(*) FROM (SELECT DISTINCT purpose FROM stg_order)""",
    "trend", "tiers", "stg_trans", "portfolio", "watchlist", "scorecard", "mart_account_360", "stg_order")

BANK_SQL["mart_account_month_appended"] = BANK_SQL["mart_account_month"]
