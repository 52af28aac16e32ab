"""Fixed values of the bank data set: codes, labels, names and texts that appear in results.

They have to equal those of the published source files and reports for results to be comparable.
"""

# Reporting calendar.
FIRST_MONTH = "1993-01-01"
LAST_MONTH = "1998-12-01"
LAST_MONTH_TEXT = "1998-12"
REPORT_YEAR = 1998
REPORT_YEAR_FROM = "1998-01"

# Transaction codes.
CREDIT = "PRIJEM"
DEBIT = "VYDAJ"
LEGACY_DEBIT = "VYBER"
CASH_WITHDRAWAL = "VYBER"
TRANSFER_OPERATIONS = ("PREVOD NA UCET", "PREVOD Z UCTU")
INTEREST = "UROK"
NO_OPERATION = "NOT_APPLICABLE"
NO_SYMBOL = "NONE"
DUPLICATE_KEY = ["account_id", "date", "type", "operation", "amount", "balance", "k_symbol"]
DUPLICATE_REASON = "DUPLICATE_POSTING"

# Decoded labels.
FREQUENCIES = {
    "POPLATEK MESICNE": "Monthly statement",
    "POPLATEK TYDNE": "Weekly statement",
    "POPLATEK PO OBRATU": "Statement after transaction",
}
UNKNOWN_FREQUENCY = "Unknown"
LOAN_STATUS = {
    "A": "Finished, paid",
    "B": "Finished, unpaid",
    "C": "Running, OK",
    "D": "Running, in debt",
}
BAD_STATUS = ("B", "D")
PURPOSES = {
    "SIPO": "Household",
    "POJISTNE": "Insurance",
    "LEASING": "Leasing",
    "UVER": "Loan payment",
}
OTHER_PURPOSE = "Unspecified"
OWNER = "OWNER"
CARD_RANKS = {"gold": 3, "classic": 2, "junior": 1}
NO_CARD = "no card"
TIERS = ("Premium", "Standard", "Basic")
OVERDRAWN, LOW_COVER, COVERED = "Overdrawn", "Low cover", "OK"
COVER_PAYMENTS = 3

# Tolerances and limits.
RECONCILIATION_TOLERANCE = 1.0
PAYMENT_TOLERANCE = 0.01
MIN_LOANS_PER_DISTRICT = 5
DISTRICT_METRICS = ["unemployment_96", "avg_salary", "crimes_96"]

# Check log texts by check name.
CHECK_TEXTS = {
    "DISTRICT_MISSING_VALUE": "District rows with ? placeholders in unemployment_95 / crimes_95",
    "TXN_SYMBOL_INCONSISTENT_ENCODING": "k_symbol uses a single space for none while other rows use NULL",
    "TXN_LEGACY_TYPE_CODE": "type=VYBER duplicates the withdrawal code VYDAJ",
    "TXN_ZERO_AMOUNT": "Transactions with amount = 0",
    "TXN_DUPLICATE_POSTING": "Same account/date/type/amount/balance/symbol posted under different trans_id",
    "TRANSFER_MISSING_COUNTERPARTY": "Transfer without partner bank or account",
    "TXN_NULL_OPERATION_UNEXPLAINED": "Null operation on rows that are not interest postings",
    "NEGATIVE_BALANCE_TXNS": "Transactions leaving the account with a negative reported balance",
    "BALANCE_RECON_ACCOUNT": "Accounts where summed signed flows differ from last reported balance by more than 1.0",
    "FK_DISP_CLIENT": "disp rows whose client is missing",
    "FK_DISP_ACCOUNT": "disp rows whose account is missing",
    "FK_LOAN_ACCOUNT": "loans whose account is missing",
    "FK_TRANS_ACCOUNT": "transactions whose account is missing",
    "FK_CARD_DISP": "cards whose disposition is missing",
    "FK_CLIENT_DISTRICT": "clients whose district is missing",
    "ACCOUNT_WITHOUT_OWNER": "Accounts with no OWNER disposition",
    "ACCOUNT_MULTIPLE_OWNERS": "Accounts with more than one OWNER",
    "LOAN_PAYMENT_ARITHMETIC": "Loans where payments x duration differs from amount by >1%",
    "LOAN_BEFORE_ACCOUNT_OPEN": "Loans dated before the account was opened",
    "CARD_BEFORE_ACCOUNT_OPEN": "Cards issued before the account was opened",
    "TXN_BEFORE_ACCOUNT_OPEN": "Transactions dated before the account was opened",
    "CLIENT_INVALID_BIRTH_DATE": "Clients whose derived birth date is not a valid date",
    "LOAN_MULTIPLE_PER_ACCOUNT": "Accounts with more than one loan",
    "RECON_RAW_VS_STG_TRANS": "raw rows must equal staging + rejected rows",
    "RECON_ACCOUNT_MONTH_SPINE": "Every account must appear in the account-360 mart",
}

# KPI names in report order.
KPI_NAMES = [
    "Data as of",
    "Accounts",
    "Total balance Dec-98 (reconstructed)",
    "Net cash flow 1998",
    "Loans",
    "Loan book (amount)",
    "Bad loans % (by amount)",
    "Accounts overdrawn in 1998",
    "DQ checks failed",
    "DQ warnings",
]
