"""Ledger analytics on Spark: staging, month-end balances, account profiles, quality checks, reports."""
