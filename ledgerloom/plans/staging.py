"""Raw tables to typed, decoded staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.codes import blank_to, decode_codes, flag, merge_code, placeholder_to_null, signed
from ledgerloom.functions.dates import birth_age, birth_date, birth_gender, parse_yymmdd, parse_yymmdd_prefix
from ledgerloom.operators.dedupe import Split, split_duplicates
from ledgerloom.plans import fixed_values as fixed

STAGED_TRANS = ["trans_id", "account_id", "txn_date", "txn_type", "operation", "amount", "signed_amount", "balance_reported", "k_symbol", "bank", "account"]
REJECTED_TRANS = ["trans_id", "account_id", "date", "type", "operation", "amount", "balance", "k_symbol", "reject_reason"]


def stage_district(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("A1").alias("district_id"),
        F.col("A2").alias("district_name"),
        F.col("A3").alias("region"),
        F.col("A4").alias("inhabitants"),
        F.col("A10").alias("urban_ratio_pct"),
        F.col("A11").alias("avg_salary"),
        placeholder_to_null(F.col("A12"), "double").alias("unemployment_95"),
        F.col("A13").alias("unemployment_96"),
        F.col("A14").alias("entrepreneurs_per_1000"),
        placeholder_to_null(F.col("A15"), "int").alias("crimes_95"),
        F.col("A16").alias("crimes_96"),
    )


def stage_account(raw: DataFrame) -> DataFrame:
    return raw.select(
        "account_id",
        "district_id",
        decode_codes(F.col("frequency"), fixed.FREQUENCIES, fixed.UNKNOWN_FREQUENCY).alias("statement_frequency"),
        parse_yymmdd(F.col("date")).alias("open_date"),
    )


def stage_client(raw: DataFrame) -> DataFrame:
    number = F.col("birth_number")
    return raw.select(
        "client_id",
        "district_id",
        birth_gender(number).alias("gender"),
        birth_date(number).alias("birth_date"),
        birth_age(number, fixed.REPORT_YEAR).alias("age_at_1998"),
    )


def stage_disp(raw: DataFrame) -> DataFrame:
    return raw.select("disp_id", "client_id", "account_id", F.lower("type").alias("disp_type"))


def stage_card(raw: DataFrame) -> DataFrame:
    return raw.select(
        "card_id", "disp_id", F.col("type").alias("card_type"), parse_yymmdd_prefix(F.col("issued")).alias("issued_date")
    )


def stage_loan(raw: DataFrame) -> DataFrame:
    return raw.select(
        "loan_id",
        "account_id",
        "amount",
        F.col("duration").alias("duration_months"),
        F.col("payments").alias("monthly_payment"),
        "status",
        decode_codes(F.col("status"), fixed.LOAN_STATUS).alias("status_desc"),
        flag(F.col("status").isin(*fixed.BAD_STATUS)).alias("is_bad"),
        parse_yymmdd(F.col("date")).alias("loan_date"),
    )


def stage_order(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "account_id",
        "amount",
        decode_codes(F.trim("k_symbol"), fixed.PURPOSES, fixed.OTHER_PURPOSE).alias("purpose"),
    )


def split_trans(raw: DataFrame) -> Split:
    """Raw transactions parted into first postings and repeats under another id."""
    return split_duplicates(raw, fixed.DUPLICATE_KEY, ["trans_id"])


def tagged_trans(split: Split) -> DataFrame:
    """Staged postings and rejected repeats as one table, told apart by its last column ``is_kept``.

    Columns that only one of them has are null in the other, which takes no room in Parquet.
    """
    kept = stage_trans(split.kept).withColumn("is_kept", F.lit(True))
    rejected = reject_trans(split.rejected).withColumn("is_kept", F.lit(False))
    tagged = kept.unionByName(rejected, allowMissingColumns=True)
    return tagged.select(*[c for c in tagged.columns if c != "is_kept"], "is_kept")


def kept_or_rejected(tagged: DataFrame, name: str) -> DataFrame:
    """``stg_trans`` or ``rej_trans`` out of the tagged table, of which it reads one folder."""
    kept = name == "stg_trans"
    return tagged.filter(F.col("is_kept") == kept).select(*(STAGED_TRANS if kept else REJECTED_TRANS))


def stage_trans(kept: DataFrame) -> DataFrame:
    kind, amount = F.col("type"), F.col("amount")
    return kept.select(
        "trans_id",
        "account_id",
        parse_yymmdd(F.col("date")).alias("txn_date"),
        merge_code(kind, fixed.LEGACY_DEBIT, fixed.DEBIT).alias("txn_type"),
        F.coalesce("operation", F.lit(fixed.NO_OPERATION)).alias("operation"),
        "amount",
        signed(kind, amount, fixed.CREDIT).alias("signed_amount"),
        F.col("balance").alias("balance_reported"),
        blank_to(F.col("k_symbol"), fixed.NO_SYMBOL).alias("k_symbol"),
        "bank",
        "account",
    )


def reject_trans(rejected: DataFrame) -> DataFrame:
    return rejected.select(
        "trans_id",
        "account_id",
        "date",
        "type",
        "operation",
        "amount",
        "balance",
        "k_symbol",
        F.lit(fixed.DUPLICATE_REASON).alias("reject_reason"),
    )
