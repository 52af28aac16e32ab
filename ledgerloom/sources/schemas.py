"""Column types of the eight raw bank tables and of the check log.

Fixed values: names and types follow the published layout of the source files.
"""

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_LONG, _INT, _TEXT = LongType(), IntegerType(), StringType()


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


RAW_SCHEMAS: dict[str, StructType] = {
    "account": _table(account_id=_LONG, district_id=_LONG, frequency=_TEXT, date=_INT),
    "client": _table(client_id=_LONG, birth_number=_INT, district_id=_LONG),
    "disp": _table(disp_id=_LONG, client_id=_LONG, account_id=_LONG, type=_TEXT),
    "card": _table(card_id=_LONG, disp_id=_LONG, type=_TEXT, issued=_TEXT),
    "loan": _table(
        loan_id=_LONG,
        account_id=_LONG,
        date=_INT,
        amount=DecimalType(18, 0),
        duration=_INT,
        payments=DecimalType(18, 2),
        status=_TEXT,
    ),
    "order": _table(
        order_id=_LONG,
        account_id=_LONG,
        bank_to=_TEXT,
        account_to=_TEXT,
        amount=DecimalType(18, 2),
        k_symbol=_TEXT,
    ),
    "district": _table(
        A1=_LONG,
        A2=_TEXT,
        A3=_TEXT,
        A4=_INT,
        A5=_INT,
        A6=_INT,
        A7=_INT,
        A8=_INT,
        A9=_INT,
        A10=DecimalType(5, 1),
        A11=_INT,
        A12=_TEXT,
        A13=DecimalType(5, 2),
        A14=_INT,
        A15=_TEXT,
        A16=_INT,
    ),
    "trans": _table(
        trans_id=_LONG,
        account_id=_LONG,
        date=_INT,
        type=_TEXT,
        operation=_TEXT,
        amount=DecimalType(18, 2),
        balance=DecimalType(18, 2),
        k_symbol=_TEXT,
        bank=_TEXT,
        account=_TEXT,
    ),
}

CHECK_LOG_SCHEMA = _table(
    run_ts=TimestampType(),
    check_name=_TEXT,
    layer=_TEXT,
    severity=_TEXT,
    failed_rows=_LONG,
    status=_TEXT,
    description=_TEXT,
)

CAUSES_SCHEMA = _table(check_name=_TEXT, likely_cause=_TEXT, treatment=_TEXT)
