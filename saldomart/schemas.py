"""Types and table schemas. Nothing in this package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# A product of TOTAL and RATE is decimal(38,8): no digit of the scale is lost.
MONEY = T.DecimalType(18, 2)
TOTAL = T.DecimalType(25, 2)
RATE = T.DecimalType(12, 6)
HOME = T.DecimalType(38, 8)


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# The six tables of the first load.
ACCOUNTS = _table(
    ("account_id", T.LongType()),
    ("currency_id", T.IntegerType()),
    ("characteristic", T.StringType()),
    ("ledger2", T.StringType()),
    ("valid_from", T.DateType()),
    ("valid_to", T.DateType()),
)
OPENING_BALANCES = _table(
    ("account_id", T.LongType()),
    ("on_date", T.DateType()),
    ("balance", MONEY),
)
CURRENCIES = _table(("currency_id", T.IntegerType()), ("is_home", T.BooleanType()))
EXCHANGE_RATES = _table(
    ("currency_id", T.IntegerType()),
    ("date_from", T.DateType()),
    ("date_to", T.DateType()),
    ("rate", RATE),
)
LEDGER_ACCOUNTS = _table(("ledger2", T.StringType()), ("name", T.StringType()))
POSTINGS = _table(
    ("posting_id", T.LongType()),
    ("on_date", T.DateType()),
    ("debit_account", T.LongType()),
    ("credit_account", T.LongType()),
    ("amount", MONEY),
)

# The daily marts.
ACCOUNT_TURNOVER = _table(
    ("on_date", T.DateType()),
    ("account_id", T.LongType()),
    ("debit", TOTAL),
    ("credit", TOTAL),
    ("debit_home", HOME),
    ("credit_home", HOME),
)
ACCOUNT_BALANCE = _table(
    ("on_date", T.DateType()),
    ("account_id", T.LongType()),
    ("balance", TOTAL),
    ("balance_home", HOME),
)

ETL_LOG = _table(
    ("task", T.StringType()),
    ("started_at", T.TimestampType()),
    ("ended_at", T.TimestampType()),
    ("rows_affected", T.LongType()),
    ("status", T.StringType()),
    ("error_text", T.StringType()),
)
