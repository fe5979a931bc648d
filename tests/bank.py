"""A small bank whose figures can be worked out by hand."""

from datetime import date
from decimal import Decimal

from saldomart.plans.jobs import INPUT_TABLES

HOME, USD, EUR = 1, 2, 3
JAN = (date(2018, 1, 1), date(2018, 1, 31))
BEFORE = date(2017, 12, 31)


def d(day, month=1):
    return date(2018, month, day)


ACCOUNTS = [
    (10, HOME, "A", "40502", date(2017, 1, 1), date(2050, 12, 31)),
    (11, HOME, "P", "40502", date(2017, 1, 1), None),
    (20, USD, "A", "30110", date(2017, 1, 1), date(2050, 12, 31)),
    (21, USD, "P", "30110", d(10), d(20)),
    (30, HOME, "A", "99999", date(2016, 1, 1), date(2017, 6, 1)),
]
OPENING = [(10, BEFORE, Decimal("100.00")), (11, BEFORE, Decimal("50.00")), (20, BEFORE, Decimal("10.00"))]
CURRENCIES = [(HOME, True), (USD, False), (EUR, False)]
RATES = [
    (USD, date(2017, 12, 1), d(15), Decimal("57.123456")),
    (USD, d(16), date(2018, 3, 31), Decimal("60.000000")),
]
LEDGER = [("40502", "Accounts"), ("30110", "Correspondents")]
POSTINGS = [
    (1, d(1), 10, 11, Decimal("5.00")),
    (2, d(1), 10, 11, Decimal("2.50")),
    (3, d(1), 11, 10, Decimal("1.00")),
    (4, d(15), 20, 21, Decimal("3.33")),
    (5, d(16), 20, 20, Decimal("4.00")),
    (6, d(31), 11, 10, Decimal("7.00")),
    (7, d(1, 2), 10, 20, Decimal("9.99")),
]
ROWS = {
    "accounts": ACCOUNTS,
    "opening_balances": OPENING,
    "currencies": CURRENCIES,
    "exchange_rates": RATES,
    "ledger_accounts": LEDGER,
    "postings": POSTINGS,
}


def table(spark, name, rows=None):
    return spark.createDataFrame(ROWS[name] if rows is None else rows, INPUT_TABLES[name].schema)


def tables(spark):
    return {name: table(spark, name) for name in ROWS}


def publish_inputs(spark, warehouse, **changed):
    for name in ROWS:
        warehouse.publish(table(spark, name, changed.get(name)), "ds", name)


