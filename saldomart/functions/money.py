"""Amounts, rates and the home / foreign split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from saldomart.schemas import MONEY, RATE, TOTAL


def to_home_currency(amount: Column, rate: Column, is_home: Column) -> Column:
    """``amount`` in home currency, as decimal(38,8). The home currency has rate 1."""
    applied = F.when(is_home, F.lit(1).cast(RATE)).otherwise(rate.cast(RATE))
    return amount.cast(TOTAL) * applied


def to_cents(amount: Column) -> Column:
    """A MONEY amount as a whole number. Spark adds longs in place, wide decimals it does not."""
    return (amount.cast(MONEY) * 100).cast("long")


def from_cents(cents: Column) -> Column:
    """The inverse of ``to_cents``, wide enough for sums."""
    return (cents.cast("decimal(23,0)") * F.lit(0.01).cast("decimal(2,2)")).cast(TOTAL)


def currency_bucket(is_home: Column) -> Column:
    """``rub`` for home-currency accounts, ``val`` for all others."""
    return F.when(is_home, F.lit("rub")).otherwise(F.lit("val"))


def round_money(amount: Column) -> Column:
    """Half-up to two decimals. Used once, on the published figure."""
    return F.round(amount, 2)
