"""Debit and credit turnover per account and day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldomart.functions.money import from_cents, to_cents, to_home_currency
from saldomart.functions.sizes import never_broadcast
from saldomart.operators.calendar import valid_accounts
from saldomart.operators.rates import MissingRate


class UnbookedMovements(ValueError):
    """Postings name an account that is not known, or not valid on their day."""


def account_movements(postings: DataFrame, date_from: date, date_to: date) -> DataFrame:
    """``debit`` and ``credit`` per account and day, in account currency.

    Every posting is one leg on its debit and one on its credit account. The legs are
    summed before the shuffle, so a busy account arrives as one row per task and day. A
    posting without an amount is an error.
    """
    on_date = F.col("on_date").cast("string")
    no_amount = F.raise_error(F.concat(F.lit("posting without an amount on "), on_date)).cast("long")
    two_sides = F.stack(
        F.lit(2), F.lit(True), F.col("debit_account"), F.lit(False), F.col("credit_account")
    ).alias("is_debit", "account_id")
    legs = (
        postings.filter(F.col("on_date").between(F.lit(date_from), F.lit(date_to)))
        .withColumn("_cents", F.when(F.col("amount").isNull(), no_amount).otherwise(to_cents(F.col("amount"))))
        .select("on_date", "_cents", two_sides)
    )

    def total(condition: Column) -> Column:
        return from_cents(F.sum(F.when(condition, F.col("_cents")).otherwise(0)))

    return legs.groupBy("account_id", "on_date").agg(
        total(F.col("is_debit")).alias("debit"), total(~F.col("is_debit")).alias("credit")
    )


def placed_movements(movements: DataFrame, accounts: DataFrame) -> DataFrame:
    """Movements with the ``currency_id`` of their account and a ``reason`` where they cannot be booked.

    The reason is ``unknown account`` or ``outside validity``, and NULL on all others.
    """
    known = accounts.select("account_id", "currency_id", "valid_from", "valid_to", F.lit(True).alias("_known"))
    on_date = F.col("on_date")
    valid = on_date.between(F.coalesce("valid_from", on_date), F.coalesce("valid_to", on_date))
    reason = F.when(F.col("_known").isNull(), "unknown account").when(~valid, "outside validity")
    placed = movements.join(never_broadcast(known), "account_id", "left")
    return placed.select(*movements.columns, "currency_id", reason.alias("reason"))


def unbooked_movements(movements: DataFrame, accounts: DataFrame) -> DataFrame:
    """Movements that turnover and balance leave out, with the reason."""
    return placed_movements(movements, accounts).filter("reason IS NOT NULL").drop("currency_id")


def require_rates(used: DataFrame, rates_by_day: DataFrame) -> None:
    """Raise with the list of currencies and days in ``used`` that lack a rate.

    ``used`` has currency_id and on_date. Jobs call this first, to report all gaps at once;
    the plans alone stop at the first. The list is bounded by currencies x days.
    """
    pair = ["currency_id", "on_date"]
    gaps = used.select(*pair).distinct().join(rates_by_day.select(*pair), pair, "left_anti")
    found = gaps.orderBy("on_date", "currency_id").collect()
    if found:
        pairs = ", ".join(f"({g['currency_id']}, {g['on_date']})" for g in found)
        raise MissingRate(f"no rate for {len(found)} pairs of currency and day: {pairs}")


def currency_days(accounts: DataFrame, date_from: date, date_to: date) -> DataFrame:
    """Currencies and the days of the period on which one of their accounts is valid.

    Accounts are reduced to the distinct intervals of their currency before days are listed.
    """
    intervals = valid_accounts(accounts, date_from, date_to).select("currency_id", "first_day", "last_day").distinct()
    days = F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day")))
    return intervals.select("currency_id", days.alias("on_date")).distinct()


def with_day_rate(df: DataFrame, rates_by_day: DataFrame, on_missing_rate: str = "error") -> DataFrame:
    """Attach ``rate`` and ``is_home`` by currency and day."""
    return filled_rates(df.join(rates_by_day, ["currency_id", "on_date"], "left"), "on_date", on_missing_rate)


def filled_rates(rated: DataFrame, day: str, on_missing_rate: str = "error") -> DataFrame:
    """``rate`` where it is NULL, by ``on_missing_rate``; ``is_home`` is false there."""
    if on_missing_rate not in ("error", "one"):
        raise ValueError(f"on_missing_rate {on_missing_rate!r} is not 'error' or 'one'")
    rate_type = rated.schema["rate"].dataType
    if on_missing_rate == "one":
        filler = F.lit(1).cast(rate_type)
    else:
        where = F.concat_ws(" on ", F.col("currency_id").cast("string"), F.col(day).cast("string"))
        filler = F.raise_error(F.concat(F.lit("no rate for currency "), where)).cast(rate_type)
    return rated.withColumn("rate", F.when(F.col("rate").isNull(), filler).otherwise(F.col("rate"))).withColumn(
        "is_home", F.coalesce("is_home", F.lit(False))
    )


def account_turnover(
    postings: DataFrame,
    accounts: DataFrame,
    rates_by_day: DataFrame,
    date_from: date,
    date_to: date,
    on_missing_rate: str = "error",
    on_unbooked: str = "error",
) -> DataFrame:
    """One row per account and day with a movement: account currency and home currency.

    ``rates_by_day`` comes from ``day_rates``. Accounts and rates are joined to the daily
    sums and not to the postings; a day has one rate, so the home value is the same.
    ``on_unbooked='skip'`` leaves out what ``unbooked_movements`` reports.
    """
    placed = placed_movements(account_movements(postings, date_from, date_to), accounts)
    return valued_turnover(booked(placed, on_unbooked), rates_by_day, on_missing_rate)


def booked(placed: DataFrame, on_unbooked: str = "error") -> DataFrame:
    """Movements without a reason against them. ``error`` stops at one with a reason."""
    if on_unbooked not in ("error", "skip"):
        raise ValueError(f"on_unbooked {on_unbooked!r} is not 'error' or 'skip'")
    if on_unbooked == "skip":
        return placed.filter("reason IS NULL")
    account = F.coalesce(F.col("account_id").cast("string"), F.lit("NULL"))
    on_date = F.col("on_date").cast("string")
    where = F.concat(F.lit("posting on "), F.col("reason"), F.lit(": "), account, F.lit(" on "), on_date)
    stop = F.when(F.col("reason").isNotNull(), F.raise_error(where).cast("int")).otherwise(F.col("currency_id"))
    return placed.withColumn("currency_id", stop)


def valued_turnover(movements: DataFrame, rates_by_day: DataFrame, on_missing_rate: str = "error") -> DataFrame:
    """Daily sums with their currency as rows of the turnover mart."""
    rated = with_day_rate(movements, rates_by_day, on_missing_rate)
    return rated.select(
        "on_date",
        "account_id",
        "debit",
        "credit",
        to_home_currency(F.col("debit"), F.col("rate"), F.col("is_home")).alias("debit_home"),
        to_home_currency(F.col("credit"), F.col("rate"), F.col("is_home")).alias("credit_home"),
    )
