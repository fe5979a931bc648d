"""Exchange rates by day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from saldomart.functions.sizes import BROADCAST_BYTES, broadcast_if_small

_ROW_BYTES = 80


class OverlappingRates(ValueError):
    """Two rates of one currency hold on the same day."""


class MissingRate(ValueError):
    """A foreign currency is used on a day that has no rate."""


class InvertedRate(ValueError):
    """A rate ends before it begins."""


LAST_DAY = date(9999, 12, 31)  # the end of a rate without one


def _ended(rates: DataFrame) -> DataFrame:
    """Rates as closed intervals. A rate without an end holds for good; one without a beginning always did."""
    return rates.select(
        "currency_id",
        F.coalesce("date_from", F.lit("0001-01-01").cast("date")).alias("date_from"),
        F.coalesce("date_to", F.lit(LAST_DAY)).alias("date_to"),
        "rate",
    )


def _last_before() -> Column:
    """The latest end among the earlier intervals of the same currency."""
    earlier = Window.partitionBy("currency_id").orderBy("date_from", "date_to")
    return F.max("date_to").over(earlier.rowsBetween(Window.unboundedPreceding, -1))


def _checks() -> list[Column]:
    """Aggregates over intervals with ``_last``: an inverted one, one that overlaps an earlier one, how many."""
    place = F.struct("currency_id", "date_from")
    return [
        F.min(F.when(F.col("date_to") < F.col("date_from"), place)).alias("inverted"),
        F.min(F.when(F.col("date_from") <= F.col("_last"), place)).alias("clash"),
        F.count(F.lit(1)).alias("intervals"),
    ]


def _refuse(found: Row) -> None:
    if found["inverted"]:
        currency, day = found["inverted"]
        raise InvertedRate(f"the rate of currency {currency} from {day} ends before it begins")
    if found["clash"]:
        currency, day = found["clash"]
        raise OverlappingRates(f"currency {currency} has two rates on {day}")


def _measure(intervals: DataFrame) -> int:
    """Number of intervals. Refuses inverted ones and those of a currency that overlap."""
    found = intervals.select("currency_id", "date_from", "date_to", _last_before().alias("_last")).agg(*_checks()).first()
    _refuse(found)
    return found["intervals"]


def day_rates(currencies: DataFrame, rates: DataFrame, date_from: date, date_to: date) -> DataFrame:
    """One row per currency and day: ``rate`` (1 for the home currency), ``is_home``.

    Holds days x currencies rows at most, whatever the number of postings, and is marked
    for broadcast once that number was found to be small; one job finds it and checks the
    intervals. A currency that is not listed counts as foreign. A day without a rate has no
    row.
    """
    first, last = F.lit(date_from), F.lit(date_to)
    home = currencies.filter("is_home").select("currency_id")
    foreign = _ended(rates).join(home, "currency_id", "left_anti")
    one = F.lit(1).cast(rates.schema["rate"].dataType)
    at_home = home.select(
        "currency_id", first.alias("date_from"), last.alias("date_to"), one.alias("rate"), F.lit(True).alias("is_home")
    )
    begins, ends = F.greatest("date_from", first), F.least("date_to", last)
    all_of_them = (
        foreign.withColumns({"is_home": F.lit(False), "_last": _last_before()})
        .unionByName(at_home.withColumn("_last", F.lit(None).cast("date")))
        .agg(*_checks(), F.sum(F.greatest(F.datediff(ends, begins) + 1, F.lit(0))).alias("days"))
        .first()
    )
    _refuse(all_of_them)
    clipped = foreign.select(
        "currency_id", begins.alias("date_from"), ends.alias("date_to"), "rate", F.lit(False).alias("is_home")
    ).filter("date_from <= date_to")
    every_day = F.explode(F.sequence("date_from", "date_to", F.expr("interval 1 day")))
    daily = clipped.unionByName(at_home).select("currency_id", every_day.alias("on_date"), "rate", "is_home")
    return F.broadcast(daily) if (all_of_them["days"] or 0) * _ROW_BYTES <= BROADCAST_BYTES else daily


def rate_runs(rates_by_day: DataFrame, currencies: DataFrame, date_from: date, date_to: date) -> DataFrame:
    """``rates_by_day`` as runs of days of one ``month`` that share a rate: ``rate_from``, ``rate_to``.

    Runs cover every day of the period for each of ``currencies``; those without a rate have
    NULL. Measured, and marked for broadcast if small.
    """
    listed = currencies.select("currency_id").filter(F.col("currency_id").isNotNull()).distinct()
    days = F.explode(F.sequence(F.lit(date_from), F.lit(date_to), F.expr("interval 1 day"))).alias("on_date")
    pair = ["currency_id", "on_date"]
    daily = listed.select("currency_id", days).join(rates_by_day, pair, "left")
    # A currency that is listed as home twice has two rows a day; each is a run of its own.
    daily = daily.withColumn("_copy", F.row_number().over(Window.partitionBy(*pair).orderBy("rate", "is_home")))
    alike = ["_copy", "month", "rate", "is_home"]
    place = F.row_number().over(Window.partitionBy("currency_id", *alike).orderBy("on_date"))
    runs = (
        daily.withColumn("month", F.trunc("on_date", "month"))
        .withColumn("_run", F.date_sub("on_date", place))
        .groupBy("currency_id", *alike, "_run")
        .agg(F.min("on_date").alias("rate_from"), F.max("on_date").alias("rate_to"))
    )
    return broadcast_if_small(runs.select("currency_id", "month", "rate_from", "rate_to", "rate", "is_home"))


def rate_as_of(
    df: DataFrame, rates: DataFrame, date_col: str, broadcast_rates: bool | None = None
) -> DataFrame:
    """``df`` with the ``rate`` of its ``currency_id`` that is valid on ``date_col``, or NULL.

    Rates that were measured to be small are broadcast. Beyond that, currency and month
    join as equal keys, so neither a currency nor a long history meets in one task.
    """
    narrow = _ended(rates)
    intervals = _measure(narrow)
    if broadcast_rates is None:
        broadcast_rates = intervals * _ROW_BYTES <= BROADCAST_BYTES
    left, day = df.alias("left"), F.col(f"left.{date_col}")
    valid = day.between(F.col("r.date_from"), F.col("r.date_to"))
    same = F.col("left.currency_id") == F.col("r.currency_id")
    if broadcast_rates:
        return left.join(F.broadcast(narrow).alias("r"), same & valid, "left").select("left.*", "r.rate")
    used = df.agg(F.min(date_col).alias("first"), F.max(date_col).alias("last")).first()
    first, last = F.lit(used["first"]).cast("date"), F.lit(used["last"]).cast("date")
    narrow = narrow.filter(F.col("date_from") <= last).filter(F.col("date_to") >= first)
    months = F.sequence(
        F.trunc(F.greatest("date_from", first), "month"),
        F.trunc(F.least("date_to", last), "month"),
        F.expr("interval 1 month"),
    )
    monthly = narrow.withColumn("_month", F.explode(months)).alias("r")
    by_month = same & (F.trunc(day, "month") == F.col("r._month")) & valid
    return left.join(monthly, by_month, "left").select("left.*", "r.rate")
