from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bank import EUR, HOME, JAN, RATES, USD, d, table
from saldomart.functions.money import currency_bucket, round_money, to_home_currency
from saldomart.operators.rates import InvertedRate, OverlappingRates, day_rates, rate_as_of


def test_day_rates(spark):
    rows = day_rates(table(spark, "currencies"), table(spark, "exchange_rates"), *JAN).collect()
    by_pair = {(r["currency_id"], r["on_date"]): (r["rate"], r["is_home"]) for r in rows}
    assert len(rows) == len(by_pair) == 62
    assert by_pair[HOME, d(5)] == (Decimal("1.000000"), True)
    assert by_pair[USD, d(15)] == (Decimal("57.123456"), False)
    assert by_pair[USD, d(16)] == (Decimal("60.000000"), False)
    assert (EUR, d(5)) not in by_pair


def test_home_currency_ignores_rates(spark):
    rates = table(spark, "exchange_rates", [*RATES, (HOME, d(1), d(31), Decimal("2.000000"))])
    rows = day_rates(table(spark, "currencies"), rates, *JAN).filter(F.col("currency_id") == HOME).collect()
    assert {r["rate"] for r in rows} == {Decimal("1.000000")} and len(rows) == 31


@pytest.mark.parametrize("clash", [(d(15), d(15)), (date(2017, 1, 1), date(2019, 1, 1)), (d(20), d(21))])
def test_overlapping_rates_are_refused(spark, clash):
    rates = table(spark, "exchange_rates", [*RATES, (USD, *clash, Decimal("1.000000"))])
    with pytest.raises(OverlappingRates):
        day_rates(table(spark, "currencies"), rates, *JAN)
    with pytest.raises(OverlappingRates):
        rate_as_of(spark.createDataFrame([(USD, d(1))], "currency_id int, on_date date"), rates, "on_date")


@pytest.mark.parametrize("broadcast_rates", [None, True, False])
def test_rate_as_of(spark, broadcast_rates):
    days = [(USD, d(15)), (USD, d(16)), (USD, d(1, 4)), (USD, date(2017, 11, 30)), (EUR, d(1)), (USD, None)]
    df = spark.createDataFrame(days, "currency_id int, on_date date")
    rated = rate_as_of(df, table(spark, "exchange_rates"), "on_date", broadcast_rates)
    assert {tuple(r) for r in rated.collect()} == {
        (USD, d(15), Decimal("57.123456")), (USD, d(16), Decimal("60.000000")),
        (USD, d(1, 4), None), (USD, date(2017, 11, 30), None), (EUR, d(1), None), (USD, None, None),
    }


def test_no_digit_is_lost(spark):
    df = spark.sql("SELECT 9999999999999999.99BD AS amount, 57.123456BD AS rate, false AS home, true AS yes")
    row = df.select(
        to_home_currency(F.col("amount"), F.col("rate"), F.col("home")),
        to_home_currency(F.col("amount"), F.col("rate"), F.col("yes")),
        currency_bucket(F.col("home")),
        currency_bucket(F.col("yes")),
    ).first()
    assert row[0] == Decimal("571234559999999999.42876544")
    assert row[1] == Decimal("9999999999999999.99")
    assert (row[2], row[3]) == ("val", "rub")


def test_half_up(spark):
    row = spark.sql("SELECT 1.005BD AS a, -1.005BD AS b").select(round_money(F.col("a")), round_money(F.col("b"))).first()
    assert row == (Decimal("1.01"), Decimal("-1.01"))


@pytest.mark.parametrize("broadcast_rates", [None, True, False])
def test_a_rate_without_an_end_holds_on(spark, broadcast_rates):
    rates = table(spark, "exchange_rates", [(USD, d(10), None, Decimal("57.000000")), (EUR, None, d(9), Decimal("60.000000"))])
    days = [(USD, d(9)), (USD, d(15, 2)), (EUR, date(2001, 1, 1)), (EUR, d(10))]
    df = spark.createDataFrame(days, "currency_id int, on_date date")
    found = {tuple(r)[:2]: r["rate"] for r in rate_as_of(df, rates, "on_date", broadcast_rates).collect()}
    assert found == dict(zip(days, [None, Decimal("57.000000"), Decimal("60.000000"), None]))
    by_day = day_rates(table(spark, "currencies"), rates, *JAN).filter(F.col("currency_id") == USD)
    assert by_day.count() == 22


def test_overlaps_behind_an_open_end_and_inverted_rates_are_refused(spark):
    df = spark.createDataFrame([(USD, d(1))], "currency_id int, on_date date")
    for rows, error in (
        ([(USD, d(1), None, Decimal(1)), (USD, d(5, 3), d(6, 3), Decimal(2))], OverlappingRates),
        ([(USD, d(9), d(3), Decimal(1))], InvertedRate),
    ):
        rates = table(spark, "exchange_rates", rows)
        with pytest.raises(error):
            rate_as_of(df, rates, "on_date")
        with pytest.raises(error):
            day_rates(table(spark, "currencies"), rates, *JAN)
