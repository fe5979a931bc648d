"""Period report by second-order balance account, home and foreign currency apart."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldomart.functions.money import currency_bucket, round_money
from saldomart.operators.calendar import valid_accounts

_FIGURES = ("balance_in", "turn_deb", "turn_cre", "balance_out")


def form_101(
    balance: DataFrame,
    turnover: DataFrame,
    accounts: DataFrame,
    currencies: DataFrame,
    ledger: DataFrame,
    date_from: date,
    date_to: date,
) -> DataFrame:
    """Opening balance, turnovers and closing balance per second-order account and kind.

    All figures are in home currency. Opening is the day before the period, closing its
    last day. An account whose validity ends inside the period leaves with the balance of
    its last valid day as closing balance, and is not in later reports; so opening and
    turnovers make up the closing balance of every account in home currency. ``balance``
    holds these days. Both marts are summed per account first; accounts are joined once.
    """
    day_before = F.lit(date_from - timedelta(days=1))
    last_day = F.lit(date_to)
    nothing = F.lit(None).cast("decimal(38,8)")
    held = valid_accounts(accounts, date_from - timedelta(days=1), date_to)
    closed = held.filter(F.col("last_day") < last_day).select("account_id", F.col("last_day").alias("on_date"))

    def balances(rows: DataFrame, opening: Column, closing: Column) -> DataFrame:
        return rows.select(
            "account_id", opening.alias("balance_in"), nothing.alias("turn_deb"), nothing.alias("turn_cre"),
            closing.alias("balance_out"),
        )

    amount = F.col("balance_home")
    opening = balances(balance.filter(F.col("on_date") == day_before), amount, nothing)
    closing = balances(balance.filter(F.col("on_date") == last_day), nothing, amount)
    leaving = balances(balance.join(closed, ["account_id", "on_date"]), nothing, amount)
    turnovers = turnover.filter(F.col("on_date").between(F.lit(date_from), last_day)).select(
        "account_id",
        nothing.alias("balance_in"),
        F.col("debit_home").alias("turn_deb"),
        F.col("credit_home").alias("turn_cre"),
        nothing.alias("balance_out"),
    )
    rows = opening.unionByName(closing).unionByName(leaving).unionByName(turnovers)
    per_account = rows.groupBy("account_id").agg(*[F.sum(f).alias(f) for f in _FIGURES])
    home = currencies.filter("is_home").select("currency_id", F.lit(True).alias("is_home"))
    reported = (
        held.join(per_account, "account_id", "left")
        .join(home, "currency_id", "left")
        .withColumn("_bucket", currency_bucket(F.coalesce("is_home", F.lit(False))))
    )

    def figure(name: str, bucket: str) -> Column:
        amount = F.col(name) if bucket == "total" else F.when(F.col("_bucket") == bucket, F.col(name))
        return round_money(F.coalesce(F.sum(amount), F.lit(0))).alias(f"{name}_{bucket}")

    figures = [figure(name, bucket) for name in _FIGURES for bucket in ("rub", "val")]
    grouped = reported.groupBy("ledger2", "characteristic").agg(*figures)
    totals = {f"{n}_total": F.col(f"{n}_rub") + F.col(f"{n}_val") for n in _FIGURES}
    ordered = [f"{n}_{b}" for n in _FIGURES for b in ("rub", "val", "total")]
    # A code that the ledger lists twice must not double a row of the report.
    names = ledger.groupBy("ledger2").agg(
        F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("the ledger lists a code twice")).cast("string"))
        .otherwise(F.max("name"))
        .alias("name")
    )
    return grouped.withColumns(totals).join(names, "ledger2", "left").select(
        F.lit(date_from).alias("date_from"),
        F.lit(date_to).alias("date_to"),
        "ledger2",
        "name",
        "characteristic",
        *ordered,
    )
