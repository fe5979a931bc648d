"""Bank tables as views over a star schema of orders, customers, nations and events.

The star schema holds no bank data, so each bank table is derived from whole tables of
it: customers are accounts, nations are currencies, order lines are postings.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saldomart.schemas import MONEY, RATE

# The days over which rates are given, and the account validity.
RATES_FROM, RATES_TO = date(1994, 12, 1), date(2001, 12, 31)
VALID_FROM, VALID_TO = date(1990, 1, 1), date(2050, 12, 31)


@dataclass(frozen=True)
class BankViews:
    spark: SparkSession
    folder: str
    _tables: dict[str, DataFrame] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @property
    def accounts(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("account_id"),
            F.col("c_nationkey").alias("currency_id"),
            F.when(F.col("c_custkey") % 2 == 0, "A").otherwise("P").alias("characteristic"),
            F.col("c_mktsegment").alias("ledger2"),
            F.lit(VALID_FROM).alias("valid_from"),
            F.lit(VALID_TO).alias("valid_to"),
        )

    def opening_balances(self, on_date: date) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("account_id"),
            F.lit(on_date).alias("on_date"),
            F.col("c_acctbal").cast(MONEY).alias("balance"),
        )

    @property
    def currencies(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("currency_id"), (F.col("n_regionkey") == 0).alias("is_home")
        )

    @property
    def exchange_rates(self) -> DataFrame:
        months = F.sequence(F.lit(RATES_FROM), F.lit(RATES_TO), F.expr("interval 1 month"))
        rate = (F.col("n_nationkey") + 1) * F.lit(0.5).cast(RATE) + F.month("date_from") * F.lit(0.01).cast(RATE)
        return (
            self.table("nation")
            .filter("n_regionkey <> 0")
            .select("n_nationkey", F.explode(months).alias("date_from"))
            .select(
                F.col("n_nationkey").alias("currency_id"),
                "date_from",
                F.last_day("date_from").alias("date_to"),
                rate.cast(RATE).alias("rate"),
            )
        )

    @property
    def ledger_accounts(self) -> DataFrame:
        return (
            self.table("customer")
            .select(F.col("c_mktsegment").alias("ledger2"))
            .distinct()
            .withColumn("name", F.initcap("ledger2"))
        )

    @property
    def postings(self) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        lines = self.table("lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
        return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
            F.to_date("o_orderdate").alias("on_date"),
            F.col("o_custkey").alias("debit_account"),
            F.col("l_suppkey").alias("credit_account"),
            F.col("l_extendedprice").cast(MONEY).alias("amount"),
        )

    @property
    def clients(self) -> DataFrame:
        return self.table("documents").select("doc_id", "text")

    @property
    def user_days(self) -> DataFrame:
        return (
            self.table("events")
            .groupBy("user_id", F.to_date("ts").alias("on_date"))
            .agg(F.sum(F.col("value").cast(MONEY)).cast(MONEY).alias("turnover"))
        )

    @property
    def balance_turnover(self) -> DataFrame:
        """Daily in- and out-sums per user, some in-sums 10 too high."""
        history = Window.partitionBy("user_id").orderBy("on_date")
        running = F.sum("turnover").over(history.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        wrong = (F.col("user_id") % 7 == 0) & (F.dayofmonth("on_date") % 3 == 0)
        in_sum = F.col("account_out_sum") - F.col("turnover") + F.when(wrong, 10).otherwise(0)
        return (
            self.user_days.withColumn("account_out_sum", running.cast(MONEY))
            .withColumn("account_in_sum", in_sum.cast(MONEY))
            .select(F.col("user_id").alias("account_id"), "on_date", "account_in_sum", "account_out_sum")
        )
