"""Longest and median task of queries over tables in which one key holds a third of all rows.

``python skew_check.py [rows]`` makes the tables (default 4 million rows), runs the queries on
``local[$BENCH_CPUS]`` and prints, for the slowest stage of each that reads a shuffle, its
tasks' longest and median seconds, from Spark's event log.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
from collections import defaultdict
from datetime import date
from pathlib import Path
from statistics import median

from pyspark.sql import functions as F

from saldomart import schemas
from saldomart.operators.duplicates import find_duplicates, remove_duplicates
from saldomart.operators.merge import upsert
from saldomart.operators.periods import find_period_gaps
from saldomart.operators.rates import day_rates
from saldomart.plans.turnover import account_turnover
from saldomart.session import local_session

HOT = 0.34
PERIOD = date(2018, 1, 1), date(2018, 12, 31)


def tables(spark, rows: int):
    third = F.rand(1) < HOT
    ids = spark.range(0, rows, 1, 64)
    postings = ids.select(
        F.col("id").alias("posting_id"),
        F.date_add(F.lit(PERIOD[0]), (F.rand(2) * 365).cast("int")).alias("on_date"),
        F.when(third, 0).otherwise(F.col("id") % 100_000).cast("long").alias("debit_account"),
        ((F.col("id") * 7) % 100_000).alias("credit_account"),
        (F.rand(3) * 1000).cast(schemas.MONEY).alias("amount"),
    )
    accounts = spark.range(100_000).select(
        F.col("id").alias("account_id"), F.lit(1).alias("currency_id"), F.lit("A").alias("characteristic"),
        F.lit("40502").alias("ledger2"), F.lit(date(2000, 1, 1)).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
    )
    currencies = spark.range(1).select(F.lit(1).alias("currency_id"), F.lit(True).alias("is_home"))
    rates = spark.createDataFrame([], schemas.EXCHANGE_RATES)
    clients = ids.select(
        F.when(F.rand(4) < HOT, 0).when(F.rand(5) < 0.5, 1).otherwise(F.col("id")).alias("key"),
        (F.rand(6) * 1000).cast("int").alias("version"),
    )
    days = ids.select(
        F.when(F.rand(7) < HOT, 0).otherwise(F.col("id") % 50_000).alias("entity"),
        F.date_add(F.lit(PERIOD[0]), (F.rand(8) * 365).cast("int")).alias("on_date"),
    )
    return postings, accounts, currencies, rates, clients, days


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 4_000_000
    log = Path(tempfile.mkdtemp(prefix="skew-"))
    conf = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log}", "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false"}
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "skew", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    postings, accounts, currencies, rates, clients, days = tables(spark, rows)
    known = accounts.select("account_id", "ledger2")
    arriving = postings.select(F.col("debit_account").alias("account_id"), F.lit("x").alias("ledger2"))
    kept, removed = remove_duplicates(clients, ["key"], [F.desc("version")])
    queries = {
        "account_turnover": account_turnover(postings, accounts, day_rates(currencies, rates, *PERIOD), *PERIOD),
        "find_duplicates": find_duplicates(clients, ["key"]),
        "remove_duplicates": kept,
        "removed_duplicates": removed,
        "find_period_gaps": find_period_gaps(days, "entity", "on_date"),
        "upsert": upsert(known, arriving, ["account_id"], small_source=False),
    }
    for name, df in queries.items():
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()

    group_of: dict[int, str] = {}
    tasks: dict[int, list[float]] = defaultdict(list)
    shuffled: set[int] = set()
    for line in (x for file in log.iterdir() if file.is_file() for x in file.open(errors="replace")):
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart":
            group = event.get("Properties", {}).get("spark.jobGroup.id")
            group_of |= {stage: group for stage in event["Stage IDs"] if group}
        elif event["Event"] == "SparkListenerTaskEnd" and "Task Metrics" in event:
            metrics = event["Task Metrics"]
            tasks[event["Stage ID"]].append(metrics["Executor Run Time"] / 1000)
            if metrics["Shuffle Read Metrics"]["Total Records Read"]:
                shuffled.add(event["Stage ID"])
    for name in queries:
        stages = [s for s in shuffled if group_of.get(s) == name]
        if stages:
            slowest = max(stages, key=lambda s: max(tasks[s]))
            print(f"{name}: longest {max(tasks[slowest]):.2f} s, median {median(tasks[slowest]):.2f} s")


if __name__ == "__main__":
    main()
