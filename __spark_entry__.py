"""

The bank tables are views over the test tables (``saldomart/sources/views.py``); the SQL
states the same views as common table expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldomart import schemas
from saldomart.functions.dates import chosen_formats, parse_dates, parse_dates_by_file
from saldomart.functions.money import currency_bucket, to_home_currency
from saldomart.operators.calendar import account_day_grid
from saldomart.operators.duplicates import DuplicateKeys, assert_unique, find_duplicates, remove_duplicates
from saldomart.operators.ledger import second_order_account
from saldomart.operators.merge import upsert
from saldomart.operators.periods import find_interval_gaps, find_period_gaps, missing_in_mart, missing_intervals
from saldomart.operators.rates import day_rates, rate_as_of
from saldomart.operators.repair import (
    find_mismatches,
    fix_in_sum,
    fix_out_sum,
    next_day,
    previous_day,
    rebuild_balance_turnover,
)
from saldomart.plans import jobs
from saldomart.plans.audit import compact_log, etl_log, run_logged
from saldomart.plans.balance import account_balance, balance_spans, with_movements
from saldomart.plans.form101 import form_101
from saldomart.plans.turnover import UnbookedMovements, account_movements, account_turnover
from saldomart.session import new_folder, remove_folder
from saldomart.sources.csv import IncompleteExport, export_csv, read_csv, read_csv_landing, read_manifest
from saldomart.sources.tables import Warehouse
from saldomart.sources.views import BankViews

JANUARY = (date(1997, 1, 1), date(1997, 1, 31))
TWO_MONTHS = (date(1997, 1, 1), date(1997, 2, 28))
BEFORE_JANUARY = date(1996, 12, 31)
HISTORY = (date(1995, 1, 1), date(2001, 12, 31))
BEFORE_HISTORY = date(1994, 12, 31)

Query = Callable[[SparkSession, str], DataFrame]

try:  # the training-data operators are a part that may be left out, or lack their libraries
    import corpus_pipeline
    from saldomart.llm.queries import ORACLE_SQL as LLM_SQL
    from saldomart.llm.queries import QUERIES as LLM_QUERIES
except ImportError:
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES = LLM_QUERIES | {"pipeline": corpus_pipeline.run}
    LLM_SQL = LLM_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})


def _doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the last step of a query that is compared."""
    return df.select(
        [
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, new_folder(spark, "warehouse"))


# Sources and sinks


def _landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders through CSV; the totals of urgent ones are not numbers."""
    total = F.when(F.col("o_orderpriority") == "1-URGENT", "unknown").otherwise(
        F.col("o_totalprice").cast(schemas.MONEY).cast("string")
    )
    text = BankViews(spark, sf_dir).table("orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), total.alias("total"), "o_orderpriority"
    )
    path = new_folder(spark, "csv")
    export_csv(text, path)
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("total", schemas.MONEY),
            T.StructField("o_orderpriority", T.StringType()),
        ]
    )
    good, rejects = read_csv_landing(spark, path, schema)
    return _doubles(good.unionByName(rejects, allowMissingColumns=True))


def _order_postings(views: BankViews) -> DataFrame:
    """A posting for each order."""
    return views.table("orders").select(
        F.col("o_orderkey").cast("long").alias("posting_id"),
        F.to_date("o_orderdate").alias("on_date"),
        F.col("o_custkey").cast("long").alias("debit_account"),
        (F.col("o_custkey") + 1).cast("long").alias("credit_account"),
        F.col("o_totalprice").cast(schemas.MONEY).alias("amount"),
    )


def _six_inputs(views: BankViews) -> dict[str, DataFrame]:
    """The six inputs as text, dates in four formats; some postings and openings cannot be read."""
    postings = _order_postings(views)
    formats = ("yyyy-MM-dd", "dd.MM.yyyy", "dd-MM-yyyy", "yyyyMMdd")

    def as_text(df: DataFrame, key: str) -> DataFrame:
        def shown(f: T.StructField):
            if not isinstance(f.dataType, T.DateType):
                return F.col(f.name).cast("string").alias(f.name)
            text = F.date_format(f.name, formats[0])
            for i, fmt in enumerate(formats[1:], 1):
                text = F.when(F.hash(key) % 4 == i, F.date_format(f.name, fmt)).otherwise(text)
            return text.alias(f.name)

        return df.select(*[shown(f) for f in df.schema.fields])

    amount = F.when(F.col("posting_id") % 90 == 1, None).otherwise(F.col("amount"))
    on_date = F.when(F.col("posting_id") % 90 == 2, "soon").when(F.col("posting_id") % 90 == 3, None)
    spoiled = as_text(postings, "posting_id").withColumns(
        {"amount": amount, "on_date": on_date.otherwise(F.col("on_date"))}
    )
    openings = views.opening_balances(BEFORE_HISTORY)
    return {
        "accounts": as_text(views.accounts, "account_id"),
        "opening_balances": as_text(openings, "account_id").withColumn(
            "balance", F.when(F.col("account_id").cast("long") % 50 == 7, "none").otherwise(F.col("balance"))
        ),
        "currencies": as_text(views.currencies, "currency_id"),
        "exchange_rates": as_text(views.exchange_rates, "date_from"),
        "ledger_accounts": as_text(views.ledger_accounts, "ledger2"),
        "postings": spoiled,
    }


def _rendered(rows: DataFrame, name: str, kind: str) -> DataFrame:
    """Rows of any table as one text each, to compare tables of several shapes."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in rows.columns]
    return rows.select(
        F.lit(name).alias("table_name"), F.lit(kind).alias("kind"), F.concat_ws("|", *parts).alias("row")
    )


def _load_six_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six inputs loaded as they are defined, the postings twice, and every reject."""
    warehouse, found = _warehouse(spark), []
    for name, df in _six_inputs(BankViews(spark, sf_dir)).items():
        path = new_folder(spark, "csv")
        export_csv(df.select(*jobs.INPUT_TABLES[name].schema.fieldNames()), path)
        jobs.load_csv(warehouse, name, path)
        if name == "opening_balances":
            jobs.load_csv(warehouse, name, path)
        found.append(_rendered(warehouse.read("ds", name), name, "row"))
        found.append(_rendered(warehouse.read("ds", f"{name}_rejects").select("reason"), name, "reject"))
    return reduce(DataFrame.unionByName, found)


def _moved_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings loaded, then some again with a date in another month."""
    warehouse, views = _warehouse(spark), BankViews(spark, sf_dir)
    orders = _order_postings(views)
    corrected = orders.filter("posting_id % 7 = 0").withColumn("on_date", F.add_months("on_date", 3))
    for rows in (orders, corrected):
        path = new_folder(spark, "csv")
        export_csv(rows, path)
        jobs.load_csv(warehouse, "postings", path)
    return _doubles(warehouse.read("ds", "postings"))


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, line breaks and quotes included, to CSV and into a new table."""
    documents, warehouse = BankViews(spark, sf_dir).table("documents"), _warehouse(spark)
    warehouse.publish(documents, "dm", "documents")
    path = new_folder(spark, "csv")
    jobs.export_mart(warehouse, "documents", path)
    jobs.import_csv_new_table(warehouse, path, documents.schema, "documents_again")
    return warehouse.read("dm", "documents_again")


def _reimport_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers exported, the CSV changed, and imported again."""
    warehouse = _warehouse(spark)
    customers = BankViews(spark, sf_dir).table("customer").select(
        "c_custkey", "c_nationkey", F.col("c_acctbal").cast(schemas.MONEY).alias("balance")
    )
    warehouse.publish(customers, "dm", "customers")
    nation = F.col("c_nationkey")
    edited = customers.filter(nation != 3).withColumn(
        "balance", F.when(nation == 5, F.col("balance") + 1).otherwise(F.col("balance")).cast(schemas.MONEY)
    )
    added = customers.filter(nation == 9).withColumn("c_custkey", -F.col("c_custkey"))
    path = new_folder(spark, "csv")
    export_csv(edited.unionByName(added), path)
    return jobs.reimport_csv(warehouse, path, customers.schema, "customers", ["c_custkey"])


def _checked_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export that lost a file and is refused, and the same one whole."""
    warehouse, path = _warehouse(spark), new_folder(spark, "csv")
    customers = BankViews(spark, sf_dir).table("customer").select("c_custkey", "c_name", "c_nationkey")
    warehouse.publish(customers.repartition(3, "c_custkey"), "dm", "customers")
    jobs.export_mart(warehouse, "customers", path)
    lost = sorted(read_manifest(spark, path)["files"])[0]
    remove_folder(spark, f"{path}/{lost}")
    try:
        jobs.import_csv_new_table(warehouse, path, customers.schema, "customers_again")
        refused = False
    except IncompleteExport:
        refused = True
    jobs.export_mart(warehouse, "customers", path)
    jobs.import_csv_new_table(warehouse, path, customers.schema, "customers_again")
    return warehouse.read("dm", "customers_again").withColumn("refused", F.lit(refused))


def _load_only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of three refreshes: one file, this and a second one, both again."""
    warehouse = _warehouse(spark)
    orders = BankViews(spark, sf_dir).table("orders").select("o_orderkey", "o_orderstatus")
    paths = [new_folder(spark, "csv"), new_folder(spark, "csv")]
    export_csv(orders.filter("o_orderstatus = 'F'").coalesce(1), paths[0])
    export_csv(orders.filter("o_orderstatus != 'F'").coalesce(1), paths[1])
    definition = jobs.InputTable(orders.schema, ("o_orderkey",))
    for known in (paths[:1], paths, paths):
        jobs.load_csv(warehouse, "orders", known, definition, only_new=True)
    n_rows = warehouse.read("ds", "orders").count()
    return etl_log(warehouse).select("task", "rows_affected", "status", F.lit(n_rows).cast("long").alias("rows_in_table"))


def _load_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, user_days = _warehouse(spark), BankViews(spark, sf_dir).user_days
    path = new_folder(spark, "csv")
    export_csv(user_days, path)
    jobs.load_snapshot(warehouse, "user_days", path, user_days.schema)
    return _doubles(warehouse.read("rd", "user_days"))


def _publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by rows computed from itself."""
    warehouse, views = _warehouse(spark), BankViews(spark, sf_dir)
    warehouse.publish(views.opening_balances(BEFORE_JANUARY), "ds", "opening_balances")
    raised = warehouse.read("ds", "opening_balances").withColumn(
        "balance", (F.col("balance") + 1).cast(schemas.MONEY)
    )
    warehouse.publish(raised, "ds", "opening_balances")
    return _doubles(warehouse.read("ds", "opening_balances"))


def _full_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, views = _warehouse(spark), BankViews(spark, sf_dir)
    warehouse.publish(views.user_days.filter(F.dayofmonth("on_date") % 4 != 0), "dm", "user_days")
    jobs.full_reload(warehouse, views.user_days, "user_days", ["user_id", "on_date"])
    return _doubles(warehouse.read("dm", "user_days"))


# Dates and upsert


def _parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text in four formats, and in one that is not accepted."""
    formats = ("yyyy-MM-dd", "dd.MM.yyyy", "dd-MM-yyyy", "yyyyMMdd")
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "dd.MM.yy"))
    for i, fmt in enumerate(formats):
        text = text.when(F.col("o_orderkey") % 4 == i, F.date_format("o_orderdate", fmt))
    rendered = BankViews(spark, sf_dir).table("orders").select("o_orderkey", text.alias("on_date"))
    parsed, rejects = parse_dates(rendered, ["on_date"])
    return parsed.withColumn("reason", F.lit(None).cast("string")).unionByName(
        rejects.withColumn("on_date", F.lit(None).cast("date"))
    )


_MANY_FORMATS = ("yyyy-MM-dd", "dd.MM.yyyy", "dd/MM/yyyy", "MM/dd/yyyy")


def _dates_of_files(views: BankViews) -> DataFrame:
    """Order dates as text, a priority for a file: day or month first, either, and two clear formats in one file."""
    priority, day = F.col("o_orderpriority"), F.to_date("o_orderdate")
    early = F.make_date(F.year(day), F.month(day), F.dayofmonth(day) % 12 + 1)
    text = (
        F.when(priority == "1-URGENT", F.date_format(day, "dd/MM/yyyy"))
        .when(priority == "2-HIGH", F.date_format(day, "MM/dd/yyyy"))
        .when(priority == "3-MEDIUM", F.date_format(early, "dd/MM/yyyy"))
        .when((priority == "5-LOW") & (F.col("o_orderkey") % 2 == 0), F.date_format(day, "dd.MM.yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    return views.table("orders").select("o_orderkey", "o_orderpriority", text.alias("on_date"))


def _chosen_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_formats(_dates_of_files(BankViews(spark, sf_dir)), ["on_date"], _MANY_FORMATS, "o_orderpriority")


def _dates_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dates of all files, and the texts that may be two dates."""
    rendered = _dates_of_files(BankViews(spark, sf_dir))
    parsed, rejects = parse_dates_by_file(rendered, ["on_date"], "o_orderpriority", _MANY_FORMATS)
    return parsed.withColumn("reason", F.lit(None).cast("string")).unionByName(
        rejects.withColumn("on_date", F.lit(None).cast("date"))
    )


def _upsert(small_source: bool | None) -> Query:
    """Orders known up to 1998 meet all orders from 1998 on."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = BankViews(spark, sf_dir).table("orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
        known = orders.filter("o_orderdate < '1999-01-01'").withColumn("o_orderstatus", F.lit("OLD"))
        arriving = orders.filter("o_orderdate >= '1998-01-01'")
        return upsert(known, arriving, ["o_orderkey"], ["o_orderdate"], small_source).select(
            "o_orderkey", "o_orderstatus", "action"
        )

    return query


# Marts


def _rate_as_of(broadcast_rates: bool | None) -> Query:
    """Every order in home currency at the rate of its day."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        views = BankViews(spark, sf_dir)
        orders = views.table("orders").select(
            "o_orderkey",
            F.col("o_custkey").alias("account_id"),
            F.to_date("o_orderdate").alias("on_date"),
            F.col("o_totalprice").cast(schemas.MONEY).alias("amount"),
        )
        placed = orders.join(views.accounts.select("account_id", "currency_id"), "account_id").join(
            views.currencies, "currency_id"
        )
        rated = rate_as_of(placed, views.exchange_rates, "on_date", broadcast_rates)
        home = to_home_currency(F.col("amount"), F.col("rate"), F.col("is_home"))
        return _doubles(rated.select("o_orderkey", "currency_id", "on_date", "rate", home.alias("amount_home")))

    return query


def _open_rates(broadcast_rates: bool | None) -> Query:
    """Rates without an end since July 1996, and an account per day that asks for them."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        views = BankViews(spark, sf_dir)
        last = F.col("date_from") == F.lit(date(1996, 7, 1))
        rates = views.exchange_rates.filter(F.col("date_from") <= F.lit(date(1996, 7, 1))).withColumn(
            "date_to", F.when(~last, F.col("date_to"))
        )
        orders = views.table("orders").select(
            "o_orderkey",
            (F.col("o_custkey") % 25).cast("int").alias("currency_id"),
            F.to_date("o_orderdate").alias("on_date"),
        )
        return _doubles(rate_as_of(orders, rates, "on_date", broadcast_rates))

    return query


def _second_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = BankViews(spark, sf_dir)
    return second_order_account(views.accounts, views.ledger_accounts).select("account_id", "ledger2", "name")


def _bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = BankViews(spark, sf_dir)
    return views.accounts.join(views.currencies, "currency_id").select(
        "account_id", currency_bucket(F.col("is_home")).alias("bucket")
    )


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return account_day_grid(BankViews(spark, sf_dir).accounts, *JANUARY)


def _turnover(period: tuple[date, date]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        v = BankViews(spark, sf_dir)
        rates_by_day = day_rates(v.currencies, v.exchange_rates, *period)
        return _doubles(account_turnover(v.postings, v.accounts, rates_by_day, *period))

    return query


def _balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = BankViews(spark, sf_dir)
    return _doubles(
        account_balance(
            v.opening_balances(BEFORE_JANUARY),
            account_movements(v.postings, *JANUARY),
            v.accounts,
            day_rates(v.currencies, v.exchange_rates, *JANUARY),
            *JANUARY,
        )
    )


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances over the whole history, one row per run of equal days."""
    v = BankViews(spark, sf_dir)
    movements = account_movements(v.postings, *HISTORY)
    spans = balance_spans(v.opening_balances(BEFORE_HISTORY), movements, v.accounts, *HISTORY)
    return _doubles(spans.select("account_id", "span_from", "span_to", "balance"))


def _loaded(spark: SparkSession, sf_dir: str, opening_day: date, changes: dict | None = None) -> Warehouse:
    """A warehouse whose DS layer holds the six inputs, postings by month."""
    views, warehouse = BankViews(spark, sf_dir), _warehouse(spark)
    inputs = {
        "accounts": views.accounts,
        "opening_balances": views.opening_balances(opening_day),
        "currencies": views.currencies,
        "exchange_rates": views.exchange_rates,
        "ledger_accounts": views.ledger_accounts,
    } | (changes or {})
    for name, rows in inputs.items():
        warehouse.publish(rows, "ds", name)
    postings = views.postings.withColumn("posting_id", F.monotonically_increasing_id())
    month = F.date_format("on_date", "yyyy-MM")
    warehouse.publish_periods(postings.select(*schemas.POSTINGS.fieldNames()), "ds", "postings", month)
    return warehouse


def _both_marts(warehouse: Warehouse) -> DataFrame:
    turnover = warehouse.read("dm", jobs.TURNOVER_MART)
    balance = warehouse.read("dm", jobs.BALANCE_MART, in_runs="on_date")
    return with_movements(_doubles(balance), _doubles(turnover))


def _calculate_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both marts for two months in a row, and the opening day."""
    warehouse = _loaded(spark, sf_dir, BEFORE_JANUARY)
    jobs.calculate_period(warehouse, *TWO_MONTHS)
    return _both_marts(warehouse)


def _calculate_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both marts for seven years in one plan each."""
    warehouse = _loaded(spark, sf_dir, BEFORE_HISTORY)
    jobs.calculate_period(warehouse, *HISTORY)
    return _both_marts(warehouse)


def _corrected_opening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """January calculated, its opening balances corrected, and January calculated again."""
    wrong = BankViews(spark, sf_dir).opening_balances(BEFORE_JANUARY)
    wrong = wrong.withColumn("balance", (F.col("balance") + 400).cast(schemas.MONEY))
    warehouse = _loaded(spark, sf_dir, BEFORE_JANUARY, {"opening_balances": wrong})
    jobs.calculate_period(warehouse, *JANUARY)
    warehouse.publish(BankViews(spark, sf_dir).opening_balances(BEFORE_JANUARY), "ds", "opening_balances")
    jobs.calculate_period(warehouse, *JANUARY)
    return _both_marts(warehouse)


def _corrected(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Two months, calculated from wrong openings and without some postings of the first.

    Then both are corrected, and only the first month is calculated again.
    """
    views = BankViews(spark, sf_dir)
    right = views.opening_balances(BEFORE_JANUARY)
    wrong = right.withColumn("balance", (F.col("balance") + 400).cast(schemas.MONEY))
    warehouse = _loaded(spark, sf_dir, BEFORE_JANUARY, {"opening_balances": wrong})
    january = warehouse.read("ds", "postings", ["1997-01"])
    warehouse.publish(january.filter("debit_account % 7 != 0"), "ds", "postings", "1997-01")
    jobs.calculate_period(warehouse, *JANUARY)
    jobs.calculate_period(warehouse, TWO_MONTHS[0].replace(month=2), TWO_MONTHS[1])
    warehouse.publish(right, "ds", "opening_balances")
    warehouse.publish(january, "ds", "postings", "1997-01")
    try:
        jobs.build_form_101(warehouse, *TWO_MONTHS)
    except jobs.StaleMonths:
        jobs.calculate_period(warehouse, *JANUARY)
    return warehouse


def _carried_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both marts after a correction of the first of two months."""
    return _both_marts(_corrected(spark, sf_dir))


def _report_after_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report for two months, of which the first was corrected."""
    warehouse = _corrected(spark, sf_dir)
    jobs.build_form_101(warehouse, *TWO_MONTHS)
    return _doubles(warehouse.read("dm", jobs.REPORT_MART))


def _control_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What opened, moved and closed in two months, by currency, as noted with the marts."""
    warehouse = _loaded(spark, sf_dir, BEFORE_JANUARY)
    jobs.calculate_period(warehouse, *TWO_MONTHS)
    return _doubles(jobs.control_totals(warehouse))


def _short_lived(views: BankViews) -> DataFrame:
    """Accounts of which every tenth opens, and every tenth closes, inside January."""
    number = F.col("account_id") % 10
    return views.accounts.withColumns(
        {
            "valid_from": F.when(number == 1, F.lit(date(1997, 1, 10))).otherwise(F.col("valid_from")),
            "valid_to": F.when(number == 2, F.lit(date(1997, 1, 20))).otherwise(F.col("valid_to")),
        }
    )


def _form_101_short_lived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report where accounts open and close inside the period; other movements are left out."""
    accounts = _short_lived(BankViews(spark, sf_dir))
    warehouse = _loaded(spark, sf_dir, BEFORE_JANUARY, {"accounts": accounts})
    jobs.calculate_period(warehouse, *JANUARY, on_unbooked="skip")
    jobs.build_form_101(warehouse, *JANUARY)
    return _doubles(warehouse.read("dm", jobs.REPORT_MART))


def _unbooked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The movements of January on accounts that were not valid that day."""
    accounts = _short_lived(BankViews(spark, sf_dir))
    warehouse = _loaded(spark, sf_dir, BEFORE_JANUARY, {"accounts": accounts})
    try:
        jobs.calculate_period(warehouse, *JANUARY)
    except UnbookedMovements:
        pass
    return _doubles(warehouse.read("dm", jobs.UNBOOKED))


def _form_101(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report for one month in one plan. Both marts share one pass over the postings."""
    v = BankViews(spark, sf_dir)
    rates_by_day = day_rates(v.currencies, v.exchange_rates, BEFORE_JANUARY, JANUARY[1])
    turnover = account_turnover(v.postings, v.accounts, rates_by_day, *JANUARY)
    balance = account_balance(
        v.opening_balances(BEFORE_JANUARY),
        turnover,
        v.accounts,
        rates_by_day,
        *JANUARY,
        with_opening_day=True,
        on_days=[BEFORE_JANUARY, JANUARY[1]],
        on_last_day=True,
    )
    return _doubles(form_101(balance, turnover, v.accounts, v.currencies, v.ledger_accounts, *JANUARY))


def _build_form_101(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report for two months, from marts that were calculated and published."""
    warehouse = _loaded(spark, sf_dir, BEFORE_JANUARY)
    jobs.calculate_period(warehouse, *TWO_MONTHS)
    jobs.build_form_101(warehouse, *TWO_MONTHS)
    return _doubles(warehouse.read("dm", jobs.REPORT_MART))


def _form_101_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report for seven years. Balances are worked out for its two days only."""
    v, warehouse = BankViews(spark, sf_dir), _warehouse(spark)
    rates_by_day = day_rates(v.currencies, v.exchange_rates, BEFORE_HISTORY, HISTORY[1])
    turnover = account_turnover(v.postings, v.accounts, rates_by_day, *HISTORY)
    warehouse.publish(turnover, "dm", jobs.TURNOVER_MART)
    stored = warehouse.read("dm", jobs.TURNOVER_MART)
    balance = account_balance(
        v.opening_balances(BEFORE_HISTORY),
        stored,
        v.accounts,
        rates_by_day,
        *HISTORY,
        with_opening_day=True,
        on_days=[BEFORE_HISTORY, HISTORY[1]],
        on_last_day=True,
    )
    return _doubles(form_101(balance, stored, v.accounts, v.currencies, v.ledger_accounts, *HISTORY))


def _build_form_101_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report for seven years, from marts that were calculated and published."""
    warehouse = _loaded(spark, sf_dir, BEFORE_HISTORY)
    jobs.calculate_period(warehouse, *HISTORY)
    jobs.build_form_101(warehouse, *HISTORY)
    return _doubles(warehouse.read("dm", jobs.REPORT_MART))


# Duplicates


def _find_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_duplicates(BankViews(spark, sf_dir).clients, ["text"])


def _remove_duplicates(kept: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        clients = BankViews(spark, sf_dir).clients
        return remove_duplicates(clients, ["text"], [F.col("doc_id").asc()])[0 if kept else 1]

    return query


def _refresh_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _warehouse(spark)
    warehouse.publish(BankViews(spark, sf_dir).clients, "dm", "client")
    repair = jobs.refresh_client(warehouse, ["text"], [F.col("doc_id").asc()])
    kept = warehouse.read("dm", "client").withColumn("kept", F.lit(True))
    return kept.unionByName(repair.reports["removed"].withColumn("kept", F.lit(False)))


def _assert_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = BankViews(spark, sf_dir)
    verdicts = []
    for table, keys in (
        ("orders", ["o_orderkey"]),
        ("customer", ["c_custkey"]),
        ("lineitem", ["l_orderkey", "l_linenumber"]),
        ("documents", ["text"]),
    ):
        try:
            assert_unique(views.table(table), keys)
            verdicts.append((table, True))
        except DuplicateKeys:
            verdicts.append((table, False))
    return spark.createDataFrame(verdicts, "table_name string, is_unique boolean")


def _declared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose keys were declared: the rows live, and the keys a refused publish repeated."""
    warehouse = _warehouse(spark)
    customers = BankViews(spark, sf_dir).table("customer").select("c_custkey", "c_nationkey")
    warehouse.declare_keys("dm", "customers", ["c_custkey"])
    warehouse.publish(customers, "dm", "customers")
    try:
        warehouse.publish(customers.unionByName(customers.filter("c_nationkey = 3")), "dm", "customers")
    except DuplicateKeys:
        pass
    repeated = warehouse.read("dm", "customers_duplicates")
    return warehouse.read("dm", "customers").join(repeated, "c_custkey", "left")


def _orders_by_month(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, DataFrame]:
    """All orders in periods, their keys declared."""
    warehouse, month = _warehouse(spark), F.date_format("o_orderdate", "yyyy-MM")
    orders = BankViews(spark, sf_dir).table("orders").select("o_orderkey", month.alias("month"), "o_orderpriority")
    warehouse.declare_keys("dm", "orders", ["o_orderkey"])
    warehouse.publish_periods(orders, "dm", "orders", F.col("month"))
    return warehouse, orders


def _keys_over_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders live in months, and the keys that a refused publish of one more month repeated."""
    warehouse, orders = _orders_by_month(spark, sf_dir)
    try:
        warehouse.publish(orders.filter("o_orderpriority = '1-URGENT'"), "dm", "orders", "2099-01")
    except DuplicateKeys:
        pass
    repeated = warehouse.read("dm", "orders_duplicates")
    return warehouse.read("dm", "orders").join(repeated, "o_orderkey", "left")


def _periods_holding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months that hold orders above a price, found by their keys."""
    warehouse, _ = _orders_by_month(spark, sf_dir)
    dear = BankViews(spark, sf_dir).table("orders").filter("o_totalprice > 480000").select("o_orderkey")
    months = warehouse.periods_holding("dm", "orders", dear, ["o_orderkey"])
    return spark.createDataFrame([(m,) for m in months], "month string")


# Missing periods


def _missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart lacks every fourth day of a month."""
    source = BankViews(spark, sf_dir).user_days
    return missing_in_mart(source, source.filter(F.dayofmonth("on_date") % 4 != 0), ["user_id", "on_date"])


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = BankViews(spark, sf_dir).table("events").select("user_id", F.to_date("ts").alias("on_date"))
    return find_period_gaps(days, "user_id", "on_date")


def _line_periods(views: BankViews) -> DataFrame:
    """Order lines as periods of parts: from the day of shipping for as many days as pieces."""
    begins = F.to_date("l_shipdate")
    ends = F.date_add(begins, F.col("l_quantity").cast("int"))
    return views.table("lineitem").select("l_partkey", "l_linenumber", "l_returnflag", begins.alias("begins"), ends.alias("ends"))


def _interval_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days without a period between those of a part. Seventh lines have no end."""
    ends = F.when(F.col("l_linenumber") != 7, F.col("ends"))
    return find_interval_gaps(_line_periods(BankViews(spark, sf_dir)).withColumn("ends", ends), "l_partkey", "begins", "ends")


def _missing_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart lacks the periods of one kind of lines."""
    source = _line_periods(BankViews(spark, sf_dir))
    return missing_intervals(source, source.filter("l_returnflag != 'N'"), "l_partkey", "begins", "ends")


def _refresh_loan_holiday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart after its refresh, with the days that were missing marked."""
    warehouse, user_days = _warehouse(spark), BankViews(spark, sf_dir).user_days
    warehouse.publish(user_days.filter(F.dayofmonth("on_date") % 4 != 0), "dm", "loan_holiday_info")
    path = new_folder(spark, "csv")
    export_csv(user_days, path)
    repair = jobs.refresh_loan_holiday(warehouse, path, user_days.schema, "user_id", "on_date")
    missing = repair.reports["missing"].withColumn("was_missing", F.lit(True))
    mart = warehouse.read("dm", "loan_holiday_info").join(missing, ["user_id", "on_date"], "left")
    return _doubles(mart.withColumn("was_missing", F.coalesce("was_missing", F.lit(False))))


# Balance repair


def _repair(operation: Callable[..., DataFrame], mode: str = "calendar") -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _doubles(operation(BankViews(spark, sf_dir).balance_turnover, mode=mode))

    return query


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, _ = previous_day("account_out_sum", "account_id", "on_date")
    after, _ = next_day("account_in_sum", "account_id", "on_date")
    rows = BankViews(spark, sf_dir).balance_turnover
    return _doubles(rows.select("account_id", "on_date", before.alias("previous_out"), after.alias("next_in")))


def _users(views: BankViews) -> DataFrame:
    return views.table("events").groupBy(F.col("user_id").alias("account_id")).agg(
        F.count(F.lit(1)).alias("event_count")
    )


def _rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = BankViews(spark, sf_dir)
    return _doubles(
        rebuild_balance_turnover(views.balance_turnover, [(_users(views), ["account_id"])], trust="in")
    )


def _refresh_balance_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart after its refresh, with the days that did not agree marked."""
    views, warehouse = BankViews(spark, sf_dir), _warehouse(spark)
    warehouse.publish(views.balance_turnover, "dm", "account_balance_turnover")
    repair = jobs.refresh_balance_turnover(warehouse, [(_users(views), ["account_id"])])
    wrong = repair.reports["mismatches"].select("account_id", "on_date", F.lit(True).alias("was_wrong"))
    mart = warehouse.read("dm", "account_balance_turnover").join(wrong, ["account_id", "on_date"], "left")
    return _doubles(mart.withColumn("was_wrong", F.coalesce("was_wrong", F.lit(False))))


# Log


def _etl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load, one that finds nothing, and one that is refused."""
    views, warehouse = BankViews(spark, sf_dir), _warehouse(spark)
    customers, clients = views.table("customer"), views.clients
    unnamed = customers.filter(F.col("c_name").isNull())
    run_logged(warehouse, "customers", lambda: warehouse.publish(customers, "ds", "customers"))
    run_logged(warehouse, "unnamed", lambda: warehouse.publish(unnamed, "ds", "unnamed"))
    try:
        run_logged(warehouse, "clients", lambda: warehouse.publish(clients, "dm", "clients", keys=["text"]))
    except DuplicateKeys:
        pass
    return etl_log(warehouse).select(
        "task", "rows_affected", "status", F.col("error_text").isNotNull().alias("has_error")
    )


def _unended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log, compacted once: a load, one that was killed while it ran, and another load."""
    customers, warehouse = BankViews(spark, sf_dir).table("customer"), _warehouse(spark)

    def killed() -> int:
        raise SystemExit

    run_logged(warehouse, "customers", lambda: warehouse.publish(customers, "ds", "customers"))
    try:
        run_logged(warehouse, "killed", killed)
    except SystemExit:
        pass
    compact_log(warehouse)
    run_logged(warehouse, "again", lambda: warehouse.publish(customers, "ds", "customers"))
    return etl_log(warehouse).select(
        "task", "rows_affected", "status", F.col("ended_at").isNull().alias("without_end")
    )


def _exchange_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of an export, its import, a refused import, a failed export and a reload."""
    warehouse, customers = _warehouse(spark), BankViews(spark, sf_dir).table("customer")
    jobs.publish(warehouse, customers.select("c_custkey", "c_name"), "dm", "customers")
    path = new_folder(spark, "csv")
    jobs.export_mart(warehouse, "customers", path)
    schema = warehouse.read("dm", "customers").schema
    jobs.import_csv_new_table(warehouse, path, schema, "customers_again")
    spoiled = customers.select("c_custkey", F.lit("\\N").alias("c_name"))
    jobs.full_reload(warehouse, spoiled, "spoiled", ["c_custkey"])
    for refused in (
        lambda: jobs.import_csv_new_table(warehouse, path, schema, "customers_again"),
        lambda: jobs.export_mart(warehouse, "spoiled", path),
    ):
        try:
            refused()
        except Exception:  # the log tells
            pass
    kept = read_csv(spark, path, schema).count()  # the failed export left the earlier files
    return etl_log(warehouse).select(
        "task", "rows_affected", "status", F.col("error_text").isNotNull().alias("has_error"),
        F.lit(kept).cast("long").alias("rows_in_files"),
    )


def entry(spark: SparkSession) -> DataFrame:
    """The period report on the smallest tables."""
    return _form_101(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return bank_queries() | LLM_QUERIES


def bank_queries() -> dict[str, Query]:
    return {
        "read_csv_landing": _landing,
        "load_six_files": _load_six_files,
        "moved_postings": _moved_postings,
        "csv_roundtrip": _csv_roundtrip,
        "reimport_diff": _reimport_diff,
        "checked_import": _checked_import,
        "load_only_new": _load_only_new,
        "load_snapshot": _load_snapshot,
        "publish": _publish,
        "full_reload": _full_reload,
        "parse_dates": _parse_dates,
        "chosen_formats": _chosen_formats,
        "dates_by_file": _dates_by_file,
        "upsert": _upsert(small_source=False),
        "upsert_measured_source": _upsert(small_source=None),
        "rate_as_of": _rate_as_of(None),
        "rate_as_of_by_month": _rate_as_of(False),
        "rate_as_of_open": _open_rates(None),
        "rate_as_of_open_by_month": _open_rates(False),
        "second_order_account": _second_order,
        "currency_bucket": _bucket,
        "account_day_grid": _grid,
        "account_turnover": _turnover(JANUARY),
        "account_turnover_history": _turnover(HISTORY),
        "account_balance": _balance,
        "balance_spans_history": _spans,
        "calculate_period": _calculate_period,
        "calculate_period_history": _calculate_history,
        "corrected_opening": _corrected_opening,
        "carried_correction": _carried_correction,
        "report_after_correction": _report_after_correction,
        "control_totals": _control_totals,
        "unbooked_movements": _unbooked,
        "form_101_short_lived": _form_101_short_lived,
        "form_101": _form_101,
        "form_101_history": _form_101_history,
        "build_form_101": _build_form_101,
        "build_form_101_history": _build_form_101_history,
        "find_duplicates": _find_duplicates,
        "remove_duplicates": _remove_duplicates(kept=True),
        "removed_duplicates": _remove_duplicates(kept=False),
        "refresh_client": _refresh_client,
        "assert_unique": _assert_unique,
        "declared_keys": _declared_keys,
        "keys_over_periods": _keys_over_periods,
        "periods_holding": _periods_holding,
        "missing_in_mart": _missing,
        "find_period_gaps": _gaps,
        "find_interval_gaps": _interval_gaps,
        "missing_intervals": _missing_intervals,
        "refresh_loan_holiday": _refresh_loan_holiday,
        "find_mismatches": _repair(find_mismatches),
        "find_mismatches_by_row": _repair(find_mismatches, "row"),
        "fix_in_sum": _repair(fix_in_sum),
        "fix_in_sum_by_row": _repair(fix_in_sum, "row"),
        "fix_out_sum": _repair(fix_out_sum),
        "fix_out_sum_by_row": _repair(fix_out_sum, "row"),
        "previous_and_next_day": _neighbours,
        "rebuild_balance_turnover": _rebuild,
        "refresh_balance_turnover": _refresh_balance_turnover,
        "etl_log": _etl_log,
        "unended_operations": _unended,
        "exchange_log": _exchange_log,
    }


# SQL

_ACCOUNTS = """
accounts AS (
  SELECT c_custkey AS account_id, c_nationkey AS currency_id,
         CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'P' END AS characteristic,
         c_mktsegment AS ledger2, CAST(c_acctbal AS DECIMAL(18,2)) AS opening,
         n_regionkey = 0 AS is_home
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

_RATES = """
rates AS (
  SELECT n_nationkey AS currency_id, CAST(m AS DATE) AS date_from,
         CAST(m + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS date_to,
         CAST((n_nationkey + 1) * CAST(0.5 AS DECIMAL(12,6))
              + month(m) * CAST(0.01 AS DECIMAL(12,6)) AS DECIMAL(12,6)) AS rate
  FROM nation, generate_series(TIMESTAMP '1994-12-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH) AS s(m)
  WHERE n_regionkey <> 0)"""

_LEGS = """
legs AS (
  SELECT CAST(o_orderdate AS DATE) AS on_date, o_custkey AS account_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS debit, CAST(0 AS DECIMAL(18,2)) AS credit
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  UNION ALL
  SELECT CAST(o_orderdate AS DATE), l_suppkey, 0, CAST(l_extendedprice AS DECIMAL(18,2))
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


def _turnover_cte(first: str, last: str, only: str = "TRUE") -> str:
    return f"""
turnover AS (
  SELECT on_date, account_id, any_value(characteristic) AS characteristic,
         CAST(sum(debit) AS DECIMAL(25,2)) AS debit, CAST(sum(credit) AS DECIMAL(25,2)) AS credit,
         sum(CAST(debit AS DECIMAL(24,2)) * CASE WHEN is_home THEN 1 ELSE rate END) AS debit_home,
         sum(CAST(credit AS DECIMAL(24,2)) * CASE WHEN is_home THEN 1 ELSE rate END) AS credit_home
  FROM legs JOIN accounts USING (account_id)
  LEFT JOIN rates ON rates.currency_id = accounts.currency_id AND on_date BETWEEN date_from AND date_to
  WHERE on_date BETWEEN DATE '{first}' AND DATE '{last}' AND {only}
  GROUP BY on_date, account_id)"""


def _balance_cte(day_before: str, last: str) -> str:
    """Balances day by day from the day before the period."""
    return f"""
days AS (
  SELECT CAST(d AS DATE) AS on_date
  FROM generate_series(TIMESTAMP '{day_before}', TIMESTAMP '{last}', INTERVAL 1 DAY) AS s(d)),
balance AS (
  SELECT days.on_date, a.account_id, a.currency_id, a.is_home,
         CAST(a.opening + sum(CASE WHEN a.characteristic = 'A' THEN 1 ELSE -1 END
                              * (coalesce(t.debit, 0) - coalesce(t.credit, 0)))
              OVER (PARTITION BY a.account_id ORDER BY days.on_date) AS DECIMAL(24,2)) AS balance
  FROM accounts a CROSS JOIN days
  LEFT JOIN turnover t ON t.account_id = a.account_id AND t.on_date = days.on_date),
valued AS (
  SELECT on_date, account_id, balance, balance * CASE WHEN is_home THEN 1 ELSE rate END AS balance_home
  FROM balance LEFT JOIN rates
    ON rates.currency_id = balance.currency_id AND on_date BETWEEN date_from AND date_to)"""


def _marts(day_before: str, first: str, last: str) -> str:
    parts = [_ACCOUNTS, _RATES, _LEGS, _turnover_cte(first, last), _balance_cte(day_before, last)]
    return "WITH " + ",".join(parts)


_OPEN = "(account_id % 10 <> 1 OR on_date >= DATE '1997-01-10')"
_SHORT_LIVED = f"{_OPEN} AND (account_id % 10 <> 2 OR on_date <= DATE '1997-01-20')"


def _report_sql(day_before: str, first: str, last: str, short_lived: bool = False) -> str:
    """``short_lived``: every tenth account opens on the 10th, every tenth closes on the 20th."""
    marts, closing = _marts(day_before, first, last), f"DATE '{last}'"
    if short_lived:
        accounts = _ACCOUNTS.replace(
            "CAST(c_acctbal AS DECIMAL(18,2)) AS opening",
            "CASE WHEN c_custkey % 10 = 1 THEN 0 ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS opening",
        )
        turnover = _turnover_cte(first, last, _SHORT_LIVED)
        marts = "WITH " + ",".join([accounts, _RATES, _LEGS, turnover, _balance_cte(day_before, last)])
        closing = f"CASE WHEN a.account_id % 10 = 2 THEN DATE '1997-01-20' ELSE DATE '{last}' END"

    def figures(name: str, amount: str) -> str:
        by_bucket = [
            f"CAST(round(sum(CASE WHEN {cond} THEN {amount} ELSE 0 END), 2) AS DECIMAL(24,2)) AS {name}_{bucket}"
            for bucket, cond in (("rub", "is_home"), ("val", "NOT is_home"))
        ]
        return ", ".join(by_bucket)

    names = ("balance_in", "turn_deb", "turn_cre", "balance_out")
    shown = ", ".join(
        f"CAST({n}_rub AS DOUBLE) AS {n}_rub, CAST({n}_val AS DOUBLE) AS {n}_val, "
        f"CAST({n}_rub + {n}_val AS DOUBLE) AS {n}_total"
        for n in names
    )
    return f"""{marts},
per_account AS (
  SELECT a.*,
    (SELECT balance_home FROM valued v WHERE v.account_id = a.account_id AND on_date = DATE '{day_before}') AS b_in,
    coalesce(t.deb, 0) AS deb, coalesce(t.cre, 0) AS cre,
    (SELECT balance_home FROM valued v WHERE v.account_id = a.account_id AND on_date = {closing}) AS b_out
  FROM accounts a LEFT JOIN (
    SELECT account_id, sum(debit_home) AS deb, sum(credit_home) AS cre FROM turnover GROUP BY account_id) t
  ON t.account_id = a.account_id),
grouped AS (
  SELECT ledger2, characteristic, {figures('balance_in', 'b_in')}, {figures('turn_deb', 'deb')},
         {figures('turn_cre', 'cre')}, {figures('balance_out', 'b_out')}
  FROM per_account GROUP BY ledger2, characteristic)
SELECT DATE '{first}' AS date_from, DATE '{last}' AS date_to, ledger2,
       upper(ledger2[1]) || lower(ledger2[2:]) AS name, characteristic, {shown}
FROM grouped"""


_TURNOVER_COLUMNS = """SELECT on_date, account_id, CAST(debit AS DOUBLE) AS debit, CAST(credit AS DOUBLE) AS credit,
       CAST(debit_home AS DOUBLE) AS debit_home, CAST(credit_home AS DOUBLE) AS credit_home FROM turnover"""

_USER_DAYS = """
user_days AS (
  SELECT user_id, CAST(ts AS DATE) AS on_date,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS turnover
  FROM events GROUP BY user_id, CAST(ts AS DATE))"""

_BALANCE_TURNOVER = f"""WITH {_USER_DAYS},
summed AS (
  SELECT *, CAST(sum(turnover) OVER (PARTITION BY user_id ORDER BY on_date) AS DECIMAL(18,2)) AS account_out_sum
  FROM user_days),
sums AS (
  SELECT user_id AS account_id, on_date,
         CAST(account_out_sum - turnover
              + CASE WHEN user_id % 7 = 0 AND day(on_date) % 3 = 0 THEN 10 ELSE 0 END AS DECIMAL(18,2))
           AS account_in_sum,
         account_out_sum
  FROM summed),
by_day AS (
  SELECT s.*, p.on_date IS NOT NULL AS has_previous, p.account_out_sum AS previous_out,
         n.account_in_sum AS next_in
  FROM sums s
  LEFT JOIN sums p ON p.account_id = s.account_id AND p.on_date = s.on_date - 1
  LEFT JOIN sums n ON n.account_id = s.account_id AND n.on_date = s.on_date + 1),
by_row AS (
  SELECT *, lag(on_date) OVER w IS NOT NULL AS has_previous, lag(account_out_sum) OVER w AS previous_out,
         lead(account_in_sum) OVER w AS next_in
  FROM sums WINDOW w AS (PARTITION BY account_id ORDER BY on_date))"""


def _mismatch_sql(rows: str) -> str:
    return f"""{_BALANCE_TURNOVER}
SELECT account_id, on_date, CAST(account_in_sum AS DOUBLE) AS account_in_sum,
       CAST(previous_out AS DOUBLE) AS previous_out_sum
FROM {rows} WHERE has_previous AND previous_out IS DISTINCT FROM account_in_sum"""


def _fixed_sql(rows: str, in_sum: str, out_sum: str, more: str = "", joins: str = "") -> str:
    return f"""{_BALANCE_TURNOVER}
SELECT account_id, on_date, CAST({in_sum} AS DOUBLE) AS account_in_sum,
       CAST({out_sum} AS DOUBLE) AS account_out_sum{more}
FROM {rows}{joins}"""


_FIXED_IN = "coalesce(previous_out, account_in_sum)"
_FIXED_OUT = "coalesce(next_in, account_out_sum)"
_EVENT_COUNTS = " JOIN (SELECT user_id, count(*) AS event_count FROM events GROUP BY user_id) ON user_id = account_id"

_UPSERT = """
SELECT o_orderkey,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'OLD' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'keep'
            WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'update' ELSE 'insert' END AS action
FROM orders"""

_RATED_ORDERS = f"""WITH {_ACCOUNTS}, {_RATES}
SELECT o_orderkey, a.currency_id, CAST(o_orderdate AS DATE) AS on_date, CAST(rate AS DOUBLE) AS rate,
       CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(24,2))
            * CASE WHEN is_home THEN 1 ELSE rate END AS DOUBLE) AS amount_home
FROM orders JOIN accounts a ON o_custkey = account_id
LEFT JOIN rates ON rates.currency_id = a.currency_id AND CAST(o_orderdate AS DATE) BETWEEN date_from AND date_to"""

_USER_DAYS_ALL = f"WITH {_USER_DAYS} SELECT user_id, on_date, CAST(turnover AS DOUBLE) AS turnover FROM user_days"

_FILE_DATES = """
WITH files AS (
  SELECT o_orderkey, o_orderpriority, CAST(o_orderpriority[1] AS INTEGER) AS number,
         CASE WHEN number = 3 THEN make_date(year(o_orderdate), month(o_orderdate), day(o_orderdate) % 12 + 1)
              ELSE CAST(o_orderdate AS DATE) END AS on_date,
         number <= 3 AND day(on_date) <= 12 AND day(on_date) <> month(on_date) AS two_readings
  FROM orders)"""

_RANKED_CLIENTS = """
SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents"""


def oracle_sql() -> dict[str, str]:
    return bank_sql() | LLM_SQL


def bank_sql() -> dict[str, str]:
    january, two_months = ("1996-12-31", "1997-01-01", "1997-01-31"), ("1996-12-31", "1997-01-01", "1997-02-28")
    history = ("1994-12-31", "1995-01-01", "2001-12-31")
    history_turnover = "WITH " + ",".join([_ACCOUNTS, _RATES, _LEGS, _turnover_cte(*history[1:])])
    open_rates = f"""WITH {_RATES}
SELECT o_orderkey, CAST(o_custkey % 25 AS INTEGER) AS currency_id, CAST(o_orderdate AS DATE) AS on_date,
       CAST(rate AS DOUBLE) AS rate
FROM orders LEFT JOIN rates ON rates.currency_id = o_custkey % 25 AND date_from <= DATE '1996-07-01'
  AND CAST(o_orderdate AS DATE) >= date_from
  AND (CAST(o_orderdate AS DATE) <= date_to OR date_from = DATE '1996-07-01')"""
    both_marts = f"""{_marts(*two_months)}
SELECT v.on_date, v.account_id, CAST(balance AS DOUBLE) AS balance, CAST(balance_home AS DOUBLE) AS balance_home,
       CAST(debit AS DOUBLE) AS debit, CAST(credit AS DOUBLE) AS credit,
       CAST(debit_home AS DOUBLE) AS debit_home, CAST(credit_home AS DOUBLE) AS credit_home
FROM valued v LEFT JOIN turnover t ON t.account_id = v.account_id AND t.on_date = v.on_date"""
    return {
        "read_csv_landing": """
SELECT CASE WHEN bad THEN NULL ELSE o_orderkey END AS o_orderkey,
       CASE WHEN bad THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS total,
       CASE WHEN bad THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN bad THEN o_orderkey || ',unknown,' || o_orderpriority END AS raw_row,
       CASE WHEN bad THEN 'does not fit the schema' END AS reason
FROM (SELECT *, o_orderpriority = '1-URGENT' AS bad FROM orders)""",
        "load_six_files": f"""WITH {_ACCOUNTS}, {_RATES},
postings AS (
  SELECT o_orderkey AS posting_id, CAST(o_orderdate AS DATE) AS on_date, o_custkey,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders)
SELECT 'accounts' AS table_name, 'row' AS kind,
       concat_ws('|', account_id, currency_id, characteristic, ledger2, '1990-01-01', '2050-12-31') AS "row"
FROM accounts
UNION ALL SELECT 'opening_balances', 'row', concat_ws('|', account_id, '1994-12-31', opening)
FROM accounts WHERE account_id % 50 <> 7
UNION ALL SELECT 'opening_balances', 'reject', 'does not fit the schema'
FROM accounts, generate_series(1, 2) WHERE account_id % 50 = 7
UNION ALL SELECT 'currencies', 'row', concat_ws('|', n_nationkey, n_regionkey = 0) FROM nation
UNION ALL SELECT 'exchange_rates', 'row', concat_ws('|', currency_id, date_from, date_to, rate) FROM rates
UNION ALL SELECT DISTINCT 'ledger_accounts', 'row', ledger2 || '|' || upper(ledger2[1]) || lower(ledger2[2:])
FROM accounts
UNION ALL SELECT 'postings', 'row', concat_ws('|', posting_id, on_date, o_custkey, o_custkey + 1, amount)
FROM postings WHERE posting_id % 90 NOT IN (1, 2, 3)
UNION ALL SELECT 'postings', 'reject',
       CASE posting_id % 90 WHEN 1 THEN 'no amount' WHEN 2 THEN 'bad date: on_date' ELSE 'no on_date' END
FROM postings WHERE posting_id % 90 IN (1, 2, 3)""",
        "moved_postings": """
SELECT o_orderkey AS posting_id,
       CAST(CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH
                 ELSE CAST(o_orderdate AS DATE) END AS DATE) AS on_date,
       o_custkey AS debit_account, o_custkey + 1 AS credit_account,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount
FROM orders""",
        "rate_as_of_open": open_rates,
        "rate_as_of_open_by_month": open_rates,
        "corrected_opening": f"""{_marts(*january)}
SELECT v.on_date, v.account_id, CAST(balance AS DOUBLE) AS balance, CAST(balance_home AS DOUBLE) AS balance_home,
       CAST(debit AS DOUBLE) AS debit, CAST(credit AS DOUBLE) AS credit,
       CAST(debit_home AS DOUBLE) AS debit_home, CAST(credit_home AS DOUBLE) AS credit_home
FROM valued v LEFT JOIN turnover t ON t.account_id = v.account_id AND t.on_date = v.on_date""",
        "unbooked_movements": f"""WITH {_ACCOUNTS}, {_LEGS}
SELECT account_id, on_date, CAST(sum(debit) AS DOUBLE) AS debit, CAST(sum(credit) AS DOUBLE) AS credit,
       'outside validity' AS reason
FROM legs JOIN accounts USING (account_id)
WHERE on_date BETWEEN DATE '1997-01-01' AND DATE '1997-01-31' AND NOT ({_SHORT_LIVED})
GROUP BY account_id, on_date""",
        "form_101_short_lived": _report_sql(*january, short_lived=True),
        "declared_keys": """
SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey = 3 THEN 2 END AS n FROM customer""",
        "keys_over_periods": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 2 END AS n
FROM orders""",
        "periods_holding": """
SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders WHERE o_totalprice > 480000""",
        "checked_import": "SELECT c_custkey, c_name, c_nationkey, true AS refused FROM customer",
        "load_only_new": """
SELECT task, rows_affected, 'SUCCESS' AS status, n AS rows_in_table
FROM (SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f FROM orders),
     (VALUES (1), (2), (3), (4)) AS steps(step),
     LATERAL (SELECT CASE step WHEN 1 THEN f WHEN 3 THEN n - f ELSE 0 END AS rows_affected,
                     CASE step WHEN 2 THEN 'pass over 1 known files of ds.orders'
                               WHEN 4 THEN 'pass over 2 known files of ds.orders' ELSE 'load orders' END AS task)""",
        "chosen_formats": f"""{_FILE_DATES}
SELECT o_orderpriority, 'on_date' AS "column", count(*) AS n_texts, 0 AS n_unread,
       count(*) FILTER (two_readings) AS n_conflicts,
       CASE any_value(number) WHEN 1 THEN 'dd/MM/yyyy' WHEN 2 THEN 'MM/dd/yyyy' WHEN 4 THEN 'yyyy-MM-dd' END AS format,
       CASE WHEN any_value(number) IN (1, 2) THEN 'decided' WHEN any_value(number) = 3 THEN 'ambiguous' ELSE 'clear' END AS status
FROM files GROUP BY o_orderpriority""",
        "dates_by_file": f"""{_FILE_DATES}
SELECT o_orderkey, o_orderpriority, CASE WHEN number <> 3 OR NOT two_readings THEN on_date END AS on_date,
       CASE WHEN number = 3 AND two_readings THEN 'ambiguous date: on_date' END AS reason
FROM files""",
        "control_totals": f"""{_marts(*two_months)}
SELECT DATE '1997-01-01' AS date_from, DATE '1997-02-28' AS date_to, currency_id,
       CAST(sum(CASE WHEN on_date = DATE '1996-12-31' THEN balance END) AS DOUBLE) AS opening,
       CAST(sum(CASE WHEN on_date = DATE '1997-02-28' THEN balance ELSE -balance END) AS DOUBLE) AS change,
       CAST(sum(CASE WHEN on_date = DATE '1997-02-28' THEN balance END) AS DOUBLE) AS closing
FROM balance WHERE on_date IN (DATE '1996-12-31', DATE '1997-02-28') GROUP BY currency_id""",
        "find_interval_gaps": """
WITH periods AS (
  SELECT l_partkey, CAST(l_shipdate AS DATE) AS begins,
         CASE WHEN l_linenumber = 7 THEN DATE '9999-12-31' ELSE CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) END AS ends
  FROM lineitem),
reached AS (
  SELECT *, max(ends) OVER (
    PARTITION BY l_partkey ORDER BY begins, ends ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last
  FROM periods)
SELECT l_partkey, last + 1 AS gap_from, begins - 1 AS gap_to, CAST(begins - last - 1 AS BIGINT) AS missing_days
FROM reached WHERE begins > last + 1""",
        "missing_intervals": """
WITH days AS (
  SELECT l_partkey, CAST(l_shipdate AS DATE) + CAST(i AS INTEGER) AS day, bool_or(l_returnflag <> 'N') AS held
  FROM lineitem, generate_series(0, CAST(l_quantity AS INTEGER)) AS s(i)
  GROUP BY l_partkey, day),
numbered AS (
  SELECT l_partkey, day, day - CAST(row_number() OVER (PARTITION BY l_partkey ORDER BY day) AS INTEGER) AS stretch
  FROM days WHERE NOT held)
SELECT l_partkey, min(day) AS missing_from, max(day) AS missing_to FROM numbered GROUP BY l_partkey, stretch""",
        "unended_operations": """
SELECT t.task, CASE WHEN t.killed THEN NULL ELSE n END AS rows_affected,
       CASE WHEN t.killed THEN 'STARTED' ELSE 'SUCCESS' END AS status, t.killed AS without_end
FROM (SELECT count(*) AS n FROM customer), (VALUES ('customers', false), ('killed', true), ('again', false)) AS t(task, killed)""",
        "exchange_log": """
WITH size AS (SELECT count(*) AS n FROM customer)
SELECT t.task, CASE WHEN t.failed THEN 0 ELSE n END AS rows_affected,
       CASE WHEN t.failed THEN 'ERROR' ELSE 'SUCCESS' END AS status, t.failed AS has_error, n AS rows_in_files
FROM size, (VALUES ('publish dm.customers all', false), ('export dm.customers', false),
                   ('import dm.customers_again', false), ('reload dm.spoiled', false),
                   ('import dm.customers_again', true), ('export dm.spoiled', true)) AS t(task, failed)""",
        "csv_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "reimport_diff": """
SELECT c_custkey, CASE c_nationkey WHEN 3 THEN 'removed' WHEN 5 THEN 'changed' ELSE 'same' END AS status
FROM customer
UNION ALL
SELECT -c_custkey, 'added' FROM customer WHERE c_nationkey = 9""",
        "load_snapshot": _USER_DAYS_ALL,
        "publish": """
SELECT c_custkey AS account_id, DATE '1996-12-31' AS on_date,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) + 1 AS DOUBLE) AS balance
FROM customer""",
        "full_reload": _USER_DAYS_ALL,
        "parse_dates": """
SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS on_date,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'bad date: on_date' END AS reason
FROM orders""",
        "upsert": _UPSERT,
        "upsert_measured_source": _UPSERT,
        "rate_as_of": _RATED_ORDERS,
        "rate_as_of_by_month": _RATED_ORDERS,
        "second_order_account": """
SELECT c_custkey AS account_id, c_mktsegment AS ledger2,
       upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS name
FROM customer""",
        "currency_bucket": """
SELECT c_custkey AS account_id, CASE WHEN n_regionkey = 0 THEN 'rub' ELSE 'val' END AS bucket
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
        "account_day_grid": """
SELECT c_custkey AS account_id, CAST(d AS DATE) AS on_date
FROM customer,
     generate_series(TIMESTAMP '1997-01-01', TIMESTAMP '1997-01-31', INTERVAL 1 DAY) AS s(d)""",
        "account_turnover": f"{_marts(*january)} {_TURNOVER_COLUMNS}",
        "account_turnover_history": f"{history_turnover} {_TURNOVER_COLUMNS}",
        "account_balance": f"""{_marts(*january)}
SELECT on_date, account_id, CAST(balance AS DOUBLE) AS balance, CAST(balance_home AS DOUBLE) AS balance_home
FROM valued WHERE on_date >= DATE '1997-01-01'""",
        "balance_spans_history": f"""{history_turnover},
points AS (
  SELECT account_id, DATE '1995-01-01' AS span_from, opening AS change FROM accounts
  UNION ALL
  SELECT account_id, on_date, CASE WHEN characteristic = 'A' THEN debit - credit ELSE credit - debit END
  FROM turnover),
starts AS (
  SELECT account_id, span_from, sum(change) AS change FROM points GROUP BY account_id, span_from)
SELECT account_id, span_from,
       coalesce(lead(span_from) OVER w - 1, DATE '2001-12-31') AS span_to,
       CAST(sum(change) OVER w AS DOUBLE) AS balance
FROM starts WINDOW w AS (PARTITION BY account_id ORDER BY span_from)""",
        "calculate_period": both_marts,
        "carried_correction": both_marts,
        "report_after_correction": _report_sql(*two_months),
        "form_101": _report_sql(*january),
        "form_101_history": _report_sql(*history),
        "build_form_101": _report_sql(*two_months),
        "build_form_101_history": _report_sql(*history),
        "find_duplicates": "SELECT text, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1",
        "remove_duplicates": f"SELECT doc_id, text FROM ({_RANKED_CLIENTS}) WHERE n = 1",
        "removed_duplicates": f"SELECT doc_id, text FROM ({_RANKED_CLIENTS}) WHERE n > 1",
        "refresh_client": f"SELECT doc_id, text, n = 1 AS kept FROM ({_RANKED_CLIENTS})",
        "assert_unique": """
SELECT 'orders' AS table_name, count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders
UNION ALL SELECT 'customer', count(*) = count(DISTINCT c_custkey) FROM customer
UNION ALL SELECT 'lineitem', count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'documents', count(*) = count(DISTINCT text) FROM documents""",
        "missing_in_mart": """
SELECT DISTINCT user_id, CAST(ts AS DATE) AS on_date FROM events WHERE day(ts) % 4 = 0""",
        "find_period_gaps": """
WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS on_date FROM events),
following AS (
  SELECT user_id, on_date AS gap_after, lead(on_date) OVER (PARTITION BY user_id ORDER BY on_date) AS gap_before
  FROM days)
SELECT user_id, gap_after, gap_before, CAST(gap_before - gap_after - 1 AS BIGINT) AS missing_days
FROM following WHERE gap_before - gap_after > 1""",
        "refresh_loan_holiday": f"""WITH {_USER_DAYS}
SELECT user_id, on_date, CAST(turnover AS DOUBLE) AS turnover, day(on_date) % 4 = 0 AS was_missing
FROM user_days""",
        "find_mismatches": _mismatch_sql("by_day"),
        "find_mismatches_by_row": _mismatch_sql("by_row"),
        "fix_in_sum": _fixed_sql("by_day", _FIXED_IN, "account_out_sum"),
        "fix_in_sum_by_row": _fixed_sql("by_row", _FIXED_IN, "account_out_sum"),
        "fix_out_sum": _fixed_sql("by_day", "account_in_sum", _FIXED_OUT),
        "fix_out_sum_by_row": _fixed_sql("by_row", "account_in_sum", _FIXED_OUT),
        "previous_and_next_day": f"""{_BALANCE_TURNOVER}
SELECT account_id, on_date, CAST(previous_out AS DOUBLE) AS previous_out, CAST(next_in AS DOUBLE) AS next_in
FROM by_day""",
        "rebuild_balance_turnover": _fixed_sql(
            "by_day", "account_in_sum", _FIXED_OUT, ", event_count", _EVENT_COUNTS
        ),
        "refresh_balance_turnover": _fixed_sql(
            "by_day",
            _FIXED_IN,
            "account_out_sum",
            ", event_count, has_previous AND previous_out IS DISTINCT FROM account_in_sum AS was_wrong",
            _EVENT_COUNTS,
        ),
        "etl_log": """
SELECT 'customers' AS task, count(*) AS rows_affected, 'SUCCESS' AS status, false AS has_error FROM customer
UNION ALL SELECT 'unnamed', count(*), 'SUCCESS', false FROM customer WHERE c_name IS NULL
UNION ALL SELECT 'clients', 0, 'ERROR', true""",
    }
