"""Jobs: read layers, run a plan, publish the result and log it. All can be run again."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldomart import schemas
from saldomart.functions.dates import DATE_FORMATS
from saldomart.functions.money import to_cents
from saldomart.functions.sizes import never_broadcast, observed
from saldomart.operators.duplicates import assert_unique, remove_duplicates
from saldomart.operators.merge import latest_per_key, stored_and_measured, table_diff, take_over
from saldomart.operators.periods import find_interval_gaps, find_period_gaps, missing_in_mart, missing_intervals
from saldomart.operators.rates import day_rates, rate_runs
from saldomart.operators.repair import find_mismatches, rebuild_balance_turnover
from saldomart.plans.audit import run_logged
from saldomart.plans.balance import account_balance, valued_runs
from saldomart.plans.control import ControlTotalsDiffer, balance_control, days_that_differ, movement_totals
from saldomart.plans.form101 import form_101
from saldomart.plans.turnover import (
    UnbookedMovements,
    account_movements,
    booked,
    currency_days,
    placed_movements,
    require_rates,
    valued_turnover,
)
from saldomart.sources.csv import (
    IncompleteExport,
    check_files,
    export_csv,
    read_csv,
    read_csv_landing,
    read_csv_text,
    typed_rows,
)
from saldomart.sources.ledger import Choice, choose_new, note_loaded
from saldomart.sources.tables import SINCE, Prepared, Published, Warehouse

TURNOVER_MART = "dm_account_turnover_f"
BALANCE_MART = "dm_account_balance_f"
REPORT_MART = "dm_f101_round_f"
UNBOOKED = "dm_unbooked_f"  # movements that the marts leave out


@dataclass(frozen=True)
class InputTable:
    schema: T.StructType
    keys: tuple[str, ...]
    month_of: str | None = None  # the date column by which the table is kept in months
    required: tuple[str, ...] = ()  # rows without a value here cannot be booked


# The six files of the first load.
INPUT_TABLES = {
    "accounts": InputTable(schemas.ACCOUNTS, ("account_id",)),
    "opening_balances": InputTable(schemas.OPENING_BALANCES, ("account_id", "on_date")),
    "currencies": InputTable(schemas.CURRENCIES, ("currency_id",)),
    "exchange_rates": InputTable(schemas.EXCHANGE_RATES, ("currency_id", "date_from")),
    "ledger_accounts": InputTable(schemas.LEDGER_ACCOUNTS, ("ledger2",)),
    "postings": InputTable(
        schemas.POSTINGS, ("posting_id",), month_of="on_date", required=tuple(schemas.POSTINGS.fieldNames())
    ),
}


# Loading


def load_csv(
    warehouse: Warehouse,
    table: str,
    path: str | list[str],
    definition: InputTable | None = None,
    formats: Sequence[str] = DATE_FORMATS,
    order_by: Sequence[str] = (),
    sep: str = ",",
    encoding: str = "UTF-8",
    formats_by_file: bool = False,
    only_new: bool = False,
) -> Published:
    """Upsert CSV files into a DS table, whatever its months, in a fixed number of passes.

    Rows that cannot be taken are kept in ``<table>_rejects``, a period for each load. A
    table kept in months rewrites the months that occur in the files, and those that a row
    of the files leaves because its date changed; these are found by an index of keys. The
    months are written together and go live together.

    ``formats_by_file`` finds out the date format of each file and column, and rejects dates
    that stay ambiguous, instead of taking the first format that fits. ``only_new`` passes
    over files that were loaded into the table before, and logs how many.
    """
    spec = definition or INPUT_TABLES[table]
    if spec.month_of is not None and spec.month_of not in spec.schema.fieldNames():
        raise ValueError(f"{table} is kept in months of {spec.month_of}, which it lacks")
    names, spark = spec.schema.fieldNames(), warehouse.spark
    files = _new_files(warehouse, f"ds.{table}", path) if only_new else None
    if files is not None and not files.new:
        return Published(warehouse.table_dir("ds", table), 0, {"inserted": 0, "updated": 0, "unchanged": 0})
    paths = path if files is None else [f.path for f in files.new]

    def load() -> Published:
        with warehouse.stage("landing") as folder:
            raw = read_csv_text(spark, paths, spec.schema, sep, encoding)
            if formats_by_file:  # read twice, parsed once
                raw.write.parquet(f"{folder}/raw")
                raw = spark.read.schema(raw.schema).parquet(f"{folder}/raw")
            rows = typed_rows(raw, spec.schema, formats, spec.required, sep, formats_by_file)
            rows.withColumn("_bad", F.col("reason").isNotNull()).write.partitionBy("_bad").parquet(f"{folder}/rows")
            kinds = T.StructType([*rows.schema.fields, T.StructField("_bad", T.BooleanType())])
            staged = spark.read.schema(kinds).parquet(f"{folder}/rows")
            rejects = staged.filter("_bad").select("raw_row", "reason")
            warehouse.publish(rejects, "ds", f"{table}_rejects", f"load-{uuid.uuid4().hex}")
            latest = latest_per_key(staged.filter("NOT _bad").select(*names), spec.keys, order_by)
            new, small = stored_and_measured(latest, f"{folder}/new")
            done = _publish_taken_over(warehouse, table, spec, new, small)
        if files is not None:
            note_loaded(warehouse, f"ds.{table}", files.new)
        return done

    return run_logged(warehouse, f"load {table}", load, lambda p: p.counts["inserted"] + p.counts["updated"])


def _new_files(warehouse: Warehouse, target: str, path: str | list[str]) -> Choice:
    """Files not loaded into ``target`` before. That others are passed over is logged."""
    files = choose_new(warehouse, target, path)
    if files.known:
        run_logged(warehouse, f"pass over {len(files.known)} known files of {target}", lambda: 0)
    return files


def _month(date_col: str) -> Column:
    return F.date_format(date_col, "yyyy-MM")


def _mart_month(date_col: str) -> Column:
    """``_month`` of a day of a calculated period, whose year has four digits, without a formatter for each row."""
    year, month = (F.lpad(part(date_col).cast("string"), n, "0") for part, n in ((F.year, 4), (F.month, 2)))
    return F.concat(year, F.lit("-"), month)


def _publish_taken_over(
    warehouse: Warehouse, table: str, spec: InputTable, new: DataFrame, small: bool
) -> Published:
    counts = {
        "inserted": F.col("action") == "insert",
        "updated": F.col("action") == "update",
        "unchanged": F.col("action") == "keep",
    }
    columns = spec.schema.fieldNames()
    if spec.month_of is None:
        merged = take_over(warehouse.read("ds", table, schema=spec.schema), new, spec.keys, small)
        return warehouse.publish(merged, "ds", table, counts=counts, columns=columns)
    months = {r["m"] for r in new.select(_month(spec.month_of).alias("m")).distinct().collect()}  # a row a month
    if spec.month_of not in spec.keys:  # a row may stand in a month that the files do not name
        months.update(warehouse.periods_holding("ds", table, new, spec.keys))
    touched = sorted(months - {None})
    target = warehouse.read("ds", table, touched, spec.schema)
    merged = take_over(target, new, spec.keys, small)
    month = _month(spec.month_of)
    return warehouse.publish_periods(
        merged, "ds", table, month, touched, counts=counts, columns=columns, index=spec.keys
    )


def load_snapshot(
    warehouse: Warehouse,
    table: str,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    only_new: bool = False,
) -> Published:
    """Replace an RD table by CSV files. Rows that do not fit go to ``<table>_rejects``.

    With ``only_new`` nothing is written where the table holds these very files already.
    """
    files = _new_files(warehouse, f"rd.{table}", path) if only_new else None
    facts = None if files is None else {"files": files.contents()}
    if facts is not None and warehouse.facts("rd", table).get("all") == facts:
        return Published(warehouse.live("rd", table)["all"], 0)

    def load() -> Published:
        with warehouse.stage("landing") as folder:
            good, rejects = read_csv_landing(warehouse.spark, path, schema, sep, stage_dir=folder)
            warehouse.publish(rejects, "rd", f"{table}_rejects")
            done = warehouse.publish(good, "rd", table, facts=facts)
        if files is not None:
            note_loaded(warehouse, f"rd.{table}", files.new)
        return done

    return run_logged(warehouse, f"load {table}", load)


def full_reload(
    warehouse: Warehouse,
    df: DataFrame,
    table: str,
    keys: Sequence[str] | None = None,
    layer: str = "dm",
) -> Published:
    """Replace all rows of a mart. With ``keys``, duplicates keep the old rows live."""
    return run_logged(
        warehouse, f"reload {layer}.{table}", lambda: warehouse.publish(df, layer, table, keys=keys or ())
    )


def publish(warehouse: Warehouse, df: DataFrame, layer: str, table: str, period: str = "all") -> Published:
    """Replace a table, or one of its periods, and log it."""
    return run_logged(
        warehouse, f"publish {layer}.{table} {period}", lambda: warehouse.publish(df, layer, table, period)
    )


# Daily marts and the period report


def _last_day(first: date) -> date:
    return (first.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)


def _months(date_from: date, date_to: date) -> list[date]:
    if date_from.day != 1 or date_to != _last_day(date_to) or date_to < date_from:
        raise ValueError(f"{date_from} to {date_to} is not a run of whole months")
    months = [date_from]
    while _last_day(months[-1]) < date_to:
        months.append(_last_day(months[-1]) + timedelta(days=1))
    return months


def _inputs(warehouse: Warehouse) -> dict[str, DataFrame]:
    names = ("accounts", "currencies", "exchange_rates", "ledger_accounts")
    return {n: warehouse.read("ds", n, schema=INPUT_TABLES[n].schema) for n in names}


def _period_name(names: Sequence[str]) -> str:
    return names[0] if len(names) == 1 else f"{names[0]} to {names[-1]}"


def calculate_period(
    warehouse: Warehouse,
    date_from: date,
    date_to: date,
    on_missing_rate: str = "error",
    on_unbooked: str = "error",
) -> list[Published]:
    """Turnovers and balances of whole months, in one plan for each mart.

    The period opens with what the month before closed with, if that month was calculated,
    and with the loaded balances of the day before otherwise. Movements on unknown accounts
    or outside an account's validity are listed in ``dm_unbooked_f`` and stop the job; with
    ``on_unbooked='skip'`` the marts go on without them.

    Months that were calculated from the last of these before follow: what closing balances
    changed by is added to theirs, and all balances go live together.
    """
    names = [f"{m:%Y-%m}" for m in _months(date_from, date_to)]
    return [
        run_logged(
            warehouse,
            f"account turnover {_period_name(names)}",
            lambda: _turnover_months(warehouse, date_from, date_to, names, on_missing_rate, on_unbooked),
        ),
        run_logged(
            warehouse,
            f"account balance {_period_name(names)}",
            lambda: _balance_months(warehouse, date_from, date_to, names, on_missing_rate),
        ),
    ]


def _turnover_months(
    warehouse: Warehouse, first: date, last: date, names: list[str], on_missing_rate: str, on_unbooked: str
) -> Published:
    ds = _inputs(warehouse)
    facts = {name: {"postings": stamps} for name, stamps in _postings_of(warehouse, names).items()}
    postings = warehouse.read("ds", "postings", [*names, "all"], schemas.POSTINGS)
    rates_by_day = day_rates(ds["currencies"], ds["exchange_rates"], first, last)
    month = _mart_month("on_date")
    needed = postings.filter(F.col("on_date").between(F.lit(first), F.lit(last))).select(
        "on_date", "debit_account", "credit_account", "amount"
    )
    seen = Observation()
    posted = needed.observe(seen, F.coalesce(F.sum(to_cents(F.col("amount"))), F.lit(0)).alias("cents"))
    with warehouse.stage("movements") as folder:
        placed = placed_movements(account_movements(posted, first, last), ds["accounts"])
        placed.write.parquet(f"{folder}/rows")  # one pass over the postings for all that follows
        placed = warehouse.spark.read.schema(placed.schema).parquet(f"{folder}/rows")
        unbooked = placed.filter("reason IS NOT NULL").drop("currency_id")
        listed = warehouse.publish_periods(unbooked, "dm", UNBOOKED, month, names)
        if listed.rows and on_unbooked == "error":
            raise UnbookedMovements(f"{listed.rows} movements cannot be booked: see dm.{UNBOOKED}")
        movements = booked(placed, "skip")
        if on_missing_rate == "error":
            require_rates(movements, rates_by_day)
        turnover = valued_turnover(movements, rates_by_day, on_missing_rate)
        prepared = warehouse.prepare_periods(turnover, "dm", TURNOVER_MART, month, names)
        mart = _prepared_rows(warehouse, prepared, TURNOVER_MART, names, schemas.ACCOUNT_TURNOVER)
        _require_all_posted(needed, observed(seen, ["cents"])["cents"], mart, unbooked)
        warehouse.switch("dm", TURNOVER_MART, [prepared], facts)
        return prepared.published


def _prepared_rows(
    warehouse: Warehouse, prepared: Prepared, mart: str, months: Sequence[str], schema: T.StructType
) -> DataFrame:
    base = warehouse.table_dir("dm", mart)
    return warehouse.spark.read.schema(schema).parquet(*[prepared.path(base, m) for m in months])


def _require_all_posted(postings: DataFrame, cents: int, turnover: DataFrame, unbooked: DataFrame) -> None:
    """Debits and credits of the mart and of what it leaves out are as much as was posted.

    ``cents`` was counted while the postings were read. A task that ran twice may have
    counted twice, so where the sums differ the days are compared before anything is refused.
    """
    if movement_totals(turnover, unbooked) == (cents, cents):
        return
    legs = ["on_date", "debit", "credit"]
    days = days_that_differ(postings, turnover.select(*legs).unionByName(unbooked.select(*legs)))
    if days:
        raise ControlTotalsDiffer(f"turnovers are not what was posted on {', '.join(map(str, days))}")


def _postings_of(warehouse: Warehouse, months: Sequence[str]) -> dict[str, list[str]]:
    """The versions of the postings that each month is calculated from."""
    stamps = warehouse.stamps("ds", "postings")
    return {m: [stamps[p] for p in (m, "all") if p in stamps] for m in months}


def _opening_period(day: date) -> str:
    return f"opening-{day:%Y-%m-%d}"


def _first_day(month: str) -> date:
    return date.fromisoformat(f"{month}-01")


def _following(month: str) -> str:
    return f"{_last_day(_first_day(month)) + timedelta(days=1):%Y-%m}"


def _rates_by_month(rates_by_day: DataFrame) -> dict[str, str]:
    """For each month a digest of its rates that does not depend on their order. A row a month is collected."""
    each = F.xxhash64("currency_id", "on_date", "rate", "is_home").cast("decimal(38,0)")
    found = rates_by_day.groupBy(_month("on_date").alias("m")).agg(F.count("*").alias("n"), F.sum(each).alias("s"))
    return {r["m"]: f"{r['n']}:{r['s']}" for r in found.collect()}


_MONTHS_AT_ONCE = 12


def _accounts_by_month(accounts: DataFrame, months: Sequence[str]) -> dict[str, str]:
    """For each month a digest of the accounts valid in it, their currency, kind and valid days, in any order."""
    found: dict[str, str] = {}
    for start in range(0, len(months), _MONTHS_AT_ONCE):
        part, sums = months[start : start + _MONTHS_AT_ONCE], []
        for m in part:
            first, last = F.lit(_first_day(m)), F.lit(_last_day(_first_day(m)))
            days = F.greatest("valid_from", first), F.least("valid_to", last)
            each = F.xxhash64("account_id", "currency_id", "characteristic", *days).cast("decimal(38,0)")
            valid = days[0] <= days[1]
            sums += [F.count_if(valid).alias(f"n{m}"), F.sum(F.when(valid, each)).alias(f"s{m}")]
        row = accounts.agg(*sums).first()
        found |= {m: f"{row[f'n{m}']}:{row[f's{m}']}" for m in part}
    return found


def _loaded_openings(opening: DataFrame, days: Sequence[date]) -> dict[date, str]:
    """For each day a digest of the opening balances loaded for it, in any order."""
    each = F.xxhash64("account_id", "balance").cast("decimal(38,0)")
    rows = opening.filter(F.col("on_date").isin(list(days)))
    found = rows.groupBy("on_date").agg(F.count("*").alias("n"), F.sum(each).alias("s"))
    return {r["on_date"]: f"loaded {r['n']}:{r['s']}" for r in found.collect()}


def _last_days(warehouse: Warehouse, periods: Sequence[str]) -> DataFrame:
    """Balances in the runs in which they are stored, by the last day of each.

    Every month's end and every account's last valid day is the last day of a run; whoever
    asks for such a day only finds it here, and no other days are listed.
    """
    return warehouse.read("dm", BALANCE_MART, periods, schemas.ACCOUNT_BALANCE, in_runs="on_date")


def _balance_months(
    warehouse: Warehouse, first: date, last: date, names: list[str], on_missing_rate: str
) -> Published:
    ds = _inputs(warehouse)
    before = first - timedelta(days=1)
    earlier = f"{before:%Y-%m}"
    turnovers, balances = (warehouse.stamps("dm", mart) for mart in (TURNOVER_MART, BALANCE_MART))
    movements = warehouse.read("dm", TURNOVER_MART, names, schemas.ACCOUNT_TURNOVER)
    calculated = earlier in turnovers and earlier in balances
    if calculated:
        opening, source = _last_days(warehouse, [earlier]), balances[earlier]
    else:
        opening = warehouse.read("ds", "opening_balances", schema=schemas.OPENING_BALANCES)
        source = _loaded_openings(opening, [before]).get(before)
        if source is None:
            raise LookupError(f"{earlier} is not calculated and ds.opening_balances has no rows for {before}")
    start = first if calculated else before
    rates_by_day = day_rates(ds["currencies"], ds["exchange_rates"], start, last)
    if on_missing_rate == "error":
        require_rates(currency_days(ds["accounts"], start, last), rates_by_day)

    def balance(until: date, **days) -> DataFrame:
        return account_balance(
            opening, movements, ds["accounts"], rates_by_day, first, until, on_missing_rate, **days
        )

    months = warehouse.prepare_periods(
        balance(last, in_runs=True), "dm", BALANCE_MART, _mart_month("on_date"), names, sort_by=_BY_DAY, runs="on_date"
    )
    rates, accounts = _rates_by_month(rates_by_day), _accounts_by_month(ds["accounts"], names)
    openings = [source, *[f"{name}@{months.versions[name]}" for name in names]]
    facts = {
        name: {
            "turnover": turnovers.get(name), "opening": opened, "rates": rates.get(name), "accounts": accounts[name]
        }
        for name, opened in zip(names, openings)
    }
    stored = _prepared_rows(warehouse, months, BALANCE_MART, names, schemas.ACCOUNT_BALANCE)
    control = balance_control(stored, opening, movements, ds["accounts"], first, last).orderBy("currency_id").collect()
    wrong = [str(r["currency_id"]) for r in control if r["left_over"]]
    if wrong:
        raise ControlTotalsDiffer(f"balances do not move by what was posted in currencies {', '.join(wrong)}")
    totals = [[r["currency_id"], *[str(r[c]) for c in ("opening", "change", "closing")]] for r in control]
    facts[names[-1]]["control"] = {"from": str(first), "to": str(last), "totals": totals}
    prepared = [months]
    if not calculated:
        day = balance(first, with_opening_day=True, on_days=[before])  # later movements do not reach it
        prepared.append(warehouse.prepare(day, "dm", BALANCE_MART, _opening_period(before), sort_by=_BY_DAY))
    with warehouse.stage("carried") as folder:
        carried, carried_facts = _carried(warehouse, months, names[-1], openings[-1], on_missing_rate, folder)
        prepared += carried
        # A day that a calculated month holds is no opening day of its own any more.
        of_days = [p for p in balances if p.startswith("opening-")]
        days = {p: date.fromisoformat(p.removeprefix("opening-")) for p in of_days}
        over = [p for p, day in days.items() if first <= day <= last or (calculated and day == before)]
        warehouse.switch("dm", BALANCE_MART, prepared, facts | carried_facts, over)
    counts = {"calculated": months.published.rows, "carried": sum(c.published.rows for c in carried)}
    return Published(months.published.path, sum(counts.values()), counts)


_BY_DAY = ["on_date", "account_id"]  # the report and the next month read last days


def _months_behind(warehouse: Warehouse, month: str) -> tuple[list[str], str | None]:
    """Calculated months that follow ``month`` one from the other, and the live period that the first opened with."""
    facts, stamps = warehouse.facts("dm", BALANCE_MART), warehouse.stamps("dm", BALANCE_MART)
    following, opening_day = _following(month), _opening_period(_last_day(_first_day(month)))
    opened = facts.get(following, {}).get("opening")
    if opened is None:
        return [], None
    if opened == stamps.get(month):
        source = month
    elif opened.startswith("loaded ") and opening_day in stamps:
        source = opening_day
    else:
        return [], None  # it was calculated from something else and stays stale
    behind = [following]
    while facts.get(_following(behind[-1]), {}).get("opening") == stamps[behind[-1]]:
        behind.append(_following(behind[-1]))
    return behind, source


def _carried(
    warehouse: Warehouse, new: Prepared, month: str, stamp: str, on_missing_rate: str, folder: str
) -> tuple[list[Prepared], dict[str, dict]]:
    """Later months after the closing balances of ``month`` changed, prepared to go live with it.

    What an account's closing balance changed by is added to its balance on every later day
    of the months that were calculated from it; nothing else in them changes, and their
    movements are not read. Without a change they only note the version they follow.
    """
    behind, source = _months_behind(warehouse, month)
    if not behind:
        return [], {}
    ds, closing = _inputs(warehouse), F.col("on_date") == F.lit(_last_day(_first_day(month)))
    path = new.path(warehouse.table_dir("dm", BALANCE_MART), month)
    now = warehouse.spark.read.schema(schemas.ACCOUNT_BALANCE).parquet(path).filter(closing)
    then = _last_days(warehouse, [source]).filter(closing)
    both = now.select("account_id", F.col("balance").alias("now")).join(
        then.select("account_id", F.col("balance").alias("then")), "account_id", "full"
    )
    delta = (F.coalesce("now", F.lit(0)) - F.coalesce("then", F.lit(0))).cast(schemas.TOTAL)
    changed = both.select("account_id", delta.alias("delta")).filter("delta != 0")
    changed, small = stored_and_measured(
        changed.join(never_broadcast(ds["accounts"].select("account_id", "currency_id")), "account_id"),
        f"{folder}/delta",
    )
    facts, versions, prepared = warehouse.facts("dm", BALANCE_MART), {}, []
    if not changed.isEmpty():
        changed = F.broadcast(changed) if small else never_broadcast(changed)
        later = _last_days(warehouse, behind)
        first, last = _first_day(behind[0]), _last_day(_first_day(behind[-1]))
        rates_by_day = day_rates(ds["currencies"], ds["exchange_rates"], first, last)
        added = (F.col("balance") + F.col("delta")).cast(schemas.TOTAL).alias("balance")
        days = F.col(SINCE).alias("span_from"), F.col("on_date").alias("span_to")
        moved = later.join(changed, "account_id").select("account_id", "currency_id", *days, added)
        moved = valued_runs(moved, rate_runs(rates_by_day, ds["accounts"], first, last), on_missing_rate)
        same = later.join(changed, "account_id", "left_anti").select(*moved.columns)
        both = moved.unionByName(same)
        prepared.append(
            warehouse.prepare_periods(
                both, "dm", BALANCE_MART, _mart_month("on_date"), behind, sort_by=_BY_DAY, runs="on_date"
            )
        )
        versions = prepared[0].versions
    noted = {}
    for m in behind:
        noted[m] = {c: v for c, v in facts[m].items() if c != "control"} | {"opening": stamp}
        if not prepared:
            break  # the months behind the first follow the versions that are live
        stamp = f"{m}@{versions[m]}"
    return prepared, noted


def control_totals(warehouse: Warehouse) -> DataFrame:
    """Of each calculated run of months and currency what opened, moved and closed, as it was when it went live."""
    rows = [
        (noted["from"], noted["to"], *line)
        for noted in (f.get("control") for f in warehouse.facts("dm", BALANCE_MART).values())
        if noted is not None
        for line in noted["totals"]
    ]
    names = ("date_from", "date_to", "currency_id", "opening", "change", "closing")
    kinds = ("date", "date", "int", "decimal(38,2)", "decimal(38,2)", "decimal(38,2)")
    texts = ", ".join(f"{n} {'int' if n == 'currency_id' else 'string'}" for n in names)
    found = warehouse.spark.createDataFrame(rows, texts)
    return found.select([F.col(n).cast(kind).alias(n) for n, kind in zip(names, kinds)])


class StaleMonths(LookupError):
    """Something that months were calculated from has changed since."""


def stale_months(warehouse: Warehouse) -> dict[str, str]:
    """Calculated months, and why each no longer agrees with what it was calculated from.

    Versions of postings and turnovers, the balances a month opened with, its rates and the
    accounts valid in it are compared with what was noted when it was calculated. A month
    behind a stale one is stale. Months that no calculation published are not listed.
    """
    turnovers, balances = (warehouse.facts("dm", mart) for mart in (TURNOVER_MART, BALANCE_MART))
    of_turnover, of_balance = (warehouse.stamps("dm", mart) for mart in (TURNOVER_MART, BALANCE_MART))
    months = sorted(m for m, f in balances.items() if f)
    if not months:
        return {}
    ds = _inputs(warehouse)
    postings = _postings_of(warehouse, months)
    before = {m: _first_day(m) - timedelta(days=1) for m in months}
    loaded = {before[m] for m in months if balances[m]["opening"].startswith("loaded ")}
    openings = warehouse.read("ds", "opening_balances", schema=schemas.OPENING_BALANCES)
    digests = _loaded_openings(openings, sorted(loaded)) if loaded else {}
    first, last = _first_day(months[0]), _last_day(_first_day(months[-1]))
    rates = _rates_by_month(day_rates(ds["currencies"], ds["exchange_rates"], first, last))
    accounts = _accounts_by_month(ds["accounts"], months)
    stale: dict[str, str] = {}
    for m in months:
        noted, earlier = balances[m], f"{before[m]:%Y-%m}"
        opened = noted["opening"]
        if turnovers.get(m, {}).get("postings", []) != postings[m]:
            stale[m] = "its postings changed"
        elif noted["turnover"] != of_turnover.get(m):
            stale[m] = "its turnovers were calculated again"
        elif noted["rates"] != rates.get(m):
            stale[m] = "its rates changed"
        elif noted["accounts"] != accounts[m]:
            stale[m] = "its accounts changed"
        elif opened != (digests.get(before[m]) if opened.startswith("loaded ") else of_balance.get(earlier)):
            stale[m] = "its opening balances changed"
        elif opened.startswith("loaded ") and earlier in of_balance:
            stale[m] = f"{earlier} was calculated since"
        elif earlier in stale:
            stale[m] = f"{earlier} is stale"
    return stale


def build_form_101(warehouse: Warehouse, date_from: date, date_to: date) -> Published:
    """Report on a period whose marts were calculated. Each period is kept on its own.

    Months that no longer agree with what they were calculated from are refused.
    """
    months = [f"{m:%Y-%m}" for m in _months(date_from, date_to)]
    before = date_from - timedelta(days=1)

    def build() -> Published:
        turnovers, balances = (warehouse.live("dm", mart).keys() for mart in (TURNOVER_MART, BALANCE_MART))
        lacking = sorted({*months} - (turnovers & balances))
        opening = [p for p in (f"{before:%Y-%m}", _opening_period(before)) if p in balances]
        if lacking or not opening:
            raise LookupError(f"the marts lack {', '.join(lacking or [str(before)])}")
        stale = {m: why for m, why in stale_months(warehouse).items() if m in (f"{before:%Y-%m}", *months)}
        if stale:
            reasons = "; ".join(f"{m}: {why}" for m, why in stale.items())
            raise StaleMonths(f"calculate again before a report ({reasons})")
        ds = _inputs(warehouse)
        report = form_101(
            _last_days(warehouse, [*opening, *months]),
            warehouse.read("dm", TURNOVER_MART, months, schemas.ACCOUNT_TURNOVER),
            ds["accounts"], ds["currencies"], ds["ledger_accounts"], date_from, date_to,
        )
        return warehouse.publish(report, "dm", REPORT_MART, f"{date_from:%Y%m%d}-{date_to:%Y%m%d}")

    return run_logged(warehouse, f"form 101 {date_from} to {date_to}", build)


# CSV exchange


def export_mart(
    warehouse: Warehouse,
    table: str,
    path: str,
    periods: Sequence[str] | None = None,
    sep: str = ",",
    max_rows_per_file: int = 1_000_000,
    layer: str = "dm",
) -> int:
    """Export the live rows of a mart. Returns how many."""
    return run_logged(
        warehouse,
        f"export {layer}.{table}",
        lambda: export_csv(
            warehouse.read(layer, table, periods), path, sep, max_rows_per_file=max_rows_per_file
        ),
    )


def import_csv_new_table(
    warehouse: Warehouse, path: str, schema: T.StructType, table: str, layer: str = "dm", sep: str = ","
) -> Published:
    """Exported CSV into a table that does not exist yet.

    Where the folder has the manifest of an export, its files and rows must be those that
    were exported.
    """

    def load() -> Published:
        if warehouse.exists(layer, table):
            raise ValueError(f"{layer}.{table} exists")
        manifest = check_files(warehouse.spark, path)
        rows = read_csv(warehouse.spark, path, schema, sep, multi_line=True)
        prepared = warehouse.prepare(rows, layer, table, digest=manifest is not None)
        done = prepared.published
        if manifest is not None and (done.rows, done.digest) != (manifest["rows"], manifest["digest"]):
            raise IncompleteExport(f"the rows of {path} are not those that were exported")
        warehouse.switch(layer, table, [prepared])
        return done

    return run_logged(warehouse, f"import {layer}.{table}", load)


def reimport_csv(
    warehouse: Warehouse,
    path: str,
    schema: T.StructType,
    table: str,
    keys: Sequence[str],
    layer: str = "dm",
    sep: str = ",",
) -> DataFrame:
    """Replace a table by its changed CSV. Returns what changed, one row per key.

    The files are parsed once; the old and the new stored rows are compared. No file of the
    export may be absent.
    """
    before = warehouse.read(layer, table, schema=schema)

    def load() -> Published:
        check_files(warehouse.spark, path, edited=True)
        changed = read_csv(warehouse.spark, path, schema, sep, multi_line=True)
        return warehouse.publish(changed, layer, table, keys=keys)

    published = run_logged(warehouse, f"reimport {layer}.{table}", load)
    return table_diff(before, warehouse.spark.read.schema(schema).parquet(published.path), keys)


# Repair


@dataclass(frozen=True)
class Repair:
    """A repaired mart, and reports on what was wrong. The reports read stored rows."""

    published: Published
    reports: dict[str, DataFrame]


def refresh_client(
    warehouse: Warehouse, keys: Sequence[str], order_by: Sequence[Column] = (), table: str = "client"
) -> Repair:
    """Keep one row per key in a mart. Rows taken out are stored in ``<table>_removed``."""
    current = warehouse.read("dm", table)
    kept, removed = remove_duplicates(current, keys, order_by)

    def repair() -> Published:
        warehouse.publish(removed, "dm", f"{table}_removed")
        done = warehouse.publish(kept, "dm", table, keys=keys)
        warehouse.declare_keys("dm", table, keys)  # new duplicates are refused from now on
        return done

    published = run_logged(warehouse, f"remove duplicates from {table}", repair)
    return Repair(published, {"removed": warehouse.read("dm", f"{table}_removed", schema=current.schema)})


def refresh_loan_holiday(
    warehouse: Warehouse,
    path: str | list[str],
    schema: T.StructType,
    entity: str,
    date_col: str,
    build: Callable[[DataFrame], DataFrame] = lambda source: source,
    table: str = "loan_holiday_info",
    source_table: str = "loan_holiday",
    sep: str = ",",
    end_col: str | None = None,
    only_new: bool = False,
) -> Repair:
    """Load current CSV files to RD, report what the mart lacks, and fill it again.

    ``build`` turns the RD table into the rows of the mart. With ``end_col`` a row holds a
    period from ``date_col`` to it, and the reports are about periods instead of days. With
    ``only_new`` files that were loaded before are passed over, and a mart that was filled
    from them stays as it is.
    """
    load_snapshot(warehouse, source_table, path, schema, sep, only_new)
    rows = build(warehouse.read("rd", source_table, schema=schema))
    keys = [entity, date_col]
    facts = {"source": warehouse.stamps("rd", source_table)["all"]}

    def refresh() -> Published:
        if only_new and warehouse.facts("dm", table).get("all") == facts:
            return Published(warehouse.live("dm", table)["all"], 0)
        return warehouse.publish(rows, "dm", table, keys=keys, facts=facts)

    before = warehouse.read("dm", table, schema=rows.schema)
    published = run_logged(warehouse, f"refresh {table}", refresh)
    after = warehouse.read("dm", table, schema=rows.schema)
    if end_col is None:
        missing = missing_in_mart(after, before, keys)
        gaps = [find_period_gaps(mart, entity, date_col) for mart in (before, after)]
    else:
        missing = missing_intervals(after, before, entity, date_col, end_col)
        gaps = [find_interval_gaps(mart, entity, date_col, end_col) for mart in (before, after)]
    return Repair(published, {"missing": missing, "gaps_before": gaps[0], "gaps": gaps[1]})


def refresh_balance_turnover(
    warehouse: Warehouse,
    dims: Sequence[tuple[DataFrame, Sequence[str]]] = (),
    trust: str = "out",
    mode: str = "calendar",
    account: str = "account_id",
    day: str = "on_date",
    source_table: str = "account_balance_turnover",
    table: str = "account_balance_turnover",
    source_layer: str = "dm",
) -> Repair:
    """Correct in- or out-sums and rebuild the mart. Reports the days that did not agree."""
    current = warehouse.read(source_layer, source_table)

    def refresh() -> Published:
        assert_unique(current, [account, day])
        rebuilt = rebuild_balance_turnover(current, dims, trust, mode, account, day)
        return warehouse.publish(rebuilt, "dm", table)

    published = run_logged(warehouse, f"refresh {table}", refresh)
    return Repair(published, {"mismatches": find_mismatches(current, account, day, mode)})
