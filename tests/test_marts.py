from datetime import date, timedelta
from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from bank import ACCOUNTS, BEFORE, EUR, HOME, JAN, OPENING, POSTINGS, USD, d, table, tables
from saldomart.operators.calendar import account_day_grid
from saldomart.operators.ledger import second_order_account
from saldomart.operators.rates import day_rates
from saldomart.plans.balance import account_balance, balance_spans, with_movements
from saldomart.plans.control import balance_control
from saldomart.plans.form101 import form_101
from saldomart.plans.turnover import account_movements, account_turnover, placed_movements, unbooked_movements
from saldomart.sources.tables import every_day


def rates_by_day(spark, first=BEFORE, last=JAN[1]):
    return day_rates(table(spark, "currencies"), table(spark, "exchange_rates"), first, last)


def turnover(spark, postings=None, accounts=None, **options):
    return account_turnover(
        table(spark, "postings", postings), table(spark, "accounts", accounts), rates_by_day(spark), *JAN, **options
    )


def balance(spark, **options):
    return account_balance(
        table(spark, "opening_balances"), turnover(spark), table(spark, "accounts"), rates_by_day(spark), *JAN, **options
    )


def test_turnover(spark):
    found = {
        (r["account_id"], r["on_date"].day): (r["debit"], r["credit"], r["debit_home"], r["credit_home"])
        for r in turnover(spark).collect()
    }
    D = Decimal
    assert found == {
        (10, 1): (D("7.50"), D("1.00"), D("7.50"), D("1.00")),
        (11, 1): (D("1.00"), D("7.50"), D("1.00"), D("7.50")),
        (20, 15): (D("3.33"), D(0), D("3.33") * D("57.123456"), D(0)),
        (21, 15): (D(0), D("3.33"), D(0), D("3.33") * D("57.123456")),
        (20, 16): (D("4.00"), D("4.00"), D(240), D(240)),
        (11, 31): (D("7.00"), D(0), D("7.00"), D(0)),
        (10, 31): (D(0), D("7.00"), D(0), D("7.00")),
    }


def test_debits_and_credits_count_as_many_as_postings(spark):
    sums = account_movements(table(spark, "postings"), *JAN).agg(F.sum("debit"), F.sum("credit")).first()
    assert sums[0] == sums[1] == sum(p[4] for p in POSTINGS if p[1] <= JAN[1])


def test_unknown_accounts(spark):
    postings = [*POSTINGS, (8, d(2), 999, 10, Decimal("1.00")), (9, d(3), 10, None, Decimal("1.00"))]
    with pytest.raises(Exception, match="unknown account"):
        turnover(spark, postings).collect()
    assert turnover(spark, postings, on_unbooked="skip").filter("account_id not in (10, 11, 20, 21)").count() == 0
    reported = unbooked_movements(account_movements(table(spark, "postings", postings), *JAN), table(spark, "accounts"))
    assert {r["account_id"] for r in reported.collect()} == {999, None}


def test_missing_rate_stops_the_mart(spark):
    accounts = [*ACCOUNTS, (40, EUR, "A", "30110", date(2017, 1, 1), None)]
    postings = [*POSTINGS, (8, d(2), 40, 10, Decimal("2.00"))]
    with pytest.raises(Exception, match="no rate for currency 3 on 2018-01-02"):
        turnover(spark, postings, accounts).collect()
    row = turnover(spark, postings, accounts, on_missing_rate="one").filter("account_id = 40").first()
    assert row["debit_home"] == Decimal("2.00")


def test_grid(spark):
    days = {}
    for r in account_day_grid(table(spark, "accounts"), *JAN).collect():
        days.setdefault(r["account_id"], set()).add(r["on_date"])
    assert {a: len(v) for a, v in days.items()} == {10: 31, 11: 31, 20: 31, 21: 11}
    assert (min(days[21]), max(days[21])) == (d(10), d(20))


def day_by_day(accounts, opening, postings, first, last):
    """The same balances by adding one valid day to the one before."""
    found = {}
    for account, _, kind, _, valid_from, valid_to in accounts:
        sign = 1 if kind == "A" else -1
        before = first - timedelta(days=1)
        held = next((b for a, on, b in opening if a == account and on == before), Decimal(0))
        if valid_from > before:
            held = Decimal(0)
        day = first
        while day <= last:
            if valid_from <= day and (valid_to is None or day <= valid_to):
                held += sign * sum(p[4] for p in postings if p[1] == day and p[2] == account)
                held -= sign * sum(p[4] for p in postings if p[1] == day and p[3] == account)
                found[account, day] = held
            day += timedelta(days=1)
    return found


def test_balance_equals_day_by_day(spark):
    rows = balance(spark).collect()
    found = {(r["account_id"], r["on_date"]): r["balance"] for r in rows}
    assert len(found) == len(rows)
    assert found == day_by_day(ACCOUNTS, OPENING, POSTINGS, *JAN)


def test_only_valid_days_count(spark):
    postings = [(i, d(n), 10, 21, Decimal(i)) for i, n in enumerate((5, 10, 15, 20, 25), 1)]
    opening = [*OPENING, (21, BEFORE, Decimal("1000.00"))]
    spans = balance_spans(
        table(spark, "opening_balances", opening), account_movements(table(spark, "postings", postings), *JAN),
        table(spark, "accounts"), *JAN,
    ).filter("account_id = 21").orderBy("span_from").collect()
    assert [(r["span_from"].day, r["span_to"].day, r["balance"]) for r in spans] == [(10, 14, 2), (15, 19, 5), (20, 20, 9)]


def test_spans_cover_every_day_once(spark):
    spans = balance_spans(
        table(spark, "opening_balances"), account_movements(table(spark, "postings"), *JAN), table(spark, "accounts"), *JAN
    )
    days = spans.select("account_id", F.explode(F.sequence("span_from", "span_to")).alias("on_date"))
    grid = account_day_grid(table(spark, "accounts"), *JAN)
    assert days.exceptAll(grid).count() == grid.exceptAll(days).count() == 0


def test_home_value_moves_with_the_rate(spark):
    home = {r["on_date"]: r["balance_home"] for r in balance(spark).filter("account_id = 20").collect()}
    assert home[d(14)] == Decimal("10.00") * Decimal("57.123456")
    assert home[d(16)] == Decimal("13.33") * 60


def test_some_days_only(spark):
    every = {tuple(r) for r in balance(spark, with_opening_day=True).collect()}
    some = {tuple(r) for r in balance(spark, with_opening_day=True, on_days=[BEFORE, d(31)]).collect()}
    assert some == {r for r in every if r[0] in (BEFORE, d(31))}
    assert {r[1]: r[2] for r in some if r[0] == BEFORE} == {a: b for a, _, b in OPENING}


def test_neither_active_nor_passive(spark):
    accounts = [(10, HOME, "X", "40502", date(2017, 1, 1), None)]
    spans = balance_spans(
        table(spark, "opening_balances"), account_movements(table(spark, "postings"), *JAN),
        table(spark, "accounts", accounts), *JAN,
    )
    with pytest.raises(Exception, match="neither active nor passive"):
        spans.collect()


def test_report(spark):
    t = tables(spark)
    report = form_101(
        balance(spark, with_opening_day=True), turnover(spark), t["accounts"], t["currencies"], t["ledger_accounts"], *JAN
    )
    rows = {(r["ledger2"], r["characteristic"]): r.asDict() for r in report.collect()}
    assert rows.keys() == {("40502", "A"), ("40502", "P"), ("30110", "A"), ("30110", "P")}
    D = Decimal
    home = rows["40502", "A"]
    assert (home["balance_in_rub"], home["turn_deb_rub"], home["turn_cre_rub"], home["balance_out_rub"]) == (
        D("100.00"), D("7.50"), D("8.00"), D("99.50"),
    )
    foreign = rows["30110", "A"]
    assert foreign["balance_in_val"] == D("571.23")
    assert foreign["turn_deb_val"] == D("430.22")
    assert foreign["balance_out_val"] == D("799.80")
    assert rows["30110", "P"]["balance_out_val"] == D("199.80")  # closed on the 20th, its last balance
    for row in rows.values():
        sign = 1 if row["characteristic"] == "A" else -1
        for name in ("balance_in", "turn_deb", "turn_cre", "balance_out"):
            assert row[f"{name}_total"] == row[f"{name}_rub"] + row[f"{name}_val"]
        assert row["balance_in_rub"] + sign * (row["turn_deb_rub"] - row["turn_cre_rub"]) == row["balance_out_rub"]
    assert rows["40502", "P"]["name"] == "Accounts"


def test_second_order_account_from_the_number(spark):
    df = spark.createDataFrame([("40502810000000000001",), ("12345000",)], "number string")
    found = second_order_account(df, table(spark, "ledger_accounts"), "number").select("ledger2", "name").collect()
    assert {tuple(r) for r in found} == {("40502", "Accounts"), ("12345", None)}


def test_postings_are_read_once_for_both_marts(spark):
    t = tables(spark)
    movements = turnover(spark)
    both = form_101(
        account_balance(
            t["opening_balances"], movements, t["accounts"], rates_by_day(spark), *JAN,
            with_opening_day=True, on_days=[BEFORE, d(31)], on_last_day=True,
        ),
        movements, t["accounts"], t["currencies"], t["ledger_accounts"], *JAN,
    )
    both.collect()
    assert "ReusedExchange" in both._jdf.queryExecution().executedPlan().toString()


def _runs_and_days(spark, currencies, rates, on_missing_rate):
    by_day = day_rates(table(spark, "currencies", currencies), table(spark, "exchange_rates", rates), BEFORE, JAN[1])
    given = table(spark, "opening_balances"), turnover(spark), table(spark, "accounts"), by_day, *JAN
    return [account_balance(*given, on_missing_rate, with_opening_day=True, in_runs=r) for r in (True, False)]


@pytest.mark.parametrize("currencies", [None, [(HOME, True), (HOME, True), (USD, False)]])
def test_runs_are_the_days(spark, currencies):
    """Also with days without a rate, a rate that comes back, and a currency that is listed twice."""
    rates = [
        (USD, d(2), d(9), Decimal("57.000000")),
        (USD, d(12), d(15), Decimal("57.000000")),
        (USD, d(16), d(17), Decimal("60.000000")),
        (USD, d(18), d(30), Decimal("57.000000")),
    ]
    runs, days = _runs_and_days(spark, currencies, rates, "one")
    shown = days.columns
    assert sorted(every_day(runs, "on_date").select(shown).collect()) == sorted(days.collect())
    assert runs.count() < days.count() / 3
    assert runs.filter("trunc(_since, 'month') != trunc(on_date, 'month')").count() == 0


def test_runs_without_a_rate(spark):
    runs, _ = _runs_and_days(spark, None, [(USD, date(2017, 12, 1), d(9), Decimal("57.000000"))], "error")
    with pytest.raises(Exception, match=f"no rate for currency {USD} on 2018-01-1"):
        runs.collect()


def test_days_meet_their_movements_after_the_join(spark):
    runs, days = _runs_and_days(spark, None, None, "error")
    moved = turnover(spark)
    moved = moved.unionByName(moved.filter("account_id = 10"))  # two rows for a day give two
    expected = days.join(moved, ["on_date", "account_id"], "left")
    found = with_movements(runs, moved)
    assert found.columns == expected.columns
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(found.collect(), key=key) == sorted(expected.collect(), key=key)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(sequence(_since") < plan.index("Join")  # days are listed above the join


def test_runs_are_parted_at_their_movements(spark):
    """Movements anywhere in a run, on days in a row and twice on a day; nothing is looked up day by day."""
    draw, runs, moved = Random(3), [], []
    for account in range(1, 9):
        first = 1
        while first <= 31:
            last = min(31, first + draw.randrange(9))
            runs.append((d(last), account, Decimal(first), d(first)))
            first = last + 1 + draw.randrange(2)
        moved += [(d(draw.randrange(1, 32)), account, Decimal(i + 1)) for i in range(2 * account)]
    moved += [(d(4), None, Decimal(1)), (d(4, 2), 1, Decimal(1))]
    runs += [(d(1), 8, Decimal(0), d(1)), (d(31), None, Decimal(0), d(1)), (d(9, 3), 8, Decimal(0), d(2, 3))]
    balances = spark.createDataFrame(runs, "on_date date, account_id long, balance decimal(25,2), _since date")
    turnovers = spark.createDataFrame(moved, "on_date date, account_id long, debit decimal(25,2)")
    found = with_movements(balances, turnovers)
    expected = []
    for last, account, balance, first in runs:
        for n in range((last - first).days + 1):
            day = first + timedelta(days=n)
            of_day = [m[2] for m in moved if account is not None and m[:2] == (day, account)]
            expected += [(day, account, balance, debit) for debit in of_day or [None]]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(str((a, b, c.quantize(Decimal("0.01")), e and e.quantize(Decimal("0.01")))) for a, b, c, e in expected)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("explode(sequence(_since")]
    assert "_moved" not in above and "lambda" not in above


def test_tables_that_grow_with_accounts_are_not_broadcast(spark):
    t, runs = tables(spark), _runs_and_days(spark, None, None, "error")[0]
    moved, runs = account_movements(t["postings"], *JAN), spark.createDataFrame(runs.collect(), runs.schema)

    def broadcasts(df):
        return df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")

    assert broadcasts(placed_movements(moved, t["accounts"])) == 0
    assert broadcasts(balance_spans(t["opening_balances"], moved, t["accounts"], *JAN)) == 0
    assert broadcasts(with_movements(runs, moved)) == 0
    control = balance_control(runs, t["opening_balances"], moved, t["accounts"], *JAN)
    assert broadcasts(control) == 1  # accounts that close inside the period, measured to be few
