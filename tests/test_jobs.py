from collections import Counter
from datetime import date, timedelta
from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from bank import ACCOUNTS, BEFORE, EUR, JAN, OPENING, POSTINGS, RATES, ROWS, USD, d, publish_inputs, table
from saldomart.operators.duplicates import DuplicateKeys
from saldomart.operators.rates import MissingRate
from saldomart.plans import jobs
from saldomart.plans.audit import compact_log, etl_log, run_logged, unended
from saldomart.plans.control import ControlTotalsDiffer
from saldomart.plans.turnover import UnbookedMovements
from saldomart.sources.csv import IncompleteExport, export_csv
from saldomart.sources.ledger import compact_ledger, loaded_files
from test_marts import day_by_day

FEB = (date(2018, 2, 1), date(2018, 2, 28))


def logged(warehouse):
    return {(r["task"], r["rows_affected"], r["status"]) for r in etl_log(warehouse).collect()}


# log


def test_log_rows(spark, warehouse):
    run_logged(warehouse, "three", lambda: warehouse.publish(spark.range(3), "ds", "t"))
    run_logged(warehouse, "none", lambda: 0)
    with pytest.raises(ZeroDivisionError):
        run_logged(warehouse, "bad", lambda: 1 // 0)
    rows = {r["task"]: r for r in etl_log(warehouse).collect()}
    assert (rows["three"]["rows_affected"], rows["three"]["status"], rows["three"]["error_text"]) == (3, "SUCCESS", None)
    assert (rows["none"]["rows_affected"], rows["none"]["status"]) == (0, "SUCCESS")
    assert (rows["bad"]["status"], "division" in rows["bad"]["error_text"]) == ("ERROR", True)
    assert all(r["started_at"] <= r["ended_at"] for r in rows.values())


def test_empty_log(warehouse):
    assert etl_log(warehouse).count() == 0


def test_spark_failure_is_logged_without_a_stack(spark, warehouse):
    broken = spark.range(1).select(F.raise_error(F.lit("broken row")).cast("long").alias("id"))
    with pytest.raises(Exception):
        run_logged(warehouse, "bad", lambda: warehouse.publish(broken, "ds", "t"))
    text = etl_log(warehouse).first()["error_text"]
    assert "broken row" in text and "at org.apache" not in text


def test_a_killed_operation_is_listed(spark, warehouse):
    def killed():
        assert [r["task"] for r in unended(warehouse).collect()] == ["killed"]
        raise SystemExit

    run_logged(warehouse, "good", lambda: 5)
    with pytest.raises(SystemExit):
        run_logged(warehouse, "killed", killed)
    run_logged(warehouse, "later", lambda: 6)
    assert logged(warehouse) == {("good", 5, "SUCCESS"), ("killed", None, "STARTED"), ("later", 6, "SUCCESS")}
    left = unended(warehouse).first()
    assert left["task"] == "killed" and left["ended_at"] is None and left["started_at"] is not None


def test_the_log_is_compacted_into_one_file(spark, warehouse, tmp_path):
    for n in range(4):
        run_logged(warehouse, f"task {n}", lambda: n)
    before = sorted(map(tuple, etl_log(warehouse).collect()))
    assert compact_log(warehouse) == 4
    folder = tmp_path / "warehouse/logs/etl_log"
    assert not list(folder.glob("notes/*.json")) and not list(folder.glob("open/*.json"))
    assert len(list(folder.glob("all/v1/*.parquet"))) == 1
    assert sorted(map(tuple, etl_log(warehouse).collect())) == before
    run_logged(warehouse, "task 4", lambda: 4)
    assert compact_log(warehouse) == 5 and etl_log(warehouse).count() == 5


def test_a_compaction_that_stopped_halfway_lists_nothing_twice(spark, warehouse, tmp_path):
    run_logged(warehouse, "one", lambda: 1)
    files = {f: f.read_text() for f in (tmp_path / "warehouse/logs/etl_log/notes").glob("*.json")}
    compact_log(warehouse)
    for f, text in files.items():
        f.write_text(text)
    assert logged(warehouse) == {("one", 1, "SUCCESS")} and etl_log(warehouse).count() == 1


# loading


def test_a_refresh_takes_only_new_files(spark, warehouse, tmp_path):
    paths = [str(tmp_path / "one"), str(tmp_path / "two")]
    export_csv(table(spark, "postings", POSTINGS[:3]).coalesce(1), paths[0])
    jobs.load_csv(warehouse, "postings", paths[0], only_new=True)
    export_csv(table(spark, "postings", POSTINGS[3:]).coalesce(1), paths[1])
    done = jobs.load_csv(warehouse, "postings", paths, only_new=True)
    assert done.counts == {"inserted": 4, "updated": 0, "unchanged": 3}
    live = warehouse.live("ds", "postings")
    again = jobs.load_csv(warehouse, "postings", [f"{p}/*.csv" for p in paths], only_new=True)
    assert (again.rows, warehouse.live("ds", "postings")) == (0, live)
    assert sorted((t, n) for t, n, _ in logged(warehouse)) == [
        ("load postings", 3), ("load postings", 4),
        ("pass over 1 known files of ds.postings", 0), ("pass over 2 known files of ds.postings", 0),
    ]
    assert loaded_files(warehouse).count() == 2 and compact_ledger(warehouse) == 2


def test_a_file_is_known_by_its_content(spark, warehouse, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    head = "account_id,on_date,balance\n"
    (folder / "a.csv").write_text(f"{head}1,2017-12-31,5.00\n2,2017-12-31,6.00\n")
    jobs.load_csv(warehouse, "opening_balances", str(folder), only_new=True)
    (folder / "a.csv").write_text(f"{head}2,2017-12-31,6.00\n1,2017-12-31,5.00\n")  # written anew, rows in another order
    assert jobs.load_csv(warehouse, "opening_balances", str(folder), only_new=True).rows == 0
    (folder / "a.csv").write_text(f"{head}1,2017-12-31,7.00\n2,2017-12-31,6.00\n")  # the same size
    done = jobs.load_csv(warehouse, "opening_balances", str(folder), only_new=True)
    assert done.counts == {"inserted": 0, "updated": 1, "unchanged": 1}
    with pytest.raises(FileNotFoundError):
        jobs.load_csv(warehouse, "opening_balances", str(tmp_path / "none"), only_new=True)


def test_dates_of_a_load_follow_their_file(spark, warehouse, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    head = "account_id,on_date,balance\n"
    (folder / "a.csv").write_text(f"{head}1,01/02/2018,1\n2,31/01/2018,2\n")
    (folder / "b.csv").write_text(f"{head}3,01/02/2018,3\n4,01/31/2018,4\n")
    (folder / "c.csv").write_text(f"{head}5,01/02/2018,5\n6,02/02/2018,6\n7,x,7\n8,,8\n")
    formats = ("dd/MM/yyyy", "MM/dd/yyyy")
    jobs.load_csv(warehouse, "opening_balances", str(folder), formats=formats, formats_by_file=True)
    found = {r["account_id"]: r["on_date"] for r in warehouse.read("ds", "opening_balances").collect()}
    assert found == {1: d(1, 2), 2: d(31), 3: d(2), 4: d(31), 6: d(2, 2), 8: None}
    rejects = {r["raw_row"]: r["reason"] for r in warehouse.read("ds", "opening_balances_rejects").collect()}
    assert rejects == {"5,01/02/2018,5": "ambiguous date: on_date", "7,x,7": "bad date: on_date"}


def test_six_files(spark, warehouse, tmp_path):
    for name, rows in ROWS.items():
        export_csv(table(spark, name), str(tmp_path / name))
        jobs.load_csv(warehouse, name, str(tmp_path / name))
        found = warehouse.read("ds", name)
        assert Counter(map(tuple, found.collect())) == Counter(rows)
        assert warehouse.read("ds", f"{name}_rejects").count() == 0
    assert {(t, s) for t, _, s in logged(warehouse)} == {(f"load {n}", "SUCCESS") for n in ROWS}
    assert sorted(warehouse.live("ds", "postings")) == ["2018-01", "2018-02"]


def test_mixed_dates_and_bad_rows(spark, warehouse, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(
        "account_id,on_date,balance\n1,31.12.2017,5.00\n2,20171231,6.00\n3,31-12-2017,7\n4,2017-12-31,8\n"
        "5,31.02.2018,9\nx,2017-12-31,1\n7,,3\n"
    )
    done = jobs.load_csv(warehouse, "opening_balances", str(folder))
    assert (done.rows, done.counts) == (5, {"inserted": 5, "updated": 0, "unchanged": 0})
    found = {r["account_id"]: r["on_date"] for r in warehouse.read("ds", "opening_balances").collect()}
    assert found == {1: BEFORE, 2: BEFORE, 3: BEFORE, 4: BEFORE, 7: None}
    rejects = {r["raw_row"]: r["reason"] for r in warehouse.read("ds", "opening_balances_rejects").collect()}
    assert rejects == {
        "x,2017-12-31,1": "does not fit the schema",
        "5,31.02.2018,9": "bad date: on_date",
    }


def test_second_load_rewrites_only_its_months(spark, warehouse, tmp_path):
    export_csv(table(spark, "postings"), str(tmp_path / "one"))
    jobs.load_csv(warehouse, "postings", str(tmp_path / "one"))
    before = warehouse.live("ds", "postings")
    more = [(7, d(1, 2), 10, 20, Decimal("1.00")), (8, d(2, 2), 10, 20, Decimal("2.00"))]
    export_csv(table(spark, "postings", more), str(tmp_path / "two"))
    done = jobs.load_csv(warehouse, "postings", str(tmp_path / "two"))
    assert done.counts == {"inserted": 1, "updated": 1, "unchanged": 0}
    after = warehouse.live("ds", "postings")
    assert after["2018-01"] == before["2018-01"] and after["2018-02"] != before["2018-02"]
    assert set(map(tuple, warehouse.read("ds", "postings").collect())) == {*POSTINGS[:-1], *more}


def test_a_posting_moves_to_the_month_of_its_corrected_date(spark, warehouse, tmp_path):
    export_csv(table(spark, "postings"), str(tmp_path / "one"))
    jobs.load_csv(warehouse, "postings", str(tmp_path / "one"))
    moved = [(7, d(6), 10, 20, Decimal("9.99")), (1, d(3, 3), 10, 11, Decimal("5.00"))]
    export_csv(table(spark, "postings", moved), str(tmp_path / "two"))
    done = jobs.load_csv(warehouse, "postings", str(tmp_path / "two"))
    assert done.counts == {"inserted": 0, "updated": 2, "unchanged": 5}
    assert set(map(tuple, warehouse.read("ds", "postings").collect())) == {*POSTINGS[1:-1], *moved}
    assert warehouse.read("ds", "postings", ["2018-02"]).count() == 0
    assert [r["posting_id"] for r in warehouse.read("ds", "postings", ["2018-03"]).collect()] == [1]


def test_rows_that_cannot_be_booked_are_kept_load_by_load(spark, warehouse, tmp_path):
    for load, lines in enumerate((["1,05.01.2018,10,11,1.00", "2,,10,11,2", "3,20180105,10,11,"], ["4,2018-01-05,10,,1", "5,x,1"])):
        folder = tmp_path / str(load)
        folder.mkdir()
        (folder / "a.csv").write_text("\n".join(["posting_id,on_date,debit_account,credit_account,amount", *lines]) + "\n")
        jobs.load_csv(warehouse, "postings", str(folder))
    assert [r["posting_id"] for r in warehouse.read("ds", "postings").collect()] == [1]
    rejects = {r["raw_row"]: r["reason"] for r in warehouse.read("ds", "postings_rejects").collect()}
    assert rejects == {
        "2,,10,11,2": "no on_date",
        "3,20180105,10,11,": "no amount",
        "4,2018-01-05,10,,1": "no credit_account",
        "5,x,1": "does not fit the schema",
    }
    assert len(warehouse.live("ds", "postings_rejects")) == 2


def test_jobs_of_a_load_do_not_follow_the_months(spark, warehouse, tmp_path):
    def jobs_for(months):
        rows = [(i, date(2000 + i // 12, i % 12 + 1, 5), 10, 11, Decimal("1.00")) for i in range(months)]
        export_csv(table(spark, "postings", rows), str(tmp_path / f"m{months}"))
        group = f"load of {months} months"
        spark.sparkContext.setJobGroup(group, group)
        name = f"postings{months}"
        jobs.load_csv(warehouse, name, str(tmp_path / f"m{months}"), jobs.INPUT_TABLES["postings"])
        spark.sparkContext.setJobGroup("other", "other")
        assert len(warehouse.live("ds", name)) == months
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs_for(40) <= jobs_for(2) + 1


def test_declared_keys_stay(spark, warehouse):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id int, v string, ver int")
    warehouse.publish(df, "dm", "client")
    jobs.refresh_client(warehouse, ["id"], [F.desc("ver")])
    with pytest.raises(DuplicateKeys, match="1 duplicate keys in id of dm.client: see dm.client_duplicates"):
        warehouse.publish(df, "dm", "client")
    assert [tuple(r) for r in warehouse.read("dm", "client_duplicates").collect()] == [(1, 2)]
    assert warehouse.read("dm", "client").count() == 2


# marts


def test_two_months(spark, warehouse):
    publish_inputs(spark, warehouse)
    jobs.calculate_period(warehouse, JAN[0], FEB[1])
    balance = warehouse.read("dm", jobs.BALANCE_MART)
    found = {(r["account_id"], r["on_date"]): r["balance"] for r in balance.collect()}
    expected = day_by_day(ACCOUNTS, OPENING, POSTINGS, JAN[0], FEB[1])
    opening = {(a, on): b for a, on, b in OPENING}
    assert found == {**opening, **expected}
    jobs.calculate_period(warehouse, *FEB)
    again = {(r["account_id"], r["on_date"]): r["balance"] for r in warehouse.read("dm", jobs.BALANCE_MART).collect()}
    assert again == found


def _stored_rows(spark, warehouse, months):
    live = warehouse.live("dm", jobs.BALANCE_MART)
    return sum(spark.read.parquet(live[m]).count() for m in months)


def test_stored_balances_grow_with_movements_and_not_with_days(spark, warehouse):
    publish_inputs(spark, warehouse)
    jobs.calculate_period(warehouse, JAN[0], FEB[1])
    # January: 10 and 11 from the 1st and the 31st, 20 from the 1st, 15th and 16th, 21 from the 10th, 15th and 16th.
    assert _stored_rows(spark, warehouse, ["2018-01"]) == 10
    assert _stored_rows(spark, warehouse, ["2018-02"]) == 3  # 10, 11 and 20; what moves on the 1st moves all of February
    assert ("account balance 2018-01 to 2018-02", 3 * 59 + 11, "SUCCESS") in logged(warehouse)
    assert warehouse.read("dm", jobs.BALANCE_MART, ["2018-01", "2018-02"]).count() == 3 * 59 + 11
    warehouse.publish(table(spark, "opening_balances", [(10, BEFORE, Decimal("500.00"))]), "ds", "opening_balances")
    jobs.calculate_period(warehouse, *JAN)
    assert _stored_rows(spark, warehouse, ["2018-02"]) == 3


def test_marts_of_seven_years(spark, warehouse):
    """The whole history in one plan, against sums day by day."""
    first, last, before = date(2011, 1, 1), date(2017, 12, 31), date(2010, 12, 31)
    random = Random(7)
    accounts = [(a, USD if a % 3 == 0 else 1, "AP"[a % 2], "40502", date(2009, 1, 1) if a % 5 else date(2013, 3, 9), None if a % 4 else date(2016, 7, 4)) for a in range(1, 13)]
    days = [first + timedelta(days=random.randrange(2557)) for _ in range(400)]
    valid = {a[0]: (a[4], a[5] or last) for a in accounts}
    postings = []
    for i, day in enumerate(days):
        open_now = [a for a, (begin, end) in valid.items() if begin <= day <= end]
        postings.append((i, day, *random.sample(open_now, 2), Decimal(random.randrange(1, 10**6)) / 100))
    opening = [(a, before, Decimal(100 * a)) for a in range(1, 13) if a % 5]
    rates = [(USD, date(2009 + i, 1, 1), date(2009 + i, 12, 31), Decimal(30 + i)) for i in range(10)]
    publish_inputs(spark, warehouse, accounts=accounts, opening_balances=opening, exchange_rates=rates, postings=[])
    warehouse.switch("ds", "postings", [], drop=["all"])
    _by_month(spark, warehouse, postings)
    jobs.calculate_period(warehouse, first, last)
    expected = day_by_day(accounts, opening, postings, first, last)
    assert _balances(warehouse) == {**{(a, on): b for a, on, b in opening}, **expected}
    foreign = {a for a in valid if a % 3 == 0}
    assert _home(warehouse) == {
        (a, on): b * (30 + on.year - 2009 if a in foreign else 1) for (a, on), b in _balances(warehouse).items()
    }
    sums = Counter()
    for _, day, debit, credit, amount in postings:
        sums[debit, day, "debit"] += amount
        sums[credit, day, "credit"] += amount
    found = Counter()
    for r in warehouse.read("dm", jobs.TURNOVER_MART).collect():
        found[r["account_id"], r["on_date"], "debit"] = r["debit"]
        found[r["account_id"], r["on_date"], "credit"] = r["credit"]
    assert +found == +sums


def test_a_day_that_became_empty_disappears(spark, warehouse):
    publish_inputs(spark, warehouse)
    jobs.calculate_period(warehouse, *JAN)
    warehouse.publish(table(spark, "postings", POSTINGS[:3]), "ds", "postings")
    jobs.calculate_period(warehouse, *JAN)
    days = {r["on_date"] for r in warehouse.read("dm", jobs.TURNOVER_MART).collect()}
    assert days == {d(1)}


def test_missing_rates_are_listed(spark, warehouse):
    accounts = [*ACCOUNTS, (40, EUR, "A", "30110", d(30), None)]
    publish_inputs(spark, warehouse, accounts=accounts)
    with pytest.raises(MissingRate, match=r"2 pairs .*\(3, 2018-01-30\), \(3, 2018-01-31\)"):
        jobs.calculate_period(warehouse, *JAN)
    assert ("account balance 2018-01", 0, "ERROR") in logged(warehouse)
    jobs.calculate_period(warehouse, *JAN, on_missing_rate="one")


def test_a_corrected_opening_reaches_the_balances(spark, warehouse):
    publish_inputs(spark, warehouse)
    jobs.calculate_period(warehouse, *JAN)
    corrected = [(10, BEFORE, Decimal("500.00")), *OPENING[1:]]
    warehouse.publish(table(spark, "opening_balances", corrected), "ds", "opening_balances")
    jobs.calculate_period(warehouse, *JAN)
    found = {(r["account_id"], r["on_date"]): r["balance"] for r in warehouse.read("dm", jobs.BALANCE_MART).collect()}
    expected = day_by_day(ACCOUNTS, corrected, POSTINGS, *JAN)
    assert found == {**{(a, on): b for a, on, b in corrected}, **expected}


def _balances(warehouse):
    return {(r["account_id"], r["on_date"]): r["balance"] for r in warehouse.read("dm", jobs.BALANCE_MART).collect()}


def _home(warehouse):
    return {(r["account_id"], r["on_date"]): r["balance_home"] for r in warehouse.read("dm", jobs.BALANCE_MART).collect()}


def _report_agrees(warehouse):
    """What a report opens with and moves is what it closes with, in home currency."""
    for r in warehouse.read("dm", jobs.REPORT_MART).collect():
        change = r["turn_deb_rub"] - r["turn_cre_rub"]
        assert r["balance_in_rub"] + (change if r["characteristic"] == "A" else -change) == r["balance_out_rub"]


MARCH = (d(1, 3), d(31, 3))


@pytest.mark.parametrize("together", [True, False])
def test_a_correction_reaches_the_months_behind(spark, warehouse, together):
    publish_inputs(spark, warehouse)
    for period in [(JAN[0], MARCH[1])] if together else [JAN, FEB, MARCH]:
        jobs.calculate_period(warehouse, *period)
    assert jobs.stale_months(warehouse) == {}
    turnovers = warehouse.live("dm", jobs.TURNOVER_MART)
    corrected = [(10, BEFORE, Decimal("500.00")), OPENING[1], (20, BEFORE, Decimal("11.50"))]
    warehouse.publish(table(spark, "opening_balances", corrected), "ds", "opening_balances")
    late = [*POSTINGS, (8, d(29), 10, 11, Decimal("70.00")), (9, d(29), 11, 20, Decimal("0.25"))]
    warehouse.publish(table(spark, "postings", late), "ds", "postings")
    assert jobs.stale_months(warehouse)["2018-01"] == "its postings changed"
    with pytest.raises(jobs.StaleMonths, match="2018-01: its postings changed"):
        jobs.build_form_101(warehouse, JAN[0], FEB[1])
    *_, done = jobs.calculate_period(warehouse, *JAN)
    expected = day_by_day(ACCOUNTS, corrected, late, JAN[0], MARCH[1])
    assert _balances(warehouse) == {**{(a, on): b for a, on, b in corrected}, **expected}
    assert done.counts["carried"] == sum(on >= FEB[0] for _, on in expected)
    assert warehouse.live("dm", jobs.TURNOVER_MART)["2018-02"] == turnovers["2018-02"]  # not read, not written
    assert set(jobs.stale_months(warehouse).values()) <= {"its postings changed"}  # one table of all months was replaced
    carried = _home(warehouse)
    jobs.calculate_period(warehouse, JAN[0], MARCH[1])
    assert _home(warehouse) == carried and jobs.stale_months(warehouse) == {}
    jobs.build_form_101(warehouse, JAN[0], FEB[1])
    _report_agrees(warehouse)


def test_changed_balances_meet_accounts_without_a_broadcast(spark, warehouse, monkeypatch):
    publish_inputs(spark, warehouse)
    jobs.calculate_period(warehouse, JAN[0], FEB[1])
    warehouse.publish(table(spark, "opening_balances", [(10, BEFORE, Decimal("500.00"))]), "ds", "opening_balances")
    plans, stored = [], jobs.stored_and_measured

    def not_small(df, path):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, path)[0], False

    monkeypatch.setattr(jobs, "stored_and_measured", not_small)
    prepare = warehouse.prepare_periods

    def seen(df, *args, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return prepare(df, *args, **options)

    monkeypatch.setattr(warehouse, "prepare_periods", seen)
    jobs.calculate_period(warehouse, *JAN)
    delta, carried = [plan for plan in plans if "delta" in plan]
    assert "BroadcastHashJoin" not in delta and "BroadcastHashJoin [account_id" not in carried
    assert _balances(warehouse)[10, d(28, 2)] > 500


def _by_month(spark, warehouse, rows):
    warehouse.publish_periods(table(spark, "postings", rows), "ds", "postings", F.date_format("on_date", "yyyy-MM"))


def test_postings_kept_in_months_leave_the_months_behind_sound(spark, warehouse):
    publish_inputs(spark, warehouse, postings=[])
    warehouse.switch("ds", "postings", [], drop=["all"])
    _by_month(spark, warehouse, POSTINGS)
    jobs.calculate_period(warehouse, JAN[0], FEB[1])
    late = [*POSTINGS[:6], (8, d(29), 10, 11, Decimal("70.00"))]
    _by_month(spark, warehouse, late)
    assert jobs.stale_months(warehouse) == {"2018-01": "its postings changed", "2018-02": "2018-01 is stale"}
    jobs.calculate_period(warehouse, *JAN)
    assert jobs.stale_months(warehouse) == {}
    jobs.build_form_101(warehouse, JAN[0], FEB[1])
    _report_agrees(warehouse)
    expected = day_by_day(ACCOUNTS, OPENING, [*late, POSTINGS[6]], JAN[0], FEB[1])
    assert _balances(warehouse) == {**{(a, on): b for a, on, b in OPENING}, **expected}


def test_months_and_their_correction_go_live_together(spark, warehouse, monkeypatch):
    publish_inputs(spark, warehouse)
    jobs.calculate_period(warehouse, JAN[0], FEB[1])
    before = _balances(warehouse)
    warehouse.publish(table(spark, "opening_balances", [(10, BEFORE, Decimal("500.00"))]), "ds", "opening_balances")
    switches, rename = [], warehouse._rename

    def counted(path, target):
        if jobs.BALANCE_MART in target:
            switches.append(_balances(warehouse))
        rename(path, target)

    monkeypatch.setattr(warehouse, "_rename", counted)
    jobs.calculate_period(warehouse, *JAN)
    assert switches == [before] and _balances(warehouse)[10, d(28, 2)] == before[10, d(28, 2)] + 400


def test_without_a_change_later_months_stay_as_they_are(spark, warehouse):
    publish_inputs(spark, warehouse)
    jobs.calculate_period(warehouse, JAN[0], FEB[1])
    kept = warehouse.live("dm", jobs.BALANCE_MART)["2018-02"]
    jobs.calculate_period(warehouse, *JAN)
    assert warehouse.live("dm", jobs.BALANCE_MART)["2018-02"] == kept
    assert jobs.stale_months(warehouse) == {}


def test_changed_rates_make_their_months_stale(spark, warehouse):
    publish_inputs(spark, warehouse)
    jobs.calculate_period(warehouse, JAN[0], FEB[1])
    more = [*RATES, (USD, date(2018, 4, 1), None, Decimal("1.000000"))]
    warehouse.publish(table(spark, "exchange_rates", more), "ds", "exchange_rates")
    assert jobs.stale_months(warehouse) == {}
    other = [RATES[0], (USD, d(16), d(10, 2), Decimal("60.000000")), (USD, d(11, 2), None, Decimal("61.000000"))]
    warehouse.publish(table(spark, "exchange_rates", other), "ds", "exchange_rates")
    assert jobs.stale_months(warehouse) == {"2018-02": "its rates changed"}
    jobs.build_form_101(warehouse, *JAN)
    with pytest.raises(jobs.StaleMonths):
        jobs.build_form_101(warehouse, *FEB)


def test_changed_accounts_make_their_months_stale(spark, warehouse):
    publish_inputs(spark, warehouse)
    jobs.calculate_period(warehouse, JAN[0], FEB[1])
    changed = [(21, USD, "P", "30110", d(10), d(24)) if a[0] == 21 else a for a in ACCOUNTS]
    later = [*ACCOUNTS, (40, USD, "A", "30110", d(1, 3), None)]
    other_ledger = [(*a[:3], "99999", *a[4:]) for a in ACCOUNTS]
    for accounts, expected in (
        (later, {}), (other_ledger, {}),
        (changed, {"2018-01": "its accounts changed", "2018-02": "2018-01 is stale"}),
    ):
        warehouse.publish(table(spark, "accounts", accounts), "ds", "accounts")
        assert jobs.stale_months(warehouse) == expected
    jobs.calculate_period(warehouse, *JAN)
    assert jobs.stale_months(warehouse) == {}
    assert _balances(warehouse)[21, d(24)] == _balances(warehouse)[21, d(20)]


def test_a_load_reads_only_months_that_hold_its_keys(spark, warehouse, tmp_path):
    export_csv(table(spark, "postings"), str(tmp_path / "one"))
    jobs.load_csv(warehouse, "postings", str(tmp_path / "one"))
    for file in (tmp_path / "warehouse/ds/postings/2018-01").rglob("*.parquet"):
        file.write_bytes(b"rubbish")
    export_csv(table(spark, "postings", [(7, d(9, 3), 10, 20, Decimal("1.00")), (8, d(2, 2), 10, 20, Decimal("2.00"))]), str(tmp_path / "two"))
    done = jobs.load_csv(warehouse, "postings", str(tmp_path / "two"))
    assert done.counts == {"inserted": 1, "updated": 1, "unchanged": 0}
    assert [r["posting_id"] for r in warehouse.read("ds", "postings", ["2018-02", "2018-03"]).orderBy("posting_id").collect()] == [7, 8]


def test_a_skipped_month_is_named(spark, warehouse):
    publish_inputs(spark, warehouse)
    jobs.calculate_period(warehouse, *JAN)
    with pytest.raises(LookupError, match="2018-02 is not calculated .* 2018-02-28"):
        jobs.calculate_period(warehouse, d(1, 3), d(31, 3))


def test_a_calculated_month_takes_over_its_opening_day(spark, warehouse):
    december = (8, date(2017, 12, 5), 10, 11, Decimal("1.00"))
    rates = [(USD, date(2017, 11, 1), date(2017, 11, 30), Decimal("56.000000")), *RATES]
    publish_inputs(spark, warehouse, postings=[*POSTINGS, december], exchange_rates=rates,
                   opening_balances=[*OPENING, *[(a, date(2017, 11, 30), b) for a, _, b in OPENING]])
    jobs.calculate_period(warehouse, *JAN)
    jobs.calculate_period(warehouse, date(2017, 12, 1), BEFORE)
    days = warehouse.read("dm", jobs.BALANCE_MART).groupBy("account_id", "on_date").count().filter("count > 1")
    assert days.count() == 0
    jobs.build_form_101(warehouse, *JAN)


def test_movements_that_cannot_be_booked_are_listed(spark, warehouse):
    late = [*POSTINGS, (8, d(25), 21, 10, Decimal("17.00")), (9, d(2), 999, 10, Decimal("1.00"))]
    publish_inputs(spark, warehouse, postings=late)
    with pytest.raises(UnbookedMovements, match="2 movements cannot be booked: see dm.dm_unbooked_f"):
        jobs.calculate_period(warehouse, *JAN)
    listed = {(r["account_id"], r["on_date"], r["reason"]) for r in warehouse.read("dm", jobs.UNBOOKED).collect()}
    assert listed == {(21, d(25), "outside validity"), (999, d(2), "unknown account")}
    jobs.calculate_period(warehouse, *JAN, on_unbooked="skip")
    jobs.build_form_101(warehouse, *JAN)
    for r in warehouse.read("dm", jobs.REPORT_MART).collect():
        change = r["turn_deb_rub"] - r["turn_cre_rub"]
        assert r["balance_in_rub"] + (change if r["characteristic"] == "A" else -change) == r["balance_out_rub"]


def test_jobs_of_a_calculation_do_not_follow_the_months(spark, warehouse):
    publish_inputs(spark, warehouse)

    def jobs_for(last, name):
        spark.sparkContext.setJobGroup(name, name)
        jobs.calculate_period(warehouse, JAN[0], last)
        spark.sparkContext.setJobGroup("other", "other")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    assert jobs_for(d(31, 3), "three months") <= jobs_for(d(31), "one month") + 4


def test_unused_currency_needs_no_rate(spark, warehouse):
    publish_inputs(spark, warehouse, accounts=[*ACCOUNTS, (40, EUR, "A", "30110", date(2016, 1, 1), date(2016, 2, 1))])
    jobs.calculate_period(warehouse, *JAN)


def test_report_job(spark, warehouse):
    publish_inputs(spark, warehouse)
    with pytest.raises(LookupError, match="the marts lack 2018-01"):
        jobs.build_form_101(warehouse, *JAN)
    jobs.calculate_period(warehouse, JAN[0], FEB[1])
    jobs.build_form_101(warehouse, *JAN)
    jobs.build_form_101(warehouse, JAN[0], FEB[1])
    report = warehouse.read("dm", jobs.REPORT_MART)
    assert report.groupBy("date_to").count().orderBy("date_to").collect() == [(JAN[1], 4), (FEB[1], 4)]


@pytest.mark.parametrize("period", [(d(2), d(31)), (d(1), d(30)), (d(1, 2), d(31))])
def test_whole_months(warehouse, period):
    with pytest.raises(ValueError, match="whole months"):
        jobs.calculate_period(warehouse, *period)


def test_a_lost_leg_stops_the_mart(spark, warehouse, monkeypatch):
    publish_inputs(spark, warehouse)
    jobs.calculate_period(warehouse, *JAN)
    live = [warehouse.live("dm", mart) for mart in (jobs.TURNOVER_MART, jobs.BALANCE_MART)]
    whole = jobs.account_movements
    lost = (F.col("account_id") == 11) & (F.col("on_date") == d(31))
    monkeypatch.setattr(jobs, "account_movements", lambda *a: whole(*a).filter(~lost))
    with pytest.raises(ControlTotalsDiffer, match="not what was posted on 2018-01-31$"):
        jobs.calculate_period(warehouse, *JAN)
    assert [warehouse.live("dm", mart) for mart in (jobs.TURNOVER_MART, jobs.BALANCE_MART)] == live


def test_a_balance_that_does_not_add_up_stops_the_mart(spark, warehouse, monkeypatch):
    publish_inputs(spark, warehouse)
    whole = jobs.account_balance

    def wrong(*args, **days):
        spoiled = (F.col("account_id") == 20) & (F.col("on_date") == d(31))
        rows = whole(*args, **days)
        return rows.withColumn("balance", F.when(spoiled, F.col("balance") + 1).otherwise(F.col("balance")).cast("decimal(25,2)"))

    monkeypatch.setattr(jobs, "account_balance", wrong)
    with pytest.raises(ControlTotalsDiffer, match=f"in currencies {USD}$"):
        jobs.calculate_period(warehouse, *JAN)
    assert not warehouse.exists("dm", jobs.BALANCE_MART)


def test_control_totals_are_kept_with_the_mart(spark, warehouse):
    publish_inputs(spark, warehouse)
    jobs.calculate_period(warehouse, *JAN)
    found = {r["currency_id"]: tuple(r)[3:] for r in jobs.control_totals(warehouse).collect()}
    # active 10: +7.50 -8.00, passive 11: +7.50 -8.00; active 20: +3.33, passive 21 closes with +3.33
    assert found == {1: (Decimal("150.00"), Decimal("-1.00"), Decimal("149.00")), USD: (Decimal("10.00"), Decimal("6.66"), Decimal("16.66"))}


# CSV exchange


def test_an_import_that_lacks_a_file_is_refused(spark, warehouse, tmp_path):
    df = spark.range(60).select(F.col("id").cast("int").alias("id"), F.lit("a\nb").alias("v"))
    warehouse.publish(df.repartition(3, "id"), "dm", "report")
    path = tmp_path / "csv"
    jobs.export_mart(warehouse, "report", str(path))
    file = sorted(path.glob("*.csv"))[0]
    content = file.read_bytes()
    file.unlink()
    with pytest.raises(IncompleteExport, match=file.name):
        jobs.import_csv_new_table(warehouse, str(path), df.schema, "again")
    for crc in path.glob(".*.crc"):
        crc.unlink()
    file.write_bytes(content.replace(b"a", b"c"))  # the same size
    with pytest.raises(IncompleteExport, match="rows of"):
        jobs.import_csv_new_table(warehouse, str(path), df.schema, "again")
    assert not warehouse.exists("dm", "again")
    file.write_bytes(content)
    assert jobs.import_csv_new_table(warehouse, str(path), df.schema, "again").rows == 60
    file.write_bytes(content.replace(b"a", b"c"))
    changed = jobs.reimport_csv(warehouse, str(path), df.schema, "again", ["id"]).groupBy("status").count()
    assert {r["status"] for r in changed.collect()} == {"changed", "same"}
    file.unlink()
    with pytest.raises(IncompleteExport):
        jobs.reimport_csv(warehouse, str(path), df.schema, "again", ["id"])


def test_export_import_change_reimport(spark, warehouse, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, ""), (3, None), (4, "x")], "id int, v string")
    warehouse.publish(df, "dm", "report")
    path = str(tmp_path / "csv")
    assert jobs.export_mart(warehouse, "report", path) == 4
    jobs.import_csv_new_table(warehouse, path, df.schema, "report_v2")
    assert warehouse.read("dm", "report_v2").exceptAll(df).count() == 0
    with pytest.raises(ValueError, match="exists"):
        jobs.import_csv_new_table(warehouse, path, df.schema, "report_v2")

    changed = spark.createDataFrame([(1, "a\nb"), (2, "two"), (3, None), (5, "new")], "id int, v string")
    export_csv(changed, path)
    diff = jobs.reimport_csv(warehouse, path, df.schema, "report_v2", ["id"])
    assert {tuple(r) for r in diff.collect()} == {(1, "same"), (2, "changed"), (3, "same"), (4, "removed"), (5, "added")}
    assert warehouse.read("dm", "report_v2").exceptAll(changed).count() == 0
    assert logged(warehouse) == {
        ("export dm.report", 4, "SUCCESS"), ("import dm.report_v2", 4, "SUCCESS"), ("import dm.report_v2", 0, "ERROR"),
        ("reimport dm.report_v2", 4, "SUCCESS"),
    }


def test_reimport_with_repeated_keys_is_refused(spark, warehouse, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    warehouse.publish(df, "dm", "report")
    export_csv(df.union(df), str(tmp_path / "csv"))
    with pytest.raises(DuplicateKeys):
        jobs.reimport_csv(warehouse, str(tmp_path / "csv"), df.schema, "report", ["id"])
    assert warehouse.read("dm", "report").count() == 1


# repair


def test_refresh_client_twice(spark, warehouse):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id int, v string, ver int")
    warehouse.publish(df, "dm", "client")
    repair = jobs.refresh_client(warehouse, ["id"], [F.desc("ver")])
    assert {tuple(r) for r in warehouse.read("dm", "client").collect()} == {(1, "b", 2), (2, "c", 1)}
    assert [tuple(r) for r in repair.reports["removed"].collect()] == [(1, "a", 1)]
    assert jobs.refresh_client(warehouse, ["id"], [F.desc("ver")]).reports["removed"].count() == 0
    with pytest.raises(DuplicateKeys):
        jobs.full_reload(warehouse, df, "client", ["id"])
    assert warehouse.read("dm", "client").count() == 2


def test_refresh_loan_holiday_twice(spark, warehouse, tmp_path):
    schema = "deal long, on_date date, rate decimal(5,2)"
    source = spark.createDataFrame([(1, d(1), Decimal(1)), (1, d(2), Decimal(1)), (1, d(5), Decimal(2)), (2, d(1), Decimal(3))], schema)
    warehouse.publish(source.filter("on_date != '2018-01-02'").limit(2), "dm", "loan_holiday_info")
    export_csv(source, str(tmp_path / "csv"))
    for missing in (2, 0):
        repair = jobs.refresh_loan_holiday(warehouse, str(tmp_path / "csv"), source.schema, "deal", "on_date")
        assert warehouse.read("dm", "loan_holiday_info").exceptAll(source).count() == 0
        assert repair.published.rows == 4
        assert repair.reports["missing"].count() == missing
        assert [tuple(r) for r in repair.reports["gaps"].collect()] == [(1, d(2), d(5), 2)]


def test_a_second_refresh_of_known_files_writes_nothing(spark, warehouse, tmp_path):
    source = spark.createDataFrame([(1, d(1), d(5)), (1, d(9), None), (2, d(1), d(2))], "deal long, begins date, ends date")
    export_csv(source.coalesce(1), str(tmp_path / "csv"))
    warehouse.publish(source.filter("deal = 2 OR ends IS NOT NULL"), "dm", "loan_holiday_info")

    def refresh():
        return jobs.refresh_loan_holiday(
            warehouse, str(tmp_path / "csv"), source.schema, "deal", "begins", end_col="ends", only_new=True
        )

    repair = refresh()
    assert [tuple(r) for r in repair.reports["missing"].collect()] == [(1, d(9), None)]
    assert [tuple(r) for r in repair.reports["gaps"].collect()] == [(1, d(6), d(8), 3)]
    assert repair.reports["gaps_before"].count() == 0
    live = warehouse.live("rd", "loan_holiday"), warehouse.live("dm", "loan_holiday_info")
    assert refresh().published.rows == 0
    assert (warehouse.live("rd", "loan_holiday"), warehouse.live("dm", "loan_holiday_info")) == live
    assert ("pass over 1 known files of rd.loan_holiday", 0, "SUCCESS") in logged(warehouse)
    warehouse.publish(source.limit(1), "dm", "loan_holiday_info")  # a mart that was spoiled is filled again
    assert refresh().published.rows == 3


def test_refresh_loan_holiday_with_a_build(spark, warehouse, tmp_path):
    source = spark.createDataFrame([(1, d(1)), (2, d(1))], "deal long, on_date date")
    export_csv(source, str(tmp_path / "csv"))
    jobs.refresh_loan_holiday(
        warehouse, str(tmp_path / "csv"), source.schema, "deal", "on_date",
        build=lambda rows: rows.withColumn("kind", F.lit("holiday")),
    )
    assert warehouse.read("dm", "loan_holiday_info").columns == ["deal", "on_date", "kind"]


def test_refresh_balance_turnover_twice(spark, warehouse):
    schema = "account_id long, on_date date, account_in_sum decimal(18,2), account_out_sum decimal(18,2)"
    rows = [(1, d(1), Decimal(0), Decimal(5)), (1, d(2), Decimal(9), Decimal(6)), (2, d(1), Decimal(1), Decimal(1))]
    names = spark.createDataFrame([(1, "one"), (2, "two")], "account_id long, name string")
    warehouse.publish(spark.createDataFrame(rows, schema), "dm", "account_balance_turnover")
    for wrong in (1, 0):
        repair = jobs.refresh_balance_turnover(warehouse, [(names, ["account_id"])])
        assert repair.reports["mismatches"].count() == wrong
        found = {tuple(r) for r in warehouse.read("dm", "account_balance_turnover").select("account_id", "on_date", "account_in_sum", "name").collect()}
        assert found == {(1, d(1), 0, "one"), (1, d(2), 5, "one"), (2, d(1), 1, "two")}


def test_repeated_days_are_refused(spark, warehouse):
    schema = "account_id long, on_date date, account_in_sum decimal(18,2), account_out_sum decimal(18,2)"
    row = (1, d(1), Decimal(0), Decimal(5))
    warehouse.publish(spark.createDataFrame([row, row], schema), "dm", "account_balance_turnover")
    with pytest.raises(DuplicateKeys):
        jobs.refresh_balance_turnover(warehouse)
