from datetime import date, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest

from saldomart.operators.duplicates import DuplicateKeys
from saldomart.operators.repair import find_mismatches, fix_in_sum, fix_out_sum, rebuild_balance_turnover

SCHEMA = "account_id long, on_date date, account_in_sum decimal(18,2), account_out_sum decimal(18,2)"
FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def day(n):
    return date(2018, 1, n)


def money(n):
    return None if n is None else Decimal(n)


def rows_of(spark, rows):
    return spark.createDataFrame([(a, day(n), money(i), money(o)) for a, n, i, o in rows], SCHEMA)


def plain(df):
    found = [(r[0], r[1].day, *[None if v is None else int(v) for v in r[2:]]) for r in df.collect()]
    return sorted(found, key=lambda r: r[:2])


ROWS = [
    (1, 1, 0, 10), (1, 2, 10, 15), (1, 3, 99, 20), (1, 5, 77, 30), (1, 6, 30, 31),
    (2, 1, 5, 5), (2, 2, 5, None), (2, 3, 8, 9), (2, 4, None, 1),
]


def test_mismatches(spark):
    df = rows_of(spark, ROWS)
    assert plain(find_mismatches(df)) == [(1, 3, 99, 15), (2, 3, 8, None), (2, 4, None, 9)]
    assert plain(find_mismatches(df, mode="row")) == [(1, 3, 99, 15), (1, 5, 77, 20), (2, 3, 8, None), (2, 4, None, 9)]


def test_fix_in_sum(spark):
    assert plain(fix_in_sum(rows_of(spark, ROWS))) == [
        (1, 1, 0, 10), (1, 2, 10, 15), (1, 3, 15, 20), (1, 5, 77, 30), (1, 6, 30, 31),
        (2, 1, 5, 5), (2, 2, 5, None), (2, 3, 8, 9), (2, 4, 9, 1),
    ]


def test_fix_out_sum(spark):
    assert plain(fix_out_sum(rows_of(spark, ROWS))) == [
        (1, 1, 0, 10), (1, 2, 10, 99), (1, 3, 99, 20), (1, 5, 77, 30), (1, 6, 30, 31),
        (2, 1, 5, 5), (2, 2, 5, 8), (2, 3, 8, 9), (2, 4, None, 1),
    ]


def test_modes_are_checked(spark):
    with pytest.raises(ValueError, match="mode"):
        fix_in_sum(rows_of(spark, ROWS), mode="week")
    with pytest.raises(ValueError, match="trust"):
        rebuild_balance_turnover(rows_of(spark, ROWS), trust="both")


def test_rebuild_attaches_dimensions_once(spark):
    names = spark.createDataFrame([(1, "one")], "account_id long, name string")
    once = rebuild_balance_turnover(rows_of(spark, ROWS), [(names, ["account_id"])])
    assert {(r["account_id"], r["name"]) for r in once.collect()} == {(1, "one"), (2, None)}
    again = rebuild_balance_turnover(once, [(names, ["account_id"])])
    assert again.columns == once.columns and again.exceptAll(once).count() == 0
    with pytest.raises(DuplicateKeys):
        rebuild_balance_turnover(rows_of(spark, ROWS), [(names.union(names), ["account_id"])])


sums = st.one_of(st.none(), st.integers(0, 3))


@FEW
@given(rows=st.dictionaries(st.tuples(st.integers(1, 2), st.integers(1, 9)), st.tuples(sums, sums), max_size=12),
       mode=st.sampled_from(["calendar", "row"]))
def test_fix_equals_a_walk(spark, rows, mode):
    def neighbour(account, n, step):
        if mode == "calendar":
            return rows.get((account, n + step))
        days = sorted(m for a, m in rows if a == account and (m - n) * step > 0)
        return rows[account, days[0] if step > 0 else days[-1]] if days else None

    ins, outs = {}, {}
    for (a, n), (i, o) in rows.items():
        before, after = neighbour(a, n, -1), neighbour(a, n, 1)
        ins[a, n] = before[1] if before and before[1] is not None else i
        outs[a, n] = after[0] if after and after[0] is not None else o
    df = rows_of(spark, [(a, n, i, o) for (a, n), (i, o) in rows.items()])
    fixed = fix_in_sum(df, mode=mode)
    assert plain(fixed) == sorted(((a, n, ins[a, n], o) for (a, n), (i, o) in rows.items()), key=lambda r: r[:2])
    assert plain(fix_out_sum(df, mode=mode)) == sorted(
        ((a, n, i, outs[a, n]) for (a, n), (i, o) in rows.items()), key=lambda r: r[:2]
    )
    left = find_mismatches(fixed, mode=mode).filter("previous_out_sum is not null")
    assert left.count() == 0


def test_one_shuffle_for_both_neighbours(spark, capsys):
    from saldomart.operators.repair import next_day, previous_day

    df = rows_of(spark, ROWS)
    df.select(previous_day("account_out_sum", "account_id", "on_date")[0],
              next_day("account_in_sum", "account_id", "on_date")[0]).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_days_do_not_wrap(spark):
    last = date(2018, 1, 31)
    df = spark.createDataFrame(
        [(1, last, Decimal(1), Decimal(2)), (1, last + timedelta(days=1), Decimal(5), Decimal(6))], SCHEMA
    )
    assert [r["account_in_sum"] for r in fix_in_sum(df).orderBy("on_date").collect()] == [1, 2]
