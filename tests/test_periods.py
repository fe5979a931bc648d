from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from saldomart.operators.periods import find_interval_gaps, find_period_gaps, missing_in_mart, missing_intervals

SCHEMA = "entity long, on_date date"
FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def day(n):
    return date(2018, 1, 1) + timedelta(days=n)


def test_missing_in_mart(spark):
    source = spark.createDataFrame([(1, day(0)), (1, day(0)), (1, day(1)), (2, day(0))], SCHEMA)
    mart = spark.createDataFrame([(1, day(1)), (1, day(1)), (3, day(0))], SCHEMA)
    found = missing_in_mart(source, mart, ["entity", "on_date"]).collect()
    assert sorted(map(tuple, found)) == [(1, day(0)), (2, day(0))]


def test_gaps(spark):
    rows = [(1, day(0)), (2, day(0)), (2, day(1)), (3, day(0)), (3, day(0)), (3, day(4)), (4, day(0)), (4, day(2)),
            (4, day(9)), (5, None)]
    found = find_period_gaps(spark.createDataFrame(rows, SCHEMA), "entity", "on_date").collect()
    assert sorted(map(tuple, found)) == [(3, day(0), day(4), 3), (4, day(0), day(2), 1), (4, day(2), day(9), 6)]


@FEW
@given(rows=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 15)), max_size=12))
def test_gaps_equal_a_walk(spark, rows):
    expected = []
    for entity in {e for e, _ in rows}:
        days = sorted({n for e, n in rows if e == entity})
        expected += [(entity, day(a), day(b), b - a - 1) for a, b in zip(days, days[1:]) if b - a > 1]
    df = spark.createDataFrame([(e, day(n)) for e, n in rows], SCHEMA)
    assert sorted(map(tuple, find_period_gaps(df, "entity", "on_date").collect())) == sorted(expected)


# periods with two ends

PERIODS = "entity long, begins date, ends date"
FAR = 40
INTERVALS = st.lists(
    st.tuples(st.integers(0, 1), st.one_of(st.none(), st.integers(0, 20)), st.one_of(st.none(), st.integers(0, 9))), max_size=7
)


def _frame(spark, rows):
    """Rows of entity, first day and length, either of which may be open."""
    return spark.createDataFrame([(e, None if a is None else day(a), None if n is None else day((a or 0) + n)) for e, a, n in rows], PERIODS)


def _covered(rows, entity):
    """Days, from one before any period to one behind; open ends reach there."""
    days = set()
    for e, a, n in rows:
        if e == entity:
            days.update(range(-1 if a is None else a, FAR if n is None else (a or 0) + n + 1))
    return days


def _stretches(days):
    found = []
    for n in sorted(days):
        if found and found[-1][1] == n - 1:
            found[-1][1] = n
        else:
            found.append([n, n])
    return found


@FEW
@given(rows=INTERVALS)
def test_interval_gaps_equal_a_walk(spark, rows):
    expected = []
    for entity in {e for e, _, _ in rows}:
        days = _covered(rows, entity)
        gaps = _stretches(set(range(min(days), max(days))) - days)
        expected += [(entity, day(a), day(b), b - a + 1) for a, b in gaps]
    found = find_interval_gaps(_frame(spark, rows), "entity", "begins", "ends")
    assert sorted(map(tuple, found.collect())) == sorted(expected)


@FEW
@given(source=INTERVALS, mart=INTERVALS)
def test_missing_intervals_equal_a_walk(spark, source, mart):
    expected = []
    for entity in {e for e, _, _ in source}:
        for a, b in _stretches(_covered(source, entity) - _covered(mart, entity)):
            expected.append((entity, None if a == -1 else day(a), None if b == FAR - 1 else day(b)))
    found = missing_intervals(_frame(spark, source), _frame(spark, mart), "entity", "begins", "ends")
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


def test_nested_periods_leave_no_gap(spark):
    rows = [(1, 0, 20), (1, 2, 1), (1, 5, 2), (1, 22, 1)]
    assert [tuple(r) for r in find_interval_gaps(_frame(spark, rows), "entity", "begins", "ends").collect()] == [(1, day(21), day(21), 1)]


@pytest.mark.parametrize("operation", [lambda df: find_interval_gaps(df, "entity", "begins", "ends"),
                                       lambda df: missing_intervals(df, df, "entity", "begins", "ends")])
def test_inverted_periods_are_refused(spark, operation):
    with pytest.raises(Exception, match="ends before it begins"):
        operation(spark.createDataFrame([(1, day(3), day(2))], PERIODS)).collect()
