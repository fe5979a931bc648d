"""In-sums and out-sums that do not agree from one day to the next.

An account holds a day once, so a window partition is never longer than the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldomart.operators.duplicates import assert_unique

MODES = ("calendar", "row")


def _neighbour(shift, col: str, account: str, day: str, step: int, mode: str) -> tuple[Column, Column]:
    """The value next door and whether there is a row next door."""
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is not one of {MODES}")
    history = Window.partitionBy(account).orderBy(day)
    other_day = shift(day).over(history)
    present = other_day.isNotNull()
    if mode == "calendar":
        present = F.coalesce(other_day == F.date_add(F.col(day), step), F.lit(False))
    return F.when(present, shift(col).over(history)), present


def previous_day(col: str, account: str, day: str, mode: str = "calendar") -> tuple[Column, Column]:
    """``col`` of the same account one day earlier, and whether that day has a row.

    ``calendar`` means the calendar day before, ``row`` the account's previous row.
    """
    return _neighbour(F.lag, col, account, day, -1, mode)


def next_day(col: str, account: str, day: str, mode: str = "calendar") -> tuple[Column, Column]:
    """``col`` of the same account one day later, and whether that day has a row."""
    return _neighbour(F.lead, col, account, day, 1, mode)


def find_mismatches(
    df: DataFrame, account: str = "account_id", day: str = "on_date", mode: str = "calendar"
) -> DataFrame:
    """Rows whose in-sum is not the out-sum of the day before."""
    before, present = previous_day("account_out_sum", account, day, mode)
    return (
        df.withColumns({"previous_out_sum": before, "_present": present})
        .filter(F.col("_present") & ~F.col("previous_out_sum").eqNullSafe(F.col("account_in_sum")))
        .select(account, day, "account_in_sum", "previous_out_sum")
    )


def fix_in_sum(
    df: DataFrame, account: str = "account_id", day: str = "on_date", mode: str = "calendar"
) -> DataFrame:
    """Every in-sum set to the out-sum of the day before, where that is known."""
    before, _ = previous_day("account_out_sum", account, day, mode)
    return df.withColumn("account_in_sum", F.coalesce(before, F.col("account_in_sum")))


def fix_out_sum(
    df: DataFrame, account: str = "account_id", day: str = "on_date", mode: str = "calendar"
) -> DataFrame:
    """Every out-sum set to the in-sum of the day after, where that is known."""
    after, _ = next_day("account_in_sum", account, day, mode)
    return df.withColumn("account_out_sum", F.coalesce(after, F.col("account_out_sum")))


def rebuild_balance_turnover(
    df: DataFrame,
    dims: Sequence[tuple[DataFrame, Sequence[str]]] = (),
    trust: str = "out",
    mode: str = "calendar",
    account: str = "account_id",
    day: str = "on_date",
) -> DataFrame:
    """Corrected rows with the columns of ``dims`` (table, keys) attached.

    ``trust='out'`` corrects in-sums, ``trust='in'`` corrects out-sums. A dimension that
    holds a key twice is refused, because it would multiply rows. Columns left by an
    earlier rebuild are replaced.
    """
    fixes = {"out": fix_in_sum, "in": fix_out_sum}
    if trust not in fixes:
        raise ValueError(f"trust {trust!r} is not one of {tuple(fixes)}")
    rebuilt = fixes[trust](df, account, day, mode)
    for dim, keys in dims:
        assert_unique(dim, keys)
        rebuilt = rebuilt.drop(*[c for c in dim.columns if c not in keys])
        rebuilt = rebuilt.join(dim, list(keys), "left")
    return rebuilt
