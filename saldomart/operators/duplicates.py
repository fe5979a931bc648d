"""Duplicate rows: find them, keep one per key, refuse new ones. NULL keys are equal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    """Rows that share a key were about to be published."""


def total_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> list[Column]:
    """``order_by`` continued by every other column, so that ties are exact copies."""
    return [*order_by, *[F.col(c).asc_nulls_first() for c in df.columns if c not in keys]]


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = ()) -> DataFrame:
    """One row per key, the first in ``order_by`` and then in all other columns.

    The rank filter is pushed below the shuffle, so each task sends at most one row per
    key and a key with very many rows stays small.
    """
    ranked = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order_by))
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def find_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, and how many rows hold them."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def remove_duplicates(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = ()
) -> tuple[DataFrame, DataFrame]:
    """The rows to keep, one per key, and the rows to remove. Together they are ``df``.

    Keys are counted first, summed per task, and only rows of repeated keys are ranked for
    removal: twice, among the rows of the same input partition, then the first of each
    partition among each other. No task gets more rows of one key than an input partition
    holds, or than there are partitions.
    """
    order = total_order(df, keys, order_by)
    repeated = find_duplicates(df, keys).select(*keys).alias("r")
    rows = df.withColumn("_part", F.spark_partition_id()).alias("l")
    same = reduce(Column.__and__, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    local = Window.partitionBy(*keys, "_part").orderBy(*order)
    among = Window.partitionBy(*keys).orderBy(*order)
    placed = rows.join(repeated, same, "left_semi").withColumn("_local", F.row_number().over(local))
    beaten = placed.filter("_local > 1").select(*df.columns)
    first = placed.filter("_local = 1").withColumn("_rank", F.row_number().over(among)).filter("_rank > 1")
    return first_per_key(df, keys, order_by), beaten.unionByName(first.select(*df.columns))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if rows share a key. ``find_duplicates`` tells which."""
    n = find_duplicates(df, keys).count()
    if n:
        raise DuplicateKeys(f"{n} duplicate keys in {', '.join(keys)}")
