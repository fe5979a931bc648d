"""Insert-or-update of one table by another, and the difference of two tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from saldomart.functions.sizes import BROADCAST_BYTES, observed, row_bytes
from saldomart.operators.duplicates import first_per_key
from saldomart.session import new_folder


def _same_columns(left: DataFrame, right: DataFrame) -> None:
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {sorted(left.columns)} and {sorted(right.columns)}")


def _keys_equal(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _values_differ(left: str, right: str, cols: Sequence[str]) -> Column:
    same = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols]
    return ~reduce(Column.__and__, same, F.lit(True))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The row with the highest ``order_by`` per key; ties go by the other columns."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in [*order_by, *rest]])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    small_source: bool | None = None,
) -> DataFrame:
    """``target`` after taking over ``source``, with an ``action`` per row.

    ``insert`` for new keys, ``update`` where a value changes, ``keep`` for the rest. Of
    several source rows of a key the highest in ``order_by`` counts. Unless ``small_source``
    tells, the source is reduced to one row per key and stored once, and measured while it
    is written. A small source is broadcast and the target is not shuffled. A target that
    holds a key of the source twice is refused, and without a broadcast any repeated key.
    """
    _same_columns(target, source)
    new = latest_per_key(source, keys, order_by).select(*target.columns)
    if small_source is None:
        new, small_source = stored_and_measured(new, new_folder(source.sparkSession, "source"))
    return take_over(target, new, keys, small_source)


def take_over(target: DataFrame, new: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """``upsert`` of rows that hold a key once. ``small`` rows are broadcast."""
    values = [c for c in target.columns if c not in keys]
    new = new.select(*target.columns).withColumn("_new", F.lit(True))
    matched = _keys_equal("old", "new", keys)
    if not small:
        old = target.withColumn("_old", _held_once(F.count(F.lit(1)).over(Window.partitionBy(*keys)), keys))
        joined = old.alias("old").join(new.alias("new"), matched, "full_outer")
        return _taken_over(joined, target.columns, values)
    new_keys = F.broadcast(new.select(*keys))
    met = target.select(*keys).alias("old").join(new_keys.alias("new"), matched, "left_semi")
    met = met.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(_held_once(F.col("_n"), keys))
    fresh = (
        new.alias("new")
        .join(F.broadcast(met).alias("old"), matched, "left_anti")  # no more rows than are new
        .select(*target.columns, F.lit("insert").alias("action"))
    )
    old = target.withColumn("_old", F.lit(True))
    joined = old.alias("old").join(F.broadcast(new).alias("new"), matched, "left")
    return _taken_over(joined, target.columns, values).unionByName(fresh)


def _held_once(n: Column, keys: Sequence[str]) -> Column:
    """True, or an error where the target holds a key more than once."""
    message = F.lit(f"the target holds a key of {', '.join(keys)} more than once")
    return F.when(n > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def stored_and_measured(df: DataFrame, path: str) -> tuple[DataFrame, bool]:
    """``df`` written to ``path``, and whether it is small enough to broadcast."""
    width = row_bytes(df.schema)
    if width is None:
        return df, False
    seen = Observation()
    df.observe(seen, F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), observed(seen, ["bytes"])["bytes"] <= BROADCAST_BYTES


def _taken_over(joined: DataFrame, columns: Sequence[str], values: Sequence[str]) -> DataFrame:
    from_new = F.col("_new").isNotNull()
    action = (
        F.when(F.col("_old").isNull(), F.lit("insert"))
        .when(from_new & _values_differ("old", "new", values), F.lit("update"))
        .otherwise(F.lit("keep"))
    )
    taken = [F.when(from_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in columns]
    return joined.select(*taken, action.alias("action"))


def table_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: ``added``, ``removed``, ``changed`` or ``same``."""
    _same_columns(before, after)
    values = [c for c in before.columns if c not in keys]
    old = before.withColumn("_old", F.lit(True)).alias("old")
    new = after.withColumn("_new", F.lit(True)).alias("new")
    status = (
        F.when(F.col("_old").isNull(), F.lit("added"))
        .when(F.col("_new").isNull(), F.lit("removed"))
        .when(_values_differ("old", "new", values), F.lit("changed"))
        .otherwise(F.lit("same"))
    )
    either = [
        F.when(F.col("_new").isNotNull(), F.col(f"new.{k}")).otherwise(F.col(f"old.{k}")).alias(k)
        for k in keys
    ]
    return old.join(new, _keys_equal("old", "new", keys), "full_outer").select(*either, status.alias("status"))
