"""Counts and digests taken while writing, and size checks that decide whether a table may be broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
_FIELD_BYTES = 16
_UNMEASURED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)


def observed(seen: Observation, names: Sequence[str]) -> dict[str, int]:
    """What was counted. A plan that turns out empty is replaced together with its counters."""
    try:
        return dict(seen.get)
    except Py4JJavaError:
        return dict.fromkeys(names, 0)


def rows_digest(df: DataFrame) -> Column:
    """An aggregate over all columns that does not depend on the order of rows: the sum of their hashes."""
    texts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in df.columns]
    return F.coalesce(F.sum(F.xxhash64(*texts).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def row_bytes(schema: T.StructType) -> Column | None:
    """The bytes of a row, strings measured, or None for nested and binary columns."""
    if any(isinstance(f.dataType, _UNMEASURED) for f in schema.fields):
        return None
    width = F.lit(_FIELD_BYTES * (len(schema.fields) + 1)).cast("long")
    for field in schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    return width


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of ``df``, measured and not estimated, fit in ``max_bytes``.

    Tables with nested or binary columns count as not small.
    """
    width = row_bytes(df.schema)
    if width is None:
        return False
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("size")).first()["size"] <= max_bytes


def never_broadcast(df: DataFrame) -> DataFrame:
    """``df`` with a hint that joins it by sorting, for tables that grow with accounts or movements.

    Spark guesses the size of a stored table by its files. Short rows that compress well take
    tens of times that in memory, and a broadcast would send millions of them through the driver.
    """
    return df.hint("merge")


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it is small. Otherwise Spark picks the join."""
    return F.broadcast(df) if is_small(df, max_bytes) else df
