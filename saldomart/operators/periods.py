"""Days and periods that a mart lacks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIRST_DAY, LAST_DAY = "0001-01-01", "9999-12-31"  # of periods without a beginning or an end


def missing_in_mart(source: DataFrame, mart: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the source that the mart does not hold.

    Both sides are reduced to distinct keys first, on the partitioning the join uses.
    """
    return source.select(*keys).distinct().join(mart.select(*keys).distinct(), list(keys), "left_anti")


def find_period_gaps(df: DataFrame, entity: str, date: str) -> DataFrame:
    """Runs of missing days inside an entity's history: last day before, first day after, days.

    Repeated days are dropped first, so an entity never has more rows than days.
    """
    days = df.select(entity, date).filter(F.col(date).isNotNull()).distinct()
    following = F.lead(date).over(Window.partitionBy(entity).orderBy(date))
    return (
        days.withColumn("gap_before", following)
        .withColumn("missing_days", (F.datediff("gap_before", date) - 1).cast("long"))
        .filter("missing_days > 0")
        .select(entity, F.col(date).alias("gap_after"), "gap_before", "missing_days")
    )


def _closed(df: DataFrame, entity: str, start: str, end: str) -> DataFrame:
    """Periods with both ends. One that ends before it begins is an error."""
    begins = F.coalesce(F.col(start), F.lit(FIRST_DAY).cast("date"))
    ends = F.coalesce(F.col(end), F.lit(LAST_DAY).cast("date"))
    inverted = F.raise_error(F.concat(F.lit("a period ends before it begins: "), begins.cast("string")))
    return df.select(
        entity, begins.alias("_begins"), F.when(ends < begins, inverted.cast("date")).otherwise(ends).alias("_ends")
    )


def _or_open(day: Column, limit: str) -> Column:
    return F.when(day != F.lit(limit).cast("date"), day)


def find_interval_gaps(df: DataFrame, entity: str, start: str, end: str) -> DataFrame:
    """Gaps between the periods of an entity: first and last missing day, and how many.

    Periods may overlap, lie in each other or repeat; both days belong to a period. A
    period without an end (NULL) holds for good, one without a beginning always did. Of
    periods that begin on one day the longest is kept before the window, so an entity
    never has more rows than days.
    """
    longest = _closed(df, entity, start, end).groupBy(entity, "_begins").agg(F.max("_ends").alias("_ends"))
    earlier = Window.partitionBy(entity).orderBy("_begins").rowsBetween(Window.unboundedPreceding, -1)
    gap_from = F.date_add(F.max("_ends").over(earlier), 1)
    return (
        longest.withColumn("gap_from", gap_from)
        .filter("gap_from < _begins")
        .select(
            entity,
            "gap_from",
            F.date_sub("_begins", 1).alias("gap_to"),
            F.datediff("_begins", "gap_from").cast("long").alias("missing_days"),
        )
    )


def missing_intervals(source: DataFrame, mart: DataFrame, entity: str, start: str, end: str) -> DataFrame:
    """The longest stretches of days that periods of the source cover and none of the mart's.

    Returns entity, first and last missing day; NULL where the stretch has no beginning or
    no end. Beginnings and ends are summed by day before the window, so an entity never has
    more rows than days.
    """

    def turns(df: DataFrame, of_source: int) -> DataFrame:
        closed = _closed(df, entity, start, end)
        sides = [F.struct(F.col("_begins").alias("day"), F.lit(1).alias("n")),
                 F.struct(F.date_add("_ends", 1).alias("day"), F.lit(-1).alias("n"))]
        each = closed.select(entity, F.inline(F.array(*sides)))
        return each.select(
            entity, "day", (F.col("n") * of_source).alias("source"), (F.col("n") * (1 - of_source)).alias("mart")
        )

    both = turns(source, 1).unionByName(turns(mart, 0))
    by_day = both.groupBy(entity, "day").agg(F.sum("source").alias("source"), F.sum("mart").alias("mart"))
    in_order = Window.partitionBy(entity).orderBy("day")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lacking = (F.sum("source").over(so_far) > 0) & (F.sum("mart").over(so_far) == 0)
    states = by_day.select(entity, "day", lacking.alias("lacking"))
    changed = states.withColumn("before", F.coalesce(F.lag("lacking").over(in_order), F.lit(False)))
    ends = changed.filter("lacking != before").withColumn("next", F.lead("day").over(in_order))
    return ends.filter("lacking").select(
        entity,
        _or_open(F.col("day"), FIRST_DAY).alias("missing_from"),
        _or_open(F.date_sub("next", 1), LAST_DAY).alias("missing_to"),
    )
