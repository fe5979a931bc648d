"""Dates that arrive as text in several formats."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tried in this order. No text matches two of them.
DATE_FORMATS = ("yyyy-MM-dd", "dd.MM.yyyy", "dd-MM-yyyy", "yyyyMMdd")


def _shape(fmt: str) -> str | None:
    """A regular expression for texts of a format of fixed digits, None for other formats."""
    parts = re.split("(yyyy|MM|dd)", fmt)
    if any(re.search("[A-Za-z]", separator) for separator in parts[::2]):
        return None
    digits = {"yyyy": r"\d{4}", "MM": r"\d{2}", "dd": r"\d{2}"}
    return "^" + "".join(digits.get(part, re.escape(part)) for part in parts) + "$"


def _readings(text: Column, formats: Sequence[str]) -> list[Column]:
    """The date in ``text`` by each format, NULL where it does not fit.

    The shape of a text is looked at first: a failed parse is an exception inside Spark,
    and slow.
    """
    trimmed = F.trim(text)
    readings = []
    for fmt in formats:
        parsed, shape = F.try_to_date(trimmed, fmt), _shape(fmt)
        readings.append(parsed if shape is None else F.when(trimmed.rlike(shape), parsed))
    return readings


def date_from_text(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The date in ``text`` by the first format that fits, or NULL."""
    return F.coalesce(*_readings(text, formats))


def _given(text: Column) -> Column:
    return text.isNotNull() & (F.trim(text) != "")


CLEAR, DECIDED, AMBIGUOUS = "clear", "decided", "ambiguous"


def chosen_formats(df: DataFrame, cols: Sequence[str], formats: Sequence[str], by: str) -> DataFrame:
    """For each file (``by``) and date column the format of its texts, from one aggregate.

    Returns by, column, n_texts, n_unread (no format fits), n_conflicts (two formats read
    different dates), format, status. A format may be chosen if it reads every text that any
    reads. ``clear``: no text has two readings. ``decided``: some have, and the formats that
    may be chosen agree on them. ``ambiguous``: they do not, or none may be chosen; format is
    NULL then, and where texts of several formats are clear.
    """
    figures, results = [], []
    for c in cols:
        given, readings = _given(F.col(c)), _readings(F.col(c), formats)
        dates = F.array_distinct(F.array_compact(F.array(*readings)))

        def name(what: str) -> str:
            return f"_{c}_{what}"

        figures += [
            F.count_if(given).alias(name("n")),
            F.count_if(given & (F.size(dates) > 0)).alias(name("read")),
            F.count_if(given & (F.size(dates) > 1)).alias(name("conflicts")),
            *[F.count_if(given & r.isNotNull()).alias(name(f"by{i}")) for i, r in enumerate(readings)],
            *[
                F.count_if(given & (readings[i] != readings[j])).alias(name(f"differ{i}_{j}"))
                for i, j in combinations(range(len(formats)), 2)
            ],
        ]
        may = [F.col(name(f"by{i}")) == F.col(name("read")) for i in range(len(formats))]
        disagree = [may[i] & may[j] & (F.col(name(f"differ{i}_{j}")) > 0) for i, j in combinations(range(len(formats)), 2)]
        at_odds = reduce(Column.__or__, disagree, F.lit(False)) | ~reduce(Column.__or__, may)
        first = F.coalesce(*[F.when(m, F.lit(fmt)) for m, fmt in zip(may, formats)])
        status = F.when(F.col(name("conflicts")) == 0, CLEAR).when(at_odds, AMBIGUOUS).otherwise(DECIDED)
        fields = {
            "column": F.lit(c),
            "n_texts": F.col(name("n")),
            "n_unread": F.col(name("n")) - F.col(name("read")),
            "n_conflicts": F.col(name("conflicts")),
            "format": F.when((status != AMBIGUOUS) & (F.col(name("read")) > 0), first),
            "status": status,
        }
        results.append(F.struct(*[value.alias(key) for key, value in fields.items()]))
    return df.groupBy(by).agg(*figures).select(by, F.inline(F.array(*results)))


def dates_by_file(
    df: DataFrame, cols: Sequence[str], formats: Sequence[str], by: str
) -> tuple[DataFrame, dict[str, Column], dict[str, Column]]:
    """``df`` with what ``chosen_formats`` chose, and for each column its date and whether it is ambiguous.

    A text is read by the format of its file and column. Where none was chosen, or it does
    not fit, the other formats count if they agree; a text they read as different dates is
    ambiguous, and its date NULL.
    """
    chosen = chosen_formats(df, cols, formats, by)
    dates, ambiguous = {}, {}
    for i, c in enumerate(cols):
        of_column = chosen.filter(F.col("column") == c).select(F.col(by).alias(f"_file{i}"), F.col("format").alias(f"_format{i}"))
        df = df.join(of_column, F.col(by).eqNullSafe(F.col(f"_file{i}")), "left")
        readings = _readings(F.col(c), formats)
        by_format = F.coalesce(*[F.when(F.col(f"_format{i}") == fmt, r) for fmt, r in zip(formats, readings)])
        possible = F.array_distinct(F.array_compact(F.array(*readings)))
        dates[c] = F.coalesce(by_format, F.when(F.size(possible) == 1, F.element_at(possible, 1)))
        ambiguous[c] = by_format.isNull() & (F.size(possible) > 1)
    return df, dates, ambiguous


def parse_dates_by_file(
    df: DataFrame, cols: Sequence[str], by: str, formats: Sequence[str] = DATE_FORMATS
) -> tuple[DataFrame, DataFrame]:
    """``parse_dates`` with the formats of each file; a text that may be two dates is rejected, not guessed."""
    known, dates, ambiguous = dates_by_file(df, cols, formats, by)
    unclear = F.concat_ws(", ", *[F.when(ambiguous[c], F.lit(c)) for c in cols])
    bad = F.concat_ws(", ", *[F.when(_given(F.col(c)) & dates[c].isNull() & ~ambiguous[c], F.lit(c)) for c in cols])
    reason = F.when(bad != "", F.concat(F.lit("bad date: "), bad)).when(
        unclear != "", F.concat(F.lit("ambiguous date: "), unclear)
    )
    judged = known.withColumn("reason", reason)
    parsed = judged.filter("reason IS NULL").withColumns(dates).select(*df.columns)
    return parsed, judged.filter("reason IS NOT NULL").select(*df.columns, "reason")


def parse_dates(
    df: DataFrame, cols: Sequence[str], formats: Sequence[str] = DATE_FORMATS
) -> tuple[DataFrame, DataFrame]:
    """Turn the text columns ``cols`` into dates.

    Returns the rows whose texts all parse, and the other rows as they came with a
    ``reason`` that names the bad columns. Empty text and NULL become NULL dates.
    """
    bad = [
        F.when(
            _given(F.col(c)) & date_from_text(F.col(c), formats).isNull(),
            F.lit(c),
        )
        for c in cols
    ]
    any_bad = F.concat_ws(", ", *bad)
    parsed = df.filter(any_bad == "").withColumns(
        {c: date_from_text(F.col(c), formats) for c in cols}
    )
    rejects = df.filter(any_bad != "").withColumn("reason", F.concat(F.lit("bad date: "), any_bad))
    return parsed, rejects
