"""One log row per operation: noted when it begins, completed when it ends."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldomart.schemas import ETL_LOG
from saldomart.sources.tables import Published, Warehouse

SUCCESS, ERROR = "SUCCESS", "ERROR"
STARTED = "STARTED"  # runs, or was killed before it could tell how it ended

_TIMES = ("started_at", "ended_at")
_STORED = T.StructType(
    [T.StructField("operation", T.StringType())]
    + [T.StructField(f.name, T.LongType() if f.name in _TIMES else f.dataType) for f in ETL_LOG.fields]
)

Result = TypeVar("Result", int, Published)


def run_logged(
    warehouse: Warehouse,
    task: str,
    operation: Callable[[], Result],
    affected: Callable[[Result], int] | None = None,
) -> Result:
    """Run ``operation`` and log its times, rows and outcome. A failure is raised again.

    ``operation`` returns a row count, or what a publish returned; ``affected`` tells the
    rows where that is neither. What an operation publishes goes live as its last step, so
    a failed one has affected no rows. Of one that is killed the row of its beginning stays.
    """
    name = uuid.uuid4().hex
    row = {"operation": name, "task": task, "started_at": _now(), "status": STARTED}
    warehouse.note("logs", "etl_log", [row], name, "open")
    try:
        result = operation()
    except Exception as failure:
        _end(warehouse, row, 0, ERROR, _text(failure))
        raise
    if affected is not None:
        rows = affected(result)
    else:
        rows = result.rows if isinstance(result, Published) else result
    _end(warehouse, row, rows, SUCCESS, None)
    return result


def _now() -> int:
    """Microseconds, as they are stored."""
    passed = datetime.now(timezone.utc) - datetime.fromtimestamp(0, timezone.utc)
    return (passed.days * 86_400 + passed.seconds) * 1_000_000 + passed.microseconds


def _text(failure: Exception) -> str:
    """What went wrong, without the stack of the JVM."""
    cause = getattr(failure, "java_exception", None)
    if cause is None:
        return str(failure) or type(failure).__name__
    while cause.getCause() is not None:
        cause = cause.getCause()
    return cause.getMessage() or cause.toString()


def _end(warehouse: Warehouse, row: dict, rows: int, status: str, error: str | None) -> None:
    ended = {"ended_at": _now(), "rows_affected": rows, "status": status, "error_text": error}
    warehouse.note("logs", "etl_log", [row | ended], row["operation"])
    warehouse.forget_note("logs", "etl_log", row["operation"], "open")


def etl_log(warehouse: Warehouse) -> DataFrame:
    """A row for each operation. One that has not ended has the status ``STARTED``."""
    ended = warehouse.notes("logs", "etl_log", _STORED)
    begun = warehouse.notes("logs", "etl_log", _STORED, "open")
    # An operation that was killed between its last two files has both, and a compacted one may be there twice.
    last = F.max_by(F.struct(*ETL_LOG.fieldNames()), F.coalesce("ended_at", F.lit(0)))
    rows = ended.unionByName(begun).groupBy("operation").agg(last.alias("row")).select("row.*")
    return rows.withColumns({c: F.timestamp_micros(c) for c in _TIMES}).select(*ETL_LOG.fieldNames())


def unended(warehouse: Warehouse) -> DataFrame:
    """Operations without an end: they still run, or were killed. Of those nothing went live."""
    return etl_log(warehouse).filter(F.col("status") == STARTED)


def compact_log(warehouse: Warehouse) -> int:
    """Put the log's small files into one. Returns its rows."""
    return warehouse.compact_notes("logs", "etl_log", _STORED)
