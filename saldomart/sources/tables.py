"""Tables of the four layers, stored as parquet.

Every publish writes new directories ``<layer>/<table>/<period>/v<N>`` and then switches: a
file ``_current/<n>`` that names the live version of every period takes its name in one
rename, and the file with the highest number counts. However many periods a publish
replaces, readers see all of them old or all of them new. A publish may read the table it
replaces, a failed one changes nothing for readers, and a period that became empty is empty.
One writer per table is assumed.

The switch file also holds what was noted about a version (``facts``), such as which other
version it was calculated from.

A table may have declared keys, stored with it. Every publish then refuses rows that share
a key with each other or with a live row of another period, and stores those keys, all of
them, in ``<table>_duplicates``. For that a version has an index beside it (``k<N>``): its
keys, texts as digests, in order. The switch file holds the range of the keys of each
period, and only indexes whose range meets that of the new keys are read.

A table with a row for each day may be stored in runs: one row for days in a row that are
alike but for the day, with the last of them as its day and the first in ``_since``. Readers
get a row for each day.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from saldomart.functions.sizes import broadcast_if_small, observed, rows_digest
from saldomart.operators.duplicates import DuplicateKeys, find_duplicates
from saldomart.session import hadoop_path, move_folder, new_folder, read_text, remove_folder, write_text

LAYERS = ("ds", "dm", "rd", "logs")
_NAME = re.compile(r"[A-Za-z0-9_-]+")
_RANGE_CHARS = 64  # of a text, in the range of a period's keys
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_PERIOD = "_period"
SINCE = "_since"  # the first day of a run
_SINCE_FIELD = T.StructField(SINCE, T.DateType())


@dataclass(frozen=True)
class Published:
    path: str
    rows: int
    counts: dict[str, int] = field(default_factory=dict)
    digest: str | None = None


@dataclass(frozen=True)
class Prepared:
    """What was written and checked and is not live yet."""

    published: Published
    versions: dict[str, int]
    ranges: dict[str, dict | None]  # of keys, by period; empty without an index
    runs: str | None = None  # the column of the day, of rows stored in runs

    def path(self, base: str, period: str) -> str:
        return f"{base}/{period}/v{self.versions[period]}"


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, in a form that Spark's optimizer sees through."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*nulls).filter(F.lit(False))


def every_day(rows: DataFrame, day: str) -> DataFrame:
    """A row for each day of rows that are runs of days."""
    days = F.explode(F.sequence(SINCE, day, F.expr("interval 1 day"))).alias(day)
    return rows.select(*[days if c == day else F.col(c) for c in rows.columns if c != SINCE])


# Keys in an index


def _form(f: T.StructField) -> Column:
    """A key column as an index holds it: texts and bytes as digests, others as they are."""
    column = F.col(f.name)
    if isinstance(f.dataType, (T.StringType, T.BinaryType)):
        return F.unhex(F.sha2(column.cast("binary"), 256)).alias(f.name)
    return column


def _forms(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [_form(df.schema[k]) for k in keys]


def _range_of(f: T.StructField) -> Column:
    """Lowest and highest value of a column and whether it has NULLs; NULL where no range is kept."""
    if isinstance(f.dataType, _WHOLE):
        value = F.col(f.name).cast("long")
    elif isinstance(f.dataType, T.DateType):
        value = F.date_format(f.name, "yyyy-MM-dd")
    elif isinstance(f.dataType, T.StringType):
        value = F.substring(f.name, 1, _RANGE_CHARS)
    else:
        return F.lit(None).cast("string").alias(f.name)
    return F.struct(F.min(value).alias("low"), F.max(value).alias("high"), F.count_if(value.isNull()).alias("nulls")).alias(f.name)


def _plain_range(found) -> list | None:
    return None if found is None else [found["low"], found["high"], found["nulls"] > 0]


def _ranges_meet(one: dict | None, other: dict | None) -> bool:
    """Whether two sets of keys may share a key. No range (None) is no key; a column without one may hold anything."""
    if one is None or other is None:
        return False
    for column in one.keys() & other.keys():
        if one[column] is None or other[column] is None:
            continue
        (low, high, nulls), (other_low, other_high, other_nulls) = one[column], other[column]
        apart = low is None or other_low is None or high < other_low or other_high < low
        if apart and not (nulls and other_nulls):
            return False
    return True


def _same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # files

    def _hadoop(self, path: str):
        return hadoop_path(self.spark, path)

    def table_dir(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"layer {layer!r} is not one of {LAYERS}")
        if not _NAME.fullmatch(table):
            raise ValueError(f"bad table name {table!r}")
        return f"{self.root}/{layer}/{table}"

    def _written(self, layer: str, table: str) -> dict[str, list[int]]:
        """Version numbers by period, ascending, of all directories, live or not."""
        fs, pattern = self._hadoop(f"{self.table_dir(layer, table)}/*/v*")
        found: dict[str, list[int]] = {}
        for status in fs.globStatus(pattern) or []:
            version = status.getPath()
            found.setdefault(version.getParent().getName(), []).append(int(version.getName()[1:]))
        return {period: sorted(numbers) for period, numbers in found.items()}

    # the switch

    def _switches(self, layer: str, table: str) -> list[int]:
        fs, pattern = self._hadoop(f"{self.table_dir(layer, table)}/_current/[0-9]*")
        return sorted(int(s.getPath().getName()) for s in fs.globStatus(pattern) or [])

    def _state(self, layer: str, table: str) -> dict[str, dict]:
        """By period: ``versions`` published, the last of which is live, ``facts`` and ``keys`` of the live one."""
        numbers = self._switches(layer, table)
        if not numbers:
            return {}
        return json.loads(read_text(self.spark, f"{self.table_dir(layer, table)}/_current/{numbers[-1]:012d}"))

    def _put(self, layer: str, table: str, state: dict[str, dict]) -> None:
        """Make ``state`` the table's, in one rename."""
        folder, numbers = f"{self.table_dir(layer, table)}/_current", self._switches(layer, table)
        new = f"{folder}/_new-{uuid.uuid4().hex}"
        write_text(self.spark, new, json.dumps(state))
        self._rename(new, f"{folder}/{(numbers[-1] if numbers else 0) + 1:012d}")

    def _rename(self, path: str, target: str) -> None:
        move_folder(self.spark, path, target)

    def switch(
        self,
        layer: str,
        table: str,
        prepared: Sequence[Prepared],
        facts: dict[str, dict] | None = None,
        drop: Sequence[str] = (),
    ) -> None:
        """Make all that was prepared live at once, note ``facts`` by period, and take periods out.

        Facts replace those of the period's version before, also where no version is new.
        """
        state = self._state(layer, table)
        for period in drop:
            state.pop(period, None)
        for one in prepared:
            for period, version in one.versions.items():
                entry = state.setdefault(period, {"versions": []})
                entry["versions"] = [*entry["versions"], version]
                entry["facts"] = {}
                entry["keys"] = {"range": one.ranges[period]} if period in one.ranges else None
                entry["runs"] = one.runs
        for period, known in (facts or {}).items():
            if period not in state:
                raise LookupError(f"{layer}.{table} has no period {period}")
            state[period]["facts"] = known
        self._one_kind(layer, table, set(state))
        self._put(layer, table, state)

    # reading

    def live(self, layer: str, table: str) -> dict[str, str]:
        """The live directory of every period."""
        base = self.table_dir(layer, table)
        return {period: f"{base}/{period}/v{e['versions'][-1]}" for period, e in self._state(layer, table).items()}

    def facts(self, layer: str, table: str) -> dict[str, dict]:
        """What was noted about the live version of every period."""
        return {period: e["facts"] for period, e in self._state(layer, table).items()}

    def stamps(self, layer: str, table: str) -> dict[str, str]:
        """Name and live version of every period, to note what something was calculated from."""
        return {period: f"{period}@{e['versions'][-1]}" for period, e in self._state(layer, table).items()}

    def exists(self, layer: str, table: str) -> bool:
        return bool(self._state(layer, table))

    def read(
        self,
        layer: str,
        table: str,
        periods: Sequence[str] | None = None,
        schema: StructType | None = None,
        in_runs: str | None = None,
    ) -> DataFrame:
        """The live rows, of all periods or of those named.

        With ``schema``, a table or period that was never published reads as empty. With
        ``in_runs``, the column of the day, rows are runs of days: that column holds the
        last day of a run and ``_since`` its first. Days that are not stored in runs are
        runs of one day.
        """
        state, live = self._state(layer, table), self.live(layer, table)
        wanted = sorted(live) if periods is None else [p for p in periods if p in live]
        if not wanted:
            if schema is None:
                raise LookupError(f"{layer}.{table} has no published rows for {periods or 'any period'}")
            found = empty_table(self.spark, schema)
            return found if in_runs is None else found.withColumn(SINCE, F.col(in_runs))
        kinds: dict[str | None, list[str]] = {}
        for p in wanted:
            kinds.setdefault(state[p].get("runs"), []).append(live[p])
        parts = []
        for day, paths in kinds.items():
            stored = schema if schema is None or day is None else StructType([*schema.fields, _SINCE_FIELD])
            rows = (self.spark.read if stored is None else self.spark.read.schema(stored)).parquet(*paths)
            if day is None and in_runs is not None:
                rows = rows.withColumn(SINCE, F.col(in_runs))
            parts.append(every_day(rows, day) if day is not None and in_runs is None else rows)
        return reduce(DataFrame.unionByName, parts)

    # keys

    def declare_keys(self, layer: str, table: str, keys: Sequence[str]) -> None:
        """From now on no two rows of the table may share ``keys``, whoever publishes them and in whatever periods.

        Live rows that do so already are listed and refuse the declaration.
        """
        if self.exists(layer, table):
            self._refuse_duplicates(self.read(layer, table), layer, table, keys)
        write_text(self.spark, f"{self.table_dir(layer, table)}/_keys", "\n".join(keys))

    def declared_keys(self, layer: str, table: str) -> list[str]:
        text = read_text(self.spark, f"{self.table_dir(layer, table)}/_keys")
        return [] if text is None else text.split("\n")

    def _refuse_duplicates(self, rows: DataFrame, layer: str, table: str, keys: Sequence[str]) -> None:
        """Keys that ``rows`` hold more than once are stored and raised."""
        if keys:
            self._refuse(find_duplicates(rows, keys), layer, table, keys)

    def _refuse(self, found: DataFrame, layer: str, table: str, keys: Sequence[str]) -> None:
        """Stores and raises keys and the number of their rows, if there are any."""
        store = f"{table}_duplicates"
        seen, version = Observation(), self._next(layer, store, "all")
        path = f"{self.table_dir(layer, store)}/all/v{version}"
        found.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
        number = observed(seen, ["rows"])["rows"]
        if not number:
            remove_folder(self.spark, path)
            return
        self.switch(layer, store, [Prepared(Published(path, number), {"all": version}, {})])
        names = ", ".join(keys)
        raise DuplicateKeys(f"{number} duplicate keys in {names} of {layer}.{table}: see {layer}.{store}")

    def _key_ranges(self, rows: DataFrame, keys: Sequence[str], periods: Sequence[str]) -> dict[str, dict | None]:
        """Range of the keys of each period of ``rows``. A row for a period is collected."""
        found = rows.groupBy(_PERIOD).agg(*[_range_of(rows.schema[k]) for k in keys]).collect()
        ranges = {r[_PERIOD]: {k: _plain_range(r[k]) for k in keys} for r in found}
        return {p: ranges.get(p) for p in periods}

    def _indexed(self, layer: str, table: str, keys: Sequence[str], schema: StructType, ranges: Sequence[dict | None], leave: Sequence[str] = ()) -> DataFrame | None:
        """Keys, as an index holds them, and period of live rows whose period may hold a key in one of ``ranges``.

        A period without an index is read itself, its key columns alone.
        """
        base, key_schema = self.table_dir(layer, table), StructType([schema[k] for k in keys])
        indexes: list[str] = []
        others: dict[str | None, list[str]] = {}
        for period, entry in self._state(layer, table).items():
            if period in leave:
                continue
            known, version = entry.get("keys"), entry["versions"][-1]
            if known is None or (known["range"] is not None and set(known["range"]) != set(keys)):
                others.setdefault(entry.get("runs"), []).append(f"{base}/{period}/v{version}")
            elif any(_ranges_meet(known["range"], r) for r in ranges):
                indexes.append(f"{base}/{period}/k{version}")
        period = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[kv]\d+/[^/]+$", 1).alias(_PERIOD)
        forms = [_form(f) for f in key_schema.fields]
        found = []
        if indexes:
            found.append(self.spark.read.parquet(*indexes).select(*keys, period))
        for day, paths in others.items():
            of_runs = [] if day is None else [f for f in (_SINCE_FIELD, T.StructField(day, T.DateType())) if f.name not in keys]
            rows = self.spark.read.schema(StructType([*key_schema.fields, *of_runs])).parquet(*paths).select("*", period)
            found.append((rows if day is None else every_day(rows, day)).select(*forms, _PERIOD))
        return reduce(DataFrame.unionByName, found) if found else None

    def periods_holding(self, layer: str, table: str, rows: DataFrame, keys: Sequence[str]) -> list[str]:
        """The periods that hold a key of ``rows``. Indexes are read where the ranges of keys meet, and no rows."""
        keyed = rows.select(*keys)
        ranges = self._key_ranges(keyed.withColumn(_PERIOD, F.lit("new")), keys, ["new"])
        known = self._indexed(layer, table, keys, keyed.schema, list(ranges.values()))
        if known is None:
            return []
        wanted = broadcast_if_small(keyed).select(*_forms(keyed, keys))
        met = known.alias("known").join(wanted.alias("new"), _same_keys("known", "new", keys), "left_semi")
        return sorted(r[_PERIOD] for r in met.select(_PERIOD).distinct().collect())

    def _refuse_live_keys(self, rows: DataFrame, layer: str, table: str, keys: Sequence[str], prepared: Prepared) -> None:
        """Keys of ``rows`` that a live row of another period has are stored and raised."""
        known = self._indexed(layer, table, keys, rows.schema, list(prepared.ranges.values()), list(prepared.versions))
        if known is None:
            return
        keyed = rows.select(*keys)
        forms = [c.alias(f"_{k}") for k, c in zip(keys, _forms(keyed, keys))]
        new = broadcast_if_small(keyed).select(*keys, *forms)
        same = reduce(Column.__and__, [F.col(f"known.{k}").eqNullSafe(F.col(f"new._{k}")) for k in keys])
        met = known.alias("known").join(new.alias("new"), same)
        self._refuse(met.groupBy(*[F.col(f"new.{k}") for k in keys]).agg((F.count(F.lit(1)) + 1).alias("n")), layer, table, keys)

    # writing

    def _next(self, layer: str, table: str, period: str, written: dict[str, list[int]] | None = None) -> int:
        """The next version of a period."""
        if not _NAME.fullmatch(period):
            raise ValueError(f"bad period name {period!r}")
        existing = (self._written(layer, table) if written is None else written).get(period, [])
        return existing[-1] + 1 if existing else 1

    def _one_kind(self, layer: str, table: str, periods: set[str]) -> None:
        """A table has periods or is a whole, not both."""
        if "all" in periods and len(periods) > 1:
            raise ValueError(f"{layer}.{table} cannot hold {sorted(periods - {'all'})} beside ['all']")

    def publish(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        period: str = "all",
        keys: Sequence[str] = (),
        counts: dict[str, Column] | None = None,
        columns: Sequence[str] | None = None,
        sort_by: Sequence[str] = (),
        facts: dict | None = None,
    ) -> Published:
        """Replace one period of a table, or with ``period='all'`` a table without periods.

        Rows that share ``keys`` or the declared keys of the table keep the old rows live;
        the written rows are checked, so the result is computed once. ``counts`` are
        conditions counted while writing, ``columns`` those to write. ``sort_by`` orders
        each file, so that readers who filter on it skip most of the file. ``facts`` are
        noted with the version.
        """
        prepared = self.prepare(df, layer, table, period, keys, counts, columns, sort_by)
        self.switch(layer, table, [prepared], None if facts is None else {period: facts})
        return prepared.published

    def prepare(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        period: str = "all",
        keys: Sequence[str] = (),
        counts: dict[str, Column] | None = None,
        columns: Sequence[str] | None = None,
        sort_by: Sequence[str] = (),
        digest: bool = False,
    ) -> Prepared:
        """``publish`` up to the switch. ``digest`` asks for that of the rows, as exports note it."""
        version = self._next(layer, table, period)
        path = f"{self.table_dir(layer, table)}/{period}/v{version}"
        self._one_kind(layer, table, {period, *self._state(layer, table)})
        seen = Observation()
        metrics = [F.count_if(cond).alias(name) for name, cond in (counts or {}).items()]
        if digest:
            metrics.append(rows_digest(df).alias("_digest"))
        counted = df.observe(seen, F.count(F.lit(1)).alias("_rows"), *metrics)
        written = counted.select(*(columns or df.columns))
        if sort_by:
            written = written.sortWithinPartitions(*sort_by)
        written.write.mode("errorifexists").parquet(path)
        numbers = observed(seen, ["_rows", *(counts or {}), *(["_digest"] if digest else [])])
        found = str(numbers.pop("_digest")) if digest else None
        published = Published(path, numbers.pop("_rows"), numbers, found)
        rows = self.spark.read.schema(written.schema).parquet(path)
        declared = self.declared_keys(layer, table)
        for each in {tuple(keys), tuple(declared)}:
            self._refuse_duplicates(rows, layer, table, each)
        if not declared:
            return Prepared(published, {period: version}, {})
        index = rows.select(*_forms(rows, declared)).sortWithinPartitions(*declared)
        index.write.parquet(f"{self.table_dir(layer, table)}/{period}/k{version}")
        ranges = self._key_ranges(rows.withColumn(_PERIOD, F.lit(period)), declared, [period])
        prepared = Prepared(published, {period: version}, ranges)
        self._refuse_live_keys(rows, layer, table, declared, prepared)
        return prepared

    def publish_periods(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        period: Column,
        periods: Sequence[str] = (),
        keys: Sequence[str] = (),
        counts: dict[str, Column] | None = None,
        columns: Sequence[str] | None = None,
        sort_by: Sequence[str] = (),
        index: Sequence[str] = (),
        facts: dict[str, dict] | None = None,
        runs: str | None = None,
    ) -> Published:
        """Replace all periods that occur in ``df``, and ``periods``, in one write and one switch.

        ``period`` names the period of a row. A period of ``periods`` without rows becomes
        empty. Keys are checked over all rows written, declared keys also over the live rows
        of other periods. ``index`` names keys by which ``periods_holding`` is to find rows
        of a table whose keys are not declared. Large periods are written by several tasks.
        ``runs`` names the column of the day where the rows of ``df`` are runs of days;
        counted and checked are days.
        """
        prepared = self.prepare_periods(df, layer, table, period, periods, keys, counts, columns, sort_by, index, runs)
        self.switch(layer, table, [prepared], facts)
        return prepared.published

    def prepare_periods(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        period: Column,
        periods: Sequence[str] = (),
        keys: Sequence[str] = (),
        counts: dict[str, Column] | None = None,
        columns: Sequence[str] | None = None,
        sort_by: Sequence[str] = (),
        index: Sequence[str] = (),
        runs: str | None = None,
    ) -> Prepared:
        """``publish_periods`` up to the switch."""
        base = self.table_dir(layer, table)
        new = f"{base}/_new-{uuid.uuid4().hex}"
        named = F.when(period.isNull(), F.raise_error(F.lit(f"row of {table} without a period"))).otherwise(period)
        seen = Observation()
        each = F.lit(1) if runs is None else F.datediff(runs, SINCE) + 1
        named_counts = {"_rows": F.lit(True), **(counts or {})}
        metrics = [F.coalesce(F.sum(F.when(cond, each)), F.lit(0)).alias(name) for name, cond in named_counts.items()]
        counted = df.observe(seen, *metrics)
        wanted = list(columns or df.columns)
        written = counted.select(*wanted, named.cast("string").alias(_PERIOD)).hint("rebalance", _PERIOD)
        if sort_by:
            written = written.sortWithinPartitions(_PERIOD, *sort_by)
        try:
            written.write.partitionBy(_PERIOD).parquet(f"{new}/rows")
            numbers = observed(seen, ["_rows", *(counts or {})])
            published = Published(base, numbers.pop("_rows"), numbers)
            with_period = StructType([*[f for f in written.schema.fields if f.name != _PERIOD], written.schema[_PERIOD]])
            rows = self.spark.read.schema(with_period).parquet(f"{new}/rows")
            rows = rows if runs is None else every_day(rows, runs)
            declared = self.declared_keys(layer, table)
            for each in {tuple(keys), tuple(declared)}:
                self._refuse_duplicates(rows, layer, table, each)
            found = self._folders(f"{new}/rows")
            names, on_disk = sorted({*found, *periods}), self._written(layer, table)
            versions = {p: self._next(layer, table, p, on_disk) for p in names}
            self._one_kind(layer, table, {*names, *self._state(layer, table)})
            by, ranges = declared or list(index), {}
            if by:
                keyed = rows.select(*_forms(rows, by), _PERIOD)
                keyed.sortWithinPartitions(_PERIOD, *by).write.partitionBy(_PERIOD).parquet(f"{new}/index")
                ranges = self._key_ranges(rows, by, names)
            prepared = Prepared(published, versions, ranges, runs)
            if declared:
                self._refuse_live_keys(rows, layer, table, declared, prepared)
            if versions.keys() - found.keys():
                empty_table(self.spark, StructType(with_period.fields[:-1])).write.parquet(f"{new}/empty")
            for p, version in versions.items():
                if p in found:
                    move_folder(self.spark, found[p], f"{base}/{p}/v{version}")
                else:
                    self._copy(f"{new}/empty", f"{base}/{p}/v{version}")
            for p, folder in (self._folders(f"{new}/index") if by else {}).items():
                move_folder(self.spark, folder, f"{base}/{p}/k{versions[p]}")
        finally:
            remove_folder(self.spark, new)
        return prepared

    def _folders(self, path: str) -> dict[str, str]:
        """Folders of a write that was partitioned by period."""
        fs, pattern = self._hadoop(f"{path}/{_PERIOD}=*")
        return {s.getPath().getName().partition("=")[2]: s.getPath().toString() for s in fs.globStatus(pattern) or []}

    def _copy(self, path: str, target: str) -> None:
        fs, source = self._hadoop(path)
        _, to = self._hadoop(target)
        conf = self.spark._jsc.hadoopConfiguration()
        self.spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, fs, to, False, conf)

    # tables that grow row by row

    def note(self, layer: str, table: str, rows: Sequence[dict], name: str | None = None, folder: str = "notes") -> str:
        """Add a few rows as one small file, without a Spark job. Returns its name."""
        name = name or uuid.uuid4().hex
        lines = "\n".join(json.dumps(row) for row in rows)
        write_text(self.spark, f"{self.table_dir(layer, table)}/{folder}/{name}.json", lines)
        return name

    def forget_note(self, layer: str, table: str, name: str, folder: str = "notes") -> None:
        remove_folder(self.spark, f"{self.table_dir(layer, table)}/{folder}/{name}.json")

    def _note_files(self, layer: str, table: str, folder: str = "notes") -> list[str]:
        fs, pattern = self._hadoop(f"{self.table_dir(layer, table)}/{folder}/*.json")
        return [s.getPath().toString() for s in fs.globStatus(pattern) or []]

    def notes(self, layer: str, table: str, schema: StructType, folder: str = "notes") -> DataFrame:
        """All rows of small files, and with the usual folder those that were compacted."""
        files = self._note_files(layer, table, folder)
        found = self.spark.read.schema(schema).json(files) if files else empty_table(self.spark, schema)
        return found if folder != "notes" else found.unionByName(self.read(layer, table, schema=schema))

    def compact_notes(self, layer: str, table: str, schema: StructType) -> int:
        """Put the rows of all small files into one version of the table and delete them. Returns how many rows it has.

        A crash in between leaves rows twice; readers tell them apart by what identifies a row.
        """
        files = self._note_files(layer, table)
        done = self.publish(self.notes(layer, table, schema).distinct().coalesce(1), layer, table)
        for file in files:
            remove_folder(self.spark, file)
        return done.rows

    @contextmanager
    def stage(self, name: str) -> Iterator[str]:
        """A folder in the shared space for the length of a job."""
        folder = new_folder(self.spark, name)
        try:
            yield folder
        finally:
            remove_folder(self.spark, folder)

    def drop_old_versions(self, layer: str, table: str, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` published versions of every period.

        Directories that never went live and are older than the live one go too, and switch
        files but for the last two. Call it when no reader still uses an old version.
        """
        if keep < 1:
            raise ValueError("the live version must be kept")
        base, state = self.table_dir(layer, table), self._state(layer, table)
        dropped = []
        for period, numbers in self._written(layer, table).items():
            if period not in state:
                continue
            entry = state[period]
            entry["versions"] = entry["versions"][-keep:]
            for n in numbers:
                if n < entry["versions"][-1] and n not in entry["versions"]:
                    remove_folder(self.spark, f"{base}/{period}/k{n}")
                    remove_folder(self.spark, f"{base}/{period}/v{n}")
                    dropped.append(f"{base}/{period}/v{n}")
        self._put(layer, table, state)
        for number in self._switches(layer, table)[:-2]:
            remove_folder(self.spark, f"{base}/_current/{number:012d}")
        return dropped
