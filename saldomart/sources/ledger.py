"""Which files were loaded into which table, so that a refresh takes only new ones."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldomart.session import hadoop_path
from saldomart.sources.tables import Warehouse

LEDGER = "loaded_files"
_SCHEMA = T.StructType(
    [
        T.StructField("target", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("modified", T.LongType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("digest", T.StringType()),
        T.StructField("loaded_at", T.StringType()),
    ]
)


@dataclass(frozen=True)
class SourceFile:
    path: str
    name: str
    bytes: int
    modified: int
    n_lines: int | None = None
    digest: str | None = None


@dataclass(frozen=True)
class Choice:
    new: list[SourceFile]
    known: list[SourceFile]

    def contents(self) -> list[str]:
        """What identifies the files of the choice, whatever their order."""
        return sorted(f"{f.name}:{f.bytes}:{f.n_lines}:{f.digest}" for f in [*self.new, *self.known])


def source_files(spark: SparkSession, path: str | Sequence[str]) -> list[SourceFile]:
    """The files that Spark reads under a path, a pattern or several of them."""
    found = []
    for each in [path] if isinstance(path, str) else path:
        fs, pattern = hadoop_path(spark, each)
        statuses = list(fs.globStatus(pattern) or [])
        if not statuses:
            raise FileNotFoundError(each)
        for status in statuses:
            inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += [s for s in inside if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
    files = {s.getPath().toString(): s for s in found}
    return [SourceFile(p, s.getPath().getName(), s.getLen(), s.getModificationTime()) for p, s in sorted(files.items())]


def _with_digests(spark: SparkSession, files: list[SourceFile]) -> list[SourceFile]:
    """Number of lines and an order-free digest of each file, in one pass over their texts."""
    if not files:
        return []
    lines = spark.read.text([f.path for f in files]).select("value", F.col("_metadata.file_path").alias("path"))
    each = F.sum(F.xxhash64("value").cast("decimal(38,0)"))
    found = lines.groupBy("path").agg(F.count("*").alias("n"), each.alias("digest")).collect()  # a row a file
    by_path = {hadoop_path(spark, r["path"])[1].toUri().getPath(): r for r in found}

    def completed(f: SourceFile) -> SourceFile:
        row = by_path.get(hadoop_path(spark, f.path)[1].toUri().getPath())
        return replace(f, n_lines=row["n"] if row else 0, digest=str(row["digest"]) if row else "0")

    return [completed(f) for f in files]


def choose_new(warehouse: Warehouse, target: str, path: str | Sequence[str]) -> Choice:
    """The files under ``path`` that were not loaded into ``target`` yet, and the others.

    A file is known if one of its name, size and content was loaded. One whose time of
    change is also as it was is not read again; of the others the texts are read once.
    """
    spark = warehouse.spark
    files = source_files(spark, path)
    names = spark.createDataFrame([(f.name, f.bytes) for f in files], "name string, bytes long") if files else None
    earlier: dict[tuple[str, int], list] = {}
    if names is not None:
        ledger = warehouse.notes("logs", LEDGER, _SCHEMA).filter(F.col("target") == target)
        for row in ledger.join(names, ["name", "bytes"], "left_semi").collect():  # versions of the files at hand
            earlier.setdefault((row["name"], row["bytes"]), []).append(row)
    known, unread = [], []
    for f in files:
        same = [r for r in earlier.get((f.name, f.bytes), []) if r["modified"] == f.modified]
        if same:
            known.append(replace(f, n_lines=same[0]["n_lines"], digest=same[0]["digest"]))
        else:
            unread.append(f)
    new = []
    for f in _with_digests(spark, unread):
        same = [r for r in earlier.get((f.name, f.bytes), []) if (r["n_lines"], r["digest"]) == (f.n_lines, f.digest)]
        (known if same else new).append(f)
    return Choice(new, known)


def note_loaded(warehouse: Warehouse, target: str, files: Sequence[SourceFile]) -> None:
    """Enter files that were loaded."""
    now = datetime.now(timezone.utc).isoformat()
    rows = [
        {"target": target, "name": f.name, "bytes": f.bytes, "modified": f.modified,
         "n_lines": f.n_lines, "digest": f.digest, "loaded_at": now}
        for f in files
    ]
    if rows:
        warehouse.note("logs", LEDGER, rows)


def loaded_files(warehouse: Warehouse) -> DataFrame:
    """A row for each file and load."""
    return warehouse.notes("logs", LEDGER, _SCHEMA).distinct()


def compact_ledger(warehouse: Warehouse) -> int:
    """Put the ledger's small files into one. Returns its rows."""
    return warehouse.compact_notes("logs", LEDGER, _SCHEMA)
