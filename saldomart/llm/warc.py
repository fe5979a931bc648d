"""WARC files: pages written as records, records read with their offsets, and a fixity audit.

An audit hashes every record and builds a tree per archive: a node is the hash of the
ordered hashes of its children, which cover consecutive ranges of offsets. Two replicas
are compared at the roots; only below nodes that differ are the children compared, down
to the records.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saldomart.llm.common import batch, stored

FANOUT = 16
ARCHIVE_RECORDS = 1000

# Fixed values of the file format.
_END = "\r\n\r\n"
_VERSION = "WARC/1.0"
_DATE = "1970-01-01T00:00:00Z"  # pages carry no date

_ORDER = ("record_id", "digest")  # of the records of an archive; rows equal in both are equal


def page_records(pages: DataFrame, records: int = ARCHIVE_RECORDS) -> DataFrame:
    """Pages as records of archives: archive, record_id, record, and a digest that orders equal ids.

    An archive holds the pages of ``records`` consecutive page_ids, in their order. Pages
    without an id go to archives of their own, by the hash of what they hold. NULL url or
    html counts as empty; line breaks in a url become blanks. Repeated pages are repeated
    records. Other columns are ignored.
    """
    page_id, url = F.col("page_id").cast("long"), F.coalesce(F.col("url"), F.lit(""))
    html = F.coalesce(F.col("html"), F.lit(""))
    digest = F.xxhash64(url, html)
    archive = F.coalesce(F.floor(page_id / records), -1 - F.pmod(digest, F.lit(1 << 20)))
    lines = [
        F.lit(_VERSION),
        F.lit("WARC-Type: resource"),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(page_id, digest).cast("string"), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.translate(url, "\r\n", "  ")),
        F.lit(f"WARC-Date: {_DATE}"),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.octet_length(html).cast("string"), F.lit(_END), html),
    ]
    return pages.select(
        archive.cast("long").alias("archive"),
        F.coalesce(page_id, digest).alias("record_id"),
        digest.alias("digest"),
        F.concat_ws("\r\n", *lines).alias("record"),
    )


def write_warc(records: DataFrame, path: str) -> None:
    """One compressed file per archive, records in their order, each ended by two line breaks."""
    ordered = records.repartition("archive").sortWithinPartitions("archive", *_ORDER)
    ordered.select("archive", "record").write.partitionBy("archive").option("lineSep", _END).option(
        "compression", "gzip"
    ).text(path)


def parse_warc(content: bytes) -> Iterator[tuple[int, int, int | None]]:
    """Offset, length and page number of each record. A stretch that is no record has no number."""
    at, end = 0, _END.encode()
    while at < len(content):
        head_end = content.find(end, at)
        lines = content[at : head_end if head_end >= 0 else len(content)].split(b"\r\n")
        fields = dict(line.split(b": ", 1) for line in lines[1:] if b": " in line)
        size, name = fields.get(b"Content-Length", b""), fields.get(b"WARC-Record-ID", b"")
        stop = head_end + len(end) + int(size) if size.isdigit() and head_end >= 0 else -1
        if lines[0] == _VERSION.encode() and stop >= 0 and content[stop : stop + len(end)] == end:
            number = name.removeprefix(b"<urn:page:").removesuffix(b">")
            yield at, stop - at, int(number) if number.lstrip(b"-").isdigit() else None
        else:  # go on at the next thing that looks like a record
            following = content.find(end + _VERSION.encode(), at)
            stop = following if following >= 0 else max(at, len(content) - len(end))
            yield at, stop - at, None
        at = stop + len(end)


_LEAVES = pa.schema(
    [
        ("archive", pa.int64()),
        ("ordinal", pa.int64()),
        ("record_id", pa.int64()),
        ("record_offset", pa.int64()),
        ("n_bytes", pa.int64()),
        ("hash", pa.string()),
    ]
)
_LEAVES_DDL = "archive long, ordinal long, record_id long, record_offset long, n_bytes long, hash string"


def warc_leaves(spark: SparkSession, path: str) -> DataFrame:
    """Place and hash of every record of the files under ``path``. A file must fit into a task."""
    files = spark.read.format("binaryFile").load(path)
    archive = F.regexp_extract("path", r"archive=(-?\d+)", 1).cast("long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for number, packed in zip(rows.column(0).to_pylist(), rows.column(1)):
                content = gzip.decompress(packed.as_buffer())
                found = list(parse_warc(content))
                yield batch(
                    _LEAVES,
                    [number] * len(found),
                    list(range(len(found))),
                    [i for _, _, i in found],
                    [at for at, _, _ in found],
                    [size for _, size, _ in found],
                    [hashlib.sha256(content[at : at + size]).hexdigest() for at, size, _ in found],
                )

    return files.select(archive.alias("archive"), "content").mapInArrow(read, _LEAVES_DDL)


def record_leaves(records: DataFrame) -> DataFrame:
    """The same for records that are still rows: their places in the files to come."""
    hashed = records.select(
        "archive", *_ORDER, F.octet_length("record").cast("long").alias("n_bytes"), F.sha2("record", 256).alias("hash")
    )
    order = Window.partitionBy("archive").orderBy(*_ORDER, "hash")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.col("n_bytes") + len(_END)).over(before), F.lit(0))
    ordinal = F.row_number().over(order).cast("long") - 1
    return hashed.withColumns({"record_offset": offset, "ordinal": ordinal}).select(*_LEAVES.names)


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """One node for each range of ``fanout`` children, whose hashes it hashes in order."""
    children = F.array_sort(F.collect_list(F.struct("ordinal", "hash")))
    return (
        nodes.groupBy("archive", F.floor(F.col("ordinal") / fanout).alias("parent"))
        .agg(F.sha2(F.concat_ws(",", F.transform(children, lambda c: c["hash"])), 256).alias("hash"))
        .withColumnRenamed("parent", "ordinal")
    )


def merkle_levels(leaves: DataFrame, depth: int, fanout: int = FANOUT) -> list[DataFrame]:
    """Nodes by level, leaves first; the last has the roots. Each level is stored, the next is made from it."""
    levels = [leaves.select("archive", "ordinal", "hash")]
    for _ in range(depth):
        levels.append(stored(_parents(levels[-1], fanout), "fixity-level"))
    return levels


def _differing(left: DataFrame, right: DataFrame, under: DataFrame | None, fanout: int) -> DataFrame:
    """Archive and ordinal of nodes that differ, among the children of ``under``."""
    if under is not None:
        parents, parent = under.withColumnRenamed("ordinal", "parent"), F.floor(F.col("ordinal") / fanout)
        left, right = (
            side.withColumn("parent", parent).join(parents, ["archive", "parent"], "left_semi")
            for side in (left, right)
        )
    keys = ["archive", "ordinal"]
    both = left.select(*keys, F.col("hash").alias("one")).join(
        right.select(*keys, F.col("hash").alias("other")), keys, "full"
    )
    return both.filter(~F.col("one").eqNullSafe(F.col("other"))).select(*keys)


def _numbered(leaves: DataFrame, prefix: str) -> DataFrame:
    """Records of an archive that bear the same id are told apart by their order."""
    again = Window.partitionBy("archive", "record_id").orderBy("ordinal")
    return leaves.select(
        "archive",
        "record_id",
        F.row_number().over(again).alias("copy"),
        F.col("record_offset").alias(f"{prefix}_offset"),
        F.col("n_bytes").alias(f"{prefix}_bytes"),
        F.col("hash").alias(f"{prefix}_hash"),
    )


def fixity_audit(master: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """What differs between two replicas of archives, located by their trees.

    Both have a row per record: archive, ordinal, record_id, record_offset, n_bytes, hash.
    Returns a row per record below differing branches that is corrupt, missing, extra or
    moved: archive, record_id, status, and offset and bytes in both replicas (NULL where
    absent). An archive that one side lacks is missing or extra as a whole. Records without
    a readable id (NULL) match each other in their order. Empty inputs have no rows.

    Leaves and levels are stored once; a level is a grouping of at most ``fanout`` rows a node.
    """
    master, replica = stored(master, "fixity-master"), stored(replica, "fixity-replica")
    last = master.select("ordinal").union(replica.select("ordinal")).agg(F.max("ordinal")).first()[0] or 0
    depth = 1
    while fanout**depth <= last:
        depth += 1
    one, other = merkle_levels(master, depth, fanout), merkle_levels(replica, depth, fanout)
    suspects = None
    for left, right in zip(reversed(one), reversed(other)):
        suspects = _differing(left, right, suspects, fanout)
    suspects = stored(suspects, "fixity-suspects")
    keys = ["archive", "ordinal"]
    lost = _numbered(master.join(suspects, keys, "left_semi"), "record")
    found = _numbered(replica.join(suspects, keys, "left_semi"), "replica")
    same = (
        (lost["archive"] == found["archive"])
        & lost["record_id"].eqNullSafe(found["record_id"])
        & (lost["copy"] == found["copy"])
    )
    status: Column = (
        F.when(F.col("replica_hash").isNull(), "missing")
        .when(F.col("record_hash").isNull(), "extra")
        .when(F.col("record_hash") != F.col("replica_hash"), "corrupt")
        .otherwise("moved")
    )
    return lost.join(found, same, "full").select(
        F.coalesce(lost["archive"], found["archive"]).alias("archive"),
        F.coalesce(lost["record_id"], found["record_id"]).alias("record_id"),
        status.alias("status"),
        "record_offset",
        "replica_offset",
        "record_bytes",
        "replica_bytes",
    )
