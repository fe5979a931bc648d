"""What the operators share: tables, shared storage, texts of Arrow batches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from saldomart.session import new_folder

WORD_LIMIT = 500_000  # words of a block that a task works on at once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a column; NULL is empty."""
    return ["" if text is None else text for text in column.to_pylist()]


def encoded_texts(column: pa.Array) -> list[bytes]:
    """The texts of a column in UTF-8; NULL is empty."""
    binary = column.cast(pa.large_binary()) if pa.types.is_large_string(column.type) else column.cast(pa.binary())
    return [b"" if text is None else text for text in binary.to_pylist()]


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
    )


def row_blocks(batches: Iterator[pa.RecordBatch], text_index: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts hold about ``max_bytes``, one row at least."""
    for rows in batches:
        sizes = np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in rows.column(text_index)])
        start = 0
        while start < rows.num_rows:
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + max_bytes, side="right")))
            yield rows.slice(start, end - start)
            start = end
