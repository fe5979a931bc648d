"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document is a sparse vector: its words by hash, weighted by their counts and scaled to
length one, and a few shares and sizes. The score adds a weight per feature and, for each
pair of features, the product of their values and of two short vectors. The pairs cost
linear time: half of the square of the sum less the sum of squares, per component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldomart.llm.common import batch, encoded_texts, row_blocks

BUCKETS = 1 << 16
RANK = 8
SAMPLE_ROWS = 10_000  # labelled rows the model is fitted on, those with the lowest hashes
THRESHOLD = 0.3
HELD_OUT_FOLDS = 5
CACHED_WORDS = 400_000
_BLOCK_BYTES = 4 * 1024 * 1024
_EPOCHS, _BATCH, _RATE, _PENALTY = 12, 256, 0.1, 1e-5

STRUCTURE = (
    "symbols",
    "exclamations",
    "capitals",
    "digits",
    "word_length",
    "distinct_words",
    "commonest_word",
    "repeated_neighbours",
    "repeated_lines",
    "size",
    "is_empty",
    "n_chars",
    "n_chars_missing",
)
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>"


class Buckets(dict):
    """The bucket of each word, worked out when first asked for, within a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh32_intdigest(word) % BUCKETS
        return value


@dataclass
class Features:
    """Documents as rows of a sparse matrix: ``starts`` has one more entry than there are rows."""

    starts: np.ndarray
    index: np.ndarray
    value: np.ndarray


def features_of(texts: list[bytes], n_chars: list[int | None], buckets: Buckets) -> Features:
    n = len(texts)
    words = [t.lower().split() for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((buckets[w] for ws in words for w in ws), np.int64, int(lengths.sum()))
    document = np.repeat(np.arange(n), lengths)
    cell, count = np.unique(document * BUCKETS + flat, return_counts=True)
    row, column = cell // BUCKETS, cell % BUCKETS
    norm = np.sqrt(np.bincount(row, count.astype(float) ** 2, n))
    commonest = np.zeros(n)
    np.maximum.at(commonest, row, count)
    distinct = np.bincount(row, minlength=n)
    twin = (flat[1:] == flat[:-1]) & (document[1:] == document[:-1])
    twins = np.bincount(document[1:][twin], minlength=n)
    size = np.array([len(t) for t in texts], float)
    some, some_words = np.maximum(size, 1), np.maximum(lengths, 1)

    def share(characters: bytes) -> np.ndarray:
        return np.array([len(t) - len(t.translate(None, characters)) for t in texts]) / some

    def repeated_lines(text: bytes) -> float:
        lines = [line for line in text.split(b"\n") if line.strip()]
        return 1 - len(set(lines)) / len(lines) if lines else 0.0

    known = np.array([c is not None for c in n_chars])
    chars = np.array([max(c or 0, 0) for c in n_chars], float)
    dense = np.stack(
        [
            4 * share(_SYMBOLS),
            4 * share(b"!"),
            share(_UPPER),
            share(_DIGITS),
            np.minimum(size / some_words / 20, 2),
            distinct / some_words,
            commonest / some_words,
            twins / some_words,
            np.array([repeated_lines(t) for t in texts]) if n else np.zeros(0),
            np.log1p(lengths) / 10,
            (lengths == 0).astype(float),
            np.log1p(chars) / 12,
            (~known).astype(float),
        ],
        axis=1,
    )
    k = len(STRUCTURE)
    rows = np.r_[row, np.repeat(np.arange(n), k)]
    index = np.r_[column, np.tile(BUCKETS + np.arange(k), n)]
    value = np.r_[count / norm[row], dense.ravel()]
    order = np.argsort(rows, kind="stable")
    starts = np.r_[0, np.cumsum(distinct + k)]
    return Features(starts, index[order].astype(np.int32), value[order].astype(np.float32))


@dataclass
class Machine:
    bias: float
    weight: np.ndarray  # by feature
    factor: np.ndarray  # by feature, RANK wide

    def raw(self, f: Features) -> np.ndarray:
        if len(f.starts) < 2:
            return np.zeros(0)
        at = f.starts[:-1]
        linear = np.add.reduceat(self.weight[f.index] * f.value, at)
        scaled = self.factor[f.index] * f.value[:, None]
        total = np.add.reduceat(scaled, at, axis=0)
        squares = np.add.reduceat((scaled**2).sum(axis=1), at)
        return self.bias + linear + ((total**2).sum(axis=1) - squares) / 2

    def score(self, f: Features) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(f), -30, 30)))


def fit(f: Features, label: np.ndarray) -> Machine:
    """Logistic loss, steps scaled by past gradients, rows in a fixed shuffled order."""
    size = BUCKETS + len(STRUCTURE)
    random = np.random.default_rng(7)
    machine = Machine(0.0, np.zeros(size), random.normal(0, 0.05, (size, RANK)))
    if not len(label):
        return machine
    seen = 1e-6
    seen_weight, seen_factor = np.full(size, 1e-6), np.full((size, RANK), 1e-6)
    for _ in range(_EPOCHS):
        order = random.permutation(len(label))
        for part in np.array_split(order, max(1, len(label) // _BATCH)):
            lengths = f.starts[part + 1] - f.starts[part]
            starts = np.r_[0, np.cumsum(lengths)]
            take = np.repeat(f.starts[part] - starts[:-1], lengths) + np.arange(starts[-1])
            sub = Features(starts, f.index[take], f.value[take])
            error = (machine.score(sub) - label[part]) / len(part)
            scaled = machine.factor[sub.index] * sub.value[:, None]
            total = np.add.reduceat(scaled, starts[:-1], axis=0)
            row_error = np.repeat(error, lengths)
            gradient = (row_error * sub.value)[:, None] * (np.repeat(total, lengths, axis=0) - scaled)
            by = np.argsort(sub.index, kind="stable")
            used, first = np.unique(sub.index[by], return_index=True)
            step = np.add.reduceat((row_error * sub.value)[by], first) + _PENALTY * machine.weight[used]
            factor_step = np.add.reduceat(gradient[by], first, axis=0) + _PENALTY * machine.factor[used]
            seen += error.sum() ** 2
            seen_weight[used] += step**2
            seen_factor[used] += factor_step**2
            machine.bias -= _RATE * error.sum() / np.sqrt(seen)
            machine.weight[used] -= _RATE * step / np.sqrt(seen_weight[used])
            machine.factor[used] -= _RATE * factor_step / np.sqrt(seen_factor[used])
    return Machine(machine.bias, machine.weight.astype(np.float32), machine.factor.astype(np.float32))


def held_out(doc_id: Column) -> Column:
    """Whether the labels of a document are kept from the model."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT_FOLDS == 0


def _columns(docs: DataFrame) -> DataFrame:
    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", chars.alias("n_chars"))


_ROWS = pa.schema(
    [("quality", pa.int64()), ("doc_id", pa.int64()), ("index", pa.binary()), ("value", pa.binary())]
)


def _sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    buckets = Buckets()
    for rows in row_blocks(batches, 1, _BLOCK_BYTES):
        f = features_of(encoded_texts(rows.column(1)), rows.column(2).to_pylist(), buckets)
        bounds = list(zip(f.starts[:-1].tolist(), f.starts[1:].tolist()))
        yield batch(
            _ROWS,
            rows.column(3).cast(pa.int64()),
            rows.column(0),
            [f.index[a:b].tobytes() for a, b in bounds],
            [f.value[a:b].astype(np.float16).tobytes() for a, b in bounds],
        )


def fit_on(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Machine:
    """Fit on at most ``sample`` labelled documents that are not held out."""
    labelled = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("long").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    chosen = _columns(docs).join(F.broadcast(labelled), "doc_id")  # at most ``sample`` rows
    sparse = chosen.mapInArrow(_sparse_rows, "quality long, doc_id long, index binary, value binary")
    once = sparse.groupBy("doc_id").agg(F.max(F.struct("index", "value")).alias("row"), F.min("quality").alias("quality"))
    rows = once.orderBy("doc_id").collect()  # a row for each label
    index = [np.frombuffer(r["row"]["index"], np.int32) for r in rows]
    value = [np.frombuffer(r["row"]["value"], np.float16).astype(np.float32) for r in rows]
    starts = np.r_[0, np.cumsum([len(i) for i in index], dtype=np.int64)]
    empty = np.zeros(0, np.int32)
    f = Features(starts, np.concatenate([empty, *index]), np.concatenate([empty.astype(np.float32), *value]))
    return fit(f, np.array([float(r["quality"] == 1) for r in rows]))


SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """How likely each document is of quality 1, from its text and n_chars alone.

    Returns one row per input row: doc_id, held_out, score and predicted (1 from a score of
    0.3 on). Labels count only from rows that are not held out, one per doc_id, the lowest;
    rows with NULL in either column do not count. Without labels every score is near 0.5.
    NULL text is empty, an empty text is scored by its structure; a NULL n_chars, or a table
    without it, is a feature of its own. Repeated rows are repeated, a NULL doc_id stays
    NULL. Other columns are ignored. The model has a fixed size and is broadcast; no shuffle.
    """
    machine = docs.sparkSession.sparkContext.broadcast(fit_on(docs, labels, sample))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for rows in row_blocks(batches, 1, _BLOCK_BYTES):
            f = features_of(encoded_texts(rows.column(1)), rows.column(2).to_pylist(), buckets)
            yield batch(SCORED, rows.column(0), machine.value.score(f).astype(float))

    scored = _columns(docs).mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
