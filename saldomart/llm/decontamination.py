"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Questions and answers are normalised to lower-case words, and each distinct word becomes a
pair of characters, so that no node of the automaton has very many children. The windows of
all items, strings of ten such pairs, go into one automaton, and so does a document: words
of no item become a pair of no window. A text is scanned once, but for stretches between such words
that are shorter than any window; matches overlap freely. A match is a range of words; words
keep their place in the original text, so ranges map back to offsets.

An automaton is built once in a worker, which keeps it. A benchmark too large for one is cut
into parts by a hash; each part has its automaton and its pass over the documents, and what
the passes find is put together by document.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldomart.llm.common import batch, encoded_texts, row_blocks, stored

WINDOW = 10
PART_BYTES = 2 * 1024 * 1024  # of benchmark text in one automaton
PIECE_WORDS = 4_000  # an item of more is taken in pieces that share nine words
_BLOCK_BYTES = 8 * 1024 * 1024

# Fixed values of the contract: ASCII letters in lower case and digits are word characters,
# and so is every byte of a character above ASCII; all other bytes separate words.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")


@dataclass
class Windows:
    """The automaton of some items: windows as strings of a pair of characters for each word, with their owners."""

    automaton: ahocorasick.Automaton
    pairs: dict[bytes, str]  # by word
    long_enough: re.Pattern  # stretches of known words that may hold a window


_NO_WORD = "\x00\x00"
_LOW = 512  # second characters, which are none of the first


def _pair(number: int) -> str:
    first = number // _LOW + 1 + _LOW
    return chr(first if first < 0xD800 else first + 0x800) + chr(number % _LOW + 1)


def build_automaton(items: list[tuple[int | None, bytes]]) -> Windows:
    """Windows of items: ten consecutive words each, all words if they are fewer. An item may have no id."""
    pairs: dict[bytes, str] = {}
    owners: dict[str, set[int]] = {}
    for item, text in items:
        words = text.translate(_NORMAL).split()
        for word in words:
            if word not in pairs:
                pairs[word] = _pair(len(pairs))
        spelled = "".join([pairs[word] for word in words])
        for i in range(max(0, len(words) - WINDOW) + 1 if words else 0):
            owners.setdefault(spelled[2 * i : 2 * (i + WINDOW)], set()).update(() if item is None else (item,))
    automaton = ahocorasick.Automaton()
    for window, ids in owners.items():
        automaton.add_word(window, (len(window) // 2, tuple(sorted(ids))))
    if owners:
        automaton.make_automaton()
    least = min(map(len, owners), default=1)
    return Windows(automaton, pairs, re.compile(f"[^\x00]{{{least},}}"))


def scan(text: bytes, windows: Windows) -> tuple[int, list[tuple[int, int, tuple[int, ...]]]]:
    """Words of a text, and the matches as first word, end word (exclusive) and items."""
    words = text.translate(_NORMAL).split()
    if not len(windows.automaton):
        return len(words), []
    spelled = "".join(map(windows.pairs.get, words, repeat(_NO_WORD)))
    matches = []
    for stretch in windows.long_enough.finditer(spelled):
        for last, (n, items) in windows.automaton.iter(stretch.group()):
            end = (stretch.start() + last + 1) // 2
            matches.append((end - n, end, items))
    return len(words), matches


def character_spans(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words as code point offsets of the original text."""
    words = [m.span() for m in _WORD.finditer(text.translate(_NORMAL))]
    heads = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    points = np.r_[0, heads]  # code points before each byte
    return [(int(points[words[a][0]]), int(points[words[b - 1][1]])) for a, b in ranges]


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    joined: list[list[int]] = []
    for a, b in sorted(ranges):
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b])
    return [(a, b) for a, b in joined]


_PIECE = pa.schema([("item_id", pa.int64()), ("piece", pa.binary())])


def item_pieces(benchmark: DataFrame, most: int = PIECE_WORDS) -> DataFrame:
    """Distinct items as normalised words, long ones in pieces of which each window lies in one at least."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for number, text in zip(rows.column(0).to_pylist(), encoded_texts(rows.column(1))):
                words = text.translate(_NORMAL).split()
                if not words:
                    continue
                starts = range(0, max(1, len(words) - WINDOW + 1), most)
                pieces = [b" ".join(words[i : i + most + WINDOW - 1]) for i in starts]
                yield batch(_PIECE, [number] * len(pieces), pieces)

    items = benchmark.selectExpr("CAST(item_id AS long) AS item_id", "CAST(text AS string) AS text")
    return items.mapInArrow(cut, "item_id long, piece binary").distinct()


@dataclass
class Part:
    """Items for one automaton, sent to the workers. ``key`` tells it from all others."""

    key: str
    items: Broadcast


def benchmark_parts(benchmark: DataFrame, part_bytes: int = PART_BYTES, piece_words: int = PIECE_WORDS) -> list[Part]:
    """The benchmark in parts of about ``part_bytes`` of text. The driver holds one part at a time."""
    spark = benchmark.sparkSession
    pieces = stored(item_pieces(benchmark, piece_words), "benchmark")
    size = pieces.agg(F.sum(F.octet_length("piece") + 16).alias("size")).first()["size"] or 0
    n = -(-size // part_bytes)
    parts = []
    for number in range(n):
        here = pieces.filter(F.pmod(F.xxhash64("piece"), F.lit(n)) == number) if n > 1 else pieces
        items = [(row["item_id"], bytes(row["piece"])) for row in here.collect()]
        parts.append(Part(uuid.uuid4().hex, spark.sparkContext.broadcast(items)))
    return parts


_kept: dict[str, Windows] = {}


def windows_of(part: Part) -> Windows:
    """The automaton of a part, built once in this worker and kept until another is asked for."""
    if part.key not in _kept:
        _kept.clear()
        _kept[part.key] = build_automaton(part.items.value)
    return _kept[part.key]


FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.int64())),
        ("spans", pa.list_(pa.list_(pa.int64()))),
    ]
)
_FOUND_DDL = (
    "doc_id long, n_words long, n_hit long, items array<long>, spans array<array<long>>"
)


def _found(rows: pa.RecordBatch, texts: list[bytes], hits: list[list[tuple[int, int]]], items: list[set[int]], n_words: list[int]):
    ranges = [_joined(found) for found in hits]
    return batch(
        FOUND,
        rows.column(0),
        n_words,
        [sum(b - a for a, b in found) for found in ranges],
        [sorted(ids) for ids in items],
        [character_spans(text, found) if found else [] for text, found in zip(texts, ranges)],
    )


def _scanner(part: Part):
    """One pass over documents with one automaton."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in row_blocks(batches, 1, _BLOCK_BYTES):
            windows, texts = windows_of(part), encoded_texts(rows.column(1))
            found = [scan(text, windows) for text in texts]
            hits = [[(a, b) for a, b, _ in matches] for _, matches in found]
            items = [{item for _, _, ids in matches for item in ids} for _, matches in found]
            yield _found(rows, texts, hits, items, [n for n, _ in found])

    return scanned


_HITS = pa.schema(
    [("row_no", pa.int64()), ("ranges", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.int64()))]
)
_HITS_DDL = "row_no long, ranges array<array<long>>, items array<long>"


def _hits_of_parts(numbered: DataFrame, parts: list[Part]) -> DataFrame:
    """Numbers of the rows that hold windows of any part, with the places and items of each part."""

    def finder(part: Part):
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in row_blocks(batches, 1, _BLOCK_BYTES):
                windows = windows_of(part)
                found = [scan(text, windows)[1] for text in encoded_texts(rows.column(1))]
                hit = [i for i, matches in enumerate(found) if matches]
                yield batch(
                    _HITS,
                    rows.column(0).take(pa.array(hit, pa.int64())),
                    [_joined([(a, b) for a, b, _ in found[i]]) for i in hit],
                    [sorted({item for _, _, ids in found[i] for item in ids}) for i in hit],
                )

        return find

    texts = numbered.select("row_no", "text")
    hits = texts.mapInArrow(finder(parts[0]), _HITS_DDL)
    for part in parts[1:]:
        hits = hits.unionByName(texts.mapInArrow(finder(part), _HITS_DDL))
    return hits


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of doc_id, text, and lists of places and items from several passes."""
    for rows in row_blocks(batches, 1, _BLOCK_BYTES):
        texts = encoded_texts(rows.column(1))
        hits = [[(a, b) for a, b in places or ()] for places in rows.column(2).to_pylist()]
        items = [set(ids or ()) for ids in rows.column(3).to_pylist()]
        yield _found(rows, texts, hits, items, [len(text.translate(_NORMAL).split()) for text in texts])


def contaminated(docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Words of each document that stand in a benchmark window, with the items and the places.

    Returns one row per input row: doc_id, n_words, n_hit, n_items, items (ids), spans
    (code point offsets of the hit passages in the text), items_sha256 and contaminated.
    NULL and empty texts have no words. Repeated rows are repeated, a NULL doc_id stays
    NULL; repeated items count once. Windows of an item without item_id are hits that
    belong to no item. Other columns are ignored.

    Up to ``part_bytes`` of benchmark text there is one automaton and one pass without a
    shuffle. Beyond that each part of the benchmark has its own pass, and rows that hold
    any of its windows meet by their number.
    """
    texts = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text")
    parts = benchmark_parts(benchmark, part_bytes)
    if len(parts) <= 1:
        only = parts[0] if parts else Part("", docs.sparkSession.sparkContext.broadcast([]))
        found = texts.mapInArrow(_scanner(only), _FOUND_DDL)
    else:
        numbered = stored(texts.withColumn("row_no", F.monotonically_increasing_id()), "documents")
        hits = _hits_of_parts(numbered, parts).groupBy("row_no").agg(
            F.flatten(F.collect_list("ranges")).alias("ranges"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
        found = (
            numbered.join(hits, "row_no", "left")
            .select("doc_id", "text", "ranges", "items")
            .mapInArrow(_put_together, _FOUND_DDL)
        )
    strings = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", strings).cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "items",
        "spans",
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark window, with all their columns."""
    parts = benchmark_parts(benchmark, part_bytes)
    if not parts:
        return docs
    if len(parts) > 1:
        number = "row_no"
        while number in docs.columns:
            number += "_"
        numbered = stored(docs.withColumn(number, F.monotonically_increasing_id()), "documents")
        hits = _hits_of_parts(numbered.select(F.col(number).alias("row_no"), "text"), parts)
        hit = hits.select(F.col("row_no").alias(number)).distinct()
        return numbered.join(hit, number, "left_anti").select(*docs.columns)
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            windows = windows_of(parts[0])
            stays = [not scan(text, windows)[1] for text in encoded_texts(rows.column(at))]
            yield rows.filter(pa.array(stays))

    return docs.mapInArrow(clean, docs.schema)
