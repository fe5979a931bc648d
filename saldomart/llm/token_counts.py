"""Counts of byte-pair tokens, without identifiers.

The symbols of a word form a linked list. A heap gives the adjacent pair of lowest rank,
the leftmost first; merging it takes one symbol away and offers the two new pairs. The
count is the number of initial symbols minus the number of merges.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from saldomart.llm.common import batch, texts_of

CACHED_WORDS = 400_000
MAX_MERGES = 1 << 20

# Fixed values of the vocabulary's format.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Where white space stands alone, a text can be taken apart at blanks, which belong to the
# word after them, and at line breaks, which are words of their own.
_WIDE_GAP = re.compile(r"\s\s")


class Merges:
    """The merges of a tokenizer file, by pairs of symbols. Bytes have the numbers 0 to 255."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        merges = content["model"]["merges"]
        if len(merges) > MAX_MERGES:
            raise ValueError(f"{path} has {len(merges)} merges, more than {MAX_MERGES}")
        printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        others = sorted(set(range(256)) - set(printable))
        number = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            made = number.setdefault(a + b, 256 + rank)
            self.ranks[number[a], number[b]] = rank, made
        self.special = [t["content"] for t in content["added_tokens"]]


def count_symbols(data: bytes, ranks: dict[tuple[int, int], tuple[int, int]]) -> int:
    """Tokens of one word."""
    n = len(data)
    if n < 2:
        return n
    symbol = list(data)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [
        (found[0], i, found[1], symbol[i], symbol[i + 1])
        for i in range(n - 1)
        if (found := ranks.get((symbol[i], symbol[i + 1])))
    ]
    heapify(heap)
    count = n
    while heap:
        _, i, made, left, right = heappop(heap)
        j = after[i]
        if symbol[i] != left or j >= n or symbol[j] != right:
            continue  # an earlier merge took one of the two
        symbol[i], symbol[j] = made, -1
        k = after[i] = after[j]
        count -= 1
        if k < n:
            before[k] = i
            if found := ranks.get((made, symbol[k])):
                heappush(heap, (found[0], i, found[1], made, symbol[k]))
        h = before[i]
        if h >= 0 and (found := ranks.get((symbol[h], made))):
            heappush(heap, (found[0], h, found[1], symbol[h], made))
    return count


class _Counts(dict):
    """Tokens by piece of text, worked out when first asked for."""

    def __init__(self, merges: Merges, before: str):
        self.ranks, self.before, self.words = merges.ranks, before, {}

    def __missing__(self, piece: str) -> int:
        count = 0
        for word in _WORDS.findall(self.before + piece):
            if (n := self.words.get(word)) is None:
                n = count_symbols(word.encode(), self.ranks)
                if len(self.words) < CACHED_WORDS and len(word) < 64:
                    self.words[word] = n
            count += n
        if len(self) >= CACHED_WORDS:
            self.clear()
        if len(piece) < 256:
            self[piece] = count
        return count


class Counter:
    def __init__(self, merges: Merges):
        self.special = merges.special
        self.first, self.rest = _Counts(merges, ""), _Counts(merges, " ")

    def count(self, text: str) -> int:
        for token in self.special:
            if token in text:
                parts = text.split(token)
                return len(parts) - 1 + sum(map(self.count, parts))
        if not text:
            return 0
        if _WIDE_GAP.search(text):
            return self.first[text]
        lines = text.split("\n")
        count = len(lines) - 1
        for line in lines:
            first, *rest = line.split(" ")
            count += self.first[first] + sum(map(self.rest.__getitem__, rest))
        return count


_counters: dict[str, Counter] = {}


def _counter(path: str, merges: Broadcast) -> Counter:
    """The counter of this worker, which keeps it from task to task."""
    if path not in _counters:
        _counters[path] = Counter(merges.value)
    return _counters[path]


COUNTED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def count_tokens(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """Tokens of the whole ``text`` of each row, and whether they are more than ``limit``.

    Returns doc_id, n_bytes, n_tokens and over_limit, one row per input row: repeated rows
    are repeated, a NULL or empty text has no tokens, a NULL doc_id stays NULL. Special
    strings of the file count as one token each. Other columns are ignored. No shuffle.
    """
    merges = docs.sparkSession.sparkContext.broadcast(Merges(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, merges)
        for rows in batches:
            texts = texts_of(rows.column(1))
            yield batch(
                COUNTED,
                rows.column(0),
                [len(t) if t.isascii() else len(t.encode()) for t in texts],
                [counter.count(t) for t in texts],
            )

    counted = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.selectExpr("*", f"n_tokens > {int(limit)} AS over_limit")
