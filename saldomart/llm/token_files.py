"""Files of token identifiers, Huffman-coded in blocks that are decoded independently.

A folder of token files holds

    codebook   id, bits: the length of the code of each identifier that occurs. Codes are
               canonical: in order of (bits, id) each is the one before plus one, so the
               lengths say it all. Lengths come from counts over all documents and are
               limited, so that one table look-up decodes an identifier.
    blocks     whole documents in order: their ids and token counts, the coded identifiers
               (payload; a document begins at a byte) and checkpoints, the bit where every
               256th identifier of a document begins. ``part`` and ``first`` place the block.
    parts      part, base: how many identifiers lie before each part.

Blocks are rows of Parquet, so that Spark commits whole files only and a repeated task
leaves nothing behind. Decoding reads all checkpoints of a block at once: each is a lane,
and a step looks up the next identifier of every lane in the table.
"""

from __future__ import annotations

import hashlib
import math
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

from saldomart.llm.common import batch, row_blocks, texts_of
from saldomart.llm.hashing import mix64
from saldomart.session import new_folder, remove_folder

MAX_VOCABULARY = 1 << 20  # identifiers; bounds the codebook, which the driver makes and sends out
CHECKPOINT = 256  # identifiers between two checkpoints
BLOCK_BYTES = 1 << 20  # coded bytes after which a block ends; one document may be longer
_TEXT_BYTES = 1 << 21


# Codes


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits, for positive counts in ascending order.

    Package-merge: of ``limit`` times the symbols with their counts, joined in pairs from one
    row to the next, the cheapest 2n - 2 are taken; a symbol's length says how often it was.
    """
    n = len(counts)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need more than {limit} bits")
    if n < 2:
        return np.ones(n, np.int64)
    row, single = counts.astype(np.int64), []
    for _ in range(limit - 1):
        packages = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        row = np.r_[counts, packages]
        order = np.argsort(row, kind="stable")
        row = row[order]
        single.append(order < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_symbol in reversed(single):
        symbols = int(is_symbol[:take].sum())
        lengths[:symbols] += 1
        take = 2 * (take - symbols)
    lengths[:take] += 1
    return lengths


@dataclass
class Code:
    """A canonical code: by identifier its code and length, by the next ``width`` bits identifier and length."""

    width: int
    codes: np.ndarray
    lengths: np.ndarray
    symbol_at: np.ndarray
    length_at: np.ndarray

    @classmethod
    def of_lengths(cls, ids: np.ndarray, lengths: np.ndarray) -> Code:
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        width = int(lengths[-1]) if len(lengths) else 1
        room = np.int64(1) << (width - lengths)  # table places that begin with a code
        begin = np.r_[0, np.cumsum(room)]
        if begin[-1] > 1 << width:
            raise ValueError("these lengths are not those of a prefix code")
        size = int(ids.max()) + 1 if len(ids) else 0
        by_id, codes = np.zeros(size, np.int64), np.zeros(size, np.int64)
        by_id[ids], codes[ids] = lengths, begin[:-1] >> (width - lengths)
        symbol_at, length_at = np.zeros(1 << width, np.uint32), np.zeros(1 << width, np.int64)
        symbol_at[: begin[-1]], length_at[: begin[-1]] = np.repeat(ids, room), np.repeat(lengths, room)
        return cls(width, codes, by_id, symbol_at, length_at)

    @classmethod
    def of_counts(cls, ids: np.ndarray, counts: np.ndarray) -> Code:
        order = np.lexsort((ids, counts))
        ids, counts = ids[order], counts[order]
        limit = max(15, math.ceil(math.log2(max(len(ids), 2))) + 3)
        return cls.of_lengths(ids, code_lengths(counts, limit))


def encode_documents(ids: np.ndarray, sizes: np.ndarray, code: Code) -> tuple[list[bytes], list[np.ndarray]]:
    """Code of each document, from a byte on, and the bits where its checkpoints begin.

    ``ids`` holds the identifiers of all documents in a row, ``sizes`` how many each has.
    """
    lengths = code.lengths[ids]
    ends = np.r_[0, np.cumsum(lengths)]
    first = np.r_[0, np.cumsum(sizes)]
    n_bytes = (ends[first[1:]] - ends[first[:-1]] + 7) // 8
    byte_at = np.r_[0, np.cumsum(n_bytes)]
    bit_in_document = ends[:-1] - np.repeat(ends[first[:-1]], sizes)
    words = np.zeros(byte_at[-1] // 4 + 3, np.uint64)
    if len(ids):
        bit = bit_in_document + np.repeat(8 * byte_at[:-1], sizes)
        word = bit >> 5
        placed = code.codes[ids].astype(np.uint64) << (64 - (bit & 31) - lengths).astype(np.uint64)
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        words[word[starts]] += np.add.reduceat(placed >> np.uint64(32), starts)  # bits do not overlap
        words[word[starts] + 1] += np.add.reduceat(placed & np.uint64(0xFFFFFFFF), starts)
    data = words.astype(">u4").tobytes()
    payloads = [data[a:b] for a, b in zip(byte_at[:-1].tolist(), byte_at[1:].tolist())]
    bounds = zip(first[:-1].tolist(), first[1:].tolist())
    return payloads, [bit_in_document[a:b:CHECKPOINT] for a, b in bounds]


def decode_block(payload: bytes, checkpoints: np.ndarray, sizes: np.ndarray, code: Code) -> np.ndarray:
    """Identifiers of all documents of a block in a row. ``checkpoints`` are bits of the payload."""
    lanes = -(-sizes // CHECKPOINT)
    last = np.cumsum(lanes) - 1
    todo = np.full(int(lanes.sum()), CHECKPOINT, np.int64)
    filled = sizes > 0
    todo[last[filled]] = sizes[filled] - CHECKPOINT * (lanes[filled] - 1)
    out = np.zeros(int(sizes.sum()), np.uint32)
    order = np.argsort(-todo, kind="stable")  # lanes that end early lie at the end
    at = (np.cumsum(todo) - todo)[order]
    bit, todo = checkpoints[order].astype(np.int64), todo[order]
    data = np.frombuffer(payload + bytes(8), np.uint8)
    window = data[:-3].astype(np.uint32) << 24
    window |= data[1:-2].astype(np.uint32) << 16
    window |= data[2:-1].astype(np.uint32) << 8
    window |= data[3:]
    active = np.searchsorted(-todo, -np.arange(CHECKPOINT), side="left")
    for step in range(CHECKPOINT):
        n = int(active[step])
        if n == 0:
            break
        here = bit[:n]
        following = (window[here >> 3] >> (32 - code.width - (here & 7)).astype(np.uint32)) & ((1 << code.width) - 1)
        out[at[:n] + step] = code.symbol_at[following]
        bit[:n] += code.length_at[following]
    return out


# Encoding texts


# Kinds of the first 256 characters, in lower case, and endings that are words of their own.
_BLANK, _LETTER, _DIGIT, _OTHER = range(4)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[[*b" \t\n\x0b\x0c\r\x85\xa0"]] = _BLANK
_KINDS[[*b"abcdefghijklmnopqrstuvwxyz\xaa\xb5\xba", *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = _LETTER
_KINDS[[*b"0123456789\xb2\xb3\xb9\xbc\xbd\xbe"]] = _DIGIT
_ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_WIDER = re.compile("[^\x00-\xff]")
_MARK = "<|"  # special tokens begin so

_CHUNK = 1 << 19  # characters of texts worked on at once
_SLOTS = 1 << 21
_RANDOM = np.random.default_rng(12).integers(1 << 63, size=(2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of the vocabulary's words in lower-case text of one byte a character."""
    kind = _KINDS[data]
    begins = kind != _BLANK
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    quotes = np.flatnonzero(begins & (data == ord("'")))
    for ending in _ENDINGS:
        at = quotes[quotes + len(ending) <= len(data)]
        for i, letter in enumerate(ending.encode("latin-1")):
            at = at[data[at + i] == letter]
        begins[at + 1] = False
        behind = at[at + len(ending) < len(data)] + len(ending)
        begins[behind] = kind[behind] != _BLANK
    starts = np.flatnonzero(begins)
    filled = np.r_[0, np.cumsum(kind != _BLANK)]
    return starts, np.diff(filled[np.r_[starts, len(data)]])  # blanks stand behind a word only


class WordTable:
    """Identifiers of words that were met, found by two 64-bit hashes in a table of open addresses."""

    def __init__(self, kind: str):
        self.kind = kind
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros((2, _SLOTS), np.uint64)
        self.place = np.full(_SLOTS, -1, np.int32)  # of a word's identifiers in the pool
        self.size = np.zeros(_SLOTS, np.int32)
        self.pool, self.used, self.words = np.zeros(1 << 16, self.kind), 0, 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each word, -1 where it is unknown."""
        slot = (hashes[0] & np.uint64(_SLOTS - 1)).astype(np.int64)
        found, left = np.full(len(slot), -1, np.int64), np.arange(len(slot))
        while len(left):
            here = slot[left]
            taken = self.place[here] >= 0
            same = taken & (self.keys[0, here] == hashes[0, left]) & (self.keys[1, here] == hashes[1, left])
            found[left[same]] = here[same]
            left = left[taken & ~same]
            slot[left] = (slot[left] + 1) & (_SLOTS - 1)
        return found

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Words that are not in the table, each once, their identifiers in a row."""
        need = self.used + len(ids)
        if need > len(self.pool):
            self.pool = np.r_[self.pool[: self.used], np.zeros(2 * need - self.used, self.kind)]
        self.pool[self.used : need] = ids
        places = self.used + np.cumsum(sizes) - sizes
        slot, left = (hashes[0] & np.uint64(_SLOTS - 1)).astype(np.int64), np.arange(len(sizes))
        while len(left):
            free = left[self.place[slot[left]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            now = free[first]
            here = slot[now]
            self.keys[:, here], self.place[here], self.size[here] = hashes[:, now], places[now], sizes[now]
            left = np.setdiff1d(left, now, assume_unique=True)
            slot[left] = np.where(self.place[slot[left]] >= 0, (slot[left] + 1) & (_SLOTS - 1), slot[left])
        self.used, self.words = need, self.words + len(sizes)


class TextEncoder:
    """Identifiers of texts by the tokenizers library, remembering words within a bound.

    Each word of the vocabulary is encoded by itself, so a text's identifiers are those of its
    words in a row. Texts of the first 256 characters are taken apart on flat arrays, many at
    a time, and only words that were not met before go to the library: words of letters
    together, without the steps that leave them as they are, told apart by the identifiers
    that end a word. Other texts, and those with special tokens, go to the library whole.
    """

    def __init__(self, content: str, kind: str):
        self.library, self.plain = Tokenizer.from_str(content), Tokenizer.from_str(content)
        for library in (self.library, self.plain):
            library.no_truncation()
            library.no_padding()
        self.plain.normalizer = None
        self.plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix, ids = self.library.model.end_of_word_suffix, self.library.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(ids.values()) + 1, bool)
        self.ends_word[[i for token, i in ids.items() if suffix and token.endswith(suffix)]] = True
        self.kind, self.table = kind, WordTable(kind)
        powers = np.ones((2, 2, _CHUNK + 1), np.uint64)  # of the bases, and of their inverses
        for i, base in enumerate(_BASES):
            for j, step in enumerate((base, pow(base, -1, 1 << 64))):
                powers[i, j, 1:] = step
        self.powers = np.multiply.accumulate(powers, axis=2)

    def _learn(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> None:
        order = np.lexsort((hashes[1], hashes[0]))
        new = order[np.r_[True, (hashes[:, order[1:]] != hashes[:, order[:-1]]).any(axis=0)]]
        letters = _KINDS[data[starts[new]]] == _LETTER
        texts, bounds = data.tobytes(), zip(starts[new].tolist(), (starts[new] + sizes[new]).tolist())
        words = [texts[a:b].decode("latin-1") for a, b in bounds]
        plain, other = np.flatnonzero(letters), np.flatnonzero(~letters)
        if len(plain):
            (found,) = self.plain.encode_batch_fast([" ".join([words[i] for i in plain])], add_special_tokens=False)
            ids = np.array(found.ids, self.kind)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(plain):
                raise ValueError("the vocabulary does not mark the ends of words")
            self.table.add(hashes[:, new[plain]], ids, np.diff(np.r_[0, ends]))
        if len(other):
            each = self.library.encode_batch_fast([words[i] for i in other], add_special_tokens=False)
            parts = [np.array(e.ids, self.kind) for e in each]
            self.table.add(hashes[:, new[other]], np.concatenate(parts), np.array([len(p) for p in parts]))

    def _known_words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place of every word, how many identifiers it has, and all of these in a row."""
        starts, sizes = word_bounds(data)
        if not len(starts):
            return starts, starts, np.zeros(0, self.kind)
        hashes = np.empty((2, len(starts)), np.uint64)
        for i in range(2):
            weighed = _RANDOM[i][data] * self.powers[i, 0, : len(data)]
            weighed[_KINDS[data] == _BLANK] = 0
            hashes[i] = mix64(np.add.reduceat(weighed, starts) * self.powers[i, 1, starts])
        if self.table.words > _SLOTS // 2 - len(starts):
            self.table.clear()
        slots = self.table.find(hashes)
        unknown = np.flatnonzero(slots < 0)
        if len(unknown):
            self._learn(data, starts[unknown], sizes[unknown], hashes[:, unknown])
            slots[unknown] = self.table.find(hashes[:, unknown])
        n_ids = self.table.size[slots].astype(np.int64)
        before = np.cumsum(n_ids) - n_ids
        return starts, n_ids, self.table.pool[np.repeat(self.table.place[slots] - before, n_ids) + np.arange(n_ids.sum())]

    def encode(self, texts: list[str]) -> list[bytes]:
        found: list[bytes] = [b""] * len(texts)
        chunk: list[tuple[int, bytes]] = []
        held = 0
        for i, text in enumerate(texts):
            parts = None if _MARK in text or _WIDER.search(text) else _parts(text.lower().encode("latin-1"))
            if parts is None:
                found[i] = np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
            for part in parts or ():
                if held + len(part) >= _CHUNK:
                    self._finish(chunk, found)
                    chunk, held = [], 0
                chunk.append((i, part))
                held += len(part) + 1
        self._finish(chunk, found)
        return found

    def _finish(self, chunk: list[tuple[int, bytes]], found: list[bytes]) -> None:
        """Add the identifiers of parts of texts to those of their texts."""
        data = np.frombuffer(b"\n".join([part for _, part in chunk]), np.uint8)
        starts, n_ids, ids = self._known_words(data)
        ends = np.cumsum([len(part) + 1 for _, part in chunk])
        at = np.r_[0, np.cumsum(n_ids)][np.searchsorted(starts, ends)] * ids.itemsize
        content, last = ids.tobytes(), 0
        for (i, _), end in zip(chunk, at.tolist()):
            found[i] += content[last:end]
            last = end


def _parts(data: bytes) -> list[bytes] | None:
    """A text in parts shorter than a chunk, cut at blanks; None where a word is longer than that."""
    parts, at = [], 0
    while len(data) - at >= _CHUNK:
        cut = max(data.rfind(b" ", at, at + _CHUNK), data.rfind(b"\n", at, at + _CHUNK))
        if cut < at:
            return None
        parts.append(data[at:cut])
        at = cut + 1
    return [*parts, data[at:]]


_encoders: dict[str, TextEncoder] = {}


def _encoder(content: str, kind: str) -> TextEncoder:
    """The encoder of this worker, which keeps it from task to task."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _encoders[key] = TextEncoder(content, kind)
    return _encoders[key]


def id_type(size: int) -> str:
    """How identifiers below ``size`` are kept before they are coded."""
    if not 0 < size <= MAX_VOCABULARY:
        raise ValueError(f"identifiers must lie below {MAX_VOCABULARY}")
    return "<u2" if size <= 1 << 16 else "<u4"


_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])


def encode_texts(docs: DataFrame, path: str, end: int) -> tuple[DataFrame, int]:
    """doc_id and ids (binary, as ``id_type`` says) of each whole text, ended by ``end``; and the vocabulary's size."""
    with open(path, encoding="utf-8") as file:
        content = file.read()
    size = max(end, *Tokenizer.from_str(content).get_vocab(with_added_tokens=True).values()) + 1
    kind = id_type(size)
    shared = docs.sparkSession.sparkContext.broadcast(content)
    ending = np.array([end], kind).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, kind)
        for rows in row_blocks(batches, 1, _TEXT_BYTES):
            yield batch(_IDS, rows.column(0), [ids + ending for ids in encoder.encode(texts_of(rows.column(1)))])

    texts = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "CAST(text AS string) AS text")
    return texts.mapInArrow(encode, "doc_id long, ids binary"), size


# Writing


def _counted(ids: DataFrame, size: int) -> DataFrame:
    """How often each identifier occurs, over all documents. A task sends each identifier once."""
    kind, schema = id_type(size), pa.schema([("id", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for rows in row_blocks(batches, 0, _TEXT_BYTES):
            every = b"".join(rows.column(0).to_pylist())
            total += np.bincount(np.frombuffer(every, kind), minlength=size)
        found = np.flatnonzero(total)
        yield batch(schema, found, total[found])

    return ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


_CODED = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("checkpoints", pa.list_(pa.int64())), ("payload", pa.binary())]
)
_BLOCKS = pa.schema(
    [
        ("part", pa.int64()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("checkpoints", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)
_BLOCKS_DDL = (
    "part long, first long, n_ids long, doc_ids array<long>, n_tokens array<long>, "
    "checkpoints array<long>, payload binary"
)
_PARTS_DDL = "part long, base long"


def _coded(ids: DataFrame, size: int, code: Code) -> DataFrame:
    kind, shared = id_type(size), ids.sparkSession.sparkContext.broadcast(code)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in row_blocks(batches, 1, _TEXT_BYTES):
            parts = [np.frombuffer(one.as_buffer(), kind) for one in rows.column(1)]
            sizes = np.array([len(p) for p in parts], np.int64)
            payloads, checkpoints = encode_documents(np.concatenate(parts).astype(np.int64), sizes, shared.value)
            yield batch(_CODED, rows.column(0), sizes, checkpoints, payloads)

    ddl = "doc_id long, n_tokens long, checkpoints array<long>, payload binary"
    return ids.select("doc_id", "ids").mapInArrow(encode, ddl)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the documents of a partition, in their order."""
    before, open_rows, open_bytes = 0, [], 0

    def block() -> pa.RecordBatch:
        starts = np.cumsum([0, *[len(r[4]) for r in open_rows]]) * 8
        checkpoints = np.concatenate([np.array(r[3], np.int64) + at for r, at in zip(open_rows, starts)])
        n_ids = sum(r[2] for r in open_rows)
        values = (
            [open_rows[0][0]],
            [before],
            [n_ids],
            [[r[1] for r in open_rows]],
            [[r[2] for r in open_rows]],
            [checkpoints],
            [b"".join([r[4] for r in open_rows])],
        )
        return batch(_BLOCKS, *values)

    for rows in row_blocks(batches, 4, BLOCK_BYTES):
        for row in zip(*[column.to_pylist() for column in rows.columns]):
            open_rows.append(row)
            open_bytes += len(row[4])
            if open_bytes >= BLOCK_BYTES:
                yield (full := block())
                before += full.column(2)[0].as_py()
                open_rows, open_bytes = [], 0
    if open_rows:
        yield block()


def write_token_files(ids: DataFrame, size: int, folder: str) -> None:
    """Write documents (doc_id, ids as ``id_type(size)`` says) as token files, in ascending doc_id order.

    Documents without doc_id come first; rows of one doc_id lie in the order of a hash of their
    identifiers. A NULL in ids counts as no identifiers. The identifiers are coded before they
    are shuffled; ranges of documents become parts, and one doc_id may reach over several.
    """
    spark = ids.sparkSession
    ids = ids.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    counted = _counted(ids, size).collect()  # one row for an identifier of the vocabulary
    code = Code.of_counts(*[np.array([r[c] for r in counted], np.int64) for c in ("id", "n")])
    book = [(r["id"], int(code.lengths[r["id"]])) for r in counted]
    spark.createDataFrame(book, "id long, bits int").coalesce(1).write.parquet(f"{folder}/codebook")
    staging = new_folder(spark, "coded")
    _coded(ids, size, code).write.option("compression", "none").parquet(staging)
    coded = spark.read.parquet(staging).withColumn("hash", F.xxhash64("payload"))
    place = F.monotonically_increasing_id()  # lets the rows of one document, repeated often, part
    columns = [F.spark_partition_id().cast("long").alias("part"), *_CODED.names]
    dealt = coded.repartitionByRange("doc_id", "hash", place).sortWithinPartitions("doc_id", "hash")
    dealt.select(*columns).mapInArrow(_packed, _BLOCKS_DDL).write.option("compression", "none").parquet(f"{folder}/blocks")
    remove_folder(spark, staging)
    found = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    parts, base = [], 0
    for row in found.orderBy("part").collect():  # a number for each part
        parts.append((row["part"], base))
        base += row["n_ids"]
    spark.createDataFrame(parts, _PARTS_DDL).coalesce(1).write.parquet(f"{folder}/parts")


# Reading


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """The documents of token files: doc_id, start (identifiers before it in all files), n_tokens,
    the CRC-32 of the identifiers as little-endian unsigned 32-bit integers, and ``with_ids``
    these themselves (``ids`` binary). Each block is decoded on its own.
    """
    book = spark.read.parquet(f"{folder}/codebook").collect()  # bounded by the vocabulary
    if len(book) > MAX_VOCABULARY:
        raise ValueError(f"{folder} has {len(book)} codes, more than {MAX_VOCABULARY}")
    code = Code.of_lengths(*[np.array([r[c] for r in book], np.int64) for c in ("id", "bits")])
    shared = spark.sparkContext.broadcast(code)
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.binary())] if with_ids else []))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                first, doc_ids, sizes, checkpoints, payload = (c[i] for c in rows.columns)
                sizes = np.array(sizes.values, np.int64)
                ids = decode_block(payload.as_py(), np.array(checkpoints.values, np.int64), sizes, shared.value)
                data, ends = ids.astype("<u4").tobytes(), np.cumsum(sizes)
                parts = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), sizes.tolist())]
                columns = [doc_ids.values, first.as_py() + ends - sizes, sizes, [zlib.crc32(p) for p in parts]]
                yield batch(schema, *columns, *([parts] if with_ids else []))

    blocks = spark.read.schema(_BLOCKS_DDL).parquet(f"{folder}/blocks")
    parts = spark.read.schema(_PARTS_DDL).parquet(f"{folder}/parts")
    placed = blocks.join(parts, "part").select(
        (F.col("base") + F.col("first")).alias("first"), "doc_ids", "n_tokens", "checkpoints", "payload"
    )
    names = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return placed.mapInArrow(decode, names)


def tokens_through_files(docs: DataFrame, path: str, end: int, with_ids: bool = False) -> DataFrame:
    """Encode each whole ``text``, append ``end``, write token files to the shared folder and read them.

    Returns a row per input row, see ``read_token_files``. A NULL or empty text is ``end``
    alone; NULL doc_ids come first; repeated rows are repeated and start one after the other.
    An empty table gives files without blocks and an empty result. Other columns are ignored.
    A text must fit into a task.
    """
    spark = docs.sparkSession
    staging, folder = new_folder(spark, "ids"), new_folder(spark, "tokens")
    encoded, size = encode_texts(docs, path, end)
    encoded.write.option("compression", "zstd").parquet(staging)
    write_token_files(spark.read.parquet(staging), size, folder)
    remove_folder(spark, staging)
    return read_token_files(spark, folder, with_ids)
