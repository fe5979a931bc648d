"""Language-model scores by logistic mixing of bit predictors with hashed contexts.

A word is spelled byte by byte, each byte as eight decisions from its highest bit down,
and closed by a blank; the end of a text is a byte of its own. Five predictors look at a
decision, each in its context: the last byte, the last two and the topic, the last four and
the topic, the word so far, and the word so far and the topic. The byte in front of a word
says how the word before it ended. The topic follows from the short words before it in the
text: each votes for the topics whose words it keeps company with. A predictor counts zeros
and ones in a hashed table and answers with the log odds. A mixer adds the answers by
weights; the gate that chooses the weights looks at how often the long contexts were seen
and at the place in the word. An adaptive map then refines the probability.

Training is one pass for topics and one for counts, over all training documents, which Spark
divides, and one for the mixer. The mixer learns online, batch after batch, from all six folds of
the training documents, each word of a fold against counts without that fold's own; the tasks'
weights are averaged. Words are counted exactly in buckets by their hash. A word is scored once, where
its bucket is, and the scores go back to the blocks of documents that hold the word, so
neither texts nor occurrences are shuffled, only each block's distinct words.

The word-so-far contexts grow with the corpus. Words are dealt to buckets by their leading
bytes, more of them where many of all words share them, so a context that holds these bytes occurs
in one bucket only. It is counted there, sorted and without a table, so it shares its counts
with no other. The tables of the other contexts are broadcast and have a fixed size: shorter
beginnings of words, and the last one, two and four bytes.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldomart.llm.common import encoded_texts, stored
from saldomart.llm.hashing import CACHED_WORDS, mix64

FOLDS, HELD_OUT_FOLD = 7, 2
BLOCK_WORDS = 500_000
SHORT_WORD, SHORT_WORDS = 3, 512  # bytes of the words that vote for topics, and their buckets
TOPICS = 8  # at most
BUCKET_BYTES = 16 * 1024 * 1024  # of text for each bucket of words
MAX_BUCKETS = 1 << 14
TRAIN_BYTES = 128 * 1024 * 1024  # of text for each task that fills tables
TABLE_BITS = (18, 22, 22, 20, 22)  # cells of each predictor's broadcast table, as a power of two
LEADING, DEEPER = 4, 2  # leading bytes that deal a word, and how many more where they are common
VOCABULARY_WORDS = 500_000  # distinct words that a task holds at once
MOST_LEVELS = 64  # depths of beginnings that are counted at once
MAX_PLACES = 1 << 24  # of a list of all possible keys
_SHARD_BITS = 18
_CONTEXTS = len(TABLE_BITS)
_LOCAL = (3, 4)  # the predictors that have a table in each bucket too
_GATED = (2, 4)  # the predictors whose counts choose the gate, and the bounds of these counts
_BOUNDS = ((0.5, 3.5), (0.5, 1.5, 3.5, 15.5, 255.5))
_GATES, _REFINE_GATES, _STEPS = 54, 18, 33
_FRONTS = 4 * (TOPICS + 1)
_CHUNK = 5_000  # words that are worked on at once
_LEARN_AT_ONCE = 500
_NEIGHBOURS = 50  # words that follow each other in the alphabet and are learned from together
_RATE = 0.05

_COMPRESSOR, _DECOMPRESSOR = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pack(data: bytes) -> bytes:
    return _COMPRESSOR.compress(data)


def _unpack(data: bytes) -> bytes:
    return _DECOMPRESSOR.decompress(data)


# How a word ended, as the byte in front of the next: nothing before, sentence, clause, other.
_ENDINGS = np.full(256, 3, np.uint8)
_ENDINGS[list(b".!?")] = 1
_ENDINGS[list(b",;:")] = 2


_COMPANY = pa.schema([("bucket", pa.int32()), ("company", pa.binary())])


def word_topics(docs: DataFrame) -> np.ndarray:
    """For each bucket of short words its share in every topic, zeros where it is rare.

    Buckets are clustered by how often they occur in the same training documents, all
    counted. The number of topics is where the spectrum of their likeness falls most.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((SHORT_WORDS, SHORT_WORDS))
        for rows in batches:
            names = rows.column(0).to_pylist()
            for start in range(0, rows.num_rows, 500):
                texts = encoded_texts(rows.column(1).slice(start, 500))
                there = np.zeros((len(texts), SHORT_WORDS), np.float32)
                for i, (name, text) in enumerate(zip(names[start : start + 500], texts)):
                    if fold_of(name) != HELD_OUT_FOLD:
                        short = {w for w in text.lower().split() if len(w) <= SHORT_WORD}
                        there[i, list(map(_short_bucket, short))] = 1
                total += there.T @ there
        used = np.flatnonzero(total.any(axis=1))
        packed = [_pack(total[i].astype("<f4").tobytes()) for i in used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(packed, pa.binary())], schema=_COMPANY)

    def add(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SHORT_WORDS)
        for rows in parts:
            for company in rows.column(1).to_pylist():
                total += np.frombuffer(_unpack(company), "<f4")
        columns = [pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=_COMPANY)

    ddl = "bucket int, company binary"
    together = np.zeros((SHORT_WORDS, SHORT_WORDS))
    for row in docs.mapInArrow(meet, ddl).groupBy("bucket").applyInArrow(add, ddl).collect():
        together[row["bucket"]] = np.frombuffer(row["company"])
    return cluster(together)


def _short_bucket(word: bytes) -> int:
    return xxhash.xxh32_intdigest(word) % SHORT_WORDS


def cluster(together: np.ndarray) -> np.ndarray:
    often = together.diagonal()
    common = np.flatnonzero(often > 0.01 * often.max()) if often.max() > 0 else np.zeros(0, np.int64)
    shares = np.zeros((SHORT_WORDS, TOPICS))
    if len(common) < 2 * TOPICS:
        return shares
    scale = np.sqrt(often[common])
    alike = together[np.ix_(common, common)] / scale[:, None] / scale[None, :]
    values, vectors = np.linalg.eigh(alike)
    values, vectors = values[::-1], vectors[:, ::-1]
    n = 2 + int(np.argmax(values[1:TOPICS] / np.maximum(values[2 : TOPICS + 1], 1e-9)))
    points = vectors[:, :n] / np.maximum(np.linalg.norm(vectors[:, :n], axis=1, keepdims=True), 1e-9)
    centres = points[[int(np.argmax(often[common]))]]
    while len(centres) < n:  # each next centre lies farthest from those before
        centres = np.vstack([centres, points[int(np.argmin((points @ centres.T).max(axis=1)))]])
    for _ in range(20):
        member = np.eye(n)[(points @ centres.T).argmax(axis=1)]
        size = member.sum(axis=0)[:, None]
        centres = np.where(size > 0, member.T @ points / np.maximum(size, 1), centres)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    near = alike @ member / np.maximum(member.sum(axis=0), 1)
    shares[common, :n] = near / np.maximum(near.sum(axis=1, keepdims=True), 1e-9)
    return shares


def depth_of(word: bytes, common: set[bytes]) -> int:
    """How many leading bytes deal a word."""
    depth = LEADING
    while len(word) >= depth and word[:depth] in common:
        depth += DEEPER
    return depth


def vocabulary(texts: DataFrame) -> DataFrame:
    """All distinct words. A task sends a word once for each ``VOCABULARY_WORDS`` of its distinct words."""
    schema = pa.schema([("word", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: set[bytes] = set()
        for rows in batches:
            for start in range(0, rows.num_rows, 200):
                for text in encoded_texts(rows.column(0).slice(start, 200)):
                    words.update(text.lower().split())
                if len(words) >= VOCABULARY_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary())], schema=schema)
                    words = set()
        if words:
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary())], schema=schema)

    return texts.select("text").mapInArrow(read, "word binary").distinct()


def common_beginnings(texts: DataFrame, buckets: int) -> set[bytes]:
    """Beginnings of so many words that they would fill a good part of a bucket, among all words of all texts.

    Beginnings of several depths are counted at once, and deeper ones only of words that all
    of these do not part. At most ``4 * buckets`` of each depth are collected.
    """
    left = stored(vocabulary(texts), "lm-vocabulary")
    most = max(8, left.count() // (4 * buckets))
    common: set[bytes] = set()
    depth, levels = LEADING, 4
    while True:
        last = depth + DEEPER * (levels - 1)
        reached = F.floor((F.least(F.octet_length("word"), F.lit(last)) - depth) / DEEPER).cast("int")
        depths = F.sequence(F.lit(0), reached)
        each = left.filter(F.octet_length("word") >= depth).select("word", F.explode(depths).alias("k"))
        beginning = F.substring("word", F.lit(1), F.lit(depth) + F.lit(DEEPER) * F.col("k")).alias("beginning")
        number = each.select(beginning).groupBy("beginning").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
        found = {bytes(row["beginning"]) for row in number.select("beginning").toLocalIterator()}
        common |= found
        deepest = [beginning for beginning in found if len(beginning) == last]
        if not deepest:
            return common
        kept = texts.sparkSession.createDataFrame([(bytearray(b),) for b in deepest], "beginning binary")
        same = F.substring("word", F.lit(1), F.lit(last)) == F.col("beginning")
        left = left.join(F.broadcast(kept), same, "left_semi")
        depth, levels = last + DEEPER, min(2 * levels, MOST_LEVELS)


def _numbers() -> defaultdict[bytes, int]:
    """Numbers words in the order of their first occurrence."""
    return defaultdict(count().__next__)


def _distinct(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct of keys from 0 to ``size``, sorted, and the place of each key among them."""
    if size > min(16 * len(keys), MAX_PLACES):
        return np.unique(keys, return_inverse=True)
    place = np.zeros(size, np.int32)
    place[keys] = 1
    distinct = np.flatnonzero(place)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[keys]


class _Dealt(dict):
    """The bucket by leading bytes of one depth, -1 where deeper ones deal the word."""

    def __init__(self, depth: int, buckets: int, common: set[bytes]):
        self.depth, self.buckets, self.common = depth, buckets, common

    def __missing__(self, leading: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        deeper = len(leading) == self.depth and leading in self.common
        value = self[leading] = -1 if deeper else xxhash.xxh32_intdigest(leading) % self.buckets
        return value


class Dealer:
    """Deals words to buckets by the leading bytes that ``depth_of`` tells; remembers buckets within a bound."""

    def __init__(self, buckets: int, common: set[bytes]):
        self.buckets, self.common, self.levels = buckets, common, []

    def buckets_of(self, words: list[bytes]) -> np.ndarray:
        bucket, left, depth = np.full(len(words), -1, np.int64), np.arange(len(words)), LEADING
        while len(left):
            level = (depth - LEADING) // DEEPER
            if level == len(self.levels):
                self.levels.append(_Dealt(depth, self.buckets, self.common))
            leading = [words[i][:depth] for i in left.tolist()]
            bucket[left] = np.fromiter(map(self.levels[level].__getitem__, leading), np.int64, len(left))
            left, depth = left[bucket[left] < 0], depth + DEEPER
        return bucket


_WORDS_DDL = (
    "kind int, block long, bucket int, n int, words binary, fronts binary, trained binary, by_fold binary, "
    "doc_id long, held_out boolean, n_tokens long, n_bytes long, tokens binary, counts binary"
)
_NAMES = [part.split()[0] for part in _WORDS_DDL.split(", ")]
_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _rows(ddl: str, **columns) -> pa.RecordBatch:
    schema = _schema(ddl)
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _each(rows: pa.RecordBatch) -> Iterator[dict]:
    """The rows one by one: a batch may hold far more bytes than the rows in use."""
    names = rows.schema.names
    for i in range(rows.num_rows):
        yield {name: rows.column(k)[i].as_py() for k, name in enumerate(names)}


def fold_of(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


def topics_before(words: list[bytes], flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, shares: np.ndarray):
    """The topic in front of each word of a row of texts: the one with most votes, or TOPICS before any vote."""
    votes = np.zeros((TOPICS, len(words)), np.float32)
    short = [i for i, w in enumerate(words) if 0 < len(w) <= SHORT_WORD]
    votes[:, short] = shares[[_short_bucket(words[i]) for i in short]].T
    voting = votes.any(axis=0)[flat]
    at = np.flatnonzero(voting)  # the topic changes behind these only
    number, first = flat[at], np.searchsorted(at, starts)
    begin = np.repeat(first, np.diff(np.r_[first, len(at)]))  # the first of the same text
    best, topic = np.zeros(len(at), np.float64), np.full(len(at) + 1, TOPICS, np.int64)
    for k in np.flatnonzero(shares.any(axis=0)).tolist():
        total = np.r_[0.0, np.cumsum(votes[k][number], dtype=np.float64)]
        after = total[1:] - total[begin]
        more = after > best + 1e-6
        topic[1:][more], best[more] = k, after[more]
    before = np.cumsum(voting) - voting
    return topic[np.where(before > np.repeat(first, lengths), before, 0)]


def _block_rows(
    ids: list[int | None],
    sizes: list[int],
    parts: list[np.ndarray],
    numbers: dict[bytes, int],
    block: int,
    dealer: Dealer,
    shares: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    """The distinct words of a block by bucket, and its documents as counts of them.

    A word has an entry for each front it has: the topic and how the word before it ended.
    """
    words = list(numbers)
    last = np.array([w[-1] if w else 0 for w in words], np.uint8)
    lengths = np.array([len(p) for p in parts])
    flat = np.concatenate(parts)
    starts = np.cumsum(lengths) - lengths
    before = np.r_[0, _ENDINGS[last[flat[:-1]]]].astype(np.int64)
    before[starts] = 0
    before += 4 * topics_before(words, flat, starts, lengths, shares)
    distinct, where = _distinct(flat * _FRONTS + before, len(words) * _FRONTS)
    number, front = distinct // _FRONTS, distinct % _FRONTS
    bucket = dealer.buckets_of(words)[number]
    order = np.argsort(bucket.astype(np.uint16), kind="stable")  # there are at most MAX_BUCKETS
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    number, front, bucket, where = number[order], front[order], bucket[order], place[where]
    fold = np.repeat([fold_of(i) for i in ids], lengths)
    by_fold = np.bincount(fold * len(order) + where, minlength=FOLDS * len(order)).reshape(FOLDS, -1).astype("<u4")
    by_fold = np.delete(by_fold, HELD_OUT_FOLD, axis=0)
    trained = by_fold.sum(axis=0, dtype="<u4")
    used, firsts = np.unique(bucket, return_index=True)
    bounds = list(zip(firsts.tolist(), [*firsts[1:].tolist(), len(order)]))
    yield _rows(
        _WORDS_DDL,
        kind=[0] * len(used),
        block=[block] * len(used),
        bucket=used.tolist(),
        n=[b - a for a, b in bounds],
        words=[_pack(b" ".join([words[i] for i in number[a:b].tolist()])) for a, b in bounds],
        fronts=[_pack(front[a:b].astype(np.uint8).tobytes()) for a, b in bounds],
        trained=[_pack(trained[a:b].tobytes()) for a, b in bounds],
        by_fold=[_pack(by_fold[:, a:b].tobytes()) for a, b in bounds],
    )
    held = np.sort((np.repeat(np.arange(len(ids)), lengths) << 32) | where)  # document and entry of each token
    firsts = np.flatnonzero(np.r_[True, held[1:] != held[:-1]])
    times = np.diff(np.r_[firsts, len(held)]).astype("<u4")
    doc, token = held[firsts] >> 32, held[firsts] & 0xFFFFFFFF
    same = np.r_[False, doc[1:] == doc[:-1]]
    token = np.where(same, token - np.r_[0, token[:-1]], token).astype("<u4")  # the difference to the one before
    ends = np.cumsum(np.bincount(doc, minlength=len(ids))).tolist()
    tokens = [_pack(token[a:b].tobytes()) for a, b in zip([0, *ends], ends)]
    counts = [_pack(times[a:b].tobytes()) for a, b in zip([0, *ends], ends)]
    yield _rows(
        _WORDS_DDL,
        kind=[1] * len(ids),
        block=[block] * len(ids),
        doc_id=ids,
        held_out=[fold_of(i) == HELD_OUT_FOLD for i in ids],
        n_tokens=lengths.tolist(),
        n_bytes=sizes,
        tokens=tokens,
        counts=counts,
    )


def block_words(
    docs: DataFrame, buckets: int, shares: np.ndarray, common: set[bytes], limit: int = BLOCK_WORDS
) -> DataFrame:
    """Rows of kind 0, a block's words of one bucket, and of kind 1, a document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, ids, sizes, parts, held = _numbers(), [], [], [], 0
        number, dealer = 0, Dealer(buckets, common)
        task = TaskContext.get().partitionId()
        for rows in batches:
            names = rows.column(0).to_pylist()
            for start in range(0, rows.num_rows, 200):
                for name, text in zip(names[start : start + 200], encoded_texts(rows.column(1).slice(start, 200))):
                    words = text.lower().split()
                    words.append(b"")  # the end
                    ids.append(name)
                    sizes.append(len(text))
                    parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                    held += len(words)
                    if held >= limit:
                        yield from _block_rows(ids, sizes, parts, numbers, (task << 32) + number, dealer, shares)
                        numbers, ids, sizes, parts, held = _numbers(), [], [], [], 0
                        number += 1
        if ids:
            yield from _block_rows(ids, sizes, parts, numbers, (task << 32) + number, dealer, shares)

    return docs.mapInArrow(read, _WORDS_DDL)


@dataclass
class Bucket:
    """The words of a bucket over all blocks; a word has an entry for each front."""

    number: int
    words: list[bytes]  # entries
    fronts: np.ndarray
    depth: np.ndarray  # leading bytes that dealt the word
    trained: np.ndarray
    by_fold: np.ndarray | None  # training folds x entries, where it was read
    word_trained: np.ndarray  # by entry: the word's count, all fronts together
    n_words: int  # distinct words that were trained on
    blocks: list[tuple[int, np.ndarray]]  # block, its entries in its order


def buckets_of(batches: Iterator[pa.RecordBatch], common: set[bytes]) -> Iterator[Bucket]:
    """Rows of kind 0, sorted by bucket, as whole buckets."""
    key: int | None = None
    held: list[dict] = []
    for rows in batches:
        for row in _each(rows):
            if row["bucket"] != key:
                if held:
                    yield _bucket(key, held, common)
                key, held = row["bucket"], []
            held.append(row)
    if held:
        yield _bucket(key, held, common)


def _bucket(number: int, rows: list[dict], common: set[bytes]) -> Bucket:
    numbers, blocks = _numbers(), []
    for row in rows:
        words = _unpack(row["words"]).split(b" ")
        word = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        front = np.frombuffer(_unpack(row["fronts"]), np.uint8)
        trained = np.frombuffer(_unpack(row["trained"]), "<u4")
        folds = np.frombuffer(_unpack(row["by_fold"]), "<u4").reshape(FOLDS - 1, -1) if "by_fold" in row else None
        blocks.append((row["block"], word * _FRONTS + front, trained, folds))
    entries, where = _distinct(np.concatenate([b[1] for b in blocks]), len(numbers) * _FRONTS)
    trained = np.bincount(where, np.concatenate([b[2] for b in blocks]), len(entries)).astype(np.int64)
    by_fold = None
    if blocks[0][3] is not None:
        folds = (np.concatenate([b[3][k] for b in blocks]) for k in range(FOLDS - 1))
        by_fold = np.stack([np.bincount(where, times, len(entries)).astype(np.uint32) for times in folds])
    by_word = np.bincount(entries // _FRONTS, trained, len(numbers)).astype(np.int64)
    bounds = np.cumsum([0, *[len(b[1]) for b in blocks]])
    spelled = list(numbers)
    return Bucket(
        number,
        [spelled[i] for i in (entries // _FRONTS).tolist()],
        (entries % _FRONTS).astype(np.uint8),
        np.array([depth_of(w, common) for w in spelled], np.int64)[entries // _FRONTS],
        trained,
        by_fold,
        by_word[entries // _FRONTS],
        int((by_word > 0).sum()),
        [(b[0], where[s:e]) for b, s, e in zip(blocks, bounds[:-1], bounds[1:])],
    )


@dataclass
class Spelling:
    """Words as bytes in a row, with the context of each byte for every predictor."""

    data: np.ndarray
    starts: np.ndarray
    word: np.ndarray  # of each byte
    contexts: list[np.ndarray]
    place: np.ndarray  # 0 first byte, 1 second or third, 2 further
    deep: np.ndarray  # the word so far holds all bytes that dealt the word


def spell(words: list[bytes], fronts: np.ndarray, depth: np.ndarray | None = None) -> Spelling:
    joined = b"".join([w + b" " if w else b"\n" for w in words])
    data = np.frombuffer(joined, np.uint8)
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    starts = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(words)), lengths)
    at = np.arange(len(data)) - starts[word]
    endings, topic = fronts & 3, (fronts >> 2).astype(np.uint64)[word] + np.uint64(1)
    back = []  # the bytes 1 to 4 before; in front of the word its ending, then nothing
    for k in range(1, 5):
        shifted = np.r_[np.zeros(k, np.uint8), data[:-k]] if len(data) > k else np.zeros(len(data), np.uint8)
        back.append(np.where(at >= k, shifted, np.where(at == k - 1, endings[word], 0)).astype(np.uint64))
    one = back[0] + np.uint64(1)
    two = one * np.uint64(257) + back[1]
    four = (two * np.uint64(257) + back[2]) * np.uint64(257) + back[3]
    # The word so far: a sum over its bytes, each scrambled with its place.
    scrambled = mix64(data.astype(np.uint64) + np.uint64(1) + (at.astype(np.uint64) << np.uint64(8)))
    sums = np.r_[np.uint64(0), np.cumsum(scrambled, dtype=np.uint64)]
    whole = mix64(sums[:-1] - sums[starts][word] + at.astype(np.uint64))
    contexts = [
        mix64(one),
        mix64(two * np.uint64(16) + topic + np.uint64(1 << 40)),
        mix64(four * np.uint64(16) + topic + np.uint64(1 << 50)),
        whole,
        mix64(whole + topic),
    ]
    deep = np.zeros(len(data), bool) if depth is None else at >= depth[word]
    return Spelling(data, starts, word, contexts, np.minimum((at + 1) // 2, 2), deep)


def alike(spelling: Spelling, fronts: np.ndarray) -> tuple[Spelling, np.ndarray, np.ndarray]:
    """The bytes of a spelling without those that repeat another in the same contexts.

    Also returned: where each kept byte was, and for every byte the place of its kept one.
    Beyond its first four bytes a word's contexts do not hold how the word before ended.
    """
    early = np.arange(len(spelling.data)) - spelling.starts[spelling.word] < 4
    ending = ((fronts & 3) + 1)[spelling.word] * early
    own = spelling.data.astype(np.uint64) | spelling.deep.astype(np.uint64) << np.uint64(8) | ending.astype(np.uint64) << np.uint64(9)
    key = spelling.contexts[4] ^ own * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(key)
    key = key[order]
    new = np.r_[True, key[1:] != key[:-1]]
    kept, place = order[new], np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    contexts = [context[kept] for context in spelling.contexts]
    few = Spelling(spelling.data[kept], spelling.starts, spelling.word[kept], contexts, spelling.place[kept], spelling.deep[kept])
    return few, kept, place


def cells(spelling: Spelling, step: int, outer: np.ndarray | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """The bit decided at a step (0 to 7) of each byte, and the cell of each predictor's broadcast table.

    With ``outer`` the predictors that are counted in buckets have cells for these bytes only.
    """
    data = spelling.data.astype(np.int64)
    bit = (data >> (7 - step)) & 1
    node = ((1 << step) | (data >> (8 - step))).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    found = []
    for number, (context, bits) in enumerate(zip(spelling.contexts, TABLE_BITS)):
        here = slice(None) if outer is None or number not in _LOCAL else outer
        value = (context[here] ^ node[here]) * np.uint64(0xD6E8FEB86659FD93)
        found.append((value >> np.uint64(64 - bits)).astype(np.int64))
    return bit, found


@dataclass
class Near:
    """The counts of a bucket's own contexts, each pair of context and byte once, as ``packed_counts`` gives them."""

    begins: np.ndarray  # by entry: its first deep byte
    sizes: np.ndarray  # by entry
    pairs: list[np.ndarray]  # for each predictor of the bucket: the pair of each deep byte of all entries in a row
    packed: list[np.ndarray]  # for each predictor of the bucket: pairs x 8 steps

    @property
    def counts(self) -> np.ndarray:
        """Predictors of the bucket x 8 steps x deep bytes of all entries in a row."""
        return self.of(np.arange(len(self.sizes)))

    def of(self, part: np.ndarray, take: np.ndarray | None = None) -> np.ndarray:
        """Counts of the deep bytes of some entries, in their order; with ``take``, of some of these bytes."""
        sizes = self.sizes[part]
        before = np.cumsum(sizes) - sizes
        at = np.repeat(self.begins[part] - before, sizes) + np.arange(sizes.sum())
        at = at if take is None else at[take]
        return np.stack([packed[pair[at]] for packed, pair in zip(self.packed, self.pairs)]).transpose(0, 2, 1)


def near_counts(bucket: Bucket) -> Near:
    """Count the contexts of the deep bytes of a bucket, each for itself.

    Bytes are sorted by context and value once for each predictor, and equal ones become one
    pair. Pairs that share a context and the bits before a step then lie side by side,
    whatever the step.
    """
    contexts: list[list[np.ndarray]] = [[] for _ in _LOCAL]
    data, weight = [], []
    for part in _chunks(bucket, np.arange(len(bucket.words)), _CHUNK):
        spelling = spell([bucket.words[i] for i in part.tolist()], bucket.fronts[part], bucket.depth[part])
        deep = np.flatnonzero(spelling.deep)
        data.append(spelling.data[deep])
        weight.append(bucket.trained[part].astype(float)[spelling.word[deep]])
        for held, number in zip(contexts, _LOCAL):
            held.append(spelling.contexts[number][deep])
    lengths = np.array([len(w) + 1 for w in bucket.words], np.int64)
    sizes = np.maximum(lengths - bucket.depth, 0)
    byte, mass = np.concatenate(data), np.concatenate(weight)
    pairs, packed = [], []
    for held in contexts:
        key = (np.concatenate(held) << np.uint64(8)) | byte  # 56 bits of the context
        order = np.argsort(key)
        key = key[order]
        firsts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        pair = np.empty(len(key), np.int32)
        pair[order] = np.repeat(np.arange(len(firsts), dtype=np.int32), np.diff(np.r_[firsts, len(key)]))
        pairs.append(pair)
        packed.append(np.zeros((len(firsts), 8), np.uint16))
        if not len(key):
            continue
        key, total = key[firsts], np.add.reduceat(mass[order], firsts)
        value = (key & np.uint64(255)).astype(np.int64)
        new = np.r_[True, (key[1:] ^ key[:-1]) >= np.uint64(256)]
        for step in range(8):
            before = value >> (8 - step)
            starts = np.flatnonzero(new | np.r_[True, before[1:] != before[:-1]])
            ones = np.add.reduceat(total * ((value >> (7 - step)) & 1), starts)
            both = packed_counts(np.stack([np.add.reduceat(total, starts) - ones, ones]))
            packed[-1][:, step] = np.repeat(both, np.diff(np.r_[starts, len(key)]))
    return Near(np.cumsum(sizes) - sizes, sizes, pairs, packed)


def _chunks(bucket: Bucket, take: np.ndarray, size: int) -> Iterator[np.ndarray]:
    for start in range(0, len(take), size):
        yield take[start : start + size]


def _by_word(bucket: Bucket, take: np.ndarray) -> np.ndarray:
    """Entries in the order of their words: those that begin alike lie side by side."""
    return np.array(sorted(take.tolist(), key=bucket.words.__getitem__), np.int64)


_TABLE_DDL = "context int, shard int, cells binary, zeros binary, ones binary, n_words long, n_tokens long"


def train_tables(words: DataFrame, tasks: int, common: set[bytes]) -> DataFrame:
    """Counts of zeros and ones by predictor and cell, and the totals N and V, from every task."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros((2, 1 << bits), np.float32) for bits in TABLE_BITS]
        n_words = n_tokens = 0
        for bucket in buckets_of(batches, common):
            n_words += bucket.n_words
            n_tokens += int(bucket.trained.sum())
            for part in _chunks(bucket, _by_word(bucket, np.flatnonzero(bucket.trained)), _CHUNK):
                spelling = spell([bucket.words[i] for i in part.tolist()], bucket.fronts[part], bucket.depth[part])
                few, _, place = alike(spelling, bucket.fronts[part])
                weight = np.bincount(place, bucket.trained[part][spelling.word], len(few.data)).astype(np.float32)
                outer = np.flatnonzero(~few.deep)
                for step in range(8):
                    bit, found = cells(few, step, outer)
                    for number, (table, cell) in enumerate(zip(tables, found)):
                        here = outer if number in _LOCAL else slice(None)
                        np.add.at(table.reshape(-1), bit[here] * table.shape[1] + cell, weight[here])
        for context, table in enumerate(tables):
            bits = min(_SHARD_BITS, TABLE_BITS[context])
            for shard in range(table.shape[1] >> bits):
                part = table[:, shard << bits : (shard + 1) << bits]
                used = np.flatnonzero(part.any(axis=0))
                if len(used):
                    yield _rows(
                        _TABLE_DDL,
                        context=[context],
                        shard=[shard],
                        cells=[_pack(np.diff(used, prepend=0).astype("<u4").tobytes())],
                        zeros=[_pack(part[0, used].astype("<f4").tobytes())],
                        ones=[_pack(part[1, used].astype("<f4").tobytes())],
                    )
        yield _rows(_TABLE_DDL, context=[-1], n_words=[n_words], n_tokens=[n_tokens])

    return words.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(train, _TABLE_DDL)


def quantised(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes: up to 15 as they are, beyond that eight steps for each doubling."""
    high = 16 + np.floor(8 * np.log2(np.maximum(counts, 16) / 16))
    return np.where(counts < 16, counts, np.minimum(high, 255)).astype(np.uint8)


def packed_counts(counts: np.ndarray) -> np.ndarray:
    """Cells of zeros and ones as one number each: zeros in its low byte and ones in its high byte."""
    zeros, ones = quantised(counts).astype("<u2")
    return zeros | ones << 8


_COUNTS = np.r_[np.arange(16), 16 * 2 ** ((np.arange(16, 256) - 15.5) / 8)].astype(np.float32)
# By a cell of a merged table, zeros in its low byte and ones in its high byte.
_ZEROS, _ONES = _COUNTS[np.arange(1 << 16) & 255], _COUNTS[np.arange(1 << 16) >> 8]
_ODDS, _SEEN = np.log((_ONES + 0.4) / (_ZEROS + 0.4)).astype(np.float32), _ZEROS + _ONES


def merged_tables(trained: DataFrame) -> list[np.ndarray]:
    """The tables of all tasks added up: a cell has its zeros in the low byte and its ones in the high byte."""

    def merge(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, shard = key[0].as_py(), key[1].as_py()
        total = np.zeros((2, 1 << min(_SHARD_BITS, TABLE_BITS[context])), np.float64)
        for rows in parts:
            for at, zeros, ones in zip(*(rows.column(c).to_pylist() for c in ("cells", "zeros", "ones"))):
                cell = np.cumsum(np.frombuffer(_unpack(at), "<u4").astype(np.int64))
                total[0, cell] += np.frombuffer(_unpack(zeros), "<f4")
                total[1, cell] += np.frombuffer(_unpack(ones), "<f4")
        packed = _pack(packed_counts(total).tobytes())
        yield _rows("context int, shard int, counts binary", context=[context], shard=[shard], counts=[packed])

    tables = [np.zeros(1 << bits, np.uint16) for bits in TABLE_BITS]
    shards = trained.filter("context >= 0").groupBy("context", "shard")
    for row in shards.applyInArrow(merge, "context int, shard int, counts binary").collect():
        part = np.frombuffer(_unpack(row["counts"]), "<u2")
        tables[row["context"]][row["shard"] * len(part) : (row["shard"] + 1) * len(part)] = part
    return tables


@dataclass
class Mixer:
    weights: np.ndarray  # by gate: one for each predictor, and a constant
    refined: np.ndarray  # by gate: probabilities at steps of log odds from -8 to 8
    past: np.ndarray | None = None  # squared gradients so far, while it learns
    mass: np.ndarray | None = None  # of bits that each map entry has learned from

    @classmethod
    def fresh(cls) -> Mixer:
        steps = 1 / (1 + np.exp(-np.linspace(-8, 8, _STEPS)))
        weights = np.full((_GATES, _CONTEXTS + 1), 0.35)
        weights[:, -1] = 0
        return cls(weights, np.tile(steps, (_REFINE_GATES, 1)))

    def predict(self, answers: np.ndarray, seen: list[np.ndarray], place: np.ndarray):
        """Probability that the bit is one, and what learning needs: gates, inputs, probability before refining."""
        by_four, by_word = seen
        refine = by_word * 3 + place
        gate = refine * 3 + (by_four * 3 - 2 * place)
        odds = np.zeros(len(place))
        for weight, answer in zip(np.ascontiguousarray(self.weights.T), (*answers, None)):
            odds += weight[gate] if answer is None else weight[gate] * answer
        odds = np.minimum(np.maximum(odds, -7.99), 7.99)
        mixed = 1 / (1 + np.exp(-odds))
        step = (odds + 8) * 2
        low = step.astype(np.int64)
        share = step - low
        curve, cell = self.refined.reshape(-1), refine * _STEPS + low
        refined = curve[cell] * (1 - share) + curve[cell + 1] * share
        return np.minimum(np.maximum((mixed + refined) / 2, 1e-6), 1 - 1e-6), gate, mixed, refine, low, share

    def learn(self, answers: np.ndarray, bit: np.ndarray, weight: np.ndarray, prediction: tuple, rate: float) -> None:
        """One online step: the mean gradient of each gate, and each map entry towards the bits seen."""
        _, gate, mixed, refine, low, share = prediction
        if self.past is None:
            self.past, self.mass = np.full(self.weights.shape, 1e-4), np.full(self.refined.size, 20.0)
        error = (bit - mixed) * weight
        total = np.maximum(np.bincount(gate, weight, _GATES), 1e-9)
        sums = [np.bincount(gate, error * x, _GATES) for x in (*answers, 1.0)]
        gradient = np.stack(sums, axis=1) / total[:, None]
        self.past += gradient**2
        self.weights += rate * gradient / np.sqrt(self.past)
        flat, size = self.refined.reshape(-1), self.refined.size
        for at, part in ((low, 1 - share), (low + 1, share)):
            cell = refine * _STEPS + at
            new = np.bincount(cell, weight * part, size)
            self.mass += new
            flat += (np.bincount(cell, weight * part * bit, size) - new * flat) / self.mass


def pairs_of(
    tables: list[np.ndarray], found: list[np.ndarray], deep: np.ndarray | None = None, near: np.ndarray | None = None
) -> list[np.ndarray]:
    """Each predictor's zeros and ones as one number: from the broadcast tables, of deep bytes from the bucket."""
    pairs = [table[cell] for table, cell in zip(tables, found)]
    if deep is not None:
        for number, counts in zip(_LOCAL, near):
            outer, pairs[number] = pairs[number], np.empty(len(deep), np.uint16)
            pairs[number][~deep], pairs[number][deep] = outer, counts
    return pairs


def _levels(seen: np.ndarray, bounds: tuple[float, ...]) -> np.ndarray:
    """How many of the bounds a count exceeds."""
    return sum((seen > bound).astype(np.int64) for bound in bounds)


_SEEN_LEVELS = [_levels(_SEEN, bounds) for bounds in _BOUNDS]


@dataclass
class Others:
    """Counts as bytes without a word's own, for each different number of own ones, and their logs."""

    row: np.ndarray  # of each byte of a spelling: where the 256 counts of its word begin
    left: np.ndarray
    logs: np.ndarray

    @classmethod
    def without(cls, own: np.ndarray, word: np.ndarray) -> Others:
        """``own`` by word, and the word of each byte."""
        numbers, which = np.unique(own, return_inverse=True)
        left = np.maximum(_COUNTS.astype(float) - numbers[:, None], 0).reshape(-1)
        return cls(which[word] * 256, left, np.log(left + 0.4))


_LOGS = np.log(_COUNTS.astype(float) + 0.4)


def answers_of(
    pairs: list[np.ndarray] | np.ndarray, others: Others | None = None, bit: np.ndarray | None = None
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Log odds of each predictor, and how many bounds the counts of the gates' cells exceed.

    With ``others`` a word's own are taken from the counts: those of the bit that was seen.
    """
    if others is None:
        answers = np.stack([_ODDS[pair] for pair in pairs])
        return answers, [levels[pairs[i]] for levels, i in zip(_SEEN_LEVELS, _GATED)]
    both = np.asarray(pairs).astype(np.int64)
    same = both >> (8 * bit) & 255  # the count of the bit that was seen
    other = both >> (8 - 8 * bit) & 255
    same += others.row
    answers = (others.logs[same] - _LOGS[other]) * (2 * bit - 1)
    return answers, [_levels(others.left[same[i]] + _COUNTS[other[i]], b) for i, b in zip(_GATED, _BOUNDS)]


def _learning_order(bucket: Bucket) -> np.ndarray:
    """Entries that were trained on: neighbours together, all else shuffled."""
    take = _by_word(bucket, np.flatnonzero(bucket.trained))
    runs = np.random.default_rng(bucket.number).permutation(-(-len(take) // _NEIGHBOURS))
    order = (runs[:, None] * _NEIGHBOURS + np.arange(_NEIGHBOURS)).reshape(-1)
    return take[order[order < len(take)]]


def fold_bytes(by_fold: np.ndarray, spelling: Spelling, place: np.ndarray):
    """What a batch of entries is to learn from: bytes, as numbers among the kept ones, by their fold's own count.

    Folds in which an entry occurs equally often ask the same; so do entries that begin alike
    and occur equally often. Each such byte is returned once, with the place of its own
    count in a list of these, and how many occurrences it stands for.
    """
    fold, entry = np.nonzero(by_fold)
    numbers, own = np.unique(by_fold[fold, entry], return_inverse=True)
    times = np.bincount(entry * len(numbers) + own, minlength=by_fold.shape[1] * len(numbers))
    used = np.flatnonzero(times)
    entry, own = used // len(numbers), used % len(numbers)
    weight = times[used] * numbers[own].astype(float)
    sizes = np.diff(np.r_[spelling.starts, len(spelling.data)])[entry]
    which = np.repeat(np.arange(len(used)), sizes)
    at = np.arange(len(which)) + np.repeat(spelling.starts[entry] - (np.cumsum(sizes) - sizes), sizes)
    total = np.bincount(place[at] * len(numbers) + own[which], weight[which])
    keys = np.flatnonzero(total)
    return keys // len(numbers), keys % len(numbers), numbers, total[keys]


def learn_bucket(mixer: Mixer, bucket: Bucket, tables: list[np.ndarray]) -> int:
    """Learn from every word of a bucket in each training fold that holds it. Returns how many these are."""
    if not bucket.trained.any():
        return 0
    near = near_counts(bucket)
    for part in _chunks(bucket, _learning_order(bucket), _LEARN_AT_ONCE):
        spelling = spell([bucket.words[i] for i in part.tolist()], bucket.fronts[part], bucket.depth[part])
        few, kept, place = alike(spelling, bucket.fronts[part])
        byte, own, numbers, weight = fold_bytes(bucket.by_fold[:, part], spelling, place)
        others = Others.without(numbers, own)
        counts = near.of(part, (np.cumsum(spelling.deep) - 1)[kept[few.deep]])
        outer, places = np.flatnonzero(~few.deep), few.place[byte]
        for step in range(8):
            bit, found = cells(few, step, outer)
            pairs = np.stack(pairs_of(tables, found, few.deep, counts[:, step]))[:, byte]
            bit = bit[byte]
            answers, seen = answers_of(pairs, others, bit)
            mixer.learn(answers, bit, weight, mixer.predict(answers, seen, places), _RATE)
    return int(np.count_nonzero(bucket.by_fold))


_MIXED_DDL = "place int, value double, mass double"


def train_mixer(words: DataFrame, tables, tasks: int, common: set[bytes]) -> Mixer:
    """Learn online in every task, over all words of all training folds; average by words learned from."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, mass = Mixer.fresh(), 0.0
        for bucket in buckets_of(batches, common):
            mass += learn_bucket(mixer, bucket, tables.value)
        if mass:
            values = np.concatenate([mixer.weights.ravel(), mixer.refined.ravel()])
            yield _mixed_rows(values, mass)

    learned = words.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(learn, _MIXED_DDL)
    mean = learned.groupBy("place").agg((F.sum(F.col("value") * F.col("mass")) / F.sum("mass")).alias("value"))
    mixer = Mixer.fresh()
    rows = mean.orderBy("place").collect()  # one row for each weight and map entry
    if rows:
        values = np.array([r["value"] for r in rows])
        cut = mixer.weights.size
        mixer = Mixer(values[:cut].reshape(mixer.weights.shape), values[cut:].reshape(mixer.refined.shape))
    return mixer


def _mixed_rows(values: np.ndarray, mass: float) -> pa.RecordBatch:
    return _rows(_MIXED_DDL, place=np.arange(len(values)), value=values, mass=np.full(len(values), mass))


def word_scores(bucket: Bucket, tables: list[np.ndarray], mixer: Mixer) -> np.ndarray:
    """log10 probability of each word after its front."""
    total = np.zeros(len(bucket.words))
    near = near_counts(bucket)
    for part in _chunks(bucket, _by_word(bucket, np.arange(len(bucket.words))), _CHUNK):
        spelling = spell([bucket.words[i] for i in part.tolist()], bucket.fronts[part], bucket.depth[part])
        few, kept, place = alike(spelling, bucket.fronts[part])
        counts = near.of(part, (np.cumsum(spelling.deep) - 1)[kept[few.deep]])
        outer, chance = np.flatnonzero(~few.deep), np.ones(len(few.data))
        for step in range(8):
            bit, found = cells(few, step, outer)
            answers, seen = answers_of(pairs_of(tables, found, few.deep, counts[:, step]))
            one = mixer.predict(answers, seen, few.place)[0]
            chance *= np.where(bit == 1, one, 1 - one)
        total[part] = np.add.reduceat(np.log10(chance)[place], spelling.starts)
    return total


_SCORES_DDL = "kind int, block long, bucket int, known binary, scores binary"


def score_words(words: DataFrame, tables, mixer, common: set[bytes]) -> DataFrame:
    """For every block and bucket the training counts and scores of its words, in the block's order."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in buckets_of(batches, common):
            scores = word_scores(bucket, tables.value, mixer.value)
            yield _rows(
                _SCORES_DDL,
                kind=[0] * len(bucket.blocks),
                block=[block for block, _ in bucket.blocks],
                bucket=[bucket.number] * len(bucket.blocks),
                known=[_pack(bucket.word_trained[at].astype("<i8").tobytes()) for _, at in bucket.blocks],
                scores=[scores[at].astype("<f4").tobytes() for _, at in bucket.blocks],
            )

    return words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(score, _SCORES_DDL)


_DOCS_DDL = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
    "score double, bits_per_byte double"
)


def _score_documents(n_tokens: int, n_words: int):
    schema = _schema(_DOCS_DDL)
    floor = np.log10(n_tokens + n_words + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by block, kind and bucket: a block's words, then its documents."""
        block, known, scores, ready = None, [], [], False
        for rows in batches:
            out: list[tuple] = []
            for row in _each(rows):
                if row["block"] != block:
                    block, known, scores, ready = row["block"], [], [], False
                if row["kind"] == 0:
                    known.append(np.frombuffer(_unpack(row["known"]), "<i8"))
                    scores.append(np.frombuffer(row["scores"], "<f4").astype(float))
                    continue
                if not ready:
                    count, value, ready = np.concatenate(known), np.concatenate(scores), True
                    base = np.log10(count + 1.0) - floor
                token = np.cumsum(np.frombuffer(_unpack(row["tokens"]), "<u4").astype(np.int64))
                times = np.frombuffer(_unpack(row["counts"]), "<u4").astype(np.int64)
                total = float(times @ value[token])
                bits = -total * np.log2(10) / max(row["n_bytes"], 1)
                known_tokens = int(times[count[token] > 0].sum())
                out.append(
                    (row["doc_id"], row["held_out"], row["n_tokens"], known_tokens, n_tokens,
                     float(times @ base[token]), total, float(bits))
                )
            if out:
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*out), schema.types)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return score


def score_texts(docs: DataFrame) -> DataFrame:
    """Log10 probability of each whole text, with a unigram base.

    Training documents are those whose crc32(doc_id as text) mod 7 is not 2 (a NULL doc_id
    counts as empty text). Tokens are words without ASCII white space, A-Z in lower case,
    and one end for each text. Returns one row per input row: doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score and bits_per_byte (of the text in UTF-8). NULL
    text is empty and has only its end. Repeated rows are repeated, and counted each time.
    Other columns are ignored. Without training documents all counts are zero.
    """
    texts = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text")
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = min(MAX_BUCKETS, 1 + size // BUCKET_BYTES * 2)
    tasks = 1 + size // TRAIN_BYTES
    common = common_beginnings(texts, buckets)
    read = stored(block_words(texts, buckets, word_topics(texts), common), "lm-blocks")
    by_fold = read.filter("kind = 0").select(*_NAMES[:8])
    words = by_fold.drop("by_fold")
    spark = docs.sparkSession
    trained = stored(train_tables(words, tasks, common), "lm-tables")
    totals = trained.filter("context < 0").agg(F.sum("n_words").alias("v"), F.sum("n_tokens").alias("n")).first()
    n_words, n_tokens = totals["v"] or 0, totals["n"] or 0
    tables = spark.sparkContext.broadcast(merged_tables(trained))
    mixer = spark.sparkContext.broadcast(train_mixer(by_fold, tables, tasks, common))
    scored = score_words(words, tables, mixer, common)
    documents = read.filter("kind = 1").select(
        "kind", "block", F.lit(-1).alias("bucket"), "doc_id", "held_out", "n_tokens", "n_bytes", "tokens", "counts"
    )
    both = scored.unionByName(documents, allowMissingColumns=True)
    by_block = both.repartition("block").sortWithinPartitions("block", "kind", "bucket")
    return by_block.mapInArrow(_score_documents(n_tokens, n_words), _DOCS_DDL)
