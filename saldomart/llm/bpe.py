"""Byte-pair encoding and decoding of whole texts by a published word vocabulary.

Distinct words are encoded together. Their symbols lie in one flat array. A round finds
the rank of every adjacent pair by binary search over the sorted pair keys, takes the
lowest rank of each word, and merges that pair wherever it stands in the word. Rounds end
when no word has a pair that can be merged. A merge whose parts come from later merges
would make this differ from merging one pair at a time; ``Vocabulary`` refuses such files.

A long word would take a round for nearly every rank, each over all its symbols. Its places
are kept by the rank of their pair instead; the lowest rank is merged at all its places,
and only pairs beside a merge are looked up again.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from saldomart.llm.common import batch, sha256_hex, texts_of

MAX_VOCABULARY = 1 << 20  # entries; what is sent to the executors is bounded by it
CACHED_WORDS = 250_000  # distinct pieces that a worker remembers; beyond it starts anew
_ENCODE_AT_ONCE = 20_000
LONG_WORD = 1_000  # bytes

# Fixed values of the vocabulary's format: byte characters, word pieces, end of a word.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t\n\r\x0b\x0ca-z0-9]+")  # the same, lower case
_END = "</w>"
NO_RANK = np.iinfo(np.int64).max


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it prints, else one above 255."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(printable)]
    return [chr(b) if b in set(printable) else chr(256 + others.index(b)) for b in range(256)]


@dataclass
class Vocabulary:
    """Symbols and merges of a tokenizer file, as arrays."""

    tokens: list[bytes]  # by identifier, as the library prints them, in UTF-8
    first: np.ndarray  # identifier of each byte inside a word
    last: np.ndarray  # identifier of each byte that ends a word
    pair_keys: np.ndarray  # sorted
    pair_ranks: np.ndarray
    pair_made: np.ndarray
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids, merges = content["model"]["vocab"], content["model"]["merges"]
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        size = max([*ids.values(), *special.values()]) + 1
        if size > MAX_VOCABULARY:
            raise ValueError(f"{path} has {size} tokens, more than {MAX_VOCABULARY}")
        tokens = [b""] * size
        for token, i in [*ids.items(), *special.items()]:
            tokens[i] = token.encode()
        made_at = {a + b: rank for rank, (a, b) in enumerate(merges)}
        if len(made_at) < len(merges) or any(
            max(made_at.get(a, -1), made_at.get(b, -1)) > rank for rank, (a, b) in enumerate(merges)
        ):
            raise ValueError(f"{path} has merges whose parts are made later")
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        keys = left * size + right
        order = np.argsort(keys)
        characters = byte_characters()
        return cls(
            tokens,
            np.array([ids[c] for c in characters], np.int64),
            np.array([ids.get(c + _END, -1) for c in characters], np.int64),
            keys[order],
            order.astype(np.int64),
            made[order],
            special,
        )


def merge_rounds(symbols: np.ndarray, word: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Merge until nothing is left to merge. ``word`` numbers the word of each symbol, ascending."""
    size, keys = len(vocabulary.tokens), vocabulary.pair_keys
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols):
        at = np.flatnonzero(word[1:] == word[:-1])
        key = symbols[at] * size + symbols[at + 1]
        place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        known = keys[place] == key
        rank = np.full(len(symbols), NO_RANK)
        rank[at[known]] = vocabulary.pair_ranks[place[known]]
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        lowest = np.minimum.reduceat(rank, starts)
        lengths = np.diff(np.r_[starts, len(symbols)])
        lowest_here = np.repeat(lowest, lengths)
        finished = lowest_here == NO_RANK
        if finished.any():  # words without a pair leave the flat array
            done.append((word[finished], symbols[finished]))
            symbols, word, rank, lowest_here = (x[~finished] for x in (symbols, word, rank, lowest_here))
            if not len(symbols):
                break
        hits = np.flatnonzero(rank == lowest_here)
        # In a run such as a a a every second hit counts, from the left.
        run_starts = np.r_[True, np.diff(hits) != 1]
        run = np.cumsum(run_starts) - 1
        hits = hits[(np.arange(len(hits)) - np.flatnonzero(run_starts)[run]) % 2 == 0]
        symbols = symbols.copy()
        symbols[hits] = vocabulary.pair_made[np.searchsorted(keys, symbols[hits] * size + symbols[hits + 1])]
        stays = np.ones(len(symbols), bool)
        stays[hits + 1] = False
        symbols, word = symbols[stays], word[stays]
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words, result = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(words, kind="stable")
    return words[order], result[order]


def _first_of_runs(places: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of places that follow each other every second one, from the left: in a a a the first pair is merged."""
    new = np.r_[True, following[places[:-1]] != places[1:]]
    run = np.cumsum(new) - 1
    return places[(np.arange(len(places)) - np.flatnonzero(new)[run]) % 2 == 0]


def merge_long(symbols: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The symbols of one word after all merges, by rank and place."""
    size, keys, n = len(vocabulary.tokens), vocabulary.pair_keys, len(symbols)
    symbols = np.r_[symbols, -1]  # the end has no pair
    following, previous = np.arange(1, n + 2), np.arange(-1, n)
    following[n] = n
    rank = np.full(n + 1, NO_RANK)
    waiting: dict[int, list[np.ndarray]] = {}
    ranks: list[int] = []

    def look_up(places: np.ndarray) -> None:
        """Find the rank of the pair at each place, and let the places wait for it."""
        right = symbols[following[places]]
        key = symbols[places] * size + right
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        rank[places] = np.where((right >= 0) & (keys[at] == key), vocabulary.pair_ranks[at], NO_RANK)
        places = places[rank[places] != NO_RANK]
        order = np.argsort(rank[places], kind="stable")
        places = places[order]
        found, firsts = np.unique(rank[places], return_index=True)
        for r, part in zip(found.tolist(), np.split(places, firsts[1:])):
            if r not in waiting:
                waiting[r] = []
                heapq.heappush(ranks, r)
            waiting[r].append(part)

    if len(keys):
        look_up(np.arange(n))
    while ranks:
        lowest = heapq.heappop(ranks)
        places = np.unique(np.concatenate(waiting.pop(lowest)))
        places = places[rank[places] == lowest]  # others were merged or changed since
        if not len(places):
            continue
        places = _first_of_runs(places, following)
        right = following[places]
        symbols[places] = vocabulary.pair_made[np.searchsorted(keys, symbols[places[:1]] * size + symbols[right[:1]])]
        rank[right] = NO_RANK
        following[places] = following[right]
        previous[following[places]] = places
        symbols[right] = -2  # gone
        before = previous[places]
        look_up(np.unique(np.r_[before[before >= 0], places]))
    return symbols[:-1][symbols[:-1] >= 0]


def words_of(piece: str) -> list[bytes]:
    """The vocabulary's words in a piece of text: composed, lower case, without white space."""
    if piece.isascii():
        return [w.encode() for w in _ASCII_WORDS.findall(piece.lower())]
    composed = unicodedata.normalize("NFC", piece)
    # A capital sigma has one lower case here, wherever it stands.
    lower = "".join(c.lower() for c in composed) if "\u03a3" in composed else composed.lower()
    return [w.encode() for w in _WORDS.findall(lower)]


def encode_words(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of all words in a row, and where each word's identifiers begin and the last one's end."""
    data = np.frombuffer(b"".join(words), np.uint8)
    lengths = np.array([len(w) for w in words], np.int64)
    symbols = vocabulary.first[data]
    ends = np.cumsum(lengths) - 1
    symbols[ends] = vocabulary.last[data[ends]]
    number = np.repeat(np.arange(len(words)), lengths)
    long = np.flatnonzero(lengths > LONG_WORD)
    short = np.repeat(lengths <= LONG_WORD, lengths)
    word, ids = merge_rounds(symbols[short], number[short], vocabulary)
    if len(long):
        merged = [merge_long(symbols[ends[i] + 1 - lengths[i] : ends[i] + 1], vocabulary) for i in long.tolist()]
        word = np.concatenate([word, np.repeat(long, [len(m) for m in merged])])
        order = np.argsort(word, kind="stable")
        word, ids = word[order], np.concatenate([ids, *merged])[order]
    return ids.astype("<u4"), np.searchsorted(word, np.arange(len(words) + 1))


def decode(ids: list[int], vocabulary: Vocabulary) -> bytes:
    """The text of identifiers: the file names no decoder, so tokens are joined by blanks."""
    return b" ".join([vocabulary.tokens[i] for i in ids])


class Encoder:
    """Encodes and decodes texts, remembering distinct words and pieces within a bound.

    A piece is text between blanks or line breaks, which every word ends at.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.words: dict[bytes, tuple[bytes, bytes]] = {}
        self.pieces: dict[str, tuple[bytes, bytes]] = {}
        self.marks = vocabulary.special
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")")

    def _learn_words(self, words: list[bytes]) -> None:
        for start in range(0, len(words), _ENCODE_AT_ONCE):
            part = words[start : start + _ENCODE_AT_ONCE]
            ids, bounds = encode_words(part, self.vocabulary)
            data, numbers, at = ids.tobytes(), ids.tolist(), bounds.tolist()
            for word, a, b in zip(part, at, at[1:]):
                self.words[word] = data[4 * a : 4 * b], decode(numbers[a:b], self.vocabulary)

    def _learn(self, pieces: list[str]) -> None:
        split = [words_of(piece) for piece in pieces]
        self._learn_words(list({w for words in split for w in words}.difference(self.words)))
        for piece, words in zip(pieces, split):
            found = [self.words[w] for w in words]
            if len(found) != 1:
                found = [(b"".join([ids for ids, _ in found]), b" ".join([text for _, text in found]))]
            self.pieces[piece] = found[0]

    def encode_batch(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text its identifiers, little-endian, and their decoded text."""
        split = []
        for text in texts:
            if any(mark in text for mark in self.marks):
                parts = self.special.split(text)  # every second part is a special token
                split.append([p for i, x in enumerate(parts) for p in ([x] if i % 2 else _pieces(x))])
            else:
                split.append(_pieces(text))
        new = {p for pieces in split for p in pieces}.difference(self.pieces)
        if len(self.pieces) + len(new) > CACHED_WORDS:
            self.pieces, self.words = {}, {}
            new = {p for pieces in split for p in pieces}
        self._learn(list(new))
        for token, i in self.marks.items():
            self.pieces[token] = np.array([i], "<u4").tobytes(), self.vocabulary.tokens[i]
        found = []
        for pieces in split:
            pairs = [self.pieces[p] for p in pieces]
            found.append((b"".join([a for a, _ in pairs]), b" ".join([b for a, b in pairs if a])))
        return found


def _pieces(text: str) -> list[str]:
    return text.replace("\n", " ").split(" ")


_encoders: dict[str, Encoder] = {}


def _encoder(path: str, vocabulary: Broadcast) -> Encoder:
    """The encoder of this worker, which keeps it from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(vocabulary.value)
    return _encoders[path]


ENCODED = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)


def bpe_encode(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Encode the whole ``text`` of each row and decode the identifiers again.

    Returns doc_id, n_tokens, the digest of the identifiers as little-endian unsigned
    32-bit integers and the digest of the decoded text; ``with_ids`` adds both themselves
    (``ids`` array<long>, ``decoded`` string). One row per input row: repeated rows are
    repeated, a NULL or empty text has no tokens, a NULL doc_id stays NULL. Other columns
    are ignored. There is no shuffle; a text must fit into a task.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    schema = ENCODED
    if with_ids:
        schema = pa.schema([*ENCODED, ("ids", pa.list_(pa.int64())), ("decoded", pa.string())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, vocabulary)
        for whole in batches:
            for rows in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                found = encoder.encode_batch(texts_of(rows.column(1)))
                columns = [
                    rows.column(0),
                    [len(ids) // 4 for ids, _ in found],
                    [sha256_hex(ids) for ids, _ in found],
                    [sha256_hex(text) for _, text in found],
                ]
                if with_ids:
                    columns += [[np.frombuffer(ids, "<u4").tolist() for ids, _ in found]]
                    columns += [[text.decode() for _, text in found]]
                yield batch(schema, *columns)

    names = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    names += ", ids array<long>, decoded string" if with_ids else ""
    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(encode, names)
