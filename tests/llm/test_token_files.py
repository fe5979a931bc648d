"""Token files against the library, the code's lengths, and blocks on their own."""

import struct
import zlib
from itertools import product

import numpy as np
import pytest
from saldomart.llm import token_files
from saldomart.llm.queries import END_OF_DOCUMENT, QUERIES, WORD_TOKENIZER
from saldomart.llm.token_files import (
    Code,
    code_lengths,
    decode_block,
    encode_documents,
    read_token_files,
    tokens_through_files,
    write_token_files,
)
from tokenizers import Tokenizer

from cases import CASES, documents


def _expected(rows):
    """doc_id, start, n_tokens and ids of all rows, one text after the other."""
    library = Tokenizer.from_file(WORD_TOKENIZER)
    found, start = [], 0
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, END_OF_DOCUMENT]
        data = struct.pack(f"<{len(ids)}I", *ids)
        found.append((doc_id, start, len(ids), zlib.crc32(data), data))
        start += len(ids)
    return found


def test_query_equals_library(spark):
    folder = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    got = sorted(tuple(r) for r in QUERIES["op12_token_files"](spark, folder).collect())
    assert got == [r[:4] for r in _expected(rows)]


def test_cases_and_places_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 100)
    rows = [(i, t, lang) for i, t, lang in CASES] + [(20, "one <|endoftext|> two<|startoftext|>", "x"), (-5, "first", "y")]
    docs = documents(spark, rows).repartition(5)
    got = sorted(map(tuple, tokens_through_files(docs, WORD_TOKENIZER, END_OF_DOCUMENT, True).collect()), key=lambda r: r[1])
    expected = _expected([(i, t) for i, t, _ in rows])
    assert sorted(map(repr, ((i, n, crc, bytes(ids)) for i, _, n, crc, ids in got))) == sorted(
        map(repr, ((i, n, crc, ids) for i, _, n, crc, ids in expected))
    )
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got]]).tolist()[:-1]
    assert [r[0] for r in got] == sorted([i for i, _, _ in rows], key=lambda i: (i is not None, i))


def test_empty_table(spark):
    found = tokens_through_files(documents(spark, []), WORD_TOKENIZER, END_OF_DOCUMENT)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and found.collect() == []


def test_one_document_in_most_rows_reaches_over_parts(spark, tmp_path):
    ids = np.arange(50, dtype="<u2").tobytes()
    rows = spark.range(4000).selectExpr("IF(id % 3 = 0, id, 7) AS doc_id").rdd.map(lambda r: (r.doc_id, ids))
    frame = spark.createDataFrame(rows, "doc_id long, ids binary")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_token_files(frame, 50, str(tmp_path / "t"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    blocks = spark.read.parquet(str(tmp_path / "t/blocks"))
    assert blocks.groupBy("part").count().count() > 2
    starts = sorted((r.start, r.doc_id) for r in read_token_files(spark, str(tmp_path / "t")).collect())
    assert [s for s, _ in starts] == list(range(0, 200_000, 50)) and [d for _, d in starts] == sorted(d for _, d in starts)
    assert spark.read.parquet(str(tmp_path / "t/parts")).filter("base = 0").count() == 1


def test_documents_without_identifiers(spark, tmp_path):
    frame = spark.createDataFrame([(1, None), (2, bytearray(b"")), (3, bytearray(b"\x05\x00"))], "doc_id long, ids binary")
    write_token_files(frame, 9, str(tmp_path / "t"))
    assert sorted(map(tuple, read_token_files(spark, str(tmp_path / "t")).collect())) == [
        (1, 0, 0, 0), (2, 0, 0, 0), (3, 0, 1, zlib.crc32(b"\x05\0\0\0"))
    ]


@pytest.mark.parametrize("limit", [3, 4, 6])
def test_lengths_are_the_best_within_the_limit(limit):
    """Against all prefix codes of up to six symbols."""
    random = np.random.default_rng(limit)
    for n in range(2, 7):
        counts = np.sort(random.integers(1, 1 + int(random.integers(1, 200)), n))
        best = min(
            int(np.dot(counts, lengths))
            for lengths in product(range(1, limit + 1), repeat=n)
            if sum(2.0**-x for x in lengths) <= 1
        )
        lengths = code_lengths(counts, limit)
        assert lengths.max() <= limit and sum(2.0 ** -lengths) <= 1 and int(np.dot(counts, lengths)) == best


def test_code_is_canonical_and_free_of_prefixes():
    random = np.random.default_rng(5)
    ids = random.choice(5000, 900, replace=False)
    code = Code.of_counts(ids, (1e6 / np.arange(1, 901) ** 1.3).astype(np.int64) + 1)
    words = {i: format(code.codes[i], f"0{code.lengths[i]}b") for i in ids.tolist()}
    in_order = [words[i] for i in sorted(words, key=lambda i: (code.lengths[i], i))]
    assert in_order == sorted(in_order)
    assert not any(b.startswith(a) for a, b in zip(in_order, in_order[1:]))
    assert Code.of_lengths(ids, code.lengths[ids]).symbol_at.tolist() == code.symbol_at.tolist()
    with pytest.raises(ValueError, match="prefix"):
        Code.of_lengths(np.arange(3), np.array([1, 1, 1]))


@pytest.mark.parametrize("spread", [1, 2, 300, 49_000])
def test_blocks_are_decoded_on_their_own(spread):
    random = np.random.default_rng(spread)
    documents_ids = [(random.random(n) ** 4 * spread).astype(np.int64) for n in (0, 1, 255, 256, 257, 5000, 0, 3, 1024)]
    every = np.concatenate(documents_ids)
    sizes = np.array([len(d) for d in documents_ids])
    code = Code.of_counts(*np.unique(every, return_counts=True))
    payloads, checkpoints = encode_documents(every, sizes, code)
    for i, payload in enumerate(payloads):  # each alone
        assert decode_block(payload, checkpoints[i], sizes[i : i + 1], code).tolist() == documents_ids[i].tolist()
    starts = np.cumsum([0, *map(len, payloads)])[:-1] * 8
    together = np.concatenate([c + s for c, s in zip(checkpoints, starts)])
    assert decode_block(b"".join(payloads), together, sizes, code).tolist() == every.tolist()


@pytest.mark.parametrize("chunk", [40, 1 << 12])
def test_encoder_equals_library(monkeypatch, chunk):
    """Random strings of one and of wider alphabets, words longer than a chunk, a table that fills up."""
    monkeypatch.setattr(token_files, "_CHUNK", chunk)
    monkeypatch.setattr(token_files, "_SLOTS", 1 << 14)
    with open(WORD_TOKENIZER, encoding="utf-8") as file:
        content = file.read()
    encoder, library = token_files.TextEncoder(content, "<u2"), Tokenizer.from_str(content)
    random = np.random.default_rng(chunk)
    narrow = [chr(i) for i in range(256)]
    wide = [*narrow, *"̀́Σİ中 😀’ﬁÅẞ "]
    often = ["'s", "'LL", "don't", "...", "?!", "<|endoftext|>", "<|", "|>", "<|ENDOFTEXT|>", " ", "\n", "É", "2²", "a\xa0b", "x\x1cy", "x\x85y", "'restyled", "x" * 90]
    texts = [""]
    for n in range(3000):
        letters = [*often, *"abcSTLM' ", *(narrow if n % 3 else wide)]
        weights = np.array([3.0] * len(often) + [12.0] * 9 + [0.3] * (len(letters) - len(often) - 9))
        texts.append("".join(random.choice(letters, int(random.integers(0, 40)), p=weights / weights.sum())))
    for start in range(0, len(texts), 500):
        part = texts[start : start + 500]
        expected = [np.array(library.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in part]
        assert encoder.encode(part) == expected
