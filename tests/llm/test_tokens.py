"""Byte-pair encoding, decoding and counts against the library that made the files."""

import hashlib
import random
import struct
import time

import pytest
from cases import CASES, documents
from saldomart.llm import bpe
from saldomart.llm.bpe import Encoder, Vocabulary, bpe_encode, encode_words
from saldomart.llm.queries import BYTE_TOKENIZER, TOKEN_LIMIT, WORD_TOKENIZER
from saldomart.llm.token_counts import Counter, Merges, count_symbols, count_tokens
from tokenizers import Tokenizer

PARTS = [
    *"abcdefgthe THE  \n\t\r\x0b\x0c.,!''s12é́Σςİßä\x1c\x85​　😀中ñ%$#\xa0 ",
    "<|endoftext|>", "<|startoftext|>", "'re", "'ll", " the ", " ing", "aaaa",
]


def _texts(n=4000):
    draw = random.Random(3)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_TOKENIZER), Tokenizer.from_file(BYTE_TOKENIZER)


def test_ids_and_decoded_text_equal_the_library(library):
    texts = _texts()
    encoder = Encoder(Vocabulary.load(WORD_TOKENIZER))
    for text, (ids, decoded), expected in zip(
        texts, encoder.encode_batch(texts), library[0].encode_batch(texts, add_special_tokens=False)
    ):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == expected.ids, text
        assert decoded.decode() == library[0].decode(expected.ids, skip_special_tokens=False)


def test_words_in_a_batch_do_not_touch_each_other():
    vocabulary = Vocabulary.load(WORD_TOKENIZER)
    words = [b"aaaa", b"the", b"aaaaa", b"x"]
    ids, bounds = encode_words(words, vocabulary)
    together = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert together == [encode_words([w], vocabulary)[0].tolist() for w in words]


@pytest.mark.parametrize("longest", [0, 2, 5])
def test_words_merged_by_rank_equal_the_library(library, monkeypatch, longest):
    monkeypatch.setattr(bpe, "LONG_WORD", longest)
    texts = [*_texts(1500), "a" * 500, "ab" * 300, "aab" * 200 + "!" * 90, "the" * 150]
    encoder = Encoder(Vocabulary.load(WORD_TOKENIZER))
    expected = library[0].encode_batch(texts, add_special_tokens=False)
    for text, (ids, _), found in zip(texts, encoder.encode_batch(texts), expected):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == found.ids, text


def test_a_very_long_word(library):
    draw = random.Random(5)
    text = "".join(draw.choice("etaoinshrdlu") for _ in range(160_000))
    started = time.monotonic()
    ((ids, _),) = Encoder(Vocabulary.load(WORD_TOKENIZER)).encode_batch([text])
    assert time.monotonic() - started < 20  # a round for each rank took a minute
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == library[0].encode(text, add_special_tokens=False).ids


def test_counts_equal_the_library(library):
    texts = _texts()
    counter = Counter(Merges(BYTE_TOKENIZER))
    expected = library[1].encode_batch(texts, add_special_tokens=False)
    assert [counter.count(t) for t in texts] == [len(e.ids) for e in expected]


def test_merging_takes_the_lowest_rank_from_the_left():
    ranks = {(97, 97): (0, 256), (256, 97): (1, 257), (98, 97): (2, 258)}
    assert count_symbols(b"", ranks) == 0
    assert count_symbols(b"aaa", ranks) == 1  # aa, then aaa
    assert count_symbols(b"aaaaa", ranks) == 2
    assert count_symbols(b"baaa", ranks) == 2  # b stays before aaa


def test_every_case_has_a_row(spark, library):
    docs = documents(spark)
    encoded = sorted(map(tuple, bpe_encode(docs, WORD_TOKENIZER).collect()), key=str)
    counted = sorted(map(tuple, count_tokens(docs, BYTE_TOKENIZER, TOKEN_LIMIT).collect()), key=str)

    def sha(data):
        return hashlib.sha256(data).hexdigest()

    expected_ids, expected_counts = [], []
    for doc_id, text, _ in CASES:
        ids = library[0].encode(text or "", add_special_tokens=False).ids
        decoded = library[0].decode(ids, skip_special_tokens=False)
        expected_ids.append((doc_id, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(decoded.encode())))
        n = len(library[1].encode(text or "", add_special_tokens=False).ids)
        expected_counts.append((doc_id, len((text or "").encode()), n, n > TOKEN_LIMIT))
    assert encoded == sorted(expected_ids, key=str)
    assert counted == sorted(expected_counts, key=str)


def test_identifiers_can_be_had(spark, library):
    row = bpe_encode(documents(spark, [(1, "Hello WORLD", "en")]), WORD_TOKENIZER, with_ids=True).first()
    assert row.ids == library[0].encode("Hello WORLD", add_special_tokens=False).ids
    assert row.decoded == "hello</w> world</w>"


def test_empty_table(spark):
    assert bpe_encode(documents(spark, []), WORD_TOKENIZER).count() == 0
    assert count_tokens(documents(spark, []), BYTE_TOKENIZER, 1).count() == 0
