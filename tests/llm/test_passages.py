"""Benchmark passages, repeated passages and personal data against brute force."""

import hashlib
import random
import re
import time
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from cases import CASES, PASSAGE, documents, words_of
from pyspark.sql import functions as F
from saldomart.llm import decontamination
from saldomart.llm import substring_dedup as dedup
from saldomart.llm.decontamination import build_automaton, character_spans, contaminated, scan, uncontaminated
from saldomart.llm.hashing import WordHashes, run_hashes
from saldomart.llm.pii import (
    FEATURES,
    KINDS,
    Field,
    added_spans,
    base_spans,
    find_pii,
    fit,
    label_tokens,
    links_of,
    luhn,
    mask,
    mask_pii,
    render,
    token_labels,
    tokens_of,
    touching,
)
from saldomart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
BENCH_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def _contamination(docs, items):
    windows = {}
    for item, text in items:
        words = BENCH_WORDS.findall(_lower(text))
        for i in range(max(1, len(words) - 9) if words else 0):
            windows.setdefault(tuple(words[i : i + 10]), set()).add(item)
    lengths = {len(w) for w in windows}
    found = []
    for doc_id, text in docs:
        words = BENCH_WORDS.findall(_lower(text))
        hit, ids = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids |= windows[tuple(words[i : i + n])] - {None}
        found.append((doc_id, len(words), len(hit), len(ids), _sha(",".join(sorted(map(str, ids)))), bool(hit)))
    return sorted(found, key=str)


def test_contamination_equals_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = QUERIES["op8_decontamination"](spark, SF).collect()
    expected = _contamination([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert sorted(map(tuple, rows), key=str) == expected


@pytest.mark.parametrize("part_bytes", [1 << 22, 100])
def test_contamination_of_odd_documents(spark, part_bytes):
    items = [(1, PASSAGE), (2, PASSAGE), (3, None), (4, "  "), (5, "中文 AND"), (None, "same words"), (None, "done"), (6, "a row"), (6, "a row")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = contaminated(documents(spark), benchmark, part_bytes)
    expected = _contamination([(i, t) for i, t, _ in CASES], items)
    assert any(row[2] and not row[3] for row in expected)  # a passage of an item without an id
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, found.select(columns).collect()), key=str) == expected
    clean = uncontaminated(documents(spark).withColumn("row_no", F.lit(1)), benchmark, part_bytes).drop("row_no")
    assert clean.columns == documents(spark).columns
    assert clean.count() == sum(not row[-1] for row in expected)
    none = benchmark.limit(0)
    assert contaminated(documents(spark), none).filter("contaminated").count() == 0
    assert contaminated(documents(spark, []), benchmark).count() == 0


def test_long_items_are_taken_in_pieces(spark):
    """Every window of an item is in a piece, and no other is."""
    draw = random.Random(6)
    items = [(n, " ".join(f"W{draw.randrange(400)}" for _ in range(n))) for n in (1, 9, 10, 11, 59, 60, 61, 200)]
    benchmark = spark.createDataFrame([*items, items[3]], "item_id long, text string")
    windows = {}
    for row in decontamination.item_pieces(benchmark, 20).collect():
        words = bytes(row.piece).decode().split()
        assert len(words) <= 29
        for i in range(max(1, len(words) - 9)):
            windows.setdefault(row.item_id, set()).add(tuple(words[i : i + 10]))
    for n, text in items:
        words = text.lower().split()
        assert windows[n] == {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))}


def test_a_benchmark_of_two_megabytes_is_one_automaton_built_once(spark, monkeypatch):
    draw = random.Random(4)
    items = [(i, " ".join(f"w{draw.randrange(90_000)}" for _ in range(3000))) for i in range(100)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    (part,) = decontamination.benchmark_parts(benchmark)
    assert sum(len(t) for _, t in items) > 1_700_000
    built = []
    monkeypatch.setattr(decontamination, "build_automaton", lambda found: built.append(len(found)) or build_automaton(found))
    first = decontamination.windows_of(part)
    for i, text in items[::10]:
        words = text.split()
        n, matches = scan(f"x {' '.join(words[50:60])} y".encode(), decontamination.windows_of(part))
        assert (n, matches) == (12, [(1, 11, (i,))])
    assert built == [100] and decontamination.windows_of(part) is first
    assert len(decontamination.benchmark_parts(benchmark, 500_000)) in (4, 5)


def test_offsets_lead_back_to_the_text():
    text = "Ünder: the  RED; fox, é jumps"
    n, matches = scan(text.encode(), build_automaton([(9, b"the red fox")]))
    assert n == 6 and matches == [(1, 4, (9,))]
    ((start, end),) = character_spans(text.encode(), [(1, 4)])
    assert text[start:end] == "the  RED; fox"


def _deduplicated(docs, window):
    first = {}
    split = [(i, words_of(t)) for i, t in docs]
    for i, words in sorted((x for x in split if x[0] is not None), key=lambda x: x[0]):
        for j in range(len(words) - window + 1):
            first.setdefault(tuple(words[j : j + window]), i)
    found = []
    for i, words in split:
        gone = set()
        for j in range(len(words) - window + 1):
            if i is not None and first[tuple(words[j : j + window])] < i:
                gone.update(range(j, j + window))
        kept = [w for j, w in enumerate(words) if j not in gone]
        found.append((i, len(words), len(words) - len(kept), _sha(" ".join(kept))))
    return sorted(found, key=str)


def test_repeats_equal_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = sorted(map(tuple, QUERIES["op9_substring_dedup"](spark, SF).collect()), key=str)
    assert rows == _deduplicated(docs, 50)
    assert sum(r[2] for r in rows) > 0


@pytest.mark.parametrize("window,anchor", [(50, 25), (6, 3), (4, 4)])
def test_repeats_of_odd_documents(spark, window, anchor):
    draw = random.Random(window)
    few = [(100 + i, " ".join(draw.choice("ab") for _ in range(draw.randint(0, 40))), "en") for i in range(60)]
    rows = dedup.remove_repeats(documents(spark, CASES + few), window, anchor).collect()
    assert sorted(map(tuple, rows), key=str) == _deduplicated([(i, t) for i, t, _ in CASES + few], window)


@pytest.mark.parametrize("heavy", [256, 0])
def test_texts_of_one_id_and_heavy_anchors(spark, monkeypatch, heavy):
    """Rows of one id with several texts, and a group of near copies of which every anchor counts as heavy."""
    monkeypatch.setattr(dedup, "HEAVY_ROWS", heavy)
    draw = random.Random(heavy)
    words = [f"w{i}" for i in range(120)]
    near = []
    for i in range(60):
        copy = list(words)
        copy[draw.randrange(120)] = f"x{i % 7}"
        near.append((200 + i % 50, " ".join(copy[draw.randrange(9) :]), "en"))
    line = "one line of words that a document says again "
    near += [(400 + i, line * (9 + i), "en") for i in range(9)]
    rows = [*CASES, *near, (2, "short"), (2, f"{PASSAGE} and more {PASSAGE}"), (500, PASSAGE), (500, "tiny"), (500, None)]
    rows = [(i, t, "en") for i, t, *_ in rows]
    got = dedup.remove_repeats(documents(spark, rows).repartition(7), 50, 25).collect()
    assert sorted(map(tuple, got), key=str) == _deduplicated([(i, t) for i, t, _ in rows], 50)


def test_repeats_survive_a_full_sketch(spark, monkeypatch):
    """Where every cell is set nothing is filtered, and nothing is lost."""
    monkeypatch.setattr(dedup, "sketch_bits", lambda docs: 4)
    rows = dedup.remove_repeats(documents(spark), with_text=True).collect()
    assert sorted((tuple(r)[:4] for r in rows), key=str) == _deduplicated([(i, t) for i, t, _ in CASES], 50)
    assert dedup.remove_repeats(documents(spark, [])).count() == 0


def test_blocks_hold_whole_documents():
    rows = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, None]), pa.array(["a b c", None, "d", "e f"]), pa.array([7, 8, 9, 0])], ["doc_id", "text", "mark"])
    blocks = list(dedup.blocks_of(iter([rows.slice(0, 3)]), 2))
    assert [(ids.tolist(), marks.tolist(), lengths.tolist(), len(flat)) for ids, marks, lengths, flat in blocks] == [
        ([1], [7], [3], 3), ([2, 3], [8, 9], [0, 1], 1)
    ]


def test_anchors_are_the_lowest_runs():
    hashes = np.random.default_rng(2).integers(0, 9, 200).astype(np.uint64)
    runs = run_hashes(hashes, 5)
    at = dedup.anchors_of(runs, 12, 5)
    for i in range(len(hashes) - 11):
        assert at[i] == i + int(np.argmin(runs[i : i + 8]))


def test_run_hashes_depend_on_order_and_words():
    h = np.array([WordHashes()[w] for w in (b"a", b"b", b"a", b"b", b"a")], np.uint64)
    runs = run_hashes(h, 2)
    assert runs[0] == runs[2] and runs[1] == runs[3] and runs[0] != runs[1]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _base(text):
    def digits(m):
        return [int(c) for c in m.group() if c.isdigit()]

    spans = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    spans += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(spans)


def test_base_spans_equal_the_patterns():
    draw = random.Random(8)
    parts = [*"ab0123456789@..+-% ()\né", "4111111111111111", "+1 (555) 555-0100", "1.2.3.4", "x.y@z.com", "@", "256."]
    for _ in range(20_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 25)))
        assert base_spans(text)[0] == _base(text), repr(text)


def test_luhn():
    assert luhn([int(c) for c in "4111111111111111"]) and not luhn([int(c) for c in "4111111111111112"])


def test_field_finds_entities_side_by_side(spark):
    """The patterns run over both; the field has learned both kinds alone."""
    text = "ring +1 (605) 555-9305 4111111111111111 then"
    alone = [f"call +1 ({200 + i}) 555-{1000 + i} now" for i in range(60)]
    alone += [f"pay {n} now" for n in ("4111111111111111", "5500000000000004", "4012888888881881", "6011111111111117") for _ in range(10)]
    docs = documents(spark, [(i, f"{t} {i * 'z'}", "en") for i, t in enumerate(alone)] + [(900, text, "en")])
    row = find_pii(docs).filter("doc_id = 900").first()
    assert _base(text) == []
    assert row.spans == f"card:{text.index('4111')}:{text.index(' then')},phone:5:22" or set(row.spans.split(",")) == {
        "phone:5:22",
        f"card:{text.index('4111')}:{text.index(' then')}",
    }
    assert (row.n_phone, row.n_card, row.n_added) == (0, 0, 2)


@pytest.mark.parametrize("card", ["4111111111111111", "4111 1111 1111 1111"])
@pytest.mark.parametrize("n", [2, 3])
def test_every_entity_of_a_run_is_found(card, n):
    text = "at 99 " + " ".join([card] * n) + " 7 then"
    tokens = tokens_of(text)
    labels = np.full(len(tokens), 3)
    starts = [6 + i * (len(card) + 1) for i in range(n)]
    expected = [(a, 2, a + len(card)) for a in starts]
    assert base_spans(text)[0] == []
    found = added_spans(text, tokens, labels, [])
    assert sorted(found) == expected
    assert mask(text, found) == "at 99 " + " ".join(["<card>"] * n) + " 7 then"


def test_tokens_meet_their_spans_in_one_sweep():
    """Labels and free tokens as they follow from comparing every token with every span."""
    draw = random.Random(2)
    parts = ["4111111111111111", "+1 (555) 555-0100", "1.2.3.4", "x.y@z.com", "word", "12", "+99 1", "999.1.1.1", "7-7", ","]
    for _ in range(600):
        text = " ".join(draw.choice(parts) for _ in range(draw.randint(0, 12))).replace(" ,", draw.choice([",", "", " "]))
        tokens = tokens_of(text)
        spans, failed = base_spans(text)
        labels = []
        for i, t in enumerate(tokens):
            inside = next((k for a, k, b in spans if a < t.end and t.start < b), None)
            meeting = [(a, b) for a, b in failed if a < t.end and t.start < b]
            shared = any(a < o.end and o.start < b for a, b in meeting for j, o in enumerate(tokens) if j != i)
            labels.append(-1 if inside is None and shared else 0 if inside is None else 1 + inside)
        assert token_labels(tokens, spans, failed) == labels
        near = [[n for n, (a, _, b) in enumerate(spans) if a < t.end and t.start < b] for t in tokens]
        assert [list(numbers) for numbers in touching(tokens, spans)] == near


def test_a_document_of_very_many_entities():
    """Thousands of addresses; comparing each token with each span took seconds."""
    text = "\n".join(f"u{i}@example.com, 10.0.{i % 250}.7" for i in range(20_000))
    tokens = tokens_of(text)
    started = time.monotonic()
    spans, failed = base_spans(text)
    labels = np.array(token_labels(tokens, spans, failed))
    assert added_spans(text, tokens, labels, spans) == [] and (labels > 0).sum() == 40_000
    assert time.monotonic() - started < 10


def _exact_labels(scores, links, field):
    """The likeliest label of each token, and by how much, from the sum over all labellings."""
    n = len(scores)
    total = np.zeros((n, 5))
    for labels in product(range(5), repeat=n):
        weight = sum(scores[i, x] for i, x in enumerate(labels))
        weight += sum(field.pair[k, labels[u], labels[v]] for u, v, k in links)
        for i, x in enumerate(labels):
            total[i, x] += np.exp(weight)
    ordered = np.sort(total, axis=1)
    return total.argmax(axis=1), ordered[:, -1] / ordered[:, -2]


@pytest.mark.parametrize("shape", ["chain", "star", "far pairs", "loop"])
def test_messages_give_the_labels_of_the_exact_field(shape):
    """On trees messages are exact; on a loop of weak links nearly so. Close calls are left out."""
    draw = np.random.default_rng(11)
    right = asked = 0
    for _ in range(40):
        n = int(draw.integers(2, 5))
        links = {
            "chain": [(i, i + 1, int(draw.integers(0, 3))) for i in range(n - 1)],
            "star": [(0, i, int(draw.integers(0, 3))) for i in range(1, n)],
            "far pairs": [(i, i + n // 2, 1) for i in range(n // 2)],
            "loop": [(i, (i + 1) % n, 2) for i in range(n if n > 2 else 1)],
        }[shape]
        field = Field(draw.normal(0, 1, (FEATURES, 5)), draw.normal(0, 0.4 if shape == "loop" else 0.8, (3, 5, 5)))
        features = draw.integers(0, FEATURES, (n, 3))
        exact, margin = _exact_labels(field.single[features].sum(axis=1), links, field)
        found = label_tokens(features, np.array(links).reshape(-1, 3), field)
        clear = margin > 1.3
        right, asked = right + (found == exact)[clear].sum(), asked + clear.sum()
    assert asked > 60 and right >= (0.97 if shape == "loop" else 1) * asked


def test_links_grow_with_tokens():
    tokens = tokens_of("7 7 7 7 8 b1 7")
    links = links_of(tokens)
    assert [t.text for t in tokens] == ["7", "7", "7", "7", "8", "b1", "7"]
    assert (3, 6, 1) in links and (4, 6, 2) in links and (0, 2, 1) not in links
    assert len(links) <= 3 * len(tokens)


def test_distant_tokens_pull_each_other():
    """A token without evidence of its own takes the label of an equal token far away."""
    features = np.array([[0, 1, 2], [0, 3, 4]] * 50)
    links = np.array([[2 * i, 2 * i + 1, 1] for i in range(50)])
    labels = np.array(([2, 2] * 25) + ([0, 0] * 25))
    features[50:, 1] = np.where(features[50:, 1] == 1, 5, 3)
    field = fit(features, links, labels)
    field.single[3] = field.single[4] = 0
    assert label_tokens(np.array([[0, 1, 2], [0, 3, 4]]), np.array([[0, 1, 1]]), field).tolist() == [2, 2]


def test_pii_of_odd_documents(spark):
    rows = find_pii(documents(spark)).collect()
    assert len(rows) == len(CASES)
    for r in rows:
        texts = [t or "" for i, t, _ in CASES if i == r.doc_id]
        assert r.base_sha256 in [_sha(render(_base(t))) for t in texts]
    seven = next(r for r in rows if r.doc_id == 7)
    assert [seven[f"n_{k}"] for k in KINDS] == [1, 1, 0, 0]
    assert find_pii(documents(spark, [])).count() == 0
    masked = mask_pii(documents(spark))
    assert masked.columns == documents(spark).columns and masked.count() == len(CASES)
    assert "<email>" in masked.filter("doc_id = 7").first().text
    assert masked.filter("doc_id = 3").first().text is None


def test_mask_joins_overlapping_spans():
    assert mask("ab 12 34 cd", [(3, 1, 5), (4, 2, 8)]) == "ab <ip> cd"
