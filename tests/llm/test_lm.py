"""Language-model scores: exact counts, a proper distribution, and gains on held-out texts."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import CASES, documents, words_of
from saldomart.llm import lm_scoring as lm

SF = "/root/testdata/sf0.01"


def _tokens(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in words_of(text)] + [None]


def _base(docs):
    count = Counter()
    for doc_id, text in docs:
        if lm.fold_of(doc_id) != 2:
            count.update(_tokens(text))
    n, v = sum(count.values()), len(count)
    found = []
    for doc_id, text in docs:
        tokens = _tokens(text)
        base = sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens)
        found.append((doc_id, lm.fold_of(doc_id) == 2, len(tokens), sum(count[t] > 0 for t in tokens), n, base))
    return found


def _check(rows, docs):
    expected = sorted(_base(docs), key=str)
    got = sorted((tuple(r)[:6] for r in rows), key=str)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for r, e in zip(got, expected):
        assert math.isclose(r[5], e[5], rel_tol=1e-9)


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return lm.score_texts(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()]


def test_counts_and_base_equal_brute_force(scored):
    _check(*scored)


def test_folds_follow_the_ids(scored):
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in scored[0])


def test_held_out_texts_score_above_the_base(scored):
    rows = [r for r in scored[0] if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert all(r.score < 0 for r in rows)
    sizes = {i: len((t or "").encode()) for i, t in scored[1]}
    for r in rows:
        assert math.isclose(r.bits_per_byte, -r.score * math.log2(10) / max(sizes[r.doc_id], 1), rel_tol=1e-9)


def test_odd_documents(spark):
    rows = lm.score_texts(documents(spark)).collect()
    _check(rows, [(i, t) for i, t, _ in CASES])
    assert all(math.isfinite(r.score) for r in rows)
    assert lm.score_texts(documents(spark, [])).count() == 0


def test_no_training_documents(spark):
    held = next(i for i in range(100) if lm.fold_of(i) == 2)
    (row,) = lm.score_texts(documents(spark, [(held, "a b", "en")])).collect()
    assert (row.train_tokens, row.n_known, row.held_out) == (0, 0, True) and math.isfinite(row.score)


def test_next_bytes_are_a_distribution():
    """At any point of a word the probabilities of all 256 next bytes add up to one."""
    draw = np.random.default_rng(4)
    tables = [(draw.integers(0, 40, 1 << bits) + 256 * draw.integers(0, 40, 1 << bits)).astype(np.uint16) for bits in lm.TABLE_BITS]
    mixer = lm.Mixer.fresh()
    for prefix in (b"", b"th"):
        total = 0.0
        for byte in range(256):
            spelling = lm.spell([prefix + bytes([byte])], np.array([7]))
            at, p = len(prefix), 1.0
            for step in range(8):
                bit, found = lm.cells(spelling, step)
                one = mixer.predict(*lm.answers_of(lm.pairs_of(tables, found)), spelling.place)[0][at]
                p *= one if bit[at] else 1 - one
            total += p
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_counts_as_bytes():
    small = np.arange(16)
    assert (lm._COUNTS[lm.quantised(small)] == small).all()
    large = np.array([17, 100, 5000, 10**6])
    assert np.allclose(lm._COUNTS[lm.quantised(large)], large, rtol=0.05)


def test_topics_part_words_that_never_meet():
    together = np.zeros((lm.SHORT_WORDS, lm.SHORT_WORDS))
    together[:20, :20], together[20:40, 20:40] = 90, 60
    together[np.arange(40), np.arange(40)] = 100
    shares = lm.cluster(together)
    best = shares[:40].argmax(axis=1)
    assert len(set(best[:20])) == 1 and len(set(best[20:])) == 1 and best[0] != best[20]
    assert not shares[40:].any()


def test_topic_in_front_depends_on_words_before():
    words = [b"aa", b"bb", b"longer"]
    shares = np.zeros((lm.SHORT_WORDS, lm.TOPICS))
    shares[lm._short_bucket(b"aa"), 0] = shares[lm._short_bucket(b"bb"), 1] = 1
    flat = np.array([2, 0, 2, 1, 1, 2, 2, 0])
    topics = lm.topics_before(words, flat, np.array([0, 6]), np.array([6, 2]), shares)
    none = lm.TOPICS
    assert topics.tolist() == [none, none, 0, 0, 0, 1, none, none]


def _bucket(draw, n):
    """Random words that share beginnings, with fronts, depths and counts; some were not trained on."""
    words = sorted({bytes(draw.integers(97, 100, int(draw.integers(0, 9))).tolist()) for _ in range(n)})
    trained = draw.integers(0, 4, len(words))
    fronts = (4 * draw.integers(0, 3, len(words)) + draw.integers(0, 4, len(words))).astype(np.uint8)
    depth = np.array([lm.depth_of(w, {b"aaaa", b"bbbb"}) for w in words], np.int64)
    return lm.Bucket(0, words, fronts, depth, trained, trained // 2, trained, int((trained > 0).sum()), [])


def _spelled(word):
    return word + b" " if word else b"\n"


def test_counts_of_a_bucket_equal_brute_force():
    """Every beginning that holds the dealing bytes counts the zeros and ones of its own occurrences, no more."""
    bucket = _bucket(np.random.default_rng(3), 400)
    count = Counter()
    for word, front, depth, n in zip(bucket.words, bucket.fronts, bucket.depth, bucket.trained):
        for at, byte in enumerate(_spelled(word)):
            bits = format(byte, "08b")
            for step in range(8):
                for topic in (None, front >> 2):
                    count[_spelled(word)[:at], bits[:step], topic, bits[step]] += n
    near = lm.near_counts(bucket)
    part = np.random.default_rng(5).permutation(len(bucket.words))[:90]
    found = near.of(part)
    place = 0
    for i in part.tolist():
        spelled, topic = _spelled(bucket.words[i]), bucket.fronts[i] >> 2
        for at in range(bucket.depth[i], len(spelled)):
            bits = format(spelled[at], "08b")
            for step in range(8):
                for k, t in enumerate((None, topic)):
                    expected = [count[spelled[:at], bits[:step], t, b] for b in "01"]
                    pair = int(found[k, step, place])
                    assert [pair & 255, pair >> 8] == lm.quantised(np.array(expected)).tolist()
            place += 1
    assert place == found.shape[2] > 0


def test_scores_equal_one_bit_after_the_other():
    """The score of each word, worked out bit by bit from the model's own tables and weights."""
    draw = np.random.default_rng(8)
    bucket = _bucket(draw, 150)
    tables = [(draw.integers(0, 40, 1 << bits) + 256 * draw.integers(0, 40, 1 << bits)).astype(np.uint16) for bits in lm.TABLE_BITS]
    mixer = lm.Mixer(draw.normal(0.3, 0.2, (lm._GATES, 6)), np.sort(draw.random((lm._REFINE_GATES, lm._STEPS)), axis=1))
    near = lm.near_counts(bucket)
    scores = lm.word_scores(bucket, tables, mixer)
    place = 0
    for i, word in enumerate(bucket.words):
        spelling = lm.spell([word], bucket.fronts[i : i + 1], bucket.depth[i : i + 1])
        total = 0.0
        for at, byte in enumerate(_spelled(word)):
            deep = at >= bucket.depth[i]
            for step in range(8):
                _, found = lm.cells(spelling, step)
                pairs = [int(table[cell[at]]) for table, cell in zip(tables, found)]
                if deep:
                    pairs[3], pairs[4] = near.counts[0, step, place], near.counts[1, step, place]
                counts = [(lm._COUNTS[p & 255], lm._COUNTS[p >> 8]) for p in pairs]
                odds = [math.log((ones + 0.4) / (zeros + 0.4)) for zeros, ones in counts]
                by_four, by_word = (sum(sum(counts[c]) > b for b in bounds) for c, bounds in zip(lm._GATED, lm._BOUNDS))
                where = min((at + 1) // 2, 2)
                weights = mixer.weights[(by_word * 3 + by_four) * 3 + where]
                mixed = min(max(sum(w * o for w, o in zip(weights, odds)) + weights[-1], -7.99), 7.99)
                low = math.floor((mixed + 8) * 2)
                share = (mixed + 8) * 2 - low
                curve = mixer.refined[by_word * 3 + where]
                one = (1 / (1 + math.exp(-mixed)) + curve[low] * (1 - share) + curve[low + 1] * share) / 2
                one = min(max(one, 1e-6), 1 - 1e-6)
                total += math.log10(one if byte >> (7 - step) & 1 else 1 - one)
            place += deep
        assert math.isclose(total, scores[i], rel_tol=1e-5)


def test_words_that_share_a_deep_context_share_a_bucket():
    common = {b"comm", b"common"}
    depths = [lm.depth_of(w, common) for w in (b"a", b"comm", b"commo", b"common", b"commonly", b"come")]
    assert depths == [4, 6, 6, 8, 8, 4]


def test_common_beginnings_count_all_words(spark, monkeypatch):
    """Of every text and of any depth, against brute force; tasks that send a word more than once count it once."""
    monkeypatch.setattr(lm, "VOCABULARY_WORDS", 50)
    draw = np.random.default_rng(5)
    long = "commonly" * 20
    words = [f"word{i}" for i in range(300)] + [f"{long}{i}" for i in range(40)] + [f"z{i:06d}" for i in range(900)]
    words += ["Üb" + "xy" * i for i in range(20)] + ["a", "bcd"]
    texts = [(i, " ".join(str(w).upper() if i % 2 else str(w) for w in draw.permutation(words)[:400])) for i in range(40)]
    found = lm.common_beginnings(spark.createDataFrame([*texts, (99, None)], "doc_id long, text string").repartition(4), 3)
    known = {w for _, text in texts for w in text.encode().lower().split()}
    number = Counter(w[:n] for w in known for n in range(lm.LEADING, len(w) + 1, lm.DEEPER))
    assert found == {beginning for beginning, n in number.items() if n > max(8, len(known) // 12)}


def test_deep_common_beginnings(spark):
    words = [f"{'commonly' * 20}{i}" for i in range(40)] + ["other"]
    found = lm.common_beginnings(spark.createDataFrame([(" ".join(words),)], "text string"), 1)
    assert found == {words[0].encode()[:n] for n in range(4, 161, 2)}
    assert lm.common_beginnings(spark.createDataFrame([], "text string"), 1) == set()


def test_words_that_begin_alike_are_scored_once_as_far_as_they_do(monkeypatch):
    """The mixer is asked once for each beginning, topic and ending before it, not for each word; scores stay."""
    words = sorted(b"shared beginning of words".replace(b" ", b"") + bytes([a, b]) for a in range(97, 117) for b in range(97, 107))
    words, fronts = words * 2, np.repeat(np.array([5, 6], np.uint8), len(words))  # one topic, two endings
    depth = np.array([lm.depth_of(w, set()) for w in words], np.int64)
    ones = np.ones(len(words), np.int64)
    bucket = lm.Bucket(0, words, fronts, depth, ones, ones, ones, len(words), [])
    draw = np.random.default_rng(6)
    tables = [(draw.integers(0, 40, 1 << bits) + 256 * draw.integers(0, 40, 1 << bits)).astype(np.uint16) for bits in lm.TABLE_BITS]
    asked, predict = [], lm.Mixer.predict
    monkeypatch.setattr(lm.Mixer, "predict", lambda self, a, s, place: asked.append(len(place)) or predict(self, a, s, place))
    scores = lm.word_scores(bucket, tables, lm.Mixer.fresh())
    beginnings = {(w[: at + 1], f & 3 if at < 4 else 0) for w, f in zip(map(_spelled, words), fronts) for at in range(len(w))}
    assert sum(asked) == 8 * len(beginnings)
    monkeypatch.setattr(lm, "_CHUNK", 1)  # each word alone
    assert np.allclose(scores, lm.word_scores(bucket, tables, lm.Mixer.fresh()), rtol=1e-12)


def test_bytes_that_are_left_out_repeat_a_kept_one():
    bucket = _bucket(np.random.default_rng(7), 400)
    spelling = lm.spell(bucket.words, bucket.fronts, bucket.depth)
    few, kept, place = lm.alike(spelling, bucket.fronts)
    assert len(kept) < len(place) == len(spelling.data)
    for column in ("data", "place", "deep"):
        whole = getattr(spelling, column)
        assert (getattr(few, column) == whole[kept]).all() and (whole[kept][place] == whole).all()
    for whole, part in zip(spelling.contexts, few.contexts):
        assert (part == whole[kept]).all() and (part[place] == whole).all()


def test_words_are_dealt_by_their_depth(monkeypatch):
    monkeypatch.setattr(lm, "CACHED_WORDS", 3)
    common = {b"comm", b"common", b"commonly"}
    words = [b"", b"a", b"comm", b"commo", b"common", b"commonly", b"commonly so", b"come", b"comet", b"commute", b"zz"] * 2
    expected = [lm.xxhash.xxh32_intdigest(w[: lm.depth_of(w, common)]) % 1000 for w in words]
    assert lm.Dealer(1000, common).buckets_of(words).tolist() == expected


def test_distinct_keys_and_their_places():
    draw = np.random.default_rng(9)
    for size in (10, 400, 100_000):
        keys = draw.integers(0, size, 300)
        distinct, place = lm._distinct(keys, size)
        assert distinct.tolist() == sorted(set(keys.tolist())) and (distinct[place] == keys).all()


def test_counts_without_own():
    """Answers with a word's own counts taken off equal those worked out one by one."""
    draw = np.random.default_rng(10)
    word = np.repeat(np.arange(20), 5)
    own, bit = draw.integers(1, 30, 20).astype(float), draw.integers(0, 2, 100)
    pairs = [draw.integers(0, 1 << 16, 100).astype(np.uint16) for _ in lm.TABLE_BITS]
    answers, levels = lm.answers_of(pairs, lm.Others.without(own, word), bit)
    for at in range(100):
        seen = []
        for k, pair in enumerate(pairs):
            zeros, ones = float(lm._COUNTS[pair[at] & 255]), float(lm._COUNTS[pair[at] >> 8])
            taken = own[word[at]]
            zeros, ones = (zeros, max(ones - taken, 0)) if bit[at] else (max(zeros - taken, 0), ones)
            assert math.isclose(answers[k, at], math.log((ones + 0.4) / (zeros + 0.4)), rel_tol=1e-9, abs_tol=1e-12)
            seen.append(zeros + ones)
        assert [int(level[at]) for level in levels] == [sum(seen[i] > b for b in bounds) for i, bounds in zip(lm._GATED, lm._BOUNDS)]


def test_words_are_counted_in_every_training_fold(spark):
    docs = [(i, f"one two{i % 3} {'three ' * (i % 4)}") for i in range(60)]
    rows = lm.block_words(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), 1, np.zeros((lm.SHORT_WORDS, lm.TOPICS)), set(), 40)
    words = rows.filter("kind = 0").select(*lm._NAMES[:8]).toArrow().combine_chunks().to_batches()
    (bucket,) = lm.buckets_of(iter(words), set())
    folds = [k for k in range(lm.FOLDS) if k != lm.HELD_OUT_FOLD]
    found, expected = Counter(), Counter()
    for k, fold in enumerate(folds):
        for word, n in zip(bucket.words, bucket.by_fold[k].tolist()):
            found[word, fold] += n
    for doc_id, text in docs:
        if lm.fold_of(doc_id) in folds:
            expected.update((w, lm.fold_of(doc_id)) for w in [*text.encode().split(), b""])
    assert +found == expected and {fold for _, fold in expected} == set(folds)
    assert (bucket.by_fold.sum(axis=0) == bucket.trained).all()


def test_the_mixer_learns_from_every_training_fold(monkeypatch):
    """Equal to learning from each word of each fold by itself, against counts without that fold's own."""
    monkeypatch.setattr(lm, "_NEIGHBOURS", 7)
    monkeypatch.setattr(lm, "_LEARN_AT_ONCE", 60)
    draw = np.random.default_rng(12)
    bucket = _bucket(draw, 400)
    bucket.by_fold = np.maximum(draw.integers(-4, 4, (lm.FOLDS - 1, len(bucket.words))), 0)
    bucket.trained = bucket.by_fold.sum(axis=0)
    tables = [(draw.integers(0, 40, 1 << bits) + 256 * draw.integers(0, 40, 1 << bits)).astype(np.uint16) for bits in lm.TABLE_BITS]
    found, expected = lm.Mixer.fresh(), lm.Mixer.fresh()
    assert lm.learn_bucket(found, bucket, tables) == np.count_nonzero(bucket.by_fold)
    order, near = lm._learning_order(bucket), lm.near_counts(bucket)
    assert sorted(order.tolist()) == np.flatnonzero(bucket.trained).tolist()
    for start in range(0, len(order), 60):
        part = order[start : start + 60]
        entry = np.concatenate([part[fold[part] > 0] for fold in bucket.by_fold])
        own = np.concatenate([fold[part][fold[part] > 0] for fold in bucket.by_fold]).astype(float)
        spelling = lm.spell([bucket.words[i] for i in entry.tolist()], bucket.fronts[entry], bucket.depth[entry])
        others, weight = lm.Others.without(own, spelling.word), own[spelling.word]
        counts, outer = near.of(entry), np.flatnonzero(~spelling.deep)
        for step in range(8):
            bit, cell = lm.cells(spelling, step, outer)
            answers, seen = lm.answers_of(lm.pairs_of(tables, cell, spelling.deep, counts[:, step]), others, bit)
            expected.learn(answers, bit, weight, expected.predict(answers, seen, spelling.place), lm._RATE)
    assert np.allclose(found.weights, expected.weights) and np.allclose(found.refined, expected.refined)
    assert not np.allclose(found.weights, lm.Mixer.fresh().weights)
