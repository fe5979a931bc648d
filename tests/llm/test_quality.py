"""Quality rules against brute force and exact bounds; the classifier on held-out rows."""

import math
import zlib
from collections import Counter

import numpy as np
from cases import CASES, documents, words_of
from pyspark.sql import functions as F
from saldomart.llm.quality_model import BUCKETS, STRUCTURE, Buckets, Features, Machine, features_of, fit, score_quality
from saldomart.llm.quality_rules import RULES, choose_cutoffs, judged, passing, tail_log

SF = "/root/testdata/sf0.01"


def _counts(text):
    words = words_of(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if words_of(line)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def _compare(rows, texts):
    for row, (doc_id, text) in zip(rows, texts):
        s = row.stats
        counts = _counts(text)
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) == counts, doc_id
        assert row.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])


def test_counts_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = judged(docs, labels).orderBy("doc_id").collect()
    texts = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    assert len(rows) == len(texts)
    _compare(rows, texts)


def test_odd_documents(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    extra = [(20, "a b c d e f\n\na b c d e f\n \na b c d e f", "en"), (21, "% $ # * & | < >", "en")]
    docs = documents(spark, CASES + extra)
    key = lambda r: (str(r[0]), str(r[1]))
    texts = sorted(((i, t) for i, t, _ in CASES + extra), key=key)
    rows = judged(docs, labels).collect()
    assert len(rows) == len(texts)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts:
        counts = _counts(text)
        found = [(s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) for s in (r.stats for r in by_id[doc_id])]
        assert counts in found
    kept = passing(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in rows)


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert judged(documents(spark, []), labels).count() == 0
    assert judged(documents(spark, CASES[:1]), labels).first().kept


def test_tail_is_the_binomial_sum(spark):
    pairs = [(0, 50), (3, 50), (10, 2000), (0, 1), (49, 50), (5, 100_000)]
    rows = spark.createDataFrame(pairs, "k long, n long").select("k", "n", tail_log(F.col("k"), F.col("n"), 0.01).alias("p"))
    for r in rows.collect():
        terms = [
            math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1) + i * math.log(0.01) + (r.n - i) * math.log(0.99)
            for i in range(r.k + 1)
        ]
        top = max(terms)
        assert math.isclose(r.p, top + math.log(sum(math.exp(t - top) for t in terms)), rel_tol=1e-9, abs_tol=1e-12)


def test_cutoffs_keep_within_the_risk(spark):
    """2000 good rows: a level that two of them reach is safe, one that 20 reach is not."""
    good = [("en", 1, 30 if i < 2 else 20 if i < 20 else 0) for i in range(2000)]
    bad = [("en", 0, 60)] * 50 + [("en", 0, 25)] * 50
    few = [("de", 1, 0)] * 100 + [("de", 0, 90)] * 100  # too few rows for any bound
    rows = [(s, q, level, 0, 0, 0) for s, q, level in good + bad + few]
    labelled = spark.createDataFrame(rows, "stratum string, quality int, " + ", ".join(f"{r} int" for r in RULES))
    cutoffs = {r.stratum: r for r in choose_cutoffs(labelled).collect()}
    assert set(cutoffs) == {"en"}
    assert cutoffs["en"].cut_symbols == 25  # rejects all bad rows and two good ones; the loosest that does
    assert cutoffs["en"].cut_exclamations is None


def test_pairs_by_squares_equal_pairs():
    f = features_of([b"a b b c", b"", b"d a"], [7, None, 3], Buckets())
    random = np.random.default_rng(1)
    size = BUCKETS + len(STRUCTURE)
    machine = Machine(0.3, random.normal(size=size), random.normal(size=(size, 8)))
    for row, got in enumerate(machine.raw(f)):
        part = slice(f.starts[row], f.starts[row + 1])
        index, value = f.index[part], f.value[part].astype(float)
        expected = 0.3 + machine.weight[index] @ value
        for i in range(len(index)):
            for j in range(i + 1, len(index)):
                expected += machine.factor[index[i]] @ machine.factor[index[j]] * value[i] * value[j]
        assert math.isclose(got, expected, rel_tol=1e-4, abs_tol=1e-4)


def test_fit_learns_an_interaction():
    """Two words that are bad only together: no weight alone can tell."""
    index = [[1], [2], [1, 2], [3]] * 100
    label = np.array([1.0, 1.0, 0.0, 1.0] * 100)
    starts = np.r_[0, np.cumsum([len(i) for i in index])]
    f = Features(starts, np.concatenate(index).astype(np.int32), np.ones(starts[-1], np.float32))
    assert ((fit(f, label).score(f) >= 0.5) == (label == 1)).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = score_quality(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    tested = [(r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    assert sum(p == q for p, q in tested) >= 0.95 * len(tested)


def test_scores_do_not_use_labels_of_held_out_rows_nor_other_columns(spark):
    docs = documents(spark)
    some = spark.createDataFrame([(i, i % 2) for i in range(1, 12)], "doc_id long, quality int")
    changed = some.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    renamed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy"))
    one = sorted(map(str, score_quality(docs, some).collect()))
    assert one == sorted(map(str, score_quality(renamed, changed).collect()))
    assert len(one) == len(CASES)
    none = score_quality(docs, some.limit(0)).collect()
    assert all(abs(r.score - 0.5) < 0.25 for r in none)
    assert score_quality(documents(spark, []), some).count() == 0
