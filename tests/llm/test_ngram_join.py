"""The similarity join against all pairs, and the parts it is made of."""

import random

import numpy as np
import pytest
from cases import CASES, documents, words_of
from saldomart.llm import ngram_join as join
from saldomart.llm.hashing import WordHashes
from saldomart.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def _sets(docs, n=5):
    sets = {}
    for doc_id, text in docs:
        words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in words_of(text)]
        if doc_id is not None:
            sets[doc_id] = {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()
    return sets


def _all_pairs(docs, similarity=0.8):
    sets = _sets(docs)
    links = {i: 0 for i in sets}
    lead = {i: i for i in sets}

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    names = sorted(sets)
    for k, i in enumerate(names):
        for j in names[k + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) >= similarity * max(len(a), len(b)):
                common = len(a & b)
                if common >= similarity * (len(a) + len(b) - common) - 1e-9:
                    links[i] += 1
                    links[j] += 1
                    a, b = find(i), find(j)
                    lead[max(a, b)] = min(a, b)
    return {i: (find(i), links[i]) for i in sets}


def test_join_equals_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op7_ngram_join"](spark, SF).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows} == _all_pairs(docs)
    assert len(rows) == len(docs) and any(r.n_links for r in rows)


def _near_copies(n, draw):
    """Copies of one text with a word changed here and there, some of them near each other only."""
    words = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(n):
        copy = list(words)
        for _ in range(draw.randint(0, 4)):
            copy[draw.randrange(len(copy))] = f"x{draw.randrange(50)}"
        texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("block", [join.BLOCK_NGRAMS, 2000])
def test_large_groups_lose_no_link(spark, monkeypatch, block):
    """Also where a group is dealt over pairs of blocks."""
    monkeypatch.setattr(join, "BLOCK_NGRAMS", block)
    draw = random.Random(6)
    texts = _near_copies(150, draw) + [" ".join(f"y{draw.randrange(40)}" for _ in range(60)) for _ in range(30)]
    docs = [(i, t) for i, t in enumerate(texts)]
    rows = join.ngram_join(documents(spark, [(i, t, "en") for i, t in docs])).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows} == _all_pairs(docs)


def test_empty_blocks_add_no_links(spark, monkeypatch):
    """Groups of two and three texts, each dealt over two or three blocks: some fall into one block."""
    monkeypatch.setattr(join, "BLOCK_NGRAMS", 130)
    docs = []
    for group in range(16):
        words = [f"g{group}w{i}" for i in range(120)]
        docs += [(len(docs) + k, " ".join([*words, *(f"x{i}" for i in range(k))])) for k in range(2 + group % 2)]
    rows = join.ngram_join(documents(spark, [(i, t, "en") for i, t in docs])).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows} == _all_pairs(docs)


def test_odd_documents(spark):
    docs = [(i, t) for i, t, _ in CASES]
    rows = join.ngram_join(documents(spark)).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows} == _all_pairs(docs)
    assert len(rows) == len({i for i, _ in docs if i is not None})
    one = join.one_of_each(documents(spark))
    assert one.columns == documents(spark).columns
    kept = [r.doc_id for r in one.collect()]
    assert kept.count(None) == 2 and 1 in kept and 2 not in kept and 11 not in kept and 10 in kept
    assert join.ngram_join(documents(spark, [])).count() == 0


def test_rows_that_repeat_an_id_are_one_document(spark):
    docs = [(1, "a b c d e f g"), (1, "other text of the same id"), (2, "a b c d e f g"), (3, "other text of the same id")]
    rows = {r.doc_id: r for r in join.ngram_join(documents(spark, [(i, t, "en") for i, t in docs])).collect()}
    assert sorted(rows) == [1, 2, 3]
    assert rows[1].n_links == 1 and rows[2].n_links + rows[3].n_links == 1


def test_bands_follow_the_recall():
    for similarity in (0.5, 0.8, 0.95):
        for recall in (0.9, 0.995):
            bands, rows = join.choose_bands(similarity, recall)
            assert 1 - (1 - similarity**rows) ** bands >= recall
            assert bands * rows <= join.MAX_HASHES
    with pytest.raises(ValueError):
        join.choose_bands(0.01, 0.999999)


def test_shared_bands_are_as_likely_as_similarity_says():
    draw = random.Random(2)
    hits = total = 0
    for _ in range(200):
        base = [f"a{draw.random()}" for _ in range(60)]
        other = base[:54] + [f"b{draw.random()}" for _ in range(6)]
        texts = [" ".join(x).encode() for x in (base, other)]
        bands = join.band_hashes(join.ngram_sets(texts, WordHashes(), 1), 1, 1)
        hits += bands[0, 0] == bands[1, 0]
        total += 1
    assert abs(hits / total - 54 / 66) < 0.1


def test_common_elements_in_column_chunks(monkeypatch):
    monkeypatch.setattr(join, "_COLUMNS", 3)
    draw = np.random.default_rng(5)
    sets = [np.unique(draw.integers(0, 30, 12)) for _ in range(9)]
    for same in (True, False):
        left, right = (sets, sets) if same else (sets[:4], sets[4:])
        got = join._common(left, right, 30, same)
        expected = [[len(np.intersect1d(a, b)) for b in right] for a in left]
        if same:
            np.fill_diagonal(got, 0)
            np.fill_diagonal(np.array(expected), 0)
            assert all(got[i, j] == expected[i][j] for i in range(9) for j in range(9) if i != j)
        else:
            assert (got == expected).all()


def test_connected_nodes_share_a_root(spark):
    draw = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 40)] + [(draw.randrange(100, 160), draw.randrange(100, 160)) for _ in range(35)] + [(5, 5)]
    lead = {}

    def find(x):
        while lead.setdefault(x, x) != x:
            x = lead[x]
        return x

    for a, b in edges:
        if a != b:
            lead[find(a)] = find(b)
    rows = join.connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(rows) == len({r.node for r in rows}) == len(lead)
    assert len({(find(r.node), r.root) for r in rows}) == len({r.root for r in rows}) == len({find(x) for x in list(lead)})
    assert join.connected(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
