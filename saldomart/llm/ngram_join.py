"""Similarity join of documents by the Jaccard similarity of their word n-grams.

1. A document is the set of its runs of five words, in lower case. Documents of equal sets
   form a class and are represented by the one of lowest doc_id.
2. MinHash bands: the numbers of bands and rows follow from the target recall. Bands are
   shuffled by their hash; documents that share a band hash are candidates.
3. Candidates fall into connected groups. A group goes to one task, or, where it is large,
   to a task for each pair of its blocks. There every pair is verified on the full sets,
   by counting common n-grams in matrix products of small blocks of documents. No pair
   becomes a row: a task returns the number of links and a label per document.
4. Labels that meet in several tasks are joined once more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldomart.llm.common import batch, encoded_texts, row_blocks, stored
from saldomart.llm.hashing import WordHashes, mix64, run_hashes

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.995  # of pairs right at the similarity; pairs above it are found more often
MAX_HASHES = 112
BLOCK_NGRAMS = 1_500_000  # of one block of a large group
_TILE = 384  # documents a side of one matrix product
_COLUMNS = 8192  # n-grams of one matrix product
_BLOCK_BYTES = 4 * 1024 * 1024


def choose_bands(similarity: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows, so the fewest false candidates, that reach the recall."""
    best = None
    for rows in range(1, max_hashes + 1):
        shared = similarity**rows
        bands = 1 if shared >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-shared))
        if bands * rows <= max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError(f"recall {recall} at {similarity} needs more than {max_hashes} hashes")
    return best


def ngram_sets(texts: list[bytes], hashes: WordHashes, n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text. Fewer words than ``n`` make one n-gram."""
    words = [t.lower().split() for t in texts]
    lengths = [len(w) for w in words]
    flat = np.fromiter((hashes[w] for ws in words for w in ws), np.uint64, sum(lengths))
    runs = run_hashes(flat, n)
    sets, start = [], 0
    for ws, length in zip(words, lengths):
        if length >= n:
            sets.append(np.unique(runs[start : start + length - n + 1]))
        elif length:
            sets.append(np.array([xxhash.xxh64_intdigest(b" ".join(ws), seed=length)], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
        start += length
    return sets


def set_digest(ngrams: np.ndarray) -> tuple[int, int]:
    """A 128-bit hash of a set, in two halves."""
    return divmod(xxhash.xxh3_128_intdigest(ngrams.tobytes()), 1 << 64)


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """One hash per set and band. Sets must not be empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    random = np.random.default_rng(11)
    factors = random.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    found = np.zeros((len(sets), bands), np.uint64)
    for band in range(bands):
        value = np.full(len(sets), band + 1, np.uint64)
        for row in range(rows):
            lowest = np.minimum.reduceat((flat * factors[band * rows + row]) >> np.uint64(24), starts)
            value = mix64(value * np.uint64(31) + lowest)
        found[:, band] = value
    return found


_SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("set_a", pa.int64()),
        ("set_b", pa.int64()),
        ("n_ngrams", pa.int64()),
        ("bands", pa.list_(pa.int64())),
    ]
)
_SIGNED_DDL = "doc_id long, set_a long, set_b long, n_ngrams long, bands array<long>"


def signatures(docs: DataFrame, bands: int, rows: int, n: int = WORDS) -> DataFrame:
    """For each document with words: a 128-bit hash of its n-gram set, its size, its band hashes."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for part in row_blocks(batches, 1, _BLOCK_BYTES):
            sets = ngram_sets(encoded_texts(part.column(1)), hashes, n)
            some = [i for i, s in enumerate(sets) if len(s)]
            if not some:
                continue
            sets = [sets[i] for i in some]
            digests = np.array([set_digest(s) for s in sets], np.uint64)
            signed = band_hashes(sets, bands, rows).view(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, signed.size + 1, bands, dtype=np.int32), signed.ravel())
            yield batch(
                _SIGNED,
                part.column(0).take(pa.array(some)),
                digests[:, 0].view(np.int64),
                digests[:, 1].view(np.int64),
                [len(s) for s in sets],
                lists,
            )

    return docs.mapInArrow(sign, _SIGNED_DDL)


def connected(edges: DataFrame, name: str = "groups") -> DataFrame:
    """node and root for every node of ``edges`` (a, b); nodes with equal roots are connected.

    Each round joins every node to its neighbour of lowest hash, another hash each round,
    and goes on with what is left between the joined ones, a part of it only. Rounds are
    stored in the shared folder.
    """
    spark = edges.sparkSession
    edges = stored(edges.filter("a <> b").distinct(), f"{name}-edges")
    labels: DataFrame | None = None
    number = 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        order = lambda c, seed=number: F.xxhash64(F.col(c), F.lit(seed))
        lowest = both.groupBy("a").agg(F.min(F.struct(order("b").alias("h"), F.col("b").alias("node"))).alias("low"))
        chosen = F.when(F.col("low.h") < order("a"), F.col("low.node")).otherwise(F.col("a"))
        moves = stored(lowest.select(F.col("a").alias("node"), chosen.alias("to")), f"{name}-moves")
        if labels is None:
            labels = moves.withColumnRenamed("to", "root")
        else:
            moved = labels.join(moves.withColumnRenamed("node", "root"), "root", "left")
            labels = stored(moved.select("node", F.coalesce("to", "root").alias("root")), f"{name}-labels")
        to_a = moves.select(F.col("node").alias("a"), F.col("to").alias("new_a"))
        to_b = moves.select(F.col("node").alias("b"), F.col("to").alias("new_b"))
        left = edges.join(to_a, "a").join(to_b, "b").filter("new_a <> new_b")
        pair = left.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
        edges = stored(pair.distinct(), f"{name}-edges")
        number += 1
    return labels if labels is not None else spark.createDataFrame([], "node long, root long")


class _Groups:
    """Labels of members, joined pair by pair of blocks."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Members of labels a[i] and b[i] belong together."""
        lead: dict[int, int] = {}

        def find(x: int) -> int:
            while x in lead:
                x = lead[x]
            return x

        for x, y in np.unique(np.stack([a, b], axis=1), axis=0).tolist():
            x, y = find(x), find(y)
            if x != y:
                lead[max(x, y)] = min(x, y)
        old = np.array(sorted(lead), np.int64)
        if len(old):
            move = np.arange(len(self.label))
            move[old] = [find(x) for x in old.tolist()]
            self.label = move[self.label]


def _common(left: list[np.ndarray], right: list[np.ndarray], size: int, same: bool) -> np.ndarray:
    """Common elements of every set on the left with every set on the right. Elements are below ``size``."""
    a, b = np.concatenate(left), np.concatenate(right)
    if same:
        shared = np.flatnonzero(np.bincount(a, minlength=size) > 1)
    else:
        mark = np.zeros(size, bool)
        mark[a] = True
        other = np.zeros(size, bool)
        other[b] = True
        shared = np.flatnonzero(mark & other)
    column = np.full(size, -1, np.int32)
    column[shared] = np.arange(len(shared))
    sides = []
    for sets, flat in ((left, a), (right, b)):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = column[flat]
        sides.append((row[at >= 0], at[at >= 0]))
    total = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(shared), _COLUMNS):
        width = min(_COLUMNS, len(shared) - start)
        parts = []
        for (row, at), sets in zip(sides, (left, right)):
            here = (at >= start) & (at < start + width)
            dense = np.zeros((len(sets), width), np.float32)
            dense[row[here], at[here] - start] = 1
            parts.append(dense)
        total += parts[0] @ parts[1].T
    return total


def verify(
    sets: list[np.ndarray], weight: np.ndarray, side: np.ndarray, similarity: float = SIMILARITY, within: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Weight of the sets linked to each set, and a label shared by linked sets.

    Pairs are all pairs ``within`` one side, else those of different sides. ``weight`` is
    the number of documents a set stands for.
    """
    n = len(sets)
    linked, groups = np.zeros(n, np.int64), _Groups(n)
    vocabulary, ids = np.unique(np.concatenate(sets), return_inverse=True)
    ids = ids.astype(np.int32)
    bounds = np.cumsum([0, *map(len, sets)])
    sizes = np.diff(bounds)
    numbered = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    # Similar sets next to each other: then most blocks have few common elements and cost little.
    keys = [np.minimum.reduceat(mix64(vocabulary * np.uint64(k))[ids], bounds[:-1]) for k in (3, 7)]
    tiles = []
    for which in np.unique(side):
        mine = np.flatnonzero(side == which)
        mine = mine[np.lexsort([k[mine] for k in reversed(keys)])]
        tiles += [(which, mine[i : i + _TILE]) for i in range(0, len(mine), _TILE)]
    for i, (side_a, a) in enumerate(tiles):
        for j in range(i, len(tiles)):
            side_b, b = tiles[j]
            if not within and side_a == side_b:
                continue
            low, high = sizes[a].min() / sizes[b].max(), sizes[a].max() / sizes[b].min()
            if high < similarity or low > 1 / similarity:
                continue  # no pair can be similar: sizes differ too much
            common = _common([numbered[x] for x in a], [numbered[x] for x in b], len(vocabulary), i == j)
            union = sizes[a][:, None] + sizes[b][None, :] - common
            hit = common >= similarity * union - 1e-6
            if i == j:
                np.fill_diagonal(hit, False)
            linked[a] += hit @ weight[b]
            if i != j:
                linked[b] += hit.T @ weight[a]
            apart = hit & (groups.label[a][:, None] != groups.label[b][None, :])
            if apart.any():
                row, column = np.nonzero(apart)
                groups.join(groups.label[a][row], groups.label[b][column])
    return linked, groups.label


_VERIFIED = pa.schema(
    [("rep", pa.int64()), ("linked", pa.int64()), ("label", pa.int64()), ("whole", pa.bool_())]
)


def _verified(batches: Iterator[pa.RecordBatch], n: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Input sorted by root, block and other: these, then mine, blocks, rep, n_same, set_a, text.

    Where rows repeat a doc_id, the text counts whose set was chosen for it.
    """
    hashes = WordHashes()
    key: tuple | None = None
    held: list[tuple[int, int, int]] = []
    sets: list[np.ndarray] = []
    seen: set[int] = set()

    def finish() -> Iterator[pa.RecordBatch]:
        within = key[1] == key[2]
        if not within and len({s for _, _, s in held}) < 2:
            return  # the other block is empty; the task of this block alone counts its pairs
        reps = np.array([r for r, _, _ in held], np.int64)
        side = np.array([s for _, _, s in held], np.int64)
        linked, label = verify(sets, np.array([d for _, d, _ in held], np.int64), side, similarity, within)
        lowest = np.full(len(reps), np.iinfo(np.int64).max)
        np.minimum.at(lowest, label, reps)
        yield batch(_VERIFIED, reps, linked, lowest[label], [whole] * len(reps))

    whole = True
    for rows in row_blocks(batches, 8, _BLOCK_BYTES):
        found = ngram_sets(encoded_texts(rows.column(8)), hashes, n)
        columns = [rows.column(i).to_pylist() for i in range(8)]
        for root, block, other, mine, blocks, rep, n_same, set_a, grams in zip(*columns, found):
            if (root, block, other) != key:
                if held:
                    yield from finish()
                key, whole, held, sets, seen = (root, block, other), blocks == 1, [], [], set()
            if rep in seen or set_digest(grams)[0] != set_a % (1 << 64):
                continue
            seen.add(rep)
            held.append((rep, n_same, mine))
            sets.append(grams)
    if held:
        yield from finish()


def ngram_join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, n: int = WORDS) -> DataFrame:
    """Class and number of links of each document.

    Two documents are linked if the Jaccard similarity of their n-gram sets is at least
    ``similarity``. Returns a row per doc_id: doc_id, class_id (the lowest doc_id that links
    lead to, directly or over others), rep_id (the lowest doc_id with the same set), n_same
    (documents with the same set, itself included) and n_links (other documents linked to it,
    copies included). Rows that repeat a doc_id are one document, with the n-gram set of
    lowest hash. Rows with a NULL doc_id cannot be named and are left out. NULL, empty and
    blank texts have no n-grams and no links. Other columns are ignored.

    Pairs at the similarity are candidates with probability ``recall`` at least; candidates
    are verified exactly.
    """
    bands, rows = choose_bands(similarity, recall)
    texts = docs.filter("doc_id IS NOT NULL").selectExpr("CAST(doc_id AS long) AS doc_id", "text")
    all_signed = signatures(texts, bands, rows, n).groupBy("doc_id")
    lowest = all_signed.agg(F.min(F.struct("set_a", "set_b", "n_ngrams", "bands")).alias("s"))
    signed = stored(lowest.select("doc_id", "s.*"), "ngram-signatures")
    classes = stored(
        signed.groupBy("set_a", "set_b").agg(
            F.min("doc_id").alias("rep"),
            F.count("*").alias("n_same"),
            F.first("n_ngrams").alias("n_ngrams"),
            F.first("bands").alias("bands"),
        ),
        "ngram-classes",
    )
    hashes = classes.select(F.col("rep").alias("a"), F.posexplode("bands").alias("band", "hash"))
    buckets = hashes.groupBy("band", "hash").agg(F.min("a").alias("b"), F.count("*").alias("n")).filter("n > 1")
    candidates = hashes.join(buckets, ["band", "hash"]).select("a", "b")
    groups = connected(candidates, "ngram-candidates")

    members = groups.join(classes.select(F.col("rep").alias("node"), "n_same", "n_ngrams", "set_a"), "node")
    blocks = members.groupBy("root").agg(F.ceil(F.sum("n_ngrams") / BLOCK_NGRAMS).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        members.join(blocks, "root")
        .withColumn("mine", mine)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "root",
            F.least("mine", "with").alias("block"),
            F.greatest("mine", "with").alias("other"),
            "mine",
            "blocks",
            F.col("node").alias("rep"),
            "n_same",
            "set_a",
        )
    )
    keys = ["root", "block", "other"]
    sets = texts.withColumnRenamed("doc_id", "rep").join(dealt, "rep").select(*dealt.columns, "text")
    spread = sets.repartition(*keys).sortWithinPartitions(*keys, "rep")
    verified = stored(
        spread.mapInArrow(
            lambda b: _verified(b, n, similarity), "rep long, linked long, label long, whole boolean"
        ),
        "ngram-verified",
    )
    linked = verified.groupBy("rep").agg(F.sum("linked").alias("linked"), F.min("label").alias("label"))
    parts = verified.filter("NOT whole").select(F.col("rep").alias("a"), F.col("label").alias("b"))
    split = connected(parts, "ngram-links")
    lowest_of = split.groupBy("root").agg(F.min("node").alias("joined"))
    joined = split.join(lowest_of, "root").select(F.col("node").alias("rep"), "joined")
    found = (
        classes.select("set_a", "set_b", "rep", "n_same")
        .join(linked, "rep", "left")
        .join(joined, "rep", "left")
        .select(
            "set_a",
            "set_b",
            F.col("rep").alias("rep_id"),
            F.coalesce("joined", "label", "rep").alias("class_id"),
            "n_same",
            (F.col("n_same") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        )
    )
    with_words = signed.select("doc_id", "set_a", "set_b").join(found, ["set_a", "set_b"])
    names = ["doc_id", "class_id", "rep_id", "n_same", "n_links"]
    without = texts.filter("coalesce(text, '') NOT RLIKE '[^ \\t-\\r]'").select("doc_id").distinct()
    alone = without.join(signed.select("doc_id"), "doc_id", "left_anti")
    return with_words.select(*names).unionByName(
        alone.select(
            "doc_id",
            F.col("doc_id").alias("class_id"),
            F.col("doc_id").alias("rep_id"),
            F.lit(1).cast("long").alias("n_same"),
            F.lit(0).cast("long").alias("n_links"),
        )
    )


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, n: int = WORDS) -> DataFrame:
    """The rows of ``docs`` without those of classes that have a lower doc_id, with all their columns.

    Rows without a doc_id stay; rows that repeat one stay or go together.
    """
    later = ngram_join(docs, similarity, recall, n).filter("doc_id <> class_id").select("doc_id")
    return docs.join(later, "doc_id", "left_anti").select(*docs.columns)
