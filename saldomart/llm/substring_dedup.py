"""Removal of passages that repeat an earlier document, by windows of 50 words.

Every window is represented by an anchor: of the 25-word runs inside it, the one with the
lowest hash. Equal windows have equal anchors, and neighbouring windows mostly share one,
so anchors are about thirteen times fewer than windows. The work has two passes.

First pass: every partition counts its anchors in a count-min sketch whose counters end
at two. Sketches are merged cell by cell, and a cell is set where the counters reach two.
An anchor counts at least as often as any window it represents, and a sketch never counts
too low, so a window whose anchor has a clear cell in any row occurs once: none is lost.

Second pass: the windows estimated repeated are grouped exactly, by the hashes of anchor
and window, both of 64 bits. Within a block of documents only the occurrence in the
smallest document goes on; all others are already known to repeat it. So a passage that
stands in very many documents gives a row a block, not a row a document.

An anchor may still be shared by very many rows, in a group of near copies, say. Rows of
such an anchor are dealt by window instead, one row for a window and document with all its
places, after those of equal windows were reduced to the smallest document within a share
of the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldomart.llm.common import WORD_LIMIT, batch, encoded_texts, sha256_hex, stored
from saldomart.llm.hashing import WordHashes, mix64, run_hashes

WINDOW = 50
ANCHOR = 25
DEPTH = 2
MIN_BITS, MAX_BITS = 18, 29  # cells of a sketch row, as a power of two; 2^29 cells are 64 MB when merged
SHARD_BITS = 18  # cells that are merged in one group
CELLS_PER_ANCHOR = 8
HEAVY_ROWS, HEAVY_SHARE = 256, 5_000  # an anchor of more rows, and of more than one row in so many, is dealt by window
SHARES = 64  # of documents, in each of which equal windows are reduced first


def blocks_of(
    batches: Iterator[pa.RecordBatch], limit: int = WORD_LIMIT
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """doc_ids, hashes of texts, numbers of words and word hashes of documents, about ``limit`` words at a time."""
    hashes = WordHashes()
    ids: list[tuple[int, int]] = []
    words: list[np.ndarray] = []
    held = 0

    def block() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        numbers, texts = np.array(ids, np.int64).T
        return numbers, texts, np.array([len(w) for w in words], np.int64), np.concatenate(words)

    for rows in batches:
        numbers, marks = rows.column(0).to_pylist(), rows.column(2).to_pylist()
        for start in range(0, rows.num_rows, 100):
            texts = encoded_texts(rows.column(1).slice(start, 100))
            for number, mark, text in zip(numbers[start : start + 100], marks[start : start + 100], texts):
                split = text.split()  # by ASCII white space
                ids.append((number, mark))
                words.append(np.fromiter(map(hashes.__getitem__, split), np.uint64, len(split)))
                held += len(split)
                if held >= limit:
                    yield block()
                    ids, words, held = [], [], 0
    if ids:
        yield block()


def anchors_of(runs: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """For each window the place of the lowest run hash in it, the leftmost of equals.

    ``runs`` are the hashes of runs of ``anchor`` words; a window holds window - anchor + 1 of them.
    """
    span = window - anchor + 1
    n = len(runs) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low, at, width = runs, np.arange(len(runs)), 1
    while width < span:  # lowest of ever wider ranges
        step = min(width, span - width)
        left, right = low[:-step], low[step:]
        take = right < left
        low = np.where(take, right, left)
        at = np.where(take, at[step:], at[:-step])
        width += step
    return at[:n]


class Block:
    """The windows of a block of documents, as flat arrays."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, flat: np.ndarray, window: int, anchor: int):
        starts = np.cumsum(lengths) - lengths
        per_doc = np.maximum(lengths - window + 1, 0)
        self.document = np.repeat(np.arange(len(ids)), per_doc)
        self.place = np.arange(len(self.document)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        flat_place = starts[self.document] + self.place
        runs = run_hashes(flat, anchor)
        at = anchors_of(runs, window, anchor)[flat_place] if len(flat_place) else flat_place
        self.anchor = runs[at] if len(at) else np.zeros(0, np.uint64)
        self.at = at  # flat place of the anchor: windows of equal anchor place share an anchor occurrence
        self.window = run_hashes(flat, window)[flat_place] if len(flat_place) else np.zeros(0, np.uint64)

    def anchor_occurrences(self) -> np.ndarray:
        """The anchors' hashes, once for each place."""
        new = np.r_[True, self.at[1:] != self.at[:-1]] if len(self.at) else np.zeros(0, bool)
        return self.anchor[new]


def cells_of(anchors: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of each anchor in a row of the sketch."""
    seed = np.uint64((row + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (mix64(anchors + seed) >> np.uint64(64 - bits)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    """Documents that can be compared, with a hash that tells apart the texts of one doc_id."""
    texts = docs.filter("doc_id IS NOT NULL").selectExpr("CAST(doc_id AS long) AS doc_id", "text")
    return texts.withColumn("mark", F.xxhash64("text"))


def sketch_bits(docs: DataFrame) -> int:
    """Cells per row, as a power of two, for about ``CELLS_PER_ANCHOR`` cells an anchor; at most ``MAX_BITS``."""
    letters = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    anchors = letters / 6 * 2 / (WINDOW - ANCHOR + 2)
    return int(np.clip(np.ceil(np.log2(max(anchors * CELLS_PER_ANCHOR, 1))), MIN_BITS, MAX_BITS))


_SKETCH = pa.schema([("row", pa.int32()), ("shard", pa.int32()), ("ones", pa.binary()), ("twos", pa.binary())])
_MERGED = pa.schema([("row", pa.int32()), ("shard", pa.int32()), ("bits", pa.binary())])


def repeated_cells(docs: DataFrame, bits: int, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """The merged sketch: row, shard, and one bit a cell, set where the count is two or more."""
    shard_bits = min(bits, SHARD_BITS)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, lengths, flat in blocks_of(batches):
            found = Block(ids, lengths, flat, window, anchor).anchor_occurrences()
            if not len(found):
                continue
            for row in range(DEPTH):
                cells, counts = np.unique(cells_of(found, row, bits), return_counts=True)
                shards, firsts = np.unique(cells >> shard_bits, return_index=True)
                inner = (cells & ((1 << shard_bits) - 1)).astype("<u4")
                parts = list(zip(np.split(inner, firsts[1:]), np.split(counts == 1, firsts[1:])))
                yield batch(
                    _SKETCH,
                    [row] * len(shards),
                    shards,
                    [part[once].tobytes() for part, once in parts],
                    [part[~once].tobytes() for part, once in parts],
                )

    def merge(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counters of one shard, all partitions taken in one after the other."""
        counts = np.zeros(1 << shard_bits, np.uint8)
        for rows in parts:
            for ones, twos in zip(rows.column("ones"), rows.column("twos")):
                cells = np.frombuffer(ones.as_buffer(), "<u4")  # each cell once
                counts[cells] = np.minimum(counts[cells] + 1, 2)
                counts[np.frombuffer(twos.as_buffer(), "<u4")] = 2
        yield batch(_MERGED, [key[0].as_py()], [key[1].as_py()], [np.packbits(counts == 2).tobytes()])

    sketches = _texts(docs).mapInArrow(sketch, "row int, shard int, ones binary, twos binary")
    return sketches.groupBy("row", "shard").applyInArrow(merge, "row int, shard int, bits binary")


def collected_sketch(cells: DataFrame, bits: int) -> np.ndarray:
    """The merged sketch as bytes; its size is DEPTH * 2^bits / 8, at most 128 MB."""
    sketch = np.zeros((DEPTH, 1 << max(bits - 3, 0)), np.uint8)
    part = 1 << (min(bits, SHARD_BITS) - 3)
    for r in cells.collect():
        sketch[r["row"], r["shard"] * part : (r["shard"] + 1) * part] = np.frombuffer(r["bits"], np.uint8)
    return sketch


def estimated_repeated(anchors: np.ndarray, sketch: np.ndarray, bits: int) -> np.ndarray:
    found = np.ones(len(anchors), bool)
    for row in range(DEPTH):
        cell = cells_of(anchors, row, bits)
        found &= (sketch[row, cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    return found


def _runs(document: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds in the arrays of stretches of consecutive places of one document."""
    if not len(place):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.r_[True, (np.diff(place) != 1) | (np.diff(document) != 0)]
    starts = np.flatnonzero(new)
    return starts, np.r_[starts[1:], len(place)]


_PART = pa.schema(
    [(name, pa.int64()) for name in ("deal", "anchor", "doc_id", "mark", "first", "last")] + [("windows", pa.binary())]
)
_PART_DDL = "deal long, anchor long, doc_id long, mark long, first long, last long, windows binary"


def _lowest_by(keys: tuple[np.ndarray, ...], value: np.ndarray) -> np.ndarray:
    """For each element the lowest value among those with equal keys."""
    order = np.lexsort((value, *keys))
    new = np.r_[True, np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)]
    group = np.cumsum(new) - 1
    lowest = np.empty(len(value), value.dtype)
    lowest[order] = value[order][np.flatnonzero(new)][group]
    return lowest


def _grouped(batches: Iterator[pa.RecordBatch], survivors: bool = False) -> Iterator[pa.RecordBatch]:
    """Later windows of rows sorted by ``deal``, a bounded number of its values at a time.

    With ``survivors`` the rows of the smallest documents come out too, as they are.
    """
    held: list[pa.RecordBatch] = []
    for rows in batches:
        deal = rows.column(0).to_numpy()
        cut = int(np.searchsorted(deal, deal[-1])) if len(deal) else 0
        if cut:  # the last value may go on in the next batch
            yield from _later_windows([*held, rows.slice(0, cut)], survivors)
            held = [rows.slice(cut)]
        else:
            held.append(rows)
    if held:
        yield from _later_windows(held, survivors)


def _spread(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and hash of every window of some rows.

    A row holds consecutive windows from ``first`` to ``last``, or with ``first`` = -1 one
    window and then its places.
    """
    firsts, lasts = rows.column(4).to_numpy(), rows.column(5).to_numpy()
    data = np.frombuffer(b"".join(rows.column(6).to_pylist()), "<u8")
    one = firsts < 0  # ``last`` tells how many places there are
    lengths = np.where(one, lasts, lasts - firsts + 1)
    held = lengths + one
    begins = np.cumsum(held) - held
    row = np.repeat(np.arange(len(firsts)), lengths)
    within = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = begins[row] + np.where(one[row], 0, within)
    place = firsts[row] + within
    packed = one[row]
    place[packed] = data[begins[row[packed]] + 1 + within[packed]].astype(np.int64)
    return row, place, data[at]


def _later_windows(parts: list[pa.RecordBatch], survivors: bool) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(parts).combine_chunks()
    if not rows.num_rows:
        return
    anchors, numbers, marks = (rows.column(i).to_numpy() for i in (1, 2, 3))
    row, place, windows = _spread(rows)
    later = numbers[row] > _lowest_by((windows, anchors[row]), numbers[row])
    if later.any():
        found, spot = row[later], place[later]
        starts, ends = _runs(found, spot)
        n, of = len(starts), found[starts]
        yield batch(
            _PART, [0] * n, [0] * n, numbers[of], marks[of], spot[starts], spot[ends - 1], pa.nulls(n, pa.binary())
        )
    if survivors:  # rows of one window each
        stays = np.ones(rows.num_rows, bool)
        stays[row[later]] = False
        yield from rows.filter(pa.array(stays)).to_batches()


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each window of a document, dealt by the window, with all its places."""
    for rows in batches:
        if not rows.num_rows:
            continue
        row, place, windows = _spread(rows)
        anchors, numbers, marks = (rows.column(i).to_numpy()[row] for i in (1, 2, 3))
        order = np.lexsort((place, marks, numbers, anchors, windows))
        keys = [k[order] for k in (windows, anchors, numbers, marks)]
        starts = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)])
        ends = np.r_[starts[1:], len(order)]
        windows, anchors, numbers, marks = (k[starts] for k in keys)
        data, spots = windows.astype("<u8").tobytes(), place[order].astype("<i8").tobytes()
        bounds = zip(range(0, len(data), 8), (8 * starts).tolist(), (8 * ends).tolist())
        yield batch(
            _PART,
            windows.view(np.int64),
            anchors,
            numbers,
            marks,
            [-1] * len(starts),
            ends - starts,
            [data[i : i + 8] + spots[a:b] for i, a, b in bounds],
        )


def _by_window(waiting: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to be grouped by ``deal``, and stretches that are known already: heavy anchors are dealt by window.

    There are at most ``HEAVY_SHARE`` heavy anchors, whatever the number of rows.
    """
    total = waiting.count()
    most = max(HEAVY_ROWS, total // HEAVY_SHARE)
    counted = waiting.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > most)
    heavy = [r["anchor"] for r in counted.collect()]
    if not heavy:
        return waiting, waiting.filter(F.lit(False))
    is_heavy = F.col("anchor").isin(heavy)
    singles = waiting.filter(is_heavy).mapInArrow(_single_windows, _PART_DDL)
    share = F.pmod(F.xxhash64("doc_id", "mark"), F.lit(SHARES))
    dealt = singles.repartition("deal", share).sortWithinPartitions("deal")
    reduced = stored(dealt.mapInArrow(lambda rows: _grouped(rows, True), _PART_DDL), "heavy-windows")
    left = waiting.filter(~is_heavy).unionByName(reduced.filter("windows IS NOT NULL"))
    return left, reduced.filter("windows IS NULL")


def repeated_stretches(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, mark (of its text), first and last: stretches of windows that also start in a smaller document.

    Stretches of a document may touch or overlap. ``last`` is the start of the last window.
    """
    bits = sketch_bits(docs)
    sketch = docs.sparkSession.sparkContext.broadcast(
        collected_sketch(repeated_cells(docs, bits, window, anchor), bits)
    )

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stretches known to repeat have windows NULL; the others wait for their group."""
        for ids, texts, lengths, flat in blocks_of(batches):
            block = Block(ids, lengths, flat, window, anchor)
            at = np.flatnonzero(estimated_repeated(block.anchor, sketch.value, bits))
            if not len(at):
                continue
            document, place = block.document[at], block.place[at]
            number, mark, anchors, windows = ids[document], texts[document], block.anchor[at], block.window[at]
            later = number > _lowest_by((windows, anchors), number)
            starts, ends = _runs(document[later], place[later])
            firsts, lasts = place[later][starts], place[later][ends - 1]
            if len(starts):
                n = len(starts)
                yield batch(
                    _PART, [0] * n, [0] * n, number[later][starts], mark[later][starts], firsts, lasts,
                    pa.nulls(n, pa.binary()),
                )
            document, place, number, mark, anchors, windows, spot = (
                x[~later] for x in (document, place, number, mark, anchors, windows, block.at[at])
            )
            if not len(place):
                continue
            new = np.r_[True, (np.diff(place) != 1) | (np.diff(document) != 0) | (np.diff(spot) != 0)]
            starts = np.flatnonzero(new)
            ends = np.r_[starts[1:], len(place)]
            data = windows.astype("<u8").tobytes()
            yield batch(
                _PART,
                anchors[starts].view(np.int64),
                anchors[starts].view(np.int64),
                number[starts],
                mark[starts],
                place[starts],
                place[ends - 1],
                [data[8 * a : 8 * b] for a, b in zip(starts.tolist(), ends.tolist())],
            )

    found = stored(_texts(docs).mapInArrow(candidates, _PART_DDL), "repeated-windows")
    known = found.filter("windows IS NULL")
    waiting, known_by_window = _by_window(found.filter("windows IS NOT NULL"))
    dealt = waiting.repartition("deal").sortWithinPartitions("deal")
    every = known.unionByName(known_by_window).unionByName(dealt.mapInArrow(_grouped, _PART_DDL))
    return every.select("doc_id", "mark", "first", "last")


KEPT = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "n_words", "n_removed")]
    + [(name, pa.string()) for name in ("kept_sha256", "kept")]
)


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, with_text: bool = False) -> DataFrame:
    """Each document without the words of windows that also start in a smaller document.

    Words are runs of characters other than ASCII white space. Returns doc_id, n_words,
    n_removed and the digest of the kept words joined by blanks; ``with_text`` adds them as
    ``kept``. One row per input row. Rows that share a doc_id, with one text or several, are
    each judged, and never against each other, since neither is smaller. A row with a NULL doc_id has no order:
    it is kept whole and removes nothing. NULL, empty and short texts lose nothing. Other
    columns are ignored.
    """
    stretches = (
        repeated_stretches(docs, window, anchor)
        .groupBy("doc_id", "mark")
        .agg(F.collect_set(F.struct("first", "last")).alias("stretches"))
    )
    schema = KEPT if with_text else pa.schema(list(KEPT)[:-1])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rows in (whole.slice(i, 500) for i in range(0, whole.num_rows, 500)):
                texts, n_words, n_removed = [], [], []
                for text, found in zip(encoded_texts(rows.column(1)), rows.column(2).to_pylist()):
                    words = text.split()
                    gone = np.zeros(len(words) + 1, np.int64)
                    for s in found or ():
                        gone[s["first"]] += 1
                        gone[s["last"] + window] -= 1
                    stays = np.cumsum(gone)[:-1] == 0
                    kept = words if stays.all() else [w for w, stay in zip(words, stays.tolist()) if stay]
                    texts.append(b" ".join(kept))
                    n_words.append(len(words))
                    n_removed.append(len(words) - len(kept))
                columns = [rows.column(0), n_words, n_removed, [sha256_hex(t) for t in texts]]
                yield batch(schema, *columns, *([[t.decode() for t in texts]] if with_text else []))

    texts = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").withColumn("mark", F.xxhash64("text"))
    ddl = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else "")
    return texts.join(stretches, ["doc_id", "mark"], "left").select("doc_id", "text", "stretches").mapInArrow(keep, ddl)
