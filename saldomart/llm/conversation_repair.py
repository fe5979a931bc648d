"""Repair of damaged conversations by the cheapest edits, found by iterative-deepening A*.

A repaired conversation reads, by the first letters of its roles, ``(s?(ua)+)?``. The search
goes through the messages in order, tries the edits Delete, Insert, Keep, Rerole in that
order, the order of their letters, and gives up where the cost so far and the least that must
follow exceed a bound; the bound then rises to the smallest cost that exceeded it. A table holds, for
each failed state (next message, end of the text so far), what it costs from there at least.
The first path that is accepted is the cheapest, and of equals the one least in letters.

Conversations go to tasks by ranges of conversation and turn. One that lies in one task and
is short is searched as a whole. One that is cut by a range's end, or long, is taken apart into blocks:
each is searched from every end to every end of the text so far, and blocks are joined like
links of a chain. So a conversation of any length is searched in many tasks; only its edits'
letters and, for the digest, its text as a stream come together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saldomart.llm.common import batch, stored

BLOCK = 64  # messages searched at once
_HEAD = 32  # characters of a text that order messages of one turn, before a hash does
_ROWS = 2000
_MOST = (1 << 63) - 1

# What counts as blank, ends of a sentence, costs.
BLANKS = " \t\n\v\f\r"
STOPS = ".!?"
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5

START, SYSTEM, USER, ASSISTANT = range(4)  # how the repaired text ends so far
ACCEPTED = (START, ASSISTANT)
_NEXT = (USER, USER, ASSISTANT, USER)  # after a message that may be chosen
_KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}

Message = tuple[str, bool, bool]  # first letter of the role, must be deleted, ends without a stop


def damaged(conversations: DataFrame) -> DataFrame:
    """Messages (conv_id, turn, role, text, gone) damaged by crc32('conv_id:turn') % 20.

    0 drops a message (it stays as a row with ``gone``), 1 empties the text, 2 takes its
    stops away, 3 repeats it, 4 makes it the user's. A NULL is one blank, but in turn and
    conv_id it stays NULL.
    """

    def text_of(name: str) -> F.Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    role = F.when(fault == 4, "user").otherwise(text_of("role"))
    text = F.when(fault == 1, "").when(fault == 2, F.translate(text_of("text"), STOPS, "")).otherwise(text_of("text"))
    gone = fault == 0
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(~gone, role).alias("role"),
        F.when(~gone, text).alias("text"),
        gone.alias("gone"),
        F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


# Search


def cheapest(messages: list[Message], start: int, ends: Iterable[int]) -> tuple[int, str]:
    """Cost and letters of the cheapest edits from ``start`` to one of ``ends``, of equals the least letters.

    One of the ends must be within reach.
    """
    n, ends = len(messages), set(ends)
    free, bound_to = [0] * (n + 1), [0] * (n + 1)  # least costs of the rest, with and without a system message kept
    for i in range(n - 1, -1, -1):
        letter, forced, truncated = messages[i]
        least = DELETE if forced or truncated else 0 if letter in ("s", "u", "a") else REROLE
        free[i] = free[i + 1] + least
        bound_to[i] = bound_to[i + 1] + (REROLE if least == 0 and letter == "s" else least)
    known: dict[tuple[int, int], int] = {}
    letters: list[str] = []

    def visit(i: int, state: int, budget: int) -> int:
        """-1 if an end was reached within the budget, else what reaching one costs at least."""
        least = known.get((i, state))
        if least is None:
            least = free[i] if state == START else bound_to[i]
        if least > budget:
            return least
        if i == n and state in ends:
            return -1
        found = _MOST
        for letter, cost, following, at in edits(i, state):
            rest = visit(following, at, budget - cost)
            if rest < 0:
                letters.append(letter)
                return -1
            found = min(found, cost + rest)
        known[i, state] = found
        return found

    def edits(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        if i < n:
            yield "D", DELETE, i + 1, state
        yield "I", INSERT, i, _NEXT[state]
        if i < n and not messages[i][1]:
            more = TRUNCATED if messages[i][2] else 0
            kept = _KEEP.get((state, messages[i][0]))
            if kept is not None:
                yield "K", more, i + 1, kept
            yield "R", REROLE + more, i + 1, _NEXT[state]

    bound = 0
    while (least := visit(0, start, bound)) >= 0:
        bound = least
    return bound, "".join(reversed(letters))


def _within_reach(messages: list[Message], start: int, end: int) -> bool:
    if end == SYSTEM and start == START:
        return any(letter == "s" and not forced for letter, forced, _ in messages)
    return end == start or end in (USER, ASSISTANT)


Legs = dict[tuple[int, int], tuple[int, str]]  # by first and last state: cost and letters


def block_legs(messages: list[Message]) -> Legs:
    """The cheapest edits of a block from each state to each state within reach."""
    pairs = [(p, q) for p in range(4) for q in range(4) if _within_reach(messages, p, q)]
    return {(p, q): cheapest(messages, p, [q]) for p, q in pairs}


def joined_legs(one: Legs, other: Legs) -> Legs:
    """Two blocks as one. Edits of equal cost between the same states never begin with one another."""
    found: Legs = {}
    for (p, q), (cost, letters) in one.items():
        for r in range(4):
            if (q, r) in other:
                whole = cost + other[q, r][0], letters + other[q, r][1]
                if (p, r) not in found or whole < found[p, r]:
                    found[p, r] = whole
    return found


def repaired(roles: list[str], texts: list[str], letters: str, state: int) -> tuple[list[str], int]:
    """The messages that edits leave, as ``role:text``, and the state behind them."""
    lines, i = [], 0
    for letter in letters:
        if letter == "I":
            state = _NEXT[state]
            lines.append(f"{_ROLE[state]}:")
            continue
        if letter == "K":
            state = _KEEP[state, roles[i][:1]]
            lines.append(f"{roles[i]}:{texts[i]}")
        elif letter == "R":
            state = _NEXT[state]
            lines.append(f"{_ROLE[state]}:{texts[i]}")
        i += 1
    return lines, state


def state_after(initials: list[str], letters: str, state: int) -> int:
    return repaired(initials, [""] * len(initials), letters, state)[1]


def letters_by_block(letters: str, sizes: list[int]) -> list[str]:
    """The edits of each block: inserted messages belong to the next message, the last ones to the last block."""
    parts, at = [], 0
    for size in sizes:
        begin, left = at, size
        while left:
            left -= letters[at] != "I"
            at += 1
        parts.append(letters[begin:at])
    parts[-1] += letters[at:]
    return parts


def is_blank(text: str) -> bool:
    return not text.strip(BLANKS)


def is_truncated(text: str) -> bool:
    return text.rstrip(BLANKS)[-1:] not in tuple(STOPS)


def _judged(rows: list[tuple], repeats: list[bool]) -> tuple[list[Message], list[int]]:
    """Messages for the search, and how many are blank, duplicate, truncated. Rows are (turn, role, text)."""
    messages, counts = [], [0, 0, 0]
    for (_, role, text), repeat in zip(rows, repeats):
        fault = 0 if is_blank(text) else 1 if repeat else 2 if is_truncated(text) else None
        if fault is not None:
            counts[fault] += 1
        messages.append((role[:1], fault in (0, 1), fault == 2))
    return messages, counts


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))


def _gaps(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else min(high - low + 1 - distinct, _MOST)


def _digest(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def repair(rows: list[tuple]) -> tuple:
    """What ``repair_conversations`` returns of one whole conversation of rows (turn, role, text)."""
    seen: set[tuple] = set()
    repeats = []
    for _, role, text in rows:
        repeats.append((role, text) in seen)
        seen.add((role, text))
    messages, counts = _judged(rows, repeats)
    turns = [turn for turn, _, _ in rows if turn is not None]
    cost, letters = cheapest(messages, START, ACCEPTED)
    lines, _ = repaired([r for _, r, _ in rows], [t for _, _, t in rows], letters, START)
    gaps = _gaps(min(turns, default=None), max(turns, default=None), len(set(turns)))
    return gaps, *counts, _illegal([m[0] for m in messages]), cost, letters, _digest(lines)


# Conversations of a task

_RESULT = {
    "gaps": "long",
    "blank": "long",
    "duplicate": "long",
    "truncated": "long",
    "illegal": "long",
    "cost": "long",
    "audit": "string",
    "repaired_sha256": "string",
}
_MESSAGE = {"turn": "long", "role": "string", "text": "string", "gone": "boolean", "pos": "long", "seen": "boolean"}
_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
}


def _schema(columns: dict[str, str]) -> tuple[pa.Schema, str]:
    return pa.schema([(c, _ARROW[t]) for c, t in columns.items()]), ", ".join(f"{c} {t}" for c, t in columns.items())


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) >= _ROWS:
            yield batch(schema, *zip(*block))
            block = []
    if block:
        yield batch(schema, *zip(*block))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for whole in batches:
        for rows in (whole.slice(i, _ROWS) for i in range(0, whole.num_rows, _ROWS)):
            yield from zip(*[column.to_pylist() for column in rows.columns])


_FIRST, _FIRST_DDL = _schema({"conv_id": "long", "open": "boolean", **_RESULT, **_MESSAGE})


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's ordered messages: a result for each conversation that is short and surely whole.

    The first and the last conversation of a task may go on in another. Their messages, and
    those of long ones, come out as they are, marked where role and text were seen in the task.
    """

    def passed() -> Iterator[tuple]:
        current, rows, cut, live = None, None, True, 0
        seen: set[bytes] = set()

        def opened(row: tuple) -> tuple:
            conv_id, turn, role, text, gone, pos = row
            mark = b"" if gone else hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
            again = mark in seen
            if not gone:
                seen.add(mark)
            return conv_id, True, *[None] * len(_RESULT), turn, role, text, gone, pos, again

        for row in _rows(batches):
            if rows is None or row[0] != current:
                if rows is not None:
                    if cut:
                        yield from map(opened, rows)
                    else:
                        result = repair([r[1:4] for r in rows if not r[4]])
                        yield current, False, *result, *[None] * len(_MESSAGE)
                    cut = False
                current, rows, live = row[0], [], 0
                seen.clear()
            if cut and live > BLOCK:
                yield opened(row)
                continue
            if not row[4] or not rows:  # one message that is gone keeps the conversation, no more are needed
                rows.append(row)
                live += 1
            if live > BLOCK:
                cut = True
                yield from map(opened, rows)
                rows = []
        yield from map(opened, rows or [])

    return _batches(passed(), _FIRST)


# Conversations of several tasks

_BLOCKS, _BLOCKS_DDL = _schema(
    {
        "conv_id": "long",
        "block": "long",
        "low": "long",
        "high": "long",
        "distinct": "long",
        "blank": "long",
        "duplicate": "long",
        "truncated": "long",
        "illegal": "long",
        "initials": "array<string>",
        "legs": "array<int>",
        "letters": "array<string>",
        "roles": "array<string>",
        "texts": "array<string>",
    }
)
_COMPACT = _BLOCKS.names[:-2]


def _grouped(rows: Iterator[tuple], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows that follow each other and share their first columns."""
    key, group = None, []
    for row in rows:
        if group and row[:width] != key:
            yield key, group
            group = []
        key = row[:width]
        group.append(row)
    if group:
        yield key, group


def _block_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def blocks() -> Iterator[tuple]:
        for key, group in _grouped(_rows(batches), 2):
            messages, counts = _judged([r[3:6] for r in group], [r[6] for r in group])
            turns = [r[3] for r in group if r[3] is not None]
            legs = block_legs(messages)
            initials = [m[0] for m in messages]
            places = [x for (p, q), (cost, _) in legs.items() for x in (p, q, cost)]
            letters = [text for _, text in legs.values()]
            ends = min(turns, default=None), max(turns, default=None), len(set(turns))
            roles, texts = [r[4] for r in group], [r[5] for r in group]
            yield *key, *ends, *counts, _illegal(initials), initials, places, letters, roles, texts

    return _batches(blocks(), _BLOCKS)


_JOINED, _JOINED_DDL = _schema(
    {"conv_id": "long", "block": "long", "state": "int", "letters": "string"}
    | {c: t for c, t in _RESULT.items() if c != "repaired_sha256"}
)


def _join_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each conversation a row of results (block NULL), and for each of its blocks the edits."""

    def joined() -> Iterator[tuple]:
        for (conv_id,), group in _grouped(_rows(batches), 1):
            chain: list[tuple[int, Legs]] = []  # neighbours of one size are joined, so letters are copied log n times
            counts, low, high, distinct, last = [0] * 4, None, None, 0, None
            for _, _, first, end, n, *some, initials, places, letters in group:
                triples = zip(places[::3], places[1::3], places[2::3], letters)
                legs, size = {(p, q): (cost, text) for p, q, cost, text in triples}, 1
                while chain and chain[-1][0] == size:
                    legs, size = joined_legs(chain.pop()[1], legs), 2 * size
                chain.append((size, legs))
                counts = [a + b for a, b in zip(counts, some)]
                if last is not None:
                    counts[3] += _illegal([last, initials[0]])
                last = initials[-1]
                if first is not None:
                    distinct += n - (first == high)
                    low, high = first if low is None else low, end
            whole = chain.pop()[1]
            while chain:
                whole = joined_legs(chain.pop()[1], whole)
            cost, letters = min(whole[START, end] for end in ACCEPTED if (START, end) in whole)
            yield conv_id, None, None, None, _gaps(low, high, distinct), *counts, cost, letters
            state = START
            for row, part in zip(group, letters_by_block(letters, [len(r[9]) for r in group])):
                yield conv_id, row[1], state, part, *[None] * 7
                state = state_after(row[9], part, state)

    return _batches(joined(), _JOINED)


_PIECES, _PIECES_DDL = _schema({"conv_id": "long", "block": "long", "piece": "string"})


def _piece_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pieces() -> Iterator[tuple]:
        for conv_id, block, roles, texts, letters, state in _rows(batches):
            lines, _ = repaired(roles, texts, letters, state)
            yield conv_id, block, "\n".join(lines) if lines else None

    return _batches(pieces(), _PIECES)


_DIGESTS, _DIGESTS_DDL = _schema({"of_conv": "long", "repaired_sha256": "string"})


def _digest_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each conversation, its pieces read as a stream."""

    def digests() -> Iterator[tuple]:
        state, current, begun = None, None, False
        for conv_id, _, piece in _rows(batches):
            if state is None or conv_id != current:
                if state is not None:
                    yield current, state.hexdigest()
                state, current, begun = hashlib.sha256(), conv_id, False
            if piece is not None:
                state.update((b"\n" if begun else b"") + piece.encode())
                begun = True
        if state is not None:
            yield current, state.hexdigest()

    return _batches(digests(), _DIGESTS)


def _taken_apart(messages: DataFrame) -> DataFrame:
    """Results of conversations whose messages come from several tasks, or are many."""
    live = messages.filter(~F.col("gone"))
    mark = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    # A task sent the first of equal messages as not seen: a window has a row for a task.
    first = F.min("pos").over(Window.partitionBy("conv_id", mark))
    fresh = live.filter(~F.col("seen")).withColumn("repeat", F.col("pos") > first)
    marked = fresh.unionByName(live.filter("seen").withColumn("repeat", F.lit(True)))
    in_blocks = marked.select(
        "conv_id", F.floor(F.col("pos") / BLOCK).alias("block"), "pos", "turn", "role", "text", "repeat"
    )
    dealt = in_blocks.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "pos")
    blocks = stored(dealt.mapInArrow(_block_pass, _BLOCKS_DDL), "conversation-blocks")
    chains = blocks.select(*_COMPACT).repartition("conv_id").sortWithinPartitions("conv_id", "block")
    joined = stored(chains.mapInArrow(_join_pass, _JOINED_DDL), "conversation-edits")
    edits = joined.filter("block IS NOT NULL").select(
        F.col("conv_id").alias("of_conv"), F.col("block").alias("of_block"), "letters", "state"
    )
    same = F.col("conv_id").eqNullSafe(F.col("of_conv"))
    pieces = (
        blocks.select("conv_id", "block", "roles", "texts")
        .join(edits, same & (F.col("block") == F.col("of_block")))
        .select("conv_id", "block", "roles", "texts", "letters", "state")
        .mapInArrow(_piece_pass, _PIECES_DDL)
    )
    digests = (
        pieces.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_digest_pass, _DIGESTS_DDL)
    )
    counted = joined.filter("block IS NULL").drop("block", "state", "letters").join(digests, same).drop("conv_id")
    nothing = dict(zip(_RESULT, repair([])))
    results = [F.coalesce(F.col(c), F.lit(nothing[c])).alias(c) for c in _RESULT]
    return messages.select("conv_id").distinct().join(counted, same, "left").select("conv_id", *results)


def repair_damaged(messages: DataFrame) -> DataFrame:
    """Faults and cheapest repair of conversations of messages (conv_id, turn, role, text, gone).

    Messages of one turn lie in the order of role, beginning and hash of the text; a NULL
    turn comes first. See ``repair_conversations`` for the columns.
    """
    keyed = messages.withColumns({"head": F.substring("text", 1, _HEAD), "hash": F.xxhash64("text")})
    order = ["conv_id", "turn", "role", "head", "hash"]
    place = F.monotonically_increasing_id()  # lets equal messages, if they are many, part
    dealt = keyed.repartitionByRange(*order, place).sortWithinPartitions(*order)
    in_order = dealt.select("conv_id", "turn", "role", "text", "gone", place.alias("pos"))
    first = stored(in_order.mapInArrow(_first_pass, _FIRST_DDL), "conversations")
    whole = first.filter(~F.col("open")).select("conv_id", *_RESULT)
    return whole.unionByName(_taken_apart(first.filter("open").select("conv_id", *_MESSAGE)))


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """Damage conversations by the rule of ``damaged`` and repair them.

    Returns a row for each conv_id: gaps between the turns, how many messages are blank,
    duplicate or truncated (the first of these counts), how many neighbours have roles in an
    illegal order, cost and letters (audit) of the cheapest edits, digest of the repaired
    messages. Rows without conv_id are one conversation; a conversation that lost all
    messages has zeros, no letters and the digest of an empty text; repeated rows are
    duplicates of each other. An empty table has no rows. Other columns are ignored.
    """
    return repair_damaged(damaged(conversations))
