"""Conversation repair against every sequence of edits, and conversations cut into blocks."""

import hashlib
import heapq
import re
import zlib
from itertools import groupby

import numpy as np
import pytest
from saldomart.llm import conversation_repair as repairing
from saldomart.llm.conversation_repair import (
    ACCEPTED,
    START,
    block_legs,
    cheapest,
    damaged,
    joined_legs,
    letters_by_block,
    repair_conversations,
    repair_damaged,
)

SCHEMA = "conv_id long, turn long, role string, text string, gone int, pos long, block string"
GOAL = re.compile(r"(s?(ua)+)?")


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 5, "clash") for r in rows], SCHEMA)


def _cheapest_plainly(messages):
    """Edits in order of cost and letters, taken from a queue until one gives a legal order of roles."""
    queue = [(0, "", 0, "")]
    while queue:
        cost, letters, i, made = heapq.heappop(queue)
        if i == len(messages) and GOAL.fullmatch(made):
            return cost, letters
        if not re.fullmatch(r"(s?(ua)*u?)?", made):
            continue
        for role in "ua":
            heapq.heappush(queue, (cost + 5, letters + "I", i, made + role))
        if i < len(messages):
            letter, forced, truncated = messages[i]
            heapq.heappush(queue, (cost + 2, letters + "D", i + 1, made))
            if not forced:
                heapq.heappush(queue, (cost + 5 * truncated, letters + "K", i + 1, made + (letter if letter in "sua" and letter else "x")))
                for role in "ua":
                    heapq.heappush(queue, (cost + 1 + 5 * truncated, letters + "R", i + 1, made + role))


def _plainly(rows):
    """All results by conv_id, from the rules as they are written."""
    found = {conv_id: [] for conv_id, *_ in rows}
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        found[conv_id] += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return {conv_id: _one(messages) for conv_id, messages in found.items()}


def _one(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32]))
    messages, counts = [], [0, 0, 0]
    for i, (_, role, text) in enumerate(rows):
        ends = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = 0 if not ends else 1 if (role, text) in [r[1:] for r in rows[:i]] else 2 if ends[-1] not in ".!?" else 3
        counts = [c + (fault == k) for k, c in enumerate(counts)]
        messages.append((role[:1], fault < 2, fault == 2))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(messages, messages[1:]))
    cost, letters = _cheapest_plainly(messages)
    lines, i = [], 0
    for letter in letters:
        last = lines[-1][0] if lines else ""
        chosen = "assistant" if last == "u" else "user"
        if letter == "I":
            lines.append(f"{chosen}:")
            continue
        if letter != "D":
            lines.append(f"{rows[i][1] if letter == 'K' else chosen}:{rows[i][2]}")
        i += 1
    return gaps, *counts, illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def _random_messages(random, n):
    letters = ["s", "u", "a", "t", "", " "]
    weights = [0.1, 0.35, 0.35, 0.1, 0.05, 0.05]
    faults = random.choice(3, n, p=[0.6, 0.15, 0.25])
    return [(str(random.choice(letters, p=weights)), f == 1, f == 2) for f in faults]


def test_search_finds_the_cheapest_and_least():
    random = np.random.default_rng(1)
    for _ in range(400):
        messages = _random_messages(random, int(random.integers(0, 8)))
        assert cheapest(messages, START, ACCEPTED) == _cheapest_plainly(messages), messages


def test_blocks_join_to_the_whole():
    random = np.random.default_rng(2)
    for _ in range(200):
        messages = _random_messages(random, int(random.integers(2, 14)))
        cuts = sorted({0, len(messages), *random.integers(1, len(messages), 3).tolist()})
        legs = [block_legs(messages[a:b]) for a, b in zip(cuts, cuts[1:])]
        forward, backward = legs[0], legs[-1]
        for one in legs[1:]:
            forward = joined_legs(forward, one)
        for one in reversed(legs[:-1]):
            backward = joined_legs(one, backward)
        assert forward == backward
        assert min(forward[START, e] for e in ACCEPTED if (START, e) in forward) == cheapest(messages, START, ACCEPTED)


def test_edits_go_to_their_blocks():
    assert letters_by_block("IKDIIRI", [2, 1]) == ["IKD", "IIRI"] and letters_by_block("DDK", [1, 1, 1]) == ["D", "D", "K"]


def _conversations(random, count):
    roles, texts = ["user", "assistant", "system", "tool", "", None, "unknown"], ["One.", "Two!", "three", "four ", " ", "", None, "Five? \n", "é\x1c"]
    rows = []
    for conv_id in range(count):
        turns = random.permutation(14)[: int(random.integers(1, 9))]
        for turn in turns.tolist():
            role = roles[turn % 2] if random.random() < 0.7 else roles[int(random.integers(0, 7))]
            rows.append((conv_id, turn, role, texts[int(random.integers(0, 9))] if random.random() < 0.5 else f"Text {turn}."))
    return rows


CASES = [
    (None, 0, "user", "No number."), (None, None, None, None), (None, 2, "assistant", "Yes."),
    (-1, None, "user", "a."), (-1, None, "user", "a."), (-1, None, None, "b"),
    (-2, -5, "system", "x" * 30_000 + "."), (-2, 900, "user", "y"), (-2, 900, "assistant", "z."),
    (-3, 1, "unknown", "u."), (-3, 2, "agent", "a!"), (-4, -(1 << 63), "user", "low."), (-4, (1 << 63) - 1, "assistant", "high."),
]


@pytest.mark.parametrize("block", [1, 3, 64])
def test_equals_plain_version(spark, monkeypatch, block):
    """Small blocks take conversations apart within a task, many tasks do so across them."""
    monkeypatch.setattr(repairing, "BLOCK", block)
    rows = _conversations(np.random.default_rng(block), 60)
    rows += [c for c in CASES if c[0] != -4] + rows[:5]
    got = [tuple(r) for r in repair_conversations(_frame(spark, rows).repartition(4)).collect()]
    assert len(got) == len({r[0] for r in got})
    assert {r[0]: r[1:] for r in got} == _plainly(rows)


def test_a_long_conversation_over_many_tasks(spark):
    random = np.random.default_rng(9)
    roles = ["user", "assistant", "assistant", "system"]
    rows = [(7, i // 2, roles[int(random.integers(0, 4))], f"Text {int(random.integers(0, 2500))}{'.' if i % 5 else ''}") for i in range(3000)]
    rows += [(i, 0, "user", "Small.") for i in range(20, 60)] + [(6, 0, "user", "Same."), (8, 0, "user", "Same.")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = {r.conv_id: tuple(r)[1:] for r in repair_conversations(_frame(spark, rows)).collect()}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    messages = [tuple(r)[1:4] for r in damaged(_frame(spark, rows)).filter("conv_id = 7 AND NOT gone").collect()]
    messages.sort(key=lambda r: (r[0], r[1], r[2][:32]))
    legs, seen, judged, n_repeats = None, set(), [], 0
    for _, role, text in messages:
        repeat = text != "" and (role, text) in seen
        n_repeats += repeat
        seen.add((role, text))
        judged.append((role[:1], repeat or not text, not repeat and text[-1:] not in ("", ".")))
    for one in judged:  # a chain of single messages
        legs = block_legs([one]) if legs is None else joined_legs(legs, block_legs([one]))
    best = min(legs[START, e] for e in ACCEPTED)
    assert got[7][5:7] == best
    assert got[7][2] == n_repeats and got[7][3] == sum(m[2] for m in judged)
    lines, _ = repairing.repaired([r for _, r, _ in messages], [t for _, _, t in messages], best[1], START)
    assert got[7][7] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert GOAL.fullmatch("".join(k[0][0] for k in groupby(lines) for _ in k[1]))
    assert len(got) == 43


def test_conversations_that_lost_everything(spark):
    empty = hashlib.sha256(b"").hexdigest()
    rows = [(i, None, None, None, True) for i in (1, 2, 2, None)]
    found = repair_damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, gone boolean"))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr((i, 0, 0, 0, 0, 0, 0, "", empty)) for i in (1, 2, None))
    assert repair_conversations(_frame(spark, [])).collect() == []


def test_turns_too_far_apart(spark):
    found = repair_conversations(_frame(spark, [c for c in CASES if c[0] == -4])).collect()
    assert [r.gaps in (0, (1 << 63) - 1) for r in found] == [True]
