"""Repair of conversations against brute force."""

from __future__ import annotations

import hashlib
import heapq
import pathlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from martloom.llm import conversation_repair, registry
from martloom.llm.repair_paths import CHAT, Grammar, solve

FOLDER = "/root/testdata/sf0.01"
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
SCHEMA = "conv_id bigint, turn bigint, role string, text string, code int, audit string, first int"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def slow_edits(rows):
    """Cheapest (cost, audit, made) of rows (initial, fault) by a search of all edits."""
    heap, seen = [(0, "", 0, 0, "")], set()
    while True:
        cost, audit, i, state, made = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(rows) and state in (0, 3):
            return cost, audit, made
        for role, to in NEXT[state].items():
            if role != "s":
                heapq.heappush(heap, (cost + 2, audit + "I", i, to, made + role))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, made + "-"))
            extra = int(fault == "truncated")
            for role, to in NEXT[state].items() if fault not in ("blank", "duplicate") else ():
                if role == initial:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, to, made + "-"))
                if role != "s":
                    heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, to, made + role))


def slow_damage(rows):
    for conv, turn, role, text in rows:
        name = [" " if v is None else str(v) for v in (conv, turn)]
        rule = zlib.crc32(":".join(name).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if rule == 1:
            text = ""
        if rule == 2:
            text = re.sub("[.!?]", "", text)
        if rule == 4:
            role = "user"
        yield conv, [(turn, role, text)] * (0 if rule == 0 else 2 if rule == 3 else 1)


def slow_repair(rows):
    grouped = defaultdict(list)
    for conv, kept in slow_damage(rows):
        grouped[conv] += kept
    out = set()
    for conv, kept in grouped.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0], r[1], hashlib.md5(r[2].encode()).digest()))
        seen, coded = set(), []
        for _, role, text in kept:
            body = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else ""
            fault = fault or ("" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
            coded.append((role[:1], fault))
        cost, audit, made = slow_edits(coded)
        repaired, left = [], iter(kept)
        for edit, new in zip(audit, made, strict=True):
            given = {"u": "user", "a": "assistant"}.get(new)
            if edit == "I":
                repaired.append(f"{given}:")
                continue
            _, role, text = next(left)
            if edit != "D":
                repaired.append(f"{given or role}:{text}")
        turns = {t for t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        count = lambda f: sum(fault == f for _, fault in coded)
        roles = [initial for initial, _ in coded]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))
        digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        out.add((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, digest))
    return out


def repaired(spark, rows):
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    found = conversation_repair.repaired(conversation_repair.damaged(table))
    return [tuple(r[c] for c in COLUMNS) for r in found.collect()]


def test_edits_of_random_conversations():
    draw = random.Random(4)
    faults = ("", "blank", "truncated")
    made = [
        [(draw.choice("suax"), draw.choice(faults)) for _ in range(draw.randint(0, 11))] for _ in range(1500)
    ]
    codes = [["suax".index(r) * 4 + faults.index(f) for r, f in c] for c in made]
    found = solve(np.array([c for row in codes for c in row]), np.array([len(c) for c in codes]))
    assert list(zip(found.costs, found.audits, found.made, strict=True)) == [slow_edits(c) for c in made]


def test_ranks_choose_where_a_letter_leads_to_several_states():
    # either role may be made first: with assistant first, an inserted row spares nothing later
    loose = Grammar(
        3, 0, frozenset({0, 2}), {(0, 1): (1, 2), (1, 2): (2,), (2, 1): (1,), (0, 2): (2,)}, (1, 2)
    )
    draw = random.Random(9)

    def slow(rows):
        heap, seen = [(0, "", 0, 0)], set()
        while True:
            cost, audit, i, state = heapq.heappop(heap)
            if (cost, audit, i, state) in seen:
                continue
            seen.add((cost, audit, i, state))
            if i == len(rows) and state in loose.accepted:
                return cost, audit
            arcs = [(r, to) for (q, r), after in loose.steps.items() if q == state for to in after]
            for _, to in arcs:
                heapq.heappush(heap, (cost + 2, audit + "I", i, to))
            if i < len(rows):
                heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state))
                for r, to in arcs:
                    if r == rows[i]:
                        heapq.heappush(heap, (cost, audit + "K", i + 1, to))
                    heapq.heappush(heap, (cost + 2, audit + "R", i + 1, to))

    made = [[draw.randrange(4) for _ in range(draw.randint(0, 6))] for _ in range(60)]
    found = solve(np.array([c * 4 for row in made for c in row]), np.array([len(c) for c in made]), loose)
    assert list(zip(found.costs, found.audits, strict=True)) == [slow(c) for c in made]


def test_a_long_conversation_has_the_edits_of_its_pieces():
    piece = [4, 8, 8, 4, 13, 4, 8]
    one = solve(np.array(piece), np.array([len(piece)]))
    many = solve(np.array(piece * 3000), np.array([len(piece) * 3000]))
    assert many.audits[0] == one.audits[0] * 3000
    assert many.costs[0] == one.costs[0] * 3000
    assert CHAT.accepted == {0, 3}


def test_edges(spark):
    draw = random.Random(2)
    texts = ["Hello.", "Hello.", "no end", "", " \t", None, "é?", "x" * 200_000 + "!"]
    roles = ["system", "user", "assistant", "user", "assistant", None, "", "tool", "User"]
    rows = [
        (draw.choice([None, *range(40)]), draw.choice([None, *range(12)]), draw.choice(roles), draw.choice(texts))
        for _ in range(600)
    ]
    rows += [(99, t, "user" if t % 2 else "assistant", f"turn {t}.") for t in range(3000)] * 2
    found = repaired(spark, rows)
    assert len(found) == len(set(found))
    assert set(found) == slow_repair(rows)


def test_a_dropped_conversation_and_an_empty_table(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    assert repaired(spark, [(7, gone, "user", "Hi.")]) == [(7, 0, 0, 0, 0, 0, 0, "", nothing)]
    assert repaired(spark, []) == []


def test_ids_may_be_text_and_rows_undamaged(spark):
    rows = [("b", 1, "user", "Hi."), ("b", 2, "assistant", "Yes."), ("a", 1, "user", "Hi.")]
    table = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    found = conversation_repair.repaired(conversation_repair.undamaged(table)).collect()
    assert {(r["conv_id"], r["audit"], r["cost"]) for r in found} == {("b", "KK", 0), ("a", "KI", 2)}


@pytest.mark.skipif(not pathlib.Path(FOLDER).is_dir(), reason="no test tables")
def test_registered_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    found = registry.QUERIES["op11_conversation_repair"](spark, FOLDER).collect()
    assert {tuple(r[c] for c in COLUMNS) for r in found} == slow_repair([tuple(r) for r in rows])
