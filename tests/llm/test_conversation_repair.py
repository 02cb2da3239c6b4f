"""Audits equal a search over all edits; tables equal single steps; rows equal plain Python."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ticklake.llm import conversation_repair as repair
from ticklake.llm.conversation_repair import Tables


def searched(kinds):
    """Least (cost, letters) by Dijkstra over (row, state); ties by the letters, in full."""
    pattern = re.compile("(s?(ua)+)?")
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, letters, at, roles = heapq.heappop(heap)
        if at == len(kinds) and pattern.fullmatch(roles):
            return cost, letters
        state = (letters, at, roles)
        if state in done or not any(pattern.fullmatch(roles + tail) for tail in ("", "a", "ua", "uaua")):
            continue
        done.add(state)
        for role in "ua":
            heapq.heappush(heap, (cost + 5, letters + "I", at, roles + role))
        if at == len(kinds):
            continue
        kind = kinds[at]
        heapq.heappush(heap, (cost + 2, letters + "D", at + 1, roles))
        if kind != 8:
            extra = 5 * (kind >= 4)
            if kind % 4 < 3:
                heapq.heappush(heap, (cost + extra, letters + "K", at + 1, roles + "sua"[kind % 4]))
            for role in "ua":
                heapq.heappush(heap, (cost + 1 + extra, letters + "R", at + 1, roles + role))
    raise AssertionError


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 8), max_size=6))
def test_audits_equal_a_full_search(kinds):
    assert repair.tables().solve(bytes(kinds)) == searched(kinds)


@pytest.mark.parametrize("block", [1, 2, 3, 5])
def test_blocks_equal_rows(block):
    rng = random.Random(block)
    other = Tables(block)
    for size in [0, 1, 4, 9, 50, 401]:
        for _ in range(20):
            kinds = bytes(rng.choices(range(9), k=size))
            assert other.solve(kinds) == repair.tables().solve(kinds)


def test_few_vectors():
    assert len(repair.tables().vectors) < 100
    assert all(min(v) == 0 for v in repair.tables().vectors)


def plain(rows):
    """Every result from (conv_id, turn, role, text) rows, by the rules as they are told."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            fate = zlib.crc32(key.encode()) % 20
            role, text = role if role is not None else " ", text if text is not None else " "
            if fate == 1:
                text = ""
            if fate == 2:
                text = re.sub("[.!?]", "", text)
            if fate == 4:
                role = "user"
            kept += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        counts, kinds, seen = dict(blank=0, duplicate=0, truncated=0), [], set()
        for _, role, text in kept:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            truncated = bool(solid) and solid[-1] not in ".!?"
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if truncated else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            kinds.append(8 if fault in ("blank", "duplicate") else {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + 4 * (fault == "truncated"))
        roles = [r[1][:1] for r in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        turns = [r[0] for r in kept if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = repair.tables().solve(bytes(kinds))
        want = len(audit) - audit.count("D")
        texts, at = [], 0
        for letter in audit:
            role = "user" if (len(texts) - want % 2) % 2 == 0 else "assistant"
            if letter == "I":
                texts.append((role, ""))
                continue
            if letter != "D":
                texts.append((kept[at][1] if letter == "K" else role, kept[at][2]))
            at += 1
        joined = "\n".join(f"{r}:{t}" for r, t in texts)
        out[conv] = (
            gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
            hashlib.sha256(joined.encode()).hexdigest(), texts,
        )
    return out


def made():
    rng = random.Random(11)
    roles = ["system", "user", "assistant", "tool", "", None, "User"]
    texts = ["Yes.", "No!", "cut off", "", " \n", None, "Why? ", "é.\t", "Yes."]
    rows = [
        (conv, rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts))
        for conv in [None, *range(60)] for _ in range(rng.randrange(1, 12))
    ]
    rows += [(500, t, ["user", "assistant"][t % 2], f"turn {t}.") for t in range(700)]  # spread over pieces
    rows += [(501, 3, "user", "same.")] * 90 + [(502, 2, "user", "long " * 200_000 + ".")]
    return rows


def test_rows_equal_plain(spark):
    rows = made()
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, times string")
    damaged = repair.damaged(table.repartition(5))
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r[0]: tuple(r)[1:] for r in repair.repair(damaged).collect()}
        want = plain(rows)
        assert got == {conv: values[:-1] for conv, values in want.items()}
        audits = repair.repairs(damaged)
        texts = {}
        for r in sorted(repair.repaired(damaged, audits).collect(), key=lambda r: (str(r.conv_id), r.position)):
            texts.setdefault(r.conv_id, []).append((r.role, r.text))
        assert texts == {conv: values[-1] for conv, values in want.items() if values[-1]}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_table_and_dropped_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert repair.repair(repair.damaged(spark.createDataFrame([], schema))).collect() == []
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repair.repair(repair.damaged(spark.createDataFrame([(dropped, 0, "user", "Hi.")], schema))).collect()
    assert [tuple(r) for r in got] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
