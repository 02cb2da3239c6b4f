"""Rows of one key in a micro-batch are folded in order, with few of them in memory."""

from __future__ import annotations

import random

import pandas as pd
import pytest

from ticklake.operators import quality, reorg
from ticklake.streaming import keyed


class Kept:
    """Stands in for the states of a key."""

    def __init__(self):
        self.value, self.entries = None, {}

    def getValueState(self, *_):
        return self

    getMapState = getValueState

    def exists(self):
        return self.value is not None or bool(self.entries)

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def keys(self):
        return list(self.entries)

    def getValue(self, key):
        return self.entries[key]

    def updateValue(self, key, value):
        self.entries[key] = value

    def removeKey(self, key):
        del self.entries[key]


@pytest.fixture()
def few(monkeypatch):
    monkeypatch.setattr(keyed, "RUN_ROWS", 40)
    monkeypatch.setattr(keyed, "PIECE_ROWS", 7)


def frames(rows: pd.DataFrame, size: int):
    return (rows.iloc[low : low + size] for low in range(0, len(rows), size))


def test_runs_are_merged_in_order(few):
    rng = random.Random(3)
    rows = pd.DataFrame({
        "a": [rng.choice([1.0, 2.0, None]) for _ in range(500)], "b": rng.sample(range(500), 500),
        "t": [rng.choice(["x", None]) for _ in range(500)],
    })
    got = list(keyed.in_order(frames(rows, 13), ["a", "b"]))
    pd.testing.assert_frame_equal(pd.concat(got), rows.sort_values(["a", "b"]))
    assert max(map(len, got)) <= 40
    assert list(keyed.in_order(iter([]), ["a"])) == []


def test_sequence_holds_few_rows(few):
    rng = random.Random(4)
    rows = [{"arrival": i, "number": i // 2 + rng.randrange(3), "time": i + rng.randrange(5), "good": rng.random() < 0.8} for i in range(900)]
    want = [[], [], []]
    end = quality.sequence_step([0, 0], [[r[c] for r in rows] for c in ("number", "time", "good")], want)
    outputs = [(f.name, keyed._PANDAS[f.dataType.simpleString()]) for f in quality.STATE_FIELDS]
    fold = keyed.FoldProcessor(quality.sequence_step, [0, 0], ["arrival"], ["number", "time", "good"], ["arrival"], outputs)
    state = Kept()
    fold.init(state)
    got = []
    for low, high in ((0, 700), (700, 900)):
        part = pd.DataFrame(rng.sample(rows[low:high], high - low))
        got += list(fold.handleInputRows(("s",), frames(part, 11), None))
    assert max(map(len, got)) <= 40
    assert pd.concat(got).values.tolist() == [list(r) for r in zip(range(900), *want)]
    assert state.value == (f"[{end[0]}, {end[1]}]",)


def test_reorgs_hold_few_rows(few):
    rng = random.Random(5)
    rows = [{"source_id": "s", "arrival": i, "tick_number": i // 3 + rng.randrange(4), "output": rng.choice("ab"),
             "batch_hash": "h", "previous_output": "p", "tx_count": rng.randrange(2)} for i in range(900)]
    want, seen = [[], [], []], {}
    reorg.compare(seen, 8, [[r[c] for r in rows] for c in reorg.WINDOW_INPUTS], want)
    process = keyed.ReorgProcessor(8)
    state = Kept()
    process.init(state)
    got = list(process.handleInputRows(("s",), frames(pd.DataFrame(rng.sample(rows, 900)), 11), None))
    assert max(map(len, got)) <= 40
    assert pd.concat(got)[["arrival", "old_arrival", "conflict_reason"]].values.tolist() == [
        [i, old, reason] for i, (reason, old) in enumerate(zip(*want[:2])) if reason is not None
    ]
    assert {n: list(e) for (n,), e in state.entries.items()} == seen
