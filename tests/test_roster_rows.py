"""Loaded rosters that repeat a terminal."""

from __future__ import annotations

import pytest

from tillbook import plans
from tillbook.operators.merge import merge_sync


def test_sync_keeps_every_loaded_row_of_a_terminal(frame, rows):
    target = frame(
        [("a", "old", "n1"), ("a", "old", "n2"), ("b", "old", "n3"), (None, "old", "n4")],
        "terminal_id STRING, state STRING, note STRING",
    )
    roster = frame([("a", None), ("c", "new"), (None, "new")], "terminal_id STRING, state STRING")
    want = [("a", None, "n1"), ("a", None, "n2"), ("c", "new", None)]
    synced = plans.sync_roster(target, roster)
    assert rows(synced) == want == rows(merge_sync(target, roster, "terminal_id"))
    assert synced._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    bare = target.select("terminal_id", "state")
    assert rows(plans.sync_roster(bare, roster)) == [w[:2] for w in want]


def test_sync_refuses_a_repeated_source_key_in_one_join(frame):
    target = frame([("a", "n1")], "k STRING, note STRING")
    with pytest.raises(Exception, match="duplicate k"):
        merge_sync(target, frame([("a",), ("a",)], "k STRING"), "k", one_join=True).collect()
