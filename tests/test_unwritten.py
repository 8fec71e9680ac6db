"""Which rows of a run a history table lacks."""

from __future__ import annotations

from conftest import rows

from doseline.sources.tables import unwritten

KEYS = ["id", "metric"]


def test_only_the_range_of_the_new_ids_is_compared(frame):
    stored = frame("id long, metric string", *[(i, "A") for i in range(100)], (100, "B"), (None, "A"), (None, None))
    new = frame("id long, metric string", (98, "A"), (98, "B"), (100, "B"), (101, "A"), (None, "A"), (None, "C"), (None, None))
    left = unwritten(new, stored, KEYS)
    assert rows(left) == [(98, "B"), (101, "A"), (None, "C")]
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert ">= 98" in plan and "<= 101" in plan and "Aggregate" not in plan


def test_rows_without_an_id(frame):
    stored = frame("id long, metric string", (1, "A"), (None, "A"), (None, "A"))
    assert rows(unwritten(frame("id long, metric string", (None, "A"), (None, "B")), stored, KEYS)) == [(None, "B")]
    assert rows(unwritten(frame("id long, metric string"), stored, KEYS)) == []
    assert rows(unwritten(stored, frame("id long, metric string"), KEYS)) == rows(stored)
