"""Steps of a run that do not need each other."""

from __future__ import annotations

from threading import Barrier

import pytest

from doseline.plans.quarter import side_by_side


def test_steps_run_at_the_same_time(spark):
    both = Barrier(2, timeout=60)  # in turn, the first would wait for ever

    def step(n):
        both.wait()
        return spark.range(n)

    one, two = side_by_side(lambda: step(1), lambda: step(2))
    assert (one.count(), two.count()) == (1, 2)


def test_a_step_that_fails_fails_the_run(spark):
    def fails():
        raise ValueError("lost")

    with pytest.raises(ValueError, match="lost"):
        side_by_side(lambda: spark.range(1), fails)
