"""Daily hours kept by month equal those summed from all services, batch after batch."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest
from conftest import rows

from doseline.operators import dosage
from doseline.sources import services, versions

S, E = date(2020, 3, 1), date(2020, 5, 31)


def batch(make, seed, many=60, first=date(2020, 1, 15), days=150):
    draw = np.random.default_rng(seed)
    return make("ea_cpt_service", *[
        (int(draw.integers(6)), first + timedelta(days=int(draw.integers(days))), int(draw.integers(-5, 90)), int(draw.integers(0, 4)))
        for _ in range(many)
    ])


def summed(spark, root):
    return rows(dosage.service_hours(services.read_services(spark, root), S, E))


def kept(spark, root):
    return rows(services.read_daily_hours(spark, root, S, E))


def test_batch_after_batch(spark, make, tmp_path):
    root, folder = str(tmp_path), str(tmp_path / "daily_hours")
    assert kept(spark, root) == [] and services.refresh_daily_hours(spark, root) == []
    services.add_services(spark, batch(make, 1), root, "one")
    assert len(services.refresh_daily_hours(spark, root)) == 6 and kept(spark, root) == summed(spark, root) != []
    before = versions.read_pointer(spark, folder).versions
    # Only May receives rows, so only May is made again.
    services.add_services(spark, batch(make, 2, 20, date(2020, 5, 1), 31), root, "two")
    assert services.refresh_daily_hours(spark, root) == [date(2020, 5, 1)]
    after = versions.read_pointer(spark, folder).versions
    assert {m for m in after if after[m] != before.get(m)} == {date(2020, 5, 1)}
    assert kept(spark, root) == summed(spark, root) and services.refresh_daily_hours(spark, root) == []
    # A batch written again takes the place of the first, also in the months it no longer has.
    services.add_services(spark, batch(make, 3, 5, date(2020, 3, 1), 31), root, "one")
    assert len(services.refresh_daily_hours(spark, root)) == 6 and kept(spark, root) == summed(spark, root)
    undated = make("ea_cpt_service", (1, None, 30, 1))
    services.add_services(spark, undated, root, "three")
    assert services.refresh_daily_hours(spark, root) == [] and kept(spark, root) == summed(spark, root)
    assert services.read_services(spark, root).count() == 20 + 5 + 1


@pytest.mark.parametrize("step", ["replace_versions", "_done"])
def test_a_refresh_that_died_is_made_again(spark, make, tmp_path, monkeypatch, step):
    root = str(tmp_path)
    services.add_services(spark, batch(make, 1), root, "one")

    def replaced(*args):
        if step == "_done":
            versions.replace_versions(*args)
        raise InterruptedError

    with monkeypatch.context() as patch:
        patch.setattr(services, "replace_versions", replaced)
        with pytest.raises(InterruptedError):
            services.refresh_daily_hours(spark, root)
    assert len(services.refresh_daily_hours(spark, root)) == 6
    assert kept(spark, root) == summed(spark, root) != []


def test_only_the_months_of_the_window_are_read(spark, make, tmp_path):
    root = str(tmp_path)
    services.add_services(spark, batch(make, 1), root, "one")
    services.refresh_daily_hours(spark, root)
    plan = services.read_daily_hours(spark, root, S, E)._jdf.queryExecution().executedPlan().toString()
    assert "start_date" in plan.split("PartitionFilters: [")[-1].split("]")[0]
    plan = services.read_services(spark, root, [S])._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters: [")[-1].split("]")[0]
