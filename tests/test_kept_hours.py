"""The daily hours kept of batches of services."""

from __future__ import annotations

from checks import queries as checked
from checks.proxies import Proxies
from doseline.sources import services

SMALL = "/root/testdata/sf0.001"


def test_batches_read_the_joined_services_once(spark, monkeypatch):
    tables = Proxies(spark, SMALL)
    read = []
    monkeypatch.setattr(services, "add_services", lambda spark, df, root, batch: read.extend(df.inputFiles()))
    monkeypatch.setattr(services, "refresh_daily_hours", lambda spark, root: [])
    monkeypatch.setattr(services, "read_daily_hours", lambda spark, root, s, e: None)
    checked._kept_hours(tables)
    assert read and all(tables.stages().root in path for path in read)
