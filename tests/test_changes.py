"""Tables received as dated changes equal a replay of all deliveries, on every day."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from conftest import rows

from doseline.operators import population
from doseline.sources import changes, runs
from doseline.sources.tables import add_changes, fold_changes, ingest_table, read_table, read_tables

FIRST = date(2020, 3, 1)


def auths(make, numbers, draw):
    """Authorizations with statuses of their own; a null number now and then."""
    return make("au_master", *[
        {"auth_no": n, "kcid": int(draw.integers(5)), "program": "400", "status_code": f"S{draw.integers(10**6)}"}
        for n in numbers
    ])


def replayed(first, deliveries, as_of):
    """The rows of a day by brute force: of each key the greatest row of its last delivery."""
    found = first.collect()
    for received, df in deliveries:
        new = df.collect() if received <= as_of else []
        keys = {r.auth_no for r in new if r.auth_no is not None}
        found = [r for r in found if r.auth_no not in keys]
        for key in keys:
            same = [r for r in new if r.auth_no == key]
            found.append(max(same, key=lambda r: [(v is not None, str(v)) for v in r]))
        found += [r for r in new if r.auth_no is None]
    return sorted(map(str, found))


def as_of(spark, root, day=None):
    return sorted(map(str, read_table(spark, root, "au_master", as_of=day).collect()))


@pytest.mark.parametrize("fold_after", [None, 0, 2])
def test_every_day_equals_a_replay(spark, make, tmp_path, fold_after):
    draw, root = np.random.default_rng(5), str(tmp_path)
    first = auths(make, [*range(40), 7, None, None], draw)  # 7 was ingested twice
    ingest_table(first, root, "au_master")
    assert as_of(spark, root) == replayed(first, [], FIRST)
    days = [FIRST, FIRST + timedelta(2), FIRST + timedelta(2), FIRST + timedelta(9), FIRST + timedelta(30)]
    done = []
    for n, day in enumerate(days):
        numbers = [*map(int, draw.integers(0, 60, 12)), 3, 3, None]  # some new, some again, one twice
        df = auths(make, numbers, draw)
        add_changes(spark, df, root, "au_master", day)
        done.append((day, df))
        if n == fold_after:
            fold_changes(spark, root, "au_master", day)
            with pytest.raises(ValueError, match="complete"):
                add_changes(spark, df, root, "au_master", day)
    for day in sorted({FIRST - timedelta(1), *days, FIRST + timedelta(5), FIRST + timedelta(99)}):
        assert as_of(spark, root, day) == replayed(first, done, day), day
    assert as_of(spark, root) == replayed(first, done, date.max)
    if fold_after == 2:
        files = read_table(spark, root, "au_master", as_of=days[3]).inputFiles()
        assert files and all("received=2020-03-03" in f or "received=2020-03-10" in f for f in files)


def test_a_table_without_deliveries_or_with_nothing_else(spark, make, tmp_path):
    root = str(tmp_path)
    df = make("g_person", (1, "1990-01-01"), (2, None))
    add_changes(spark, df, root, "g_person", FIRST)
    assert rows(read_table(spark, root, "g_person")) == rows(df)
    assert read_table(spark, root, "g_person", as_of=FIRST - timedelta(1)).count() == 0
    add_changes(spark, df.limit(0), root, "g_person", FIRST)
    assert rows(read_table(spark, root, "g_person")) == rows(df)
    # Both parts of a key count: a case rate of another person is another row.
    ingest_table(make("case_rate", (1, 10, "A", None, None), (2, 10, "A", None, None)), root, "case_rate")
    add_changes(spark, make("case_rate", (2, 10, "C  ", None, None)), root, "case_rate", FIRST)
    assert rows(read_table(spark, root, "case_rate"), "kcid", "age_group") == [(1, "A"), (2, "C")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, root, "au_master")
    with pytest.raises(ValueError, match="not received as changes"):
        add_changes(spark, make("ep_jail"), root, "ep_jail", FIRST)


def test_a_delivery_that_broke_off_is_not_seen(spark, make, tmp_path, monkeypatch):
    root, draw = str(tmp_path), np.random.default_rng(1)
    ingest_table(auths(make, range(5), draw), root, "au_master")
    before = as_of(spark, root)
    with monkeypatch.context() as patch:
        patch.setattr(changes, "astuple", lambda *_: (_ for _ in ()).throw(InterruptedError()))
        with pytest.raises(InterruptedError):
            add_changes(spark, auths(make, range(5), draw), root, "au_master", FIRST)
    assert as_of(spark, root) == before


def test_days_that_were_read_do_not_change(spark, make, tmp_path):
    root, draw = str(tmp_path), np.random.default_rng(2)
    ingest_table(auths(make, range(5), draw), root, "au_master")
    add_changes(spark, auths(make, [1], draw), root, "au_master", FIRST)
    with pytest.raises(ValueError, match="complete"):
        add_changes(spark, auths(make, [1], draw), root, "au_master", FIRST - timedelta(1))
    day = FIRST + timedelta(4)
    runs.record(spark, root, runs.Run(FIRST, 1, runs.RESERVED, day, day, datetime(2020, 3, 5), 0, 0))
    with pytest.raises(ValueError, match="a run has read"):
        add_changes(spark, auths(make, [1], draw), root, "au_master", day)
    add_changes(spark, auths(make, [1], draw), root, "au_master", day + timedelta(1))


def test_filters_reach_the_scan_and_only_changes_are_dealt(spark, make, tmp_path):
    root, draw = str(tmp_path), np.random.default_rng(3)
    ingest_table(auths(make, range(50), draw), root, "au_master")
    add_changes(spark, auths(make, [1, 2], draw), root, "au_master", FIRST)
    auth = read_table(spark, root, "au_master")
    due = auth.where("status_code = 'AA' AND start_date >= DATE '2020-01-01'").select("auth_no", "kcid")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    tree = due._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    base = next(line for line in tree.splitlines() if "FileScan" in line and "_changes" not in line)
    assert "status_code" in base.split("PushedFilters:")[1] and "agency_id" not in base.split("ReadSchema:")[1]
    above = tree[: tree.index(base)]
    assert "Exchange hashpartitioning" not in above and "BroadcastHashJoin" in above


def test_the_population_of_a_day_is_selected_again(spark, make, tmp_path):
    root = str(tmp_path)
    auth = {
        "kcid": 1, "agency_id": 1, "start_date": "2020-01-01", "expire_date": "2020-12-31", "program": "400",
        "status_code": "AA", "post_stamp": "2020-01-05 00:00:00", "data_status": "OK",
    }
    ingest_table(make("au_master", *[{**auth, "auth_no": n} for n in (1, 2, 3)]), root, "au_master")
    ingest_table(make("case_rate", *[(1, n, "A", None, None) for n in (1, 2, 3, 4)]), root, "case_rate")
    ingest_table(make("g_person", (1, "1980-05-05")), root, "g_person")

    def selected(day):
        t = {n: read_table(spark, root, n, as_of=day) for n in ("au_master", "case_rate", "g_person")}
        pop = population.select_population(
            t["au_master"], t["g_person"], make("au_initial_plan"), t["case_rate"], make("au_stratum"),
            make("g_p1_client"), date(2020, 4, 1), date(2020, 6, 30), date(2020, 4, 20),
        )
        return rows(pop, "auth_no", "age_group", "age")

    then = selected(date(2020, 4, 20))
    assert then == [(n, "A", 39) for n in (1, 2, 3)]
    changed = make("au_master", {**auth, "auth_no": 1, "data_status": "ID"}, {**auth, "auth_no": 4})
    add_changes(spark, changed, root, "au_master", date(2020, 5, 2))
    add_changes(spark, make("case_rate", (1, 2, "G", None, None)), root, "case_rate", date(2020, 5, 3))
    add_changes(spark, make("g_person", (1, "1970-05-05")), root, "g_person", date(2020, 5, 4))
    assert selected(date(2020, 4, 20)) == then
    assert selected(None) == [(2, "G", 49), (3, "A", 49), (4, "A", 49)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_tables(spark, root)
