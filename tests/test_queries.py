"""Registered queries against their SQL, and the quarterly job end to end."""

from __future__ import annotations

import os
from datetime import date, timedelta

import pytest
from checks.compare import compare, duck
from checks.config import CALC, NOW, RESET_QUARTER, SINCE
from checks.proxies import Proxies
from checks.queries import QUERIES, SQL
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as contract
from doseline.functions.dates import Periods
from doseline.operators import linkage
from doseline.plans import quarter
from doseline.plans.quarter import Options, publish_quarter, replay_quarter, run_and_publish, run_quarter
from doseline.session import Stages
from doseline.sources import runs, services, versions
from doseline.sources.tables import add_changes, append_rows, ingest_table, read_table

SMALL = "/root/testdata/sf0.001"
# The full list takes minutes; `python -m checks.compare` or DOSELINE_ALL=1 runs it.
QUICK = [
    "reporting_periods", "currency_cutoff", "program_recode", "interval_overlap", "not_yet_stratified",
    "population", "latest_score", "latest_score_fallback", "condition_pivot", "utilization_counts",
    "merge_intervals_lag", "merge_intervals_runmax", "active_strata", "hours_in_interval", "prior_episode",
    "link_prior_episode", "pay_multiplier", "reset_payments", "authorizations_as_of", "population_as_of",
]
NAMES = list(QUERIES) if os.environ.get("DOSELINE_ALL") else QUICK


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, con, name):
    result = compare(spark, con, name, SMALL)
    assert result.startswith("ok") and "types" not in result, result


def test_contract_lists_every_query_with_sql():
    assert set(QUERIES) == set(SQL) and set(SQL) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.fixture(scope="module")
def run(spark):
    tables = Proxies(spark, SMALL).all()
    options = Options(now=NOW, linked_since=SINCE, reset_quarter=RESET_QUARTER, substance_inputs=True)
    return tables, run_quarter(spark, tables, CALC, options)


def test_job_equals_its_sql(run, con):
    _, result = run
    got = rows(result["au_stratum"].drop("modify_stamp", "post_stamp"))
    df = con.execute(contract.oracle_sql()["quarter_run"])
    names = [d[0] for d in df.description]
    order = [names.index(c) for c in result["au_stratum"].columns if c not in ("modify_stamp", "post_stamp")]
    assert len(got) == len(want := df.fetchall())
    assert {r[0]: r for r in got}.keys() == {w[names.index("au_stratum_id")] for w in want}
    plain = {tuple(str(w[i]) for i in order) for w in want}
    assert {tuple(str(v) for v in r) for r in got} == plain


def test_job_invariants(run):
    tables, result = run
    population = result["population"].count()
    assert population == result["strata"].count() == result["ratios"].count() > 0
    final = result["au_stratum"]
    assert final.select("au_stratum_id").distinct().count() == final.count()
    assert final.count() == tables["au_stratum"].count() + population
    assert {r for (r,) in rows(final.select("sda_rule").distinct())} <= {"FPC", "NOR", "PQD", "FPN", "SHA"}
    assert final.where("sda_rule IN ('FPC','FPN','SHA') AND sda_pay_multiplier <> 1").count() == 0
    assert {"ASAM", "IDU"}.isdisjoint({m for (m,) in rows(result["scores"].select("metric").distinct())})
    assert "CHRON" not in {m for (m,) in rows(result["scores"].select("metric").distinct())}


HISTORY_TABLES = ("au_stratum", "au_stratum_shadow", "au_stratum_sda", "au_stratum_score")


def stored(spark, root):
    return {n: rows(read_table(spark, root, n)) for n in HISTORY_TABLES}


def test_published_tables_hold_the_run_however_often_and_after_any_interruption(spark, run, tmp_path, monkeypatch):
    tables, result = run
    ends = []
    for stop in range(5):  # steps done before the first attempt breaks off
        root = str(tmp_path / str(stop))
        for name in HISTORY_TABLES:
            append_rows(tables[name], root, name)
        done = []

        def step(work):
            def limited(*args):
                if len(done) == stop:
                    raise InterruptedError
                done.append(work(*args))

            return limited

        with monkeypatch.context() as patch:
            patch.setattr(quarter, "append_new_rows", step(quarter.append_new_rows))
            patch.setattr(quarter, "replace_quarters", step(quarter.replace_quarters))
            if stop < 4:
                with pytest.raises(InterruptedError):
                    publish_quarter(spark, result, root)
        publish_quarter(spark, result, root)
        ends.append(stored(spark, root))
    assert all(end == ends[0] for end in ends)
    assert ends[0]["au_stratum"] == rows(result["au_stratum"])
    assert len(ends[0]["au_stratum_shadow"]) == len(ends[0]["au_stratum"])
    for name, fresh in (("au_stratum_sda", "ratios"), ("au_stratum_score", "scores")):
        assert len(ends[0][name]) == tables[name].count() + result[fresh].count()


def test_a_quarter_before_the_linked_ones_is_stored_whole(spark, tmp_path):
    tables = Proxies(spark, SMALL).all()
    undated = tables["au_stratum"].limit(1).withColumns({"start_date": F.lit(None).cast("date"), "au_stratum_id": F.lit(-1).cast("long")})
    tables["au_stratum"] = tables["au_stratum"].unionByName(undated)
    result = run_quarter(spark, tables, CALC, Options(now=NOW))
    for name in HISTORY_TABLES:
        append_rows(tables[name], str(tmp_path), name)
    publish_quarter(spark, result, str(tmp_path))
    ids = {r.au_stratum_id for r in read_table(spark, str(tmp_path), "au_stratum").select("au_stratum_id").collect()}
    assert {r.au_stratum_id for r in result["strata"].collect()} <= ids and -1 in ids
    assert len(ids) == tables["au_stratum"].count() + result["strata"].count()
    assert -1 in {r.au_stratum_id for r in result["au_stratum"].collect()}


LATER = {**vars(Options(now=None, linked_since=SINCE, reset_quarter=RESET_QUARTER)), "as_of": CALC + timedelta(days=1)}


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """The tables written once, so that every run of the job reads the same."""
    t, root = Proxies(spark, SMALL), str(tmp_path_factory.mktemp("world"))
    for name, df in t.all().items():
        df.write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in t.all()}


def start(world, root):
    for name in HISTORY_TABLES:
        append_rows(world[name], root, name)
    return {name: df for name, df in world.items() if name not in HISTORY_TABLES}


JOB = Options(now=NOW, linked_since=SINCE, reset_quarter=RESET_QUARTER)


def broken_off(stop, monkeypatch):
    """Lets the job die after so many of its steps: staging, recording it, three appends, the
    replacement, the last record."""
    done = []

    def step(work):
        def limited(*args):
            if len(done) == stop:
                raise InterruptedError
            out = work(*args)
            done.append(work)
            return out

        return limited

    for owner, name in (
        (quarter, "run_quarter"), (quarter, "append_new_rows"), (quarter, "replace_quarters"), (runs, "advance")
    ):
        monkeypatch.setattr(owner, name, step(getattr(owner, name)))


@pytest.fixture(scope="module")
def finished(spark, world, tmp_path_factory):
    """A job that died while it computed and was run again a day later; its root, and the folder it staged."""
    root = str(tmp_path_factory.mktemp("finished"))
    inputs = start(world, root)
    with pytest.MonkeyPatch.context() as patch:
        broken_off(0, patch)
        with pytest.raises(InterruptedError):
            run_and_publish(spark, root, CALC, JOB, Stages(spark), inputs)
    assert runs.last_run(spark, root).step == runs.RESERVED
    stages = Stages(spark)
    result = run_and_publish(spark, root, CALC, Options(**LATER), stages, inputs)
    assert rows(read_table(spark, root, "au_stratum")) == rows(result["au_stratum"])
    return root, stages


def test_a_finished_job_equals_one_that_never_died(spark, run, finished):
    tables, result = run
    root, _ = finished
    assert rows(read_table(spark, root, "au_stratum")) == rows(result["au_stratum"])
    for name, fresh in (("au_stratum_sda", "ratios"), ("au_stratum_shadow", "shadow")):
        assert rows(read_table(spark, root, name)) == rows(tables[name].unionByName(result[fresh]))


@pytest.mark.parametrize("stop", range(1, 7))
def test_a_job_run_again_after_it_died_ends_as_if_it_had_not(spark, world, finished, tmp_path, monkeypatch, stop):
    """Run again whole, dated a day later and, once its rows are staged, with other inputs."""
    root = str(tmp_path)
    inputs = start(world, root)
    # What it would compute has been computed from the same tables before.
    monkeypatch.setattr(quarter, "run_quarter", lambda *args: None)
    with monkeypatch.context() as patch:
        broken_off(stop, patch)
        with pytest.raises(InterruptedError):
            run_and_publish(spark, root, CALC, JOB, finished[1], inputs)
    assert runs.last_run(spark, root).step == (runs.RESERVED if stop == 1 else runs.STAGED)
    with pytest.raises(ValueError, match="not finished"):
        run_and_publish(spark, root, date(1999, 4, 20), JOB, finished[1], inputs)
    if stop > 1:
        inputs = {**inputs, "au_master": inputs["au_master"].limit(0)}
        monkeypatch.undo()
    run_and_publish(spark, root, CALC, Options(**LATER), finished[1], inputs)
    assert runs.last_run(spark, root).step == runs.DONE
    assert stored(spark, root) == stored(spark, finished[0])


def test_two_quarters_one_after_the_other(spark, world, finished):
    """The second run links to what the first one stored, and its state stands for all strata. It
    takes the hours of its look-back from those kept by month."""
    root, _ = finished
    services.add_services(spark, world["ea_cpt_service"], root, "all")
    inputs = {name: df for name, df in world.items() if name not in HISTORY_TABLES}
    first = read_table(spark, root, "au_stratum")
    state = versions.read_state(spark, f"{root}/au_stratum", SINCE)
    assert rows(state) == rows(linkage.settled_strata(first, SINCE)) and state.count() > 0
    history = {name: read_table(spark, root, name) for name in HISTORY_TABLES}
    day, options = date(1999, 4, 15), Options(linked_since=SINCE, reset_quarter=None)
    want = run_quarter(spark, {**inputs, **history}, day, options)  # knows no state
    inputs["ea_cpt_service"] = world["ea_cpt_service"].limit(0)
    got = run_and_publish(spark, root, day, options, Stages(spark), inputs)
    assert rows(got["au_stratum"]) == rows(want["au_stratum"])
    ratios = ("auth_no", "svc_hrs", "sda", "prev_auth_no")
    assert rows(got["ratios"], *ratios) == rows(want["ratios"], *ratios)
    assert got["ratios"].where("svc_hrs > 0").count() > 0
    assert rows(got["state"]) == rows(linkage.settled_strata(got["au_stratum"], SINCE))
    assert got["au_stratum"].where("start_date = DATE '1999-04-01' AND stratum_sda_id IS NOT NULL").count() > 0


def test_a_finished_run_is_made_again_after_later_changes(spark, world, tmp_path):
    """Two quarters run from ingested tables, the authorizations edited between and after them; each
    run made again gives what it published, and publishes nothing."""
    root = str(tmp_path)
    start(world, root)
    for name, df in world.items():
        if name not in HISTORY_TABLES:
            ingest_table(df, root, name)
    auth = world["au_master"]
    options = Options(linked_since=SINCE, reset_quarter=None)
    results = []
    for calc in (CALC, date(1999, 4, 15)):
        results.append(run_and_publish(spark, root, calc, options, Stages(spark)))
        edited = auth.where("auth_no % 4 = 1").withColumn("data_status", F.lit("ID"))
        moved = auth.where("auth_no % 4 = 2").withColumn("agency_id", F.lit(9))
        add_changes(spark, edited.unionByName(moved), root, "au_master", calc + timedelta(days=1))
    after = stored(spark, root)
    parts = ("population", "strata", "ratios", "scores", "replaced", "state")
    for calc, result in zip((CALC, date(1999, 4, 15)), results, strict=True):
        quarter_start = Periods.of(calc).pop_start
        again = replay_quarter(spark, root, quarter_start, options, Stages(spark))
        for name in parts:
            assert rows(again[name]) == rows(result[name]), (calc, name)
        assert result["population"].count() > 0 and "shadow" not in again
    # The second run did not see what changed after the first alone: those closed were left out of it.
    assert results[0]["population"].where("auth_no % 4 = 1").count() > 0
    assert results[1]["population"].where("auth_no % 4 = 1").count() == 0
    assert stored(spark, root) == after
    with pytest.raises(ValueError, match="no run"):
        replay_quarter(spark, root, date(1999, 7, 1), options)
