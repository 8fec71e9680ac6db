from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from doseline.operators import publish
from doseline.session import Stages
from doseline.sources import runs, versions
from doseline.sources.tables import append_new_rows, append_rows, ingest_table, read_table, replace_quarters

NOW = datetime(2020, 7, 3, 12)


def test_ids_are_dense_ordered_and_repeatable(spark):
    rng = random.Random(3)
    keys = [(rng.choice([5, 70_000, 2**33]) + rng.randint(0, 200_000), date(2020, rng.choice([1, 4]), 1)) for _ in range(500)]
    df = spark.createDataFrame([(a, d, i) for i, (a, d) in enumerate(keys)], "auth_no long, start_date date, n int")
    out = publish.with_ids(df.repartition(7), "id", 1000)
    got = [r[1:] for r in rows(out, "id", "start_date", "auth_no", "n")]
    assert got == sorted((d.isoformat(), a, i) for i, (a, d) in enumerate(keys))
    assert [r.id for r in out.orderBy("id").collect()] == list(range(1001, 1501))
    assert rows(publish.with_ids(df.repartition(2), "id", 1000)) == rows(out)


def test_highest_id_of_an_empty_table(make):
    assert publish.highest_id(make("au_stratum"), "au_stratum_id") == 0


def test_score_rows_leave_out_the_summary_metric(frame):
    lines = frame(
        "auth_no long, metric string, value int, score int, missing_data string",
        (1, "LOCUS", 1, 2, "N"), (1, "CHRON", 1, 2, "N"), (2, "LOCUS", 1, 2, "Y"),
    )
    ids = frame("au_stratum_id long, auth_no long", (7, 1))
    assert rows(publish.score_rows(lines, ids), "au_stratum_id", "metric", "missing_data", "override_ind") == [
        (7, "LOCUS", "N", "N"), (None, "LOCUS", "Y", "N"),
    ]


def test_sda_rows_period(frame):
    df = frame(
        """auth_no long, phs_start_date date, phs_end_date date, sda double, enroll_days int, hrs_expected int,
        svc_hrs int, svc_hrs_prorated int, prev_auth_no long""",
        (1, "2020-04-01", "2020-06-30", None, 0, 0, 0, 0, None),
    )
    assert rows(publish.sda_rows(df), "start_date", "end_date") == [("2019-12-01", "2020-02-29")]
    assert rows(publish.sda_rows(df, "quarter"), "start_date", "end_date") == [("2020-04-01", "2020-06-30")]
    with pytest.raises(ValueError):
        publish.sda_rows(df, "month")


def strata(make):
    return make(
        "au_stratum",
        {"au_stratum_id": 1, "auth_no": 1, "start_date": "2020-04-01", "end_date": "2020-06-30", "sda_rule": "NOR", "sda_pay_multiplier": "0.9"},
        {"au_stratum_id": 2, "auth_no": 1, "start_date": "2020-07-01", "end_date": "2020-09-30", "sda_rule": "NOR", "sda_pay_multiplier": "0.9"},
        {"au_stratum_id": 3, "auth_no": 2, "start_date": "2020-07-01", "end_date": "2020-09-30", "sda_rule": "SHA", "sda_pay_multiplier": "0.8"},
    )


def test_shadow_and_reset(make):
    table = strata(make)
    shadow = table.where("au_stratum_id = 1")
    delta = publish.shadow_delta(table, shadow)
    assert rows(delta, "au_stratum_id") == [(2,), (3,)]
    assert publish.shadow_delta(table, shadow.unionByName(delta)).count() == 0
    reset = publish.reset_payments(table, date(2020, 7, 1))
    assert [(i, r, float(p)) for i, r, p in rows(reset, "au_stratum_id", "sda_rule", "sda_pay_multiplier")] == [
        (1, "NOR", 0.9), (2, "SHA", 1.0), (3, "SHA", 0.8),
    ]
    assert rows(publish.stratum_ids_on(table, date(2020, 7, 1)), "au_stratum_id") == [(2,), (3,)]


def test_history_tables_append_and_replace(spark, make, tmp_path):
    root = str(tmp_path)
    assert read_table(spark, root, "au_stratum").count() == 0
    table = strata(make)
    append_rows(table, root, "au_stratum")
    stored = read_table(spark, root, "au_stratum")
    assert stored.schema == table.schema and rows(stored) == rows(table)
    july = stored.where(F.col("start_date") == "2020-07-01").withColumn("sda_rule", F.lit("FPN"))
    replace_quarters(july, root, "au_stratum", Stages(spark))
    again = read_table(spark, root, "au_stratum")
    assert rows(again, "au_stratum_id", "sda_rule") == [(1, "NOR"), (2, "FPN"), (3, "FPN")]
    plan = again.where(F.col("start_date") == "2020-07-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(start_date" in plan


def test_a_missing_input_table_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, str(tmp_path), "au_master")


def test_ids_of_sparse_numbers_are_dense(spark):
    numbers = [-(2**63), -5, 0, 7, 2**16, 2**33 + 1, 2**47, 2**48 + 3, 2**62, 2**63 - 1]
    data = [(n, day) for day in (date(2020, 4, 1), date(2020, 1, 1)) for n in reversed(numbers)]
    got = publish.with_ids(spark.createDataFrame(data, "auth_no long, start_date date"), "id", 100)
    want = [(101 + i, n, d.isoformat()) for i, (d, n) in enumerate(sorted((d, n) for n, d in data))]
    assert rows(got) == want


def test_appending_again_adds_nothing(spark, make, tmp_path):
    root = str(tmp_path)
    scores = make(
        "au_stratum_score",
        {"au_stratum_id": 1, "metric": "LOCUS", "post_stamp": "2020-07-01 00:00:00"},
        {"au_stratum_id": None, "metric": "LOCUS", "post_stamp": "2020-07-01 00:00:00"},
        {"au_stratum_id": None, "metric": "LOCUS", "post_stamp": "2020-07-01 00:00:00"},
    )
    for _ in range(2):
        append_new_rows(spark, scores, root, "au_stratum_score")
    assert rows(read_table(spark, root, "au_stratum_score")) == rows(scores)
    later = scores.withColumn("post_stamp", F.expr("post_stamp + INTERVAL 1 DAY"))
    append_new_rows(spark, later, root, "au_stratum_score")
    assert read_table(spark, root, "au_stratum_score").count() == 6


def test_codes_are_trimmed_on_ingest(spark, make, tmp_path):
    ingest_table(make("ma_cond_ass", (1, "152  "), (2, "153")), str(tmp_path), "ma_cond_ass")
    assert rows(read_table(spark, str(tmp_path), "ma_cond_ass")) == [(1, "152"), (2, "153")]


def test_a_reader_sees_a_replacement_whole_or_not_at_all(spark, make, tmp_path, monkeypatch):
    root, folder = str(tmp_path), str(tmp_path / "au_stratum")
    table = strata(make)
    undated = table.limit(1).withColumns({"start_date": F.lit(None).cast("date"), "au_stratum_id": F.lit(9).cast("long")})
    append_rows(table.unionByName(undated), root, "au_stratum")
    before = rows(read_table(spark, root, "au_stratum"))
    changed = read_table(spark, root, "au_stratum").withColumn("sda_rule", F.lit("FPN"))
    early = read_table(spark, root, "au_stratum")
    with monkeypatch.context() as patch:
        patch.setattr(versions, "_switch", lambda *_: (_ for _ in ()).throw(InterruptedError))
        with pytest.raises(InterruptedError):
            replace_quarters(changed, root, "au_stratum", name="a")
    # Written in full, but not switched to.
    assert rows(read_table(spark, root, "au_stratum")) == before and versions.read_pointer(spark, folder).seq == 0
    replace_quarters(changed, root, "au_stratum", name="a")
    after = rows(read_table(spark, root, "au_stratum"))
    assert rows(early) == before and after != before
    assert sorted(r[0] for r in after) == [1, 2, 3, 9]
    assert {r for (r,) in rows(read_table(spark, root, "au_stratum"), "sda_rule")} == {"FPN"}
    replace_quarters(read_table(spark, root, "au_stratum").where("false"), root, "au_stratum", name="b")
    replace_quarters(changed.withColumn("sda_rule", F.lit("NOR")), root, "au_stratum", name="a")
    assert rows(read_table(spark, root, "au_stratum")) == after and versions.read_pointer(spark, folder).seq == 1
    with pytest.raises(ValueError, match="replaced quarters"):
        append_rows(table, root, "au_stratum")


def test_versions_are_pruned_and_older_ones_shadowed(spark, make, tmp_path):
    root, folder = str(tmp_path), str(tmp_path / "au_stratum")
    append_rows(strata(make), root, "au_stratum")
    for rule in ("FPN", "PQD", "FPC"):
        july = read_table(spark, root, "au_stratum").where("start_date = DATE '2020-07-01'")
        replace_quarters(july.withColumn("sda_rule", F.lit(rule)), root, "au_stratum", name=rule)
    table = read_table(spark, root, "au_stratum")
    assert rows(table, "au_stratum_id", "sda_rule") == [(1, "NOR"), (2, "FPC"), (3, "FPC")]
    assert versions.read_pointer(spark, folder).versions == {date(2020, 7, 1): "FPC"}
    current = [f for f in table.inputFiles() if "/_versions/" in f]
    assert current and all("/version=FPC/start_date=2020-07-01/" in f for f in current)
    plan = table.where("start_date = DATE '2020-04-01'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and "PartitionFilters: []" not in plan


def test_state_goes_with_the_version_it_was_made_for(spark, make, tmp_path):
    root, folder = str(tmp_path), str(tmp_path / "au_stratum")
    append_rows(strata(make), root, "au_stratum")
    assert versions.read_state(spark, folder, date(2020, 1, 1)) is None
    table = read_table(spark, root, "au_stratum")
    replace_quarters(table, root, "au_stratum", name="a", state=table.select("auth_no"), since=date(2020, 1, 1))
    assert versions.read_state(spark, folder, date(2020, 1, 1)).count() == 3
    assert versions.read_state(spark, folder, date(2020, 4, 1)) is None
    replace_quarters(table, root, "au_stratum", name="b")
    assert versions.read_state(spark, folder, date(2020, 1, 1)) is None


def test_the_last_step_of_the_last_run_counts(spark, tmp_path):
    root = str(tmp_path)
    assert runs.last_run(spark, root) is None
    first = runs.Run(date(2020, 4, 1), 1, runs.RESERVED, date(2020, 4, 9), date(2020, 4, 10), datetime(2020, 4, 10, 1, 2, 3, 456789), 5, 6)
    runs.record(spark, root, first)
    assert runs.last_run(spark, root) == first
    staged = runs.advance(spark, root, first, runs.STAGED, "/stages")
    assert runs.last_run(spark, root) == staged and staged.stages == "/stages" and staged.now == first.now
    done = runs.advance(spark, root, staged, runs.DONE)
    assert runs.last_run(spark, root) == done
    second = runs.record(spark, root, runs.Run(date(2020, 4, 1), 2, runs.RESERVED, date(2020, 4, 9), date(2020, 4, 10), NOW, 7, 8))
    assert runs.last_run(spark, root) == second and second.name == "2020-04-01-2"
