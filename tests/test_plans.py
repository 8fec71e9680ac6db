"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest
from checks.config import CALC, SDA_END, SDA_START
from checks.proxies import Proxies
from checks.queries import QUERIES
from conftest import rows
from pyspark.sql import functions as F

from doseline.functions import codes, ranges
from doseline.operators import dosage, intervals, risk, scoring
from doseline.sources.tables import ingest_table, read_table

SMALL = "/root/testdata/sf0.001"
LIGHT = [
    "population", "latest_score_fallback", "adult_assessment", "chronic_conditions", "high_utilization",
    "justice_events", "merge_intervals_lag", "merge_intervals_runmax", "prior_episode", "hours_in_interval",
    "payment_rule", "apply_links", "shadow_delta", "service_hours_daily",
]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LIGHT)
def test_no_cross_joins_and_no_python(spark, name):
    plan = physical(QUERIES[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroups"):
        assert bad not in plan, (name, bad)


def test_latest_record_is_thinned_before_the_shuffle(spark):
    plan = physical(risk.latest_scores(Proxies(spark, SMALL)["ep_locus"], CALC))
    final, exchange, partial = (plan.index(s) for s in ("Final", "Exchange hashpartitioning", "Partial"))
    assert "WindowGroupLimit" in plan and final < exchange < partial


def test_config_tables_are_broadcast_and_only_within_the_size_limit(spark):
    t = Proxies(spark, SMALL)
    long = t["case_rate"].select(
        "kcid", "auth_no", F.lit("400").alias("program"), "age_group", F.lit(CALC).alias("calc_date"),
        F.lit("LOCUS").alias("metric"), F.lit(10).cast("decimal(18,3)").alias("value"), F.lit("N").alias("missing_data"),
    )
    lines = scoring.score_lines(long, t["cd_stratum_pop_model"])
    assert physical(lines).count("BroadcastHashJoin") == 2
    expected = rows(lines)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = scoring.score_lines(long, t["cd_stratum_pop_model"])
        assert "Broadcast" not in physical(shuffled)
        assert rows(shuffled) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_service_scan_is_pruned_and_filtered(spark, make, tmp_path):
    path = str(tmp_path / "services")
    make("ea_cpt_service", (1, "1998-10-01", 30, 1)).withColumn("note", F.lit("x")).write.parquet(path)
    plan = physical(dosage.service_hours(spark.read.parquet(path), SDA_START, SDA_END))
    assert "note" not in plan.split("ReadSchema")[1]
    pushed = plan.split("PushedFilters:")[1].split("]")[0]
    assert "event_date" in pushed and "service_minutes" in pushed


def test_hot_keys_give_the_same_results(spark):
    """A third of all rows on one person: results do not change for the others."""
    cold = spark.range(600).selectExpr(
        "id % 60 + 10 AS k", "date_add(DATE '2019-01-01', CAST(id * 37 % 800 AS INT)) AS s",
        "date_add(DATE '2019-01-01', CAST(id * 37 % 800 + id % 40 AS INT)) AS e", "id AS auth_no",
    )
    hot = spark.range(600, 900).selectExpr(
        "1L AS k", "date_add(DATE '2019-01-01', CAST(id * 53 % 800 AS INT)) AS s",
        "date_add(DATE '2019-01-01', CAST(id * 53 % 800 + id % 40 AS INT)) AS e", "id AS auth_no",
    )
    both = cold.unionByName(hot)
    merged = intervals.merge_intervals(both, ["k"], "s", "e")
    assert rows(merged.where("k <> 1")) == rows(intervals.merge_intervals(cold, ["k"], "s", "e"))
    assert rows(merged.where("k = 1")) == rows(intervals.merge_intervals(hot, ["k"], "s", "e"))


def test_hot_interval_key_is_sliced(spark):
    df = spark.createDataFrame([], "k long, s date, e date")
    plan = physical(intervals.merge_intervals(df, ["k"], "s", "e"))
    rowwise = [line for line in plan.splitlines() if "lag(e" in line]
    assert rowwise and all("_slice" in line for line in rowwise)


@pytest.mark.parametrize(
    ("table", "build", "pushed"),
    [
        ("au_master", lambda t, df: df.where(codes.in_scope(F.col("program"), F.col("status_code"))).where(
            ranges.overlaps(F.col("start_date"), F.col("expire_date"), "1999-01-01", "1999-03-31")),
         ["start_date", "expire_date", "In(program", "In(status_code"]),
        ("mcaid_elig_timevar", lambda t, df: risk.coverage_missing_flag(df, t["mcaid_claim_header"], CALC), ["from_date", "to_date"]),
        ("mcaid_claim_ccw", lambda t, df: risk.condition_flags(df, t["mcaid_elig_timevar"], t["mcaid_claim_header"], CALC), ["In(ccw_desc", "from_date"]),
        ("ep_residence", lambda t, df: risk.homeless_state(df, CALC), ["start_date"]),
        ("crisis_au_master", lambda t, df: risk.crisis_events(df, t["ip_master"], CALC), ["In(program", "In(status_code", "start_date"]),
        ("ep_jail", lambda t, df: risk.normalize_stays(df, t["muni_jail"], "1994-01-01", "1999-01-01"), ["book_date", "release_date"]),
    ],
)
def test_filters_reach_the_scan_of_an_ingested_table(spark, tmp_path, table, build, pushed):
    t = Proxies(spark, SMALL)
    ingest_table(t[table].limit(5), str(tmp_path), table)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = build(t, read_table(spark, str(tmp_path), table))._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if str(tmp_path) in line)
    found = scan.split("PushedFilters:")[1].split("ReadSchema")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert all(p in found for p in pushed), found


def test_population_is_dealt_by_authorization_once_and_by_person_once(spark):
    """Strata, case rates and plans meet it by authorization, person and Medicaid id by person."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = QUERIES["population"](spark, SMALL)._jdf.queryExecution().executedPlan().treeString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert tree.count("Exchange hashpartitioning") <= 7 and "hashpartitioning(kcid, auth_no" not in tree


@pytest.mark.parametrize(("name", "most"), [("payment_rule", 12), ("pay_multiplier", 12), ("levels_in_row", 4)])
def test_no_more_exchanges_than_needed(spark, name, most):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().treeString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Of levels_in_row only the configuration and the rows that meet it are dealt.
    assert tree.count("Exchange hashpartitioning") <= most, tree
