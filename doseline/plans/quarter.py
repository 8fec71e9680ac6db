"""The quarterly job: population, risk inputs, scores, dose ratios, linkage, publishing."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date, datetime, time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doseline.functions.dates import Periods
from doseline.operators import dosage, linkage, population, publish, risk, scoring
from doseline.session import Stages
from doseline.sources import runs
from doseline.sources.schemas import HISTORY
from doseline.sources.services import DAILY, has_batches, read_daily_hours, refresh_daily_hours
from doseline.sources.tables import CHANGING, append_new_rows, conform, read_table, read_tables, replace_quarters
from doseline.sources.versions import read_state, read_versioned

Tables = dict[str, DataFrame]
STATE = "stratum_state"  # of settled strata, among the tables where there is one
STAGED = ["population", "scored", "complete", "strata", "scores", "ratios", "shadow", "replaced", "state"]


@dataclass(frozen=True)
class Options:
    """What differs between runs; the defaults follow the published rules."""

    as_of: date | None = None
    now: datetime | None = None
    linked_since: date = linkage.LINKED_SINCE
    reset_quarter: date | None = date(2020, 7, 1)
    sda_period: str = "lookback"
    tier_as_of: date | None = None
    merge_mode: str = "lag"
    literal_utilization: bool = False
    substance_inputs: bool = False


def side_by_side(*steps: Callable[[], DataFrame]) -> list[DataFrame]:
    """Steps that do not need each other, at the same time: while one is planned or waits for its
    last tasks, the others use the cores."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [started.result() for started in [pool.submit(step) for step in steps]]


def population_of(tables: Tables, periods: Periods, as_of: date) -> DataFrame:
    """The authorizations due in the quarter."""
    return population.select_population(
        tables["au_master"],
        tables["g_person"],
        tables["au_initial_plan"],
        tables["case_rate"],
        tables["au_stratum"],
        tables["g_p1_client"],
        periods.pop_start,
        periods.pop_end,
        as_of,
    )


def with_inputs(pop: DataFrame, tables: Tables, calc: date, options: Options) -> DataFrame:
    """Attach the risk inputs. Those joined on the person come last and in a row, so that
    they share one partitioning of the population."""
    t = tables
    jail_cutoff = population.currency_cutoff(t["muni_jail"], "booking_start", calc).first()[0]
    df = risk.chronic_conditions(
        pop, t["ma_cond_ass"], t["mcaid_claim_ccw"], t["mcaid_elig_timevar"],
        t["mcaid_claim_header"], calc,
    )
    if options.substance_inputs:
        df = risk.asam_level(df, t["ep_asam_placement"], calc)
    df = risk.assessments(df, t["ep_locus"], t["ep_calocus"], calc)
    if options.substance_inputs:
        df = risk.injection_use(df, t["ep_substance_use"], calc)
    df = risk.foster_history(df, t["ep_residence"], t["ep_coverage_mco"], calc)
    df = risk.homeless_now(df, t["ep_residence"], calc)
    df = risk.high_utilization(
        df, t["crisis_au_master"], t["ip_master"], t["cmt_hospital_report"], calc,
        options.literal_utilization,
    )
    return risk.justice_events(df, t["ep_jail"], t["muni_jail"], jail_cutoff, options.merge_mode)


def run_quarter(
    spark: SparkSession,
    tables: Tables,
    calc_date: date,
    options: Options = Options(),
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
    after: tuple[int, int] | None = None,
) -> Tables:
    """Compute one quarter's records and the updated history; writes no history table.

    Returns the new rows (`strata`, `scores`, `ratios`, `shadow`), the linked and reset
    stratum table as of the end of the run (`au_stratum`), those of its quarters the run
    changes (`replaced`), the state of its settled strata (`state`), the level counts
    (`levels`) and the stages they were built from (`population`, `score_lines`, `complete`).

    With the state of the stored strata among the tables, linking reads of them those that
    await their link and the quarters it changes; without, it is made from all of them.
    With the daily hours of the look-back among them, the services are not read.
    `after` are the highest stratum and ratio id in use, sought in the tables unless given.

    `keep` materializes a step under a name; by default it writes to spark.checkpoint.dir.
    What is published is kept, so that publishing reads nothing it writes.
    """
    keep = keep or Stages(spark).keep
    periods = Periods.of(calc_date)
    as_of = options.as_of or calc_date
    now = options.now or datetime.combine(as_of, time())
    history = tables["au_stratum"]
    if after is None:
        after = ids_in_use(tables)

    pop = keep(population_of(tables, periods, as_of), "population")
    since = options.linked_since

    def score() -> DataFrame:
        inputs = keep(with_inputs(pop, tables, calc_date, options), "inputs")
        metrics = scoring.metric_names(tables["cd_stratum_metric"], calc_date, inputs.columns)
        return keep(scoring.score_in_row(inputs, metrics, tables["cd_stratum_pop_model"]), "scored")

    def dose() -> DataFrame:
        return dosage.dose_ratio(
            pop, history, tables["cd_stratum_tier"], tables["au_master"], tables["ea_cpt_service"],
            periods.sda_start, periods.sda_end, tier_as_of=options.tier_as_of,
            keep=keep, hours=tables.get(DAILY),
        )

    def settle() -> DataFrame:
        state = tables.get(STATE)
        return keep(linkage.settled_strata(history, since), "settled") if state is None else state

    scored, ratios, state = side_by_side(score, dose, settle)
    lines = scoring.lines_of(scored)
    leveled = scoring.level_in_row(scored.drop("lines"), tables["cd_stratum_tier"])
    complete = keep(dosage.with_sda(leveled, ratios), "complete")

    strata = publish.new_strata(publish.stratum_rows(complete), after[0], now)
    sda = publish.new_sda(publish.sda_rows(complete, options.sda_period), after[1], now)
    strata, sda = side_by_side(
        lambda: keep(conform(strata, "au_stratum"), "strata"), lambda: keep(conform(sda, "au_stratum_sda"), "ratios")
    )
    everything = history.unionByName(strata)

    def store_scores() -> DataFrame:
        ids = publish.stratum_ids_on(everything, periods.pop_start)
        scores = publish.new_scores(publish.score_rows(lines, ids), now)
        return keep(conform(scores, "au_stratum_score"), "scores")

    def link() -> DataFrame:
        all_ratios = tables["au_stratum_sda"].unionByName(sda)
        unsettled = linkage.awaiting_strata(history, since).unionByName(strata)
        links = linkage.link_strata(
            unsettled, tables["au_master"], all_ratios, tables["cd_stratum_pay_corridor"], since,
            keep=keep, endpoints=linkage.endpoints_from_state(state, unsettled, since),
        )
        return keep(links, "links")

    scores, links = side_by_side(store_scores, link)
    # Few: quarters. Linking touches no others, which are passed through and not read here.
    changed = {row[0] for row in links.select("phs_start_date").distinct().collect()} | {periods.pop_start}
    is_linked = F.col("start_date").isin(sorted(changed))
    linked = linkage.apply_links(everything.where(is_linked), links, now)
    linked = keep(conform(linked, "au_stratum"), "linked")
    state = linkage.combined_states(state, linkage.settled_strata(linked, since))
    final = everything.where(F.col("start_date").isNull() | ~is_linked).unionByName(linked)
    shadow = publish.shadow_delta(final, tables["au_stratum_shadow"])
    if options.reset_quarter is not None:
        final = publish.reset_payments(final, options.reset_quarter)
        changed.add(options.reset_quarter)
    is_changed = F.col("start_date").isin(sorted(changed))
    replaced = final.where(is_changed)
    state, shadow, replaced = side_by_side(
        lambda: keep(state, "state"),
        lambda: keep(conform(shadow, "au_stratum_shadow"), "shadow"),
        lambda: keep(conform(replaced, "au_stratum"), "replaced"),
    )

    return {
        "population": pop,
        "score_lines": lines,
        "complete": complete,
        "levels": scoring.level_counts(complete),
        "strata": strata,
        "scores": scores,
        "ratios": sda,
        "shadow": shadow,
        "au_stratum": final,
        "replaced": replaced,
        "state": state,
    }


def ids_in_use(tables: Tables) -> tuple[int, int]:
    """The highest stratum and ratio id."""
    return (
        publish.highest_id(tables["au_stratum"], "au_stratum_id"),
        publish.highest_id(tables["au_stratum_sda"], "stratum_sda_id"),
    )


def publish_quarter(
    spark: SparkSession, result: Tables, root: str, name: str | None = None, since: date | None = None
) -> None:
    """Write a run's records to the history tables under `root`.

    Appended rows are those the tables do not have yet, and replaced quarters are whole, so
    publishing a result again, or after it was interrupted, ends in the same tables. The
    stratum table comes last, under the version `name`: until it is there, the quarter counts
    as not stratified. Given the option `since` that the state of settled strata was made
    for, the state is kept beside it for the next run.
    """
    append_new_rows(spark, result["scores"], root, "au_stratum_score")
    append_new_rows(spark, result["ratios"], root, "au_stratum_sda")
    append_new_rows(spark, result["shadow"], root, "au_stratum_shadow")
    state = result["state"] if since is not None else None
    replace_quarters(result["replaced"], root, "au_stratum", None, name, state, since)


def stage_quarter(
    spark: SparkSession,
    root: str,
    calc_date: date,
    options: Options = Options(),
    stages: Stages | None = None,
    inputs: Tables | None = None,
) -> runs.Run:
    """Reserve a run of the quarter under `root` and write all rows it will publish to its stages.

    A run that was left is taken up where it stands: one only reserved is computed from its own
    dates, stamp and first ids, one staged is returned as it is.
    """
    stages = stages or Stages(spark)
    quarter = Periods.of(calc_date).pop_start
    run = runs.last_run(spark, root)
    if run and run.step != runs.DONE and run.quarter != quarter:
        raise ValueError(f"the run of {run.quarter} is not finished; run it again first")
    if run and run.step == runs.STAGED:
        return run
    tables = {**(inputs or read_tables(spark, root)), **{n: read_table(spark, root, n) for n in HISTORY}}
    if run is None or run.step == runs.DONE:
        as_of = options.as_of or calc_date
        now = options.now or datetime.combine(as_of, time())
        attempt = run.attempt + 1 if run else 1
        reserved = runs.Run(quarter, attempt, runs.RESERVED, calc_date, as_of, now, *ids_in_use(tables))
        run = runs.record(spark, root, reserved)
    state = read_state(spark, f"{root}/au_stratum", options.linked_since)
    known = tables if state is None else {**tables, STATE: state}
    if inputs is None:
        known |= {name: read_table(spark, root, name, as_of=run.as_of) for name in CHANGING}
    if DAILY not in tables and has_batches(spark, root):
        periods = Periods.of(run.calc_date)
        refresh_daily_hours(spark, root)
        known = {**known, DAILY: read_daily_hours(spark, root, periods.sda_start, periods.sda_end)}
    dated = replace(options, as_of=run.as_of, now=run.now)
    run_quarter(spark, known, run.calc_date, dated, stages.keep, (run.after_stratum_id, run.after_ratio_id))
    return runs.advance(spark, root, run, runs.STAGED, stages.root)


def run_and_publish(
    spark: SparkSession,
    root: str,
    calc_date: date,
    options: Options = Options(),
    stages: Stages | None = None,
    inputs: Tables | None = None,
) -> Tables:
    """The whole job: compute a quarter from the tables under `root` and publish it there.

    A job that died is finished by running it again, on whatever day. Before it computes, a run
    is reserved with its dates, stamp and first ids; once all its rows are written, that is
    recorded too, and only then is anything published. Run again before that point, it computes
    from what was reserved; after it, it publishes the rows written, however the inputs have
    changed since. So no authorization gets a second record. The run of one quarter must be
    finished before that of another starts, and one job works on a `root` at a time.

    `inputs` take the place of tables under `root`; the history tables are always read there, and
    those received as changes as they stood on the run's day.
    Where services were added in batches, the daily hours kept of them are brought up to date
    and read in their stead. Returns what `run_quarter` does, with the stratum table as it is stored.
    """
    run = stage_quarter(spark, root, calc_date, options, stages, inputs)
    result = staged_rows(spark, run)
    publish_quarter(spark, result, root, run.name, options.linked_since)
    runs.advance(spark, root, run, runs.DONE)
    return {**result, "au_stratum": read_table(spark, root, "au_stratum")}


def tables_of_run(
    spark: SparkSession, root: str, run: runs.Run, since: date, inputs: Tables | None = None
) -> Tables:
    """The tables under `root` as a finished run found them.

    Those received as changes stand as on its day. The strata are those before its version was
    switched in, with the state kept of them; ratios and shadow rows are those with ids in use
    before it, or without an id. Tables that carry no dates of receipt (services, assessments,
    claims, stays) are as they are now.
    """
    folder, schema = f"{root}/au_stratum", HISTORY["au_stratum"]
    ratios, shadow = (read_table(spark, root, name) for name in ("au_stratum_sda", "au_stratum_shadow"))
    tables = {
        **(inputs or read_tables(spark, root, run.as_of)),
        "au_stratum": read_versioned(spark, folder, schema, run.name).select(*schema.fieldNames()),
        "au_stratum_sda": ratios.where(F.coalesce("stratum_sda_id", F.lit(0)) <= run.after_ratio_id),
        "au_stratum_shadow": shadow.where(F.coalesce("au_stratum_id", F.lit(0)) <= run.after_stratum_id),
    }
    state = read_state(spark, folder, since, run.name)
    return tables if state is None else {**tables, STATE: state}


def replay_quarter(
    spark: SparkSession,
    root: str,
    quarter: date,
    options: Options = Options(),
    stages: Stages | None = None,
    inputs: Tables | None = None,
) -> Tables:
    """Compute the last finished run of a quarter again, from the tables as that run found them
    and with its dates, stamp and first ids; publishes nothing.

    What was published can so be explained after authorizations have changed: the population is
    that of its day, whatever statuses hold now. The rows for the shadow table are not among the
    results, as older strata that the run copied there are in it by now. `inputs` take the place
    of tables under `root`, but for the history tables.
    """
    run = runs.last_run(spark, root, quarter)
    if run is None or run.step != runs.DONE:
        raise ValueError(f"no run of {quarter} is finished")
    tables = tables_of_run(spark, root, run, options.linked_since, inputs)
    if DAILY not in tables and has_batches(spark, root):
        periods = Periods.of(run.calc_date)
        refresh_daily_hours(spark, root)
        tables[DAILY] = read_daily_hours(spark, root, periods.sda_start, periods.sda_end)
    dated = replace(options, as_of=run.as_of, now=run.now)
    keep = (stages or Stages(spark)).keep
    result = run_quarter(spark, tables, run.calc_date, dated, keep, (run.after_stratum_id, run.after_ratio_id))
    del result["shadow"]
    return result


def staged_rows(spark: SparkSession, run: runs.Run) -> Tables:
    """What a staged run has computed, without the stratum table as a whole."""
    result = {name: spark.read.parquet(f"{run.stages}/{name}") for name in STAGED}
    lines = scoring.lines_of(result.pop("scored"))
    return {**result, "score_lines": lines, "levels": scoring.level_counts(result["complete"])}
