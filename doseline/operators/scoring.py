"""Scoring: unpivot risk inputs, score them against the model, total and tier."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doseline.functions.dates import as_date
from doseline.operators.lookups import attach, range_lookup

IDS = ["kcid", "auth_no", "program", "age_group", "calc_date"]
TOTAL_KEYS = ["auth_no", "program", "age_group", "calc_date"]
VALUE = "decimal(18,3)"
YOUNG_AGE, YOUNG_LEVEL = 6, "H"


def active_metrics(config: DataFrame, calc: date | str | Column, columns: Iterable[str]) -> DataFrame:
    """Metrics in force on the calculation date that exist among `columns`, one row each."""
    in_force = as_date(calc).between(F.col("start_date"), F.col("end_date"))
    name = F.trim("metric").alias("metric")
    return config.where(in_force).select(name).distinct().where(F.col("metric").isin(list(columns)))


def metric_names(config: DataFrame, calc: date | str | Column, columns: Iterable[str]) -> list[str]:
    """The active metrics as names; a read of configuration only."""
    return sorted(row.metric for row in active_metrics(config, calc, columns).collect())


def to_score_input(df: DataFrame, metrics: list[str], ids: list[str] = IDS) -> DataFrame:
    """One row per id and metric with its value and missing-data flag."""
    lines = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(m).cast(VALUE).alias("value"),
            F.col(f"{m}_missing_data").alias("missing_data"),
        )
        for m in metrics
    ]
    return df.select(*ids, F.explode(F.array(*lines)).alias("_line")).select(*ids, "_line.*")


def restrict_to_model(lines: DataFrame, model: DataFrame) -> DataFrame:
    """Distinct lines whose metric the model version in force uses for program and age."""
    used = model.select(
        "program", "age_group", F.rtrim("metric").alias("metric"), "start_date", "end_date"
    ).distinct()
    same = [lines[c] == used[c] for c in ("program", "age_group", "metric")]
    in_force = lines["calc_date"].between(used["start_date"], used["end_date"])
    return lines.join(used, [*same, in_force], "left_semi").distinct()


def score_lines(lines: DataFrame, model: DataFrame) -> DataFrame:
    """Score each line by its value's range in the model; 0 where no range holds it."""
    trimmed = model.withColumn("metric", F.rtrim("metric"))
    scored = range_lookup(
        restrict_to_model(lines, model),
        trimmed,
        {"program": "program", "age_group": "age_group", "metric": "metric"},
        "value",
        "range_low",
        "range_high",
        ["score"],
        as_of="calc_date",
    )
    score = F.coalesce("score", F.lit(0).cast(VALUE)).cast(VALUE).alias("score")
    return scored.select(*TOTAL_KEYS, "metric", "value", score, "missing_data")


def total_score(lines: DataFrame) -> DataFrame:
    """Summed score and worst flag per authorization; incomplete keys have no total."""
    complete = lines.na.drop(subset=TOTAL_KEYS)
    return complete.groupBy(*TOTAL_KEYS).agg(
        F.sum("score").cast(VALUE).alias("total_score"),
        F.max("missing_data").alias("missing_data"),
    )


def tier_lookup(totals: DataFrame, tiers: DataFrame) -> DataFrame:
    """Level and monthly service hours for each total score."""
    return range_lookup(
        totals,
        tiers,
        {"program": "program", "age_group": "age_group"},
        "total_score",
        "range_low",
        "range_high",
        ["strat_level", "svc_hrs_req"],
        as_of="calc_date",
    )


def _ranges_by_key(table: DataFrame, fields: list[str], name: str) -> DataFrame:
    """One row per program and age group with all its ranges of a configuration table, sorted."""
    ranges = F.sort_array(F.collect_list(F.struct("range_low", "range_high", *fields, "start_date", "end_date")))
    keyed = table.where(F.col("program").isNotNull() & F.col("age_group").isNotNull())
    return keyed.groupBy("program", "age_group").agg(ranges.alias(name))


def _in_force(entry: Column, day: Column) -> Column:
    return day.between(entry["start_date"], entry["end_date"])


def _holds(entry: Column, value: Column, day: Column) -> Column:
    return value.between(entry["range_low"], entry["range_high"]) & _in_force(entry, day)


def score_in_row(df: DataFrame, metrics: list[str], model: DataFrame) -> DataFrame:
    """Adds `lines`, the scored lines of each row as an array, and their `total_score` and
    `missing_data`; the row stays one row.

    The same as unpivoting, restricting to the model, scoring and totalling, for input with one
    row per authorization: the model meets each row once, as the ranges of its program and
    age group, and nothing is shuffled but, beyond the broadcast threshold, the rows by that
    key. A line has the scores of all ranges that hold its value, where there are several.
    """
    # A row compares a value with the ranges of its metric only, and casts it once.
    model = model.withColumn("metric", F.rtrim("metric"))

    def ranges_of(metric: str) -> Column:
        return F.filter("_ranges", lambda entry: entry["metric"] == metric).alias(f"_of_{metric}")

    ranges = _ranges_by_key(model, ["metric", "score"], "_ranges").select(
        "program", "age_group", *map(ranges_of, metrics)
    )
    joined = df.join(ranges, ["program", "age_group"], "left")
    day = F.col("calc_date")
    values = joined.withColumns({f"_value_{m}": F.col(m).cast(VALUE) for m in metrics})
    now = {f"_now_{m}": F.filter(f"_of_{m}", lambda entry: _in_force(entry, day)) for m in metrics}

    def line(metric: str) -> Column:
        value = F.col(f"_value_{metric}")
        held = F.filter(f"_now_{metric}", lambda entry: value.between(entry["range_low"], entry["range_high"]))
        found = F.struct(
            F.lit(metric).alias("metric"), value.alias("value"), F.col(f"{metric}_missing_data").alias("missing_data"),
            F.transform(held, lambda entry: entry["score"].cast(VALUE)).alias("scores"),
        )
        return F.when(F.size(f"_now_{metric}") > 0, found)

    lined = values.withColumns(now).withColumn("lines", F.array_compact(F.array(*map(line, metrics))))
    zero = F.lit(0).cast(VALUE)
    scores = F.flatten(F.transform("lines", lambda entry: entry["scores"]))
    total = F.aggregate(scores, zero, lambda so_far, score: (so_far + F.coalesce(score, zero)).cast(VALUE))
    complete = F.size("lines") > 0
    for key in TOTAL_KEYS:
        complete &= F.col(key).isNotNull()
    return lined.select(
        *[F.col(c) for c in df.columns],
        "lines",
        F.when(complete, total).alias("total_score"),
        F.when(complete, F.array_max(F.transform("lines", lambda entry: entry["missing_data"]))).alias("missing_data"),
    )


def lines_of(scored: DataFrame) -> DataFrame:
    """The lines of `score_in_row` as rows, for storing: one per score, one of 0 without any."""
    each = scored.select(*TOTAL_KEYS, F.explode("lines").alias("line"))
    score = F.explode_outer("line.scores").alias("score")
    rows = each.select(*TOTAL_KEYS, "line.metric", "line.value", score, "line.missing_data")
    return rows.withColumn("score", F.coalesce("score", F.lit(0).cast(VALUE)))


def level_in_row(scored: DataFrame, tiers: DataFrame) -> DataFrame:
    """Adds `strat_level` and `svc_hrs_req` for the total; children under six are high, their hours
    unchanged. Tiers in force that overlap at a total are an error, as one row has one level."""
    joined = scored.join(
        _ranges_by_key(tiers, ["strat_level", "svc_hrs_req"], "_tiers"), ["program", "age_group"], "left"
    )
    held = F.filter("_tiers", lambda entry: _holds(entry, F.col("total_score"), F.col("calc_date")))
    overlap = F.raise_error(F.lit("tiers of one program and age group overlap"))
    found = F.when(F.size("_held") > 1, overlap.cast(_entry_type(tiers))).otherwise(F.get("_held", F.lit(0)))
    young = F.col("age") < YOUNG_AGE
    return joined.withColumn("_held", held).withColumn("_tier", found).select(
        *[F.col(c) for c in scored.columns],
        F.when(young, YOUNG_LEVEL).otherwise(F.col("_tier.strat_level")).alias("strat_level"),
        F.col("_tier.svc_hrs_req").alias("svc_hrs_req"),
    )


def _entry_type(tiers: DataFrame) -> T.StructType:
    names = ["range_low", "range_high", "strat_level", "svc_hrs_req", "start_date", "end_date"]
    return T.StructType([tiers.schema[name] for name in names])


def assign_level(pop: DataFrame, tiers: DataFrame) -> DataFrame:
    """Attach totals and tiers; children under six are high, their hours unchanged."""
    leveled = attach(pop, tiers, TOTAL_KEYS)
    young = F.col("age") < YOUNG_AGE
    return leveled.withColumn(
        "strat_level", F.when(young, YOUNG_LEVEL).otherwise(F.col("strat_level"))
    )


def level_counts(df: DataFrame) -> DataFrame:
    """How many authorizations have each level; those without one are not counted."""
    known = df.where(F.col("strat_level").isNotNull())
    return known.groupBy("strat_level").agg(F.count(F.lit(1)).alias("count"))
