"""Reading the domain tables, and writing the history tables."""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doseline.session import Stages
from doseline.sources import runs
from doseline.sources.buckets import read_whole, write_bucketed
from doseline.sources.changes import deliver, read_as_of
from doseline.sources.schemas import HISTORY, TABLES
from doseline.sources.versions import read_pointer, read_versioned, replace_versions

# Tables written by start date, so that a quarter can be read or replaced on its own.
PARTITIONED = ["au_stratum", "au_stratum_sda", "au_stratum_shadow"]

# Those of them whose quarters are replaced.
VERSIONED = ["au_stratum"]

# Inputs of one row per key, which may be received as dated changes.
CHANGING = {
    "au_master": ["auth_no"],
    "crisis_au_master": ["auth_no"],
    "au_initial_plan": ["auth_no"],
    "case_rate": ["kcid", "auth_no"],
    "g_person": ["kcid"],
    "g_p1_client": ["kcid"],
}

# The key that tables with few rows per key are joined on most, for dealing them into buckets.
BUCKET_KEYS = {
    "au_master": "auth_no",
    "au_initial_plan": "auth_no",
    "case_rate": "auth_no",
    "crisis_au_master": "auth_no",
    "ip_master": "auth_no",
    "ma_cond_ass": "auth_no",
    "g_person": "kcid",
    "g_p1_client": "kcid",
}

# What tells the appended rows apart. Scores may lack an id, and then share their run's stamp.
KEYS = {
    "au_stratum_score": ["au_stratum_id", "metric", "post_stamp"],
    "au_stratum_sda": ["stratum_sda_id"],
    "au_stratum_shadow": ["au_stratum_id"],
}


def trim_codes(df: DataFrame) -> DataFrame:
    """Drop the trailing blanks of fixed-width text; trailing blanks never tell codes apart."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: F.rtrim(name) for name in text}) if text else df


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast to the declared columns and types of a table; a missing column is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[table].fields])


def ingest_table(df: DataFrame, root: str, table: str, buckets: int | None = None) -> None:
    """Write a table as the library reads it: declared columns and types, codes trimmed.

    Trimmed here once, codes can be compared as they are stored, so that filters on them
    reach the scan. Given a number of `buckets`, a table of BUCKET_KEYS is dealt by its key
    here once, and is not shuffled for joins on it.
    """
    clean = trim_codes(conform(df, table))
    if buckets:
        if table not in BUCKET_KEYS:
            raise ValueError(f"{table} has no key to deal it by, only {', '.join(BUCKET_KEYS)} have")
        write_bucketed(clean, f"{root}/{table}", BUCKET_KEYS[table], buckets)
        return
    writer = clean.write.mode("overwrite")
    if table in PARTITIONED:
        writer = writer.partitionBy("start_date")
    writer.parquet(f"{root}/{table}")


def add_changes(spark: SparkSession, df: DataFrame, root: str, table: str, received: date) -> None:
    """Take in the rows of a table that are new or changed, as of the end of a day.

    They take the place of those with their keys from that day on, while earlier days stay as
    they were. A day that a run of the job has read is complete: a delivery dated on or before
    it is an error, as the run could not be made again.
    """
    run = runs.last_run(spark, root)
    if run and run.as_of >= received:
        raise ValueError(f"a run has read the tables of {run.as_of}; date the delivery later")
    deliver(trim_codes(conform(df, table)), _changing(root, table), received)


def fold_changes(spark: SparkSession, root: str, table: str, received: date) -> None:
    """Write the table as it stood at the end of a day in whole, so that reading that day or later
    ones starts there. Earlier days are still read as before."""
    folder = _changing(root, table)
    deliver(read_table(spark, root, table, as_of=received), folder, received, whole=True)


def _changing(root: str, table: str) -> str:
    if table not in CHANGING:
        raise ValueError(f"{table} is not received as changes, only {', '.join(CHANGING)}")
    return f"{root}/{table}"


def read_table(
    spark: SparkSession, root: str, table: str, fmt: str = "parquet", as_of: date | None = None
) -> DataFrame:
    """An ingested table under `root`; a history table may not exist yet. One received as
    changes is read as it stood at the end of the day `as_of`, by default the last."""
    schema = TABLES[table]
    if table in VERSIONED and fmt == "parquet":
        df = read_versioned(spark, f"{root}/{table}", schema)
        return spark.createDataFrame([], schema) if df is None else df.select(*schema.fieldNames())
    if table in CHANGING and fmt == "parquet":
        df = read_as_of(spark, f"{root}/{table}", schema, CHANGING[table], as_of)
        if df is not None:
            return df
    if table in BUCKET_KEYS and fmt == "parquet":
        df = read_whole(spark, f"{root}/{table}", schema)
        if df is not None:
            return df.select(*schema.fieldNames())
    reader = spark.read.format(fmt).schema(schema)
    try:
        df = reader.load(f"{root}/{table}")
    except AnalysisException as missing:
        if table in HISTORY and "PATH_NOT_FOUND" in str(missing):
            return spark.createDataFrame([], schema)
        raise
    return df.select(*schema.fieldNames())


def read_tables(spark: SparkSession, root: str, as_of: date | None = None) -> dict[str, DataFrame]:
    """Every declared table under one folder; those received as changes as they stood on a day."""
    return {name: read_table(spark, root, name, as_of=as_of) for name in TABLES}


def append_rows(df: DataFrame, root: str, table: str) -> None:
    """Append rows to a history table. One with replaced quarters shows those from their versions
    only, so it is not appended to any more."""
    if table in VERSIONED and read_pointer(df.sparkSession, f"{root}/{table}").versions:
        raise ValueError(f"{table} has replaced quarters; replace quarters of it instead")
    writer = conform(df, table).write.mode("append")
    if table in PARTITIONED:
        writer = writer.partitionBy("start_date")
    writer.parquet(f"{root}/{table}")


def unwritten(df: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of `df` whose keys `stored` does not have; null keys are equal.

    Of `stored`, a whole history, only the range of first keys that `df` has can hold them; the
    rest is left at the scan. For new ids, which follow all others, that is next to nothing.
    """
    first = F.col(keys[0])
    low, high = df.agg(F.min(first), F.max(first)).first()
    near = first.isNull() if low is None else first.isNull() | first.between(low, high)
    known = stored.where(near).select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return df.join(known, same, "left_anti")


def append_new_rows(spark: SparkSession, df: DataFrame, root: str, table: str) -> None:
    """Append the rows the table does not have yet, so that an append can be repeated."""
    stored = read_table(spark, root, table)
    append_rows(unwritten(conform(df, table), stored, KEYS[table]), root, table)


def replace_quarters(
    df: DataFrame, root: str, table: str, stages: Stages | None = None, name: str | None = None,
    state: DataFrame | None = None, since: date | None = None,
) -> None:
    """Replace the start dates that occur in `df`, leaving the table's others alone.

    They are written as a new version, which readers see all at once or not at all. A step
    that is repeated under the same `name` replaces nothing twice. `state` is kept with the
    version, as what derives from the table from `since` on. With `stages` the rows are written
    there first, so that a costly `df` is computed once.
    """
    staged = conform(df, table)
    if stages is not None:
        staged = stages.keep(staged, f"replace-{table}")
    replace_versions(staged, f"{root}/{table}", name or uuid.uuid4().hex, state, since)
