"""The log of published runs, by which a job that died is finished and not started anew.

A run passes three steps, each recorded by one appended file: `reserved`, with all that a rerun
must take from it rather than from its own day (dates, stamp and the ids in use before);
`staged`, when every row it will publish has been written, with their folder; `done`.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace
from datetime import date, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doseline.sources.versions import read_if_there

FOLDER = "_runs"
RESERVED, STAGED, DONE = "reserved", "staged", "done"
LOG = T.StructType([
    T.StructField("quarter", T.DateType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("step", T.StringType()),
    T.StructField("calc_date", T.DateType()),
    T.StructField("as_of", T.DateType()),
    T.StructField("now", T.TimestampType()),
    T.StructField("after_stratum_id", T.LongType()),
    T.StructField("after_ratio_id", T.LongType()),
    T.StructField("stages", T.StringType()),
])


@dataclass(frozen=True)
class Run:
    """One run of a quarter, at the step it has reached."""

    quarter: date
    attempt: int
    step: str
    calc_date: date
    as_of: date
    now: datetime
    after_stratum_id: int
    after_ratio_id: int
    stages: str | None = None

    @property
    def name(self) -> str:
        return f"{self.quarter.isoformat()}-{self.attempt}"


def last_run(spark: SparkSession, root: str, quarter: date | None = None) -> Run | None:
    """The latest run under `root`, or of one quarter, at the last step it reached. Attempts are
    numbered over all quarters, and only one run at a time is under way."""
    log = read_if_there(spark, f"{root}/{FOLDER}", LOG)
    if log is None:
        return None
    if quarter is not None:
        log = log.where(F.col("quarter") == quarter)
    order = F.struct("attempt", F.array_position(F.array(*map(F.lit, (RESERVED, STAGED, DONE))), F.col("step")))
    found = log.select(F.max_by(F.struct(*LOG.fieldNames()), order).alias("run")).first().run
    return Run(**found.asDict()) if found else None


def record(spark: SparkSession, root: str, run: Run) -> Run:
    """Append the step a run has reached."""
    rows = [tuple(asdict(run)[name] for name in LOG.fieldNames())]
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{root}/{FOLDER}")
    return run


def advance(spark: SparkSession, root: str, run: Run, step: str, stages: str | None = None) -> Run:
    return record(spark, root, replace(run, step=step, stages=stages or run.stages))
