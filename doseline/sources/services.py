"""Services received in batches, and the daily hours kept of them by month.

A batch is written to a folder of its own, by month, so that writing it again replaces it. Which
months it has is recorded first and ticked off when their daily hours have been made anew: a
month's hours are read from all batches of that month and switched in as a version. So a run
reads the daily hours of its three months, and only months that received rows are summed again.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doseline.functions.dates import as_date
from doseline.operators.dosage import service_hours
from doseline.sources.schemas import TABLES
from doseline.sources.tables import conform, trim_codes
from doseline.sources.versions import read_if_there, read_versioned, replace_versions

SERVICES, DAILY = "ea_cpt_service", "daily_hours"
RECEIVED = T.StructType([T.StructField("batch", T.StringType()), T.StructField("month", T.DateType())])
DONE = T.StructType([T.StructField("batch", T.StringType())])
HOURS_SCHEMA = T.StructType([
    T.StructField("auth_no", T.LongType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("micro_hrs", T.LongType()),
    T.StructField("start_date", T.DateType()),  # of the month
])


def add_services(spark: SparkSession, df: DataFrame, root: str, batch: str) -> None:
    """Write a batch of services under `root`; the same batch again takes the place of the first.

    Its old months, if it had others, and its new ones count as changed.
    """
    rows = trim_codes(conform(df, SERVICES)).withColumn("month", F.trunc("event_date", "month"))
    months = [row.month for row in rows.select("month").distinct().collect()]  # few
    # Before the rows: a job that dies between leaves a month to be made again, not one forgotten.
    token = f"{batch}/{uuid.uuid4().hex}"
    listed = spark.createDataFrame([(token, month) for month in months], RECEIVED).coalesce(1)
    folder = f"{root}/{SERVICES}"
    earlier = read_if_there(spark, f"{folder}/_received", RECEIVED)
    if earlier is not None:
        old = earlier.where(F.col("batch").startswith(f"{batch}/")).select(F.lit(token).alias("batch"), "month")
        listed = listed.unionByName(old).distinct().coalesce(1)
    listed.write.mode("append").parquet(f"{folder}/_received")
    rows.write.mode("overwrite").partitionBy("month").parquet(f"{folder}/batch={batch}")


def read_services(spark: SparkSession, root: str, months: list[date] | None = None) -> DataFrame:
    """The services of all batches, or only those of some months, each given by its first day."""
    extra = [T.StructField("batch", T.StringType()), T.StructField("month", T.DateType())]
    rows = spark.read.schema(T.StructType([*TABLES[SERVICES].fields, *extra])).parquet(f"{root}/{SERVICES}")
    if months is not None:
        rows = rows.where(F.col("month").isin(months) if months else F.lit(False))
    return rows.select(*TABLES[SERVICES].fieldNames())


def has_batches(spark: SparkSession, root: str) -> bool:
    return read_if_there(spark, f"{root}/{SERVICES}/_received", RECEIVED) is not None


def refresh_daily_hours(spark: SparkSession, root: str) -> list[date]:
    """Make the daily hours of changed months anew; returns these months."""
    received = read_if_there(spark, f"{root}/{SERVICES}/_received", RECEIVED)
    if received is None:
        return []
    done = read_if_there(spark, f"{root}/{DAILY}/_done", DONE)
    open_rows = (received if done is None else received.join(done, "batch", "left_anti")).collect()
    months = sorted({row.month for row in open_rows if row.month is not None})
    if not open_rows:
        return []
    if months:
        last = F.last_day(F.lit(months[-1]))
        hours = service_hours(read_services(spark, root, months), months[0], last)
        dated = hours.withColumn("start_date", F.trunc("event_date", "month"))
        kept = dated.select(*[F.col(f.name).cast(f.dataType) for f in HOURS_SCHEMA.fields])
        # A month that has no counted service left is replaced by one row without hours.
        empty = spark.createDataFrame([(None, None, None, month) for month in months], HOURS_SCHEMA)
        replace_versions(kept.unionByName(empty), f"{root}/{DAILY}", uuid.uuid4().hex)
    ticks = spark.createDataFrame(sorted({(row.batch,) for row in open_rows}), DONE)
    ticks.coalesce(1).write.mode("append").parquet(f"{root}/{DAILY}/_done")
    return months


def read_daily_hours(spark: SparkSession, root: str, s: date, e: date) -> DataFrame:
    """Delivered hours per authorization and day from `s` to `e`, as `service_hours` gives them.
    Only the months of that window are read."""
    hours = read_versioned(spark, f"{root}/{DAILY}", HOURS_SCHEMA)
    if hours is None:
        hours = spark.createDataFrame([], HOURS_SCHEMA)
    day = F.col("event_date").between(as_date(s), as_date(e))
    month = F.col("start_date").between(as_date(s.replace(day=1)), as_date(e))
    return hours.where(month & day).select("auth_no", "event_date", "micro_hrs")
