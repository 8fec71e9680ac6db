"""Tables whose quarters are replaced by new versions, and a pointer that is switched last.

Under a table's folder, the files it was ingested with stay as they are. A replacement writes
its quarters to `_versions/version=NAME/start_date=DAY` and, beside them, what derives from
the table to `_state/version=NAME`. Then one small file in `_pointer` names the version of every
replaced quarter. A reader takes the newest such file once and sees the table before the
replacement or after it, never a mix, whatever else fails or is still being written. Folders no
longer pointed to may be expired once no reader uses them.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION = "start_date"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder of rows without a date
POINTER = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("version", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("since", T.DateType()),
])


@dataclass(frozen=True)
class Pointer:
    """Which version holds each replaced quarter; `state` names the version of the derived state
    and `since` what it was made for."""

    seq: int = 0
    versions: dict[date | None, str] = field(default_factory=dict)
    state: str | None = None
    since: date | None = None


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise


def read_pointer(spark: SparkSession, folder: str, before: str | None = None) -> Pointer:
    """The newest pointer of a table's folder, or the one in force when a version was switched in;
    an empty one where no quarter had been replaced."""
    log = read_if_there(spark, f"{folder}/_pointer", POINTER)
    if before is not None:
        first = log.where(F.col("version") == before).agg(F.min("seq")).first()[0] if log is not None else None
        if first is None:
            raise ValueError(f"{folder} has no version {before}")
        log = log.where(F.col("seq") < first)
    seq = log.agg(F.max("seq")).first()[0] if log is not None else None
    if seq is None:
        return Pointer()
    rows = log.where(F.col("seq") == seq).collect()  # one row per replaced quarter
    versions = {row.start_date: row.version for row in rows}
    if len(versions) != len(rows):
        raise ValueError(f"two writers have switched {folder} at once")
    return Pointer(seq, versions, rows[0].state, rows[0].since)


def _switch(spark: SparkSession, folder: str, pointer: Pointer) -> None:
    rows = [(pointer.seq, day, name, pointer.state, pointer.since) for day, name in pointer.versions.items()]
    spark.createDataFrame(rows, POINTER).coalesce(1).write.mode("append").parquet(f"{folder}/_pointer")


def read_versioned(
    spark: SparkSession, folder: str, schema: T.StructType, before: str | None = None
) -> DataFrame | None:
    """A table as its pointer shows it, or did before a version was switched in; None if there is
    no such folder."""
    pointer = read_pointer(spark, folder, before)
    base = read_if_there(spark, folder, schema)
    if not pointer.versions:
        return base
    days = [day for day in pointer.versions if day is not None]
    # Both parts of the condition are on the partition column: replaced quarters are not listed.
    undated = F.col(PARTITION).isNull()
    kept = ~F.col(PARTITION).isin(days) if days else ~undated
    base = base.where(kept if None in pointer.versions else kept | undated)
    root = f"{folder}/_versions"
    paths = [f"{root}/version={name}/{PARTITION}={day or NO_DATE}" for day, name in pointer.versions.items()]
    fields = [T.StructField("version", T.StringType()), *schema.fields]
    current = spark.read.schema(T.StructType(fields)).option("basePath", root).parquet(*paths)
    return base.select(*schema.fieldNames()).unionByName(current.select(*schema.fieldNames()))


def read_state(
    spark: SparkSession, folder: str, since: date, before: str | None = None
) -> DataFrame | None:
    """The state written with the version in force, if there is one for `since`."""
    pointer = read_pointer(spark, folder, before)
    if pointer.state is None or pointer.since != since:
        return None
    return spark.read.parquet(f"{folder}/_state/version={pointer.state}")


def replace_versions(
    df: DataFrame, folder: str, name: str, state: DataFrame | None = None, since: date | None = None
) -> None:
    """Put the quarters that occur in `df`, already in the table's columns, in place of the stored ones.

    Nothing that is being read is overwritten, so `df` and `state` may derive from the table.
    A name that the pointer already shows was switched to before, and is left alone; one whose
    writing broke off is written again. Without a `state` there is none from then on, as
    the one before no longer fits.
    """
    spark = df.sparkSession
    pointer = read_pointer(spark, folder)
    if name in pointer.versions.values():
        return
    version = f"{folder}/_versions/version={name}"
    df.write.mode("overwrite").partitionBy(PARTITION).parquet(version)
    if state is not None:
        state.write.mode("overwrite").parquet(f"{folder}/_state/version={name}")
    written = spark.read.schema(df.schema).parquet(version)
    days = [row[0] for row in written.select(PARTITION).distinct().collect()]  # a few quarters
    versions = {**pointer.versions, **dict.fromkeys(days, name)}
    if days:
        _switch(spark, folder, Pointer(pointer.seq + 1, versions, name if state is not None else None, since))
