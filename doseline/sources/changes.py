"""Tables received as dated deliveries of changed rows, and how they stood on a day.

The table as it was ingested stays as it is. A delivery holds the rows that are new or changed
since, whole, and takes the place of the rows with their keys. It is written to
`_changes/received=DAY/delivery=NAME` under the table's folder and counts once the log in
`_deliveries` names it, so one that broke off is never seen. A folded delivery holds the whole
table of its day; from that day on a reader starts there. Nothing is overwritten, so a day gives
the same rows however often and however late it is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import astuple, dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doseline.operators.lookups import latest_by
from doseline.sources.buckets import layout_of, read_whole, write_bucketed
from doseline.sources.versions import read_if_there

CHANGES, LOG = "_changes", "_deliveries"
DELIVERED = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("received", T.DateType()),
    T.StructField("delivery", T.StringType()),
    T.StructField("whole", T.BooleanType()),
])
_PLACE = [T.StructField("received", T.DateType()), T.StructField("delivery", T.StringType())]


@dataclass(frozen=True)
class Delivery:
    """One line of the log; `whole` where the rows are the table and not only its changes."""

    seq: int
    received: date
    delivery: str
    whole: bool

    def folder(self, root: str) -> str:
        return f"{root}/{CHANGES}/received={self.received.isoformat()}/delivery={self.delivery}"


def deliveries(spark: SparkSession, folder: str) -> list[Delivery]:
    """The deliveries of a table in their order; a few a day at most."""
    log = read_if_there(spark, f"{folder}/{LOG}", DELIVERED)
    found = [] if log is None else sorted((Delivery(*row) for row in log.collect()), key=lambda d: d.seq)
    if len({d.seq for d in found}) != len(found):
        raise ValueError(f"two deliveries to {folder} were made at once")
    return found


def deliver(df: DataFrame, folder: str, received: date, whole: bool = False) -> None:
    """Write a delivery in the table's columns and put it last in the log. Its day may not lie
    before that of another, nor be one that has been folded, since both have been read already.
    A whole table is dealt into buckets as the ingested one is."""
    spark = df.sparkSession
    known = deliveries(spark, folder)
    late = [d for d in known if d.received > received or (d.whole and d.received == received)]
    if late:
        raise ValueError(f"the rows of {late[-1].received} are complete; date the delivery later")
    new = Delivery(known[-1].seq + 1 if known else 1, received, uuid.uuid4().hex, whole)
    layout = layout_of(spark, folder) if whole else None
    if layout is None:
        df.write.parquet(new.folder(folder))
    else:
        write_bucketed(df, new.folder(folder), *layout[1:])
    line = spark.createDataFrame([astuple(new)], DELIVERED)
    line.coalesce(1).write.mode("append").parquet(f"{folder}/{LOG}")


def read_as_of(
    spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str], as_of: date | None = None
) -> DataFrame | None:
    """The table as it stood at the end of a day, by default the last; None if there is no folder.

    Of the rows with a key the last delivered counts; where one delivery has several, the
    greatest, by its columns from the left. Rows that lack a part of their key take no place
    of others and all count, and so do rows of equal key that were ingested together.

    Only changed rows are ranked. The rest keeps its partitioning and meets nothing but the
    changed keys, which Spark broadcasts while they are few, so filters still reach its scan.
    """
    known = [d for d in deliveries(spark, folder) if as_of is None or d.received <= as_of]
    start = max((i for i, d in enumerate(known) if d.whole), default=None)
    names = schema.fieldNames()
    if start is None:
        whole = read_whole(spark, folder, schema)
        parts = known
    else:
        whole = read_whole(spark, known[start].folder(folder), schema)
        parts = known[start + 1 :]
    if whole is None or not parts:
        return whole if whole is None else whole.select(*names)
    # The place of a row is its folder, so one scan reads all deliveries.
    place = {name: f"_{name}" for name in ("received", "delivery")}
    order = F.create_map(*[F.lit(x) for d in parts for x in (d.delivery, d.seq)])
    fields = T.StructType([*schema.fields, *_PLACE])
    reader = spark.read.schema(fields).option("basePath", f"{folder}/{CHANGES}")
    changed = reader.parquet(*[d.folder(folder) for d in parts]).withColumnsRenamed(place)
    changed = changed.withColumn("_seq", order[F.col("_delivery")]).drop(*place.values())
    has_key = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    last = latest_by(changed.where(has_key), keys, [F.desc("_seq"), *[F.desc_nulls_last(n) for n in names]])
    taken = changed.where(has_key).select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_{k}") for k in keys])
    stayed = whole.select(*names).join(taken, same, "left_anti")
    unkeyed = changed.where(~has_key)
    return stayed.unionByName(last.select(*names)).unionByName(unkeyed.select(*names))
