"""Tables dealt into buckets by a key when they are written, so that joins on it need no shuffle.

Files carry no record of their buckets; only a catalog's table does. Here one line in `_buckets`
beside the files says how they are dealt, and a reader declares the table to its own session's
catalog from that line, under a name of the line's. Rewritten files get a new line and so a new
name, and a session never takes the old listing for the new files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from doseline.sources.versions import read_if_there

LAYOUT = "_buckets"
LINE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("buckets", T.IntegerType()),
])


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write a table in place of the one at `path`, in one file a bucket, ordered by the key.

    A bucket is read by one task, so their number should make them of the size of a partition,
    and be no less than that of the shuffle partitions, or Spark deals the table anew. All rows
    of a key share a bucket, and rows without a key one: it should be a key of few rows each.
    """
    spark = df.sparkSession
    name = f"doseline_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    dealt.option("path", path).format("parquet").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files are not the catalog's and stay
    line = spark.createDataFrame([(name, key, buckets)], LINE).coalesce(1)
    line.write.parquet(f"{path}/{LAYOUT}")


def layout_of(spark: SparkSession, path: str) -> tuple[str, str, int] | None:
    """Name, key and number of buckets of the table at `path`; None where it has none."""
    line = read_if_there(spark, f"{path}/{LAYOUT}", LINE)
    return None if line is None else tuple(line.first())


def read_whole(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table at `path`, by its buckets where it has them; None if there is no such folder."""
    layout = layout_of(spark, path)
    if layout is None:
        return read_if_there(spark, path, schema)
    name, key, buckets = layout
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet
        CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'"""
    )
    return spark.table(name)
