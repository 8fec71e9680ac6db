"""Session settings and materialization used by the jobs."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# One key may hold a large share of the rows. These let Spark split such a partition at
# run time even where that costs an extra shuffle, and pick join sides by measured size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Partitions of a shuffle are put together up to this size. A task of the dose totals sorts,
# ranks and sums its rows several times over, in about 60 times the bytes it reads, since
# shuffled bytes are compressed; Spark's own 64 MB would be 3 to 4 GB in one task.
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
MOST_READ = 8 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the plans are designed for. A session that already asks for
    smaller partitions keeps them."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if size_in_bytes(spark.conf.get(ADVISORY)) > MOST_READ:
        spark.conf.set(ADVISORY, str(MOST_READ))
    return spark


def size_in_bytes(text: str) -> int:
    """A size as Spark's settings give it: a number of bytes, or one with a unit."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)i?b?\s*", text.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


class Stages:
    """Writes intermediate tables of one run and reads them back.

    A written table cuts the lineage, survives lost executors, has a known size and can
    be pruned by column, so what several later steps read is computed once. The root must
    be a folder that all executors share: the one given, or the one in spark.checkpoint.dir.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        root = root or spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise ValueError("give a shared folder for intermediate tables or set spark.checkpoint.dir")
        self.spark = spark
        self.root = f"{root.rstrip('/')}/run-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
