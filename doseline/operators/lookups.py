"""Lookups: latest record, fallback, presence flags and versioned range tables.

Reductions to one row per key keep their map-side half, so that a key holding a large
share of the rows is thinned before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in `order`, which should be total.

    Spark turns the `= 1` filter into a group limit on both sides of the shuffle, so
    each map task sends at most one row per key.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def lookup(df: DataFrame, right: DataFrame, on: str, key: str, spread_by: str) -> DataFrame:
    """Left join to a table with one row per `key`, where `on` is often null.

    A null matches nothing, and all nulls would meet in one partition. Here each is joined
    under a stand-in derived from `spread_by` instead, and what a stand-in may happen to
    match is dropped again, so the result is that of the plain join. The right side keeps
    the partitioning it has on its key.
    """
    stand_in = F.xxhash64(spread_by)
    if dict(right.dtypes)[key] == "string":
        stand_in = F.concat(F.lit("null "), stand_in.cast("string"))
    left = df.withColumn("_on", F.coalesce(F.col(on), stand_in))
    side = right.withColumnRenamed(key, "_key")
    found = [
        F.when(F.col(on).isNotNull(), F.col(c)).alias(c) for c in right.columns if c != key
    ]
    joined = left.join(side, F.col("_on") == F.col("_key"), "left")
    return joined.select(*df.columns, *found)


def limited(df: DataFrame, to: DataFrame, key: str) -> DataFrame:
    """The rows of a table reduced by `key` whose key occurs in `to`.

    Where the keys are few enough to be broadcast, Spark moves this below the reduction, to
    the scan; otherwise it runs on the partitioning the reduction has made.
    """
    return df.join(to.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi")


def attach(df: DataFrame, right: DataFrame, on: Sequence[str], fill: dict | None = None) -> DataFrame:
    """Left join on equal names, then fill the named new columns where nothing matched."""
    joined = df.join(right, list(on), "left")
    return joined.fillna(fill) if fill else joined


def latest_with_fallback(
    df: DataFrame,
    own: DataFrame,
    other: DataFrame,
    person: str,
    source: str,
    value: str,
    alias: str,
) -> DataFrame:
    """Attach `value` of the person at the same source, else of the person anywhere.

    `own` and `other` hold one row per (person, source), with the event date; the
    fallback is the latest of those, ties going to the smallest source.
    """
    mine = own.select(person, source, F.col(value).alias("_own"))
    anywhere = latest_by(other, [person], [F.desc("event_date"), F.asc(source)]).select(
        person, F.col(value).alias("_other")
    )
    return (
        df.join(mine, [person, source], "left")
        .join(anywhere, person, "left")
        .withColumn(alias, F.coalesce("_own", "_other"))
        .drop("_own", "_other")
    )


def presence_flag(df: DataFrame, sources: Sequence[DataFrame], key: str, alias: str) -> DataFrame:
    """1 where the key occurs in any of the one-column sources, else 0."""
    seen = sources[0]
    for source in sources[1:]:
        seen = seen.unionByName(source)
    return attach(df, seen.distinct().withColumn(alias, F.lit(1)), [key], {alias: 0})


def latest_state(df: DataFrame, key: str, day: str, is_state: Column, alias: str) -> DataFrame:
    """Per key, 1 if any of the rows tied on the latest day is in the state, else 0.

    Day and state travel in one integer, so a single hash aggregate finds both.
    """
    packed = F.unix_date(day) * 2 + F.coalesce(is_state, F.lit(False)).cast("int")
    return df.groupBy(key).agg(F.pmod(F.max(packed), F.lit(2)).cast("int").alias(alias))


def range_lookup(
    df: DataFrame,
    table: DataFrame,
    equal: dict[str, str],
    value: str,
    low: str,
    high: str,
    take: Sequence[str],
    as_of: str | None = None,
    valid: tuple[str, str] = ("start_date", "end_date"),
) -> DataFrame:
    """Left join to an effective-dated table of inclusive value ranges.

    `equal` maps columns of `df` to columns of `table`; `take` are the table columns to
    add. Ranges that overlap give one row each. The table is configuration: Spark
    broadcasts it while its size is under the session's threshold, and falls back to a
    shuffled join on the equal keys beyond that.
    """
    needed = [*equal.values(), low, high, *take, *(valid if as_of else ())]
    side = table.select(*[F.col(c).alias(f"_t_{c}") for c in dict.fromkeys(needed)])
    match = F.col(value).between(F.col(f"_t_{low}"), F.col(f"_t_{high}"))
    for mine, theirs in equal.items():
        match = match & (F.col(mine) == F.col(f"_t_{theirs}"))
    if as_of:
        match = match & F.col(as_of).between(F.col(f"_t_{valid[0]}"), F.col(f"_t_{valid[1]}"))
    added = [F.col(f"_t_{c}").alias(c) for c in take]
    return df.join(side, match, "left").select(*df.columns, *added)
