"""Importance resampling towards a target: documents weighted by hashed features, then ranked.

Weights are sums of an array of gains, one per feature bucket. The ranking is a parallel sort
by regular sampling: sorted runs give splitters, the segments between them are exchanged and
merged, and the counts of earlier segments turn places into ranks.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import partial
from math import isqrt
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from doseline.llm.common import keep, ship, struct

# Letters, digits and everything beyond ASCII, after lower-casing; the rest separates words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LONGEST_RUN = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
ROWS_SQUARED = 1024  # segments and the rows of each grow alike, as the root of all rows
SAMPLES = 32  # for each segment, from all runs together


def words_of(text: Column) -> Column:
    """Words of a text, only A-Z lower-cased; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.array_remove(F.split(lowered, BETWEEN), "")


def runs_of(words: Column, n: int) -> Column:
    """Every run of `n` words, joined by blanks."""
    starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
    joined = F.transform(starts, lambda at: F.array_join(F.slice(words, at, n), " "))
    return F.when(F.size(words) >= n, joined).otherwise(F.array().cast("array<string>"))


def features_of(words: Column, longest: int) -> Column:
    """Every run of 1 to `longest` words, repeats included."""
    return F.concat(words, *[runs_of(words, n) for n in range(2, longest + 1)])


def bucket_of(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def bucket_counts(texts: DataFrame, text_col: str, longest: int, buckets: int) -> DataFrame:
    """How many features of all texts fall into each bucket: at most `buckets` rows."""
    words = texts.select(words_of(F.col(text_col)).alias("_words"))
    features = words.select(F.explode(features_of(F.col("_words"), longest)).alias("_feature"))
    return features.groupBy(bucket_of(F.col("_feature"), buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def bucket_gains(
    raw: DataFrame, target: DataFrame, raw_col: str, target_col: str, longest: int, buckets: int
) -> list[int]:
    """Gain of each bucket: 1000 times the log of how much likelier it is in the target,
    one added to each count, cut to whole numbers. The list is as long as `buckets`."""
    own = bucket_counts(raw, raw_col, longest, buckets).select("bucket", F.col("n").alias("s"))
    aimed = bucket_counts(target, target_col, longest, buckets).select("bucket", F.col("n").alias("t"))
    everywhere = raw.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    counts = everywhere.join(own, "bucket", "left").join(aimed, "bucket", "left").na.fill(0)
    totals = Window.partitionBy()
    of_raw, of_target = F.sum("s").over(totals), F.sum("t").over(totals)
    counts = counts.select("bucket", *[
        c.cast("double").alias(name) for name, c in {"s": F.col("s"), "t": F.col("t"), "of_s": of_raw, "of_t": of_target}.items()
    ])
    ratio = (F.col("t") + 1) * (F.col("of_s") + buckets) / ((F.col("s") + 1) * (F.col("of_t") + buckets))
    rows = counts.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain")).collect()
    return [gain for _, gain in sorted(tuple(row) for row in rows)]


def noise(id_col: Column, seed: int) -> Column:
    """A number drawn by the id from a Gumbel distribution, times 1000, cut to a whole number."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def scored(
    docs: DataFrame, gains: list[int], id_col: str, text_col: str, longest: int, least_words: int, seed: int
) -> DataFrame:
    """`_id`, `n_features`, `weight`, `score` of each row, and `_drawable`: whether it has enough words."""
    table = F.split(F.lit(",".join(map(str, gains))), ",").cast("array<long>")
    rows = docs.select(F.col(id_col).alias("_id"), words_of(F.col(text_col)).alias("_words"))
    rows = rows.select("_id", F.size("_words").alias("_size"), features_of(F.col("_words"), longest).alias("_features"))
    weight = F.aggregate(
        "_features", F.lit(0).cast("long"),
        lambda total, feature: total + F.get(table, bucket_of(feature, len(gains))),
    )
    rows = rows.select(
        "_id", F.size("_features").cast("long").alias("n_features"), weight.alias("weight"),
        (F.col("_size") >= least_words).alias("_drawable"),
    )
    return rows.withColumn("score", F.col("weight") + noise(F.col("_id"), seed))


def sorted_runs(rows: DataFrame) -> DataFrame:
    """The rows written in sorted runs, one per partition as it comes, with `_run` and `_place`
    in it, which make every row's place in the order its own. Rows not drawable come last.

    `_place` is the row number of monotonically_increasing_id, whose upper bits are the
    partition. As they are written, a task that runs again later cannot change them.
    """
    order = [F.desc("_drawable"), F.desc("score"), F.asc_nulls_last("_id"), "n_features"]
    ordered = rows.sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()
    placed = ordered.withColumns({"_run": F.shiftright(number, 33), "_place": number.bitwiseAND(F.lit((1 << 33) - 1))})
    return keep(placed, "runs")


def order_key(row: tuple) -> tuple:
    """Sort key of (score, id, features, run, place): highest score, smallest id, null last."""
    score, name, *rest = row
    return (-score, name is None, 0 if name is None else name, *rest)


def splitters_of(drawable: DataFrame, many: int, segments: int) -> list[tuple]:
    """Keys that cut the order into `segments` parts of about the same size.

    Every run gives each `step`-th row, from an offset of its own, as runs may be shorter
    than a step. That is `SAMPLES` rows per segment in all, which are sorted here.
    """
    step = max(1, many // (segments * SAMPLES))
    taken = F.pmod(F.col("_place") + F.xxhash64("_run"), F.lit(step)) == 0
    sample = drawable.where(taken).select("score", "_id", "n_features", "_run", "_place").collect()
    keys = sorted(order_key(tuple(row)) for row in sample)
    return [keys[at * len(keys) // segments] for at in range(1, segments)] if keys else []


def deal(batches: Iterator[pa.RecordBatch], splitters: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Appends each row's segment: how many splitters come before it."""
    for batch in batches:
        parts = [batch.column(name).to_pylist() for name in ("score", "_id", "n_features", "_run", "_place")]
        places = [bisect_left(splitters, order_key(row)) for row in zip(*parts, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int32())], schema=schema)


def ranks(drawable: DataFrame, drawn: int, many: int) -> DataFrame:
    """(`_run`, `_place`, `rank`) of the first `drawn` of `many` sorted rows.

    Segments that start beyond the rows drawn are not exchanged at all.
    """
    segments = max(1, isqrt(many // ROWS_SQUARED))
    splitters = splitters_of(drawable, many, segments)
    narrow = drawable.select("score", "_id", "n_features", "_run", "_place")
    schema = T.StructType([*narrow.schema.fields, T.StructField("_segment", T.IntegerType())])
    dealt = narrow.mapInArrow(partial(deal, splitters=splitters, schema=to_arrow_schema(schema)), schema)
    sizes = dealt.groupBy("_segment").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_segment", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    # One row per segment, whose number grows as the root of the rows.
    offsets = offsets.where(F.col("_before") < drawn)
    exchanged = dealt.join(F.broadcast(offsets), "_segment")
    merged = Window.partitionBy("_segment").orderBy(
        F.desc("score"), F.asc_nulls_last("_id"), "n_features", "_run", "_place"
    )
    ranked = exchanged.withColumn("rank", F.row_number().over(merged) + F.col("_before"))
    return ranked.where(F.col("rank") <= drawn).select("_run", "_place", "rank")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    longest: int = LONGEST_RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """One row per input row: id, `n_features`, `weight`, `score`, `rank`.

    Features are runs of 1 to `longest` words, counted in `buckets` hash buckets over all of
    `docs` and all of `target`. A row's weight sums the gains of its features' buckets; its
    score adds noise drawn by its id, so that taking the highest scores samples without
    replacement in proportion to the weights. Of the rows with at least `least_words` words,
    the highest `percent` in a hundred are drawn and ranked from 1; others have no rank.

    Only the gains, of fixed number, and sampled keys, `SAMPLES` for each of a number of
    segments that grows as the root of the rows, reach the driver.

    Null and empty texts have no features and weight 0. Equal scores are ordered by id, a
    null id last, its noise drawn from the word null; then by features. Rows that repeat an
    id share its noise; equal rows take neighbouring ranks. Without a target all buckets
    lean on `docs` alone. Other columns are not read; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    gains = bucket_gains(docs, target, text_col, target_text_col, longest, buckets)
    runs = sorted_runs(scored(docs, gains, id_col, text_col, longest, least_words, seed))
    drawable = runs.where("_drawable")
    many = drawable.count()
    placed = ranks(drawable, percent * many // 100, many)
    return runs.join(placed, ["_run", "_place"], "left").select(
        F.col("_id").alias(id_col), "n_features", "weight", "score", F.col("rank").cast("long")
    )
