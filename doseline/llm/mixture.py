"""Mixing sources to target weights: repetition rates and hash-seeded copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doseline.llm.common import beside, keep, word_count

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
AT_ONCE = 65_536  # copies made from one array


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS
) -> DataFrame:
    """One row per source of (`source`, `size`): `source_size`, `target`.

    Sources in code point order, null last, get the weights in turn. They share the total
    by weight; no target exceeds `most` times its source, and what is cut off is shared by
    weight among the others, again and again. That ends where every uncapped target is one
    level times its weight, so the level is found directly: with sources ordered by cap per
    weight, it is the first one at which the next source stays under its cap.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sources.select(
        "source", "source_size",
        (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1).alias("_rank"),
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    capped = ranked.select(
        "source", "source_size", "_rank", weight.cast("long").alias("_weight"),
        (F.col("source_size") * most).alias("_cap"),
    )
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = capped.select(
        "*",
        (
            (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
            / (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0)))
        ).alias("_level"),
    )
    # The first that holds; beyond it sources would be capped that need not be.
    holds = F.col("_level") * F.col("_weight") <= F.col("_cap")
    place = F.struct((F.col("_cap") / F.col("_weight")).alias("_ratio"), "_rank", "_level")
    levels = levels.withColumn("_found", F.min(F.when(holds, place)).over(everything))
    target = F.least(F.col("_cap").cast("double"), F.col("_found._level") * F.col("_weight"))
    return levels.select("source", "source_size", target.alias("target"))


def text_digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def draw(key: Column, digest: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the key, the text's digest and the seed only."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), digest)
    return F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def rates_of(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """`of_source`, `source_size`, `target` and `rate` of each source, written first: its size is then
    known to be small, so that joining it moves no rows."""
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    targets = source_targets(sizes, weights, most)
    return keep(targets.select(F.col("source").alias("of_source"), "source_size", "target", rate.alias("rate")), "rates")


def more_of(rate: Column, rows: Column, drawn: Column) -> Column:
    """How many of `rows` equal rows get one copy more than the whole part of their rate: as many
    as the fraction grants them together, the last one by the draw."""
    due = rows * (rate - F.floor(rate))
    return F.floor(due) + (drawn < due - F.floor(due)).cast("long")


def counted(rows: Column) -> Column:
    """The numbers 0 to `rows` - 1 as arrays of bounded length, to be exploded one after the other."""
    starts = F.sequence(F.lit(0).cast("long"), rows - 1, F.lit(AT_ONCE))
    return F.transform(starts, lambda at: F.struct(at.alias("first"), F.least(at + AT_ONCE, rows).alias("end")))


def mix_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    seed: int = 17,
) -> DataFrame:
    """One row per input row: id, `source`, `size`, `source_size`, `target`, `rate`, `copies`, `taken`.

    A document's copies are the whole part of its source's rate (target over size) plus one
    more with the remaining probability, drawn from its id and text, so that reruns agree.
    Rows that share source, id and text cannot draw apart: n of them get n times the
    fraction more copies together, the rest of that by one draw, so that they come as near
    the target as others do. Sizes are words. Only one row per source is ever ordered in one
    task; equal rows are counted before they are shuffled.

    A null source is a source of its own, the last. Null text has size 0; a source of size 0
    has rate 0 and takes nothing. A null id draws by its text. Other columns are not read. An
    empty table gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        text_digest(F.col(text_col)).alias("digest"),
    )
    groups = rows.groupBy("id", "source", "size", "digest").agg(F.count(F.lit(1)).alias("n"))
    rates = rates_of(rows, weights, most)
    joined = groups.join(rates, F.col("source").eqNullSafe(F.col("of_source")))
    more = more_of(F.col("rate"), F.col("n"), draw(F.col("id"), F.col("digest"), seed))
    parts = joined.withColumn("more", more).withColumn("part", F.explode(counted(F.col("n"))))
    each = parts.withColumn("number", F.explode(F.sequence("part.first", F.col("part.end") - 1)))
    copies = F.floor("rate") + (F.col("number") < F.col("more")).cast("long")
    return each.withColumn("copies", copies).select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target", "rate", "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    seed: int = 17,
) -> DataFrame:
    """The mixture itself: each row of `docs` as often as `mix_counts` says, with all its columns.

    The targets need one pass over the texts, and finding rows that share source, id and text
    another; the others then repeat in place. Those few are counted by their whole rows, and
    the copies due to all of them dealt in an order of these.
    """
    rows = beside(
        docs, id=F.col(id_col), source=F.col(source_col), size=word_count(F.col(text_col)),
        digest=text_digest(F.col(text_col)),
    )
    rates = rates_of(rows.select("source", "size"), weights, most)
    again = rows.groupBy("id", "source", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = keep(again.toDF("same_id", "same_source", "same_digest", "n"), "repeated")
    same = (F.col("digest") == F.col("same_digest")) & F.col("id").eqNullSafe(F.col("same_id"))
    same &= F.col("source").eqNullSafe(F.col("same_source"))
    drawn = draw(F.col("id"), F.col("digest"), seed)
    rated = F.col("source").eqNullSafe(F.col("of_source"))
    single = rows.join(again, same, "left_anti").join(rates, rated)
    single = single.select("row", (F.floor("rate") + more_of(F.col("rate"), F.lit(1), drawn)).alias("copies"))

    # Equal rows of a group are one row with a count, however many there are.
    equal = rows.join(again, same).groupBy("row", "id", "source", "digest", "n").agg(F.count(F.lit(1)).alias("equal"))
    line = Window.partitionBy("id", "source", "digest").orderBy(F.xxhash64(F.to_json("row")), F.to_json("row"))
    before = F.coalesce(F.sum("equal").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    equal = equal.withColumn("before", before).join(rates, rated)
    extra = F.greatest(F.lit(0), F.least(F.col("equal"), more_of(F.col("rate"), F.col("n"), drawn) - F.col("before")))
    repeated = equal.select("row", (F.col("equal") * F.floor("rate") + extra).alias("copies"))
    dealt = single.unionByName(repeated).where("copies > 0").withColumn("part", F.explode(counted(F.col("copies"))))
    each = dealt.withColumn("copy", F.explode(F.sequence("part.first", F.col("part.end") - 1)))
    return each.select("row.*")
