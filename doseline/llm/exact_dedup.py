"""Exact dedup: groups by a 128-bit content hash, compared byte by byte."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doseline.llm.common import beside

# Any run of white space other than one single blank; a single blank stays as it is.
UNEVEN_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normal_text(text: Column) -> Column:
    """Text with each run of white space as one blank; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), UNEVEN_SPACE, " ")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    content_hash: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per input row: id, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Rows are equal when their normal texts are; the smallest id of a group stays. A group is
    keyed by the 128-bit `content_hash` and, in case two texts share that, the SHA-256 the
    result carries anyway. Within it rows are grouped by the bytes of their texts; if a
    group ever had two texts, the job would fail rather than merge them.

    Each task sends one row per group it has seen, so a group of any size is never gathered;
    the members, without text, then look up their group, which has one row.

    Null text is empty text, and empty texts are equal. A null id never stays unless its
    whole group has none. A repeated row counts in `group_size` and repeats its result.
    Other columns of `docs` are not read. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("_id"), normal_text(F.col(text_col)).alias("_text"))
    rows = rows.select(
        "_id", "_text", content_hash(F.col("_text")).alias("_hash"),
        F.sha2("_text", 256).alias("_sha"),
    )
    # Grouped by the text as well, rows meet only where their bytes are equal.
    texts = rows.groupBy("_hash", "_sha", "_text").agg(
        F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_size")
    )
    groups = texts.groupBy("_hash", "_sha").agg(
        F.min("_keep").alias("_keep"), F.sum("_size").alias("_size"), F.count(F.lit(1)).alias("_texts")
    )
    # On the id that stays, which every use of the groups reads.
    collision = F.raise_error(F.lit("two texts share both content hashes")).cast(docs.schema[id_col].dataType)
    groups = groups.withColumn("_keep", F.when(F.col("_texts") == 1, F.col("_keep")).otherwise(collision))
    return (
        rows.select("_id", "_hash", "_sha")
        .join(groups, ["_hash", "_sha"])
        .select(
            F.col("_id").alias(id_col),
            F.col("_keep").alias("keep_id"),
            F.col("_size").alias("group_size"),
            F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
            F.col("_sha").alias("text_sha256"),
        )
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns; of repeated rows one stays."""

    def key(sha: str, own: str) -> Column:
        """Text and id in one, so that the rows found are already dealt by what repeats."""
        return F.concat_ws(":", sha, F.col(own).cast("string"))

    groups = exact_groups(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text")

    stays = groups.where("kept").select(key("text_sha256", "id").alias("stays"))
    rows = beside(docs, sha=F.sha2(normal_text(F.col(text_col)), 256), id=F.col(id_col))
    rows = rows.select("row", key("sha", "id").alias("key"))
    return rows.join(stays, F.col("key") == F.col("stays"), "left_semi").dropDuplicates(["key"]).select("row.*")
