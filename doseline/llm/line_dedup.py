"""Line dedup: lines that many documents share are dropped, the others reassembled in place."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doseline.llm.common import keep

SPACE = " \t\n\v\f\r"
LEAST_CHARS = 1
LEAST_DOCS = 10


def lines_of(text: Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def keys_of(text: Column) -> Column:
    """The key of each line: white space stripped at both ends, A-Z lower-cased."""
    lowered = F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.transform(F.split(lowered, "\n"), lambda line: F.btrim(line, F.lit(SPACE)))


def key_hash(key: Column) -> list[Column]:
    """128 bits that stand for a key, as two columns."""
    return [F.xxhash64(F.lit(n), key).alias(f"_h{n}") for n in (1, 2)]


def shared_lines(
    docs: DataFrame, text_col: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """Hashes (`_h1`, `_h2`) of the keys found in at least `least_docs` rows, and `docs`, in how many.

    A row gives each of its keys once, and each task one row per key it has seen.
    """
    keys = docs.select(F.explode(F.array_distinct(keys_of(F.col(text_col)))).alias("_key"))
    counts = keys.where(F.length("_key") >= least_chars).groupBy(*key_hash(F.col("_key"))).agg(
        F.count(F.lit(1)).alias("docs")
    )
    return counts.where(F.col("docs") >= least_docs)


def _text_key(id_col: str, text_col: str) -> list[Column]:
    """What tells rows apart whose lines may differ. The text alone would do; the id deals
    copies of one text to many tasks."""
    data = F.coalesce(F.col(text_col), F.lit(""))
    return [F.col(id_col).alias("_id"), *key_hash(data)]


def _dropped(docs: DataFrame, shared: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """Places of the shared lines of each id and text, as `_places`; rows that repeat both meet."""
    named = [c.alias(name) for c, name in zip(_text_key(id_col, text_col), ("_id", "_t1", "_t2"), strict=True)]
    lines = docs.select(*named, F.posexplode(keys_of(F.col(text_col))).alias("_at", "_key"))
    lines = lines.where(F.length("_key") >= least_chars)
    lines = lines.select("_id", "_t1", "_t2", "_at", *key_hash(F.col("_key")))
    found = lines.join(shared.select("_h1", "_h2"), ["_h1", "_h2"], "left_semi")
    return found.groupBy("_id", "_t1", "_t2").agg(F.collect_set("_at").alias("_places"))


def drop_shared_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """One row per input row: id, `n_lines`, `n_dropped`, `kept_text`.

    Lines end at a line feed. A line's key is the line without white space at its ends, A-Z
    lower-cased. Keys of at least `least_chars` code points that occur in at least
    `least_docs` documents lose all their lines in every document; the other lines stay
    as they are, in order, joined by line feeds.

    Keys are counted and found by 128 bits of hash. The shared ones are written first, so
    that Spark knows their size and broadcasts them only below its threshold; beyond it the
    lines are joined by a shuffle, a common key split at run time. Of the lines only the
    places of dropped ones travel to their texts, which are shuffled once.

    Every row is a document, whatever its id: rows that repeat an id, or have none, count
    each, and are judged by their own text. Null and empty texts are one empty line. If all
    lines go, the text left is empty. Other columns of `docs` are not read. An empty table
    gives an empty result.
    """
    shared = keep(shared_lines(docs, text_col, least_chars, least_docs), "shared-lines")
    dropped = _dropped(docs, shared, id_col, text_col, least_chars)
    rows = docs.select(*_text_key(id_col, text_col), F.col(text_col).alias("_text"))
    same = rows["_id"].eqNullSafe(dropped["_id"]) & (rows["_h1"] == dropped["_t1"]) & (rows["_h2"] == dropped["_t2"])
    joined = rows.join(dropped, same, "left").select(
        rows["_id"], lines_of(F.col("_text")).alias("_lines"),
        F.coalesce("_places", F.array().cast("array<int>")).alias("_places"),
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_places"))
    return joined.select(
        F.col("_id").alias(id_col),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size("_places").cast("long").alias("n_dropped"),
        F.array_join(F.transform(stay, lambda at: F.get("_lines", at)), "\n").alias("kept_text"),
    )
