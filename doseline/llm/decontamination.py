"""Benchmark decontamination: spaced seeds, joined by hash and verified around each hit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doseline.llm.common import beside, row_key

# Word offsets a seed compares; the others are ignored. Together they hit every window of
# the lengths below with as many substitutions as `allowed` grants, at any places.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 5, 6))
WINDOW = 13
LEAST_WORDS = 5  # of an overlap that masks are laid on; shorter items are compared whole
# Scripts written without blanks between words: each of their letters counts as a word.
UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"
SEGMENT = 244
BROADCAST_SEEDS = 1_000_000  # rows of 24 bytes; more are joined by a shuffle


def allowed(window: Column) -> Column:
    """Substituted words that an overlap of so many words may have: 0 below 8, 1 below 13, then 2."""
    return F.greatest(F.lit(0), F.floor((window - 3) / 5)).cast("int")


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits, and single letters of scripts without blanks."""
    spaced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), UNSPACED, " $1 ")
    return F.array_remove(F.split(spaced, r"[^\p{L}\p{N}]+"), "")


def masks_for(lengths: list[int]) -> dict[int, tuple[int, ...]]:
    """The masks by number, and one under -n for whole items of n words."""
    return {**dict(enumerate(MASKS)), **{-n: tuple(range(n)) for n in lengths}}


def seeds(words: Column, at: Column, masks: dict[int, tuple[int, ...]], window: Column | None = None) -> Column:
    """Hash of each mask laid on a position, null where it would stand out. An item, which has a
    `window`, takes the mask of its length if it is short, and else the others."""

    def fits(number: int, mask: tuple[int, ...]) -> Column:
        inside = at + mask[-1] < F.size(words)
        if window is None:
            return inside
        return inside & (window == -number if number < 0 else window >= LEAST_WORDS)

    return F.array(*[
        F.when(fits(number, mask), F.xxhash64(F.lit(number), *[F.get(words, at + k) for k in mask]))
        for number, mask in masks.items()
    ])


def segments(frame: DataFrame) -> DataFrame:
    """The frame's `words` in pieces of bounded length with their place `base`; every window
    lies whole in the piece it starts in. Only pieces travel with the seeds, so that a long
    text costs no more than many short ones."""
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(SEGMENT)),
        lambda base: F.struct(base.alias("base"), F.slice("words", base + 1, SEGMENT + WINDOW - 1).alias("words")),
    )
    others = [c for c in frame.columns if c != "words"]
    return frame.select(*others, F.explode(pieces).alias("_piece")).select(*others, "_piece.base", "_piece.words")


def planted(pieces: DataFrame, masks: dict[int, tuple[int, ...]], window: Column | None = None) -> DataFrame:
    """A row per seed of the pieces' `words`: its place `at` in the piece, and hash `seed`."""
    placed = pieces.select("*", F.posexplode("words").alias("at", "_word")).drop("_word")
    placed = placed.select("*", F.explode(seeds(F.col("words"), F.col("at"), masks, window)).alias("seed"))
    return placed.where("seed IS NOT NULL")


def overlap_start(*names: str) -> Column:
    """Where the first overlap around a hit starts in the piece of the document, or null.

    The names are those of the piece's words and the hit's place in it, the same of the item,
    and the window. Windows of the item around the hit are laid on the document; each counts
    the words that agree. They are at most `WINDOW` in number and in length.
    """
    words, at, item_words, item_at, window = map(F.col, names)
    low = F.greatest(F.lit(0), item_at - at, item_at + F.least(F.lit(LEAST_WORDS), window) - window)
    high = F.least(item_at, F.size(item_words) - window, F.size(words) - window + item_at - at)

    def agrees(start: Column) -> Column:
        same = F.filter(
            F.sequence(F.lit(0), window - 1),
            lambda k: F.get(words, start + at - item_at + k) == F.get(item_words, start + k),
        )
        return F.size(same) >= window - allowed(window)

    return F.when(low <= high, F.array_min(F.filter(F.sequence(low, high), agrees)) + at - item_at)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_seeds: int = BROADCAST_SEEDS,
) -> DataFrame:
    """A row per document and benchmark item it overlaps: id, item id, `start_word`.

    Texts are compared by lower-case words. An overlap is a window of 13 words of the item,
    or all of a shorter one, that the document has with at most 2 words substituted (1 in 8
    to 12 words, none in fewer). `start_word` is where the first one starts. Every window of
    both sides is searched: seeds of all positions are joined by hash, and each hit is
    verified word by word. Items of 1 to 4 words are found where a document has them whole, by
    a hash of as many words; documents are hashed so only for lengths that occur among the
    items. Letters of scripts without blanks between words are words.

    Seeds of the items are broadcast if there are at most `broadcast_seeds`, which is
    counted first; hits are then verified where they are found, without a shuffle of texts.
    Otherwise seeds are joined by a shuffle, and the pieces with hits are looked up again.

    Null texts are empty. Items without a word are in no document. Rows that repeat an
    id give one result; a null id is an id of its own. Other columns are not read; empty
    tables give an empty result.
    """
    targets = items.select(F.col(item_col).alias("_item"), words_of(F.col(item_text_col)).alias("words"))
    targets = targets.where(F.size("words") > 0).distinct()
    short = targets.where(F.size("words") < LEAST_WORDS).select(F.size("words").alias("n")).distinct()
    masks = masks_for(sorted(row.n for row in short.collect()))  # at most four lengths
    targets = targets.withColumn("_window", F.least(F.lit(WINDOW), F.size("words")))
    targets = segments(targets).withColumnsRenamed({"base": "_item_base", "words": "_item_words"})
    laid = targets.select("_item", "_item_base", F.col("_item_words").alias("words"), "_window")
    item_seeds = planted(laid, masks, F.col("_window"))
    item_seeds = item_seeds.select("_item", "_item_base", F.col("at").alias("_item_at"), "seed")
    corpus = segments(docs.select(F.col(id_col).alias("_id"), words_of(F.col(text_col)).alias("words")))
    if item_seeds.limit(broadcast_seeds + 1).count() <= broadcast_seeds:
        hits = planted(corpus, masks).join(F.broadcast(item_seeds), "seed")
    else:
        found = planted(corpus, masks).select(F.col("_id").alias("_hit"), F.col("base").alias("_hit_base"), "at", "seed")
        found = found.join(item_seeds, "seed").distinct()
        here = F.col("_id").eqNullSafe(F.col("_hit")) & (F.col("base") == F.col("_hit_base"))
        hits = corpus.join(found, here)
    hits = hits.select("_id", "base", "words", "at", "_item", "_item_base", "_item_at")
    known = targets.withColumnsRenamed({"_item": "_known", "_item_base": "_known_base"})
    same = F.col("_item").eqNullSafe(F.col("_known")) & (F.col("_item_base") == F.col("_known_base"))
    start = overlap_start("words", "at", "_item_words", "_item_at", "_window")
    return (
        hits.join(known, same)
        .select("_id", "_item", (F.col("base") + start).cast("long").alias("_start"))
        .where("_start IS NOT NULL")
        .groupBy("_id", "_item")
        .agg(F.min("_start").alias("start_word"))
        .select(F.col("_id").alias(id_col), F.col("_item").alias(item_col), "start_word")
    )


def drop_contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` that overlap no item, with all their columns. Each row is judged by
    its own text, whatever others share its id."""
    rows = beside(docs, key=row_key(id_col, text_col), text=F.col(text_col))
    named = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    found = contaminated(rows.select("key", "text"), named, "key", "text", "item", "text")
    found = found.select(F.col("key").alias("found")).distinct()
    return rows.join(found, F.col("key") == F.col("found"), "left_anti").select("row.*")
