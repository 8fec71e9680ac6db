"""Substring dedup: relative Lempel-Ziv factors of documents against reference blocks.

The reference is the corpus itself, and a document may copy from those with smaller ids. A
copied factor counts once it has `window` words, so the reference is indexed by its windows:
block b holds the windows that hash to b, from every document. Each document asks every block
for its windows and learns which smaller document seems to have them, judged by their hashes.

Following windows with one source make a factor, whose words are looked up in the words of
that source. A factor that is not there is checked window by window, and each window its
source lacks is compared, word by word, with all documents. Windows that lie across the end
of one source's copy and the start of another's are windows like others, so nothing is lost
at boundaries. Runs of matched windows, whatever their sources, are removed.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from doseline.llm.common import keep, struct, text_blocks

WINDOW = 13
CHUNK_BYTES = 3 << 20
ANSWERS_AT_ONCE = 500_000
ROWS_AT_ONCE = 500
HASHED_BYTES = 2 << 20
KEY_BYTES = 7
KEY_MASK = np.uint64((1 << 8 * KEY_BYTES) - 1)
NO_ID = np.iinfo(np.int64).max
BROADCAST_OWNERS = 1_000_000  # ids of 8 bytes; with more, all texts are dealt to be compared

# Odd multipliers of the rolling hashes and of the final mixing.
BYTE_FACTOR, KEY_FACTOR, BLOCK_FACTOR, MIX_A, MIX_B = map(
    np.uint64,
    (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xC6BC279692B5CC83, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB),
)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX_A
    h = (h ^ (h >> np.uint64(27))) * MIX_B
    return h ^ (h >> np.uint64(31))


def hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and starting byte of each word."""
    raw = np.frombuffer(data, np.uint8)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    lengths = ends - starts
    powers = np.full(int(lengths.max()), BYTE_FACTOR).cumprod(dtype=np.uint64)
    letters = np.flatnonzero(inside)
    first = lengths.cumsum() - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    return mixed(np.add.reduceat((raw[letters] + np.uint64(1)) * powers[place], first)), starts


def hash_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and the number of words of each."""
    counts, found = np.zeros(len(texts), np.int64), []
    pieces: list[bytes] = []
    owners: list[int] = []

    def flush() -> None:
        hashes, starts = hash_words(b" ".join(pieces))
        offsets = np.cumsum([0] + [len(p) + 1 for p in pieces])
        np.add.at(counts, owners, np.diff(np.searchsorted(starts, offsets)))
        found.append(hashes)
        pieces.clear()
        owners.clear()

    size = 0
    for i, text in enumerate(texts):
        for block in text_blocks(text):
            pieces.append(block)
            owners.append(i)
            size += len(block)
            if size >= HASHED_BYTES:
                flush()
                size = 0
    if pieces:
        flush()
    return np.concatenate(found) if found else np.zeros(0, np.uint64), counts


def rolling(hashes: np.ndarray, window: int, factor: np.uint64) -> np.ndarray:
    n = max(0, len(hashes) - window + 1)
    rolled = np.zeros(n, np.uint64)
    for j in range(window):
        rolled = rolled * factor + hashes[j : n + j]
    return mixed(rolled)


def window_keys(hashes: np.ndarray, window: int) -> np.ndarray:
    """Key of the window at each start within its block; the block adds the bits to tell more apart."""
    return rolling(hashes, window, KEY_FACTOR) & KEY_MASK


def window_blocks(hashes: np.ndarray, window: int, blocks: int) -> np.ndarray:
    return ((rolling(hashes, window, BLOCK_FACTOR) >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def narrow(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def wide(keys: bytes) -> np.ndarray:
    out = np.zeros((len(keys) // KEY_BYTES, 8), np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(keys, np.uint8).reshape(-1, KEY_BYTES)
    return out.view("<u8").ravel()


def whole_key(text: bytes) -> int:
    """In place of a key: every window of the document's row with this text is matched."""
    return -1 - (xxhash.xxh64_intdigest(text) >> 1)


ANSWER = struct(id=T.LongType(), key=T.LongType(), owner=T.LongType())
ASKED = T.StructType(
    struct(block=T.LongType(), ids=T.BinaryType(), counts=T.BinaryType(), keys=T.BinaryType()).fields + ANSWER.fields
)


def first_copies(ids: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """The smallest id of the documents with each one's text."""
    least: dict[bytes, int] = {}
    for i, t in zip(ids.tolist(), texts, strict=True):
        least[t] = min(i, least.get(t, i))
    return np.array([least[t] for t in texts], np.int64)


def sorted_windows(ids: np.ndarray, texts: list[bytes], window: int, blocks: int) -> list[np.ndarray]:
    """Block, key and id of every window, in this order."""
    hashes, counts = hash_texts(texts)
    left = np.repeat(counts.cumsum(), counts) - np.arange(len(hashes))  # words to the text's end
    starts = np.flatnonzero(left >= window)
    block, key = window_blocks(hashes, window, blocks)[starts], window_keys(hashes, window)[starts]
    doc = np.repeat(ids, counts)[starts]
    order = np.lexsort((doc, key, block))
    return [block[order], key[order], doc[order]]


def starts_of_runs(*columns: np.ndarray) -> np.ndarray:
    """Whether each entry differs from the one before it in a column."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def asked_rows(block: np.ndarray, key: np.ndarray, doc: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    """One row per block: the asking ids, how many windows each has there, and their keys."""
    order = np.lexsort((doc, block))
    block, key, doc = block[order], key[order], doc[order]
    run = np.flatnonzero(starts_of_runs(block, doc))
    counts = np.diff(np.r_[run, len(doc)]).astype("<u4")
    cuts = np.flatnonzero(starts_of_runs(block))
    bounds = np.r_[cuts, len(block)]
    at = np.searchsorted(run, bounds)
    columns = [
        pa.array(block[cuts]),
        pa.array([doc[run[a:b]].tobytes() for a, b in zip(at, at[1:])], pa.binary()),
        pa.array([counts[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()),
        pa.array([narrow(key[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary()),
    ]
    none = pa.nulls(len(cuts), pa.int64())
    return pa.RecordBatch.from_arrays([*columns, none, none, none], schema=schema)


def ask(ids: list[int], texts: list[bytes], window: int, blocks: int) -> Iterator[pa.RecordBatch]:
    """What a chunk of documents asks the blocks, and the answers it has by itself.

    Of a window in several of its documents only the smallest id asks; for the others it is
    matched already. A copy of a whole text in the chunk asks nothing. Answers known so far
    travel under a negative block number.
    """
    schema, own = to_arrow_schema(ASKED), np.array(ids, np.int64)
    source = first_copies(own, texts)
    first = source == own
    block, key, doc = sorted_windows(own[first], [t for t, f in zip(texts, first, strict=True) if f], window, blocks)
    least = starts_of_runs(block, key)
    yield asked_rows(block[least], key[least], doc[least], schema)

    repeated = ~least & starts_of_runs(block, key, doc)
    owner = doc[least][least.cumsum() - 1] if len(doc) else doc
    repeated &= doc != owner
    whole = np.array([whole_key(t) for t, f in zip(texts, first, strict=True) if not f], np.int64)
    known = np.r_[doc[repeated], own[~first]]
    answers = [known, np.r_[key[repeated].astype(np.int64), whole], np.r_[owner[repeated], source[~first]]]
    empty = pa.nulls(len(known), pa.binary())
    yield pa.RecordBatch.from_arrays(
        [pa.array(-1 - known % blocks), empty, empty, empty, *map(pa.array, answers)], schema=schema
    )


def pack(data: bytes | None) -> bytes | None:
    """A text as it travels: Spark's own codec, for shuffled blocks, leaves most of its size."""
    return zlib.compress(data, 1) if data is not None else None


def unpack(data: bytes | None) -> bytes:
    return zlib.decompress(data) if data is not None else b""


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts, so that little is made of one before it is passed on."""
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text), the text packed."""
    for batch in pieces(batches):
        packed = pa.array((pack(text.as_py()) for text in batch.column(1)), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), packed], schema=batch.schema)


def ask_batches(batches: Iterator[pa.RecordBatch], window: int, blocks: int) -> Iterator[pa.RecordBatch]:
    """Documents (id, text), a chunk of about CHUNK_BYTES at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for own, text in zip(batch.column(0), batch.column(1), strict=True):
            if data := text.as_py():
                ids.append(NO_ID if (value := own.as_py()) is None else value)
                texts.append(data)
                size += len(data)
            if size >= CHUNK_BYTES:
                yield from ask(ids, texts, window, blocks)
                ids, texts, size = [], [], 0
    if texts:
        yield from ask(ids, texts, window, blocks)


def matches(asked: list[dict]) -> Iterator[pa.RecordBatch]:
    """The windows of one reference block that its smallest asking id does not own."""
    schema = to_arrow_schema(ANSWER)
    doc = np.concatenate(
        [np.repeat(np.frombuffer(r["ids"], np.int64), np.frombuffer(r["counts"], "<u4")) for r in asked]
    )
    key = np.concatenate([wide(r["keys"]) for r in asked])
    order = np.argsort(key)
    key, doc = key[order], doc[order]
    first = np.flatnonzero(starts_of_runs(key))
    least = np.repeat(np.minimum.reduceat(doc, first), np.diff(np.r_[first, len(doc)]))
    later = np.flatnonzero(doc > least)
    later = later[np.argsort(doc[later], kind="stable")]
    for at in range(0, len(later), ANSWERS_AT_ONCE):
        some = later[at : at + ANSWERS_AT_ONCE]
        answers = [doc[some], key[some].astype(np.int64), least[some]]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, answers)), schema=schema)


def match_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Asked windows, sorted by block, become answers, one block at a time."""
    schema, held = to_arrow_schema(ANSWER), []
    for batch in batches:
        known = batch.filter(pc.less(batch.column(0), 0))
        yield pa.RecordBatch.from_arrays(known.columns[4:], schema=schema)
        for row in batch.filter(pc.greater_equal(batch.column(0), 0)).to_pylist():
            if held and row["block"] != held[0]["block"]:
                yield from matches(held)
                held = []
            held.append(row)
    if held:
        yield from matches(held)


def spans(matched: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end, in words, of the greedy factors: each run of matched windows."""
    edge = np.flatnonzero(np.diff(np.r_[False, matched, False]))
    return edge[::2], edge[1::2] + window - 1


def covered(words: int, at: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of `words` words from `at` on lie in a span."""
    depth = np.zeros(words + 1, np.int64)
    np.add.at(depth, np.clip(starts - at, 0, words), 1)
    np.add.at(depth, np.clip(ends - at, 0, words), -1)
    return depth[:-1].cumsum() > 0


def matched_windows(data: bytes, keys: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Key of each window, and whether it is among the answers."""
    found = window_keys(hash_texts([data])[0], window).astype(np.int64)
    return found, np.isin(found, keys) | (keys == whole_key(data)).any()


def factors(data: bytes, keys: np.ndarray, owners: np.ndarray, window: int) -> Iterator[tuple[int, bytes]]:
    """Source and words of each run of matched windows with one source."""
    if not len(keys):
        return
    found, matched = matched_windows(data, keys, window)
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    source = owners[np.searchsorted(keys, found).clip(max=len(keys) - 1)]
    # What no key answers is matched with the whole text, if at all.
    source = np.where(np.isin(found, keys), source, owners[np.searchsorted(keys, whole_key(data)).clip(max=len(keys) - 1)])
    words, at = data.split(), np.flatnonzero(starts_of_runs(matched, source))
    for start, end in zip(at.tolist(), [*at[1:].tolist(), len(found)]):
        if matched[start]:
            yield int(source[start]), b" ".join(words[start : end + window - 1])


def check_batches(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Texts and then factors of each source, to the windows that the source does not have."""
    own, held = None, []
    for batch in batches:
        missing = []
        for number, text, words in zip(*(c for c in batch.columns), strict=True):
            if number != own:
                own, held = number, []
            if text.is_valid:
                held.append(b" %b " % b" ".join(unpack(text.as_py()).split()))
                continue
            words = unpack(words.as_py())
            if any(b" %b " % words in t for t in held):
                continue
            split = words.split()
            for k in range(len(split) - window + 1):
                some = b" ".join(split[k : k + window])
                if not any(b" %b " % some in t for t in held):
                    missing.append(some)
        yield pa.RecordBatch.from_arrays([pa.array(missing, pa.binary())], names=["words"])


def keys_of(windows: list[bytes], window: int) -> np.ndarray:
    return window_keys(hash_texts(windows)[0], window)[::window].astype(np.int64)


def holder_batches(batches: Iterator[pa.RecordBatch], windows: list[bytes], window: int) -> Iterator[pa.RecordBatch]:
    """Documents (id, text) to those of the given windows that they have."""
    wanted, keys = set(windows), keys_of(windows, window)
    for batch in batches:
        ids, found = [], []
        for own, text in zip(batch.column(0), batch.column(1), strict=True):
            data = text.as_py() or b""
            near = np.flatnonzero(np.isin(window_keys(hash_texts([data])[0], window).astype(np.int64), keys))
            words = data.split() if len(near) else []
            some = {b" ".join(words[k : k + window]) for k in near.tolist()} & wanted
            ids += [NO_ID if own.as_py() is None else own.as_py()] * len(some)
            found += some
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(ids, pa.int64())], names=["words", "id"])


def cut(
    data: bytes, keys: np.ndarray, window: int, with_text: bool, own: int = NO_ID, least: dict[bytes, int] | None = None
) -> tuple:
    """n_words, n_removed, hash of the kept words, spans (start, length), kept text. `least`
    has the smallest id with each window whose key cannot be trusted."""
    starts = ends = np.zeros(0, np.int64)
    if len(keys):
        found, matched = matched_windows(data, keys, window)
        if least:
            doubted = np.flatnonzero(matched & np.isin(found, keys_of(list(least), window)))
            words = data.split() if len(doubted) else []
            for k in doubted.tolist():
                matched[k] = least.get(b" ".join(words[k : k + window]), -1 - NO_ID) < own
        starts, ends = spans(matched, window)
    digest, at, removed, kept = hashlib.sha256(), 0, 0, []
    for block in text_blocks(data):
        words = block.split()
        if len(starts):
            gone = covered(len(words), at, starts, ends)
            removed += int(gone.sum())
            left = list(compress(words, (~gone).tolist()))
        else:
            left = words
        at += len(words)
        if left:
            kept.append(b" ".join(left))
            digest.update(b" " + kept[-1] if len(kept) > 1 else kept[-1])
            if not with_text:
                kept[-1] = b""
    lengths = (ends - starts).tolist()
    parse = [{"start": s, "length": n} for s, n in zip(starts.tolist(), lengths, strict=True)]
    return at, removed, digest.hexdigest(), parse, b" ".join(kept).decode() if with_text else None


def cut_batches(
    batches: Iterator[pa.RecordBatch], window: int, schema: pa.Schema, with_text: bool, least: dict[bytes, int] | None
) -> Iterator[pa.RecordBatch]:
    """Results and, unless windows have been compared before, the factors they rest on."""
    none = np.zeros(0, np.int64)
    for batch in pieces(batches):
        rows, checks = [], []
        for own, text, answers in zip(*batch.columns, strict=True):
            data, own = unpack(text.as_py()), own.as_py()
            keys, owners = (c.to_numpy() for c in answers.values.flatten()) if answers.is_valid else (none, none)
            rows.append(cut(data, keys, window, with_text, NO_ID if own is None else int(own), least))
            if least is None:
                checks += ((source, pack(words)) for source, words in factors(data, keys, owners, window))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        arrays = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=False)]
        blank = [pa.nulls(len(rows), f.type) for f in list(schema)[-2:]]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays, *blank], schema=schema)
        blank = [pa.nulls(len(checks), f.type) for f in list(schema)[:-2]]
        asked = [pa.array([o for o, _ in checks], pa.int64()), pa.array([w for _, w in checks], pa.binary())]
        yield pa.RecordBatch.from_arrays([*blank, *asked], schema=schema)


def unfounded(rows: DataFrame, checks: DataFrame, window: int) -> list[bytes]:
    """Windows of the factors (`id` of the source, `words`) that their source does not have.

    Equal factors are compared once. Only the texts of sources travel if those are at most
    BROADCAST_OWNERS, which is counted first.
    """
    checks = checks.distinct()
    owners = checks.select("id").distinct()
    texts = rows.where("id IS NOT NULL")
    if owners.limit(BROADCAST_OWNERS + 1).count() <= BROADCAST_OWNERS:
        texts = texts.join(F.broadcast(owners), "id", "left_semi")
    texts = texts.mapInArrow(pack_batches, texts.schema)
    dealt = texts.select("id", "_text", F.lit(None).cast("binary").alias("words")).unionByName(
        checks.select("id", F.lit(None).cast("binary").alias("_text"), "words")
    )
    dealt = dealt.repartition("id").sortWithinPartitions("id", F.col("words").asc_nulls_first())
    missing = dealt.mapInArrow(partial(check_batches, window=window), "words binary").distinct()
    return [bytes(r.words) for r in missing.collect()]


def drop_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    blocks: int | None = None,
    with_text: bool = True,
) -> DataFrame:
    """One row per input row: id, `n_words`, `n_removed`, `kept_sha256`, `spans`, `kept_text`.

    A word goes if a window of `window` words over it also starts in a document with a
    smaller id; this is judged on the texts as given. `spans` are the factors (start,
    length) in words, `kept_text` the other words joined by blanks (null unless `with_text`).

    Windows are looked up by hashes of 56 bits within one of `blocks` blocks (as many as
    shuffle partitions unless given); a block is solved at a time, so `blocks` should grow
    with the corpus. What is frequent within a chunk is settled before the shuffle. Texts
    are shuffled once, packed, to meet the answers; then each factor's words are compared with the
    text of its source. Windows not found there, which is where hashes have confused two,
    go to the driver; if there are any, all documents are searched for them, word by word,
    and the result is made again with what they are.

    Ids are whole numbers. Null and empty texts have no words. A null id counts as larger
    than any other, and rows that share an id, repeated ones too, do not match each other.
    Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("_text"))
    texts = rows.select(F.col(id_col).cast("long").alias("id"), "_text")
    asked = texts.mapInArrow(partial(ask_batches, window=window, blocks=blocks), ASKED)
    dealt = asked.repartition("block").sortWithinPartitions("block")
    answers = dealt.mapInArrow(match_batches, ANSWER).select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("_id"), F.struct("key", "owner").alias("_answer")
    )
    answers = answers.groupBy("_id").agg(F.collect_list("_answer").alias("_answers"))
    packed = rows.mapInArrow(pack_batches, rows.schema)
    joined = packed.join(answers, packed[id_col].cast("long").eqNullSafe(answers["_id"]), "left")
    factor = struct(start=T.LongType(), length=T.LongType())
    schema = struct(
        **{id_col: docs.schema[id_col].dataType},
        n_words=T.LongType(), n_removed=T.LongType(), kept_sha256=T.StringType(),
        spans=T.ArrayType(factor), kept_text=T.StringType(), _owner=T.LongType(), _words=T.BinaryType(),
    )

    def result(least: dict[bytes, int] | None) -> DataFrame:
        work = partial(cut_batches, window=window, schema=to_arrow_schema(schema), with_text=with_text, least=least)
        return joined.select(id_col, "_text", "_answers").mapInArrow(work, schema)

    found = keep(result(None), "factors")
    checks = found.where("_owner IS NOT NULL").select(F.col("_owner").alias("id"), F.col("_words").alias("words"))
    if windows := unfounded(texts, checks, window):
        held = texts.mapInArrow(partial(holder_batches, windows=windows, window=window), "words binary, id long")
        found = result({bytes(r.words): r.id for r in held.groupBy("words").agg(F.min("id").alias("id")).collect()})
    return found.where("_owner IS NULL").drop("_owner", "_words")
