"""SimHash near-dedup: 64-bit fingerprints, linked by BK-trees over shards."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from doseline.llm.common import BYTES_AT_ONCE, beside, keep, row_key, text_blocks
from doseline.llm.components import components

BITS = 64
SHINGLE = 4
RADIUS = 4
BLOCKS = 6
SEED = 42
TREE_NODES = 16_384  # most nodes of one shard tree
PAIRS_AT_ONCE = 1 << 21  # of a query and a node, on one level of the search


def fingerprint(text: bytes, shingle: int = SHINGLE, size: int = BYTES_AT_ONCE) -> int:
    """Signed 64-bit fingerprint; a bit is set where over half the shingle hashes set it."""
    digest, ones, hashes, carried = xxhash.xxh64_digest, np.zeros(BITS, np.int64), 0, []
    for block in text_blocks(text.lower(), size):
        words = carried + block.split()
        if len(words) >= shingle:
            joined = b" ".join(words)
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            ends = (lengths + 1).cumsum() - 1
            starts = (ends - lengths)[: len(words) - shingle + 1]
            found = [digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends[shingle - 1 :].tolist())]
            bits = np.unpackbits(np.frombuffer(b"".join(found), np.uint8).reshape(-1, BITS // 8), axis=1)
            ones += bits.sum(axis=0, dtype=np.int64)
            hashes += len(found)
            carried = words[len(words) - shingle + 1 :]
        else:
            carried = words
    if not hashes and carried:
        ones += np.unpackbits(np.frombuffer(digest(b" ".join(carried), SEED), np.uint8))
        hashes = 1
    return int.from_bytes(np.packbits(ones * 2 > hashes).tobytes(), "big", signed=True)


def fingerprint_batches(
    batches: Iterator[pa.RecordBatch], shingle: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1)
        marks = [fingerprint(t.as_py() or b"", shingle) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.int64())], schema=schema)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Id and `mark`, the fingerprint as a signed number; no shuffle."""
    schema = T.StructType(
        [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("mark", T.LongType())]
    )
    work = partial(fingerprint_batches, shingle=shingle, schema=to_arrow_schema(schema))
    return docs.select(F.col(id_col), F.col(text_col).cast("binary")).mapInArrow(work, schema)


def shard_masks(radius: int, blocks: int) -> list[int]:
    """Bit masks such that two marks within the radius agree under at least one: with the
    bits in `blocks` blocks, the differing bits leave `blocks - radius` blocks untouched."""
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("blocks must exceed the radius")
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)).astype(np.int64)


class Forest:
    """BK-trees over shards of marks: a node's children are keyed by their distance from it.

    Trees of all shards are built and searched level by level together. Marks of a shard are
    distinct and `shard` is ascending.
    """

    def __init__(self, marks: np.ndarray, shard: np.ndarray):
        self.marks = marks
        first = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else np.zeros(0, np.int64)
        self.root = first[shard] if len(shard) else first
        node = self.root.copy()
        left = np.flatnonzero(node != np.arange(len(marks)))
        keys, children = [], []
        while len(left):
            key = node[left] * (BITS + 1) + distance(marks[left], marks[node[left]])
            order = np.argsort(key, kind="stable")
            left, key = left[order], key[order]
            new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            keys.append(key[new])
            children.append(left[new])
            node[left] = np.repeat(left[new], np.diff(np.r_[new, len(left)]))
            left = left[node[left] != left]
        edge = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        order = np.argsort(edge, kind="stable")
        self.edge = edge[order]
        self.child = np.concatenate(children)[order] if keys else edge

    def search(self, marks: np.ndarray, root: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) within the radius; only edges within it of the distance are followed."""
        query, node, hits = np.arange(len(marks)), root, []
        while len(query):
            away = distance(marks[query], self.marks[node])
            near = away <= radius
            hits.append((query[near], node[near]))
            base = node * (BITS + 1)
            low = np.searchsorted(self.edge, base + np.maximum(away - radius, 0))
            high = np.searchsorted(self.edge, base + np.minimum(away + radius, BITS), side="right")
            count = high - low
            total = int(count.sum())
            at = np.repeat(low - (count.cumsum() - count), count) + np.arange(total)
            query, node = np.repeat(query, count), self.child[at]
        return np.concatenate([q for q, _ in hits]), np.concatenate([n for _, n in hits])


def queries_at_once(nodes: int) -> int:
    """So many that a level of the search stays within its memory."""
    return max(1, PAIRS_AT_ONCE // int(nodes))


def settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the labels of linked items, in place; a label is its set's least item."""
    while True:
        high, low = np.maximum(label[a], label[b]), np.minimum(label[a], label[b])
        if (high == low).all():
            return
        np.minimum.at(label, high, low)
        while (label != (up := label[label])).any():
            label[:] = up


def link_within(marks: np.ndarray, shard: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what lies within the radius in each shard, at most one per mark."""
    forest, label = Forest(marks, shard), np.arange(len(marks))
    step = queries_at_once(np.bincount(shard).max(initial=1))
    for at in range(0, len(marks), step):
        some = slice(at, at + step)
        query, node = forest.search(marks[some], forest.root[some], radius)
        settle(label, query + at, node)
    moved = np.flatnonzero(label != np.arange(len(marks)))
    return marks[moved], marks[label[moved]]


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shard", pa.int64()), ("part", pa.int64()), ("marks", pa.binary())])


def links_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), none, none, pa.nulls(len(a), pa.binary())], schema=LINKS)


def shard_batches(batches: Iterator[pa.RecordBatch], radius: int, most: int) -> Iterator[pa.RecordBatch]:
    """Rows (shard key, mark), sorted, become links; a shard beyond `most` marks is passed on
    in parts of that size, as packed marks."""
    keys, marks = np.zeros((2, 0), np.int64), np.zeros(0, np.int64)
    part, again = 0, True

    def passed_on(key: np.ndarray, own: np.ndarray, number: int) -> pa.RecordBatch:
        name = xxhash.xxh64_intdigest(key.tobytes()) - (1 << 63)
        row = [[None], [None], [name], [number], [own.tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, LINKS, strict=True)], schema=LINKS)

    while again:
        batch = next(batches, None)
        again = batch is not None
        if again:
            fresh = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            keys, marks = np.hstack([keys, fresh]), np.r_[marks, batch.column(2).to_numpy()]
        change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        if part and (len(change) or not again):  # the rest of a large shard
            end = change[0] if len(change) else len(marks)
            if end:
                yield passed_on(keys[:, 0], marks[:end], part)
            part, keys, marks, change = 0, keys[:, end:], marks[end:], change[1:] - end
        done = len(marks) if not again else change[-1] if len(change) else 0
        if done:
            starts = np.r_[0, change[change < done]]
            sizes = np.diff(np.r_[starts, done])
            shard = np.repeat(np.arange(len(starts)), sizes)
            small = (sizes > 1) & (sizes <= most)
            chosen = np.flatnonzero(small[shard])
            _, dense = np.unique(shard[chosen], return_inverse=True)
            yield links_batch(*link_within(marks[:done][chosen], dense, radius))
            for s in np.flatnonzero(sizes > most):
                own = marks[starts[s] : starts[s] + sizes[s]]
                for number, at in enumerate(range(0, len(own), most)):
                    yield passed_on(keys[:, starts[s]], own[at : at + most], number)
            keys, marks = keys[:, done:], marks[done:]
        while len(marks) > most and again:  # one shard that goes on
            yield passed_on(keys[:, 0], marks[:most], part)
            part, keys, marks = part + 1, keys[:, most:], marks[most:]


def cell_batches(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Pairs of parts of one large shard: the tree of one answers the marks of the other."""
    for batch in batches:
        for ours, theirs in zip(batch.column(0), batch.column(1), strict=True):
            tree, asked = (np.frombuffer(x.as_py(), np.int64) for x in (ours, theirs))
            forest = Forest(tree, np.zeros(len(tree), np.int64))
            marks = np.r_[tree, asked]
            label = np.arange(len(marks))
            step = queries_at_once(len(tree))
            for at in range(0, len(asked), step):
                some = asked[at : at + step]
                query, node = forest.search(some, np.zeros(len(some), np.int64), radius)
                settle(label, query + at + len(tree), node)
            moved = np.flatnonzero(label != np.arange(len(marks)))
            yield links_batch(marks[moved], marks[label[moved]])


def mark_links(marks: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, most: int = TREE_NODES) -> DataFrame:
    """Links (`a`, `b`) that connect every two distinct marks within the radius.

    Marks are dealt to shards by the bits under each mask, so that two marks within the
    radius meet in a shard; `blocks` sets how finely (more blocks: smaller shards, more
    copies of each mark). A task builds the BK-trees of the shards it holds and asks them
    for their own marks. A shard over `most` marks is cut into parts, and the tree of each
    part goes to the other parts, a task for each pair of parts.
    """
    masks = shard_masks(radius, blocks)
    dealt = marks.select(
        "mark",
        F.explode(F.array(*[
            F.struct(F.lit(i).cast("long").alias("mask"), F.col("mark").bitwiseAND(F.lit(m)).alias("key"))
            for i, m in enumerate(masks)
        ])).alias("s"),
    ).select("s.mask", "s.key", "mark")
    sharded = dealt.repartition("mask", "key").sortWithinPartitions("mask", "key")
    ddl = "a long, b long, shard long, part long, marks binary"
    found = keep(sharded.mapInArrow(partial(shard_batches, radius=radius, most=most), ddl), "shards")
    parts = found.where("marks IS NOT NULL").select("shard", "part", "marks")
    other = parts.select("shard", F.col("part").alias("_part"), F.col("marks").alias("_marks"))
    cells = parts.join(other, "shard").where("part <= _part").select("marks", "_marks")
    across = cells.repartition(F.xxhash64("marks", "_marks")).mapInArrow(partial(cell_batches, radius=radius), ddl)
    return found.where("marks IS NULL").unionByName(across).select("a", "b")


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
) -> DataFrame:
    """One row per input row: id, `fingerprint` (16 hexadecimal digits), `component_id`.

    Texts are lower-cased in ASCII and cut into words; XXH64 of each shingle of `shingle`
    words, repeats included, votes on every bit. Fewer words make one shingle. Fingerprints
    that differ in at most `radius` bits are linked; a component is named after the smallest
    id in it. All fingerprints are compared, none is capped; equal ones are compared once.

    Null and empty texts have fingerprint zero and are linked like any other. A null id
    never names a component unless it has no other. Repeated rows repeat their result; other
    columns are not read; an empty table gives an empty result.
    """
    marked = keep(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    marks = marked.groupBy("mark").agg(F.min(id_col).alias("_least"))
    roots = keep(components(mark_links(marks.select("mark"), radius, blocks)), "components")
    rooted = marks.join(roots, marks["mark"] == roots["node"], "left").select(
        "mark", "_least", F.coalesce("root", "mark").alias("_root")
    )
    named = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    names = rooted.join(named, "_root").select(F.col("mark").alias("_mark"), "component_id")
    return marked.join(names, marked["mark"] == names["_mark"]).select(
        id_col,
        F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
) -> DataFrame:
    """One document of each component, with all its columns: the one that names it. Of
    several texts under that id, or under none, the one with the smallest hash stays; rows
    repeated whole stay together."""
    rows = beside(docs, id=F.col(id_col), text=F.col(text_col), key=row_key(id_col, text_col))
    order = F.struct(F.col("id").isNull().alias("none"), "id", F.col("key").alias("row"))
    keyed = rows.select(order.alias("order"), "text")
    near = near_copies(keyed, "order", "text", shingle, radius, blocks)
    stays = near.where(F.col("order") == F.col("component_id")).select(F.col("order.row").alias("stays"))
    return rows.join(stays.distinct(), F.col("key") == F.col("stays"), "left_semi").select("row.*")
