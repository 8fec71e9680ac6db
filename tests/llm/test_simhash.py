"""Fingerprints and components against brute force."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from doseline.llm import simhash
from doseline.llm.components import components
from doseline.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text: str | None) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [words[i : i + 4] for i in range(len(words) - 3)] if len(words) >= 4 else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs: list[tuple[int, int]], radius: int = 4) -> dict[int, int]:
    """Smallest id reachable, from (id, mark) by comparing all."""
    name = {i: i for i, _ in pairs}
    linked = [(a, b) for a, x in pairs for b, y in pairs if a < b and (x ^ y).bit_count() <= radius]
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            least = min(name[a], name[b])
            changed |= name[a] != least or name[b] != least
            name[a] = name[b] = least
    return name


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: plain_fingerprint(r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    names = plain_components(list(docs.items()))
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op3_simhash"](spark, SMALL).collect()}
    assert got == {(d, f"{m:016x}", names[d]) for d, m in docs.items()}
    assert len({n for *_, n in got}) < len(docs)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAÉ \t\n\x85\xa0b", max_size=60), st.integers(1, 9))
def test_fingerprint_in_blocks(text, size):
    assert simhash.fingerprint(text.encode(), size=size) % 2**64 == plain_fingerprint(text)


@pytest.fixture(scope="module")
def marks():
    """Random marks, chains and a dense cluster around one of them."""
    draw = np.random.default_rng(5)
    found = [int(x) for x in draw.integers(-(2**63), 2**63 - 1, 120)]
    for center, many, steps in ((found[0], 80, 3), (found[1], 20, 4)):
        mark = center
        for _ in range(many):
            for bit in draw.choice(64, steps, replace=False):
                mark ^= 1 << int(bit)
            mark = (mark + 2**63) % 2**64 - 2**63
            found.append(mark)
            mark = center if steps == 3 else mark
    return sorted(set(found))


@pytest.mark.parametrize("most", [3, 7, 1000])
def test_links_connect_what_brute_force_connects(spark, marks, most):
    frame = spark.createDataFrame([(m,) for m in marks], "mark long")
    roots = {r.node: r.root for r in components(simhash.mark_links(frame, most=most)).collect()}
    got = {}
    for m in marks:
        got.setdefault(roots.get(m, m), set()).add(m)
    want = {}
    for m, name in plain_components([(m, m % 2**64) for m in marks]).items():
        want.setdefault(name, set()).add(m)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_masks_leave_no_pair_out():
    masks = [m % 2**64 for m in simhash.shard_masks(4, 6)]
    draw = np.random.default_rng(1)
    for _ in range(2000):
        off = sum(1 << int(b) for b in draw.choice(64, 4, replace=False))
        assert any(m & off == 0 for m in masks)


def test_shards_do_not_depend_on_batches(marks):
    keyed = sorted((m & 7, 0, m) for m in marks)
    columns = list(zip(*[(k, z, m) for k, z, m in keyed]))

    def linked(size, most):
        table = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list("abc"))
        parts = [table.slice(i, size) for i in range(0, table.num_rows, size)]
        out = pa.Table.from_batches(simhash.shard_batches(iter(parts), 4, most))
        chunks = sum(len(x) // 8 for x in out["marks"].to_pylist() if x)
        return set(zip(out["a"].to_pylist(), out["b"].to_pylist())) - {(None, None)}, chunks

    assert linked(1, 1000) == linked(7, 1000) == linked(10**6, 1000)
    sizes = [sum(1 for k, *_ in keyed if k == v) for v in range(8)]
    for size in (1, 7, 10**6):
        assert linked(size, 5)[1] == sum(s for s in sizes if s > 5)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 140)}


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    rows = [(5, None, "x"), (2, "", "x"), (3, long, "x"), (3, long, "x"), (9, "one two", "x"), (4, "ONE  two", "x"), (None, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_copies(docs).collect())
    assert got == [(-1, -1), (2, 2), (3, 3), (3, 3), (4, 4), (5, 2), (9, 4)]
    assert simhash.near_copies(docs.limit(0)).count() == 0
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 2, 3, 3, 4]
