"""The pipeline, stage by stage, against brute force."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import public_tokenizers
import pytest
from test_decontamination import plain as overlaps
from test_simhash import plain_components, plain_fingerprint

import corpus_pipeline
from doseline.llm import decontamination, exact_dedup, language, mixture, simhash

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")


def words(text):
    return re.findall(r"[^\W_]+", text.lower())


def sizes_and_copies(docs):
    """Copies of all rows of each (id, source, text), by the rules of the mixture."""
    total = Counter()
    for _, source, text in docs:
        total[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(total, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_ones, rest = {}, set(order), sum(total.values())
    while True:
        share = {s: rest * weight[s] / sum(weight[o] for o in open_ones) for s in open_ones}
        above = {s for s in open_ones if share[s] > 3 * total[s]}
        if not above:
            break
        for s in above:
            target[s] = 3 * total[s]
            rest -= target[s]
        open_ones -= above
    target |= share
    out = {}
    for (d, source, text), n in Counter((d, source, text or "") for d, source, text in docs).items():
        rate = target[source] / total[source] if total[source] else 0
        digest = hashlib.md5(text.encode()).hexdigest()
        draw = int(hashlib.md5(f"17:{'null' if d is None else d}:{digest}".encode()).hexdigest()[:13], 16) / 16**13
        due = n * (rate - math.floor(rate))
        out[d, source, text] = n * math.floor(rate) + math.floor(due) + (draw < due - math.floor(due))
    return out, target, total


def test_pipeline_equals_brute_force(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = {r.doc_id: r for r in frame.collect()}
    read = language.languages_of(frame, PATH).collect()
    left = {r.doc_id for r in read if r.lang_pred != "und" and r.score >= 0.5}

    normal = {d: re.sub(r"[\x20\x09-\x0D]+", " ", docs[d].text) for d in left}
    first: dict[str, int] = {}
    for d in sorted(left):
        first.setdefault(normal[d], d)
    left = set(first.values())

    names = plain_components([(d, plain_fingerprint(docs[d].text)) for d in sorted(left)])
    left = {d for d in left if names[d] == d}

    items = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    grams = {tuple(w[k : k + 5]) for _, w in items for k in range(len(w) - 4)}
    near = [d for d in left for w in [words(docs[d].text)] if any(tuple(w[k : k + 5]) in grams for k in range(len(w) - 4))]
    left -= {d for d, *_ in overlaps([(d, words(docs[d].text)) for d in near], items)}

    copies, _, _ = sizes_and_copies([(d, docs[d].source, docs[d].text) for d in left])
    result = corpus_pipeline.run(spark, SMALL)
    assert result.columns == frame.columns
    assert Counter(r.doc_id for r in result.collect()) == Counter({d: n for (d, _, _), n in copies.items() if n})
    assert {tuple(r) for r in result.collect()} <= {tuple(r) for r in docs.values()}


def test_stage_names_and_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "simhash", "decontamination", "mixture"]
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, SMALL)
        assert out.columns == empty.columns and out.count() == 0


ROWS = [
    (4, "a  b\tc", "s"), (2, "a b c", None), (2, "a b c", None), (7, "a b c ", "t"), (5, None, "s"), (6, "", "s"),
    (None, "a b c", "s"), (None, "only", "t"), (9, "word " * 300_000, "u"), (10, None, "empty"),
]


def odd(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in ROWS], "doc_id int, text string, source string, keep_id string, size int")


def test_exact_groups_of_odd_rows(spark):
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(odd(spark)).collect())
    assert got == Counter([
        (4, 2, 4, False), (2, 2, 4, True), (2, 2, 4, True), (7, 7, 1, True), (5, 5, 3, True), (6, 5, 3, False),
        (10, 5, 3, False), (None, 2, 4, False), (None, None, 1, True), (9, 9, 1, True),
    ])
    kept = exact_dedup.drop_exact_copies(odd(spark))
    assert Counter(r.doc_id for r in kept.collect()) == Counter([2, 7, 5, None, 9]) and kept.columns == odd(spark).columns
    # Even if one content hash were shared by all texts, groups stay right.
    same = exact_dedup.exact_groups(odd(spark), content_hash=lambda text: exact_dedup.F.lit("h"))
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in same.collect()) == got


def test_texts_that_share_every_hash_are_never_merged(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda text, bits: exact_dedup.F.lit("s"))
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id int, text string")
    with pytest.raises(Exception, match="share both content hashes"):
        exact_dedup.exact_groups(docs, content_hash=lambda text: exact_dedup.F.lit("h")).where("kept").collect()


def test_mixture_of_odd_rows(spark):
    got = mixture.mix_counts(odd(spark)).collect()
    copies, _, _ = sizes_and_copies([(r[0], r[2], r[1]) for r in ROWS])
    dealt = Counter()
    for r in got:
        dealt[r.doc_id, r.source, r.size] += r.copies
    want = Counter()
    for (d, source, text), n in copies.items():
        want[d, source, len(text.split())] += n
    assert dealt == want
    assert len(got) == len(ROWS)
    for r in got:
        assert r.taken == r.size * r.copies <= 3 * r.size and r.source_size >= r.size
    assert {r.source: r.source_size for r in got}["empty"] == 0 and all(r.copies == 0 for r in got if r.source == "empty")
    mixed = mixture.mix(odd(spark))
    assert mixed.columns == odd(spark).columns and mixed.count() == sum(r.copies for r in got)
    assert mixture.mix_counts(odd(spark).limit(0)).count() == 0


def test_mixture_targets(spark):
    docs = [(i, ("a", "b", "c", None)[i % 4 if i < 8 else 0], "w " * (i + 1)) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, source string, text string")
    copies, target, total = sizes_and_copies(docs)
    got = {r.doc_id: r for r in mixture.mix_counts(frame).collect()}
    for d, source, _ in docs:
        assert abs(got[d].target - target[source]) < 1e-6 and got[d].source_size == total[source]
        assert got[d].copies == copies[d, source, "w " * (d + 1)]


def test_rows_without_ids_and_repeated_rows_draw_apart(spark):
    """Each source comes near its target, whether or not its rows can be told apart."""
    rows = [(None, "a", f"w{i} w w w w", i) for i in range(2_000)] + [(None, "b", "same five words in all", i % 3) for i in range(1_000)]
    rows += [(7, "c", "w w w w w", 0)] * 1_000 + [(i, "d", "w " * 5, 0) for i in range(7_000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string, n int")
    got = mixture.mix_counts(frame).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    for source in target:
        assert abs(taken[source] - target[source]) <= 0.02 * target[source], (source, taken, target)
    want = Counter()
    for r in got:
        want[r.source] += r.copies
    mixed = mixture.mix(frame).collect()
    assert Counter(r.source for r in mixed) == want
    assert max(Counter(r for r in mixed if r.source == "a").values()) <= 3
    assert sorted(map(tuple, mixture.mix(frame.repartition(5)).collect()), key=str) == sorted(map(tuple, mixed), key=str)


def test_no_column_of_a_caller_is_lost(spark):
    """Whatever its name, in any stage."""
    names = ["key", "id", "sha", "found", "known", "stays", "order", "row", "digest", "n", "copies", "part", "rate", "copy",
             "_row", "_ROW2", "_source", "_copy", "_rate", "_stays", "Size", "of_source", "same_id", "equal", "before", "_text"]
    rows = [(1, "the cat and the dog went home", "en", "s", *names), (2, "the cow", "en", "t", *names)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in names))
    items = spark.createDataFrame([(1, "none of these words")], "item_id long, text string")
    taught = frame.unionByName(frame.withColumn("lang", frame.source))
    for out in (
        language.drop_unknown_languages(taught, PATH, least=0.0), exact_dedup.drop_exact_copies(frame), simhash.drop_near_copies(frame),
        decontamination.drop_contaminated(frame, items), mixture.mix(frame),
    ):
        assert out.columns == frame.columns and out.schema == frame.schema
        assert {r[4:] for r in out.collect()} == {tuple(names)}


def rows_of(frame):
    return Counter((r.doc_id, r.text) for r in frame.collect())


def test_rows_that_share_an_id_or_have_none_are_judged_apart(spark):
    """Of two rows of one id, and of two without, each stage drops one and keeps the other."""
    ddl = "doc_id long, text string, lang string"
    good, bad = ("the cat and the dog", "12 34 !?")
    taught = [(i, "the cat and the dog" if i % 2 else "der Hund und die Katze", "en" if i % 2 else "de") for i in range(20)]
    rows = [(i, t, None) for i in (50, None) for t in (good, bad)]
    kept = language.drop_unknown_languages(spark.createDataFrame(taught + rows, ddl), PATH).where("lang IS NULL")
    assert rows_of(kept) == Counter([(50, good), (None, good)])

    one, two, three = (" ".join(f"{c}{i}" for i in range(200)) for c in "abc")
    rows = [(3, one), (5, one), (5, two), (None, one), (None, three), (None, three + "\n"), (None, three)]
    frame = spark.createDataFrame([(*r, None) for r in rows], ddl)
    first = min((three, three + "\n"), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert set(rows_of(simhash.drop_near_copies(frame))) == {(3, one), (5, two), (None, first)}

    items = spark.createDataFrame([(1, " ".join(f"a{i}" for i in range(20)))], "item_id long, text string")
    rows = [(5, one), (5, two), (None, one), (None, two), (None, None)]
    kept = decontamination.drop_contaminated(spark.createDataFrame([(*r, None) for r in rows], ddl), items)
    assert rows_of(kept) == Counter([(5, two), (None, two), (None, None)]) and kept.columns == ["doc_id", "text", "lang"]
