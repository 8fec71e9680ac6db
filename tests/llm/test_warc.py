"""Archives: exact round trip, and the merged history against a plain sort."""

from __future__ import annotations

import hashlib
import heapq
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from doseline.llm import warc


def capture(key, at):
    return {"url_key": key, "captured": "t", "page": None, "archive": "a", "offset": at}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcde"), max_size=9), max_size=9))
def test_loser_tree_merges(keys):
    runs = [sorted((capture(k, 100 * i + j) for j, k in enumerate(run)), key=warc.order_of) for i, run in enumerate(keys)]
    assert list(warc.LoserTree([iter(r) for r in runs])) == list(heapq.merge(*runs, key=warc.order_of))


def test_url_keys():
    assert warc.url_key("http://www.Example.org:80/A/b?q=1#x") == "org,example)/a/b?q=1"
    assert warc.url_key("https://example.org") == "org,example)/"
    assert warc.url_key(None) == ")/" and warc.url_key("http://[bad") == "http://[bad"


ROWS = [
    (1, "http://b.org/x", "<p>" + "a" * 200), (5, "http://a.org/", "<p>" + "a" * 200), (2, "http://a.org/y", "short"),
    (3, "http://a.org/y", "short"), (4, None, None), (6, "http://a.org/\r\nX: y", ""), (None, "http://c.org", "<p>" + "a" * 200),
    (7, "http://d.org", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\nContent-Length: 3\r\n\r\n" + "é漢" * 60),
    (8, "http://d.org", "x" * 3_000_000), (8, "http://d.org", "x" * 3_000_000), (9, "http://d.org", "x" * 3_000_000),
]


@pytest.mark.parametrize("ranges", [1, 4, 50])
def test_round_trip_and_order(spark, tmp_path, ranges):
    stamps = [(*r, datetime(2024, 1, 1 + i % 3), "own") for i, r in enumerate(ROWS)]
    pages = spark.createDataFrame(stamps, "page_id long, url string, html string, at timestamp, record_type string")
    folder = str(tmp_path / "archives")
    warc.write_archives(pages.repartition(4), folder, date_col="at")
    got = [r.asDict() for r in warc.capture_history(spark, folder, ranges).orderBy("range_no", "position").collect()]
    assert [warc.order_of(r) for r in got] == sorted(warc.order_of(r) for r in got) and len(got) == len(ROWS)
    want = []
    for i, url, html, at, _ in stamps:
        data = (html or "").encode()
        group = [r[0] for r in ROWS if r[0] and (r[2] or "").encode() == data]
        again = len(data) >= 100 and i != min(group)
        want.append((str(i) if i else None, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", str(min(group)) if again else None, at.strftime("%Y-%m-%dT00:00:00Z")))
    keys = ("page", "payload_bytes", "payload_digest", "record_type", "refers_to", "captured")
    assert sorted(map(str, want)) == sorted(str(tuple(r[k] for k in keys)) for r in got)


def test_odd_rows(spark):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id int, url string, html string, refers_to string")
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc.archive_pages(pages).collect()}
    assert got == {
        (1, "response", None), (5, "revisit", 1), (2, "response", None), (3, "response", None), (4, "response", None),
        (6, "response", None), (None, "revisit", 1), (7, "response", None), (8, "response", None), (9, "revisit", 8),
    }
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_ids_of_any_text_and_name(spark):
    ids = ["<k>", "a\r\nWARC-Type: x", " b +%2B ", "urn:page:", "é>", "", None]
    pages = spark.createDataFrame([(i, f"http://e.org/{n}", "same " * 50) for n, i in enumerate(ids)], "page string, url string, html string")
    got = warc.archive_pages(pages, id_col="page").collect()
    first = min(i for i in ids if i is not None)
    assert sorted((r.page, r.record_type, r.refers_to) for r in got if r.page is not None) == sorted(
        (i, "response" if i == first else "revisit", None if i == first else first) for i in ids if i is not None
    )
    assert [(r.record_type, r.refers_to) for r in got if r.page is None] == [("revisit", first)]


def test_damage_is_found():
    data = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Date: d\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 9\r\n\r\nH: 1\r\n\r\nx\r\n\r\n"
    with pytest.raises(ValueError, match="damaged"):
        list(warc.parse("a", data))
