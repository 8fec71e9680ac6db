"""WARC: archives of captures, and their index as one globally ordered history.

Each archive read back gives a run of captures, sorted by URL key and time. The runs are cut
at common keys; a loser tree merges the slices of one range, and the ranges in order are the
history of all captures.
"""

from __future__ import annotations

import gzip
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import partial
from itertools import batched
from urllib.parse import unquote_plus, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from doseline.llm.common import keep, new_folder, struct

LEAST_SHARED = 100  # bytes; shorter payloads are always written out
RECORDS_PER_FILE = 5_000
SAMPLED_KEYS = 10_000
KEYS_PER_RUN = 64
NO_DATE = "1970-01-01T00:00:00Z"

# Fixed values of the format.
CRLF = "\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"
PAGE = "urn:page:"

CAPTURE = struct(
    url_key=T.StringType(), captured=T.StringType(), page=T.StringType(), url=T.StringType(),
    record_type=T.StringType(), payload_bytes=T.LongType(), payload_digest=T.StringType(),
    refers_to=T.StringType(), archive=T.StringType(), offset=T.LongType(), length=T.LongType(),
)
RUN = struct(archive=T.StringType(), captures=T.ArrayType(CAPTURE))
SLICE = struct(range_no=T.LongType(), captures=T.ArrayType(CAPTURE))
HISTORY = T.StructType([*struct(range_no=T.LongType(), position=T.LongType()).fields, *CAPTURE.fields])


def url_key(url: str | None) -> str:
    """A URL with its host reversed, without scheme, 'www.', port and fragment, in lower case."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return (url or "").lower()
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return (",".join(reversed(host.split("."))) + ")" + rest).lower()


def header(name: str, value: Column) -> Column:
    """A header line; none where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def page_uri(page: Column) -> Column:
    """An id as a record id, percent-encoded, so that it cannot end its header or its brackets."""
    return F.concat(F.lit(f"<{PAGE}"), F.url_encode(page.cast("string")), F.lit(">"))


def records(
    pages: DataFrame, id_col: str, url_col: str, html_col: str, date_col: str | None, least: int
) -> DataFrame:
    """The text of each page's record, without the two line ends that close it.

    Pages with equal payloads of `least` bytes or more are one group; the smallest id is
    written out and the others refer to it. Only digests are grouped and looked up.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    date = F.date_format(F.to_utc_timestamp(date_col, "UTC"), "yyyy-MM-dd'T'HH:mm:ss'Z'") if date_col else F.lit(NO_DATE)
    rows = pages.select(
        F.col(id_col).alias("_id"),
        F.regexp_replace(F.col(url_col), r"[\r\n]", "%0A").alias("_url"),
        F.coalesce(date, F.lit(NO_DATE)).alias("_date"),
        F.sha2(html, 256).alias("_digest"),
        html.alias("_html"),
    )
    shared = rows.where(F.octet_length("_html") >= least).groupBy("_digest")
    shared = shared.agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_many")).where("_many > 1")
    rows = rows.join(shared.drop("_many"), "_digest", "left")
    revisit = F.coalesce(F.col("_first") != F.col("_id"), F.col("_first").isNotNull() & F.col("_id").isNull())
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length("_html").cast("string"), F.lit(CRLF + CRLF),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "_html"))
    head = F.concat(
        F.lit(f"{VERSION}{CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(CRLF),
        header("WARC-Record-ID", page_uri(F.col("_id"))),
        header("WARC-Date", F.col("_date")),
        header("WARC-Target-URI", F.col("_url")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "_digest")),
        header("WARC-Profile", F.when(revisit, PROFILE)),
        header("WARC-Refers-To", F.when(revisit, page_uri(F.col("_first")))),
        F.lit(f"Content-Type: {HTTP_TYPE}{CRLF}Content-Length: "), F.octet_length(block).cast("string"),
        F.lit(CRLF + CRLF),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    date_col: str | None = None, least: int = LEAST_SHARED,
) -> None:
    """Write one record per row into compressed archives under `folder`, as Spark's writer
    commits them; a record's two closing line ends are its line separator. `date_col` is a
    timestamp; without one the captures have no time of their own."""
    writer = records(pages, id_col, url_col, html_col, date_col, least).write
    writer = writer.option("lineSep", CRLF + CRLF).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def fields(lines: bytes) -> dict[str, str]:
    pairs = (line.split(b": ", 1) for line in lines.split(b"\r\n")[1:])
    return {name.decode(): value.decode() for name, value in pairs}


def page_of(uri: str | None) -> str | None:
    return unquote_plus(uri.removeprefix(f"<{PAGE}").removesuffix(">")) if uri else None


def parse(archive: str, data: bytes) -> Iterator[dict]:
    """The captures of one archive, in file order; lengths decide, so a payload may hold
    anything. A payload that differs from its digest is an error."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at) + 4
        head = fields(data[at : end - 4])
        size = int(head["Content-Length"])
        block = data[end : end + size]
        body = block.index(b"\r\n\r\n") + 4
        payload = block[body:]
        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
        kind = head["WARC-Type"]
        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"{archive} is damaged at byte {at}")
        yield {
            "url_key": url_key(head.get("WARC-Target-URI")),
            "captured": head["WARC-Date"],
            "page": page_of(head.get("WARC-Record-ID")),
            "url": head.get("WARC-Target-URI"),
            "record_type": kind,
            "payload_bytes": len(payload) if kind == "response" else int(fields(block[: body - 4])["Content-Length"]),
            "payload_digest": digest,
            "refers_to": page_of(head.get("WARC-Refers-To")),
            "archive": archive,
            "offset": at,
            "length": end + size - at,
        }
        at = end + size + 4


def order_of(capture: dict) -> tuple[str, str, str, str, int]:
    """By URL key and time; ties by page, archive and place, so that the order is total."""
    return capture["url_key"], capture["captured"], capture["page"] or "", capture["archive"], capture["offset"]


def run_batches(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Archives to sorted runs."""
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            archive = path.as_py().rsplit("/", 1)[-1]
            run = sorted(parse(archive, gzip.decompress(content.as_py())), key=order_of)
            if run:
                yield pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([run], schema.field(1).type)], schema=schema)


class LoserTree:
    """Merges sorted iterators: inner nodes hold the loser of their match, so that after each
    winner only the matches on its path are played again."""

    def __init__(self, runs: list[Iterator[dict]]):
        self.runs = runs
        self.heads = [self.advance(i) for i in range(len(runs))]
        self.losers = [-1] * len(runs)
        self.winner = self.play(1) if runs else -1

    def advance(self, run: int) -> tuple:
        """The next key of a run, ended runs being last."""
        capture = next(self.runs[run], None)
        return (True, (), run, None) if capture is None else (False, order_of(capture), run, capture)

    def beats(self, a: int, b: int) -> bool:
        return self.heads[a][:3] < self.heads[b][:3]

    def play(self, node: int) -> int:
        """Winner below a node; the leaves follow the inner nodes 1 to k - 1."""
        k = len(self.runs)
        if node >= k:
            return node - k
        a, b = self.play(2 * node), self.play(2 * node + 1)
        won, lost = (a, b) if self.beats(a, b) else (b, a)
        self.losers[node] = lost
        return won

    def __iter__(self) -> Iterator[dict]:
        while self.winner >= 0 and not self.heads[self.winner][0]:
            best = self.winner
            yield self.heads[best][3]
            self.heads[best] = self.advance(best)
            node = (best + len(self.runs)) // 2
            while node:
                if self.beats(self.losers[node], best):
                    self.losers[node], best = best, self.losers[node]
                node //= 2
            self.winner = best


def slice_batches(batches: Iterator[pa.RecordBatch], cuts: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Runs to their slices between the cuts."""
    for batch in batches:
        for run in batch.column(1).to_pylist():
            keys = [order_of(c) for c in run]
            edges = [0, *(bisect_left(keys, cut) for cut in cuts), len(run)]
            found = [(i, run[a:b]) for i, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]
            columns = [pa.array(c, f.type) for c, f in zip(zip(*found), schema, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def merge_batches(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Slices, sorted by range, to the range's captures in order."""

    def merged(number: int, slices: list[list[dict]]) -> Iterator[pa.RecordBatch]:
        rows = ({"range_no": number, "position": i, **c} for i, c in enumerate(LoserTree([iter(s) for s in slices])))
        for some in batched(rows, RECORDS_PER_FILE):
            yield pa.RecordBatch.from_pylist(list(some), schema=schema)

    number, slices = None, []
    for batch in batches:
        for own, captures in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if own != number and slices:
                yield from merged(number, slices)
                slices = []
            number = own
            slices.append(captures)
    if slices:
        yield from merged(number, slices)


def capture_history(spark: SparkSession, folder: str, ranges: int | None = None) -> DataFrame:
    """The captures of all archives under `folder`, ordered by (`range_no`, `position`).

    Runs are written once. The cuts are quantiles of at most SAMPLED_KEYS keys taken evenly
    from the runs, and only balance the ranges: any cuts give the same history. They are full keys, so
    a URL with very many captures spreads over ranges. Ranges are as many as shuffle
    partitions unless given; a range is merged in one task.
    """
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path", "content")
    runs = keep(archives.mapInArrow(partial(run_batches, schema=to_arrow_schema(RUN)), RUN), "runs")
    step = F.greatest(F.lit(1), F.floor(F.size("captures") / KEYS_PER_RUN)).cast("int")
    places = F.sequence(F.lit(0), F.size("captures") - 1, step)
    keys = runs.select(F.explode(F.transform(places, lambda i: F.get("captures", i))).alias("c"))
    keys = keys.select("c.url_key", "c.captured", "c.page", "c.archive", "c.offset")
    sample = keys.orderBy(F.xxhash64("archive", "offset")).limit(SAMPLED_KEYS).collect()
    sample = sorted(order_of(r.asDict()) for r in sample)
    cuts = [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []
    sliced = runs.mapInArrow(partial(slice_batches, cuts=sorted(set(cuts)), schema=to_arrow_schema(SLICE)), SLICE)
    dealt = sliced.repartition("range_no").sortWithinPartitions("range_no")
    return dealt.mapInArrow(partial(merge_batches, schema=to_arrow_schema(HISTORY)), HISTORY)


def archive_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    date_col: str | None = None, least: int = LEAST_SHARED, folder: str | None = None,
) -> DataFrame:
    """Write the pages as archives, read them back, and return their history with the id.

    Null html is an empty payload, a null URL is left out of its record, and a null id has no
    record id; in a group with other ids it refers to the smallest. Rows that repeat the
    smallest id of a group are each written out. Ids of any text come back as they were. Other
    columns are not read, and an id named like a column of the history takes its place; an
    empty table gives an empty result.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "archives")
    write_archives(pages, folder, id_col, url_col, html_col, date_col, least)
    kind = pages.schema[id_col].dataType
    history = capture_history(spark, folder).withColumn("refers_to", F.col("refers_to").cast(kind))
    others = [name for name in history.columns if name not in ("page", id_col)]
    return history.select(*others, F.col("page").cast(kind).alias(id_col))
