"""WARC archives and the external merge of their index.

Pages are written as WARC records by Spark's text sink: a record is UTF-8 text, and the
line separator of the sink is the blank lines that end a record, so each file is a (gzip)
archive. The archives are read back whole, one file a row and of bounded size, and give
each its run of index entries, sorted by URL key and timestamp. The runs are stored; then
the key space is cut into ranges, and in every range a loser tree merges the k runs. The
ranges in order are the capture history of all URLs.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions.keys import lookup
from tallywork.llm.text import tasks_for
from tallywork.session import shared_folder, written

LEAST_BYTES = 100
RECORDS_PER_ARCHIVE = 2048
END = "\r\n\r\n"
NO_PAGE = "none"
# Captures without a time of their own count seconds from here, by page id.
EPOCH = 1_704_067_200


def page_time(id: str = "page_id") -> Column:
    """A made-up capture time, the same in every run: page ids are taken as seconds."""
    return F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce(F.col(id), F.lit(0)), F.lit(10**9)))


def _urn(id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(id.cast("string"), F.lit(NO_PAGE)), F.lit(">"))


def records(
    pages: DataFrame, *, id: str = "page_id", url: str = "url", html: str = "html", captured: Column | None = None
) -> DataFrame:
    """(record): a WARC response or revisit record, without its final blank lines, per page.

    Of pages with equal payloads of LEAST_BYTES or more the one with the smallest id is the
    response; the others are revisits without payload that refer to it. Only ids and digests
    are grouped; the pages join the list of revisits on their unique id, so a payload that a
    third of the pages share is no hot key.
    """
    page = pages.select(
        F.col(id).cast("bigint").alias("id"),
        # A target on one line, without spaces: a record's header must not be broken up.
        F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"[\x00-\x20\x7f]", "%20").alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
        F.date_format(captured if captured is not None else page_time(id), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"),
    ).withColumns({"bytes": F.octet_length("html"), "digest": F.sha2("html", 256)})
    narrow = page.filter(F.col("bytes") >= LEAST_BYTES).select("id", "digest")
    shared = (
        narrow.groupBy(F.col("digest").alias("_digest"))
        .agg(F.min("id").alias("refers"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    revisits = (
        lookup(narrow, shared, {"digest": "_digest"}, "inner")
        .filter(~F.col("id").eqNullSafe(F.col("refers")))
        .distinct()
        .withColumnsRenamed({"id": "_id", "digest": "_digest"})
    )
    joined = lookup(page, revisits, {"id": "_id", "digest": "_digest"})
    again = F.col("refers").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END),
    )
    block = F.when(again, http).otherwise(F.concat(http, F.col("html")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "),
        _urn(F.col("id")),
        F.when(
            again,
            F.concat(
                F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
                _urn(F.col("refers")),
            ),
        ).otherwise(F.lit("")),
        F.lit("\r\nWARC-Date: "),
        F.col("at"),
        F.lit("\r\nWARC-Target-URI: "),
        F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
    )
    return joined.select(F.concat(head, block).alias("record"))


def write_archives(records: DataFrame, folder: str, rows: int) -> None:
    """Write ``rows`` records as gzip archives of at most RECORDS_PER_ARCHIVE records; many
    small partitions share an archive."""
    (
        records.coalesce(max(1, -(-rows // RECORDS_PER_ARCHIVE)))
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_ARCHIVE)
        .text(folder)
    )


def url_key(url: str) -> str:
    """The sort key of a URL: host labels reversed, then the path and query, in lower case."""
    try:
        parts = urlsplit(url if "//" in url else "//" + url)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.lower()
    host = re.sub(r"^www\d*\.", "", host)
    tail = f":{port}" if port and port not in (80, 443) else ""
    query = f"?{parts.query}" if parts.query else ""
    return (",".join(reversed(host.split("."))) + tail + ")" + (parts.path or "/") + query).lower()


def parsed(raw: bytes) -> Iterator[dict[str, object]]:
    """Index entries of an archive's records, in file order.

    Length and digest of a response are taken from its payload, not from its header; those
    of a revisit, which has no payload, from its HTTP head and its header.
    """
    at, blank = 0, END.encode()
    while at < len(raw):
        body = raw.index(blank, at) + len(blank)
        lines = raw[at:body].decode().split("\r\n")[1:-2]
        field = dict(line.split(": ", 1) for line in lines)
        end = body + int(field["Content-Length"])
        payload = raw.index(blank, body) + len(blank)
        kind, data = field["WARC-Type"], raw[payload:end]
        if kind == "response":
            size, digest = len(data), hashlib.sha256(data).hexdigest()
        else:
            head = raw[body:payload].decode()
            size = int(re.search(r"Content-Length: (\d+)", head)[1])
            digest = field["WARC-Payload-Digest"].removeprefix("sha256:")

        def page(name: str) -> int | None:
            text = field.get(name, "").removeprefix("<urn:page:").removesuffix(">")
            return int(text) if text and text != NO_PAGE else None

        yield {
            "urlkey": url_key(field["WARC-Target-URI"]),
            "timestamp": re.sub(r"\D", "", field["WARC-Date"]),
            "page_id": page("WARC-Record-ID"),
            "payload_bytes": size,
            "payload_digest": digest,
            "record_type": kind,
            "refers_to": page("WARC-Refers-To"),
            "record_offset": at,
            "record_bytes": end - at,
        }
        at = end + len(blank)


ENTRY = (
    "urlkey string, timestamp string, page_id bigint, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint, record_offset bigint, record_bytes bigint"
)
RUN_SCHEMA = f"archive string, place bigint, {ENTRY}"
_ARROW = {"string": pa.string(), "bigint": pa.int64()}


def _arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (part.split() for part in ddl.split(", "))])


def sort_key(entry: dict[str, object]) -> tuple:
    return entry["urlkey"], entry["timestamp"], entry["page_id"] is not None, entry["page_id"] or 0, entry["record_offset"]


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The sorted run of each archive: RUN_SCHEMA, ``place`` numbers the entries of a run."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow_schema(RUN_SCHEMA)
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                entries = sorted(parsed(gzip.decompress(content.as_py())), key=sort_key)
                name = path.rsplit("/", 1)[-1]
                rows = [{"archive": name, "place": i, **entry} for i, entry in enumerate(entries)]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("path", "content").mapInArrow(runs, RUN_SCHEMA)


class LoserTree:
    """k-way merge: the inner nodes hold the losers of their matches, so the next smallest
    entry costs one path from a leaf to the root."""

    def __init__(self, runs: Sequence[Iterator[tuple[tuple, object]]]):
        self.runs = list(runs)
        k = len(self.runs)
        self.heads = [next(run, None) for run in self.runs]
        self.losers = [-1] * max(k, 1)
        # A node that has no match yet keeps the run that waits there.
        for leaf in range(k):
            winner, node = leaf, (leaf + k) // 2
            while node and self.losers[node] >= 0:
                if self._before(self.losers[node], winner):
                    self.losers[node], winner = winner, self.losers[node]
                node //= 2
            self.losers[node] = winner

    def _before(self, a: int, b: int) -> bool:
        """Whether run a comes before run b; ended runs come last, ties by number."""
        one, other = self.heads[a], self.heads[b]
        if one is None or other is None:
            return other is None and (one is not None or a < b)
        return (one[0], a) < (other[0], b)

    def __iter__(self) -> Iterator[object]:
        k = len(self.runs)
        while k and self.heads[winner := self.losers[0]] is not None:
            yield self.heads[winner][1]
            self.heads[winner] = next(self.runs[winner], None)
            node = (winner + k) // 2
            while node:
                if self._before(self.losers[node], winner):
                    self.losers[node], winner = winner, self.losers[node]
                node //= 2
            self.losers[0] = winner


# Entries a task merges; as Python rows some hundred MB.
RANGE_ENTRIES = 200_000
HISTORY_SCHEMA = f"range bigint, place bigint, archive string, {ENTRY}"


def merged_history(runs: DataFrame, ranges: int | None = None) -> DataFrame:
    """The runs merged: rows in order of (range, place) are the captures of all URLs by URL
    key, timestamp and page id.

    The range bounds lie on the whole sort key, so the captures of a very frequent URL
    spread over several ranges, and a task holds the runs' parts in its range only: about
    RANGE_ENTRIES, however many there are in all. Inside a task rows come run by run, each in its own order, and the loser tree merges them.
    """
    width = ranges or tasks_for(runs.sparkSession, runs.count(), RANGE_ENTRIES)
    key = ["urlkey", "timestamp", "page_id", "archive", "place"]
    dealt = (
        runs.repartitionByRange(width, *key)
        .withColumn("range", F.spark_partition_id().cast("bigint"))
        .sortWithinPartitions("archive", "place")
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow_schema(HISTORY_SCHEMA)
        held: dict[str, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault(row["archive"], []).append(row)
        tree = LoserTree([((sort_key(row), row) for row in run) for run in held.values()])
        rows = []
        for place, row in enumerate(tree):
            rows.append({**row, "place": place})
            if len(rows) == 4096:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return dealt.select("range", "place", "archive", *(p.split()[0] for p in ENTRY.split(", "))).mapInArrow(
        merge, HISTORY_SCHEMA
    )


def archive_and_index(
    pages: DataFrame,
    *,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    captured: Column | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Write ``pages`` to archives in ``folder`` (by default a new one in the shared folder),
    read them back and return the merged capture history, one row per page.

    A null html is empty, a null url too; pages below LEAST_BYTES are never revisits. Rows
    that repeat a page id and its payload are all responses, or all revisits of a smaller
    id. A null page id refers to, but is not referred to; it sorts first. Other columns are not read.
    """
    spark = pages.sparkSession
    place = folder or f"{shared_folder(spark)}/archives-{uuid.uuid4().hex}"
    write_archives(records(pages, id=id, url=url, html=html, captured=captured), place, pages.count())
    return merged_history(written(read_runs(spark, place)))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
m AS (SELECT page_id, html, strlen(html) AS n, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM m
"""
