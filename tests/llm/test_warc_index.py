import gzip
import hashlib
import random
from datetime import datetime

from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywork.llm import warc_index
from tallywork.llm.warc_index import LoserTree, archive_and_index, merged_history, parsed, read_runs, records, sort_key, url_key, write_archives

SCHEMA = "page_id bigint, url string, html string, at timestamp, digest string"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20), max_size=8), max_size=9))
def test_loser_tree(runs):
    runs = [sorted(run) for run in runs]
    got = list(LoserTree([iter([(x, (x, i)) for x in run]) for i, run in enumerate(runs)]))
    assert got == sorted((x, i) for i, run in enumerate(runs) for x in run)


def test_url_key():
    assert url_key("http://www.A.Example.com:80/Path?q=1#top") == "com,example,a)/path?q=1"
    assert url_key("https://example.org:8080") == "org,example:8080)/"
    assert url_key("example.net/x") == "net,example)/x"
    assert url_key("") == ")/" and url_key("http://[bad") == "http://[bad"


def data():
    rng = random.Random(8)
    page = lambda n: "".join(rng.choices("<p>é \r\n\r\nWARC/1.1\r\n", k=n))
    shared, small = page(300), "tiny"
    out = []
    for i in range(200):
        html = shared if i % 3 == 0 else small if i % 5 == 0 else page(rng.randrange(400))
        url = "http://hot.example.com/" if i % 2 else f"http://h{i % 9}.example.org/{i}\r\nWARC-Type: forged"
        out.append((i * 11 % 1000, url, html, datetime(2024, 1, 1 + i % 28), "x"))
    return out + [(5000, None, None, datetime(2024, 1, 1), "x"), (5001, "u", "", datetime(2024, 1, 1), "x"), (None, "u", shared, datetime(2024, 1, 1), "x"), (11, "again", small, datetime(2024, 1, 1), "x")]


def test_history(spark, monkeypatch):
    monkeypatch.setattr(warc_index, "RECORDS_PER_ARCHIVE", 17)
    pages = data()
    df = spark.createDataFrame(pages, SCHEMA).repartition(4)
    got = archive_and_index(df, captured=F.col("at")).collect()
    first = {}
    for i, _, html, _, _ in pages:
        raw = (html or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(first.get(raw, i), i)
    want = []
    for i, url, html, at, _ in pages:
        raw = (html or "").encode()
        refers = first.get(raw)
        again = refers is not None and refers != i
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", refers if again else None))
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[f] for f in fields) for r in got), key=repr) == sorted(want, key=repr)
    # In order of range and place the captures are in order of URL key and time.
    ordered = [r.asDict() for r in sorted(got, key=lambda r: (r["range"], r["place"]))]
    keys = [sort_key(r)[:4] for r in ordered]
    assert keys == sorted(keys)
    assert len({r["range"] for r in ordered if r["urlkey"] == "com,example,hot)/"}) > 1
    assert len({r["archive"] for r in ordered}) >= 12


def test_archives_on_disk(spark, tmp_path, monkeypatch):
    """Plain WARC files: offsets point at records, lengths and digests hold."""
    monkeypatch.setattr(warc_index, "RECORDS_PER_ARCHIVE", 20)
    folder = str(tmp_path / "archives")
    write_archives(records(spark.createDataFrame(data(), SCHEMA).repartition(2)), folder, rows=len(data()))
    files = {p.name: gzip.decompress(p.read_bytes()) for p in (tmp_path / "archives").glob("*.gz")}
    assert all(len(list(parsed(raw))) <= 20 for raw in files.values())
    runs = read_runs(spark, folder).collect()
    for r in runs:
        record = files[r.archive][r.record_offset : r.record_offset + r.record_bytes]
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode())
        assert files[r.archive][r.record_offset + r.record_bytes :].startswith(b"\r\n\r\n")
        payload = record.split(b"\r\n\r\n", 2)[2]
        assert (hashlib.sha256(payload).hexdigest() == r.payload_digest) == (r.record_type == "response")
        assert b"forged" not in record.split(b"\r\n\r\n")[0].split(b"\r\n")[1]
    for name in files:
        run = sorted((r for r in runs if r.archive == name), key=lambda r: r.place)
        assert [sort_key(r.asDict()) for r in run] == sorted(sort_key(r.asDict()) for r in run)


def test_empty(frame, spark):
    assert archive_and_index(frame([], SCHEMA)).count() == 0
    assert merged_history(spark.createDataFrame([], warc_index.RUN_SCHEMA), ranges=3).count() == 0
    one = archive_and_index(frame([(1, "u", "h", None, "d")], "page_id bigint, url string, html string, urlkey string, place string"))
    assert rows(one, "page_id", "record_type") == [(1, "response")]


def test_ranges_grow_with_the_entries(spark, monkeypatch, tmp_path):
    """A task merges a bounded number of entries; the order is the same."""
    pages = spark.range(600).selectExpr("id AS page_id", "'http://a.org/' || id % 7 AS url", "repeat('x', 50) || id AS html")
    write_archives(records(pages), str(tmp_path / "a"), 600)
    runs = read_runs(spark, str(tmp_path / "a")).cache()
    order = lambda df: [r.page_id for r in df.orderBy("range", "place").collect()]
    want = order(merged_history(runs))
    monkeypatch.setattr(warc_index, "RANGE_ENTRIES", 20)
    many = merged_history(runs)
    assert order(many) == want and many.select("range").distinct().count() > 20
