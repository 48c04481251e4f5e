"""The streaming ledger equals the batch ledger; what comes too late is reported."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import rows

from tallywork.operators.ledger import running_stock
from tallywork.sources.sinks import read_batches
from tallywork.streaming.stock import running_stock_stream, write_stock

SCHEMA = "tank bigint, id bigint, at timestamp_ntz, change decimal(12,2)"
START = dt.datetime(2026, 1, 1)
OUT = "tank bigint, id bigint, at timestamp, change decimal(18,2), remaining_stock decimal(18,2)"


@pytest.fixture
def stream(spark, tmp_path):
    """Files of rows, read one after the other, through the stream; its two outputs."""

    def run(files, **how):
        source = str(tmp_path / "in")
        for rows_ in files:
            spark.createDataFrame(rows_, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        changes = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        after = running_stock_stream(changes, tank="tank", log_id="id", at="at", change="change", **how)
        ledger, late = str(tmp_path / "ledger"), str(tmp_path / "late")
        write_stock(after, ledger, late, str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
        return read_batches(spark, ledger, OUT), read_batches(spark, late, OUT)

    return run


def in_files(arrival, count):
    size = -(-len(arrival) // count)
    return [arrival[i : i + size] for i in range(0, len(arrival), size)]


def test_stream_equals_batch_when_rows_come_in_disorder(spark, stream):
    rng = random.Random(2)
    data = [
        (1 if i % 3 == 0 else rng.randrange(2, 6), i, START + dt.timedelta(seconds=i // 2), Decimal(rng.randrange(-500, 900)) / 100)
        for i in range(300)
    ]
    # Rows arrive up to 40 seconds late, in four files read one after the other.
    arrival = sorted(data, key=lambda r: r[2] + dt.timedelta(seconds=rng.randrange(40)))
    last = (99, 999, START + dt.timedelta(days=1), Decimal(0))
    ledger, late = stream([*in_files(arrival, 4), [last]], delay="60 seconds", stretch_seconds=20)
    want = running_stock(spark.createDataFrame(data, SCHEMA), tank=["tank"], change="change", order_by=["at", "id"])
    # The far later row only moves the watermark past all others.
    assert rows(ledger.filter("tank <> 99"), "id", "remaining_stock") == rows(want, "id", "remaining_stock")
    assert late.count() == 0


def test_late_changes_come_out_and_do_not_count(stream):
    at = lambda s: START + dt.timedelta(seconds=s)
    one = Decimal(1)
    files = [
        [(1, 1, at(5), one), (1, 2, at(15), one), (2, 3, at(5), one)],
        [(1, 4, at(500), one)],
        [(1, 5, at(501), one)],
        # The stretch of second 12 is over for tank 1; tank 2 still has nothing after second 5.
        [(1, 6, at(12), 50 * one), (1, 7, at(502), one)],
        [(2, 8, at(900), one)],
        [(99, 9, at(5000), one)],
    ]
    ledger, late = stream(files, delay="10 seconds", stretch_seconds=10)
    assert [(r.id, r.remaining_stock) for r in late.collect()] == [(6, None)]
    assert rows(ledger.filter("tank <> 99"), "id", "remaining_stock") == [
        (1, 1), (2, 2), (3, 1), (4, 3), (5, 4), (7, 5), (8, 2)
    ]


def test_a_hot_tank_is_held_in_stretches(stream):
    """Thousands of held changes of one tank come out in order, stretch by stretch."""
    rng = random.Random(7)
    data = [(1, i, START + dt.timedelta(milliseconds=200 * i), Decimal(1)) for i in range(4000)]
    arrival = sorted(data, key=lambda r: r[2] + dt.timedelta(seconds=rng.randrange(100)))
    ledger, late = stream([*in_files(arrival, 3), [(99, 9999, START + dt.timedelta(days=1), Decimal(0))]], delay="200 seconds")
    got = {r.id: r.remaining_stock for r in ledger.filter("tank = 1").collect()}
    assert got == {i: i + 1 for i in range(4000)} and late.count() == 0
