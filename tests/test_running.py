"""Totals cut into slices equal plain windows, and have one type at every size."""

import random
from decimal import Decimal

import duckdb
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywork.functions.running import groups_between, numbered, over_frames, peer_total, rank_up_to, running_last, running_total

D = Decimal


@pytest.fixture(scope="module")
def ledger(spark):
    """A tank with over a third of the rows, a third of which share one instant, and NULLs."""
    rng = random.Random(5)
    data = []
    for i in range(3000):
        tank = 1 if i % 5 < 2 else rng.randrange(2, 40)
        ts = 500 if tank == 1 and i % 3 == 0 else rng.randrange(1000)
        change = None if i % 50 == 0 else D(rng.randrange(-5000, 9000)) / 100
        data.append((None if i % 97 == 0 else tank, ts, i, change))
    return spark.createDataFrame(data, "tank int, ts int, id int, change decimal(12,2)").repartition(6).cache()


def plain(df, partition_by, order_by):
    w = Window.partitionBy(*partition_by).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("total", F.sum("change").over(w))


@pytest.mark.parametrize("slices", [1, 7, 60, None])
def test_by_group(ledger, slices):
    order = ["ts", "id"]
    got = running_total(ledger, "change", "total", partition_by=["tank"], order_by=order, slices=slices)
    assert got.columns == [*ledger.columns, "total"]
    assert rows(got) == rows(plain(ledger, ["tank"], order))


def test_whole_frame_descending(ledger):
    order = [F.col("ts").desc_nulls_last(), F.col("id").desc()]
    got = running_total(ledger, "change", "total", order_by=order, slices=30)
    assert rows(got) == rows(plain(ledger, [], order))


def test_slices_are_many_and_even(ledger):
    """The largest slice of the hot tank stays near the limit."""
    cut = ledger.repartitionByRange(30, "tank", "ts", "id").withColumn("s", F.spark_partition_id())
    largest = cut.groupBy("s").count().agg(F.max("count")).first()[0]
    assert largest < 400


@pytest.mark.parametrize("slices", [1, 43])
def test_numbered(ledger, slices):
    got = numbered(ledger, "n", order_by=[F.col("ts").desc(), "id"], start=10, slices=slices)
    ordered = sorted(ledger.collect(), key=lambda r: (-r.ts, r.id))
    assert {(r.id, r.n) for r in got.collect()} == {(r.id, 10 + i) for i, r in enumerate(ordered)}


@pytest.mark.parametrize("slices", [1, 6, 120])
def test_peers_share_a_total(ledger, slices):
    got = peer_total(ledger, "change", "total", order_by="ts", slices=slices)
    per_ts = {}
    for r in ledger.collect():
        per_ts[r.ts] = per_ts.get(r.ts, D(0)) + (r.change or 0)
    for r in got.collect():
        assert r.total == sum(v for ts, v in per_ts.items() if ts <= r.ts)


def test_peers_with_null_order(frame):
    df = frame([(1, 5), (None, 7), (1, 2), (2, 1)], "p int, q int")
    for slices in (1, 4):
        got = peer_total(df, "q", "total", order_by="p", slices=slices)
        assert rows(got) == rows(frame([(1, 5, 7), (1, 2, 7), (2, 1, 8), (None, 7, 15)], "p int, q int, t long"))


@pytest.mark.parametrize("agg", ["sum", "count", "min", "max"])
@pytest.mark.parametrize("frame_", [(-1, 0), (0, 1), (-2, -1), (-3, 2)])
def test_groups_frame(spark, agg, frame_):
    rng = random.Random(7)
    data = [(rng.choice("ab"), rng.choice([1, 2, 5, 6, 9, None]), rng.randrange(50)) for _ in range(60)]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (p VARCHAR, o INTEGER, v BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", data)
    side = lambda n: f"{abs(n)} {'PRECEDING' if n < 0 else 'FOLLOWING'}" if n else "CURRENT ROW"
    want = con.execute(
        f"""SELECT p, o, v, {agg}(v) OVER (PARTITION BY p ORDER BY o NULLS LAST
            GROUPS BETWEEN {side(frame_[0])} AND {side(frame_[1])}) FROM t"""
    ).fetchall()
    df = spark.createDataFrame(data, "p string, o int, v bigint")
    got = groups_between(
        df, "v", "r", order_by="o", lower=frame_[0], upper=frame_[1], partition_by=["p"], agg=agg
    )
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("rows_", [10, 100_000])
@pytest.mark.parametrize("kind, total", [("decimal(18,2)", "decimal(38,2)"), ("int", "bigint"), ("double", "double")])
def test_the_type_does_not_depend_on_size(spark, rows_, kind, total):
    df = spark.range(rows_).select("id", F.lit(1).cast(kind).alias("v"))
    for got in (running_total(df, "v", "t", order_by=["id"]), peer_total(df, "v", "t", order_by="id")):
        assert got.schema["t"].dataType.simpleString() == total
        assert got.agg(F.max("t")).first()[0] == rows_


@pytest.mark.parametrize("slices", [1, 7, 200, None])
def test_running_last(ledger, slices):
    """Carried over slices that hold no value of their own."""
    sparse = ledger.withColumn("change", F.when(F.col("id") % 37 == 0, F.col("change")))
    order = ["ts", "id"]
    got = running_last(sparse, "change", "total", partition_by=["tank"], order_by=order, slices=slices)
    assert got.columns == [*ledger.columns, "total"]
    w = Window.partitionBy("tank").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    assert rows(got) == rows(sparse.withColumn("total", F.last("change", ignorenulls=True).over(w)))


@pytest.mark.parametrize("n", [1, 40, 333, 5000])
def test_rank_up_to(ledger, n):
    """Ties are kept, nulls come last, whatever the slices; a third of a group ties."""
    tied = ledger.withColumn("v", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise((F.col("change") % 50).cast("int")))
    got = rank_up_to(tied, n, order_by="v", partition_by=["tank"], slices=9)
    w = Window.partitionBy("tank").orderBy(F.col("v").desc_nulls_last())
    assert rows(got) == rows(tied.withColumn("r", F.rank().over(w)).filter(F.col("r") <= n).drop("r"))


@pytest.mark.parametrize("block_rows", [1, 2, 5, 1000])
@pytest.mark.parametrize("frame_", [(-2, 1), (-1, 3), (0, 0), (-4, -2), (2, 4)])
def test_frames_in_blocks(ledger, block_rows, frame_):
    few = ledger.filter("id < 300")
    order = ["ts", "id"]
    lower, upper = frame_
    made = {"s": lambda w: F.sum("change").over(w.rowsBetween(lower, upper)), "n": lambda w: F.count(F.lit(1)).over(w.rowsBetween(lower, upper))}
    got = over_frames(few, made, order_by=order, partition_by=["tank"], lower=lower, upper=upper, block_rows=block_rows, slices=3)
    plain_window = Window.partitionBy("tank").orderBy(*order)
    assert rows(got) == rows(few.withColumns({name: make(plain_window) for name, make in made.items()}))


def test_frames_of_nothing(frame):
    none = frame([], "a int, v int")
    made = {"s": lambda w: F.sum("v").over(w.rowsBetween(-1, 1))}
    assert over_frames(none, made, order_by=["a"], lower=-1, upper=1).collect() == []
    assert running_last(none, "v", "l", order_by=["a"]).collect() == [] and rank_up_to(none, 5, order_by="v").collect() == []
