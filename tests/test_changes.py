"""Changes: what they add, keep and remove, and that running them twice adds nothing."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallywork.functions.keys import absent, among, sifted
from tallywork.operators import changes, ledger
from tallywork.sources import sinks

D = Decimal


def test_insert_if_absent_twice(frame):
    target = frame([(1, "A"), (2, "B"), (9, None)], "id int, t string")
    batch = frame([(3, "B"), (4, "C"), (5, None)], "id int, t string")
    once = changes.insert_if_absent(target, batch, ["t"])
    assert rows(once.rows, "id") == [(4,), (5,)]  # NULL equals nothing
    keyed = batch.dropna()
    again = changes.insert_if_absent(changes.insert_if_absent(target, keyed, ["t"]).table, keyed, ["t"])
    assert rows(again.rows) == [] and again.table.count() == 4


def test_insert_ignore_first_row_wins_and_reruns(frame):
    target = frame([("a", 1)], "k string, v int")
    batch = frame([("a", 2), ("b", 4), ("b", 3), ("b", 9), (None, 5), (None, 6)], "k string, v int")
    once = changes.insert_ignore(target, batch, ["k"], ["v"])
    assert rows(once.rows) == sorted([("b", 3), (None, 5), (None, 6)], key=repr)
    assert rows(changes.insert_ignore(once.table, batch.dropna(), ["k"], ["v"]).rows) == []


def test_absent_with_repeated_hot_key(spark, frame):
    target = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    batch = frame([(-1,), (1,), (3,), (7000,)], "k bigint")
    assert rows(absent(batch, target, ["k"])) == [(3,), (7000,)]


def test_resolve_keys_reports_and_rejects_ambiguous_names(frame):
    dim = frame([(1, "x"), (2, "y"), (3, "y")], "id int, name string")
    look = changes.Lookup(dim, "name", "id", "who", "who_id")
    got = changes.resolve_keys(frame([("x",), ("z",), (None,)], "who string"), [look])
    assert rows(got) == sorted([("x", 1, []), ("z", None, ["who_id"]), (None, None, [])], key=repr)
    with pytest.raises(PySparkException, match="not unique"):
        changes.resolve_keys(frame([("y",)], "who string"), [look]).collect()


def test_assign_ids(spark, frame):
    target, batch = frame([(7,), (3,)], "id bigint"), frame([("b",), ("a",), ("c",)], "n string")
    assert rows(changes.assign_ids(target, batch, "id", ["n"]), "n", "id") == [("a", 8), ("b", 9), ("c", 10)]
    assert rows(changes.assign_ids(target.limit(0), batch, "id", ["n"]), "id") == [(1,), (2,), (3,)]
    sparse = changes.assign_ids(target, spark.range(1000).repartition(5).select(F.col("id").alias("n")), "id")
    ids = [r.id for r in sparse.collect()]
    assert len(set(ids)) == 1000 and min(ids) > 7


def test_update_and_delete(frame):
    table = frame([(1, "a", D(1)), (2, None, D(2)), (None, "c", D(3))], "k int, s string, v decimal(10,2)")
    keys = frame([(1,), (1,), (None,)], "k int")
    up = changes.update_where(table, {"s": "new", "v": F.col("v") * 2}, keys=keys, on=["k"])
    assert rows(up.rows) == [(1, "new", D(2))]
    assert up.table.schema == table.schema and up.table.count() == 3
    unknown = changes.update_where(table, {"v": 0}, predicate=F.col("s") == "a")
    assert rows(unknown.rows, "k") == [(1,)]
    assert rows(changes.update_column(table, "v", "5", "k", 2).rows) == [(2, None, D(5))]
    gone = changes.delete_where(table, keys, ["k"])
    assert rows(gone.rows, "k") == [(1,)]
    assert rows(gone.table, "k") == sorted([(2,), (None,)], key=repr)


def test_defaults_and_audit_column_once(frame):
    df = changes.with_defaults(frame([(1, None), (2, "x")], "k int, s string"), {"s": "none"})
    stamped = changes.with_audit_column(df, F.lit(dt.datetime(2020, 1, 1)))
    assert rows(stamped, "s") == [("none",), ("x",)]
    assert changes.with_audit_column(stamped) is stamped


def test_match_pairs_equals_or_of_blocks(spark, frame):
    people = frame([(1, "AL", "PACINO"), (2, "EMMA", "STONE"), (3, "EMMA", "OTHER")], "a int, first string, last string")
    films = frame([(10, "GODFATHER"), (11, "LA LA LAND")], "f int, title string")
    pairs = frame([("GODFATHER", "AL", "PACINO"), ("LA LA LAND", "EMMA", "STONE"), ("LA LA LAND", "NO", "ONE")],
                  "title string, first string, last string")
    got = changes.match_pairs(people, films, pairs, entity_names=["first", "last"], title="title")
    assert rows(got, "a", "f") == [(1, 10), (2, 11)]


def test_price_and_generated_column(frame):
    sales = frame([(1, D("39.99")), (9, D("1.00"))], "p int, q decimal(12,2)")
    got = ledger.price_on_ingest(sales, frame([(1, D("2.51"))], "p int, u decimal(10,2)"), pricing_key="p", price="u", quantity="q")
    assert rows(got, "p", "total_amount") == [(1, D("100.37")), (9, None)]
    assert got.schema["total_amount"].dataType.simpleString() == "decimal(15,2)"


@pytest.mark.parametrize("slices", [1, 4])
def test_ledger_and_running_stock(frame, slices):
    deliveries = frame([(1, i, D(100), i) for i in range(6)], "tank int, id int, q decimal(12,2), at int")
    sales = frame([(1, i, D(i), i) for i in range(6)] + [(2, 9, D(4), 0)], "tank int, id int, q decimal(12,2), at int")
    log = ledger.ledger_from_sources(
        deliveries, sales, tank="tank", delivery_id="id", received="q", sale_id="id", sold="q", also=["at"]
    )
    assert log.filter(F.col("sale_id").isNull() == F.col("delivery_id").isNull()).count() == 0
    order = ["at", F.col("sale_id").isNotNull(), F.coalesce("sale_id", "delivery_id")]
    got = ledger.running_stock(log, tank=["tank"], change="change_amount", order_by=order, slices=slices)
    stock, want = {}, []
    for r in sorted(log.collect(), key=lambda r: (r.at, r.sale_id is not None)):
        stock[r.tank] = stock.get(r.tank, D(0)) + r.change_amount
        want.append((r.tank, r.at, r.change_amount, stock[r.tank]))
    assert rows(got, "tank", "at", "change_amount", "remaining_stock") == sorted(want, key=repr)


def test_partitioned_sink_and_replace(spark, frame, tmp_path):
    day = lambda m: dt.datetime(2020, m, 1)
    df = frame([(1, day(1)), (2, day(2)), (3, day(3)), (4, None)], "k int, at timestamp_ntz")
    path = str(tmp_path / "pay")
    sinks.write_partitioned(sinks.with_month_bucket(df, "at", ["2020-01", "2020-02"]), path)
    stored = spark.read.parquet(path)
    assert rows(stored, "k", "bucket") == [(1, "2020-01"), (2, "2020-02"), (3, "default"), (4, "default")]
    assert {p.name for p in (tmp_path / "pay").iterdir() if p.is_dir()} == {
        "bucket=2020-01", "bucket=2020-02", "bucket=default",
    }
    assert "PartitionFilters: [isnotnull(bucket" in (
        stored.filter("bucket = '2020-01'")._jdf.queryExecution().executedPlan().toString()
    )
    plain = str(tmp_path / "plain")
    sinks.append(df, plain)
    table = spark.read.parquet(plain)
    sinks.replace(changes.delete_where(table, frame([(1,)], "k int"), ["k"]).table, plain)
    assert rows(spark.read.parquet(plain), "k") == [(2,), (3,), (4,)]


def test_a_failed_replace_leaves_the_table(spark, frame, tmp_path):
    import pytest
    from pyspark.sql import functions as F

    path = str(tmp_path / "t")
    frame([(1,), (2,)], "k int").write.parquet(path)
    bad = spark.read.parquet(path).withColumn("k", F.raise_error("broken").cast("int"))
    with pytest.raises(Exception, match="broken"):
        sinks.replace(bad, path)
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]
    sinks.replace(spark.read.parquet(path).filter("k = 2"), path)
    assert rows(spark.read.parquet(path)) == [(2,)]
    assert not list(tmp_path.glob("t.old-*"))


def test_ids_without_order_are_fixed_once(spark, frame):
    batch = spark.range(100).repartition(7).select("id")
    got = changes.assign_ids(frame([(41,)], "k bigint"), batch, "k")
    first = rows(got)
    assert first == rows(got) and len({r[1] for r in first}) == 100 and min(r[1] for r in first) == 42


def test_a_batch_is_written_once(spark, frame, tmp_path):
    path = str(tmp_path / "table")
    assert sinks.read_batches(spark, path, "a int").collect() == []
    assert sinks.write_batch(frame([(1,), (2,)], "a int"), path, "one")
    assert not sinks.write_batch(frame([(1,), (2,)], "a int"), path, "one")
    assert sinks.write_batch(frame([(3,)], "a int"), path, 2)
    # What a lost driver left: rows without a commit record. They are not read, and replaced.
    frame([(7,), (8,)], "a int").write.parquet(f"{path}/batch=lost")
    (tmp_path / "table" / "batch=lost" / "_SUCCESS").unlink()
    assert rows(sinks.read_batches(spark, path, "a int")) == [(1,), (2,), (3,)]
    assert sinks.write_batch(frame([(9,)], "a int"), path, "lost")
    assert rows(sinks.read_batches(spark, path, "a int")) == [(1,), (2,), (3,), (9,)]
    with pytest.raises(ValueError, match="named by"):
        sinks.write_batch(frame([], "a int"), path, "../x")


def test_sifted_changes_equal_plain_ones(spark):
    target = spark.range(5000).selectExpr("if(id % 3 = 0, 7, if(id % 50 = 1, NULL, id)) AS k", "id AS v", "'x' AS s")
    batch = spark.range(4000, 9000, 7).selectExpr("cast(id as int) AS k", "id AS v", "'y' AS s").unionByName(target.limit(3))
    plain, sift = (changes.insert_if_absent(target, batch, ["k"], sift=x) for x in (False, True))
    assert rows(plain.table) == rows(sift.table) and rows(plain.rows) == rows(sift.rows)
    keys = batch.select("k")
    plain, sift = (changes.delete_where(target, keys, ["k"], sift=x) for x in (False, True))
    assert rows(plain.table) == rows(sift.table) and rows(plain.rows) == rows(sift.rows)
    plain, sift = (changes.update_where(target, {"s": "z"}, predicate=F.col("v") > 100, keys=keys, on=["k"], sift=x) for x in (False, True))
    assert rows(plain.table) == rows(sift.table) and rows(plain.rows) == rows(sift.rows)


def test_only_possible_matches_pass_the_filter(spark):
    target = spark.range(100_000).selectExpr("id AS k", "id % 7 AS j")
    wanted = spark.range(0, 100_000, 500).selectExpr("id AS k", "id % 7 AS j")
    possible, others = sifted(target, wanted.unionByName(wanted), ["k", "j"])
    found = possible.count()
    assert 200 <= found < 1000 and found + others.count() == 100_000
    assert among(others, wanted, ["k", "j"]).count() == 0 and among(possible, wanted, ["k", "j"]).count() == 200
    nothing = sifted(target, wanted.limit(0), ["k"])
    assert nothing[0].count() == 0 and nothing[1].count() == 100_000
