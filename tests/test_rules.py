"""Quality rules, declared tables and row policies."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallywork.operators import policy, quality
from tallywork.sources import schemas
from tallywork.sources.sinks import read_batches

D = Decimal


def test_checks_pass_on_null(frame):
    df = frame([(1, None, 5), (2, 3, None), (3, None, None), (4, 1, 2)], "k int, a int, b int")
    assert rows(quality.violations(df, quality.exactly_one("a", "b")), "k") == [(3,), (4,)]
    assert rows(quality.violations(df, quality.above("a", 2)), "k") == [(4,)]
    assert rows(quality.violations(df, quality.differs("a", "b")), "k") == []
    assert rows(quality.violations(df, quality.in_domain("a", [3])), "k") == [(4,)]
    assert rows(quality.violations(df, quality.required("a")), "k") == [(1,), (3,)]


def test_date_window_ends_now(frame):
    now = dt.datetime.now()
    df = frame([(1, dt.datetime(1999, 1, 1)), (2, dt.datetime(2020, 1, 1)), (3, now + dt.timedelta(days=2)), (4, None)],
               "k int, t timestamp")
    assert rows(quality.violations(df, quality.date_window("t", dt.date(2000, 1, 1))), "k") == [(1,), (3,)]


def test_keys(frame):
    df = frame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, s string")
    assert rows(quality.duplicate_keys(df, ["k", "s"])) == [(1, "a", 2)]
    assert rows(quality.missing_parents(df, "k", frame([(2,)], "id int"), "id")) == [(1, "a"), (1, "a"), (1, "b")]


def test_empty_tables_break_no_rule(spark):
    frames = {name: t.empty(spark) for name, t in schemas.FUEL_TABLES.items()}
    chosen = schemas.fuel_rules()
    assert len({r.name for r in chosen}) == len(chosen)
    # A plan over every rule at once is large; a sample of each kind is run.
    kinds = [[r for r in chosen if isinstance(r, k)][:4] for k in (quality.Check, quality.Unique, quality.ForeignKey)]
    got = quality.summary([r for kind in kinds for r in kind], frames).collect()
    assert len(got) == sum(map(len, kinds)) and all(r.violations == 0 for r in got)
    for r in chosen:
        assert quality.broken_rows(r, frames).columns  # every rule resolves against its table


def test_fuel_rules_find_what_is_wrong(spark, frame):
    frames = {name: t.empty(spark) for name, t in schemas.FUEL_TABLES.items()}
    log = schemas.FUEL_TABLES["inventory_logs"].conform(
        frame([(1, 1, 1, D(5), 7, 8, D(-1), dt.datetime(2026, 1, 2)), (2, None, 1, D(5), None, 8, D(1), None)],
              schemas.FUEL_TABLES["inventory_logs"].ddl)
    )
    frames["inventory_logs"] = log
    names = ("inventory_logs: sale or delivery", "inventory_logs: stock not negative", "inventory_logs: tank_id in tanks")
    chosen = [r for r in schemas.fuel_rules() if r.name in names]
    assert {(r["rule"], r["violations"]) for r in quality.summary(chosen, frames).collect()} == {(n, 1) for n in names}


@pytest.fixture
def people(frame):
    return frame([(1, "MARY", "SMITH"), (2, "Tom", "Reed")], "c int, first_name string, last_name string")


@pytest.fixture
def rentals(frame):
    return frame([(10, 1), (11, 2), (12, 1), (13, 3), (14, None)], "r int, c int")


def test_row_policy(people, rentals):
    own = policy.row_policy(rentals, policy.principal_keys(people, "client_mary_smith", key="c"), "c")
    assert rows(own, "r") == [(10,), (12,)]
    assert rows(own.filter("c = 2")) == []
    assert rows(policy.row_policy(rentals, policy.principal_keys(people, "client_no_one", key="c"), "c")) == []


def test_namesakes_see_nothing(frame, rentals):
    both = frame([(1, "Mary", "Smith"), (2, "MARY", "SMITH"), (3, "Tom", "Reed")], "c int, first_name string, last_name string")
    shared = policy.principal_keys(both, "client_mary_smith", key="c")
    assert rows(policy.row_policy(rentals, shared, "c")) == []
    assert rows(policy.policy_union(rentals, [policy.Policy(keys=shared)], key="c")) == []
    assert rows(policy.row_policy(rentals, policy.principal_keys(both, "client_tom_reed", key="c"), "c"), "r") == [(13,)]


def test_policies_add_up(people, rentals):
    mary = policy.Policy(keys=policy.principal_keys(people, "client_mary_smith", key="c"))
    open_rows = policy.Policy(predicate=F.col("r") > 12)
    assert rows(policy.policy_union(rentals, [mary, open_rows, mary], key="c"), "r") == [(10,), (12,), (13,), (14,)]
    assert rows(policy.policy_union(rentals, [open_rows], key="c"), "r") == [(13,), (14,)]
    assert rows(policy.policy_union(rentals, [], key="c")) == []


def test_summary_takes_one_scan_of_each_table(spark):
    """Row checks, a foreign key and a unique key of one table come from one pass."""
    orders = spark.createDataFrame([(1, 5, -1), (1, 5, 2), (2, 6, None), (None, 9, 3), (None, 9, 4), (3, None, 5)], "k int, c int, v int")
    people = spark.createDataFrame([(5,), (6,), (6,), (None,)], "c int")
    rules = [
        quality.Check("v above 0", "orders", quality.above("v")),
        quality.ForeignKey("c known", "orders", "c", "people", "c"),
        quality.Unique("k once", "orders", ("k",)),
        quality.Unique("v once", "orders", ("v",)),
        quality.Check("c given", "people", quality.required("c")),
    ]
    got = quality.summary(rules, {"orders": orders, "people": people})
    assert rows(got, "rule", "violations") == [("c given", 1), ("c known", 2), ("k once", 1), ("v above 0", 1), ("v once", 0)]
    none = quality.summary(rules, {"orders": orders.limit(0), "people": people.limit(0)})
    assert {r.violations for r in none.collect()} == {0} and none.count() == 5


def test_rules_are_counted_while_the_table_is_written(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "if(id % 10 = 0, NULL, id % 4) AS v")
    checks = [quality.Check("v above 0", "t", quality.above("v")), quality.Check("v given", "t", quality.required("v"))]
    path = str(tmp_path / "t")
    want = [("v above 0", "t", df.filter("v = 0").count()), ("v given", "t", 100)]
    for _ in range(2):
        assert rows(quality.write_checked(df, path, "one", "t", checks)) == want
    assert read_batches(spark, path, df.schema).count() == 1000
