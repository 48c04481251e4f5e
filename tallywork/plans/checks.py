"""Data-quality rules and row policies."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.operators import policy, quality
from tallywork.plans.query import Query
from tallywork.sources.tables import Tables

EARLIEST, LATEST = dt.date(1995, 6, 1), dt.date(2001, 6, 30)


def date_window(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderdate")
    return quality.violations(orders, quality.date_window("o_orderdate", EARLIEST, LATEST))


DATE_WINDOW = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders
WHERE (o_orderdate >= TIMESTAMP '1995-06-01' AND o_orderdate <= TIMESTAMP '2001-06-30') IS FALSE
"""


def log_lines(t: Tables) -> DataFrame:
    """Order lines as log rows: some name a sale, some a delivery, some both or none."""
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")).alias("sale_id"),
        F.when(F.col("l_linestatus") == "O", F.col("l_suppkey")).alias("delivery_id"),
    )


def exclusive_refs(t: Tables) -> DataFrame:
    return quality.violations(log_lines(t), quality.exactly_one("sale_id", "delivery_id"))


EXCLUSIVE_REFS = """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, sale_id, delivery_id
FROM (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS sale_id,
             CASE WHEN l_linestatus = 'O' THEN l_suppkey END AS delivery_id FROM lineitem)
WHERE ((sale_id IS NOT NULL AND delivery_id IS NULL) OR (sale_id IS NULL AND delivery_id IS NOT NULL)) IS FALSE
"""


def value_ranges(t: Tables) -> DataFrame:
    rule = quality.at_least("c_acctbal") & quality.above("c_custkey", -1)
    return quality.violations(t.customer.select("c_custkey", "c_acctbal"), rule)


VALUE_RANGES = """
SELECT c_custkey, c_acctbal::DECIMAL(18,2)::DOUBLE AS c_acctbal FROM customer
WHERE (c_acctbal >= 0 AND c_custkey > -1) IS FALSE
"""


def unique_key(t: Tables) -> DataFrame:
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


UNIQUE_KEY = """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS copies
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""


def open_accounts(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_acctbal") >= 0).select("c_custkey")


def foreign_key(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey")
    return quality.missing_parents(orders, "o_custkey", open_accounts(t), "c_custkey")


FOREIGN_KEY = """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)
"""


def described_parts(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.expr("nullif(p_name, 'hot bolt')").alias("p_name"), "p_type")


def required_and_length(t: Tables) -> DataFrame:
    return quality.labelled_violations(
        described_parts(t), {"required": quality.required("p_name"), "length": quality.max_length("p_name", 10)}
    )


REQUIRED_AND_LENGTH = """
WITH parts AS (SELECT p_partkey, nullif(p_name, 'hot bolt') AS p_name, p_type FROM part)
SELECT *, 'required' AS rule FROM parts WHERE p_name IS NULL
UNION ALL SELECT *, 'length' AS rule FROM parts WHERE length(p_name) > 10
"""

KNOWN_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "STANDARD")


def domain(t: Tables) -> DataFrame:
    return quality.violations(t.part.select("p_partkey", "p_type"), quality.in_domain("p_type", KNOWN_TYPES))


DOMAIN = """
SELECT p_partkey, p_type FROM part WHERE (p_type IN ('ECONOMY', 'LARGE', 'MEDIUM', 'STANDARD')) IS FALSE
"""


def not_self(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return quality.violations(lines, quality.differs("l_partkey", "l_suppkey"))


NOT_SELF = """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE (l_partkey <> l_suppkey) IS FALSE
"""


def summary(t: Tables) -> DataFrame:
    tables = {
        "orders": t.orders,
        "lineitem": t.lineitem,
        "log": log_lines(t),
        "customer": t.customer,
        "open_accounts": open_accounts(t),
        "part": described_parts(t),
    }
    rules = [
        quality.Check("date window", "orders", quality.date_window("o_orderdate", EARLIEST, LATEST)),
        quality.ForeignKey("customer is open", "orders", "o_custkey", "open_accounts", "c_custkey"),
        quality.Check("sale or delivery", "log", quality.exactly_one("sale_id", "delivery_id")),
        quality.Check("balance not negative", "customer", quality.at_least("c_acctbal")),
        quality.Check("name given", "part", quality.required("p_name")),
        quality.Check("name length", "part", quality.max_length("p_name", 10)),
        quality.Check("known type", "part", quality.in_domain("p_type", KNOWN_TYPES)),
        quality.Check("part is not supplier", "lineitem", quality.differs("l_partkey", "l_suppkey")),
        quality.Check("quantity above 0", "lineitem", quality.above("l_quantity")),
        quality.Unique("line key", "lineitem", ("l_orderkey", "l_linenumber")),
    ]
    return quality.summary(rules, tables)


SUMMARY = f"""
SELECT 'date window' AS rule, 'orders' AS table_name, count(*) AS violations FROM ({DATE_WINDOW})
UNION ALL SELECT 'customer is open', 'orders', count(*) FROM ({FOREIGN_KEY})
UNION ALL SELECT 'sale or delivery', 'log', count(*) FROM ({EXCLUSIVE_REFS})
UNION ALL SELECT 'balance not negative', 'customer', count(*) FROM ({VALUE_RANGES})
UNION ALL SELECT 'name given', 'part', count(*) FROM ({REQUIRED_AND_LENGTH}) WHERE rule = 'required'
UNION ALL SELECT 'name length', 'part', count(*) FROM ({REQUIRED_AND_LENGTH}) WHERE rule = 'length'
UNION ALL SELECT 'known type', 'part', count(*) FROM ({DOMAIN})
UNION ALL SELECT 'part is not supplier', 'lineitem', count(*) FROM ({NOT_SELF})
UNION ALL SELECT 'quantity above 0', 'lineitem', count(*) FROM lineitem WHERE (l_quantity > 0) IS FALSE
UNION ALL SELECT 'line key', 'lineitem', count(*) FROM ({UNIQUE_KEY})
"""

PRINCIPAL = "client_customer_000000007"


def _people(t: Tables) -> DataFrame:
    names = F.split("c_name", "#")
    return t.customer.select(
        F.col("c_custkey").alias("o_custkey"),
        "c_mktsegment",
        "c_nationkey",
        names[0].alias("first_name"),
        names[1].alias("last_name"),
    )


def _own_orders(t: Tables) -> DataFrame:
    allowed = policy.principal_keys(_people(t), PRINCIPAL, key="o_custkey")
    return policy.row_policy(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), allowed, "o_custkey")


ROW_POLICY = f"""
SELECT o_orderkey, o_custkey, o_totalprice::DECIMAL(18,2)::DOUBLE AS o_totalprice FROM orders
WHERE o_custkey = (SELECT c_custkey FROM customer
                   WHERE 'client_' || lower(replace(c_name, '#', '_')) = '{PRINCIPAL}')
"""


def policy_union(t: Tables) -> DataFrame:
    people = _people(t)
    policies = [
        policy.Policy(keys=policy.principal_keys(people, PRINCIPAL, key="o_custkey")),
        policy.Policy(keys=people.filter("c_mktsegment = 'MACHINERY'").select("o_custkey")),
        policy.Policy(predicate=F.col("o_orderpriority") == "1-URGENT"),
    ]
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return policy.policy_union(orders, policies, key="o_custkey")


POLICY_UNION = f"""
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
WHERE o_custkey = (SELECT c_custkey FROM customer
                   WHERE 'client_' || lower(replace(c_name, '#', '_')) = '{PRINCIPAL}')
   OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
   OR o_orderpriority = '1-URGENT'
"""


def policy_then_filter(t: Tables) -> DataFrame:
    # One customer of the two is visible: without the policy there would be rows of both.
    return _own_orders(t).filter(F.col("o_custkey").isin(7, 2))


QUERIES = {
    "q01_date_window": Query(date_window, DATE_WINDOW),
    "q02_exclusive_refs": Query(exclusive_refs, EXCLUSIVE_REFS),
    "q03_value_ranges": Query(value_ranges, VALUE_RANGES),
    "q04_unique_key": Query(unique_key, UNIQUE_KEY),
    "q05_foreign_key": Query(foreign_key, FOREIGN_KEY),
    "q06_required_and_length": Query(required_and_length, REQUIRED_AND_LENGTH),
    "q07_domain": Query(domain, DOMAIN),
    "q08_not_self": Query(not_self, NOT_SELF),
    "q09_summary": Query(summary, SUMMARY),
    "s01_row_policy": Query(_own_orders, ROW_POLICY),
    "s02_policy_union": Query(policy_union, POLICY_UNION),
    "s03_policy_then_filter": Query(policy_then_filter, ROW_POLICY + "AND o_custkey IN (7, 2)"),
}
