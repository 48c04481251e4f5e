"""Reports with checked arguments."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.operators import rental
from tallywork.plans.query import Query
from tallywork.sources.tables import Tables

# Roles: order lines are payments by part; a part's type is its category.


def _payments(t: Tables) -> dict:
    return {
        "payments": t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_extendedprice", "l_shipdate"),
        "path": [(t.part.select("p_partkey", "p_type"), "p_partkey")],
        "category": "p_type",
        "amount": "l_extendedprice",
        "paid_at": "l_shipdate",
    }


def current_quarter_revenue(t: Tables) -> DataFrame:
    return rental.current_quarter_revenue(**_payments(t), as_of=dt.date(1998, 5, 17))


def quarter_revenue(t: Tables) -> DataFrame:
    return rental.quarter_revenue(**_payments(t), year=2000, quarter=4, this_year=2001)


_QUARTER_REVENUE = """
SELECT p_type AS category_name, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total_revenue,
       quarter(l_shipdate)::BIGINT AS {prefix}_quarter, year(l_shipdate)::BIGINT AS {prefix}_year
FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE year(l_shipdate) = {year} AND quarter(l_shipdate) = {quarter}
GROUP BY p_type, quarter(l_shipdate), year(l_shipdate)
"""


def most_popular_by_group(t: Tables) -> DataFrame:
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), "n_name"
    )
    rentals = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    names = t.part.groupBy("p_name").agg(F.count(F.lit(1)).alias("parts"))
    return rental.most_popular_by_group(
        customers,
        rentals,
        t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name"),
        names,
        group="n_name",
        groups=[*(f"NATION_{i}" for i in range(25)), "ATLANTIS"],
        customer_key="o_custkey",
        copy_key="l_partkey",
        item_key="p_name",
    )


MOST_POPULAR_BY_GROUP = """
WITH counts AS (
  SELECT n_name, p_name, count(*) AS rental_count
  FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
  JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
  GROUP BY n_name, p_name
)
SELECT n_name, p_name, rental_count, (SELECT count(*) FROM part p WHERE p.p_name = a.p_name) AS parts
FROM counts a
WHERE rental_count = (SELECT max(rental_count) FROM counts b WHERE b.n_name = a.n_name)
"""


def search_history(t: Tables) -> DataFrame:
    names = F.split("c_name", "#")
    return rental.search_history(
        t.part.select("p_partkey", "p_name", "p_brand", (F.col("p_size") % F.lit(25)).alias("language_id")),
        t.lineitem.select(
            F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), "l_linenumber"
        ),
        t.orders.select("o_orderkey", "o_custkey", "o_orderdate"),
        t.customer.select(
            F.col("c_custkey").alias("o_custkey"), names[0].alias("first_name"), names[1].alias("last_name")
        ),
        pattern="%WIDGET%",
        title="p_name",
        item_key="p_partkey",
        copy_key="o_orderkey",
        customer_key="o_custkey",
        rented_at="o_orderdate",
        tie_break=["o_orderkey", "p_partkey", "l_linenumber"],
        # Roles: a nation is a language; a part has that of its size, counted round the 25 nations.
        languages=t.nation.select(F.col("n_nationkey").alias("language_id"), F.col("n_name").alias("language")),
    ).select(
        "row_num", "p_name", "p_brand", "language", "customer_name", "o_orderdate", "o_orderkey", "p_partkey", "l_linenumber"
    )


SEARCH_HISTORY = """
SELECT row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey, p_partkey, l_linenumber) AS row_num,
       p_name, p_brand, n_name AS language, replace(c_name, '#', ' ') AS customer_name,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderkey, p_partkey,
       l_linenumber::BIGINT AS l_linenumber
FROM part JOIN lineitem ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = p_size % 25
WHERE p_name ILIKE '%WIDGET%'
"""


def rewards(t: Tables) -> DataFrame:
    return rental.rewards(
        t.events.select(F.col("user_id").alias("c_custkey"), "value", "ts"),
        t.customer.select("c_custkey", "c_name", "c_mktsegment"),
        customer_key="c_custkey",
        amount="value",
        paid_at="ts",
        min_purchases=50,
        min_amount=Decimal("2500.00"),
    )


REWARDS = """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_custkey IN (
  SELECT user_id FROM events
  WHERE date_trunc('month', ts) = (SELECT date_trunc('month', max(ts)) FROM events)
  GROUP BY user_id HAVING sum(value::DECIMAL(18,2)) > 2500 AND count(*) > 50)
"""


def balance(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_partkey").alias("copy_id"),
        F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")).alias("return_date"),
    )
    rentals = lines.join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey")
    items = t.part.select(
        "p_partkey",
        (F.col("p_retailprice") - 890).alias("rental_rate"),
        F.col("p_size").alias("rental_duration"),
        F.col("p_retailprice").alias("replacement_cost"),
    )
    return rental.balance(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name"),
        rentals,
        t.part.select(F.col("p_partkey").alias("copy_id"), "p_partkey"),
        items,
        t.orders,
        customer_key="o_custkey",
        copy_key="copy_id",
        item_key="p_partkey",
        rented_at="o_orderdate",
        returned_at="return_date",
        amount="o_totalprice",
        paid_at="o_orderdate",
        as_of=dt.datetime(1999, 6, 30, 12),
    )


BALANCE = """
WITH held AS (
  SELECT o_custkey, p_retailprice::DECIMAL(18,2) AS cost, o_orderdate + to_days(p_size) AS due,
         o_orderdate + to_days(2 * p_size) AS long_due,
         CASE WHEN l_returnflag <> 'N' THEN l_shipdate ELSE TIMESTAMP '1999-06-30 12:00:00' END AS back
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
  WHERE o_orderdate <= TIMESTAMP '1999-06-30 12:00:00'
), fees AS (
  SELECT o_custkey, sum(cost - 890 + CASE
      WHEN back > long_due THEN cost + round((epoch(back) - epoch(due)) / 86400)::DECIMAL(18,2)
      WHEN back > due THEN round((epoch(back) - epoch(due)) / 86400)::DECIMAL(18,2)
      ELSE 0 END) AS fee
  FROM held GROUP BY o_custkey
), paid AS (
  SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2)) AS paid FROM orders
  WHERE o_orderdate <= TIMESTAMP '1999-06-30 12:00:00' GROUP BY o_custkey
)
SELECT c_custkey AS o_custkey, c_name, (coalesce(fee, 0) - coalesce(paid, 0))::DOUBLE AS balance
FROM customer LEFT JOIN fees f ON f.o_custkey = c_custkey LEFT JOIN paid p ON p.o_custkey = c_custkey
"""

# Roles: a (part, supplier) pair is a copy, an order line its rental; lines flagged N are still out.


def _copies_and_rentals(t: Tables) -> tuple[DataFrame, DataFrame]:
    rentals = t.lineitem.select(
        "l_partkey",
        "l_suppkey",
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")).alias("return_date"),
    )
    copies = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    return copies, rentals


_STATUS = {
    "copy_key": ["l_partkey", "l_suppkey"],
    "returned_at": "return_date",
    "order_by": ["l_shipdate", "l_orderkey", "l_linenumber"],
}


def available_items(t: Tables) -> DataFrame:
    return rental.available_items(*_copies_and_rentals(t), **_STATUS)


def unavailable_items(t: Tables) -> DataFrame:
    return rental.unavailable_items(*_copies_and_rentals(t), **_STATUS)


def unavailable_counts(t: Tables) -> DataFrame:
    return rental.stock_counts(unavailable_items(t), ["l_suppkey"])


_STOCK = """
WITH newest AS (
  SELECT l_partkey, l_suppkey, l_returnflag = 'N' AS is_out,
         row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC,
                            l_linenumber DESC, (l_returnflag = 'N') DESC) AS rn
  FROM lineitem
), stock AS (
  SELECT l_partkey, l_suppkey, coalesce(is_out, FALSE) AS is_out
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
  LEFT JOIN (SELECT l_partkey, l_suppkey, is_out FROM newest WHERE rn = 1) USING (l_partkey, l_suppkey)
)
"""


def held_by(t: Tables) -> DataFrame:
    rentals = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")).alias("return_date"),
    ).join(t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")), "o_orderkey")
    return rental.held_by(
        rentals, t.customer.select("c_custkey", "c_name"), customer_key="c_custkey", returned_at="return_date"
    ).drop("return_date")


HELD_BY = """
SELECT o_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, c_custkey, c_name
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
WHERE l_returnflag = 'N'
"""


def month_end(t: Tables) -> DataFrame:
    return rental.with_month_end(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate")


MONTH_END = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
       strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end
FROM orders
"""

QUERIES = {
    "f01_current_quarter_revenue": Query(
        current_quarter_revenue, _QUARTER_REVENUE.format(prefix="current", year=1998, quarter=2)
    ),
    "f02_quarter_revenue": Query(
        quarter_revenue, _QUARTER_REVENUE.format(prefix="result", year=2000, quarter=4)
    ),
    "f03_most_popular_by_group": Query(most_popular_by_group, MOST_POPULAR_BY_GROUP),
    "f04_search_history": Query(search_history, SEARCH_HISTORY),
    "f05_rewards": Query(rewards, REWARDS),
    "f06_balance": Query(balance, BALANCE),
    "f07_available_items": Query(
        available_items, _STOCK + "SELECT l_partkey, l_suppkey FROM stock WHERE NOT is_out"
    ),
    "f08_unavailable_items": Query(
        unavailable_items, _STOCK + "SELECT l_partkey, l_suppkey FROM stock WHERE is_out"
    ),
    "f08_unavailable_counts": Query(
        unavailable_counts,
        _STOCK + "SELECT l_suppkey, count(*) AS copies FROM stock WHERE is_out GROUP BY l_suppkey",
    ),
    "f09_held_by": Query(held_by, HELD_BY),
    "f10_month_end": Query(month_end, MONTH_END),
}
