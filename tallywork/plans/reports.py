"""Catalogue, revenue, ranking and membership reports."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import instant, within
from tallywork.operators import catalog, membership, ranking, revenue
from tallywork.plans.query import Query
from tallywork.sources.tables import Tables

# Roles: orders are items, order lines the bridge to parts.
R01_YEARS = (dt.date(1997, 1, 1), dt.date(1999, 12, 31))


def order_lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), "l_linenumber"
    )


def filtered_catalog(t: Tables) -> DataFrame:
    items = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    return catalog.filtered_catalog(
        items,
        order_lines(t),
        t.part.select("p_partkey", "p_name", "p_type"),
        item_key="o_orderkey",
        category_key="p_partkey",
        name="p_type",
        category="PROMO",
        year="o_orderdate",
        years=(instant(R01_YEARS[0]), instant(R01_YEARS[1])),
        rate="o_totalprice",
        min_rate=Decimal("100000.00"),
    ).select(
        "o_orderkey",
        "l_linenumber",
        "p_name",
        F.col("p_type").alias("category_name"),
        "o_orderstatus",
        F.to_date("o_orderdate").alias("o_orderdate"),
        "o_totalprice",
    )


FILTERED_CATALOG = """
SELECT o_orderkey, l_linenumber::BIGINT AS l_linenumber, p_name, p_type AS category_name, o_orderstatus,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       o_totalprice::DECIMAL(18,2)::DOUBLE AS o_totalprice
FROM orders
JOIN lineitem ON l_orderkey = o_orderkey
JOIN part ON p_partkey = l_partkey
WHERE p_type = 'PROMO'
  AND o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-12-31'
  AND o_totalprice::DECIMAL(18,2) > 100000
"""


def revenue_by_location(t: Tables) -> DataFrame:
    return revenue.revenue_by_location(
        t.lineitem.withColumnRenamed("l_suppkey", "s_suppkey"),
        t.supplier.withColumnRenamed("s_nationkey", "n_nationkey"),
        t.nation.withColumnRenamed("n_regionkey", "r_regionkey"),
        t.region.select(
            "r_regionkey",
            F.col("r_name").alias("address"),
            F.when(F.col("r_name") != "ASIA", F.lower("r_name")).alias("address2"),
        ),
        staff_key="s_suppkey",
        store_key="n_nationkey",
        address_key="r_regionkey",
        amount="l_extendedprice",
        paid_at="l_shipdate",
        since=instant(dt.date(1997, 4, 1)),
    )


REVENUE_BY_LOCATION = """
WITH addr AS (
  SELECT r_regionkey, r_name AS address, CASE WHEN r_name <> 'ASIA' THEN lower(r_name) END AS address2 FROM region
)
SELECT n_nationkey::BIGINT AS n_nationkey, address || ' ' || coalesce(address2, '') AS full_address,
       sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total_amount
FROM lineitem
JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey
JOIN addr ON r_regionkey = n_regionkey
WHERE l_shipdate >= TIMESTAMP '1997-04-01'
GROUP BY n_nationkey, address, address2
"""


def topn_by_count(t: Tables) -> DataFrame:
    return catalog.top_by_count(
        t.supplier.select("s_suppkey", "s_name"),
        t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_orderkey").alias("o_orderkey")),
        t.orders,
        entity_key="s_suppkey",
        item_key="o_orderkey",
        after=("o_orderdate", instant(dt.date(1998, 12, 31))),
        out="number_of_orders",
    )


TOPN_BY_COUNT = """
SELECT s_suppkey, s_name, count(*) AS number_of_orders
FROM supplier JOIN lineitem ON l_suppkey = s_suppkey
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1998-12-31')
GROUP BY s_suppkey, s_name
ORDER BY number_of_orders DESC, s_suppkey
LIMIT 5
"""


def conditional_counts(t: Tables) -> DataFrame:
    return catalog.conditional_counts(
        t.orders.select("o_orderkey", F.year("o_orderdate").alias("order_year")),
        order_lines(t),
        t.part.select("p_partkey", "p_type"),
        item_key="o_orderkey",
        category_key="p_partkey",
        name="p_type",
        year="order_year",
        columns={"number_of_promo": "PROMO", "number_of_small": "SMALL", "number_of_standard": "STANDARD"},
    )


CONDITIONAL_COUNTS = """
SELECT year(o_orderdate)::BIGINT AS order_year,
       count(*) FILTER (WHERE p_type = 'PROMO') AS number_of_promo,
       count(*) FILTER (WHERE p_type = 'SMALL') AS number_of_small,
       count(*) FILTER (WHERE p_type = 'STANDARD') AS number_of_standard
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
WHERE p_type IN ('PROMO', 'SMALL', 'STANDARD')
GROUP BY 1
"""


def topn_with_last_location(t: Tables) -> DataFrame:
    rentals = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_suppkey").alias("s_suppkey")
    )
    payments = t.orders.select(
        "o_orderkey", F.col("o_orderkey").alias("payment_id"), "o_custkey", "o_totalprice", "o_orderdate"
    )
    return revenue.top_with_last_location(
        payments,
        rentals,
        t.supplier.select("s_suppkey", "s_nationkey"),
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name"),
        staff_key="o_custkey",
        payment_key="payment_id",
        rental_key="o_orderkey",
        copy_key="s_suppkey",
        store_key="s_nationkey",
        amount="o_totalprice",
        paid_at="o_orderdate",
        start=instant(dt.date(1997, 1, 1)),
        end=instant(dt.date(1998, 1, 1)),
    )


TOPN_WITH_LAST_LOCATION = """
WITH revenue AS (
  SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2)) AS total_revenue FROM orders
  WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY o_custkey
), last_payment AS (
  SELECT o_custkey, max(o_orderkey) AS last_id FROM orders
  WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY o_custkey
), rental AS (
  SELECT l_orderkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY l_orderkey
)
SELECT o_custkey, c_name, s_nationkey::BIGINT AS last_assigned_store, total_revenue::DOUBLE AS total_revenue
FROM revenue
JOIN last_payment USING (o_custkey)
JOIN rental ON l_orderkey = last_id
JOIN supplier ON s_suppkey = l_suppkey
JOIN customer ON c_custkey = o_custkey
ORDER BY revenue.total_revenue DESC, o_custkey
LIMIT 3
"""


def latest_row(t: Tables) -> DataFrame:
    return revenue.latest_row(
        t.orders, ["o_custkey"], ["o_orderkey"], before=("o_orderdate", instant(dt.date(1998, 1, 1)))
    ).select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice")


LATEST_ROW = """
SELECT p1.o_custkey, p1.o_orderkey, strftime(p1.o_orderdate, '%Y-%m-%d') AS o_orderdate,
       p1.o_totalprice::DECIMAL(18,2)::DOUBLE AS o_totalprice
FROM orders p1
LEFT JOIN orders p2 ON p1.o_custkey = p2.o_custkey AND p1.o_orderkey < p2.o_orderkey
  AND p2.o_orderdate < TIMESTAMP '1998-01-01'
WHERE p2.o_orderkey IS NULL AND p1.o_orderdate < TIMESTAMP '1998-01-01'
"""


def popular_with_band(t: Tables) -> DataFrame:
    return catalog.popular_with_band(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"),
        t.orders,
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")),
        item_key="o_custkey",
        copy_key="o_orderkey",
        rating="c_mktsegment",
        bands={"AUTOMOBILE": "Drivers", "BUILDING": "Trades", "FURNITURE": "Homes", "MACHINERY": "Plants"},
        band="audience",
        count="line_count",
    )


POPULAR_WITH_BAND = """
SELECT o_custkey, c_name, c_mktsegment, count(*) AS line_count,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Drivers' WHEN 'BUILDING' THEN 'Trades'
            WHEN 'FURNITURE' THEN 'Homes' WHEN 'MACHINERY' THEN 'Plants' ELSE 'Unrated' END AS audience
FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY o_custkey, c_name, c_mktsegment
ORDER BY line_count DESC, o_custkey
LIMIT 5
"""


def inactivity(t: Tables) -> DataFrame:
    return catalog.inactivity(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name"),
        t.orders.select("o_custkey", "o_orderkey"),
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.year("l_shipdate").alias("ship_year")),
        entity_key="o_custkey",
        item_key="o_orderkey",
        year="ship_year",
        as_of_year=2003,
        latest="latest_ship_year",
    )


INACTIVITY = """
SELECT o_custkey, c_name, max(year(l_shipdate))::BIGINT AS latest_ship_year,
       (2003 - max(year(l_shipdate)))::BIGINT AS years_of_inactivity
FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY o_custkey, c_name
"""


def topn_per_group_ties(t: Tables) -> DataFrame:
    best = ranking.top_n_per_group_with_share(
        t.orders, group="o_orderpriority", member="o_custkey", amount="o_totalprice"
    )
    names = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return best.join(names, "o_custkey").orderBy(
        "o_orderpriority", F.col("total_sales").desc(), "o_custkey"
    )


TOPN_PER_GROUP_TIES = """
WITH sums AS (
  SELECT o_custkey, o_orderpriority, sum(o_totalprice::DECIMAL(18,2)) AS total_sales
  FROM orders GROUP BY o_custkey, o_orderpriority
), whole AS (
  SELECT o_orderpriority, sum(total_sales) AS grand_total FROM sums GROUP BY o_orderpriority
)
SELECT a.o_custkey, c_name, a.o_orderpriority, a.total_sales::DOUBLE AS total_sales,
       round(100 * a.total_sales::DOUBLE / grand_total::DOUBLE, 4) AS sales_percentage
FROM sums a
JOIN customer ON c_custkey = a.o_custkey
JOIN whole b ON b.o_orderpriority = a.o_orderpriority
WHERE (SELECT count(*) FROM sums c
       WHERE c.o_orderpriority = a.o_orderpriority AND c.total_sales > a.total_sales) < 5
"""


def sales_with_region(t: Tables, orders: DataFrame, regions: list[str] | None = None) -> DataFrame:
    """Orders with the region of their customer. Regions are cut before customers."""
    wanted = t.region if regions is None else t.region.filter(F.col("r_name").isin(regions))
    people = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(wanted, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("o_custkey"), "r_name")
    )
    return orders.join(people, "o_custkey")


def part_sales(t: Tables, start: dt.date, end: dt.date, regions: list[str], part: DataFrame) -> DataFrame:
    """Order lines of a period and some regions with attributes of their part."""
    orders = t.orders.filter(within("o_orderdate", start, end)).select("o_orderkey", "o_custkey", "o_orderdate")
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), "l_extendedprice"
    )
    return lines.join(sales_with_region(t, orders, regions), "o_orderkey").join(part, "p_partkey")


def quarter_crosstab(t: Tables) -> DataFrame:
    sales = part_sales(
        t,
        dt.date(1998, 1, 1),
        dt.date(1999, 1, 1),
        ["ASIA"],
        t.part.filter(F.col("p_type") == "PROMO").select("p_partkey", "p_name"),
    )
    return revenue.quarter_crosstab(
        sales, row="p_name", quarter=F.quarter("o_orderdate"), amount="l_extendedprice"
    )


QUARTER_CROSSTAB = """
WITH cells AS (
  SELECT p_name, quarter(o_orderdate) AS q, sum(l_extendedprice::DECIMAL(18,2)) AS amount
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN part ON p_partkey = l_partkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
  WHERE p_type = 'PROMO' AND r_name = 'ASIA'
    AND o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
  GROUP BY 1, 2
)
SELECT p_name,
       coalesce(sum(amount) FILTER (WHERE q = 1), 0)::DOUBLE AS q1,
       coalesce(sum(amount) FILTER (WHERE q = 2), 0)::DOUBLE AS q2,
       coalesce(sum(amount) FILTER (WHERE q = 3), 0)::DOUBLE AS q3,
       coalesce(sum(amount) FILTER (WHERE q = 4), 0)::DOUBLE AS q4,
       sum(amount)::DOUBLE AS year_sum
FROM cells GROUP BY p_name
"""


def consistent_top_n(t: Tables) -> DataFrame:
    years = (1996, 1997, 1999)
    # The year list also bounds the dates, which reaches the scan.
    orders = t.orders.filter(within("o_orderdate", dt.date(1996, 1, 1), dt.date(2000, 1, 1)))
    best = ranking.consistent_top_n(
        orders.withColumn("order_year", F.year("o_orderdate")),
        period="order_year",
        group="o_orderpriority",
        member="o_custkey",
        amount="o_totalprice",
        periods=years,
    )
    names = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return best.join(names, "o_custkey").orderBy(
        F.col("amount_sold").desc(), "o_orderpriority", "o_custkey"
    )


CONSISTENT_TOP_N = """
SELECT o_custkey, o_orderpriority, sum(total)::DOUBLE AS amount_sold, c_name
FROM (
  SELECT o_custkey, o_orderpriority, year(o_orderdate) AS y, sum(o_totalprice::DECIMAL(18,2)) AS total,
         rank() OVER (PARTITION BY year(o_orderdate), o_orderpriority
                      ORDER BY sum(o_totalprice::DECIMAL(18,2)) DESC) AS r
  FROM orders WHERE year(o_orderdate) IN (1996, 1997, 1999)
  GROUP BY o_custkey, o_orderpriority, year(o_orderdate)
) JOIN customer ON c_custkey = o_custkey
WHERE r <= 300
GROUP BY o_custkey, o_orderpriority, c_name
HAVING count(DISTINCT y) = 3
"""


# More than Spark trims before a shuffle; orders are the members, so there are more of them.
LARGE_N = 5000


def topn_large(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_returnflag", "l_orderkey", "l_extendedprice")
    return ranking.top_n_per_group_with_share(
        lines, group="l_returnflag", member="l_orderkey", amount="l_extendedprice", n=LARGE_N
    )


TOPN_LARGE = f"""
WITH sums AS (
  SELECT l_returnflag, l_orderkey, sum(l_extendedprice::DECIMAL(18,2)) AS total_sales
  FROM lineitem GROUP BY l_returnflag, l_orderkey
)
SELECT l_returnflag, l_orderkey, total_sales::DOUBLE AS total_sales,
       round(100 * total_sales::DOUBLE / grand_total::DOUBLE, 4) AS sales_percentage
FROM (SELECT *, rank() OVER (PARTITION BY l_returnflag ORDER BY total_sales DESC) AS r,
             sum(total_sales) OVER (PARTITION BY l_returnflag) AS grand_total FROM sums)
WHERE r <= {LARGE_N}
"""

CONSISTENT_LARGE_N = 1500


def consistent_large(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.year("l_shipdate").alias("y"), "l_returnflag", "l_partkey", "l_extendedprice")
    return ranking.consistent_top_n(
        lines, period="y", group="l_returnflag", member="l_partkey", amount="l_extendedprice",
        periods=[1996, 1997, 1999], n=CONSISTENT_LARGE_N,
    )


CONSISTENT_LARGE = f"""
SELECT l_returnflag, l_partkey, sum(total)::DOUBLE AS amount_sold
FROM (
  SELECT l_returnflag, l_partkey, year(l_shipdate) AS y, sum(l_extendedprice::DECIMAL(18,2)) AS total,
         rank() OVER (PARTITION BY year(l_shipdate), l_returnflag ORDER BY sum(l_extendedprice::DECIMAL(18,2)) DESC) AS r
  FROM lineitem WHERE year(l_shipdate) IN (1996, 1997, 1999)
  GROUP BY l_returnflag, l_partkey, year(l_shipdate)
)
WHERE r <= {CONSISTENT_LARGE_N}
GROUP BY l_returnflag, l_partkey
HAVING count(*) = 3
"""


def conditional_sums(t: Tables) -> DataFrame:
    sales = part_sales(
        t,
        dt.date(1998, 1, 1),
        dt.date(1998, 4, 1),
        ["AMERICA", "EUROPE"],
        t.part.select("p_partkey", "p_type"),
    ).withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM"))
    return revenue.conditional_sums(
        sales,
        keys=["order_month", "p_type"],
        on="r_name",
        amount="l_extendedprice",
        columns={"america_sales": "AMERICA", "europe_sales": "EUROPE"},
    )


CONDITIONAL_SUMS = """
SELECT strftime(o_orderdate, '%Y-%m') AS order_month, p_type,
       round(sum(CASE WHEN r_name = 'AMERICA' THEN l_extendedprice::DECIMAL(18,2) ELSE 0 END), 0)::DOUBLE AS america_sales,
       round(sum(CASE WHEN r_name = 'EUROPE' THEN l_extendedprice::DECIMAL(18,2) ELSE 0 END), 0)::DOUBLE AS europe_sales
FROM lineitem
JOIN orders ON o_orderkey = l_orderkey
JOIN part ON p_partkey = l_partkey
JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey
WHERE r_name IN ('AMERICA', 'EUROPE')
  AND o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-04-01'
GROUP BY 1, 2
"""


def latest_quarter_summary(t: Tables) -> DataFrame:
    pricing = t.part.select(
        F.col("p_partkey").alias("l_partkey"),
        F.expr("(p_size - 1) div 2").cast("int").alias("n_nationkey"),
        F.col("p_type").alias("fuel_key"),
    )
    return revenue.latest_quarter_summary(
        t.lineitem,
        pricing,
        t.nation.select("n_nationkey", F.col("n_name").alias("station")),
        t.part.select(F.col("p_type").alias("fuel_key"), F.lower("p_type").alias("fuel_type")).distinct(),
        pricing_key="l_partkey",
        station_key="n_nationkey",
        fuel_key="fuel_key",
        station="station",
        fuel="fuel_type",
        quantity="l_quantity",
        amount="l_extendedprice",
        sold_at="l_shipdate",
    )


LATEST_QUARTER_SUMMARY = """
WITH newest AS (SELECT date_trunc('quarter', max(l_shipdate)) AS q FROM lineitem)
SELECT n_name AS station, lower(p_type) AS fuel_type, count(*) AS total_transactions,
       sum(l_quantity::DECIMAL(18,2))::DOUBLE AS volume_sold,
       sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS gross_revenue,
       ((2 * sum(round(l_extendedprice * 100)::HUGEINT) + count(*)) // (2 * count(*)))::DOUBLE / 100
         AS average_transaction_value,
       year(any_value(q)) || ' Q' || quarter(any_value(q)) AS period
FROM lineitem
JOIN part ON p_partkey = l_partkey
JOIN nation ON n_nationkey = (p_size - 1) // 2
CROSS JOIN newest
WHERE date_trunc('quarter', l_shipdate) = q
GROUP BY n_name, p_type
"""


def _named_lines(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_returnflag", F.col("l_partkey").alias("p_partkey")).join(
        t.part.select("p_partkey", F.expr("nullif(p_name, 'small widget')").alias("p_name")), "p_partkey"
    )


def string_list_agg(t: Tables) -> DataFrame:
    return catalog.joined_text(_named_lines(t), ["l_orderkey"], "p_name", "part_names")


def string_list_parts(t: Tables) -> DataFrame:
    return catalog.joined_text_parts(_named_lines(t), ["l_returnflag"], "p_name", "part_names", part_rows=500)


STRING_LIST_PARTS = """
SELECT l_returnflag, part, string_agg(name, ', ' ORDER BY name) AS part_names
FROM (SELECT l_returnflag, name, (row_number() OVER (PARTITION BY l_returnflag ORDER BY name) - 1) // 500 AS part
      FROM (SELECT l_returnflag, nullif(p_name, 'small widget') AS name FROM lineitem JOIN part ON p_partkey = l_partkey)
      WHERE name IS NOT NULL)
GROUP BY l_returnflag, part
"""

STRING_LIST_AGG = """
SELECT l_orderkey, string_agg(name, ', ' ORDER BY name) AS part_names
FROM (SELECT l_orderkey, nullif(p_name, 'small widget') AS name FROM lineitem JOIN part ON p_partkey = l_partkey)
GROUP BY l_orderkey
"""


def _orders_and_events(t: Tables) -> tuple[DataFrame, DataFrame]:
    return (
        t.orders.select(F.col("o_custkey").alias("c_custkey")),
        t.events.select(F.col("user_id").alias("c_custkey")),
    )


ACTIVE_IN_BOTH = """
SELECT c_custkey, left_rows, right_rows
FROM (SELECT o_custkey AS c_custkey, count(*) AS left_rows FROM orders GROUP BY 1 HAVING count(*) > 9)
JOIN (SELECT user_id AS c_custkey, count(*) AS right_rows FROM events GROUP BY 1 HAVING count(*) > 43)
  USING (c_custkey)
"""


def exists_in_both(t: Tables) -> DataFrame:
    orders, events = _orders_and_events(t)
    return membership.exists_in_both(t.customer.select("c_custkey", "c_name"), orders, events, key="c_custkey")


EXISTS_IN_BOTH = """
SELECT c_custkey, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
  AND EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)
"""


def _active(n: int | None):
    def build(t: Tables) -> DataFrame:
        orders, events = _orders_and_events(t)
        return membership.active_in_both(orders, events, key="c_custkey", more_than=(9, 43), n=n)

    return build


QUERIES = {
    "r01_filtered_catalog": Query(filtered_catalog, FILTERED_CATALOG),
    "r02_revenue_by_location": Query(revenue_by_location, REVENUE_BY_LOCATION),
    "r03_topn_by_count": Query(topn_by_count, TOPN_BY_COUNT),
    "r04_conditional_counts": Query(conditional_counts, CONDITIONAL_COUNTS),
    "r05_topn_with_last_location": Query(topn_with_last_location, TOPN_WITH_LAST_LOCATION),
    "r06_latest_row_antiself": Query(latest_row, LATEST_ROW),
    "r07_popular_with_band": Query(popular_with_band, POPULAR_WITH_BAND),
    "r08_inactivity": Query(inactivity, INACTIVITY),
    "r16_topn_per_group_ties": Query(topn_per_group_ties, TOPN_PER_GROUP_TIES),
    "r17_quarter_crosstab": Query(quarter_crosstab, QUARTER_CROSSTAB),
    "r16_topn_large": Query(topn_large, TOPN_LARGE),
    "r18_consistent_top_n": Query(consistent_top_n, CONSISTENT_TOP_N),
    "r18_consistent_large": Query(consistent_large, CONSISTENT_LARGE),
    "r19_conditional_sums": Query(conditional_sums, CONDITIONAL_SUMS),
    "r20_latest_quarter_summary": Query(latest_quarter_summary, LATEST_QUARTER_SUMMARY),
    "r21_string_list_agg": Query(string_list_agg, STRING_LIST_AGG),
    "r21_string_list_parts": Query(string_list_parts, STRING_LIST_PARTS),
    "r22_active_in_both": Query(_active(None), ACTIVE_IN_BOTH),
    "r22_largest_active_key": Query(_active(1), ACTIVE_IN_BOTH + "ORDER BY c_custkey DESC LIMIT 1"),
    "r23_exists_in_both": Query(exists_in_both, EXISTS_IN_BOTH),
}
