"""Reports over time and frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import instant, within
from tallywork.operators import trends
from tallywork.plans.query import Query
from tallywork.plans.reports import sales_with_region
from tallywork.sources.tables import Tables


def next_gap(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"))
    orders = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year"))
    events = lines.join(orders, "o_orderkey").join(t.part.select("p_partkey", "p_name"), "p_partkey")
    # Every line has a part, so the orders that have lines know the years without the parts.
    years = orders.join(lines, "o_orderkey", "left_semi")
    return trends.next_gap(
        events, entity="o_custkey", item="p_name", year="order_year", next_year="next_order_year", years=years
    )


NEXT_GAP = """
WITH listed AS (
  SELECT DISTINCT o_custkey, p_name, year(o_orderdate) AS y
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
)
SELECT a.o_custkey, a.p_name, a.y::BIGINT AS order_year, min(b.y)::BIGINT AS next_order_year,
       (min(b.y) - a.y)::BIGINT AS gap_size
FROM listed a JOIN listed b ON a.o_custkey = b.o_custkey AND b.y > a.y
GROUP BY a.o_custkey, a.p_name, a.y
"""


def share_and_prior(t: Tables) -> DataFrame:
    orders = t.orders.filter(within("o_orderdate", dt.date(1996, 1, 1), dt.date(2000, 1, 1)))
    sales = sales_with_region(t, orders, ["AMERICA", "ASIA", "EUROPE"])
    return trends.share_and_prior(
        sales.withColumn("order_year", F.year("o_orderdate")),
        year="order_year",
        region="r_name",
        channel="o_orderpriority",
        amount="o_totalprice",
        first_year=1997,
    )


SHARE_AND_PRIOR = """
WITH sums AS (
  SELECT r_name, year(o_orderdate) AS y, o_orderpriority, sum(o_totalprice::DECIMAL(18,2)) AS amount
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
  WHERE r_name IN ('AMERICA', 'ASIA', 'EUROPE') AND year(o_orderdate) IN (1996, 1997, 1998, 1999)
  GROUP BY ALL
), shares AS (
  SELECT *, 100 * amount::DOUBLE / (sum(amount) OVER (PARTITION BY y, r_name))::DOUBLE AS pct FROM sums
), compared AS (
  SELECT *, round(pct, 2)::DECIMAL(9,2) AS now_pct,
         round(lag(pct) OVER (PARTITION BY r_name, o_orderpriority ORDER BY y), 2)::DECIMAL(9,2) AS prior_pct
  FROM shares
)
SELECT r_name, y::BIGINT AS order_year, o_orderpriority, amount::DOUBLE AS amount_sold,
       now_pct::DOUBLE AS by_channels, prior_pct::DOUBLE AS previous_period,
       (now_pct - prior_pct)::DOUBLE AS delta
FROM compared WHERE y >= 1997
"""


def share_and_prior_text(t: Tables) -> DataFrame:
    return trends.share_report_text(share_and_prior(t))


SHARE_AND_PRIOR_TEXT = f"""
SELECT r_name, order_year, o_orderpriority,
       lpad(format('{{:,}}', (floor(amount_sold + 0.5))::BIGINT), 14, ' ') || '$' AS amount_sold,
       by_channels::DECIMAL(9,2)::VARCHAR || '%' AS by_channels,
       previous_period::DECIMAL(9,2)::VARCHAR || '%' AS previous_period, delta::DECIMAL(9,2)::VARCHAR || '%' AS delta
FROM ({SHARE_AND_PRIOR})
"""


def daily_orders(t: Tables, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    orders = t.orders if start is None else t.orders.filter(within("o_orderdate", start, end))
    daily = trends.daily_totals(orders, day="o_orderdate", amount="o_totalprice")
    return daily.select(
        F.col("o_orderdate").alias("day"),
        trends.iso_year("o_orderdate").alias("order_year"),
        F.weekofyear("o_orderdate").alias("week"),
        F.date_format("o_orderdate", "EEEE").alias("day_name"),
        "sales",
    )


_DAILY = """
WITH daily AS (
  SELECT o_orderdate::DATE AS day, isoyear(o_orderdate) AS order_year, week(o_orderdate) AS week,
         dayname(o_orderdate) AS day_name, sum(o_totalprice::DECIMAL(18,2)) AS sales,
         sum(round(o_totalprice * 100)::HUGEINT) AS cents
  FROM orders{where} GROUP BY ALL
)
"""


def cumulative_in_week(t: Tables) -> DataFrame:
    return trends.cumulative_in_period(
        daily_orders(t), period=["order_year", "week"], day="day", amount="sales"
    )


CUMULATIVE_IN_WEEK = _DAILY.format(where="") + """
SELECT strftime(day, '%Y-%m-%d') AS day, order_year::BIGINT AS order_year, week::BIGINT AS week, day_name,
       sales::DOUBLE AS sales,
       (sum(sales) OVER (PARTITION BY order_year, week ORDER BY day
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE AS cum_sum
FROM daily
"""


def centered_average(t: Tables) -> DataFrame:
    # A week on either side warms the frames up.
    daily = daily_orders(t, dt.date(1995, 12, 25), dt.date(2001, 1, 8))
    return trends.centered_average(
        daily,
        day="day",
        weekday=F.col("day_name"),
        amount="sales",
        keep=within("day", dt.date(1996, 1, 1), dt.date(2001, 1, 1)),
    )


_ROUNDED_AVERAGE = """((2 * sum(cents) OVER (ORDER BY day ROWS BETWEEN {f})
         + count(*) OVER (ORDER BY day ROWS BETWEEN {f}))
        // (2 * count(*) OVER (ORDER BY day ROWS BETWEEN {f})))::DOUBLE / 100"""

CENTERED_AVERAGE = (
    _DAILY.format(
        where=" WHERE o_orderdate >= TIMESTAMP '1995-12-25' AND o_orderdate < TIMESTAMP '2001-01-08'"
    )
    + f""", framed AS (
  SELECT *, CASE day_name
    WHEN 'Monday' THEN {_ROUNDED_AVERAGE.format(f='2 PRECEDING AND 1 FOLLOWING')}
    WHEN 'Friday' THEN {_ROUNDED_AVERAGE.format(f='1 PRECEDING AND 2 FOLLOWING')}
    ELSE {_ROUNDED_AVERAGE.format(f='1 PRECEDING AND 1 FOLLOWING')} END AS centered_avg
  FROM daily
)
SELECT strftime(day, '%Y-%m-%d') AS day, order_year::BIGINT AS order_year, week::BIGINT AS week, day_name,
       sales::DOUBLE AS sales, centered_avg
FROM framed WHERE day >= DATE '1996-01-01' AND day < DATE '2001-01-01'
"""
)


def rolling_rows_average(t: Tables) -> DataFrame:
    daily = daily_orders(t, dt.date(1995, 12, 1), dt.date(2001, 1, 1)).select("day", "sales")
    return trends.rolling_rows_average(
        daily, day="day", amount="sales", keep=F.col("day") >= instant(dt.date(1996, 1, 1))
    )


ROLLING_ROWS_AVERAGE = (
    _DAILY.format(
        where=" WHERE o_orderdate >= TIMESTAMP '1995-12-01' AND o_orderdate < TIMESTAMP '2001-01-01'"
    )
    + """, framed AS (
  SELECT day, sales, sum(cents) OVER w AS s, count(*) OVER w AS n
  FROM daily WINDOW w AS (ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
)
SELECT strftime(day, '%Y-%m-%d') AS day, sales::DOUBLE AS sales,
       ((2 * s * 10000 + n) // (2 * n))::DOUBLE / 1000000 AS rolling_3day_avg
FROM framed WHERE day >= DATE '1996-01-01'
"""
)


def range_running_total(t: Tables) -> DataFrame:
    sales = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return trends.range_running_total(sales, price="l_extendedprice", quantity="l_quantity")


RANGE_RUNNING_TOTAL = """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
       l_extendedprice::DECIMAL(18,2)::DOUBLE AS l_extendedprice, l_quantity::DECIMAL(18,2)::DOUBLE AS l_quantity,
       (sum(l_quantity::DECIMAL(18,2)) OVER (ORDER BY l_extendedprice::DECIMAL(18,2)
          RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE AS cumulative_qty_by_price
FROM lineitem
"""


def groups_frame(t: Tables) -> DataFrame:
    return trends.groups_frame_total(
        daily_orders(t), period="week", amount="sales", partition_by=["order_year"]
    )


GROUPS_FRAME = _DAILY.format(where="") + """
SELECT strftime(day, '%Y-%m-%d') AS day, order_year::BIGINT AS order_year, week::BIGINT AS week, day_name,
       sales::DOUBLE AS sales,
       (sum(sales) OVER (PARTITION BY order_year ORDER BY week
                         GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW))::DOUBLE AS two_week_promo_total
FROM daily
"""

QUERIES = {
    "r09_next_gap": Query(next_gap, NEXT_GAP),
    "r10_share_and_prior": Query(share_and_prior, SHARE_AND_PRIOR),
    "r10_share_text": Query(share_and_prior_text, SHARE_AND_PRIOR_TEXT),
    "r11_cumulative_in_week": Query(cumulative_in_week, CUMULATIVE_IN_WEEK),
    "r12_centered_average": Query(centered_average, CENTERED_AVERAGE),
    "r13_rolling_rows_average": Query(rolling_rows_average, ROLLING_ROWS_AVERAGE),
    "r14_range_running_total": Query(range_running_total, RANGE_RUNNING_TOTAL),
    "r15_groups_frame": Query(groups_frame, GROUPS_FRAME),
}
