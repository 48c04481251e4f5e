"""The SQL-callable reports over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import full_name
from tallywork.operators import sql_reports
from tallywork.plans import rental, reports
from tallywork.plans.query import Query
from tallywork.sources.tables import Tables


def define(t: Tables) -> None:
    """All functions and views, in the tables' session."""
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_name", "p_size")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    paid = lines.join(parts, "l_partkey")
    sql_reports.define_quarter_revenue(
        t.spark,
        paid.select(
            F.col("p_type").alias("category_name"), F.col("l_extendedprice").alias("amount"), F.col("l_shipdate").alias("paid_at")
        ),
    )
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    people = t.customer.select("c_custkey", "c_name", "c_nationkey")
    rented = paid.join(orders, "l_orderkey").join(people, "c_custkey")
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("group_name"))
    sql_reports.define_most_popular(
        t.spark, rented.join(nations, "c_nationkey").select("group_name", F.col("p_name").alias("item_name"))
    )
    languages = t.nation.select(F.col("n_nationkey").alias("_language"), F.col("n_name").alias("language"))
    names = F.split("c_name", "#")
    sql_reports.define_search_history(
        t.spark,
        rented.withColumn("_language", F.col("p_size") % F.lit(25))
        .join(languages, "_language")
        .select(
            F.col("p_name").alias("title"), "language", full_name(names[0], names[1]).alias("customer_name"),
            F.col("o_orderdate").alias("rented_at"), "l_orderkey", "l_partkey", "l_linenumber",
        ),
    )
    sql_reports.define_latest_quarter(reports.latest_quarter_summary(t))


def _asked(query: str):
    def ask(t: Tables) -> DataFrame:
        define(t)
        return t.spark.sql(query)

    return ask


MOST_POPULAR = """
WITH counts AS (
  SELECT n_name, p_name, count(*) AS n
  FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
  JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
  WHERE n_name IN ('NATION_3', 'NATION_4', 'NATION_11') GROUP BY n_name, p_name
)
SELECT n_name AS group_name, p_name AS item_name, n AS rental_count
FROM counts a WHERE n = (SELECT max(n) FROM counts b WHERE b.n_name = a.n_name)
"""

SEARCH = """
SELECT p_name AS title, n_name AS language, replace(c_name, '#', ' ') AS customer_name,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS rented_at, l_orderkey, l_partkey, l_linenumber::BIGINT AS l_linenumber
FROM part JOIN lineitem ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = p_size % 25
WHERE p_name ILIKE '%gadget%'
"""

QUERIES = {
    "f02_quarter_revenue_sql": Query(
        _asked("SELECT * FROM quarter_revenue(2000, 4)"), rental._QUARTER_REVENUE.format(prefix="result", year=2000, quarter=4)
    ),
    "f03_most_popular_sql": Query(
        _asked("SELECT * FROM most_popular_by_group(array('NATION_3', 'NATION_4', 'NATION_11', 'ATLANTIS'))"), MOST_POPULAR
    ),
    "f04_search_history_sql": Query(_asked("SELECT * FROM search_history('%gadget%')"), SEARCH),
    "r20_latest_quarter_view": Query(_asked("SELECT * FROM latest_quarter_summary"), reports.LATEST_QUARTER_SUMMARY),
}
