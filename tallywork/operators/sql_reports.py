"""The reports with arguments as SQL table functions, and two of them as views.

Each function works on one temporary view with the joined rows it needs; Catalyst prunes and
filters through it. ``define_*`` adds to the session; a later call replaces the definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywork.functions.sql import define_table_function, define_view
from tallywork.operators.rental import FIRST_YEAR


def define_quarter_revenue(spark: SparkSession, payments: DataFrame) -> None:
    """``quarter_revenue(report_year, report_quarter)`` and the view ``current_quarter_revenue``.

    ``payments``: category_name, amount, paid_at (timestamp_ntz). A quarter outside 1 to 4 or a
    year outside 2000 to this one is an error.
    """
    define_view("category_payments", payments.select("category_name", "amount", "paid_at"))
    amount = payments.schema["amount"].dataType.simpleString()
    total = f"decimal(38,{payments.schema['amount'].dataType.scale})" if amount.startswith("decimal") else amount
    # Bounds instead of year() and quarter() of the column: they reach the scan. The quarter is
    # kept within 1 to 4 for the bounds alone; the checks refuse any other.
    start = "make_timestamp_ntz(report_year, 3 * least(greatest(report_quarter, 1), 4) - 2, 1, 0, 0, 0)"
    define_table_function(
        spark,
        "quarter_revenue",
        {"report_year": "INT", "report_quarter": "INT"},
        {"category_name": "STRING", "total_revenue": total, "result_quarter": "INT", "result_year": "INT"},
        f"""SELECT category_name, total, report_quarter, report_year
            FROM (SELECT category_name, CAST(sum(amount) AS {total}) AS total FROM category_payments
                  WHERE paid_at >= {start} AND paid_at < {start} + INTERVAL 3 MONTH
                  GROUP BY category_name)""",
        checks={
            "quarter must be between 1 and 4": "report_quarter BETWEEN 1 AND 4",
            f"year must be between {FIRST_YEAR} and this year": f"report_year BETWEEN {FIRST_YEAR} AND year(current_date())",
        },
    )
    spark.sql(
        """CREATE OR REPLACE TEMPORARY VIEW current_quarter_revenue AS
           SELECT category_name, total_revenue, result_quarter AS current_quarter, result_year AS current_year
           FROM quarter_revenue(year(current_date()), quarter(current_date()))"""
    )


def define_most_popular(spark: SparkSession, rentals: DataFrame) -> None:
    """``most_popular_by_group(group_names)``: the most rented items of each group, ties kept.

    ``rentals``: group_name, item_name. Unknown groups give no rows.
    """
    define_view("group_rentals", rentals.select("group_name", "item_name"))
    define_table_function(
        spark,
        "most_popular_by_group",
        {"group_names": "ARRAY<STRING>"},
        {"group_name": "STRING", "item_name": "STRING", "rental_count": "BIGINT"},
        """SELECT group_name, item_name, n
           FROM (SELECT *, rank() OVER (PARTITION BY group_name ORDER BY n DESC) AS place
                 FROM (SELECT group_name, item_name, count(*) AS n FROM group_rentals
                       WHERE array_contains(group_names, group_name) GROUP BY group_name, item_name))
           WHERE place = 1""",
    )


def define_search_history(spark: SparkSession, rentals: DataFrame) -> None:
    """``search_history(pattern)``: rentals of items whose title matches, in any case.

    ``rentals``: title, language, customer_name, rented_at and any key columns. Rows are not
    numbered: the asking query orders them, and
    :func:`tallywork.operators.rental.search_history` numbers any amount of them.
    """
    define_view("rental_search", rentals)
    define_table_function(
        spark,
        "search_history",
        {"pattern": "STRING"},
        {f.name: f.dataType.simpleString() for f in rentals.schema},
        "SELECT * FROM rental_search WHERE title ILIKE pattern",
    )


def define_latest_quarter(summary: DataFrame) -> None:
    """The view ``latest_quarter_summary`` of :func:`tallywork.operators.revenue.latest_quarter_summary`."""
    define_view("latest_quarter_summary", summary)
