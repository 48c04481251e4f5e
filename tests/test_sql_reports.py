"""Reports called from SQL, and policy views by session user."""

import re

import pytest
from conftest import rows

from tallywork.operators.policy import policy_view
from tallywork.plans import rental, sql_reports
from tallywork.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql(spark):
    sql_reports.define(Tables(spark, FOLDER))
    return spark.sql


def test_quarter_revenue_equals_the_operator(spark, sql):
    got = sql("SELECT * FROM quarter_revenue(2000, 4)")
    assert rows(got) == rows(rental.quarter_revenue(Tables(spark, FOLDER)))
    assert sql("SELECT * FROM quarter_revenue(2024, 1)").collect() == []


@pytest.mark.parametrize("arguments, message", [("2000, 5", "quarter must"), ("2000, 0", "quarter must"), ("1990, 1", "year must"), ("3000, 1", "year must")])
def test_wrong_arguments(sql, arguments, message):
    with pytest.raises(Exception, match=message):
        sql(f"SELECT * FROM quarter_revenue({arguments})").collect()


def test_the_quarter_reaches_the_scan(sql):
    plan = sql("SELECT * FROM quarter_revenue(2000, 4)")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", plan) and re.search(r"LessThan\(l_shipdate", plan)
    assert not re.search("NestedLoop|CartesianProduct", plan)


def test_current_quarter_view(sql):
    got = sql("SELECT * FROM current_quarter_revenue")
    assert got.columns == ["category_name", "total_revenue", "current_quarter", "current_year"] and got.collect() == []


def test_most_popular_of_no_group(sql):
    assert sql("SELECT * FROM most_popular_by_group(array('ATLANTIS'))").collect() == []
    assert sql("SELECT * FROM most_popular_by_group(array())").collect() == []


def test_policy_view_follows_the_session_user(spark, frame):
    people = frame([(1, "Mary", "Smith"), (2, "Jo", "Day"), (3, "Al", "Twin"), (4, "Al", "Twin")], "customer_id int, first_name string, last_name string")
    orders = frame([(10, 1), (11, 1), (12, 2), (13, 3), (14, 4), (15, None)], "o int, customer_id int")
    policy_view(orders, people, "own_orders", key="customer_id")
    user = spark._jvm.org.apache.spark.sql.catalyst.CurrentUserContext.CURRENT_USER()

    def seen(name):
        user.set(name)
        try:
            return [r.o for r in spark.sql("SELECT o FROM own_orders ORDER BY o").collect()]
        finally:
            user.remove()

    assert seen("client_mary_smith") == [10, 11]
    assert seen("client_jo_day") == [12]
    # Two customers share the name: it stands for neither.
    assert seen("client_al_twin") == []
    assert seen("somebody") == []
    assert [r.o for r in spark.sql("SELECT o FROM own_orders").collect()] == []
