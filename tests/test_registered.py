"""Every registered query against its SQL, and the shape of its plan."""

import re

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from tallywork.plans import registered

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(registered())


@pytest.fixture(scope="module")
def con():
    return check.duck(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, con, name):
    df = queries()[name](spark, FOLDER)
    assert check.compare(df, con, oracle_sql()[name]).startswith("ok")


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["o_custkey", "o_orderpriority", "total_sales", "sales_percentage", "c_name"]
    assert df.count() >= 25


@pytest.fixture
def large_tables(spark):
    """Plans as they are when no side is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Ordered over the whole frame: none.
ONE_TASK_WINDOWS: set[str] = set()
# Running totals over the whole frame order one row per slice in one task.
SLICE_TOTALS = {
    "r12_centered_average", "r13_rolling_rows_average", "r14_range_running_total", "f04_search_history", "c04_assign_ids",
    "c17_seeded_rows",
}


@pytest.mark.parametrize("name", NAMES)
def test_plan_shape(spark, large_tables, name):
    """No rows are paired up, and only known windows take a whole frame."""
    plan = plan_of(queries()[name](spark, FOLDER))
    assert not re.search("NestedLoop|CartesianProduct", plan)
    in_one_task = re.search(r"Window \[.*\n.*Sort \[.*\n.*Exchange SinglePartition", plan)
    assert bool(in_one_task) == (name in ONE_TASK_WINDOWS | SLICE_TOTALS)
    if name in SLICE_TOTALS:
        # What meets in one task has been summed by slice before.
        assert re.search(r"Exchange SinglePartition.*\n.*HashAggregate\(keys=\[_slice", plan)


@pytest.mark.parametrize(
    "name, column",
    [
        ("r01_filtered_catalog", "o_orderdate"),
        ("r02_revenue_by_location", "l_shipdate"),
        ("r05_topn_with_last_location", "o_orderdate"),
        ("r10_share_and_prior", "o_orderdate"),
        ("r17_quarter_crosstab", "o_orderdate"),
        ("f01_current_quarter_revenue", "l_shipdate"),
        ("c01_insert_if_absent", "l_shipdate"),
        ("q01_date_window", "o_orderdate"),
    ],
)
def test_date_filters_reach_the_scan(spark, name, column):
    pushed = " ".join(re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan_of(queries()[name](spark, FOLDER))))
    assert re.search(rf"(GreaterThan|LessThan)\w*\({column},", pushed)


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(queries()["r16_topn_per_group_ties"](spark, FOLDER))
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert all("o_orderdate" not in s and "o_orderstatus" not in s for s in schemas)


def test_top_n_is_trimmed_before_the_shuffle(spark):
    for name in ("r16_topn_per_group_ties", "r06_latest_row_antiself", "c02_insert_ignore"):
        assert plan_of(queries()[name](spark, FOLDER)).count("WindowGroupLimit") >= 2


def test_prices_as_of_are_one_carry(spark, large_tables):
    """No history is exploded and no price is joined to a sale: what is left after the write of
    the ordered rows is one window and the small join of what slices start with."""
    plan = plan_of(queries()["c12_record_sales_as_of"](spark, FOLDER))
    assert "Generate" not in plan and "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") <= 25 and plan.count("SortMergeJoin") <= 1


def shuffled(df):
    """(columns, partitioning) of every hash exchange of a plan."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\((.*)\)", text)


@pytest.mark.parametrize("name", ["c12_record_sales", "c12_rejected_sales"])
def test_sales_are_shuffled_narrow(spark, large_tables, name):
    """Buyers meet orders, not their lines, and names are ids by the time customers are looked up."""
    found = shuffled(queries()[name](spark, FOLDER))
    lines = [(columns, keys) for columns, keys in found if "l_linenumber" in columns]
    assert lines and not [keys for _, keys in lines if "o_custkey" in keys]
    (wide,) = [columns for columns, keys in lines if "customer_email" in keys]
    for name_of_id in ("payment_method#", "station_name#", "fuel_type#", "employee_last_name#"):
        assert name_of_id not in wide
    # Parts, orders, sellers and places; then five names and, for every sale, its price.
    assert len(lines) <= 10


def test_names_are_not_written_with_sales(spark, large_tables):
    plan = plan_of(queries()["c12_record_sales_as_of"](spark, FOLDER))
    (sales,) = [s for s in re.findall(r"ReadSchema: struct<(.*?)>", plan) if "l_linenumber" in s]
    assert "quantity_sold" in sales and not re.search("_name|_email|fuel_type:|payment_method:", sales)


def test_rules_of_a_table_share_a_scan(spark):
    plan = plan_of(queries()["q06_required_and_length"](spark, FOLDER))
    assert plan.count("Scan parquet") == 1
    assert "Not(EqualTo" in plan_of(queries()["q07_domain"](spark, FOLDER)) or "Not(In" in plan_of(queries()["q07_domain"](spark, FOLDER))


def test_a_hot_title_is_joined_once(spark, large_tables):
    plan = plan_of(queries()["c13_add_items"](spark, FOLDER))
    assert len(re.findall(r"SortMergeJoin \[_title", plan)) <= 2
