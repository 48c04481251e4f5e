"""Reports on small frames, and against the other ways to write them."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallywork.functions import columns
from tallywork.operators import catalog, membership, ranking, revenue, trends
from tallywork.sources.tables import Tables

D = Decimal
SF = "/root/testdata/sf0.001"


def test_top_n_keeps_ties(frame):
    sales = [("web", c, D(v)) for c, v in ((1, 50), (2, 40), (3, 40), (4, 30), (5, 30), (6, 10))]
    df = frame([*sales, ("shop", 1, D(5))], "channel string, cust int, amount decimal(10,2)")
    best = ranking.top_n_per_group_with_share(df, group="channel", member="cust", amount="amount", n=4)
    assert [(r.channel, r.cust) for r in best.collect()] == [
        ("shop", 1), ("web", 1), ("web", 2), ("web", 3), ("web", 4), ("web", 5),
    ]
    shares = {r.cust: r.sales_percentage for r in best.filter("channel = 'web'").collect()}
    assert shares[1] == D("25.0000") and shares[4] == D("15.0000")


def test_consistent_top_n_needs_every_period(frame):
    df = frame(
        [(y, "a", c, D(v)) for y, c, v in
         ((1, 1, 9), (1, 2, 8), (1, 3, 1), (2, 1, 9), (2, 3, 8), (2, 2, 1), (3, 1, 9), (3, 2, 9), (9, 3, 99))],
        "y int, ch string, c int, v decimal(10,2)",
    )
    got = ranking.consistent_top_n(df, period="y", group="ch", member="c", amount="v", periods=[1, 2, 3], n=2)
    assert rows(got) == [("a", 1, D("27.00"))]


def test_next_gap_skips_equal_years(frame):
    df = frame([(1, "a", 2000), (1, "b", 2000), (1, "b", 2000), (1, "c", 2003), (2, "d", 1990)], "e int, t string, y int")
    got = trends.next_gap(df, entity="e", item="t", year="y")
    assert [tuple(r) for r in got.collect()] == [(1, "b", 2000, 2003, 3), (1, "a", 2000, 2003, 3)]


def test_next_gap_equals_self_join(spark):
    t = Tables(spark, SF)
    events = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_custkey", "l_partkey", F.year("o_orderdate").alias("y")
    )
    events.createOrReplaceTempView("gap_events")
    want = spark.sql(
        """WITH d AS (SELECT DISTINCT * FROM gap_events)
           SELECT a.o_custkey, a.l_partkey, a.y, min(b.y), min(b.y) - a.y
           FROM d a JOIN d b ON a.o_custkey = b.o_custkey AND b.y > a.y GROUP BY ALL"""
    )
    assert rows(trends.next_gap(events, entity="o_custkey", item="l_partkey", year="y")) == rows(want)


def test_share_uses_warm_up_year_and_rounds_first(frame):
    df = frame(
        [(1998, "A", "x", D(1)), (1998, "A", "y", D(2)), (1999, "A", "x", D(2)), (1999, "A", "y", D(1)), (1999, "B", "x", D(4))],
        "y int, r string, c string, v decimal(10,2)",
    )
    got = trends.share_and_prior(df, year="y", region="r", channel="c", amount="v", first_year=1999)
    assert [tuple(r)[3:] for r in got.collect()] == [
        (D("2.00"), D("66.67"), D("33.33"), D("33.34")),
        (D("1.00"), D("33.33"), D("66.67"), D("-33.34")),
        (D("4.00"), D("100.00"), None, None),
    ]
    text = trends.share_report_text(got).collect()
    assert tuple(text[0])[3:] == ("             2$", "66.67%", "33.33%", "33.34%")
    assert text[2].previous_period is None and text[2].delta is None


def test_centered_average_frames(frame):
    # Thursday to Tuesday with the Sunday missing.
    days = [(dt.date(1999, 12, d), D(v)) for d, v in ((2, 1), (3, 2), (4, 4), (6, 8), (7, 16))]
    df = frame(days, "day date, v decimal(10,2)")
    got = trends.centered_average(df, day="day", weekday=F.date_format("day", "EEEE"), amount="v", out="a")
    assert [r.a for r in got.orderBy("day").collect()] == [
        D("1.50"),  # clipped at the start
        D("3.75"),  # Friday: 1, 2, 4, 8
        D("4.67"),  # Saturday: 2, 4, 8
        D("7.50"),  # Monday: 2, 4, 8, 16
        D("12.00"),
    ]


def test_filter_comes_after_the_frame(frame):
    df = frame([(dt.date(2000, 1, d), D(d)) for d in range(1, 6)], "day date, v decimal(10,2)")
    got = trends.rolling_rows_average(df, day="day", amount="v", out="a", keep=F.col("day") >= dt.date(2000, 1, 3))
    assert [r.a for r in got.orderBy("day").collect()] == [D("2.000000"), D("3.000000"), D("4.000000")]


def test_crosstab_fills_zero(frame):
    df = frame([("p", 3, D("1.25")), ("p", 3, D("1.00")), ("r", 1, D(9))], "n string, q int, v decimal(10,2)")
    got = revenue.quarter_crosstab(df, row="n", quarter=F.col("q"), amount="v")
    assert [tuple(r) for r in got.collect()] == [
        ("r", D(9), D(0), D(0), D(0), D(9)),
        ("p", D(0), D(0), D("2.25"), D(0), D("2.25")),
    ]


def test_catalog_forms_agree(spark):
    t = Tables(spark, SF)
    for name in ("orders", "lineitem", "part"):
        getattr(t, name).createOrReplaceTempView(f"cat_{name}")
    got = catalog.filtered_catalog(
        t.orders.withColumn("k", F.col("o_orderkey")),
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey")),
        t.part,
        item_key="o_orderkey", category_key="p_partkey", name="p_type", category="LARGE",
        year="o_orderkey", years=(10, 900), rate="o_totalprice", min_rate=D(5000),
    )
    forms = [
        """SELECT o_orderkey FROM cat_orders JOIN cat_lineitem ON l_orderkey = o_orderkey
           JOIN cat_part ON p_partkey = l_partkey
           WHERE p_type = 'LARGE' AND o_orderkey BETWEEN 10 AND 900 AND o_totalprice > 5000""",
        """WITH c AS (SELECT p_partkey FROM cat_part WHERE p_type = 'LARGE')
           SELECT o_orderkey FROM cat_orders JOIN cat_lineitem ON l_orderkey = o_orderkey JOIN c ON p_partkey = l_partkey
           WHERE o_orderkey BETWEEN 10 AND 900 AND o_totalprice > 5000""",
        """SELECT o_orderkey FROM cat_orders JOIN cat_lineitem ON l_orderkey = o_orderkey
           WHERE (SELECT max(p_type) FROM cat_part WHERE p_partkey = l_partkey) = 'LARGE'
             AND o_orderkey BETWEEN 10 AND 900 AND o_totalprice > 5000""",
    ]
    for form in forms:
        assert rows(got, "o_orderkey") == rows(spark.sql(form))


def test_last_location_equals_anti_self_join(frame):
    payments = frame(
        [(1, 7, 10, D(5), dt.datetime(2017, 3, 1)), (2, 7, 11, D(6), dt.datetime(2017, 9, 1)),
         (3, 7, 12, D(7), dt.datetime(2018, 2, 1)), (4, 8, 10, D(9), dt.datetime(2016, 5, 1)),
         (5, 9, 99, D(50), dt.datetime(2017, 5, 1))],
        "pid int, sid int, rid int, v decimal(10,2), at timestamp_ntz",
    )
    got = revenue.top_with_last_location(
        payments,
        frame([(10, 1), (11, 2), (12, 3)], "rid int, iid int"),
        frame([(1, 100), (2, 200), (3, 300)], "iid int, store int"),
        frame([(7, "Ann"), (8, "Bo"), (9, "Cy")], "sid int, name string"),
        staff_key="sid", payment_key="pid", rental_key="rid", copy_key="iid", store_key="store",
        amount="v", paid_at="at", start=columns.instant(dt.date(2017, 1, 1)), end=columns.instant(dt.date(2018, 1, 1)),
    )
    # 8 has no revenue in the year; 9's last payment has no rental.
    assert rows(got, "name", "last_assigned_store", "total_revenue") == [("Ann", 200, D("11.00"))]


def test_latest_row_of_ties_and_cutoff(frame):
    df = frame([(1, 1, 5), (1, 2, 3), (1, 3, 9), (2, 1, 1)], "k int, id int, v int")
    assert rows(revenue.latest_row(df, ["k"], ["id"], before=("v", F.lit(9)))) == [(1, 2, 3), (2, 1, 1)]


def test_inactivity_defaults_to_this_year(frame):
    args = (frame([(1, "a")], "e int, n string"), frame([(1, 5)], "e int, i int"), frame([(5, 2000)], "i int, y int"))
    got = catalog.inactivity(*args, entity_key="e", item_key="i", year="y").first()
    assert got.years_of_inactivity == dt.date.today().year - 2000


def test_joined_text_skips_null(frame):
    df = frame([(1, "b"), (1, None), (1, "a"), (2, None)], "k int, t string")
    assert rows(catalog.joined_text(df, ["k"], "t", "list")) == [(1, "a, b"), (2, None)]


def test_popular_with_band_default(frame):
    got = catalog.popular_with_band(
        frame([(1, "x", "PG"), (2, "y", None)], "f int, title string, rating string"),
        frame([(10, 1), (11, 2)], "i int, f int"),
        frame([(10,), (10,), (11,)], "i int"),
        item_key="f", copy_key="i", rating="rating", bands={"PG": "8-12 Years"},
    )
    assert [(r.title, r.rental_count, r.target_audience_age) for r in got.collect()] == [
        ("x", 2, "8-12 Years"), ("y", 1, "Unrated"),
    ]


def test_active_in_both_strictly_more(frame):
    left, right = frame([(1,), (1,), (2,), (2,), (3,)], "k int"), frame([(1,), (1,), (2,), (2,), (3,), (3,)], "k int")
    assert rows(membership.active_in_both(left, right, key="k", more_than=1)) == [(2, 2, 2)]
    assert len(rows(membership.active_in_both(left, right, key="k", more_than=1, n=None))) == 2


@pytest.mark.parametrize("value, text", [(D("12.5000"), "12.5%"), (D("3.0000"), "3.%"), (D("0.1234"), "0.1234%")])
def test_percent_text(frame, value, text):
    df = frame([(value,)], "v decimal(8,4)")
    assert df.select(columns.trimmed_percent_text("v")).first()[0] == text


def test_texts_and_periods(frame):
    df = frame([(dt.datetime(2026, 2, 3), "Mary", "Smith", "Elm St", None)], "t timestamp_ntz, f string, l string, a string, b string")
    got = df.select(
        columns.quarter_label("t"), columns.month_end("t"), columns.principal_name("f", "l"),
        columns.full_name("f", "l"), columns.full_name("f", "b"), columns.full_address("a", "b"),
    ).first()
    assert tuple(got) == ("2026 Q1", dt.date(2026, 2, 28), "client_mary_smith", "Mary Smith", None, "Elm St ")
    assert columns.quarter_range(1999, 4) == (dt.datetime(1999, 10, 1), dt.datetime(2000, 1, 1))


def test_daily_reports_with_times_of_day_and_across_new_year(spark, tmp_path):
    """The daily queries on orders that carry a time, beside their SQL."""
    import check
    from pyspark.sql import functions as F

    from tallywork.plans import trends as bound

    source = "/root/testdata/sf0.001"
    for name in check.TABLES:
        df = spark.read.parquet(f"{source}/{name}.parquet")
        if name == "orders":
            df = df.withColumn("o_orderdate", F.expr("o_orderdate + make_interval(0, 0, 0, 0, int(o_orderkey % 24), int(o_orderkey % 60), 0)"))
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    con = __import__("duckdb").connect()
    for name in check.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    for name in ("r11_cumulative_in_week", "r12_centered_average", "r13_rolling_rows_average", "r15_groups_frame"):
        query = bound.QUERIES[name]
        assert check.compare(query.run(spark, str(tmp_path)), con, query.sql).startswith("ok"), name
    weeks = bound.QUERIES["r11_cumulative_in_week"].run(spark, str(tmp_path)).groupBy("order_year", "week")
    widest = weeks.agg(F.datediff(F.max("day"), F.min("day")).alias("d")).agg(F.max("d")).first()[0]
    assert widest <= 6


def test_top_n_of_any_size(spark, frame):
    """Beyond what Spark trims, ranks are taken in slices; the rows are the same."""
    import pytest

    from tallywork.operators import ranking

    df = frame([("a", 1, 2)], "g string, m int, v int")
    with pytest.raises(ValueError, match="at least 1"):
        ranking.top_n_per_group_with_share(df, group="g", member="m", amount="v", n=0)
    df = spark.range(8000).selectExpr("id % 2 AS g", "id AS m", "cast(id % 1500 AS decimal(10,2)) AS v", "id % 3 AS y")
    for n in (900, 1001, 3000):
        best = ranking.top_n_per_group_with_share(df, group="g", member="m", amount="v", n=n, slices=7)
        ordered = {g: sorted((r.v for r in df.filter(f"g = {g}").collect()), reverse=True) for g in (0, 1)}
        want = {g: sum(v >= values[n - 1] for v in values) for g, values in ordered.items()}
        assert {r.g: r["count"] for r in best.groupBy("g").count().collect()} == want
    spread = ranking.consistent_top_n(df.withColumn("m", F.col("m") % 400), period="y", group="g", member="m", amount="v", periods=[0, 1, 2], n=1200, slices=5)
    assert spread.count() == 400


def test_joined_text_takes_any_separator(frame):
    from tallywork.operators.catalog import joined_text

    df = frame([(1, "b"), (1, "a"), (1, None), (2, None)], "k int, t string")
    assert sorted(map(tuple, joined_text(df, ["k"], "t", "o", separator="' \\").collect())) == [(1, "a' \\b"), (2, None)]


def test_text_in_parts_is_the_whole_text(spark):
    """Two thirds of the rows share one key, half of them one text."""
    df = spark.range(3000).selectExpr("if(id % 3 < 2, 1, id % 20) AS k", "if(id % 11 = 0, NULL, if(id % 2 = 0, 'same', 't' || id % 97)) AS t").repartition(6)
    parts = catalog.joined_text_parts(df, ["k"], "t", "text", part_rows=100, slices=30)
    whole = {r.k: r.text for r in catalog.joined_text(df, ["k"], "t", "text").collect() if r.text}
    found = {}
    for r in parts.orderBy("k", "part").collect():
        assert r.part == len(found.setdefault(r.k, [])) and len(r.text.split(", ")) <= 100
        found[r.k].append(r.text)
    assert {k: ", ".join(texts) for k, texts in found.items()} == whole and len(found[1]) == 19
