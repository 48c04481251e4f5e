"""Reports with checked arguments."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallywork.operators import rental

D = Decimal
BASE = dt.datetime(2020, 1, 1)


def days(n):
    return BASE + dt.timedelta(days=n)


@pytest.mark.parametrize("quarter, year", [(0, 2017), (5, 2017), (1, 1999), (1, 2031)])
def test_bad_quarter_raises_before_any_plan(quarter, year):
    with pytest.raises(ValueError):
        rental.quarter_revenue(
            None, [], category="c", amount="a", paid_at="p", year=year, quarter=quarter, this_year=2030
        )


@pytest.mark.parametrize("limits", [(0, 1), (1, 0), (1, D("0.00"))])
def test_zero_reward_limits_raise(limits):
    with pytest.raises(ValueError):
        rental.rewards(
            None, None, customer_key="c", amount="a", paid_at="p", min_purchases=limits[0], min_amount=limits[1]
        )


def test_quarter_revenue_over_a_path(frame):
    payments = frame(
        [(1, D(5), dt.datetime(2017, 3, 31, 23, 59)), (2, D(7), dt.datetime(2017, 4, 1)), (1, D(1), dt.datetime(2017, 1, 1))],
        "rid int, v decimal(10,2), at timestamp_ntz",
    )
    path = [
        (frame([(1, 10), (2, 20)], "rid int, iid int"), "rid"),
        (frame([(10, "Music"), (20, "Sports")], "iid int, cat string"), "iid"),
    ]
    args = {"category": "cat", "amount": "v", "paid_at": "at"}
    assert rows(rental.quarter_revenue(payments, path, year=2017, quarter=1, **args)) == [("Music", D(6), 1, 2017)]
    assert rows(rental.quarter_revenue(payments, path, year=2016, quarter=1, **args)) == []
    current = rental.current_quarter_revenue(payments, path, as_of=dt.date(2017, 6, 30), **args)
    assert current.columns[2:] == ["current_quarter", "current_year"]
    assert rows(current) == [("Sports", D(7), 2, 2017)]


def test_most_popular_keeps_ties_and_drops_unknown_groups(frame):
    got = rental.most_popular_by_group(
        frame([(1, "Turkey"), (2, "Turkey"), (3, "Peru")], "c int, country string"),
        frame([(1, 10), (2, 20), (3, 10)], "c int, i int"),
        frame([(10, 100), (20, 200)], "i int, f int"),
        frame([(100, "A"), (200, "B")], "f int, title string"),
        group="country", groups=["Turkey", "Narnia"], customer_key="c", copy_key="i", item_key="f",
    )
    assert rows(got, "country", "title") == [("Turkey", "A"), ("Turkey", "B")]


def test_search_numbers_newest_first(frame):
    got = rental.search_history(
        frame([(1, "Toy BOY"), (2, "Other")], "f int, title string"),
        frame([(10, 1), (11, 1), (12, 2)], "i int, f int"),
        frame([(5, 10, 7, days(1)), (6, 11, 7, days(3)), (7, 12, 7, days(9))], "r int, i int, c int, at timestamp_ntz"),
        frame([(7, "Al", "Bo")], "c int, first_name string, last_name string"),
        pattern="%boy%", title="title", item_key="f", copy_key="i", customer_key="c", rented_at="at", tie_break=["r"],
    )
    assert rows(got, "row_num", "r", "customer_name") == [(1, 6, "Al Bo"), (2, 5, "Al Bo")]


def test_rewards_are_strict_and_use_the_newest_month(frame):
    payments = frame(
        [(1, D(6), days(31)), (1, D(5), days(40)), (2, D(10), days(59)), (2, D(90), days(0)), (3, D(20), days(32))],
        "c int, v decimal(10,2), at timestamp_ntz",
    )
    people = frame([(1, "a"), (2, "b"), (3, "c")], "c int, n string")
    got = rental.rewards(
        payments, people, customer_key="c", amount="v", paid_at="at", min_purchases=1, min_amount=10
    )
    assert rows(got) == [(1, "a")]


@pytest.mark.parametrize(
    "returned, fee",
    [
        (3.0, "2.00"),  # on time
        (3.4, "2.00"),  # late by 0.4 days, rounds to nothing
        (3.5, "3.00"),  # half a day rounds up
        (4.5, "4.00"),  # 1.5 days
        (6.0, "5.00"),  # exactly twice the duration: fee only
        (6.1, "15.00"),  # beyond it: replacement on top of 3 days
        (None, "19.00"),  # still out at day 10: 7 days and replacement
    ],
)
def test_balance_of_one_rental(frame, returned, fee):
    got = rental.balance(
        frame([(1,), (2,)], "c int"),
        frame([(1, 10, BASE, None if returned is None else days(returned))],
              "c int, i int, at timestamp_ntz, back timestamp_ntz"),
        frame([(10, 100)], "i int, f int"),
        frame([(100, D("2.00"), 3, D("10.00"))],
              "f int, rental_rate decimal(4,2), rental_duration int, replacement_cost decimal(5,2)"),
        frame([(1, D("1.50"), days(1)), (1, D("9.00"), days(11))], "c int, v decimal(10,2), paid timestamp_ntz"),
        customer_key="c", copy_key="i", item_key="f", rented_at="at", returned_at="back", amount="v",
        paid_at="paid", as_of=days(10),
    )
    assert rows(got) == [(1, D(fee) - D("1.50")), (2, D("0.00"))]


def test_stock_follows_the_newest_rental(frame):
    copies = frame([(1, 5, 1), (2, 5, 1), (3, 5, 2), (4, 6, 2)], "i int, f int, store int")
    rentals = frame(
        [(1, 1, days(0), days(1)), (2, 1, days(2), None), (3, 2, days(0), None), (4, 2, days(3), days(4)), (5, 4, days(1), days(2))],
        "r int, i int, at timestamp_ntz, back timestamp_ntz",
    )
    args = {"copy_key": ["i"], "returned_at": "back", "order_by": ["at", "r"]}
    assert rows(rental.unavailable_items(copies, rentals, **args)) == [(1, 5, 1)]
    free = rental.available_items(copies, rentals, **args)
    assert rows(free, "i") == [(2,), (3,), (4,)]
    assert rows(rental.stock_counts(free, ["f", "store"])) == [(5, 1, 1), (5, 2, 1), (6, 2, 1)]


def test_held_by_and_month_end(frame):
    rentals = frame([(1, 7, None), (2, 7, days(1))], "i int, c int, back timestamp_ntz")
    got = rental.held_by(rentals, frame([(7, "x")], "c int, n string"), customer_key="c", returned_at="back")
    assert rows(got, "i", "n") == [(1, "x")]
    leap = frame([(dt.date(2020, 2, 3),)], "d date")
    assert rental.with_month_end(leap, "d").select(F.col("month_end")).first()[0] == dt.date(2020, 2, 29)
