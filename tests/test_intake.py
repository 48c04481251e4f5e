"""Checked batches, derived rows and generated rows."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallywork.functions.running import running_last
from tallywork.operators import intake, ledger

D = Decimal
BATCH = (
    "n int, customer_full_name string, customer_email string, station_name string, fuel_type string, "
    "employee_last_name string, payment_method string, quantity_sold decimal(12,2), sold_on date"
)
GOOD = ("Vera Lane", "vera@mail.test", "North", "Diesel", "Brook", "Card", D("39.99"), dt.date(2026, 2, 10))


@pytest.fixture
def tables(frame):
    return intake.SaleTables(
        customers=frame([(1, "Vera Lane", "vera@mail.test"), (2, "Tom Reed", "tom@mail.test")],
                        "customer_id int, full_name string, email string"),
        payment_methods=frame([(5, "Card"), (6, "Cash")], "payment_method_id int, payment_method_description string"),
        employees=frame([(8, "Brook"), (7, "Brook")], "employee_id int, last_name string"),
        stations=frame([(1, "North"), (2, "South")], "station_id int, station_name string"),
        fuel_types=frame([(1, "Diesel"), (2, "LPG")], "fuel_type_id int, fuel_description string"),
        pricing=frame(
            [(1, 1, 1, D("2.00"), dt.date(2026, 1, 1)), (2, 1, 1, D("3.00"), dt.date(2026, 3, 1)),
             (3, 2, 1, D("4.00"), dt.date(2026, 1, 1)), (4, 1, 1, D("2.50"), dt.date(2026, 2, 10))],
            "pricing_id int, station_id int, fuel_type_id int, price_per_unit decimal(10,2), effective_date date"),
    )


def sale(n, **changed):
    names = [c.split()[0] for c in BATCH.split(", ")][1:]
    return (n, *(changed.get(name, value) for name, value in zip(names, GOOD)))


def test_record_sales(frame, tables):
    batch = frame(
        [
            sale(1),
            sale(2, customer_email="else@mail.test"),  # same name, other e-mail: guest
            sale(3, customer_full_name=None, customer_email=None, payment_method="Cash"),  # guest
            sale(4, employee_last_name="Nobody", fuel_type="Steam"),  # the first failing check is the reason
            sale(5, payment_method=None, station_name="Nowhere"),
            sale(6, station_name="Nowhere"),
            sale(7, fuel_type="Steam"),
            sale(8, station_name="South", fuel_type="LPG"),
        ],
        BATCH,
    )
    judged = intake.record_sales(batch, tables)
    assert rows(intake.accepted(judged), "n", "customer_id", "pricing_id", "employee_id", "payment_method_id", "total_amount") == [
        (1, 1, 2, 7, 5, D("119.97")),
        (2, None, 2, 7, 5, D("119.97")),
        (3, None, 2, 7, 6, D("119.97")),
    ]
    assert rows(intake.rejected(judged), "n", "reject_reason") == [
        (4, "employee not found"),
        (5, "payment method not found"),
        (6, "station not found"),
        (7, "fuel type not found"),
        (8, "no price set"),
    ]


def test_record_sales_as_of(frame, tables):
    on = lambda y, m, d: dt.date(y, m, d)
    dates = [(on(2025, 12, 31), None), (on(2026, 1, 1), 1), (on(2026, 2, 9), 1), (on(2026, 2, 10), 4),
             (on(2026, 2, 28), 4), (on(2026, 3, 1), 2), (on(2030, 1, 1), 2)]
    batch = frame([sale(i, sold_on=d) for i, (d, _) in enumerate(dates)], BATCH)
    judged = intake.record_sales(batch, tables, sold_at="sold_on")
    assert [r.pricing_id for r in judged.orderBy("n").collect()] == [p for _, p in dates]
    assert judged.filter("reject_reason = 'no price set'").count() == 1


def test_what_is_kept_leaves_with_a_sale(frame, tables):
    """Names that ids stand for are not written; the outcome is that with all columns."""
    batch = frame([sale(1), sale(2, sold_on=dt.date(2026, 3, 2)), sale(3, station_name="Nowhere"), sale(3), sale(3),
                   sale(4, customer_email=None, sold_on=None)], BATCH)
    for sold_at in (None, "sold_on"):
        whole = intake.record_sales(batch, tables, sold_at=sold_at)
        kept = intake.record_sales(batch, tables, sold_at=sold_at, keep=["n"])
        names = {"customer_full_name", "customer_email", "station_name", "fuel_type", "employee_last_name", "payment_method"}
        assert names <= set(whole.columns) and not names & set(kept.columns)
        assert rows(kept) == rows(whole, *kept.columns) and kept.count() == 6
    assert {"n", "quantity_sold", "sold_on", "customer_id", "total_amount"} <= set(kept.columns)


def test_price_as_of_orders_days_not_sales(spark, monkeypatch):
    """Sales of one key and day ask once, so what is sorted with the prices is not the sales."""
    ordered = []

    def counted(df, *args, **named):
        ordered.append(df.count())
        return running_last(df, *args, **named)

    monkeypatch.setattr(ledger, "running_last", counted)
    on = lambda d: dt.date(2020, 1, d)
    sales = [(i, i % 2, on(1 + i % 3)) for i in range(300)] + [(300, None, on(1)), (301, 1, None)]
    got = ledger.price_as_of(
        spark.createDataFrame(sales, "n int, k int, d date").repartition(5),
        spark.createDataFrame([(1, 0, on(2)), (2, 1, on(1)), (3, 1, on(3))], "p int, k int, e date"),
        keys=["k"], sold_at="d", effective="e", columns=["p"],
    )
    assert ordered == [6 + 3]
    want = {(0, 1): None, (0, 2): 1, (0, 3): 1, (1, 1): 2, (1, 2): 2, (1, 3): 3}
    assert {r.n: r.p for r in got.collect()} == {n: want.get((k, d and d.day)) for n, k, d in sales}


def test_price_as_of_equals_brute_force(spark):
    rng = random.Random(3)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(700))
    prices = [(i, rng.randrange(6), day()) for i in range(120)]
    # A third of the sales share one key.
    sales = [(i, 0 if i % 3 == 0 else rng.choice([*range(8), None]), day()) for i in range(600)]
    got = ledger.price_as_of(
        spark.createDataFrame(sales, "n int, k int, d date"),
        spark.createDataFrame(prices, "p int, k int, e date"),
        keys=["k"], sold_at="d", effective="e", columns=["p"],
    )
    for r in got.collect():
        known = [(e, p) for p, k, e in prices if k == r.k and e <= r.d]
        assert r.p == (max(known)[1] if known else None)
    assert got.count() == 600


def test_price_as_of_of_one_hot_day(spark):
    """Most sales on one day of one key, prices that change on that day, sales without a day or key."""
    on = lambda d: dt.date(2020, 1, d)
    prices = [(1, 7, on(1)), (2, 7, on(9)), (3, 7, on(9)), (4, 7, on(10)), (5, None, on(1)), (6, 8, None)]
    sales = [(i, 7, on(9)) for i in range(400)] + [(900, 7, on(8)), (901, 7, None), (902, None, on(9)), (903, 8, on(9)), (904, 7, on(30))]
    got = ledger.price_as_of(
        spark.createDataFrame(sales, "n int, k int, d date").repartition(7),
        spark.createDataFrame(prices, "p int, k int, e date"),
        keys=["k"], sold_at="d", effective="e", columns=["p"],
    )
    assert got.columns == ["n", "k", "d", "p"]
    want = {i: 3 for i in range(400)} | {900: 1, 901: None, 902: None, 903: None, 904: 4}
    assert {r.n: r.p for r in got.collect()} == want


def test_add_items_equals_one_by_one(spark):
    rng = random.Random(9)
    titles, languages = ["Night", "NIGHT", "day", "Dawn", "dusk"], ["english ", "French", "Elvish", None]
    for _ in range(3):
        batch = [(i, rng.choice(titles), rng.choice([None, 2019]), rng.choice(languages)) for i in range(25)]
        taken, want = {"DUSK"}, []
        for i, title, year, language in batch:
            known = (language or "Klingon").strip().upper() in {"ENGLISH", "FRENCH"}
            if title.upper() in taken:
                reason = "duplicate title"
            elif not known:
                reason = "language not found"
            else:
                reason = None
                taken.add(title.upper())
            want.append((i, year or 2026, reason))
        got = intake.add_items(
            spark.createDataFrame([("Dusk",), ("Dusk",)], "title string"),
            spark.createDataFrame([(1, "English  "), (2, "French")], "language_id int, name string"),
            spark.createDataFrame(batch, "n int, title string, release_year int, language_name string"),
            arrival="n", this_year=2026,
        )
        assert rows(got, "n", "release_year", "reject_reason") == sorted(want, key=repr)
        assert got.filter("rental_duration <> 3 OR rental_rate <> 4.99 OR replacement_cost <> 19.99").count() == 0


def test_derived_payments_and_rentals(frame):
    items = frame([(1, "GODFATHER"), (2, "OTHER")], "f int, title string")
    copies = frame([(10, 1), (11, 1), (12, 2)], "i int, f int")
    start = dt.datetime(2026, 1, 1, 9)
    rented = intake.rental_batch(
        copies, items, item_key="f", title="title", titles=["GODFATHER"], customer_id=5, start=start
    )
    assert rows(rented, "i", "customer_id", "rental_date", "return_date") == [
        (10, 5, start, dt.datetime(2026, 1, 8, 9)), (11, 5, start, dt.datetime(2026, 1, 8, 9)),
    ]
    paid = intake.derive_payments(
        frame([(1, 10), (2, 12)], "r int, i int"), copies, items,
        copy_key="i", item_key="f", title="title", amounts={"GODFATHER": "2.99"},
    )
    assert rows(paid, "r", "amount") == [(1, D("2.99")), (2, D("0.99"))]


def test_seeded_rows_do_not_depend_on_partitions(spark, frame):
    people = spark.range(50).select(F.col("id").alias("c"))
    shops = frame([("x",), ("y",), ("z",)], "s string")

    def made(parts):
        series = spark.range(900).repartition(parts)
        return intake.seeded_rows(
            series, number="id", picks=[(people, "c"), (shops, "s")], start=dt.date(2026, 1, 1), seed=4
        )

    first = rows(made(1))
    assert first == rows(made(7)) and len(first) == 900
    assert len({r[2] for r in first}) == 3 or len({r[1] for r in first}) == 50
    quantities = [r["quantity_sold"] for r in made(2).collect()]
    assert min(quantities) >= 5 and max(quantities) <= 55 and len(set(quantities)) > 500


def test_pairs_in_use(frame):
    facts = frame([(1, "a", 5), (1, "a", 6), (2, "b", 7), (1, "b", 8)], "s int, f string, q int")
    assert rows(intake.pairs_in_use(facts, ["s", "f"])) == [(1, "a"), (1, "b"), (2, "b")]


def test_draws_reach_beyond_31_bits(spark):
    """Large numbers and large key lists: draws differ, and fill the whole range."""
    modulus = intake.LEHMER_MODULUS
    numbers = [3, 3 + modulus, 3 + 2 * modulus, 2**40, 2**40 + modulus]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    drawn = [r[0] for r in df.select(intake.seeded_number(F.col("n"), 11)).collect()]
    assert len(set(drawn)) == len(numbers)
    many = [r[0] for r in spark.range(4000).select(intake.seeded_number(F.col("id"), 11)).collect()]
    assert len(set(many)) == 4000 and min(many) >= 0
    quarters = [sum(q * 2**60 <= x < (q + 1) * 2**60 for x in many) for q in range(4)]
    assert all(900 < q < 1100 for q in quarters)
