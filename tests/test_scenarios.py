"""Whole workflows, made of operators only: a fuel network and a film rental."""

import datetime as dt
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from tallywork.operators import catalog, changes, intake, ledger, membership, policy, quality, revenue
from tallywork.session import written
from tallywork.sources.schemas import FUEL_TABLES, fuel_rules
from tallywork.sources.tables import inline_rows

D = Decimal
NOW = dt.datetime(2026, 3, 31, 12)


def listing(spark, table, key, text, values):
    """A lookup table seeded twice: the second run must add nothing."""
    empty = FUEL_TABLES[table].empty(spark)
    batch = changes.assign_ids(empty, inline_rows(spark, [(v,) for v in values], f"{text} string"), key, [text])
    once = written(changes.insert_ignore(empty, batch, [text], [key]).table)
    twice = changes.insert_ignore(once, batch, [text], [key])
    assert twice.rows.count() == 0
    return once


def stored(table, df):
    """The table as written: later steps read files, not the steps before."""
    return written(FUEL_TABLES[table].conform(df))


def test_fuel_network(spark):
    t = {name: table.empty(spark) for name, table in FUEL_TABLES.items()}
    t["fuel_types"] = listing(spark, "fuel_types", "fuel_type_id", "fuel_description", ["A95", "B7", "Gas"])
    t["payment_method"] = listing(spark, "payment_method", "payment_method_id", "payment_method_description", ["Card", "Cash"])
    t["location"] = listing(spark, "location", "location_id", "location_description", ["Hill", "Port"])
    t["roles"] = listing(spark, "roles", "role_id", "role_description", ["Clerk", "Manager"])
    t["loyalty_tiers"] = listing(spark, "loyalty_tiers", "loyalty_tier_id", "loyalty_tier_description", ["Gold", "None"])

    # Children name their parents; the ids come from lookups.
    stations = changes.resolve_keys(
        inline_rows(spark, [(1, "Up", "Hill"), (2, "Quay", "Port"), (3, "Lost", "Moon")],
                    "station_id bigint, station_name string, place string"),
        [changes.Lookup(t["location"], "location_description", "location_id", "place", "location_id")],
    )
    assert rows(stations.filter(F.size("unresolved") > 0), "station_name") == [("Lost",)]
    t["fuel_station"] = stored("fuel_station", stations)
    staff = changes.resolve_keys(
        inline_rows(spark, [(1, "Up", "Clerk", "Ada", "Moss"), (2, "Quay", "Manager", "Ben", "Hart")],
                    "employee_id bigint, station string, role string, first_name string, last_name string"),
        [changes.Lookup(t["fuel_station"], "station_name", "station_id", "station", "station_id"),
         changes.Lookup(t["roles"], "role_description", "role_id", "role", "role_id")],
    )
    t["employees"] = stored("employees", staff)
    t["customers"] = stored("customers", 
        changes.with_defaults(
            inline_rows(spark, [(1, "Vera Lane", "vera@mail.test", 1, None)],
                        "customer_id bigint, full_name string, email string, loyalty_tier_id bigint, join_date date"),
            {"join_date": dt.date(2026, 1, 15)},
        )
    )
    t["tanks"] = stored("tanks", 
        t["fuel_station"].select(F.col("station_id").alias("tank_id"), "station_id", F.lit(50000).alias("max_capacity"))
    )

    # A price for every station and fuel, then deliveries and sales.
    grid = t["fuel_station"].crossJoin(t["fuel_types"]).withColumns(
        {"price_per_unit": intake.seeded_amount(F.col("station_id") * 10 + F.col("fuel_type_id"), 3, 0, "2.50", "4.00"),
         "effective_date": F.lit("2026-01-01").cast("date")}
    )
    t["pricing"] = stored("pricing", 
        changes.assign_ids(t["pricing"], grid, "pricing_id", ["station_id", "fuel_type_id"])
    )
    assert t["pricing"].count() == 9
    made = intake.seeded_rows(
        spark.range(6).withColumnRenamed("id", "n"), number="n", picks=[], quantity=("5000.00", "10000.00"),
        out="quantity_received", start=NOW.date(), step_days=15, seed=2,
    ).withColumn("cost_per_unit", intake.seeded_amount(F.col("n"), 2, 5, "2.00", "2.50").cast("decimal(10,2)"))
    delivered = ledger.with_product_of(made, "quantity_received", "cost_per_unit")
    t["delivery"] = stored("delivery", 
        delivered.select((F.col("n") + 1).alias("delivery_id"), F.lit(None).alias("supplier_id"), "quantity_received",
                         "cost_per_unit", F.col("sale_date").alias("delivery_date"), "total_delivery_value")
    )
    batch = inline_rows(
        spark,
        [(1, "Vera Lane", "vera@mail.test", "Up", "A95", "Moss", "Card", D("39.99")),
         (2, "Vera Lane", "other@mail.test", "Up", "A95", "Moss", "Card", D("30.00")),
         (3, None, None, "Quay", "Gas", "Hart", "Cash", D("15.00")),
         (4, None, None, "Quay", "Steam", "Hart", "Cash", D("15.00"))],
        "sale_id bigint, customer_full_name string, customer_email string, station_name string, fuel_type string, "
        "employee_last_name string, payment_method string, quantity_sold decimal(12,2)",
    )
    judged = intake.record_sales(
        batch,
        intake.SaleTables(t["customers"], t["payment_method"], t["employees"], t["fuel_station"], t["fuel_types"], t["pricing"]),
    )
    assert rows(intake.rejected(judged), "sale_id") == [(4,)]
    sold = changes.with_audit_column(intake.accepted(judged), F.lit(NOW), "sale_time")
    t["sales"] = stored("sales", sold)
    assert rows(t["sales"], "sale_id", "customer_id") == sorted([(1, 1), (2, None), (3, None)], key=repr)

    # Deliveries first, then sales, with the stock after each.
    place = {"tank_id": F.lit(1), "fuel_type_id": F.lit(1)}
    log = ledger.ledger_from_sources(
        t["delivery"].withColumns({**place, "log_timestamp": F.lit(NOW - dt.timedelta(days=1))}),
        t["sales"].withColumns({**place, "log_timestamp": F.lit(NOW)}),
        tank="tank_id", delivery_id="delivery_id", received="quantity_received", sale_id="sale_id", sold="quantity_sold",
        also=["fuel_type_id", "log_timestamp"],
    )
    log = changes.assign_ids(
        t["inventory_logs"], log, "inventory_log_id", ["log_timestamp", F.coalesce("delivery_id", "sale_id")]
    )
    stock = ledger.running_stock(
        log, tank=["tank_id"], change="change_amount", order_by=["log_timestamp", "inventory_log_id"]
    )
    t["inventory_logs"] = stored("inventory_logs", stock)
    received = t["delivery"].agg(F.sum("quantity_received")).first()[0]
    last = t["inventory_logs"].orderBy(F.desc("inventory_log_id")).first()
    assert last.remaining_stock == received - D("84.99")

    # The row constraints of the model hold.
    kept = [r for r in fuel_rules() if isinstance(r, quality.Check) and "in time" not in r.name]
    assert rows(quality.summary(kept, t).filter("violations > 0")) == []

    report = revenue.latest_quarter_summary(
        t["sales"].withColumn("sale_time", F.col("sale_time").cast("timestamp_ntz")), t["pricing"], t["fuel_station"],
        t["fuel_types"], pricing_key="pricing_id", station_key="station_id", fuel_key="fuel_type_id",
        station="station_name", fuel="fuel_description", quantity="quantity_sold", amount="total_amount", sold_at="sale_time",
    )
    assert rows(report, "station_name", "fuel_description", "total_transactions", "volume_sold", "period") == [
        ("Quay", "Gas", 1, D("15.00"), "2026 Q1"), ("Up", "A95", 2, D("69.99"), "2026 Q1"),
    ]
    fixed = changes.update_column(t["delivery"], "cost_per_unit", "5", "delivery_id", 6)
    assert rows(fixed.rows, "delivery_id", "cost_per_unit") == [(6, D("5.00"))]


def test_film_rental(spark, frame):
    films = frame([(1, "OLD ONE", 2001, ["Trailers"])], "film_id bigint, title string, release_year int, special_features array<string>")
    new = frame([("RIVER", 2016, ["Trailers"]), ("STONE", 1972, ["Trailers", "Commentaries"]), ("OLD ONE", 2001, None)],
                "title string, release_year int, special_features array<string>")
    batch = changes.assign_ids(films, new, "film_id", ["title"])
    added = changes.insert_if_absent(films, batch, ["title"])
    assert rows(added.rows, "title") == [("RIVER",), ("STONE",)]
    assert changes.insert_if_absent(added.table, batch, ["title"]).rows.count() == 0
    films = written(added.table)

    actors = frame([(1, "EMMA", "LAKE"), (2, "RYAN", "FORD"), (3, "AL", "HILL")], "actor_id bigint, first_name string, last_name string")
    pairs = frame([("RIVER", "EMMA", "LAKE"), ("RIVER", "RYAN", "FORD"), ("STONE", "AL", "HILL")],
                  "title string, first_name string, last_name string")
    cast = changes.match_pairs(actors, films, pairs, entity_names=["first_name", "last_name"], title="title")
    film_actor = written(changes.insert_ignore(
        frame([], "actor_id bigint, film_id bigint"), cast.select("actor_id", "film_id"), ["actor_id", "film_id"], ["actor_id"]
    ).table)
    top = catalog.top_by_count(actors, film_actor, films, entity_key="actor_id", item_key="film_id",
                               after=("release_year", 2015), out="number_of_movies")
    assert rows(top, "first_name", "number_of_movies") == [("EMMA", 1), ("RYAN", 1)]

    copies = frame([(1, 1, 1)], "inventory_id bigint, film_id bigint, store_id int")
    wanted = films.filter(F.col("title").isin("RIVER", "STONE")).select("film_id", F.lit(1).alias("store_id"))
    copies = written(changes.insert_if_absent(
        copies, changes.assign_ids(copies, wanted, "inventory_id", ["film_id"]), ["film_id"]
    ).table)

    rentals = spark.range(200).select(
        F.col("id").alias("rental_id"), (F.col("id") % 4).alias("customer_id"), F.lit(1).cast("bigint").alias("inventory_id"),
        F.lit(NOW).cast("timestamp_ntz").alias("rental_date"),
    )
    payments = rentals.select(F.col("rental_id").alias("payment_id"), "customer_id", "rental_id")
    payments = payments.filter("customer_id <> 3 OR rental_id < 100")
    chosen = membership.active_in_both(rentals, payments, key="customer_id", more_than=43)
    assert rows(chosen) == [(2, 50, 50)]
    people = frame([(i, "A", f"N{i}") for i in range(4)], "customer_id bigint, first_name string, last_name string")
    renamed = changes.update_where(people, {"first_name": "VERA", "last_name": "LANE"}, keys=chosen, on=["customer_id"])
    assert rows(renamed.rows) == [(2, "VERA", "LANE")]
    payments = written(changes.delete_where(payments, chosen, ["customer_id"]).table)
    rentals = written(changes.delete_where(rentals, chosen, ["customer_id"]).table)
    assert rentals.count() == 150 and payments.filter("customer_id = 2").count() == 0

    # The key is passed on: it no longer qualifies by its row counts.
    rented = intake.rental_batch(copies, films, item_key="film_id", title="title", titles=["RIVER", "STONE"], customer_id=2, start=NOW)
    rented = written(changes.assign_ids(rentals, rented, "rental_id", ["inventory_id"]))
    paid = intake.derive_payments(rented, copies, films, copy_key="inventory_id", item_key="film_id", title="title",
                                  amounts={"RIVER": "4.99", "STONE": "2.99"})
    assert rows(paid, "rental_id", "amount") == [(200, D("4.99")), (201, D("2.99"))]
    rentals = rentals.unionByName(rented.select(*rentals.columns, *["return_date"]), allowMissingColumns=True)
    own = policy.row_policy(rentals, policy.principal_keys(renamed.table, "client_vera_lane", key="customer_id"), "customer_id")
    assert rows(own, "rental_id") == [(200,), (201,)]
    assert own.filter("customer_id = 1").count() == 0
