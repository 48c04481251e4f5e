"""Declared tables and constraints of the two operational data models.

A column list is Spark DDL; the constraints are rules for
:mod:`tallywork.operators.quality`. Table and column names, lengths and limits
are fixed values that stored data must agree with.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallywork.operators.quality import (
    Check,
    ForeignKey,
    Rule,
    Unique,
    above,
    at_least,
    date_window,
    exactly_one,
    in_domain,
    max_length,
    required,
)


@dataclass(frozen=True)
class Table:
    """A table's columns, its keys, and what its rows must satisfy.

    ``unique`` lists key column groups, the first being the primary key;
    ``parents`` maps a column to the table it refers to; ``lengths`` maps text
    columns to their longest length.
    """

    name: str
    ddl: str
    unique: tuple[tuple[str, ...], ...]
    needed: tuple[str, ...] = ()
    lengths: tuple[tuple[str, int], ...] = ()
    parents: tuple[tuple[str, str], ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)

    def conform(self, df: DataFrame) -> DataFrame:
        """``df`` with exactly the declared columns, in order and type."""
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in self.schema.fields])


def structural_rules(tables: dict[str, Table]) -> list[Rule]:
    """Keys, required columns, lengths and references of declared tables as rules."""
    rules: list[Rule] = []
    for t in tables.values():
        rules += [Unique(f"{t.name}: unique {', '.join(keys)}", t.name, keys) for keys in t.unique]
        needed = dict.fromkeys([*t.unique[0], *t.needed])
        rules += [Check(f"{t.name}: {c} required", t.name, required(c)) for c in needed]
        rules += [Check(f"{t.name}: {c} at most {n}", t.name, max_length(c, n)) for c, n in t.lengths]
        for c, parent in t.parents:
            parent_key = tables[parent].unique[0][0]
            rules.append(ForeignKey(f"{t.name}: {c} in {parent}", t.name, c, parent, parent_key))
    return rules


def _by_name(*tables: Table) -> dict[str, Table]:
    return {t.name: t for t in tables}


def _listing(name: str, key: str, text: str, length: int) -> Table:
    """A lookup table: an id and one unique text."""
    return Table(name, f"{key} BIGINT, {text} STRING", ((key,), (text,)), (text,), ((text, length),))


# Fuel station network.
FUEL_TABLES = _by_name(
    _listing("location", "location_id", "location_description", 255),
    _listing("roles", "role_id", "role_description", 50),
    _listing("loyalty_tiers", "loyalty_tier_id", "loyalty_tier_description", 50),
    _listing("payment_method", "payment_method_id", "payment_method_description", 50),
    _listing("fuel_types", "fuel_type_id", "fuel_description", 50),
    Table(
        "supplier",
        "supplier_id BIGINT, company_name STRING, contact_info STRING",
        (("supplier_id",), ("company_name",), ("contact_info",)),
        ("company_name", "contact_info"),
        (("company_name", 100), ("contact_info", 255)),
    ),
    Table(
        "customers",
        "customer_id BIGINT, full_name STRING, email STRING, loyalty_tier_id BIGINT, join_date DATE",
        (("customer_id",), ("email",)),
        ("full_name", "email"),
        (("full_name", 100), ("email", 100)),
        (("loyalty_tier_id", "loyalty_tiers"),),
    ),
    Table(
        "fuel_station",
        "station_id BIGINT, station_name STRING, location_id BIGINT",
        (("station_id",), ("station_name",)),
        ("station_name",),
        (("station_name", 100),),
        (("location_id", "location"),),
    ),
    Table(
        "employees",
        "employee_id BIGINT, station_id BIGINT, role_id BIGINT, first_name STRING, last_name STRING",
        (("employee_id",),),
        ("first_name", "last_name"),
        (("first_name", 50), ("last_name", 50)),
        (("station_id", "fuel_station"), ("role_id", "roles")),
    ),
    Table(
        "tanks",
        "tank_id BIGINT, station_id BIGINT, max_capacity DECIMAL(12,2)",
        (("tank_id",),),
        ("max_capacity",),
        parents=(("station_id", "fuel_station"),),
    ),
    Table(
        "delivery",
        "delivery_id BIGINT, supplier_id BIGINT, quantity_received DECIMAL(12,2), "
        "cost_per_unit DECIMAL(10,2), delivery_date DATE, total_delivery_value DECIMAL(15,2)",
        (("delivery_id",),),
        ("quantity_received", "cost_per_unit"),
        parents=(("supplier_id", "supplier"),),
    ),
    Table(
        "pricing",
        "pricing_id BIGINT, station_id BIGINT, fuel_type_id BIGINT, "
        "price_per_unit DECIMAL(10,2), effective_date DATE",
        (("pricing_id",),),
        ("price_per_unit",),
        parents=(("station_id", "fuel_station"), ("fuel_type_id", "fuel_types")),
    ),
    Table(
        "sales",
        "sale_id BIGINT, customer_id BIGINT, pricing_id BIGINT, employee_id BIGINT, "
        "payment_method_id BIGINT, quantity_sold DECIMAL(12,2), total_amount DECIMAL(15,2), sale_time TIMESTAMP",
        (("sale_id",),),
        ("quantity_sold", "total_amount"),
        parents=(
            ("customer_id", "customers"),
            ("pricing_id", "pricing"),
            ("employee_id", "employees"),
            ("payment_method_id", "payment_method"),
        ),
    ),
    Table(
        "inventory_logs",
        "inventory_log_id BIGINT, tank_id BIGINT, fuel_type_id BIGINT, change_amount DECIMAL(12,2), "
        "sale_id BIGINT, delivery_id BIGINT, remaining_stock DECIMAL(12,2), log_timestamp TIMESTAMP",
        (("inventory_log_id",),),
        ("change_amount", "remaining_stock"),
        parents=(
            ("tank_id", "tanks"),
            ("fuel_type_id", "fuel_types"),
            ("sale_id", "sales"),
            ("delivery_id", "delivery"),
        ),
    ),
)

# Fixed values of the fuel network's checks.
FUEL_START = dt.date(2026, 1, 1)
LOYALTY_TIERS = ("Bronze", "Silver", "Gold", "Platinum", "VIP", "None")


def fuel_rules() -> list[Rule]:
    """Every constraint of the fuel network."""
    dated = (
        ("delivery", "delivery_date"),
        ("customers", "join_date"),
        ("pricing", "effective_date"),
        ("sales", "sale_time"),
    )
    return [
        *structural_rules(FUEL_TABLES),
        *[Check(f"{t}: {c} in time", t, date_window(c, FUEL_START)) for t, c in dated],
        Check("inventory_logs: sale or delivery", "inventory_logs", exactly_one("sale_id", "delivery_id")),
        Check("inventory_logs: stock not negative", "inventory_logs", at_least("remaining_stock")),
        Check("tanks: capacity above 0", "tanks", above("max_capacity")),
        Check("sales: amounts", "sales", above("quantity_sold") & at_least("total_amount")),
        Check("pricing: price above 0", "pricing", above("price_per_unit")),
        Check("loyalty_tiers: known tier", "loyalty_tiers", in_domain("loyalty_tier_description", LOYALTY_TIERS)),
    ]
