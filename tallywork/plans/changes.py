"""Table changes, ledger, checked intake and generated rows."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import instant
from tallywork.operators import changes, intake, ledger
from tallywork.operators.intake import SaleTables
from tallywork.plans.query import Query
from tallywork.session import written, written_folder
from tallywork.sources.sinks import read_batches, with_month_bucket, write_batch, write_partitioned
from tallywork.sources.tables import Tables

# Roles: lines shipped before this day are the table, later lines the batch; the
# natural key is the (part, supplier) pair.
NEW_YEAR = dt.date(1998, 1, 1)
_LINE = ["l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate"]


def _insert_if_absent(t: Tables, sift: bool = False) -> changes.Change:
    lines = t.lineitem.select("l_partkey", "l_suppkey", "l_shipdate")
    old = lines.filter(F.col("l_shipdate") < instant(NEW_YEAR))
    new = (
        lines.filter(F.col("l_shipdate") >= instant(NEW_YEAR))
        .groupBy("l_partkey", "l_suppkey")
        .agg(F.min("l_shipdate").alias("l_shipdate"))
    )
    return changes.insert_if_absent(old, new, ["l_partkey", "l_suppkey"], sift=sift)


INSERT_IF_ABSENT = """
WITH old AS (
  SELECT l_partkey, l_suppkey, l_shipdate FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'
), new AS (
  SELECT l_partkey, l_suppkey, min(l_shipdate) AS l_shipdate FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY l_partkey, l_suppkey
)
SELECT l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM (
  SELECT * FROM old UNION ALL
  SELECT * FROM new n WHERE NOT EXISTS (
    SELECT 1 FROM old o WHERE o.l_partkey = n.l_partkey AND o.l_suppkey = n.l_suppkey))
"""


def insert_ignore(t: Tables) -> DataFrame:
    target = t.lineitem.filter(F.col("l_shipdate") < instant(NEW_YEAR)).select(*_LINE)
    unknown = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)
    batch = (
        t.lineitem.filter(F.col("l_shipdate") >= instant(NEW_YEAR))
        .withColumn("l_suppkey", F.when(~unknown, F.col("l_suppkey")))
        .select(*_LINE)
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    return changes.insert_ignore(target, batch, ["l_partkey", "l_suppkey"], order).table


INSERT_IGNORE = """
WITH target AS (
  SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_shipdate
  FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'
), batch AS (
  SELECT l_partkey, CASE WHEN NOT (l_returnflag = 'R' AND l_linenumber = 7) THEN l_suppkey END AS l_suppkey,
         l_orderkey, l_linenumber, l_shipdate
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey
                               ORDER BY l_shipdate, l_orderkey, l_linenumber) AS rn FROM batch
), result AS (
  SELECT * FROM target
  UNION ALL
  SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_shipdate FROM numbered n
  WHERE l_suppkey IS NULL OR (rn = 1 AND NOT EXISTS (
    SELECT 1 FROM target o WHERE o.l_partkey = n.l_partkey AND o.l_suppkey = n.l_suppkey))
)
SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber::BIGINT AS l_linenumber,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM result
"""


def resolve_keys(t: Tables) -> DataFrame:
    batch = t.customer.select(
        "c_custkey",
        F.concat(F.lit("NATION_"), (F.col("c_nationkey") + 2).cast("string")).alias("nation_name"),
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"),
    )
    segments = (
        t.customer.filter("c_mktsegment <> 'MACHINERY'")
        .groupBy("c_mktsegment")
        .agg(F.min("c_custkey").alias("segment_id"))
    )
    resolved = changes.resolve_keys(
        batch,
        [
            changes.Lookup(t.nation, "n_name", "n_nationkey", "nation_name", "nation_id"),
            changes.Lookup(segments, "c_mktsegment", "segment_id", "segment", "segment_id"),
        ],
    )
    return resolved.withColumn("unresolved", F.array_join("unresolved", ","))


RESOLVE_KEYS = """
WITH batch AS (
  SELECT c_custkey, 'NATION_' || (c_nationkey + 2) AS nation_name, nullif(c_mktsegment, 'BUILDING') AS segment
  FROM customer
), segments AS (
  SELECT c_mktsegment, min(c_custkey) AS segment_id FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1
)
SELECT c_custkey, nation_name, segment, n_nationkey::BIGINT AS nation_id, segment_id,
       concat_ws(',', CASE WHEN n_nationkey IS NULL THEN 'nation_id' END,
                      CASE WHEN segment_id IS NULL AND segment IS NOT NULL THEN 'segment_id' END) AS unresolved
FROM batch LEFT JOIN nation ON n_name = nation_name LEFT JOIN segments ON c_mktsegment = segment
"""


def assign_ids(t: Tables) -> DataFrame:
    order = [F.col("c_acctbal").desc(), F.col("c_custkey")]
    return changes.assign_ids(t.supplier, t.customer.select("c_custkey", "c_acctbal"), "s_suppkey", order)


ASSIGN_IDS = """
SELECT c_custkey, c_acctbal::DECIMAL(18,2)::DOUBLE AS c_acctbal,
       (SELECT max(s_suppkey) FROM supplier)
         + row_number() OVER (ORDER BY c_acctbal::DECIMAL(18,2) DESC, c_custkey) AS s_suppkey
FROM customer
"""


def _overdrawn(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))


def _update(t: Tables, sift: bool = False) -> changes.Change:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    return changes.update_where(
        orders,
        {"o_orderstatus": "H", "o_orderpriority": F.upper(F.concat(F.lit("held "), "o_orderpriority"))},
        predicate=F.col("o_orderdate") >= instant(NEW_YEAR),
        keys=_overdrawn(t),
        on=["o_custkey"],
        sift=sift,
    )


_UPDATED = """
SELECT o_orderkey, o_custkey, CASE WHEN hit THEN 'H' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN hit THEN upper('held ' || o_orderpriority) ELSE o_orderpriority END AS o_orderpriority,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate
FROM (SELECT *, o_orderdate >= TIMESTAMP '1998-01-01'
                AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AS hit FROM orders)
"""


def _update_column(t: Tables) -> changes.Change:
    customers = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return changes.update_column(customers, "c_acctbal", "1234.5", "c_custkey", 7)


UPDATE_COLUMN = """
SELECT c_custkey, c_mktsegment,
       (CASE WHEN c_custkey = 7 THEN 1234.50 ELSE c_acctbal::DECIMAL(18,2) END)::DOUBLE AS c_acctbal
FROM customer
"""


def _delete(t: Tables, sift: bool = False) -> changes.Change:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return changes.delete_where(orders, _overdrawn(t), ["o_custkey"], sift=sift)


_DELETED = """
SELECT o_orderkey, o_custkey, o_totalprice::DECIMAL(18,2)::DOUBLE AS o_totalprice FROM orders
WHERE o_custkey {} (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
"""


def price_on_ingest(t: Tables) -> DataFrame:
    sales = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), "l_quantity"
    )
    return ledger.price_on_ingest(
        sales, t.part, pricing_key="p_partkey", price="p_retailprice", quantity="l_quantity"
    )


PRICE_ON_INGEST = """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey AS p_partkey,
       l_quantity::DECIMAL(18,2)::DOUBLE AS l_quantity,
       (p_retailprice::DECIMAL(10,2) * l_quantity::DECIMAL(8,2))::DECIMAL(15,2)::DOUBLE AS total_amount
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
"""


def stock_changes(t: Tables) -> DataFrame:
    """Events as a tank log: purchases take from the stock of a user, others add."""
    taken = F.col("event_type") == "purchase"
    return t.events.select(
        "event_id", "user_id", "ts", F.when(taken, -F.col("value")).otherwise(F.col("value")).alias("change_amount")
    )


def running_stock(t: Tables) -> DataFrame:
    return ledger.running_stock(
        stock_changes(t), tank=["user_id"], change="change_amount", order_by=["ts", "event_id"]
    ).select("event_id", "user_id", "change_amount", "remaining_stock")


RUNNING_STOCK = """
WITH log AS (
  SELECT event_id, user_id, ts,
         CASE WHEN event_type = 'purchase' THEN -value ELSE value END::DECIMAL(18,2) AS change_amount FROM events
)
SELECT event_id, user_id, change_amount::DOUBLE AS change_amount,
       (sum(change_amount) OVER (PARTITION BY user_id ORDER BY ts, event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE AS remaining_stock
FROM log
"""


def ledger_from_sources(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    returned = F.col("l_returnflag") == "R"
    return ledger.ledger_from_sources(
        lines.filter(returned),
        lines.filter(~returned),
        tank="l_suppkey",
        delivery_id="l_orderkey",
        received="l_quantity",
        sale_id="l_orderkey",
        sold="l_quantity",
        also=["l_linenumber"],
    )


LEDGER_FROM_SOURCES = """
SELECT l_suppkey, l_linenumber::BIGINT AS l_linenumber, l_quantity::DOUBLE AS change_amount,
       NULL::BIGINT AS sale_id, l_orderkey AS delivery_id FROM lineitem WHERE l_returnflag = 'R'
UNION ALL
SELECT l_suppkey, l_linenumber, -l_quantity, l_orderkey, NULL FROM lineitem WHERE l_returnflag <> 'R'
"""


def generated_column(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return ledger.with_product_of(lines, "l_quantity", "l_extendedprice")


GENERATED_COLUMN = """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity::DOUBLE AS l_quantity,
       l_extendedprice::DECIMAL(18,2)::DOUBLE AS l_extendedprice,
       (l_quantity::DECIMAL(8,2) * l_extendedprice::DECIMAL(10,2))::DECIMAL(15,2)::DOUBLE AS total_delivery_value
FROM lineitem
"""


def defaults_and_audit(t: Tables) -> DataFrame:
    orders = t.orders.select(
        "o_orderkey",
        F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("o_orderdate"),
    )
    filled = changes.with_defaults(orders, {"o_orderstatus": "O", "o_orderdate": instant(dt.date(2002, 1, 1))})
    return changes.with_audit_column(filled, instant(dt.datetime(2002, 1, 2, 3, 4, 5)))


DEFAULTS_AND_AUDIT = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS o_orderstatus,
       strftime(CASE WHEN o_orderpriority = '5-LOW' THEN TIMESTAMP '2002-01-01' ELSE o_orderdate END,
                '%Y-%m-%d %H:%M:%S') AS o_orderdate,
       '2002-01-02 03:04:05' AS record_ts
FROM orders
"""

# Checked sales. Roles: an order line is a sale by name; part of the names is unknown:
# priority 5-LOW is no payment method, overdrawn suppliers are no employees, nations of
# region 0 no stations, ECONOMY no fuel, and PROMO has no price in nations of region 2.
# Only orders of status F set prices. The second letter of a type tells types apart.


def _sale_batch(t: Tables) -> DataFrame:
    people = t.customer.select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_name").alias("customer_full_name"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("other@mail.test"))
        .when(F.col("c_mktsegment") != "AUTOMOBILE", F.concat(F.lower("c_name"), F.lit("@mail.test")))
        .alias("customer_email"),
    )
    sellers = t.supplier.select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("employee_last_name"), "s_nationkey"
    )
    places = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("station_name"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").alias("quantity_sold"),
    )
    orders = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderdate", F.col("o_orderpriority").alias("payment_method")
    )
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("fuel_type"))
    # Lines are many: they meet the parts while they are narrow, the buyers as few orders, not
    # line by line, and the sellers, who may be broadcast, only when no other table follows.
    return (
        lines.join(parts, "l_partkey")
        .join(orders.join(people, "o_custkey"), "o_orderkey")
        .join(sellers, "l_suppkey")
        .join(places, "s_nationkey")
        .drop("s_nationkey")
    )


def _sale_tables(t: Tables) -> SaleTables:
    """The dimensions. Those made from large tables are small themselves and are written once:
    then their size is known before a join with all sales is planned."""
    priced = (
        t.lineitem.join(t.orders.filter("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .filter("p_type <> 'PROMO' OR n_regionkey <> 2")
    )
    pricing = priced.groupBy(
        F.col("n_nationkey").alias("station_id"),
        F.ascii(F.substring("p_type", 2, 1)).alias("fuel_type_id"),
        F.to_date("o_orderdate").alias("effective_date"),
    ).agg(F.max("p_retailprice").alias("price_per_unit"))
    # One price row per station, fuel and day: the id is made of the three.
    pricing_id = F.concat_ws("/", F.col("station_id"), F.col("fuel_type_id"), F.col("effective_date"))
    return SaleTables(
        customers=t.customer.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("full_name"),
            F.concat(F.lower("c_name"), F.lit("@mail.test")).alias("email"),
        ),
        payment_methods=written(
            t.orders.filter("o_orderpriority <> '5-LOW'")
            .select(
                F.col("o_orderpriority").alias("payment_method_description"),
                F.substring("o_orderpriority", 1, 1).cast("bigint").alias("payment_method_id"),
            )
            .distinct()
        ),
        employees=t.supplier.filter("s_acctbal >= 0").select(
            F.col("s_suppkey").alias("employee_id"), F.col("s_name").alias("last_name")
        ),
        stations=t.nation.filter("n_regionkey <> 0").select(
            F.col("n_nationkey").alias("station_id"), F.col("n_name").alias("station_name")
        ),
        fuel_types=written(
            t.part.filter("p_type <> 'ECONOMY'")
            .select(
                F.ascii(F.substring("p_type", 2, 1)).alias("fuel_type_id"), F.col("p_type").alias("fuel_description")
            )
            .distinct()
        ),
        pricing=written(pricing.withColumn("pricing_id", pricing_id)),
    )


_SALE_KEYS = ["o_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_SALE_IDS = ["customer_id", "pricing_id", "employee_id", "payment_method_id", "quantity_sold", "total_amount"]


def record_sales(t: Tables) -> DataFrame:
    judged = intake.record_sales(_sale_batch(t), _sale_tables(t))
    return intake.accepted(judged).select(*_SALE_KEYS, *_SALE_IDS)


def rejected_sales(t: Tables) -> DataFrame:
    judged = intake.record_sales(_sale_batch(t), _sale_tables(t))
    return intake.rejected(judged).select(*_SALE_KEYS, "reject_reason")


def record_sales_as_of(t: Tables) -> DataFrame:
    judged = intake.record_sales(_sale_batch(t), _sale_tables(t), sold_at="o_orderdate", keep=_SALE_KEYS)
    return judged.select(*_SALE_KEYS, "pricing_id", "total_amount", "reject_reason")


_SALES = """
WITH prices AS (
  SELECT n_nationkey, p_type, o_orderdate::DATE AS d, max(p_retailprice)::DECIMAL(10,2) AS price,
         n_nationkey || '/' || ascii(p_type[2]) || '/' || strftime(o_orderdate, '%Y-%m-%d') AS pricing_id
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey JOIN part ON p_partkey = l_partkey
  WHERE o_orderstatus = 'F' AND (p_type <> 'PROMO' OR n_regionkey <> 2)
  GROUP BY n_nationkey, p_type, d, pricing_id
), newest AS (
  SELECT n_nationkey, p_type, max(d) AS d FROM prices GROUP BY n_nationkey, p_type
), latest AS (
  SELECT p.* FROM prices p JOIN newest USING (n_nationkey, p_type, d)
), lines AS (
  SELECT l.*, o.*, c.*, s.*, n.*, p_type,
         CASE WHEN c_mktsegment NOT IN ('MACHINERY', 'AUTOMOBILE') THEN c_custkey END AS customer_id,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'payment method not found'
              WHEN s_acctbal < 0 THEN 'employee not found'
              WHEN n_regionkey = 0 THEN 'station not found'
              WHEN p_type = 'ECONOMY' THEN 'fuel type not found' END AS early_reason
  FROM lineitem l JOIN orders o ON o_orderkey = l_orderkey JOIN customer c ON c_custkey = o_custkey
  JOIN supplier s ON s_suppkey = l_suppkey JOIN nation n ON n_nationkey = s_nationkey
  JOIN part ON p_partkey = l_partkey
), judged AS (
  SELECT a.*, price, pricing_id,
         coalesce(early_reason, CASE WHEN pricing_id IS NULL THEN 'no price set' END) AS reject_reason
  FROM lines a LEFT JOIN latest b ON b.n_nationkey = a.n_nationkey AND b.p_type = a.p_type
)
"""

RECORD_SALES = _SALES + """
SELECT o_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, customer_id, pricing_id,
       s_suppkey AS employee_id, o_orderpriority[1]::BIGINT AS payment_method_id, l_quantity AS quantity_sold,
       (price * l_quantity::DECIMAL(8,2))::DECIMAL(15,2)::DOUBLE AS total_amount
FROM judged WHERE reject_reason IS NULL
"""

REJECTED_SALES = _SALES + """
SELECT o_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, reject_reason
FROM judged WHERE reject_reason IS NOT NULL
"""

RECORD_SALES_AS_OF = _SALES + """
, found AS (
  SELECT a.*, b.pricing_id, b.price
  FROM lines a ASOF LEFT JOIN prices b
    ON a.n_nationkey = b.n_nationkey AND a.p_type = b.p_type AND a.o_orderdate::DATE >= b.d
)
SELECT o_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey,
       CASE WHEN n_regionkey <> 0 AND p_type <> 'ECONOMY' THEN pricing_id END AS pricing_id,
       CASE WHEN n_regionkey <> 0 AND p_type <> 'ECONOMY'
            THEN (price * l_quantity::DECIMAL(8,2))::DECIMAL(15,2)::DOUBLE END AS total_amount,
       coalesce(early_reason, CASE WHEN pricing_id IS NULL THEN 'no price set' END) AS reject_reason
FROM found
"""


def add_items(t: Tables) -> DataFrame:
    title = F.concat_ws(" ", "p_name", F.col("p_size"))
    items = t.part.filter("p_type <> 'PROMO'").select(title.alias("title"))
    batch = t.part.filter("p_type = 'PROMO'").select(
        "p_partkey",
        F.initcap(title).alias("title"),
        F.when(F.col("p_size") != 7, F.concat(F.lit(" "), F.lower("p_brand"))).alias("language_name"),
        F.when(F.col("p_size") != 8, 1990 + F.col("p_size")).alias("release_year"),
    )
    languages = (
        t.part.filter("p_brand <> 'Brand#9'")
        .select(
            F.regexp_extract("p_brand", r"\d+", 0).cast("bigint").alias("language_id"),
            F.concat("p_brand", F.lit("  ")).alias("name"),
        )
        .distinct()
    )
    return intake.add_items(items, languages, batch, arrival="p_partkey", this_year=2002)


ADD_ITEMS = """
WITH items AS (SELECT DISTINCT upper(p_name || ' ' || p_size) AS u FROM part WHERE p_type <> 'PROMO'),
batch AS (
  SELECT p_partkey, upper(p_name || ' ' || p_size) AS u, p_name || ' ' || p_size AS raw,
         CASE WHEN p_size <> 7 THEN ' ' || lower(p_brand) ELSE 'Klingon' END AS language_name,
         CASE WHEN p_size <> 8 THEN 1990 + p_size ELSE 2002 END AS release_year,
         CASE WHEN p_size <> 7 AND p_brand <> 'Brand#9' THEN p_brand[7:]::BIGINT END AS language_id
  FROM part WHERE p_type = 'PROMO'
), judged AS (
  SELECT *, CASE
      WHEN EXISTS (SELECT 1 FROM items i WHERE i.u = b.u) THEN 'duplicate title'
      WHEN EXISTS (SELECT 1 FROM batch e WHERE e.u = b.u AND e.language_id IS NOT NULL
                   AND e.p_partkey < b.p_partkey) THEN 'duplicate title'
      WHEN language_id IS NULL THEN 'language not found' END AS reject_reason
  FROM batch b
)
SELECT p_partkey,
       list_aggregate([upper(w[1]) || lower(w[2:]) FOR w IN string_split(raw, ' ')], 'string_agg', ' ') AS title,
       language_name, release_year::BIGINT AS release_year, language_id, reject_reason,
       3::BIGINT AS rental_duration, 4.99::DOUBLE AS rental_rate, 19.99::DOUBLE AS replacement_cost
FROM judged
"""


def derive_payments(t: Tables) -> DataFrame:
    rentals = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("copy_id"))
    return intake.derive_payments(
        rentals,
        t.part.select(F.col("p_partkey").alias("copy_id"), "p_partkey"),
        t.part,
        copy_key="copy_id",
        item_key="p_partkey",
        title="p_name",
        amounts={"small widget": "2.99", "blue anvil": "4.99", "hot bolt": "3.99"},
        paid_at=instant(dt.datetime(2002, 1, 1, 10)),
    )


DERIVE_PAYMENTS = """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey AS copy_id,
       CASE p_name WHEN 'small widget' THEN 2.99 WHEN 'blue anvil' THEN 4.99 WHEN 'hot bolt' THEN 3.99
            ELSE 0.99 END::DOUBLE AS amount,
       '2002-01-01 10:00:00' AS payment_date
FROM lineitem JOIN part ON p_partkey = l_partkey
"""


def rental_batch(t: Tables) -> DataFrame:
    copies = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_suppkey").distinct()
    return intake.rental_batch(
        copies,
        t.part,
        item_key="p_partkey",
        title="p_name",
        titles=["small widget", "blue anvil", "hot bolt"],
        customer_id=42,
        start=dt.datetime(2001, 8, 1, 9, 30),
    )


RENTAL_BATCH = """
SELECT DISTINCT l_partkey AS p_partkey, l_suppkey, '2001-08-01 09:30:00' AS rental_date, 42::BIGINT AS customer_id,
       '2001-08-08 09:30:00' AS return_date, 1::BIGINT AS staff_id
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_name IN ('small widget', 'blue anvil', 'hot bolt')
"""


def match_pairs(t: Tables) -> DataFrame:
    title = F.concat_ws(" ", "p_name", "p_brand", F.col("p_size")).alias("title")
    items = t.part.select("p_partkey", title)
    suppliers = t.supplier.select("s_suppkey", "s_name")
    pairs = (
        t.lineitem.select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"))
        .join(items, "p_partkey")
        .join(suppliers, "s_suppkey")
        .select("title", "s_name")
        .distinct()
    )
    return changes.match_pairs(suppliers, items, pairs, entity_names=["s_name"], title="title").select(
        "s_suppkey", "p_partkey"
    )


MATCH_PAIRS = """
WITH items AS (SELECT p_partkey, p_name || ' ' || p_brand || ' ' || p_size AS title FROM part),
pairs AS (
  SELECT DISTINCT title, s_name FROM lineitem JOIN items ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey
)
SELECT s_suppkey, p_partkey FROM pairs JOIN supplier USING (s_name) JOIN items USING (title)
"""


def seeded_rows(t: Tables) -> DataFrame:
    return intake.seeded_rows(
        t.orders,
        number="o_orderkey",
        picks=[(t.customer, "c_custkey"), (t.supplier, "s_suppkey")],
        start=dt.date(2001, 8, 1),
        seed=11,
    )


def _lehmer(step: str, seed: int, draw: int) -> str:
    for _ in range(3):
        step = f"(({step} * 48271 + {seed + draw}) % 2147483647)"
    return step


def _draw(number: str, seed: int, draw: int) -> str:
    high = _lehmer(f"(({number} + {seed + 7919 * draw + 1}) % 2147483647)", seed, draw)
    low = _lehmer(f"(({high} + {number} // 2147483647 + 1) % 2147483647)", seed + 1, draw)
    return f"({high} * 2147483648 + {low})"


def _amount(number: str, seed: int, draw: int, low: int, high: int) -> str:
    """SQL for an amount between two numbers of cents, rounded half up."""
    unit = f"({_draw(number, seed, draw)} % 100001)"
    return f"((2 * ({low} * 100000 + {high - low} * {unit}) + 100000) // 200000)::DOUBLE / 100"


SEEDED_ROWS = f"""
WITH customers AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS c_at FROM customer),
suppliers AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS s_at FROM supplier),
sizes AS (SELECT (SELECT count(*) FROM customer) AS n_customers, (SELECT count(*) FROM supplier) AS n_suppliers),
drawn AS (
  SELECT o_orderkey, {_draw('o_orderkey', 11, 0)} % n_customers AS c_at,
         {_draw('o_orderkey', 11, 1)} % n_suppliers AS s_at
  FROM orders CROSS JOIN sizes
)
SELECT o_orderkey, c_custkey, s_suppkey, {_amount('o_orderkey', 11, 2, 500, 5500)} AS quantity_sold,
       strftime(DATE '2001-08-01' - ((o_orderkey % 6) * 18)::INTEGER, '%Y-%m-%d') AS sale_date
FROM drawn JOIN customers USING (c_at) JOIN suppliers USING (s_at)
"""


def priced_pairs(t: Tables) -> DataFrame:
    brands = t.part.select(
        F.col("p_partkey").alias("l_partkey"),
        "p_brand",
        F.regexp_extract("p_brand", r"\d+", 0).cast("bigint").alias("brand_no"),
    )
    lines = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), "l_partkey")
    grid = intake.pairs_in_use(lines.join(brands, "l_partkey"), ["s_suppkey", "p_brand", "brand_no"])
    number = F.col("s_suppkey") * 100 + F.col("brand_no")
    return grid.withColumns(
        {
            "price_per_unit": intake.seeded_amount(number, 7, 0, "2.50", "4.00"),
            "effective_date": F.lit("2001-01-01").cast("date"),
        }
    )


PRICED_PAIRS = f"""
SELECT s_suppkey, p_brand, brand_no, {_amount('(s_suppkey * 100 + brand_no)', 7, 0, 250, 400)} AS price_per_unit,
       '2001-01-01' AS effective_date
FROM (SELECT DISTINCT l_suppkey AS s_suppkey, p_brand, p_brand[7:]::BIGINT AS brand_no
      FROM lineitem JOIN part ON p_partkey = l_partkey)
"""

# Months that have a partition of their own; the rest go to the default one.
MONTHS = tuple(f"{year}-{month:02d}" for year in range(1996, 2001) for month in range(1, 13))


def partitioned_sink(t: Tables) -> DataFrame:
    """Written by month and read back, the default bucket included."""
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    path = f"{written_folder(t.spark)}/{uuid.uuid4().hex}"
    write_partitioned(with_month_bucket(orders, "o_orderdate", MONTHS), path)
    return t.spark.read.parquet(path)


PARTITIONED_SINK = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
       o_totalprice::DECIMAL(18,2)::DOUBLE AS o_totalprice,
       CASE WHEN year(o_orderdate) BETWEEN 1996 AND 2000 THEN strftime(o_orderdate, '%Y-%m')
            ELSE 'default' END AS bucket
FROM orders
"""



def batch_appended_twice(t: Tables) -> DataFrame:
    """Old rows as one batch, absent ones as another, that one twice, as after a lost driver."""
    change = _insert_if_absent(t)
    old = t.lineitem.select("l_partkey", "l_suppkey", "l_shipdate").filter(F.col("l_shipdate") < instant(NEW_YEAR))
    path = f"{written_folder(t.spark)}/{uuid.uuid4().hex}"
    write_batch(old, path, "before")
    for _ in range(2):
        write_batch(change.rows, path, "1998")
    return read_batches(t.spark, path, old.schema)


BATCH_APPENDED_TWICE = INSERT_IF_ABSENT

QUERIES = {
    "c01_insert_if_absent": Query(lambda t: _insert_if_absent(t).table, INSERT_IF_ABSENT),
    "c01_insert_sifted": Query(lambda t: _insert_if_absent(t, sift=True).table, INSERT_IF_ABSENT),
    "c01_batch_appended_twice": Query(batch_appended_twice, BATCH_APPENDED_TWICE),
    "c02_insert_ignore": Query(insert_ignore, INSERT_IGNORE),
    "c03_resolve_keys": Query(resolve_keys, RESOLVE_KEYS),
    "c04_assign_ids": Query(assign_ids, ASSIGN_IDS),
    "c05_update_where": Query(lambda t: _update(t).table, _UPDATED),
    "c05_changed_rows": Query(lambda t: _update(t).rows, _UPDATED + "WHERE hit"),
    "c05_update_sifted": Query(lambda t: _update(t, sift=True).table, _UPDATED),
    "c05_update_column": Query(lambda t: _update_column(t).table, UPDATE_COLUMN),
    "c06_delete_where": Query(lambda t: _delete(t).table, _DELETED.format("NOT IN")),
    "c06_delete_sifted": Query(lambda t: _delete(t, sift=True).table, _DELETED.format("NOT IN")),
    "c06_removed_rows": Query(lambda t: _delete(t).rows, _DELETED.format("IN")),
    "c07_price_on_ingest": Query(price_on_ingest, PRICE_ON_INGEST),
    "c08_running_stock": Query(running_stock, RUNNING_STOCK),
    "c09_ledger_from_sources": Query(ledger_from_sources, LEDGER_FROM_SOURCES),
    "c10_generated_column": Query(generated_column, GENERATED_COLUMN),
    "c11_defaults_and_audit": Query(defaults_and_audit, DEFAULTS_AND_AUDIT),
    "c12_record_sales": Query(record_sales, RECORD_SALES),
    "c12_record_sales_as_of": Query(record_sales_as_of, RECORD_SALES_AS_OF),
    "c12_rejected_sales": Query(rejected_sales, REJECTED_SALES),
    "c13_add_items": Query(add_items, ADD_ITEMS),
    "c14_derive_payments": Query(derive_payments, DERIVE_PAYMENTS),
    "c15_rental_batch": Query(rental_batch, RENTAL_BATCH),
    "c16_match_pairs": Query(match_pairs, MATCH_PAIRS),
    "c17_seeded_rows": Query(seeded_rows, SEEDED_ROWS),
    "c18_full_grid": Query(priced_pairs, PRICED_PAIRS),
    "c19_partitioned_sink": Query(partitioned_sink, PARTITIONED_SINK),
}
