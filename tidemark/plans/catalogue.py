"""Registered queries and the SQL that gives the same rows from the base tables.

Each query derives change events from the whole base tables, sends them through
the library, and returns a frame.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import json_text
from tidemark.functions.changes import encode_changes, tombstones
from tidemark.functions.decimals import decode_scaled_decimal
from tidemark.operators import cleanse, facts, raw, reconcile, rollup, validity
from tidemark.operators.expectations import QUARANTINE, Rule
from tidemark.operators.keys import assign_keys
from tidemark.operators.pending import Bound
from tidemark.operators.running import running, top_of_groups
from tidemark.operators.sessions import Sessions
from tidemark.plans import replay
from tidemark.plans.retail import current_datasets, incremental_datasets, retail_datasets
from tidemark.plans.retail_sql import retail_sql_datasets
from tidemark.session import batch_settings, own_session, scratch_dir, short_shuffles
from tidemark.sources import bus, flat_files
from tidemark.sources.tables import table_stream
from tidemark.streaming import files
from tidemark.streaming.lake import BOUNDED, MERGED, Dataset, Lake

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str


CATALOGUE: dict[str, Entry] = {}


def _register(sql: str):
    def add(run: Query) -> Query:
        CATALOGUE[run.__name__] = Entry(run, sql)
        return run

    return add


# -- shared pieces ---------------------------------------------------------

# All columns of a customer, with the decimals decoded.
_CUSTOMER = """
    c_custkey AS customer_id, 'T-' || c_custkey AS tax_id, 'C' || c_custkey % 7 AS tax_code,
    c_name AS customer_name, n_name AS state, n_name || ' City' || c_custkey % 11 AS city,
    lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postcode,
    'Street ' || c_custkey % 101 AS street, CAST(c_custkey % 300 AS VARCHAR) AS number,
    'U' || c_custkey % 9 AS unit, r_name AS region, r_name || '/' || n_name AS district,
    CAST(c_nationkey * -1.5 AS DECIMAL(10,6)) AS lon, CAST(c_nationkey * 0.5 AS DECIMAL(10,6)) AS lat,
    'Ship to ' || c_custkey || ', ' || n_name AS ship_to_address,
    1534928698 + c_custkey AS valid_from,
    CASE WHEN c_acctbal < 0 THEN 1634928698 + c_custkey END AS valid_to,
    CAST(c_acctbal AS DECIMAL(18,2)) AS units_purchased, c_mktsegment AS loyalty_segment
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

_SALES_COLUMNS = ["order_number", "customer_id", "order_datetime", "product_id", "unit_price", "quantity"]

_LINES = """
lines AS (
  SELECT o_custkey AS customer_id, c_name AS customer_name,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_datetime,
         CAST(o_orderdate AS DATE) AS order_date,
         l_orderkey AS order_number,
         CAST(l_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         CAST(floor(l_extendedprice) AS INTEGER) AS unit_price,
         CAST(floor(l_quantity) AS INTEGER) AS quantity,
         l_linenumber, l_partkey, l_discount
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
)"""

_KEYS = """
products AS (
  SELECT row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) AS product_key,
         CAST(p_partkey AS VARCHAR) AS product_id
  FROM part
),
customers AS (
  SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey AS customer_id
  FROM customer
)"""

_FACT = f"""
WITH {_LINES}, {_KEYS}
SELECT order_number, customer_key, product_key, order_date AS order_datetime,
       unit_price, quantity, CAST(unit_price AS BIGINT) * quantity AS total_price
FROM lines JOIN products USING (product_id) JOIN customers USING (customer_id)"""

_CUSTOMER_SALES = f"""
SELECT customer_key, product_key, CAST(sum(quantity) AS BIGINT) AS total_quantity,
       CAST(sum(total_price) AS BIGINT) AS sale_amount
FROM ({_FACT}) GROUP BY customer_key, product_key"""

_CLEANSED_ORDERS = f"""
WITH {_LINES}
SELECT customer_id, customer_name, order_datetime, order_number,
       count(*) OVER (PARTITION BY order_number) AS number_of_line_items,
       product_id, unit_price, quantity,
       'USD' AS curr, product_name, 'pcs' AS unit,
       CASE WHEN l_discount >= 0.05 THEN l_linenumber * 10 END AS promo_id,
       CASE WHEN l_discount >= 0.05 THEN 1 END AS promo_qty,
       CASE WHEN l_discount >= 0.05 THEN CAST(l_discount AS DECIMAL(3,2)) END AS promo_disc,
       CASE WHEN l_discount >= 0.05 THEN product_id END AS promo_item,
       clicked_items, promotions
FROM lines JOIN (
  SELECT order_number, string_agg(clicked, ';' ORDER BY clicked) AS clicked_items,
         coalesce(string_agg(promoted, ';' ORDER BY promoted), '') AS promotions
  FROM (SELECT order_number, product_name || '|' || l_linenumber AS clicked,
               CASE WHEN l_discount >= 0.09
                    THEN l_linenumber * 10 || '|1|' || CAST(l_discount AS DECIMAL(3,2)) || '|' || product_id
               END AS promoted
        FROM lines) GROUP BY order_number) USING (order_number)"""


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return raw.as_text(replay.order_messages(spark, folder))


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return cleanse.cleanse_customers(raw.as_text(replay.customer_messages(spark, folder)))


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return cleanse.cleanse_products(raw.as_text(replay.product_messages(spark, folder)))


def _sales_lines(spark: SparkSession, folder: str) -> DataFrame:
    return cleanse.cleanse_orders(_orders(spark, folder), columns=_SALES_COLUMNS)


def _dim_products(spark: SparkSession, folder: str) -> DataFrame:
    return assign_keys(_products(spark, folder), "product_key", order_by=["product_id"])


def _dim_customers(spark: SparkSession, folder: str) -> DataFrame:
    return assign_keys(_customers(spark, folder), "customer_key", order_by=["customer_id"])


def _fine(spark: SparkSession) -> SparkSession:
    """A session of small shuffle partitions, however large the tables."""
    return own_session(spark, batch_settings(spark))


def _staged(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` worked out once and written, for what reads them more than once."""
    path = scratch_dir(rows.sparkSession, label)
    rows.write.parquet(path, compression="zstd")
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _line_columns(lines: DataFrame) -> DataFrame:
    product = F.col("ordered_products")
    return lines.select(
        "customer_id",
        "customer_name",
        "order_datetime",
        "order_number",
        "number_of_line_items",
        "product_id",
        "unit_price",
        "quantity",
        product["curr"].alias("curr"),
        product["name"].alias("product_name"),
        product["unit"].alias("unit"),
        "ordered_products.promotion_info.*",
        _sorted_text("clicked_items", lambda x: F.array_join(x, "|")).alias("clicked_items"),
        _sorted_text(
            "promo_info",
            lambda x: F.concat_ws("|", x["promo_id"], x["promo_qty"], x["promo_disc"], x["promo_item"]),
        ).alias("promotions"),
    )


def _sorted_text(name: str, item) -> Column:
    """An array's items as texts, in an order that both engines agree on."""
    return F.array_join(F.array_sort(F.transform(name, item)), ";")


# -- raw layer -------------------------------------------------------------


@_register(
    """
    SELECT 'retail.public.sales_orders' AS topic, o_orderkey AS order_number,
           o_custkey AS customer_id, c_name AS customer_name, count(*) AS number_of_line_items
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    GROUP BY o_orderkey, o_custkey, c_name
    """
)
def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("key")
    return _orders(spark, folder).select(
        "topic",
        F.get_json_object(key, "$.payload.order_number").cast("bigint").alias("order_number"),
        F.get_json_object(key, "$.payload.customer_id").cast("bigint").alias("customer_id"),
        F.get_json_object("value", "$.payload.after.customer_name").alias("customer_name"),
        F.get_json_object("value", "$.payload.after.number_of_line_items")
        .cast("bigint")
        .alias("number_of_line_items"),
    )


@_register(
    """
    SELECT 'retail.public.customers' AS topic, c_custkey AS customer_id, c_name AS customer_name
    FROM customer
    """
)
def captured_topic(spark: SparkSession, folder: str) -> DataFrame:
    """One topic picked out of stored messages of three."""
    path = scratch_dir(spark, "bus")
    for make in (replay.order_messages, replay.customer_messages, replay.product_messages):
        make(spark, folder).write.mode("append").parquet(path)
    messages = spark.read.parquet(path)
    rows = raw.as_text(raw.only_topic(messages, bus.topic_name("customers")))
    number = F.get_json_object("key", "$.payload.customer_id").cast("bigint")
    name = F.get_json_object("value", "$.payload.after.customer_name")
    return rows.select("topic", number.alias("customer_id"), name.alias("customer_name"))


@_register(
    """
    SELECT o_orderkey AS order_number, 'retail.public.sales_orders' AS topic
    FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    ORDER BY o_orderkey LIMIT 5
    """
)
def raw_preview(spark: SparkSession, folder: str) -> DataFrame:
    view = f"orders_{uuid.uuid4().hex}"
    _orders(spark, folder).createOrReplaceTempView(view)
    rows = spark.sql(
        f"""
        SELECT CAST(get_json_object(key, '$.payload.order_number') AS BIGINT) AS order_number,
               topic
        FROM {view} ORDER BY order_number LIMIT 5
        """
    )
    spark.catalog.dropTempView(view)
    return rows


@_register(
    """
    SELECT l_orderkey AS order_number, o_custkey AS customer_id, c_name AS customer_name,
           CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR) AS order_datetime,
           count(*) AS number_of_line_items, CAST(count(*) AS INTEGER) AS products
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    GROUP BY l_orderkey, o_custkey, c_name, o_orderdate
    """
)
def after_image_orders(spark: SparkSession, folder: str) -> DataFrame:
    row = json_text.after_image(F.col("value"))
    images = _orders(spark, folder).select(row.alias("row"))
    text = {name: json_text.json_field(F.col("row"), name) for name in schemas.ORDER.names}
    return images.select(
        text["order_number"].cast("bigint").alias("order_number"),
        text["customer_id"].cast("bigint").alias("customer_id"),
        text["customer_name"].alias("customer_name"),
        text["order_datetime"].alias("order_datetime"),
        text["number_of_line_items"].cast("bigint").alias("number_of_line_items"),
        F.json_array_length(text["ordered_products"]).alias("products"),
    )


# -- cleansed layer --------------------------------------------------------


@_register(_CLEANSED_ORDERS)
def cleansed_orders_nested(spark: SparkSession, folder: str) -> DataFrame:
    return _line_columns(cleanse.cleanse_orders(_orders(spark, folder)))


@_register(_CLEANSED_ORDERS)
def cleansed_orders_strip(spark: SparkSession, folder: str) -> DataFrame:
    return _line_columns(cleanse.cleanse_orders(_orders(spark, folder), mode="strip"))


def _decoded_customers(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "valid_from": decode_scaled_decimal(F.col("valid_from"), 0).cast("bigint"),
            "valid_to": decode_scaled_decimal(F.col("valid_to"), 0).cast("bigint"),
            "units_purchased": decode_scaled_decimal(F.col("units_purchased"), 2).cast("decimal(18,2)"),
        }
    )


@_register("SELECT" + _CUSTOMER)
def cleansed_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _decoded_customers(_customers(spark, folder))


@_register(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category,
           p_name AS product_name, CAST(p_partkey + 2.0e12 AS DOUBLE) AS ean13,
           lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') AS ean5, 'pcs' AS product_unit
    FROM part
    """
)
def cleansed_products(spark: SparkSession, folder: str) -> DataFrame:
    return _products(spark, folder).drop("sales_price")


@_register(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id,
           CAST(p_retailprice AS DECIMAL(18,2)) AS sales_price
    FROM part
    """
)
def decoded_prices(spark: SparkSession, folder: str) -> DataFrame:
    price = decode_scaled_decimal(F.col("sales_price"), 2).cast("decimal(18,2)")
    return _products(spark, folder).select("product_id", price.alias("sales_price"))


@_register(
    """
    SELECT c_custkey AS customer_id, 1634928698 + c_custkey AS valid_to
    FROM customer WHERE c_acctbal < 0
    """
)
def closed_customers(spark: SparkSession, folder: str) -> DataFrame:
    closed = _customers(spark, folder).where(F.col("valid_to").isNotNull())
    end = decode_scaled_decimal(F.col("valid_to"), 0).cast("bigint")
    return closed.select("customer_id", end.alias("valid_to"))


def _customer_history(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer created, one segment renamed, accounts in debt deleted."""
    rows = replay.customer_rows(spark, folder)
    key, topic = ["customer_id", "valid_from"], bus.topic_name("customers")
    renamed = rows.where(F.col("loyalty_segment") == "BUILDING").withColumn(
        "customer_name", F.concat("customer_name", F.lit(" & Co"))
    )
    gone = rows.where(F.col("valid_to").isNotNull())
    return (
        encode_changes(rows, key, op="c", topic=topic)
        .union(encode_changes(renamed, key, op="u", topic=topic))
        .union(encode_changes(gone, key, op="d", topic=topic))
        .union(tombstones(gone, key, topic=topic))
    )


_HISTORY = """
    SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer
    UNION ALL
    SELECT c_custkey, c_name || ' & Co' FROM customer WHERE c_mktsegment = 'BUILDING'
"""


# The same with all columns.
_HISTORY_ROWS = f"""
    SELECT {_CUSTOMER}
    UNION ALL
    SELECT * REPLACE (customer_name || ' & Co' AS customer_name)
    FROM (SELECT {_CUSTOMER} WHERE c_mktsegment = 'BUILDING')
"""
_NULL_ROWS = f"""
    UNION ALL
    SELECT {", ".join(["NULL"] * len(schemas.CUSTOMER))}
    FROM customer, (VALUES ('delete'), ('tombstone')) WHERE c_acctbal < 0
"""


@_register(_HISTORY_ROWS)
def customer_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Updates add a row; deletes and tombstones add none."""
    messages = raw.as_text(_customer_history(spark, folder))
    return _decoded_customers(cleanse.cleanse_customers(messages))


@_register(_HISTORY_ROWS + _NULL_ROWS)
def customer_versions_with_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Deletes and tombstones as all-NULL rows."""
    messages = raw.as_text(_customer_history(spark, folder))
    return _decoded_customers(cleanse.cleanse_customers(messages, keep_null_rows=True))


# -- surrogate keys --------------------------------------------------------


@_register(
    """
    SELECT row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) AS product_key,
           CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category,
           p_name AS product_name, CAST(p_retailprice AS DECIMAL(18,2)) AS sales_price,
           CAST(p_partkey + 2.0e12 AS DOUBLE) AS ean13,
           lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') AS ean5, 'pcs' AS product_unit
    FROM part
    """
)
def dim_products(spark: SparkSession, folder: str) -> DataFrame:
    price = decode_scaled_decimal(F.col("sales_price"), 2).cast("decimal(18,2)")
    return _dim_products(spark, folder).withColumn("sales_price", price)


@_register("SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key," + _CUSTOMER)
def dim_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _decoded_customers(_dim_customers(spark, folder))


@_register(
    f"""
    WITH {_LINES}
    SELECT row_number() OVER (
             ORDER BY order_number, product_id, unit_price, quantity) AS id,
           order_number, product_id, unit_price, quantity
    FROM lines
    """
)
def identity_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    order = ["order_number", "product_id", "unit_price", "quantity"]
    lines = cleanse.cleanse_orders(_orders(spark, folder), columns=order)
    return assign_keys(lines, "id", order_by=order)


@_register("SELECT row_number() OVER () AS id FROM lineitem")
def identity_arrival_order(spark: SparkSession, folder: str) -> DataFrame:
    """Keys in input order: gap-free, but which line gets which is open."""
    lines = cleanse.cleanse_orders(_orders(spark, folder), columns=["order_number"])
    return assign_keys(lines, "id").select("id")


# -- gold layer ------------------------------------------------------------


@_register(_FACT)
def fact_sales_orders(spark: SparkSession, folder: str) -> DataFrame:
    return facts.fact_sales_orders(
        _sales_lines(spark, folder), _dim_products(spark, folder), _dim_customers(spark, folder)
    )


@_register(_FACT)
def fact_sales_orders_salted(spark: SparkSession, folder: str) -> DataFrame:
    """The joins as they run on streams: every key spread over several tasks."""
    spark = _fine(spark)
    return facts.fact_sales_orders(
        _sales_lines(spark, folder),
        _dim_products(spark, folder),
        _dim_customers(spark, folder),
        product_salting=facts.Salting(2, [(8, ["0", "1", "2"])]),
        customer_salting=facts.Salting(3, [(4, [0, 1])]),
    )


@_register(_FACT.replace("order_date AS order_datetime", "order_date"))
def fact_sales_orders_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The fact as a SELECT over views."""
    views = {
        "lines": _sales_lines(spark, folder),
        "products": _dim_products(spark, folder),
        "customers": _dim_customers(spark, folder),
    }
    tag = uuid.uuid4().hex
    for name, frame in views.items():
        frame.createOrReplaceTempView(f"{name}_{tag}")
    rows = spark.sql(
        f"""
        SELECT order_number, customer_key, product_key, to_date(order_datetime) AS order_date,
               unit_price, quantity, unit_price * CAST(quantity AS BIGINT) AS total_price
        FROM lines_{tag} JOIN products_{tag} USING (product_id) JOIN customers_{tag} USING (customer_id)
        """
    )
    for name in views:
        spark.catalog.dropTempView(f"{name}_{tag}")
    return rows


@_register(
    f"""
    WITH {_LINES}
    SELECT product_id, customer_id, CAST(sum(quantity) AS BIGINT) AS total_quantity,
           CAST(sum(CAST(unit_price AS BIGINT) * quantity) AS BIGINT) AS sale_amount
    FROM lines GROUP BY product_id, customer_id
    """
)
def fact_customer_sales(spark: SparkSession, folder: str) -> DataFrame:
    return facts.fact_customer_sales(
        _sales_lines(spark, folder), _products(spark, folder), _customers(spark, folder)
    )


@_register(
    f"""
    WITH {_LINES}, history AS ({_HISTORY})
    SELECT product_id, customer_id, CAST(sum(quantity) AS BIGINT) AS total_quantity,
           CAST(sum(CAST(unit_price AS BIGINT) * quantity) AS BIGINT) AS sale_amount
    FROM lines JOIN history USING (customer_id) GROUP BY product_id, customer_id
    """
)
def fact_customer_sales_versions(spark: SparkSession, folder: str) -> DataFrame:
    """A customer with two versions counts twice, as in the three-way join."""
    history = cleanse.cleanse_customers(raw.as_text(_customer_history(spark, folder)))
    return facts.fact_customer_sales(
        _sales_lines(spark, folder), _products(spark, folder), history
    )


@_register(_CUSTOMER_SALES)
def customer_sales(spark: SparkSession, folder: str) -> DataFrame:
    return facts.customer_sales(fact_sales_orders(spark, folder))


# -- flat files ------------------------------------------------------------


@_register(
    """
    SELECT CAST(l_orderkey AS INTEGER) AS order_number, CAST(o_custkey AS INTEGER) AS customer_id,
           CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR) AS order_datetime,
           c_name AS customer_name, CAST(count(*) AS SMALLINT) AS number_of_line_items,
           CAST(count(*) AS INTEGER) AS products
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    GROUP BY l_orderkey, o_custkey, c_name, o_orderdate
    """
)
def ingest_json_typed(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "json")
    replay.order_rows(spark, folder).write.json(path)
    rows = flat_files.read_json_lines(spark, path, schemas.ORDER_FILE)
    return rows.select(
        "order_number",
        "customer_id",
        "order_datetime",
        "customer_name",
        "number_of_line_items",
        F.json_array_length("ordered_products").alias("products"),
    )


@_register(
    f"""
    SELECT * REPLACE (CAST(customer_id AS INTEGER) AS customer_id, CAST(lon AS DOUBLE) AS lon,
                      CAST(lat AS DOUBLE) AS lat, n_regionkey AS loyalty_segment)
    FROM (SELECT {_CUSTOMER}) c JOIN (SELECT n_name AS state, n_regionkey FROM nation) USING (state)
    """.replace("SELECT * REPLACE", "SELECT * EXCLUDE (n_regionkey) REPLACE")
)
def ingest_csv_typed(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    region = replay.table(spark, folder, "nation").select(
        F.col("n_name").alias("state"), F.col("n_regionkey")
    )
    source = replay.customer_rows(spark, folder).join(region, "state")
    written = source.select(
        *[
            decode_scaled_decimal(F.col(f.name), 2).alias(f.name)
            if f.name in ("valid_from", "valid_to", "units_purchased")
            else F.col("n_regionkey" if f.name == "loyalty_segment" else f.name).alias(f.name)
            for f in schemas.CUSTOMER_FILE.fields
        ]
    )
    written.write.option("header", True).csv(path)
    rows = flat_files.read_csv(spark, path, schemas.CUSTOMER_FILE)
    kinds = {"valid_from": "bigint", "valid_to": "bigint", "units_purchased": "decimal(18,2)"}
    return rows.withColumns({name: F.col(name).cast(kind) for name, kind in kinds.items()})


@_register(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category,
           p_name AS product_name, CAST(p_retailprice AS DECIMAL(18,2)) AS sales_price,
           CAST(p_partkey + 2.0e12 AS DOUBLE) AS ean13,
           lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') AS ean5, 'pcs' AS product_unit
    FROM part
    """
)
def ingest_csv_semicolon(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    price = decode_scaled_decimal(F.col("sales_price"), 2)
    written = replay.product_rows(spark, folder).withColumn("sales_price", price)
    written.write.option("header", True).option("sep", ";").csv(path)
    rows = flat_files.read_csv(spark, path, schemas.PRODUCT_FILE, delimiter=";")
    return rows.withColumn("sales_price", F.col("sales_price").cast("decimal(18,2)"))


# -- streams ---------------------------------------------------------------


class _Replay:
    """A lake fed from message files in the scratch folder.

    Messages are made in ``maker``, whose shuffles go once a file is written.
    """

    def __init__(self, spark: SparkSession, folder: str, columns=("key", "value")):
        self.spark, self.folder, self.columns = spark, folder, list(columns)
        self.maker = short_shuffles(spark)
        self.schema = schemas.pick(schemas.BUS_MESSAGE, columns)
        self.root = scratch_dir(spark, "lake")
        self.database = f"tidemark_{uuid.uuid4().hex}"
        self.paths = {t: f"{self.root}/bus/{t}" for t in bus.CAPTURED_TABLES}
        # An empty first file lets a stream start before its messages come.
        empty = spark.createDataFrame([], self.schema)
        for table in bus.CAPTURED_TABLES:
            self.send(table, empty)

    def send(self, table: str, messages: DataFrame) -> None:
        messages.select(*self.columns).write.mode("append").parquet(self.paths[table], compression="zstd")

    def send_all(self) -> None:
        self.send("sales_orders", replay.order_messages(self.maker, self.folder))
        self.send("customers", replay.customer_messages(self.maker, self.folder))
        self.send("products", replay.product_messages(self.maker, self.folder))

    def source(self, table: str, *, expired: bool = False):
        """The messages of a table; none of them if the bus has dropped them."""
        kept = F.lit(not expired)
        path = self.paths[table]
        schema = self.schema
        return lambda spark: bus.message_stream(
            spark, "parquet", {}, path=path, schema=schema
        ).where(kept)

    def retail(self, *, expired: bool = False, datasets=retail_datasets, more=(), **options) -> Lake:
        sources = {t: self.source(t, expired=expired) for t in bus.CAPTURED_TABLES}
        return Lake(
            self.spark, f"{self.root}/lake", self.database, [*datasets(sources, **options), *more]
        )

    def close(self) -> None:
        """Drop the catalog entries; frames that are already read keep their files.

        What the returned frame may still read stays under ``root``, which
        belongs to the owner of the scratch folder; messages and checkpoints go.
        """
        files.delete(self.spark, f"{self.root}/bus")
        files.delete(self.spark, f"{self.root}/lake/checkpoints")
        files.delete(self.spark, f"{self.root}/lake/pending")
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")


@_register(_FACT)
def fact_sales_orders_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Raw, cleansed, dimension and fact tables, each a stream from the last."""
    run = _Replay(spark, folder)
    run.send_all()
    lake = run.retail()
    lake.update()
    rows = lake.read("fact_sales_orders")
    run.close()
    return rows


@_register(_CUSTOMER_SALES)
def customer_sales_lake(spark: SparkSession, folder: str) -> DataFrame:
    """The recomputed table that follows the streams."""
    run = _Replay(spark, folder)
    run.send_all()
    lake = run.retail()
    lake.update()
    rows = lake.read("customer_sales")
    run.close()
    return rows


@_register(_FACT)
def fact_late_dimensions_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines arrive first and wait in the join for their dimensions."""
    run = _Replay(spark, folder)
    lake = run.retail()
    run.send("sales_orders", replay.order_messages(run.maker, folder))
    lake.update()
    run.send("products", replay.product_messages(run.maker, folder))
    run.send("customers", replay.customer_messages(run.maker, folder))
    lake.update()
    rows = lake.read("fact_sales_orders")
    run.close()
    return rows


@_register(
    f"""
    WITH {_LINES}, {_KEYS},
    versions AS (
      SELECT product_id, product_key FROM products
      UNION ALL
      SELECT CAST(p_partkey AS VARCHAR),
             (SELECT count(*) FROM part)
             + row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR))
      FROM part WHERE p_size > 40
    )
    SELECT order_number, customer_key, product_key, order_date AS order_datetime,
           unit_price, quantity, CAST(unit_price AS BIGINT) * quantity AS total_price
    FROM lines JOIN versions USING (product_id) JOIN customers USING (customer_id)
    """
)
def fact_product_versions_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A later version of a product gives its order lines again, with a new key."""
    run = _Replay(spark, folder)
    lake = run.retail()
    run.send_all()
    lake.update()
    large = replay.table(run.maker, folder, "part").where("p_size > 40")
    large = large.select(F.col("p_partkey").cast("string").alias("product_id"))
    changed = replay.product_rows(run.maker, folder).join(large, "product_id", "left_semi")
    run.send(
        "products",
        encode_changes(changed, ["product_id"], op="u", topic=bus.topic_name("products")),
    )
    lake.update()
    rows = lake.read("fact_sales_orders")
    run.close()
    return rows


@_register(
    """
    SELECT l_orderkey AS order_number, CAST(count(*) AS INTEGER) AS products
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey
    """
)
def streaming_table_sql(spark: SparkSession, folder: str) -> DataFrame:
    """A streaming table defined by a SELECT over a view of the message stream."""
    run = _Replay(spark, folder)
    run.send("sales_orders", replay.order_messages(run.maker, folder))
    datasets = [
        Dataset("orders_stream", run.source("sales_orders"), temporary=True),
        Dataset(
            "orders_text",
            "SELECT CAST(key AS STRING) AS key, CAST(value AS STRING) AS value FROM orders_stream",
            ["orders_stream"],
        ),
    ]
    lake = Lake(spark, f"{run.root}/lake", run.database, datasets)
    lake.update()
    rows = lake.read("orders_text")
    run.close()
    products = json_text.json_field(json_text.after_image(F.col("value")), "ordered_products")
    return rows.select(
        F.get_json_object("key", "$.payload.order_number").cast("bigint").alias("order_number"),
        F.json_array_length(products).alias("products"),
    )


@_register(
    f"""
    WITH {_LINES}
    SELECT 'sales_orders_raw' AS dataset, count(DISTINCT order_number) AS row_count FROM lines
    UNION ALL SELECT 'customers_raw', CAST(0 AS BIGINT)
    UNION ALL SELECT 'products_raw', (SELECT count(*) FROM part)
    UNION ALL SELECT 'sales_orders_cleansed', count(*) FROM lines
    UNION ALL SELECT 'dim_products', (SELECT count(*) FROM part)
    UNION ALL SELECT 'dim_customers', CAST(0 AS BIGINT)
    UNION ALL SELECT 'fact_sales_orders', CAST(0 AS BIGINT)
    """
)
def refresh_guard(spark: SparkSession, folder: str) -> DataFrame:
    """A full refresh after the bus has dropped its old messages.

    Guarded raw tables keep their rows and what follows is built again from
    them; raw customers are not guarded and start over with an empty bus.
    """
    run = _Replay(spark, folder)
    run.send_all()
    run.retail().update()
    lake = run.retail(expired=True)
    lake.refresh(full=True)
    names = [
        "sales_orders_raw",
        "customers_raw",
        "products_raw",
        "sales_orders_cleansed",
        "dim_products",
        "dim_customers",
        "fact_sales_orders",
    ]
    counts = [
        lake.read(n).select(F.lit(n).alias("dataset")).groupBy("dataset").count() for n in names
    ]
    found = counts[0]
    for more in counts[1:]:
        found = found.union(more)
    every = spark.createDataFrame([(n,) for n in names], "dataset string")
    rows = every.join(found, "dataset", "left").select(
        "dataset", F.coalesce("count", F.lit(0).cast("bigint")).alias("row_count")
    )
    run.close()
    return rows


_CUSTOMER_TOTALS = f"""
    WITH {_LINES}
    SELECT product_id, customer_id, CAST(sum(quantity) AS BIGINT) AS total_quantity,
           CAST(sum(CAST(unit_price AS BIGINT) * quantity) AS BIGINT) AS sale_amount
    FROM lines GROUP BY product_id, customer_id
"""


@_register(_CUSTOMER_TOTALS)
def fact_customer_sales_lake(spark: SparkSession, folder: str) -> DataFrame:
    """The recomputed table over the three streams' tables."""
    run = _Replay(spark, folder)
    run.send_all()
    lake = run.retail(output_partitions=4)
    lake.update()
    rows = lake.read("fact_customer_sales")
    run.close()
    return rows


def _history_lake(spark: SparkSession, folder: str, keep_null_rows: bool) -> DataFrame:
    run = _Replay(spark, folder)
    run.send("customers", _customer_history(run.maker, folder))
    lake = run.retail(keep_null_rows=keep_null_rows)
    lake.update()
    rows = _decoded_customers(lake.read("customers_cleansed"))
    run.close()
    return rows


@_register(_HISTORY_ROWS)
def customer_history_lake(spark: SparkSession, folder: str) -> DataFrame:
    """Creates, updates, deletes and tombstones through the lake."""
    return _history_lake(spark, folder, keep_null_rows=False)


@_register(_HISTORY_ROWS + _NULL_ROWS)
def customer_history_lake_with_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return _history_lake(spark, folder, keep_null_rows=True)


@_register(_CUSTOMER_SALES)
def gold_sql_lake(spark: SparkSession, folder: str) -> DataFrame:
    """Dimensions, the streaming fact and the aggregate, each as a SELECT."""
    run = _Replay(spark, folder)
    run.send_all()
    lake = run.retail(datasets=retail_sql_datasets)
    lake.update()
    rows = lake.read("customer_sales")
    run.close()
    return rows


@_register(_CUSTOMER_TOTALS)
def external_tables_lake(spark: SparkSession, folder: str) -> DataFrame:
    """One lake keeps the raw tables; a second one reads them as another pipeline's."""
    run = _Replay(spark, folder)
    run.send_all()
    sources = {t: run.source(t) for t in bus.CAPTURED_TABLES}
    own, others = [], []
    for dataset in retail_datasets(sources):
        (others if dataset.name.endswith("_raw") else own).append(dataset)
    Lake(spark, f"{run.root}/bronze", run.database, others).update()
    views = [
        Dataset(d.name, table_stream(f"{run.database}.{d.name}"), temporary=True) for d in others
    ]
    silver = Lake(spark, f"{run.root}/lake", f"{run.database}_silver", views + own)
    silver.update()
    rows = silver.read("fact_customer_sales")
    run.close()
    spark.sql(f"DROP DATABASE IF EXISTS `{run.database}_silver` CASCADE")
    return rows


@_register(
    """
    SELECT * FROM (VALUES
      ('sales_orders_raw', '', NULL, 'false', '1 seconds'),
      ('customers_raw', '', NULL, 'true', '1 seconds'),
      ('products_raw', '', NULL, 'false', '1 seconds'),
      ('sales_orders_cleansed', 'Order lines with typed columns', NULL, 'true', '60 seconds'),
      ('customers_cleansed', 'Customer versions with typed columns', NULL, 'true', '60 seconds'),
      ('products_cleansed', 'Product versions with typed columns', NULL, 'true', '60 seconds'),
      ('dim_products', 'Product dimension', 'gold', 'true', '60 seconds'),
      ('dim_customers', 'Customer dimension', 'gold', 'true', '60 seconds'),
      ('fact_sales_orders', 'Order lines by customer and product key', 'gold', 'true', '60 seconds'),
      ('fact_customer_sales', 'Sales by product and customer', 'gold', 'true', '60 seconds'),
      ('customer_sales', 'Sales by customer and product key', 'gold', 'true', '60 seconds')
    ) t(dataset, comment, quality, reset_allowed, trigger_interval)
    JOIN (
      SELECT 'sales_orders_raw' AS dataset, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS row_count, 2 AS n_columns
      UNION ALL SELECT 'customers_raw', (SELECT count(*) FROM customer), 2
      UNION ALL SELECT 'products_raw', (SELECT count(*) FROM part), 2
      UNION ALL SELECT 'sales_orders_cleansed', (SELECT count(*) FROM lineitem), 11
      UNION ALL SELECT 'customers_cleansed', (SELECT count(*) FROM customer), 19
      UNION ALL SELECT 'products_cleansed', (SELECT count(*) FROM part), 7
      UNION ALL SELECT 'dim_products', (SELECT count(*) FROM part), 8
      UNION ALL SELECT 'dim_customers', (SELECT count(*) FROM customer), 20
      UNION ALL SELECT 'fact_sales_orders', (SELECT count(*) FROM lineitem), 7
      UNION ALL SELECT 'fact_customer_sales',
        (SELECT count(*) FROM (SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)), 4
      UNION ALL SELECT 'customer_sales',
        (SELECT count(*) FROM (SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)), 4
    ) USING (dataset)
    """
)
def dataset_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """What the catalog says of each table of the lake, with its number of rows."""
    run = _Replay(spark, folder)
    run.send_all()
    lake = run.retail()
    lake.update()
    found = None
    for name in lake.datasets:
        table = lake.table_name(name)
        told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        text = lambda value: F.lit(value).cast("string")
        row = lake.read(name).agg(F.count(F.lit(1)).alias("row_count")).select(
            text(name).alias("dataset"),
            text(told.get("Comment", "")).alias("comment"),
            text(properties.get("quality")).alias("quality"),
            text(properties["reset.allowed"]).alias("reset_allowed"),
            text(properties["trigger.interval"]).alias("trigger_interval"),
            "row_count",
            F.lit(len(lake.read(name).columns)).alias("n_columns"),
        )
        found = row if found is None else found.union(row)
    run.close()
    return found


@_register(
    f"""
    SELECT {_CUSTOMER}
    UNION ALL SELECT 0, NULL, NULL, 'John smith', 'MI', {", ".join(["NULL"] * (len(schemas.CUSTOMER) - 5))}
    """
)
def literal_row_lake(spark: SparkSession, folder: str) -> DataFrame:
    """A running lake gets the customers, and then one row written out by hand."""
    run = _Replay(spark, folder)
    lake = run.retail()
    queries = {q.name: q for q in lake.start()}
    try:
        run.send("customers", replay.customer_messages(run.maker, folder))
        row = spark.sql("SELECT 0L AS customer_id, 'John smith' AS customer_name, 'MI' AS state")
        run.send("customers", encode_changes(row, ["customer_id"], topic=bus.topic_name("customers")))
        for name in ("customers_raw", "customers_cleansed"):
            queries[name].processAllAvailable()
        rows = _decoded_customers(lake.read("customers_cleansed"))
    finally:
        for query in queries.values():
            query.stop()
    run.close()
    return rows


@_register(_CUSTOMER_TOTALS)
def cached_lake_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table of the lake kept in memory while it is shown, then let go."""
    rows = fact_customer_sales_lake(spark, folder)
    kept = rows.cache()
    kept.limit(5).collect()
    kept.unpersist()
    return rows


# -- state, validity, rules ------------------------------------------------


def _placed(messages: DataFrame, offset: Column) -> DataFrame:
    """Messages with the place on the bus that a connector would report."""
    return messages.withColumns(
        {
            "partition": F.lit(0),
            "offset": offset,
            "timestamp": F.timestamp_seconds(F.lit(1_700_000_000) + offset),
        }
    )


def _customer_offset(step: int) -> Column:
    """Offsets in the order of a customer's changes."""
    number = F.get_json_object(F.col("key").cast("string"), "$.payload.customer_id")
    return number.cast("bigint") * 4 + step


@_register("SELECT" + _CUSTOMER.replace("c_name AS customer_name", "c_name || CASE WHEN c_mktsegment = 'BUILDING' THEN ' & Co' ELSE '' END AS customer_name") + " WHERE c_acctbal >= 0")
def current_customers_lake(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as they are now, merged from creates, updates, deletes and tombstones.

    The renaming of a customer comes after the delete that follows it, and
    everybody's creation once more at the end.
    """
    run = _Replay(spark, folder, ["key", "value", "offset"])
    rows = replay.customer_rows(run.maker, folder)
    key, topic = ["customer_id", "valid_from"], bus.topic_name("customers")
    renamed = rows.where(F.col("loyalty_segment") == "BUILDING").withColumn(
        "customer_name", F.concat("customer_name", F.lit(" & Co"))
    )
    gone = rows.where(F.col("valid_to").isNotNull())
    created = _placed(encode_changes(rows, key, op="c", topic=topic), _customer_offset(0))
    updated = _placed(encode_changes(renamed, key, op="u", topic=topic), _customer_offset(1))
    deleted = _placed(encode_changes(gone, key, op="d", topic=topic), _customer_offset(2))
    emptied = _placed(tombstones(gone, key, topic=topic), _customer_offset(3))
    datasets = [d for d in current_datasets(buckets=16) if d.name == "current_customers"]
    for messages in (created, deleted, updated, emptied, created):
        run.send("customers", messages)
        lake = run.retail(datasets=lambda sources: retail_datasets(sources)[1:2], more=datasets)
        lake.update()
    rows = _decoded_customers(lake.read("current_customers"))
    run.close()
    return rows


_VERSIONS = """
customer_versions AS (
  SELECT c_custkey AS customer_id, CAST(NULL AS BIGINT) AS valid_from,
         CAST(epoch(DATE '1993-01-01') AS BIGINT) + c_custkey % 1000 * 86400 AS valid_to FROM customer
  UNION ALL
  SELECT c_custkey, CAST(epoch(DATE '1993-01-01') AS BIGINT) + c_custkey % 1000 * 86400,
         CAST(epoch(DATE '1993-01-01') AS BIGINT) + (c_custkey % 1000 + 1 + c_custkey % 400) * 86400 FROM customer
  UNION ALL
  SELECT c_custkey, CAST(epoch(DATE '1993-01-01') AS BIGINT) + (c_custkey % 1000 + 1 + c_custkey % 400) * 86400, NULL
  FROM customer WHERE c_acctbal >= 0
),
product_versions AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(NULL AS BIGINT) AS valid_from,
         CAST(NULL AS BIGINT) AS valid_to FROM part WHERE p_size <= 25
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), NULL, CAST(epoch(DATE '1995-06-01') AS BIGINT) FROM part WHERE p_size > 25
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), CAST(epoch(DATE '1995-06-01') AS BIGINT), NULL FROM part WHERE p_size > 25
),
customers AS (
  SELECT row_number() OVER (ORDER BY customer_id, valid_from NULLS FIRST) AS customer_key, *
  FROM customer_versions
),
products AS (
  SELECT row_number() OVER (ORDER BY product_id, valid_from NULLS FIRST) AS product_key, *
  FROM product_versions
)"""


def _versions_of(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Dimensions with several versions: what each changed to, and since when."""
    day = lambda days: F.lit(725_846_400) + days * 86_400  # noqa: E731  (from 1993-01-01 on)
    never = F.lit(None).cast("bigint")
    key = F.col("customer_id")
    first, second = day(key % 1000), day(key % 1000 + 1 + key % 400)
    customers = _customers(spark, folder).select(
        "customer_id",
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(never.alias("valid_from"), first.alias("valid_to")),
                    # Its end is the start of the next version, or the close of the account.
                    F.struct(
                        first.alias("valid_from"),
                        F.when(F.col("valid_to").isNotNull(), second).alias("valid_to"),
                    ),
                    F.when(
                        F.col("valid_to").isNull(),
                        F.struct(second.alias("valid_from"), never.alias("valid_to")),
                    ),
                )
            )
        ).alias("v"),
    ).select("customer_id", "v.*")
    large = replay.table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), (F.col("p_size") > 25).alias("large")
    )
    changed = F.lit(801_964_800)  # 1995-06-01
    products = _products(spark, folder).join(large, "product_id").select(
        "product_id",
        F.explode(F.when(F.col("large"), F.array(never, changed)).otherwise(F.array(never))).alias("valid_from"),
        never.alias("valid_to"),
    )
    order = F.col("valid_from").asc_nulls_first()
    return (
        assign_keys(
            validity.successive(products, "product_id", "valid_from", "valid_to"),
            "product_key", order_by=["product_id", order],
        ),
        assign_keys(
            validity.successive(customers, "customer_id", "valid_from", "valid_to"),
            "customer_key", order_by=["customer_id", order],
        ),
    )


@_register(
    f"""
    WITH {_LINES}, {_VERSIONS}
    SELECT order_number, customer_key, product_key, order_date AS order_datetime,
           unit_price, quantity, CAST(unit_price AS BIGINT) * quantity AS total_price
    FROM (SELECT *, CAST(epoch(CAST(order_datetime AS TIMESTAMP)) AS BIGINT) AS ordered_at FROM lines) l
    JOIN products p ON p.product_id = l.product_id
      AND (p.valid_from IS NULL OR ordered_at >= p.valid_from) AND (p.valid_to IS NULL OR ordered_at < p.valid_to)
    JOIN customers c ON c.customer_id = l.customer_id
      AND (c.valid_from IS NULL OR ordered_at >= c.valid_from) AND (c.valid_to IS NULL OR ordered_at < c.valid_to)
    """
)
def fact_sales_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Each line with the one version of its product and customer that was valid when it was ordered."""
    lines = _staged(_sales_lines(spark, folder), "lines")
    lines = lines.withColumn("ordered_at", F.unix_timestamp("order_datetime"))
    products, customers = _versions_of(spark, folder)
    hot = facts.hot_keys(lines, ["product_id", "customer_id"], spark.sparkContext.defaultParallelism)
    hot = hot or {"product_id": [], "customer_id": []}
    return validity.fact_sales_as_of(
        lines,
        products,
        customers,
        product_salting=facts.Salting(1, hot["product_id"]),
        customer_salting=facts.Salting(1, hot["customer_id"]),
    )


@_register(
    f"""
    WITH {_LINES}, history AS ({_HISTORY}),
    versions AS (
      SELECT CAST(p_partkey AS VARCHAR) AS product_id, CASE WHEN p_size > 40 THEN 2 ELSE 1 END AS n FROM part
    )
    SELECT product_id, customer_id, CAST(sum(quantity * n) AS BIGINT) AS total_quantity,
           CAST(sum(CAST(unit_price AS BIGINT) * quantity * n) AS BIGINT) AS sale_amount
    FROM lines JOIN history USING (customer_id) JOIN versions USING (product_id)
    GROUP BY product_id, customer_id
    """
)
def customer_sales_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Sales kept from changes: lines and dimensions, more lines, then second versions of both."""
    run = _Replay(spark, folder)
    orders = _staged(replay.order_rows(run.maker, folder), "orders")
    late = F.col("order_number") % 3 == 0

    def sent(rows: DataFrame) -> DataFrame:
        return encode_changes(
            rows, ["order_number"], json_columns=schemas.ORDER_JSON_COLUMNS, topic=bus.topic_name("sales_orders")
        )

    def update() -> Lake:
        lake = run.retail(
            datasets=lambda sources: [d for d in retail_datasets(sources) if "sales_orders_c" in d.name or "fact" not in d.name and d.name != "customer_sales"],
            more=incremental_datasets(grid=4),
        )
        lake.update()
        return lake

    run.send("sales_orders", sent(orders.where(~late)))
    run.send("customers", replay.customer_messages(run.maker, folder))
    run.send("products", replay.product_messages(run.maker, folder))
    update()
    run.send("sales_orders", sent(orders.where(late)))
    update()
    renamed = replay.customer_rows(run.maker, folder).where(F.col("loyalty_segment") == "BUILDING")
    run.send("customers", encode_changes(renamed, ["customer_id"], op="u", topic=bus.topic_name("customers")))
    large = replay.table(run.maker, folder, "part").where("p_size > 40")
    large = large.select(F.col("p_partkey").cast("string").alias("product_id"))
    changed = replay.product_rows(run.maker, folder).join(large, "product_id", "left_semi")
    run.send("products", encode_changes(changed, ["product_id"], op="u", topic=bus.topic_name("products")))
    rows = update().read("customer_sales_incremental")
    run.close()
    return rows


@_register(
    """
    SELECT 'retail.public.sales_orders' AS topic, o_orderkey AS "offset", o_orderkey AS order_number,
           c_name AS customer_name, count(*) AS number_of_line_items
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    GROUP BY o_orderkey, c_name
    """
)
def raw_orders_once(spark: SparkSession, folder: str) -> DataFrame:
    """A raw table of a bus that is replayed from its start, twice, while new messages come."""
    run = _Replay(spark, folder, ["key", "value", "topic", "partition", "offset", "timestamp"])
    number = F.get_json_object(F.col("key").cast("string"), "$.payload.order_number").cast("bigint")
    messages = _staged(_placed(replay.order_messages(run.maker, folder), number), "messages")
    early = messages.where(F.col("offset") % 2 == 0)

    def update() -> Lake:
        lake = run.retail(datasets=lambda sources: retail_datasets(sources, exactly_once=True)[:1])
        lake.update()
        return lake

    run.send("sales_orders", early)
    update()
    run.send("sales_orders", messages)
    run.send("sales_orders", early)
    update()
    run.send("sales_orders", messages)
    rows = update().read("sales_orders_raw")
    run.close()
    return rows.select(
        "topic",
        "offset",
        F.get_json_object("key", "$.payload.order_number").cast("bigint").alias("order_number"),
        F.get_json_object("value", "$.payload.after.customer_name").alias("customer_name"),
        F.get_json_object("value", "$.payload.after.number_of_line_items")
        .cast("bigint")
        .alias("number_of_line_items"),
    )


# Rules on order lines: what each asks of a good line, and what happens to others.
_ORDER_RULES = [
    Rule("priced", "unit_price IS NOT NULL"),
    Rule("plain", "ordered_products.promotion_info IS NULL"),
    Rule("small", "quantity < 45", QUARANTINE),
    Rule("worth_it", "unit_price * quantity >= 2000", QUARANTINE),
]

_JUDGED = f"""
WITH {_LINES},
judged AS (
  SELECT order_number, product_id, unit_price, quantity, l_linenumber,
         unit_price IS NULL AS b0, l_discount >= 0.05 AS b1, quantity >= 45 AS b2,
         CAST(unit_price AS BIGINT) * quantity < 2000 AS b3
  FROM lines
)"""


def _rules_lake(spark: SparkSession, folder: str) -> tuple[Lake, _Replay]:
    run = _Replay(spark, folder)
    orders = _staged(replay.order_messages(run.maker, folder), "messages")
    half = F.crc32("key") % 2 == 0
    for part in (orders.where(half), orders.where(~half)):
        run.send("sales_orders", part)
        lake = run.retail(
            datasets=lambda sources: [
                d for d in retail_datasets(sources, order_rules=_ORDER_RULES) if d.name.startswith("sales_orders")
            ]
        )
        lake.update()
    return lake, run


@_register(
    f"""
    {_JUDGED}
    SELECT order_number, product_id, unit_price, quantity,
           CASE WHEN b2 OR b3 THEN 'quarantined' ELSE 'kept' END AS state,
           CASE WHEN b2 OR b3 THEN concat_ws(',', CASE WHEN b1 THEN 'plain' END, CASE WHEN b2 THEN 'small' END,
                                             CASE WHEN b3 THEN 'worth_it' END) END AS broken
    FROM judged
    """
)
def expectations_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines that keep the rules, and those in quarantine with the rules they break."""
    lake, run = _rules_lake(spark, folder)
    columns = ["order_number", "product_id", "unit_price", "quantity"]
    kept = lake.read("sales_orders_cleansed").select(
        *columns, F.lit("kept").alias("state"), F.lit(None).cast("string").alias("broken")
    )
    apart = lake.quarantine("sales_orders_cleansed").select(
        *columns, F.lit("quarantined").alias("state"), F.array_join("broken_rules", ",").alias("broken")
    )
    run.close()
    return kept.unionByName(apart)


@_register(
    f"""
    {_JUDGED}
    SELECT 'priced' AS rule, 'warn' AS action, count(*) AS checked, count(*) FILTER (b0) AS broken FROM judged
    UNION ALL SELECT 'plain', 'warn', count(*), count(*) FILTER (b1) FROM judged
    UNION ALL SELECT 'small', 'quarantine', count(*), count(*) FILTER (b2) FROM judged
    UNION ALL SELECT 'worth_it', 'quarantine', count(*), count(*) FILTER (b3) FROM judged
    """
)
def expectations_counts(spark: SparkSession, folder: str) -> DataFrame:
    """How many lines each rule has seen, and how many broke it."""
    lake, run = _rules_lake(spark, folder)
    rows = lake.rule_counts("sales_orders_cleansed")
    run.close()
    return rows


_SESSION_GAP = 60 * 86_400


@_register(
    f"""
    WITH {_LINES}, e AS (
      SELECT customer_id, CAST(epoch(CAST(order_datetime AS TIMESTAMP)) AS BIGINT) AS t, quantity,
             CAST(unit_price AS BIGINT) * quantity AS amount FROM lines
    ),
    n AS (
      SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY customer_id ORDER BY t) <= {_SESSION_GAP} THEN 0 ELSE 1 END AS opens
      FROM e
    ),
    r AS (SELECT *, sum(opens) OVER (PARTITION BY customer_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS run FROM n)
    SELECT customer_id, min(t) AS started, max(t) AS ended, count(*) AS events,
           CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(amount) AS BIGINT) AS amount
    FROM r GROUP BY customer_id, run
    """
)
def order_sessions_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of a customer's orders without a gap of over 60 days, kept as orders come in any order."""
    run = _Replay(spark, folder)
    orders = _staged(replay.order_messages(run.maker, folder), "messages")
    third = F.pmod(F.crc32("key"), F.lit(3))

    def events(spark: SparkSession, messages: DataFrame) -> DataFrame:
        lines = cleanse.cleanse_orders(messages, columns=_SALES_COLUMNS)
        return lines.select(
            "customer_id",
            F.unix_timestamp("order_datetime").alias("at"),
            F.col("quantity").cast("bigint").alias("quantity"),
            (F.col("unit_price").cast("bigint") * F.col("quantity")).alias("amount"),
        )

    sums = {"quantity": "quantity", "amount": "amount"}
    sessions = Dataset(
        "order_sessions",
        events,
        ["sales_orders_raw"],
        kind=MERGED,
        merge=Sessions("customer_id", sums, gap=_SESSION_GAP, buckets=16),
        schema=schemas.struct(
            customer_id=schemas.LONG, **{n: schemas.LONG for n in ("started", "ended", "events", *sums)}
        ),
    )
    for n in range(3):
        run.send("sales_orders", orders.where(third == n))
        lake = run.retail(datasets=lambda sources: retail_datasets(sources)[:1], more=[sessions])
        lake.update()
    rows = lake.read("order_sessions")
    run.close()
    return rows


@_register(
    f"""
    WITH {_LINES}
    SELECT order_number, product_id, unit_price, quantity
    FROM lines JOIN part ON CAST(p_partkey AS VARCHAR) = product_id WHERE p_size % 10 = 0
    """
)
def orphan_lines_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines whose product does not come, given out once the time for it has passed.

    A tenth of the products never come, half of the others after their lines.
    The last messages are far in the future and move the watermarks on.
    """
    run = _Replay(spark, folder, ["key", "value", "timestamp"])
    topic = bus.topic_name("products")
    bound = Bound("ordered_at", "timestamp", delay="1 day", within="5000 days")
    at = lambda messages, text: messages.withColumn("timestamp", F.lit(text).cast("timestamp"))
    parts = replay.table(run.maker, folder, "part").where("p_size % 10 <> 0")
    parts = parts.select(F.col("p_partkey").cast("string").alias("product_id"), (F.col("p_partkey") % 2 == 0).alias("soon"))
    products = replay.product_rows(run.maker, folder).join(parts, "product_id")
    sent = lambda rows: at(encode_changes(rows.drop("soon"), ["product_id"], topic=topic), "1995-01-01 00:00:00")
    datasets = [
        Dataset("orders_stream", run.source("sales_orders"), temporary=True),
        Dataset("products_stream", run.source("products"), temporary=True),
        Dataset(
            "order_lines",
            lambda spark, orders: cleanse.cleanse_orders(raw.as_text(orders), columns=_SALES_COLUMNS).withColumn(
                "ordered_at", F.col("order_datetime").try_cast("timestamp")
            ),
            ["orders_stream"],
            temporary=True,
        ),
        Dataset(
            "product_versions",
            lambda spark, changes: cleanse.cleanse_products(raw.as_text(changes), carry=["timestamp"])
            .where("product_id IS NOT NULL")
            .select("product_id", "timestamp"),
            ["products_stream"],
            temporary=True,
        ),
        Dataset(
            "orphan_lines",
            lambda spark, lines, versions: facts.unmatched_lines(
                lines, versions, at=bound.at, delay=bound.delay, within=bound.within, time=bound.time
            ),
            ["order_lines", "product_versions"],
            kind=BOUNDED,
            bound=bound,
            schema=T.StructType(
                [
                    *(schemas.ORDER_LINE[name] for name in _SALES_COLUMNS),
                    T.StructField("ordered_at", T.TimestampType()),
                ]
            ),
        ),
    ]

    def update() -> Lake:
        lake = Lake(spark, f"{run.root}/lake", run.database, datasets)
        lake.update()
        return lake

    run.send("sales_orders", at(replay.order_messages(run.maker, folder), "1995-01-01 00:00:00"))
    run.send("products", sent(products.where("soon")))
    update()
    run.send("products", sent(products.where("NOT soon")))
    update()
    future = "2100-01-01 00:00:00"
    order = spark.sql(
        "SELECT -1L AS order_number, -1L AS customer_id, cast(unix_timestamp(timestamp '2100-01-01 00:00:00') AS string)"
        " AS order_datetime, array(named_struct('id', 'none', 'price', 1, 'qty', 1)) AS ordered_products"
    )
    run.send(
        "sales_orders",
        at(encode_changes(order, ["order_number"], json_columns=["ordered_products"]), future),
    )
    product = spark.sql("SELECT 'never' AS product_id")
    run.send("products", at(encode_changes(product, ["product_id"], topic=topic), future))
    rows = update().read("orphan_lines").select("order_number", "product_id", "unit_price", "quantity")
    run.close()
    return rows


# -- analysis --------------------------------------------------------------


@_register(
    f"""
    WITH {_LINES}, l AS (
      SELECT customer_id, order_datetime, order_number, product_id, quantity,
             CAST(unit_price AS BIGINT) * quantity AS amount FROM lines
    )
    SELECT *, row_number() OVER w AS line_rank, CAST(sum(amount) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS spent,
           lag(amount) OVER w AS last_amount
    FROM l WINDOW w AS (PARTITION BY customer_id ORDER BY order_datetime, order_number, product_id, quantity, amount)
    """
)
def customer_running_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Each line's place among its customer's, what they had spent by then, and on the line before."""
    lines = _staged(_sales_lines(spark, folder), "lines").select(
        "customer_id",
        "order_datetime",
        "order_number",
        "product_id",
        "quantity",
        (F.col("unit_price").cast("bigint") * F.col("quantity")).alias("amount"),
    )
    return running(
        lines,
        "customer_id",
        ["order_datetime", "order_number", "product_id", "quantity", "amount"],
        rank="line_rank",
        totals={"spent": "amount"},
        previous={"last_amount": "amount"},
    )


@_register(
    f"""
    WITH {_LINES}, s AS (
      SELECT region, product_id, CAST(sum(CAST(unit_price AS BIGINT) * quantity) AS BIGINT) AS amount
      FROM lines JOIN (SELECT {_CUSTOMER}) USING (customer_id) GROUP BY region, product_id
    )
    SELECT * FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY region ORDER BY amount DESC, product_id) AS INTEGER) AS rank FROM s
    ) WHERE rank <= 10
    """
)
def top_products_per_region(spark: SparkSession, folder: str) -> DataFrame:
    """The ten products that sold for most in each region; of equal ones the least product_id."""
    regions = _customers(spark, folder).select("customer_id", "region")
    sold = facts.fact_customer_sales(
        _sales_lines(spark, folder), _products(spark, folder), _customers(spark, folder)
    )
    amounts = sold.join(regions, "customer_id").groupBy("region", "product_id").agg(
        F.sum("sale_amount").alias("amount")
    )
    return top_of_groups(amounts, ["region"], [F.desc("amount"), "product_id"], 10)


@_register(
    f"""
    WITH {_LINES}, l AS (
      SELECT region, p_type AS category, order_date AS day, customer_id, quantity,
             CAST(unit_price AS BIGINT) * quantity AS amount
      FROM lines JOIN (SELECT {_CUSTOMER}) USING (customer_id) JOIN part ON CAST(p_partkey AS VARCHAR) = product_id
    )
    SELECT region, category, day, CAST(3 - bit_count(GROUPING_ID(region, category, day)) AS INTEGER) AS level,
           count(*) AS row_count, CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(amount) AS BIGINT) AS amount,
           count(DISTINCT customer_id) AS customers, true AS estimate_is_close
    FROM l GROUP BY ROLLUP (region, category, day)
    """
)
def sales_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Sales by region, category and day and all levels above, out of stored cells.

    The number of customers is exact; whether the merged sketches' estimate lies
    within six standard errors of it (or one customer) stands beside it.
    """
    spark = _fine(spark)
    dimensions = ["region", "category", "day"]
    regions = _customers(spark, folder).select("customer_id", "region")
    categories = _products(spark, folder).select("product_id", F.col("product_category").alias("category"))
    lines = _sales_lines(spark, folder).select(
        "customer_id",
        "product_id",
        F.to_date("order_datetime").alias("day"),
        "quantity",
        (F.col("unit_price").cast("bigint") * F.col("quantity")).alias("amount"),
    )
    path = scratch_dir(spark, "sales")
    lines.join(regions, "customer_id").join(categories, "product_id").write.parquet(path)
    rows = spark.read.parquet(path)
    cells = rollup.base_cells(rows, dimensions, {"quantity": "quantity", "amount": "amount"}, "customer_id")
    path = scratch_dir(spark, "cells")
    cells.write.parquet(path)
    made = rollup.rolled_up(spark.read.parquet(path), dimensions, ["quantity", "amount"])
    made = rollup.with_exact(
        made, rollup.exact_distinct(rows, dimensions, "customer_id", "customers"), dimensions
    )
    most = F.greatest(F.lit(1.0), F.col("customers") * 6 * 1.04 / 2 ** (rollup.SKETCH_SIZE / 2))
    close = F.abs(F.col("estimate") - F.col("customers")) <= most
    return made.withColumn("estimate_is_close", close).drop("estimate")


@_register(
    f"""
    WITH {_LINES}, l AS (
      SELECT order_number, product_id, quantity, order_number % 97 AS m FROM lines
    ),
    d AS (
      SELECT order_number, product_id, quantity, -1 AS n FROM l WHERE m = 1
      UNION ALL SELECT order_number, product_id, quantity, 1 FROM l WHERE m = 2
      UNION ALL SELECT order_number, product_id, quantity, -1 FROM l WHERE m = 3
      UNION ALL SELECT order_number, product_id, quantity + 100, 1 FROM l WHERE m = 3
    )
    SELECT order_number, product_id, quantity, CAST(sum(n) AS BIGINT) AS surplus
    FROM d GROUP BY order_number, product_id, quantity
    """
)
def reconcile_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines that a lake lost, holds twice or changed, found against the source."""
    run = _Replay(spark, folder)
    orders = _staged(replay.order_rows(run.maker, folder), "orders")
    m = F.col("order_number") % 97
    product = F.transform("ordered_products", lambda x: x.withField("qty", x["qty"] + 100))
    changed = orders.where(m == 3).withColumn("ordered_products", product)
    sent = orders.where((m != 1) & (m != 3)).unionByName(orders.where(m == 2)).unionByName(changed)
    run.send(
        "sales_orders",
        encode_changes(
            sent, ["order_number"], json_columns=schemas.ORDER_JSON_COLUMNS, topic=bus.topic_name("sales_orders")
        ),
    )
    lake = run.retail(datasets=lambda sources: [d for d in retail_datasets(sources) if d.name.startswith("sales_orders")])
    lake.update()
    columns = ["order_number", "product_id", "quantity"]
    source = _staged(_sales_lines(spark, folder).select(columns), "source")
    rows = reconcile.differences(
        lake.read("sales_orders_cleansed"), source, columns, ["order_number"], 64
    )
    run.close()
    return rows
