"""The cleansed layer: change messages to typed rows.

All functions take a batch or a streaming frame with a text ``value`` column,
are narrow (no shuffle) and append one result per change event: an update adds
a row, it replaces nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import json_text

_PRODUCT_FIELDS = {"product_id": "id", "unit_price": "price", "quantity": "qty"}


def cleanse_orders(messages: DataFrame, *, mode: str = "nested", columns=None) -> DataFrame:
    """One row per ordered product.

    ``nested`` parses the envelope and then the arrays inside its strings.
    ``strip`` edits the quotes away first and so loses orders whose texts hold
    quotes or brackets; it is there to reproduce that result.  An order without
    products gives no row in either mode.

    ``columns`` names the wanted columns of ``schemas.ORDER_LINE``; only what
    they need is parsed.
    """
    columns = schemas.ORDER_LINE.names if columns is None else list(columns)
    schemas.pick(schemas.ORDER_LINE, columns)
    needed = {"ordered_products"} | (set(columns) & set(schemas.ORDER.names))
    order_schema = schemas.pick(schemas.ORDER, needed)
    if "ordered_products" not in columns:
        order_schema = _narrow_products(
            order_schema, [field for name, field in _PRODUCT_FIELDS.items() if name in columns]
        )

    if mode == "nested":
        orders = _nested_orders(messages, order_schema)
    elif mode == "strip":
        orders = _stripped_orders(messages, order_schema)
    else:
        raise ValueError(f"mode is 'nested' or 'strip', not {mode!r}")

    others = [c for c in order_schema.names if c != "ordered_products"]
    lines = _explode(orders, F.col("ordered_products"), "ordered_products", others)
    return lines.select(*[_line_column(name) for name in columns])


def cleanse_customers(
    messages: DataFrame, *, keep_null_rows: bool = False, carry: Sequence[str] = ()
) -> DataFrame:
    """Customer versions.  ``keep_null_rows`` keeps an all-NULL row per delete.

    ``carry`` names columns of the message, such as its time, that go along.
    """
    return _cleanse_rows(messages, schemas.CUSTOMER, keep_null_rows, carry)


def cleanse_products(
    messages: DataFrame, *, keep_null_rows: bool = False, carry: Sequence[str] = ()
) -> DataFrame:
    """Product versions, with ``keep_null_rows`` and ``carry`` as for customers.

    ``product_id`` is char(20) at the source, where padding is not part of the
    value, so trailing spaces go.
    """
    rows = _cleanse_rows(messages, schemas.PRODUCT, keep_null_rows, carry)
    return rows.withColumn("product_id", F.rtrim("product_id"))


def _cleanse_rows(
    messages: DataFrame, schema: T.StructType, keep_null_rows: bool, carry: Sequence[str]
) -> DataFrame:
    row = json_text.parse_after(F.col("value"), schema)
    if keep_null_rows:
        parsed = messages.select(*carry, row.alias("row"))
    else:
        parsed = explode_kept(messages, row, "row", carry)
    return parsed.select(*carry, "row.*")


def explode_kept(rows: DataFrame, value: Column, name: str, others: Sequence[str] = ()) -> DataFrame:
    """``value`` of the rows where it is not null, worked out once, next to ``others``."""
    return _explode(rows, F.array_compact(F.array(value)), name, others)


def _explode(rows: DataFrame, items: Column, name: str, others) -> DataFrame:
    """The rows of a plain explode, parsing each message once.

    A filter on a parsed column, or one that the optimizer infers from a plain
    explode, is pushed below the parse and so parses everything a second time.
    The position of an outer explode gives a filter that stays above.
    """
    exploded = rows.select(*others, F.posexplode_outer(items).alias("_position", name))
    return exploded.where("_position is not null").drop("_position")


def _narrow_products(order: T.StructType, fields) -> T.StructType:
    products = T.ArrayType(schemas.pick(schemas.ORDERED_PRODUCT, fields or ["id"]))
    return T.StructType(
        [
            T.StructField(f.name, products if f.name == "ordered_products" else f.dataType)
            for f in order.fields
        ]
    )


def _nested_orders(messages: DataFrame, schema: T.StructType) -> DataFrame:
    json_columns = set(schemas.ORDER_JSON_COLUMNS) & set(schema.names)
    texts = json_text.strings_for(schema, json_columns)
    rows = messages.select(json_text.parse_after(F.col("value"), texts).alias("row"))
    return rows.select(
        *[
            F.from_json(F.col("row")[f.name], f.dataType).alias(f.name)
            if f.name in json_columns
            else F.col("row")[f.name].alias(f.name)
            for f in schema.fields
        ]
    )


def _stripped_orders(messages: DataFrame, schema: T.StructType) -> DataFrame:
    row = json_text.strip_array_quotes(json_text.after_image(F.col("value")))
    return messages.select(F.from_json(row, schema).alias("row")).select("row.*")


def _line_column(name: str) -> Column:
    if name == "order_datetime":
        return json_text.epoch_to_text(F.col(name)).alias(name)
    if name == "product_id":
        return F.rtrim(F.col("ordered_products")["id"]).alias(name)
    if name in _PRODUCT_FIELDS:
        return F.col("ordered_products")[_PRODUCT_FIELDS[name]].alias(name)
    return F.col(name)
