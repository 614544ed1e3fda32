"""Column layouts of the retail change feed.

The names and types below are fixed values: they are the contract between the
captured tables, the JSON on the bus and every table built from it.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
DEGREES = T.DecimalType(10, 6)
DISCOUNT = T.DecimalType(3, 2)


def struct(**fields: T.DataType) -> T.StructType:
    """A struct whose fields are all nullable, in the order given."""
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def pick(schema: T.StructType, names) -> T.StructType:
    """The named fields of ``schema``, in the order of ``schema``."""
    wanted = set(names)
    unknown = wanted - set(schema.names)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return T.StructType([f for f in schema.fields if f.name in wanted])


# An unconstrained numeric column travels as its scale and the base64 text of
# its unscaled big-endian two's-complement bytes.
SCALED_DECIMAL = struct(scale=INT, value=STRING)

PROMOTION = struct(promo_id=INT, promo_qty=INT, promo_disc=DISCOUNT, promo_item=STRING)

ORDERED_PRODUCT = struct(
    curr=STRING,
    id=STRING,
    name=STRING,
    price=INT,
    qty=INT,
    unit=STRING,
    promotion_info=PROMOTION,
)

ORDER = struct(
    customer_id=LONG,
    customer_name=STRING,
    order_datetime=STRING,
    order_number=LONG,
    ordered_products=T.ArrayType(ORDERED_PRODUCT),
    number_of_line_items=LONG,
    clicked_items=T.ArrayType(T.ArrayType(STRING)),
    promo_info=T.ArrayType(PROMOTION),
)

# Columns of ORDER that the source keeps as json, so they reach the bus as JSON
# text inside a JSON string.
ORDER_JSON_COLUMNS = ("ordered_products", "clicked_items", "promo_info")

# One row per ordered product: the order's columns, the product itself in place
# of the array, and the three product fields that later tables use.
ORDER_LINE = T.StructType(
    [
        T.StructField(f.name, ORDERED_PRODUCT if f.name == "ordered_products" else f.dataType)
        for f in ORDER.fields
    ]
    + struct(product_id=STRING, unit_price=INT, quantity=INT).fields
)

CUSTOMER = struct(
    customer_id=LONG,
    tax_id=STRING,
    tax_code=STRING,
    customer_name=STRING,
    state=STRING,
    city=STRING,
    postcode=STRING,
    street=STRING,
    number=STRING,
    unit=STRING,
    region=STRING,
    district=STRING,
    lon=DEGREES,
    lat=DEGREES,
    ship_to_address=STRING,
    valid_from=SCALED_DECIMAL,
    valid_to=SCALED_DECIMAL,
    units_purchased=SCALED_DECIMAL,
    loyalty_segment=STRING,
)

PRODUCT = struct(
    product_id=STRING,
    product_category=STRING,
    product_name=STRING,
    sales_price=SCALED_DECIMAL,
    ean13=DOUBLE,
    ean5=STRING,
    product_unit=STRING,
)

DIM_CUSTOMER = T.StructType(struct(customer_key=LONG).fields + CUSTOMER.fields)
DIM_PRODUCT = T.StructType(struct(product_key=LONG).fields + PRODUCT.fields)

# total_price is a bigint: the product of two ints may exceed 32 bits.
FACT_SALES_ORDER = struct(
    order_number=LONG,
    customer_key=LONG,
    product_key=LONG,
    order_datetime=T.DateType(),
    unit_price=INT,
    quantity=INT,
    total_price=LONG,
)

FACT_CUSTOMER_SALES = struct(
    product_id=STRING, customer_id=LONG, total_quantity=LONG, sale_amount=LONG
)

CUSTOMER_SALES = struct(
    customer_key=LONG, product_key=LONG, total_quantity=LONG, sale_amount=LONG
)

# What the bus connector hands over for each message.
BUS_MESSAGE = struct(
    key=T.BinaryType(),
    value=T.BinaryType(),
    topic=STRING,
    partition=INT,
    offset=LONG,
    timestamp=T.TimestampType(),
    timestampType=INT,
)

# Flat files of the source database.  Column order is the order in the file.
CUSTOMER_FILE = struct(
    customer_id=INT,
    tax_id=STRING,
    tax_code=STRING,
    customer_name=STRING,
    state=STRING,
    city=STRING,
    postcode=STRING,
    street=STRING,
    number=STRING,
    unit=STRING,
    region=STRING,
    district=STRING,
    lon=DOUBLE,
    lat=DOUBLE,
    ship_to_address=STRING,
    valid_from=T.DecimalType(38, 10),
    valid_to=T.DecimalType(38, 10),
    units_purchased=T.DecimalType(38, 10),
    loyalty_segment=INT,
)

PRODUCT_FILE = struct(
    product_id=STRING,
    product_category=STRING,
    product_name=STRING,
    sales_price=T.DecimalType(38, 10),
    ean13=DOUBLE,
    ean5=STRING,
    product_unit=STRING,
)

ORDER_FILE = struct(
    order_number=INT,
    customer_id=INT,
    order_datetime=STRING,
    customer_name=STRING,
    clicked_items=STRING,
    number_of_line_items=T.ShortType(),
    ordered_products=STRING,
    promo_info=STRING,
)
