"""Change events derived from base tables, for replays and checks.

Builds the three captured tables out of ``customer part orders lineitem nation
region`` and encodes their rows as bus messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.changes import encode_changes
from tidemark.functions.decimals import encode_scaled_decimal
from tidemark.sources.bus import topic_name

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Order documents: ``schemas.ORDER`` with the products of each order."""
    line = table(spark, folder, "lineitem")
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    # One list of plain columns goes through the shuffle; the documents, which
    # repeat them, are made of it afterwards.
    plain = [
        F.col("l_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        _whole("l_extendedprice").alias("price"),
        _whole("l_quantity").alias("qty"),
        "l_linenumber",
        F.when(F.col("l_discount") >= 0.05, F.col("l_discount").cast(schemas.DISCOUNT)).alias("discount"),
        (F.col("l_discount") >= 0.05).alias("promoted"),
        (F.col("l_discount") >= 0.09).alias("listed"),
    ]
    # A captured row holds its documents in one value, so the lists are as long
    # as the source's own record.
    grouped = (
        line.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(F.collect_list(F.struct(*plain)).alias("_lines"))
    )
    promoted = F.filter("_lines", lambda x: x["listed"])
    documents = grouped.select(
        "l_orderkey",
        F.size("_lines").cast("bigint").alias("number_of_line_items"),
        F.transform("_lines", _ordered_product).alias("ordered_products"),
        F.transform(
            "_lines", lambda x: F.array(x["name"], x["l_linenumber"].cast("string"))
        ).alias("clicked_items"),
        F.transform(promoted, _promotion).alias("promo_info"),
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    columns = {
        "customer_id": F.col("o_custkey"),
        "customer_name": F.col("c_name"),
        "order_datetime": F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string"),
        "order_number": F.col("o_orderkey"),
    }
    # The heads meet their customers first, so the documents stay where they were grouped.
    heads = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return documents.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *[columns.get(n, F.col(n)).alias(n) for n in schemas.ORDER.names]
    )


def customer_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Customers: ``schemas.CUSTOMER``.  Only accounts in debt have an end of validity."""
    columns = {
        "customer_id": F.col("c_custkey"),
        "tax_id": F.concat(F.lit("T-"), "c_custkey"),
        "tax_code": F.concat(F.lit("C"), F.col("c_custkey") % 7),
        "customer_name": F.col("c_name"),
        "state": F.col("n_name"),
        "city": F.concat("n_name", F.lit(" City"), F.col("c_custkey") % 11),
        "postcode": F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0"),
        "street": F.concat(F.lit("Street "), F.col("c_custkey") % 101),
        "number": (F.col("c_custkey") % 300).cast("string"),
        "unit": F.concat(F.lit("U"), F.col("c_custkey") % 9),
        "region": F.col("r_name"),
        "district": F.concat("r_name", F.lit("/"), "n_name"),
        "lon": (F.col("c_nationkey") * -1.5).cast(schemas.DEGREES),
        "lat": (F.col("c_nationkey") * 0.5).cast(schemas.DEGREES),
        "ship_to_address": F.concat(F.lit("Ship to "), "c_custkey", F.lit(", "), "n_name"),
        "valid_from": encode_scaled_decimal(F.lit(1534928698) + F.col("c_custkey"), 0),
        "valid_to": encode_scaled_decimal(
            F.when(F.col("c_acctbal") < 0, F.lit(1634928698) + F.col("c_custkey")), 0
        ),
        "units_purchased": encode_scaled_decimal(_cents("c_acctbal"), 2),
        "loyalty_segment": F.col("c_mktsegment"),
    }
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(*_shaped(schemas.CUSTOMER, columns))
    )


def product_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Products: ``schemas.PRODUCT``."""
    columns = {
        "product_id": F.col("p_partkey").cast("string"),
        "product_category": F.col("p_type"),
        "product_name": F.col("p_name"),
        "sales_price": encode_scaled_decimal(_cents("p_retailprice"), 2),
        "ean13": F.lit(2.0e12) + F.col("p_partkey"),
        "ean5": F.lpad((F.col("p_partkey") % 100000).cast("string"), 5, "0"),
        "product_unit": F.lit("pcs"),
    }
    return table(spark, folder, "part").select(*_shaped(schemas.PRODUCT, columns))


def order_messages(spark: SparkSession, folder: str) -> DataFrame:
    return encode_changes(
        order_rows(spark, folder),
        ["order_number", "customer_id", "order_datetime"],
        json_columns=schemas.ORDER_JSON_COLUMNS,
        topic=topic_name("sales_orders"),
    )


def customer_messages(spark: SparkSession, folder: str) -> DataFrame:
    return encode_changes(
        customer_rows(spark, folder),
        ["customer_id", "valid_from"],
        topic=topic_name("customers"),
    )


def product_messages(spark: SparkSession, folder: str) -> DataFrame:
    return encode_changes(
        product_rows(spark, folder), ["product_id"], topic=topic_name("products")
    )


def _ordered_product(line: Column) -> Column:
    return F.struct(
        F.lit("USD").alias("curr"),
        line["id"].alias("id"),
        line["name"].alias("name"),
        line["price"].alias("price"),
        line["qty"].alias("qty"),
        F.lit("pcs").alias("unit"),
        F.when(line["promoted"], _promotion(line)).alias("promotion_info"),
    )


def _promotion(line: Column) -> Column:
    return F.struct(
        (line["l_linenumber"] * 10).alias("promo_id"),
        F.lit(1).alias("promo_qty"),
        line["discount"].alias("promo_disc"),
        line["id"].alias("promo_item"),
    )


def _whole(name: str) -> Column:
    return F.floor(F.col(name)).cast("int")


def _cents(name: str) -> Column:
    return F.round(F.col(name) * 100).cast("bigint")


def _shaped(schema, columns: dict[str, Column]) -> list[Column]:
    return [
        columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
