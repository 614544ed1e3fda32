"""The gold layer of the retail lake written in SQL."""

from __future__ import annotations

from collections.abc import Mapping

from tidemark import schemas
from tidemark.plans.retail import GOLD, Source, retail_datasets
from tidemark.streaming.lake import JOINED, RECOMPUTED, Dataset

# The stream's join keys are never NULL by type, as join state has a fixed schema.
# Every key spreads over so many state partitions: lines draw a salt, and the
# rows of the dimensions are copied to each.
SALTS = 4

FACT_SALES_ORDERS = f"""
SELECT s.order_number, c.customer_key, p.product_key,
       try_cast(s.order_datetime AS DATE) AS order_date, s.unit_price, s.quantity,
       CAST(s.unit_price AS BIGINT) * s.quantity AS total_price
FROM (SELECT *, coalesce(product_id, '') AS product, coalesce(customer_id, 0L) AS customer,
             coalesce(CAST(floor(rand(20) * {SALTS}) AS INT), 0) AS product_salt,
             coalesce(CAST(floor(rand(21) * {SALTS}) AS INT), 0) AS customer_salt
      FROM sales_orders_cleansed WHERE product_id IS NOT NULL AND customer_id IS NOT NULL) s
INNER JOIN (SELECT product_key, coalesce(product_id, '') AS product,
                   explode(sequence(0, {SALTS - 1})) AS product_salt
            FROM dim_products WHERE product_id IS NOT NULL) p
  ON s.product = p.product AND s.product_salt = p.product_salt
INNER JOIN (SELECT customer_key, coalesce(customer_id, 0L) AS customer,
                   explode(sequence(0, {SALTS - 1})) AS customer_salt
            FROM dim_customers WHERE customer_id IS NOT NULL) c
  ON s.customer = c.customer AND s.customer_salt = c.customer_salt
"""

CUSTOMER_SALES = """
SELECT customer_key, product_key, sum(quantity) AS total_quantity, sum(total_price) AS sale_amount
FROM fact_sales_orders GROUP BY customer_key, product_key
"""

_FACT_SCHEMA = schemas.struct(
    **{
        "order_date" if f.name == "order_datetime" else f.name: f.dataType
        for f in schemas.FACT_SALES_ORDER.fields
    }
)


def retail_sql_datasets(sources: Mapping[str, Source], **options) -> list[Dataset]:
    """``retail_datasets`` up to the dimensions, with fact and aggregate as SELECTs.

    In the SQL every key is spread over ``SALTS`` state partitions; a key that holds
    more than as many partitions' share needs the measured salts of ``retail_datasets``.
    """
    until_dimensions = [
        d for d in retail_datasets(sources, **options) if "fact" not in d.name and d.name != "customer_sales"
    ]
    return [
        *until_dimensions,
        Dataset(
            "fact_sales_orders",
            FACT_SALES_ORDERS,
            ["sales_orders_cleansed", "dim_products", "dim_customers"],
            kind=JOINED,
            schema=_FACT_SCHEMA,
            comment="Order lines by customer and product key",
            properties=GOLD,
        ),
        Dataset(
            "customer_sales",
            CUSTOMER_SALES,
            ["fact_sales_orders"],
            kind=RECOMPUTED,
            schema=schemas.CUSTOMER_SALES,
            comment="Sales by customer and product key",
            properties=GOLD,
        ),
    ]
